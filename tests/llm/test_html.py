import html
import re
import time

import pytest
from helpers_llm import SMOKE
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmarts.llm.common import table
from sparkmarts.llm.html_render import extract, render, shown, title_in, tree
from sparkmarts.llm.queries import op4_html
from sparkmarts.llm.warc_derive import links

CASES = [
    ("<p>One<p>Two <b>bo</b>ld", "One\n\nTwo bold"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
    ("<ol start=9><li>x<li>y<li value=20>z</ol>", "9. x\n10. y\n20. z"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>10<tr><td>kiwi fruit<td>2</table>", "Name       | Qty\napple      | 10\nkiwi fruit | 2"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><tr><td>a<table><tr><td>x<td>y</table><td>b</table>", "a     | b\nx | y |"),
    ("<pre>\n a  b\n   c</pre>x", " a  b\n   c\n\nx"),
    ("x<div style='display: none'>no</div><p hidden>no</p><div>y</div>", "x\ny"),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><noscript>n</noscript>t", "t"),
    ("<!-- a > b --><title>T</title>v<!-- unclosed", "v"),
    ("a &amp; &lt;b&gt; &copy; &#233;", "a & <b> © é"),
    ("<a href='x>y'>l</a> <img alt=' pic '>", "l pic"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("one</p>two<textarea> a\n b</textarea>", "one\n\ntwo a\n b"),
    ("a < b and c <1", "a < b and c <1"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("<select><option>o<option>p</select><input type=submit value=Go><input value=yes><input type=password value=no>", "o Goyes"),
    ("", ""),
]


@pytest.mark.parametrize(("source", "text"), CASES)
def test_rendering(source, text):
    assert render(source) == text


PIECES = ["<p>", "</p>", "<li>", "<ul>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<b>", "</b>", "<div>", "</div>", "w1 ", "w2", " w3", "<br>", "<pre>", "</pre>", "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
def test_no_visible_character_is_lost(source):
    """Without hidden elements, all text comes out in order; outside tables exactly so."""
    want = re.sub(r"<[^>]*>|\s", "", source)
    got = re.sub(r"[\s|]|- ", "", render(source))
    assert sorted(got) == sorted(want)
    if "<table>" not in source:
        assert got == want


HEADS = [
    ("<html><head><title>T</title><h1>A</h1><p>text", "A\n\ntext"),
    ("<head><meta charset=utf-8><title>T</title>\ntext <b>x</b></head><body>y", "text x\ny"),
    ("<head><noscript><img alt=n></noscript><style>s{}</style><div>a</div><title>T</title></head><body>b", "a\nb"),
    ("<p>a<head>b</p>c", "ab\n\nc"),
    ("<head><template><p>no</template></head><body>b", "b"),
]


@pytest.mark.parametrize(("source", "text"), HEADS)
def test_a_head_ends_where_the_body_begins(source, text):
    assert render(source) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*PIECES, "<head>", "<head>", "</head>", "<body>", "<meta>"]), max_size=30).map("".join))
def test_no_visible_character_is_lost_by_a_head(source):
    got = re.sub(r"[\s|]|- ", "", render(source))
    assert sorted(got) == sorted(re.sub(r"<[^>]*>|\s", "", source))


TABLES = [
    ("<table><tbody><form><tr><td>a</td></tr></form></tbody></table>", "a"),
    ("<table><tbody><form><tr><td>a<td>b</tr></form><tr><td>cc<td>d</table>", "a  | b\ncc | d"),
    ("<table><tbody>text<div>x</div><tr><td>a<td>b</table>", "text\nx\na | b"),
    ("<table><thead>h<tfoot><p>f</p><tbody><tr><form><td>a<td>b</form></table>", "h\n\nf\n\na | b"),
    ("<table><colgroup><div>c</div><tr><td>a</table>", "c\na"),
    ("<table><tr><td><form><table><tr><td>in</table></form><td>b</table>", "in | b"),
    ("<table><tbody hidden>no<tr><td>no</tbody><tbody><tr><td>a</table>", "a"),
]


@pytest.mark.parametrize(("source", "text"), TABLES)
def test_all_parts_of_a_table_show(source, text):
    assert render(source) == text


GROUPS = ["<tbody>", "</tbody>", "<thead>", "<tfoot>", "<form>", "</form>", "<colgroup>", "<caption>"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*PIECES, *GROUPS]), max_size=30).map("".join))
def test_no_visible_character_is_lost_in_row_groups(source):
    got = re.sub(r"[\s|]|- ", "", render("<table>" + source))
    assert sorted(got) == sorted(re.sub(r"<[^>]*>|\s", "", source))


DRAWN = [
    ("a <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> b", "a x=1 2 b"),
    ("<math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math>", "x"),
    ("<annotation>shown</annotation>", "shown"),
    ("<p>a<svg width='1'><defs><text>no</text></defs><title>no</title><g><text>yes<desc>no</desc></text></g></svg>b", "a yes b"),
    ("<svg><style>x{}</style><text><![CDATA[1 < 2]]></text><text display=none>no</text></svg>", "1 < 2"),
    ("<svg><foreignObject><p>in</p></foreignObject></svg>", "in"),
    ("<div>a <svg/>b <math/>c</div>", "a b c"),
    ("<div><svg><path d='M0 0'/><script/></svg>b</div>", "b"),
    ("<div><svg><g><svg><path><p>b", "b"),
    ("<math><title><td></title></svg></math><p>END", "END"),
    ("<svg><foreignObject><tr><td>a</foreignObject></svg>b<table><tr><td>c</table>", "a b\n\nc"),
    ("<map name=m><a href=x>l</a><area alt=no></map>", "l"),
    ("<select><option>o<option selected>p</select> q", "p q"),
    ("<select multiple><optgroup><option>o<option>p</select>q", "o p q"),
]


@pytest.mark.parametrize(("source", "text"), DRAWN)
def test_drawings_formulas_and_choices(source, text):
    assert render(source) == text


FOREIGN = ["<svg>", "</svg>", "<svg/>", "<math>", "</math>", "<math/>", "<text>", "</text>", "<mi>", "</mi>", "<title>", "<g/>", "<"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*PIECES, *FOREIGN]), max_size=30).map("".join))
def test_what_follows_a_drawing_shows(source):
    # as many ends as there may be drawings in titles of drawings
    assert render(source + "</title></svg></math>" * 31 + "<p>END").split()[-1:] in (["END"], ["|END"]) or "<table>" in source


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/\"'=-!&;ab pt\n", max_size=60))
def test_any_input_renders(source):
    render(source)


def test_deep_and_long_pages():
    assert render("<div>" * 50_000 + "x") == "x"
    assert render("<b" * 20_000).count("<b") in (0, 20_000)
    assert len(render("<p>word " * 50_000).split()) == 50_000
    assert render("<table>" + "<tr><td>a<td>b" * 3000 + "</table>").count("\n") == 2999


def test_query_on_given_table(spark):
    pages = {r.page_id: r.html for r in table(spark, SMOKE, "pages").collect()}
    got = op4_html(spark, SMOKE).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->", "", pages[r.page_id])
        want = html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        assert [w for w in r.rendered.split() if w != "-"] == [w for w in want if w != "-"]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "<p>x"), (1, None), (3, "<p>y " * 20_000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, html string, title string").drop("title")
    got = {r.page_id: r for r in extract(df, keep=["page_id"]).collect()}
    assert (got[1].rendered, got[1].title, got[2].rendered, got[None].rendered) == ("", "", "", "x")
    assert extract(df.limit(0)).count() == 0


SHOWN = [
    ("<div style='visibility:hidden'>no<p style='visibility: visible'>yes</p>no</div>z", "yes\n\nz"),
    ("<p style='visibility:hidden'>no <b>no</b></p>y", "y"),
    ("<table><tr style='visibility:hidden'><td>a<td style='visibility:visible'>b<tr><td>c<td>d</table>", "  | b\nc | d"),
    ("<p style='backface-visibility: hidden'>y</p>", "y"),
    ("<ruby>kan<rp>(</rp><rt>ji</rt><rp>)</rp></ruby>", "kanji"),
    ("<details><summary>s</summary>no<p>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    ("<select><option disabled>a<option>b<option>c</select>", "b"),
    ("<select><option>a<option selected>b</select>", "b"),
]


@pytest.mark.parametrize(("source", "text"), SHOWN)
def test_what_a_browser_shows(source, text):
    assert render(source) == text


def test_titles_come_from_the_tree():
    title = lambda s: title_in(tree(s))
    assert title("<!-- <title>bad</title> --><head><title> good\n one &amp; two</title>") == "good one & two"
    assert title("<body><svg><title>bad</title></svg><template><title>bad</title></template><title>late</title>") == "late"
    assert title("<p>none") == ""


def test_time_grows_with_the_page():
    for piece in ("<html ", "<a ", "<title", "<title>", "<!--", "<a href='", "<p style='visibility:hidden'>", "<details>", "<select><option>"):
        source = piece * ((1 << 18) // len(piece))
        for page in (source, source + ">"):
            began = time.process_time()
            root = tree(page)
            title_in(root), shown(root), list(links(root, "http://x.org/"))
            assert time.process_time() - began < 8, piece
