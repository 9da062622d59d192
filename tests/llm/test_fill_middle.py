import hashlib

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import numpy as np

from sparkmarts.llm.common import table
from sparkmarts.llm.fill_middle import fill_middle, pieces, restore, transform
from sparkmarts.llm.queries import op12_fill_middle

SMOKE = "/root/testdata/sf0.001"


def plain_fim(doc_id, text, seed=1, rate=90, spm_rate=20):
    """(n, form, prefix units, middle units, output) by slicing a Python string."""
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_rate:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


WORDS = st.text(alphabet=st.sampled_from(list("ab <PSM>\n\x00éß漢😀́")), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(WORDS, max_size=12), st.integers(1, 40))
def test_pieces_make_up_the_texts(texts, part_bytes):
    rng = np.random.default_rng(len(texts))
    n = np.array([len(t) for t in texts], np.int64)
    low = (rng.random(len(n)) * (n + 1)).astype(np.int64)
    high = low + (rng.random(len(n)) * (n - low + 1)).astype(np.int64)
    got = pieces(pa.array(texts, pa.string()), low, high, part_bytes)
    for i, t in enumerate(texts):
        assert [got[r][i].as_py() for r in ("prefix", "middle", "suffix")] == [t[: low[i]], t[low[i] : high[i]], t[high[i] :]]


def test_slice_of_an_array():
    texts = pa.array(["xx", "añb", "", "漢字"]).slice(1)
    got = pieces(texts, np.array([1, 0, 0]), np.array([2, 0, 1]))
    assert got["prefix"].to_pylist() == ["a", "", ""]
    assert got["middle"].to_pylist() == ["ñ", "", "漢"]
    assert got["suffix"].to_pylist() == ["b", "", "字"]


@settings(max_examples=40, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=10))
def test_transform_against_plain_slicing(texts):
    h = np.array([[int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for i in range(len(texts))] for k in range(4)])
    got = transform(pa.array(texts, pa.string()), *h, part_bytes=16)
    for i, t in enumerate(texts):
        assert tuple(got[c][i].as_py() for c in ("n", "form", "prefix_chars", "middle_chars", "output")) == plain_fim(i, t)


def test_rows_of_all_kinds(spark):
    long = "Ünï<b> c😀" * 400_000  # several parts
    rows = [(i, t) for i, t in enumerate(["", None, "a", "<P>x", "a<S", "<" * 9, "x<M>", "same", long])] + [(7, "same"), (None, "no id"), (7, "same")]
    df = spark.createDataFrame([(i, t, "u", 1.0, "d", 5) for i, t in rows], "doc_id long, text string, output string, __text double, __draws string, n int")
    got = fill_middle(df)
    assert got.columns == ["doc_id", "text", "__text", "__draws", "form", "prefix_chars"][:4] + ["n", "form", "prefix_chars", "middle_chars", "output"]
    found = got.withColumn("back", restore(F.col("output"), F.col("form"))).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found) == sorted(
        (i is None, i, *plain_fim(i, t)) for i, t in rows
    )
    assert all(r.back == (r.text or "") and r["__text"] == 1.0 and r["__draws"] == "d" for r in found)


def test_every_form_is_restored(spark):
    rows = [(i, f"<<a{i}<S P><{'é' * (i % 7)}<") for i in range(300)] + [(i, None) for i in range(5)]
    got = fill_middle(spark.createDataFrame(rows, "doc_id int, text string"), seed=3, rate=70, spm_rate=50)
    found = got.withColumn("back", restore(F.col("output"), F.col("form"))).collect()
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        assert r.back == (r.text or "")
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(r.doc_id, r.text, 3, 70, 50)


def test_empty_table(spark):
    assert fill_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_on_given_table(spark):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for r in table(spark, SMOKE, "documents").select("doc_id", "text").collect():
        n, form, p, m, out = plain_fim(r.doc_id, r.text)
        want[r.doc_id] = (n, form, p, m, sha(out), sha(r.text or ""))
    got = {r.doc_id: tuple(r)[1:] for r in op12_fill_middle(spark, SMOKE).collect()}
    assert got == want
