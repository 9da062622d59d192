import itertools

from helpers_llm import SMOKE, odd_docs, words
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmarts.llm.common import table
from sparkmarts.llm.license_templates import PHRASES, TEMPLATES, compile_template, licenses, matcher
from sparkmarts.llm.queries import op10_licenses


def expand(template):
    """All wordings of a template without nested regions; <n> with 0..n times 'z'."""
    import re

    parts = []
    for t in re.findall(r"\[[^\]]*\]|\{[^}]*\}|<\d+>|[^\s\[\]{}<>]+", template):
        if t[0] == "[":
            parts.append(["", t[1:-1]])
        elif t[0] == "{":
            parts.append(t[1:-1].split("|"))
        elif t[0] == "<":
            parts.append([" ".join(["z"] * i) for i in range(int(t[1:-1]) + 1)])
        else:
            parts.append([t])
    return {tuple(" ".join(c).split()) for c in itertools.product(*parts)}


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.sampled_from(["a", "b", "[a]", "[b a]", "{a|b b}", "<2>", "z"]), min_size=0, max_size=5).map(" ".join),
    st.lists(st.sampled_from("abz"), max_size=7),
)
def test_automaton_accepts_what_the_markup_allows(template, text):
    template = "a " + template
    words_ = [w.encode() for w in text]
    all_ = expand(template)
    # <n> takes any words, not only z
    ends = [n for n in range(len(text) + 1) if any(len(w) == n and all(x == y or x == "z" and "<" in template for x, y in zip(w, text)) for w in all_)]
    got = compile_template(template).longest(words_, 0)
    if "<" not in template or "z" not in template.replace("<2>", ""):
        assert got == (ends[-1] if ends else -1)


def test_every_template_accepts_its_own_wording():
    m = matcher()
    for label, texts in TEMPLATES.items():
        for t in texts:
            for full in (True, False):
                import re

                s = re.sub(r"<\d+>", "some words" if full else "", t)
                s = re.sub(r"\{([^|}]*)\|[^}]*\}", r"\1", s)
                s = re.sub(r"\[([^\]]*)\]", r"\1" if full else "", s)
                _, _, found = m.find(f"Intro. {s.upper()} - tail".encode())
                assert label in {x for *_, x in found}, (label, s)
    changed = "Permission is hereby granted, free of charge, to any cat obtaining a copy"
    assert not m.find(changed.encode())[2]


def test_query_on_given_tables(spark):
    texts = {r.doc_id: r.text for r in table(spark, SMOKE, "documents").collect()}
    for r in op10_licenses(spark, SMOKE).collect():
        w = words(texts[r.doc_id])
        places = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_labels_and_odd_rows(spark):
    rows = [(1, "Released under the MIT License."), (2, "Licensed under CC BY-NC 4.0."), (3, "an MIT license, an MIT license"),
            (4, "Licensed under the terms of the Apache License, Version 2.0.")]
    got = {r.doc_id: r for r in licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].labels, got[1].score, got[1].n_base) == ("MIT,mit", 1.0, 1)
    assert (got[2].labels, got[2].score, got[2].first_word) == ("CC-BY-NC-4.0", 1.0, None)
    assert (got[3].labels, got[3].score, got[3].first_word, got[3].last_word) == ("mit", 0.5, 1, 4)
    assert (got[4].labels, got[4].matches[0].end_word) == ("Apache-2.0,apache", 11)
    docs = odd_docs(spark)
    assert licenses(docs, keep=["doc_id"]).count() == docs.count() and licenses(docs.limit(0), keep=["doc_id"]).count() == 0
