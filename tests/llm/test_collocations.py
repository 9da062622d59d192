import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmarts.llm.collocations import collocations, merge_join, mine, segments
from sparkmarts.llm.common import table
from sparkmarts.llm.queries import op13_collocations

SMOKE = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=30, top=2000, absorbed=80, max_words=4):
    """The result by counting every phrase in a dictionary."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    cands = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in cands.items():
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        inside = any(
            100 * b >= absorbed * a
            for (other, v), b in cands.items()
            if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
        )
        if not inside:
            out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    got, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return got


def run(spark, rows, **options):
    df = spark.createDataFrame([(t, g, "x", 1) for t, g in rows], "text string, lang string, phrase string, chunk int")
    return sorted((tuple(r) for r in collocations(df, **options).collect()), key=lambda r: (r[0], r[1]))


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["The", "a", "of", "é", "漢", "x\x00y", "the-cat", "\x1c", "sat", "mat"]
    ends = [".", ",", "\n", "\r", "\x0b", "!", "?", ";", ":", " ", "  ", "\t", " \t "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + (rng.choice(ends) if rng.random() < 0.3 else " ") for _ in range(rng.randint(0, 30)))
        rows.append((text, rng.choice(["en", "en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", "de"), (None, None), ("one", "la"), rows[0], rows[0]]


def test_against_counting(spark):
    rows = corpus(250, 3)
    for options in ({"least": 3}, {"least": 5, "top": 7, "salts": 3}, {"least": 2, "absorbed": 30, "max_words": 3}):
        want = plain(rows, **{k: v for k, v in options.items() if k != "salts"})
        assert len(want) > 5
        assert run(spark, rows, **options) == want


def test_chunks_and_cut_texts_change_nothing(spark):
    rows = corpus(60, 5) + [("a the of sat " * 40 + "a" * 300 + " the of." + " sat mat" * 50, "en")]
    want = plain(rows, least=3)
    for size in (7, 200):
        assert run(spark, rows, least=3, chunk_bytes=size) == want


def test_overlapping_occurrences(spark):
    rows = [("b b b b b, b b", "en")]
    assert run(spark, rows, least=1) == plain(rows, least=1)
    phrases, languages = mine(spark.createDataFrame(rows, "text string, lang string"), least=2)
    assert {r.phrase: r.a for r in phrases.collect()} == {"b": 7, "b b": 5, "b b b": 3, "b b b b": 2}
    assert [tuple(r) for r in languages.collect()] == [("en", 7)]


def test_ties_go_by_bytes_and_rank_is_whole(spark):
    rows = [(f"{a} {b}", "en") for a, b in (("ä", "b"), ("z", "b2"), ("Y", "c"), ("𝒳", "q"), ("～", "q2"))] * 2
    got = run(spark, rows, least=2)
    assert got == plain(rows, least=2)
    assert [r[2] for r in got] == sorted((r[2] for r in got), key=str.encode)


def test_empty_and_rare(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, None), ("", "en")]) == []
    assert run(spark, [("a b c", "en")]) == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\t\né", max_size=60), st.integers(1, 20), st.integers(0, 3))
def test_segments_hold_every_phrase_once(text, max_bytes, context):
    parts = list(segments(text.encode(), max_bytes, context))
    for k in range(1, context + 2):
        whole, cut = Counter(), Counter()
        for piece in re.split(r"[.\n]", text):
            w = piece.split()
            whole.update(tuple(x.encode() for x in w[i : i + k]) for i in range(len(w) - k + 1))
        for tokens, lead in parts:
            cut.update(
                tuple(tokens[i : i + k]) for i in range(len(tokens) - k + 1) if i + k > lead and b"." not in tokens[i : i + k]
            )
        assert whole == cut


def test_merge_join():
    left, right = np.array([0, 1, 4, 9]), np.array([2, 3, 5, 11])
    i, j = merge_join(left, right, 2)
    assert list(zip(left[i], right[j], strict=True)) == [(0, 2), (1, 3), (9, 11)]
    assert all(len(x) == 0 for x in merge_join(left[:0], right, 1) + merge_join(left, right[:0], 1))


def test_query_on_given_table(spark):
    rows = [(r.text, r.lang) for r in table(spark, SMOKE, "documents").select("text", "lang").collect()]
    got = sorted((tuple(r) for r in op13_collocations(spark, SMOKE).collect()), key=lambda r: (r[0], r[1]))
    assert got == plain(rows)


def test_rows_that_are_counted_do_not_stay_on_disk(spark, monkeypatch):
    import os

    from sparkmarts.llm import collocations as module

    made = {}

    def noted(df, name, **how):
        held = {n: sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(t.scratch) for f in files if f.endswith(".parquet")) for n, t in made.items()}
        made[name] = module_materialise(df, name, **how)
        sizes[name] = held
        return made[name]

    sizes, module_materialise = {}, module.materialise
    monkeypatch.setattr(module, "materialise", noted)
    rows = [("alpha beta gamma delta. alpha beta epsilon", "en")] * 40 + [("uno dos tres", None)] * 40
    phrases, languages = mine(spark.createDataFrame(rows, "text string, lang string"))
    assert {(r.phrase, r.a) for r in phrases.collect()} >= {("alpha beta", 80), ("alpha beta gamma delta", 40), ("uno dos tres", 40)}
    assert {r.lang: r.n for r in languages.collect()} == {"en": 280, "und": 120}
    for name, gone in (("c2", ("r1", "c1")), ("c3", ("r2", "c2")), ("c4", ("r3", "c3"))):
        assert not any(sizes[name][x] for x in gone), (name, sizes[name])
    # of a relation that is extended, only what is extended
    assert 0 < sizes["r3"]["r2"] < sizes["c2"]["r2"]
