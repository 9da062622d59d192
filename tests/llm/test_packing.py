from itertools import combinations

import pytest
from helpers_llm import SMOKE, odd_docs, tokens
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmarts.llm.common import table
from sparkmarts.llm.packing import optimal_buckets, pack


def waste(hist, bounds):
    return sum(n * (min(b for b in bounds if b >= k) - k) for k, n in hist.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 12), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 4))
def test_buckets_are_optimal(hist, k):
    got = optimal_buckets(hist, k)
    lengths = sorted(hist)
    assert len(got) <= k and got[-1] == lengths[-1]
    best = min(waste(hist, [*c, lengths[-1]]) for n in range(min(k, len(lengths))) for c in combinations(lengths[:-1], n))
    assert waste(hist, got) == best


def check(rows, max_tokens, budget, short_batches):
    batches = {}
    for r in rows:
        assert r.n_tokens <= r.bucket_tokens and r.padding == r.bucket_tokens - r.n_tokens
        batches.setdefault(r.batch_id, []).append(r)
    short = 0
    for b in batches.values():
        size = {r.bucket_tokens for r in b}
        assert len(size) == 1
        slots = max(1, budget // max(1, size.pop()))
        assert sorted(r.slot for r in b) == list(range(len(b))) and len(b) <= slots
        short += len(b) < slots
    assert short <= short_batches


def test_pack_covers_every_token(spark):
    docs = table(spark, SMOKE, "documents")
    rows = pack(docs, max_tokens=100, buckets=5, budget=1000, with_text=True).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert set(by) == set(texts)
    for i, own in by.items():
        own.sort(key=lambda r: r.segment)
        assert "".join(r.text for r in own) == texts[i]
        assert [texts[i][r.start : r.end] for r in own] == [r.text for r in own]
        assert [len(tokens(r.text)) for r in own] == [r.n_tokens for r in own]
        assert all(r.n_tokens == 100 for r in own[:-1])
    check(rows, 100, 1000, short_batches=5)


def test_pack_streams_of_a_hot_bucket(spark):
    docs = spark.range(500).selectExpr("id doc_id", "repeat('w ', 7) text")
    rows = pack(docs, buckets=3, budget=70, stream_batches=10).collect()
    assert len(rows) == 500 and {r.bucket_tokens for r in rows} == {7}
    check(rows, 2048, 70, short_batches=5)


def test_pack_odd_rows(spark):
    docs = odd_docs(spark)
    rows = pack(docs, max_tokens=1000).collect()
    assert len({(r.doc_id, r.segment) for r in rows}) >= 11 and sum(r.segment == 0 for r in rows) == docs.count()
    assert sum(r.n_tokens for r in rows if r.doc_id == 5) == 30_000
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert pack(docs.limit(0)).count() == 0


@pytest.mark.parametrize("hist", [{}, {0: 5}, {7: 1}])
def test_small_histograms(hist):
    assert optimal_buckets(hist, 4) == sorted(hist)
