import random

import numpy as np
import xxhash
from helpers_llm import SMOKE, odd_docs, tokens
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmarts.llm.common import table
from sparkmarts.llm.queries import op7_simhash
from sparkmarts.llm.simhash_bktree import Forest, close_links, components, keep_one, simhash_groups


def fingerprint(text, n=4):
    w = tokens(text)
    grams = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups(values, radius=4):
    """Smallest member of each value's component, by all pairs."""
    label = {v: v for v in values}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    vs = sorted(set(values))
    for i, a in enumerate(vs):
        for b in vs[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {v: find(v) for v in vs}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def clustered(rng, centres, n):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(n):
            v = c
            for b in rng.sample(range(64), rng.randrange(6)):
                v ^= 1 << b
            out.add(v)
    return sorted(out)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2**10 - 1)), min_size=1, max_size=60, unique=True), st.integers(0, 5))
def test_bk_tree_finds_all_in_its_shard(items, radius):
    items.sort()
    shard = np.array([s for s, _ in items])
    shard = np.cumsum(np.r_[True, shard[1:] != shard[:-1]]) - 1
    values = np.array([v for _, v in items], np.uint64)
    found = {(int(a), int(b)) for q, n in Forest(values, shard).search(values, shard, radius, step=7) for a, b in zip(q, n)}
    want = {
        (i, j)
        for i in range(len(items))
        for j in range(len(items))
        if shard[i] == shard[j] and (int(values[i]) ^ int(values[j])).bit_count() <= radius
    }
    assert found == want


def test_links_connect_what_all_pairs_connect(spark):
    rng = random.Random(1)
    values = clustered(rng, 30, 12) + [rng.getrandbits(64) for _ in range(300)]
    want = groups(values)
    df = spark.createDataFrame([(signed(v),) for v in set(values)], "fp long")
    for rows in (8192, 5):  # with 5 rows a piece, hot shards are cut
        roots = {r.node: r.root for r in components(close_links(df, shard_rows=rows)).collect()}
        got = {}
        for v in want:
            got.setdefault(roots.get(signed(v), signed(v)), set()).add(v)
        expect = {}
        for v, g in want.items():
            expect.setdefault(g, set()).add(v)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, expect.values()))


def test_components_of_long_chains(spark):
    chain = spark.range(300).selectExpr("id a", "id + 1 b").union(spark.range(1000, 1020).selectExpr("1000L a", "id b"))
    got = {r.node: r.root for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{i: 1000 for i in range(1001, 1020)}}
    assert components(chain.limit(0)).count() == 0


def test_query_on_given_tables(spark):
    texts = {r.doc_id: r.text for r in table(spark, SMOKE, "documents").collect()}
    fps = {i: fingerprint(t) for i, t in texts.items()}
    group = groups(fps.values())
    low = {}
    for i in sorted(fps):
        low.setdefault(group[fps[i]], i)
    want = {(i, f"{v:016x}", low[group[v]]) for i, v in fps.items()}
    assert {tuple(r) for r in op7_simhash(spark, SMOKE).collect()} == want


def test_shingle_hash_is_sparks(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("the quick é fox")).alias("h")).first()
    assert row.h & (2**64 - 1) == xxhash.xxh64_intdigest("the quick é fox".encode(), 42)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = simhash_groups(docs).collect()
    assert len(got) == docs.count()
    assert {r.component_id for r in got if r.fp == 0} == {0}
    assert {r.component_id for r in got if r.doc_id in (7, 8)} == {7}
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) == len({r.component_id for r in got}) and 0 in ids and 8 not in ids
    assert keep_one(docs.limit(0)).count() == 0
    nulls = docs.selectExpr("cast(null as long) doc_id", "text").where("text = 'same text here'")
    assert keep_one(nulls).count() == 1 and simhash_groups(nulls).first().component_id is None


def test_columns_with_the_names_used_inside(spark):
    names = "doc_id long, text string, __h long, ___h long, fp long, root long, __kid long, __kh long, component_id long"
    rows = [(i, "one two three four five" if i % 2 else f"text {i} of its own words", 10 + i, 2, 3, 4, 5, 6, 7) for i in range(6)]
    docs = spark.createDataFrame(rows, names)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [r for r in rows if r[0] in (0, 1, 2, 4)]
