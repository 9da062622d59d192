import math

import numpy as np
from pyspark.sql import functions as F

from sparkmarts.llm.block_knn import exact, nearest, quantise, tile_best
from sparkmarts.llm.common import table
from sparkmarts.llm.queries import op6_nearest

SMOKE = "/root/testdata/sf0.001"


def product(a, b):
    s = 0.0
    for x, y in zip(a, b, strict=True):
        s += x * y
    return s


def brute(rows, queries, k):
    return {
        q: sorted(((-product(rows[q], v), i) for i, v in rows.items() if i != q and len(v) == len(rows[q])))[:k] for q in queries
    }


def test_tile_is_exact_with_ties_and_scales():
    rng = np.random.default_rng(2)
    for scale in (1.0, 1e-9, 1e12):
        c = np.round(rng.normal(size=(700, 5)) * 3) * scale
        c *= 10.0 ** rng.integers(-3, 4, size=(700, 1))
        q = c[:40]
        ids = rng.permutation(5000)[:700]
        heaps = tile_best(ids[:40], q, ids, c, 7)
        for j, heap in enumerate(heaps):
            s = exact(np.repeat(q[j : j + 1], 700, axis=0), c)
            want = sorted((-x, i) for x, i in zip(s.tolist(), ids.tolist(), strict=True) if i != ids[j])[:7]
            assert sorted((-x, -i) for x, i in heap) == want


def test_quantisation_bound():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 16)) * 10.0 ** rng.integers(-5, 5, size=(50, 1))
    q, scale, _ = quantise(x)
    assert np.all(np.abs(x - q * scale[:, None]) <= scale[:, None] / 2 * (1 + 1e-9))


def test_query_on_given_table(spark):
    rows = {r.vec_id: [float(x) for x in r.embedding] for r in table(spark, SMOKE, "embeddings").collect()}
    want = brute(rows, [i for i in rows if i % 20 == 0], 20)
    got = {}
    for r in sorted(op6_nearest(spark, SMOKE).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert got == want


def test_many_tiles(spark):
    rng = np.random.default_rng(8)
    rows = {i: [float(x) for x in rng.integers(-3, 4, size=3)] for i in range(300)}
    rows = {i: v for i, v in rows.items() if any(v)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, F.col("vec_id") % 7 == 0, k=5, query_rows=10, tile_rows=30).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert got == brute(rows, [i for i in rows if i % 7 == 0], 5)


def test_many_tasks(spark):
    """Tiles dealt to many tasks that are not merged again."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "37"}
    old = {k: spark.conf.get(k) for k in conf}
    rng = np.random.default_rng(9)
    rows = {i: [float(x) for x in rng.normal(size=4)] for i in range(400)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = {}
        for r in nearest(df, F.col("vec_id") % 5 == 0, k=5, query_rows=20, tile_rows=60).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == brute(rows, [i for i in rows if i % 5 == 0], 5)


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [2.0, 5.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, []), (9, [1.0]), (10, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, score string, rank int")
    got = [tuple(r) for r in nearest(df, F.lit(True)).orderBy("query_id", "rank").collect()]
    assert got[:3] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 10, -1.0)]
    assert {r[0] for r in got} == {0, 1, 2, 10}
    assert nearest(df.limit(0), F.lit(True)).count() == 0
    assert nearest(df, F.lit(False)).count() == 0
