import math

import numpy as np

from sparkmarts.llm.common import table
from sparkmarts.llm.flat_graph import Graph, assign, audit, build, centroids, near_duplicates, robust_prune, unit
from sparkmarts.llm.queries import op11_near_vectors

SMOKE = "/root/testdata/sf0.001"


def plain(rows, cosine=0.9):
    """{row number: (id, n_links, component_id, kept)} by comparing all pairs."""
    ok = [v is not None and len(v) > 0 and any(v) and all(x is not None and math.isfinite(x) for x in v) for _, v in rows]
    near = {i: set() for i in range(len(rows))}
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows):
            if i != j and ok[i] and ok[j] and len(a) == len(b):
                x, y = unit(np.array([a, b], float))
                if float(x @ y) >= cosine:
                    near[i].add(j)
    out = []
    for i, (own, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        name = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((own, len(near[i]), name, own is not None and own == name))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], "vec_id long, embedding array<double>, n_links int, shard string")
    return sorted((tuple(r) for r in near_duplicates(df, **options).collect()), key=str)


def groups(seed, n, dim, sizes, spread):
    """n vectors far apart, then groups of near copies."""
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=dim) for _ in range(n)]
    for size in sizes:
        centre = rng.normal(size=dim)
        x += [centre + rng.normal(size=dim) * spread * np.linalg.norm(centre) / math.sqrt(dim) for _ in range(size)]
    order = rng.permutation(len(x))
    return [(int(i), [float(c) for c in x[i]]) for i in order]


def test_pruning_keeps_what_no_kept_neighbour_covers():
    rng = np.random.default_rng(1)
    x = unit(rng.normal(size=(60, 4))).astype(np.float32)
    near = np.argsort(-(x @ x.T - 3 * np.eye(60)), axis=1, kind="stable")[:, :25]
    dist = lambda a, b: math.sqrt(max(0, 2 - 2 * float(x[a] @ x[b])))
    got = robust_prune(x, near, 1.2, 6)
    for i in range(60):
        left, want = list(near[i]), []
        while left and len(want) < 6:
            want.append(left.pop(0))
            left = [c for c in left if 1.2 * dist(want[-1], c) > dist(i, c)]
        assert [c for c in got[i] if c >= 0] == want


def test_search_finds_the_range_of_every_vector():
    x = unit(np.array([v for _, v in groups(3, 600, 16, [40, 200, 3, 2], 0.2)]))
    links, medoid = build(x, 20, 48, 1.2)
    assert links.shape == (len(x), 40)
    graph = Graph(x, links, medoid)
    found = [p for q, v in graph.search(x, [np.full(len(x), -1)], 0.9, 16) for p in zip(q.tolist(), v.tolist(), strict=True)]
    assert len(found) == len(set(found))  # each pair once
    s = x @ x.T
    # from the medoid alone, never told where a vector is
    want = {(i, j) for i, j in zip(*np.nonzero(s >= 0.9), strict=True)}
    assert len(want & set(found)) >= 0.95 * len(want)


def test_splits():
    rng = np.random.default_rng(5)
    x = unit(rng.normal(size=(500, 8)))
    c = centroids(x, 7)
    first, second = assign(x, np.arange(500), c, 7)
    apart = ((x[:, None, :] - c[None]) ** 2).sum(2)
    order = np.argsort(apart, axis=1)
    assert (first == order[:, 0]).all() and (second == order[:, 1]).all()
    same = np.repeat(x[:1], 50, axis=0)
    assert len(centroids(same, 4)) == 0
    first, second = assign(same, np.arange(50), centroids(same, 4), 4)
    assert set(first) == set(range(4)) and (first != second).all()


def test_many_shards_and_rounds(spark):
    rows = groups(7, 250, 12, [120, 30, 2, 2], 0.15)
    for options in ({"shard_rows": 40, "fan": 4}, {"shard_rows": 100, "sample_rows": 60}):
        assert run(spark, rows, **options) == plain(rows)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1e300]), (4, [0.0, 1e-300]), (None, [0.0, 5.0]), (5, None), (6, []),
            (7, [0.0, 0.0]), (8, [1.0, None]), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [1.0]), (12, [-1.0]), (13, [3.0]), (None, None), (0, [9.0, 0.1]),
            (14, [-0.0, -1.0]), (15, [0.0, -1.0])]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, cosine=1.0 - 1e-12) == plain(rows, 1.0 - 1e-12)


def test_copies_beyond_a_shard(spark):
    """Rows of one direction, which no centroid tells apart, and equal rows."""
    rows = [(i, [1.0 + i, 0.0, 0.0]) for i in range(60)] + [(100 + i, [0.0, 1.0, 0.0]) for i in range(200)] + [(1000, [0.0, 0.0, 1.0])]
    got = run(spark, rows, shard_rows=16)
    assert got == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(3, None)]) == [(3, 0, 3, True)]


def test_audit_counts_missed_links(spark):
    rows = [(i, 1, [1.0, 0.001 * i], i) for i in range(10)]
    nodes = spark.createDataFrame(rows, "node long, mult long, v array<double>, low long")
    counts = spark.createDataFrame([(i, 9 if i < 5 else 0) for i in range(9)], "q long, n long")
    assert audit(nodes, counts, 0.9) == 0.5
    assert audit(nodes.where("node < 1"), counts, 0.9) == 1.0


def test_query_on_given_table(spark):
    df = table(spark, SMOKE, "embeddings")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    assert sorted((tuple(r) for r in op11_near_vectors(spark, SMOKE).collect()), key=str) == plain(rows)
