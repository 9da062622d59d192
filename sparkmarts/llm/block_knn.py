"""Nearest neighbours by inner product as a block matrix join.

Queries and candidates are dealt to groups; every pair of groups is one tile,
handled by one task with bounded memory. In a tile, vectors are quantised to
int8 and multiplied as matrices; the quantisation error bounds how far each
product can be from the true one. Only pairs that may still belong to a
query's best are computed again in double precision and kept in heaps; the
tiles' heaps are merged per query. The result is exact."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmarts.llm.common import materialise

K = 20
#: bounds of a tile: rows, and bytes of the vectors of one side
QUERY_ROWS, TILE_ROWS, TILE_BYTES = 4096, 65_536, 64 << 20
#: candidates multiplied at once inside a tile
BLOCK = 512


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scale of each row, L1 norm of each row's error-free part)."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.abs(x).sum(axis=1)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed in component order."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def tile_best(q_ids, q, c_ids, c, k: int) -> list[list[tuple[float, int]]]:
    """For each query a heap of its k best (score, -candidate id) in the tile."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(len(q))]
    qq, qs, ql1 = quantise(q)
    qf = qq.astype(np.float32)
    floor = np.full(len(q), -np.inf)  # worst of a full heap
    for at in range(0, len(c), BLOCK):
        part, ids = c[at : at + BLOCK], c_ids[at : at + BLOCK]
        cq, cs, cl1 = quantise(part)
        # int8 products summed in float32 are exact below 2^24; beyond 1,040 components sum in double
        wide = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
        near = (qf.astype(wide) @ cq.astype(wide).T).astype(np.float64) * qs[:, None] * cs[None, :]
        # |x.y - x'.y'| <= |x|1 * err(y) + |y'|1 * err(x), with err = half a step
        bound = ql1[:, None] * (cs / 2)[None, :] + (qs / 2)[:, None] * (cl1 + len(part[0]) * cs / 2)[None, :]
        bound = bound * (1 + 1e-9) + 1e-300
        own = q_ids[:, None] == ids[None, :]
        low = np.where(own, -np.inf, near - bound)
        least = floor
        if len(ids) > k:
            least = np.maximum(floor, np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k])
        row, col = np.nonzero(((near + bound) >= least[:, None]) & ~own)
        score = exact(q[row], part[col])
        for r, s, i in zip(row.tolist(), score.tolist(), ids[col].tolist(), strict=True):
            heap = heaps[r]
            if len(heap) < k:
                heapq.heappush(heap, (s, -i))
            elif (s, -i) > heap[0]:
                heapq.heapreplace(heap, (s, -i))
        floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    return heaps


def usable(vec: Column) -> Column:
    """Not null, and finite in every component, and not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vec.isNotNull() & ~F.exists(vec, bad) & F.exists(vec, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    query_rows: int = QUERY_ROWS,
    tile_rows: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of every query,
    ties to the smaller id. Rows with a null id, or whose vector is null, empty, zero
    or holds null or non-finite components take no part. Of rows that repeat an id the one with the
    smallest vector counts. Vectors of unlike length have no product. How the
    rows are cut into tiles changes no result."""
    rows = (
        vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), is_query.alias("q"))
        .where(F.col("id").isNotNull() & usable(F.col("v")))
        .groupBy("id")
        .agg(F.min(F.struct("v", "q")).alias("r"))
        .select("id", "r.v", F.coalesce("r.q", F.lit(False)).alias("q"))
    )
    rows = materialise(rows, "vectors")
    n, asked, width = rows.agg(F.count("*"), F.count_if("q"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    fit = max(256, TILE_BYTES // (8 * width))
    query_rows = min(query_rows, fit)
    if tile_rows is None:
        # large tiles send each row to fewer places; enough of them for all cores
        busy = math.ceil(n / (4 * vectors.sparkSession.sparkContext.defaultParallelism))
        tile_rows = min(TILE_ROWS, fit, max(1024, busy))
    q_groups, c_groups = max(1, math.ceil(asked / query_rows)), max(1, math.ceil(n / tile_rows))
    # both sides' keys need one type: a cogroup deals an int and a bigint to different tasks
    place = lambda groups, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(groups)).cast("int")
    every = lambda groups: F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    size = F.size("v").alias("size")
    left = rows.where("q").select("id", "v", size, place(q_groups, 1).alias("qg"), every(c_groups).alias("cg"))
    right = rows.select(
        F.col("id").alias("c_id"), F.col("v").alias("c_v"), size, place(c_groups, 2).alias("cg"), every(q_groups).alias("qg")
    )

    def matrix(t: pa.Table, name: str) -> np.ndarray:
        flat = t.column(name).combine_chunks().flatten()
        return flat.to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)

    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return kind.empty_table()
        q_ids, c_ids = a.column("id").to_numpy(), b.column("c_id").to_numpy()
        heaps = tile_best(q_ids, matrix(a, "v"), c_ids, matrix(b, "c_v"), k)
        found = [(int(q), -i, s) for q, heap in zip(q_ids, heaps, strict=True) for s, i in heap]
        return pa.table(list(zip(*found, strict=True)) if found else [[], [], []], schema=kind)

    keys = ["qg", "cg", "size"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, "query_id long, vec_id long, score double")
    # two merges, so that no query's heaps of all tiles meet in one task
    level = F.pmod(F.xxhash64("vec_id"), F.lit(math.ceil(math.sqrt(c_groups))))
    out = "query_id long, rank int, vec_id long, score double"

    def merge(t: pa.Table) -> pa.Table:
        pairs = zip(t.column("score").to_pylist(), t.column("vec_id").to_pylist(), strict=True)
        top = heapq.nsmallest(k, ((-s, i) for s, i in pairs))
        q = t.column("query_id")[0].as_py()
        return pa.table(
            {
                "query_id": pa.array([q] * len(top), pa.int64()), "rank": pa.array(range(1, len(top) + 1), pa.int32()),
                "vec_id": pa.array([i for _, i in top], pa.int64()), "score": pa.array([-s for s, _ in top], pa.float64()),
            }
        )

    first = best.withColumn("level", level).groupBy("query_id", "level").applyInArrow(merge, out)
    return first.groupBy("query_id").applyInArrow(merge, out)
