"""Length-bucketed packing.

Texts are cut into sequences of at most ``max_tokens`` words. One global
histogram of sequence lengths (at most ``max_tokens`` entries) feeds a dynamic
program that picks the bucket lengths with the least padding; inside each
bucket, batches hold as many sequences as fit the token budget when padded to
the bucket's length."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmarts.llm.common import map_slices, materialise, texts_of

MAX_TOKENS = 2048
BUCKETS = 16
BUDGET = 65_536
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def optimal_buckets(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds, at most ``buckets`` of them, that minimise the sum of
    (bound - length) over all sequences. Ties take the smaller bounds."""
    lengths = np.array(sorted(k for k, v in histogram.items() if v > 0), dtype=np.int64)
    if not len(lengths):
        return []
    count = np.array([histogram[int(k)] for k in lengths], dtype=np.int64)
    n = np.concatenate([[0], np.cumsum(count)])
    m = len(lengths)
    k_max = min(buckets, m)
    # best[j]: least padded tokens of the first j lengths with the buckets so far
    best = np.full(m + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    cuts = []
    for _ in range(k_max):
        new, cut = np.empty(m + 1, np.int64), np.zeros(m + 1, np.int64)
        new[0] = 0
        for j in range(1, m + 1):
            cost = best[:j] + lengths[j - 1] * (n[j] - n[:j])
            cut[j] = int(np.argmin(cost))
            new[j] = cost[cut[j]]
        best = new
        cuts.append(cut)
    out, j = [], m
    for cut in reversed(cuts):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(cut[j])
    return sorted(set(out))


def sequences(docs: DataFrame, id_col: str, text_col: str, max_tokens: int, with_text: bool) -> DataFrame:
    """One row per sequence: id, segment (from 0), n_tokens, start and end in
    code points, and its text if asked for. A text without words is one
    sequence of no tokens."""

    def run(part: pa.RecordBatch) -> dict:
        rows = []
        for data in texts_of(part, "__text"):
            n = len(data.split())
            chars = len(data) if data.isascii() else len(data.decode("utf-8", "surrogateescape"))
            if n <= max_tokens:
                rows.append([{"segment": 0, "n_tokens": n, "start": 0, "end": chars}])
                continue
            firsts = [m.start() for i, m in enumerate(_WORD.finditer(data)) if i % max_tokens == 0]
            cuts, seen, at = [0], 0, 0
            for p in firsts[1:]:
                at += len(data[seen:p].decode("utf-8", "surrogateescape"))
                seen = p
                cuts.append(at)
            cuts.append(chars)
            rows.append(
                [
                    {"segment": i, "n_tokens": min(max_tokens, n - i * max_tokens), "start": cuts[i], "end": cuts[i + 1]}
                    for i in range(len(firsts))
                ]
            )
        return {"__s": rows}

    keep = [id_col, text_col] if with_text else [id_col]
    cut = map_slices(docs, text_col, run, "__s array<struct<segment:bigint,n_tokens:bigint,start:bigint,end:bigint>>", keep)
    out = cut.select("*", F.explode("__s").alias("__q")).select(*(F.col(f"`{c}`") for c in keep), "__q.*")
    if with_text:
        piece = F.substring(F.col(f"`{text_col}`"), F.col("start") + 1, F.col("end") - F.col("start"))
        out = out.withColumn(text_col, F.coalesce(piece, F.lit("")))
    return out


def _bucket(bounds: list[int], n: Column) -> Column:
    """Smallest bound that holds n tokens."""
    return F.element_at(F.filter(F.array(*map(F.lit, bounds)), lambda b: b >= n), 1) if bounds else n


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    stream_batches: int = 64,
    with_text: bool = False,
) -> DataFrame:
    """(id, segment, n_tokens, start, end, bucket_tokens, batch_id, slot, padding)
    of every sequence, ``text`` too if asked for.

    A bucket of more than ``stream_batches`` batches is dealt to several streams
    of about that many by a hash of the sequence, so that a task numbers a
    bounded number of tokens however hot a bucket is; only the last batch of a
    stream may be short. In a stream, sequences are ordered
    by (id, segment, start, end); rows equal in all of these are interchangeable.
    A batch has max(1, budget // bucket_tokens) slots (bucket 0 counts as 1).
    Null and empty texts are sequences of no tokens; null ids are kept."""
    rows = materialise(sequences(docs, id_col, text_col, max_tokens, with_text), "sequences")
    counts = {int(r[0]): int(r[1]) for r in rows.groupBy("n_tokens").count().collect()}  # at most max_tokens + 1 rows
    bounds = optimal_buckets(counts, buckets)
    held = {b: sum(v for k, v in counts.items() if k <= b and (i == 0 or k > bounds[i - 1])) for i, b in enumerate(bounds)}
    per_stream = {b: stream_batches * max(1, budget // max(1, b)) for b in bounds}
    streams = F.create_map(*(F.lit(x) for b in bounds for x in (b, -(-held[b] // per_stream[b])))) if bounds else None
    rows = rows.withColumn("bucket_tokens", _bucket(bounds, F.col("n_tokens")).cast("bigint"))
    n = streams[F.col("bucket_tokens")].cast("bigint") if bounds else F.lit(1).cast("bigint")
    rows = rows.withColumn("__stream", F.pmod(F.xxhash64(id_col, "segment", "n_tokens", "start", "end"), n))
    order = Window.partitionBy("bucket_tokens", "__stream").orderBy(id_col, "segment", "start", "end")
    slots = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("bucket_tokens")))).cast("bigint")
    rank = F.row_number().over(order) - 1
    out = rows.withColumn("__rank", rank).withColumn("__slots", slots)
    batch = F.concat_ws("-", "bucket_tokens", "__stream", F.floor(F.col("__rank") / F.col("__slots")))
    text = [F.col(f"`{text_col}`")] if with_text else []
    return out.select(
        id_col, "segment", "n_tokens", "start", "end", *text, "bucket_tokens", batch.alias("batch_id"),
        F.pmod("__rank", "__slots").alias("slot"), (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"),
    )
