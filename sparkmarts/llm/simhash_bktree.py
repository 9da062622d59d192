"""SimHash near-duplicates found with BK-trees.

1. Every text gets a 64-bit fingerprint (majority of its shingles' hashes);
   equal fingerprints become one row before anything else.
2. The bits are cut into blocks. Fingerprints within the radius agree on all
   but ``radius`` of the blocks, so each fingerprint is sent once for every
   choice of ``blocks - radius`` blocks: two close ones meet in a shard.
3. Each shard holds a BK-tree (children keyed by their integer Hamming distance
   to the parent); its fingerprints are looked up in it, following only edges
   within the radius. A shard over ``shard_rows`` is cut into pieces; each pair
   of pieces is one task's tree and queries, so no task holds a whole hot shard.
   The trees stay with the shards: they grow with the corpus, so none of them
   passes through the driver.
4. A shard reports a spanning forest of its links, never all pairs; alternating
   large-star and small-star steps join the forests into components.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.llm.common import fresh, map_slices, materialise, texts_of

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
SHARD_ROWS = 8192
SEED = 42


# --- fingerprints -----------------------------------------------------------


def shingle_hashes(text: bytes, shingle: int, seed: int = SEED) -> list[int]:
    """XXH64 of every run of ``shingle`` words (all words if there are fewer)."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: n - 1]]
    h = xxhash.xxh64_intdigest
    return [h(joined[a : b - 1], seed) for a, b in zip(starts, ends[shingle - 1 :], strict=True)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes; zero for an empty group."""
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    starts = (np.cumsum(counts) - counts)[full]
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    set_bits = 2 * ones > counts[full][:, None]
    out[full] = np.packbits(set_bits, axis=1).reshape(-1, 8).copy().view(">u8").ravel().astype(np.uint64)
    return out


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, extra: list[str] | None = None
) -> DataFrame:
    """(id, columns ``extra``, fp bigint) of every row; a null or empty text has fingerprint 0."""

    def run(part: pa.RecordBatch) -> dict:
        hashes = [shingle_hashes(t, shingle) for t in texts_of(part, "__text")]
        counts = np.array([len(x) for x in hashes], dtype=np.int64)
        flat = np.fromiter(itertools.chain.from_iterable(hashes), dtype=np.uint64, count=int(counts.sum()))
        return {"fp": pa.array(majority(flat, counts).view(np.int64))}

    # 64 bytes a shingle while bits are counted: small slices
    return map_slices(docs, text_col, run, "fp long", keep=[id_col, *(extra or [])], slice_bytes=1 << 20)


# --- BK-trees ---------------------------------------------------------------


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class Forest:
    """One BK-tree per shard, built level by level for all shards at once."""

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        """values: uint64, distinct in a shard; shard: 0..n-1, ascending."""
        self.values = values
        n = len(values)
        first = np.r_[True, shard[1:] != shard[:-1]] if n else np.zeros(0, bool)
        self.roots = np.flatnonzero(first)
        at = self.roots[np.cumsum(first) - 1] if n else np.zeros(0, np.int64)
        waiting = np.flatnonzero(~first)
        keys, kids = [], []
        while len(waiting):
            key = at[waiting] * 65 + _bits(values[waiting] ^ values[at[waiting]])
            # the first item with a key becomes the child; the others go below it
            uniq, place, inverse = np.unique(key, return_index=True, return_inverse=True)
            child = waiting[place]
            keys.append(uniq)
            kids.append(child)
            at[waiting] = child[inverse]
            rest = np.ones(len(waiting), bool)
            rest[place] = False
            waiting = waiting[rest]
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(key)
        self.keys = key[order]  # parent * 65 + distance to the parent
        self.kids = (np.concatenate(kids) if kids else np.zeros(0, np.int64))[order]

    def search(self, queries: np.ndarray, shard: np.ndarray, radius: int, step: int = 1 << 18):
        """Yields (query, node) index arrays of all pairs within the radius in
        the query's shard. Works on bounded pieces of the search front."""
        todo = [(np.arange(len(queries)), self.roots[shard])]
        while todo:
            q, node = todo.pop()
            if len(q) > step:
                todo += [(q[:step], node[:step]), (q[step:], node[step:])]
                continue
            d = _bits(queries[q] ^ self.values[node])
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), side="right")
            n = hi - lo
            if n.any():
                kid = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                todo.append((np.repeat(q, n), self.kids[kid]))


def _spanning(n: int, pairs, parent: np.ndarray | None = None) -> np.ndarray:
    """Smallest index of each item's group, over an iterator of pair arrays:
    labels sink to the smaller end of every link until nothing changes."""
    label = np.arange(n) if parent is None else parent
    for a, b in pairs:
        a, b = a[a != b], b[a != b]
        while len(a):
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def shard_links(values: np.ndarray, shard: np.ndarray, own: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (value, group's first value) of the links in each shard.
    Rows that are not ``own`` are in the tree but are not looked up."""
    order = np.lexsort((values, shard))
    values, shard, own = values[order], shard[order], own[order]
    keep = np.r_[True, (shard[1:] != shard[:-1]) | (values[1:] != values[:-1])]
    values, shard, own = values[keep], shard[keep], own[keep]
    shard = np.cumsum(np.r_[True, shard[1:] != shard[:-1]]) - 1
    size = np.bincount(shard)
    few = size[shard] > 1
    values, own = values[few], own[few]
    shard = shard[few]
    if not len(values):
        return values, values
    shard = np.cumsum(np.r_[True, shard[1:] != shard[:-1]]) - 1
    tree = Forest(values, shard)
    ask = np.flatnonzero(own)
    found = ((ask[q], node) for q, node in tree.search(values[ask], shard[ask], radius))
    label = _spanning(len(values), found)
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def close_links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) lying
    within ``radius`` bits: connected fingerprints stay connected."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("need 0 <= radius < blocks <= 64")
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in itertools.combinations(range(blocks), blocks - radius):
        m = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        masks.append(m - (1 << 64) if m >> 63 else m)
    table = F.explode(
        F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)))
    )
    rows = fps.select("fp", table.alias("s")).select("fp", "s.choice", "s.key")
    # shards of more than shard_rows are cut into pieces by a hash
    size = rows.groupBy("choice", "key").count().where(F.col("count") > 1)
    pieces = size.select("choice", "key", F.ceil(F.col("count") / shard_rows).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("pieces")).cast("int")
    rows = rows.join(pieces, ["choice", "key"]).withColumn("piece", piece)
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    rows = rows.withColumn("other", other).select(
        "fp",
        # the pair of pieces; its own queries are those of the smaller piece
        F.xxhash64("choice", "key", F.least("piece", "other"), F.greatest("piece", "other")).alias("shard"),
        (F.col("piece") <= F.col("other")).alias("own"),
    )

    def run(batches):
        # rows come sorted by shard: handle whole shards, in bounded batches
        held: list[pa.RecordBatch] = []
        n = 0

        def links(parts, last):
            t = pa.Table.from_batches(parts)
            s = t.column("shard").to_numpy()
            # without the last shard, which may go on in the next batch
            end = len(s) if last else int(np.flatnonzero(s == s[-1])[0])
            a, b = shard_links(
                t.column("fp").to_numpy()[:end].view(np.uint64),
                s[:end],
                t.column("own").to_numpy(zero_copy_only=False)[:end],
                radius,
            ) if end else (np.zeros(0, np.uint64),) * 2
            out = pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
            return out, [] if last else t.slice(end).to_batches()

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= 1 << 18:
                out, held = links(held, False)
                n = sum(x.num_rows for x in held)
                yield out
        if held and n:
            yield links(held, True)[0]

    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "a long, b long")


# --- components -------------------------------------------------------------


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest
    node that it reaches. Alternates large-star and small-star steps; each
    round is written to the shared work folder."""
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")

    def large(e: DataFrame) -> DataFrame:
        s = e.select(both).select("e.a", "e.b")
        low = s.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return s.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")

    def small(e: DataFrame) -> DataFrame:
        s = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = s.groupBy("a").agg(F.min("b").alias("m"))
        hung = s.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return hung.unionByName(low.select("a", F.col("m").alias("b"))).distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = materialise(links.where("a <> b").distinct(), "links")
    seen = state(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        e = materialise(small(large(e)), "stars", instead_of=e)
        now = state(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def fp_components(
    fps: DataFrame, id_col: str, radius: int = RADIUS, blocks: int = BLOCKS, shard_rows: int = SHARD_ROWS, salts: int = 32
) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint: its component's
    smallest fingerprint and the smallest id among all rows of the component."""
    nodes = fps.groupBy("fp").agg(F.min(id_col).alias("low"))
    roots = components(close_links(nodes.select("fp"), radius, blocks, shard_rows))
    placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    # a component may hold a large share of all fingerprints: its name goes to
    # ``salts`` places; a fingerprint without links keeps its own
    named = placed.groupBy("root").agg(F.min("low").alias("name"), F.count("*").alias("n")).where("n > 1")
    named = named.select("root", "name", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = placed.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(salts)).cast("int"))
    return salted.join(named, ["root", "salt"], "left").select(
        "fp", "root", F.coalesce("name", "low").alias("component_id")
    )


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(id, fp, component_id) of every row: component_id is the smallest id
    among all rows whose fingerprints are reachable over links of ``radius``
    bits. Repeated rows stay; null ids get a component but never name one (it
    is null only where no id is known). Null and empty texts have fingerprint
    0 and are linked like any other. Other columns of ``docs`` are ignored."""
    fps = materialise(fingerprints(docs, id_col, text_col, shingle), "fps")
    of_fp = fp_components(fps, id_col, radius, blocks, shard_rows)
    return fps.join(of_fp, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component, columns unchanged: that of the smallest id
    (null ids come last; of rows equal in id and text, one stays)."""
    # the text's hash tells rows of one id apart; equal ones are interchangeable
    own = fresh("h", docs.columns)
    marked = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    shingle = options.pop("shingle", SHINGLE)
    fps = materialise(fingerprints(marked, id_col, text_col, shingle, extra=[own]), "fps")
    of_fp = materialise(fp_components(fps, id_col, **options), "components")
    first = fps.join(of_fp, "fp").groupBy("root").agg(
        F.min(F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col(own).alias("h"))).alias("k")
    )
    kid, kh = fresh("kid", marked.columns), fresh("kh", marked.columns)
    keepers = first.select(F.col("k.i").alias(kid), F.col("k.h").alias(kh))
    kept = marked.join(keepers, F.col(id_col).eqNullSafe(F.col(kid)) & (F.col(own) == F.col(kh)), "left_semi")
    return kept.dropDuplicates([id_col, own]).select(*(F.col(f"`{c}`") for c in docs.columns))
