"""Near-duplicate vectors by search on a robust-pruned flat graph.

1. Equal vectors become one node. Nodes are dealt to cluster shards: a shard that
   is too large is split by centroids fitted on a bounded sample of it, again and
   again. At every split a node also joins the shard of its second nearest
   centroid, so shards overlap; one of its shards is its home.
2. In each shard a graph is built: candidates of every node are robust-pruned, so
   that a link stays only if no kept neighbour leads there. A node's adjacency list
   is the union of its lists in all its shards.
3. Every node is searched for in its shards: greedily from the shard's medoid, then
   the range is expanded over all neighbours of what lies in it. Where a node found
   has links in other shards as well, the search goes on there, round after
   round, until no search reaches a new shard.
4. Links are verified in double precision and counted at the found node's home, so each counts
   once. Tasks report counts and spanning links, never all pairs of a group.
5. The recall is audited by brute force on a sample; a search that falls short of the target
   is repeated with a wider beam and range."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.llm.block_knn import usable
from sparkmarts.llm.common import column_of, materialise
from sparkmarts.llm.simhash_bktree import _spanning, components

COSINE = 0.9
#: nodes of a shard at most, children of a split, sampled rows a split is fitted on
SHARD_ROWS, FAN, SAMPLE_ROWS = 4096, 64, 8192
#: neighbours kept by pruning, candidates pruned, slack of the pruning rule
DEGREE, CANDIDATES, ALPHA = 20, 48, 1.2
#: beam of the greedy search, and how far below the cosine the range is expanded
BEAM, SLACK = 16, 0.05
#: searches of one task, and those advanced together
TASK_QUERIES, BATCH = 16_384, 512
AUDIT_ROWS, RECALL = 512, 0.9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; any finite size of components will do."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def matrix(col: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(rows, -1)


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))


# --- shards -----------------------------------------------------------------------


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means by cosine of unit rows; no centroids if they can't tell the rows apart."""
    rng = np.random.default_rng(len(x))
    # far-off offsets of a tight group must not drown its differences
    mean = x.mean(axis=0)
    y = x - mean
    c = y[rng.choice(len(y), min(k, len(y)), replace=False)]
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1)[None, :] - 2 * y @ c.T, axis=1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, y)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c + mean if n.max() <= 0.95 * len(x) else c[:0]


def assign(x: np.ndarray, node: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and second nearest of k children; without centroids by number."""
    if not len(c):
        return node % k, (node + 1) % k
    far = (c * c).sum(1)[None, :] - 2 * x @ c.T
    first = np.argmin(far, axis=1)
    far[np.arange(len(x)), first] = np.inf
    return first, np.argmin(far, axis=1)


_MEMBER = "shard string, node long, v array<double>, home boolean"


def shards(nodes: DataFrame, shard_rows: int, sample_rows: int, fan: int) -> DataFrame:
    """Members (shard, node, v, home) of shards of ``shard_rows`` nodes at most."""
    fields = pa.schema(
        [("shard", pa.string()), ("node", pa.int64()), ("v", pa.list_(pa.float64())), ("home", pa.bool_())]
    )

    def fit(t: pa.Table) -> pa.Table:
        c = centroids(unit(matrix(t.column("v"), t.num_rows)), t.column("k")[0].as_py())
        return pa.table([t.column("shard").slice(0, 1), pa.array([c.ravel().tolist()], pa.list_(pa.float64()))], names=["shard", "c"])

    def deal(rows: pa.Table, c: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return fields.empty_table()
        raw, node = rows.column("v").combine_chunks(), rows.column("node").to_numpy()
        x = unit(matrix(raw, len(node)))
        flat = c.column("c")[0].values.to_numpy() if c.num_rows else np.zeros(0)
        first, second = assign(x, node, flat.reshape(-1, x.shape[1]), rows.column("k")[0].as_py())
        home = rows.column("home").to_numpy(zero_copy_only=False)
        parent = rows.column("shard")[0].as_py()
        at = np.r_[np.arange(len(node)), np.flatnonzero(home)]
        child = np.r_[first, second[home]]
        is_home = np.r_[home, np.zeros(int(home.sum()), bool)]
        return pa.table(
            [pa.array([f"{parent}/{i}" for i in child.tolist()], pa.string()), pa.array(node[at]), raw.take(pa.array(at)), pa.array(is_home)],
            schema=fields,
        )

    members = materialise(nodes.select(F.size("v").cast("string").alias("shard"), "node", "v", F.lit(True).alias("home")), "members")
    for _ in range(64):
        size = members.groupBy("shard").count()
        over = materialise(size.where(F.col("count") > shard_rows), "oversize")
        if over.isEmpty():
            return members
        # children of half the size, as they overlap and differ in size
        k = F.least(F.lit(fan), F.ceil(F.col("count") * 4 / shard_rows)).cast("int")
        over = over.select("shard", "count", k.alias("k"), F.ceil(F.col("count") / 8192).cast("int").alias("pieces"))
        rows = members.join(over, "shard")
        drawn = F.pmod(F.xxhash64("node", F.lit(17)), F.col("count")) < sample_rows
        fitted = rows.where(drawn).select("shard", "v", "k").groupBy("shard").applyInArrow(fit, "shard string, c array<double>")
        fitted = materialise(fitted, "centroids")
        piece = F.pmod(F.xxhash64("node", F.lit(5)), F.col("pieces")).cast("int").alias("piece")
        left = rows.select("shard", piece, "node", "v", "home", "k").groupBy("shard", "piece")
        right = over.join(fitted, "shard", "left").select("shard", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.coalesce("c", F.array().cast("array<double>")).alias("c"))
        dealt = left.cogroup(right.groupBy("shard", "piece")).applyInArrow(deal, _MEMBER)
        small = members.join(over.select("shard"), "shard", "left_anti").select("shard", "node", "v", "home")
        members = materialise(small.unionByName(dealt), "members", instead_of=members)
    raise RuntimeError("shards did not become small enough")


# --- graph ------------------------------------------------------------------------


def robust_prune(x: np.ndarray, near: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Of each row's candidates ``near`` (closest first, -1 for none) up to ``degree`` neighbours, -1 for
    none: the closest candidate is kept, those that are ``alpha`` times closer to it than to the row go, and so on."""
    n, width = near.shape
    out = np.full((n, degree), -1, np.int64)
    for a in range(0, n, 1024):
        rows = slice(a, min(a + 1024, n))
        cand = near[rows]
        own = x[rows]
        y = x[np.maximum(cand, 0)]
        apart = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ikj->ik", own, y), 0))
        alive = cand >= 0
        each = np.arange(len(cand))
        for d in range(degree):
            pick = np.argmax(alive, axis=1)  # the closest one left
            has = alive[each, pick]
            if not has.any():
                break
            out[rows, d] = np.where(has, cand[each, pick], -1)
            to_pick = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ikj->ik", y[each, pick], y), 0))
            alive &= (alpha * to_pick > apart) | ~has[:, None]
            alive[each, pick] = False
    return out


def build(x: np.ndarray, degree: int, candidates: int, alpha: float) -> tuple[np.ndarray, int]:
    """(neighbours of every row of unit vectors, -1 for none; the medoid)."""
    n = len(x)
    x = x.astype(np.float32)
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    if n == 1:
        return np.full((1, 2 * degree), -1, np.int64), medoid
    width = min(candidates, n - 1)
    rng = np.random.default_rng(n)
    near = np.empty((n, width), np.int64)
    for a in range(0, n, 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        top = np.argpartition(-s, width - 1, axis=1)[:, :width]
        near[a : a + len(s)] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1)
    kept = robust_prune(x, near, alpha, degree)
    # links go both ways, and a few at random keep far parts within reach
    extra = np.c_[np.repeat(np.arange(n), 2), rng.integers(0, n, 2 * n)]
    src, col = np.nonzero(kept >= 0)
    pair = np.r_[np.c_[src, kept[src, col]], extra, [[medoid, i] for i in rng.integers(0, n, degree)]]
    pair = np.r_[pair, pair[:, ::-1]]
    pair = pair[pair[:, 0] != pair[:, 1]]
    code = np.unique(pair[:, 0] * n + pair[:, 1])
    src, dst = code // n, code % n
    # a node that many point to keeps its closest; no list grows with the shard
    s = np.einsum("ij,ij->i", x[src], x[dst])
    order = np.lexsort((-s, src))
    src, dst = src[order], dst[order]
    place = np.arange(len(src)) - np.searchsorted(src, src)
    fits = place < 2 * degree
    out = np.full((n, 2 * degree), -1, np.int64)
    out[src[fits], place[fits]] = dst[fits]
    return out, medoid


# --- search -----------------------------------------------------------------------


class Graph:
    """A shard's graph and the searches in it."""

    def __init__(self, x: np.ndarray, links: np.ndarray, medoid: int):
        self.x, self.single, self.links, self.medoid = x, x.astype(np.float32), links, medoid

    def _fresh(self, q: np.ndarray, node: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours of the nodes that their searches have not seen, which become seen."""
        to = self.links[node]
        q = np.repeat(q, to.shape[1])
        to = to.ravel()
        ok = to >= 0
        q, to = q[ok], to[ok]
        new = ~seen[q, to]
        code = np.unique(q[new] * len(self.x) + to[new])
        q, to = code // len(self.x), code % len(self.x)
        seen[q, to] = True
        return q, to

    def search(self, y: np.ndarray, starts: list[np.ndarray], low: float, beam: int, width: int = 4):
        """Yields (query, node) arrays of everything with a cosine of ``low`` or more that is found for the unit
        vectors y. ``starts``: for each way to start the node of every query, -1 for none; the medoid always is one."""
        for a in range(0, len(y), BATCH):
            own = y[a : a + BATCH].astype(np.float32)
            found = self._batch(own, [s[a : a + BATCH] for s in starts], low - 1e-4, beam, width)
            yield found[0] + a, found[1]

    def _batch(self, y, starts, low, beam, width):
        n, m = len(y), len(self.x)
        seen, done = np.zeros((n, m), bool), np.zeros((n, m), bool)
        each = np.arange(n)
        pairs = [np.c_[each, np.full(n, self.medoid)]] + [np.c_[each, s][s >= 0] for s in starts]
        code = np.unique(np.concatenate([p[:, 0] * m + p[:, 1] for p in pairs]))
        q, node = code // m, code % m
        seen[q, node] = True
        hold, score = np.full((n, beam), -1, np.int64), np.full((n, beam), -np.inf, np.float32)
        hits_q, hits_node = [], []

        def measure(q, node):
            s = np.empty(len(q), np.float32)
            for b in range(0, len(q), 1 << 16):
                part = slice(b, b + (1 << 16))
                s[part] = np.einsum("ij,ij->i", y[q[part]], self.single[node[part]])
            hit = s >= low
            hits_q.append(q[hit])
            hits_node.append(node[hit])
            return s

        while len(q):
            s = measure(q, node)
            # merge into the beams
            count = np.bincount(q, minlength=n)
            place = np.arange(len(q)) - (np.cumsum(count) - count)[q]
            more, more_s = np.full((n, count.max()), -1, np.int64), np.full((n, count.max()), -np.inf, np.float32)
            more[q, place], more_s[q, place] = node, s
            both, both_s = np.c_[hold, more], np.c_[score, more_s]
            top = np.argpartition(-both_s, beam - 1, axis=1)[:, :beam]
            hold, score = np.take_along_axis(both, top, 1), np.take_along_axis(both_s, top, 1)
            # the best that were not expanded yet
            open_s = np.where((hold >= 0) & ~done[each[:, None], np.maximum(hold, 0)], score, -np.inf)
            best = np.argpartition(-open_s, min(width, beam) - 1, axis=1)[:, :width]
            row, col = np.nonzero(np.take_along_axis(open_s, best, 1) > -np.inf)
            node_now = hold[row, best[row, col]]
            done[row, node_now] = True
            q, node = self._fresh(row, node_now, seen)
            if not len(q) and len(row):
                # nothing new there, but beams may hold more to expand
                q, node = self._drain(hold, score, done, seen, each)
        # expand the range until nothing new lies in it
        at = 0
        while at < len(hits_q):
            q, node = np.concatenate(hits_q[at:]), np.concatenate(hits_node[at:])
            at = len(hits_q)
            ask = ~done[q, node]
            q, node = q[ask], node[ask]
            done[q, node] = True
            for b in range(0, len(q), 1 << 15):
                new = self._fresh(q[b : b + (1 << 15)], node[b : b + (1 << 15)], seen)
                if len(new[0]):
                    measure(*new)
        return np.concatenate(hits_q), np.concatenate(hits_node)

    def _drain(self, hold, score, done, seen, each):
        while True:
            row, col = np.nonzero((hold >= 0) & ~done[each[:, None], np.maximum(hold, 0)])
            if not len(row):
                return row, col
            done[row, hold[row, col]] = True
            q, node = self._fresh(row, hold[row, col], seen)
            if len(q):
                return q, node


_FOUND = "q long, n long, a long, b long, to_shard string, entry long, v array<double>"
_FOUND_FIELDS = pa.schema(
    [(c, pa.int64()) for c in ("q", "n", "a", "b")] + [("to_shard", pa.string()), ("entry", pa.int64()), ("v", pa.list_(pa.float64()))]
)


def _searcher(cosine: float, beam: int, slack: float):
    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return _FOUND_FIELDS.empty_table()
        node = block.column("node").to_numpy()
        order = np.argsort(node)
        node, block = node[order], block.take(pa.array(order))
        x = unit(matrix(block.column("v"), len(node)))
        home = block.column("home").to_numpy(zero_copy_only=False)
        mult = block.column("mult").to_numpy()
        at = lambda ids: np.where(ids == node[np.minimum(np.searchsorted(node, ids), len(node) - 1)], np.searchsorted(node, ids), -1)
        links = matrix(block.column("links"), len(node))
        links = np.where(links >= 0, at(links.ravel()).reshape(links.shape), -1)
        medoid = int(np.flatnonzero(block.column("medoid").to_numpy(zero_copy_only=False))[0])
        q = asked.column("q").to_numpy()
        raw = asked.column("v").combine_chunks()
        y = unit(matrix(raw, len(q)))
        graph = Graph(x, links, medoid)
        starts = [at(q), at(asked.column("entry").fill_null(-1).to_numpy())]
        n = np.zeros(len(q), np.int64)
        shared = block.column("elsewhere").combine_chunks()
        shard_at, names = np.asarray(shared.offsets), shared.values.to_pylist()
        known, number = np.unique(np.array(names, object).astype(str), return_inverse=True) if names else (np.array([], str), np.zeros(0, np.int64))
        # all ids of the block's nodes and of its searches, for the spanning links
        every = np.unique(np.r_[node, q])
        of_node, of_query = np.searchsorted(every, node), np.searchsorted(every, q)
        label = np.arange(len(every))
        asks: dict[int, int] = {}
        for qi, vi in graph.search(y, starts, cosine - slack, beam):
            for b in range(0, len(qi), 1 << 16):
                i, j = qi[b : b + (1 << 16)], vi[b : b + (1 << 16)]
                exact = np.einsum("ij,ij->i", y[i], x[j])  # verified in double precision
                # where else what lies in the range has links
                size = shard_at[j + 1] - shard_at[j]
                if size.any():
                    rep = np.repeat(np.arange(len(i)), size)
                    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + shard_at[j][rep]
                    code = i[rep] * len(known) + number[place]
                    best = np.lexsort((node[j][rep], -exact[rep], code))
                    first = best[np.r_[True, np.diff(code[best]) != 0]]
                    for c, e in zip(code[first].tolist(), node[j][rep][first].tolist(), strict=True):
                        asks.setdefault(c, e)
                hit = (exact >= cosine) & (node[j] != q[i])
                i, j = i[hit], j[hit]
                np.add.at(n, i[home[j]], mult[j[home[j]]])
                label = _spanning(len(every), [(of_query[i], of_node[j])], label)
        linked = np.flatnonzero(label != np.arange(len(every)))
        counted = np.flatnonzero(n)
        rows = len(counted), len(linked), len(asks)
        total = sum(rows)

        def column(kind, part, values):
            out = [pa.nulls(r, kind) for r in rows]
            out[part] = values if isinstance(values, pa.Array) else pa.array(values, kind)
            return pa.concat_arrays(out)

        asker = np.array([c // max(1, len(known)) for c in asks], np.int64)
        who = [q[counted], None, q[asker]]
        ids = pa.concat_arrays([pa.array(who[0], pa.int64()), pa.nulls(rows[1], pa.int64()), pa.array(who[2], pa.int64())])
        columns = [
            ids, column(pa.int64(), 0, n[counted]), column(pa.int64(), 1, every[linked]), column(pa.int64(), 1, every[label[linked]]),
            column(pa.string(), 2, [str(known[c % len(known)]) for c in asks]), column(pa.int64(), 2, list(asks.values())),
            column(raw.type, 2, raw.take(pa.array(asker))),
        ]
        return pa.table([c.cast(f.type) for c, f in zip(columns, _FOUND_FIELDS, strict=True)], schema=_FOUND_FIELDS) if total else _FOUND_FIELDS.empty_table()

    return run


def flat_graph(members: DataFrame, degree: int = DEGREE, candidates: int = CANDIDATES, alpha: float = ALPHA) -> DataFrame:
    """Members (shard, node, v, home) with their neighbours in the shard (``links``, -1 for none),
    whether they are its medoid, and the node's other shards (``elsewhere``), where the rest of its list is."""

    def run(t: pa.Table) -> pa.Table:
        node = t.column("node").to_numpy()
        got, medoid = build(unit(matrix(t.column("v"), len(node))), degree, candidates, alpha)
        ids = np.where(got >= 0, node[got], -1)
        return t.append_column("links", _lists(ids)).append_column("medoid", pa.array(np.arange(len(node)) == medoid))

    made = members.groupBy("shard").applyInArrow(run, f"{_MEMBER}, links array<long>, medoid boolean")
    made = materialise(made, "graph")
    # a node is in few shards: two more for every level of splits
    places = members.groupBy("node").agg(F.collect_set("shard").alias("all")).where(F.size("all") > 1)
    named = made.join(places, "node", "left")
    return named.select(*made.columns, F.coalesce(F.array_remove("all", F.col("shard")), F.array().cast("array<string>")).alias("elsewhere"))


def search(graph: DataFrame, nodes: DataFrame, cosine: float, beam: int, slack: float, task_queries: int = TASK_QUERIES) -> tuple[DataFrame, DataFrame]:
    """(counts (q, n), links (a, b)): how many vectors each node's search found at other
    nodes, and links that connect all nodes found."""
    blocks = materialise(graph.join(nodes.select("node", "mult"), "node"), "blocks")
    # every node asks its own shards first
    own = graph.sparkSession.read.schema(blocks.schema).parquet(blocks.scratch)
    asked = own.select("shard", F.col("node").alias("q"), "v", F.lit(None).cast("bigint").alias("entry"))
    done, found = None, []
    while True:
        # a shard asked by many is searched by several tasks
        load = asked.groupBy("shard").agg(F.ceil(F.count("*") / task_queries).cast("int").alias("pieces"))
        right = asked.join(load, "shard").withColumn("piece", F.pmod(F.xxhash64("q"), F.col("pieces")).cast("int"))
        left = blocks.join(load, "shard").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        keys = ["shard", "piece"]
        got = left.drop("pieces").groupBy(*keys).cogroup(right.drop("pieces").groupBy(*keys)).applyInArrow(_searcher(cosine, beam, slack), _FOUND)
        got = materialise(got, "found")
        found.append(got)
        now = asked.select("shard", "q")
        done = now if done is None else done.unionByName(now)
        wanted = got.where("to_shard IS NOT NULL").groupBy(F.col("to_shard").alias("shard"), "q").agg(F.min(F.struct("entry", "v")).alias("e"))
        wanted = wanted.select("shard", "q", "e.v", "e.entry").join(done, ["shard", "q"], "left_anti")
        asked = materialise(wanted, "asked")
        if asked.isEmpty():
            break
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    counts = every.where("n IS NOT NULL").groupBy("q").agg(F.sum("n").alias("n"))
    return counts, every.where("a IS NOT NULL").select("a", "b")


def audit(nodes: DataFrame, counts: DataFrame, cosine: float, rows: int = AUDIT_ROWS) -> float:
    """Share of the links of ``rows`` nodes (those of the smallest hash) that the search found, by
    comparing these nodes with all others. 1 if they have none."""
    drawn = nodes.orderBy(F.xxhash64("node", F.lit(29)), "node").limit(rows).select("node", "v").toArrow()
    if not drawn.num_rows:
        return 1.0
    lens = drawn.column("v").combine_chunks().value_lengths().to_numpy()
    of_size = {}
    for size in np.unique(lens).tolist():
        part = drawn.filter(pa.array(lens == size))
        of_size[size] = part.column("node").to_numpy(), unit(matrix(part.column("v"), part.num_rows))
    shared = nodes.sparkSession.sparkContext.broadcast(of_size)

    def run(batches):
        for batch in batches:
            v = column_of(batch, "v")
            size = v.value_lengths().to_numpy()
            for s in np.unique(size).tolist():
                if s in shared.value:
                    ids, y = shared.value[s]
                    part = pa.array(size == s)
                    node = column_of(batch, "node").filter(part).to_numpy()
                    x = unit(matrix(v.filter(part), len(node)))
                    near = (y @ x.T >= cosine) & (ids[:, None] != node[None, :])
                    n = near @ column_of(batch, "mult").filter(part).to_numpy()
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64))], names=["q", "n"])

    truth = nodes.select("node", "v", "mult").mapInArrow(run, "q long, n long").groupBy("q").agg(F.sum("n").alias("true"))
    both = truth.join(counts, "q", "left")
    true, got = both.agg(F.sum("true"), F.sum(F.least("true", F.coalesce("n", F.lit(0))))).first()
    shared.unpersist()
    return got / true if true else 1.0


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    cosine: float = COSINE,
    shard_rows: int = SHARD_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    fan: int = FAN,
    beam: int = BEAM,
    slack: float = SLACK,
    recall: float = RECALL,
    audit_rows: int = AUDIT_ROWS,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row: the other vectors found with a cosine of
    ``cosine`` or more, the smallest id reachable over such links, and whether that is its own.

    Vectors that are null, empty, zero or hold null or non-finite components have no links; nor do
    vectors of unlike length. Equal rows count as vectors of their own and are linked. Rows of a null id are
    linked and counted like any other but never name a component (its id is null if all are). Other columns are ignored."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    good = usable(F.col("v"))
    nodes = rows.where(good).groupBy("v").agg(F.count("*").alias("mult"), F.min("id").alias("low"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    graph = materialise(flat_graph(shards(nodes, shard_rows, sample_rows, fan)), "flat")
    for _ in range(4):
        counts, links = search(graph, nodes, cosine, beam, slack)
        counts = materialise(counts, "counts")
        share = audit(nodes, counts, cosine, audit_rows)
        if share >= recall:
            break
        beam, slack = beam * 2, slack + 0.1
    else:
        raise RuntimeError(f"recall {share:.3f} stays below {recall}")
    roots = components(links)
    placed = nodes.join(counts, F.col("node") == F.col("q"), "left").drop("q")
    placed = placed.join(roots, "node", "left").select(
        "v", "low", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")
    )
    placed = materialise(placed, "placed")
    names = placed.groupBy("root").agg(F.min("low").alias("name"))
    salts = 32
    named = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")).join(named, ["root", "salt"])
    of_vector = placed.select(F.col("v").alias("key"), "n_links", "name")
    out = rows.where(good).join(of_vector, F.col("v") == F.col("key")).select("id", "n_links", F.col("name").alias("component_id"))
    rest = rows.where(~good).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(rest).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
