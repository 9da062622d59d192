"""A hidden Markov language model trained by Baum-Welch on Spark.

Tokens are whitespace-separated words (A-Z lowered) and one end token per text.

1. Each task packs its texts into chunks of bounded size: distinct words, their
   training counts, and the texts as positions in that list.
2. The (chunk, word) counts are summed per word over the whole corpus, in
   buckets of words, and sent back to their chunks: exact counts.
3. The model's symbols: each word counted ``least`` times or more in the
   training texts has a symbol; rarer words share ``classes`` symbols chosen by
   their ending; unknown words have one. A rare word's share of its symbol is
   its smoothed count, the same in every state. So the vocabulary with
   statistics of its own grows with the corpus.
4. Every Baum-Welch round is one pass over all training chunks. A word's
   statistics are never held as a whole: a chunk sends the expected counts of its
   own words to their buckets, where they are summed per word, and gets back the
   sums of its own words. Only the classes, transitions and starts are broadcast.
   A word's expected counts add up to its known count, so both ways they travel as
   the states' shares of it, in the finer steps the larger the count, as its errors
   weigh more: the expected counts themselves are off by 0.00005 at most for counts
   up to 100,000. The emissions are normed by the sums of what the chunks get, so
   that probabilities still add up to one.
5. The scaled forward recursion gives each text's exact probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.llm.chain import Pass, layout
from sparkmarts.llm.common import column_of, materialise, shuffles_cleared, slices

END = b""
STATES = 8
ROUNDS = 6
#: training count from which a word has statistics of its own
LEAST = 2
CLASSES = 4096
CHUNK_BYTES = 16 << 20
#: (chunk, word) pairs summed together, and buckets of words at least
BUCKET_PAIRS = 250_000
BUCKETS = 256
#: tokens handled by one batch of the recursions
BATCH_TOKENS = 700_000
_LOG10 = np.log(10.0)


def endings(words: pa.Array) -> tuple[list[tuple[bytes, int]], np.ndarray]:
    """Distinct (last three bytes, length up to four) of some words, and each word's place among them."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    cuts = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    size = np.diff(cuts)
    key = np.minimum(size, 4) << 24
    for i in (1, 2, 3):
        long = size >= i
        key[long] |= data[cuts[1:][long] - i].astype(np.int64) << 8 * (i - 1)
    found, at = np.unique(key, return_inverse=True)
    return [((k & 0xFFFFFF).to_bytes(3, "big")[max(0, 3 - (k >> 24)) :], k >> 24) for k in found.tolist()], at


def ending_classes(words: pa.Array, classes: int) -> np.ndarray:
    """Symbol classes of words without a symbol of their own: a hash of their last
    three bytes and their length up to four."""
    found, at = endings(words)
    return np.array([xxhash.xxh32_intdigest(e + bytes([n])) % classes for e, n in found], np.int32)[at]


@lru_cache(1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One for a process: a new one takes ten times as long as what a bucket holds."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(a: np.ndarray) -> bytes:
    return _zstd()[0].compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(_zstd()[1].decompress(b), kind) if b else np.zeros(0, kind)


def _pack_words(size: np.ndarray, data: np.ndarray) -> bytes:
    """Words as their lengths and their bytes, one after the other."""
    low = _pack(size.astype(np.int32))
    return len(low).to_bytes(4, "little") + low + _pack(data)


def _unpack_words(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    cut = 4 + int.from_bytes(b[:4], "little")
    return _unpack(b[4:cut], np.int32), _unpack(b[cut:], np.uint8)


def _words(size: np.ndarray, data: np.ndarray) -> pa.Array:
    cuts = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(cuts), pa.py_buffer(data)])


#: counts from which shares have more digits, and the units below and from them
FINE, FINER = 4, 256
_UNITS = np.array([(1 << 16) - 1, (1 << 24) - 1, (1 << 31) - 1])


def _unit(count: np.ndarray) -> np.ndarray:
    return _UNITS[np.searchsorted([FINE, FINER], count, side="right")]


def shares(x: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Rows of expected counts as whole numbers that add up to the unit of their
    count, without the last one."""
    upto = np.cumsum(x, axis=1)
    upto *= (_unit(count) / np.maximum(upto[:, -1], 1e-300))[:, None]
    return np.diff(np.rint(upto[:, :-1]), axis=1, prepend=0.0).astype(np.int32)


def parts_of(q: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The states' shares of one that ``q`` stands for."""
    unit = _unit(count)
    return np.column_stack([q, unit - q.sum(axis=1, dtype=np.int64)]) / unit[:, None]


def _planes(q: np.ndarray, kind) -> bytes:
    """Bytes apart by significance, which compresses better."""
    return _pack(np.ascontiguousarray(q, kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T)


def _of_planes(b: bytes, kind, width: int) -> np.ndarray:
    flat = _unpack(b, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).reshape(-1, width)


def _pack_shares(q: np.ndarray, count: np.ndarray) -> bytes:
    fine = count >= FINE
    low = _planes(q[~fine], np.uint16)
    return len(low).to_bytes(4, "little") + low + _planes(q[fine], np.int32)


def _unpack_shares(b: bytes, count: np.ndarray, states: int) -> np.ndarray:
    fine, cut = count >= FINE, 4 + int.from_bytes(b[:4], "little")
    q = np.empty((len(count), states - 1), np.int32)
    q[~fine] = _of_planes(b[4:cut], np.uint16, states - 1)
    q[fine] = _of_planes(b[cut:], np.int32, states - 1)
    return parts_of(q, count)


# --- chunks and counts --------------------------------------------------------

_CHUNK = (
    "chunk long, ids array<{id}>, held array<boolean>, lens array<int>, codes binary, cls binary, "
    "words binary, counts binary, n_words long, tokens long"
)


def coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts (first the end token, then by their first
    place), the texts as numbers of words, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    there = pc.binary_length(split.values).to_numpy() > 0
    lens = np.diff(np.concatenate([[0], np.cumsum(there)])[split.offsets.to_numpy()]) + 1
    tokens = split.values.filter(pa.array(there)).dictionary_encode()
    codes = np.zeros(int(lens.sum()), np.int32)
    inner = np.ones(len(codes), bool)
    inner[np.cumsum(lens) - 1] = False
    codes[inner] = tokens.indices.to_numpy() + 1
    return pa.concat_arrays([pa.array([END.decode()]), tokens.dictionary]), codes, lens.astype(np.int32)


def chunks(docs: DataFrame, id_col: str, text_col: str, held_col: str, classes: int, chunk_bytes: int) -> DataFrame:
    """Texts packed by task: every chunk has its own word list (first the end
    token) and the words' counts in texts that are not held out."""
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("__id"), F.col(held_col).alias("__held"), F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]):
        number = TaskContext.get().partitionId() << 32

        def full(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            ids, held = (pa.concat_arrays([column_of(p, c) for p in parts]) for c in ("__id", "__held"))
            words, flat, lens = coded(pa.concat_arrays([column_of(p, "__text").cast(pa.string()).fill_null("") for p in parts]))
            train = np.repeat(~held.to_numpy(zero_copy_only=False), lens)
            counts = np.bincount(flat[train], minlength=len(words)).astype(np.int32)
            size = pc.binary_length(words).to_numpy()
            data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
            row = {
                "chunk": pa.array([number], pa.int64()), "ids": pa.ListArray.from_arrays([0, len(ids)], ids),
                "held": pa.ListArray.from_arrays([0, len(held)], held), "lens": pa.ListArray.from_arrays([0, len(lens)], pa.array(lens)),
                "codes": pa.array([_planes(flat, np.int32)], pa.binary()), "cls": pa.array([_pack(ending_classes(words, classes))], pa.binary()),
                "words": pa.array([_pack_words(size, data[: int(size.sum())])], pa.binary()), "counts": pa.array([_pack(counts)], pa.binary()),
                "n_words": pa.array([len(words)], pa.int64()), "tokens": pa.array([int(train.sum())], pa.int64()),
            }
            return pa.RecordBatch.from_pydict(row)

        parts, size = [], 0
        for batch in slices(batches, "__text", chunk_bytes // 4):
            since = 0
            for i, n in enumerate(pc.fill_null(pc.binary_length(column_of(batch, "__text")), 0).to_pylist()):
                if size and size + n > chunk_bytes:
                    yield full([*parts, batch.slice(since, i - since)])
                    number += 1
                    parts, size, since = [], 0, i
                    pa.default_memory_pool().release_unused()
                size += n + 64
            parts.append(batch.slice(since))
        if size:
            yield full(parts)
        parts.clear()
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, _CHUNK.format(id=kind))


def with_counts(packed: DataFrame, least: int, buckets: int, states: int) -> DataFrame:
    """The chunks with each of their words' training count in the whole corpus
    (``totals``) and n_new, which adds up to the distinct training words. Of the
    words counted ``least`` times or more, ordered by bucket and rank: place
    in the chunk (``own``), rank in the bucket, first leaning to the states; and
    how many there are in each bucket (``sizes``)."""

    def deal(batches: Iterator[pa.RecordBatch]):
        """A row for each bucket that has words of a chunk."""
        for row in _rows(batches):
            words, counts = _words(*_unpack_words(row["words"])), _unpack(row["counts"], np.int32)
            bucket = np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words)) % np.uint64(buckets)
            pos = np.argsort(bucket, kind="stable").astype(np.int32)
            bucket, counts = bucket[pos].astype(np.int32), counts[pos]
            words = words.take(pa.array(pos))
            size = pc.binary_length(words).to_numpy()
            data, end = np.frombuffer(words.buffers()[2] or b"", np.uint8), np.concatenate([[0], np.cumsum(size)])
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            some = list(zip(cuts, cuts[1:], strict=False))
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([row["chunk"]] * len(some), pa.int64()),
                    "bucket": pa.array(bucket[cuts[:-1]]),
                    "pos": pa.array([_pack(pos[a:b]) for a, b in some], pa.binary()),
                    "words": pa.array([_pack_words(size[a:b], data[end[a] : end[b]]) for a, b in some], pa.binary()),
                    "counts": pa.array([_pack(counts[a:b]) for a, b in some], pa.binary()),
                }
            )

    rows = packed.select("chunk", "words", "counts").mapInArrow(deal, "chunk long, bucket int, pos binary, words binary, counts binary")

    def count(got: pa.Table) -> pa.Table:
        size, data = zip(*map(_unpack_words, got.column("words").to_pylist()), strict=True)
        words = _words(np.concatenate(size), np.concatenate(data)).dictionary_encode()
        code, names = words.indices.to_numpy(), words.dictionary
        counts, pos = (np.concatenate([_unpack(x, np.int32) for x in got.column(c).to_pylist()]) for c in ("counts", "pos"))
        total = np.bincount(code, counts, len(names)).astype(np.int64)
        mine = total >= least
        rank = (np.cumsum(mine) - 1).astype(np.int32)
        found, at = endings(names.filter(pa.array(mine)))
        lean = np.array([_noise(ending, states) for ending, _ in found], np.uint8).reshape(-1, states)[at]
        chunk = np.repeat(got.column("chunk").to_numpy(), [len(x) for x in size])
        order = np.lexsort((code, chunk))
        new = int(np.count_nonzero(total))
        out = []
        for at in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1):
            own = at[mine[code[at]]]
            ranks = rank[code[own]]
            out.append((chunk[at[0]], got.column("bucket")[0].as_py(), _pack(pos[at]), _pack(total[code[at]]), _pack(pos[own]), _pack(ranks), _pack(lean[ranks]), new))
            new = 0
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.int64()], strict=True)], ["of", "bucket", "pos", "total", "own", "ranks", "lean", "new"])

    counted = rows.groupBy("bucket").applyInArrow(
        count, "of long, bucket int, pos binary, total binary, own binary, ranks binary, lean binary, new long"
    )
    kind = packed.schema["ids"].dataType.simpleString()
    out = (
        f"chunk long, ids {kind}, held array<boolean>, lens array<int>, codes binary, cls binary, "
        "totals binary, own binary, ranks binary, lean binary, sizes array<struct<bucket:int,n:int>>, n_new long"
    )

    def merge(chunk: pa.Table, got: pa.Table) -> pa.Table:
        got = got.sort_by("bucket")
        of = {k: [_unpack(x, t) for x in got.column(k).to_pylist()] for k, t in (("pos", np.int32), ("total", np.int64), ("own", np.int32), ("ranks", np.int32), ("lean", np.uint8))}
        pos = np.concatenate(of["pos"])
        totals = np.zeros(len(pos), np.int64)
        totals[pos] = np.concatenate(of["total"])
        sizes = [{"bucket": b, "n": len(x)} for b, x in zip(got.column("bucket").to_pylist(), of["own"], strict=True) if len(x)]
        more = {"totals": pa.array([_pack(totals)], pa.binary())}
        more |= {k: pa.array([_pack(np.concatenate(of[k]))], pa.binary()) for k in ("own", "ranks", "lean")}
        more["sizes"] = pa.array([sizes], pa.list_(pa.struct([("bucket", pa.int32()), ("n", pa.int32())])))
        more["n_new"] = pa.array([sum(got.column("new").to_pylist())], pa.int64())
        for k, v in more.items():
            chunk = chunk.append_column(k, v)
        return chunk

    left = packed.select("chunk", "ids", "held", "lens", "codes", "cls")
    return left.groupBy("chunk").cogroup(counted.groupBy("of")).applyInArrow(merge, out)


# --- the model ----------------------------------------------------------------


def _noise(name: bytes, states: int) -> np.ndarray:
    return np.frombuffer(xxhash.xxh3_128_digest(name) * (states // 16 + 1), np.uint8)[:states]


@dataclass
class Hmm:
    """What all chunks share: ending classes, then the unknown word. A word of its
    own has a row of expected counts in the table of its chunk."""

    classes: int
    tokens: int
    vocabulary: int
    mass: np.ndarray  # smoothed unigram probability of each class
    start: np.ndarray
    trans: np.ndarray
    emit: np.ndarray  # classes x states
    norm: np.ndarray  # of the emissions, by state
    share: np.ndarray | None  # added to the expected counts of a word; None before the first round

    def word_prob(self, totals: np.ndarray) -> np.ndarray:
        return (totals + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1))

    def symbols(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word of a chunk its symbol (own words first, by their first
        place: common words lie together) and its corpus count; the places of
        the own words, and their order in the rows by bucket."""
        totals, own = _unpack(row["totals"], np.int64), _unpack(row["own"], np.int32)
        order = np.argsort(own)
        own = own[order]
        sym = _unpack(row["cls"], np.int32) + len(own)
        sym[own] = np.arange(len(own))
        sym[totals == 0] = len(own) + self.classes
        return sym, totals, own, order

    def lean(self, row: dict, mass: np.ndarray, order: np.ndarray) -> np.ndarray:
        """First emissions of the own words, not yet normed."""
        return mass[:, None] * (1.0 + _unpack(row["lean"], np.uint8).reshape(len(mass), -1)[order] / 255.0)

    def emissions(self, row: dict, parts: np.ndarray | None, totals: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Symbols x states of a chunk; ``parts``: the states' shares of its own
        words, whose corpus counts are ``totals``."""
        if self.share is not None:
            own = parts[order] * totals[:, None] + 0.5 * self.share
        else:
            own = self.lean(row, self.word_prob(totals), order) if len(totals) else np.zeros((0, len(self.norm)))
        return np.vstack([own / self.norm, self.emit])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}


def _emit(table: np.ndarray, seen: np.ndarray):
    """States x items of some places; a symbol's states are one line of the cache."""
    return lambda a, b: table.take(seen[a:b], axis=0).T


def _groups(lens: np.ndarray, chosen: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of texts of like length, with bounded tokens together."""
    order = chosen[np.argsort(lens[chosen], kind="stable")]
    total = np.cumsum(lens[order])
    group = total // BATCH_TOKENS
    for part in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(part):
            yield part


def _items(codes: np.ndarray, starts: np.ndarray, lens: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Codes of some texts, one after the other."""
    n = lens[part]
    return codes[np.repeat(starts[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def expected_counts(model: Hmm, row: dict, parts: np.ndarray | None):
    """Summed over a chunk's training texts: (symbols x states), transitions,
    starts; and its own words' training counts in the chunk."""
    k = len(model.start)
    sym, totals, own, order = model.symbols(row)
    table = model.emissions(row, parts, totals[own], order)
    counts = np.zeros((len(table), k))
    pairs, starts_of = np.zeros((k, k)), np.zeros(k)
    known = np.zeros(len(table), np.int64)
    codes = _of_planes(row["codes"], np.int32, 1)[:, 0]
    lens = np.array(row["lens"], np.int64)
    begin = np.cumsum(lens) - lens
    for part in _groups(lens, np.flatnonzero(~np.array(row["held"], bool))):
        lay = layout(lens[part])
        seen = np.empty(int(lens[part].sum()), np.int64)
        seen[lay.slot] = sym[_items(codes, begin, lens, part)]
        both = Pass(_emit(table, seen), lay, model.start, model.trans, keep=True)
        pairs += both.backward()
        starts_of += both.block(0).sum(axis=1)
        counts += both.by_symbol(seen, len(counts))
        known += np.bincount(seen, minlength=len(known))
    # own words by bucket again
    counts[order] = counts[: len(own)].copy()
    in_chunk = np.empty(len(own), np.int32)
    in_chunk[order] = known[: len(own)]
    return counts, pairs, starts_of, in_chunk


def initial(classes: int, states: int, tokens: int, vocabulary: int, counts: np.ndarray, own: np.ndarray) -> Hmm:
    """Sticky states; emissions lean to a state by the ending of the word.
    ``counts``: (training count, distinct words) of each class; ``own``: summed
    first emissions of the own words."""
    mass = (counts[:, 0] + 0.5 * counts[:, 1]) / (tokens + 0.5 * (vocabulary + 1))
    lean = np.array([_noise(str(i).encode(), states) for i in range(classes + 1)]) / 255.0 + 1.0
    emit = mass[:, None] * lean
    norm = emit.sum(axis=0) + own
    trans = np.full((states, states), 0.05 / states) + 0.95 * np.eye(states)
    return Hmm(classes, tokens, vocabulary, mass, np.full(states, 1 / states), trans, emit / norm, norm, None)


def maximise(model: Hmm, counts: np.ndarray, words: np.ndarray, own: np.ndarray, pairs: np.ndarray, starts: np.ndarray) -> Hmm:
    """New parameters. The base model's added half count of every word is
    shared by the states in proportion to their use, so that an unknown word
    is as likely in each state as in the base model. ``own``: expected counts of
    all own words together."""
    total = counts.sum(axis=0) + own
    use = total + 1e-9
    share = use / max(use.sum(), 1e-9)
    norm = total + 0.5 * (model.vocabulary + 1) * share
    trans = pairs + 0.1
    start = starts + 0.1
    return Hmm(
        model.classes, model.tokens, model.vocabulary, model.mass, start / start.sum(),
        trans / trans.sum(axis=1, keepdims=True), (counts + 0.5 * words[:, None] * share) / norm, norm, share,
    )


def _cuts(row: dict) -> np.ndarray:
    """Where the own words of one bucket end and those of the next begin."""
    return np.cumsum([e["n"] for e in row["sizes"]], dtype=np.int64)[:-1]


def _each(table: DataFrame, sums: DataFrame | None, states: int, fn, out: str) -> DataFrame:
    """``fn`` of every chunk and the states' shares of its own words (None before the first round)."""
    if sums is None:

        def alone(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from fn(next(_rows([batch.slice(i, 1)])), None, batch.schema).to_batches()

        return table.mapInArrow(alone, out)

    def joined(chunk: pa.Table, got: pa.Table) -> pa.Table:
        row = {k: v[0] for k, v in chunk.to_pydict().items()}
        counts = np.split(_unpack(row["totals"], np.int64)[_unpack(row["own"], np.int32)], _cuts(row))
        sent = got.sort_by("bucket").column("sums").to_pylist()
        parts = (_unpack_shares(x, k, states) for x, k in zip(sent, counts[: len(sent)], strict=True))
        return fn(row, np.vstack([np.zeros((0, states)), *parts]), chunk.schema)

    return table.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(joined, out)


def _added(sent: DataFrame, states: int) -> DataFrame:
    """Expected counts summed per word, as shares, for each chunk that sent some;
    the sum of each bucket's words in a row of chunk -1; rows of negative
    buckets, what all chunks share, are added up."""

    def add(got: pa.Table) -> pa.Table:
        if got.column("bucket")[0].as_py() < 0:
            whole = np.sum([np.frombuffer(x) for x in got.column("sums").to_pylist()], axis=0)
            return got.select(["chunk", "bucket"]).slice(0, 1).append_column("sums", pa.array([whole.tobytes()], pa.binary()))
        ranks = [_unpack(x, np.int32) for x in got.column("ranks").to_pylist()]
        total = np.zeros((1 + max(int(r[-1]) for r in ranks), states))
        count = np.zeros(len(total), np.int64)
        for r, k, x in zip(ranks, got.column("known").to_pylist(), got.column("sums").to_pylist(), strict=True):
            known = _unpack(k, np.int32)
            total[r] += _unpack_shares(x, known, states) * known[:, None]
            count[r] += known
        q = shares(total, count)
        whole = (parts_of(q, count) * count[:, None]).sum(axis=0)
        return pa.table(
            {
                "chunk": pa.array([-1, *got.column("chunk").to_pylist()], pa.int64()),
                "bucket": pa.array([got.column("bucket")[0].as_py()] * (1 + len(ranks)), pa.int32()),
                "sums": pa.array([whole.tobytes(), *(_pack_shares(q[r], count[r]) for r in ranks)], pa.binary()),
            }
        )

    return sent.groupBy("bucket").applyInArrow(add, "chunk long, bucket int, sums binary")


def train(table: DataFrame, tokens: int, states: int, rounds: int, classes: int) -> tuple[Hmm, DataFrame | None]:
    """Baum-Welch over all training texts of the counted chunks: what all chunks
    share, and the states' shares of each chunk's own words."""
    spark = table.sparkSession
    vocabulary = int(table.agg(F.sum("n_new")).first()[0] or 0)
    size = classes + 1

    def gather(rows: DataFrame, fn, height: int, width: int) -> np.ndarray:
        """fn's (height x width) sums over all tasks, added per row."""

        def run(batches):
            got = np.zeros((height, width))
            for row in _rows(batches):
                got += fn(row)
            at = np.flatnonzero(got.any(axis=1))
            flat = pa.array(got[at].ravel(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * width, flat)],
                names=["row", "v"],
            )

        sums = [F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(width)]
        got = rows.mapInArrow(run, "row long, v array<double>").groupBy("row").agg(*sums).toArrow()  # height rows
        out = np.zeros((height, width))
        if got.num_rows:
            out[got.column("row").to_numpy()] = np.column_stack([got.column(f"v{i}").to_numpy() for i in range(width)])
        return out

    base = Hmm(classes, tokens, vocabulary, None, None, None, None, None, None)

    def class_counts(row: dict) -> np.ndarray:
        """Training tokens and words of each class, and the own words' first
        emissions; a word that stands in n chunks' training texts is counted by
        its share of the corpus count."""
        out = np.zeros((size + 1, max(2, states)))
        sym, totals, own, order = base.symbols(row)
        train_of = np.repeat(~np.array(row["held"], bool), row["lens"])
        in_chunk = np.bincount(_of_planes(row["codes"], np.int32, 1)[:, 0][train_of], minlength=len(sym))
        part = in_chunk / np.maximum(totals, 1)
        rare = sym >= len(own)
        out[:size, 0] = np.bincount(sym[rare] - len(own), in_chunk[rare], size)
        out[:size, 1] = np.bincount(sym[rare] - len(own), part[rare], size)
        out[size, :states] = part[own] @ base.lean(row, base.word_prob(totals[own]), order) if len(own) else 0.0
        return out

    got = gather(table, class_counts, size + 1, max(2, states))
    counts = got[:size, :2]
    counts[:, 1] = np.rint(counts[:, 1])
    counts[size - 1] = (0, 1)  # the unknown word
    model = initial(classes, states, tokens, vocabulary, counts, got[size, :states])
    height = size + states + 2
    added = sums = None

    def common(row: dict) -> np.ndarray:
        """What all chunks share; in the last row the sum of all own words."""
        out = np.zeros((height, states))
        x = np.frombuffer(row["sums"]).reshape(-1, states)
        if row["bucket"] < 0:
            out[:-1] = x
        else:
            out[-1] = x[0]
        return out

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(vars(model))

        def step(row: dict, own_sums, _schema, shared=shared) -> pa.Table:
            model = Hmm(**shared.value)
            got, pairs, starts, known = expected_counts(model, row, own_sums)
            n = len(got) - size
            cuts = _cuts(row)
            ranks = np.split(_unpack(row["ranks"], np.int32), cuts) if n else []
            parts = np.split(shares(got[:n], known), cuts) if n else []
            counts_of = np.split(known, cuts) if n else []
            rest = np.vstack([got[n:], pairs, starts])
            m = len(parts) + 1
            return pa.table(
                {
                    "chunk": pa.array([row["chunk"]] * m, pa.int64()),
                    "bucket": pa.array([-1 - row["chunk"] % 1021 % BUCKETS] + [e["bucket"] for e in row["sizes"]], pa.int32()),
                    "ranks": pa.array([b""] + [_pack(r) for r in ranks], pa.binary()),
                    "known": pa.array([b""] + [_pack(x) for x in counts_of], pa.binary()),
                    "sums": pa.array([rest.tobytes()] + [_pack_shares(x, k) for x, k in zip(parts, counts_of, strict=True)], pa.binary()),
                }
            )

        kept = ["chunk", "held", "lens", "codes", "cls", "totals", "own", "ranks", "sizes"]
        of = table.select(*kept, "lean") if sums is None else table.select(*kept)
        # in two steps, so that the shuffles of one are gone before the other's
        sent = materialise(_each(of, sums, states, step, "chunk long, bucket int, ranks binary, known binary, sums binary"), "sent", instead_of=added)
        added = materialise(_added(sent, states), "added", instead_of=sent)
        shared.destroy()
        rest = added.filter("bucket < 0 or chunk < 0").select("bucket", "sums")
        got = gather(rest, common, height, states)
        model = maximise(model, got[:size], counts[:, 1], got[-1], got[size : size + states], got[-2])
        sums = added.filter("bucket >= 0 and chunk >= 0")
    return model, sums


def text_scores(table: DataFrame, model: Hmm, sums: DataFrame | None, id_col: str) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    shared = table.sparkSession.sparkContext.broadcast(vars(model))
    kind = table.schema["ids"].dataType.elementType.simpleString()
    states = len(model.start)

    def run(row: dict, own_sums, schema: pa.Schema) -> pa.Table:
        m = Hmm(**shared.value)
        id_type = schema.field("ids").type.value_type
        sym, totals, own, order = m.symbols(row)
        codes = _of_planes(row["codes"], np.int32, 1)[:, 0]
        lens = np.array(row["lens"], np.int64)
        begin = np.cumsum(lens) - lens
        word = m.word_prob(totals)
        log_word = np.log10(word)
        known = np.add.reduceat((totals > 0)[codes], begin, dtype=np.int64)
        base = np.add.reduceat(log_word[codes], begin)
        # the word's share of its symbol
        mass = np.concatenate([word[own], m.mass])
        inside = np.add.reduceat((log_word - np.log10(mass[sym]))[codes], begin)
        by_state = m.emissions(row, own_sums, totals[own], order)
        score = np.empty(len(lens))
        for part in _groups(lens, np.arange(len(lens))):
            lay = layout(lens[part])
            seen = np.empty(int(lens[part].sum()), np.int64)
            seen[lay.slot] = sym[_items(codes, begin, lens, part)]
            score[part] = Pass(_emit(by_state, seen), lay, m.start, m.trans, keep=False).logs
        return pa.table(
            [
                pa.array(row["ids"], id_type), pa.array(row["held"], pa.bool_()), pa.array(lens),
                pa.array(known), pa.array(np.full(len(lens), m.tokens)), pa.array(base),
                pa.array(score / _LOG10 + inside),
            ],
            names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return _each(
        table.drop("ranks", "n_new", *(["lean"] if sums is not None else [])),
        sums,
        states,
        run,
        f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def hmm_scores(
    docs: DataFrame,
    held_out,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    rounds: int = ROUNDS,
    own_share: float | None = None,
    classes: int = CLASSES,
    chunk_bytes: int = CHUNK_BYTES,
    least: int = LEAST,
) -> DataFrame:
    """Train on the rows where the column ``held_out`` is not true and score
    every row. Null and empty texts are the end token alone; repeated rows each
    count; null ids are kept (and are training rows if ``held_out`` is null).
    Without training rows every token is unknown and has probability one.
    ``own_share`` sets ``least`` as a share of the training tokens."""
    marked = docs.select(F.col(id_col), F.col(text_col), F.coalesce(held_out, F.lit(False)).alias("__held"))
    packed = materialise(chunks(marked, id_col, text_col, "__held", classes, chunk_bytes), "chunks")
    tokens, pairs = packed.agg(F.sum("tokens"), F.sum("n_words")).first()
    tokens = int(tokens or 0)
    if own_share is not None:
        least = int(np.ceil(tokens * own_share))
    buckets = max(BUCKETS, int(pairs or 0) // BUCKET_PAIRS)
    with shuffles_cleared(docs.sparkSession):
        table = materialise(with_counts(packed, max(1, least), buckets, states), "counted", instead_of=packed)
        model, sums = train(table, tokens, states, rounds, classes)
    return text_scores(table, model, sums, id_col)
