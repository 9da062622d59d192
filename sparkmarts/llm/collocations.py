"""Collocations mined by set-oriented relations, as in SETM.

The occurrence relation R(k) holds (position, group) of every phrase of k words
that may still be frequent, sorted by position. Positions number the words of a
chunk of texts, with a gap between pieces, so a place one further is the next
word of the same piece. Each length is one round over Spark:

1. R(k) comes from a merge join of R(k-1) with the words at position + k - 1, chunk by chunk. A phrase
   can be frequent only if its last k - 1 words are, so these words are taken as the last words of the
   rows of R(k-1) at position + 1; single words need not be stored again.
2. Group-count: a chunk's distinct groups, already counted, are summed over all chunks
   in buckets dealt by a hash. So a group is one entry per chunk at most, however often it occurs.
3. Semi-join: only the groups frequent in the whole corpus go back to their
   chunks, and R(k) keeps only their occurrences before it is extended.

The relations are stored per chunk, compressed, in the shared work folder. A group
is named by the place where it is first seen (chunk and number in it), so names
are exact: no hash stands for a word or phrase. What is frequent grows with the
corpus and is never broadcast or collected; buckets grow in number, not in size."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmarts.llm.common import column_of, discard, materialise, shuffles_cleared, slices, texts_of

MAX_WORDS = 4
LEAST = 30
TOP = 2000
#: score of a cut: SCALE * a / (l + r)
SCALE = 2_000_000
#: a phrase gives way to a longer one with this percentage of its count
ABSORBED = 80
CHUNK_BYTES = 6 << 20
#: bits of a group's name that number it in its chunk, and of a chunk's number in its task
_LOCAL, _CHUNKS = 24, 13
#: entries (chunk, group) summed together, at most but for chance
BUCKET_ENTRIES = 250_000

_BREAK = b"."
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 9 + b" "
)


def _split(clean: bytes) -> list[bytes]:
    """Words, and a break for each piece's end; the other whitespace that split() knows has become a break."""
    return clean.replace(_BREAK, b" . ").split()


def segments(text: bytes, max_bytes: int, context: int) -> Iterator[tuple[list[bytes], int]]:
    """(tokens, words that only lead in) of a text, cut between words into segments of about
    ``max_bytes``. A segment that goes on inside a piece is led in by its last ``context`` words."""
    clean = text.translate(_TABLE)
    lead: list[bytes] = []
    at = 0
    while at < len(clean) or not at:
        end = len(clean)
        if end - at > max_bytes:
            end = max(clean.rfind(b" ", at, at + max_bytes), clean.rfind(_BREAK, at, at + max_bytes)) + 1
            if end <= at:  # one long word
                ends = [x for x in (clean.find(b" ", at), clean.find(_BREAK, at)) if x >= 0]
                end = min(ends) + 1 if ends else len(clean)
        tokens = _split(clean[at:end])
        yield lead + tokens, len(lead)
        tail = (lead + tokens)[-context:] if context else []
        while _BREAK in tail:
            tail = tail[tail.index(_BREAK) + 1 :]
        lead, at = tail, end or 1


def _pack(a: np.ndarray) -> bytes:
    """The numbers' bytes apart by significance, which compresses better."""
    planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(b: bytes | None, kind=np.int32) -> np.ndarray:
    if not b:
        return np.zeros(0, kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _blobs(t: pa.Table, name: str, kind=np.int32) -> list[np.ndarray]:
    return [_unpack(x, kind) for x in t.column(name).to_pylist()]


def _deltas(ascending: np.ndarray) -> bytes:
    return _pack(np.diff(ascending, prepend=0).astype(np.int32))


def _undelta(b: bytes | None) -> np.ndarray:
    return np.cumsum(_unpack(b), dtype=np.int32)


def _parts(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its places in their order)."""
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(part):
            yield int(bucket[part[0]]), part


# --- R(1) -------------------------------------------------------------------------

_CHUNK = "chunk long, own int, codes binary, size int, langs array<string>, words array<binary>, totals array<long>, n binary, part int"
#: parts of a stored relation: what the next length extends, and what is only counted
_KEPT, _COUNTED = 0, 1
_ENTRIES = "bucket int, chunk long, lang string, words binary, prefix binary, last binary, local binary, n binary"


def chunks(docs: DataFrame, text_col: str, lang_col: str, chunk_bytes: int, context: int) -> DataFrame:
    """Texts packed into chunks by their task: ``codes`` numbers the words in order (0: a break), ``words``
    has the distinct ones of each language, ``n`` their counts, in a row (``part``) of their own. The first ``own`` codes of a chunk only lead in."""
    docs = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text")
    )
    kinds = pa.schema(
        [("chunk", pa.int64()), ("own", pa.int32()), ("codes", pa.binary()), ("size", pa.int32()), ("langs", pa.list_(pa.string()))]
        + [("words", pa.list_(pa.binary())), ("totals", pa.list_(pa.int64())), ("n", pa.binary()), ("part", pa.int32())]
    )

    def packed(chunk: int, own: int, tokens: dict[str, list[pa.Array]]) -> pa.RecordBatch:
        codes, langs, names, ends = [], [], [], []
        size = 0
        for lang, arrays in tokens.items():
            coded = pc.dictionary_encode(pa.concat_arrays(arrays))
            words = coded.dictionary
            is_word = pc.not_equal(words, _BREAK).to_numpy(zero_copy_only=False)
            number = np.where(is_word, size + np.cumsum(is_word), 0).astype(np.int32)
            codes.append(number[coded.indices.to_numpy()])
            kept = words.filter(pa.array(is_word))
            # a word holds no break
            names.append(zstandard.ZstdCompressor(level=1).compress(pc.binary_join(pa.ListArray.from_arrays([0, len(kept)], kept), _BREAK)[0].as_py()))
            langs.append(lang)
            size += len(kept)
            ends.append(size)
        flat = np.concatenate(codes)
        n = np.bincount(flat[own:], minlength=1 + size)[1:].astype(np.int32)
        totals = [int(x.sum()) for x in np.split(n.astype(np.int64), ends[:-1])]
        kept = {"chunk": chunk, "own": own, "codes": _pack(flat), "size": size, "part": _KEPT}
        counted = {"chunk": chunk, "langs": langs, "words": names, "totals": totals, "n": _pack(n), "part": _COUNTED}
        return pa.RecordBatch.from_pylist([kept, counted], schema=kinds)

    def run(batches: Iterable[pa.RecordBatch]):
        task = TaskContext.get().partitionId() << _CHUNKS
        made = held = own = 0
        tokens: dict[str, list[pa.Array]] = defaultdict(list)
        for batch in slices(batches, "text", chunk_bytes // 4):
            langs = column_of(batch, "lang").to_pylist()
            for lang, text in zip(langs, texts_of(batch, "text"), strict=True):
                for words, lead in segments(text, chunk_bytes, context):
                    if tokens and (lead or held + len(text) > chunk_bytes):
                        yield packed(task | made, own, tokens)
                        tokens, made, held = defaultdict(list), made + 1, 0
                        if made >> _CHUNKS:
                            raise ValueError("too many chunks in one task: use more input partitions")
                    if not tokens:
                        own = lead
                    words.append(_BREAK)
                    tokens[lang].append(pa.array(words, pa.binary()))
                    held += min(len(text), chunk_bytes)
        if tokens:
            yield packed(task | made, own, tokens)

    return docs.mapInArrow(run, _CHUNK)


def word_entries(state: DataFrame, buckets: int) -> DataFrame:
    """The words of every chunk, dealt to buckets by a hash of language and word."""

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                n, at = _unpack(row["n"]), 0
                for lang, blob in zip(row["langs"], row["words"], strict=True):
                    words = zstandard.ZstdDecompressor().decompress(blob).split(_BREAK) if blob else []
                    words = words if any(words) else []
                    seed = xxhash.xxh32_intdigest(lang)
                    bucket = np.fromiter((xxhash.xxh64_intdigest(w, seed) % buckets for w in words), np.int64, len(words))
                    rows = [
                        {
                            "bucket": b, "chunk": row["chunk"], "lang": lang, "words": _join(words, part),
                            "local": _deltas(part + at), "n": _pack(n[part + at]),
                        }
                        for b, part in _parts(bucket)
                    ]
                    at += len(words)
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY_FIELDS)

    return state.where(F.col("part") == _COUNTED).select("chunk", "langs", "words", "n").mapInArrow(run, _ENTRIES)


def _join(words: list[bytes], part: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(_BREAK.join([words[i] for i in part]))


# --- one length -------------------------------------------------------------------


def merge_join(left_at: np.ndarray, right_at: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the rows of two sorted position columns with left + shift = right."""
    place = np.searchsorted(right_at, left_at + shift)
    found = place < len(right_at)
    found[found] = right_at[place[found]] == left_at[found] + shift
    return np.flatnonzero(found), place[found]


_STATE = "chunk long, own int, at binary, group binary"
_STATE_FIELDS = [("chunk", pa.int64()), ("own", pa.int32()), ("at", pa.binary()), ("group", pa.binary())]
_ENTRY_FIELDS = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int64()), ("lang", pa.string())]
    + [(c, pa.binary()) for c in ("words", "prefix", "last", "local", "n")]
)
#: a chunk's state and its entries come from one pass: rows without and with a bucket
_MADE_FIELDS = pa.schema(_STATE_FIELDS + [(f.name, f.type) for f in _ENTRY_FIELDS if f.name != "chunk"])
_MADE = f"{_STATE}, {_ENTRIES.replace('chunk long, ', '')}"


def extend(at, group, names, lasts, k: int, own: int):
    """R(k) from the frequent R(k-1) (positions, groups; the groups' names and the names of their last
    words): its positions and groups, and for every group the names of its prefix and last word and its count."""
    i, j = merge_join(at, at, 1)
    words, word = np.unique(lasts, return_inverse=True)
    key = group[i].astype(np.int64) * max(1, len(words)) + word[group[j]]
    distinct, number = np.unique(key, return_inverse=True)
    # occurrences that end in a chunk's lead-in belong to the chunk before
    mine = at[i] + k - 1 >= own
    n = np.bincount(number, weights=mine, minlength=len(distinct)).astype(np.int64)
    return at[i], number, names[distinct // max(1, len(words))], words[distinct % max(1, len(words))], n


def _extension(k: int, max_words: int, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _MADE_FIELDS.empty_table()
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        chunk, own = row["chunk"], row["own"]
        no_names = [np.zeros(0, np.int64)]
        local = np.concatenate([np.zeros(0, np.int32)] + [_undelta(x) for x in right.column("local").to_pylist()])
        names = np.concatenate(no_names + _blobs(right, "names", np.int64))
        lasts = np.concatenate(no_names + _blobs(right, "lasts", np.int64))
        order = np.argsort(local)
        local, names, lasts = local[order], names[order], lasts[order]
        if k == 2:
            codes = _unpack(row["codes"])
            number = np.full(row["size"] + 1, -1, np.int32)
            number[local + 1] = np.arange(len(local))
            group = number[codes]
            at = np.flatnonzero(group >= 0).astype(np.int32)
            group = group[at]
        else:
            at, group = _undelta(row["at"]), _unpack(row["group"])
            # semi-join: only occurrences of frequent groups are extended
            place = np.searchsorted(local, group).astype(np.int32)
            place[place == len(local)] = 0
            frequent = local[place] == group if len(local) else np.zeros(len(group), bool)
            at, group = at[frequent], place[frequent]
        new_at, new_group, prefix, end, n = extend(at, group, names, lasts, k, own)
        rows = []
        if k < max_words:
            rows.append({"chunk": chunk, "own": own, "at": _deltas(new_at), "group": _pack(new_group.astype(np.int32))})
        for b, part in _parts(_mix(prefix, end) % np.uint64(buckets)):
            entry = {"prefix": _pack(prefix[part]), "last": _pack(end[part]), "local": _deltas(part), "n": _pack(n[part].astype(np.int32))}
            rows.append({"chunk": chunk, "bucket": b} | entry)
        return pa.Table.from_pylist(rows, schema=_MADE_FIELDS)

    return run


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A well-mixed number for each pair."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


_SUMMED = "chunk long, local binary, names binary, lasts binary, name long, lang string, word string, prefix long, last long, a long"


def frequent(entries: DataFrame, least: int) -> DataFrame:
    """Groups whose entries sum up to ``least``, in two kinds of rows: (name, the group's
    keys, a) for each group, and (chunk, local, names, lasts) for the entries of a bucket that go back to
    their chunk: their groups' names and the names of the groups' last words."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(T.StructType.fromDDL(_SUMMED))

    def summed(t: pa.Table) -> pa.Table:
        local, n = [_undelta(x) for x in t.column("local").to_pylist()], _blobs(t, "n")
        sizes = [len(x) for x in local]
        row = np.repeat(np.arange(t.num_rows), sizes)
        chunk = t.column("chunk").to_numpy()
        local, n = np.concatenate(local), np.concatenate(n)
        words = not t.column("words").null_count
        if not words:
            first = np.concatenate(_blobs(t, "prefix", np.int64))
            second = np.concatenate(_blobs(t, "last", np.int64))
        else:
            unpacked = zstandard.ZstdDecompressor().decompress
            coded = pa.array([w for x in t.column("words").to_pylist() for w in unpacked(x).split(_BREAK)], pa.binary()).dictionary_encode()
            langs = t.column("lang").combine_chunks().dictionary_encode()
            first, second = langs.indices.to_numpy()[row], coded.indices.to_numpy()
        order = np.lexsort((second, first))
        new = np.r_[True, (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)]
        starts = np.flatnonzero(new)
        a = np.add.reduceat(n[order].astype(np.int64), starts)
        uid = (chunk[row] << _LOCAL) + local
        name = np.minimum.reduceat(uid[order], starts)
        keep = np.flatnonzero(a >= least)
        head = order[starts[keep]]
        found = {"name": name[keep], "a": a[keep]}
        if not words:
            found |= {"prefix": first[head], "last": second[head]}
        else:
            found |= {"lang": langs.dictionary.take(pa.array(first[head])), "word": coded.dictionary.take(pa.array(second[head])).cast(pa.string())}
        groups = pa.table(
            [pa.array(found[f.name], f.type) if f.name in found else pa.nulls(len(keep), f.type) for f in fields], schema=fields
        )
        of_group = np.cumsum(new) - 1
        of_entry = np.empty(len(order), np.int64)
        of_entry[order] = np.where(a[of_group] >= least, name[of_group], -1)
        back = []
        for r, (x, y) in enumerate(zip(np.cumsum([0, *sizes[:-1]]), np.cumsum(sizes), strict=True)):
            mine = np.flatnonzero(of_entry[x:y] >= 0) + x
            if len(mine):
                lasts = of_entry if words else second
                back.append({"chunk": int(chunk[r]), "local": _deltas(local[mine]), "names": _pack(of_entry[mine]), "lasts": _pack(lasts[mine])})
        return pa.concat_tables([groups, pa.Table.from_pylist(back, schema=fields)])

    return entries.groupBy("bucket").applyInArrow(summed, _SUMMED)


def mine(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_words: int = MAX_WORDS,
    least: int = LEAST,
    chunk_bytes: int = CHUNK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(phrases, languages): all phrases of 1 to ``max_words`` words that occur ``least`` times or more in
    their language, as (lang, ids array<long>, phrase, a), and the number of words of each language, as (lang, n)."""
    if not 0 < chunk_bytes < 1 << _LOCAL:
        raise ValueError(f"a chunk has at most {1 << _LOCAL} bytes")
    spark = docs.sparkSession
    # a bucket's size is bounded by their number, which follows the entries
    enough = lambda n: max(2 * spark.sparkContext.defaultParallelism, (n or 0) // BUCKET_ENTRIES + 1)
    state = materialise(chunks(docs, text_col, lang_col, chunk_bytes, max_words - 1), "r1", parts="part")
    entries = word_entries(state, enough(state.agg(F.sum("size")).first()[0]))
    found = materialise(frequent(entries, least), "c1")
    totals = state.where(F.col("part") == _COUNTED).select(F.explode(F.arrays_zip("langs", "totals")).alias("t"))
    languages = materialise(totals.groupBy(F.col("t.langs").alias("lang")).agg(F.sum("t.totals").alias("n")), "languages")
    discard(state, f"part={_COUNTED}")
    first = found.where("name IS NOT NULL").select("name", "lang", F.array("name").alias("ids"), F.col("word").alias("phrase"), "a")
    first = materialise(first, "phrases1")
    phrases, of_length = first, first
    for k in range(2, max_words + 1):
        # the occurrences to be extended bound the entries of the next length
        buckets = enough(found.agg(F.sum("a")).first()[0])
        fields = ["chunk", "own", "codes", "size"] if k == 2 else [c for c, _ in _STATE_FIELDS]
        left = state.where(F.col("part") == _KEPT).select(*fields)
        right = found.where("name IS NULL").select("chunk", "local", "names", "lasts")
        made = left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(_extension(k, max_words, buckets), _MADE)
        made = made.withColumn("part", F.when(F.col("bucket").isNull(), _KEPT).otherwise(_COUNTED))
        state = materialise(made, f"r{k}", instead_of=state, parts="part")
        discard(found)
        entries = state.where(F.col("part") == _COUNTED).select(*(f.name for f in _ENTRY_FIELDS))
        found = materialise(frequent(entries, least), f"c{k}")
        discard(state, f"part={_COUNTED}")
        here = found.where("name IS NOT NULL").select("name", "prefix", "last", "a")
        starts = of_length.select(F.col("name").alias("prefix"), "lang", F.col("ids").alias("p_ids"), F.col("phrase").alias("p"))
        ends = first.select(F.col("name").alias("last"), F.col("phrase").alias("w"))
        of_length = materialise(
            here.join(starts, "prefix").join(ends, "last").select(
                "name", "lang", F.concat("p_ids", F.array("last")).alias("ids"), F.concat_ws(" ", "p", "w").alias("phrase"), "a"
            ),
            f"phrases{k}",
        )
        phrases = phrases.unionByName(of_length)
    return phrases.select("lang", "ids", "phrase", "a"), languages


# --- scores -----------------------------------------------------------------------


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_words: int = MAX_WORDS,
    least: int = LEAST,
    top: int = TOP,
    absorbed: int = ABSORBED,
    chunk_bytes: int = CHUNK_BYTES,
    salts: int = 64,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases of 2 to ``max_words`` words.

    a is the phrase's count, l and r those of its two parts at the cut that scores lowest
    (score: SCALE * a / (l + r), rounded down; ties: the first cut), n the words of the language. Phrases that lie
    inside a longer one with ``absorbed`` percent of their count or more are left out. Ties in rank
    go by larger a, then by the phrase's bytes. A null text has no words; a null language counts
    as ``und``; repeated rows count each time; other columns are ignored."""
    with shuffles_cleared(docs.sparkSession):
        phrases, languages = mine(docs, text_col, lang_col, max_words, least, chunk_bytes)
        phrases = materialise(phrases, "phrases")
    size = F.size("ids")
    candidates = phrases.where(size > 1)
    counts = phrases.select(F.col("ids").alias("part"), F.col("a").alias("f"))
    cut = candidates.select("lang", "ids", "phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cut = cut.withColumns({"part": F.slice("ids", F.lit(1), F.col("k")), "rest": F.slice("ids", F.col("k") + 1, size - F.col("k"))})
    cut = cut.join(counts.withColumnRenamed("f", "l"), "part").drop("part")
    cut = cut.join(counts.select(F.col("part").alias("rest"), F.col("f").alias("r")), "rest").drop("rest")
    # products may pass 64 bits
    whole = "decimal(20,0)"
    score = F.expr(f"CAST({SCALE} AS decimal(10,0)) * CAST(a AS {whole}) DIV (CAST(l AS {whole}) + CAST(r AS {whole}))")
    scored = cut.withColumn("score", score).groupBy("lang", "ids", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    inner = candidates.where(size > 2).select("ids", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("len"))
    inner = inner.select("ids", "a", "len", F.explode(F.sequence(F.lit(1), size - F.col("len") + 1)).alias("at"))
    longer = inner.groupBy(F.slice("ids", F.col("at"), F.col("len")).alias("ids")).agg(F.max("a").alias("longer"))
    enough = F.expr(f"100 * CAST(longer AS {whole}) >= {absorbed} * CAST(a AS {whole})")
    kept = scored.join(longer, "ids", "left").where(F.col("longer").isNull() | ~enough)
    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # first the best of each part of a language, then of the language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    some = kept.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    some = some.where(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(languages, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
