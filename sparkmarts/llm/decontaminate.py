"""Benchmark decontamination with one Aho-Corasick automaton.

Test questions and answers are normalised to words; every window of ten words
(a whole item if it is shorter) is one pattern. Each document is normalised the
same way and scanned once; hits are mapped back to the original text."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.llm.common import WORD_BYTES, fresh, map_slices, materialise, texts_of

WINDOW = 10
#: most bytes of test text in one automaton (about 300 bytes of memory each); a
#: larger benchmark is scanned in several passes, one automaton each
AUTOMATON_BYTES = 512 << 10
SPAN = "array<struct<item_id:string,first_word:bigint,last_word:bigint,start:bigint,end:bigint>>"
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normalise(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def windows(words: list[bytes], width: int) -> list[tuple[int, bytes]]:
    """(words, padded pattern) of each window of an item."""
    n = min(width, len(words))
    return [(n, b" " + b" ".join(words[i : i + n]) + b" ") for i in range(len(words) - n + 1)] if n else []


def automaton(items: list[tuple[str, bytes]], width: int) -> ahocorasick.Automaton:
    """Values: (length in characters, words, item ids)."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        for n, pattern in windows(normalise(text), width):
            found.setdefault(pattern, (n, set()))[1].add(item)
    a = ahocorasick.Automaton()
    for pattern, (n, ids) in found.items():
        a.add_word(pattern.decode("latin-1"), (len(pattern), n, tuple(sorted(ids))))
    if len(a):
        a.make_automaton()
    return a


def occurrences(a: ahocorasick.Automaton, words: list[bytes]) -> list[tuple[int, int, tuple[str, ...]]]:
    """(first word, words, item ids) of every window in the word list."""
    if not words or not len(a):
        return []
    text = (b" " + b" ".join(words) + b" ").decode("latin-1")
    out = []
    seen = at = 0  # spaces before position seen
    for end, (size, n, ids) in a.iter(text):
        # the space that ends a window stands after its last word
        at += text.count(" ", seen, end)
        seen = end
        out.append((at - n, n, ids))
    return out


def item_spans(hits: list[tuple[int, int, tuple[str, ...]]]) -> list[tuple[str, int, int]]:
    """Merged runs (item, first word, last word) of overlapping or touching windows."""
    by: dict[str, list[list[int]]] = defaultdict(list)
    for first, n, ids in sorted(hits, key=lambda h: h[:2]):
        for item in ids:
            runs = by[item]
            if runs and first <= runs[-1][1] + 1:
                runs[-1][1] = max(runs[-1][1], first + n - 1)
            else:
                runs.append([first, first + n - 1])
    return sorted((item, a, b) for item, runs in by.items() for a, b in runs)


def original_spans(text: bytes, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Adds the code point offsets (end exclusive) in the original text."""
    if not spans:
        return []
    places = [m.span() for m in _WORD.finditer(text.decode("utf-8", "surrogateescape"))]
    return [
        {"item_id": i, "first_word": a, "last_word": b, "start": places[a][0], "end": places[b][1]} for i, a, b in spans
    ]


def benchmark_passes(
    benchmark: DataFrame, id_col: str, text_col: str, pass_bytes: int
) -> tuple[int, Callable[[int], list[tuple[str, bytes]]]]:
    """The distinct test items in groups of bounded size: how many groups there
    are, and what collects one of them. Items without id are named ''."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")
    )
    total = items.distinct().agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = int(total // pass_bytes) + 1
    group = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    return n, lambda k: [(r.i, r.t.encode()) for r in items.where(group == k).distinct().collect()]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    pass_bytes: int = AUTOMATON_BYTES,
    prefix: str = "",
) -> DataFrame:
    """Each row of ``docs`` (columns ``keep``, all by default) with
    n_words, n_hit (words inside any window), and spans: for each item the runs
    of words that its windows cover, with offsets in the original text.
    Null and empty texts have no words; null and empty items no windows. Equal
    windows of several items hit all of them; repeated items count once. Columns
    of ``docs`` named like an added one give way."""
    spark = docs.sparkSession
    c_n, c_hit, c_spans = (f"{prefix}{x}" for x in ("n_words", "n_hit", "spans"))
    keep = list(docs.columns) if keep is None else keep
    passes, items_of = benchmark_passes(benchmark, item_id_col, item_text_col, pass_bytes)
    own = fresh("found", [*docs.columns, c_n, c_hit, c_spans])
    key = fresh("key", [*docs.columns, own])
    earlier = None
    for k in range(passes):
        last = k == passes - 1
        shared = spark.sparkContext.broadcast(items_of(k))
        built: list[ahocorasick.Automaton] = []

        def run(part: pa.RecordBatch, shared=shared, earlier=last and earlier is not None, built=built) -> dict:
            if not built:
                built.append(automaton(shared.value, width))
            n_words, n_hit, spans = [], [], []
            before = part.column(part.schema.names.index(own)).to_pylist() if earlier else None
            for i, text in enumerate(texts_of(part, "__text")):
                words = normalise(text)
                hits = occurrences(built[0], words)
                if before and before[i]:
                    hits += [(r["first_word"], r["last_word"] - r["first_word"] + 1, (r["item_id"],)) for r in before[i]]
                rows = original_spans(text, item_spans(hits))
                reach, hit = -1, 0
                for a, b in sorted((r["first_word"], r["last_word"]) for r in rows):
                    hit += max(0, b - max(a, reach + 1) + 1)
                    reach = max(reach, b)
                n_words.append(len(words))
                n_hit.append(hit)
                spans.append(rows)
            return {c_n: n_words, c_hit: n_hit, c_spans: spans}

        added = f"`{c_n}` long, `{c_hit}` long, `{c_spans}` {SPAN}"
        if not last:
            # what a text holds follows from the text alone: only texts with hits are written, by their digest
            texts = docs.select(F.col(f"`{text_col}`").alias("t"))
            hit = map_slices(texts, "t", run, added, keep=["t"]).where(F.col(f"`{c_hit}`") > 0)
            hit = hit.select(F.sha2("t", 256).alias(key), F.col(f"`{c_spans}`").alias(own)).dropDuplicates([key])
            hit = materialise(hit, "hits")
            shared.destroy()
            earlier = hit if earlier is None else earlier.unionByName(hit)
        elif earlier is None:
            return map_slices(docs, text_col, run, added, keep=keep)
    by_text = earlier.groupBy(key).agg(F.flatten(F.collect_list(own)).alias(own))
    marked = docs.withColumn(key, F.sha2(F.col(f"`{text_col}`"), 256)).join(by_text, key, "left")
    return map_slices(marked, text_col, run, added, keep=[*keep, own]).drop(own)


def items_digest(spans):
    """Lowercase hex SHA-256 of the distinct item ids, sorted and comma-joined (a column)."""
    ids = F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["item_id"])))
    return F.sha2(F.array_join(ids, ","), 256)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    found = contamination(docs, benchmark, prefix=prefix)
    return found.where(f"{prefix}n_hit = 0").select(*(F.col(f"`{c}`") for c in docs.columns))

