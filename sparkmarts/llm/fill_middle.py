"""Fill-in-middle transformation as a pyarrow.compute pipeline.

The units of a text are its code points. Per batch of rows the units become
list arrays, which are flattened with the index of their parent row; a unit's
ordinal in its row tells whether it belongs to the prefix, middle or suffix; the
units of each role are filtered, rebuilt into lists and joined, and the pieces
are joined with the sentinels in the order of the row's form. Cuts and forms come
from a hash of the row's id: a run that is repeated makes the same choices.

A text of over ``PART_BYTES`` passes through the pipeline in parts whose
ordinals go on, so the arrays per unit stay bounded whatever the text's length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmarts.llm.common import column_of, fresh, map_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: of 100 rows, those transformed; of 100 transformed rows, those with the suffix first
FIM_RATE, SPM_RATE = 90, 20
SEED = 1
#: bytes of text whose units are held at once
PART_BYTES = 1 << 20
ROLES = ("prefix", "middle", "suffix")
ADDED = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(id_col: str, seed: int = SEED, n: int = 4) -> list[Column]:
    """The first ``n`` groups of 8 hex digits of sha256("seed:id") as numbers; a null id counts as empty."""
    own = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    digest = F.sha2(own.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(n)]


# --- the pipeline ---------------------------------------------------------------


def split(texts: pa.StringArray) -> pa.ListArray:
    """Each text as the list of its code points, which share the texts' bytes."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2] or pa.py_buffer(b"")
    own = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    starts = np.flatnonzero((own & 0xC0) != 0x80).astype(np.int32) + ends[0]
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.r_[starts, ends[-1:]]), data)
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, ends).astype(np.int32)), units)


def roles(texts: pa.StringArray, first: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[str, pa.Array]:
    """The pieces of texts whose units have the ordinals ``first``, ``first`` + 1, ... in
    their row: prefix below ``low``, middle below ``high``, suffix the rest."""
    lists = split(texts)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    start = pc.take(pa.array(lists.offsets.to_numpy()[:-1] - first), parent)
    ordinal = pc.subtract(pa.array(np.arange(len(units), dtype=np.int64)), start)
    before, after = pc.less(ordinal, pc.take(pa.array(low), parent)), pc.greater_equal(ordinal, pc.take(pa.array(high), parent))
    of = {"prefix": before, "middle": pc.invert(pc.or_(before, after)), "suffix": after}
    out = {}
    for role, mask in of.items():
        # sums of the filtered units of each list are the offsets of the rebuilt lists
        running = np.r_[0, np.cumsum(mask.to_numpy(zero_copy_only=False))].astype(np.int32)
        rebuilt = pa.ListArray.from_arrays(pa.array(running[lists.offsets.to_numpy()]), pc.filter(units, mask))
        out[role] = pc.binary_join(rebuilt, "")
    return out


def parts(texts: pa.StringArray, part_bytes: int) -> Iterator[tuple[pa.StringArray, np.ndarray, np.ndarray]]:
    """(texts or parts of one text, their rows, ordinals of their first units), of ``part_bytes`` together or one text."""
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    start = 0
    while start < len(texts):
        if size[start] > part_bytes:
            data, at, units = texts[start].as_buffer().to_pybytes(), 0, 0
            while at < len(data):
                end = min(at + part_bytes, len(data))
                while end < len(data) and data[end] & 0xC0 == 0x80:
                    end += 1
                part = pa.array([data[at:end]], pa.binary()).cast(pa.string())
                yield part, np.array([start]), np.array([units])
                units += pc.utf8_length(part)[0].as_py()
                at = end
            start += 1
            continue
        end = start + max(1, int(np.searchsorted(np.cumsum(size[start:]), part_bytes, side="right")))
        yield texts.slice(start, end - start), np.arange(start, end), np.zeros(end - start, np.int64)
        start = end


def pieces(texts: pa.StringArray, low: np.ndarray, high: np.ndarray, part_bytes: int = PART_BYTES) -> dict[str, pa.Array]:
    """The prefix, middle and suffix of each text, cut after ``low`` and ``high`` units."""
    got: dict[str, list] = {r: [] for r in ROLES}
    of_row = []
    for own, rows, first in parts(texts, part_bytes):
        of_row.append(rows)
        for role, made in roles(own, first, low[rows], high[rows]).items():
            got[role].append(made)
    rows = np.concatenate(of_row) if of_row else np.zeros(0, np.int64)
    ends = pa.array(np.searchsorted(rows, np.arange(len(texts) + 1)).astype(np.int32))
    flat = {r: pa.chunked_array(x, pa.string()).combine_chunks() for r, x in got.items()}
    if len(rows) == len(texts):
        return flat
    # the parts of one text are joined in turn
    return {r: pc.binary_join(pa.ListArray.from_arrays(ends, x), "") for r, x in flat.items()}


def transform(
    texts: pa.StringArray, h1: np.ndarray, h2: np.ndarray, h3: np.ndarray, h4: np.ndarray,
    rate: int = FIM_RATE, spm_rate: int = SPM_RATE, part_bytes: int = PART_BYTES,
) -> dict:
    """The columns ``ADDED`` of texts without nulls."""
    n = pc.utf8_length(texts).cast(pa.int64()).to_numpy()
    a, b = h1 % (n + 1), h2 % (n + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    plain = (n == 0) | (h3 % 100 >= rate)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    spm = ~plain & (h4 % 100 < spm_rate)
    # plain texts need no pieces
    cut = pieces(pc.if_else(pa.array(plain), "", texts), low, high, part_bytes)
    p, m, s = cut["prefix"], cut["middle"], cut["suffix"]
    put = lambda *x: pc.binary_join_element_wise(*x, "")
    psm_form, spm_form = put(PREFIX, p, SUFFIX, s, MIDDLE, m), put(SUFFIX, s, PREFIX, p, MIDDLE, m)
    kind = [pa.array(plain), pa.array(spm)]
    cases = pa.StructArray.from_arrays(kind, names=["plain", "spm"])
    null = pa.scalar(None, pa.int64())
    return {
        "n": pa.array(n),
        "form": pc.case_when(cases, "plain", "spm", "psm"),
        "prefix_chars": pc.if_else(kind[0], null, pa.array(low)),
        "middle_chars": pc.if_else(kind[0], null, pa.array(high - low)),
        "output": pc.case_when(cases, texts, spm_form, psm_form),
    }


def fill_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    seed: int = SEED,
    rate: int = FIM_RATE,
    spm_rate: int = SPM_RATE,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The columns ``keep`` (all by default) of every row, then ``n`` (code points), ``form``
    (plain, psm or spm), ``prefix_chars`` and ``middle_chars`` (null if plain) and ``output``. A column
    of one of these names gives way to the new one. A null text counts as empty. A text that is
    empty or holds a sentinel stays plain, so that every output can be restored. Repeated rows are each
    transformed, alike if they agree in id and text; rows of a null id share one draw."""
    names = [c for c in (keep if keep is not None else docs.columns) if c not in ("n", "form", "prefix_chars", "middle_chars", "output")]
    h = F.array(*draws(id_col, seed))
    text = fresh("text", docs.columns + names)
    drawn = fresh("draws", docs.columns + names)
    rows = docs.select(*(F.col(f"`{c}`") for c in names), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(text), h.alias(drawn))

    def run(part: pa.RecordBatch) -> dict:
        drawn_here = column_of(part, drawn).flatten().to_numpy().reshape(-1, 4)
        texts = column_of(part, "__text")
        return transform(texts, *drawn_here.T, rate=rate, spm_rate=spm_rate, part_bytes=part_bytes)

    made = map_slices(rows, text, run, ADDED, keep=[*names, drawn])
    return made.drop(drawn)


def restore(output: Column, form: Column) -> Column:
    """The text from which ``output`` of the given ``form`` was made. No piece holds a sentinel, and
    '<' stands only at a sentinel's start, so each sentinel's first occurrence is the one put there."""
    after = lambda x, mark: F.substring(x, F.length(F.substring_index(x, mark, 1)) + 1 + len(mark), F.length(x))
    body = F.substring(output, 4, F.length(output))
    second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    one = F.when(form == "psm", F.substring_index(body, SUFFIX, 1)).otherwise(F.substring_index(body, PREFIX, 1))
    rest = F.substring(body, F.length(one) + 1 + F.length(second), F.length(body))
    two, middle = F.substring_index(rest, MIDDLE, 1), after(rest, MIDDLE)
    whole = F.when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
    return F.when(form == "plain", output).otherwise(whole)
