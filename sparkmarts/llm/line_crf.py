"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the
lines before and after it. Training lines carry their document's label. The
marginals of all lines, weighted by their length, give the document's score."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.llm.chain import Pass, layout
from sparkmarts.llm.common import fresh, map_slices, materialise, remainder, texts_of

THRESHOLD = 0.7
#: bounds of the training sample: documents, lines of one document, and lines of
#: all (about 1,500 bytes of the driver's memory each while the field is fitted)
TRAIN_DOCS = 6000
TRAIN_LINES = 4000
ALL_LINES = 200_000
FOLDS, HELD_OUT = 4, 2

#: byte classes whose share of a line is a feature
_CLASSES = ("upper", "digit", "symbol", "pipe", "bang", "sentence", "space", "other")


def _class_table() -> np.ndarray:
    t = np.full(256, 255, np.uint8)
    for c in range(128):
        ch = chr(c)
        if ch.isupper():
            t[c] = 0
        elif ch.isdigit():
            t[c] = 1
        elif ch == "|":
            t[c] = 3
        elif ch == "!":
            t[c] = 4
        elif ch in ".,;:?'\"()-":
            t[c] = 5
        elif ch.isspace():
            t[c] = 6
        elif not ch.isalnum():
            t[c] = 2
    t[192:] = 7  # first bytes of non-ASCII characters
    return t


N_FEATURES = len(_CLASSES) + 6


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines, their byte lengths, lines per text). An empty
    text is one empty line."""
    lines = [x for t in texts for x in t.split(b"\n")]
    per_text = np.array([t.count(b"\n") + 1 for t in texts], dtype=np.int64)
    size = np.array([len(x) for x in lines], dtype=np.int64)
    out = np.zeros((len(lines), N_FEATURES), dtype=np.float32)
    raw = np.frombuffer(b"\n".join(lines) + b"\n", dtype=np.uint8)
    starts = np.cumsum(size + 1) - (size + 1)
    kind = _class_table()[raw]
    share = 1.0 / np.maximum(size, 1)
    for i in range(len(_CLASSES)):
        count = np.add.reduceat((kind == i).view(np.uint8), starts, dtype=np.int64)
        if _CLASSES[i] == "space":
            count -= 1  # the line's own end
        out[:, i] = count * share
    k = len(_CLASSES)
    for j, line in enumerate(lines):
        words = line.split()
        n = len(words)
        if n:
            out[j, k] = 1 - len(set(words)) / n
            out[j, k + 1] = sum(map(eq, words, words[1:])) / n
            out[j, k + 2] = len(line) / n / 10
    out[:, k + 3] = np.log1p(size) / 8
    out[:, k + 4] = size == 0
    # long lines in which most words come again
    out[:, k + 5] = out[:, k] * np.minimum(size / 200, 1)
    return out, size, per_text


def with_neighbours(x: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Own features, then those of the line before and after; zeros with a flag at a text's edge."""
    n, d = x.shape
    ends = np.cumsum(per_text)
    first = np.zeros(n, bool)
    last = np.zeros(n, bool)
    first[ends - per_text] = True
    last[ends - 1] = True
    before = np.vstack([np.zeros((1, d), x.dtype), x[:-1]]) if n else x
    after = np.vstack([x[1:], np.zeros((1, d), x.dtype)]) if n else x
    before[first] = 0
    after[last] = 0
    return np.hstack([x, before, after, first[:, None], last[:, None], np.ones((n, 1))]).astype(np.float64)


@dataclass
class Crf:
    """Log-linear weights: ``node`` for label good, ``trans`` between labels
    (0 bad, 1 good). Without a training row of each label ``node`` is None and
    every score is ``prior``."""

    node: np.ndarray | None
    trans: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def marginals(self, x: np.ndarray, per_text: np.ndarray):
        """P(good) of every line, and the summed pair marginals."""
        z = np.clip(((x - self.mean) / self.scale) @ self.node, -50, 50)
        lay = layout(per_text)
        emit = np.empty((len(z), 2))
        emit[lay.slot, 1] = good = 1 / (1 + np.exp(-z))
        emit[lay.slot, 0] = 1 - good
        emit += 1e-30
        both = Pass(lambda a, b: emit[a:b].copy().T, lay, np.ones(2), np.exp(self.trans), keep=True)
        pairs = both.backward()
        return both.marginals()[1], pairs

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Length-weighted mean of the lines' marginals."""
        if self.node is None:
            return np.full(len(texts), self.prior)
        x, size, per_text = line_features(texts)
        good, _ = self.marginals(with_neighbours(x, per_text), per_text)
        weight = size + 1.0
        starts = np.cumsum(per_text) - per_text
        mean = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
        return np.clip(mean, 0.0, 1.0)


def fit(x: np.ndarray, per_text: np.ndarray, label: np.ndarray, rounds: int = 150, rate: float = 0.1, l2: float = 1e-3) -> Crf:
    """Maximum conditional likelihood by Adam; every document counts the same,
    however many lines it has."""
    full = with_neighbours(x, per_text)
    mean, scale = full.mean(axis=0), full.std(axis=0)
    const = scale < 1e-9
    mean[const], scale[const] = 0.0, 1.0
    model = Crf(np.zeros(full.shape[1]), np.zeros((2, 2)), mean, scale, 0.5)
    full = (full - mean) / scale
    y = np.repeat(label, per_text).astype(np.float64)
    weight = np.repeat(1.0 / per_text, per_text)
    # pair counts when all lines of a document have one label
    inner = float((per_text - 1).sum())
    held = np.zeros((2, 2))
    for k in (0, 1):
        held[k, k] = float((per_text[label == k] - 1).sum())
    n = len(per_text)
    moment = [np.zeros_like(model.node), np.zeros((2, 2))]
    square = [np.zeros_like(model.node), np.zeros((2, 2))]
    plain = Crf(model.node, model.trans, np.zeros(full.shape[1]), np.ones(full.shape[1]), 0.5)
    for t in range(1, rounds + 1):
        good, pairs = plain.marginals(full, per_text)
        grads = [
            full.T @ ((y - good) * weight) / n - l2 * plain.node,
            (held - pairs) / max(inner, 1.0) - 10 * l2 * plain.trans,
        ]
        for i, g in enumerate(grads):
            moment[i] = 0.9 * moment[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            step = rate * (moment[i] / (1 - 0.9**t)) / (np.sqrt(square[i] / (1 - 0.999**t)) + 1e-8)
            if i:
                plain.trans = plain.trans + step
            else:
                plain.node = plain.node + step
    return Crf(plain.node, plain.trans, mean, scale, float(label.mean()))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_docs: int = TRAIN_DOCS,
    max_lines: int = TRAIN_LINES,
    all_lines: int = ALL_LINES,
) -> Crf:
    """Fit on a sample of labelled documents outside the held-out fold: the
    ``max_docs`` labels first in the order of a hash of the id, without
    documents of over ``max_lines`` lines, as far as they have ``all_lines``
    lines together at most. Ids whose labels are null or contradict one another
    are left out; of several texts of one id the one with the fewest lines counts.
    Only the sample's line features reach the driver. Without a sample row of
    each label every score is (good rows + 1) / (rows + 2)."""
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (remainder(id_col, FOLDS) != HELD_OUT))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.min(label_col).alias("__low"), F.max(label_col).alias("__y"))
        .where("__low = __y")
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_docs)
        .select("__id", F.col("__y").cast("int").alias("__y"))
    )
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).join(F.broadcast(known), "__id")

    def run(part: pa.RecordBatch) -> dict:
        texts = texts_of(part, "__text")
        per_text = [t.count(b"\n") + 1 for t in texts]
        rows = [line_features([t])[0].tobytes() if n <= max_lines else None for t, n in zip(texts, per_text, strict=True)]
        return {"n": per_text, "x": rows}

    found = map_slices(sample, "__t", run, "n int, x binary", keep=["__id", "__y"]).where("x is not null")
    one = found.groupBy("__id", "__y").agg(F.min(F.struct("n", "x")).alias("k"))
    feats = materialise(one.select("__id", "__y", "k.n", "k.x", F.xxhash64("__id").alias("place")), "features")
    # one row for each document of the sample
    sizes = feats.groupBy("place").agg(F.sum("n").alias("n")).orderBy("place").toArrow()
    fits = np.cumsum(sizes.column("n").to_numpy()) <= all_lines
    until = int(sizes.column("place").to_numpy()[fits][-1]) if fits.any() else None
    got = feats.where(F.col("place") <= until if until is not None else F.lit(False)).toArrow()
    y = got.column("__y").to_numpy()
    if len(y) == 0 or y.min() == y.max():
        prior = (float(y.sum()) + 1) / (len(y) + 2)
        return Crf(None, np.zeros((2, 2)), np.zeros(0), np.zeros(0), prior)
    order = np.argsort(got.column("__id").to_numpy(), kind="stable")
    parts = got.column("x").to_pylist()
    mats = [np.frombuffer(parts[i], np.float32).reshape(-1, N_FEATURES) for i in order]
    return fit(np.vstack(mats), np.array([len(m) for m in mats]), y[order])


def quality_scores(
    docs: DataFrame, model: Crf, text_col: str = "text", keep: list[str] | None = None, score_col: str = "score"
) -> DataFrame:
    """Each row of ``docs`` with its score (0 to 1) added; ``keep`` names the
    columns to carry (all by default; one named ``score_col`` gives way). Null
    and empty texts are one empty line."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(part: pa.RecordBatch) -> dict:
        return {score_col: pa.array(Crf(**shared.value).scores(texts_of(part, "__text")), pa.float64())}

    return map_slices(docs, text_col, run, f"`{score_col}` double", keep)


def accept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, columns unchanged."""
    score = fresh("score", docs.columns)
    scored = quality_scores(docs, train(docs, labels), score_col=score)
    return scored.where(F.col(score) >= threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
