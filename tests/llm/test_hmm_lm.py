import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers_llm import SMOKE, odd_docs, tokens
from pyspark.sql import functions as F

from sparkmarts.llm.chain import Pass, layout
from sparkmarts.llm.common import table
from sparkmarts.llm.hmm_lm import _pack, _unpack, _zstd, coded, ending_classes, hmm_scores
from sparkmarts.llm.queries import op2_hmm_lm


def random_model(rng, states, items):
    start, trans, emit = rng.random(states), rng.random((states, states)), rng.random((items, states))
    return start, trans, emit


def test_recursions_against_all_paths():
    rng = np.random.default_rng(3)
    start, trans, emit = random_model(rng, 3, 11)
    lens = np.array([4, 1, 5, 1])
    lay = layout(lens)
    ordered = np.empty((3, 11))
    ordered[:, lay.slot] = emit.T
    both = Pass(lambda a, b: ordered[:, a:b].copy(), lay, start, trans, keep=True)
    logs = both.logs
    assert np.array_equal(logs, Pass(lambda a, b: ordered[:, a:b].copy(), lay, start, trans, keep=False).logs)
    pairs, gamma = both.backward(), both.marginals().T
    symbols = np.arange(11) % 4
    placed = np.empty(11, int)
    placed[lay.slot] = symbols
    assert np.allclose(both.by_symbol(placed, 4, piece=3), [gamma[symbols == s].sum(axis=0) for s in range(4)])
    want_pairs = np.zeros((3, 3))
    at = 0
    for s, n in enumerate(lens):
        weight, state, two = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = start[path[0]] * emit[at, path[0]]
            for i in range(1, n):
                p *= trans[path[i - 1], path[i]] * emit[at + i, path[i]]
            weight += p
            for i, k in enumerate(path):
                state[i, k] += p
            for a, b in itertools.pairwise(path):
                two[a, b] += p
        assert math.isclose(logs[s], math.log(weight), rel_tol=1e-12)
        assert np.allclose(gamma[at : at + n], state / weight)
        want_pairs += two / weight
        at += n
    assert np.allclose(pairs, want_pairs)


def test_long_sequences_stay_in_range():
    rng = np.random.default_rng(5)
    lens = np.array([500, 3, 77, 16, 17, 500])
    start, trans, _ = random_model(rng, 4, 1)
    emit = rng.random((4, int(lens.sum()))) * 10.0 ** -rng.integers(0, 12, size=int(lens.sum()))
    lay = layout(lens)
    ordered = np.empty_like(emit)
    ordered[:, lay.slot] = emit
    both = Pass(lambda a, b: ordered[:, a:b].copy(), lay, start, trans, keep=True)
    at = 0
    for s, n in enumerate(lens):
        alpha, log = start, 0.0
        for i in range(n):
            alpha = (alpha if i == 0 else alpha @ trans) * emit[:, at + i]
            log += math.log(alpha.sum())
            alpha = alpha / alpha.sum()
        assert math.isclose(both.logs[s], log, rel_tol=1e-12)
        at += n
    pairs = both.backward()
    assert np.allclose(both.marginals().sum(axis=0), 1) and math.isclose(pairs.sum(), (lens - 1).sum(), rel_tol=1e-9)


def base_of(rows):
    """rows: (id, held, text) -> {id: (n_tokens, n_known, base)}, N."""
    count = Counter()
    for _, held, t in rows:
        if not held:
            count.update([*tokens(t), ""])
    n, v = sum(count.values()), len(count)
    out = {}
    for i, _, t in rows:
        ts = [*tokens(t), ""]
        out[i] = len(ts), sum(count[w] > 0 for w in ts), sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts)
    return out, n, v


def test_query_counts_and_base_scores(spark):
    docs = [(r.doc_id, zlib.crc32(str(r.doc_id).encode()) % 5 == 1, r.text) for r in table(spark, SMOKE, "documents").collect()]
    want, n, _ = base_of(docs)
    held = dict((i, h) for i, h, _ in docs)
    rows = op2_hmm_lm(spark, SMOKE).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], *want[r.doc_id][:2], n)
        assert math.isclose(r.base_score, want[r.doc_id][2], rel_tol=1e-9)
    # latent states predict held-out texts better than word frequencies
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out) * 0.97


def test_likelihood_rises_and_chunks_do_not_matter(spark):
    docs = table(spark, SMOKE, "documents").repartition(3)
    held = F.lit(False)
    total = lambda **o: hmm_scores(docs, held, classes=64, own_share=1e-3, **o).agg(F.sum("score")).first()[0]
    a, b, c = (total(rounds=r, chunk_bytes=50_000) for r in (0, 2, 5))
    assert a < b < c
    assert math.isclose(b, total(rounds=2, chunk_bytes=10 << 20), rel_tol=1e-9)


@pytest.mark.parametrize("rounds", [0, 3])
def test_probabilities_of_all_short_texts_sum_to_one(spark, rounds):
    """All texts of up to two tokens over the vocabulary and one unknown word,
    plus the mass of the longer prefixes, make up everything."""
    train = ["a b a", "b c", "a", "c c a b", "b"]
    known = ["a", "b", "c"]
    words = [*known, "unseen"]
    shorts = [""] + words + [f"{x} {y}" for x in words for y in words]
    rows = [(i, False, t) for i, t in enumerate(train)] + [(100 + i, True, t) for i, t in enumerate(shorts)]
    df = spark.createDataFrame(rows, "doc_id long, held boolean, text string")
    got = {r.doc_id: r for r in hmm_scores(df, F.col("held"), states=2, rounds=rounds, own_share=0.2, classes=4).collect()}
    p = {t: 10 ** got[100 + i].score for i, t in enumerate(shorts)}
    end = p[""]
    assert 0 < sum(p.values()) < 1
    # prefix masses: P(first = w) = P(w end) + sum of P(w x ...) -> bounded by what is left
    assert end + sum(p[w] for w in words) < 1
    base = {t: 10 ** got[100 + i].base_score for i, t in enumerate(shorts)}
    assert math.isclose(sum(base[w] for w in words) / base[""] + base[""], 1.0, rel_tol=1e-9)


def test_rare_words_have_statistics_of_their_own(spark):
    """Two words of like ending and count, one in 15,000 tokens each, that stand in different contexts."""
    left, right = "l1 l2 l3 l4 " * 4, "r1 r2 r3 r4 " * 4
    train = [left] * 1600 + [right] * 1600 + [left + "xaing " + left] * 4 + [right + "ybing " + right] * 4
    probes = [left + "xaing", left + "ybing", right + "ybing", right + "xaing"]
    rows = [(i, False, t) for i, t in enumerate(train)] + [(10_000 + i, True, t) for i, t in enumerate(probes)]
    df = spark.createDataFrame(rows, "doc_id long, held boolean, text string").repartition(3)
    got = {r.doc_id: r.score for r in hmm_scores(df, F.col("held"), chunk_bytes=50_000).filter("held_out").collect()}
    own_left, other_left, own_right, other_right = (got[10_000 + i] for i in range(4))
    assert own_left > other_left + 0.5 and own_right > other_right + 0.5


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = hmm_scores(docs, F.col("doc_id") % 5 == 1, rounds=2)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert next(r.n_tokens for r in rows if r.doc_id == 5) == 30_001
    assert hmm_scores(docs.limit(0), F.lit(True)).count() == 0
    untrained = hmm_scores(docs, F.lit(True), rounds=1).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in untrained} == {(0, 0, 0.0, 0.0)}


def test_pairs_over_pieces_and_equal_steps(monkeypatch):
    """Sums over runs of steps with as many sequences, whatever the piece, against each sequence alone."""
    rng = np.random.default_rng(7)
    lens = np.array([40, 40, 1, 17, 33, 40, 16])
    start, trans, emit = random_model(rng, 3, int(lens.sum()))
    want = np.zeros((3, 3))
    for a, n in zip(np.cumsum(lens) - lens, lens, strict=True):
        one = Pass(lambda i, j, a=a: emit[a + i : a + j].T.copy(), layout(np.array([n])), start, trans, keep=True)
        want += one.backward()
    lay = layout(lens)
    ordered = np.empty_like(emit.T)
    ordered[:, lay.slot] = emit.T
    for piece in (1, 20, 1 << 13):
        monkeypatch.setattr("sparkmarts.llm.chain.PIECE", piece)
        both = Pass(lambda i, j: ordered[:, i:j].copy(), lay, start, trans, keep=True)
        assert np.allclose(both.backward(), want) and np.allclose(both.marginals().sum(axis=0), 1)


def test_words_and_classes_of_a_chunk_against_plain_code():
    texts = ["  Ab\tc\n\x0bd  ab ", "", None, "É x \x1c y\x00z \x00\x00", "c c", "a bc def ghij klmno"]
    plain = [[*tokens(t), ""] for t in texts]
    names = list(dict.fromkeys(["", *itertools.chain.from_iterable(plain)]))
    words, codes, lens = coded(pa.array(texts, pa.string()).fill_null(""))
    assert words.to_pylist() == names and lens.tolist() == [len(p) for p in plain]
    assert codes.tolist() == [names.index(w) for p in plain for w in p]
    raw = [w.encode() for w in names]
    want = [xxhash.xxh32_intdigest(w[-3:] + bytes([min(len(w), 4)])) % 97 for w in raw]
    assert ending_classes(words, 97).tolist() == want and ending_classes(words[1:], 97).tolist() == want[1:]


def test_compressors_are_made_once():
    packed = _pack(np.arange(10))
    assert _zstd() is _zstd() and _pack(np.arange(10)) == packed and _unpack(packed, np.int64).tolist() == list(range(10))
