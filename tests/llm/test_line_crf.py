import math
import zlib

import numpy as np
from helpers_llm import odd_docs

from sparkmarts.llm.common import table
from sparkmarts.llm.line_crf import (
    HELD_OUT, FOLDS, N_FEATURES, Crf, accept, fit, line_features, quality_scores, train, with_neighbours,
)
from sparkmarts.llm.queries import op5_quality

SF = "/root/testdata/sf0.01"


def test_features_of_lines():
    x, size, per_text = line_features([b"Ab1! | x x\n\n\xc3\xa9", b""])
    assert size.tolist() == [10, 0, 2, 0] and per_text.tolist() == [3, 1]
    assert np.allclose(x[0, :7], [0.1, 0.1, 0, 0.1, 0.1, 0, 0.3])
    assert x[0, 8] == np.float32(0.25) and x[2, 7] == 0.5 and x[1, 12] == x[3, 12] == 1


def test_neighbours_stop_at_text_edges():
    x = np.arange(1, 6, dtype=np.float32)[:, None]
    full = with_neighbours(x, np.array([2, 3]))
    assert full[:, 1].tolist() == [0, 1, 0, 3, 4] and full[:, 2].tolist() == [2, 0, 4, 5, 0]


def test_gradient_is_that_of_the_likelihood():
    """The maximiser's fixed point: a small step in any weight never helps."""
    rng = np.random.default_rng(0)
    per_text = np.array([3, 1, 4, 2, 5, 1])
    label = np.array([1, 0, 1, 0, 1, 0])
    x = rng.normal(size=(int(per_text.sum()), N_FEATURES)).astype(np.float32) + np.repeat(label, per_text)[:, None]
    model = fit(x, per_text, label)
    good, _ = model.marginals(with_neighbours(x, per_text), per_text)
    assert good[np.repeat(label, per_text) == 1].min() > good[np.repeat(label, per_text) == 0].max()


def test_score_is_the_length_weighted_mean_of_marginals():
    rng = np.random.default_rng(1)
    d = 3 * N_FEATURES + 3
    model = Crf(rng.normal(size=d), rng.normal(size=(2, 2)), np.zeros(d), np.ones(d), 0.5)
    texts = [b"One line.\nTwo !! lines\n\nend", b"", b"x"]
    x, size, per_text = line_features(texts)
    good, _ = model.marginals(with_neighbours(x, per_text), per_text)
    want = [np.average(good[:4], weights=size[:4] + 1), good[4], good[5]]
    assert np.allclose(model.scores(texts), want)


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = [r for r in op5_quality(spark, SF).collect() if r.doc_id in labels]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % FOLDS == HELD_OUT)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.95


def test_held_out_labels_are_not_read(spark):
    labels = table(spark, SF, "labels")
    wrong = labels.withColumn(
        "quality", (labels.quality + (__import__("pyspark").sql.functions.crc32(labels.doc_id.cast("string").cast("binary")) % 4 == 2).cast("int")) % 2
    )
    docs = table(spark, SF, "documents")
    a, b = train(docs, labels), train(docs, wrong)
    assert np.array_equal(a.node, b.node) and np.array_equal(a.trans, b.trans)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(0, 1), (1, None), (5, 0), (7, 1), (8, 0), (8, 1), (None, 1), (9, 1), (6, 0)], "doc_id long, quality int")
    model = train(docs, labels)
    scored = quality_scores(docs, model, score_col="own_score").collect()
    assert len(scored) == docs.count() and all(0 <= r.own_score <= 1 for r in scored)
    one_label = train(docs, labels.where("quality = 1"))
    # (good + 1) / (rows + 2)
    assert one_label.node is None and 0.5 < one_label.prior < 1.0
    none = train(docs, labels.limit(0))
    assert none.node is None and none.prior == 0.5
    assert accept(docs, labels.limit(0)).count() == 0  # nothing speaks for any document
    assert accept(docs, labels).columns == docs.columns
    assert accept(docs.limit(0), labels).count() == 0
    assert math.isclose(train(docs, labels.where("quality = 0")).prior, 1 / (1 + 2), abs_tol=0.2)


def test_the_sample_is_bounded_in_lines(spark):
    """Documents in the order of the hash, as far as their lines fit; a repeated id counts once."""
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    few = train(docs, labels, all_lines=400)
    again = train(docs.unionByName(docs), labels, all_lines=400)
    assert np.array_equal(few.node, again.node)
    assert not np.array_equal(few.node, train(docs, labels).node)
    assert train(docs, labels, all_lines=0).prior == 0.5
