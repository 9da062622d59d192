import hashlib
import random

from helpers_llm import SMOKE, odd_docs, words
from pyspark.core.broadcast import Broadcast

from sparkmarts.llm.common import table
from sparkmarts.llm.decontaminate import contamination, remove_contaminated
from sparkmarts.llm.queries import op3_decontamination


def brute(text, items, width=10):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(width, len(iw))
        for i in range(len(iw) - n + 1) if n else ():
            for j in range(len(w) - n + 1):
                if w[j : j + n] == iw[i : i + n]:
                    hit |= set(range(j, j + n))
                    ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["a", "B", "ça", "d1", "e"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.randrange(0, 9))) for i in range(12)] + [(3, "a"), (50, None), (None, "d1 e"), (51, "!!")]
    docs = [(i, text(rng.randrange(0, 40))) for i in range(60)] + [(99, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    named = [("" if i is None else i, t) for i, t in items]
    one = {r.doc_id: r for r in contamination(d, b, width=4).collect()}
    many = {r.doc_id: r for r in contamination(d, b, width=4, pass_bytes=40).collect()}
    for i, t in docs:
        n, hit, n_items, _ = brute(t, named, 4)
        for got in (one[i], many[i]):
            assert (got.n_words, got.n_hit, len({s.item_id for s in got.spans})) == (n, hit, n_items)
        assert one[i].spans == many[i].spans
        for s in one[i].spans:
            assert words(t[s.start : s.end]) == words(t)[s.first_word : s.last_word + 1]


def test_query_on_given_tables(spark):
    items = [(r.item_id, r.text) for r in table(spark, SMOKE, "benchmark").collect()]
    texts = {r.doc_id: r.text for r in table(spark, SMOKE, "documents").collect()}
    grams = {}
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            grams.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    widths = {len(g) for g in grams}
    for r in op3_decontamination(spark, SMOKE).collect():
        w, hit, ids = words(texts[r.doc_id]), set(), set()
        for n in widths:
            for j in range(len(w) - n + 1):
                if (g := tuple(w[j : j + n])) in grams:
                    hit |= set(range(j, j + n))
                    ids |= grams[g]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(ids), digest, bool(hit))


def test_one_bounded_group_of_distinct_items_at_a_time(spark, monkeypatch):
    items = [(1, "a b c d e f g h i j")] * 200 + [(k, f"k{k} l m n o p q r s t") for k in range(2, 14)]
    b = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(i, f"x {t} y") for i, t in dict(items).items()], "doc_id long, text string")
    sizes, held = [], [0]
    broadcast, destroy = spark.sparkContext.broadcast, Broadcast.destroy

    def counted(value):
        sizes.append(sum(len(t) for _, t in value))
        held[0] += 1
        assert held[0] == 1
        return broadcast(value)

    def freed(self, *a):
        held[0] -= 1
        destroy(self, *a)

    monkeypatch.setattr(spark.sparkContext, "broadcast", counted)
    monkeypatch.setattr(Broadcast, "destroy", freed)
    got = {r.doc_id: [s.item_id for s in r.spans] for r in contamination(d, b, pass_bytes=100).collect()}
    assert got == {i: [str(i)] for i in dict(items)}
    assert sum(sizes) == sum(len(t) for t in dict(items).values()) and len(sizes) == 3


def test_odd_rows(spark):
    docs = odd_docs(spark)
    none = docs.selectExpr("doc_id item_id", "text").limit(0)
    assert contamination(docs, none, prefix="c_").where("c_n_hit > 0").count() == 0
    items = spark.createDataFrame([(1, "same TEXT here"), (2, "word " * 12)], "item_id long, text string")
    kept = remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 3
    assert remove_contaminated(docs.limit(0), items).count() == 0


def test_passes_write_only_texts_with_hits(spark, monkeypatch):
    """Ten passes take less room than the documents; columns with the names used inside stay."""
    import sparkmarts.llm.decontaminate as module

    items = spark.createDataFrame([(k, f"k{k} l m n o p q r s t") for k in range(20)], "item_id long, text string")
    names = "doc_id long, text string, __spans string, spans string, __n_hit long, __key string, __found string"
    rows = [(i, f"only words of its own {i}", "s", "p", 7, "k", "f") for i in range(500)]
    rows += [(1000 + k, f"x k{k} l m n o p q r s t k{k + 1} l m n o p q r s t", "s", "p", 7, "k", "f") for k in range(19)]
    rows += [(2000, None, "s", "p", 7, "k", "f"), *[(3000, "x k3 l m n o p q r s t", "s", "p", 7, "k", "f")] * 50]
    docs = spark.createDataFrame(rows, names)
    written = []
    plain = module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, name: written.append(plain(df, name)) or written[-1])
    got = contamination(docs, items, pass_bytes=40).collect()
    assert len(written) >= 9 and sum(t.count() for t in written) <= 2 * 20
    assert len(got) == len(rows)
    for r in got:
        want = {r.doc_id - 1000, r.doc_id - 999} if 1000 <= r.doc_id < 2000 else {3} if r.doc_id == 3000 else set()
        assert {int(s.item_id) for s in r.spans} == want
        assert (r["__spans"], r["__n_hit"], r["__key"], r["__found"]) == ("s", 7, "k", "f")
    kept = remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(rows[:500] + [rows[519]])
