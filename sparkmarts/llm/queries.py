"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmarts.llm.block_knn import nearest
from sparkmarts.llm.collocations import collocations
from sparkmarts.llm.common import remainder, table
from sparkmarts.llm.decontaminate import contamination, items_digest
from sparkmarts.llm.fill_middle import fill_middle, restore
from sparkmarts.llm.flat_graph import near_duplicates
from sparkmarts.llm.hmm_lm import hmm_scores
from sparkmarts.llm.html_render import extract
from sparkmarts.llm.license_templates import licenses
from sparkmarts.llm.line_crf import FOLDS, HELD_OUT, THRESHOLD, quality_scores, train
from sparkmarts.llm.packing import pack
from sparkmarts.llm.secret_scan import base_digest, secrets
from sparkmarts.llm.simhash_bktree import simhash_groups
from sparkmarts.llm.warc_derive import derivatives, responses


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scores(table(spark, sf_dir, "documents"), remainder("doc_id", 5) == 1)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    ids = F.array_distinct(F.transform("spans", lambda s: s["item_id"]))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("bigint").alias("n_items"),
        items_digest(F.col("spans")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = quality_scores(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    spans = F.col("spans")
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(base_digest(spans, ("assign", "access", "hex")), 256).alias("base_sha256"),
        base_digest(spans).alias("spans"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = derivatives(responses(table(spark, sf_dir, "pages")), "page_id")
    return made.withColumn("record", F.decode("record", "UTF-8"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("matches")


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_hmm_lm": op2_hmm_lm,
    "op3_decontamination": op3_decontamination,
    "op4_html": op4_html,
    "op5_quality": op5_quality,
    "op6_nearest": op6_nearest,
    "op7_simhash": op7_simhash,
    "op8_secrets": op8_secrets,
    "op9_warc": op9_warc,
    "op10_licenses": op10_licenses,
    "op11_near_vectors": op11_near_vectors,
    "op12_fill_middle": op12_fill_middle,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+')"
)

#: DuckDB SQL of the queries that SQL can express over whole tables. A trained
#: model, XXH64, checksums, template automata and markup cannot be: the tests
#: hold those against brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT item, least(len(w), 10) AS n, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM items WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM item_windows),
widths AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs JOIN widths ON len(w) >= n),
hits AS (
  SELECT doc_id, i, n, item
  FROM (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM places) JOIN grams USING (n, gram)),
touched AS (SELECT doc_id, unnest(range(i, i + n)) AS word FROM (SELECT DISTINCT doc_id, i, n FROM hits)),
n_touched AS (SELECT doc_id, COUNT(DISTINCT word) AS n_hit FROM touched GROUP BY 1),
found AS (
  SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(t.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(t.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN n_touched t USING (doc_id) LEFT JOIN found f USING (doc_id)
""",
    "op6_nearest": """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and([c IS NOT NULL AND isfinite(c) FOR c IN embedding])
    AND list_bool_or([c <> 0 FOR c IN embedding])),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 20
""",
    "op12_fill_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
         CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || t[1:lo] || '<S>' || t[hi + 1:] || '<M>' || t[lo + 1:hi]
              ELSE '<S>' || t[hi + 1:] || '<P>' || t[1:lo] || '<M>' || t[lo + 1:hi] END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY 1),
lengths AS (SELECT unnest([1, 2, 3, 4]) AS k),
occurrences AS (
  SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM worded JOIN lengths ON len(w) >= k),
f AS (
  SELECT lang, w[i : i + k - 1] AS p, CAST(count(*) AS HUGEINT) AS a FROM occurrences GROUP BY 1, 2 HAVING count(*) >= 30),
cands AS (SELECT * FROM f WHERE len(p) > 1),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM cands),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r, 2000000 * c.a // (x.a + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : c.k] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1 :]),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS nth FROM scored) WHERE nth = 1),
inside AS (
  SELECT lang, a, p, m, unnest(range(1, len(p) - m + 2)) AS i
  FROM (SELECT lang, a, p, unnest(range(2, len(p))) AS m FROM cands WHERE len(p) > 2)),
longer AS (SELECT lang, p[i : i + m - 1] AS p, max(a) AS a FROM inside GROUP BY 1, 2),
kept AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, b.l, b.r, b.score
  FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.p = b.p WHERE g.a IS NULL OR 100 * g.a < 80 * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
""",
}
