"""Thin queries over the corpus operators, by the names that the driver's contract fixes."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html_extract, langid, license_scan, near_dup, repair, secret_scan, simhash, spelling, substring_dedup, topk, toxicity
from .common import crc_remainder, stash, table

#: The vocabulary whose ranks op3 uses; any file of base64 tokens and ranks will do.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "start", "stop", "n_words", "kept_in", F.size("clusters").cast("long").alias("n_clusters"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_remainder(F.col("doc_id")) == 2
    models = langid.train(docs, ~held_out)
    found = langid.identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secret_scan.scan(docs, ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] != "generic")
    number = lambda field, value: F.size(F.filter("spans", lambda s: s[field] == value)).cast("long").alias(f"n_{value}")
    counts = [number("kind", kind) for kind in secret_scan.BASE_KINDS]
    verdicts = [number("verdict", v) for v in ("live", "shared", "example")]
    return found.select("doc_id", *counts, F.sha2(secret_scan.written(base), 256).alias("base_sha256"), secret_scan.written(F.col("spans")).alias("spans"), *verdicts)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


#: A document is predicted toxic from this score on.
TOXIC_FROM = 0.3


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_remainder(F.col("doc_id")) == 2
    grammar = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score(docs, grammar)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "clauses")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns, and for documents whose id is divisible by 100 how many others are within the radius."""
    found = stash(simhash.sketch(table(spark, sf_dir, "documents").select("doc_id", "text")))
    asked = F.coalesce(F.col("id") % 100 == 0, F.lit(False))
    near = simhash.within(found, asked).select(F.col("fingerprint").alias("asked_for"), "n_within")
    # rows that are no queries have no key: joined, they would all meet in one task
    answered = found.where(asked).join(near, F.concat("fingerprint", F.lit("")) == F.col("asked_for"), "left").drop("asked_for")
    rows = answered.unionByName(found.where(~asked).withColumn("n_within", F.lit(None).cast("bigint")))
    return rows.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_within")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    written = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    return repair.with_unrepaired(repair.repair(repair.damage(rows, F.crc32(written.cast("binary")) % 20)), rows)


QUERIES = {"op1_substring_dedup": op1_substring_dedup, "op2_license_scan": op2_license_scan, "op3_byte_bpe": op3_byte_bpe, "op10_language_id": op10_language_id, "op4_exact_top_k": op4_exact_top_k, "op5_near_duplicates": op5_near_duplicates, "op6_html_extraction": op6_html_extraction, "op7_toxicity": op7_toxicity, "op8_decontamination": op8_decontamination, "op9_secret_scan": op9_secret_scan, "op11_spelling_variants": op11_spelling_variants, "op12_simhash": op12_simhash, "op13_conversation_repair": op13_conversation_repair}

#: Words, shingles and containment as SQL says them; ids of pairs with their counts.
OP8_SQL = r"""
WITH d AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
b AS (SELECT item_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
ds AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM d WHERE len(w) >= 5),
bs AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS s FROM b WHERE len(w) >= 5),
n AS (SELECT id, count(*) AS n FROM bs GROUP BY id)
SELECT ds.id AS doc_id, bs.id AS item_id, count(*) AS shared, n.n AS n_shingles, count(*) / n.n AS containment
FROM ds JOIN bs USING (s) JOIN n ON n.id = bs.id GROUP BY ds.id, bs.id, n.n HAVING count(*) >= ceil(n.n * 0.8 - 1e-9)
"""

OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

#: Links by shared shingles of full sets, components by reachability.
OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
u AS (SELECT doc_id, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.c >= 85 * (na.n + nb.n - p.c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
k AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT n.doc_id, n.n AS n_shingles, k.root AS component_id, n.doc_id = k.root AS kept FROM n JOIN k ON k.id = n.doc_id
"""

ORACLES: dict[str, str] = {"op4_exact_top_k": OP4_SQL, "op5_near_duplicates": OP5_SQL, "op8_decontamination": OP8_SQL}
