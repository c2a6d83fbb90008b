"""The registered queries of the corpus operators, with their oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import language_id, quality, vector_codes
from marketloom.llm.common import held_out, table
from marketloom.llm.decontaminate import contamination
from marketloom.llm.exact_dedup import exact_duplicates
from marketloom.llm.mixing import schedule, size_of
from marketloom.llm.preferences import format_pairs, mismatched
from marketloom.llm.sharding import documents_by_text, shard_documents
from marketloom.llm.simhash import near_duplicates
from marketloom.llm.substring_dedup import passages
from marketloom.llm.token_alignment import aligned
from marketloom.llm.token_counts import token_counts
from marketloom.llm.warc import archived
from marketloom.session import durable


def op1_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 4, 2))
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 4, 2))
    # Every text's features are worked out once, for learning and for scoring.
    docs = durable(docs.select("doc_id", "held_out", quality.shape("text").alias("x")), "shapes")
    model = quality.fit(docs.where(~F.col("held_out")), labels, shape_col="x")
    scored = docs.select("doc_id", "held_out", quality.quality_scores(docs, model, shape_col="x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


def op2_content_addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("size", size_of(F.col("text")))
    return schedule(docs.select("doc_id", "source", "size"), F.col("size"))


def op4_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(documents_by_text(table(spark, sf_dir, "documents")))
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_ngram_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))


def op7_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = format_pairs(mismatched(table(spark, sf_dir, "conversations")))
    return found.withColumnRenamed("pair", "conv_id")


def op8_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    model = language_id.fit(docs.where(~F.col("held_out")))
    found = docs.select("doc_id", "held_out", language_id.identify(docs, model).alias("x"))
    return found.select(
        "doc_id", "held_out", F.col("x.lang").alias("lang_pred"), F.col("x.score").alias("score"), F.col("x.rejected").alias("rejected")
    )


def op9_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("id").alias("doc_id"), fingerprint.alias("fingerprint"), F.col("component").alias("component_id"))


def op10_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_pair_merging(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return found.withColumnRenamed("id", "doc_id")


def op12_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aligned(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return found.select(F.col("id").alias("doc_id"), *columns)


ORACLE_10 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id
  AND row_number() OVER (PARTITION BY t.norm ORDER BY t.doc_id) = 1 AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""

ORACLE_2 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first,
  row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS place FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND place > 1 THEN first END AS refers_to
FROM r
"""

QUERIES = {
    "op1_bradley_terry": op1_bradley_terry,
    "op2_content_addressed": op2_content_addressed,
    "op3_pfair_mix": op3_pfair_mix,
    "op4_label_propagation": op4_label_propagation,
    "op5_collinear_chains": op5_collinear_chains,
    "op6_ngram_set": op6_ngram_set,
    "op7_preference_pairs": op7_preference_pairs,
    "op8_nearest_centroid": op8_nearest_centroid,
    "op9_simhash_pigeonhole": op9_simhash_pigeonhole,
    "op10_content_sort": op10_content_sort,
    "op11_pair_merging": op11_pair_merging,
    "op12_gnat_codes": op12_gnat_codes,
    "op13_galloping_alignment": op13_galloping_alignment,
}

ORACLES = {
    "op2_content_addressed": ORACLE_2,
    "op10_content_sort": ORACLE_10,
    "op12_gnat_codes": vector_codes.oracle(),
}
