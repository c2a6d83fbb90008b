"""A corpus from raw documents to shards, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet; the next one reads it as its docs.
All but the last return the columns of ``documents``.

1. language ID: documents that the operator rejects go, and ``lang`` becomes the language it found.
2. SimHash near-dedup: of each component the document with the smallest doc_id stays.
3. benchmark decontamination: documents with a word inside a benchmark window go.
4. mixing: rows in the order of the mix; documents of sources that the weights raise come again in later epochs.
5. sharding: every row gets its shard and its place there.

Defined results: rows with a missing doc_id run through all stages; of rows that repeat doc_id and text, one passes stage 2;
an empty table gives empty stages. Columns beyond those of ``documents`` are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import language_id
from marketloom.llm.common import held_out, table
from marketloom.llm.decontaminate import clean_documents
from marketloom.llm.mixing import mixed
from marketloom.llm.sharding import documents_by_text, shard_documents
from marketloom.llm.simhash import fingerprints, near_duplicates
from marketloom.session import durable

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs.where(~held_out(F.col("doc_id"), 3, 1)))
    found = docs.select(*COLUMNS, language_id.identify(docs, model).alias("__found"))
    return found.where(~F.col("__found.rejected")).withColumn("lang", F.col("__found.lang")).select(COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = durable(near_duplicates(docs), "near-duplicates")
    # Identifiers of one row each are looked up alone; the others, if any, together with their text's fingerprint.
    shared = durable(found.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").select("id"), "shared")
    gone = durable(found.where("id <> component or id is null").select(F.col("id").alias("__id")).distinct(), "gone")
    if shared.isEmpty():
        return docs.join(gone, docs["doc_id"] == F.col("__id"), "left_anti").select(COLUMNS)
    shared = shared.withColumnRenamed("id", "__id")
    single = docs.join(shared, docs["doc_id"].eqNullSafe(F.col("__id")), "left_anti")
    single = single.join(gone, single["doc_id"] == F.col("__id"), "left_anti")
    several = docs.join(shared, docs["doc_id"].eqNullSafe(F.col("__id")), "left_semi").withColumn("__fp", fingerprints(F.col("text")))
    # A component keeps one row: of its smallest identifier, the smallest fingerprint.
    keep = found.where(F.col("id").eqNullSafe(F.col("component"))).groupBy("id", "root").agg(F.min("fp").alias("__kept"))
    keep = keep.select(F.col("id").alias("__id"), "__kept")
    several = several.join(keep, several["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__kept")), "left_semi")
    several = several.dropDuplicates(["doc_id", "__fp"])
    return single.select(COLUMNS).unionByName(several.select(COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs.select(COLUMNS))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = shard_documents(documents_by_text(docs))
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", "law", "shard", "slot")


STAGES = [
    ("language ID", language_identification),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", sharding),
]

#: Several stages (clusters, components, label propagation) have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; every stage but the last is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
