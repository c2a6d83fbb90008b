"""Exact duplicates by content sort.

1. Texts are normalised. One narrow pass stores (identifier, digest) and finds the few texts with very many copies.
2. The rows are range-partitioned by the normalised bytes: Spark samples splitters over (first characters, hash, salt), so
   that a splitter stays short however long the texts are. Only texts with many copies get more than one salt, which
   spreads their copies over several ranges, by row and not by identifier: copies without one are spread like any others.
3. An external sort by (first characters, hash, salt, whole text) puts equal texts next to each other, and a streaming
   aggregate compares each whole text with its neighbour's and keeps the smallest identifier and the count of each run.
4. The runs of one text (more than one only if it was salted) are put together, and narrow rows, salted in their turn, look their
   run up. Of the rows that hold the smallest identifier of a salted text one with the smallest salt stays.

Defined results: a missing text counts as empty; all empty texts are one group; a missing identifier is larger than any
other; of rows that repeat both identifier and text, one stays and the rest go; an empty table gives no rows. Other
columns of the input are not read, so they may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import single_spaced
from marketloom.session import durable

#: Copies of one text that one task may take. The threshold rises with the table so that no more than MAX_HOT texts lie
#: above it: that bounds the table of hot texts, which is broadcast.
HOT_ROWS, MAX_HOT = 2_000, 1_000_000
PREFIX = 24


def hot_keys(keys: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, __salts) of the keys with more than ``hot_rows`` rows; at most MAX_HOT rows, so it may be broadcast."""
    counted = keys.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    limit = max(hot_rows, keys.count() // MAX_HOT)
    return durable(
        counted.where(F.col("__n") > limit).select(key, F.ceil(F.col("__n") / limit).cast("int").alias("__salts")), "hot"
    )


def salted(df: DataFrame, hot: DataFrame, key: str, row: str) -> DataFrame:
    """Adds ``__salts`` (1 but for hot keys) and ``__salt`` from 0, by the number of the row."""
    joined = df.join(F.broadcast(hot), key, "left").withColumn("__salts", F.coalesce("__salts", F.lit(1)))
    return joined.withColumn("__salt", F.pmod(F.xxhash64(row), "__salts").cast("int"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the identifier, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of the normalised text."""
    rows = docs.select(F.col(id_col).alias("__id"), single_spaced(F.col(text_col)).alias("__text"))
    rows = rows.withColumn("__hash", F.xxhash64("__text")).withColumn("__row", F.monotonically_increasing_id())
    narrow = durable(rows.select("__id", "__row", "__hash", F.unhex(F.sha2("__text", 256)).alias("__sha")), "digests")
    hot = hot_keys(narrow, "__hash")

    ranges = ["__prefix", "__hash", "__salt"]
    keyed = salted(rows.withColumn("__prefix", F.substring("__text", 1, PREFIX)), hot, "__hash", "__row")
    runs = (
        keyed.repartitionByRange(*ranges)
        .sortWithinPartitions(*ranges, "__text", "__id")
        .groupBy(*ranges, "__text")
        # An aggregate over a struct cannot hash, so Spark walks the sorted rows and compares neighbours.
        .agg(F.min(F.struct(F.col("__id").isNull(), F.col("__id").alias("id"))).alias("__least"), F.count(F.lit(1)).alias("__n"), F.max("__salts").alias("__salts"))
    )
    runs = durable(
        runs.select(
            F.unhex(F.sha2("__text", 256)).alias("__sha"),
            F.when(F.col("__salts") > 1, F.col("__text")).alias("__hot_text"),
            "__least",
            "__n",
            "__salts",
        ),
        "runs",
    )
    groups = runs.groupBy("__sha", "__hot_text").agg(
        F.min("__least").alias("__least"), F.sum("__n").alias("group_size"), F.max("__salts").alias("__salts")
    )
    groups = groups.select(
        "__sha",
        F.col("__least.id").alias("keep_id"),
        "group_size",
        F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)).alias("__salt"),
    )
    spread = salted(narrow, hot, "__hash", "__row")
    copies = spread.groupBy("__id", "__sha", "__salt").agg(F.count(F.lit(1)).cast("int").alias("__copies"))
    # Rows that repeat the identifier that stays may have several salts.
    least = F.min(F.struct(F.col("__id").isNull(), "__id", "__salt")).alias("__least")
    first = spread.where("__salts > 1").groupBy("__sha").agg(least).select("__sha", F.col("__least.__salt").alias("__first"))
    groups = groups.join(first, "__sha", "left").withColumn("__first", F.coalesce("__first", F.lit(0)))
    found = copies.join(groups, ["__sha", "__salt"])
    return (
        found.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(
            F.col("__id").alias(id_col),
            "keep_id",
            "group_size",
            (F.col("__id").eqNullSafe(F.col("keep_id")) & (F.col("__salt") == F.col("__first")) & (F.col("__copy") == 1)).alias("kept"),
            F.lower(F.hex("__sha")).alias("text_sha256"),
        )
    )
