"""Streaming jobs. Each takes what has arrived, then stops (``availableNow``); the checkpoint remembers what was done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketloom.functions import amounts


def read_folder(
    spark: SparkSession, folder: str, schema: T.StructType, kind: str = "parquet", pattern: str | None = None, **options
) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format(kind).load(folder)


def append(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table; files already taken are not taken again."""
    return (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def upsert(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the rows that a stream updates, one folder per micro-batch; a batch that runs again replaces its folder.

    ``current`` reads the table. In update mode windows appear as soon as they have rows, also the last ones, which a watermark
    never passes.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def current(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The newest version of every row of an ``upsert`` table."""
    rows = spark.read.parquet(target)
    values = [c for c in rows.columns if c not in keys and c != "batch"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__row"))
    return newest.select(*keys, "__row.*")


def windowed_kpis(
    stream: DataFrame,
    timestamp: str,
    amount: str,
    customer: str | None = None,
    window: str = "1 day",
    delay: str = "1 day",
) -> DataFrame:
    """Sales, transactions and mean per tumbling window; a window is final once the watermark has passed it.

    Written with ``append`` only final windows appear; ``upsert`` writes all of them.

    Streams cannot count distinct values exactly; with ``customer`` the count is approximate.
    """
    measures = [
        amounts.total(amount).alias("total_sales"),
        amounts.row_count().alias("transaction_count"),
        amounts.mean(amount).alias("avg_transaction"),
    ]
    if customer:
        measures.append(F.approx_count_distinct(customer).alias("approx_customers"))
    return (
        stream.withColumn("__time", F.col(timestamp).cast("timestamp"))
        .withWatermark("__time", delay)
        .groupBy(F.window("__time", window).alias("__window"))
        .agg(*measures)
        .select(
            F.col("__window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("__window.end").cast("timestamp_ntz").alias("window_end"),
            *["total_sales", "transaction_count", "avg_transaction", *(["approx_customers"] if customer else [])],
        )
    )


def deduplicated(stream: DataFrame, keys: list[str], timestamp: str, delay: str = "1 day") -> DataFrame:
    """Drop copies that arrive within the delay; only keys inside the watermark are remembered."""
    timed = stream.withColumn("__time", F.col(timestamp).cast("timestamp")).withWatermark("__time", delay)
    return timed.dropDuplicatesWithinWatermark(keys).drop("__time")
