"""The report views (per day, category and customer) kept up to date by a stream of sales, without reading old sales again.

What is stored are cells: the sums, counts, and first and last dates per (day, customer) and per (category, customer). Cells of
different batches add up, so a batch costs one pass over its own rows, and the views are worked out from the cells:

- a day's and a category's distinct customers are its distinct cells, exact however often a customer comes back,
- a customer's view adds the cells of its days.

Each micro-batch publishes one version of the cells' table (``sources.snapshots``) that names the batch; a batch that runs again after a
failure finds itself there and adds nothing. A reader sees all three views at the same batch. ``compact`` adds up the cells of
all batches, so that their number is bounded by the days and categories of the customers and not by the batches.

The views equal ``operators.aggregates.daily_view``, ``category_view`` and ``customer_view`` over all sales taken so far. Rows without a day,
category or customer are in the views that do not need it; amounts are added as there, as decimals. Columns beyond the ones needed are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketloom.functions import amounts
from marketloom.operators.aggregates import AMOUNT, CUSTOMER, DATE, dense_days
from marketloom.session import durable
from marketloom.sources import snapshots

KEYS = ["view", "day", "category", "customer"]
DAY, CATEGORY = "day", "category"
SUM = "decimal(38,4)"


def cells(df: DataFrame) -> DataFrame:
    """The cells of some sales, from one scan with a grouping set for each kind."""
    rows = df.select(
        F.to_date(DATE).alias("day"),
        F.col("category"),
        F.col(CUSTOMER).alias("customer"),
        F.col(DATE).alias("at"),
        F.col(AMOUNT).cast(amounts.AMOUNT).alias("amount"),
        F.col("quantity").cast(amounts.AMOUNT).alias("items"),
    )
    grouped = rows.groupingSets([["day", "customer"], ["category", "customer"]], "day", "category", "customer").agg(
        F.when(F.grouping("category") == 1, DAY).otherwise(CATEGORY).alias("view"),
        F.sum("amount").cast(SUM).alias("amount"),
        F.count("amount").alias("amounts"),
        F.sum("items").cast(SUM).alias("items"),
        F.count("items").alias("item_rows"),
        F.min("at").alias("first"),
        F.max("at").alias("last"),
    )
    return grouped.select(*KEYS, "amount", "amounts", "items", "item_rows", "first", "last")


def _added(found: DataFrame, *keys: str) -> DataFrame:
    return found.groupBy(*keys).agg(
        F.sum("amount").cast(SUM).alias("amount"),
        F.sum("amounts").alias("amounts"),
        F.sum("items").cast(SUM).alias("items"),
        F.sum("item_rows").alias("item_rows"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )


def absorb(batch: DataFrame, number: int, target: str) -> None:
    """Take a micro-batch of sales into the cells at ``target``, once."""
    snapshots.append_batch(cells(batch), target, number)


def refresh(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Take all sales that have arrived since the last refresh."""
    return (
        stream.writeStream.foreachBatch(lambda batch, number: absorb(batch, number, target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact(spark: SparkSession, target: str) -> None:
    """One cell per key in place of one for every batch that has it; readers keep the version they opened."""
    snapshots.rewrite_snapshot(spark, target, lambda found: _added(found, *KEYS))


def _measures() -> list[Column]:
    return [
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("total_sales"),
        _mean(F.sum("amount"), F.sum("amounts")).alias("avg_transaction"),
        F.sum("amounts").alias("transaction_count"),
        F.coalesce(F.sum("items").cast("double"), F.lit(0.0)).alias("total_quantity"),
        _mean(F.sum("items"), F.sum("item_rows")).alias("avg_quantity"),
        F.count("customer").alias("unique_customers"),
    ]


def _mean(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count.cast("double"))


def _kind(found: DataFrame, view: str) -> DataFrame:
    return found.where(F.col("view") == view)


def daily(found: DataFrame) -> DataFrame:
    """The daily view from cells; days without sales have sums and counts 0."""
    merged = _added(_kind(found, DAY).where("day is not null"), "day", "customer")
    days = durable(merged.groupBy(F.col("day").alias("date")).agg(*_measures()), "daily")
    return dense_days(days)


def by_category(found: DataFrame) -> DataFrame:
    merged = _added(_kind(found, CATEGORY).where("category is not null"), "category", "customer")
    return merged.groupBy("category").agg(*_measures())


def by_customer(found: DataFrame) -> DataFrame:
    merged = _added(_kind(found, DAY).where("customer is not null"), "customer")
    return merged.select(
        F.col("customer").alias(CUSTOMER),
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("total_spent"),
        _mean(F.col("amount"), F.col("amounts")).alias("avg_transaction"),
        F.col("amounts").alias("transaction_count"),
        F.col("first").alias("first_purchase"),
        F.col("last").alias("last_purchase"),
    )


VIEWS = {"daily": daily, "category": by_category, "customer": by_customer}


def read_view(spark: SparkSession, target: str, view: str, version: int | None = None) -> DataFrame:
    """A view as of the newest batch, or of an earlier version of the cells."""
    if view not in VIEWS:
        raise ValueError(f"unknown view: {view}")
    return VIEWS[view](snapshots.read_snapshot(spark, target, version))
