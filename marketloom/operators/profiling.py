"""Data-quality reports. Each report scans its input once (quantiles excepted) and returns a small DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import amounts
from marketloom.operators.ordering import ascending
from marketloom.operators.quantiles import quantiles
from marketloom.schema import float_columns, numeric_columns, other_columns


def is_missing(df: DataFrame, column: str):
    """Null, or NaN in a floating-point column."""
    value = F.col(column)
    return value.isNull() | F.isnan(value) if column in set(float_columns(df)) else value.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NaN missing, so that sums, means and extremes skip it."""
    names = float_columns(df)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names}) if names else df


def unpivot(df: DataFrame, per_column: dict[str, Sequence], fields: Sequence[str]) -> DataFrame:
    """Turn a one-row frame into one row per column; ``per_column`` gives the expressions for ``fields``."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[v.alias(f) for f, v in zip(fields, values)])
            for c, values in per_column.items()
        ]
    )
    return df.select(F.inline(rows))


def schema_check(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per column name: ``match`` (right place), ``moved``, ``missing`` or ``extra``."""
    have, expected = df.columns, list(expected)

    def status(name: str) -> str:
        if name not in have:
            return "missing"
        if name not in expected:
            return "extra"
        return "match" if have.index(name) == expected.index(name) else "moved"

    rows = [(c, status(c)) for c in [*expected, *[c for c in have if c not in expected]]]
    return df.sparkSession.createDataFrame(rows, "column string, status string")


def shape_and_types(df: DataFrame) -> DataFrame:
    fields = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
            for i, f in enumerate(df.schema.fields)
        ]
    )
    counted = df.agg(amounts.row_count().alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))
    return counted.select(F.inline(fields), "row_count", "column_count")


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column: count and percent of the rows."""
    columns = list(columns or df.columns)
    counts = df.agg(
        amounts.row_count().alias("__rows"),
        *[F.count(F.when(is_missing(df, c), 1)).alias(f"__m_{i}") for i, c in enumerate(columns)],
    )
    share = lambda i: F.try_divide(F.col(f"__m_{i}") * 100.0, F.col("__rows").cast("double"))
    return unpivot(
        counts,
        {c: [F.col(f"__m_{i}"), share(i)] for i, c in enumerate(columns)},
        ["missing_count", "missing_percent"],
    )


def missing_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing counts before and after a cleaning step; null where a column exists on one side only."""
    b = missing_report(before).select("column", F.col("missing_count").alias("missing_before"))
    a = missing_report(after).select("column", F.col("missing_count").alias("missing_after"))
    return b.join(a, "column", "full")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """count, mean, sample standard deviation, min, quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    df = nan_to_null(df.select(*columns))
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75], exact)
    stats = df.agg(
        *[
            e.alias(f"__{k}_{i}")
            for i, c in enumerate(columns)
            for k, e in (
                ("count", F.count(c)),
                ("mean", amounts.mean(F.col(c).cast("double"), exact=False)),
                ("std", F.stddev_samp(F.col(c).cast("double"))),
                ("min", F.min(c).cast("double")),
                ("max", F.max(c).cast("double")),
            )
        ]
    )

    def fields(i: int, c: str):
        lit = [F.lit(q).cast("double") for q in quartiles[c]]
        one = lambda k: F.col(f"__{k}_{i}")
        return [one("count"), one("mean"), one("std"), one("min"), *lit, one("max")]

    return unpivot(
        stats,
        {c: fields(i, c) for i, c in enumerate(columns)},
        ["count", "mean", "std", "min", "p25", "p50", "p75", "max"],
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value) for all given columns in one shuffle; missing values are left out.

    Counted per task before the shuffle, so a value that fills a third of the rows costs one row per task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(amounts.row_count().alias("rows"))
    )


def top_values(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent values per column of ``value_counts``, ties by value; adds ``rank``.

    The window keeps k rows per column in every task before it shuffles (a window group limit), so it does not gather a
    column's values.
    """
    by_count = Window.partitionBy("column").orderBy(F.desc("rows"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= k)


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None, k: int = 3) -> DataFrame:
    """Number of distinct values and the ``k`` most frequent ones per non-numeric column."""
    counts = value_counts(df, list(columns or other_columns(df)))
    distinct = counts.groupBy("column").agg(amounts.row_count().alias("distinct_count"))
    return top_values(counts, k).join(distinct, "column").select("column", "distinct_count", "rank", "value", "rows")


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date")).withColumn(
        "days", F.datediff("last_date", "first_date")
    )


def sales_metrics(df: DataFrame, amount: str = "total_amount", customer: str = "customer_id") -> DataFrame:
    return df.agg(
        amounts.total(amount).alias("total_sales"),
        amounts.mean(amount).alias("avg_transaction"),
        F.countDistinct(customer).alias("unique_customers"),
    )


def finite_check(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Infinite and missing values left per numeric column; ``ready`` if there are none."""
    columns = list(columns or numeric_columns(df))
    infinite = F.lit(float("inf"))
    counts = df.agg(
        *[F.count(F.when(F.abs(F.col(c).cast("double")) == infinite, 1)).alias(f"__i_{i}") for i, c in enumerate(columns)],
        *[F.count(F.when(is_missing(df, c), 1)).alias(f"__m_{i}") for i, c in enumerate(columns)],
    )
    return unpivot(
        counts,
        {
            c: [F.col(f"__i_{i}"), F.col(f"__m_{i}"), ((F.col(f"__i_{i}") + F.col(f"__m_{i}")) == 0).cast("int")]
            for i, c in enumerate(columns)
        },
        ["infinite_count", "missing_count", "ready"],
    )


def sample_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*ascending(order)).limit(n)


REPORT = T.StructType(
    [
        T.StructField("step", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def cleaning_report(before: DataFrame, after: DataFrame, outliers: DataFrame | None = None) -> DataFrame:
    """What a cleaning run changed, as rows of (step, column, metric, value)."""
    rows = before.agg(amounts.row_count().alias("b")).join(after.agg(amounts.row_count().alias("a")), F.lit(True))
    counts = rows.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("rows").alias("step"),
                        F.lit(None).cast("string").alias("column"),
                        F.lit(m).alias("metric"),
                        v.cast("double").alias("value"),
                    )
                    for m, v in (
                        ("rows_before", F.col("b")),
                        ("rows_after", F.col("a")),
                        ("rows_removed", F.col("b") - F.col("a")),
                    )
                ]
            )
        )
    )

    def missing(df: DataFrame, step: str) -> DataFrame:
        return missing_report(df).select(
            F.lit(step).alias("step"), "column", F.lit("missing_count").alias("metric"), F.col("missing_count").cast("double").alias("value")
        )

    report = counts.unionByName(missing(before, "missing_before")).unionByName(missing(after, "missing_after"))
    if outliers is not None:
        report = report.unionByName(
            outliers.select(
                F.lit("outliers").alias("step"),
                "column",
                F.col("method").alias("metric"),
                F.col("outlier_count").cast("double").alias("value"),
            )
        )
    return report


def save_report(report: DataFrame, path: str) -> None:
    """Write a report as JSON lines, stamped with the time of the run; a repeated run replaces it."""
    report.withColumn("timestamp", F.current_timestamp()).write.mode("overwrite").json(path)
