"""Dashboard reports on the (filtered) sales table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import amounts, calendar
from marketloom.operators.aggregates import AMOUNT, CUSTOMER, DATE, with_share


def filtered(
    df: DataFrame, first: str | None = None, last: str | None = None, category: str = "All", date: str = DATE
) -> DataFrame:
    """Rows between two dates (both included) and of one category, or of all."""
    if first is not None and last is not None:
        df = df.where(calendar.in_dates(date, first, last))
    return df if category == "All" else df.where(F.col("category") == category)


def filter_domains(df: DataFrame) -> DataFrame:
    """What the filters offer: every category in order, with the first and last date of the table."""
    # One row per (category, extremes) after partial aggregation; the whole-table extremes are one row.
    per_category = df.groupBy("category").agg(F.min(DATE).alias("a"), F.max(DATE).alias("b"))
    span = df.agg(F.to_date(F.min(DATE)), F.to_date(F.max(DATE))).first()
    return per_category.where(F.col("category").isNotNull()).select(
        "category", F.lit(span[0]).alias("first_date"), F.lit(span[1]).alias("last_date")
    ).orderBy("category")


def kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        amounts.total(AMOUNT).alias("total_sales"),
        amounts.mean(AMOUNT).alias("avg_transaction"),
        amounts.row_count().alias("transaction_count"),
        F.countDistinct(CUSTOMER).alias("unique_customers"),
        amounts.mean("quantity").alias("avg_quantity"),
    )


def _sales(df: DataFrame, key) -> DataFrame:
    return df.groupBy(key).agg(amounts.total(AMOUNT).alias("total_sales"))


def by_day(df: DataFrame) -> DataFrame:
    return _sales(df, F.to_date(DATE).alias("date")).orderBy("date")


def by_month(df: DataFrame) -> DataFrame:
    return _sales(df, F.date_format(DATE, "yyyy-MM").alias("month")).orderBy("month")


def by_column(df: DataFrame, column: str) -> DataFrame:
    """Sales per value, largest first (category, gender, payment method)."""
    return _sales(df, column).orderBy(F.desc("total_sales"), F.asc_nulls_first(column))


def share_by_column(df: DataFrame, column: str) -> DataFrame:
    """Sales per value and its percent of all sales."""
    return with_share(_sales(df, column), "total_sales", "share").orderBy(F.desc("total_sales"), F.asc_nulls_first(column))


def age_histogram(df: DataFrame, column: str = "age", bins: int = 30) -> DataFrame:
    """Rows per equal-width bin between the smallest and the largest value."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return df.select(F.lit(None).cast("long").alias("bin"), F.lit(None).cast("long").alias("rows")).limit(0)
    place = F.width_bucket(F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high) + 1.0), F.lit(bins))
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(place.cast("long").alias("bin"))
        .agg(F.min(column).alias("from_value"), F.max(column).alias("to_value"), amounts.row_count().alias("rows"))
        .orderBy("bin")
    )


def by_mall(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("shopping_mall")
        .agg(
            amounts.total(AMOUNT).alias("total_sales"),
            amounts.row_count().alias("transaction_count"),
            F.countDistinct(CUSTOMER).alias("unique_customers"),
        )
        .orderBy(F.desc("total_sales"), F.asc_nulls_first("shopping_mall"))
    )


def by_weekday(df: DataFrame) -> DataFrame:
    """Monday to Sunday; a day without sales is there with null."""
    week = df.sparkSession.createDataFrame(list(enumerate(calendar.WEEKDAYS)), "position int, weekday string")
    sales = _sales(df.where(F.col(DATE).isNotNull()), F.weekday(DATE).alias("position"))
    return week.join(sales, "position", "left").orderBy("position")


def by_hour(df: DataFrame, timestamp: str, amount: str = AMOUNT) -> DataFrame:
    return (
        df.groupBy(F.hour(timestamp).alias("hour")).agg(amounts.total(amount).alias("total_sales")).orderBy("hour")
    )


def top_by_column(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k values with most sales (customers, categories)."""
    return by_column(df, column).limit(k)
