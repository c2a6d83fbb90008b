"""Aggregate tables. All are partial aggregations: tasks combine their rows before anything is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import amounts, calendar
from marketloom.operators.ordering import has_group
from marketloom.session import durable

AMOUNT, CUSTOMER, DATE = "total_amount", "customer_id", "invoice_date"


def named(column: str) -> Column:
    """A column by its exact name, which may hold dots."""
    return F.col(f"`{column.replace('`', '``')}`")


def sales_totals(
    avg: str = "avg_transaction", quantity: bool = True, amount: str = AMOUNT, customer: str = CUSTOMER
) -> list[Column]:
    """Total sales, quantity, transactions, distinct customers and mean transaction; null customers do not count."""
    measures = [amounts.total(named(amount)).alias("total_sales")]
    if quantity:
        measures.append(amounts.total("quantity").alias("total_quantity"))
    return [
        *measures,
        amounts.row_count().alias("transaction_count"),
        F.countDistinct(named(customer)).alias("unique_customers"),
        amounts.mean(named(amount)).alias(avg),
    ]


PERIODS = {
    "day": lambda d: {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)},
    "week": lambda d: {"year": calendar.iso_year(d), "week": F.weekofyear(d)},
    "month": lambda d: {"year": F.year(d), "month": F.month(d)},
    "year": lambda d: {"year": F.year(d)},
}


def sales_by_period(
    df: DataFrame, period: str = "day", date: str = DATE, amount: str = AMOUNT, customer: str = CUSTOMER
) -> DataFrame:
    """Sales per day, ISO week, month or year, in order of time."""
    if period not in PERIODS:
        raise ValueError(f"unknown period: {period}")
    parts = PERIODS[period](named(date))
    totals = sales_totals(amount=amount, customer=customer)
    return df.groupBy(*[e.alias(n) for n, e in parts.items()]).agg(*totals).orderBy(*parts)


def sales_by_category(df: DataFrame, category: str = "category", amount: str = AMOUNT, customer: str = CUSTOMER) -> DataFrame:
    """Sales per value of a column, the largest first."""
    return (
        df.groupBy(named(category))
        .agg(*sales_totals(amount=amount, customer=customer), amounts.mean("price").alias("avg_price"))
        .orderBy(F.desc("total_sales"), named(category).asc_nulls_first())
    )


def customer_rfm(df: DataFrame, customer: str = CUSTOMER, date: str = DATE, amount: str = AMOUNT) -> DataFrame:
    """Last and first purchase, number of rows, amount and mean amount per customer."""
    return (
        df.groupBy(named(customer))
        .agg(
            F.max(named(date)).alias("last_purchase"),
            F.min(named(date)).alias("first_purchase"),
            amounts.row_count().alias("frequency"),
            amounts.total(named(amount)).alias("monetary"),
            amounts.mean(named(amount)).alias("avg_transaction"),
        )
        .orderBy(F.desc("monetary"), named(customer).asc_nulls_first())
    )


def top_categories(df: DataFrame, k: int = 10, category: str = "category", amount: str = AMOUNT) -> DataFrame:
    return (
        df.groupBy(named(category))
        .agg(
            amounts.total(named(amount)).alias("total_sales"),
            amounts.total("quantity").alias("total_quantity"),
            amounts.row_count().alias("transaction_count"),
        )
        .orderBy(F.desc("total_sales"), named(category).asc_nulls_first())
        .limit(k)
    )


def sales_by_demographics(df: DataFrame, fields: Sequence[str] = ("gender", "age")) -> DataFrame:
    """Sales per value of each field, in long form, from one scan with one grouping set per field."""
    fields = list(fields)
    texts = [f"__text_{f}" for f in fields]
    df = df.withColumns({t: F.col(f).cast("string") for f, t in zip(fields, texts)})
    # grouping() of a field is 0 in the set that groups by it.
    dimension = F.coalesce(*[F.when(F.col(f"__set_{f}") == 0, F.lit(f)) for f in fields])
    value = F.coalesce(*[F.when(F.col(f"__set_{f}") == 0, F.col(t)) for f, t in zip(fields, texts)])
    grouped = df.groupingSets([[t] for t in texts], *texts).agg(
        *sales_totals(quantity=False), *[F.grouping(t).alias(f"__set_{f}") for f, t in zip(fields, texts)]
    )
    return grouped.select(
        dimension.alias("dimension"),
        value.alias("dimension_value"),
        "total_sales",
        "transaction_count",
        "unique_customers",
        "avg_transaction",
    ).orderBy("dimension", F.desc("total_sales"), F.asc_nulls_first("dimension_value"))


def sales_by_payment(df: DataFrame, method: str = "payment_method", amount: str = AMOUNT) -> DataFrame:
    """Sales per payment method with its share of the transactions in percent."""
    grouped = df.groupBy(named(method)).agg(
        amounts.total(named(amount)).alias("total_sales"),
        amounts.row_count().alias("transaction_count"),
        amounts.mean(named(amount)).alias("avg_transaction"),
    )
    return with_share(grouped, "transaction_count", "percentage").orderBy(
        F.desc("total_sales"), named(method).asc_nulls_first()
    )


def with_share(grouped: DataFrame, measure: str, name: str) -> DataFrame:
    """Percent of the total of ``measure``. The total is one number, summed over the grouped rows."""
    saved = durable(grouped, "shares")
    whole = saved.agg(F.sum(F.col(measure).cast("decimal(30,4)")).cast("double")).first()[0]
    return saved.withColumn(name, F.try_divide(F.col(measure) * 100.0, F.lit(whole).cast("double")))


def save_aggregate(result: DataFrame, path: str) -> int:
    """Write a result table, replacing an older one; returns its number of rows. An empty result is not written."""
    saved = durable(result, "aggregate")
    rows = saved.count()
    if rows:
        saved.write.mode("overwrite").parquet(path)
    return rows


# --- report tables ---------------------------------------------------------------------------------------------------


def _view_measures() -> list[Column]:
    return [
        F.coalesce(amounts.total(AMOUNT), F.lit(0.0)).alias("total_sales"),
        amounts.mean(AMOUNT).alias("avg_transaction"),
        F.count(AMOUNT).alias("transaction_count"),
        F.coalesce(amounts.total("quantity"), F.lit(0.0)).alias("total_quantity"),
        amounts.mean("quantity").alias("avg_quantity"),
        F.countDistinct(CUSTOMER).alias("unique_customers"),
    ]


def daily_view(df: DataFrame, date: str = DATE) -> DataFrame:
    """Sales per calendar day between the first and the last date; days without sales have sums and counts 0."""
    day = F.to_date(date).alias("date")
    return dense_days(durable(df.where(F.col(date).isNotNull()).groupBy(day).agg(*_view_measures()), "daily"))


def dense_days(daily: DataFrame) -> DataFrame:
    """A row for every calendar day between the first and the last ``date``; sums and counts of added days are 0."""
    calendar_days = daily.agg(F.min("date").alias("a"), F.max("date").alias("b")).where(F.col("a").isNotNull())
    days = calendar_days.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))
    zeros = {"total_sales": 0.0, "transaction_count": 0, "total_quantity": 0.0, "unique_customers": 0}
    return days.join(daily, "date", "left").fillna(zeros)


def category_view(df: DataFrame) -> DataFrame:
    return df.where(has_group(["category"])).groupBy("category").agg(*_view_measures())


def customer_view(df: DataFrame, *more: Column) -> DataFrame:
    """Spending and first and last purchase per customer, and any further measures."""
    return (
        df.where(has_group([CUSTOMER]))
        .groupBy(CUSTOMER)
        .agg(
            F.coalesce(amounts.total(AMOUNT), F.lit(0.0)).alias("total_spent"),
            amounts.mean(AMOUNT).alias("avg_transaction"),
            F.count(AMOUNT).alias("transaction_count"),
            F.min(DATE).alias("first_purchase"),
            F.max(DATE).alias("last_purchase"),
            *more,
        )
    )


PREFERENCES = {
    "preferred_category": "category",
    "preferred_payment_method": "payment_method",
    "preferred_mall": "shopping_mall",
}


def preferences(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """The most frequent value per customer of each column, ties to the smallest.

    Rows are first counted per (customer, column, value), so a customer with very many rows is a few counts.
    """
    columns = columns or PREFERENCES
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("value")) for n, c in columns.items()])
    counts = (
        df.where(has_group([CUSTOMER]))
        .select(CUSTOMER, F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy(CUSTOMER, "name", "value")
        .agg(amounts.row_count().alias("rows"))
    )
    best = {
        n: F.min(F.when(F.col("name") == n, F.struct((-F.col("rows")).alias("negative"), F.col("value"))))
        for n in columns
    }
    return (
        counts.groupBy(CUSTOMER)
        .agg(*[e.alias(n) for n, e in best.items()])
        .select(CUSTOMER, *[F.col(f"{n}.value").alias(n) for n in columns])
    )


def customer_summary(df: DataFrame) -> DataFrame:
    """The customer view with days active, recency, mean items per transaction and preferences."""
    last = df.agg(F.max(F.to_date(DATE))).first()[0]
    base = customer_view(df, amounts.mean("quantity").alias("avg_items"))
    out = base.join(preferences(df), CUSTOMER, "left")
    return out.withColumns(
        {
            "days_active": F.datediff("last_purchase", "first_purchase"),
            "recency_days": F.datediff(F.lit(last), F.col("last_purchase")),
        }
    )


AGGREGATE_TYPES = ["period", "category", "shopping_mall", "payment_method", "gender"]


def aggregated_sales(df: DataFrame) -> DataFrame:
    """One long table of monthly sales: overall and by category, mall, payment method and gender.

    One scan with a grouping set per type; ``metrics`` holds the measures.
    """
    dims = AGGREGATE_TYPES[1:]
    texts = [f"__d_{d}" for d in dims]
    df = df.withColumn("period", F.date_format(DATE, "yyyy-MM")).withColumns(
        {t: F.col(d).cast("string") for d, t in zip(dims, texts)}
    )
    sets = [["period"], *[["period", t] for t in texts]]
    grouped = df.groupingSets(sets, "period", *texts).agg(
        amounts.total(AMOUNT).alias("total_sales"),
        amounts.row_count().alias("transaction_count"),
        amounts.mean(AMOUNT).alias("avg_transaction"),
        F.min(AMOUNT).alias("min_transaction"),
        F.max(AMOUNT).alias("max_transaction"),
        F.countDistinct(CUSTOMER).alias("unique_customers"),
        *[F.grouping(t).alias(f"__set_{t}") for t in texts],
    )
    chosen = [F.when(F.col(f"__set_{t}") == 0, F.lit(d)) for d, t in zip(dims, texts)]
    return grouped.select(
        F.coalesce(*chosen, F.lit("period")).alias("aggregation_type"),
        "period",
        F.coalesce(*chosen, F.lit("all")).alias("dimension"),
        F.coalesce(*[F.when(F.col(f"__set_{t}") == 0, F.col(t)) for t in texts]).alias("dimension_value"),
        F.struct(
            "total_sales",
            "transaction_count",
            "avg_transaction",
            "min_transaction",
            "max_transaction",
            "unique_customers",
        ).alias("metrics"),
        F.current_timestamp().alias("created_at"),
    )
