"""Feature operators on transactions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import amounts, calendar
from marketloom.operators import profiling
from marketloom.operators.lookups import lookup, lookup_columns
from marketloom.operators.ordering import HOT_ROWS, has_group, ordered_columns, row_numbers
from marketloom.schema import LAG_PERIODS, ROLLING_WINDOWS, numeric_columns, present
from marketloom.session import durable

Maker = Callable[[object], Column]


# --- lags and rolling frames -----------------------------------------------------------------------------------------


def lag_makers(value: str, lags: Sequence[int]) -> dict[str, Maker]:
    return {f"{value}_lag_{n}": (lambda w, n=n: F.lag(value, n).over(w)) for n in lags}


def rolling_makers(value: str, windows: Sequence[int], functions: Sequence[str], exact: bool = False) -> dict[str, Maker]:
    return {
        f"{value}_rolling_{f}_{size}": (
            lambda w, f=f, size=size: amounts.summary(f, value, w.rowsBetween(1 - size, 0), exact)
        )
        for size in windows
        for f in functions
    }


def running_makers(value: str) -> dict[str, Maker]:
    """Sum and count of the values up to the row, the sum exact: what ``rolling_mean_makers`` takes differences of."""
    past = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    return {
        f"__sum_{value}": lambda w: F.coalesce(F.sum(F.col(value).cast(amounts.AMOUNT)).over(past(w)), F.lit(0).cast(amounts.AMOUNT)),
        f"__count_{value}": lambda w: F.count(value).over(past(w)),
    }


def rolling_mean_makers(value: str, windows: Sequence[int]) -> dict[str, Maker]:
    """The exact rolling means, at a cost per row that does not grow with the frame; for use with ``running_makers``."""

    def inside(name: str, size: int, w) -> Column:
        before = F.lag(name, size).over(w)
        return F.when(before.isNull(), F.col(name)).otherwise(F.col(name) - before).cast("double")

    return {
        f"{value}_rolling_mean_{size}": (
            lambda w, size=size: F.try_divide(inside(f"__sum_{value}", size, w), inside(f"__count_{value}", size, w))
        )
        for size in windows
    }


def lag_features(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    lags: Sequence[int] = LAG_PERIODS,
    groups: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``{value}_lag_{n}``: the value n rows (not days) earlier, in the group or in the whole table."""
    return ordered_columns(df, order, lag_makers(value, lags), max(lags), groups, hot_rows=hot_rows)


def rolling_features(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    windows: Sequence[int] = ROLLING_WINDOWS,
    groups: Sequence[str] = (),
    functions: Sequence[str] = ("mean", "std"),
    exact: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``{value}_rolling_{f}_{w}`` over the last w rows, as many as there are; std of one value is null."""
    makers = rolling_makers(value, windows, functions, exact)
    return ordered_columns(df, order, makers, max(max(windows) - 1, 1), groups, hot_rows=hot_rows)


# --- dates -----------------------------------------------------------------------------------------------------------


def date_features(df: DataFrame, column: str) -> DataFrame:
    if dict(df.dtypes)[column] == "string":
        df = df.withColumn(column, F.col(column).try_cast("timestamp_ntz"))
    return df.withColumns(calendar.date_parts(column))


# --- encodings -------------------------------------------------------------------------------------------------------


def label_codes(df: DataFrame, columns: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(column, value, code): the place of each value among the sorted distinct values, from 0."""
    numbers = set(numeric_columns(df.select(*columns)))
    # Numbers are ordered as numbers, everything else as text.
    number = F.when(F.col("column").isin(*numbers), F.col("value").cast("double")) if numbers else F.lit(None).cast("double")
    # Stored, since numbering looks for columns with very many values first.
    levels = durable(profiling.value_counts(df, columns).drop("rows").withColumn("__number", number), "levels")
    numbered = row_numbers(levels, ["__number", "value"], "n", ["column"], hot_rows)
    return numbered.select("column", "value", (F.col("n") - 1).cast("int").alias("code"))


def label_encode(df: DataFrame, columns: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``{c}_encoded``: index among the sorted distinct values, -1 for a missing value."""
    columns = present(df, columns)
    coded = lookup_columns(df, label_codes(df, columns, hot_rows), columns, "code", "_encoded")
    return coded.withColumns({f"{c}_encoded": F.coalesce(F.col(f"{c}_encoded"), F.lit(-1)) for c in columns})


def frequency_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``{c}_freq``: share of the value among the non-missing rows; null for a missing value."""
    columns = present(df, columns)
    counts = profiling.value_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("rows").alias("total"))
    shares = counts.join(totals, "column").select("column", "value", (F.col("rows") / F.col("total")).alias("share"))
    return lookup_columns(df, shares, columns, "share", "_freq")


def onehot_levels(df: DataFrame, column: str, max_levels: int | None = None) -> list[str]:
    """The sorted distinct values. Each becomes a column; with ``max_levels`` more of them are an error."""
    levels = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
    found = (levels if max_levels is None else levels.limit(max_levels + 1)).collect()
    if max_levels is not None and len(found) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} values; use label or frequency encoding")
    return [r[0] for r in found]


def onehot_encode(df: DataFrame, columns: Sequence[str], max_levels: int | None = None) -> DataFrame:
    """``{c}_{value}`` flags for all but the first sorted value; all false for a missing value."""
    new = {}
    for c in present(df, columns):
        for level in onehot_levels(df, c, max_levels)[1:]:
            new[f"{c}_{level}"] = F.coalesce(F.col(c) == F.lit(level), F.lit(False))
    return df.withColumns(new) if new else df


def encode(df: DataFrame, columns: Sequence[str], kind: str = "label") -> DataFrame:
    kinds = {"label": label_encode, "onehot": onehot_encode, "frequency": frequency_encode}
    if kind not in kinds:
        raise ValueError(f"unknown encoding: {kind}")
    return kinds[kind](df, columns)


# --- group statistics ------------------------------------------------------------------------------------------------


def group_features(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    functions: Sequence[str] = ("mean", "sum", "std", "min", "max", "count"),
    exact: bool = False,
) -> DataFrame:
    """``{value}_{f}_by_{groups}`` joined back to every row; null for a missing group, sum of nothing is 0."""
    label = "_".join(groups)
    aggregates = []
    for f in functions:
        result = amounts.summary(f, value, exact=exact)
        aggregates.append((F.coalesce(result, F.lit(0.0)) if f == "sum" else result).alias(f"{value}_{f}_by_{label}"))
    table = df.where(has_group(groups)).groupBy(*groups).agg(*aggregates)
    return lookup(df, table, groups, "groups")


def ratio_feature(df: DataFrame, numerator: str, denominator: str, name: str | None = None) -> DataFrame:
    """numerator / denominator; 0 where the denominator is zero."""
    return df.withColumn(name or f"{numerator}_to_{denominator}_ratio", amounts.ratio(numerator, denominator))


# --- customers -------------------------------------------------------------------------------------------------------


def reference_date(df: DataFrame, date: str = "invoice_date") -> dt.datetime | None:
    """One day after the last date of the whole table."""
    last = df.agg(F.max(F.col(date).cast("timestamp_ntz"))).first()[0]
    return None if last is None else last + dt.timedelta(days=1)


def _days_until(reference: dt.datetime | None, last: Column) -> Column:
    moment = F.lit(None if reference is None else reference.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("SECOND", last.cast("timestamp_ntz"), moment) / 86400).cast("long")


def customer_makers(
    df: DataFrame,
    reference: dt.datetime | None,
    date: str = "invoice_date",
    amount: str = "total_amount",
    invoice: str = "invoice_no",
) -> dict[str, Maker]:
    """Recency, frequency, monetary value and amount and quantity statistics of a customer.

    Each maker gives the window form for a window and the plain aggregate for ``None``.
    """

    def over(column: Column) -> Maker:
        return lambda w: column if w is None else column.over(w)

    def last_date(w):
        return _days_until(reference, over(F.max(date))(w))

    makers: dict[str, Maker] = {
        "recency": last_date,
        "frequency": over(F.count(invoice)),
        "monetary": lambda w: F.coalesce(amounts.total(amount, w), F.lit(0.0)),
        "customer_avg_amount": lambda w: amounts.mean(amount, w),
        "customer_std_amount": over(F.stddev_samp(amount)),
        "customer_min_amount": over(F.min(amount)),
        "customer_max_amount": over(F.max(amount)),
    }
    # Optional columns: what is made of them is left out with them.
    for name, column in (("recency", date), ("frequency", invoice)):
        if column not in df.columns:
            del makers[name]
    if "quantity" in df.columns:
        makers["customer_avg_quantity"] = lambda w: amounts.mean("quantity", w)
        makers["customer_total_quantity"] = lambda w: F.coalesce(amounts.total("quantity", w), F.lit(0.0))
    return makers


def customer_features(
    df: DataFrame,
    customer: str = "customer_id",
    date: str = "invoice_date",
    amount: str = "total_amount",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """The customer statistics (or those in ``names``) joined back to every row."""
    makers = customer_makers(df, reference_date(df, date), date, amount)
    chosen = {n: m for n, m in makers.items() if names is None or n in names}
    table = df.where(has_group([customer])).groupBy(customer).agg(*[m(None).alias(n) for n, m in chosen.items()])
    return lookup(df, table, [customer], "customers")


def customer_ltv(df: DataFrame, customer: str = "customer_id", amount: str = "total_amount") -> DataFrame:
    """``customer_ltv``: everything the customer has spent."""
    table = df.where(has_group([customer])).groupBy(customer).agg(
        F.coalesce(amounts.total(amount), F.lit(0.0)).alias("customer_ltv")
    )
    return lookup(df, table, [customer], "ltv")


# --- categories ------------------------------------------------------------------------------------------------------


def category_table(
    df: DataFrame, category: str = "category", amount: str = "total_amount", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Statistics per category, its rank by total amount (ties share the average rank), and its mean price."""
    aggregates = [
        amounts.mean(amount).alias("category_avg_amount"),
        F.coalesce(amounts.total(amount), F.lit(0.0)).alias("category_total_amount"),
        F.count(amount).alias("category_transaction_count"),
    ]
    if "quantity" in df.columns:
        aggregates.append(amounts.mean("quantity").alias("category_avg_quantity"))
        aggregates.append(F.coalesce(amounts.total("quantity"), F.lit(0.0)).alias("category_total_quantity"))
    if "price" in df.columns:
        aggregates.append(amounts.mean("price").alias("__avg_price"))
    table = durable(df.where(has_group([category])).groupBy(category).agg(*aggregates), "categories")
    return average_rank(table, "category_total_amount", [category], "category_rank", hot_rows)


def average_rank(
    table: DataFrame, value: str, ties: Sequence[str], name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rank by ``value`` descending, from 1; equal values share the mean of their places."""
    negative = table.withColumn("__negative", -F.col(value))
    numbered = row_numbers(negative, ["__negative", *ties], "__place", hot_rows=hot_rows)
    shared = numbered.groupBy("__negative").agg((F.sum("__place") / F.count("__place")).alias(name))
    return numbered.join(shared, "__negative").drop("__negative", "__place")


CATEGORY_STATS = [
    "category_avg_amount",
    "category_total_amount",
    "category_transaction_count",
    "category_avg_quantity",
    "category_total_quantity",
]


def category_features(df: DataFrame, category: str = "category", amount: str = "total_amount") -> DataFrame:
    return lookup(df, category_table(df, category, amount).drop("__avg_price"), [category], "category")


def price_vs_category(df: DataFrame, category: str = "category", price: str = "price") -> DataFrame:
    """``price_vs_category_avg``: price over the mean price of its category; over 1 if the category is missing."""
    table = df.where(has_group([category])).groupBy(category).agg(amounts.mean(price).alias("__avg_price"))
    return with_price_ratio(lookup(df, table, [category], "prices"), category, price)


def with_price_ratio(df: DataFrame, category: str = "category", price: str = "price") -> DataFrame:
    base = F.when(F.col(category).isNull(), F.lit(1.0)).otherwise(F.col("__avg_price"))
    return df.withColumn("price_vs_category_avg", F.try_divide(F.col(price).cast("double"), base)).drop("__avg_price")
