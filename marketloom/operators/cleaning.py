"""Cleaning operators. Each maps a DataFrame to a DataFrame; statistics are taken in one scan for all columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import amounts, calendar, text
from marketloom.operators import profiling
from marketloom.operators.ordering import HOT_ROWS, forward_fill, order_key
from marketloom.operators.quantiles import quantiles
from marketloom.schema import (
    MISSING_THRESHOLD,
    OUTLIER_THRESHOLD,
    numeric_columns,
    other_columns,
    present,
    string_columns,
)


# --- duplicates ------------------------------------------------------------------------------------------------------


def remove_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, keep: str | bool = "first", order: Sequence[str] | None = None
) -> DataFrame:
    """Drop duplicates on all columns or on ``subset``; nulls equal each other.

    ``keep`` is ``'first'`` or ``'last'`` in ``order`` (needed with a subset), or ``False`` to drop every copy. All forms are
    aggregations that merge copies in each task before the shuffle, so a huge group of copies is never gathered.
    """
    if keep not in ("first", "last", False):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    if subset is None and keep is not False:
        return df.dropDuplicates()
    keys = list(subset or df.columns)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(True)
    if keep is False:
        kept = df.groupBy(*keys).agg(F.first(row).alias("__row"), F.count(F.lit(1)).alias("__n")).where(F.col("__n") == 1)
    else:
        if not order:
            raise ValueError("keep='first' and keep='last' on a subset need order columns")
        pick = F.min_by if keep == "first" else F.max_by
        kept = df.groupBy(*keys).agg(pick(row, order_key(order)).alias("__row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


# --- dates, text, types ----------------------------------------------------------------------------------------------


def choose_date_formats(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] = calendar.DATE_FORMATS
) -> dict[str, str | None]:
    """For each column the first format that parses at least one value; ``None`` if none does.

    One scan for all of them. Every different text is parsed once, however many rows hold it.
    """
    columns = present(df, columns)
    if not columns:
        return {}
    texts = profiling.value_counts(df, columns)
    hits = texts.groupBy("column").agg(*[F.count(calendar.parse_date("value", f)).alias(f"n_{j}") for j, f in enumerate(formats)])
    rows = {r["column"]: r for r in hits.collect()}  # one row per column
    return {c: next((f for j, f in enumerate(formats) if c in rows and rows[c][f"n_{j}"]), None) for c in columns}


def parse_dates(df: DataFrame, formats: dict[str, str | None]) -> DataFrame:
    """Parse each column with its format; without one, with Spark's own date syntax. What does not parse becomes null."""
    typed = dict(df.dtypes)
    new = {}
    for c, fmt in formats.items():
        if typed[c] != "string":
            new[c] = F.col(c).cast("timestamp_ntz")
        elif fmt is not None:
            new[c] = calendar.parse_date(c, fmt)
        else:
            new[c] = F.col(c).try_cast("timestamp_ntz")
    return df.withColumns(new) if new else df


def standardize_dates(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] = calendar.DATE_FORMATS, per_row: bool = False
) -> DataFrame:
    """Parse date text. The format is chosen per column (first that fits any value) or, with ``per_row``, per value."""
    columns = present(df, columns)
    if per_row:
        return df.withColumns({c: F.coalesce(*[calendar.parse_date(c, f) for f in formats]) for c in columns})
    typed = dict(df.dtypes)
    chosen = choose_date_formats(df, [c for c in columns if typed[c] == "string"], formats)
    return parse_dates(df, {c: chosen.get(c) for c in columns})


def standardize_text(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    lowercase: bool = True,
    strip: bool = True,
    reference_nulls: bool = False,
) -> DataFrame:
    """Strip and lower text columns (default: all). Missing stays missing unless ``reference_nulls`` writes ``'nan'``."""
    columns = string_columns(df) if columns is None else present(df, columns)
    token = "nan" if reference_nulls else None
    return df.withColumns({c: text.normalize(c, lowercase, strip, token) for c in columns}) if columns else df


def fractional_columns(df: DataFrame, columns: Sequence[str]) -> set[str]:
    """The columns that hold a number with a fraction."""
    whole = {c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint")}
    columns = [c for c in columns if c not in whole]
    if not columns:
        return set()
    number = {c: F.col(c).try_cast("double") for c in columns}
    row = df.agg(*[F.count(F.when(number[c] != F.floor(number[c]), 1)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c for i, c in enumerate(columns) if row[f"n{i}"]}


def coercion_losses(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column, lost): values that were there before a type coercion and are missing after it; one scan of each."""
    columns = present(after, before.columns)
    b = missing_counts(before.select(*columns))
    a = missing_counts(after.select(*columns))
    rows = [(c, a[c] - b[c]) for c in columns]
    return before.sparkSession.createDataFrame(rows, "column string, lost long")


def missing_counts(df: DataFrame) -> dict[str, int]:
    cells = [F.count(F.when(profiling.is_missing(df, c), 1)).alias(f"m{i}") for i, c in enumerate(df.columns)]
    row = df.agg(*cells).first()
    return {c: row[f"m{i}"] for i, c in enumerate(df.columns)}


def coerce_types(df: DataFrame, types: dict[str, str], reference_nulls: bool = False) -> DataFrame:
    """Cast columns to int, float, str, datetime or category; a value that does not fit becomes null.

    A column with fractions is not made an integer one, which would lose them: it becomes double. One scan finds out for
    all columns; ``coercion_losses`` counts the values that do not fit.
    """
    new = {}
    fractional = fractional_columns(df, [c for c in present(df, types) if types[c].lower() in ("int", "int64")])
    for c in present(df, types):
        kind, value = types[c].lower(), F.col(c)
        kind = "float" if c in fractional else kind
        if kind in ("int", "int64"):
            # Text like '3.0' is a whole number too.
            number = value.try_cast("double")
            new[c] = F.coalesce(value.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))
            if dict(df.dtypes)[c] in ("float", "double") or dict(df.dtypes)[c].startswith("decimal"):
                new[c] = F.when(value == F.floor(value), value.try_cast("bigint"))
        elif kind in ("float", "float64"):
            number = value.try_cast("double")
            new[c] = F.when(~F.isnan(number), number)
        elif kind in ("datetime", "datetime64"):
            new[c] = value.try_cast("timestamp_ntz")
        elif kind == "category":
            new[c] = value.cast("string")
        elif kind in ("str", "string", "object"):
            new[c] = F.coalesce(value.cast("string"), F.lit("nan")) if reference_nulls else value.cast("string")
        else:
            raise ValueError(f"unknown type for {c}: {types[c]}")
    return df.withColumns(new) if new else df


# --- missing values --------------------------------------------------------------------------------------------------


def missing_shares(df: DataFrame) -> dict[str, float]:
    """Share of missing values per column; one scan."""
    row = df.agg(
        amounts.row_count().alias("rows"),
        *[F.count(F.when(profiling.is_missing(df, c), 1)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    ).first()
    return {c: row[f"m{i}"] / row["rows"] if row["rows"] else 0.0 for i, c in enumerate(df.columns)}


def sparse_columns(df: DataFrame, threshold: float = MISSING_THRESHOLD) -> list[str]:
    """Columns whose share of missing values is strictly above the threshold."""
    return [c for c, share in missing_shares(df).items() if share > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = MISSING_THRESHOLD) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return profiling.nan_to_null(df).dropna("any", subset=list(columns) if columns else None)


def numeric_fills(df: DataFrame, columns: Sequence[str], strategy: str = "median", exact: bool = True) -> dict[str, float]:
    """The median or mean per column; a column without values has none."""
    columns = present(df, columns)
    df = profiling.nan_to_null(df.select(*columns))
    if strategy == "median":
        values = {c: q[0] for c, q in quantiles(df, columns, [0.5], exact).items()}
    elif strategy == "mean":
        row = df.agg(*[amounts.mean(F.col(c).cast("double"), exact=False).alias(c) for c in columns]).first() if columns else {}
        values = {c: row[c] for c in columns}
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    return {c: v for c, v in values.items() if v is not None}


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The most frequent value per column as text, ties to the smallest; counted by a shuffle on (column, value)."""
    columns = present(df, columns)
    if not columns:
        return {}
    best = profiling.value_counts(df, columns).groupBy("column").agg(
        F.min(F.struct((-F.col("rows")).alias("negative"), F.col("value"))).alias("best")
    )
    return {r["column"]: r["best"]["value"] for r in best.collect()}  # one row per column


def fill_numeric(df: DataFrame, columns: Sequence[str], fills: dict[str, float]) -> DataFrame:
    """Fill missing numbers; the columns become double, whether or not anything was missing."""
    new = {}
    for c in present(df, columns):
        value = F.when(~profiling.is_missing(df, c), F.col(c).cast("double"))
        new[c] = F.coalesce(value, F.lit(fills[c])) if c in fills else value
    return df.withColumns(new) if new else df


def fill_text(df: DataFrame, fills: dict[str, str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in fills.items()}) if fills else df


def impute(
    df: DataFrame,
    strategy: str = "auto",
    numeric: Sequence[str] | None = None,
    other: Sequence[str] | None = None,
    exact: bool = True,
    shares: dict[str, float] | None = None,
) -> DataFrame:
    """Fill numeric columns with median or mean and all others with the most frequent value.

    ``auto`` and ``mode`` use the median for numbers. Statistics are taken only of columns that miss something;
    ``shares`` is the share of missing values per column, if known.
    """
    if strategy not in ("auto", "median", "mean", "mode"):
        raise ValueError(f"unknown strategy: {strategy}")
    numeric = numeric_columns(df) if numeric is None else present(df, numeric)
    other = other_columns(df) if other is None else present(df, other)
    shares = shares if shares is not None else missing_shares(df.select(*{*numeric, *other}))
    gaps = {c for c, share in shares.items() if 0 < share < 1}
    fills = numeric_fills(df, [c for c in numeric if c in gaps], "mean" if strategy == "mean" else "median", exact)
    modes = most_frequent(df, [c for c in other if c in gaps])
    return fill_text(fill_numeric(df, numeric, fills), modes)


def handle_missing(
    df: DataFrame,
    strategy: str = "auto",
    threshold: float = MISSING_THRESHOLD,
    numeric: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
    groups: Sequence[str] = (),
    exact: bool = True,
    hot_rows: int = HOT_ROWS,
    shares: dict[str, float] | None = None,
) -> DataFrame:
    """Drop sparse columns, then ``drop`` rows, fill (``auto``, ``median``, ``mean``, ``mode``) or ``forward_fill``.

    ``shares`` is the share of missing values per column, if known.
    """
    shares = missing_shares(df) if shares is None else shares
    df = df.drop(*[c for c, share in shares.items() if share > threshold])
    if strategy == "drop":
        return drop_null_rows(df)
    if strategy == "forward_fill":
        if not order:
            raise ValueError("forward_fill needs order columns")
        filled = [c for c in df.columns if c not in order and c not in groups]
        return forward_fill(profiling.nan_to_null(df), filled, order, groups, hot_rows)
    return impute(df, strategy, numeric, exact=exact, shares=shares)


# --- outliers --------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bounds:
    low: float
    high: float


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], threshold: float = OUTLIER_THRESHOLD, exact: bool = True
) -> dict[str, Bounds]:
    """[Q1 - t * IQR, Q3 + t * IQR] per column that has values."""
    found = quantiles(profiling.nan_to_null(df.select(*present(df, columns))), present(df, columns), [0.25, 0.75], exact)
    return {
        c: Bounds(q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1)) for c, (q1, q3) in found.items() if q1 is not None
    }


def zscore_bounds(df: DataFrame, columns: Sequence[str], threshold: float = OUTLIER_THRESHOLD) -> dict[str, Bounds]:
    """mean -+ t * standard deviation per column that has at least two different values."""
    columns = present(df, columns)
    df = profiling.nan_to_null(df.select(*columns))
    row = df.agg(
        *[amounts.mean(F.col(c).cast("double"), exact=False).alias(f"mean_{c}") for c in columns],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"std_{c}") for c in columns],
    ).first()
    return {
        c: Bounds(row[f"mean_{c}"] - threshold * row[f"std_{c}"], row[f"mean_{c}"] + threshold * row[f"std_{c}"])
        for c in columns
        if row[f"std_{c}"]
    }


def _bounds(df, columns, method, threshold, exact) -> dict[str, Bounds]:
    if method == "iqr":
        return iqr_bounds(df, columns, threshold, exact)
    if method == "zscore":
        return zscore_bounds(df, columns, threshold)
    raise ValueError(f"unknown outlier method: {method}")


def cap(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    """Move values outside the bounds onto them; null stays null."""
    new = {}
    for c, b in bounds.items():
        value = F.col(c).cast("double")
        new[c] = F.when(value < b.low, F.lit(b.low)).when(value > b.high, F.lit(b.high)).otherwise(value)
    return df.withColumns(new) if new else df


def is_outlier(column: str, bounds: Bounds):
    return F.coalesce((F.col(column) < bounds.low) | (F.col(column) > bounds.high), F.lit(False))


def handle_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "iqr",
    threshold: float = OUTLIER_THRESHOLD,
    exact: bool = True,
    cap_zscore: bool = False,
) -> DataFrame:
    """Cap outliers (``iqr``). ``zscore`` only detects, as in the reference, unless ``cap_zscore`` is set."""
    columns = numeric_columns(df) if columns is None else present(df, columns)
    if method == "zscore" and not cap_zscore:
        return df
    return cap(df, _bounds(df, columns, method, threshold, exact))


def flag_outliers(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "zscore",
    threshold: float = OUTLIER_THRESHOLD,
    exact: bool = True,
) -> DataFrame:
    """Add ``{column}_outlier``, 1 for an outlier and 0 else."""
    bounds = _bounds(df, columns, method, threshold, exact)
    return df.withColumns(
        {
            f"{c}_outlier": is_outlier(c, bounds[c]).cast("int") if c in bounds else F.lit(0)
            for c in present(df, columns)
        }
    )


def outlier_report(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    methods: Sequence[str] = ("iqr", "zscore"),
    threshold: float = OUTLIER_THRESHOLD,
    exact: bool = True,
) -> DataFrame:
    """Number of outliers per column and method, counted for all of them in one scan."""
    columns = numeric_columns(df) if columns is None else present(df, columns)
    bounds = {m: _bounds(df, columns, m, threshold, exact) for m in methods}
    counts = {
        (c, m): F.count(F.when(is_outlier(c, bounds[m][c]), 1)) if c in bounds[m] else F.count(F.lit(None))
        for m in methods
        for c in columns
    }
    row = df.agg(*[e.alias(f"o{i}") for i, e in enumerate(counts.values())])
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(m).alias("method"), F.col(f"o{i}").alias("outlier_count"))
            for i, (c, m) in enumerate(counts)
        ]
    )
    return row.select(F.inline(cells))


# --- derived columns -------------------------------------------------------------------------------------------------


def derived_columns(df: DataFrame) -> DataFrame:
    """total_amount = price * quantity and the calendar columns of the cleaned table, as far as their inputs exist."""
    new = {}
    if {"price", "quantity"} <= set(df.columns):
        new["total_amount"] = F.col("price") * F.col("quantity")
    if "invoice_date" in df.columns:
        parts = calendar.date_parts("invoice_date")
        new.update({p: parts[p] for p in ("year", "month", "day", "day_of_week", "quarter")})
    return df.withColumns(new) if new else df
