"""Forecasts on daily series.

A daily series has one row per day (and group) whatever the number of transactions behind it, so ordinary windows per
group are safe here; everything before it is a partial aggregation over the transactions. Operators that read a series more
than once store it first, so that the transactions are added up once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import amounts, calendar
from marketloom.operators.modelling import FEATURES, PREDICTION, assemble
from marketloom.session import durable

TRAIN_SHARE = 0.8
CALENDAR = ["day_of_year", "month", "day_of_week", "quarter"]
YEARLY_TERMS, WEEKLY_TERMS, CHANGEPOINTS = 10, 3, 25


def daily_series(df: DataFrame, groups: Sequence[str] = (), date: str = "invoice_date", amount: str = "total_amount") -> DataFrame:
    """(groups, date, sales): one row per day with sales."""
    dated = df.where(F.col(date).isNotNull())
    return dated.groupBy(*groups, F.to_date(date).alias("date")).agg(amounts.total(amount).alias("sales"))


def series_stats(series: DataFrame) -> DataFrame:
    """Mean, standard deviation, minimum and maximum of daily sales."""
    return series.agg(
        amounts.row_count().alias("days"),
        F.avg("sales").alias("mean"),
        F.stddev_samp("sales").alias("std"),
        F.min("sales").alias("min"),
        F.max("sales").alias("max"),
    )


def chrono_split(series: DataFrame, share: float = TRAIN_SHARE, groups: Sequence[str] = ()) -> DataFrame:
    """Add ``is_train``: 1 for the first int(share * n) days of the series."""
    along = Window.partitionBy(*groups).orderBy("date")
    whole = Window.partitionBy(*groups)
    limit = F.floor(F.lit(share) * F.count(F.lit(1)).over(whole))
    return series.withColumn("is_train", (F.row_number().over(along) <= limit).cast("int"))


# --- calendar polynomial ---------------------------------------------------------------------------------------------


def calendar_model(series: DataFrame, with_year: bool = True, degree: int = 2, reg: float = 1e-6):
    """Fit sales on calendar parts up to the given degree. (model, predictions for all days, feature names).

    The parts overlap (month, quarter, day of year), so a very small ridge keeps the solution unique.
    """
    names = [*CALENDAR, *(["year"] if with_year else [])]
    parts = calendar.date_parts("date")
    rows = chrono_split(durable(series, "series")).withColumns({n: parts[n].cast("double") for n in names})
    expanded = PolynomialExpansion(degree=degree, inputCol=FEATURES, outputCol="terms").transform(assemble(rows, names))
    linear = LinearRegression(featuresCol="terms", labelCol="sales", predictionCol=PREDICTION, regParam=reg, solver="normal")
    model = linear.fit(expanded.where("is_train = 1"))
    return model, model.transform(expanded).select("date", "sales", "is_train", PREDICTION), names


def linear_coefficients(series: DataFrame, model, names: Sequence[str], degree: int = 2) -> DataFrame:
    """Coefficients of the plain (degree one) terms, largest first."""
    spark, n = series.sparkSession, len(names)
    # Expanding one variable at a time shows the place of its plain term: for x = 2 it is 2, for the square it is 4.
    rows = spark.createDataFrame(
        [(i, Vectors.dense([2.0 if j == i else 0.0 for j in range(n)])) for i in range(n)], ["i", FEATURES]
    )
    places = PolynomialExpansion(degree=degree, inputCol=FEATURES, outputCol="terms").transform(rows).collect()
    found = [
        (names[r["i"]], float(model.coefficients[int(np.flatnonzero(r["terms"].toArray() == 2.0)[0])])) for r in places
    ]
    table = spark.createDataFrame(found, "feature string, coefficient double")
    return table.orderBy(F.desc(F.abs("coefficient")), "feature")


# --- trend and seasons -----------------------------------------------------------------------------------------------


def _seasonal_terms(position: str) -> list:
    """Trend position, then sine and cosine pairs of the year and of the week."""
    day = F.datediff("date", F.lit("1970-01-01").cast("date")).cast("double")
    waves = []
    for period, terms in ((365.25, YEARLY_TERMS), (7.0, WEEKLY_TERMS)):
        for k in range(1, terms + 1):
            angle = day * (2 * math.pi * k / period)
            waves += [F.sin(angle), F.cos(angle)]
    return [F.col(position), *waves]


def _ridge(x: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ y)


def _penalties(terms: int, reg: float) -> np.ndarray:
    """None on level and slope, little on the seasons, more on each change of the slope."""
    return np.array([1e-9, 1e-9] + [0.01 * reg] * (terms - 1) + [reg] * CHANGEPOINTS)


def seasonal_forecast(
    series: DataFrame, groups: Sequence[str] = (), share: float = TRAIN_SHARE, multiplicative: bool = False, reg: float = 1.0
) -> DataFrame:
    """Trend with changepoints plus yearly and weekly seasons, fitted on the first days and predicted for all.

    With groups one fit per group, in parallel; a group is one daily series. A single series is fitted on Spark: its normal
    equations are added up in the tasks. ``multiplicative`` fits the logarithm of the sales.
    """
    groups = list(groups)
    along = Window.partitionBy(*groups)
    first, last = F.min("date").over(along), F.max(F.when(F.col("is_train") == 1, F.col("date"))).over(along)
    rows = chrono_split(series if groups else durable(series, "series"), share, groups)
    rows = rows.withColumn("position", F.datediff("date", first) / F.greatest(F.datediff(last, first), F.lit(1)))
    rows = rows.withColumn("terms", F.array(*_seasonal_terms("position")))
    knots = np.linspace(0, 0.8, CHANGEPOINTS + 2)[1:-1]
    if not groups:
        return _seasonal_single(rows, knots, multiplicative, reg)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        terms = np.stack(pdf["terms"].to_numpy())
        bends = np.maximum(0.0, terms[:, :1] - knots)
        x = np.hstack([np.ones((len(pdf), 1)), terms, bends])
        y = pdf["sales"].to_numpy(float)
        y = np.log1p(np.maximum(y, 0.0)) if multiplicative else y
        train = pdf["is_train"].to_numpy() == 1
        scale = max(np.abs(y[train]).max(initial=0.0), 1e-12)
        penalty = _penalties(terms.shape[1], reg)
        guess = x @ _ridge(x[train], y[train] / scale, penalty) * scale if train.any() else np.full(len(pdf), np.nan)
        out = pdf[[*groups, "date", "sales", "is_train"]].copy()
        out[PREDICTION] = np.expm1(guess) if multiplicative else guess
        return out

    fields = [f for f in series.schema.fields if f.name in groups]
    schema = T.StructType(
        [
            *fields,
            T.StructField("date", T.DateType()),
            T.StructField("sales", T.DoubleType()),
            T.StructField("is_train", T.IntegerType()),
            T.StructField(PREDICTION, T.DoubleType()),
        ]
    )
    return rows.select(*groups, "date", "sales", "is_train", "terms").groupBy(*groups).applyInPandas(fit, schema)


def normal_equations(rows: DataFrame, x: str, y: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(X'X, X'y) over the rows of an array column ``x`` of ``size`` numbers and a column ``y``.

    Each row gives the products of its numbers with those from their own place on, and with y; the products of a place are added
    up in the tasks before the shuffle. The driver gets one number for each place of the matrix, whatever the number of rows.
    """
    each = rows.select(F.posexplode(x).alias("i", "a"), x, F.col(y).alias("__y"))
    tail = F.concat(F.slice(x, F.col("i") + 1, F.lit(size)), F.array("__y"))
    products = each.select("i", F.posexplode(F.transform(tail, lambda b: b * F.col("a"))).alias("k", "v"))
    found = products.groupBy("i", "k").agg(F.sum("v").alias("v")).collect()
    gram, right = np.zeros((size, size)), np.zeros(size)
    for r in found:
        i, j = r["i"], r["i"] + r["k"]
        if j == size:
            right[i] = r["v"]
        else:
            gram[i, j] = gram[j, i] = r["v"]
    return gram, right


def _seasonal_single(rows: DataFrame, knots: np.ndarray, multiplicative: bool, reg: float) -> DataFrame:
    y = F.log1p(F.greatest(F.col("sales"), F.lit(0.0))) if multiplicative else F.col("sales").cast("double")
    bends = F.transform(F.array(*[F.lit(float(k)) for k in knots]), lambda k: F.greatest(F.col("terms")[0] - k, F.lit(0.0)))
    terms = len(_seasonal_terms("position"))
    size = 1 + terms + len(knots)
    rows = rows.withColumns({"__x": F.concat(F.array(F.lit(1.0)), F.col("terms"), bends), "__target": y})
    gram, right = normal_equations(rows.where("is_train = 1 and __target is not null"), "__x", "__target", size)
    if gram[0, 0] == 0:
        return rows.select("date", "sales", "is_train", F.lit(None).cast("double").alias(PREDICTION))
    weights = np.linalg.solve(gram + np.diag(_penalties(terms, reg)), right)
    pairs = F.zip_with("__x", F.array(*[F.lit(float(w)) for w in weights]), lambda a, w: a * w)
    guess = F.aggregate(pairs, F.lit(0.0), lambda total, v: total + v)
    return rows.select("date", "sales", "is_train", (F.expm1(guess) if multiplicative else guess).alias(PREDICTION))


def mean_forecast(series: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """The mean of the first days for every day: what any other forecast should beat."""
    rows = chrono_split(durable(series, "series"), share)
    mean = rows.where("is_train = 1").agg(F.avg("sales").alias(PREDICTION))
    return rows.join(mean, F.lit(True)).select("date", "sales", "is_train", PREDICTION)  # one row


def ar_forecast(series: DataFrame, lags: int = 7, share: float = TRAIN_SHARE) -> DataFrame:
    """One-day-ahead forecast from the last ``lags`` daily changes."""
    along = Window.partitionBy().orderBy("date")
    rows = chrono_split(durable(series, "series"), share).withColumn("__change", F.col("sales") - F.lag("sales").over(along))
    names = [f"__change_{k}" for k in range(1, lags + 1)]
    rows = rows.withColumns({n: F.lag("__change", k).over(along) for k, n in enumerate(names, 1)})
    rows = rows.withColumn("__before", F.lag("sales").over(along)).dropna(subset=names)
    data = assemble(rows, names)
    linear = LinearRegression(featuresCol=FEATURES, labelCol="__change", predictionCol="__step")
    model = linear.fit(data.where("is_train = 1"))
    return model.transform(data).select(
        "date", "sales", "is_train", (F.col("__before") + F.col("__step")).alias(PREDICTION)
    )


def seasonal_decompose(series: DataFrame, period: int = 7, groups: Sequence[str] = ()) -> DataFrame:
    """Additive decomposition of a series into trend, season and rest.

    The trend is the centred mean over one (odd) period, the season the mean of what is left per place in the period.
    """
    if period % 2 == 0:
        raise ValueError("the period must be odd")
    half = period // 2
    along = Window.partitionBy(*groups).orderBy("date")
    around = along.rowsBetween(-half, half)
    full = F.count("sales").over(around) == period
    rows = durable(series, "series").withColumn("trend", F.when(full, amounts.mean("sales", around)))
    rows = rows.withColumn("place", F.pmod(F.row_number().over(along) - 1, F.lit(period)).cast("int"))
    rows = rows.withColumn("__left", F.col("sales") - F.col("trend"))
    place = Window.partitionBy(*groups, "place")
    rows = rows.withColumn("__season", F.avg("__left").over(place))
    # The seasons of one period add up to zero.
    one = rows.groupBy(*groups, "place").agg(F.first("__season").alias("__s"))
    level = one.groupBy(*groups).agg(F.avg("__s").alias("__level"))
    joined = rows.join(level, list(groups)) if groups else rows.join(level, F.lit(True))
    return joined.select(
        *groups,
        "date",
        "sales",
        "trend",
        (F.col("__season") - F.col("__level")).alias("season"),
        (F.col("__left") - (F.col("__season") - F.col("__level"))).alias("rest"),
    )
