"""Modelling and forecasting on the transformed sales table and on daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import features as f
from marketloom.operators import forecasting as t
from marketloom.operators import modelling as m
from marketloom.plans import models
from marketloom.plans.transform import transform_sales
from marketloom.queries.fixtures import KEYS, ORDER, mean, money, on_sales, sales, significant, significant_sql
from marketloom.schema import TARGET
from marketloom.session import discard, durable

#: Shallower trees than the default keep the forest queries short.
DEPTH = 10


def _transformed(s, d):
    rows = durable(sales(s, d), "sales")
    out = durable(transform_sales(rows, ORDER), "transformed")
    discard(rows)
    return out


def _prepared(s, d):
    df = _transformed(s, d)
    out = models.prepare(df, KEYS)
    discard(df)
    return out


def _fit(kind, train, features):
    return m.fit(kind, train, features, **({"maxDepth": DEPTH} if kind == "forest" else {}))


def _model(s, d, kind):
    df, features = _prepared(s, d)
    train, test = m.split(df, KEYS)
    kept, _ = m.clean_features(train, features)
    model = _fit(kind, train, kept)
    return model, m.predict(model, test, kept), kept


def _scored(kind):
    return lambda s, d: m.regression_metrics(_model(s, d, kind)[1]).select("rows", "rmse", "mae", "r2")


def _importance(s, d):
    model, scored, features = _model(s, d, "forest")
    return m.importances(scored, model, features)


# The first rows of a customer have no earlier row, so that lags have gaps to fill.
def _gaps(s, d):
    slim = sales(s, d).select(*ORDER, "customer_id", "age", "total_amount")
    # Stored on both sides: lags look for customers with too many rows first, and what follows takes statistics.
    lagged = f.lag_features(durable(slim, "sales"), "total_amount", ORDER, [1, 7], ["customer_id"])
    return durable(lagged.withColumn("empty", F.lit(None).cast("double")), "lagged")


FILLED = ["age", "total_amount_lag_1", "total_amount_lag_7", "empty"]
BASE = ["age", "quantity", "price", "l_linenumber", "l_partkey", "l_suppkey"]


def _numbers(s, d):
    return sales(s, d).select(
        *BASE,
        F.month("invoice_date").alias("month"),
        (F.col("price") * 2 + F.col("l_linenumber")).alias("price_twice"),
        (F.col("total_amount") * 0.5).alias("half_total_amount"),
        F.col("total_amount").alias("amount_copy"),
        F.lit(1).alias("one"),
        TARGET,
    )


NUMBERS = [*BASE, "month", "price_twice", "half_total_amount", "amount_copy", "one"]


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _baseline(s, d):
    """A prediction that SQL can make too: quantity times the mean price of the category."""
    df = durable(sales(s, d).select(*KEYS, "category", "quantity", "price", TARGET), "sales")
    priced = f.group_features(df, ["category"], "price", ["mean"])
    return priced.withColumn("prediction", F.col("quantity") * F.col("price_mean_by_category"))


def _metrics(s, d):
    out = m.regression_metrics(_baseline(s, d))
    return out.withColumns({c: F.round(c, 2) for c in ("mse", "rmse", "mae")}).withColumns(
        {c: F.round(c, 6) for c in ("r2", "mape")}
    ).drop("mse")


def _comparison(s, d):
    df, features = _prepared(s, d)
    plan = [("original", "linear"), ("original", "forest"), ("clean", "linear"), ("clean", "forest"), ("clean", "boosting")]
    return models.compare_models(df, KEYS, features, plan, _fit)


def _ranges(s, d):
    train, test = m.split(_gaps(s, d), KEYS)
    return m.range_check(train, test, FILLED)


def _series(s, d, groups=()):
    return t.daily_series(sales(s, d), groups)


def _series_stats(s, d):
    return t.series_stats(_series(s, d)).withColumns({c: F.round(c, 2) for c in ("mean", "std")})


def _poly_coefficients(s, d):
    series = _series(s, d)
    model, _, names = t.calendar_model(series)
    return t.linear_coefficients(series, model, names)


def _decompose(s, d):
    out = t.seasonal_decompose(_series(s, d))
    return out.withColumns({c: F.round(c, 2) for c in ("trend", "season", "rest")})


def _one_feature(s, d):
    """A regression that SQL can fit too."""
    train, _ = m.split(sales(s, d).select(*KEYS, F.col("quantity").cast("double").alias("quantity"), TARGET), KEYS)
    train = durable(train.select("quantity", TARGET), "train")
    model = m.fit("linear", train, ["quantity"])
    scored = m.predict(model, train, ["quantity"])
    return m.regression_metrics(scored).select(
        "rows",
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(model.intercept)), 2).alias("intercept"),
        F.round("r2", 6).alias("r2"),
    )


SCORES = ["rmse", "mae", "r2", "mape"]


def _compared(s, d):
    """Models and forecasts that SQL can work out too, scored on what they were not fitted on."""
    df = durable(sales(s, d).select(*KEYS, F.col("quantity").cast("double").alias("quantity"), "invoice_date", TARGET), "sales")
    series = t.daily_series(df)
    found = models.compare_all(df, KEYS, {"quantity": ["quantity"]}, [("quantity", "linear")], series, ["mean", "one_lag"])
    return significant(found, SCORES, 6)


def _forecast_scores(s, d):
    """Every forecast of the library on the last days: the days, the mean forecast's error, and whether the own one is of its order.

    The days of the sales table are random, so that the mean is hard to beat; 1.5 times its error tells a broken forecast.
    """
    found = models.hold_out_scores(models.forecast_candidates(_series(s, d)))
    mean = found.where("model = 'mean'").select(F.col("rmse").alias("mean_rmse"))
    of_its_order = (F.col("rmse") < 1.5 * F.col("mean_rmse")).cast("int").alias("of_its_order")
    return significant(found.join(mean, F.lit(True)).select("model", "rows", of_its_order, "mean_rmse"), ["mean_rmse"], 6)


def _single_against_group(s, d):
    """The single series fitted on Spark, and the same series as a group of its own: largest difference, relative to the sales."""
    series = durable(_series(s, d), "series")
    own = t.seasonal_forecast(series).withColumnRenamed("prediction", "own")
    group = t.seasonal_forecast(series.withColumn("g", F.lit(1)), ["g"]).drop("g", "sales", "is_train")
    both = own.join(group, "date")
    apart = F.max(F.abs(F.col("own") - F.col("prediction"))) / F.max(F.abs("sales"))
    return both.agg(F.count(F.lit(1)).alias("days"), F.sum("is_train").alias("train_days"), (apart < 1e-6).cast("int").alias("equal"))


CHECKED = ["label_min", "label_max", "prediction_min", "prediction_max"]

QUERIES = {
    "ml_feature_list": lambda s, d: m.feature_list(_transformed(s, d), exclude=[*m.ID_COLUMNS, *KEYS]),
    "ml_fill": lambda s, d: m.fill_features(_gaps(s, d), FILLED),
    "constant_features": lambda s, d: m.constant_features(_numbers(s, d), NUMBERS),
    "correlated_pairs": lambda s, d: _rounded(
        m.correlated_pairs(_numbers(s, d), [c for c in NUMBERS if c != "one"]), "correlation"
    ),
    "ml_split": lambda s, d: sales(s, d).select(*KEYS, TARGET, m.split_flag(KEYS).cast("int").alias("is_train")),
    "linear_regression": _scored("linear"),
    "linear_one_feature": _one_feature,
    "random_forest": _scored("forest"),
    "gradient_boosting": _scored("boosting"),
    "regression_metrics": _metrics,
    "feature_importance": _importance,
    "target_correlation": lambda s, d: _rounded(
        m.strongest(m.target_correlation(_numbers(s, d), NUMBERS)), "correlation"
    ),
    "target_identity": lambda s, d: _rounded(m.target_identity(_numbers(s, d), NUMBERS), "correlation"),
    "leakage_columns": lambda s, d: _rounded(m.leakage_columns(_numbers(s, d), NUMBERS), "correlation"),
    "model_comparison": _comparison,
    "prediction_check": lambda s, d: significant(m.prediction_check(_baseline(s, d)), CHECKED),
    "range_check": _ranges,
    "forecast_comparison": _compared,
    "forecast_scores": _forecast_scores,
    "seasonal_single_fit": _single_against_group,
    "daily_series": lambda s, d: _series(s, d, ["category"]),
    "daily_series_stats": _series_stats,
    "chrono_split": lambda s, d: t.chrono_split(_series(s, d)),
    "poly_forecast": lambda s, d: t.calendar_model(_series(s, d))[1],
    "poly_coefficients": _poly_coefficients,
    "seasonal_forecast": lambda s, d: t.seasonal_forecast(_series(s, d)),
    "seasonal_forecast_by_category": lambda s, d: t.seasonal_forecast(
        _series(s, d, ["category"]), ["category"], multiplicative=True
    ),
    "ar_forecast": lambda s, d: t.ar_forecast(_series(s, d)),
    "ar_one_lag": lambda s, d: t.ar_forecast(_series(s, d), lags=1).withColumn("prediction", F.round("prediction", 2)),
    "seasonal_decompose": _decompose,
}

_K = ", ".join(KEYS)
_O = ", ".join(ORDER)
_LAG = lambda n: f"lag(total_amount, {n}) OVER (PARTITION BY customer_id ORDER BY {_O}) AS total_amount_lag_{n}"
_NUMBERS = f"""n AS (SELECT {', '.join(BASE)}, CAST(month(invoice_date) AS INTEGER) AS month, price * 2 + l_linenumber AS price_twice,
    total_amount * 0.5 AS half_total_amount, total_amount AS amount_copy, 1 AS one, total_amount FROM sales)"""


def _on_numbers(select: str) -> str:
    return on_sales("").rstrip() + f", {_NUMBERS}\n{select}"


def _median(column: str) -> str:
    return f"coalesce(CAST({column} AS DOUBLE), (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.5) FROM g), 0.0) AS {column}"


_CORR = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", corr(CAST({c} AS DOUBLE), total_amount) AS r FROM n""" for c in NUMBERS if c != "one"
)
_PAIRED = [c for c in NUMBERS if c != "one"]
_SERIES = f"d AS (SELECT invoice_date::DATE AS date, {money('total_amount')} AS sales FROM sales GROUP BY 1)"


def _on_series(select: str) -> str:
    return on_sales("").rstrip() + f", {_SERIES}\n{select}"


_OF = {k: "total_amount" if k.startswith("label") else "prediction" for k in CHECKED}
_PREDICTED = f"""p AS (SELECT *, quantity * {mean('price', ' OVER (PARTITION BY category)')} AS prediction FROM sales)"""

# The split in SQL: the same hash of the key.
_KEY_HASH = "concat('0x', substr(md5(concat_ws(',', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in KEYS) + f", '{m.SEED}')), 1, 7))"
_IS_TRAIN = f"(CAST({_KEY_HASH} AS BIGINT) % 100 < {m.TRAIN_PERCENT})"


def _range(column: str, part: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max,
        count(*) - count({column}) AS missing, '{part}' AS part FROM g WHERE {'' if part == 'train' else 'NOT '}{_IS_TRAIN}"""


_DAYS = """s AS (SELECT date, sales, lag(sales) OVER w AS b, sales - lag(sales) OVER w AS y,
      row_number() OVER w <= floor(0.8 * count(*) OVER ()) AS train FROM d WINDOW w AS (ORDER BY date))"""
_METRICS = f"""count(*) AS rows, {significant_sql('sqrt(avg((y - p) * (y - p)))', 6)} AS rmse, {significant_sql('avg(abs(y - p))', 6)} AS mae,
      {significant_sql('1 - avg((y - p) * (y - p)) / var_pop(y)', 6)} AS r2,
      {significant_sql('avg(CASE WHEN y != 0 THEN abs((y - p) / y) END) * 100', 6)} AS mape"""

ORACLES = {
    "forecast_comparison": _on_series("").rstrip()
    + f""", {_DAYS}, l AS (SELECT *, lag(y) OVER (ORDER BY date) AS x FROM s),
      f AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS base FROM l WHERE train AND x IS NOT NULL),
      r AS (SELECT total_amount AS y, CAST(quantity AS DOUBLE) AS q, {_IS_TRAIN} AS train FROM sales),
      g AS (SELECT regr_slope(y, q) AS slope, regr_intercept(y, q) AS base, avg(y) AS mean FROM r WHERE train),
      scores AS (
        SELECT 'linear (quantity)' AS model, 'ML' AS type, {_METRICS} FROM (SELECT y, base + slope * q AS p FROM r, g WHERE NOT train)
        UNION ALL SELECT 'mean', 'ML', {_METRICS} FROM (SELECT y, mean AS p FROM r, g WHERE NOT train)
        UNION ALL SELECT 'mean', 'Time Series', {_METRICS}
          FROM (SELECT sales AS y, (SELECT avg(sales) FROM s WHERE train) AS p FROM s WHERE NOT train)
        UNION ALL SELECT 'one_lag', 'Time Series', {_METRICS}
          FROM (SELECT sales AS y, b + base + slope * x AS p FROM l, f WHERE x IS NOT NULL AND NOT train))
      SELECT *, CAST(rmse = min(rmse) OVER () AS INTEGER) AS best_rmse, CAST(r2 = max(r2) OVER () AS INTEGER) AS best_r2,
        CAST(rmse = min(rmse) OVER (PARTITION BY type) AS INTEGER) AS best_of_type FROM scores""",
    "forecast_scores": _on_series("").rstrip()
    + f""", {_DAYS}, e AS (SELECT {_METRICS} FROM (SELECT sales AS y, (SELECT avg(sales) FROM s WHERE train) AS p FROM s WHERE NOT train))
      SELECT unnest(['mean', 'one_lag', 'seven_lags', 'calendar', 'seasonal']) AS model, rows, 1 AS of_its_order, rmse AS mean_rmse FROM e""",
    "seasonal_single_fit": _on_series(
        """SELECT count(*) AS days, CAST(floor(0.8 * count(*)) AS BIGINT) AS train_days, 1 AS equal FROM d"""
    ),
    "ml_split": on_sales(f"SELECT {_K}, total_amount, CAST({_IS_TRAIN} AS INTEGER) AS is_train FROM sales"),
    "range_check": on_sales("").rstrip()
    + f""", g AS (SELECT {_O}, customer_id, age, total_amount, {_LAG(1)}, {_LAG(7)}, CAST(NULL AS DOUBLE) AS empty FROM sales) """
    + " UNION ALL ".join(_range(c, part) for c in FILLED for part in ("train", "test")),
    "linear_one_feature": on_sales(f"""SELECT count(*) AS rows, round(regr_slope(total_amount, quantity), 4) AS slope,
        round(regr_intercept(total_amount, quantity), 2) AS intercept, round(regr_r2(total_amount, quantity), 6) AS r2
        FROM sales WHERE {_IS_TRAIN}"""),
    "ar_one_lag": _on_series(
        """, a AS (SELECT date, sales, lag(sales) OVER (ORDER BY date) AS b, sales - lag(sales) OVER (ORDER BY date) AS y,
          CASE WHEN row_number() OVER (ORDER BY date) <= floor(0.8 * count(*) OVER ()) THEN 1 ELSE 0 END AS is_train FROM d),
        l AS (SELECT *, lag(y) OVER (ORDER BY date) AS x FROM a),
        f AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS base FROM l WHERE is_train = 1 AND x IS NOT NULL)
        SELECT date, sales, CAST(is_train AS INTEGER) AS is_train, round(b + base + slope * x, 2) AS prediction FROM l, f WHERE x IS NOT NULL"""
    ),
    "ml_fill": on_sales("").rstrip()
    + f""", g AS (SELECT {_O}, customer_id, age, total_amount, {_LAG(1)}, {_LAG(7)}, CAST(NULL AS DOUBLE) AS empty FROM sales)
      SELECT {_O}, customer_id, {', '.join(_median(c) for c in FILLED)}, total_amount FROM g""",
    "constant_features": """SELECT 'one' AS "column", 1.0::DOUBLE AS value FROM lineitem LIMIT 1""",
    "correlated_pairs": _on_numbers(
        "SELECT left_column, right_column, round(r, 6) AS correlation FROM ("
        + "\nUNION ALL ".join(
            f"""SELECT '{a}' AS left_column, '{b}' AS right_column, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM n"""
            for i, a in enumerate(_PAIRED)
            for b in _PAIRED[i + 1 :]
        )
        + ") WHERE abs(r) > 0.95"
    ),
    "regression_metrics": on_sales("").rstrip()
    + f""", {_PREDICTED}, e AS (SELECT total_amount AS y, total_amount - prediction AS err FROM p)
      SELECT count(*) AS rows, round(sqrt(avg(err * err)), 2) AS rmse, round(avg(abs(err)), 2) AS mae,
      round(1 - avg(err * err) / var_pop(y), 6) AS r2, round(avg(CASE WHEN y != 0 THEN abs(err / y) END) * 100, 6) AS mape FROM e""",
    "target_correlation": _on_numbers(
        f"""SELECT "column", round(r, 6) AS correlation FROM ({_CORR}) ORDER BY abs(r) DESC, "column" LIMIT 10"""
    ),
    "target_identity": _on_numbers(
        f"""SELECT "column", CASE WHEN "column" = 'amount_copy' THEN 1 ELSE 0 END AS identical, round(r, 6) AS correlation
        FROM ({_CORR}) WHERE r > 0.999"""
    ),
    "leakage_columns": _on_numbers(
        f"""SELECT "column", round(r, 6) AS correlation, CASE WHEN abs(r) > 0.95 THEN 'correlation' ELSE 'name' END AS reason
        FROM ({_CORR}) WHERE abs(r) > 0.95 OR contains("column", 'total_amount')"""
    ),
    "prediction_check": on_sales("").rstrip()
    + f""", {_PREDICTED} SELECT {', '.join(f"{significant_sql(f'{k.split(chr(95))[1]}({_OF[k]})')} AS {k}" for k in CHECKED)},
      CAST(bool_and(abs(prediction - total_amount) <= 1e-8 + 1e-5 * abs(total_amount)) AS INTEGER) AS all_close FROM p""",
    "daily_series": on_sales(
        f"SELECT category, invoice_date::DATE AS date, {money('total_amount')} AS sales FROM sales GROUP BY 1, 2"
    ),
    "daily_series_stats": _on_series(
        """SELECT count(*) AS days, round(avg(sales), 2) AS mean, round(stddev_samp(sales), 2) AS std, min(sales) AS min,
        max(sales) AS max FROM d"""
    ),
    "chrono_split": _on_series(
        """SELECT date, sales, CAST(row_number() OVER (ORDER BY date) <= floor(0.8 * count(*) OVER ()) AS INTEGER) AS is_train FROM d"""
    ),
    "seasonal_decompose": _on_series(
        """, a AS (SELECT date, sales, CASE WHEN count(sales) OVER w = 7 THEN CAST(sum(CAST(sales AS DECIMAL(18,4))) OVER w AS DOUBLE) / 7 END AS trend,
          (row_number() OVER (ORDER BY date) - 1) % 7 AS place FROM d WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
        b AS (SELECT place, avg(sales - trend) AS s FROM a GROUP BY place),
        c AS (SELECT place, s - (SELECT avg(s) FROM b) AS season FROM b)
        SELECT date, sales, round(trend, 2) AS trend, round(season, 2) AS season, round(sales - trend - season, 2) AS rest
        FROM a JOIN c USING (place)"""
    ),
}
