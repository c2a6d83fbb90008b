import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import forecasting as t
from marketloom.operators import modelling as m
from marketloom.plans import models


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        a, b = rng.random() * 10, rng.random() * 5
        rows.append((i, a, b, 3 * a - 2 * b + 1 + rng.gauss(0, 0.01), 2.0 * a, 1, None if i % 10 else a))
    df = spark.createDataFrame(rows, "id int, a double, b double, total_amount double, twice double, one int, gappy double")
    return df.withColumn("total_amount_copy", F.col("total_amount"))


def test_feature_roles(numbers):
    assert m.feature_columns(numbers, exclude=["id"]) == ["a", "b", "twice", "one", "gappy", "total_amount_copy"]
    roles = {r.column: r.role for r in m.feature_list(numbers, exclude=["id"]).collect()}
    assert roles["total_amount"] == "target" and roles["id"] == "left out" and roles["a"] == "feature"


def test_fill(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (3.0, None, None), (None, None, 7.0)], "x double, e double, total_amount double")
    assert sorted(map(tuple, m.fill_features(df, ["x", "e"]).collect())) == [(1.0, 0.0, 5.0), (2.0, 0.0, 7.0), (3.0, 0.0, 6.0)]


def test_constant_and_correlated(numbers):
    assert [r.column for r in m.constant_features(numbers, ["a", "one", "b"]).collect()] == ["one"]
    pairs = m.correlated_pairs(numbers, ["a", "b", "twice"]).collect()
    assert [(p.left_column, p.right_column) for p in pairs] == [("a", "twice")]
    assert m.correlated_pairs(numbers, ["a", "b"]).count() == 0


def test_leakage(numbers):
    columns = ["a", "b", "twice", "one", "gappy", "total_amount_copy"]
    found = {r.column: r.reason for r in m.leakage_columns(numbers, columns).collect()}
    assert found["total_amount_copy"] == "correlation"
    kept, again = m.clean_features(numbers.withColumn("total_amount_id", F.col("id")), [*columns, "total_amount_id"])
    assert "total_amount_id" not in kept and "b" in kept and "one" in kept
    same = {r.column: r.identical for r in m.target_identity(numbers, columns).collect()}
    assert same == {"total_amount_copy": 1}
    top = m.strongest(m.target_correlation(numbers, columns), 2).collect()
    assert top[0].column == "total_amount_copy" and top[0].correlation == pytest.approx(1.0)


def test_split_is_stable(numbers):
    train, test = m.split(numbers, ["id"])
    assert train.count() + test.count() == 600 and 420 < train.count() < 540
    ids = lambda df: {r.id for r in df.select("id").collect()}
    assert ids(m.split(numbers.repartition(7), ["id"])[0]) == ids(train)


def test_linear_model_finds_the_line(numbers):
    train, test = m.split(numbers, ["id"])
    model, scored = m.fit_predict("linear", train, test, ["a", "b"])
    assert list(model.coefficients) == pytest.approx([3, -2], abs=0.01) and model.intercept == pytest.approx(1, abs=0.02)
    metrics = m.regression_metrics(scored).first()
    assert metrics.r2 > 0.999 and metrics.rmse == pytest.approx(math.sqrt(metrics.mse))
    check = m.prediction_check(scored.withColumn("prediction", F.col("total_amount"))).first()
    assert check.all_close == 1 and m.prediction_check(scored).first().all_close == 0
    ranges = m.range_check(train, test, ["a", "gappy"]).where("part = 'train' and column = 'gappy'").first()
    assert ranges.missing > 0 and ranges.min >= 0


def test_tree_models(numbers):
    train, test = m.split(numbers, ["id"])
    model, scored = m.fit_predict("forest", train, test, ["a", "b", "one"], numTrees=5, maxDepth=5)
    assert m.regression_metrics(scored).first().r2 > 0.8
    top = m.importances(scored, model, ["a", "b", "one"]).collect()
    assert [r.feature for r in top][0] == "a" and sum(r.importance for r in top) == pytest.approx(1)
    _, boosted = m.fit_predict("boosting", train, test, ["a", "b"], maxIter=5, maxDepth=3)
    assert m.regression_metrics(boosted).first().r2 > 0.5
    defaults = m.estimator("boosting")
    assert (defaults.getMaxIter(), defaults.getMaxDepth(), defaults.getStepSize()) == (100, 6, 0.1)
    assert m.estimator("forest").getNumTrees() == 100
    with pytest.raises(ValueError):
        m.estimator("network")


def test_comparison(numbers):
    filled, features = models.prepare(numbers, ["id"])
    assert "one" not in features and filled.where("gappy is null").count() == 0
    table = models.compare_models(filled, ["id"], features, [("original", "linear"), ("clean", "linear")]).collect()
    by_set = {r.feature_set: r for r in table}
    assert by_set["original"].r2 >= by_set["clean"].r2 and by_set["original"].best_r2 == 1


@pytest.fixture(scope="module")
def series(spark):
    start = dt.date(2021, 1, 1)
    rows = []
    for i in range(900):
        day = start + dt.timedelta(days=i)
        level = 1000 + 0.5 * i + 200 * math.sin(2 * math.pi * i / 365.25) + (150 if day.weekday() >= 5 else 0)
        for g in ("x", "y"):
            rows.append((g, day, level * (2 if g == "y" else 1)))
    return spark.createDataFrame(rows, "g string, date date, sales double")


def one(series):
    return series.where("g = 'x'").select("date", "sales")


def test_series_and_split(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), 1.0), (dt.datetime(2024, 1, 1, 9), 2.0), (dt.datetime(2024, 1, 9), 4.0), (None, 9.0)], "invoice_date timestamp_ntz, total_amount double")
    assert [tuple(r) for r in t.daily_series(df).orderBy("date").collect()] == [(dt.date(2024, 1, 1), 3.0), (dt.date(2024, 1, 9), 4.0)]
    days = spark.createDataFrame([(dt.date(2024, 1, i), float(i)) for i in range(1, 8)], "date date, sales double")
    assert sum(r.is_train for r in t.chrono_split(days).collect()) == 5
    assert t.series_stats(days).first().mean == 4.0


def test_seasonal_forecast(series):
    for groups in ([], ["g"]):
        for multiplicative in (False, True):
            data = series if groups else one(series)
            out = t.seasonal_forecast(data, groups, multiplicative=multiplicative)
            assert out.count() == data.count()
            error = out.where("is_train = 0").agg(F.avg(F.abs(F.col("prediction") / F.col("sales") - 1))).first()[0]
            assert error < 0.1


def test_calendar_model(series):
    model, scored, names = t.calendar_model(one(series))
    rows = scored.where("is_train = 1").orderBy("date").collect()
    parts = [(r.date.timetuple().tm_yday, r.date.month, r.date.weekday(), (r.date.month + 2) // 3, r.date.year) for r in rows]
    x = np.array(parts, float)
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    terms = [np.ones(len(x)), *x.T, *[x[:, i] * x[:, j] for i in range(5) for j in range(i + 1)]]
    y = np.array([r.sales for r in rows])
    best = np.linalg.lstsq(np.stack(terms, axis=1), y, rcond=None)[0]
    error = ((np.stack(terms, axis=1) @ best - y) ** 2).mean()
    assert m.regression_metrics(scored.where("is_train = 1"), "sales").first().mse == pytest.approx(error, rel=0.05)
    table = {r.feature: r.coefficient for r in t.linear_coefficients(series, model, names).collect()}
    assert set(table) == set(names)
    # Spark expands two variables to x, x*x, y, x*y, y*y: the third variable's plain term is the sixth.
    assert table["day_of_year"] == pytest.approx(model.coefficients[0])
    assert table["month"] == pytest.approx(model.coefficients[2])
    assert table["day_of_week"] == pytest.approx(model.coefficients[5])


def test_ar(series):
    out = t.ar_forecast(one(series), lags=7)
    assert out.count() == 900 - 8
    assert m.regression_metrics(out.where("is_train = 0"), "sales").first().r2 > 0.8


def test_decompose(series):
    out = t.seasonal_decompose(series, 7, ["g"])
    assert out.count() == 1800 and out.where("trend is null").count() == 12
    assert out.where("trend is not null").agg(F.max(F.abs(F.col("trend") + F.col("season") + F.col("rest") - F.col("sales")))).first()[0] < 1e-6
    with pytest.raises(ValueError):
        t.seasonal_decompose(series, 6)


def daily(spark, days):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(i), 100.0 + i + 30.0 * math.sin(2 * math.pi * i / 7)) for i in range(days)]
    return spark.createDataFrame(rows, "date date, sales double")


def test_single_series_is_fitted_without_python(spark):
    series = daily(spark, 120)
    for multiplicative in (False, True):
        single = t.seasonal_forecast(series, multiplicative=multiplicative)
        plan = single._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan
        group = t.seasonal_forecast(series.withColumn("g", F.lit("a")), ["g"], multiplicative=multiplicative)
        want = {r.date: r.prediction for r in group.collect()}
        got = {r.date: r.prediction for r in single.collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 * max(want.values()) for k in want)
    assert t.seasonal_forecast(series.limit(0)).collect() == []


def test_normal_equations(spark):
    rows = [([1.0, 2.0], 3.0), ([0.5, -1.0], 2.0), ([1.0, 0.0], -1.0)]
    gram, right = t.normal_equations(spark.createDataFrame(rows, "x array<double>, y double"), "x", "y", 2)
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert np.allclose(gram, x.T @ x) and np.allclose(right, x.T @ y)


def test_all_models_in_one_table(spark):
    df = spark.createDataFrame([(i, float(i % 7), 3.0 * (i % 7) + 1.0, float(i % 3)) for i in range(300)], "k long, x double, total_amount double, z double")
    sets = {"good": ["x"], "bad": ["z"]}
    found = models.compare_all(df, ["k"], sets, [("good", "linear"), ("bad", "linear")], daily(spark, 60), ["mean", "seasonal"]).collect()
    rows = {(r.type, r.model): r for r in found}
    assert len(rows) == 5 and rows["ML", "linear (good)"].best_rmse == rows["ML", "linear (good)"].best_of_type == 1
    assert sum(r.best_rmse for r in found) == 1 and sum(r.best_of_type for r in found) == 2
    assert rows["Time Series", "seasonal"].rmse < rows["Time Series", "mean"].rmse and rows["Time Series", "mean"].rows == 12
