"""Inputs that are read more than once are stored first, missing keys do not meet in one task, and statistics are taken once."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.functions import amounts
from marketloom.operators import cleaning, features, forecasting, lookups, modelling, ordering
from marketloom.queries import registry

SF = "/root/testdata/sf0.001"


def _files(df):
    return {p.rsplit("/", 2)[1].rsplit("-", 1)[0] if "/part-" in p else p.rsplit("/", 1)[1] for p in df.inputFiles()}


def _days(spark, path):
    days = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=i), float(100 + i * 7 % 13)) for i in range(60)]
    spark.createDataFrame(days, "invoice_date timestamp_ntz, total_amount double").write.parquet(path)
    return forecasting.daily_series(spark.read.parquet(path))


def test_forecasts_add_up_the_transactions_once(spark, tmp_path):
    series = _days(spark, str(tmp_path / "days"))
    for out in (
        forecasting.ar_forecast(series),
        forecasting.ar_forecast(series, lags=1),
        forecasting.calendar_model(series)[1],
        forecasting.seasonal_forecast(series),
        forecasting.seasonal_decompose(series),
        forecasting.mean_forecast(series),
    ):
        assert _files(out) == {"series"}


def test_queries_store_what_they_read_again(spark):
    for name in ("ml_fill", "customer_summary_ext", "rfm_features", "rolling_global", "forward_fill", "cleaning_report"):
        assert not any(f.startswith("lineitem") for f in _files(registry.queries()[name](spark, SF))), name


def test_copies_are_merged_once_for_the_cleaning_report(spark):
    assert "deduplicated" in _files(registry.queries()["cleaning_report"](spark, SF))


def test_medians_of_columns_with_gaps_only(spark, monkeypatch):
    asked = []
    found = cleaning.numeric_fills
    monkeypatch.setattr(cleaning, "numeric_fills", lambda df, columns, *rest: asked.append(list(columns)) or found(df, columns, *rest))
    df = spark.createDataFrame([(1.0, 5.0, None, 1.0), (None, 6.0, None, 2.0), (3.0, float("nan"), None, 3.0)], "a double, b double, c double, total_amount double")
    rows = modelling.fill_features(df, ["a", "b", "c"]).orderBy("total_amount").collect()
    assert asked == [["a", "b", "c"]]
    assert [tuple(r) for r in rows] == [(1.0, 5.0, 0.0, 1.0), (2.0, 6.0, 0.0, 2.0), (3.0, 5.5, 0.0, 3.0)]
    assert modelling.fill_features(df.select("total_amount"), []).count() == 3
    assert asked[1] == []


def test_missing_keys_are_spread_over_the_tasks(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 10).cast("string").alias("key"))
    table = spark.createDataFrame([("key", str(i), i) for i in (0, 2, 4)], "column string, value string, code int")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        coded = lookups.lookup_columns(df, table, ["key"], "code", "_code")
        looked = lookups.lookup(df, table.select(F.col("value").alias("key"), "code"), ["key"])
        for out, name in ((coded, "key_code"), (looked, "code")):
            assert set(out.columns) == {"id", "key", name}
            rows = out.select("key", F.spark_partition_id().alias("place")).collect()
            missing = [r["place"] for r in rows if r["key"] is None]
            assert len(missing) == 2000 and len(set(missing)) > 1
            assert out.where(f"{name} is not null").count() == 1200 and out.count() == 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rolling_means_from_running_sums(spark):
    rows = [(g, i, None if i % 7 == 3 or i < 3 else i * 1.37 + 0.01) for g in ("a", "b", None) for i in range(45)]
    df = spark.createDataFrame(rows, "g string, i long, v double")
    makers = features.rolling_mean_makers("v", [3, 7, 30])
    line = Window.partitionBy("g").orderBy("i")
    for hot_rows in (10, 1000):
        out = ordering.ordered_columns(df, ["i"], makers, 29, ["g"], hot_rows=hot_rows, running=features.running_makers("v"))
        assert out.columns == ["g", "i", "v", *makers]
        plain = df.withColumns({f"v_rolling_mean_{n}": F.when(F.col("g").isNotNull(), amounts.mean("v", line.rowsBetween(1 - n, 0))) for n in (3, 7, 30)})
        assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_parts_grow_with_the_table(spark, monkeypatch):
    from marketloom.queries import sources

    monkeypatch.setattr(sources, "PART_ROWS", 100)
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert sources._parts(spark, SF, 6) == -(-rows // 100)
    path = sources._write_by_mall(spark, SF)
    counts = [r["count"] for r in spark.read.option("header", True).csv(path).groupBy("_metadata.file_path").count().collect()]
    assert sum(counts) == rows and max(counts) < rows / 10


def test_each_date_text_is_parsed_once(spark):
    df = spark.createDataFrame([("2024-01-02", "x", None), ("31/12/2023", "x", None)] * 3, "a string, b string, c string")
    assert cleaning.choose_date_formats(df, ["a", "b", "c"])["a"] is not None
    assert {k: v for k, v in cleaning.choose_date_formats(df, ["a", "b", "c"]).items() if k != "a"} == {"b": None, "c": None}
