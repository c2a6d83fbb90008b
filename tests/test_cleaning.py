import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.functions import text
from marketloom.operators import cleaning as c
from marketloom.operators import profiling
from marketloom.operators.cleaning_log import CleaningLog
from marketloom.plans.cleaning import clean_sales, clean_table
from marketloom.queries.fixtures import raw_sales
from marketloom.schema import RAW_SALES
from marketloom.session import durable


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, "a", 10), (1, "b", 20), (None, "c", 1), (None, "d", 2), (3, "e", 5)], "k int, s string, n int")
    assert c.remove_duplicates(df).count() == 5
    first = c.remove_duplicates(df, ["k"], "first", ["n"])
    assert {(r.k, r.s) for r in first.collect()} == {(1, "a"), (None, "c"), (3, "e")}
    last = c.remove_duplicates(df, ["k"], "last", ["n"])
    assert {(r.k, r.s) for r in last.collect()} == {(1, "b"), (None, "d"), (3, "e")}
    assert [tuple(r) for r in c.remove_duplicates(df, ["k"], False).collect()] == [(3, "e", 5)]
    assert c.remove_duplicates(df, keep=False).count() == 4
    again = c.remove_duplicates(first, ["k"], "first", ["n"])
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))
    with pytest.raises(ValueError):
        c.remove_duplicates(df, ["k"], "first")
    with pytest.raises(ValueError):
        c.remove_duplicates(df, ["k"], "any", ["n"])


def test_date_format_is_chosen_per_column(spark):
    df = spark.createDataFrame([("5/8/2022",), ("24/10/2021",), ("2021-01-02",)], "d string")
    found = [r.d for r in c.standardize_dates(df, ["d"]).orderBy("d").collect()]
    assert found == [None, None, dt.datetime(2021, 1, 2)]
    each = {r.d for r in c.standardize_dates(df, ["d"], per_row=True).collect()}
    assert each == {dt.datetime(2022, 8, 5), dt.datetime(2021, 10, 24), dt.datetime(2021, 1, 2)}


def test_date_fallbacks(spark):
    free = spark.createDataFrame([("2021-01-02 03:04:05",), ("x",)], "d string")
    assert {r.d for r in c.standardize_dates(free, ["d"]).collect()} == {dt.datetime(2021, 1, 2, 3, 4, 5), None}
    empty = spark.createDataFrame([(None,)], "d string")
    assert c.standardize_dates(empty, ["d", "absent"]).collect()[0].d is None
    american = spark.createDataFrame([("13/25/2021",), ("12/25/2021",)], "d string")
    assert {r.d for r in c.standardize_dates(american, ["d"]).collect()} == {None, dt.datetime(2021, 12, 25)}


def test_text(spark):
    df = spark.createDataFrame([("\t A b\u00a0\n",), (None,), ("",)], "t string")
    assert {r.t for r in c.standardize_text(df).collect()} == {"a b", None, ""}
    assert {r.t for r in c.standardize_text(df, reference_nulls=True).collect()} == {"a b", "nan", ""}
    assert {r.t for r in c.standardize_text(df, lowercase=False).collect()} == {"A b", None, ""}
    assert all(x.isspace() for x in text.WHITE_SPACE) and len(set(text.WHITE_SPACE)) == len(text.WHITE_SPACE)


def test_types(spark):
    df = spark.createDataFrame([("1", "x", 2.5, "2021-02-03"), ("1.0", "2.5", 3.0, "no"), ("1.5", "nan", None, None)], "a string, b string, c double, d string")
    out = c.coerce_types(df, {"a": "int", "b": "float64", "c": "int64", "d": "datetime", "absent": "str"}).collect()
    # A fraction keeps the whole column from becoming an integer one.
    assert [r.a for r in out] == [1.0, 1.0, 1.5]
    assert [r.b for r in out] == [None, 2.5, None]
    assert [r.c for r in out] == [2.5, 3.0, None]
    whole = spark.createDataFrame([("1", 2.0), ("1.0", 3.0), ("x", None)], "a string, c double")
    typed = c.coerce_types(whole, {"a": "int", "c": "int64"})
    assert [tuple(r) for r in typed.collect()] == [(1, 2), (1, 3), (None, None)]
    assert [t for _, t in typed.dtypes] == ["bigint", "bigint"]
    assert {r["column"]: r.lost for r in c.coercion_losses(whole, typed).collect()} == {"a": 1, "c": 0}
    assert [r.d for r in out] == [dt.datetime(2021, 2, 3), None, None]
    with pytest.raises(ValueError):
        c.coerce_types(df, {"a": "complex"})


def test_sparse_threshold_is_strict(spark):
    df = spark.createDataFrame([(None if i < 3 else i, None if i < 4 else i, i) for i in range(10)], "at int, above int, full int")
    assert c.drop_sparse_columns(df, 0.3).columns == ["at", "full"]
    assert c.sparse_columns(df.limit(0)) == []


def test_imputation(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, "b", 1), (3.0, "a", None), (nan, None, 2), (None, "a", 9), (10.0, "b", 4)], "x double, s string, n int")
    out = c.impute(df)
    assert sorted(r.x for r in out.collect()) == [1.0, 3.0, 3.0, 3.0, 10.0]
    assert sorted(r.s for r in out.collect()) == ["a", "a", "a", "b", "b"]  # a tie goes to the smallest
    assert sorted(r.n for r in out.collect()) == [1.0, 2.0, 3.0, 4.0, 9.0]
    assert c.impute(df, "mode").where("x = 3").count() == 3
    mean = sorted(r.x for r in c.impute(df, "mean").collect())
    assert mean[1:4] == pytest.approx([3.0, 14 / 3, 14 / 3])
    assert c.handle_missing(df, "drop", 1.0).count() == 2
    with pytest.raises(ValueError):
        c.impute(df, "guess")


def test_all_missing_column_stays(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, s string")
    assert rows(c.impute(df)) == [(None, None), (None, None)]


def test_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 1000.0, -1000.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    capped = [r.v for r in c.handle_outliers(df, ["v", "absent"]).collect()]
    assert len(capped) == len(values) and capped.count(None) == 1
    bound = c.iqr_bounds(df, ["v"])["v"]
    assert max(v for v in capped if v is not None) == bound.high
    assert min(v for v in capped if v is not None) == bound.low
    assert rows(c.handle_outliers(df, ["v"], "zscore").where("v is not null")) == rows(df.where("v is not null"))
    assert c.flag_outliers(df, ["v"], "zscore", 1.0).agg(F.sum("v_outlier")).first()[0] == 2
    assert c.outlier_report(df, ["v"], ["iqr"]).first().outlier_count == 2
    same = spark.createDataFrame([(5.0,)] * 3, "v double")
    assert c.outlier_report(same, ["v"]).agg(F.sum("outlier_count")).first()[0] == 0
    with pytest.raises(ValueError):
        c.handle_outliers(df, ["v"], "other")


GOLDEN = ("I138884", "C241288", " Female ", 28, "Clothing", 5, 1500.40, "Credit Card", "8/3/2022", "Kanyon")


def test_golden_row(spark):
    out = clean_sales(spark.createDataFrame([GOLDEN, GOLDEN], RAW_SALES)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.gender, r.category, r.payment_method, r.shopping_mall) == ("female", "clothing", "credit card", "kanyon")
    assert r.invoice_date == dt.datetime(2022, 3, 8) and r.total_amount == pytest.approx(7502.0)
    assert (r.year, r.month, r.day, r.day_of_week, r.quarter) == (2022, 3, 8, 1, 1)


def test_optional_columns_may_be_absent(spark):
    raw = spark.createDataFrame([("A ", 1.0), ("A ", 1.0), ("B", None), ("C", 5.0), ("D", 2.0)], "category string, price double")
    out = clean_sales(raw, reference_nulls=False)
    assert out.columns == ["category", "price"] and out.count() == 4
    assert clean_table(raw).where("price is null").count() == 0


def test_reports(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (float("inf"), "b")], "x double, s string")
    report = {r.column: r for r in profiling.missing_report(df).collect()}
    assert report["x"].missing_count == 1 and report["s"].missing_percent == pytest.approx(100 / 3)
    finite = profiling.finite_check(df).first()
    assert (finite.infinite_count, finite.missing_count, finite.ready) == (1, 1, 0)
    status = {r.column: r.status for r in profiling.schema_check(df, ["s", "x", "y"]).collect()}
    assert status == {"s": "moved", "x": "moved", "y": "missing"}
    assert profiling.missing_report(df.limit(0)).first().missing_percent is None


def test_general_statistics_of_any_size(spark):
    from marketloom.operators import profiling as p

    df = spark.createDataFrame([(1e-5, 1e15, 2.0), (2e-5, 3e15, float("inf")), (4e-5, 5e15, 4.0)], "t double, h double, i double")
    rows = {r["column"]: r for r in p.describe_numeric(df, ["t", "h", "i"]).collect()}
    assert rows["t"]["mean"] == pytest.approx(7e-5 / 3) and rows["h"]["mean"] == 3e15 and rows["i"]["mean"] == float("inf")
    fills = c.numeric_fills(df, ["t", "h"], "mean")
    assert fills["t"] == pytest.approx(7e-5 / 3) and fills["h"] == 3e15
    bounds = c.zscore_bounds(df, ["t"], 1.0)["t"]
    assert bounds.low < 7e-5 / 3 < bounds.high and bounds.low > 0


def test_all_numeric_columns_are_imputed_but_keys(spark):
    raw = spark.createDataFrame([GOLDEN, GOLDEN], RAW_SALES)
    raw = raw.withColumn("line", F.monotonically_increasing_id()).withColumn("discount", F.lit(None).cast("double"))
    more = raw.withColumn("discount", F.when(F.col("line") % 2 == 0, 0.5)).unionByName(raw.withColumn("discount", F.lit(0.25)))
    out = clean_sales(more, keys=["line"])
    assert out.where("discount is null").count() == 0
    assert out.schema["line"].dataType.typeName() == "long"


def test_log_counts_inside_the_cleaning_jobs(spark):
    """The log needs no job, and so no scan, beyond those of the cleaning itself."""
    raw = raw_sales(spark, "/root/testdata/sf0.001")
    jobs = []
    for label, log in (("plain", None), ("logged", CleaningLog())):
        spark.sparkContext.setJobGroup(f"cleaning-{label}", label)
        durable(clean_sales(raw, log=log), "cleaned")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"cleaning-{label}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]
    rows = {(r.step, r.column, r.metric): r.value for r in log.frame(spark).collect()}
    assert rows["duplicates", None, "rows_removed"] == raw.count() - raw.distinct().count()
    assert rows["missing", "price", "filled"] > 0 and rows["outliers", "price", "capped"] > 0
    assert [r.position for r in log.frame(spark).orderBy("position").collect()] == list(range(len(rows)))


def test_log_of_values_that_are_lost(spark):
    rows = [("1", "c", " F ", "x", "A", "2", 1.0, "card", "2022-01-02", "m"), ("2", "c", "f", "30", "a", "3.5", None, "card", "never", "m")]
    raw = spark.createDataFrame(
        rows,
        "invoice_no string, customer_id string, gender string, age string, category string, quantity string, price double, "
        "payment_method string, invoice_date string, shopping_mall string",
    )
    log = CleaningLog()
    durable(clean_sales(raw, log=log), "cleaned")
    got = {(r.step, r.column, r.metric): (r.value, r.detail) for r in log.frame(spark).collect()}
    assert got["dates", "invoice_date", "lost"] == (1.0, None) and got["dates", "invoice_date", "format"][1] == "yyyy-M-d"
    assert got["types", "age", "lost"][0] == 1 and got["types", "quantity", "lost"][0] == 0
    assert got["text", "gender", "changed"][0] == 1 and got["text", "category", "changed"][0] == 1
    assert got["columns", "price", "dropped"][0] == 0.5
