import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators import aggregates as a
from marketloom.operators import features as f
from marketloom.plans import reports as r
from marketloom.plans.transform import transform_sales


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def sales(spark):
    data = [
        (1, "I1", "C1", "female", 30, "toys", 2, 10.0, "cash", day(0), "m1"),
        (2, "I2", "C1", "female", 30, "books", 1, 5.0, "card", day(0), "m1"),
        (3, "I3", "C1", "female", 30, "toys", 1, 10.0, "cash", day(3), "m2"),
        (4, "I4", "C2", "male", 40, "food", 5, 5.0, None, day(1), "m2"),
        (5, None, None, "male", 41, None, 1, 7.0, "cash", day(6), "m1"),
    ]
    schema = (
        "id int, invoice_no string, customer_id string, gender string, age long, category string, quantity long, "
        "price double, payment_method string, invoice_date timestamp_ntz, shopping_mall string"
    )
    return spark.createDataFrame(data, schema).withColumn("total_amount", F.col("price") * F.col("quantity"))


def by_id(df):
    return {x.id: x for x in df.collect()}


def test_lag_and_rolling(sales):
    out = by_id(f.lag_features(sales, "total_amount", ["invoice_date", "id"], [1], ["customer_id"]))
    assert [out[i].total_amount_lag_1 for i in (1, 2, 3, 4, 5)] == [None, 20.0, 5.0, None, None]
    roll = by_id(f.rolling_features(sales, "total_amount", ["invoice_date", "id"], [2], ["customer_id"], ["mean", "std", "sum"]))
    assert roll[1].total_amount_rolling_std_2 is None and roll[1].total_amount_rolling_mean_2 == 20.0
    assert roll[3].total_amount_rolling_sum_2 == 15.0
    assert roll[5].total_amount_rolling_sum_2 is None
    with pytest.raises(ValueError):
        f.rolling_features(sales, "total_amount", ["id"], [2], functions=["mad"])


@pytest.mark.parametrize(
    "date, week, end",
    [("2021-01-01", 53, 0), ("2020-12-31", 53, 1), ("2024-12-30", 1, 0), ("2024-02-29", 9, 1)],
)
def test_iso_week_and_month_end(spark, date, week, end):
    out = f.date_features(spark.createDataFrame([(date,)], "d string"), "d").first()
    assert (out.week_of_year, out.is_month_end) == (week, end)


def test_missing_date(spark):
    out = f.date_features(spark.createDataFrame([(None,)], "d timestamp_ntz"), "d").first()
    assert (out.season, out.is_weekend, out.is_month_start, out.is_month_end, out.year) == (4, 0, 0, 0, None)


def test_iso_year(sales, spark):
    df = sales.withColumn("invoice_date", F.lit("2021-01-01").cast("timestamp_ntz"))
    assert tuple(a.sales_by_period(df, "week").first()[:2]) == (2020, 53)
    with pytest.raises(ValueError):
        a.sales_by_period(df, "hour")


def test_encodings(sales):
    label = by_id(f.encode(sales, ["category", "absent"], "label"))
    assert [label[i].category_encoded for i in (1, 2, 4, 5)] == [2, 0, 1, -1]
    share = by_id(f.encode(sales, ["category"], "frequency"))
    assert share[1].category_freq == 0.5 and share[5].category_freq is None
    hot = by_id(f.encode(sales, ["category"], "onehot"))
    assert "category_books" not in hot[1].asDict()
    assert (hot[1].category_toys, hot[4].category_food, hot[5].category_toys) == (True, True, False)
    with pytest.raises(ValueError):
        f.onehot_encode(sales, ["category"], max_levels=2)
    with pytest.raises(ValueError):
        f.encode(sales, ["category"], "hash")


def test_ratio(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 0.0), (1, None), (None, 2.0)], "n int, d double")
    assert [x[2] for x in f.ratio_feature(df, "n", "d").collect()] == [0.5, 0.0, None, None]
    assert f.ratio_feature(df, "n", "d").columns[-1] == "n_to_d_ratio"


def test_customers(sales):
    out = by_id(f.customer_features(sales))
    assert (out[1].recency, out[1].frequency, out[1].monetary) == (4, 3, 35.0)
    assert (out[4].recency, out[4].customer_std_amount) == (6, None)
    assert out[5].monetary is None
    assert by_id(f.customer_ltv(sales))[2].customer_ltv == 35.0


def test_group_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), (None, 2.0)], "g string, v double")
    out = {x.g: x for x in f.group_features(df, ["g"], "v", ["sum", "mean", "count"]).collect()}
    assert (out["a"].v_sum_by_g, out["a"].v_mean_by_g, out["a"].v_count_by_g) == (0.0, None, 0)
    assert out[None].v_sum_by_g is None


def test_category_rank_shares_ties(sales, spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 1.0), ("d", 9.0)], "category string, total_amount double")
    ranks = {x.category: x.category_rank for x in f.category_table(df).collect()}
    assert ranks == {"d": 1.0, "a": 2.5, "b": 2.5, "c": 4.0}
    split = {x.category: x.category_rank for x in f.category_table(df, hot_rows=1).collect()}
    assert split == ranks
    assert by_id(f.price_vs_category(sales))[5].price_vs_category_avg == 7.0


@pytest.mark.parametrize("hot_rows", [1, 2, 1000])
def test_transform(sales, hot_rows):
    order = ["invoice_date", "id"]
    out = by_id(transform_sales(sales, order, hot_rows))
    assert len(out) == 5
    assert out[3].total_amount_lag_1 == 5.0 and out[3].customer_ltv == 35.0 and out[3].recency == 4
    assert out[3].total_amount_count_by_customer_id == 3 and out[3].category_rank == 1.0
    assert out[3].total_amount_rolling_mean_7 == pytest.approx(35 / 3)
    assert out[5].category_encoded == -1 and out[5].monetary is None and out[5].price_vs_category_avg == 7.0


def test_dense_days(sales):
    out = a.daily_view(sales).orderBy("date").collect()
    assert len(out) == 7
    assert (out[2].total_sales, out[2].transaction_count, out[2].avg_transaction, out[2].unique_customers) == (0.0, 0, None, 0)
    assert sum(x.total_sales for x in out) == sum(x.total_sales for x in a.sales_by_category(sales).collect())
    assert a.daily_view(sales.limit(0)).count() == 0


def test_null_groups(sales):
    assert a.sales_by_category(sales).where("category is null").count() == 1
    assert a.category_view(sales).where("category is null").count() == 0
    shares = a.sales_by_payment(sales)
    assert shares.agg(F.sum("percentage")).first()[0] == pytest.approx(100.0)
    long = a.sales_by_demographics(sales, ["gender", "payment_method"]).collect()
    assert {(x.dimension, x.dimension_value) for x in long} >= {("payment_method", None), ("gender", "male")}
    assert sum(x.transaction_count for x in long) == 10


def test_long_table(sales):
    out = a.aggregated_sales(sales)
    assert out.select("metrics.total_sales").where("aggregation_type = 'period'").first()[0] == 67.0
    assert out.where("aggregation_type = 'payment_method' and dimension_value is null").count() == 1


def test_save(sales, tmp_path, spark):
    path = str(tmp_path / "agg")
    assert a.save_aggregate(a.sales_by_category(sales), path) == 4
    assert a.save_aggregate(a.sales_by_category(sales), path) == 4
    assert spark.read.parquet(path).count() == 4
    assert a.save_aggregate(sales.limit(0), str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()


def test_reports(sales):
    assert r.filtered(sales, "2024-01-01", "2024-01-02").count() == 3
    assert r.filtered(sales, category="toys").count() == 2
    week = r.by_weekday(sales).collect()
    assert [x.weekday for x in week][0] == "Monday" and week[4].total_sales is None and week[0].total_sales == 25.0
    assert r.filter_domains(sales).count() == 3
    assert r.age_histogram(sales).agg(F.sum("rows")).first()[0] == 5
    assert r.age_histogram(sales.limit(0)).count() == 0
    assert r.kpis(sales).first().unique_customers == 2


def test_filter_reaches_the_scan(spark, sales, tmp_path):
    path = str(tmp_path / "s")
    sales.write.parquet(path)
    plan = r.filtered(spark.read.parquet(path), "2024-01-01", "2024-01-02").select("total_amount")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(invoice_date), GreaterThanOrEqual" in text and "LessThan(" in text
    assert "gender" not in text
