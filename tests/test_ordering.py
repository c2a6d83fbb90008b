"""The split path must equal one plain window, also with a dominant group, null groups and empty segments."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.functions import amounts
from marketloom.operators import ordering as o


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(1200):
        # A third of all rows in one group, some without a group, many groups with one or two rows.
        group = "hot" if i % 3 == 0 else None if i % 17 == 0 else f"g{rng.randrange(300) if i % 2 else i % 5}"
        day = None if i % 101 == 0 else i // 400
        data.append((group, day, i, rng.choice([None, float(rng.randrange(1000))])))
    return spark.createDataFrame(data, "g string, day int, id int, v double").repartition(5).cache()


def collected(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


OUT = {
    "lag2": lambda w: F.lag("v", 2).over(w),
    "sum5": lambda w: amounts.total("v", w.rowsBetween(-4, 0)),
    "std9": lambda w: F.round(F.stddev_samp("v").over(w.rowsBetween(-8, 0)), 6),
}
TOTALS = {"n": lambda w: F.count("v") if w is None else F.count("v").over(w), "total": lambda w: amounts.total("v", w)}
ORDER = ["day", "id"]


@pytest.mark.parametrize("hot_rows", [48, 399, 10_000])
def test_grouped(rows, hot_rows):
    w = Window.partitionBy("g").orderBy(*o.ascending(ORDER))
    known = F.col("g").isNotNull()
    expected = rows.withColumns({n: F.when(known, m(w)) for n, m in OUT.items()}).withColumns(
        {n: F.when(known, m(Window.partitionBy("g"))) for n, m in TOTALS.items()}
    )
    actual = o.ordered_columns(rows, ORDER, OUT, 8, ["g"], TOTALS, hot_rows)
    assert collected(actual) == collected(expected)


@pytest.mark.parametrize("hot_rows", [48, 5000])
def test_global(rows, hot_rows):
    w = Window.partitionBy().orderBy(*o.ascending(ORDER))
    expected = rows.withColumns({n: m(w) for n, m in OUT.items()})
    assert collected(o.ordered_columns(rows, ORDER, OUT, 8, hot_rows=hot_rows)) == collected(expected)


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("hot_rows", [64, 5000])
def test_forward_fill(rows, groups, hot_rows):
    w = Window.partitionBy(*groups).orderBy(*o.ascending(ORDER)).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.last("v", ignorenulls=True).over(w)
    expected = rows.withColumn("v", F.when(F.col("g").isNotNull(), filled).otherwise(F.col("v")) if groups else filled)
    assert collected(o.forward_fill(rows, ["v"], ORDER, groups, hot_rows)) == collected(expected)


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("hot_rows", [64, 5000])
def test_row_numbers(rows, groups, hot_rows):
    number = F.row_number().over(Window.partitionBy(*groups).orderBy(*o.ascending(ORDER))).cast("long")
    expected = rows.withColumn("n", F.when(F.col("g").isNotNull(), number) if groups else number)
    assert collected(o.row_numbers(rows, ORDER, "n", groups, hot_rows)) == collected(expected)


def test_plans_do_not_gather_a_hot_group(rows):
    """Above the threshold no window may run over the group columns alone."""
    plan = o.ordered_columns(rows, ORDER, OUT, 8, hot_rows=100)._jdf.queryExecution().toString()
    main = plan.split("== Physical Plan ==")[1]
    assert o.SEGMENT in main
    assert "CartesianProduct" not in main


def test_empty(spark):
    empty = spark.createDataFrame([], "g string, day int, id int, v double")
    assert o.ordered_columns(empty, ORDER, OUT, 8, ["g"], TOTALS, 10).count() == 0
    assert o.ordered_columns(empty, ORDER, OUT, 8, hot_rows=10).count() == 0
    assert o.forward_fill(empty, ["v"], ORDER).count() == 0


@pytest.mark.parametrize("segments, groups", [(1, []), (2, []), (40, ["g"]), (2000, []), (2000, ["g"])])
def test_carry_over_segments_of_any_length(spark, monkeypatch, segments, groups):
    """Lags and rolling sums that reach over several segments, and segments without rows, as one window gives them."""
    data = [(k % 2 if groups else 0, k, float(k * 7 % 11)) for k in range(300)]
    df = spark.createDataFrame(data, "g int, k int, v double")

    def cut(df, groups, order, rows, hot_rows):
        at = F.least(F.floor(F.col("k") / 300 * segments), F.lit(segments - 1)).cast("int")
        return o.durable(df.withColumn(o.SEGMENT, at), "segments")

    outputs = {"lag": lambda w: F.lag("v", 25).over(w), "sum": lambda w: F.sum("v").over(w.rowsBetween(-25, 0))}
    with monkeypatch.context() as m:
        m.setattr(o, "segmented", cut)
        got = o.ordered_columns(df, ["k"], outputs, 25, groups, hot_rows=10)
    # Every window is cut by group or segment.
    first = re.findall(r"windowspecdefinition\((\w+)#", got._jdf.queryExecution().optimizedPlan().toString())
    assert first and set(first) <= {o.SEGMENT, "g"}
    want = o.ordered_columns(df, ["k"], outputs, 25, groups, hot_rows=10_000)
    assert collected(got) == collected(want)
