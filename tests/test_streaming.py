import datetime as dt

import pytest

from marketloom.operators import aggregates
from marketloom.sources import snapshots
from marketloom.streaming import jobs, views


def wait(query):
    query.awaitTermination()
    assert query.exception() is None


def test_only_new_files_are_taken(spark, tmp_path):
    schema = "id int, v double"
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for i in range(2):
        spark.createDataFrame([(i, 1.0)], schema).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.read_folder(spark, source, spark.createDataFrame([], schema).schema)
        wait(jobs.append(stream, target, progress))
        assert spark.read.parquet(target).count() == i + 1
    wait(jobs.append(stream, target, progress))
    assert spark.read.parquet(target).count() == 2


def test_windows_and_copies(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=i), 1.5, f"c{i % 3}") for i in range(100)]
    df = spark.createDataFrame(rows + rows[:10], "id int, ts timestamp_ntz, v double, c string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.read_folder(spark, str(tmp_path / "in"), df.schema)
    wait(jobs.append(jobs.deduplicated(stream, ["id"], "ts"), str(tmp_path / "dedup"), str(tmp_path / "p1")))
    assert spark.read.parquet(str(tmp_path / "dedup")).count() == 100
    clean = jobs.read_folder(spark, str(tmp_path / "dedup"), df.schema)
    kpis = jobs.windowed_kpis(clean, "ts", "v", "c", delay="1 hour")
    wait(jobs.append(kpis, str(tmp_path / "kpis"), str(tmp_path / "p2")))
    out = spark.read.parquet(str(tmp_path / "kpis")).orderBy("window_start").collect()
    # The fifth day is still open: the last event is four hours into it.
    assert [(r.transaction_count, r.total_sales, r.approx_customers) for r in out] == [(24, 36.0, 3)] * 4


SALES = "invoice_date timestamp_ntz, category string, customer_id string, total_amount double, quantity long, extra string"
FULL = {"daily": aggregates.daily_view, "category": aggregates.category_view, "customer": aggregates.customer_view}


def sale(day, category, customer, amount, quantity=1):
    return (None if day is None else dt.datetime(2024, 1, day, 8), category, customer, amount, quantity, "x")


BATCHES = [
    [sale(1, "a", "c1", 0.1), sale(1, "a", "c1", 0.2), sale(1, "b", "c2", 5.0, None), sale(None, "b", "c3", 7.0)],
    [sale(1, "a", "c1", 0.3), sale(5, None, "c1", 1.0), sale(5, "a", None, 2.0), sale(5, "a", None, None)],
    [],
    [sale(3, "b", "c2", 4.0), sale(3, "c", None, None, None), sale(None, None, None, 1.0), sale(1, "a", "c2", 9.0)],
]


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def same_as_from_scratch(spark, target, taken):
    full = spark.createDataFrame([r for rows in taken for r in rows], SALES)
    for name, make in FULL.items():
        view, want = views.read_view(spark, target, name), make(full)
        assert dict(view.dtypes) == dict(want.dtypes)
        assert rows_of(view) == rows_of(want), name


def test_views_after_each_batch_equal_views_from_scratch(spark, tmp_path):
    target = str(tmp_path / "cells")
    for number, rows in enumerate(BATCHES):
        batch = spark.createDataFrame(rows, SALES)
        views.absorb(batch, number, target)
        views.absorb(batch, number, target)  # it runs again
        if number == 1:
            before = views.read_view(spark, target, "category")
            views.compact(spark, target)
            views.absorb(batch, number, target)
        same_as_from_scratch(spark, target, BATCHES[: number + 1])
    # A reader keeps the version that it opened.
    assert rows_of(before) == rows_of(aggregates.category_view(spark.createDataFrame(BATCHES[0] + BATCHES[1], SALES)))


def test_compaction_leaves_one_cell_per_key(spark, tmp_path):
    target = str(tmp_path / "cells")
    for number in range(4):
        views.absorb(spark.createDataFrame([sale(1, "a", "c1", 1.0)] * 5, SALES), number, target)
    assert snapshots.read_snapshot(spark, target).count() == 8
    views.compact(spark, target)
    assert snapshots.read_snapshot(spark, target).count() == 2
    assert [r.total_spent for r in views.read_view(spark, target, "customer").collect()] == [20.0]


def test_a_batch_that_meets_a_compaction_is_kept(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "cells")
    views.absorb(spark.createDataFrame(BATCHES[0], SALES), 0, target)
    publish, once = snapshots.publish, []

    def late(session, version):
        if not once:
            once.append(1)
            views.compact(spark, target)
        return publish(session, version)

    monkeypatch.setattr(snapshots, "publish", late)
    views.absorb(spark.createDataFrame(BATCHES[1], SALES), 1, target)
    same_as_from_scratch(spark, target, BATCHES[:2])
    assert snapshots.open_version(spark, target).counts["batch"] == 1


def test_views_of_nothing(spark, tmp_path):
    target = str(tmp_path / "cells")
    views.absorb(spark.createDataFrame([], SALES), 0, target)
    assert [views.read_view(spark, target, v).count() for v in views.VIEWS] == [0, 0, 0]
    with pytest.raises(ValueError):
        views.read_view(spark, target, "mall")
