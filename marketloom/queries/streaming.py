"""Streaming jobs over the events table, run until everything that has arrived is taken."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.queries.aggregates import ORACLES as AGGREGATES
from marketloom.queries.fixtures import money, sales, table
from marketloom.session import scratch_path
from marketloom.sources import snapshots
from marketloom.streaming import jobs, views


def _events(s, d):
    return jobs.read_folder(s, d, table(s, d, "events").schema, pattern="events.parquet")


def _run(stream, s, label):
    path = scratch_path(s, label)
    query = jobs.append(stream, path, scratch_path(s, f"{label}-progress"))
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return s.read.schema(stream.schema).parquet(path)


def _kpis(s, d):
    """All windows, the last ones too."""
    path = scratch_path(s, "kpis")
    query = jobs.upsert(jobs.windowed_kpis(_events(s, d), "ts", "value"), path, scratch_path(s, "kpis-progress"))
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return jobs.current(s, path, ["window_start", "window_end"])


def _copies(stream):
    """Every seventh event arrives twice."""
    twice = F.when(F.col("event_id") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return stream.withColumn("copy", F.explode(twice)).drop("copy")


PARTS = 3


def _refreshed(s, d):
    """Cells of the sales that arrive in three parts, days and customers across all of them; the second part's batch runs twice, and old
    batches are added up before the last."""
    needed = ["invoice_date", "category", "customer_id", "total_amount", "quantity"]
    arrived = scratch_path(s, "arrived")
    rows = sales(s, d).select(*needed, F.pmod(F.xxhash64("l_orderkey"), F.lit(PARTS)).alias("part"))
    rows.write.partitionBy("part").parquet(arrived)
    target, progress = scratch_path(s, "cells"), scratch_path(s, "cells-progress")
    folder = scratch_path(s, "sales")
    schema = rows.drop("part").schema
    for part in range(PARTS):
        s.read.schema(schema).parquet(f"{arrived}/part={part}").write.mode("append").parquet(folder)
        query = views.refresh(jobs.read_folder(s, folder, schema), target, progress)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        if part == 1:
            again = s.read.schema(schema).parquet(f"{arrived}/part={part}")
            views.absorb(again, snapshots.open_version(s, target).counts[snapshots.BATCH], target)
            views.compact(s, target)
    return target


def _view(name):
    return lambda s, d: views.read_view(s, _refreshed(s, d), name)


QUERIES = {
    "stream_daily_view": _view("daily"),
    "stream_category_view": _view("category"),
    "stream_customer_view": _view("customer"),
    "stream_ingest": lambda s, d: _run(_events(s, d), s, "ingested"),
    "stream_kpis": _kpis,
    "stream_final_kpis": lambda s, d: _run(jobs.windowed_kpis(_events(s, d), "ts", "value"), s, "kpis"),
    "stream_dedup": lambda s, d: _run(jobs.deduplicated(_copies(_events(s, d)), ["event_id"], "ts"), s, "deduplicated"),
}

_KPIS = f"""SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, total_sales, transaction_count,
    total_sales / transaction_count AS avg_transaction FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start,
    {money('value')} AS total_sales, count(*) AS transaction_count FROM events GROUP BY 1) {{}}"""

ORACLES = {
    "stream_daily_view": AGGREGATES["agg_daily_sales"],
    "stream_category_view": AGGREGATES["agg_category_sales"],
    "stream_customer_view": AGGREGATES["agg_customer_summary"],
    "stream_ingest": "SELECT * FROM events",
    "stream_kpis": _KPIS.format(""),
    # Windows that end after the watermark, one day behind the last event, are still open.
    "stream_final_kpis": _KPIS.format("WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"),
    "stream_dedup": "SELECT * FROM events",
}
