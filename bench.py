"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the tables (default /root/testdata/sf0.1), BENCH_CPUS the number of cores, BENCH_QUERIES an
optional comma-separated list of query names, or ``all``. Each query runs once to warm up and once on the clock; its result is written
to Spark's ``noop`` sink, so that every row and column is computed.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from marketloom.queries import registry
from marketloom.session import build_session

HEADLINE = [
    "sales_by_day",
    "sales_by_category",
    "customer_rfm",
    "sales_by_demographics",
    "agg_daily_sales",
    "customer_summary_ext",
    "aggregated_sales",
    "kpis",
    "report_mall",
    "top_customers",
    "missing_report",
    "describe_numeric",
    "dedup_all",
    "dedup_first",
    "standardize_text",
    "impute_median",
    "impute_mode",
    "forward_fill",
    "outlier_iqr_cap",
    "clean_sales",
    "lag_grouped",
    "rolling_grouped",
    "lag_global",
    "encode_label",
    "customer_stats",
    "category_stats",
    "transform_sales",
    "scan_csv",
    "layout_pruned_read",
    "upsert_rows",
    "daily_series",
    "target_correlation",
    "seasonal_forecast_by_category",
    "stream_kpis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries = registry.queries()
    names = os.environ.get("BENCH_QUERIES", "")
    names = HEADLINE if not names else list(queries) if names == "all" else names.split(",")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.marketloom.spread": "true",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="marketloom-bench-"),
    }
    spark = build_session("marketloom-bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")

    # Starts the executors and compiles what every query uses, so that the first query is not slower than the others.
    queries[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds, rows = {}, {}
    for name in names:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        result = queries[name](spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_ROWS"):
            rows[name] = result.count()
    report = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }
    if rows:
        report["rows"] = rows
    print(json.dumps(report))


if __name__ == "__main__":
    main()
