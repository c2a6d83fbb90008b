"""Scans, sinks and stored tables. Files are written to the shared folder and read back."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import amounts
from marketloom.queries.fixtures import KEYS, money, on_raw, on_sales, raw_sales, sales, table
from marketloom.schema import RAW_SALES
from marketloom.session import durable, scratch_path
from marketloom.sources import clustered, excel, files, snapshots, tables

RAW = RAW_SALES.names
_RAW = ", ".join(RAW)


def _stored(df, s, label, kind="parquet"):
    return files.save(df, scratch_path(s, label), kind)


def _scan_csv(s, d):
    return files.scan(s, _stored(raw_sales(s, d).select(*RAW), s, "raw", "csv"), schema=RAW_SALES)


def _scan_parquet(s, d):
    return files.scan(s, f"{d}/lineitem.parquet")


def _scan_excel(s, d):
    folder = scratch_path(s, "books")
    daily = (
        sales(s, d)
        .groupBy("shopping_mall", "category")
        .agg(amounts.total("total_amount").alias("total_sales"), amounts.row_count().alias("transactions"), F.max("invoice_date").alias("last_date"))
    )
    excel.write_excel(daily.repartition(3, "shopping_mall"), folder, rows_per_file=40)
    return excel.scan_excel(s, folder, daily.schema).drop("source_file")


PART_ROWS = 250_000


def _parts(s, d, least):
    """Parts of at most about PART_ROWS rows that the sales table is written in."""
    return max(least, -(-table(s, d, "lineitem").count() // PART_ROWS))


def _write_by_mall(s, d):
    """A folder of CSV files, one for each part of the sales table; their number grows with it."""
    path = scratch_path(s, "parts")
    parts = _parts(s, d, 6)
    sales(s, d).select(*RAW).repartition(parts, "shopping_mall", "invoice_no").write.option("header", True).csv(path)
    return path


def _list_files(s, d):
    names = files.list_files(s, d, "*.parquet")
    return names.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), (F.col("length") > 0).cast("int").alias("filled"))


def _load_folder(s, d):
    target = scratch_path(s, "loaded")
    report = files.load_folder(s, _write_by_mall(s, d), target, schema=RAW_SALES)
    stored = s.read.parquet(target).agg(
        amounts.row_count().alias("rows"), amounts.total("price").alias("price_sum"), F.countDistinct("customer_id").alias("customers")
    )
    complete = report.select((F.col("files_found") == F.col("files_loaded")).cast("int").alias("complete"), F.col("rows").alias("rows_loaded"))
    return stored.join(complete, F.lit(True))


def _load_retail_stats(s, d):
    path = _stored(raw_sales(s, d).select(*RAW), s, "raw", "csv")
    return files.load_sales(s, path, scratch_path(s, "raw_sales"))


def _load_batch(s, d):
    def entry(name, kind="parquet", source="local"):
        return {"source": source, "path": f"{d}/{name}.parquet", "table": scratch_path(s, name), "file_type": kind}

    wanted = {
        "orders": entry("orders"),
        "parts": entry("part"),
        "absent": entry("no_such_table"),
        "elsewhere": entry("orders", source="ftp"),
        "events": entry("events"),
    }
    return files.load_batch(s, wanted)


def _write_roundtrip(s, d):
    df = sales(s, d).select(*KEYS, "category", "quantity", "price", "invoice_date")
    csv, parquet = _stored(df, s, "trip", "csv"), _stored(df, s, "trip")
    return (
        files.scan(s, csv, schema=df.schema)
        .unionByName(files.scan(s, parquet))
        .groupBy("category")
        .agg(
            amounts.row_count().alias("rows"),
            amounts.total("price").alias("price_sum"),
            F.sum("l_orderkey").alias("key_sum"),
            F.max("invoice_date").alias("last_date"),
        )
    )


def _append_table(s, d):
    path = scratch_path(s, "appended")
    df = sales(s, d).select(*KEYS, "price")
    inserted = files.append_table(df, path) + files.append_table(df.where("l_orderkey % 13 = 0"), path)
    return s.read.parquet(path).agg(
        amounts.row_count().alias("rows"), amounts.total("price").alias("price_sum")
    ).withColumn("inserted", F.lit(inserted).cast("long"))


def _read_filtered(s, d):
    return tables.read_table(
        s,
        f"{d}/orders.parquet",
        where={"o_orderstatus": "F"},
        exclude=["o_orderpriority"],
        limit=500,
        order=["o_orderdate", "o_orderkey"],
    )


UPDATE = {"o_orderstatus": "X", "o_totalprice": 0.0}


def _update_rows(s, d):
    return tables.update_rows(table(s, d, "orders"), {"o_orderpriority": "1-URGENT"}, UPDATE)


def _upsert_rows(s, d):
    orders = table(s, d, "orders")
    changes = orders.where("o_orderkey % 7 = 0").select(
        (F.col("o_orderkey") + F.when(F.col("o_orderkey") % 2 == 0, 0).otherwise(100_000_000)).alias("o_orderkey"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.lit("U").alias("o_orderstatus"),
    )
    return tables.upsert_rows(orders, changes, ["o_orderkey"])


def _delete_rows(s, d):
    return tables.delete_rows(table(s, d, "orders"), (F.col("o_totalprice") > 100_000) & (F.col("o_orderstatus") == "O"))


def _table_stats(s, d):
    return tables.table_stats(s, f"{d}/lineitem.parquet").select("row_count", "column_count", "files")


def _drop_table(s, d):
    name = f"sales_{uuid.uuid4().hex[:8]}"
    path = scratch_path(s, "catalog")
    tables.write_table(sales(s, d).groupBy("category").agg(amounts.row_count().alias("rows")), path)
    tables.register_table(s, name, path)
    counted = s.table(name).agg(F.sum("rows").alias("rows")).first()[0]
    existed = tables.drop_table(s, name)
    gone = not s.catalog.tableExists(name)
    # Dropping an external table keeps its files.
    return s.read.parquet(path).agg(F.sum("rows").alias("rows")).select(
        "rows", F.lit(counted).cast("long").alias("rows_before"), F.lit(int(existed)).alias("existed"), F.lit(int(gone)).alias("gone")
    )


def _layout_pruned_read(s, d):
    path = scratch_path(s, "layout")
    dated = sales(s, d).select(*KEYS, "customer_id", "total_amount", "invoice_date")
    tables.write_partitioned(dated.withColumns({"year": F.year("invoice_date"), "month": F.month("invoice_date")}), path)
    return tables.read_table(s, path, where={"year": 1997, "month": 3}, exclude=["year", "month"])


#: One filter on each of the columns that the table is clustered by.
CLUSTERED = {
    "invoice_date": (dt.datetime(1996, 5, 1), dt.datetime(1996, 5, 20)),
    "customer_id": "C101",
    "category": "MEDIUM",
    "shopping_mall": "NATION_7",
}
CLUSTER_FILES = 256


def _layout_clustered(s, d):
    """Rows of a filter on each column alone, and whether it scanned less than a third of the files."""
    path = scratch_path(s, "clustered")
    table = sales(s, d).select(*KEYS, *CLUSTERED, "total_amount")
    clustered.write_clustered(durable(table, "sales"), path, list(CLUSTERED), CLUSTER_FILES, bloom={"customer_id": 10_000})
    whole = len(s.read.parquet(f"{path}/data").inputFiles())
    parts = []
    for column, wanted in CLUSTERED.items():
        found = clustered.read_clustered(s, path, {column: wanted}, [*KEYS, "total_amount"])
        few = int(3 * len(clustered.candidate_files(s, path, {column: wanted})) < whole)
        parts.append(found.select(F.lit(column).alias("filter"), "*", F.lit(few).alias("few_files")))
    return reduce(DataFrame.unionByName, parts)


def _retention(s, d):
    return tables.retention_prune(sales(s, d).select(*KEYS, "invoice_date", "total_amount"), "invoice_date", 24)


def _bucketed(s, d):
    name, path = f"by_customer_{uuid.uuid4().hex[:8]}", scratch_path(s, "buckets")
    tables.write_bucketed(
        sales(s, d).select("customer_id", "invoice_date", "total_amount"), name, path, 8, ["customer_id"], ["invoice_date"]
    )
    return s.table(name).groupBy("customer_id").agg(amounts.total("total_amount").alias("total_sales"))


def _changed_table(s, d):
    """Four versions of a stored table, and a frame over the first that was opened before the others were made."""
    path = scratch_path(s, "versions")
    # Stored, since the ranges are found in a sample first; their number grows with the table, as every change rewrites in them.
    df = durable(sales(s, d).select(*KEYS, "category", "payment_method", "quantity", "price"), "sales")
    snapshots.create_snapshot(df.repartitionByRange(_parts(s, d, 8), "l_orderkey"), path)
    first = snapshots.read_snapshot(s, path)
    snapshots.update_snapshot(s, path, F.col("l_orderkey") % 1000 == 7, {"quantity": 9, "price": F.col("price") * 2})
    changes = df.where("l_orderkey < 200").select(*KEYS, (F.col("quantity") + F.col("l_linenumber") % 2).alias("quantity"))
    added = df.where("l_orderkey < 20").select((F.col("l_orderkey") + 100_000_000).alias("l_orderkey"), *KEYS[1:], "quantity")
    snapshots.upsert_snapshot(changes.unionByName(added), path, KEYS)
    snapshots.delete_snapshot(s, path, {"payment_method": "5-LOW"})
    return path, first


def _snapshot_versions(s, d):
    path, first = _changed_table(s, d)
    rows = first.withColumn("version", F.lit(1))
    for number in (2, 3, 4):
        rows = rows.unionByName(snapshots.read_snapshot(s, path, number).withColumn("version", F.lit(number)))
    return rows.groupBy("version", "category").agg(
        amounts.row_count().alias("rows"),
        F.sum("quantity").alias("quantity"),
        F.sum("l_orderkey").alias("key_sum"),
        amounts.total("price").alias("price_sum"),
    )


QUERIES = {
    "snapshot_versions": _snapshot_versions,
    "snapshot_history": lambda s, d: snapshots.history(s, _changed_table(s, d)[0]),
    "scan_csv": _scan_csv,
    "scan_parquet": _scan_parquet,
    "scan_excel_folder": _scan_excel,
    "list_files": _list_files,
    "load_folder": _load_folder,
    "load_retail_stats": _load_retail_stats,
    "load_batch": _load_batch,
    "write_roundtrip": _write_roundtrip,
    "append_table": _append_table,
    "read_filtered": _read_filtered,
    "update_rows": _update_rows,
    "upsert_rows": _upsert_rows,
    "delete_rows": _delete_rows,
    "table_stats": _table_stats,
    "drop_table": _drop_table,
    "layout_pruned_read": _layout_pruned_read,
    "layout_bucketed_read": _bucketed,
    "layout_clustered_read": _layout_clustered,
    "retention_prune": _retention,
}

_VERSIONS = """, v1 AS (SELECT l_orderkey, l_linenumber, category, payment_method, quantity, price, quantity AS q FROM sales),
    v2 AS (SELECT * REPLACE (CASE WHEN l_orderkey % 1000 = 7 THEN 9 ELSE quantity END AS quantity,
      CASE WHEN l_orderkey % 1000 = 7 THEN price * 2 ELSE price END AS price) FROM v1),
    v3 AS (SELECT * REPLACE (CASE WHEN l_orderkey < 200 THEN q + l_linenumber % 2 ELSE quantity END AS quantity) FROM v2
      UNION ALL SELECT l_orderkey + 100000000, l_linenumber, NULL, NULL, quantity, NULL, NULL FROM sales WHERE l_orderkey < 20),
    v4 AS (SELECT * FROM v3 WHERE payment_method IS DISTINCT FROM '5-LOW')"""

ORACLES = {
    "snapshot_versions": on_sales("").rstrip()
    + _VERSIONS
    + " UNION ALL ".join(
        f"""SELECT {n} AS version, category, count(*) AS rows, CAST(sum(quantity) AS BIGINT) AS quantity,
        CAST(sum(l_orderkey) AS BIGINT) AS key_sum, {money('price')} AS price_sum FROM v{n} GROUP BY category"""
        for n in (1, 2, 3, 4)
    ),
    "snapshot_history": on_sales("").rstrip()
    + _VERSIONS
    + """ SELECT CAST(1 AS BIGINT) AS version, 'create' AS operation, CAST(0 AS BIGINT) AS matched, CAST(0 AS BIGINT) AS changed,
        count(*) AS added, CAST(0 AS BIGINT) AS deleted FROM v1
    UNION ALL SELECT 2, 'update', count(*), count(*), 0, 0 FROM v1 WHERE l_orderkey % 1000 = 7
    UNION ALL SELECT 3, 'upsert', count(*), count(CASE WHEN quantity <> q + l_linenumber % 2 THEN 1 END),
        (SELECT count(*) FROM v1 WHERE l_orderkey < 20), 0 FROM v2 WHERE l_orderkey < 200
    UNION ALL SELECT 4, 'delete', count(*), 0, 0, count(*) FROM v3 WHERE payment_method = '5-LOW'""",
    "scan_csv": on_raw(f"SELECT {_RAW} FROM raw"),
    "scan_parquet": "SELECT * FROM lineitem",
    "scan_excel_folder": on_sales(f"""SELECT shopping_mall, category, {money('total_amount')} AS total_sales, count(*) AS transactions,
        max(invoice_date) AS last_date FROM sales GROUP BY shopping_mall, category"""),
    "load_folder": on_sales(f"""SELECT count(*) AS rows, {money('price')} AS price_sum, count(DISTINCT customer_id) AS customers,
        1 AS complete, count(*) AS rows_loaded FROM sales"""),
    "load_retail_stats": on_raw("""SELECT count(*) AS rows, min(try_strptime(invoice_date, '%d/%m/%Y')) AS first_date,
        max(try_strptime(invoice_date, '%d/%m/%Y')) AS last_date, count(DISTINCT customer_id) AS customers,
        count(DISTINCT category) AS categories, '' AS missing_columns FROM raw"""),
    "load_batch": """SELECT * FROM (SELECT 'orders' AS dataset, 1 AS success, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM orders
        UNION ALL SELECT 'parts', 1, count(*), NULL FROM part UNION ALL SELECT 'events', 1, count(*), NULL FROM events
        UNION ALL SELECT 'absent', 0, 0, 'AnalysisException' UNION ALL SELECT 'elsewhere', 0, 0, 'ValueError')""",
    "write_roundtrip": on_sales(f"""SELECT category, count(*) AS rows, {money('price')} AS price_sum,
        CAST(sum(l_orderkey) AS BIGINT) AS key_sum, max(invoice_date) AS last_date
        FROM (SELECT * FROM sales UNION ALL SELECT * FROM sales) GROUP BY category"""),
    "append_table": on_sales(f"""SELECT count(*) AS rows, {money('price')} AS price_sum, count(*) AS inserted
        FROM (SELECT * FROM sales UNION ALL SELECT * FROM sales WHERE l_orderkey % 13 = 0)"""),
    "read_filtered": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
        WHERE o_orderstatus = 'F' ORDER BY o_orderdate, o_orderkey LIMIT 500""",
    "update_rows": """SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE o_totalprice END AS o_totalprice) FROM orders""",
    "upsert_rows": """SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 2 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 2 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice) FROM orders
        UNION ALL SELECT o_orderkey + 100000000, NULL, 'U', o_totalprice * 2, NULL, NULL FROM orders
        WHERE o_orderkey % 7 = 0 AND o_orderkey % 2 != 0""",
    "delete_rows": "SELECT * FROM orders WHERE NOT (o_totalprice > 100000 AND o_orderstatus = 'O')",
    "table_stats": "SELECT count(*) AS row_count, 11 AS column_count, CAST(1 AS BIGINT) AS files FROM lineitem",
    "drop_table": on_sales("SELECT count(*) AS rows, count(*) AS rows_before, 1 AS existed, 1 AS gone FROM sales"),
    "layout_pruned_read": on_sales(f"""SELECT {', '.join(KEYS)}, customer_id, total_amount, invoice_date FROM sales
        WHERE year(invoice_date) = 1997 AND month(invoice_date) = 3"""),
    "layout_clustered_read": on_sales("").rstrip()
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS filter, {', '.join(KEYS)}, total_amount, 1 AS few_files FROM sales WHERE "
        + (f"{c} BETWEEN '{w[0]}' AND '{w[1]}'" if isinstance(w, tuple) else f"{c} = '{w}'")
        for c, w in CLUSTERED.items()
    ),
    "layout_bucketed_read": on_sales(
        f"SELECT customer_id, {money('total_amount')} AS total_sales FROM sales GROUP BY customer_id"
    ),
    "retention_prune": on_sales(f"""SELECT {', '.join(KEYS)}, invoice_date, total_amount FROM sales
        WHERE invoice_date >= (SELECT CAST(max(invoice_date) AS DATE) - INTERVAL 24 MONTH FROM sales)"""),
}
