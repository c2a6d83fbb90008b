"""Data-quality reports on the dirty sales table."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import cleaning as c
from marketloom.operators import profiling as p
from marketloom.queries.fixtures import KEYS, ORDER, mean, money, on_raw, on_sales, raw_sales, sales, significant, significant_sql
from marketloom.schema import RAW_SALES
from marketloom.session import durable

NUMERIC = ["age", "quantity", "price"]
DESCRIBED = [*NUMERIC, "price_tiny", "price_huge"]
TEXT = ["gender", "category", "payment_method", "shopping_mall", "loyalty_tier"]
CHECKED = ["age", "quantity", "price", "unit_ratio"]
WITH_GAPS = ["age", "category", "price", "loyalty_tier"]


def _finite(s, d):
    ratio = raw_sales(s, d).withColumn(
        "unit_ratio", F.when(F.col("l_orderkey") % 17 == 0, F.lit(float("inf"))).otherwise(F.col("price") / F.col("quantity"))
    )
    return p.finite_check(ratio, CHECKED)


def _describe(s, d):
    raw = raw_sales(s, d).select(*NUMERIC).withColumns({"price_tiny": F.expr("price / 1e7"), "price_huge": F.expr("price * 1e13")})
    out = p.describe_numeric(durable(raw, "raw"), DESCRIBED)
    return significant(out, ["mean", "std", "min", "p25", "p50", "p75", "max"])


def _report(s, d):
    raw = durable(raw_sales(s, d).select(*KEYS, *WITH_GAPS), "raw")
    # Stored: the statistics, the row count and the missing counts would each merge the copies again.
    unique = durable(c.remove_duplicates(raw), "deduplicated")
    after = c.handle_missing(unique, "auto", numeric=["age", "price"])
    return p.cleaning_report(raw, after, c.outlier_report(raw, ["age", "price"]))


def _change(s, d):
    raw = durable(raw_sales(s, d).select(*KEYS, *WITH_GAPS), "raw")
    return p.missing_change(raw, c.handle_missing(raw, "auto", numeric=["age", "price"]))


QUERIES = {
    "schema_check": lambda s, d: p.schema_check(raw_sales(s, d), RAW_SALES.names),
    "shape_dtypes": lambda s, d: p.shape_and_types(raw_sales(s, d)),
    "missing_report": lambda s, d: p.missing_report(raw_sales(s, d)),
    "missing_change": _change,
    "describe_numeric": _describe,
    "categorical_profile": lambda s, d: p.categorical_profile(raw_sales(s, d), TEXT),
    "date_range": lambda s, d: p.date_range(sales(s, d), "invoice_date"),
    "sales_metrics": lambda s, d: p.sales_metrics(sales(s, d)),
    "finite_check": _finite,
    "cleaning_report": _report,
    "outlier_report": lambda s, d: c.outlier_report(durable(raw_sales(s, d).select(*NUMERIC), "raw"), NUMERIC),
    "sample_rows": lambda s, d: p.sample_rows(sales(s, d), 1000, ORDER),
}

_ALL = [
    "invoice_no", "customer_id", "gender", "age", "category", "quantity", "price", "payment_method", "invoice_date",
    "shopping_mall", "loyalty_tier", *KEYS,
]


def _each(columns, make) -> str:
    return "\nUNION ALL ".join(make(x) for x in columns)


def _outliers(column: str) -> str:
    q1, q3 = (f"(SELECT quantile_cont(CAST({column} AS DOUBLE), {q}) FROM raw)" for q in (0.25, 0.75))
    return f"""SELECT '{column}' AS "column", 'iqr' AS method, count(*) AS outlier_count FROM raw
        WHERE {column} < {q1} - 3 * ({q3} - {q1}) OR {column} > {q3} + 3 * ({q3} - {q1})
        UNION ALL SELECT '{column}', 'zscore', count(*) FROM raw
        WHERE abs({column} - (SELECT avg({column}) FROM raw)) / (SELECT stddev_samp({column}) FROM raw) > 3"""


_REPORT_COLUMNS = [*KEYS, *WITH_GAPS]

_TYPES = [
    "string", "string", "string", "bigint", "string", "bigint", "double", "string", "string", "string", "string",
    "bigint", "int", "bigint", "bigint", "double",
]

ORACLES = {
    "shape_dtypes": on_raw(
        "SELECT CAST(p AS INTEGER) AS position, c AS \"column\", t AS type, (SELECT count(*) FROM raw) AS row_count, "
        f"CAST({len(_ALL)} AS INTEGER) AS column_count FROM (VALUES "
        + ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(zip(_ALL, _TYPES, strict=True)))
        + ") AS v(p, c, t)"
    ),
    "missing_report": on_raw(
        _each(
            _ALL,
            lambda x: f"""SELECT '{x}' AS "column", count(*) - count({x}) AS missing_count,
            (count(*) - count({x})) * 100.0::DOUBLE / count(*) AS missing_percent FROM raw""",
        )
    ),
    "missing_change": on_raw(
        _each(
            _REPORT_COLUMNS,
            lambda x: f"""SELECT '{x}' AS "column", count(*) - count({x}) AS missing_before,
            {'CAST(NULL AS BIGINT)' if x == 'loyalty_tier' else 'CAST(0 AS BIGINT)'} AS missing_after FROM raw""",
        )
    ),
    "describe_numeric": on_raw("").rstrip()
    + ", t AS (SELECT *, price / 1e7 AS price_tiny, price * 1e13 AS price_huge FROM raw) "
    + _each(
        DESCRIBED,
        lambda x: f"""SELECT '{x}' AS "column", count({x}) AS count, """
        + ", ".join(
            f"{significant_sql(e.replace('X', f'CAST({x} AS DOUBLE)'))} AS {n}"
            for n, e in {
                "mean": "avg(X)",
                "std": "stddev_samp(X)",
                "min": "min(X)",
                "p25": "quantile_cont(X, 0.25)",
                "p50": "quantile_cont(X, 0.5)",
                "p75": "quantile_cont(X, 0.75)",
                "max": "max(X)",
            }.items()
        )
        + " FROM t",
    ),
    "categorical_profile": on_raw(
        "SELECT * FROM ("
        + _each(
            TEXT,
            lambda x: f"""SELECT '{x}' AS "column", count(*) OVER () AS distinct_count,
            CAST(row_number() OVER (ORDER BY count(*) DESC, {x}) AS INTEGER) AS rank, {x} AS value, count(*) AS rows
            FROM raw WHERE {x} IS NOT NULL GROUP BY {x}""",
        )
        + ") WHERE rank <= 3"
    ),
    "date_range": on_sales("""SELECT min(invoice_date) AS first_date, max(invoice_date) AS last_date,
        CAST(datediff('day', min(invoice_date), max(invoice_date)) AS INTEGER) AS days FROM sales"""),
    "sales_metrics": on_sales(f"""SELECT {money('total_amount')} AS total_sales, {mean('total_amount')} AS avg_transaction,
        count(DISTINCT customer_id) AS unique_customers FROM sales"""),
    "finite_check": on_raw(
        _each(
            CHECKED,
            lambda x: f"""SELECT '{x}' AS "column", i AS infinite_count, m AS missing_count,
            CASE WHEN i + m = 0 THEN 1 ELSE 0 END AS ready FROM (SELECT
            count(CASE WHEN abs(CAST({x} AS DOUBLE)) = 'inf'::DOUBLE THEN 1 END) AS i, count(*) - count({x}) AS m FROM
            (SELECT *, CASE WHEN l_orderkey % 17 = 0 THEN 'inf'::DOUBLE ELSE price / quantity END AS unit_ratio FROM raw))""",
        )
    ),
    "cleaning_report": on_raw(
        f"""SELECT * FROM (SELECT 'rows' AS step, CAST(NULL AS VARCHAR) AS "column", 'rows_before' AS metric, CAST(count(*) AS DOUBLE) AS value FROM raw
        UNION ALL SELECT 'rows', NULL, 'rows_after', CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT {', '.join(_REPORT_COLUMNS)} FROM raw)
        UNION ALL SELECT 'rows', NULL, 'rows_removed', CAST((SELECT count(*) FROM raw) - count(*) AS DOUBLE)
          FROM (SELECT DISTINCT {', '.join(_REPORT_COLUMNS)} FROM raw)
        UNION ALL SELECT 'outliers', "column", method, CAST(outlier_count AS DOUBLE) FROM ({_each(['age', 'price'], _outliers)})
        UNION ALL """
        + _each(
            _REPORT_COLUMNS,
            lambda x: f"SELECT 'missing_before', '{x}', 'missing_count', CAST(count(*) - count({x}) AS DOUBLE) FROM raw",
        )
        + "\nUNION ALL "
        + _each(
            [x for x in _REPORT_COLUMNS if x != "loyalty_tier"],
            lambda x: f"SELECT 'missing_after', '{x}', 'missing_count', CAST(0 AS DOUBLE)",
        )
        + ")"
    ),
    "outlier_report": on_raw(_each(NUMERIC, _outliers)),
    "sample_rows": on_sales(f"SELECT * FROM sales ORDER BY {', '.join(ORDER)} LIMIT 1000"),
}
