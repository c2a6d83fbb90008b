"""Cleaning operators on the dirty sales table."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import cleaning as c
from marketloom.operators.cleaning_log import CleaningLog
from marketloom.operators.ordering import forward_fill
from marketloom.plans.cleaning import clean_sales, clean_table
from marketloom.queries.fixtures import KEYS, ORDER, RAW_SQL, on_raw, on_sales, raw_sales, sales, significant, significant_sql
from marketloom.session import durable

SUBSET = ["customer_id", "category"]
GAPS = ["age", "price"]
CAPPED = ["age", "quantity", "price"]
# The same amounts far below and far above what a sum of amounts is made for.
SCALED = {"price_tiny": "price / 1e7", "price_huge": "price * 1e13"}
SCALED_SQL = ", ".join(f"{e} AS {c}" for c, e in SCALED.items())


def _rounded(df, columns, places=4):
    return df.withColumns({x: F.round(x, places) for x in columns})


def _typed(spark, d):
    """Text versions of numbers and dates, some of them not convertible."""
    order = F.col("l_orderkey")
    text = sales(spark, d).select(
        *KEYS,
        F.when(order % 31 == 0, "unknown").otherwise(F.col("quantity").cast("string")).alias("quantity_text"),
        F.when(order % 29 == 0, "n/a").otherwise(F.col("price").cast("decimal(18,2)").cast("string")).alias("price_text"),
        F.when(order % 37 == 0, "someday").otherwise(F.date_format("invoice_date", "yyyy-MM-dd")).alias("date_text"),
        F.when(order % 41 == 0, F.lit(None)).otherwise(F.col("age")).alias("age_text"),
        (F.col("age") / 4).alias("quarter_age"),
    )
    types = {"quantity_text": "int", "price_text": "float", "date_text": "datetime", "age_text": "str", "quarter_age": "int64"}
    return c.coerce_types(text, types, reference_nulls=True)


def _text_columns(spark, d, reference_nulls):
    raw = raw_sales(spark, d).select(*KEYS, "gender", "category", "payment_method", "shopping_mall")
    return c.standardize_text(raw, ["gender", "category", "payment_method", "shopping_mall"], reference_nulls=reference_nulls)


def _cleaned(spark, d):
    return _rounded(clean_sales(raw_sales(spark, d), keys=KEYS), ["price", "quantity", "age", "total_amount"])


def _generic(spark, d):
    out = clean_table(
        raw_sales(spark, d),
        date_columns=["invoice_date"],
        text_columns=["gender", "category"],
        capped_columns=["price", "age"],
    )
    return _rounded(out, ["price", "age"])


def _stored(s, d, *columns):
    """Columns of the raw table as a stored table: operators that take statistics read their input more than once."""
    return durable(raw_sales(s, d).select(*KEYS, *columns), "raw")


def _impute(strategy):
    def query(s, d):
        raw = _stored(s, d, *GAPS)
        raw = raw.withColumns({x: F.expr(e) for x, e in SCALED.items()})
        columns = [*GAPS, *SCALED]
        return significant(c.fill_numeric(raw, columns, c.numeric_fills(raw, columns, strategy)), columns)

    return query


def _impute_mode(s, d):
    raw = _stored(s, d, "category", "loyalty_tier")
    return c.fill_text(raw, c.most_frequent(raw, ["category", "loyalty_tier"]))


def _log(s, d):
    log = CleaningLog()
    durable(clean_sales(raw_sales(s, d), keys=KEYS, log=log), "cleaned")
    return log.frame(s).drop("position").withColumn("value", F.round("value", 9))


QUERIES = {
    "cleaning_log": _log,
    "dedup_all": lambda s, d: c.remove_duplicates(raw_sales(s, d)),
    "dedup_first": lambda s, d: c.remove_duplicates(sales(s, d), SUBSET, "first", ORDER),
    "dedup_last": lambda s, d: c.remove_duplicates(sales(s, d), SUBSET, "last", ORDER),
    "dedup_none": lambda s, d: c.remove_duplicates(sales(s, d), ["customer_id", "shopping_mall"], False),
    "standardize_dates": lambda s, d: c.standardize_dates(raw_sales(s, d).select(*KEYS, "invoice_date"), ["invoice_date"]),
    "standardize_text": lambda s, d: _text_columns(s, d, False),
    "standardize_text_nan": lambda s, d: _text_columns(s, d, True),
    "coerce_types": _typed,
    "drop_sparse_columns": lambda s, d: c.drop_sparse_columns(raw_sales(s, d)),
    "drop_null_rows": lambda s, d: c.handle_missing(raw_sales(s, d), "drop"),
    "impute_median": _impute("median"),
    "impute_mean": _impute("mean"),
    "impute_mode": _impute_mode,
    "forward_fill": lambda s, d: forward_fill(
        _stored(s, d, "customer_id", "age", "category", "price"), ["age", "category", "price"], KEYS
    ),
    "forward_fill_grouped": lambda s, d: forward_fill(
        _stored(s, d, "customer_id", "age", "category", "price"),
        ["age", "category", "price"],
        KEYS,
        ["customer_id"],
    ),
    "outlier_iqr_cap": lambda s, d: _rounded(
        c.handle_outliers(_stored(s, d, *CAPPED), CAPPED), CAPPED
    ),
    "outlier_zscore": lambda s, d: c.flag_outliers(_stored(s, d, *CAPPED), CAPPED, "zscore"),
    "derived_columns": lambda s, d: c.derived_columns(
        sales(s, d).select(*KEYS, "price", "quantity", "invoice_date")
    ),
    "clean_sales": _cleaned,
    "clean_generic": _generic,
}

_K = ", ".join(KEYS)
_O = ", ".join(ORDER)


def _pick(direction: str) -> str:
    order = ", ".join(f"{o} {direction}" for o in ORDER)
    return on_sales(f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, category
        ORDER BY {order}) AS rn FROM sales) WHERE rn = 1""")


def _fill(partition: str) -> str:
    over = f"OVER ({partition} ORDER BY {_K} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return on_raw(f"""SELECT customer_id, last_value(age IGNORE NULLS) {over} AS age,
        last_value(category IGNORE NULLS) {over} AS category, last_value(price IGNORE NULLS) {over} AS price, {_K} FROM raw""")


def _clean_text(column: str) -> str:
    return f"coalesce(lower(trim({column})), 'nan')"


def _capped(column: str) -> str:
    return f"""round(CASE WHEN {column} < {column}_q1 - 3 * ({column}_q3 - {column}_q1) THEN {column}_q1 - 3 * ({column}_q3 - {column}_q1)
        WHEN {column} > {column}_q3 + 3 * ({column}_q3 - {column}_q1) THEN {column}_q3 + 3 * ({column}_q3 - {column}_q1)
        ELSE CAST({column} AS DOUBLE) END, 4)"""


def _quartiles(columns, source: str) -> str:
    return "SELECT " + ", ".join(
        f"quantile_cont(CAST({x} AS DOUBLE), 0.25) AS {x}_q1, quantile_cont(CAST({x} AS DOUBLE), 0.75) AS {x}_q3" for x in columns
    ) + f" FROM {source}"


def _median(column: str, source: str) -> str:
    return f"(SELECT quantile_cont(CAST({column} AS DOUBLE), 0.5) FROM {source})"


def _imputed(statistic: str) -> str:
    """Gaps filled with a statistic of the column, for the amounts and their scaled versions."""
    filled = ", ".join(
        f"{significant_sql(f'coalesce({x}, fill_{x})')} AS {x}" for x in [*GAPS, *SCALED]
    )
    found = ", ".join(f"{statistic.format(x)} AS fill_{x}" for x in [*GAPS, *SCALED])
    return (
        on_raw("").rstrip()
        + f""", t AS MATERIALIZED (SELECT {_K}, age, price, {SCALED_SQL} FROM raw), fills AS MATERIALIZED (SELECT {found} FROM t)
      SELECT {_K}, {filled} FROM t CROSS JOIN fills"""
    )


def _mode(column: str, source: str) -> str:
    return f"""(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}
        ORDER BY count(*) DESC, {column} LIMIT 1)"""


def _zflag(column: str) -> str:
    return f"""CAST(CASE WHEN abs({column} - (SELECT avg({column}) FROM raw)) / (SELECT stddev_samp({column}) FROM raw) > 3
        THEN 1 ELSE 0 END AS INTEGER) AS {column}_outlier"""


# Duplicates merged, the date and text columns parsed: the table the cleaning statistics are taken on.
_DEDUP = f"""WITH {RAW_SQL.strip()},
  t AS (SELECT DISTINCT * FROM raw),
  u AS (SELECT invoice_no, customer_id, {_clean_text('gender')} AS gender, age, {_clean_text('category')} AS category,
    quantity, price, PAYMENT AS payment_method, try_strptime(invoice_date, '%d/%m/%Y') AS invoice_date, MALL AS shopping_mall, {_K} FROM t),
  f AS (SELECT * REPLACE (coalesce(invoice_date, {_mode('invoice_date', 'u')}) AS invoice_date,
    coalesce(CAST(age AS DOUBLE), {_median('age', 'u')}) AS age, CAST(quantity AS DOUBLE) AS quantity,
    coalesce(price, {_median('price', 'u')}) AS price) FROM u)"""

_CLEAN_SALES = (
    _DEDUP.replace("PAYMENT", _clean_text("payment_method")).replace("MALL", _clean_text("shopping_mall"))
    + f""",
  q AS ({_quartiles(CAPPED, 'f')}),
  g AS (SELECT f.* REPLACE ({', '.join(f'{_capped(x)} AS {x}' for x in CAPPED)}) FROM f, q)
  SELECT *, round(price * quantity, 4) AS total_amount, CAST(year(invoice_date) AS INTEGER) AS year,
    CAST(month(invoice_date) AS INTEGER) AS month, CAST(day(invoice_date) AS INTEGER) AS day,
    CAST(isodow(invoice_date) - 1 AS INTEGER) AS day_of_week, CAST(quarter(invoice_date) AS INTEGER) AS quarter FROM g"""
)

_GENERIC = (
    _DEDUP.replace("PAYMENT", "payment_method").replace("MALL", "shopping_mall")
    + f""",
  q AS ({_quartiles(['price', 'age'], 'f')})
  SELECT f.* REPLACE ({_capped('price')} AS price, {_capped('age')} AS age, {', '.join(f'CAST({k} AS DOUBLE) AS {k}' for k in KEYS)}) FROM f, q"""
)

def _logged(step: str, column: str | None, metric: str, value: str, detail: str = "CAST(NULL AS VARCHAR)") -> str:
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{step}' AS step, {name} AS "column", '{metric}' AS metric, CAST({value} AS DOUBLE) AS value, {detail} AS detail"""


_CHANGED = ["gender", "category", "payment_method", "shopping_mall"]
_TYPED = ["invoice_no", "customer_id", "gender", "age", "category", "quantity", "price", "payment_method", "invoice_date", "shopping_mall"]
_LOG = (
    _DEDUP.replace("PAYMENT", _clean_text("payment_method")).replace("MALL", _clean_text("shopping_mall"))
    + f",\n  q AS ({_quartiles(CAPPED, 'f')})\n"
    + "\nUNION ALL ".join(
        [
            _logged("duplicates", None, "rows_before", "(SELECT count(*) FROM raw)"),
            _logged("duplicates", None, "rows_after", "(SELECT count(*) FROM t)"),
            _logged("duplicates", None, "rows_removed", "(SELECT count(*) FROM raw) - (SELECT count(*) FROM t)"),
            _logged("dates", "invoice_date", "format", "NULL", "'d/M/yyyy'"),
            _logged(
                "dates",
                "invoice_date",
                "lost",
                "(SELECT count(*) FROM t WHERE invoice_date IS NOT NULL AND try_strptime(invoice_date, '%d/%m/%Y') IS NULL)",
            ),
            *[_logged("text", x, "changed", f"(SELECT count(*) FROM t WHERE {x} IS DISTINCT FROM {_clean_text(x)})") for x in _CHANGED],
            *[_logged("types", x, "lost", "0") for x in _TYPED],
            _logged(
                "columns",
                "loyalty_tier",
                "dropped",
                "round((SELECT 1 - count(loyalty_tier) / count(*) FROM t), 9)",
                "'missing share above 0.3'",
            ),
            *[_logged("missing", x, "filled", f"(SELECT count(*) - count({x}) FROM u)") for x in ("age", "price", "invoice_date")],
            *[_logged("outliers", x, "capped", f"(SELECT count(*) FROM f, q WHERE {x} < {x}_q1 - 3 * ({x}_q3 - {x}_q1) "
              f"OR {x} > {x}_q3 + 3 * ({x}_q3 - {x}_q1))") for x in CAPPED],
        ]
    )
)

ORACLES = {
    "cleaning_log": _LOG,
    "dedup_all": on_raw("SELECT DISTINCT * FROM raw"),
    "dedup_first": _pick("ASC"),
    "dedup_last": _pick("DESC"),
    "dedup_none": on_sales("""SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY customer_id, shopping_mall) AS n
        FROM sales) WHERE n = 1"""),
    "standardize_dates": on_raw(f"""SELECT {_K}, CASE
        WHEN (SELECT count(try_strptime(invoice_date, '%Y-%m-%d')) FROM raw) > 0 THEN try_strptime(invoice_date, '%Y-%m-%d')
        WHEN (SELECT count(try_strptime(invoice_date, '%d/%m/%Y')) FROM raw) > 0 THEN try_strptime(invoice_date, '%d/%m/%Y')
        WHEN (SELECT count(try_strptime(invoice_date, '%m/%d/%Y')) FROM raw) > 0 THEN try_strptime(invoice_date, '%m/%d/%Y')
        ELSE try_strptime(invoice_date, '%Y/%m/%d') END AS invoice_date FROM raw"""),
    "standardize_text": on_raw(f"""SELECT {_K}, lower(trim(gender)) AS gender, lower(trim(category)) AS category,
        lower(trim(payment_method)) AS payment_method, lower(trim(shopping_mall)) AS shopping_mall FROM raw"""),
    "standardize_text_nan": on_raw(
        f"SELECT {_K}, "
        + ", ".join(f"{_clean_text(x)} AS {x}" for x in ("gender", "category", "payment_method", "shopping_mall"))
        + " FROM raw"
    ),
    "coerce_types": on_sales(f"""SELECT {_K}, CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE quantity END AS quantity_text,
        CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE) END AS price_text,
        CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE CAST(CAST(invoice_date AS DATE) AS TIMESTAMP) END AS date_text,
        CASE WHEN l_orderkey % 41 = 0 THEN 'nan' ELSE CAST(age AS VARCHAR) END AS age_text,
        CAST(age AS DOUBLE) / 4 AS quarter_age FROM sales"""),
    "drop_sparse_columns": on_raw("SELECT * EXCLUDE (loyalty_tier) FROM raw"),
    "drop_null_rows": on_raw("""SELECT * EXCLUDE (loyalty_tier) FROM raw
        WHERE age IS NOT NULL AND category IS NOT NULL AND price IS NOT NULL AND gender IS NOT NULL"""),
    "impute_median": _imputed("quantile_cont(CAST({} AS DOUBLE), 0.5)"),
    "impute_mean": _imputed("avg(CAST({} AS DOUBLE))"),
    "impute_mode": on_raw(f"""SELECT {_K}, coalesce(category, {_mode('category', 'raw')}) AS category,
        coalesce(loyalty_tier, {_mode('loyalty_tier', 'raw')}) AS loyalty_tier FROM raw"""),
    "forward_fill": _fill(""),
    "forward_fill_grouped": _fill("PARTITION BY customer_id"),
    "outlier_iqr_cap": on_raw(f"""SELECT {_K}, {', '.join(f'{_capped(x)} AS {x}' for x in CAPPED)}
        FROM raw, ({_quartiles(CAPPED, 'raw')}) q"""),
    "outlier_zscore": on_raw(f"SELECT {_K}, {', '.join(CAPPED)}, {', '.join(map(_zflag, CAPPED))} FROM raw"),
    "derived_columns": on_sales(f"""SELECT {_K}, price, quantity, invoice_date, price * quantity AS total_amount,
        CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month,
        CAST(day(invoice_date) AS INTEGER) AS day, CAST(isodow(invoice_date) - 1 AS INTEGER) AS day_of_week,
        CAST(quarter(invoice_date) AS INTEGER) AS quarter FROM sales"""),
    "clean_sales": _CLEAN_SALES,
    "clean_generic": _GENERIC,
}
