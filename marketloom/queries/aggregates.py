"""Aggregations and dashboard reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import aggregates as a
from marketloom.plans import reports as r
from marketloom.queries.fixtures import mean, money, on_sales, sales, table
from marketloom.session import durable, scratch_path

TOTALS = f"""{money('total_amount')} AS total_sales, {money('quantity')} AS total_quantity,
  count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers, {mean('total_amount')} AS avg_transaction"""
SHORT = f"""{money('total_amount')} AS total_sales, count(*) AS transaction_count,
  count(DISTINCT customer_id) AS unique_customers, {mean('total_amount')} AS avg_transaction"""
VIEW = f"""{money('total_amount')} AS total_sales, {mean('total_amount')} AS avg_transaction,
  count(total_amount) AS transaction_count, {money('quantity')} AS total_quantity, {mean('quantity')} AS avg_quantity,
  count(DISTINCT customer_id) AS unique_customers"""
SUMMARIZED = [a.CUSTOMER, a.AMOUNT, a.DATE, "quantity", *a.PREFERENCES.values()]
INT = lambda e, n: f"CAST({e} AS INTEGER) AS {n}"

# The date range and category that the report queries are filtered by.
FILTER = ("1996-03-01", "1998-06-30", "PROMO")


def _save_aggregate(spark, d):
    path = scratch_path(spark, "by_category")
    a.save_aggregate(a.sales_by_category(sales(spark, d)), path)
    return spark.read.parquet(path)


def _flat_aggregated(spark, d):
    out = a.aggregated_sales(sales(spark, d))
    return out.select("aggregation_type", "period", "dimension", "dimension_value", "metrics.*")


def _filter_category(spark, d):
    """A category that exists, so that the filter keeps something at every scale."""
    return sales(spark, d).agg(F.min("category")).first()[0]


def _report_filters(spark, d):
    df = sales(spark, d)
    kept = r.filtered(df, FILTER[0], FILTER[1], _filter_category(spark, d))
    return kept.select("invoice_no", "customer_id", "category", "invoice_date", "quantity", "total_amount")


def _by_hour(spark, d):
    return r.by_hour(table(spark, d, "events"), "ts", "value")


QUERIES = {
    "sales_by_day": lambda s, d: a.sales_by_period(sales(s, d), "day"),
    "sales_by_week": lambda s, d: a.sales_by_period(sales(s, d), "week"),
    "sales_by_month": lambda s, d: a.sales_by_period(sales(s, d), "month"),
    "sales_by_year": lambda s, d: a.sales_by_period(sales(s, d), "year"),
    "sales_by_category": lambda s, d: a.sales_by_category(sales(s, d)),
    "customer_rfm": lambda s, d: a.customer_rfm(sales(s, d)),
    "sales_by_mall": lambda s, d: a.sales_by_category(sales(s, d), "shopping_mall"),
    "shipping_by_month": lambda s, d: a.sales_by_period(
        table(s, d, "lineitem").select(F.col("l_shipdate").alias("ship.date"), F.col("l_extendedprice").alias("net.amount"),
            F.col("l_suppkey").alias("supplier.key"), F.col("l_quantity").alias("quantity")),
        "month", "ship.date", "net.amount", "supplier.key"),
    "top_categories": lambda s, d: a.top_categories(sales(s, d)),
    "sales_by_demographics": lambda s, d: a.sales_by_demographics(sales(s, d)),
    "sales_by_payment": lambda s, d: a.sales_by_payment(sales(s, d)),
    "save_aggregate": _save_aggregate,
    "agg_daily_sales": lambda s, d: a.daily_view(sales(s, d)),
    "agg_category_sales": lambda s, d: a.category_view(sales(s, d)),
    "agg_customer_summary": lambda s, d: a.customer_view(sales(s, d)),
    "customer_summary_ext": lambda s, d: a.customer_summary(durable(sales(s, d).select(*SUMMARIZED), "sales")),
    "aggregated_sales": _flat_aggregated,
    "report_filters": _report_filters,
    "kpis": lambda s, d: r.kpis(sales(s, d)),
    "report_daily": lambda s, d: r.by_day(sales(s, d)),
    "report_monthly": lambda s, d: r.by_month(sales(s, d)),
    "report_category": lambda s, d: r.by_column(sales(s, d), "category"),
    "report_category_share": lambda s, d: r.share_by_column(sales(s, d), "category"),
    "report_payment_share": lambda s, d: r.share_by_column(sales(s, d), "payment_method"),
    "report_gender": lambda s, d: r.by_column(sales(s, d), "gender"),
    "report_age_histogram": lambda s, d: r.age_histogram(sales(s, d)),
    "report_payment": lambda s, d: r.by_column(sales(s, d), "payment_method"),
    "report_mall": lambda s, d: r.by_mall(sales(s, d)),
    "report_weekday": lambda s, d: r.by_weekday(sales(s, d)),
    "report_hour": _by_hour,
    "top_customers": lambda s, d: r.top_by_column(sales(s, d), "customer_id"),
    "report_top_categories": lambda s, d: r.top_by_column(sales(s, d), "category"),
    "report_domains": lambda s, d: r.filter_domains(sales(s, d)),
}


def _by(key: str, columns: str = TOTALS) -> str:
    return on_sales(f"SELECT {key}, {columns} FROM sales GROUP BY ALL")


def _simple(column: str) -> str:
    return on_sales(f"SELECT {column}, {money('total_amount')} AS total_sales FROM sales GROUP BY {column}")


def _share(column: str) -> str:
    return on_sales(f"""SELECT {column}, total_sales, total_sales * 100.0 / CAST(sum(CAST(total_sales AS DECIMAL(30,4))) OVER () AS DOUBLE) AS share
      FROM (SELECT {column}, {money('total_amount')} AS total_sales FROM sales GROUP BY {column})""")


def _top(column: str) -> str:
    return on_sales(f"""SELECT {column}, {money('total_amount')} AS total_sales FROM sales GROUP BY {column}
      ORDER BY total_sales DESC, {column} LIMIT 10""")


def _month_set(kind: str) -> str:
    value = "CAST(NULL AS VARCHAR)" if kind == "period" else kind
    group = "period" if kind == "period" else f"period, {kind}"
    return f"""SELECT '{kind}' AS aggregation_type, period, '{"all" if kind == "period" else kind}' AS dimension,
      {value} AS dimension_value, {SHORT}, min(total_amount) AS min_transaction, max(total_amount) AS max_transaction
      FROM m GROUP BY {group}"""


_D = "invoice_date"
ORACLES = {
    "sales_by_day": _by(f"{INT(f'year({_D})', 'year')}, {INT(f'month({_D})', 'month')}, {INT(f'day({_D})', 'day')}"),
    "sales_by_week": _by(f"{INT(f'isoyear({_D})', 'year')}, {INT(f'week({_D})', 'week')}"),
    "sales_by_month": _by(f"{INT(f'year({_D})', 'year')}, {INT(f'month({_D})', 'month')}"),
    "sales_by_year": _by(INT(f"year({_D})", "year")),
    "sales_by_category": _by("category", f"{TOTALS}, {mean('price')} AS avg_price"),
    "sales_by_mall": _by("shopping_mall", f"{TOTALS}, {mean('price')} AS avg_price"),
    "shipping_by_month": f"""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
        {money('l_extendedprice')} AS total_sales, {money('l_quantity')} AS total_quantity, count(*) AS transaction_count,
        count(DISTINCT l_suppkey) AS unique_customers, {mean('l_extendedprice')} AS avg_transaction FROM lineitem GROUP BY 1, 2""",
    "customer_rfm": _by(
        "customer_id",
        f"""max(invoice_date) AS last_purchase, min(invoice_date) AS first_purchase, count(*) AS frequency,
        {money('total_amount')} AS monetary, {mean('total_amount')} AS avg_transaction""",
    ),
    "top_categories": on_sales(f"""SELECT category, {money('total_amount')} AS total_sales,
        {money('quantity')} AS total_quantity, count(*) AS transaction_count FROM sales GROUP BY category
        ORDER BY total_sales DESC, category LIMIT 10"""),
    "sales_by_demographics": on_sales(f"""SELECT 'gender' AS dimension, gender AS dimension_value, {SHORT} FROM sales GROUP BY gender
        UNION ALL SELECT 'age', CAST(age AS VARCHAR), {SHORT} FROM sales GROUP BY age"""),
    "sales_by_payment": on_sales(f"""SELECT payment_method, total_sales, transaction_count, avg_transaction,
        transaction_count * 100.0 / CAST(sum(transaction_count) OVER () AS DOUBLE) AS percentage FROM (
        SELECT payment_method, {money('total_amount')} AS total_sales, count(*) AS transaction_count,
        {mean('total_amount')} AS avg_transaction FROM sales GROUP BY payment_method)"""),
    "save_aggregate": _by("category", f"{TOTALS}, {mean('price')} AS avg_price"),
    "agg_daily_sales": on_sales(f"""SELECT CAST(x.date AS DATE) AS date, coalesce(total_sales, 0.0) AS total_sales, avg_transaction,
        coalesce(transaction_count, 0) AS transaction_count, coalesce(total_quantity, 0.0) AS total_quantity, avg_quantity,
        coalesce(unique_customers, 0) AS unique_customers
        FROM (SELECT unnest(generate_series(min(invoice_date::DATE), max(invoice_date::DATE), INTERVAL 1 DAY)) AS date FROM sales) x
        LEFT JOIN (SELECT invoice_date::DATE AS date, {VIEW} FROM sales GROUP BY 1) y ON CAST(x.date AS DATE) = y.date"""),
    "agg_category_sales": _by("category", VIEW),
    "agg_customer_summary": _by(
        "customer_id",
        f"""{money('total_amount')} AS total_spent, {mean('total_amount')} AS avg_transaction,
        count(total_amount) AS transaction_count, min(invoice_date) AS first_purchase, max(invoice_date) AS last_purchase""",
    ),
    "customer_summary_ext": on_sales(f"""SELECT b.*, preferred_category, preferred_payment_method, preferred_mall,
        CAST(datediff('day', first_purchase, last_purchase) AS INTEGER) AS days_active,
        CAST(datediff('day', last_purchase, (SELECT max(invoice_date) FROM sales)) AS INTEGER) AS recency_days
        FROM (SELECT customer_id, {money('total_amount')} AS total_spent, {mean('total_amount')} AS avg_transaction,
          count(total_amount) AS transaction_count, min(invoice_date) AS first_purchase, max(invoice_date) AS last_purchase,
          {mean('quantity')} AS avg_items FROM sales GROUP BY customer_id) b
        JOIN (SELECT customer_id, category AS preferred_category FROM (SELECT customer_id, category,
          row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, category) AS rn FROM sales GROUP BY 1, 2) WHERE rn = 1) p1 USING (customer_id)
        JOIN (SELECT customer_id, payment_method AS preferred_payment_method FROM (SELECT customer_id, payment_method,
          row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, payment_method) AS rn FROM sales GROUP BY 1, 2) WHERE rn = 1) p2 USING (customer_id)
        JOIN (SELECT customer_id, shopping_mall AS preferred_mall FROM (SELECT customer_id, shopping_mall,
          row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, shopping_mall) AS rn FROM sales GROUP BY 1, 2) WHERE rn = 1) p3 USING (customer_id)"""),
    "aggregated_sales": on_sales(
        "").rstrip()
    + ", m AS (SELECT *, strftime(invoice_date, '%Y-%m') AS period FROM sales)\n"
    + "\nUNION ALL ".join(_month_set(k) for k in a.AGGREGATE_TYPES),
    "report_filters": on_sales(f"""SELECT invoice_no, customer_id, category, invoice_date, quantity, total_amount FROM sales
        WHERE CAST(invoice_date AS DATE) BETWEEN DATE '{FILTER[0]}' AND DATE '{FILTER[1]}'
        AND category = (SELECT min(category) FROM sales)"""),
    "kpis": on_sales(f"""SELECT {money('total_amount')} AS total_sales, {mean('total_amount')} AS avg_transaction,
        count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers, {mean('quantity')} AS avg_quantity FROM sales"""),
    "report_daily": on_sales(f"SELECT invoice_date::DATE AS date, {money('total_amount')} AS total_sales FROM sales GROUP BY 1"),
    "report_monthly": on_sales(
        f"SELECT strftime(invoice_date, '%Y-%m') AS month, {money('total_amount')} AS total_sales FROM sales GROUP BY 1"
    ),
    "report_category": _simple("category"),
    "report_category_share": _share("category"),
    "report_payment_share": _share("payment_method"),
    "report_gender": _simple("gender"),
    "report_age_histogram": on_sales("""SELECT CAST(floor(30.0 * (age - mn) / (mx + 1 - mn)) AS BIGINT) + 1 AS bin,
        min(age) AS from_value, max(age) AS to_value, count(*) AS rows
        FROM sales, (SELECT min(age) AS mn, max(age) AS mx FROM sales) GROUP BY 1"""),
    "report_payment": _simple("payment_method"),
    "report_mall": on_sales(f"""SELECT shopping_mall, {money('total_amount')} AS total_sales, count(*) AS transaction_count,
        count(DISTINCT customer_id) AS unique_customers FROM sales GROUP BY shopping_mall"""),
    "report_weekday": on_sales(f"""SELECT CAST(w.position AS INTEGER) AS position, w.weekday, total_sales FROM (VALUES (0,'Monday'),
        (1,'Tuesday'),(2,'Wednesday'),(3,'Thursday'),(4,'Friday'),(5,'Saturday'),(6,'Sunday')) w(position, weekday) LEFT JOIN
        (SELECT isodow(invoice_date) - 1 AS position, {money('total_amount')} AS total_sales FROM sales GROUP BY 1) y
        ON w.position = y.position"""),
    "report_hour": f"SELECT CAST(hour(ts) AS INTEGER) AS hour, {money('value')} AS total_sales FROM events GROUP BY 1",
    "top_customers": _top("customer_id"),
    "report_top_categories": _top("category"),
    "report_domains": on_sales("""SELECT category, min(min(invoice_date)) OVER ()::DATE AS first_date,
        max(max(invoice_date)) OVER ()::DATE AS last_date FROM sales WHERE category IS NOT NULL GROUP BY category"""),
}
