"""The sales tables that the registered queries run on, derived from the given star schema; and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Identifies a row of the sales table (and, copies apart, of the raw one).
ORDER = ["invoice_date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
KEYS = ORDER[1:]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a table by its key where the session asks for it: small test tables sit in one row group, which one task would read."""
    wanted = df.sparkSession.conf.get("spark.marketloom.spread", "false") == "true"
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key) if wanted else df


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, with made-up gender and age per customer."""
    customer, price, quantity = F.col("o_custkey"), F.col("l_extendedprice"), F.col("l_quantity")
    return (
        spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("I"), F.col("l_orderkey").cast("string")).alias("invoice_no"),
            F.concat(F.lit("C"), customer.cast("string")).alias("customer_id"),
            F.when(customer % 2 == 0, "Female").otherwise("Male").alias("gender"),
            (18 + customer % 52).cast("bigint").alias("age"),
            F.col("p_type").alias("category"),
            quantity.cast("bigint").alias("quantity"),
            price.alias("price"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_orderdate").alias("invoice_date"),
            F.col("n_name").alias("shopping_mall"),
            (price * quantity).alias("total_amount"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_extendedprice",
        )
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales table with copies, date text, padding, missing values and a few prices a hundred times too high."""
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    dirty = sales(spark, sf_dir).select(
        "invoice_no",
        "customer_id",
        F.when(order % 3 == 0, F.concat(F.lit("  "), F.upper("gender"), F.lit(" "))).otherwise(F.col("gender")).alias("gender"),
        F.when(order % 23 != 0, F.col("age")).alias("age"),
        F.when(part % 29 == 0, F.lit(None)).when(order % 3 == 1, F.upper("category")).otherwise(F.col("category")).alias("category"),
        "quantity",
        F.when(order % 19 == 0, F.lit(None)).when(order % 101 == 0, F.col("price") * 100).otherwise(F.col("price")).alias("price"),
        "payment_method",
        F.when(order % 31 == 0, "unknown").otherwise(F.date_format("invoice_date", "d/M/yyyy")).alias("invoice_date"),
        "shopping_mall",
        F.when(order % 5 >= 2, "gold").alias("loyalty_tier"),
        *KEYS,
    )
    copies = F.when(order % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return dirty.withColumn("__copy", F.explode(copies)).drop("__copy")


SALES_SQL = """
sales AS (
  SELECT concat('I', CAST(l_orderkey AS VARCHAR)) AS invoice_no,
         concat('C', CAST(o_custkey AS VARCHAR)) AS customer_id,
         CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CAST(18 + o_custkey % 52 AS BIGINT) AS age,
         p_type AS category,
         CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice AS price,
         o_orderpriority AS payment_method,
         o_orderdate AS invoice_date,
         n_name AS shopping_mall,
         l_extendedprice * l_quantity AS total_amount,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem
  JOIN orders   ON l_orderkey = o_orderkey
  JOIN part     ON l_partkey  = p_partkey
  JOIN supplier ON l_suppkey  = s_suppkey
  JOIN nation   ON s_nationkey = n_nationkey
)"""

RAW_SQL = (
    SALES_SQL
    + """,
r0 AS (
  SELECT invoice_no, customer_id,
    CASE WHEN l_orderkey % 3 = 0 THEN concat('  ', upper(gender), ' ') ELSE gender END AS gender,
    CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE age END AS age,
    CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_orderkey % 3 = 1 THEN upper(category) ELSE category END AS category,
    quantity,
    CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN price * 100 ELSE price END AS price,
    payment_method,
    CASE WHEN l_orderkey % 31 = 0 THEN 'unknown' ELSE strftime(invoice_date, '%-d/%-m/%Y') END AS invoice_date,
    shopping_mall,
    CASE WHEN l_orderkey % 5 < 2 THEN NULL ELSE 'gold' END AS loyalty_tier,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM sales
),
raw AS (SELECT * FROM r0 UNION ALL SELECT * FROM r0 WHERE l_orderkey % 13 = 0)"""
)


def money(column: str, over: str = "") -> str:
    """SQL for a sum of amounts that does not depend on the order of the rows."""
    return f"CAST(sum(CAST({column} AS DECIMAL(18,4))){over} AS DOUBLE)"


def mean(column: str, over: str = "") -> str:
    return f"({money(column, over)} / nullif(count({column}){over}, 0))"


def significant(df: DataFrame, columns, digits: int = 9) -> DataFrame:
    """Doubles rounded to significant digits: engines add in different orders, and values may be tiny or huge."""
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.format_string(f"%.{digits}e", F.col(c).cast("double"))).cast("double") for c in columns})


def significant_sql(expression: str, digits: int = 9) -> str:
    return f"CAST(printf('%.{digits}e', CAST({expression} AS DOUBLE)) AS DOUBLE)"


def on_sales(select: str) -> str:
    return f"WITH {SALES_SQL.strip()}\n{select}"


def on_raw(select: str) -> str:
    return f"WITH {RAW_SQL.strip()}\n{select}"
