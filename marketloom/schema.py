"""Table schemas and column roles of the sales data model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_SALES = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("invoice_date", T.StringType()),
        T.StructField("shopping_mall", T.StringType()),
    ]
)

# Types that the cleaning job coerces the sales columns to.
SALES_TYPES = {
    "invoice_no": "str",
    "customer_id": "str",
    "gender": "category",
    "age": "int64",
    "category": "category",
    "quantity": "int64",
    "price": "float64",
    "payment_method": "category",
    "invoice_date": "datetime",
    "shopping_mall": "category",
}

TEXT_COLUMNS = ["gender", "category", "payment_method", "shopping_mall"]
OUTLIER_COLUMNS = ["age", "quantity", "price"]
ID_COLUMNS = ["invoice_no", "customer_id", "invoice_date"]
TARGET = "total_amount"

# Fixed values that must equal the reference's settings for right results.
MISSING_THRESHOLD = 0.3
OUTLIER_THRESHOLD = 3.0
LAG_PERIODS = [1, 7, 14, 28]
ROLLING_WINDOWS = [7, 14, 30]
RETENTION_MONTHS = {"cleaned": 24, "transformed": 12, "aggregates": 6}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def other_columns(df: DataFrame) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def present(df: DataFrame, columns) -> list[str]:
    """The given columns that ``df`` has; optional columns may be absent."""
    have = set(df.columns)
    return [c for c in columns if c in have]
