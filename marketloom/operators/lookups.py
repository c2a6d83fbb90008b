"""Joining small derived tables back to the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.session import durable

_NULL_SPREAD = 4096


def _spread(df: DataFrame, missing: Column) -> Column:
    """0 for rows with a key. Rows without one match nothing; numbers made from their cells spread them over the join's tasks.

    The table holds its 0 as a stored column: a literal one would be optimized out of the join's keys.
    """
    cells = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]
    return F.when(missing, F.pmod(F.xxhash64(*cells), F.lit(_NULL_SPREAD)) + 1).otherwise(F.lit(0)).cast("int")


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], label: str = "lookup") -> DataFrame:
    """Left join with a derived table.

    The table is written first, so the optimizer knows its size: below the broadcast threshold the rows of ``df`` stay
    where they are, above it the join shuffles, and AQE splits the partitions of hot keys.
    """
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rows, saved = df.withColumn("__spread", _spread(df, missing)), durable(table.withColumn("__spread", F.lit(0)), label)
    return rows.join(saved, [*keys, "__spread"], "left").drop("__spread")


def lookup_columns(df: DataFrame, table: DataFrame, columns: Sequence[str], value: str, suffix: str) -> DataFrame:
    """Join a (column, value, x) table once per column, giving ``{column}{suffix}``."""
    saved = durable(table.withColumn("__none", F.lit(0)), "levels")
    for c in columns:
        part = saved.where(F.col("column") == c).select("__none", F.col("value").alias("__key"), F.col(value).alias(f"{c}{suffix}"))
        key = F.col(c).cast("string")
        rows = df.withColumn("__spread", _spread(df, key.isNull()))
        df = rows.join(part, (key == F.col("__key")) & (F.col("__spread") == F.col("__none")), "left").drop("__key", "__spread", "__none")
    return df
