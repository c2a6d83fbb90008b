"""Helpers that several corpus operators share: tables, text normalisation, ranks that no single task has to count."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: White space runs that differ from one plain space.
_ODD_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"

#: Characters whose composed form, lower case and class are the same in every version of Unicode: printable ASCII and the plain white
#: space, composed Latin and Cyrillic letters (none of which joins with its neighbours), dashes and quotes.
SAFE = r"\x20-\x7e\t\n\r\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f\u0400-\u045f\u2010-\u2027"
unsafe = re.compile(f"[^{SAFE}]").search


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def single_spaced(text: Column) -> Column:
    """Every run of space, tab and line break characters becomes one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ODD_SPACE, " ")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the identifier as text leaves this remainder; a missing identifier counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def bucket_count(rows: int) -> int:
    """Buckets for ``ranked``: about 500 rows each, and more on large tables, where one task sums up all buckets of a group."""
    return max(1, min(rows // 500, 10_000), rows // 50_000)


def ranked(
    df: DataFrame,
    groups: Sequence[str],
    bucket: str,
    order: Sequence[Column],
    name: str,
    value: Column | None = None,
) -> DataFrame:
    """Adds ``name``: the rows (or the sum of ``value``) of the same group before each row, in the order (bucket, ``order``).

    A task sorts one (group, bucket), never a whole group: each bucket is summed up first, and the running sum over these
    gives what comes before it. ``df`` is read twice: pass a stored table, or one whose buckets depend on its rows only.
    """
    value = F.lit(1).cast("long") if value is None else value
    sums = df.groupBy(*groups, bucket).agg(F.sum(value).alias("__n"))
    # One row per bucket of a group; the caller bounds the buckets by rows / rows per task.
    along = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*groups, bucket]
    first = sums.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("__n").over(along), F.lit(0)).alias("__first")
    )
    on = None
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"__k{i}"))
        on = same if on is None else on & same
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("__local", F.coalesce(F.sum(value).over(within), F.lit(0)))
    out = local.join(first, on, "left").withColumn(name, F.col("__first") + F.col("__local"))
    return out.drop("__local", "__first", *[f"__k{i}" for i in range(len(keys))])
