"""A table laid out for filters on any of several columns, in place of an index on each.

Rows are ordered along a space-filling curve: each column's values become bucket numbers between splitters, the numbers' bits are
interleaved (highest bits first), and files hold whole cells of the curve. A file so covers a small range of every column at once, and a
filter on any one of k columns reads about files ** (1 - 1/k) of them (a quarter of 256 files of four columns), where a sorted table serves its
first column only.

``<path>/data`` holds the rows and ``<path>/files`` the smallest and largest value and the number of nulls of each column per file. A read
looks its filter up there and scans only the files that may hold rows. Inside these Parquet's own statistics skip row groups, and Bloom
filters (``bloom``) do so for single values of a column with many values.

Scale: splitters come from a sample of about ``SAMPLE`` rows (they decide about the layout only, never about results); rows are shuffled
once, by range of cells, and a cell that holds more than twice a file's share is spread over files by the hash of its rows (rows that are equal
in all columns stay together).
A name per file that a filter leaves goes to the driver, as Spark's own listing does.

Odd inputs: nulls sort before all values and are found by a filter on None; an empty table has no files to read; NaN counts as larger than all
numbers, as Spark orders it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import amounts

SAMPLE = 20_000
_Z, _SALT = "__z", "__salt"


def splitters(df: DataFrame, by: Sequence[str], bits: int) -> dict[str, list[tuple]]:
    """Ascending (value, number of its bucket) for each column, at the quantiles of its rows.

    A frequent value takes several quantiles, and the number of its bucket is the last one's: numbers cover their whole range, so that the
    highest bits part every column's rows in halves, also those of few values.
    """
    rows, buckets = df.count(), 2**bits
    part = df.select(*[F.col(f"`{c}`") for c in by])
    if rows > SAMPLE:
        part = part.sample(SAMPLE / rows, seed=0)
    found = part.collect()  # about SAMPLE rows
    out = {}
    for c in by:
        values = sorted(r[c] for r in found if r[c] is not None and r[c] == r[c])
        # A later quantile of the same value replaces the one before.
        out[c] = sorted({values[len(values) * i // buckets]: i for i in range(1, buckets)}.items()) if values else []
    return out


def bucket(value: Column, cuts: Sequence[tuple], below: int = 0) -> Column:
    """The bucket of the largest splitter not above a value, by binary search; null is in the first bucket."""
    if not cuts:
        return F.lit(below)
    middle = len(cuts) // 2
    cut, number = cuts[middle]
    return F.when(value >= F.lit(cut), bucket(value, cuts[middle + 1 :], number)).otherwise(bucket(value, cuts[:middle], below))


def interleaved(numbers: Sequence[Column], bits: Sequence[int]) -> Column:
    """The bits of the numbers (``bits`` of each) in turn, the highest ones first."""
    turns = [(i, b) for t in range(max(bits)) for i, b in ((i, n - 1 - t) for i, n in enumerate(bits)) if b >= 0]
    places = [
        F.shiftleft(F.shiftright(numbers[i], b).bitwiseAND(F.lit(1)).cast("long"), len(turns) - 1 - at)
        for at, (i, b) in enumerate(turns)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), places)


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int, bloom: Mapping[str, int] | None = None) -> None:
    """Write a stored table in about ``files`` files clustered by several columns; the path must be new.

    ``bloom`` names columns that get Bloom filters, with the number of different values expected in a file.
    """
    spark, by = df.sparkSession, list(by)
    total = max(1, int(math.log2(files)))
    bits = [total // len(by) + (i < total % len(by)) for i in range(len(by))]
    cuts = splitters(df, by, max(bits))
    places = [bucket(F.col(f"`{c}`"), cuts[c]) for c in by]
    placed = df.withColumn(_Z, interleaved([F.shiftright(n, max(bits) - b) for n, b in zip(places, bits)], bits))
    # Cells above twice their share are split by the hash of the row: files / 2 cells at most.
    sizes = placed.groupBy(_Z).agg(amounts.row_count().alias("rows"))
    rows = sizes.agg(F.sum("rows")).first()[0] or 0
    large = {r[_Z]: -(-r["rows"] * files // rows) for r in sizes.where(F.col("rows") * files > 2 * rows).collect()}
    salt = F.lit(0)
    if large:
        known = F.create_map(*[F.lit(v) for z, n in large.items() for v in (z, n)])
        plain = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        salt = F.coalesce(F.pmod(F.xxhash64(*plain), F.try_element_at(known, F.col(_Z))), F.lit(0))
    # Several ranges for each cell, most of them empty, so that files end where cells end.
    ranges = 4 * (2**total + sum(large.values()))
    ranged = placed.withColumn(_SALT, salt).repartitionByRange(ranges, _Z, _SALT)
    ranged = ranged.sortWithinPartitions(_Z, _SALT, *[f"`{c}`" for c in by])
    writer = ranged.drop(_Z, _SALT).write
    for c, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(values))
    writer.parquet(f"{path}/data")
    written = spark.read.schema(df.schema).parquet(f"{path}/data")
    stats = written.groupBy(F.regexp_extract("_metadata.file_path", "([^/]+)$", 1).alias("file")).agg(
        amounts.row_count().alias("rows"),
        *[
            e.alias(f"{k}_{i}")
            for i, c in enumerate(by)
            for k, e in (("low", F.min(f"`{c}`")), ("high", F.max(f"`{c}`")), ("nulls", F.count_if(F.col(f"`{c}`").isNull())))
        ],
    )
    # The names of the columns stand beside the statistics, so that a read needs nothing but the path.
    stats.withColumn("by", F.array(*[F.lit(c) for c in by])).coalesce(1).write.parquet(f"{path}/files")


Filter = Mapping[str, object]


def _test(wanted, one, between, null) -> Column:
    """A filter's condition: None, a (low, high) pair with open ends as None, a list of values, or one value."""
    if wanted is None:
        return null
    if isinstance(wanted, tuple):
        return between(*wanted)
    if isinstance(wanted, list):
        return reduce(lambda a, b: a | b, [_test(w, one, between, null) for w in wanted], F.lit(False))
    return one(wanted)


def _row_test(c: str, wanted) -> Column:
    value = F.col(f"`{c}`")

    def between(low, high):
        ends = ([value >= F.lit(low)] if low is not None else []) + ([value <= F.lit(high)] if high is not None else [])
        return reduce(lambda a, b: a & b, ends, value.isNotNull())

    return _test(wanted, lambda v: value == F.lit(v), between, value.isNull())


def _file_test(i: int, wanted) -> Column:
    low, high = F.col(f"low_{i}"), F.col(f"high_{i}")

    def between(a, b):
        ends = ([high >= F.lit(a)] if a is not None else []) + ([low <= F.lit(b)] if b is not None else [])
        return reduce(lambda x, y: x & y, ends, low.isNotNull())

    return _test(wanted, lambda v: (low <= F.lit(v)) & (high >= F.lit(v)), between, F.col(f"nulls_{i}") > 0)


def candidate_files(spark: SparkSession, path: str, where: Filter) -> list[str]:
    """The files that may hold rows of a filter; columns that the table is not clustered by rule out none."""
    stats = spark.read.parquet(f"{path}/files")
    named = stats.select("by").first()
    by = list(named["by"]) if named else []
    kept = stats.where(reduce(lambda a, b: a & b, [_file_test(by.index(c), w) for c, w in where.items() if c in by], F.lit(True)))
    return sorted(r["file"] for r in kept.select("file").collect())


def read_clustered(spark: SparkSession, path: str, where: Filter | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows that match: ``where`` gives for a column a value, None, a (low, high) pair (None: open) or a list of values."""
    whole = spark.read.parquet(f"{path}/data")
    rows = whole
    if where:
        names = candidate_files(spark, path, where)
        rows = spark.read.schema(whole.schema).parquet(*[f"{path}/data/{n}" for n in names]) if names else whole.where(F.lit(False))
        rows = rows.where(reduce(lambda a, b: a & b, [_row_test(c, w) for c, w in where.items()]))
    return rows.select(*[f"`{c}`" for c in columns]) if columns else rows
