import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from marketloom.sources import clustered as cl

BY = ["day", "customer", "kind", "mall"]
FILES = 256


@pytest.fixture(scope="module")
def rows(spark):
    n = 20_000
    hashed = lambda i, m: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(m))
    return spark.range(0, n, numPartitions=4).select(
        "id",
        F.date_add(F.lit(dt.date(2024, 1, 1)), hashed(1, 700).cast("int")).alias("day"),
        F.format_string("C%05d", hashed(2, 3000)).alias("customer"),
        F.when(F.col("id") % 50 != 0, F.format_string("kind %d", hashed(3, 40))).alias("kind"),
        # A third of all rows share one mall.
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("mall %d", hashed(4, 25))).alias("mall"),
    )


@pytest.fixture(scope="module")
def path(rows, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("clustered") / "table")
    cl.write_clustered(rows, place, BY, FILES)
    return place


FILTERS = {
    "day": {"day": dt.date(2024, 5, 5)},
    "days": {"day": (dt.date(2024, 5, 5), dt.date(2024, 5, 25))},
    "customer": {"customer": "C00123"},
    "kind": {"kind": "kind 7"},
    "mall": {"mall": "mall 9"},
    "two kinds": {"kind": ["kind 1", "kind 11"], "customer": (None, "C01")},
    "no kind": {"kind": None},
    "other column": {"id": 77},
    "nowhere": {"customer": "D"},
}


def plain(row, where):
    def fits(value, wanted):
        if wanted is None or value is None:
            return wanted is None and value is None
        if isinstance(wanted, tuple):
            return (wanted[0] is None or value >= wanted[0]) and (wanted[1] is None or value <= wanted[1])
        return value in wanted if isinstance(wanted, list) else value == wanted

    return all(fits(row[c], w) for c, w in where.items())


@pytest.mark.parametrize("name", FILTERS)
def test_rows_of_a_filter(spark, rows, path, name):
    want = sorted(r.id for r in rows.collect() if plain(r, FILTERS[name]))
    assert sorted(r.id for r in cl.read_clustered(spark, path, FILTERS[name]).collect()) == want


@pytest.mark.parametrize("name", ["day", "customer", "kind", "mall"])
def test_any_one_column_reads_less_than_a_third_of_the_files(spark, path, name):
    scanned = cl.read_clustered(spark, path, FILTERS[name]).inputFiles()
    assert len(scanned) == len(cl.candidate_files(spark, path, FILTERS[name])) < FILES / 3


def test_hot_value_is_spread(spark, path):
    sizes = [r["rows"] for r in spark.read.parquet(f"{path}/files").collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 20_000 / FILES * 4
    assert len(cl.candidate_files(spark, path, {"mall": "hot"})) > 1


def test_bloom_filters_are_written(spark, tmp_path):
    place = str(tmp_path / "table")
    df = spark.range(150_000).select(F.md5(F.col("id").cast("string")).alias("customer"), F.col("id").alias("n"))
    cl.write_clustered(df, place, ["n"], 1, bloom={"customer": 150_000})
    found = duckdb.sql(f"SELECT path_in_schema, bool_or(bloom_filter_offset IS NOT NULL) FROM parquet_metadata('{place}/data/*.parquet') GROUP BY 1")
    assert dict(found.fetchall()) == {"customer": True, "n": False}


def test_odd_tables(spark, tmp_path):
    schema = "`a.b` string, x double, m map<string,int>"
    cl.write_clustered(spark.createDataFrame([], schema), str(tmp_path / "empty"), ["a.b", "x"], 8)
    assert cl.read_clustered(spark, str(tmp_path / "empty"), {"x": 1.0}).count() == 0
    odd = [(None, None, None), ("", float("nan"), {"k": 1}), ("é", float("inf"), {}), ("é", -1.0, None)] * 5
    place = str(tmp_path / "odd")
    cl.write_clustered(spark.createDataFrame(odd, schema), place, ["a.b", "x"], 8)
    count = lambda where: cl.read_clustered(spark, place, where).count()
    assert [count({"a.b": "é"}), count({"a.b": None}), count({"x": None, "a.b": None}), count({"x": (0.0, None)})] == [10, 5, 5, 10]
    assert count({"x": float("nan")}) == 5 and count(None) == 20 and count({"a.b": []}) == 0
