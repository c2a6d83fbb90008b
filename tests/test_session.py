import os

from pyspark.sql import functions as F

from marketloom import session


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}


def folders(df):
    return {f.removeprefix("file://").rsplit("/", 1)[0] for f in df.inputFiles()}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = session.durable(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    assert not shuffle_files(spark) - before
    assert rows.count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_tables_of_a_job_go_with_it(spark):
    outside = session.durable(spark.range(5))
    with session.temporary(spark):
        inside = session.durable(spark.range(5))
        where = folders(inside)
        assert all(os.path.isdir(f) for f in where)
    assert where and not any(os.path.isdir(f) for f in where)
    assert outside.count() == 5 and session.durable(spark.range(3)).count() == 3


def test_only_own_tables_are_discarded(spark, tmp_path):
    kept, gone = str(tmp_path / "kept"), session.durable(spark.range(5))
    spark.range(5).write.parquet(kept)
    where = folders(gone)
    session.discard(gone)
    session.discard(spark.read.parquet(kept))
    assert not any(os.path.isdir(f) for f in where) and spark.read.parquet(kept).count() == 5
