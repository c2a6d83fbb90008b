import threading

import pytest
from pyspark.sql import functions as F

from marketloom.sources import snapshots as sn


@pytest.fixture
def path(spark, tmp_path):
    place = str(tmp_path / "table")
    rows = spark.range(0, 100, numPartitions=4).select("id", F.lit("a").alias("name"), (F.col("id") * 0.5).alias("x"))
    sn.create_snapshot(rows, place)
    return place


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(version):
    return {(f, n) for f, names in version.folders.items() for n in (names or ["*"])}


def test_update_rewrites_only_touched_files_and_old_readers_keep_their_rows(spark, path):
    before = sn.read_snapshot(spark, path)
    first = sn.open_version(spark, path)
    v = sn.update_snapshot(spark, path, F.col("id") < 3, {"x": 0.5, "name": "b"})
    assert (v.number, v.counts) == (2, {"matched": 3, "changed": 3})
    # Three of the first version's four files are taken over.
    (old,) = first.folders
    assert len(v.folders[old]) == 3
    assert before.where("name = 'b'").count() == 0 and before.count() == 100
    assert sn.read_snapshot(spark, path).where("name = 'b'").count() == 3
    again = sn.update_snapshot(spark, path, F.col("id") < 3, {"x": 0.5, "name": "b"})
    assert again.counts == {"matched": 3, "changed": 0}


def test_update_without_a_match_publishes_nothing_but_an_upsert(spark, path):
    v = sn.update_snapshot(spark, path, {"id": 1000}, {"name": "n"})
    assert v.number == 1 and v.counts["matched"] == 0
    v = sn.update_snapshot(spark, path, {"id": 1000}, {"name": "n"}, upsert=True)
    assert v.number == 2 and v.counts == {"added": 1}
    assert content(sn.read_snapshot(spark, path).where("id = 1000")) == [(1000, "n", None)]


def test_delete_upsert_append_and_time_travel(spark, path):
    assert sn.delete_snapshot(spark, path, F.col("id") >= 90).counts == {"matched": 10, "deleted": 10}
    changes = spark.createDataFrame([(1, "z"), (2, "a"), (500, "new"), (None, "no key")], "id long, name string")
    v = sn.upsert_snapshot(changes, path, ["id"])
    assert v.counts == {"matched": 2, "changed": 1, "added": 2}
    sn.append_snapshot(spark.createDataFrame([(7.5, 600, "ap")], "x double, id int, name string"), path)
    rows = sn.read_snapshot(spark, path)
    assert rows.count() == 93
    assert content(rows.where("id in (1, 2, 500, 600) or id is null")) == sorted(
        [(1, "z", 0.5), (2, "a", 1.0), (500, "new", None), (None, "no key", None), (600, "ap", 7.5)], key=str
    )
    assert [sn.read_snapshot(spark, path, n).count() for n in (1, 2, 3, 4)] == [100, 90, 92, 93]
    got = [tuple(r) for r in sn.history(spark, path).collect()]
    assert got == [(1, "create", 0, 0, 100, 0), (2, "delete", 10, 0, 0, 10), (3, "upsert", 2, 1, 2, 0), (4, "append", 0, 0, 1, 0)]
    assert sn.delete_snapshot(spark, path, F.lit(True)).counts["deleted"] == 93
    assert sn.read_snapshot(spark, path).collect() == []
    sn.append_snapshot(changes.withColumn("x", F.lit(1.0)), path)
    assert sn.read_snapshot(spark, path).count() == 4


def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, path, monkeypatch):
    def dies(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(sn, "publish", dies)
    with pytest.raises(RuntimeError, match="lost driver"):
        sn.delete_snapshot(spark, path, F.col("id") < 50)
    monkeypatch.undo()
    assert sn.read_snapshot(spark, path).count() == 100
    # One that dies while it writes data.
    bad = F.when(F.col("id") == 1, F.raise_error(F.lit("lost task"))).otherwise(F.col("x"))
    with pytest.raises(Exception, match="lost task"):
        sn.update_snapshot(spark, path, F.col("id") < 3, {"x": bad.cast("double")})
    assert sn.versions(spark, path) == [1] and sn.read_snapshot(spark, path).count() == 100
    assert sn.delete_snapshot(spark, path, F.col("id") < 50).number == 2
    orphans = len(sn._names(spark, f"{path}/data")) - len(sn.open_version(spark, path).folders)
    assert orphans >= 1 and sn.vacuum(spark, path, keep=2) == 0
    assert sn.vacuum(spark, path, keep=1, older_than_s=-60) >= 1
    assert set(sn._names(spark, f"{path}/data")) == set(sn.open_version(spark, path).folders)
    assert sn.read_snapshot(spark, path).count() == 50


def test_writers_that_meet_all_get_through(spark, path):
    failed = []

    def run(k):
        try:
            sn.update_snapshot(spark, path, F.col("id") == k, {"name": f"by {k}"})
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=run, args=(k,)) for k in (1, 30, 60)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and sn.versions(spark, path) == [1, 2, 3, 4]
    rows = sn.read_snapshot(spark, path)
    assert rows.count() == 100 and content(rows.where("name <> 'a'").select("name")) == [("by 1",), ("by 30",), ("by 60",)]


def test_a_version_is_published_once(spark, path):
    base = sn.open_version(spark, path)
    with pytest.raises(sn.Conflict):
        sn.publish(spark, base)
    assert [n for n in sn._names(spark, f"{path}/versions") if n.startswith(".draft")] == []
    with pytest.raises(FileNotFoundError):
        sn.open_version(spark, path + "x")
