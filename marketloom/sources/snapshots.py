"""Stored tables that change in place: immutable data files, and one manifest per version.

A table's folder holds ``data/<id>/part-*.parquet``, which are never changed, and ``versions/<number>.json``, one manifest for every
version with the files that belong to it. A change writes new files beside the old ones and then publishes the next manifest by an
atomic create that fails if another writer was first. So

- a reader that has opened a version keeps its rows, whatever is written meanwhile,
- a writer that dies before it publishes leaves nothing but files that no manifest names (``vacuum`` removes them),
- of two writers that meet, one wins; the other starts again from the new version (``RETRIES`` times).

A change rewrites only the files that hold rows it concerns; all others are taken over by name. What it did is counted by an
observation in the job that writes, so no scan is made for the counts.

Publishing needs a file system that renames atomically and not over an existing file (HDFS) or makes links (local disks).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom.sources.tables import Condition, matches

RETRIES = 5
COUNTS = ["matched", "changed", "added", "deleted"]
#: The last batch of a stream that a version holds; every later version carries it on.
BATCH = "batch"
_FILE = "__file"


class Conflict(RuntimeError):
    """Another writer has published the version first."""


@dataclass(frozen=True)
class Version:
    """A version of a table: ``folders`` maps data folders to their files that belong to it (None: all files)."""

    path: str
    number: int
    schema: StructType
    folders: dict[str, list[str] | None]
    operation: str
    counts: dict[str, int] = field(default_factory=dict)

    def places(self) -> list[str]:
        out = []
        for folder, files in self.folders.items():
            root = f"{self.path}/data/{folder}"
            out += [root] if files is None else [f"{root}/{f}" for f in files]
        return out


# --- files -----------------------------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _fs(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create_once(spark: SparkSession, path: str, text: str) -> None:
    """The whole file, or a ``Conflict`` if there is one of this name: written beside it, then put in its place in one step."""
    draft = f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}"
    _write_text(spark, draft, text)
    fs, source = _fs(spark, draft)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm = spark._jvm
    try:
        if fs.getScheme() == "file":
            place = lambda p: jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri())
            jvm.java.nio.file.Files.createLink(place(target), place(source))
        else:
            none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration()).rename(source, target, options)
    except Exception as e:
        if fs.exists(target):
            raise Conflict(path) from e
        raise
    finally:
        fs.delete(source, False)


# --- versions --------------------------------------------------------------------------------------------------------


def versions(spark: SparkSession, path: str) -> list[int]:
    names = _names(spark, f"{path}/versions")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def open_version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version of the table (the newest by default)."""
    path = path.rstrip("/")
    if number is None:
        known = versions(spark, path)
        if not known:
            raise FileNotFoundError(f"no table at {path}")
        number = known[-1]
    found = json.loads(_read_text(spark, f"{path}/versions/{number:020d}.json"))
    return Version(path, number, StructType.fromJson(found["schema"]), found["folders"], found["operation"], found["counts"])


def read_version(spark: SparkSession, version: Version, with_files: bool = False) -> DataFrame:
    """The rows of a version; later changes do not reach them."""
    places = version.places()
    if not places:
        empty = spark.createDataFrame([], version.schema)
        return empty.withColumn(_FILE, F.lit("")) if with_files else empty
    rows = spark.read.schema(version.schema).parquet(*places)
    name = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/[^/]+)$", 1)
    return rows.select("*", name.alias(_FILE)) if with_files else rows


def read_snapshot(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    return read_version(spark, open_version(spark, path, number))


def history(spark: SparkSession, path: str) -> DataFrame:
    """(version, operation, matched, changed, added, deleted), a row for each version."""
    rows = []
    for number in versions(spark, path):
        v = open_version(spark, path, number)
        rows.append((number, v.operation, *[v.counts.get(c, 0) for c in COUNTS]))
    return spark.createDataFrame(rows, "version long, operation string, " + ", ".join(f"{c} long" for c in COUNTS))


def publish(spark: SparkSession, version: Version) -> Version:
    """Make a version the newest, or raise ``Conflict`` if its number is taken."""
    fs, folder = _fs(spark, f"{version.path}/versions")
    fs.mkdirs(folder)
    content = {
        "schema": version.schema.jsonValue(),
        "folders": version.folders,
        "operation": version.operation,
        "counts": version.counts,
    }
    _create_once(spark, f"{version.path}/versions/{version.number:020d}.json", json.dumps(content))
    return version


def _write_data(rows: DataFrame, path: str, counted: dict[str, Column], drop: Sequence[str] = ()) -> tuple[str, dict[str, int]]:
    """A new data folder, and what was counted on the way."""
    folder = uuid.uuid4().hex
    seen = Observation()
    cells = [F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long").alias(k) for k, c in counted.items()]
    kept = rows.observe(seen, *cells)
    kept = kept.where(~counted["deleted"]) if "deleted" in counted else kept
    kept.drop(*drop).write.parquet(f"{path}/data/{folder}")
    return folder, {k: int(v) for k, v in seen.get.items()}


def create_snapshot(df: DataFrame, path: str) -> Version:
    """A new table with the rows of ``df`` as its first version."""
    spark, path = df.sparkSession, path.rstrip("/")
    folder, counts = _write_data(df, path, {"added": F.lit(True)})
    schema = spark.read.parquet(f"{path}/data/{folder}").schema
    return publish(spark, Version(path, 1, schema, {folder: None}, "create", counts))


# --- changes ---------------------------------------------------------------------------------------------------------


def _without(spark: SparkSession, base: Version, touched: set[str]) -> dict[str, list[str] | None]:
    """The base's files without the touched ones (``folder/file``)."""
    gone: dict[str, set[str]] = {}
    for name in touched:
        folder, file = name.split("/")
        gone.setdefault(folder, set()).add(file)
    out: dict[str, list[str] | None] = {}
    for folder, files in base.folders.items():
        if folder in gone:
            files = files if files is not None else [n for n in _names(spark, f"{base.path}/data/{folder}") if n.endswith(".parquet")]
            files = [f for f in files if f not in gone[folder]]
        if files is None or files:
            out[folder] = files
    return out


def _change(spark: SparkSession, path: str, operation: str, attempt: Callable[[Version], tuple[dict, dict]]) -> Version:
    """Make a change against the newest version, again and again while other writers are first."""
    for n in range(RETRIES + 1):
        base = open_version(spark, path)
        folders, counts = attempt(base)
        counts = {k: v for k, v in base.counts.items() if k == BATCH} | counts
        if folders == base.folders:
            return Version(base.path, base.number, base.schema, base.folders, operation, {c: 0 for c in COUNTS} | counts)
        try:
            return publish(spark, Version(base.path, base.number + 1, base.schema, folders, operation, counts))
        except Conflict:
            # What this attempt wrote belongs to no version.
            for folder in folders.keys() - base.folders.keys():
                fs, place = _fs(spark, f"{base.path}/data/{folder}")
                fs.delete(place, True)
            if n == RETRIES:
                raise
            time.sleep(0.05 * 2**n)
    raise AssertionError


def _touched(rows: DataFrame) -> set[str]:
    """The files of these rows: a name for each file, as Spark's own file listing has."""
    return {r[_FILE] for r in rows.select(_FILE).distinct().collect()}


def _only(spark: SparkSession, base: Version, touched: set[str]) -> DataFrame:
    """The rows of the touched files."""
    folders: dict[str, list[str] | None] = {}
    for name in sorted(touched):
        folder, file = name.split("/")
        folders.setdefault(folder, []).append(file)  # type: ignore[union-attr]
    return read_version(spark, Version(base.path, base.number, base.schema, folders, base.operation))


def append_snapshot(df: DataFrame, path: str) -> Version:
    """Add rows; files of the versions before are taken over."""
    spark = df.sparkSession
    path = path.rstrip("/")
    written: list = []

    def attempt(base: Version) -> tuple[dict, dict]:
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in base.schema.fields])
        if not written or written[0][0] not in _names(spark, f"{path}/data"):
            written[:] = [_write_data(rows, path, {"added": F.lit(True)})]
        folder, counts = written[0]
        return {**base.folders, folder: None}, counts

    return _change(spark, path, "append", attempt)


def append_batch(df: DataFrame, path: str, number: int) -> Version:
    """Add the rows of a stream's micro-batch, once: a batch that the table already holds (it runs again after a failure) adds nothing.

    One stream per table, whose batches come in order of their numbers. A missing table is made.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    if not versions(spark, path):
        try:
            create_snapshot(df.limit(0), path)
        except Conflict:
            pass  # another writer has made it

    def attempt(base: Version) -> tuple[dict, dict]:
        if base.counts.get(BATCH, -1) >= number:
            return base.folders, {}
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in base.schema.fields])
        folder, counts = _write_data(rows, path, {"added": F.lit(True)})
        return {**base.folders, folder: None}, {**counts, BATCH: number}

    return _change(spark, path, "append", attempt)


def rewrite_snapshot(spark: SparkSession, path: str, job: Callable[[DataFrame], DataFrame]) -> Version:
    """Replace all rows by what ``job`` makes of them, in the same columns; rows that another writer adds meanwhile are not lost (it starts again)."""
    path = path.rstrip("/")

    def attempt(base: Version) -> tuple[dict, dict]:
        rows = job(read_version(spark, base)).select(*[f"`{f.name}`" for f in base.schema.fields])
        folder, _ = _write_data(rows, path, {"added": F.lit(True)})
        return {folder: None}, {}

    return _change(spark, path, "rewrite", attempt)


def update_snapshot(
    spark: SparkSession, path: str, where: Condition, values: dict[str, object], upsert: bool = False
) -> Version:
    """Set columns in the rows that match; with ``upsert`` and no match, add a row with the condition's values.

    The version's counts say how many rows matched and how many of them really changed. Without any match nothing is published.
    """
    path = path.rstrip("/")

    def attempt(base: Version) -> tuple[dict, dict]:
        types = {f.name: f.dataType for f in base.schema.fields}
        new = {c: (v if isinstance(v, Column) else F.lit(v)).cast(types[c]) for c, v in values.items() if c in types}
        touched = _touched(read_version(spark, base, with_files=True).where(matches(where)))
        if not touched:
            if not upsert:
                return base.folders, {}
            known = {**(where if isinstance(where, dict) else {}), **values}
            cells = [known[c] if isinstance(known.get(c), Column) else F.lit(known.get(c)) for c in types]
            row = spark.range(1).select(*[cell.cast(t).alias(c) for cell, (c, t) in zip(cells, types.items())])
            folder, counts = _write_data(row, path, {"added": F.lit(True)})
            return {**base.folders, folder: None}, counts
        differs = reduce(lambda a, b: a | b, [~F.col(f"`{c}`").eqNullSafe(v) for c, v in new.items()], F.lit(False))
        rows = _only(spark, base, touched).withColumns({"__hit": matches(where), "__differs": differs})
        hit = F.col("__hit")
        rows = rows.withColumns({c: F.when(hit, v).otherwise(F.col(f"`{c}`")) for c, v in new.items()})
        counted = {"matched": hit, "changed": hit & F.col("__differs")}
        folder, counts = _write_data(rows, path, counted, ["__hit", "__differs"])
        return {**_without(spark, base, touched), folder: None}, counts

    return _change(spark, path, "update", attempt)


def delete_snapshot(spark: SparkSession, path: str, where: Condition) -> Version:
    """Remove the rows that match; the version's counts say how many."""
    path = path.rstrip("/")

    def attempt(base: Version) -> tuple[dict, dict]:
        touched = _touched(read_version(spark, base, with_files=True).where(matches(where)))
        if not touched:
            return base.folders, {}
        rows = _only(spark, base, touched).withColumn("__hit", matches(where))
        folder, counts = _write_data(rows, path, {"matched": F.col("__hit"), "deleted": F.col("__hit")}, ["__hit"])
        return {**_without(spark, base, touched), folder: None}, counts

    return _change(spark, path, "delete", attempt)


def upsert_snapshot(changes: DataFrame, path: str, keys: Sequence[str]) -> Version:
    """Replace rows by key and add new ones; ``changes`` holds one row per key and may lack columns, which are then kept.

    Files without any of the keys are not read beyond their key columns. Two shuffles on the key: one finds the files, one joins
    their rows with the changes. Missing keys match nothing and are added.
    """
    spark, path, keys = changes.sparkSession, path.rstrip("/"), list(keys)
    given = [c for c in changes.columns if c not in keys]

    def attempt(base: Version) -> tuple[dict, dict]:
        wanted = changes.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
        same = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"__k{i}") for i, k in enumerate(keys)])
        held = read_version(spark, base, with_files=True).select(*[F.col(f"`{k}`") for k in keys], _FILE)
        touched = _touched(held.join(wanted, same, "left_semi"))
        right = changes.select(
            *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)],
            *[F.col(f"`{c}`").alias(f"__n{i}") for i, c in enumerate(given)],
            F.lit(True).alias("__new"),
        )
        left = _only(spark, base, touched).withColumn("__old", F.lit(True))
        joined = left.join(right, same, "full")
        new, old = F.col("__new").isNotNull(), F.col("__old").isNotNull()
        cells = []
        for f in base.schema.fields:
            own = F.col(f"`{f.name}`")
            if f.name in keys:
                cell = F.coalesce(own, F.col(f"__k{keys.index(f.name)}").cast(f.dataType))
            elif f.name in given:
                cell = F.when(new, F.col(f"__n{given.index(f.name)}").cast(f.dataType)).otherwise(own)
            else:
                cell = own
            cells.append(cell.alias(f.name))
        differs = reduce(
            lambda a, b: a | b,
            [~F.col(f"`{c}`").eqNullSafe(F.col(f"__n{i}")) for i, c in enumerate(given) if c in base.schema.names],
            F.lit(False),
        )
        flags = [(new & old).alias("__hit"), (new & old & differs).alias("__differs"), (new & ~old).alias("__added")]
        counted = {"matched": F.col("__hit"), "changed": F.col("__differs"), "added": F.col("__added")}
        folder, counts = _write_data(joined.select(*cells, *flags), path, counted, ["__hit", "__differs", "__added"])
        if not counts["matched"] and not counts["added"]:
            return base.folders, counts
        return {**_without(spark, base, touched), folder: None}, counts

    return _change(spark, path, "upsert", attempt)


def vacuum(spark: SparkSession, path: str, keep: int, older_than_s: float = 7 * 86400) -> int:
    """Delete versions but the newest ``keep``, and data files that no version left names; returns the files deleted.

    Data younger than ``older_than_s`` stays: it may belong to a writer that has not published yet.
    """
    path = path.rstrip("/")
    known = versions(spark, path)
    for number in known[:-keep] if keep else known:
        fs, place = _fs(spark, f"{path}/versions/{number:020d}.json")
        fs.delete(place, False)
    named: dict[str, set[str] | None] = {}
    for number in versions(spark, path):
        for folder, files in open_version(spark, path, number).folders.items():
            held = named.get(folder, set())
            named[folder] = None if files is None or held is None else held | set(files)
    fs, root = _fs(spark, f"{path}/data")
    limit, gone = (time.time() - older_than_s) * 1000, 0
    for status in fs.listStatus(root) if fs.exists(root) else []:
        folder = status.getPath()
        held = named.get(folder.getName(), set())
        if held is None or status.getModificationTime() > limit:
            continue
        files = [f for f in fs.listStatus(folder) if f.getPath().getName().endswith(".parquet")]
        old = [f for f in files if f.getPath().getName() not in held]
        gone += len(old)
        if not held:
            fs.delete(folder, True)
        else:
            for f in old:
                fs.delete(f.getPath(), False)
    return gone
