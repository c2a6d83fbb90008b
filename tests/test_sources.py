import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketloom.plans.runner import Warehouse, run
from marketloom.schema import RAW_SALES
from marketloom.sources import excel, files, tables


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, 'a "q", b', 1.5), (2, None, None), (3, " c ", 2.0)], "id int, name string, x double")


def test_formats_and_sources():
    assert files.file_format("x/Y.CSV") == "csv" and files.file_format("b.xlsx") == "excel"
    assert files.file_format("any", "XLSX") == "excel"
    for bad in ("a.txt", "noext", "b.xls"):
        with pytest.raises(ValueError):
            files.file_format(bad)
    with pytest.raises(ValueError):
        files.file_format("a.csv", "orc")
    assert files.source_uri("S3", "k/a.csv", "b") == "s3a://b/k/a.csv"
    assert files.source_uri("s3", "s3://b/k") == "s3a://b/k"
    assert files.source_uri("local", "/a") == "/a"
    for bad in (("ftp", "a", None), ("s3", "a", None)):
        with pytest.raises(ValueError):
            files.source_uri(*bad)


def test_csv_round_trip(spark, people, tmp_path):
    path = files.save(people, str(tmp_path / "p"))
    assert path.endswith("p.csv")
    back = files.scan(spark, path, schema=people.schema).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, 'a "q", b', 1.5), (2, None, None), (3, " c ", 2.0)]
    assert files.scan(spark, path).schema["id"].dataType.typeName() == "integer"
    with pytest.raises(ValueError):
        files.save(people, "x", "excel")


def test_schema_goes_by_name_not_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text("price,extra,invoice_no\n1.5,z,I1\nbad,y,I2\n")
    df = files.scan(spark, str(tmp_path / "a.csv"), schema=RAW_SALES)
    assert [tuple(r) for r in df.collect()] == [(1.5, "z", "I1"), (None, "y", "I2")]
    stats = files.load_sales(spark, str(tmp_path / "a.csv"), str(tmp_path / "raw")).first()
    assert stats.rows == 2 and "customer_id" in stats.missing_columns and stats.customers is None


def test_folder(spark, people, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text(f"id,name\n{i},n{i}\n")
    (tmp_path / "other.txt").write_text("id,name\n9,x\n")
    assert files.list_files(spark, str(tmp_path)).count() == 3
    report = files.load_folder(spark, str(tmp_path), str(tmp_path / "t")).first()
    assert tuple(report) == (3, 3, 3, 0, 0, "")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_corrupt_file_does_not_stop_the_others(spark, people, tmp_path):
    people.coalesce(1).write.parquet(str(tmp_path / "p"))
    (tmp_path / "p" / "bad.parquet").write_bytes(b"not parquet")
    report = files.load_folder(spark, str(tmp_path / "p"), str(tmp_path / "t"), "parquet", schema=people.schema).first()
    assert tuple(report) == (2, 1, 3, 0, 0, "bad.parquet")


def test_every_csv_file_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("invoice_no,age,price\nI1,28.0,1.5\nI2,,2.5\n")
    (tmp_path / "b.csv").write_text("price,invoice_no,extra,age\n3.5,I3,x,40\n4.5,I4,y,old\n1,2\n")
    (tmp_path / "c.csv").write_text("invoice_no,age,price\n")
    report = files.load_folder(spark, str(tmp_path), str(tmp_path / "t"), schema=RAW_SALES).first()
    assert tuple(report) == (3, 3, 5, 1, 1, "")
    rows = spark.read.parquet(str(tmp_path / "t")).orderBy("price").select("invoice_no", "age", "price", "extra").collect()
    assert [tuple(r) for r in rows][1:] == [("I1", 28, 1.5, None), ("I2", None, 2.5, None), ("I3", 40, 3.5, "x"), ("I4", None, 4.5, "y")]
    assert spark.read.parquet(str(tmp_path / "t")).schema["age"].dataType.typeName() == "long"


def test_half_a_file_is_left_out_whole(spark, tmp_path):
    import gzip

    text = "id,name\n" + "".join(f"{i},name {i * 7919 % 1000003}\n" for i in range(20_000))
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(text.encode())[:60_000])
    report = files.load_folder(spark, str(tmp_path), str(tmp_path / "t"), pattern="*.csv.gz").first()
    assert tuple(report) == (2, 1, 20_000, 0, 0, "b.csv.gz")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"two\nlines"\n2,one\n')
    rows = files.scan(spark, str(tmp_path / "a.csv"), multiLine=True).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines"), (2, "one")]


def test_columns_of_later_files(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, x string").coalesce(1).write.parquet(str(tmp_path / "p" / "one.parquet"))
    spark.createDataFrame([(2, 0.5)], "id int, y double").coalesce(1).write.parquet(str(tmp_path / "p" / "two.parquet"))
    rows = files.scan(spark, str(tmp_path / "p"), "parquet", recursiveFileLookup=True).orderBy("id").collect()
    assert [tuple(r[c] for c in ("id", "x", "y")) for r in rows] == [(1, "a", None), (2, None, 0.5)]
    for i, names in enumerate((["a", "b"], ["b", "c"])):
        spark.createDataFrame([(f"{i}0", f"{i}1")], names).createOrReplaceTempView("v")
        excel.write_excel(spark.table("v").coalesce(1), str(tmp_path / f"x{i}"))
    books = tmp_path / "books"
    books.mkdir()
    for i in range(2):
        (books / f"{i}.xlsx").write_bytes(next((tmp_path / f"x{i}").glob("*.xlsx")).read_bytes())
    found = excel.scan_excel(spark, str(books)).drop("source_file").orderBy("b").collect()
    assert [r.asDict() for r in found] == [{"a": "00", "b": "01", "c": None}, {"a": None, "b": "10", "c": "11"}]


def test_append_counts_and_keeps(spark, people, tmp_path):
    path = str(tmp_path / "t")
    assert files.append_table(people, path) == 3
    assert files.append_table(people.limit(1), path) == 1
    assert spark.read.parquet(path).count() == 4


def test_excel(spark, tmp_path):
    rows = [
        (1, "a & <b>", 1.5, True, dt.datetime(2024, 1, 2, 3, 4, 5), 2**53 + 1),
        (2, None, None, False, None, -5),
        (3, "  sp", 1e300, None, dt.datetime(1999, 12, 31), 0),
    ]
    df = spark.createDataFrame(rows, "id int, t string, x double, b boolean, d timestamp_ntz, big long")
    folder = str(tmp_path / "books")
    written = excel.write_excel(df.repartition(2, "id"), folder, rows_per_file=1).collect()
    assert sum(r.rows for r in written) == 3 and len(os.listdir(folder)) == 3
    back = excel.scan_excel(spark, folder, df.schema).drop("source_file").orderBy("id")
    assert [tuple(r) for r in back.collect()] == rows
    assert excel.scan_excel(spark, folder).columns == ["id", "t", "x", "b", "d", "big", "source_file"]
    with pytest.raises(ValueError):
        excel.write_excel(df, folder, 2_000_000)


def test_excel_shared_strings_and_dates():
    import io
    import zipfile

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", excel._PARTS["xl/workbook.xml"])
        z.writestr("xl/_rels/workbook.xml.rels", excel._PARTS["xl/_rels/workbook.xml.rels"])
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>name</t></si><si><r><t>A</t></r><r><t>da</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><numFmts><numFmt numFmtId="170" formatCode="yyyy&quot;x&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>')
        z.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="str"><v>day</v></c></row>'
            '<row><c r="A2" t="s"><v>1</v></c><c r="C2" s="1"><v>45293.5</v></c><c r="D2" s="2"><v>1</v></c></row></sheetData></worksheet>',
        )
    assert list(excel.sheet_rows(out.getvalue())) == [
        ["name", None, "day"],
        ["Ada", None, "2024-01-02 12:00:00", "1899-12-31 00:00:00"],
    ]


def test_changes(spark, people):
    up = tables.update_rows(people, {"id": 1}, {"name": "z"})
    assert {r.name for r in up.collect()} == {"z", None, " c "}
    assert tables.update_rows(people, {"id": 9}, {"name": "n"}, upsert=True).where("id = 9 and name = 'n' and x is null").count() == 1
    assert tables.update_rows(people, {"id": 1}, {"name": "n"}, upsert=True).count() == 3
    assert tables.count_changes(people, {"name": None}, {"x": 1.0}) == 1
    changes = spark.createDataFrame([(1, None), (7, "new")], "id int, name string")
    out = {r.id: (r.name, r.x) for r in tables.upsert_rows(people, changes, ["id"]).collect()}
    assert out == {1: (None, 1.5), 2: (None, None), 3: (" c ", 2.0), 7: ("new", None)}
    assert tables.delete_rows(people, F.col("x") > 1.7).count() == 2
    assert tables.delete_rows(people, {"name": None}).count() == 2


def test_read_pushes_filter_and_columns(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "p"))
    df = tables.read_table(spark, str(tmp_path / "p"), {"id": 2}, ["name"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,2)" in plan and "x#" not in plan
    assert tables.read_table(spark, str(tmp_path / "p"), limit=2, order=["id"]).count() == 2
    assert tables.read_table(spark, str(tmp_path / "p"), {"name": None}).count() == 1


def test_partition_pruning(spark, people, tmp_path):
    tables.write_partitioned(people, str(tmp_path / "p"), ["id"])
    df = tables.read_table(spark, str(tmp_path / "p"), {"id": 2})
    assert "PartitionFilters: [isnotnull(id" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 1
    tables.write_sorted(people, str(tmp_path / "s"), ["x"])
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3


def test_bucketed_group_needs_no_shuffle(spark, people, tmp_path):
    tables.write_bucketed(people, "bucketed_people", str(tmp_path / "b"), 4, ["id"], ["x"])
    plan = spark.table("bucketed_people").groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert tables.drop_table(spark, "bucketed_people") and not tables.drop_table(spark, "bucketed_people")


def test_retention(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1),), (dt.datetime(2022, 3, 1),), (dt.datetime(2024, 2, 29),)], "d timestamp_ntz")
    assert tables.retention_prune(df, "d", 24).count() == 2
    assert tables.retention_prune(df, "d", 24, dt.date(2025, 1, 1)).count() == 1
    assert tables.retention_prune(df.limit(0), "d", 24).count() == 0


def test_batch_run_can_be_repeated(spark, tmp_path):
    lines = [",".join(RAW_SALES.names)]
    for i in range(40):
        lines.append(f"I{i},C{i % 7},Male,{20 + i % 9},Toys,{1 + i % 3},{10.5 + i},Cash,{1 + i % 28}/{1 + i % 12}/2022,Kanyon")
    (tmp_path / "sales.csv").write_text("\n".join(lines + lines[1:3]))
    house = Warehouse(str(tmp_path / "house"))
    for skip in ((), ("ingest",)):
        out = run(spark, house, ["invoice_date", "invoice_no"], "local", str(tmp_path / "sales.csv"), skip=skip)
        assert out["raw_sales"].count() == 42 and out["transformed_sales"].count() == 40
    assert set(run(spark, house, [], skip=("ingest", "clean", "transform", "views"))) == {"raw_sales"}
    assert spark.read.json(house.path("cleaning_report")).where("metric = 'rows_removed'").first().value == 2.0
