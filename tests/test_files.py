import json
import os
import time

import pytest
from pyspark.sql import functions as F

from fieldtally import schemas
from fieldtally.sources import readers, writers
from fieldtally.streaming import incremental, keyed


def test_pages(spark, tmp_path):
    doc = {"username": "u", "regionSummary": [{"regionCode": "R", "total": 1, "statusBreakdown": []}]}
    for i, content in enumerate([[doc, doc], [], None]):
        (tmp_path / f"{i}.json").write_text(json.dumps({"success": content is not None, "data": {"totalElements": 3, "content": content}}))
    out = readers.progress_pages(spark, str(tmp_path), "04", "X")
    assert out.count() == 2 and out.first()._kabKotaCode == "04"
    assert [(r.expected, r.received) for r in readers.page_completeness(spark, str(tmp_path)).collect()] == [(3, 2)]


def test_snapshots_and_retention(spark, tmp_path):
    df = spark.createDataFrame([("u",)], "username string")
    writers.write_snapshot(df, str(tmp_path), "1")
    writers.write_snapshot(df.limit(0), str(tmp_path), "2")
    assert sorted(os.listdir(tmp_path)) == ["version=1"]
    for i in range(4):
        (tmp_path / f"f{i}.bin").write_bytes(b"x")
        os.utime(tmp_path / f"f{i}.bin", (i, i))
    files = readers.listing(spark, str(tmp_path), "*.bin")
    assert sorted(r.path[-6:] for r in writers.expired(files, 3).collect()) == ["f0.bin"]


def test_only_own_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    write = lambda rows: writers.replace_partitions(spark.createDataFrame(rows, "n int, kab string"), path, ["kab"])
    write([(1, "a"), (2, "b")])
    write([(3, "a")])
    assert sorted((r.n, r.kab) for r in spark.read.parquet(path).collect()) == [(2, "b"), (3, "a")]


def test_grid_and_bad_rows(spark, tmp_path):
    writers.write_grid(spark.range(25).select(F.col("id").cast("string")), str(tmp_path / "g"), 10)
    assert readers.grid(spark, str(tmp_path / "g")).count() == 25
    (tmp_path / "b.csv").write_text("name,address\nA,x\nB,y,z\n")
    good, bad = readers.branch_list(spark, str(tmp_path / "b.csv"), ["name", "address"])
    assert (good.count(), bad.count()) == (1, 1)


def test_sql_is_limited_and_raises(spark):
    assert readers.run_sql(spark, "SELECT * FROM range(5000)").count() == 1000
    with pytest.raises(Exception):
        readers.run_sql(spark, "SELECT nonsense")
    assert json.loads(writers.json_rows(spark.range(1))[0]) == {"id": 0}


def test_workbook_round_trip(spark, tmp_path):
    header = "No string, `Kab/Kota` string, `Kode Wilayah (SLS)` string, Username string, Email string, Role string, `Total Target` string, OPEN string, `ZZ NEW` string"
    rows = [("1", "X", "'6104012003000102", " u1 ", "e", None, "5", "12abc", "3.7"), ("2", "X", "", "u2", None, "P", None, "", None), ("3", "X", "610", "u3", "e", "P", "1", "1", "2"), ("4", "X", "6104", " ", "e", "P", "1", "1", "2")]
    other = spark.createDataFrame([("no",)], "OPEN string")
    book = writers.workbook({"Other": other, "Detail Wilayah per Pencacah": spark.createDataFrame(rows, header)})
    older = writers.workbook({"Sheet": spark.createDataFrame([("1", "Y", "6104012003000102", "u1", "old", "P", "9", "99", "9")], header)})
    for name, data, at in (("new.xlsx", book, 2000), ("old.xlsx", older, 1000)):
        (tmp_path / name).write_bytes(data)
        os.utime(tmp_path / name, (at, at))
    flat = readers.workbooks(spark, str(tmp_path))
    assert {r.status for r in flat.collect()} == {"OPEN", "ZZ NEW"}
    docs = {r.username: r for r in readers.workbook_documents(flat).collect()}
    assert set(docs) == {"u1", "u2", "u3"}
    u1 = docs["u1"]
    assert (u1.email, u1.roleName, u1._kabKotaCode, u1.total) == ("e", "Pencacah", "04", None)
    assert [(r.regionCode, r.total, [(s.status, s["count"]) for s in r.statusBreakdown]) for r in u1.regionSummary] == [("6104012003000102", 5, [("ZZ NEW", 3), ("OPEN", 12)])]
    assert docs["u2"].regionSummary is None and docs["u3"]._kabKotaCode == "00"
    with pytest.raises(ValueError):
        writers.workbook({"s": spark.range(20)}, most=10)
    (tmp_path / "wrong").mkdir()
    (tmp_path / "wrong/x.xlsx").write_bytes(writers.workbook({"s": spark.createDataFrame([("u", "1"), ("v", "late")], "Username string, NOTE string")}))
    with pytest.raises(Exception, match="not counts"):
        readers.workbooks(spark, str(tmp_path / "wrong")).count()


def test_the_first_name_of_a_field_decides():
    fields, statuses = readers.header_places(["Total Assignment", "OPEN", "Username Petugas", "username", "Total Target", "", "Kode Wilayah"])
    assert fields == {"region": 6, "username": 3, "total": 4} and statuses == {"OPEN": 1}


def test_regions_at_the_row_limit(spark):
    rows = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2, "code string")
    assert [tuple(r) for r in readers.capped_regions(rows, "code", 3).collect()] == [("a", 3)]


def test_a_second_run_finds_nothing(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, seq int")
    df.write.parquet(str(tmp_path / "in"))
    sink = keyed.merge_into(str(tmp_path / "out"), ["id"], ["seq"])
    run = lambda: incremental.run_available(incremental.parquet_stream(spark, str(tmp_path / "in"), df.schema), sink, str(tmp_path / "state"))
    assert (run(), run()) == (2, 0)
    spark.createDataFrame([("a", 0), ("c", 1)], "id string, seq int").write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == 2
    assert sorted(tuple(r) for r in keyed.KeyedTable(spark, str(tmp_path / "out"), ["id"], ["seq"]).read().collect()) == [("a", 0), ("b", 2), ("c", 1)]


def test_high_water_mark(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    files = readers.listing(spark, str(tmp_path))
    none = spark.createDataFrame([], "last_processed timestamp")
    assert incremental.is_new(files, none).count() == 1
    assert incremental.is_new(files, files.select(F.col("modified").alias("last_processed"))).count() == 0
    time.sleep(0)


def test_log(spark, tmp_path):
    writers.log_line(spark, str(tmp_path / "log"), "INFO", "x")
    assert spark.read.json(str(tmp_path / "log")).first().text == "x"


def test_schemas_are_read(spark, tmp_path):
    (tmp_path / "s.json").write_text("[]")
    assert readers.snapshot(spark, str(tmp_path / "s.json")).count() == 0
    assert readers.respondents(spark, str(tmp_path / "s.json")).columns[0] == "id"
    assert readers.region_level(spark, str(tmp_path / "s.json")).columns == ["id", "code", "fullCode", "name", "parentFullCode"]
    assert schemas.REGION_DIM.count(",") == 9
