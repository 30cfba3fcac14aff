import json
import os

from fieldtally import __main__ as command
from fieldtally import schemas
from fieldtally.plans import jobs
from fieldtally.sources import readers, writers


def doc(user, region, count):
    return {"username": user, "email": user, "roleName": "Pencacah", "total": count, "regionSummary": [{"regionCode": region, "total": count, "statusBreakdown": [{"status": "OPEN", "count": count}]}]}


def test_a_snapshot_keeps_officers_that_are_missing(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"success": True, "data": {"totalElements": 1, "content": [doc("u1", "R1", 2)]}}))
    old = spark.createDataFrame([("u1", None, None, 9, "04", "X", None), ("u2", None, None, 9, "05", "Y", [("R9", 9, [("DRAFT", 9)])])], schemas.PROGRESS_DOC)
    old.write.parquet(str(tmp_path / "old"))
    command.main(["snapshot", str(tmp_path / "p.json"), str(tmp_path / "out"), "--previous", str(tmp_path / "old"), "--kab", "4", "--name", "X"])
    final = spark.read.parquet(str(tmp_path / "out/snapshot"))
    assert {(r.username, r.total) for r in final.collect()} == {("u1", 2), ("u2", 9)}
    wide = spark.read.option("header", True).csv(str(tmp_path / "out/reports/progress_per_sls"))
    assert {(r.no, r.region_code, r.OPEN) for r in wide.collect()} == {("1", "R1", "2"), ("2", "R9", "0")}
    empty = jobs.sync_snapshot(final.drop("version").limit(0), final, str(tmp_path / "none"), "1")
    assert empty.count() == 2 and not (tmp_path / "none").exists()


def test_only_new_workbooks_are_taken(spark, tmp_path):
    grid = spark.createDataFrame([("X", "6104012003000102", "u1", "3")], "`Kab/Kota` string, `Kode Wilayah` string, Username string, OPEN string")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.xlsx").write_bytes(writers.workbook({"Progress per SLS": grid}))
    none = spark.createDataFrame([], "last_processed timestamp")
    out = jobs.sync_workbooks(spark, str(tmp_path / "in"), none, None, str(tmp_path / "out"), "1")
    assert [(r.username, r._kabKotaCode) for r in out.collect()] == [("u1", "04")]
    done = spark.sql("select timestamp'2999-01-01 00:00:00' as last_processed")
    assert jobs.sync_workbooks(spark, str(tmp_path / "in"), done, None, str(tmp_path / "out"), "2") is None


def test_counts_replace_their_kabs_only(spark, tmp_path):
    schema = "assignment_id string, level_2_full_code string, level_2_name string, level_6_full_code string, current_user_username string, current_user_survey_role_name string, assignment_status_alias string"
    rows = [("1", "6104", "X", "6104000000000001", "u", "p", "OPEN"), ("2", "6105", "Y", "6105000000000001", "u", "p", "OPEN")]
    jobs.sync_assignments(spark.createDataFrame(rows, schema), ["04", "05"], str(tmp_path / "g"))
    jobs.sync_assignments(spark.createDataFrame([(*rows[0][:6], "DRAFT")], schema), ["04"], str(tmp_path / "g"))
    assert {(r.kab, r.OPEN, r.DRAFT) for r in spark.read.schema("kab string, OPEN long, DRAFT long").parquet(str(tmp_path / "g")).collect()} == {("04", 0, 1), ("05", 1, 0)}


def test_respondents_regions_and_sql(spark, tmp_path, capsys):
    (tmp_path / "r.json").write_text(json.dumps([{"id": "1", "codeIdentity": "b"}, {"id": "1", "codeIdentity": "a"}, {"id": "2"}]))
    command.main(["respondents", str(tmp_path / "r.json"), str(tmp_path / "flat")])
    flat = spark.read.option("header", True).csv(str(tmp_path / "flat"))
    assert {(r.id, r.code_identity) for r in flat.collect()} == {("1", "b"), ("2", "-")}  # the first that arrived
    parent = None
    for i in range(3, 7):
        (tmp_path / f"level{i}").mkdir()
        (tmp_path / f"level{i}/x.json").write_text(json.dumps([{"id": f"i{i}", "fullCode": f"c{i}", "name": f"n{i}", "parentFullCode": parent}]))
        parent = f"c{i}"
    command.main(["regions", str(tmp_path), str(tmp_path / "dim")])
    assert [(r.id, r.kecName, r.slsFullCode) for r in spark.read.parquet(str(tmp_path / "dim")).collect()] == [("i6", "n3", "c5")]
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    command.main(["query", "select id from t order by id", "--tables", str(tmp_path), "--names", "t", "--limit", "2"])
    shown = capsys.readouterr().out
    assert json.loads(shown[shown.index("[{") :]) == [{"id": 0}, {"id": 1}]


def test_the_high_water_mark_is_kept(spark, tmp_path):
    grid = spark.createDataFrame([("X", "6104012003000102", "u1", "3")], "`Kab/Kota` string, `Kode Wilayah` string, Username string, OPEN string")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.xlsx").write_bytes(writers.workbook({"Progress per SLS": grid}))
    (tmp_path / "in/older.xlsx").write_bytes(b"not a workbook, and never opened")
    os.utime(tmp_path / "in/older.xlsx", (1000, 1000))
    run = lambda version, **more: jobs.sync_new_workbooks(spark, str(tmp_path / "in"), None, str(tmp_path / "out"), version, **more)
    assert run("1").count() == 1
    assert run("2") is None and run("3", force=True).count() == 1
    assert sorted(p.name for p in (tmp_path / "out/snapshot").iterdir() if p.is_dir()) == ["version=1", "version=3"]
    command.main(["workbooks", str(tmp_path / "in"), str(tmp_path / "out")])
    assert readers.state(spark, str(tmp_path / "out/state")).count() == 2


def test_sqllab_and_resume_commands(spark, tmp_path):
    schema = "assignment_id string, level_2_full_code string, level_2_name string, level_6_full_code string, current_user_username string, current_user_survey_role_name string, assignment_status_alias string"
    spark.createDataFrame([("1", "6104", "X", "6104000000000001", "u", "p", "OPEN"), ("2", "6105", "Y", "6105000000000001", "u", "p", "OPEN")], schema).write.parquet(str(tmp_path / "a"))
    command.main(["sync-sqllab", str(tmp_path / "a"), str(tmp_path / "g"), "--kab", "5"])
    assert [r.region_code for r in spark.read.parquet(str(tmp_path / "g")).collect()] == ["6105000000000001"]
    regions = spark.createDataFrame([("2",), ("1",), ("3",)], "fullCode string")
    for key in ("completedRegionFullCodes", "completedSlsCodes"):
        (tmp_path / f"{key}.json").write_text(json.dumps({key: ["3"]}))
        assert [r.fullCode for r in jobs.remaining_regions(spark, regions, str(tmp_path / f"{key}.json")).collect()] == ["1", "2"]
    assert jobs.remaining_regions(spark, regions, None).count() == 3
