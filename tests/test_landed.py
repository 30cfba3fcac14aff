"""Landed pages and respondents of several kabs and regions, some of them broken."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fieldtally import __main__ as command
from fieldtally.plans import jobs
from fieldtally.sources import readers, writers


def page(total, users, **more):
    content = [{"username": u, "email": u, "roleName": "P", "total": 1, "regionSummary": [{"regionCode": f"61{u}", "total": 1, "statusBreakdown": [{"status": "OPEN", "count": 1}]}]} for u in users]
    return json.dumps({"success": True, "data": {"totalElements": total, "content": content}} | more)


@pytest.fixture
def landed(tmp_path):
    files = {
        "kab=04/1.json": page(3, ["u1", "u2"]), "kab=04/2.json": page(3, ["u3"])[:-40], "kab=05/1.json": page(2, ["v1", "v2"]),
        "kab=06/1.json": json.dumps({"success": False, "message": "try again"}), "kab=07/1.json": page(1, ["w1"]),
    }
    for name, text in files.items():
        (tmp_path / "pages" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "pages" / name).write_text(text)
    return str(tmp_path / "pages")


def test_broken_pages_are_kept_apart(spark, landed):
    pages = readers.pages(spark, landed)
    wrong = {os.path.relpath(r.source_file.split("pages/")[1]): (r.kab, r.reason) for r in readers.quarantine(pages).collect()}
    assert set(wrong) == {"kab=04/2.json", "kab=06/1.json"} and wrong["kab=06/1.json"] == ("06", "refused: try again") and wrong["kab=04/2.json"][1].startswith("not JSON")
    whole = {r.kab: (r.expected, r.received, r.missing, r.unusable) for r in readers.completeness_of(pages).collect()}
    assert whole == {"04": (3, 2, 1, 1), "05": (2, 2, 0, 0), "06": (None, 0, None, 1), "07": (1, 1, 0, 0)}
    assert sorted(r.username for r in readers.progress_pages(spark, landed).collect()) == ["u1", "u2", "v1", "v2", "w1"]


def test_other_kabs_are_not_read(spark, landed):
    plan = readers.pages(spark, landed, ["04", "05"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "kab" in plan.split("PartitionFilters:")[1].split("\n")[0].split("]")[0]
    assert readers.pages(spark, landed, ["04", "05"]).count() == 3


def test_a_run_of_several_kabs(spark, landed, tmp_path, capsys):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    command.main(["snapshot", landed, out, "--kab", "04,5,99", "--name", "04=MEMPAWAH,05=SAMBAS", "--log", log])
    got = {(r.username, r._kabKotaCode, r._kabKotaName) for r in spark.read.parquet(f"{out}/snapshot").collect()}
    assert got == {("u1", "04", "MEMPAWAH"), ("u2", "04", "MEMPAWAH"), ("v1", "05", "SAMBAS"), ("v2", "05", "SAMBAS")}
    said = capsys.readouterr().err
    assert "no folder for kab 99" in said and "kab=04/2.json: not JSON" in said and "2 of 3 rows" in said and "4 of 5 rows, 1 unusable files" in said
    assert spark.read.json(log).where(F.col("text").contains("99")).count() == 1
    assert {r.status for r in readers.workbooks(spark, f"{out}/reports").collect()} >= {"OPEN"}
    with pytest.raises(ValueError, match="folders"):
        jobs.landed_pages(spark, f"{landed}/kab=07", ["07", "08"])
    one = jobs.landed_pages(spark, f"{landed}/kab=07", ["07"], {"07": "X"}).documents.collect()
    assert [(r.username, r._kabKotaCode, r._kabKotaName) for r in one] == [("w1", "07", "X")]


def test_old_snapshots_go(spark, landed, tmp_path):
    docs = jobs.landed_pages(spark, landed).documents
    for n in range(4):
        jobs.sync_snapshot(docs, None, str(tmp_path / "out"), f"2026-01-0{n + 1}", keep=2)
    assert sorted(n for n in os.listdir(tmp_path / "out/snapshot") if "=" in n) == ["version=2026-01-03", "version=2026-01-04"]


def test_a_command_runs_again(spark, landed, tmp_path):
    import time

    began = time.time()
    command.main(["snapshot", landed, str(tmp_path / "out"), "--every", "1.5", "--times", "2", "--log", str(tmp_path / "log")])
    assert time.time() - began > 1.5 and spark.read.json(str(tmp_path / "log")).where("text = 'snapshot is done'").count() == 2


def region(base, code, people, age):
    folder = base / f"region_code={code}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "1.json").write_text(json.dumps([{"id": i, "codeIdentity": c} for i, c in people]))
    os.utime(folder / "1.json", (age, age))


def test_respondents_resume(spark, tmp_path):
    files, dim = tmp_path / "in", spark.createDataFrame([("6104000000000001",), ("6104000000000002",), ("6105000000000001",)], "fullCode string")
    run = lambda: jobs.sync_respondents(spark, str(files), str(tmp_path / "table"), dim, str(tmp_path / "resume"))
    region(files, "6104000000000001", [("2", "second"), ("1", "first"), ("2", "again")], 2000)
    region(files, "6199000000000001", [("8", "not wanted")], 1000)
    assert run() == (3, 1)
    # the list has the key of its readers, and a region that is done isn't read again
    lists = [json.loads(line) for f in os.listdir(tmp_path / "resume") if f.endswith(".json") for line in open(tmp_path / "resume" / f)]
    assert lists == [{"completedRegionFullCodes": ["6104000000000001"]}]
    region(files, "6104000000000001", [("7", "changed since")], 3000)
    region(files, "6104000000000002", [("1", "elsewhere"), ("3", "third")], 1000)
    assert run() == (3, 2) and run() == (3, 2)
    region(files, "6105000000000001", [("4", "fourth")], 4000)
    assert run() == (3, 3) and not (tmp_path / "resume").exists()
    got = sorted((r.no, r.id, r.code_identity, r.region_code) for r in jobs.respondents_of(spark, str(tmp_path / "table")).collect())
    assert got == [(1, "3", "third", "6104000000000002"), (2, "2", "second", "6104000000000001"), (3, "1", "first", "6104000000000001"), (4, "4", "fourth", "6105000000000001")]


def test_resume_lists_of_others(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"completedRegionFullCodes": []}))
    assert readers.finished(spark, str(tmp_path / "a.json")).count() == 0 and readers.finished(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "b.json").write_text(json.dumps({"done": ["1"]}))
    with pytest.raises(Exception, match="completedRegionFullCodes"):
        readers.finished(spark, str(tmp_path / "b.json")).count()
    writers.add_finished(spark.createDataFrame([(f"{i}",) for i in range(25)] + [(None,)], "c string"), str(tmp_path / "list"), at_once=10)
    assert readers.finished(spark, str(tmp_path / "list")).count() == 25


def test_kabs_of_two_provinces(spark, tmp_path):
    schema = "assignment_id string, level_2_full_code string, level_2_name string, level_6_full_code string, current_user_username string, current_user_survey_role_name string, assignment_status_alias string"
    rows = [("1", "6104", "X", "6104000000000001", "u", "p", "OPEN"), ("2", "7104", "Y", "7104000000000001", "u", "p", "OPEN")]
    jobs.sync_assignments(spark.createDataFrame(rows, schema), ["04"], str(tmp_path / "g"))
    jobs.sync_assignments(spark.createDataFrame([(*rows[1][:6], "DRAFT")], schema), ["04"], str(tmp_path / "g"))
    read = lambda: {(r.level_2_full_code, r.kab, r.OPEN, r.DRAFT) for r in readers.counts(spark, str(tmp_path / "g")).collect()}
    assert read() == {("6104", "04", 1, 0), ("7104", "04", 0, 1)}
    jobs.sync_assignments(spark.createDataFrame(rows, schema), ["7104"], str(tmp_path / "g"))
    assert read() == {("6104", "04", 1, 0), ("7104", "04", 1, 0)}
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "a"))
    seen = []
    own, writers.replace_partitions = writers.replace_partitions, lambda df, *_: seen.append(df._jdf.queryExecution().executedPlan().toString())
    try:
        jobs.sync_assignments(spark.read.parquet(str(tmp_path / "a")), ["04"], "unused")
    finally:
        writers.replace_partitions = own
    assert "In(level_2_full_code, [6104,7104])" in seen[0]


def test_too_many_statuses_are_refused(spark):
    from fieldtally.operators import progress

    with pytest.raises(ValueError, match="statuses"):
        progress.status_values(spark.range(600).select(F.col("id").cast("string").alias("s")), "s")
