"""Nested documents with the edges that differ from report to report."""

import pytest
from pyspark.sql import functions as F

from fieldtally import schemas, statuses
from fieldtally.operators import progress

DOCS = [
    ("u1@x", "u1@x", "Pencacah", 6, "04", "MEMPAWAH", [("R1", 4, [("OPEN", 3), ("DRAFT", 1)]), ("R2", 2, [("OPEN", 2)])]),
    ("u2@x", "u2@x", "Pencacah", 3, "04", "MEMPAWAH", [("R3", 3, [("OPEN", 1), ("OPEN", 2)])]),
    ("u3@x", "u3@x", "Pencacah", 0, "04", "MEMPAWAH", None),
    ("u4@x", "u4@x", "Pencacah", 0, "05", "SAMBAS", [("R4", 0, [])]),
    ("u5@x", "u5@x", "Pencacah", 6, "05", "SAMBAS", [("R5", 6, [("ZZ EXTRA", 4), ("", 1), (None, 1)])]),
    ("u1@x", "u1@x", "Pencacah", 1, "05", "SAMBAS", [("R6", 1, [("OPEN", 1)])]),
    ("u6@x", "u6@x", None, None, None, None, [("R7", 1, [("OPEN", 1)])]),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, schemas.PROGRESS_DOC)


def test_statuses_are_the_fixed_ones_then_the_found_ones(docs):
    assert progress.found_statuses(docs) == [*statuses.STATUSES, "ZZ EXTRA"]
    assert statuses.columns(["b", "a", None, "", "OPEN"])[-2:] == ["a", "b"]


def test_wide_keeps_the_last_of_repeated_statuses_and_no_officer_without_regions(docs):
    rows = {r.region_code: r for r in progress.wide(docs, progress.found_statuses(docs)).collect()}
    assert set(rows) == {"R1", "R2", "R3", "R4", "R5", "R6", "R7"}
    assert rows["R3"]["OPEN"] == 2 and rows["R4"]["OPEN"] == 0 and rows["R5"]["ZZ EXTRA"] == 4
    assert rows["R7"].kab_name == "-"


def test_summary_adds_repeated_statuses_and_keeps_everyone(docs):
    rows = {(r.username, r.kab_name): r for r in progress.officer_summary(docs, ["OPEN", "DRAFT"]).collect()}
    assert len(rows) == 7
    assert rows["u2@x", "MEMPAWAH"]["OPEN"] == 3
    assert (rows["u3@x", "MEMPAWAH"].n_regions, rows["u3@x", "MEMPAWAH"]["OPEN"]) == (0, 0)
    assert rows["u6@x", "-"].total is None


def test_long_has_a_placeholder_for_an_empty_breakdown(docs):
    rows = progress.long(docs).collect()
    assert [(r.status, r["count"]) for r in rows if r.region_code == "R4"] == [(None, None)]
    assert not [r for r in rows if r.username == "u3@x"]


def test_long_is_wide_unpivoted_without_zeros(docs):
    names = progress.found_statuses(docs)
    ids = ["kab_name", "region_code", "username"]
    wide = progress.unpivot_statuses(progress.wide(docs, names), ids, names).where("count > 0")
    simple = progress.long(docs).where("count is not null and status <> ''").groupBy(*ids, "status").agg(F.max("count").alias("count"))
    assert sorted(map(tuple, wide.collect()), key=str) == sorted(map(tuple, simple.collect()), key=str)


def test_unpivot_refuses_text(docs):
    with pytest.raises(ValueError):
        progress.unpivot_statuses(docs, ["email"], ["username"])


def test_null_and_dash_are_different_groups(spark):
    rows = [("1", "6104", "X", "R", None, "p", "OPEN"), ("2", "6104", "X", "R", "-", "p", "OPEN"), ("3", "6104", "X", None, "a", "p", "OPEN"), ("4", "6105", "Y", "S", "a", "p", None)]
    df = spark.createDataFrame(rows, "assignment_id string, level_2_full_code string, level_2_name string, level_6_full_code string, current_user_username string, current_user_survey_role_name string, assignment_status_alias string")
    out = progress.progress_by_region_officer(df, "6104").collect()
    assert [(r.username, r.total, r["OPEN"]) for r in out] == [("-", 1, 1), ("-", 1, 1)]
    assert progress.progress_by_region_officer(df).count() == 3


def test_flat_to_nested_and_back(spark):
    rows = [("u", "R1", "OPEN", 2), ("u", "R1", "DRAFT", 1), ("u", "R2", "OPEN", 5), ("v", "R1", "OPEN", 1)]
    flat = spark.createDataFrame(rows, "who string, region string, status string, n long")
    nested = progress.nest(flat, ["who"], "region", "status", F.sum("n"))
    back = nested.select("who", F.explode("regionSummary").alias("r")).select("who", "r.regionCode", F.explode("r.statusBreakdown").alias("s")).select("who", "regionCode", "s.status", "s.count")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_numbers_follow_the_order(spark):
    df = spark.createDataFrame([("b", 2), ("a", 9), ("b", 1), (None, 3), ("a", 1)], "k string, x int")
    out = progress.numbered(df, "k", ["x"]).orderBy("no").collect()
    assert [(r.no, r.k, r.x) for r in out] == [(1, None, 3), (2, "a", 1), (3, "a", 9), (4, "b", 1), (5, "b", 2)]


def test_counters(spark, docs):
    assert tuple(progress.totals(docs).first()) == (7, 7)
    assert spark.range(1).select(progress.percent_done(F.lit(1), F.lit(3)), progress.percent_done(F.lit(1), F.lit(0))).first()[:] == (33, None)


def test_empty_documents(spark):
    empty = spark.createDataFrame([], schemas.PROGRESS_DOC)
    assert progress.wide(empty, statuses.STATUSES).count() == progress.long(empty).count() == 0
    assert tuple(progress.totals(empty).first()) == (0, 0)


def test_numbers_go_on_over_ranges_and_nulls(spark):
    rows = [(b, o, k) for b in ("x", None, "a") for o in (None, *range(40)) for k in range(2)]
    df = spark.createDataFrame(rows, "b string, o int, k int").repartition(5)
    out = progress.numbered(df, "b", ["o", "k"], ranges=4).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2]))
    assert [(r.b, r.o, r.k) for r in sorted(out, key=lambda r: r.no)] == order and sorted(r.no for r in out) == list(range(1, len(rows) + 1))
    assert progress.numbered(df.limit(0), "b", ["o", "k"]).count() == 0


def test_repeated_and_missing_statuses(spark):
    from fieldtally import schemas

    twice = [("A", 1), ("B", 2), ("A", 5), (None, 9)]
    docs = spark.createDataFrame([("u", None, None, 1, "04", None, [("R", 1, twice), ("S", 1, None), ("T", 1, [("A", None)])]), ("v", None, None, 1, "04", "X", None), ("w", None, None, 1, "04", "X", [])], schemas.PROGRESS_DOC)
    wide = {r.region_code: (r.A, r.B, r.C) for r in progress.wide(docs, ["A", "B", "C"]).collect()}
    assert wide == {"R": (5, 2, 0), "S": (0, 0, 0), "T": (0, 0, 0)}
    summary = {r.username: (r.n_regions, r.A, r.B, r.C) for r in progress.officer_summary(docs, ["A", "B", "C"]).collect()}
    assert summary == {"u": (3, 6, 2, 0), "v": (0, 0, 0, 0), "w": (0, 0, 0, 0)}
    assert progress.status_values(docs.select("username"), "username")[-3:] == ["u", "v", "w"]
