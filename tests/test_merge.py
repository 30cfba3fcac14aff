from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fieldtally.operators import merge, regions, respondents


def rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_patch_compares_columns_and_nulls(spark):
    new = spark.createDataFrame([("a_b", "c", 1), (None, "k", 2)], "u string, k string, n int")
    old = spark.createDataFrame([("a", "b_c", 9), (None, "k", 8), ("z", None, 7)], "u string, k string, n int")
    out = merge.fallback_patch(new, old, ["u", "k"])
    assert {r.n for r in out.collect()} == {1, 2, 9, 7}


def test_selective_merge_is_idempotent_and_keeps_null(spark):
    old = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "k string, n int")
    new = spark.createDataFrame([("A", 5)], "k string, n int")
    once = merge.selective_merge(old, new, "k", "A")
    assert rows(once, ["n"]) == rows(merge.selective_merge(once, new, "k", "A"), ["n"]) == [("B", 2), (None, 3), ("A", 5)]


def test_first_seen(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "id string, seq int, v string")
    assert rows(merge.first_seen(df, ["id"], ["seq"]), ["id"]) == [("a", 1, "y"), ("b", 5, None)]


def test_parts(spark):
    df = spark.createDataFrame([("u", "04", "R1", 1, "new", 0), ("u", "04", "R1", 9, "old", 1), ("u", "04", "R2", 4, "old", 1), (" ", "04", "R3", 4, "x", 0)], "u string, kab string, r string, n int, mail string, file int")
    out = merge.merge_parts(df, ["u", "kab"], ["mail"], "r", ["n"], ["file"])
    assert rows(out.select("u", "r", "n", "mail"), ["r"]) == [("u", "R1", 1, "new"), ("u", "R2", 4, "new")]


def test_latest_batch_includes_both_ends(spark):
    end = datetime(2026, 1, 1, 12)
    gaps = [0, 7140, 7200, 7201]
    df = spark.createDataFrame([(g, end - timedelta(seconds=g)) for g in gaps], "gap int, at timestamp_ntz")
    assert [r.gap for r in merge.latest_batch(df, "at").orderBy("gap").collect()] == [0, 7140, 7200]


def test_filters(spark):
    df = spark.createDataFrame([("6104",), ("61",), (None,), ("610512",)], "code string")
    assert {r.code for r in merge.selected_kabs(df, "code", ["04"]).collect()} == {"6104"}
    assert merge.selected_kabs(df, "code", []).count() == 3
    done = spark.createDataFrame([("6104",)], "code string")
    assert merge.not_done(df.where("code is not null"), done, "code").count() == 2
    assert [r.code for r in merge.missing_codes(done, df.where("code = '61'"), "code").collect()] == ["6104"]
    assert merge.newest_per_group(df, ["code"], [F.col("code")], 1).count() == 4


def test_tree_and_childless_parents(spark):
    nodes = spark.createDataFrame([("1", "A", None), ("2", "B", "1"), ("3", "C", "2"), ("9", "Z", "8")], "code string, name string, parent string")
    assert rows(regions.tree(nodes), ["level"]) == [("1", "A", 1, "A"), ("2", "B", 2, "A / B"), ("3", "C", 3, "A / B / C")]
    level = lambda *r: spark.createDataFrame(list(r), "id string, fullCode string, name string, parentFullCode string")
    out = regions.expand(level(("k", "1", "K", None), ("l", "2", "L", None)), level(("d", "11", "D", "1")), level(("s", "111", "S", "11")), level(("t", "1111", "T", "111")))
    assert [(r.id, r.slsId, r.desaId, r.kecName) for r in out.collect()] == [("t", "s", "d", "K")]


def test_respondents(spark):
    from fieldtally import schemas

    six = {"level1": {"name": "p", "level2": {"name": "k", "level3": {"name": "c", "level4": {"name": "d", "level5": {"name": "five", "level6": {"name": "six"}}}}}}}
    five = {"level1": {"name": "p", "level2": {"name": "k", "level3": {"name": "c", "level4": {"name": "d", "level5": {"name": "five", "level6": None}}}}}}
    base = {"data9": "", "latitude": ""}
    df = spark.createDataFrame([{"id": "1", "region": six, **base}, {"id": "2", "region": five, "data9": "1. Ya"}, {"id": "3", "region": None}], schemas.RESPONDENT)
    out = {r.id: r for r in respondents.flatten(df).collect()}
    assert [out[i].place for i in "123"] == ["six", "five", "-"]
    assert [out[i].found for i in "123"] == ["Belum diisi", "1. Ya", "Belum diisi"]
    assert out["1"].latitude == "-" and out["3"].kab == "-"


def test_trees_have_no_limit_of_depth_and_end_at_cycles(spark):
    chain = [(str(i), f"n{i}", str(i - 1) if i else None) for i in range(14)]
    loop = [("x", "X", "13"), ("y", "Y", "x"), ("x", "X", "y")]
    out = {(r.code, r.level) for r in regions.tree(spark.createDataFrame(chain + loop, "code string, name string, parent string")).collect()}
    assert out == {(str(i), i + 1) for i in range(14)} | {("x", 15), ("y", 16)}
    assert regions.tree(spark.createDataFrame([], "code string, name string, parent string")).count() == 0


def test_the_batch_filter_reaches_the_scan(spark, tmp_path):
    spark.sql("select timestamp'2026-01-01 00:00:00' + make_dt_interval(0, id) as at, id from range(10)").write.parquet(str(tmp_path / "t"))
    out = merge.latest_batch(spark.read.parquet(str(tmp_path / "t")), "at", 2)
    assert sorted(r.id for r in out.collect()) == [7, 8, 9]
    plan = out._jdf.queryExecution().explainString(out.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(at,ScalarSubquery" in plan
    text = spark.createDataFrame([("2026-01-01 00:00:00",), ("2026-01-01 03:00:00",)], "at string")
    assert merge.latest_batch(text, "at", 2).count() == 1


def test_targets(spark):
    df = spark.createDataFrame([("1", None), ("true", "-1"), ("1", "2"), ("0", None), (None, None)], "is_target string, error string")
    assert (merge.targets(df).count(), merge.targets(df, error_status="error").count()) == (3, 2)
