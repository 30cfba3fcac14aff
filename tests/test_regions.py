"""Ways to the root, cuts below a cap, numbers over one order, histories, repeaters."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fieldtally.operators import nesting, progress, regions
from fieldtally.sources import shared

NODE = "code string, name string, parent string"


def test_a_thousand_levels_take_eleven_rounds(spark, monkeypatch):
    rounds, lengths = [], []
    own = shared.written

    def counted(df, name):
        rounds.append(name)
        lengths.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
        return own(df, name)

    monkeypatch.setattr(regions, "written", counted)
    chain = spark.createDataFrame([(f"{i}", f"n{i}", f"{i - 1}" if i else None) for i in range(1000)], NODE)
    got = {r.code: r for r in regions.tree(chain.repartition(4)).collect()}
    assert len(rounds) <= 12 and max(lengths[2:]) <= 1.2 * min(lengths[2:])  # the first is the table itself
    assert all(got[f"{i}"].level == i + 1 for i in range(1000))
    assert got["999"].path == " / ".join(f"n{i}" for i in range(1000))


def test_loops_orphans_and_repeated_codes(spark):
    rows = [("a", "A", None), ("b", "B", "a"), ("x", "X", "y"), ("y", "Y", "x"), ("z", "Z", "z"), ("o", "O", "nowhere"), ("u", "U", "x"), ("b", "B2", "a"), ("c", None, "b"), ("l", "L", None), ("l", "L2", "m"), ("m", "M", "l")]
    got = sorted((r.code, r.level, r.path) for r in regions.tree(spark.createDataFrame(rows, NODE)).collect())
    assert got == [("a", 1, "A"), ("b", 2, "A / B"), ("b", 2, "A / B2"), ("c", 3, "A / B / "), ("c", 3, "A / B2 / "), ("l", 1, "L"), ("m", 2, "L / M")]
    assert regions.tree(spark.createDataFrame([], NODE)).count() == 0


def cut(rows, levels, cap):
    """(codes, n, over) of each region, and each row's, by plain counting."""
    n = Counter(r[: i + 1] for r in rows for i in range(levels))
    of = [next(r[: i + 1] for i in range(levels) if n[r[: i + 1]] < cap or i == levels - 1) for r in rows]
    return {(k, m, m >= cap) for k, m in Counter(of).items()}, Counter((r, len(k), n[k]) for r, k in zip(rows, of))


@pytest.mark.parametrize("cap", [1, 3, 7, 20, 1000])
def test_a_cut_below_the_cap(spark, cap):
    rows = [(f"p{i % 3}", f"k{i % 5}" if i % 11 else None, f"s{i * i % 7}" if i % 4 else None, None if i % 2 else "-") for i in range(120)] + [("p9", "", "", "")] * 25
    levels = ["a", "b", "c", "d"]
    df = spark.createDataFrame(rows, ", ".join(f"{x} string" for x in levels)).withColumn("n", F.lit(1)).repartition(3)
    regions_, of = cut(rows, 4, cap)
    got = [(tuple(r[x] for x in levels)[: r.level], r.n, r.over) for r in regions.frontier(df, levels, cap).collect()]
    assert len(got) == len(regions_) and set(got) == regions_ and sum(n for _, n, _ in got) == len(rows)
    assert Counter((tuple(r[x] for x in levels), r.region_level, r.region_n) for r in regions.by_frontier(df, levels, cap).collect()) == of
    assert regions.frontier(df.limit(0), levels, cap).count() == 0


def test_numbers_with_a_hot_first_value(spark):
    n = 20_000
    df = spark.range(n).select(F.lit("b").alias("b"), F.when(F.col("id") % 100 > 0, "hot").otherwise(F.col("id").cast("string")).alias("o"), (n - F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = progress.numbered(df, "b", ["o", "k"])
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = sorted(("b", "hot" if i % 100 else str(i), n - i) for i in range(n))
    assert [(r.b, r.o, r.k) for r in sorted(rows, key=lambda r: r.no)] == want


def test_a_hot_value_is_dealt_to_several_ranges(spark, monkeypatch):
    seen = {}
    own = shared.written

    def look(df, name):
        out = own(df, name)
        seen[name] = out
        return out

    monkeypatch.setattr(progress, "written", look)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        progress.numbered(spark.range(20_000).select(F.lit("b").alias("b"), F.lit("hot").alias("o"), "id"), "b", ["o", "id"]).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = seen["numbered"].groupBy(F.shiftright("_at", 33).alias("p")).count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 10_000


def test_how_long_a_status_held(spark):
    at = lambda m: datetime(2026, 1, 1) + timedelta(minutes=m)
    rows = [("a", "OPEN", at(0), 1), ("a", "ASSIGNED TO: x", at(3), 2), ("a", "DONE", at(10), 3), ("b", "OPEN", at(5), 4), (None, "OPEN", at(1), 5), (None, None, at(2), 6), ("c", "OPEN", None, 7), ("d", "A", at(1), 8), ("d", "B", at(1), 9)]
    df = spark.createDataFrame(rows, "who string, status string, at timestamp, n int")
    got = {r.n: r.seconds for r in progress.durations(df, ["who"], "status", "at", "n", F.lit(at(60))).collect()}
    assert got == {1: 600, 3: 3000, 4: 3300, 5: 60, 6: 3480, 8: 0, 9: 3540}
    still = {r.n: r.ended for r in progress.durations(df, ["who"], "status", "at", "n").collect()}
    assert still[3] is None and still[1] == at(10)


def nested_tables(spark, colocated=None):
    forms = spark.createDataFrame([(1, "f1"), (2, "f2"), (3, "f3")], "assignment_id long, name string")
    businesses = spark.createDataFrame([(1, "2", "b12"), (1, " 1", "b11"), (2, "1", "b21"), (2, "x", "no place"), (9, "1", "no form")], "assignment_id long, index1 string, name string")
    branches = spark.createDataFrame([(1, 1, 2, "r112"), (1, 1, 1, "r111"), (1, 7, 1, "no business"), (2, 1, None, "no place"), (2, 1, 10, "r2110"), (2, 1, 9, "r219")], "assignment_id long, index1 int, index2 int, name string")
    frames = [forms, businesses, branches]
    return [nesting.colocate(df, f"{colocated.name}_{i}", ["assignment_id"], 4, f"{colocated}/{i}") for i, df in enumerate(frames)] if colocated else frames


@pytest.mark.parametrize("colocated", [False, True])
def test_repeaters_are_nested(spark, colocated, tmp_path):
    colocated = tmp_path if colocated else None
    got = {r.assignment_id: [(b.index1, b.name, [(x.index2, x.name) for x in b.branches]) for b in r.businesses] for r in nesting.nested(*nested_tables(spark, colocated)).collect()}
    assert got == {1: [(1, "b11", [(1, "r111"), (2, "r112")]), (2, "b12", [])], 2: [(1, "b21", [(9, "r219"), (10, "r2110")])], 3: []}


def test_nothing_moves_between_tables_side_by_side(spark, tmp_path):
    tables = nested_tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = nesting.nested(*tables)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" in nesting.nested(*nested_tables(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
