import os
import re

import pytest

from fieldtally.functions import scalars
from fieldtally.operators import checks
from tests.conftest import ROOT


def test_rules(spark):
    df = spark.createDataFrame([(1, "3", "1", "2", None), (2, "4", "1", None, "100"), (3, None, "x", "1", "60")], "id int, total_tk_jk string, tk_laki string, tk_pr string, pribadi string")
    rules = [checks.BUSINESS_RULES[0], checks.ConstantRule("owners", 100, ("pribadi",)), checks.SumRule("absent", "no_such", ("x",))]
    out = {(r.id, r.rule): r.ok for r in checks.check(df, "t", ["id"], rules).collect()}
    assert out == {(1, "workers_by_sex"): True, (2, "workers_by_sex"): False, (3, "workers_by_sex"): None, (1, "owners"): None, (2, "owners"): True, (3, "owners"): False}


def test_currency_rule_and_rosters(spark):
    df = spark.createDataFrame([(1, "Rp 1.500", "1000", "500"), (2, "Rp 2", "1", None)], "id int, t string, a string, b string")
    assert {r.id: r.ok for r in checks.currency_sum_rule(df, ["id"], "t", ["a", "b"]).collect()} == {1: True, 2: False}
    header = spark.createDataFrame([(1, "2"), (2, "0"), (3, None)], "id int, n string")
    roster = spark.createDataFrame([(1,), (1,), (9,)], "id int")
    assert {r.id: (r.stated, r.counted, r.ok) for r in checks.roster_counts(header, roster, "id", "n").collect()} == {1: (2, 2, True), 2: (0, 0, True), 3: (None, 0, None)}


def test_changes_anomalies_mapping_and_pivot(spark):
    df = spark.createDataFrame([(1, 2, 2, 3, 4)], "id int, a int, a_new int, b int, b_new int")
    assert [tuple(r) for r in checks.changed_items(df, ["id"], ["a", "b"]).collect()] == [(1, "b", "3", "4")]
    slots = spark.createDataFrame([(1, "why", None, " ", None), (2, None, None, "x", "2026")], "id int, e1 string, r1 string, e2 string, r2 string")
    assert sorted((r.id, r.slot, r.resolved) for r in checks.anomalies(slots, ["id"], [("e1", "r1"), ("e2", "r2")]).collect()) == [(1, 1, False), (2, 2, True)]
    v = spark.createDataFrame([("A", "c"), ("A", ""), ("B", None)], "block string, column_name string")
    assert {r.block: (r.variables, r.mapped, r.ratio) for r in checks.mapping_ratio(v).collect()} == {"A": (2, 1, 0.5), "B": (1, 0, 0.0)}
    eav = spark.createDataFrame([("x", "k1", "1"), ("x", "k2", "2"), ("y", "k2", "3")], "id string, data_key string, pair_value string")
    assert {r.id: (r.k1, r.k2) for r in checks.eav_pivot(eav, ["id"], ["k1", "k2"]).collect()} == {"x": ("1", "2"), "y": (None, "3")}


def test_rule_names_are_unique():
    names = [r.name for r in checks.BUSINESS_RULES]
    assert len(names) == len(set(names))
    with pytest.raises(AttributeError):
        checks.BUSINESS_RULES[0].name = "x"


def business_columns():
    """The columns that FIXTURES.md lists for se2026_nested, by type."""
    with open(f"{ROOT}/FIXTURES.md") as f:
        part = re.search(r"### `se2026_nested`(.*?)\n### ", f.read(), re.S)[1]
    return {c.strip(): kind for kind, names in re.findall(r"^- (VARCHAR|INTEGER|DOUBLE) \(\d+\): (.*)$", part, re.M) for c in names.split(",")}


def test_every_business_rule_fires_on_the_columns_of_its_table(spark):
    kinds = {"VARCHAR": "string", "INTEGER": "int", "DOUBLE": "double"}
    columns = business_columns()
    empty = dict.fromkeys(columns)
    rows = []
    for key, off in ((1, 0), (2, 7)):
        row = dict(empty)
        for rule in checks.BUSINESS_RULES:
            parts = dict(zip(rule.parts, [10, 20, 30, 15, 5, 20]))
            if isinstance(rule, checks.SumRule):
                parts[rule.total] = sum(parts.values()) + off
            else:
                parts[rule.parts[-1]] += off
            row |= parts
        assert set(row) == set(columns), set(row) - set(columns)
        rows.append((key, *(None if row[c] is None else {"string": str, "int": int, "double": float}[kinds[k]](row[c]) for c, k in columns.items())))
    df = spark.createDataFrame([*rows, (3, *empty.values())], "id int, " + ", ".join(f"`{c}` {kinds[k]}" for c, k in columns.items()))
    out = {(r.id, r.rule): r.ok for r in checks.check(df, "se2026_nested", ["id"], checks.BUSINESS_RULES).collect()}
    assert out == {(i, r.name): ok for i, ok in ((1, True), (2, False), (3, None)) for r in checks.BUSINESS_RULES}
    assert {"assets_month", "ownership_started"} <= {r.name for r in checks.BUSINESS_RULES}


def test_monthly_assets_are_read_from_text(spark):
    texts = {"36550000": True, "Rp 36.550.000": True, "36.550.000": True, "rp. 36.550.000,00": True, "36550000.0": True, "Rp 36.550.001": False, "36.550": False, "": None, "Rp": None, "-": None}
    df = spark.createDataFrame([(t, 36_000_000.0, 550_000.0) for t in texts], "total_aset_bln string, aset_tanah_bln double, aset_lain_bln double")
    assert {r.total_aset_bln: r.ok for r in checks.check(df, "t", ["total_aset_bln"], checks.BUSINESS_RULES).collect()} == texts


def test_amount(spark):
    want = {"4100": 4100.0, "Rp 4.100.000": 4100000.0, "1.500,25": 1500.25, "-1.500": -1500.0, "0.125": 0.125, "1,5": 1.5, "Rp500,-": 500.0, "3.655E7": 36550000.0, "x": None, "": None}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    assert {r.t: r.a for r in df.select("t", scalars.amount(df.t).alias("a")).collect()} == want
    number = spark.sql("select 12.345d as x")
    assert [r.a for r in number.select(scalars.amount(number.x).alias("a")).collect()] == [12.345]


def test_key_join_of_text_and_number(spark):
    left = spark.createDataFrame([("a", "1", "x"), ("a", " 02", "y"), ("b", "z", "w"), ("c", None, "v")], "assignment_id string, index1 string, name string")
    right = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("b", 1, "r"), ("c", None, "s")], "assignment_id string, index1 int, name string")
    out = checks.key_join(left, right)
    assert out.columns == ["assignment_id", "index1", "name", "name_right"]
    assert {tuple(r) for r in out.collect()} == {("a", "1", "x", "p"), ("a", " 02", "y", "q"), ("b", "z", "w", None), ("c", None, "v", None)}


def test_rules_that_do_not_fit_are_reported(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.warns(UserWarning, match="workers_by_sex"):
        none = checks.check(df, "t", ["id"], checks.BUSINESS_RULES[:1])
    assert none.count() == 0 and none.columns == ["table_name", "id", "rule", "ok"] and dict(none.dtypes)["ok"] == "boolean"
    assert checks.missing_columns(df, checks.BUSINESS_RULES[:1]) == {"workers_by_sex": ["tk_laki", "tk_pr", "total_tk_jk"]}
    assert checks.check(df, "t", ["id"], []).count() == 0
