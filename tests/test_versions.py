"""Versions that are committed in one step, and tables kept by key."""

import os

import pytest
from pyspark.sql import functions as F

from fieldtally.sources import versions, writers
from fieldtally.streaming import keyed


def data_files(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(f"{root}/data") for f in fs if f.endswith(".parquet")}


def test_a_stopped_write_is_no_version(spark, tmp_path):
    table = versions.Snapshots(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    assert table.write(spark.range(3)) == 1 and table.write(spark.range(0)) is None
    broken = spark.range(5).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        table.write(broken.repartition(1))
    (tmp_path / "t/_versions/000000000002.json").write_text('{"paths": ["da')  # a manifest cut off half-way
    assert table.versions() == [1] and table.read().count() == 3
    assert table.write(spark.range(4)) == 3 and table.read().count() == 4 and table.read(1).count() == 3


def test_only_one_of_two_writers_commits(spark, tmp_path):
    store = versions.Store(spark, str(tmp_path / "t"))
    assert store.commit(0, {"paths": []}) == 1
    with pytest.raises(versions.Conflict):
        store.commit(0, {"paths": []})
    assert store.versions() == [1]


def test_expiry_deletes_what_no_version_needs(spark, tmp_path):
    root = str(tmp_path / "t")
    table = versions.Snapshots(spark, root)
    for n in range(1, 4):
        table.write(spark.range(n).coalesce(1))
    table.add(spark.range(10).coalesce(1))  # shares the third version's data
    os.makedirs(f"{root}/data/being-written")
    before = len(data_files(root))
    assert table.expire(keep=1) == [1, 2, 3] and table.versions() == [4]
    assert table.read().count() == 13 and len(data_files(root)) == before - 2 and os.path.isdir(f"{root}/data/being-written")
    assert table.add(spark.range(0)) is None and table.versions() == [4]


def test_changes(spark):
    schema = "k long, x double, y string"
    old = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, None), (3, 3.0, "c"), (None, 1.0, "n"), (5, 1.0, "r"), (5, 1.0, "r"), (7, None, "")], schema)
    new = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, ""), (4, 1.0, "d"), (None, 1.0, "n"), (5, 1.0, "r"), (7, None, "")], schema)
    found = lambda a, b: {r.k: r.change for r in versions.changes(a, b, ["k"]).collect()}
    assert found(old, new) == {2: "changed", 3: "removed", 4: "added", 5: "changed"}
    assert found(old, old.repartition(7)) == {} and set(found(old.limit(0), new).values()) == {"added"}
    assert found(old, new.drop("y").withColumn("z", F.lit(1)).where("k = 1")) == {1: "changed", 2: "removed", 3: "removed", None: "removed", 5: "removed", 7: "removed"}


def test_folders_retire(spark, tmp_path):
    for n in ("version=1", "version=2", "version=3", "backup=1"):
        (tmp_path / n).mkdir()
    assert writers.retire(spark, str(tmp_path), 2) == ["version=1"] and writers.retire(spark, str(tmp_path), 2, "backup=") == []
    assert sorted(os.listdir(tmp_path)) == ["backup=1", "version=2", "version=3"]


def rows(n, seq, step=1):
    return [(k, seq, f"{k}-{seq}") for k in range(0, n, step)]


SCHEMA = "k long, seq int, v string"


def test_a_batch_writes_its_own_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    table = keyed.KeyedTable(spark, root, ["k"], ["seq"], buckets=50, most_deltas=2)
    assert table.merge(spark.createDataFrame(rows(1000, 5), SCHEMA), 0) == list(range(50))
    first = data_files(root)
    few = spark.createDataFrame([(k, 1, "early") for k in range(10)], SCHEMA)  # 1 % of the keys
    touched = table.merge(few, 1)
    new = data_files(root) - first
    assert 0 < len(touched) <= 10 and len(new) == len(touched) and {int(p.split("_bucket=")[1].split("/")[0]) for p in new} == set(touched)
    # the same batch again: no file, no version
    assert table.merge(few, 1) == [] and data_files(root) == first | new and table.store.versions() == [1, 2]
    # a third file: only these buckets are rewritten
    before = data_files(root)
    again = table.merge(spark.createDataFrame([(k, 9, "late") for k in range(10)], SCHEMA), 2)
    assert again == touched and len(data_files(root) - before) == len(touched)
    parts = table.store.latest()[1]["parts"]
    assert all(len(p) == 1 for p in parts.values()) and {p.split("/")[1] for b, ps in parts.items() if int(b) not in touched for p in ps} == {next(iter(first)).split("/")[1]}
    table.expire(1)
    assert len(data_files(root)) == 50
    got = {r.k: r.v for r in table.read().collect()}
    assert got == {k: "early" if k < 10 else f"{k}-5" for k in range(1000)}


def test_the_first_row_of_a_key_stays_whatever_comes(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["seq"], buckets=4, most_deltas=3)
    want = {}
    for n, seq in enumerate((5, 3, 8, 1, 2)):
        batch = [(k, seq, f"{seq}") for k in range(n, 40, n + 1)] + [(None, seq, f"{seq}")] * 2
        table.merge(spark.createDataFrame(batch, SCHEMA), n)
        for k, s, v in batch:
            want[k] = min(want.get(k, (s, v)), (s, v))
        assert {r.k: (r.seq, r.v) for r in table.read().collect()} == want
    table.compact()
    assert all(len(p) == 1 for p in table.store.latest()[1]["parts"].values())
    assert {r.k: (r.seq, r.v) for r in table.read().collect()} == want
    table.merge(spark.createDataFrame([], SCHEMA), 9)
    reopened = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["seq"], buckets=99)
    assert reopened.buckets == 4 and reopened.read().count() == len(want)
    with pytest.raises(ValueError):
        keyed.KeyedTable(spark, str(tmp_path / "t"), ["v"], ["seq"])


def test_a_stopped_batch_is_as_if_it_had_not_come(spark, tmp_path, monkeypatch):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["seq"], buckets=4)
    table.merge(spark.createDataFrame([(1, 5, "a")], SCHEMA), 0)

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(table.store, "commit", stop)
    with pytest.raises(KeyboardInterrupt):
        table.merge(spark.createDataFrame([(1, 1, "b"), (2, 1, "c")], SCHEMA), 1)
    monkeypatch.undo()
    assert [tuple(r) for r in table.read().collect()] == [(1, 5, "a")]
    table.merge(spark.createDataFrame([(1, 1, "b"), (2, 1, "c")], SCHEMA), 1)
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, 1, "b"), (2, 1, "c")]
