"""Streams with late rows, sessions and restarts."""

from datetime import datetime, timedelta

from fieldtally.streaming import incremental

START = datetime(2026, 1, 1)
SCHEMA = "id string, at timestamp, who string"


class Feed:
    """A stream whose batches are written one after another; each run is a restart."""

    def __init__(self, spark, base, make):
        self.spark, self.base, self.make = spark, str(base), make

    def add(self, rows):
        frame = self.spark.createDataFrame([(i, START + timedelta(minutes=m), w) for i, m, w in rows], SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(f"{self.base}/in")
        stream = self.make(incremental.parquet_stream(self.spark, f"{self.base}/in", frame.schema))
        incremental.run_available(stream, incremental.append_to(f"{self.base}/out"), f"{self.base}/state")
        return self.spark.read.parquet(f"{self.base}/out").collect()


def test_a_key_is_given_out_once(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: incremental.first_in_stream(s, ["id"], "at", "1 hour"))
    assert sorted(r.id for r in feed.add([("a", 0, "x"), ("b", 5, "x"), ("a", 1, "y")])) == ["a", "b"]
    assert sorted(r.id for r in feed.add([("a", 10, "x"), ("c", 12, "x")])) == ["a", "b", "c"]
    assert sorted(r.id for r in feed.add([("c", 20, "x"), ("d", 300, "x"), ("b", 30, "z")])) == ["a", "b", "c", "d"]
    # the watermark has passed: what is older is left out, and state no longer knows a
    assert sorted(r.id for r in feed.add([("e", 100, "x"), ("a", 310, "x")])) == ["a", "a", "b", "c", "d"]


def windows(rows):
    return sorted((int((r.start - START).total_seconds() // 60), r.n) for r in rows)


def test_rows_beyond_the_lateness_are_left_out(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: incremental.windowed_counts(s, "at", ["who"], "10 minutes", "15 minutes"))
    assert windows(feed.add([("a", 1, "x"), ("b", 12, "x")])) == []  # the watermark is before all windows' ends
    # a row late by 11 minutes counts; the watermark then is at 40 - 15
    assert windows(feed.add([("c", 1, "x"), ("d", 40, "x")])) == [(0, 2), (10, 1)]
    # one from before the watermark doesn't; one after it does, though it comes late
    assert windows(feed.add([("e", 5, "x"), ("f", 33, "x"), ("g", 90, "x")])) == [(0, 2), (10, 1), (30, 1), (40, 1)]


def sessions(rows):
    return sorted((r.who, int((r.start - START).total_seconds() // 60), int((r.until - START).total_seconds() // 60), r.n) for r in rows)


def test_sessions_of_a_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: incremental.session_counts(s, "at", ["who"], "30 minutes", "20 minutes"))
    assert sessions(feed.add([("a", 0, "x"), ("b", 20, "x"), ("c", 10, "y")])) == []
    # x goes on with a row of a later batch; y ends
    assert sessions(feed.add([("d", 45, "x"), ("e", 62, "y")])) == [("y", 10, 40, 1)]
    got = sessions(feed.add([("late", 5, "y"), ("f", 300, "y")]))
    assert got == [("x", 0, 75, 3), ("y", 10, 40, 1), ("y", 62, 92, 1)]
