"""A table with one row for each key, kept in hash buckets as batches come."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.merge import first_seen
from ..sources.shared import Folder
from ..sources.versions import Store


class KeyedTable:
    """The first row of each key by ``sequence``, which must be total within a key.

    Keys are dealt to ``buckets`` by a hash.  A batch adds one small file to each
    bucket that it touches and nothing else; a bucket with more than
    ``most_deltas`` of them is rewritten alone.  What a batch changes is committed
    in one step with its number, so a batch that is repeated changes nothing, and
    one that was stopped is as if it had never come.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], sequence: Sequence[str], buckets: int = 64, most_deltas: int = 8):
        self.spark, self.keys, self.sequence, self.most_deltas = spark, list(keys), list(sequence), most_deltas
        self.store = Store(spark, root)
        found = self.store.latest()[1]
        if found is not None and found["keys"] != self.keys:
            raise ValueError(f"the table's keys are {found['keys']}")
        self.buckets = found["n_buckets"] if found is not None else buckets

    def _put(self, rows: DataFrame) -> dict[str, str]:
        """Rows in a new data folder, apart by bucket; the path of each bucket."""
        path = self.store.new_data()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        dealt = rows.withColumn("_bucket", bucket)
        dealt.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.store.root}/{path}")
        names = Folder(self.spark, f"{self.store.root}/{path}").names()
        return {n.split("=")[1]: f"{path}/{n}" for n in names if n.startswith("_bucket=")}

    def merge(self, batch: DataFrame, number: int) -> list[int]:
        """Take in a batch; the buckets that it touches.  Numbers of batches rise."""
        version, found = self.store.latest()
        found = found or {"last": None, "parts": {}}
        if found["last"] is not None and number <= found["last"]:
            return []
        schema = batch.schema if "schema" not in found else StructType.fromJson(found["schema"])
        new = self._put(first_seen(batch.select(*(f.name for f in schema)), self.keys, self.sequence))
        parts = {b: [*found["parts"].get(b, []), *([new[b]] if b in new else [])] for b in {*found["parts"], *new}}
        full = sorted(b for b in new if len(parts[b]) > self.most_deltas)
        if full:
            merged = first_seen(self._read([p for b in full for p in parts[b]], schema), self.keys, self.sequence)
            parts |= {b: [p] for b, p in self._put(merged).items()}
        paths = sorted(p for ps in parts.values() for p in ps)
        self.store.commit(version, {"last": number, "keys": self.keys, "n_buckets": self.buckets, "schema": schema.jsonValue(), "parts": parts, "paths": paths})
        for b in full:
            self.store.folder.delete(new[b])  # is in the bucket's new file and in no version
        return sorted(map(int, new))

    def _read(self, paths: Sequence[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.store.root}/{p}" for p in paths))

    def read(self) -> DataFrame:
        """One row for each key; only buckets with several files are merged again."""
        found = self.store.latest()[1]
        if found is None:
            raise ValueError(f"{self.store.root} has no version")
        schema = StructType.fromJson(found["schema"])
        one = [p[0] for p in found["parts"].values() if len(p) == 1]
        several = [p for ps in found["parts"].values() if len(ps) > 1 for p in ps]
        frames = [self._read(one, schema)] if one else []
        frames += [first_seen(self._read(several, schema), self.keys, self.sequence)] if several else []
        if not frames:
            return self.spark.createDataFrame([], schema)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def compact(self) -> None:
        """One file for each bucket; buckets that have one are not read."""
        version, found = self.store.latest()
        many = {b: ps for b, ps in (found or {"parts": {}})["parts"].items() if len(ps) > 1}
        if many:
            merged = first_seen(self._read([p for ps in many.values() for p in ps], StructType.fromJson(found["schema"])), self.keys, self.sequence)
            parts = found["parts"] | {b: [p] for b, p in self._put(merged).items()}
            self.store.commit(version, found | {"parts": parts, "paths": sorted(p for ps in parts.values() for p in ps)})

    def expire(self, keep: int = 2) -> list[int]:
        """Drop older versions and the files that only they have."""
        return self.store.expire(keep)


def merge_into(root: str, keys: Sequence[str], sequence: Sequence[str], buckets: int = 64, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """A stream's sink that keeps the first row of each key in a ``KeyedTable``."""

    def sink(batch: DataFrame, number: int) -> None:
        table = KeyedTable(batch.sparkSession, root, keys, sequence, buckets)
        table.merge(batch, number)
        table.expire(keep)

    return sink
