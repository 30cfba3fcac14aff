"""Tables in versions: data folders that never change, and manifests that say
which of them a version is made of."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import Folder


class Conflict(RuntimeError):
    """Another writer has committed in the meantime."""


class Store:
    """``_versions/NUMBER.json`` under ``root``.

    A version exists once its manifest can be read; what a writer that was stopped
    has left behind, data without a manifest or half of one, is no version.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.folder = spark, root.rstrip("/"), Folder(spark, root)

    def _taken(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.names("_versions") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int) -> dict | None:
        try:
            return json.loads(self.folder.text(f"_versions/{version:012d}.json"))
        except (ValueError, OSError):
            return None
        except Exception as e:  # Java's errors have no class of their own here
            if "FileNotFound" in str(e):
                return None
            raise

    def versions(self) -> list[int]:
        return [v for v in self._taken() if self.manifest(v) is not None]

    def latest(self) -> tuple[int, dict | None]:
        """The newest version and its manifest; 0 and None before the first."""
        for v in reversed(self._taken()):
            if (found := self.manifest(v)) is not None:
                return v, found
        return 0, None

    def commit(self, after: int, manifest: dict) -> int:
        """The next version, if ``after`` is still the newest one."""
        now, _ = self.latest()
        if now != after:
            raise Conflict(f"version {now} has come after {after}")
        version = max([after, *self._taken()]) + 1
        at = datetime.now(timezone.utc).isoformat()
        try:
            self.folder.write(f"_versions/{version:012d}.json", json.dumps({"at": at} | manifest))
        except Exception as e:
            raise Conflict(f"version {version} was taken") from e
        return version

    def new_data(self) -> str:
        return f"data/{uuid.uuid4().hex}"

    def expire(self, keep: int = 30) -> list[int]:
        """Delete all but the newest ``keep`` versions, first their manifests, then the
        data that no version has any more.  Data of a write that goes on is not
        touched: only what an expired manifest names is deleted."""
        found = {v: self.manifest(v) for v in self.versions()}
        gone = sorted(found)[: max(0, len(found) - max(1, keep))]
        needed = {p for v, m in found.items() if v not in gone for p in m["paths"]}
        for v in gone:
            self.folder.delete(f"_versions/{v:012d}.json")
        unused = {p for v in gone for p in found[v]["paths"]} - needed
        whole = {"/".join(p.split("/")[:2]) for p in unused} - {"/".join(p.split("/")[:2]) for p in needed}
        for name in whole | {p for p in unused if "/".join(p.split("/")[:2]) not in whole}:
            self.folder.delete(name)
        return gone


class Snapshots:
    """A table of which every write is a version of its own."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Store(spark, root)

    def write(self, df: DataFrame) -> int | None:
        """A new version; None for an empty result, which can't replace a good one."""
        after, _ = self.store.latest()
        path = self.store.new_data()
        if df.isEmpty():
            return None
        df.write.mode("errorifexists").parquet(f"{self.store.root}/{path}")
        return self.store.commit(after, {"paths": [path], "schema": df.schema.jsonValue()})

    def add(self, df: DataFrame) -> int | None:
        """A version with the rows of the newest one and these; None if there are none."""
        after, found = self.store.latest()
        path = self.store.new_data()
        df.write.mode("errorifexists").parquet(f"{self.store.root}/{path}")
        if self.store.spark.read.schema(df.schema).parquet(f"{self.store.root}/{path}").isEmpty():
            self.store.folder.delete(path)
            return None
        return self.store.commit(after, {"paths": [*(found or {"paths": []})["paths"], path], "schema": df.schema.jsonValue()})

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or that one."""
        found = self.store.manifest(version) if version is not None else self.store.latest()[1]
        if found is None:
            raise ValueError(f"{self.store.root} has no version{'' if version is None else f' {version}'}")
        return self.store.spark.read.schema(StructType.fromJson(found["schema"])).parquet(*(f"{self.store.root}/{p}" for p in found["paths"]))

    def versions(self) -> list[int]:
        return self.store.versions()

    def expire(self, keep: int = 30) -> list[int]:
        return self.store.expire(keep)

    def changes(self, before: int, after: int, keys: Sequence[str]) -> DataFrame:
        return changes(self.read(before), self.read(after), keys)


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``change`` (added, removed, changed) for the keys whose rows differ.

    Each side's rows of a key are counted and their hashes summed before they move,
    so one shuffle of keys compares both, and a key with very many rows is no
    burden.  Null equals null; repeated rows of a key differ if their numbers do;
    columns are compared by name, and one that only one side has as null.
    """
    columns = [*old.columns, *(c for c in new.columns if c not in old.columns)]
    values = [c for c in columns if c not in keys]

    def side(df: DataFrame, n: int) -> DataFrame:
        have = [F.col(f"`{c}`") if c in df.columns else F.lit(None) for c in values]
        # a null is marked, as hashes leave it out
        marked = [x for c in have for x in (c.isNull(), c)] or [F.lit(0)]
        return df.select(*keys, F.lit(n).alias("_side"), F.xxhash64(*marked).alias("_h1"), F.xxhash64(F.lit(1), *marked).alias("_h2"))

    both = side(old, 0).unionByName(side(new, 1))
    of = lambda n, c: F.sum(F.when(F.col("_side") == n, c))
    sums = [of(n, F.lit(1)).alias(f"_n{n}") for n in (0, 1)] + [of(n, F.col(h).cast("decimal(38,0)")).alias(f"{h}{n}") for h in ("_h1", "_h2") for n in (0, 1)]
    per_key = both.groupBy(*keys).agg(*sums)
    same = (F.col("_n0") == F.col("_n1")) & (F.col("_h10") == F.col("_h11")) & (F.col("_h20") == F.col("_h21"))
    change = F.when(F.col("_n0").isNull(), "added").when(F.col("_n1").isNull(), "removed").when(~same, "changed")
    return per_key.select(*keys, change.alias("change")).where("change is not null")
