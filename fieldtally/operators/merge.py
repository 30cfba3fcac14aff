"""Merging a new snapshot with earlier ones, and keeping what came first or last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fallback_patch(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``new``, and the rows of ``old`` whose keys it doesn't have.

    Keys are compared column by column, so joined texts can't collide, and null
    equals null.  Partitions that were not fetched again keep all their rows.
    """
    have = new.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    same = None
    for k in keys:
        one = old[k].eqNullSafe(have[f"_{k}"])
        same = one if same is None else same & one
    return new.unionByName(old.join(have, same, "left_anti"))


def selective_merge(old: DataFrame, new: DataFrame, partition: str, target: str) -> DataFrame:
    """The rows of ``old`` outside the target partition, and those of ``new``."""
    return old.where(~F.col(partition).eqNullSafe(F.lit(target))).unionByName(new)


def first_seen(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The first row of each key by ``sequence``, which must be total within a key.

    Candidates are compared before they move, so a key with very many rows is
    no burden.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*sequence)).alias("_first")
    return df.groupBy(*keys).agg(best).select(*keys, "_first.*").select(df.columns)


def merge_parts(parts: DataFrame, officer: Sequence[str], attributes: Sequence[str], region: str, breakdown: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Rows of several files as one row for each officer and region.

    An officer's attributes come from the first row that has the officer; a
    region's counts from the first that has the region.  Rows without an officer
    are dropped.
    """
    who = officer[0]
    rows = parts.where(F.trim(F.coalesce(F.col(who), F.lit(""))) != "")
    people = first_seen(rows.select(*officer, *attributes, *sequence), officer, sequence).select(*officer, *attributes)
    regions = first_seen(rows.select(*officer, region, *breakdown, *sequence), [*officer, region], sequence).select(*officer, region, *breakdown)
    return regions.join(people, list(officer))


def latest_batch(df: DataFrame, at: str, hours: float = 2) -> DataFrame:
    """Rows at most ``hours`` before the newest one, both ends included.

    The earliest time that counts is a scalar subquery, and a time column is
    compared as it is, so the filter reaches the scan; texts are cast.
    """
    time = F.col(at) if df.schema[at].dataType.typeName().startswith("timestamp") else F.col(at).cast("timestamp")
    earliest = df.agg((F.max(time) - F.make_dt_interval(secs=F.lit(hours * 3600).cast("decimal(18,6)"))).alias("m")).scalar()
    return df.where(time >= earliest)


def newest(df: DataFrame, order: Sequence[Column], keep: int) -> DataFrame:
    """The first ``keep`` rows of a total order."""
    return df.orderBy(*order).limit(keep)


def newest_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], keep: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= keep).drop("_n")


def missing_codes(requested: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Requested codes that were not found."""
    return requested.select(key).distinct().join(found.select(key), key, "left_anti")


def selected_kabs(df: DataFrame, code: str, kabs: Sequence[str]) -> DataFrame:
    """Rows whose region code is of one of these kabs; an empty list takes all
    that have a code."""
    from ..functions.scalars import kab_of

    kab = kab_of(F.col(code))
    return df.where(kab.isin(*kabs) if kabs else F.col(code).isNotNull())


def targets(df: DataFrame, flag: str = "is_target", error_status: str | None = None) -> DataFrame:
    """Target rows only (flag 1 or true); with an ``error_status`` column, only
    those without an error (null or below 0)."""
    rows = df.where(F.lower(F.col(flag).cast("string")).isin("1", "true"))
    return rows if error_status is None else rows.where(F.coalesce(F.col(error_status).try_cast("int"), F.lit(-1)) < 0)


def not_done(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work whose key has not been finished."""
    return work.join(done.select(key).distinct(), key, "left_anti")
