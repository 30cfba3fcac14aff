"""Counts by region, officer and status, from assignments and nested documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import or_default
from ..sources.shared import written
from ..statuses import STATUSES, columns


def progress_by_region_officer(assignments: DataFrame, kab_code: str | None = None, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Assignments per region and officer: a total and a count for each status.

    Groups are made of raw values, so a null and a literal "-" stay apart though
    both are shown as "-".  One aggregation computes all counts; only rows with
    a sub-SLS code are counted, and a kab code is a filter that reaches the scan.
    """
    rows = assignments.where("level_6_full_code is not null")
    if kab_code is not None:
        rows = rows.where(F.col("level_2_full_code") == kab_code)
    keys = ["level_2_name", "level_6_full_code", "current_user_username", "current_user_survey_role_name"]
    counts = [F.count(F.when(F.col("assignment_status_alias") == s, 1)).alias(s) for s in statuses]
    out = rows.groupBy(*keys).agg(F.count("assignment_id").alias("total"), *counts)
    name = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    return out.select(name("level_2_name", "-").alias("kab_name"), F.col("level_6_full_code").alias("region_code"), name("current_user_username", "-").alias("username"), name("current_user_username", "-").alias("email"), name("current_user_survey_role_name", "Pencacah").alias("role"), "total", *(F.col(f"`{s}`") for s in statuses))


def page(df: DataFrame, order: Sequence[str], limit: int, offset: int) -> DataFrame:
    """One page in a total order, nulls first."""
    return df.orderBy(*(F.col(c).asc_nulls_first() for c in order)).offset(offset).limit(limit)


def nest(rows: DataFrame, officer: Sequence[str], region: str, status: str, count: Column) -> DataFrame:
    """Flat rows as one document for each officer: ``regionSummary`` with a
    ``statusBreakdown`` for each region, both in order."""
    by_status = rows.groupBy(*officer, region, status).agg(count.cast("long").alias("n"))
    by_region = by_status.groupBy(*officer, region).agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct(F.col(status).alias("status"), F.col("n").alias("count")))).alias("statusBreakdown"))
    return by_region.groupBy(*officer).agg(F.sum("total").alias("total"), F.array_sort(F.collect_list(F.struct(F.col(region).alias("regionCode"), "total", "statusBreakdown"))).alias("regionSummary"))


def found_statuses(docs: DataFrame) -> list[str]:
    """All statuses of the documents, the fixed ones first."""
    seen = docs.select(F.explode("regionSummary").alias("r")).select(F.explode("r.statusBreakdown").alias("s")).select("s.status").where("status is not null and status <> ''").distinct()
    return columns(_few(seen))


def status_values(rows: DataFrame, column: str) -> list[str]:
    """The same from flat rows, before they are nested."""
    return columns(_few(rows.select(column).where(F.col(column).isNotNull() & (F.col(column) != "")).distinct()))


def _few(distinct: DataFrame, most: int = 500) -> list[str]:
    """Values that become columns; a column of other texts is refused before it fills the driver."""
    values = [r[0] for r in distinct.limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"more than {most} different statuses")
    return values


def wide(docs: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """One row for each region of a document; of repeated statuses the last counts.

    Documents without regions have no row.  All is computed within the row, so
    nothing is shuffled: names and counts are taken apart once, the last first,
    and each status is looked up by its place.
    """
    r = docs.select("*", F.explode("regionSummary").alias("_r"))
    r = r.select("*", F.reverse("_r.statusBreakdown.status").alias("_names"), F.reverse("_r.statusBreakdown.count").alias("_counts"))
    count = lambda s: F.coalesce(F.get("_counts", (F.array_position("_names", s) - 1).cast("int")), F.lit(0).cast("long")).alias(s)
    return r.select(or_default(F.col("_kabKotaName"), "-").alias("kab_name"), F.col("_r.regionCode").alias("region_code"), "username", "email", F.col("roleName").alias("role"), F.col("_r.total").alias("total"), *map(count, statuses))


def officer_summary(docs: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """One row for each document, with or without regions; repeated statuses add up.

    Within the row, entries become one sum for each status in a single pass over
    them; nothing is shuffled.
    """
    regions = F.coalesce(F.col("regionSummary"), F.array().cast(docs.schema["regionSummary"].dataType))
    flat = F.flatten(F.transform(regions, lambda r: F.coalesce(r["statusBreakdown"], F.array().cast("array<struct<status:string,count:bigint>>"))))
    place = F.create_map(*(c for i, s in enumerate(statuses) for c in (F.lit(s), F.lit(i)))) if statuses else F.lit(None).cast("map<string,int>")
    # (place, count) of each entry, in the order of places: equal ones stand together
    known = F.filter(F.transform(flat, lambda x: F.struct(F.try_element_at(place, x["status"]).alias("at"), F.coalesce(x["count"], F.lit(0).cast("long")).alias("n"))), lambda x: x["at"].isNotNull())
    empty = F.lit(None).cast("array<struct<at:int,n:bigint>>")
    add = lambda done, x: F.when(F.try_element_at(done, F.lit(-1))["at"] == x["at"], F.array_append(F.slice(done, 1, F.size(done) - 1), F.struct(x["at"].alias("at"), (F.element_at(done, -1)["n"] + x["n"]).alias("n")))).otherwise(F.array_append(done, x))
    sums = F.aggregate(F.array_sort(known), F.coalesce(empty, F.array().cast("array<struct<at:int,n:bigint>>")), add)
    rows = docs.select("*", F.size(regions).cast("long").alias("_n"), sums.alias("_sums"))
    count = lambda i, s: F.coalesce(F.get("_sums.n", (F.array_position("_sums.at", F.lit(i)) - 1).cast("int")), F.lit(0).cast("long")).alias(s)
    return rows.select(or_default(F.col("_kabKotaName"), "-").alias("kab_name"), "username", "email", F.col("roleName").alias("role"), F.col("_n").alias("n_regions"), "total", *(count(i, s) for i, s in enumerate(statuses)))


def long(docs: DataFrame) -> DataFrame:
    """One row for each officer, region and status; a region with an empty
    breakdown has one row with a null status and count."""
    r = docs.select("*", F.explode("regionSummary").alias("_r"))
    s = r.select("*", F.explode_outer("_r.statusBreakdown").alias("_s"))
    return s.select(or_default(F.col("_kabKotaName"), "-").alias("kab_name"), F.col("_r.regionCode").alias("region_code"), "username", F.col("_s.status").alias("status"), F.col("_s.count").alias("count"))


def unpivot_statuses(grid: DataFrame, ids: Sequence[str], statuses: Sequence[str]) -> DataFrame:
    """A status column for each status as rows of ``status`` and ``count``; only
    numeric columns can be statuses."""
    wrong = [c for c in statuses if dict(grid.dtypes)[c] not in ("int", "bigint", "double")]
    if wrong:
        raise ValueError(f"not counts: {wrong}")
    return grid.unpivot(list(ids), list(statuses), "status", "count")


def numbered(df: DataFrame, bucket: str, order: Sequence[str], name: str = "no", ranges: int | None = None) -> DataFrame:
    """1..n in the order of ``bucket`` and then ``order``, which must be total; nulls first.

    Rows are dealt to ``ranges`` of the whole order (None: as many as shuffles have
    partitions), so a bucket or a first value that
    most rows have is shared out too.  Places within a range come from its sorted
    rows, and only the ranges' counts, a row for each, are summed in one task.  The
    ranges are written, so ``df`` is worked out once, besides the sample for bounds.
    """
    first = [F.col(c).asc_nulls_first() for c in (bucket, *order)]
    ranges = written(df.repartitionByRange(*([ranges] if ranges else []), *first).sortWithinPartitions(*first).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = ranges.withColumn("_part", part).join(before, "_part")
    return placed.withColumn(name, F.col("_at").bitwiseAND((1 << 33) - 1) + F.col("_before") + 1).drop("_part", "_at", "_before")


def durations(history: DataFrame, keys: Sequence[str], status: str, at: str, tie: str, until: Column | None = None) -> DataFrame:
    """How long each entry of a history held: its row, ``ended`` and ``seconds``.

    An entry of some ``keys`` ends when their next one begins, by ``at`` and then
    ``tie``, which must be total; the last one ends at ``until`` (null: open).
    Texts that assign work ("ASSIGNED TO: ..") are no status and are left out
    first, and so are entries without a time.  All entries are put in one order
    and each is joined with the one after it, so keys of very many entries are
    shared out like others.
    """
    rows = history.where(F.col(at).isNotNull() & ~F.coalesce(F.col(status).startswith("ASSIGNED TO:"), F.lit(False)))
    ordered = written(numbered(rows.withColumn("_k", F.struct(*keys)), "_k", [at, tie], "_no"), "history")
    after = ordered.select((F.col("_no") - 1).alias("_no"), F.col("_k").alias("_next"), F.col(at).alias("_began"))
    joined = ordered.join(after, "_no", "left")
    ended = F.when(F.col("_k").eqNullSafe(F.col("_next")), F.col("_began")).otherwise(F.lit(None) if until is None else until)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return joined.withColumn("ended", ended).withColumn("seconds", (micros(F.col("ended")) - micros(F.col(at))) / 1e6).drop("_k", "_no", "_next", "_began")


def percent_done(done: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(done / total * 100)).cast("long")


def completeness(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """How many keys were expected and how many came."""
    flags = expected.select(key).distinct().join(got.select(key).distinct().withColumn("_got", F.lit(1)), key, "left")
    return flags.agg(F.count("*").alias("expected"), F.count("_got").alias("succeeded")).withColumn("missing", F.col("expected") - F.col("succeeded"))


def totals(docs: DataFrame) -> DataFrame:
    """Officers and regions in all documents."""
    return docs.agg(F.count("*").alias("officers"), F.coalesce(F.sum(F.coalesce(F.size("regionSummary"), F.lit(0))), F.lit(0)).alias("regions"))
