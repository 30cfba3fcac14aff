"""The end-to-end flows: landed files to merged snapshots and reports."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge, progress, respondents
from ..operators import regions as regions_of
from ..sources import readers, shared, versions, writers
from ..statuses import STATUSES

KEYS = ["_kabKotaCode", "username"]


# How columns are headed in workbooks.
TITLES = {"no": "No", "kab_name": "Kab/Kota", "region_code": "Kode Wilayah (SLS)", "username": "Username", "email": "Email", "role": "Role", "n_regions": "Jumlah Wilayah", "total": "Total Target", "status": "Status", "count": "Count"}


def reports(docs: DataFrame) -> dict[str, DataFrame]:
    """The wide, summary and long reports of a snapshot, numbered."""
    statuses = progress.found_statuses(docs)
    return {
        "Progress per SLS": progress.numbered(progress.wide(docs, statuses), "kab_name", ["region_code", "username"]),
        "Summary per Officer": progress.numbered(progress.officer_summary(docs, statuses), "kab_name", ["username"]),
        "Detail": progress.numbered(progress.long(docs), "kab_name", ["region_code", "username", "status"]),
    }


def publish(frames: dict[str, DataFrame], out: str, rows_per_file: int = 10_000, most_in_workbook: int = 100_000) -> None:
    """Each report as a grid, and all of them as one workbook unless one is too long
    for people to open."""
    for name, df in frames.items():
        writers.write_grid(df, f"{out}/{name.lower().replace(' ', '_')}", rows_per_file)
    shown = {name: df.withColumnsRenamed(TITLES) for name, df in frames.items()}
    try:
        writers.write_workbook(shown, f"{out}/reports.xlsx", most_in_workbook)
    except ValueError as e:
        warnings.warn(f"no workbook: {e}", stacklevel=2)


def sync_snapshot(docs: DataFrame, previous: DataFrame | None, out: str, version: str, keep: int = 30) -> DataFrame:
    """Merge new documents with the previous snapshot, write the next version and
    its reports, and delete all but the newest ``keep`` versions.  Without new
    documents nothing is written and the previous snapshot, if any, is returned."""
    spark = docs.sparkSession
    if docs.isEmpty():
        return previous if previous is not None else docs
    final = docs if previous is None else merge.fallback_patch(docs, previous.select(docs.columns), KEYS)
    path = writers.write_snapshot(final, f"{out}/snapshot", version)
    written = spark.read.parquet(path)
    publish(reports(written), f"{out}/reports")
    writers.retire(spark, f"{out}/snapshot", keep)
    return written


@dataclass(frozen=True)
class Landed:
    """The usable documents of landed pages, what is wrong with the others, and how
    complete each folder is."""

    documents: DataFrame
    quarantine: DataFrame
    completeness: DataFrame
    missing_kabs: list[str]


def landed_pages(spark: SparkSession, path: str, kabs: Sequence[str] = (), names: Mapping[str, str] | None = None) -> Landed:
    """Pages of several kabs in one run.

    With folders named ``kab=..`` below ``path`` each document gets the code of
    its folder, and of ``kabs`` those without a folder are named in
    ``missing_kabs``.  Without such folders all pages are of one kab, so more
    than one code is an error.  ``names`` are the kabs' names.
    """
    pages = readers.pages(spark, path)
    apart = [r.kab for r in pages.select("kab").distinct().limit(1001).collect()]
    if apart in ([None], []):
        if len(kabs) > 1:
            raise ValueError(f"{path} has no folders kab=.., so it can't be of {', '.join(kabs)}")
        chosen, missing = pages.withColumn("kab", F.lit(kabs[0] if kabs else None).cast("string")), []
    else:
        chosen = readers.pages(spark, path, kabs)
        missing = [k for k in kabs if k not in apart]
    name = F.lit(None).cast("string")
    for code, text in (names or {}).items():
        name = F.when(F.col("kab") == code, text).otherwise(name)
    docs = readers.page_documents(chosen)
    docs = docs.withColumns({"_kabKotaCode": F.coalesce("kab", "_kabKotaCode"), "_kabKotaName": F.coalesce(name, "_kabKotaName")}).drop("kab", "source_file")
    return Landed(docs, readers.quarantine(chosen), readers.completeness_of(chosen), missing)


def said_of(landed: Landed, most: int = 100) -> list[str]:
    """What people should know of a run: kabs and rows that are missing, and which files
    can't be used; up to ``most`` folders and files are named, the others counted."""
    out = [f"no folder for kab {k}" for k in landed.missing_kabs]
    sums = landed.completeness.agg(F.sum("expected").alias("expected"), F.sum("received").alias("received"), F.sum("unusable").alias("unusable")).first()
    out.append(f"{sums.received or 0} of {sums.expected or 0} rows, {sums.unusable or 0} unusable files")
    short = landed.completeness.where("missing > 0 or expected is null").orderBy("folder").limit(most).collect()
    out += [f"{r.folder}: {r.received} of {r.expected if r.expected is not None else 'an unknown number of'} rows" for r in short]
    out += [f"{r.source_file}: {r.reason}" for r in landed.quarantine.orderBy("source_file").limit(most).collect()]
    return out


def sync_workbooks(spark: SparkSession, folder: str, state: DataFrame, previous: DataFrame | None, out: str, version: str, hours: float = 2) -> DataFrame | None:
    """The newest batch of workbooks as a snapshot; None if none is newer than
    the high-water mark in ``state`` (``last_processed``).

    Only files of the batch are opened; their rows are written once and read from
    there, so no file is parsed twice.
    """
    from ..streaming.incremental import is_new

    files = readers.listing(spark, folder, "*.xlsx")
    if is_new(files, state).isEmpty():
        return None
    chosen = [r.path for r in merge.latest_batch(files, "modified", hours).select("path").collect()]
    parsed = f"{out}/parsed/version={version}"
    readers.workbooks(spark, chosen).write.mode("overwrite").parquet(parsed)
    return sync_snapshot(readers.workbook_documents(spark.read.parquet(parsed)), previous, out, version)


def sync_new_workbooks(spark: SparkSession, folder: str, previous: DataFrame | None, out: str, version: str, hours: float = 2, force: bool = False) -> DataFrame | None:
    """``sync_workbooks`` with the high-water mark kept beside the snapshots: the
    newest file's time is written after the batch, so a run that fails is taken
    again, and a run without newer files does nothing unless ``force``."""
    path = f"{out}/state"
    none = readers.state(spark, path).limit(0)
    newest = readers.listing(spark, folder, "*.xlsx").agg(F.max("modified").alias("last_processed")).first()
    done = sync_workbooks(spark, folder, none if force else readers.state(spark, path), previous, out, version, hours)
    if done is not None:
        writers.write_mark(spark.createDataFrame([newest], "last_processed timestamp"), path)
    return done


def remaining_regions(spark: SparkSession, regions: DataFrame, resume: str | None) -> DataFrame:
    """Regions that a resume list doesn't have, in the order of their codes."""
    if resume is not None:
        done = readers.finished(spark, resume).withColumnRenamed("code", "fullCode")
        regions = merge.not_done(regions, done, "fullCode")
    return regions_of.sorted_regions(regions)


def sync_assignments(assignments: DataFrame, kabs: Sequence[str], grid: str) -> None:
    """Fresh counts of the given kabs (two digits, or four with the province; none:
    all); partitions of other kabs, and of kabs of the same number in other
    provinces, stay untouched.  ``readers.counts`` reads them.

    The kabs' full codes are looked up first, so the filter on them reaches the scan.
    """
    rows = assignments.where("level_6_full_code is not null")
    if kabs:
        codes = [r[0] for r in rows.select("level_2_full_code").where(F.col("level_2_full_code").isin(*kabs) | F.substring("level_2_full_code", 3, 2).isin(*kabs)).distinct().limit(1001).collect()]
        rows = rows.where(F.col("level_2_full_code").isin(*codes)) if codes else rows.limit(0)
    counts = progress.progress_by_region_officer(rows, statuses=STATUSES)
    counts = counts.withColumns({"kab": F.substring("region_code", 3, 2), "level_2_full_code": F.substring("region_code", 1, 4)})
    if not counts.isEmpty():
        writers.replace_partitions(counts, grid, ["level_2_full_code"])


#: How respondents that come again are told apart, and numbered: as they arrived.
ARRIVAL = ["arrived", "source_file", "position"]


def respondent_report(rows: DataFrame, region_dim: DataFrame | None = None) -> DataFrame:
    """Respondents once each, the first that arrived, flat and numbered by arrival;
    with regions, only those from their folders."""
    if region_dim is not None:
        rows = respondents.of_regions(rows, region_dim, "region_code", "fullCode")
    return _by_arrival(respondents.flatten(merge.first_seen(rows, ["id"], ARRIVAL)))


def _by_arrival(flat: DataFrame) -> DataFrame:
    return progress.numbered(flat, ARRIVAL[0], ARRIVAL[1:]).drop(*ARRIVAL)


def sync_respondents(spark: SparkSession, files: str, out: str, regions: DataFrame | None = None, resume: str | None = None) -> tuple[int, int]:
    """Take in the landed respondents of the regions that the resume list doesn't have,
    then add these to it; (regions wanted, regions done so far).

    Each run adds a version to the table ``out`` (``respondents_of`` reads it), and a
    respondent that an earlier run has is not taken again.  The list is written
    after the rows, so a run that fails is taken again.  When all regions are done
    it is deleted, as there is nothing to resume.  Without ``regions`` the folders
    that have come are all that is wanted.
    """
    rows = readers.respondents(spark, files)
    code = F.nullif(F.regexp_extract("path", "/region_code=([^/]+)/", 1), F.lit(""))  # from the names alone
    landed = readers.listing(spark, files, "*.json").select(code.alias("fullCode")).where("fullCode is not null").distinct()
    wanted = landed if regions is None else regions.select("fullCode").distinct()
    done = readers.finished(spark, resume).withColumnRenamed("code", "fullCode") if resume else wanted.limit(0)
    now = shared.written(merge.not_done(wanted, done, "fullCode").join(landed, "fullCode", "left_semi"), "regions")
    fresh = rows if regions is None and not resume else rows.join(now.withColumnRenamed("fullCode", "region_code"), "region_code", "left_semi")
    earlier = versions.Snapshots(spark, out)
    if earlier.versions():
        fresh = fresh.join(earlier.read().select("id").distinct(), "id", "left_anti")
    earlier.add(respondents.flatten(merge.first_seen(fresh, ["id"], ARRIVAL)))
    if resume:
        writers.add_finished(now, resume)
        done = readers.finished(spark, resume).withColumnRenamed("code", "fullCode")
    else:
        done = landed
    n_wanted, n_left = wanted.count(), merge.not_done(wanted, done, "fullCode").count()
    if resume and not n_left:
        shared.Folder(spark, resume).delete()
    return n_wanted, n_wanted - n_left


def respondents_of(spark: SparkSession, table: str) -> DataFrame:
    """What ``sync_respondents`` has taken in so far, numbered by arrival."""
    return _by_arrival(versions.Snapshots(spark, table).read())


def region_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Landed level files (level3 to level6) as the flat level-6 dimension."""
    return regions_of.expand(*(readers.region_level(spark, f"{folder}/level{i}") for i in range(3, 7)))
