"""Reading landed files: pages, snapshots, grids, tables, workbooks, listings."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..statuses import STATUSES


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON with ``unreadable`` (the text of a file that isn't JSON, as one
    that was cut off) and ``source_file``.

    Folders named ``kab=04`` and ``region_code=6104..`` below ``path`` are columns, and
    filters on them skip the other folders; without such folders they are null.
    """
    schema = f"{schema}, unreadable string, kab string, region_code string"
    rows = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "unreadable").json(path)
    return rows.withColumn("source_file", F.col("_metadata.file_path"))


def pages(spark: SparkSession, path: str, kabs: Sequence[str] = ()) -> DataFrame:
    """Landed pages as they are, readable or not; of these kabs only, if any are given."""
    found = _json(spark, path, schemas.PAGE)
    return found.where(F.col("kab").isin(*kabs)) if kabs else found


def quarantine(landed: DataFrame) -> DataFrame:
    """``source_file``, ``kab`` and ``reason`` of the pages that can't be used: those
    that aren't JSON, and those by which the service reported a failure."""
    reason = F.when(F.col("unreadable").isNotNull(), F.concat(F.lit("not JSON, "), F.length("unreadable"), F.lit(" characters"))).when(~F.coalesce("success", F.lit(False)), F.concat(F.lit("refused: "), F.coalesce("message", F.lit("without a message"))))
    return landed.select("source_file", "kab", reason.alias("reason")).where("reason is not null")


def page_documents(landed: DataFrame) -> DataFrame:
    """The documents of the pages that can be used, with their kab and file."""
    good = landed.where("unreadable is null and success")
    return good.select(F.explode("data.content").alias("d"), "kab", "source_file").select("d.*", "kab", "source_file")


def progress_pages(spark: SparkSession, path: str, kab_code: str | None = None, kab_name: str | None = None) -> DataFrame:
    """The documents of landed pages, with the file each came from.

    Pages that can't be read, didn't succeed or have no content add nothing; see
    ``quarantine``.
    """
    docs = page_documents(pages(spark, path)).drop("kab")
    if kab_code is not None:
        docs = docs.withColumns({"_kabKotaCode": F.lit(kab_code), "_kabKotaName": F.lit(kab_name)})
    return docs


def completeness_of(landed: DataFrame) -> DataFrame:
    """For each folder: its ``kab``, how many elements its pages announce and hold,
    how many are missing, and how many pages can't be used."""
    good = F.col("unreadable").isNull() & F.coalesce("success", F.lit(False))
    rows = landed.select(F.regexp_replace("source_file", "/[^/]*$", "").alias("folder"), "kab", F.when(good, F.col("data.totalElements")).alias("total"), F.when(good, F.coalesce(F.size("data.content"), F.lit(0))).alias("n"))
    sums = rows.groupBy("folder", "kab").agg(F.max("total").alias("expected"), F.coalesce(F.sum("n"), F.lit(0)).alias("received"), F.count_if(F.col("n").isNull()).alias("unusable"))
    return sums.withColumn("missing", F.col("expected") - F.col("received"))


def page_completeness(spark: SparkSession, path: str) -> DataFrame:
    """How many elements the pages announce and how many they hold, per folder."""
    return completeness_of(pages(spark, path))


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of documents, or a folder of them."""
    return spark.read.schema(schemas.PROGRESS_DOC).option("multiLine", True).json(path)


def respondents(spark: SparkSession, path: str) -> DataFrame:
    """Landed respondents, with ``kab`` and ``region_code`` from the names of their
    folders, and their place in the order of arrival: ``arrived`` (the file's time),
    ``source_file`` and ``position`` within it.  Files that aren't JSON add nothing."""
    rows = _json(spark, path, schemas.RESPONDENT)
    placed = rows.withColumns({"arrived": F.col("_metadata.file_modification_time"), "position": F.monotonically_increasing_id()})
    return placed.where("unreadable is null").drop("unreadable")


def region_level(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REGION_LEVEL).option("multiLine", True).json(path)


def grid(spark: SparkSession, path: str) -> DataFrame:
    """A header and rows, all text; columns are found by name, not by position."""
    return spark.read.option("header", True).csv(path)


def branch_list(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A CSV import (one line a record, a header line) and, apart from it, its
    lines that don't fit."""
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _corrupt_record string"
    lines = spark.read.text(path).where((F.trim("value") != "") & (F.lower("value") != ",".join(columns).lower()))
    rows = lines.select("value", F.from_csv("value", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    return rows.where("r._corrupt_record is null").select(*(f"r.`{c}`" for c in columns)), rows.where("r._corrupt_record is not null").select("value")


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path``, ``modified`` and ``length`` of the files of a folder; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def state(spark: SparkSession, path: str) -> DataFrame:
    """The marks that ``writers.write_mark`` wrote; empty before the first."""
    schema = "last_processed timestamp, key string"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def finished(spark: SparkSession, path: str) -> DataFrame:
    """The region codes of a resume list: JSON objects with the key that is written
    now or the one of earlier lists; an object with neither is an error."""
    now, before = RESUME_KEYS
    if not exists(spark, path):
        return spark.createDataFrame([], "code string")
    lists = spark.read.schema(f"{now} array<string>, {before} array<string>").option("multiLine", True).json(path)
    codes = F.coalesce(now, before)
    checked = F.when(codes.isNull(), F.raise_error(F.lit(f"a resume list has neither {now} nor {before}"))).otherwise(codes)
    return lists.select(F.explode(checked).alias("code")).distinct()


def counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts that ``jobs.sync_assignments`` keeps; codes stay text."""
    fixed = "kab_name string, region_code string, username string, email string, role string, total long, kab string"
    statuses = ", ".join(f"`{s}` long" for s in STATUSES)
    return spark.read.schema(f"{fixed}, {statuses}, level_2_full_code string").parquet(path)


# The keys of a resume list, the one that is written and an earlier one.
RESUME_KEYS = ("completedRegionFullCodes", "completedSlsCodes")


def capped_regions(respondents: DataFrame, region: str, cap: int = 1000) -> DataFrame:
    """Regions with as many rows as the service returns at the most: some of their
    rows may be missing, and they must be fetched in smaller parts."""
    return respondents.groupBy(region).agg(F.count("*").alias("n")).where(F.col("n") >= cap)


def run_sql(spark: SparkSession, text: str, limit: int | None = 1000) -> DataFrame:
    """A statement over the registered views, with a row limit (None: all rows);
    errors are raised."""
    rows = spark.sql(text)
    return rows if limit is None else rows.limit(limit)


def register(spark: SparkSession, folder: str, tables: Sequence[str]) -> None:
    for t in tables:
        spark.read.parquet(f"{folder}/{t}.parquet").createOrReplaceTempView(t)


# Header names that are not statuses, in lower case.
HEADERS = {
    "kab": ["kab/kota", "kabupaten/kota", "kabupaten"],
    "region": ["kode wilayah", "kode wilayah (sls)", "kode wilayah (sub-sls)"],
    "username": ["username", "username petugas"],
    "email": ["email", "email petugas"],
    "role": ["role"],
    "total": ["total wilayah", "total target", "total assignment"],
    "": ["no", "jumlah wilayah", "status", "count"],
}
# Sheets to prefer, by a part of their name.
SHEETS = ["Detail Wilayah per Pencacah", "Progress per SLS"]

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def _sheet_rows(data: bytes, prefer: Sequence[str]) -> list[list[str | None]]:
    """The cached cell values of one sheet of a workbook, as text."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        sheets = {s.get("name"): s.get(f"{{{_NS['r']}}}id") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{_NS['m']}}}sheet")}
        chosen = next((n for p in prefer for n in sheets if p in n), next(iter(sheets)))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        part = targets[sheets[chosen]].lstrip("/")
        rows = []
        for row in ElementTree.fromstring(z.read(part if part.startswith("xl/") else f"xl/{part}")).iter(f"{{{_NS['m']}}}row"):
            cells: dict[int, str | None] = {}
            for c in row.findall("m:c", _NS):
                letters = re.match(r"[A-Z]*", c.get("r") or "")[0]
                at = len(cells)
                if letters:
                    at = 0
                    for x in letters:
                        at = at * 26 + ord(x) - 64
                    at -= 1
                value = c.find("m:v", _NS)
                text = value.text if value is not None else None
                if c.get("t") == "s" and text is not None:
                    text = shared[int(text)]
                elif c.get("t") == "inlineStr":
                    text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                cells[at] = text
            rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
        return rows


def header_places(header: Sequence[str]) -> tuple[dict[str, int], dict[str, int]]:
    """Where the known fields and the other headers stand.

    Of a field's names, the first in ``HEADERS`` that the sheet has decides,
    whatever the order of columns; other names of fields are no statuses.
    """
    lower = [h.lower() for h in header]
    fields = {field: next((lower.index(a) for a in aliases if a in lower), -1) for field, aliases in HEADERS.items() if field}
    known = {a for aliases in HEADERS.values() for a in aliases}
    return {f: i for f, i in fields.items() if i >= 0}, {h: i for i, h in enumerate(header) if h and h.lower() not in known}


def _is_count(text: str | None) -> bool:
    return re.match(r"\s*[+-]?[0-9]", text or "0") is not None


def workbooks(spark: SparkSession, path: str | Sequence[str], prefer: Sequence[str] = SHEETS) -> DataFrame:
    """The rows of workbooks, given as a folder or as files; one for each officer,
    region and status.

    ``source_file``, ``modified``, ``row_no``, ``kab``, ``region``, ``username``,
    ``email``, ``role``, ``total``, ``status`` and ``count`` (text).  Headers are
    known by name; any other header is a status if all its cells are empty or
    start with a number, else the column is refused with its file.  Files are
    parsed in parallel, one at a time in a task.
    """
    fields = ["kab", "region", "username", "email", "role", "total"]

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file in frame.itertuples():
                rows = _sheet_rows(file.content, prefer)
                header = [(h or "").strip() for h in rows[0]] if rows else []
                places, statuses = header_places(header)
                cell = lambda row, i: row[i] if i is not None and i < len(row) else None
                wrong = [h for h, i in statuses.items() if not all(_is_count(cell(row, i)) for row in rows[1:])]
                if wrong:
                    raise ValueError(f"{file.path}: not counts: {wrong}")
                out = []
                for no, row in enumerate(rows[1:], 1):
                    own = [cell(row, places.get(f)) for f in fields]
                    out += [[file.path, file.modificationTime, no, *own, h, cell(row, i)] for h, i in statuses.items()]
                yield pd.DataFrame(out, columns=["source_file", "modified", "row_no", *fields, "status", "count"])

    schema = "source_file string, modified timestamp, row_no long, " + ", ".join(f"{f} string" for f in fields) + ", status string, count string"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path if isinstance(path, str) else list(path)).select("path", "modificationTime", "content")
    return files.mapInPandas(parse, schema)


def workbook_documents(rows: DataFrame) -> DataFrame:
    """Workbook rows as progress documents; the newest file that has an officer
    or a region decides, and totals of officers are unknown."""
    from ..functions.scalars import kab_of, leading_int, unquoted
    from ..operators.merge import first_seen

    clean = rows.where(F.trim(F.coalesce("username", F.lit(""))) != "").withColumns({
        "username": F.trim("username"),
        "region": unquoted(F.trim(F.coalesce("region", F.lit("")))),
        "order": F.struct((-F.unix_micros("modified")).alias("age"), "source_file", "row_no"),
    })
    clean = clean.withColumn("kab_code", F.coalesce(kab_of(F.col("region")), F.lit("00")))
    keys = ["username", "kab_code"]
    people = first_seen(clean.select(*keys, "email", "role", "kab", "order"), keys, ["order"]).drop("order")
    counts = clean.where("region <> ''").groupBy(*keys, "region", "order").agg(
        F.max(leading_int(F.col("total"))).alias("total"),
        F.array_sort(F.collect_list(F.struct(F.coalesce(F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status")), F.lit(0)).alias("at"), "status", leading_int(F.col("count")).alias("count")))).alias("b"),
    )
    first = first_seen(counts, [*keys, "region"], ["order"])
    breakdown = F.transform("b", lambda x: F.struct(x["status"].alias("status"), x["count"].alias("count")))
    nested = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("region").alias("regionCode"), F.col("total"), breakdown.alias("statusBreakdown")))).alias("regionSummary"))
    out = people.join(nested, keys, "left")
    return out.select("username", "email", F.coalesce("role", F.lit("Pencacah")).alias("roleName"), F.lit(None).cast("bigint").alias("total"), F.col("kab_code").alias("_kabKotaCode"), F.col("kab").alias("_kabKotaName"), "regionSummary")
