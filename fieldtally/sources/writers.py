"""Writing snapshots, grids and workbooks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import RESUME_KEYS
from .shared import Folder


def write_snapshot(df: DataFrame, root: str, version: str) -> str:
    """A new ``version=`` folder; earlier ones stay as backups.  An empty result
    writes nothing, so it can't replace a good one."""
    path = f"{root}/version={version}"
    if not df.isEmpty():
        df.write.mode("errorifexists").parquet(path)
    return path


def retained(files: DataFrame, keep: int = 30) -> DataFrame:
    """The newest files of a listing."""
    return files.orderBy(F.col("modified").desc(), F.col("path").desc()).limit(keep)


def expired(files: DataFrame, keep: int = 30) -> DataFrame:
    return files.join(retained(files, keep).select("path"), "path", "left_anti")


def retire(spark: SparkSession, root: str, keep: int = 30, prefix: str = "version=") -> list[str]:
    """Delete all but the newest ``keep`` of the folders or files of ``root`` whose
    names begin with ``prefix``; names order them, as those of versions do.  Each
    kind is counted by itself, so call it once for each."""
    folder = Folder(spark, root)
    old = [n for n in folder.names() if n.startswith(prefix)][:-keep or None]
    for name in old:
        folder.delete(name)
    return old


def add_finished(codes: DataFrame, path: str, at_once: int = 10_000) -> None:
    """Append region codes to a resume list; lists of up to about ``at_once`` codes,
    so a long one is no single row."""
    code = codes.columns[0]
    lists = codes.select(F.col(code).alias("code"), F.pmod(F.xxhash64(code), F.lit(1 + codes.count() // at_once)).alias("part"))
    lists.where("code is not null").groupBy("part").agg(F.array_sort(F.collect_set("code")).alias(RESUME_KEYS[0])).drop("part").write.mode("append").option("maxRecordsPerFile", 1).json(path)


def write_mark(marks: DataFrame, path: str) -> None:
    """Append what has been processed: ``last_processed`` (a time) or ``key``."""
    marks.write.mode("append").json(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_grid(df: DataFrame, path: str, rows_per_file: int = 10_000) -> None:
    """CSV files with a header, of a bounded number of rows each."""
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file).csv(path)


def _sheet(df: DataFrame, most: int) -> str:
    def cell(v) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"<c><v>{v}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    rows = ["".join(map(cell, df.columns))]
    taken = df.limit(most + 1).collect()
    if len(taken) > most:
        raise ValueError(f"a sheet holds {most} rows; write a grid instead")
    rows += ["".join(map(cell, r)) for r in taken]
    return '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + "".join(f"<row>{r}</row>" for r in rows) + "</sheetData></worksheet>"


def workbook(sheets: dict[str, DataFrame], most: int = 100_000) -> bytes:
    """A small report as a workbook of one sheet for each frame.

    A workbook is one file for people to open, so it is made on the driver and
    refuses more than ``most`` rows a sheet; ``write_grid`` takes any number.
    """
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack = "http://schemas.openxmlformats.org/package/2006"
    with zipfile.ZipFile(out := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
        ids = range(1, len(sheets) + 1)
        over = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in ids)
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{over}</Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in zip(ids, sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{pack}/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in ids) + "</Relationships>")
        for i, df in zip(ids, sheets.values()):
            z.writestr(f"xl/worksheets/sheet{i}.xml", _sheet(df, most))
    return out.getvalue()


def write_workbook(sheets: dict[str, DataFrame], path: str, most: int = 100_000) -> None:
    """``workbook`` as a file of any file system."""
    spark, (folder, _, name) = next(iter(sheets.values())).sparkSession, path.rpartition("/")
    Folder(spark, folder).write_bytes(name, workbook(sheets, most), replace=True)


def json_rows(df: DataFrame, n: int = 1000) -> list[str]:
    """Up to ``n`` rows as JSON texts, for a command's output."""
    return [r.row for r in df.select(F.to_json(F.struct("*")).alias("row")).take(n)]


def log_line(spark: SparkSession, path: str, level: str, text: str) -> None:
    """Append one line to a log table."""
    log_lines(spark, path, level, [text])


def log_lines(spark: SparkSession, path: str, level: str, texts: Sequence[str]) -> None:
    """Append the lines of one run, as one file."""
    lines = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    lines.select(F.current_timestamp().alias("at"), F.lit(level).alias("level"), "text").write.mode("append").json(path)
