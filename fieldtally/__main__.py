"""python -m fieldtally COMMAND: the flows of ``plans.jobs`` on landed files."""

from __future__ import annotations

import argparse
import sys
import time
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .functions.scalars import code_list
from .plans import jobs
from .sources import readers, writers


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="fieldtally")
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("query", help="run a statement over the tables of a folder and print JSON rows")
    p.add_argument("sql")
    p.add_argument("--tables", default="", help="folder of NAME.parquet tables")
    p.add_argument("--names", default="", help="tables to register, separated by commas")
    p.add_argument("--limit", type=int, default=1000)
    p = commands.add_parser("snapshot", help="merge landed pages with the previous snapshot and write reports")
    p.add_argument("pages")
    p.add_argument("out")
    p.add_argument("--previous")
    p.add_argument("--kab", default="", help="codes, separated by commas; pages lie in folders kab=CODE if there are several")
    p.add_argument("--name", default="", help="the kab's name, or CODE=NAME for each, separated by commas")
    p.add_argument("--keep", type=int, default=30, help="how many snapshots stay")
    p = commands.add_parser("workbooks", help="the newest batch of workbooks as a snapshot with reports")
    p.add_argument("folder")
    p.add_argument("out")
    p.add_argument("--previous")
    p.add_argument("--force", action="store_true", help="take the newest batch again")
    p = commands.add_parser("sync-sqllab", help="fresh counts of some kabs from a table of assignments; other kabs stay")
    p.add_argument("assignments", help="folder of the assignment table")
    p.add_argument("out")
    p.add_argument("--kab", default="", help="codes, separated by commas; all without")
    p = commands.add_parser("respondents", help="take in landed respondent files, in folders region_code=CODE")
    p.add_argument("files")
    p.add_argument("out")
    p.add_argument("--table", help="the table that runs add to; beside the output without")
    p.add_argument("--regions", help="the dimension that the command regions wrote; all folders without")
    p.add_argument("--resume", help="resume list: regions in it are left out, those taken in are added")
    p = commands.add_parser("regions", help="expand landed region levels")
    p.add_argument("folder")
    p.add_argument("out")
    p.add_argument("--resume", help="resume list; regions in it are left out")
    for p in commands.choices.values():
        p.add_argument("--log", help="log table to append to")
        p.add_argument("--every", type=float, default=0, help="seconds after which the command runs again")
        p.add_argument("--times", type=int, default=1, help="how often it runs at the most, with --every; 0 for ever")
    a = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("fieldtally").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    n = 0
    while True:
        n += 1
        said = run(spark, a)
        for line in said:
            print(line, file=sys.stderr)
        if a.log:
            writers.log_lines(spark, a.log, "INFO", said)
        if not a.every or n == a.times:
            return 0
        time.sleep(a.every)


def run(spark: SparkSession, a: argparse.Namespace) -> list[str]:
    """One run of a command; what people should know of it."""
    version, said = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H-%M-%S"), [f"{a.command} is done"]
    previous = spark.read.parquet(a.previous) if getattr(a, "previous", None) else None
    if a.command == "query":
        readers.register(spark, a.tables, [t for t in a.names.split(",") if t])
        rows = writers.json_rows(readers.run_sql(spark, a.sql, a.limit + 1), a.limit + 1)
        print("[" + ",\n".join(rows[: a.limit]) + "]")
        if len(rows) > a.limit:
            said.append(f"only the first {a.limit} rows are shown; see --limit")
    elif a.command == "snapshot":
        kabs = code_list(a.kab)
        names = dict(n.split("=", 1) for n in a.name.split(",") if "=" in n) or ({k: a.name for k in kabs} if a.name else {})
        landed = jobs.landed_pages(spark, a.pages, kabs, names)
        said = jobs.said_of(landed) + said
        jobs.sync_snapshot(landed.documents, previous, a.out, version, a.keep)
    elif a.command == "workbooks":
        jobs.sync_new_workbooks(spark, a.folder, previous, a.out, version, force=a.force)
    elif a.command == "sync-sqllab":
        jobs.sync_assignments(spark.read.parquet(a.assignments), code_list(a.kab), a.out)
    elif a.command == "respondents":
        table = a.table or f"{a.out.rstrip('/')}-table"
        wanted, done = jobs.sync_respondents(spark, a.files, table, spark.read.parquet(a.regions) if a.regions else None, a.resume)
        writers.write_grid(jobs.respondents_of(spark, table), a.out)
        said.insert(0, f"{done} of {wanted} regions")
    else:
        jobs.remaining_regions(spark, jobs.region_dimension(spark, a.folder), a.resume).write.mode("overwrite").parquet(a.out)
    return said


if __name__ == "__main__":
    sys.exit(main())
