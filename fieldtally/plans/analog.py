"""Survey tables simulated from the star-schema test tables.

The text runs in Spark and in DuckDB alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import SumRule
from ..operators.progress import nest
from ..statuses import STATUSES

_STATUS = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STATUSES))

ASSIGNMENT = f"""
SELECT CAST(o_orderkey AS STRING) AS assignment_id,
  concat('6', CAST(r_regionkey AS STRING)) AS level_1_full_code, r_name AS level_1_name,
  concat('6', CAST(r_regionkey AS STRING), lpad(CAST(n_nationkey AS STRING), 2, '0')) AS level_2_full_code, n_name AS level_2_name,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE concat('6', CAST(r_regionkey AS STRING), lpad(CAST(n_nationkey AS STRING), 2, '0'), lpad(CAST(c_custkey % 40 AS STRING), 12, '0')) END AS level_6_full_code,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat(lower(c_mktsegment), '@x') END AS current_user_username,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'Pengawas' ELSE 'Pencacah' END AS current_user_survey_role_name,
  CASE o_orderkey % 13 {_STATUS} ELSE 'ZZ EXTRA' END AS assignment_status_alias,
  o_orderdate AS date_modified, o_custkey AS household, o_orderkey AS seq
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

TABLES = ["orders", "customer", "nation", "region"]


def register(spark: SparkSession, sf_dir: str, tables: list[str]) -> None:
    """The tables as views."""
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, TABLES)
    return spark.sql(ASSIGNMENT)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress documents: one for each officer and kab, regions and statuses nested."""
    rows = assignments(spark, sf_dir).where("level_6_full_code is not null and current_user_username is not null")
    nested = nest(rows, ["level_2_full_code", "level_2_name", "current_user_username"], "level_6_full_code", "assignment_status_alias", F.count("*"))
    return nested.select(F.col("current_user_username").alias("username"), F.col("current_user_username").alias("email"), F.lit("Pencacah").alias("roleName"), "total", F.substring("level_2_full_code", 3, 2).alias("_kabKotaCode"), F.col("level_2_name").alias("_kabKotaName"), "regionSummary")


def _sum(*parts: tuple[str, int]) -> str:
    """Columns of small numbers, some null."""
    return ", ".join(f"CASE WHEN (o_orderkey + {n}) % 17 = 0 THEN NULL ELSE CAST((o_orderkey * {n} + o_custkey) % {40 + n} AS DOUBLE) END AS {c}" for c, n in parts)


def _total(name: str, wrong: int, *parts: str) -> str:
    """Their sum, off by one for some rows and null for others."""
    return f"CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {' + '.join(f'coalesce({c}, 0)' for c in parts)} + CASE WHEN o_orderkey % {wrong} = 0 THEN 1 ELSE 0 END END AS {name}"


_PARTS = ["tk_laki", "tk_pr", "tk_dibayar", "tk_tdk_dibayar", "gaji", "biaya_produksi", "biaya_pembelian", "operasional", "non_operasional", "nilai_pendapatan", "pendapatan_lain", "aset_usaha_thn", "aset_lain_thn"]
_MONTHLY = ["gaji_bln", "biaya_produksi_bln", "biaya_pembelian_bln", "operasional_bln", "non_operasional_bln", "nilai_pendapatan_bln", "pendapatan_lain_bln", "aset_tanah_bln", "aset_lain_bln"]
_SHARES = ["pribadi", "non_profit", "publik", "non_publik", "pemerintah", "asing"]
_STARTED = ["pribadi_didirikan", "nonprofit_didirikan", "publik_didirikan", "nonpublik_didirikan", "pemerintah_didirikan", "asing_didirikan"]

#: Businesses: the columns of the questionnaire's rules, with rows that break them.
BUSINESS = f"""SELECT *, {_total("total_tk_jk", 5, *_PARTS[:2])}, {_total("total_tk_bayar", 7, *_PARTS[2:4])}, {_total("total_pengeluaran", 6, *_PARTS[4:9])}, {_total("total_pendapatan", 8, *_PARTS[9:11])},
  {_total("total_aset_thn", 9, *_PARTS[11:])}, {_total("total_pengeluaran_bln", 10, *_MONTHLY[:5])}, {_total("total_pendapatan_bln", 11, *_MONTHLY[5:7])},
  CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE concat('Rp ', CAST(CAST(coalesce(aset_tanah_bln, 0) + coalesce(aset_lain_bln, 0) + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS STRING)) END AS total_aset_bln
FROM (SELECT o_orderkey AS assignment_id, o_orderkey, {_sum(*((c, i + 1) for i, c in enumerate(_PARTS + _MONTHLY)))},
  {", ".join(f"CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 6 = {i} THEN CASE WHEN o_custkey % 23 = 0 THEN 99 ELSE 100 END ELSE 0 END AS {c}" for i, c in enumerate(_SHARES))},
  {", ".join(f"CASE WHEN o_custkey % 6 = {i} THEN CASE WHEN o_orderkey % 29 = 0 THEN 90 ELSE 100 END END AS {c}" for i, c in enumerate(_STARTED))}
  FROM orders) AS b"""

#: Pay as numbers, and what their sum should be.
PAY = """SELECT o_orderkey AS assignment_id, o_custkey % 900 * 1000 AS pend_gaji, o_custkey % 7 * 500 AS tunjangan, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey % 11 * 100 END AS uangmkn,
  o_custkey % 2 * 250 AS honor, 0 AS lembur, CASE WHEN o_orderkey % 5 = 0 THEN 75 END AS lainnya, o_custkey % 900 * 1000 + o_custkey % 7 * 500 + o_custkey % 11 * 100 + o_custkey % 2 * 250 AS whole FROM orders"""


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ["orders"])
    return spark.sql(BUSINESS)


def pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the sum as people write it, dots between thousands and a decimal comma
    or not; a few aren't amounts."""
    register(spark, sf_dir, ["orders"])
    text = F.concat(F.lit("Rp "), F.translate(F.format_number(F.col("whole"), 0), ",", "."))
    shown = F.when(F.col("assignment_id") % 11 == 0, "unknown").when(F.col("assignment_id") % 4 == 0, F.concat(text, F.lit(",50"))).otherwise(text)
    return spark.sql(PAY).withColumn("nilai_pend_pekerjaan", shown)


def rule_sql(rule) -> str:
    """A rule's verdicts over ``business`` as SQL."""
    total = " + ".join(f"coalesce({c}, 0)" for c in rule.parts)
    if isinstance(rule, SumRule):
        stated = f"CAST(replace({rule.total}, 'Rp ', '') AS DOUBLE)" if rule.written else rule.total
        ok = f"CASE WHEN {rule.total} IS NOT NULL THEN abs({stated} - ({total})) <= {rule.tolerance} END"
    else:
        ok = f"CASE WHEN coalesce({', '.join(rule.parts)}) IS NOT NULL THEN abs({total} - {rule.value}) <= {rule.tolerance} END"
    return f"SELECT 'business' AS table_name, assignment_id, '{rule.name}' AS rule, {ok} AS ok FROM business"
