"""One query for each operator family over the test tables, and its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import checks, merge, nesting, progress, regions, respondents
from .plans import analog, jobs
from .sources import readers, shared, versions
from .statuses import STATUSES
from .streaming import incremental, keyed

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

_SEEN = [*STATUSES, "ZZ EXTRA"]
_WITH = f"WITH assignment AS ({analog.ASSIGNMENT}), doc AS (SELECT * FROM assignment WHERE level_6_full_code IS NOT NULL AND current_user_username IS NOT NULL)"
_count = lambda names: ", ".join(f"count(CASE WHEN assignment_status_alias = '{s}' THEN 1 END) AS \"{s}\"" for s in names)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_PROGRESS = f"""SELECT coalesce(level_2_name, '-') AS kab_name, level_6_full_code AS region_code, coalesce(current_user_username, '-') AS username,
  coalesce(current_user_username, '-') AS email, coalesce(current_user_survey_role_name, 'Pencacah') AS role, count(assignment_id) AS total, {_count(STATUSES)}
FROM assignment WHERE level_6_full_code IS NOT NULL GROUP BY level_2_name, level_6_full_code, current_user_username, current_user_survey_role_name"""


@query(f"{_WITH} {_PROGRESS}")
def progress_by_region_officer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.progress_by_region_officer(analog.assignments(spark, sf_dir))


@query(f"{_WITH} SELECT level_2_full_code, level_6_full_code, assignment_id FROM assignment ORDER BY level_2_full_code NULLS FIRST, level_6_full_code NULLS FIRST, assignment_id NULLS FIRST LIMIT 1000 OFFSET 1000")
def progress_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["level_2_full_code", "level_6_full_code", "assignment_id"]
    return progress.page(analog.assignments(spark, sf_dir).select(order), order, 1000, 1000)


@query(f"""{_WITH} SELECT level_2_name AS kab_name, level_6_full_code AS region_code, current_user_username AS username, current_user_username AS email, 'Pencacah' AS role, count(*) AS total, {_count(_SEEN)}
FROM doc GROUP BY level_2_name, level_6_full_code, current_user_username""")
def progress_wide_from_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    statuses = progress.status_values(analog.assignments(spark, sf_dir).where("level_6_full_code is not null and current_user_username is not null"), "assignment_status_alias")
    return progress.wide(analog.documents(spark, sf_dir), statuses)


@query(f"""{_WITH} SELECT level_2_name AS kab_name, current_user_username AS username, current_user_username AS email, 'Pencacah' AS role, count(DISTINCT level_6_full_code) AS n_regions, count(*) AS total, {_count(_SEEN)}
FROM doc GROUP BY level_2_name, current_user_username""")
def officer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.officer_summary(analog.documents(spark, sf_dir), _SEEN)


@query(f"""{_WITH} SELECT level_2_name AS kab_name, level_6_full_code AS region_code, current_user_username AS username, assignment_status_alias AS status, count(*) AS "count"
FROM doc GROUP BY level_2_name, level_6_full_code, current_user_username, assignment_status_alias""")
def progress_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.long(analog.documents(spark, sf_dir))


@query(f"""{_WITH}, g AS (SELECT level_2_name AS kab_name, level_6_full_code AS region_code, current_user_username AS username, {_count(STATUSES)} FROM doc GROUP BY 1, 2, 3)
SELECT kab_name, region_code, username, status, "count" FROM g UNPIVOT ("count" FOR status IN ({", ".join(f'"{s}"' for s in STATUSES)}))""")
def unpivot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = progress.wide(analog.documents(spark, sf_dir), STATUSES)
    return progress.unpivot_statuses(grid, ["kab_name", "region_code", "username"], STATUSES)


_SNAPSHOTS = """, old AS (SELECT level_2_full_code AS kab, current_user_username AS username, count(*) AS total FROM doc GROUP BY 1, 2),
new AS (SELECT level_2_full_code AS kab, current_user_username AS username, count(*) * 10 AS total FROM doc WHERE substr(level_2_full_code, 4, 1) < '5' GROUP BY 1, 2)"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = analog.assignments(spark, sf_dir).where("level_6_full_code is not null and current_user_username is not null")
    keys = [F.col("level_2_full_code").alias("kab"), F.col("current_user_username").alias("username")]
    old = rows.groupBy(*keys).agg(F.count("*").alias("total"))
    new = rows.where(F.substring("level_2_full_code", 4, 1) < "5").groupBy(*keys).agg((F.count("*") * 10).alias("total"))
    return old, new


@query(f"{_WITH}{_SNAPSHOTS} SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.kab = old.kab AND new.username = old.username)")
def fallback_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return merge.fallback_patch(new, old, ["kab", "username"])


@query(f"""{_WITH}{_SNAPSHOTS}, merged AS (SELECT * FROM old WHERE kab <> '6001' UNION ALL SELECT * FROM new WHERE kab = '6001')
SELECT *, row_number() OVER (ORDER BY kab, username) AS no FROM merged""")
def selective_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    merged = merge.selective_merge(old, new.where("kab = '6001'"), "kab", "6001")
    return progress.numbered(merged, "kab", ["username"])


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def dedupe_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return merge.first_seen(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"""{_WITH}, part AS (SELECT *, seq % 3 AS file_rank FROM doc),
people AS (SELECT username, kab, role FROM (SELECT current_user_username AS username, level_2_full_code AS kab, current_user_survey_role_name AS role, row_number() OVER (PARTITION BY current_user_username, level_2_full_code ORDER BY file_rank, seq) AS rn FROM part) WHERE rn = 1),
places AS (SELECT username, kab, region, status FROM (SELECT current_user_username AS username, level_2_full_code AS kab, level_6_full_code AS region, assignment_status_alias AS status, row_number() OVER (PARTITION BY current_user_username, level_2_full_code, level_6_full_code ORDER BY file_rank, seq) AS rn FROM part) WHERE rn = 1)
SELECT p.username, p.kab, p.region, p.status, q.role FROM places p JOIN people q ON p.username = q.username AND p.kab = q.kab""")
def multi_part_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = analog.assignments(spark, sf_dir).where("level_6_full_code is not null")
    parts = rows.select(F.col("current_user_username").alias("username"), F.col("level_2_full_code").alias("kab"), F.col("level_6_full_code").alias("region"), F.col("assignment_status_alias").alias("status"), F.col("current_user_survey_role_name").alias("role"), (F.col("seq") % 3).alias("file_rank"), "seq")
    return merge.merge_parts(parts, ["username", "kab"], ["role"], "region", ["status"], ["file_rank", "seq"])


@query("SELECT event_id, event_type FROM events WHERE epoch_us(ts) >= (SELECT max(epoch_us(ts)) FROM events) - 7200000000")
def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.latest_batch(_table(spark, sf_dir, "events"), "ts").select("event_id", "event_type")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 30")
def retain_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.newest(_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 30)


@query("""WITH RECURSIVE node AS (SELECT 'r' || r_regionkey AS code, r_name AS name, NULL AS parent FROM region
  UNION ALL SELECT 'n' || n_nationkey, n_name, 'r' || n_regionkey FROM nation
  UNION ALL SELECT 's' || s_suppkey, s_name, 'n' || s_nationkey FROM supplier),
t AS (SELECT code, name, 1 AS level, name AS path FROM node WHERE parent IS NULL
  UNION ALL SELECT n.code, n.name, t.level + 1, t.path || ' / ' || n.name FROM node n JOIN t ON n.parent = t.code)
SELECT code, name, level, path FROM t""")
def region_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    def level(table: str, mark: str, key: str, name: str, parent) -> DataFrame:
        return _table(spark, sf_dir, table).select(F.concat(F.lit(mark), F.col(key).cast("string")).alias("code"), F.col(name).alias("name"), parent.cast("string").alias("parent"))

    nodes = level("region", "r", "r_regionkey", "r_name", F.lit(None)).unionByName(level("nation", "n", "n_nationkey", "n_name", F.concat(F.lit("r"), "n_regionkey"))).unionByName(level("supplier", "s", "s_suppkey", "s_name", F.concat(F.lit("n"), "s_nationkey")))
    return regions.tree(nodes)


@query("""SELECT CAST(c_custkey AS STRING) AS id, c_name AS name, CAST(n_nationkey AS STRING) AS desa_id, n_name AS desa_name, CAST(r_regionkey AS STRING) AS kec_id, r_name AS kec_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def region_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    def level(table: str, key: str, name: str, parent: str | None) -> DataFrame:
        return _table(spark, sf_dir, table).select(F.col(key).cast("string").alias("id"), F.col(key).cast("string").alias("fullCode"), F.col(name).alias("name"), (F.col(parent) if parent else F.lit(None)).cast("string").alias("parentFullCode"))

    nation = level("nation", "n_nationkey", "n_name", "n_regionkey")
    sls = nation.withColumn("parentFullCode", F.col("fullCode"))
    flat = regions.expand(level("region", "r_regionkey", "r_name", None), nation, sls, level("customer", "c_custkey", "c_name", "c_nationkey"))
    return flat.select("id", "name", F.col("desaId").alias("desa_id"), F.col("desaName").alias("desa_name"), F.col("kecId").alias("kec_id"), F.col("kecName").alias("kec_name"))


@query(f"{_WITH} SELECT level_1_full_code, level_2_full_code, level_6_full_code, count(*) AS n FROM doc GROUP BY ROLLUP (level_1_full_code, level_2_full_code, level_6_full_code)")
def region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = analog.assignments(spark, sf_dir).where("level_6_full_code is not null and current_user_username is not null")
    return regions.rollup(rows, ["level_1_full_code", "level_2_full_code", "level_6_full_code"])


_RESPONDENT = """SELECT CAST(c_custkey AS STRING) AS id, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN '1. Ya' WHEN c_custkey % 3 = 1 THEN '2. Tidak' END AS data9,
  c_name, concat('Jl. ', c_name) AS c_address, c_mktsegment, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('L6-', c_custkey) END AS six, concat('L5-', c_custkey % 10) AS five, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer").join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("c_custkey")
    named = lambda name, **deeper: F.struct(name.cast("string").alias("name"), *(v.alias(k) for k, v in deeper.items()))
    six = F.when(key % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("L6-"), key))
    tree = named(F.lit("prov"), level2=named(F.col("r_name"), level3=named(F.col("n_name"), level4=named(F.col("c_mktsegment"), level5=named(F.concat(F.lit("L5-"), key % 10), level6=named(six))))))
    found = F.when(key % 7 == 0, "").when(key % 3 == 0, "1. Ya").when(key % 3 == 1, "2. Tidak")
    null = F.lit(None).cast("string")
    return c.select(key.cast("string").alias("id"), null.alias("codeIdentity"), F.col("c_name").alias("data1"), F.concat(F.lit("Jl. "), "c_name").alias("data2"), F.col("c_mktsegment").alias("data6"), found.alias("data9"), null.alias("assignmentStatusAlias"), null.alias("currentUserFullname"), null.alias("currentUserUsername"), F.lit("").alias("latitude"), null.alias("longitude"), F.struct(tree.alias("level1")).alias("region"))


@query(f"""WITH r AS ({_RESPONDENT}) SELECT r_name AS kab, n_name AS kec, c_mktsegment AS desa, coalesce(six, five) AS place, id, '-' AS code_identity, coalesce(nullif(c_name, ''), '-') AS name,
  coalesce(nullif(c_address, ''), '-') AS address, c_mktsegment AS kind, coalesce(nullif(data9, ''), 'Belum diisi') AS found, '-' AS status, '-' AS officer, '-' AS username, '-' AS latitude, '-' AS longitude FROM r""")
def respondent_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return respondents.flatten(_respondents(spark, sf_dir))


@query(f"""WITH r AS ({_RESPONDENT}) SELECT r_name AS kab, CASE WHEN data9 = '1. Ya' THEN 'found' WHEN data9 = '2. Tidak' THEN 'not found' WHEN coalesce(data9, '') = '' THEN 'not filled' ELSE 'other' END AS found_status, count(*) AS n FROM r GROUP BY 1, 2""")
def found_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _respondents(spark, sf_dir).select(F.col("region.level1.level2.name").alias("kab"), "data9")
    return respondents.found_counts(rows, ["kab"], "data9")


@query("""WITH i AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN concat('6104 - ', o_custkey) ELSE concat(lpad(CAST(o_custkey AS STRING), 16, '6'), ' - UMK - ', o_orderkey % 9) END AS c FROM orders)
SELECT o_orderkey, nullif(split_part(c, ' - ', 1), '') AS region, nullif(split_part(c, ' - ', 2), '') AS kind, nullif(split_part(c, ' - ', 3), '') AS number, length(split_part(c, ' - ', 1)) = 16 AS is_field FROM i""")
def code_identity_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    c = F.when(key % 4 == 0, F.concat(F.lit("6104 - "), "o_custkey")).otherwise(F.concat(F.lpad(F.col("o_custkey").cast("string"), 16, "6"), F.lit(" - UMK - "), key % 9))
    return _table(spark, sf_dir, "orders").select("o_orderkey", S.code_identity_parts(c).alias("p")).select("o_orderkey", "p.*")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE CASE WHEN o_orderkey % 2 = 1 THEN -1 ELSE 1 END * CAST(CAST(floor(o_totalprice) AS BIGINT) + 1000 + CASE WHEN o_orderkey % 3 = 1 THEN 0.5 ELSE 0 END AS DOUBLE) END AS amount FROM orders")
def currency_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as people write them: dots between thousands, decimal commas, signs on
    either side of "Rp", plain numbers, and texts that are none."""
    whole = "CAST(floor(o_totalprice) AS BIGINT) + 1000"
    dotted = f"translate(format_number({whole}, 0), ',', '.')"
    text = f"""CASE o_orderkey % 6 WHEN 0 THEN concat('Rp ', {dotted}) WHEN 1 THEN concat('-Rp', {dotted}, ',50') WHEN 2 THEN concat(' rp. ', {dotted}, ',-')
      WHEN 3 THEN concat('Rp -', {dotted}) WHEN 4 THEN concat(CAST({whole} AS STRING), '.5') ELSE concat({dotted}, ' or so') END"""
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.expr(text).alias("t")).select("o_orderkey", S.amount(F.col("t")).alias("amount"))


@query("""SELECT p_partkey, concat('A, ', p_brand) AS label, CAST(p_partkey % 10 AS STRING) AS value FROM part UNION ALL SELECT p_partkey, p_type, CAST(p_size AS STRING) FROM part""")
def label_value_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("[{label=A, "), "p_brand", F.lit(", value="), (F.col("p_partkey") % 10).cast("string"), F.lit("}, {label="), "p_type", F.lit(", value="), F.col("p_size").cast("string"), F.lit("}]"))
    return _table(spark, sf_dir, "part").select("p_partkey", F.explode(S.label_value_list(text)).alias("e")).select("p_partkey", "e.label", "e.value")


@query("""SELECT l_orderkey, max(CASE WHEN l_returnflag = 'A' THEN l_linestatus END) AS "A", max(CASE WHEN l_returnflag = 'N' THEN l_linestatus END) AS "N", max(CASE WHEN l_returnflag = 'R' THEN l_linestatus END) AS "R" FROM lineitem GROUP BY l_orderkey""")
def eav_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.eav_pivot(_table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["A", "N", "R"], "l_returnflag", "l_linestatus")


@query("""SELECT o_orderkey, CAST(o_custkey % 7 AS BIGINT) AS stated, coalesce(n, 0) AS counted, o_custkey % 7 = coalesce(n, 0) AS ok FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def roster_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = _table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 7).alias("stated"))
    return checks.roster_counts(header, _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "stated")


@query("SELECT o_orderkey AS assignment_id, CAST(o_custkey % 7 AS VARCHAR) AS index1, o_orderpriority, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = o_custkey % 7")
def key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("assignment_id"), (F.col("o_custkey") % 7).cast("string").alias("index1"), "o_orderpriority")
    return checks.key_join(left, _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("assignment_id"), F.col("l_linenumber").alias("index1"), "l_quantity"))


@query("""SELECT 'lineitem' AS table_name, l_orderkey, l_linenumber, 'parts' AS rule, abs(l_quantity - (l_linenumber + l_suppkey)) <= 0.5 AS ok FROM lineitem
UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber, 'whole', abs(l_discount + l_tax - 0.1) <= 0.01001 FROM lineitem""")
def dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [checks.SumRule("parts", "l_quantity", ("l_linenumber", "l_suppkey")), checks.ConstantRule("whole", 0.1, ("l_discount", "l_tax"), 0.01001)]
    return checks.check(_table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"], rules)


@query("SELECT c_custkey AS o_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def anti_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order."""
    found = _table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return merge.missing_codes(_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey")), found, "o_custkey")


_BUSINESS_SQL = " UNION ALL ".join(analog.rule_sql(r) for r in checks.BUSINESS_RULES)


@query(f"WITH business AS ({analog.BUSINESS}) {_BUSINESS_SQL}")
def questionnaire_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The questionnaire's own rules (D1-D10) over a simulated business table."""
    return checks.check(analog.business(spark, sf_dir), "business", ["assignment_id"], checks.BUSINESS_RULES)


_PAY = ("pend_gaji", "tunjangan", "uangmkn", "honor", "lembur", "lainnya")


@query(f"WITH pay AS ({analog.PAY}) SELECT assignment_id, CASE WHEN assignment_id % 11 <> 0 THEN abs({' + '.join(f'coalesce({c}, 0)' for c in _PAY)} - (whole + CASE WHEN assignment_id % 4 = 0 THEN 0.5 ELSE 0 END)) <= 0.005 END AS ok FROM pay")
def currency_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay as an amount in words of people against the sum of its parts."""
    return checks.currency_sum_rule(analog.pay(spark, sf_dir), ["assignment_id"], "nilai_pend_pekerjaan", _PAY)


@query("""SELECT * FROM (SELECT o_orderkey, 'motor' AS item, CAST(o_custkey % 3 AS VARCHAR) AS before, CAST(o_orderkey % 3 AS VARCHAR) AS after FROM orders
UNION ALL SELECT o_orderkey, 'mobil', CAST(nullif(o_custkey % 5, 0) AS VARCHAR), CAST(nullif(o_orderkey % 5, 0) AS VARCHAR) FROM orders) WHERE before IS DISTINCT FROM after""")
def changed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prelisted against updated counts, null where there is none."""
    rows = _table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey % 3 AS motor", "o_orderkey % 3 AS motor_new", "nullif(o_custkey % 5, 0) AS mobil", "nullif(o_orderkey % 5, 0) AS mobil_new")
    return checks.changed_items(rows, ["o_orderkey"], ["motor", "mobil"])


@query("""SELECT * FROM (SELECT o_orderkey, 1 AS slot, CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority END AS explanation, o_custkey % 11 = 0 AS resolved FROM orders
UNION ALL SELECT o_orderkey, 2, CASE WHEN o_orderkey % 5 = 0 THEN 'why' END, o_custkey % 13 = 0 FROM orders) WHERE explanation IS NOT NULL OR resolved""")
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots with an explanation, or resolved."""
    rows = _table(spark, sf_dir, "orders").selectExpr("o_orderkey", "if(o_orderkey % 7 = 0, o_orderpriority, ' ') AS e1", "if(o_custkey % 11 = 0, '2026', null) AS r1", "if(o_orderkey % 5 = 0, ' why', null) AS e2", "if(o_custkey % 13 = 0, '2026', null) AS r2")
    return checks.anomalies(rows, ["o_orderkey"], [("e1", "r1"), ("e2", "r2")])


@query("SELECT p_brand AS block, count(*) AS variables, count(CASE WHEN p_partkey % 3 > 0 THEN 1 END) AS mapped, count(CASE WHEN p_partkey % 3 > 0 THEN 1 END) / count(*) AS ratio FROM part GROUP BY p_brand")
def mapping_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many variables of a block have a column."""
    return checks.mapping_ratio(_table(spark, sf_dir, "part").selectExpr("p_brand AS block", "if(p_partkey % 3 > 0, p_name, ' ') AS column_name"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey WHEN 2 THEN -o_custkey ELSE 0 END AS n FROM orders")
def leading_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that cells hold as text, with and without something after them."""
    text = "CASE o_orderkey % 4 WHEN 0 THEN concat(o_custkey, ' rows') WHEN 1 THEN concat(' ', o_custkey, '.7') WHEN 2 THEN concat('-', o_custkey) ELSE 'none' END"
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.expr(text).alias("t")).select("o_orderkey", S.leading_int(F.col("t")).alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 4 < 3 THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS at FROM events")
def any_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three spellings of a time, and a text that is none."""
    forms = "CASE event_id % 4 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN 1 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") WHEN 2 THEN concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '.000Z') ELSE 'soon' END"
    return _table(spark, sf_dir, "events").select("event_id", F.expr(forms).alias("t")).select("event_id", S.any_timestamp(F.col("t")).alias("at"))


@query(f"{_WITH} SELECT count(*) AS officers, CAST(sum(n) AS BIGINT) AS regions FROM (SELECT count(DISTINCT level_6_full_code) AS n FROM doc GROUP BY level_2_full_code, current_user_username)")
def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.totals(analog.documents(spark, sf_dir))


@query("SELECT o_custkey, CAST(floor(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) / count(*) * 100 + 0.5) AS BIGINT) AS percent FROM orders GROUP BY o_custkey")
def percent_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count("*").alias("n"))
    return n.select("o_custkey", progress.percent_done(F.col("done"), F.col("n")).alias("percent"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0) ORDER BY c_custkey")
def resume_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """work that isn't on the list of what is finished."""
    done = _table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return merge.not_done(_table(spark, sf_dir, "customer").select("c_custkey", "c_name"), done, "c_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def respondents_of_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of given regions, by their codes."""
    some = _table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return respondents.of_regions(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), some, "o_custkey", "c_custkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND coalesce(nullif(l_linenumber % 4, 0) - 2, -1) < 0")
def target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """targets without an error."""
    rows = _table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "if(l_returnflag = 'R', '1', '0') AS is_target", "nullif(l_linenumber % 4, 0) - 2 AS error")
    return merge.targets(rows, error_status="error").select("l_orderkey", "l_linenumber")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= 12")
def capped_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions that reach the service's row limit, here of 12."""
    return readers.capped_regions(_table(spark, sf_dir, "orders"), "o_custkey", 12)


@query("SELECT count(*) AS expected, count(o_custkey) AS succeeded, count(*) - count(o_custkey) AS missing FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON o_custkey = c_custkey")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.completeness(_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


@query(f"{_WITH} SELECT assignment_id, level_6_full_code FROM assignment WHERE length(level_6_full_code) >= 4 AND substr(level_6_full_code, 3, 2) IN ('04', '15')")
def kab_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = analog.assignments(spark, sf_dir).select("assignment_id", "level_6_full_code")
    return merge.selected_kabs(rows, "level_6_full_code", S.code_list("04, 15"))


@query("SELECT p_type AS kategori, count(*) AS n FROM part GROUP BY p_type")
def kategori_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    _table(spark, sf_dir, "part").createOrReplaceTempView("part")
    return readers.run_sql(spark, "SELECT p_type AS kategori, count(*) AS n FROM part GROUP BY p_type", limit=None)


@query("SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.windowed_counts(_table(spark, sf_dir, "events"), "ts", ["event_type"]).select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT event_type, count(*) AS n, CAST(0 AS BIGINT) AS again FROM events GROUP BY event_type")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of what one run took in, and the rows of a second run (none)."""
    base = shared.new_folder(spark, "resume")
    schema = _table(spark, sf_dir, "events").schema
    runs = [incremental.run_available(incremental.parquet_stream(spark, sf_dir, schema, "events.parquet"), incremental.append_to(f"{base}/out"), f"{base}/state") for _ in range(2)]
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n")).withColumn("again", F.lit(runs[1]).cast("long"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user, as three batches come, one of them twice."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    table = keyed.KeyedTable(spark, shared.new_folder(spark, "keyed"), ["user_id"], ["ts", "event_id"], buckets=16, most_deltas=2)
    for number in (0, 1, 1, 2):
        table.merge(events.where(F.col("event_id") % 3 == 2 - number), number)
    return table.read().select("user_id", "event_id", "event_type")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that come again in two later batches, one of them after a restart,
    are there once."""
    base = shared.new_folder(spark, "first-seen")
    events = _table(spark, sf_dir, "events")
    stream = lambda: incremental.first_in_stream(incremental.parquet_stream(spark, f"{base}/in", events.schema), ["event_id"], "ts", "60 days")
    run = lambda: incremental.run_available(stream(), incremental.append_to(f"{base}/out"), f"{base}/state")
    for part in (events.where("event_id % 2 = 0"), events.where("event_id % 3 = 0"), events):
        part.write.mode("append").parquet(f"{base}/in")
        run()
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type")


@query("""WITH e AS (SELECT event_type, user_id, ts, lag(ts) OVER (PARTITION BY event_type, user_id ORDER BY ts) AS before FROM events),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 12 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY event_type, user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM e)
SELECT event_type, user_id, min(ts) AS start, max(ts) + INTERVAL 12 HOUR AS until, count(*) AS n FROM s GROUP BY event_type, user_id, session""")
def session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of event time."""
    found = incremental.session_counts(_table(spark, sf_dir, "events"), "ts", ["event_type", "user_id"], "12 hours")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "until")})


_PLACES = "SELECT c_custkey, CAST(r_regionkey AS STRING) AS l1, CAST(n_nationkey AS STRING) AS l2, CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_mktsegment END AS l3 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_CUT = f"""WITH p AS ({_PLACES}), c AS (SELECT *, count(*) OVER (PARTITION BY l1) AS n1, count(*) OVER (PARTITION BY l1, l2) AS n2, count(*) OVER (PARTITION BY l1, l2, l3) AS n3, greatest(2, (SELECT count(*) FROM customer) // 24) AS cap FROM p),
f AS (SELECT *, CASE WHEN n1 < cap THEN 1 WHEN n2 < cap THEN 2 ELSE 3 END AS level FROM c)"""


def _places(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    analog.register(spark, sf_dir, ["customer", "nation", "region"])
    rows = spark.sql(_PLACES)
    return rows, max(2, _table(spark, sf_dir, "customer").count() // 24)


@query(f"{_CUT} SELECT level, l1, CASE WHEN level > 1 THEN l2 END AS l2, CASE WHEN level > 2 THEN l3 END AS l3, count(*) AS n, count(*) >= any_value(cap) AS over FROM f GROUP BY ALL")
def region_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coarsest regions that the service's row limit lets through."""
    rows, cap = _places(spark, sf_dir)
    return regions.frontier(rows, ["l1", "l2", "l3"], cap)


@query(f"{_CUT} SELECT c_custkey, level AS region_level, CASE level WHEN 1 THEN n1 WHEN 2 THEN n2 ELSE n3 END AS region_n FROM f")
def rows_by_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row is in one of these regions."""
    rows, cap = _places(spark, sf_dir)
    return regions.by_frontier(rows, ["l1", "l2", "l3"], cap).select("c_custkey", "region_level", "region_n")


@query("""WITH old AS (SELECT o_orderkey, o_totalprice, nullif(o_custkey % 5, 0) AS x FROM orders WHERE o_orderkey % 7 <> 0),
new AS (SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS o_totalprice, CASE WHEN o_orderkey % 4 > 0 THEN nullif(o_custkey % 5, 0) END AS x FROM orders WHERE o_orderkey % 5 <> 0)
SELECT * FROM (SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'removed'
  WHEN o.o_totalprice <> n.o_totalprice OR o.x IS DISTINCT FROM n.x THEN 'changed' END AS change FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey) WHERE change IS NOT NULL""")
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two written versions."""
    orders = _table(spark, sf_dir, "orders")
    table = versions.Snapshots(spark, shared.new_folder(spark, "snapshots"))
    first = table.write(orders.where("o_orderkey % 7 <> 0").selectExpr("o_orderkey", "o_totalprice", "nullif(o_custkey % 5, 0) AS x"))
    second = table.write(orders.where("o_orderkey % 5 <> 0").selectExpr("o_orderkey", "o_totalprice + if(o_orderkey % 3 = 0, 1, 0) AS o_totalprice", "if(o_orderkey % 4 > 0, nullif(o_custkey % 5, 0), null) AS x"))
    return table.changes(first, second, ["o_orderkey"])


@query("""SELECT event_id, user_id, event_type, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ended,
  (epoch_us(coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '2024-02-01')) - epoch_us(ts)) / 1e6 AS seconds FROM events WHERE event_type <> 'error'""")
def status_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.6: how long each status held, open ones until a given time."""
    events = _table(spark, sf_dir, "events").withColumn("status", F.when(F.col("event_type") == "error", F.concat(F.lit("ASSIGNED TO: "), F.col("user_id"))).otherwise(F.col("event_type")))
    end = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    found = progress.durations(events, ["user_id"], "status", "ts", "event_id", end)
    return found.select("event_id", "user_id", "event_type", F.when(F.col("ended") != end, F.col("ended")).alias("ended"), "seconds")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber % 3 AS index1, count(*) AS n, min(l_quantity) AS least FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey AS assignment_id, o_orderstatus AS status, coalesce(count(b.n), 0) AS n_businesses, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS n_branches,
  coalesce(string_agg(b.index1 || ':' || b.n || ':' || CAST(b.least AS INTEGER), ',' ORDER BY b.index1), '') AS shape
FROM orders LEFT JOIN b ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus""")
def nested_repeaters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms with their businesses and their branches, from tables that lie
    side by side; here each form's tree is shown as text."""
    lines = _table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS assignment_id", "cast(l_linenumber % 3 AS string) AS index1", "l_linenumber AS index2", "l_quantity")
    frames = {"forms": _table(spark, sf_dir, "orders").selectExpr("o_orderkey AS assignment_id", "o_orderstatus AS status"), "businesses": lines.select("assignment_id", "index1").distinct(), "branches": lines}
    base, name = shared.new_folder(spark, "nested"), f"fieldtally_{uuid.uuid4().hex}"
    tables = [nesting.colocate(df, f"{name}_{k}", ["assignment_id"], 8, f"{base}/{k}") for k, df in frames.items()]
    found = nesting.nested(*tables)
    shape = F.transform("businesses", lambda b: F.concat_ws(":", b["index1"], F.size(b["branches"]), F.array_min(F.transform(b["branches"], lambda x: x["l_quantity"])).cast("int")))
    count = F.aggregate("businesses", F.lit(0).cast("long"), lambda n, b: n + F.size(b["branches"]))
    return found.select("assignment_id", "status", F.size("businesses").cast("long").alias("n_businesses"), count.alias("n_branches"), F.concat_ws(",", shape).alias("shape"))


@query(f"""{_WITH}, changed AS (SELECT level_2_name, level_6_full_code, current_user_username, current_user_survey_role_name, assignment_id, level_2_full_code,
  CASE WHEN level_2_full_code LIKE '61%' THEN 'DRAFT' ELSE assignment_status_alias END AS s FROM assignment WHERE level_6_full_code IS NOT NULL)
SELECT substr(level_6_full_code, 1, 4) AS level_2_full_code, level_6_full_code AS region_code, coalesce(current_user_username, '-') AS username, coalesce(current_user_survey_role_name, 'Pencacah') AS role, count(assignment_id) AS total, count(CASE WHEN s = 'DRAFT' THEN 1 END) AS draft, count(CASE WHEN s = 'OPEN' THEN 1 END) AS open
FROM changed GROUP BY level_2_name, level_6_full_code, current_user_username, current_user_survey_role_name""")
def sync_two_provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: fresh counts of one province's kabs, and those of the same number in others
    stay."""
    path, rows = shared.new_folder(spark, "counts"), analog.assignments(spark, sf_dir)
    jobs.sync_assignments(rows, [], path)
    fresh = rows.where("level_2_full_code LIKE '61%'").withColumn("assignment_status_alias", F.lit("DRAFT"))
    jobs.sync_assignments(fresh, S.code_list(",".join(f"{i}" for i in range(25))), path)
    return readers.counts(spark, path).select("level_2_full_code", "region_code", "username", "role", "total", F.col("DRAFT").alias("draft"), F.col("OPEN").alias("open"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
