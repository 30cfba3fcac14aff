"""Consistency rules of the questionnaire, as one long table of results."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import amount


@dataclass(frozen=True)
class SumRule:
    """``total`` should equal the sum of ``parts`` within ``tolerance``; an amount
    that is kept as text (``written``) is read as people write it."""

    name: str
    total: str
    parts: tuple[str, ...]
    tolerance: float = 0.5
    written: bool = False


@dataclass(frozen=True)
class ConstantRule:
    """The sum of ``parts`` should be ``value`` where any of them is given."""

    name: str
    value: float
    parts: tuple[str, ...]
    tolerance: float = 0.01


# Column names of the questionnaire, in its order.
_COSTS = ("gaji", "biaya_produksi", "biaya_pembelian", "operasional", "non_operasional")
_OWNERS = ("pribadi", "non_profit", "publik", "non_publik", "pemerintah", "asing")
_FOUNDERS = ("pribadi_didirikan", "nonprofit_didirikan", "publik_didirikan", "nonpublik_didirikan", "pemerintah_didirikan", "asing_didirikan")

# The sums that the questionnaire's labels state.
BUSINESS_RULES: list[SumRule | ConstantRule] = [
    SumRule("workers_by_sex", "total_tk_jk", ("tk_laki", "tk_pr")),
    SumRule("workers_by_pay", "total_tk_bayar", ("tk_dibayar", "tk_tdk_dibayar")),
    SumRule("costs", "total_pengeluaran", _COSTS),
    SumRule("income", "total_pendapatan", ("nilai_pendapatan", "pendapatan_lain")),
    SumRule("assets", "total_aset_thn", ("aset_usaha_thn", "aset_lain_thn")),
    ConstantRule("ownership", 100, _OWNERS),
    SumRule("costs_month", "total_pengeluaran_bln", tuple(f"{c}_bln" for c in _COSTS)),
    SumRule("income_month", "total_pendapatan_bln", ("nilai_pendapatan_bln", "pendapatan_lain_bln")),
    SumRule("assets_month", "total_aset_bln", ("aset_tanah_bln", "aset_lain_bln"), written=True),
    ConstantRule("ownership_started", 100, _FOUNDERS),
]


def _amount(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))


def _verdict(rule: SumRule | ConstantRule) -> Column:
    total = sum((_amount(c) for c in rule.parts), F.lit(0.0))
    if isinstance(rule, SumRule):
        stated = amount(F.col(rule.total)) if rule.written else F.col(rule.total).try_cast("double")
        return F.when(stated.isNotNull(), F.abs(stated - total) <= rule.tolerance)
    given = F.coalesce(*(F.col(c).try_cast("double") for c in rule.parts)).isNotNull()
    return F.when(given, F.abs(total - rule.value) <= rule.tolerance)


def missing_columns(df: DataFrame, rules: Sequence[SumRule | ConstantRule]) -> dict[str, list[str]]:
    """The rules that a table can't be checked by, with the columns it lacks."""
    have = {c.lower() for c in df.columns}
    lacking = {r.name: [c for c in (*r.parts, *([r.total] if isinstance(r, SumRule) else [])) if c.lower() not in have] for r in rules}
    return {name: columns for name, columns in lacking.items() if columns}


def check(df: DataFrame, table: str, keys: Sequence[str], rules: Sequence[SumRule | ConstantRule]) -> DataFrame:
    """``table_name``, keys, ``rule`` and ``ok`` (null: not applicable), one row for
    each row and rule.

    Rules whose columns are missing are left out with a warning that names them
    (``missing_columns``); without any rule the result is empty.
    """
    lacking = missing_columns(df, rules)
    if lacking:
        warnings.warn(f"{table}: not checked for want of columns: {lacking}", stacklevel=2)
    verdicts = [F.struct(F.lit(r.name).alias("rule"), _verdict(r).alias("ok")) for r in rules if r.name not in lacking]
    results = F.explode(F.array(*verdicts).cast("array<struct<rule:string,ok:boolean>>")).alias("r")
    return df.select(F.lit(table).alias("table_name"), *keys, results).select("table_name", *keys, "r.rule", "r.ok")


def currency_sum_rule(df: DataFrame, keys: Sequence[str], total: str, parts: Sequence[str], tolerance: float = 0.005) -> DataFrame:
    """An amount against the sum of its parts, each a number or a text as people
    write amounts; a part that is none counts as 0, a total that is none gives null."""
    whole = sum((F.coalesce(amount(F.col(c)), F.lit(0.0)) for c in parts), F.lit(0.0))
    return df.select(*keys, (F.abs(amount(F.col(total)) - whole) <= tolerance).alias("ok"))


def roster_counts(header: DataFrame, roster: DataFrame, key: str, stated: str) -> DataFrame:
    """Stated against counted roster rows for each header row."""
    counts = roster.groupBy(key).agg(F.count("*").alias("counted"))
    joined = header.join(counts, key, "left").select(key, F.col(stated).cast("long").alias("stated"), F.coalesce("counted", F.lit(0)).alias("counted"))
    return joined.withColumn("ok", F.col("stated") == F.col("counted"))


def key_join(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("assignment_id", "index1"), how: str = "left") -> DataFrame:
    """Two of the survey's tables on their keys, with the keys of ``left``.

    A key that is text in one and a number in the other (``index1``) is compared
    as a whole number; a text that is none, or a null, matches nothing.  Columns
    of ``right`` that ``left`` has too end in ``_right``.
    """
    kinds = [(left.schema[k].dataType, right.schema[k].dataType) for k in keys]

    def values(df: DataFrame) -> DataFrame:
        return df.withColumns({f"_key{i}": F.col(k) if a == b else F.trim(F.col(k).cast("string")).try_cast("bigint") for i, (k, (a, b)) in enumerate(zip(keys, kinds))})

    have = {c.lower() for c in left.columns}
    other = values(right).drop(*keys)
    other = other.withColumnsRenamed({c: f"{c}_right" for c in other.columns if c.lower() in have})
    on = [f"_key{i}" for i in range(len(keys))]
    return values(left).join(other, on, how).drop(*on)


def changed_items(df: DataFrame, keys: Sequence[str], items: Sequence[str], suffix: str = "_new") -> DataFrame:
    """Prelisted against updated values of each item, where they differ."""
    pairs = F.explode(F.array(*(F.struct(F.lit(i).alias("item"), F.col(i).cast("string").alias("before"), F.col(i + suffix).cast("string").alias("after")) for i in items))).alias("i")
    return df.select(*keys, pairs).select(*keys, "i.*").where(~F.col("before").eqNullSafe(F.col("after")))


def anomalies(df: DataFrame, keys: Sequence[str], slots: Sequence[tuple[str, str]]) -> DataFrame:
    """Open and resolved anomaly slots, given as (explanation, resolved_at) columns."""
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("slot"), F.nullif(F.trim(F.col(e)), F.lit("")).alias("explanation"), F.col(r).isNotNull().alias("resolved")) for n, (e, r) in enumerate(slots, 1)))).alias("a")
    return df.select(*keys, each).select(*keys, "a.*").where("explanation is not null or resolved")


def mapping_ratio(variables: DataFrame, block: str = "block", column: str = "column_name") -> DataFrame:
    """For each block, how many variables have a column."""
    mapped = F.count(F.nullif(F.trim(F.col(column)), F.lit("")))
    return variables.groupBy(block).agg(F.count("*").alias("variables"), mapped.alias("mapped")).withColumn("ratio", F.col("mapped") / F.col("variables"))


def eav_pivot(answers: DataFrame, keys: Sequence[str], variables: Sequence[str], name: str = "data_key", value: str = "pair_value") -> DataFrame:
    """Multi-select answers as one column for each variable: 1 where the key has it."""
    return answers.groupBy(*keys).agg(*(F.max(F.when(F.col(name) == v, F.col(value))).alias(v) for v in variables))
