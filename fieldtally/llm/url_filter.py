"""URL rules found through their rarest literal token; built-in functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The most rules that are put into the plan as a literal; more are joined.
INLINE_RULES = 500


@dataclass(frozen=True)
class Rule:
    """``host`` fits itself and all its subdomains; ``path`` is a prefix in which
    ``*`` stands for any characters."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    @property
    def regex(self) -> str:
        path = ".*".join(re.escape(p) for p in self.path.split("*"))
        return rf"(?s)\A(?:[^/?#]*\.)?{re.escape(self.host.lower())}(?:\z|(?=/)){path}"

    @property
    def tokens(self) -> list[str]:
        """Runs of ASCII letters and digits that a fitting URL has whole: one
        that the prefix or a ``*`` ends may go on in the URL and is left out."""
        host = re.findall(r"[A-Za-z0-9]+", self.host.lower())
        path = [m[0] for m in re.finditer(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])", self.path)]
        return [*host, *path]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.concat_ws("/", host, path), "[^A-Za-z0-9]+"), lambda t: t != ""))


def rarest_tokens(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> dict[Rule, str]:
    """For each rule, the literal token that the fewest of all URLs have; ''
    for a rule without one.

    Counted over every row; only tokens of rules are kept, so what comes back
    is bounded by the rules.
    """
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {r: "" for r in rules}
    seen = pages.select(F.explode(_tokens(host_of(F.col(url_col)), path_of(F.col(url_col)))).alias("token"))
    if len(wanted) <= INLINE_RULES:
        seen = seen.where(F.col("token").isin(wanted))
    else:
        seen = seen.join(pages.sparkSession.createDataFrame([(t,) for t in wanted], "token string"), "token", "left_semi")
    counts = {row.token: row.n for row in seen.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {r: min(r.tokens, key=lambda t: (counts.get(t, 0), t), default="") for r in rules}


def url_filter(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """For each row: ``id_col``, ``host``, ``path``, ``rule`` and ``verdict``.

    A URL's tokens fetch the rules indexed by them and only those run their
    regular expressions; of the fitting rules the longest decides (then the
    lesser name); without one, ``rule`` is null and ``default`` the verdict.

    Up to ``INLINE_RULES`` rules stand in the plan as a literal index and no row
    moves.  With more, the rules join the exploded tokens of distinct (host,
    path) pairs, so a URL that repeats on many rows is judged once.

    A null URL, or one without ``://``, has an empty host and path and fits no
    rule.  Null ids, repeated rows and other columns do no harm; an empty table
    gives an empty result.
    """
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    index = rarest_tokens(pages, rules, url_col)
    key = lambda r: F.struct((-F.length(r["name"])).alias("less"), r["name"].alias("name"), r["verdict"].alias("verdict"))
    if not rules:
        best = rows.withColumn("best", F.lit(None).cast("struct<less:int,name:string,verdict:string>"))
    elif len(rules) <= INLINE_RULES:
        entry = lambda r: F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.regex).alias("regex"))
        by_token: dict[str, list[Rule]] = {}
        for r in rules:
            by_token.setdefault(index[r], []).append(r)
        table = F.create_map(*[c for t, own in sorted(by_token.items()) for c in (F.lit(t), F.array(*map(entry, own)))])
        fetched = F.flatten(F.filter(F.transform(F.array_append(_tokens(F.col("host"), F.col("path")), F.lit("")), lambda t: F.try_element_at(table, t)), lambda x: x.isNotNull()))
        fitting = F.filter(fetched, lambda r: F.rlike(F.concat("host", "path"), r["regex"]))
        best = rows.withColumn("best", F.array_min(F.transform(fitting, key)))
    else:
        listed = pages.sparkSession.createDataFrame([(index[r], r.name, r.verdict, r.regex) for r in rules], "token string, name string, verdict string, regex string")
        urls = rows.select("host", "path").distinct()
        judged = urls.withColumn("token", F.explode(F.array_append(_tokens(F.col("host"), F.col("path")), F.lit("")))).join(listed, "token").where(F.rlike(F.concat("host", "path"), F.col("regex")))
        judged = judged.groupBy("host", "path").agg(F.min(F.struct((-F.length("name")).alias("less"), "name", "verdict")).alias("best"))
        best = rows.join(judged, ["host", "path"], "left")
    return best.select(F.col("id").alias(id_col), "host", "path", F.col("best.name").alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
