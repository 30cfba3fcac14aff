"""The region hierarchy: parent-child joins, ways to the root, cuts, roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written


def expand(kec: DataFrame, desa: DataFrame, sls: DataFrame, sub: DataFrame) -> DataFrame:
    """Flat level-6 rows with their parents' ids and names; parents without
    children have no row.  Each level has ``id``, ``fullCode``, ``name`` and
    ``parentFullCode``."""
    up = lambda df, p: df.select(F.col("fullCode").alias("_code"), *(F.col(c).alias(n) for c, n in p.items()))
    k = up(kec, {"id": "kecId", "name": "kecName"})
    d = desa.join(k, desa["parentFullCode"] == k["_code"]).select("id", "fullCode", "name", "kecId", "kecName")
    d = d.select(F.col("fullCode").alias("_code"), F.col("id").alias("desaId"), F.col("name").alias("desaName"), "kecId", "kecName")
    s = sls.join(d, sls["parentFullCode"] == d["_code"])
    s = s.select(F.col("fullCode").alias("_code"), F.col("id").alias("slsId"), F.col("name").alias("slsName"), F.col("fullCode").alias("slsFullCode"), "desaId", "desaName", "kecId", "kecName")
    out = sub.join(s, sub["parentFullCode"] == s["_code"])
    return out.select("id", "fullCode", "name", "slsId", "slsName", "slsFullCode", "desaId", "desaName", "kecId", "kecName")


def tree(nodes: DataFrame) -> DataFrame:
    """Every node of a hierarchy (``code``, ``name``, ``parent``) with its level and
    path of names, from the roots (null parent) down.

    Each node points to its parent, and in every round to where that one points,
    so ways double: a hierarchy of depth d takes log2(d) rounds, each a join of
    what isn't at its root yet with all nodes.  Rounds are written, so plans stay
    as short as one.  A way that meets a node twice ends there; nodes that no root
    leads to have no row; a code of several rows has one for each way.
    """
    state = written(nodes.select("code", F.col("parent").alias("to"), F.array(F.col("name").cast("string")).alias("names"), F.array("code").alias("codes"), "name"), "tree")
    while not state.where("to is not null").isEmpty():
        further = state.select(F.col("code").alias("to"), F.col("to").alias("_to"), F.col("names").alias("_names"), F.col("codes").alias("_codes"))
        moved = state.where("to is not null").join(further, "to").select("code", F.col("_to").alias("to"), F.concat("_names", "names").alias("names"), F.concat("_codes", "codes").alias("codes"), "name")
        # a way that goes round never ends, so it is dropped when it first meets itself
        moved = moved.where(F.size(F.array_distinct("codes")) == F.size("codes"))
        state = written(state.where("to is null").unionByName(moved), "tree")
    return state.select("code", "name", F.size("names").alias("level"), F.array_join("names", " / ", "").alias("path"))


def _keys(levels: Sequence[str]) -> list[Column]:
    """A text for the codes down to each level; a null code is apart from all others."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in levels]
    return [F.concat_ws("\x1f", *marked[: i + 1]) for i in range(len(levels))]


def frontier(rows: DataFrame, levels: Sequence[str], cap: int) -> DataFrame:
    """The coarsest regions of which each holds fewer than ``cap`` rows.

    ``levels`` are the columns of codes from the top down.  Rows are counted once
    for each place of the lowest level, and places are summed up the tree.  A
    region is in the result if it is below the cap and the one above it isn't;
    a place of the lowest level that reaches the cap is there too, with ``over``.
    So each row is in one region, and a service that returns up to ``cap`` rows
    answers for each with all of them.  ``level`` (from 1), the codes (null below
    the region's level), ``n`` and ``over`` come back; a null code is a place of
    its own.
    """
    return _frontier(rows.groupBy(*levels).agg(F.count("*").alias("n")), levels, cap).drop("_key")


def _frontier(places: DataFrame, levels: Sequence[str], cap: int) -> DataFrame:
    keys, depth = _keys(levels), len(levels)
    nodes = [F.struct(F.lit(i + 1).alias("level"), key.alias("_key"), (keys[i - 1] if i else F.lit(None).cast("string")).alias("_above"), *((F.col(c) if j <= i else F.lit(None)).alias(c) for j, c in enumerate(levels))) for i, key in enumerate(keys)]
    kinds = places.select(*nodes[-1:]).schema[0].dataType.simpleString()
    each = places.select("n", F.explode(F.array(*(x.cast(kinds) for x in nodes))).alias("e")).select("n", "e.*")
    counted = each.groupBy("level", "_key", "_above").agg(F.sum("n").alias("n"), *(F.first(c).alias(c) for c in levels))
    above = counted.select(F.col("_key").alias("_above"), F.col("n").alias("_n_above"), (F.col("level") + 1).alias("level"))
    joined = counted.join(above, ["level", "_above"], "left").where((F.col("level") == 1) | (F.col("_n_above") >= cap))
    return joined.where((F.col("n") < cap) | (F.col("level") == depth)).select("_key", "level", *levels, "n", (F.col("n") >= cap).alias("over"))


def by_frontier(rows: DataFrame, levels: Sequence[str], cap: int) -> DataFrame:
    """Each row with the level of its region in ``frontier`` and that region's size,
    ``region_level``, ``region_n``.  Places are looked up once each, not rows."""
    places = written(rows.groupBy(*levels).agg(F.count("*").alias("n")), "places")
    cut = _frontier(places, levels, cap).select("_key", F.col("level").alias("region_level"), F.col("n").alias("region_n"))
    found = places.select(*levels, F.explode(F.array(*_keys(levels))).alias("_key")).join(cut, "_key").drop("_key")
    same = [rows[c].eqNullSafe(found[c]) for c in levels]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return rows.join(found, on).select(*(rows[c] for c in rows.columns), "region_level", "region_n")


def sorted_regions(regions: DataFrame) -> DataFrame:
    """Regions in the order of their full codes, by which crawls are dealt out."""
    return regions.orderBy("fullCode")


def rollup(rows: DataFrame, levels: list[str]) -> DataFrame:
    """Counts for every level of the hierarchy and in total (null: all)."""
    return rows.rollup(*levels).agg(F.count("*").alias("n"))
