"""Respondent rows and what is counted from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import or_default


def flatten(respondents: DataFrame) -> DataFrame:
    """One flat row for each respondent; empty and null values are shown as "-",
    the place is level 6 or else level 5.  Columns beside the respondents' own, as
    the region code and the order of arrival, are kept as they are."""
    own = {"id", "codeIdentity", "assignmentStatusAlias", "currentUserFullname", "currentUserUsername", "latitude", "longitude", "region", *(f"data{i}" for i in range(1, 11))}
    beside = [F.col(f"`{c}`").alias("kab_code" if c == "kab" else c) for c in respondents.columns if c not in own]
    kec, deep = "region.level1.level2.level3", "region.level1.level2.level3.level4"
    five, six = f"{deep}.level5.name", f"{deep}.level5.level6.name"
    show = lambda c, d="-": or_default(F.col(c).cast("string"), d)
    place = F.coalesce(F.nullif(F.col(six), F.lit("")), F.nullif(F.col(five), F.lit("")), F.lit("-"))
    return respondents.select(
        show("region.level1.level2.name").alias("kab"), show(f"{kec}.name").alias("kec"), show(f"{deep}.name").alias("desa"), place.alias("place"),
        show("id").alias("id"), show("codeIdentity").alias("code_identity"), show("data1").alias("name"), show("data2").alias("address"), show("data6").alias("kind"),
        show("data9", "Belum diisi").alias("found"), show("assignmentStatusAlias").alias("status"), show("currentUserFullname").alias("officer"), show("currentUserUsername").alias("username"),
        show("latitude").alias("latitude"), show("longitude").alias("longitude"), *beside,
    )


def found_status(c: Column) -> Column:
    return F.when(c == "1. Ya", "found").when(c == "2. Tidak", "not found").when(F.coalesce(c, F.lit("")) == "", "not filled").otherwise("other")


def found_counts(rows: DataFrame, group: list[str], found: str) -> DataFrame:
    return rows.groupBy(*group, found_status(F.col(found)).alias("found_status")).agg(F.count("*").alias("n"))


def of_regions(respondents: DataFrame, regions: DataFrame, code: str, region_code: str) -> DataFrame:
    """Respondents of these regions, by the region's code and not by a prefix of
    an identity text, which rows registered online don't have."""
    return respondents.join(regions.select(F.col(region_code).alias(code)).distinct(), code, "left_semi")
