"""Column expressions for codes, encoded strings and values of uncertain type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def leading_int(c: Column) -> Column:
    """The integer that a text starts with ("12abc" is 12, "3.7" is 3), else 0."""
    return F.coalesce(F.nullif(F.regexp_extract(c.cast("string"), r"^\s*([+-]?[0-9]+)", 1), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def pad2(c: Column) -> Column:
    """At least two characters, zeros in front; longer text stays whole."""
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def or_default(c: Column, default: str) -> Column:
    """``default`` for null and empty text."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def unquoted(c: Column) -> Column:
    """Without the one quote that spreadsheets put before text."""
    return F.regexp_replace(c, "^'", "")


def kab_of(code: Column) -> Column:
    """Characters 3 and 4 of a region code of at least 4, else null."""
    return F.when(F.length(code) >= 4, F.substring(code, 3, 2))


def region_parts(code: Column) -> Column:
    """A 16-digit region code cut into province, kab, kec, desa, SLS and sub-SLS."""
    at, parts = 1, []
    for name, width in (("prov", 2), ("kab", 2), ("kec", 3), ("desa", 3), ("sls", 4), ("sub_sls", 2)):
        parts.append(F.nullif(F.substring(code, at, width), F.lit("")).alias(name))
        at += width
    return F.struct(*parts)


def code_identity_parts(c: Column) -> Column:
    """``<region> - <kind> - <no>`` or ``<kab> - <id>``: region, kind or id, number,
    and whether the region part is a full 16-digit code."""
    part = lambda i: F.nullif(F.split_part(c, F.lit(" - "), F.lit(i)), F.lit(""))
    return F.struct(part(1).alias("region"), part(2).alias("kind"), part(3).alias("number"), F.coalesce(part(1).rlike("^[0-9]{16}$"), F.lit(False)).alias("is_field"))


def label_value_list(c: Column) -> Column:
    """``[{label=.., value=..}, ..]`` as an array of structs.

    The text isn't JSON: nothing is quoted, labels may hold commas, and entries
    may have other keys.  An entry starts at ``label=`` after a brace or comma;
    the last ``, value=`` before the entry's end separates the two.
    """
    entry = r"[{,]\s*label=((?:(?!\}).)*), value=([^,}]*)"
    found = F.regexp_extract_all(c, F.lit(entry), F.lit(0))
    one = lambda m: F.struct(F.regexp_extract(m, r"label=(.*), value=", 1).alias("label"), F.regexp_extract(m, r", value=([^,}]*)$", 1).alias("value"))
    return F.transform(found, one)


def amount(c: Column) -> Column:
    """A number, or an amount as people write it ("Rp 4.100.000,50": dots between
    thousands, decimal comma; a minus before or after "Rp"), as double; null for
    anything else."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(c.cast("string")), r"(?i)^(-?)\s*rp\.?\s*", "$1"), ",-$", "")
    written = bare.rlike(r"^-?[1-9][0-9]{0,2}(\.[0-9]{3})+(,[0-9]+)?$|^-?[0-9]+,[0-9]+$")
    text = F.when(written, F.translate(bare, ",.", ".")).otherwise(bare).try_cast("double")
    return F.when(F.typeof(c) == "string", text).otherwise(c.try_cast("double"))


def bracketed(c: Column) -> Column:
    """"[04] NAME" as code and name; text without brackets has a null code."""
    return F.struct(F.nullif(F.regexp_extract(c, r"^\s*\[([^\]]*)\]", 1), F.lit("")).alias("code"), F.trim(F.regexp_replace(c, r"^\s*\[[^\]]*\]\s*", "")).alias("name"))


def composite_id(c: Column) -> Column:
    """``<id>_<epoch ms>`` as id and timestamp."""
    ms = F.regexp_extract(c, r"_([0-9]+)$", 1).try_cast("bigint")
    return F.struct(F.regexp_replace(c, r"_[0-9]+$", "").alias("id"), F.timestamp_millis(ms).alias("at"))


def any_timestamp(c: Column) -> Column:
    """The three spellings in use, as a timestamp without zone; else null."""
    forms = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.coalesce(*(F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in forms))


def assigned_to(c: Column) -> Column:
    """The ids of "ASSIGNED TO: a, b"; null for texts that aren't assignments."""
    return F.when(c.startswith("ASSIGNED TO:"), F.filter(F.split(F.trim(F.substring_index(c, ":", -1)), r",\s*"), lambda x: x != ""))


def plain_text(c: Column) -> Column:
    """Without tags, for display."""
    return F.trim(F.regexp_replace(c, "<[^>]*>", ""))


def code_list(text: str | None) -> list[str]:
    """"04, 5" as ["04", "05"]: an environment value that lists codes."""
    return [x.strip().zfill(2) for x in (text or "").split(",") if x.strip()]
