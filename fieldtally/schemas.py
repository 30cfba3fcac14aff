"""Explicit schemas of what is read, and schemas from a data dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROGRESS_DOC = (
    "username string, email string, roleName string, total bigint, _kabKotaCode string, _kabKotaName string, "
    "regionSummary array<struct<regionCode:string,total:bigint,statusBreakdown:array<struct<status:string,count:bigint>>>>"
)
PAGE = f"success boolean, message string, data struct<totalElements:bigint,content:array<struct<{', '.join(':'.join(f.split(' ', 1)) for f in PROGRESS_DOC.split(', '))}>>>"
REGION_LEVEL = "id string, code string, fullCode string, name string, parentFullCode string"
REGION_DIM = "id string, fullCode string, name string, slsId string, slsName string, slsFullCode string, desaId string, desaName string, kecId string, kecName string"


def _levels(first: int, last: int) -> str:
    inner = "name:string" if first == last else f"name:string,level{first + 1}:{_levels(first + 1, last)}"
    return f"struct<{inner}>"


RESPONDENT = "id string, codeIdentity string, " + ", ".join(f"data{i} string" for i in range(1, 11)) + ", assignmentStatusAlias string, currentUserFullname string, currentUserUsername string, latitude string, longitude string, region struct<level1:" + _levels(1, 6) + ">"

#: Types of the service's dictionary; DATETIME has no zone.
TYPES = {"VARCHAR": T.StringType(), "INTEGER": T.IntegerType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "DATETIME": T.TimestampNTZType()}


def from_dictionary(rows: list[tuple[str, str, str]], table: str) -> T.StructType:
    """The schema of ``table`` from (table, column, type) rows of a dictionary file."""
    found = [T.StructField(c, TYPES[k.upper()]) for t, c, k in rows if t == table]
    if not found:
        raise ValueError(f"the dictionary has no table {table}")
    return T.StructType(found)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in this schema: by name, missing columns null, values that don't
    convert null, booleans also from 0/1 and true/false, empty text null."""
    have = {c.lower(): c for c in df.columns}

    def one(field: T.StructField):
        if field.name.lower() not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        c = F.col(f"`{have[field.name.lower()]}`")
        text = F.nullif(F.trim(c.cast("string")), F.lit(""))
        if isinstance(field.dataType, T.BooleanType):
            text = F.lower(text)
            out = F.when(text.isin("1", "true"), F.lit(True)).when(text.isin("0", "false"), F.lit(False))
        elif isinstance(field.dataType, T.TimestampNTZType):
            from .functions.scalars import any_timestamp

            out = any_timestamp(text)
        else:
            out = text.try_cast(field.dataType)
        return out.alias(field.name)

    return df.select(*map(one, schema.fields))
