from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally import schemas
from fieldtally.functions import scalars as S


def one(spark, value, f):
    out = spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("o")).first().o
    return out.asDict() if hasattr(out, "asDict") else out


@pytest.mark.parametrize("text, n", [("12abc", 12), ("", 0), (None, 0), ("3.7", 3), (" -4", -4), ("x1", 0), ("9" * 30, 0)])
def test_leading_int(spark, text, n):
    assert one(spark, text, S.leading_int) == n


@pytest.mark.parametrize("text, out", [("4", "04"), ("04", "04"), ("104", "104"), (None, None)])
def test_pad2(spark, text, out):
    assert one(spark, text, S.pad2) == out


def test_region_codes(spark):
    assert one(spark, "6104012003000102", S.region_parts) == {"prov": "61", "kab": "04", "kec": "012", "desa": "003", "sls": "0001", "sub_sls": "02"}
    assert one(spark, "610", S.kab_of) is None and one(spark, "6104", S.kab_of) == "04"
    assert one(spark, "''x", S.unquoted) == "'x"


def test_code_identity(spark):
    assert one(spark, "6104012003000102 - UMK - 3", S.code_identity_parts) == {"region": "6104012003000102", "kind": "UMK", "number": "3", "is_field": True}
    assert one(spark, "6104 - abc", S.code_identity_parts) == {"region": "6104", "kind": "abc", "number": None, "is_field": False}
    assert one(spark, None, S.code_identity_parts)["is_field"] is False


@pytest.mark.parametrize(
    "text, out",
    [
        ("[{label=1. A, b, value=1}, {label=2. C, value=2}]", [("1. A, b", "1"), ("2. C", "2")]),
        ("[{label=a, value=b, value=3}]", [("a, value=b", "3")]),
        ("[{gender=1, label=N, value=7}]", [("N", "7")]),
        ("[{other=1}]", []),
        ("[]", []),
        ("", []),
    ],
)
def test_label_value_list(spark, text, out):
    assert [(r.label, r.value) for r in one(spark, text, S.label_value_list)] == out


def test_encoded_values(spark):
    assert one(spark, "Rp 4.100.000", S.amount) == 4_100_000 and one(spark, "-", S.amount) is None
    assert [one(spark, t, S.amount) for t in ("Rp 4.100.000,50", "-5000", "1000.0", "-Rp 5.000", "Rp -5.000,25", "12 or so")] == [4_100_000.5, -5000, 1000, -5000, -5000.25, None]
    assert one(spark, "[04] NAME", S.bracketed) == {"code": "04", "name": "NAME"}
    assert one(spark, "NAME", S.bracketed) == {"code": None, "name": "NAME"}
    assert one(spark, "a_b_1700000000000", S.composite_id)["id"] == "a_b"
    assert one(spark, "ASSIGNED TO: a, b", S.assigned_to) == ["a", "b"] and one(spark, "OPEN", S.assigned_to) is None
    assert one(spark, "<b>x</b> y", S.plain_text) == "x y"
    assert S.code_list(" 4, 05,,") == ["04", "05"] and S.code_list(None) == []


@pytest.mark.parametrize("text, out", [("2026-01-02 03:04:05", datetime(2026, 1, 2, 3, 4, 5)), ("2026-01-02T03:04:05", datetime(2026, 1, 2, 3, 4, 5)), ("2026-01-02T03:04:05.000Z", datetime(2026, 1, 2, 3, 4, 5)), ("soon", None), (None, None)])
def test_any_timestamp(spark, text, out):
    assert one(spark, text, S.any_timestamp) == out


def test_schema_from_a_dictionary(spark):
    schema = schemas.from_dictionary([("t", "a", "VARCHAR"), ("t", "n", "INTEGER"), ("t", "b", "BOOLEAN"), ("t", "d", "DATETIME"), ("u", "x", "DOUBLE")], "t")
    assert [type(f.dataType) for f in schema] == [T.StringType, T.IntegerType, T.BooleanType, T.TimestampNTZType]
    df = spark.createDataFrame([(" ", "12", "1", "2026-01-02T00:00:00"), ("x", "1x", "TRUE", "?")], "A string, n string, b string, d string")
    rows = [tuple(r) for r in schemas.conform(df, schema).collect()]
    assert rows == [(None, 12, True, datetime(2026, 1, 2)), ("x", None, True, None)]
    with pytest.raises(ValueError):
        schemas.from_dictionary([], "t")
