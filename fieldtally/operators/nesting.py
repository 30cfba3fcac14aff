"""Tables of one key side by side, and repeaters nested into their forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def colocate(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """``df`` as a catalog table in ``buckets`` by its ``keys``, sorted by them within each.

    Tables with the same number of buckets by the same keys are joined and grouped
    by them without moving a row.  ``path`` is where the files lie; the warehouse
    without.
    """
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def nested(forms: DataFrame, businesses: DataFrame, branches: DataFrame, key: str = "assignment_id", first: str = "index1", second: str = "index2") -> DataFrame:
    """Each form with its ``businesses``, in the order of ``first``, and each of these
    with its ``branches``, in the order of ``second``.

    Indexes are compared as whole numbers whether they are kept as numbers or as
    text; rows whose index is no number have no place and are left out, as are
    those whose form or business isn't there.  Forms and businesses without
    any have an empty array; a repeated index is there as often as it comes.
    Where all three tables lie in buckets of ``key`` nothing is moved.

    A form's repeaters are in one row, as the questionnaire bounds their number.
    """
    number = lambda c: F.trim(F.col(c).cast("string")).try_cast("int")
    inner = branches.select(key, number(first).alias(first), F.struct(number(second).alias(second), *(c for c in branches.columns if c not in (key, first, second))).alias("_b"))
    lists = inner.where(F.col(first).isNotNull() & F.col(f"_b.{second}").isNotNull()).groupBy(key, first).agg(F.array_sort(F.collect_list("_b")).alias("_l"))
    # one map for each form, so that the tables meet by the form's key alone
    of_form = lists.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(first, "_l"))).alias("_branches"))
    own = [c for c in businesses.columns if c not in (key, first)]
    outer = businesses.select(key, F.struct(number(first).alias(first), *own).alias("_a")).where(F.col(f"_a.{first}").isNotNull())
    all_of = outer.groupBy(key).agg(F.array_sort(F.collect_list("_a")).alias("_businesses"))
    joined = forms.join(all_of, key, "left").join(of_form, key, "left")
    none = F.array().cast(lists.schema["_l"].dataType)
    with_branches = F.transform("_businesses", lambda a: F.struct(a[first].alias(first), *(a[c].alias(c) for c in own), F.coalesce(F.try_element_at("_branches", a[first]), none).alias("branches")))
    out = joined.withColumn("_found", with_branches)
    return out.withColumn("businesses", F.coalesce("_found", F.array().cast(out.schema["_found"].dataType))).drop("_businesses", "_branches", "_found")
