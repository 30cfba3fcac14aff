"""Bounded samples of labelled rows, and the hold-out rule that both classifiers use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in this fold; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_labels(labels: DataFrame, target: str, folds: int, fold: int) -> DataFrame:
    """``doc_id``, ``label``: 0 or 1 labels of ids outside the held-out fold, one
    for each id (the greatest, where they differ)."""
    known = labels.select("doc_id", F.col(target).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    return known.where(~held_out(F.col("doc_id"), folds, fold)).groupBy("doc_id").agg(F.max("label").alias("label"))


def sample(rows: DataFrame, id_col: str, most: int, total: int) -> DataFrame:
    """About ``most`` of ``total`` rows of different ids, by a hash of the id."""
    if total > most:
        bound = int(most / total * 2**32)
        rows = rows.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(2**32)) < bound)
    return rows
