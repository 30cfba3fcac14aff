"""Token counts of whole texts, by batch encoding in Arrow functions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces
from .common import slices


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, batch_bytes: int = 1 << 20) -> DataFrame:
    """For each row: ``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``tokenizer`` is the path of a tokenizers JSON file on every worker.  Texts
    are cut at the tokenizer's own splits, a very long one window by window, and a
    very long run of letters where no token can lie (see ``pieces``); rows are taken in runs of about ``batch_bytes``.
    There is no shuffle.

    A null or empty text has 0 bytes and 0 tokens; a null id is kept; repeated
    rows give repeated results; other columns are ignored; an empty table gives
    an empty result.  Special strings inside texts count as the tokenizer's
    special tokens, its default.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, cache = pieces.load(tokenizer, "lengths")
        for run in slices(batches, "text", batch_bytes):
            n = cache.texts(run.column(1).to_pylist(), cut)
            size = pc.fill_null(pc.binary_length(run.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([run.column(0), size, pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
