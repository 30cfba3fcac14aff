"""What the operators of this subpackage share: the shared folder and row batches."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import partial
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``; a temporary folder is set
    only where no one has named one and all tasks run in this process, as in
    tests.  On a cluster without the setting, executors would not see each
    other's files, so that is an error.
    """
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="fieldtally-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


class Table:
    """A Parquet table in the shared folder that cuts the lineage of ``df``.

    Operators drop the tables that nothing reads any more; those that a returned
    DataFrame reads stay until ``drop_tables`` or the end of the program.
    """

    live: dict[str, "Table"] = {}

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/fieldtally/{name}-{uuid.uuid4().hex}"
        self.schema = df.schema
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        # these outlive the session, so the table can be dropped after it has ended
        self._delete = partial(place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete, place, True)
        self.live[self.path] = self  # also if writing fails half-way
        df.write.option("compression", "zstd").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        """Only for tables that no DataFrame still in use reads."""
        self._delete()
        self.live.pop(self.path, None)


def drop_tables() -> None:
    """Drop all tables that operators have written, once their results have been
    used; for sessions that live long."""
    for table in list(Table.live.values()):
        table.drop()


@atexit.register
def _drop_at_exit() -> None:
    for table in list(Table.live.values()):
        try:
            table.drop()
        except Exception:  # Java has ended, or the folder is gone
            pass


T = TypeVar("T")
_RESIDENT: dict = {}


def resident(key: tuple, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept by a Python worker for its next tasks.

    Workers outlive stages, so what another operator has kept is let go first:
    a worker holds the state of one operator at a time, however many run in a
    session.
    """
    if key not in _RESIDENT:
        _RESIDENT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that come sorted by integer ``keys``, one table each."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        change = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            change |= np.diff(table[k].to_numpy()) != 0
        edges = [0, *(np.flatnonzero(change) + 1).tolist()]
        for i, j in zip(edges, edges[1:]):
            yield table.slice(i, j - i)
        held = table.slice(edges[-1])  # it may go on in the next batch
    if held is not None:
        yield held


class Scratch:
    """Tables that are dropped together, once nothing reads them any more."""

    def __init__(self):
        self.tables: list[Table] = []

    def hold(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(Table(df, name))
        return self.tables[-1].read()

    def drop(self) -> None:
        for table in self.tables:
            table.drop()


def materialize(df: DataFrame, name: str) -> DataFrame:
    return Table(df, name).read()


def _cuts(values: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of about ``most_bytes``; a run has one
    row at least, so a longer value stands alone."""
    sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    first = held = 0
    for row, n in enumerate(sizes):
        if held + n > most_bytes and row > first:
            yield first, row - first
            first, held = row, 0
        held += n
    if len(sizes) > first:
        yield first, len(sizes) - first


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of about ``most_bytes`` of ``column``."""
    for batch in batches:
        for first, n in _cuts(batch.column(batch.schema.get_field_index(column)), most_bytes):
            yield batch.slice(first, n)


def in_runs(values: pa.Array, most_bytes: int, each: Callable[[list], pa.Array]) -> pa.Array:
    """``each`` of the Python values of runs of about ``most_bytes``, put together."""
    return pa.concat_arrays([pa.array([], pa.float64())] + [each(values.slice(first, n).to_pylist()) for first, n in _cuts(values, most_bytes)])
