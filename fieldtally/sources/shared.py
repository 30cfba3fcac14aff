"""The folder that driver and executors share, and small files in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; a temporary folder only where nothing is
    named and all tasks run in this process, as in tests."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="fieldtally-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/fieldtally/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    """A folder of any file system that Spark knows; for its few small files and for
    listings of folders, never for data."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._at = lambda name: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        self._files = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, name: str = "") -> list[str]:
        where = self._at(name)
        return sorted(s.getPath().getName() for s in self._files.listStatus(where)) if self._files.exists(where) else []

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._at(name))

    def delete(self, name: str = "") -> bool:
        return self._files.delete(self._at(name), True)

    def text(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str, replace: bool = False) -> None:
        """Without ``replace`` an error if the file exists, also if two write it at once."""
        self.write_bytes(name, text.encode(), replace)

    def write_bytes(self, name: str, data: bytes, replace: bool = False) -> None:
        stream = self._files.create(self._at(name), replace)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
