"""Token ids in files of directly addressable codes.

An id is split into chunks of ``widths`` bits, the lowest first.  Level k holds
the k-th chunk of every id that has one, a bitmap that tells which of them go
on, and a rank directory over that bitmap.  The k-th chunk of the i-th id is
found by following ranks, so any token is read without decoding its neighbours.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import pieces
from .common import Table, slices

MAGIC = b"DAC1"
#: Bits of a bitmap for each entry of its rank directory.
RANK_BLOCK = 512


def encode(ids: np.ndarray, widths: Sequence[int] = (8, 8, 16)) -> bytes:
    """A file image: magic, number of ids, number of levels, then each level's
    width, length, chunks, continuation bitmap and rank directory."""
    left = np.asarray(ids)
    if left.dtype != np.uint32:
        left = left.astype(np.uint64)
    levels = []
    for k, width in enumerate(widths):
        rest = left >> left.dtype.type(width)
        more = rest > 0
        if k == len(widths) - 1 and more.any():
            raise ValueError("an id needs more bits than the levels have")
        chunk = (left & left.dtype.type((1 << width) - 1)).astype("<u1" if width <= 8 else "<u2" if width <= 16 else "<u4")
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK), dtype="<u4") if len(more) else np.zeros(0, "<u4")
        ranks = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype("<u4") if len(more) else blocks
        levels.append(struct.pack("<BQ", width, len(left)) + chunk.tobytes() + bits.tobytes() + ranks.tobytes())
        left = rest[more]
        if not len(left):
            break
    return MAGIC + struct.pack("<QB", len(ids), len(levels)) + b"".join(levels)


class Reader:
    """Random access to the ids of a file image."""

    def __init__(self, image: bytes):
        if image[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.n, levels = struct.unpack_from("<QB", image, 4)
        at, self.levels = 13, []
        for _ in range(levels):
            width, n = struct.unpack_from("<BQ", image, at)
            at += 9
            kind = "<u1" if width <= 8 else "<u2" if width <= 16 else "<u4"
            chunk = np.frombuffer(image, kind, n, at)
            at += chunk.nbytes
            bits = np.frombuffer(image, np.uint8, (n + 7) // 8, at)
            at += bits.nbytes
            ranks = np.frombuffer(image, "<u4", -(-n // RANK_BLOCK), at)
            at += ranks.nbytes
            self.levels.append((width, chunk, bits, ranks))

    def _rank(self, level: int, i: int) -> int:
        """How many ids before i go on from this level."""
        _, _, bits, ranks = self.levels[level]
        block = i // RANK_BLOCK
        first = block * RANK_BLOCK
        return int(ranks[block]) + int(np.unpackbits(bits[first // 8 : (i + 7) // 8], bitorder="little")[: i - first].sum())

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for level, (width, chunk, bits, _) in enumerate(self.levels):
            value |= int(chunk[i]) << shift
            if not bits[i // 8] >> (i % 8) & 1:
                break
            i, shift = self._rank(level, i), shift + width
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from start to stop; each level is touched only where they lie."""
        out = np.zeros(max(0, stop - start), np.uint64)
        where, shift = np.arange(len(out)), 0
        for level, (width, chunk, bits, _) in enumerate(self.levels):
            if stop <= start:
                break
            out[where] |= chunk[start:stop].astype(np.uint64) << np.uint64(shift)
            first = start // 8
            more = np.unpackbits(bits[first : (stop + 7) // 8], bitorder="little")[start - 8 * first : stop - 8 * first].astype(bool)
            if not more.any():
                break
            start, stop = self._rank(level, start), self._rank(level, start) + int(more.sum())
            where, shift = where[more], shift + width
        return out.astype("<u4")


def _crc(reader: Reader, start: int, stop: int, span: int = 1 << 20) -> int:
    crc = 0
    for i in range(start, stop, span):
        crc = zlib.crc32(reader.slice(i, min(i + span, stop)).tobytes(), crc)
    return crc


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 1 << 20, batch_bytes: int = 1 << 22) -> Table:
    """Encode every text, end it with ``end_id`` and write the ids in ascending
    order of ``id_col``, about ``shard_tokens`` to a file image.

    The table written to the shared folder has a row for each image: ``part``
    and ``shard`` (their order is the order of the ids), ``first`` (the ids of
    its part before it), ``doc_ids``, ``lengths`` and ``image``.  A range
    partitioning by id brings neighbours together; a document is never split over
    two images.  Rows of one id, or of none, stand in the order of a hash of their
    texts, which is part of the range, so however many they are they don't come to
    one task.

    A null or empty text has the end id alone; null ids come first; repeated
    ids keep all their rows; other columns are ignored; an empty table gives an
    empty one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, cache = pieces.load(tokenizer, "ids")
        part, shard, first, ids, raws, held = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def image() -> pa.RecordBatch:
            lengths = [[len(r) // 4 for r in raws]]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)), pa.array(lengths, pa.list_(pa.int64())), pa.array([encode(np.frombuffer(b"".join(raws), "<u4"))], pa.binary())], ["part", "shard", "first", "doc_ids", "lengths", "image"])

        for run in slices(batches, "text", batch_bytes):
            new = [r + end for r in cache.texts(run.column(1).to_pylist(), cut)]
            ids.append(run.column(0))
            raws += new
            held += sum(map(len, new)) // 4
            if held >= shard_tokens:
                yield image()
                shard, first, ids, raws, held = shard + 1, first + held, [], [], 0
        if raws:
            yield image()

    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return Table(ordered.mapInArrow(write, f"part int, shard int, first long, doc_ids array<{kind}>, lengths array<long>, image binary"), "dac")


def read_token_files(files: DataFrame, id_col: str = "doc_id", most_broadcast: int = 200_000) -> DataFrame:
    """Per document of the images that ``write_token_files`` wrote: ``id_col``,
    ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32``.

    The writer has summed ids within its part; here only parts are summed.  Their
    sums, one row for each part, are sent to the tasks if there are at most
    ``most_broadcast`` after counting them, and joined beyond; so images don't
    move in usual files.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                start, lengths = batch.column(0)[k].as_py(), np.array(batch.column(2)[k].as_py(), np.int64)
                reader = Reader(batch.column(3)[k].as_buffer().to_pybytes())
                ends = np.cumsum(lengths)
                if reader.n > 1 << 22:  # a very long document: some of it at a time
                    crc = [_crc(reader, e - n, e) for e, n in zip(ends.tolist(), lengths.tolist())]
                else:
                    ids = memoryview(reader.slice(0, reader.n)).cast("B") if reader.n else b""
                    crc = [zlib.crc32(ids[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(1)[k].values, pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])

    if files.select("part").distinct().count() <= most_broadcast:
        parts = F.broadcast(parts)
    placed = files.join(parts, "part").select((F.col("first") + F.col("part_start")).alias("start"), "doc_ids", "lengths", "image")
    return placed.mapInArrow(read, f"id {kind}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def token_at(files: DataFrame, wanted: DataFrame, span: int = 1 << 16) -> DataFrame:
    """The token at each ``position`` of ``wanted`` (part, shard, position): the
    image's ranks lead to it, nothing is decoded around it.

    Positions of an image are looked up together, at most ``span`` different ones
    with each copy of it.  A part or shard that doesn't exist, a position that
    its image doesn't have, and a null in any of the three give a null token;
    repeated rows give repeated results.
    """
    keys = ["part", "shard", "position"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                reader = Reader(batch.column(3)[k].as_buffer().to_pybytes())
                positions = [i for i in batch.column(2)[k].as_py() if 0 <= i < reader.n]
                n = len(positions)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(c)[k].as_py()] * n, pa.int32()) for c in (0, 1)] + [pa.array(positions, pa.int64()), pa.array([reader[i] for i in positions], pa.int64())], [*keys, "token"])

    asked = wanted.select(F.col("part").cast("int"), F.col("shard").cast("int"), F.col("position").cast("long"))
    together = asked.dropna().distinct().groupBy("part", "shard", F.floor(F.col("position") / span).alias("span")).agg(F.collect_set("position").alias("positions"))
    found = together.join(files.select("part", "shard", "image"), ["part", "shard"]).select("part", "shard", "positions", "image").mapInArrow(look, "part int, shard int, position long, token long")
    return asked.join(found, keys, "left").select(*keys, "token")
