"""SimHash fingerprints of whole texts, their likeness, and all that are near.

A term is a run of 8 bytes (A-Z as a-z); its hash votes with its weight on each
of 128 signed bits, and the fingerprint's bits are the signs of the sums.  Near
fingerprints are found in permuted block tables: the bits are cut into blocks,
and two fingerprints within the radius agree in all blocks of one of the tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Table, slices

BITS = 128
#: Bytes of a term; texts stand between as many zeros less one, so short ones have terms too.
_TERM = 8
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Terms whose repetitions are counted together; a longer text's votes add up block by block.
_BLOCK = 1 << 18
_AT_ONCE = 1 << 13


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _votes(terms: np.ndarray) -> np.ndarray:
    """The weighted votes of one block of terms: 1 + ln(repetitions), in eighths, so
    that sums are whole numbers and don't depend on their order."""
    terms = np.sort(terms)
    first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    weight = np.rint(8 + 8 * np.log(np.diff(np.append(first, len(terms))))).astype(np.float32)
    total, terms = np.zeros(BITS, np.int64), terms[first]
    for i in range(0, len(terms), _AT_ONCE):
        x, w = terms[i : i + _AT_ONCE], weight[i : i + _AT_ONCE]
        hashes = np.stack([_mix(x + np.uint64(0x9E3779B97F4A7C15)), _mix(x ^ np.uint64(0xD1B54A32D192ED03))], 1).astype("<u8")
        up = w @ np.unpackbits(hashes.view(np.uint8), axis=1).astype(np.float32)
        total += 2 * up.astype(np.int64) - int(w.sum())
    return total


def simhash(raws: list[bytes]) -> np.ndarray:
    """16 bytes for each text; those of an empty text are zeros."""
    gap = bytes(_TERM - 1)
    data = np.append(_FOLD[np.frombuffer(gap + gap.join([*raws, b""]), np.uint8)], np.zeros(_TERM, np.uint8))
    terms = np.ndarray((len(data) - _TERM + 1,), "<u8", data, strides=(1,))
    out, at = np.zeros((len(raws), BITS // 8), np.uint8), 0
    with np.errstate(over="ignore"):
        for i, raw in enumerate(raws):
            if raw:
                end = at + len(raw) + _TERM - 1
                out[i] = np.packbits(sum(_votes(terms[j : min(j + _BLOCK, end)]) for j in range(at, end, _BLOCK)) > 0)
                at = end
            else:
                at += _TERM - 1
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The share of bits in which fingerprints agree."""
    return 1 - np.bitwise_count(x ^ y).sum(1) / BITS


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """``id_col`` and ``fingerprint`` (32 hexadecimal digits) of each row.

    Whole texts count, block by block.  A null or empty text has the fingerprint
    of zeros; null ids and repeated rows are kept, other columns are ignored; an
    empty table gives an empty result.  There is no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", batch_bytes):
            made = simhash([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.tobytes().hex() for f in made], pa.string())], ["id", "fingerprint"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string").withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: What a row of ``_neighbours`` is: finished, the first of its part, or the last of it.
_DONE, _FIRST, _LAST = 0, 1, 2
_SAID = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(texts: list[str], prints: np.ndarray, nexts: list[str], next_prints: np.ndarray) -> list[pa.Array]:
    """The columns of ``_SAID``."""
    raws = [edited(a, b).encode("utf-8", "replace") for a, b in zip(texts, nexts)]
    made = simhash(raws)
    shown = [pa.array([f.tobytes().hex() for f in x], pa.string()) for x in (prints, made)]
    return [pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raws], pa.string()), *shown, pa.array(likeness(prints, made), pa.float64()), pa.array(likeness(prints, next_prints), pa.float64())]


def _neighbours(rows: DataFrame, batch_bytes: int) -> Table:
    """Ranges of rows by falling id, each compared with the next one of its range;
    the first and last row of a range come with their texts."""
    kind = rows.schema["id"].dataType.simpleString()
    order = [F.col("id").desc_nulls_last(), F.col("tie"), F.col("place")]
    ordered = rows.withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()}).repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None

        def end(role: int, row: pa.Array, text: str, print_: np.ndarray) -> pa.RecordBatch:
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            shown = pa.array([print_.tobytes().hex()], pa.string())
            return pa.RecordBatch.from_arrays([row, *none[:2], shown, *none[2:], pa.array([part], pa.int32()), pa.array([role], pa.int32()), pa.array([text], pa.string())], names)

        for batch in slices(batches, "text", batch_bytes):
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            prints = simhash([t.encode("utf-8", "replace") for t in texts])
            if held is None:
                yield end(_FIRST, ids.slice(0, 1), texts[0], prints[0])
            else:
                ids, texts, prints = pa.concat_arrays([held[0], ids]), [held[1], *texts], np.concatenate([held[2][None], prints])
            n = len(texts) - 1
            if n:
                more = [pa.array([v] * n, pa.int32()) for v in (part, _DONE)]
                yield pa.RecordBatch.from_arrays([ids.slice(0, n), *_compared(texts[:-1], prints[:-1], texts[1:], prints[1:]), *more, pa.nulls(n, pa.string())], names)
            held = ids.slice(n), texts[n], prints[n]
        if held is not None:
            yield end(_LAST, *held)

    names = ["id", *(c.split()[0] for c in _SAID.split(", ")), "part", "role", "text"]
    return Table(ordered.mapInArrow(compare, f"id {kind}, {_SAID}, part int, role int, text string"), "neighbours")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """Each text's fingerprint against that of its edited text and of the next text.

    The next row is the one after it by falling id; after the last comes the first
    again.  Rows of one id stand in the order of a hash of their texts, null ids
    come last.  The edited text is ``edited`` of both.  ``id_col``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next`` come back.

    Texts move once, to ranges of ids; only the first and last row of each range
    meet another range's, by its number.  A null text is an empty one; repeated
    rows are kept (the next of one may be its equal); a single row is next to
    itself; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    said = _neighbours(rows, batch_bytes).read()
    ends = said.where(F.col("role") != _DONE)
    order = Window.orderBy("part")
    numbers = ends.select("part").distinct().select("part", F.lead("part").over(order).alias("after"), F.min("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("least"))
    follow = numbers.select("part", F.coalesce("after", "least").alias("after"))
    first = ends.where(F.col("role") == _FIRST).select(F.col("part").alias("after"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    pairs = ends.where(F.col("role") == _LAST).select("part", "id", "text", "fingerprint").join(follow, "part").join(first, "after")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", batch_bytes):
            texts, nexts = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            prints, next_prints = (np.frombuffer(b"".join(map(bytes.fromhex, batch.column(i).to_pylist())), np.uint8).reshape(-1, BITS // 8) for i in (2, 4))
            yield pa.RecordBatch.from_arrays([batch.column(0), *_compared(texts, prints, nexts, next_prints)], names)

    names = ["id", *(c.split()[0] for c in _SAID.split(", "))]
    finished = pairs.select("id", "text", "fingerprint", "next_text", "next_print").mapInArrow(finish, f"id {kind}, {_SAID}")
    return said.where(F.col("role") == _DONE).select(names).unionByName(finished).withColumnRenamed("id", id_col)


def tables_of(radius: int, blocks: int) -> np.ndarray:
    """For each table the bits (two 64-bit masks) of the blocks that must agree.

    Any ``radius`` wrong bits lie in as many of the ``blocks`` at the most, so the
    others agree, and each choice of the others is a table.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("there must be more blocks than the radius, and no more than bits")
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    bits = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    kept = [sum(bits[i] for i in c) for c in combinations(range(blocks), blocks - radius)]
    return np.array([[m >> 64, m & (1 << 64) - 1] for m in kept], np.uint64)


def _found(key: np.ndarray, tile: np.ndarray, chunk: np.ndarray, prints: np.ndarray, masks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and distances of the near pairs of rows that come sorted by key and
    tile; a pair counts in the first table that it shares."""
    a, found = np.arange(len(key)), []
    for step in range(1, len(key)):
        a = a[a + step < len(key)]
        a = a[(key[a] == key[a + step]) & (tile[a] == tile[a + step])]
        if not len(a):
            break
        differ = prints[a] ^ prints[a + step]
        distance = np.bitwise_count(differ).sum(1).astype(np.int64)
        near = (distance <= radius) & (distance > 0)
        # a tile of two chunks compares one with the other only
        near &= (tile[a] >> 32 == tile[a] & 0xFFFFFFFF) | (chunk[a] != chunk[a + step])
        at = np.flatnonzero(near)
        first = ((differ[at][:, None, :] & masks) == 0).all(2).argmax(1)
        at = at[first == key[a[at]] % len(masks)]
        found.append(np.stack([a[at], a[at] + step, distance[at]]))
    return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64),) * 3


def _search(prints: DataFrame, radius: int, blocks: int, tile: int, schema: str, out: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]) -> DataFrame:
    """``out`` of the near pairs of distinct fingerprints, task by task."""
    masks = tables_of(radius, blocks)
    if len(masks) > 128:  # a key has room for them
        raise ValueError(f"{len(masks)} tables; take fewer blocks")
    names = ["key", "hi", "lo"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                raw = b"".join(map(bytes.fromhex, batch.column(0).slice(i, 4096).to_pylist()))
                x = np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)
                with np.errstate(over="ignore"):
                    kept = x[:, None, :] & masks
                    key = _mix(kept[:, :, 0] + _mix(kept[:, :, 1] + np.uint64(1)))
                key = (key >> np.uint64(8)).astype(np.int64) * len(masks) + np.arange(len(masks))
                both = np.repeat(x.view(np.int64), len(masks), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(both[:, 0]), pa.array(both[:, 1])], names)

    rows = prints.select("fingerprint").where("fingerprint is not null").distinct().mapInArrow(deal, "key long, hi long, lo long")
    large = Table(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > tile), "large-buckets").read()
    if large.isEmpty():
        tiles = rows.withColumns({"tile": F.lit(0).cast("long"), "chunk": F.lit(0)})
    else:
        dealt = rows.join(large, "key", "left").withColumn("chunks", F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)).cast("int"))
        dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("hi", "lo"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        tiles = dealt.select(*names, (F.least("chunk", "other").cast("long") * (1 << 32) + F.greatest("chunk", "other")).alias("tile"), "chunk")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(5)]
            columns = columns if held is None else [np.concatenate(c) for c in zip(held, columns)]
            key, where = columns[0], columns[3]
            edge = int(np.flatnonzero(np.append(True, (key != key[-1]) | (where != where[-1])))[-1])
            held = [c[edge:] for c in columns]  # this tile may go on in the next batch
            if edge:
                yield from said([c[:edge] for c in columns])
        if held is not None:
            yield from said(held)

    def said(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x = np.stack(columns[1:3], 1).view(np.uint64)
        a, b, distance = _found(columns[0], columns[3], columns[4], x, masks, radius)
        if len(a):
            yield out(np.stack(columns[1:3], 1), a, b, distance)

    return tiles.repartition("key", "tile").sortWithinPartitions("key", "tile").mapInArrow(compare, schema)


def _hex(hi: str, lo: str):
    return F.concat(*(F.lpad(F.lower(F.hex(c)), 16, "0") for c in (hi, lo)))


def near_pairs(prints: DataFrame, radius: int = 3, blocks: int = 5, tile: int = 2048) -> DataFrame:
    """All pairs ``a`` < ``b`` of different values of ``fingerprint`` within
    ``radius`` bits, and their ``distance``.

    Equal fingerprints are one; nulls are left out; an empty table gives an empty
    result.  A bucket of more than ``tile`` fingerprints is dealt to chunks, and
    each two chunks meet in a task of their own; so no bucket is left out or cut.
    """

    def out(x: np.ndarray, a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x[a, 0]), pa.array(x[a, 1]), pa.array(x[b, 0]), pa.array(x[b, 1]), pa.array(distance.astype(np.int32))], ["a0", "a1", "b0", "b1", "distance"])

    found = _search(prints, radius, blocks, tile, "a0 long, a1 long, b0 long, b1 long, distance int", out)
    pairs = found.select(_hex("a0", "a1").alias("x"), _hex("b0", "b1").alias("y"), "distance")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "distance")


def near_counts(prints: DataFrame, radius: int = 3, blocks: int = 5, tile: int = 2048) -> DataFrame:
    """``fingerprint`` and ``n_near``, how many other values lie within ``radius``
    bits, where there are any.  Tasks return counts, so a group of very many near
    fingerprints never becomes a list of their pairs.  See ``near_pairs``."""

    def out(x: np.ndarray, a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
        which, n = np.unique(np.concatenate([a, b]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(x[which, 0]), pa.array(x[which, 1]), pa.array(n.astype(np.int64))], ["hi", "lo", "n"])

    found = _search(prints, radius, blocks, tile, "hi long, lo long, n long", out)
    return found.groupBy("hi", "lo").agg(F.sum("n").alias("n_near")).select(_hex("hi", "lo").alias("fingerprint"), "n_near")
