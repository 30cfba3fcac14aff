"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors of length 1 with a cosine of at least c are at most 2 - 2c apart in
squared distance.  After a rotation the coordinates are dealt to blocks, and
each block gets its proportional share of that budget: the blocks' distances add
up, so two linked vectors keep within the share in one block at least.

Blocks are joined by range.  Vectors are sorted so that near ones are neighbours
and cut into chunks; two chunks meet if the boxes around them come
within the share in some block, and within a tile runs of rows are compared in
just those blocks in which their boxes do.  So two vectors meet once, in all
blocks together, or never.  What is near in some block is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import Scratch, Table
from .components import components


@dataclass(frozen=True)
class Settings:
    """Linked from a cosine of ``least`` on.  ``blocks`` subspaces; a task compares
    the chunks of ``chunk`` vectors of at most two bands of ``band`` chunks.  The rotation and ``centres`` to sort
    by are fitted on about ``fit_rows`` vectors, chosen by a hash; they decide how
    much is compared, not what is found.  Boxes of one label meet in ``salts`` tasks."""

    least: float = 0.93
    blocks: int = 4
    chunk: int = 4096
    band: int = 8
    fit_rows: int = 4096
    centres: int = 256
    salts: int = 16
    seed: int = 3


@lru_cache
def random_rotation(dims: int, seed: int) -> np.ndarray:
    """The same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1.  They are scaled by a power of two first, so that no
    square is too large or too small."""
    _, exponent = np.frexp(np.abs(x).max(1, keepdims=True))
    x = np.ldexp(x, -exponent)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Fitted:
    """Rotations and centres for the commonest lengths of vectors."""

    rotations: dict[int, np.ndarray]
    centres: dict[int, np.ndarray]


def fit(reps: DataFrame, s: Settings, most_sizes: int = 8) -> Fitted:
    """From a bounded sample: the principal axes, widest first, and the centres.
    Other lengths get a random rotation and no centres."""
    total = reps.count()
    bound = 2**32 if total <= s.fit_rows else int(s.fit_rows / total * 2**32)
    by_size: dict[int, list[bytes]] = {}
    for r in reps.where(F.pmod(F.xxhash64("rep", F.lit(s.seed)), F.lit(2**32)) < bound).select("rep", "raw").orderBy("rep").collect():
        by_size.setdefault(len(r.raw) // 8, []).append(r.raw)
    fitted = Fitted({}, {})
    for dims in sorted(by_size, key=lambda d: (-len(by_size[d]), d))[:most_sizes]:
        x = np.frombuffer(b"".join(by_size[dims]), np.float64).reshape(-1, dims)
        _, axes = np.linalg.eigh(np.cov(unit(x).T, bias=True).reshape(dims, dims))
        fitted.rotations[dims] = axes[:, ::-1].T
        fitted.centres[dims] = fit_centres(rotated(x, fitted.rotations, s), s)
    return fitted


def rotated(x: np.ndarray, rotations: dict[int, np.ndarray], s: Settings) -> np.ndarray:
    """Unit vectors, turned; the coordinates of block b come together."""
    dims = x.shape[1]
    y = unit(x) @ (rotations[dims] if dims in rotations else random_rotation(dims, s.seed)).T
    return y[:, np.concatenate([np.arange(b, dims, s.blocks) for b in range(min(s.blocks, dims))])]


def edges(dims: int, s: Settings) -> np.ndarray:
    """Where each block's coordinates start, and the end.  Wide and narrow axes are
    dealt in turn, so every block has some of the widest ones, in front."""
    return np.concatenate([[0], np.cumsum([len(range(b, dims, s.blocks)) for b in range(min(s.blocks, dims))])])


def shares(dims: int, s: Settings) -> np.ndarray:
    """The blocks' parts of the squared distance, a little widened for rounding."""
    return (2 - 2 * s.least) * np.diff(edges(dims, s)) / dims * (1 + 1e-9) + 1e-12


def fit_centres(y: np.ndarray, s: Settings) -> np.ndarray:
    """Up to ``s.centres`` means of rotated vectors, by a few rounds of k-means, in
    the order of their first coordinate."""
    rng = np.random.default_rng(s.seed)
    centres = y[rng.permutation(len(y))[: s.centres]]
    for _ in range(6):
        nearest = (y @ centres.T - (centres**2).sum(1) / 2).argmax(1)
        sums, n = np.zeros_like(centres), np.bincount(nearest, minlength=len(centres))
        np.add.at(sums, nearest, y)
        centres = np.where(n[:, None] > 0, sums / np.maximum(1, n)[:, None], centres)
    return centres[centres[:, 0].argsort(kind="stable")]


def order_code(y: np.ndarray, centres: np.ndarray | None) -> np.ndarray:
    """Vectors around one centre get neighbouring numbers, in the order of their
    first coordinate."""
    first = np.clip((y[:, 0] + 1) * 32767, 0, 65535).astype(np.int64)
    if centres is None:
        return first
    return (y @ centres.T - (centres**2).sum(1) / 2).argmax(1) << 16 | first


def block_gaps(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The least squared distance of two boxes in each block."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return np.add.reduceat(gap**2, at[:-1], axis=-1)


def _prepare(vectors: DataFrame) -> DataFrame:
    """``id``, ``label`` and the vector's bytes as 64-bit floats; null bytes if the
    vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # null is nan, -0 is 0
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(values), values != 0)]
            wrong, some = (x[ends] - x[ends - sizes] for x in sums)
            good = (wrong == 0) & (some > 0) & batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], ends * 8]).astype(np.int32)
            valid = np.packbits(good, bitorder="little")
            raw = pa.BinaryArray.from_buffers(pa.binary(), len(good), [pa.py_buffer(valid), pa.py_buffer(offsets), pa.py_buffer(values)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], raw], ["id", "label", "raw"])

    rows = vectors.select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, label string, raw binary")


def _matrix(raws: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(raws.to_pylist()), np.float64).reshape(len(raws), -1)


def _coded(reps: DataFrame, fitted, s: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, sizes = np.zeros(batch.num_rows, np.int64), batch.column(1).to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                code[at] = order_code(rotated(_matrix(batch.column(4).take(pa.array(at))), fitted.value.rotations, s), fitted.value.centres.get(int(size) // 8))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], [*batch.schema.names, "code"])

    return reps.select("label", "size", "rep", "times", "raw").mapInArrow(run, "label string, size int, rep long, times long, raw binary, code long")


def _chunked(reps: DataFrame, fitted, s: Settings) -> DataFrame:
    """The representatives in chunks of one label and size, each a run of the order
    by code.  The first row of a chunk has its box: ``low`` and ``high``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, None

        def chunk(table: pa.Table) -> pa.RecordBatch:
            nonlocal number
            y = rotated(_matrix(table["raw"]), fitted.value.rotations, s)
            n, number = table.num_rows, number + 1
            box = [pa.array([b.tobytes()] + [None] * (n - 1), pa.binary()) for b in (y.min(0), y.max(0))]
            columns = [table[c].combine_chunks() for c in ("label", "size", "rep", "times", "raw")]
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, number)), pa.array(np.arange(n)), pa.array(np.full(n, n)), *box], ["label", "size", "rep", "times", "raw", "chunk", "place", "n", "low", "high"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            while held.num_rows:
                same = pc.and_(pc.equal(held["label"], held["label"][0]), pc.equal(held["size"], held["size"][0])).to_numpy()
                run_length = len(same) if same.all() else int(same.argmin())
                if run_length == held.num_rows and run_length < s.chunk:
                    break  # it may go on in the next batch
                n = min(run_length, s.chunk)
                yield chunk(held.slice(0, n))
                held = held.slice(n)
        if held is not None and held.num_rows:
            yield chunk(held)

    order = ["label", "size", "code", "rep"]
    ordered = _coded(reps, fitted, s).repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, "label string, size int, rep long, times long, raw binary, chunk long, place long, n long, low binary, high binary")


def chunk_pairs(chunks: DataFrame, s: Settings) -> DataFrame:
    """``a`` <= ``b``, chunks whose boxes come within the share of some block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                boxes = [_matrix(batch.column(k).take(pa.array(at))) for k in range(3, 7)]
                dims = boxes[0].shape[1]
                keep[at] = (block_gaps(*boxes, edges(dims, s)) <= shares(dims, s)).any(1)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    boxes = chunks.where("low is not null").select("label", "size", "chunk", "low", "high")
    a = boxes.select("label", "size", F.pmod(F.xxhash64("chunk"), F.lit(s.salts)).alias("salt"), F.col("chunk").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    b = boxes.select("label", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(s.salts - 1).cast("long"))).alias("salt"), F.col("chunk").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    met = a.join(b, ["label", "size", "salt"]).where("a <= b")
    return met.select("size", "a", "b", "low_a", "high_a", "low_b", "high_b").mapInArrow(run, "a long, b long")


def _least_of_component(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of n rows reaches by the links a - b."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def near_runs(y: np.ndarray, first: int, group: np.ndarray, s: Settings, step: int) -> list[tuple[slice, slice, np.ndarray]]:
    """The runs of rows that are compared, and in which blocks: those whose boxes
    come within the block's share.

    Runs end after ``step`` rows and where the ``group`` changes.  If their boxes
    exclude less than half of the pairs, short runs don't pay, and runs are
    ``step`` rows whatever their groups.
    """
    n, dims = y.shape
    at, share = edges(dims, s), shares(dims, s)
    changes = np.flatnonzero(np.diff(group)) + 1
    found: list[tuple[slice, slice, np.ndarray]] = []
    for cuts in (changes, changes[:0]):
        starts = np.unique(np.concatenate([[0], np.arange(0, first, step), np.arange(first, n, step), cuts]).astype(np.int64))
        ends = np.append(starts[1:], n)
        low, high = (f.reduceat(y, starts, axis=0) for f in (np.minimum, np.maximum))
        found, area = [], 0
        for p, (i, j) in enumerate(zip(starts.tolist(), ends.tolist())):
            if first < n and i >= first:
                break
            others = np.arange(p, len(starts)) if first == n else np.flatnonzero(starts >= first)
            within = block_gaps(low[p], high[p], low[others], high[others], at) <= share
            for q in np.flatnonzero(within.any(1)).tolist():
                o = slice(int(starts[others[q]]), int(ends[others[q]]))
                found.append((slice(i, j), o, np.flatnonzero(within[q])))
                area += (j - i) * (o.stop - o.start)
        if area < (n * n / 2 if first == n else first * (n - first)) / 2:
            break
    return found


def linked_pairs(x: np.ndarray, y: np.ndarray, first: int, group: np.ndarray, s: Settings, step: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Linked rows (a, b) of a tile, in parts, with how many pairs each part compared.

    Rows up to ``first`` are one chunk and the others another; with ``first`` at
    the end, all pairs of the one chunk meet.  ``x`` are the vectors, ``y`` the
    rotated ones.
    """
    n, dims = x.shape
    at, share = edges(dims, s), shares(dims, s)
    halves = [(y[:, i:j] ** 2).sum(1, keepdims=True) / 2 for i, j in zip(at, at[1:])]
    one = np.ones((n, 1))
    # a product of these is minus half of the squared distance in the block
    left = [np.hstack([y[:, i:j], -h, one]) for i, j, h in zip(at, at[1:], halves)]
    right = [np.hstack([y[:, i:j], one, -h]).T.copy() for i, j, h in zip(at, at[1:], halves)]
    for r, o, blocks in near_runs(y, first, group, s, step):
        near = np.zeros((r.stop - r.start, o.stop - o.start), bool)
        for b in blocks:
            near |= left[b][r] @ right[b][:, o] >= -share[b] / 2 - 1e-12
        compared = near.size
        if r == o:
            near &= np.arange(near.shape[0])[:, None] < np.arange(near.shape[1])[None]
            compared = len(near) * (len(near) - 1) // 2
        a, b = np.nonzero(near)
        a, b = a + r.start, b + o.start
        for k in range(0, max(1, len(a)), 1 << 16):  # bounded memory, however many are near
            u, v = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
            cosine = np.einsum("ij,ij->i", x[u], x[v]) / (np.linalg.norm(x[u], axis=1) * np.linalg.norm(x[v], axis=1))
            yield u[cosine >= s.least], v[cosine >= s.least], compared if k == 0 else 0


def compare_tile(times: np.ndarray, x: np.ndarray, y: np.ndarray, first: int, group: np.ndarray, rank: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row within a tile, and the linked row of least ``rank``."""
    links, a_all, b_all = np.zeros(len(x), np.int64), [], []
    for u, v, _ in linked_pairs(x, y, first, group, s):
        np.add.at(links, u, times[v])
        np.add.at(links, v, times[u])
        a_all.append(rank[u])
        b_all.append(rank[v])
    if not a_all:
        return links, rank
    return links, _least_of_component(len(x), np.concatenate(a_all), np.concatenate(b_all))[rank]


def _bands(pairs: DataFrame, chunks: DataFrame, s: Settings) -> DataFrame:
    """The rows that each pair of bands needs (``band_a``, ``band_b``): a chunk comes
    there once, however many others it meets, and its first row has the list of
    chunks that meet (``band`` squared at the most)."""
    band = lambda c: F.floor(F.col(c) / s.band).alias(f"band_{c}")
    met = pairs.select(band("a"), band("b"), "a", "b").groupBy("band_a", "band_b").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("met"))
    needed = F.array_distinct(F.flatten(F.transform("met", lambda p: F.array(p["a"], p["b"]))))
    rows = met.select("band_a", "band_b", "met", F.explode(needed).alias("chunk")).join(chunks.select("chunk", "place", "rep", "times", "raw"), "chunk")
    return rows.withColumn("met", F.when(F.col("place") == 0, F.col("met")))


def near_duplicate_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """For each row of ``vectors`` (``vec_id``, ``embedding``, ``label``):
    ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Equal vectors of one label are one representative with a count.
    Representatives are sorted and cut into chunks (see above), so no label,
    however large, comes to one task; chunks meet in tasks of bounded size, and
    neighbouring chunks go to a task together to meet all those of another band
    there.  A tile returns a count for each of its rows and one link to the least row
    that it reaches there; pairs are never listed.

    Ids may be of any kind that has an order, and keep it.
    Vectors that are null, empty, zero or hold null or non-finite components,
    and those with a null label, link with nothing; so do vectors of different
    lengths.  Repeated rows count as other vectors.  A null id has a null
    component and is kept.  An empty table gives an empty result.
    """
    s = settings
    rows = Table(_prepare(vectors).withColumns({"k1": F.xxhash64("label", "raw"), "k2": F.xxhash64("raw", F.lit(7), "label")}), "vectors").read()
    usable = rows.where("raw is not null and id is not null")
    grouped = usable.groupBy("k1", "k2").agg(F.min("id").alias("least"), F.count("*").alias("times"), F.first("label").alias("label"), F.first("raw").alias("raw"))
    if isinstance(rows.schema["id"].dataType, IntegralType):
        grouped = grouped.withColumn("rep", F.col("least").cast("long"))
    else:  # numbers in the order of the ids
        grouped = grouped.orderBy("least", "k1", "k2").withColumn("rep", F.monotonically_increasing_id())
    reps = Table(grouped.withColumn("size", F.length("raw")), "classes").read()
    fitted = vectors.sparkSession.sparkContext.broadcast(fit(reps, s))
    scratch = Scratch()
    chunks = scratch.hold(_chunked(reps, fitted, s), "chunks")
    pairs = scratch.hold(chunk_pairs(chunks, s), "chunk-pairs")
    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("chunk", "ascending"), ("place", "ascending")])
        chunk = table["chunk"].to_numpy()
        starts = np.flatnonzero(np.diff(chunk, prepend=-1)).tolist()
        made, met, out = {}, table["met"][0].as_py(), []
        for i, j in zip(starts, [*starts[1:], len(chunk)]):
            x = _matrix(table["raw"].slice(i, j - i))
            x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
            y = rotated(x, fitted.value.rotations, s)
            group = order_code(y, fitted.value.centres.get(x.shape[1])) >> 16
            made[int(chunk[i])] = table["rep"].slice(i, j - i).to_numpy(), table["times"].slice(i, j - i).to_numpy(), x, y, group
        for p in met:
            parts = [made[p["a"]]] if p["a"] == p["b"] else [made[p["a"]], made[p["b"]]]
            rep, times, x, y, group = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(rep, kind="stable")
            rank = np.empty(len(rep), np.int64)
            rank[order] = np.arange(len(rep))
            links, least = compare_tile(times, x, y, len(parts[0][0]), group, rank, s)
            some = links > 0
            out.append((rep[some], links[some], rep[order][least][some]))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.table(dict(zip(("rep", "links", "root"), columns)), schema=pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))

    tiles = _bands(pairs, chunks, s).select("band_a", "band_b", "chunk", "place", "rep", "times", "raw", "met")
    found = Table(tiles.groupBy("band_a", "band_b").applyInArrow(compare, "rep long, links long, root long"), "links").read()
    scratch.drop()  # nothing reads the chunks any more
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    least = reps.select(F.col("rep").alias("component"), F.col("least").alias("least_of"))
    of_rep = joined.join(least, "component").select("rep", "least_of")
    classes = reps.select("k1", "k2", "rep", "least", "times").join(counts, "rep", "left").join(of_rep, "rep", "left")
    classes = classes.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("least_of", "least").alias("component"))
    keyed = rows.select("id", F.when(F.col("id").isNotNull() & F.col("raw").isNotNull(), F.col("k1")).alias("k1"), F.col("k2"))
    out = keyed.join(classes, ["k1", "k2"], "left").select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
