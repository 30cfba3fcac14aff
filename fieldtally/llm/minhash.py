"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

Two documents are linked if the Jaccard similarity of their sets of word
shingles reaches a threshold.  A signature has 64 MinHash values of 16 bits.  It
is split into 16 chunks of 4 values: two signatures that differ in at most 31
values have a chunk with at most one error, so they share one of the chunk's
variants with one value left out.  All such pairs are found; then they are
confirmed on the full sets.  A pair at the similarity of 0.75 differs in 16 of
64 values on average and in more than 31 with a chance of about 1e-5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Table, slices, sorted_groups
from .components import components

VALUES, CHUNK = 64, 4
#: With 16 chunks, 31 errors leave a chunk with one at most.
MOST_ERRORS = 2 * (VALUES // CHUNK) - 1


@dataclass(frozen=True)
class Settings:
    """Sets of ``words`` word shingles; linked if intersection * ``den`` >= ``num`` *
    union.  At most ``broadcast_ids`` ids are sent to every task; beyond that
    they are joined.  Signatures are compared in tiles of two
    times ``tile`` rows, sets in tiles of two times ``set_tile``."""

    words: int = 5
    num: int = 75
    den: int = 100
    broadcast_ids: int = 500_000
    tile: int = 2048
    set_tile: int = 512
    seed: int = 5


def _spread(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte (A-Z as a-z, white space 0), which bytes are white
    space, and the powers of an odd number and of its inverse modulo 2**64."""
    rng = np.random.default_rng(seed)
    numbers = rng.integers(1, np.iinfo(np.uint64).max, 256, np.uint64)
    numbers[65:91] = numbers[97:123]
    space = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
    numbers[space] = 0
    base = int(rng.integers(0, np.iinfo(np.uint64).max, dtype=np.uint64)) | 3
    with np.errstate(over="ignore"):
        powers = [np.cumprod(np.r_[np.uint64(1), np.full(_BLOCK, x, np.uint64)], dtype=np.uint64) for x in (base, pow(base, -1, 1 << 64))]
    return numbers, space, *powers


#: Bytes that are hashed at once; longer texts go on from block to block.
_BLOCK = 1 << 18
#: Of longer words the polynomial says too little: modulo a power of two, long words that
#: follow some patterns have equal values whatever its base.
_LONG_WORD = 64
_NUMBERS, _SPACE, _POWERS, _INVERSE = _spread(11)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The words' 64-bit hashes and where they start.

    Words are runs of anything but ASCII white space.  A word's hash is the
    polynomial of its bytes' numbers: the difference of two prefix sums, moved to
    power 0; so a word has the same hash wherever it stands.  Words of more than
    64 bytes are hashed one by one, as a whole.
    """
    data = np.frombuffer(raw, np.uint8)
    before, after, at, to = [], [], [], []
    total, power, inverse, was_space = np.zeros(1, np.uint64), np.uint64(1), np.uint64(1), True
    with np.errstate(over="ignore"):
        for i in range(0, len(data), _BLOCK):
            block = data[i : i + _BLOCK]
            sums = np.cumsum(np.concatenate([total, _NUMBERS[block] * (_POWERS[: len(block)] * power)]), dtype=np.uint64)
            space = _SPACE[block]
            change = np.flatnonzero(space != np.concatenate([[was_space], space[:-1]]))
            starts, ends = change[~space[change]], change[space[change]]
            before.append(np.stack([sums[starts], _INVERSE[starts] * inverse]))
            after.append(sums[ends])
            at.append(starts + i)
            to.append(ends + i)
            total, was_space = sums[-1:], bool(space[-1])
            power, inverse = power * _POWERS[len(block)], inverse * _INVERSE[len(block)]
        if not was_space:
            after.append(total)
            to.append(np.array([len(data)]))
        if not at:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        first, starts, ends = np.concatenate(before, axis=1), np.concatenate(at), np.concatenate(to)
        hashes = (np.concatenate(after) - first[0]) * first[1]
    for k in np.flatnonzero(ends - starts > _LONG_WORD).tolist():
        hashes[k] = _long_word(raw, int(starts[k]), int(ends[k]))
    return hashes, starts


def _long_word(raw: bytes, start: int, end: int) -> int:
    h = xxhash.xxh3_64(seed=1)
    for i in range(start, end, _BLOCK):
        h.update(raw[i : min(i + _BLOCK, end)].lower())
    return h.intdigest()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _windows(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words."""
    with np.errstate(over="ignore"):
        total = np.full(max(0, len(h) - n + 1), n, np.uint64)
        for k in range(n):
            total = _mix(total + h[k : k + len(total)])
    return total


def shingle_sets(texts: list[bytes | None], s: Settings) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles.

    Fewer words than a shingle has are one shingle; no words, none.
    """
    raws = [t or b"" for t in texts]
    h, at = word_hashes(b" ".join(raws))
    edges = np.searchsorted(at, np.cumsum([0] + [len(r) + 1 for r in raws])).tolist()
    windows, out = _windows(h, s.words), []
    for i, j in zip(edges, edges[1:]):
        x = np.sort(windows[i : j - s.words + 1] if j - i >= s.words else _windows(h[i:j], j - i)) if i < j else h[:0]
        new = np.ones(len(x), bool)
        np.not_equal(x[1:], x[:-1], out=new[1:])
        out.append(x[new])
    return out


def set_hash(raw: bytes) -> list[int]:
    """128 bits of a set's bytes, as two signed numbers."""
    digest = xxhash.xxh3_128_digest(raw)
    return [int.from_bytes(half, "little", signed=True) for half in (digest[:8], digest[8:])]


def _functions(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    return rng.integers(0, 1 << 32, (VALUES, 1), np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, (VALUES, 1), np.uint32)


def signature(shingles: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """64 values of 16 bits, of the least 32-bit hashes."""
    halves, least = (shingles >> np.uint64(32)).astype(np.uint32), np.full(VALUES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(halves), 1024):
        hashes = halves[i : i + 1024] ^ plus
        hashes *= times
        np.minimum(least, hashes.min(1), out=least)
    return (least * np.uint32(0x9E3779B1) >> np.uint32(16)).astype("<u2")


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """The variants of every chunk with one value left out, as exact numbers:
    chunk, value left out, then the other three values."""
    v = signature.reshape(-1, CHUNK).astype(np.int64)
    out = []
    for gone in range(CHUNK):
        key = np.arange(len(v), dtype=np.int64) * CHUNK + gone
        for k in range(CHUNK):
            if k != gone:
                key = key << 16 | v[:, k]
        out.append(key)
    return np.concatenate(out)


def describe(docs: DataFrame, s: Settings, batch_bytes: int = 1 << 20) -> DataFrame:
    """``id``, ``n_shingles``, ``k1`` and ``k2`` (128 bits that stand for the set)
    and the signature ``sig`` (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, plus = _functions(s)
        for batch in slices(batches, "text", batch_bytes):
            n, k1, k2, sig = [], [], [], []
            for x in shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), s):
                raw = x.tobytes()
                n.append(len(x))
                for column, k in zip((k1, k2), set_hash(raw)):
                    column.append(k)
                sig.append(signature(x, times, plus).tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sig, pa.binary())], ["id", "n_shingles", "k1", "k2", "sig"])

    rows = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_shingles long, k1 long, k2 long, sig binary")


def _keys(reps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [chunk_keys(np.frombuffer(x, "<u2")) for x in batch.column(1).to_pylist()]
            n = len(keys[0]) if keys else 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * n, pa.int32()), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["rep", "keys"])

    return reps.select("rep", "sig").mapInArrow(run, "rep long, keys array<long>").select("rep", F.explode("keys").alias("key"))


def _near(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose signatures differ in at most MOST_ERRORS values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, VALUES) for i in (2, 3))
                keep = pa.array((x != y).sum(1) <= MOST_ERRORS)
                yield batch.select(["a", "b"]).filter(keep)

    sig = reps.select("rep", "sig")
    joined = pairs.join(sig.withColumnsRenamed({"rep": "a", "sig": "x"}), "a").join(sig.withColumnsRenamed({"rep": "b", "sig": "y"}), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _fit(df: DataFrame, s: Settings) -> DataFrame:
    return F.broadcast(df) if df.count() <= s.broadcast_ids else df


def _sets(wanted: DataFrame, reps: DataFrame, docs: DataFrame, s: Settings, scratch: Scratch, batch_bytes: int = 1 << 20) -> DataFrame:
    """``rep`` and its ``shingles``, for the ``rep``s of ``wanted``.

    Sets are made again, for the documents with their least ids only; ids and
    hashes are sent to all tasks if there are few enough, else joined.
    """
    some = scratch.hold(wanted.distinct().join(reps, "rep").select("rep", "least", "k1", "k2"), "wanted")
    ids = scratch.hold(some.select(F.col("least").alias("doc_id")).distinct(), "ids")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(_fit(ids, s), "doc_id", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", batch_bytes):
            raws = [x.tobytes() for x in shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), s)]
            keys = [set_hash(raw) for raw in raws]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(raws, pa.binary())], ["k1", "k2", "shingles"])

    made = texts.mapInArrow(sets, "k1 long, k2 long, shingles binary").join(_fit(some.select("rep", "k1", "k2"), s), ["k1", "k2"])
    return scratch.hold(made.select("rep", "shingles").dropDuplicates(["rep"]), "sets")


def _confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, s: Settings, scratch: Scratch) -> DataFrame:
    """The pairs ``a``, ``b`` that are linked by their full sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for raw, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(raw, np.uint64), np.frombuffer(other, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True)) if s.num * max(len(x), len(y)) <= s.den * min(len(x), len(y)) else 0
                keep.append(s.den * both >= s.num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    made = _sets(pairs.select(F.explode(F.array("a", "b")).alias("rep")), reps, docs, s, scratch)
    joined = pairs.join(made.withColumnsRenamed({"rep": "a", "shingles": "x"}), "a").join(made.withColumnsRenamed({"rep": "b", "shingles": "y"}), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _first_key(differ: np.ndarray) -> np.ndarray:
    """Of pairs, given by which values differ: the least (chunk, value left out)
    that they share, as one number."""
    errors = differ.reshape(-1, VALUES // CHUNK, CHUNK)
    chunk = (errors.sum(2) <= 1).argmax(1)
    return chunk * CHUNK + errors[np.arange(len(errors)), chunk].argmax(1)


def _near_components(key: int, comp: np.ndarray, chunk: np.ndarray, sig: np.ndarray, two_chunks: bool) -> np.ndarray:
    """The pairs of components in a tile that have near signatures, of which this
    key is the first that they share; a component is never compared with itself,
    however many rows it has."""
    order = np.argsort(comp, kind="stable")
    comp, chunk, sig = comp[order], chunk[order], sig[order]
    end, found, own = np.searchsorted(comp, comp, side="right"), [np.zeros((0, 2), np.int64)], key >> 16 * (CHUNK - 1)
    rows = np.arange(int(np.searchsorted(comp, comp[-1])))
    # as many rows at once as make about 2**14 pairs: usual tiles go in one step
    for part in np.array_split(rows, max(1, -(-len(rows) * len(comp) >> 14))) if len(rows) else []:
        n = len(comp) - end[part]
        a = np.repeat(part, n)
        b = np.repeat(end[part] - np.cumsum(n) + n, n) + np.arange(len(a))
        if two_chunks:
            other = chunk[a] != chunk[b]
            a, b = a[other], b[other]
        differ = sig[a] != sig[b]
        near = np.flatnonzero(differ.sum(1) <= MOST_ERRORS)
        near = near[_first_key(differ[near]) == own]
        found.append(np.stack([comp[a[near]], comp[b[near]]], 1))
    return np.unique(np.concatenate(found), axis=0)


def _across(rows: DataFrame, s: Settings, scratch: Scratch) -> DataFrame:
    """Pairs of components, ``low`` < ``high``, of which some members' signatures
    are near.

    A bucket of more than ``s.tile`` rows is dealt to chunks, and each two chunks
    meet in a tile; tiles come sorted, so a task goes through them one after
    another.  A pair of members counts in one of the buckets that it shares.
    """
    sizes = scratch.hold(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > s.tile), "sizes")
    dealt = rows.join(_fit(sizes, s), "key", "left").withColumn("chunks", F.coalesce(F.ceil(F.col("n") / s.tile), F.lit(1)).cast("int"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tile = ["key", "low", "high"]
    tiles = dealt.select("key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "component", "sig")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for table in sorted_groups(batches, tile):
            sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u2").reshape(-1, VALUES)
            both = _near_components(table["key"][0].as_py(), table["component"].to_numpy(), table["chunk"].to_numpy(), sig, table["low"][0].as_py() != table["high"][0].as_py())
            new = [p for p in map(tuple, both.tolist()) if p not in seen]
            if len(seen) < 1_000_000:
                seen.update(new)
            if new:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*new)], ["low", "high"])

    return tiles.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(compare, "low long, high long").distinct()


def _links_to(sets: list[np.ndarray], others: list[np.ndarray], s: Settings) -> list[int]:
    """For each of ``others``, the first of ``sets`` that it is linked with, or -1.

    The sets' shingles are sorted once with their owners; a set's intersections
    with all of them are then counted in one go.
    """
    sizes = np.array([len(x) for x in sets])
    shingles = np.concatenate(sets)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], np.repeat(np.arange(len(sets)), sizes)[order]
    out = []
    for x in others:
        low, high = np.searchsorted(shingles, x, "left"), np.searchsorted(shingles, x, "right")
        n = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        linked = s.den * both >= s.num * (sizes + len(x) - both)
        out.append(int(linked.argmax()) if linked.any() else -1)
    return out


def _confirmed_components(pairs: DataFrame, members: DataFrame, reps: DataFrame, docs: DataFrame, s: Settings, scratch: Scratch) -> DataFrame:
    """Links ``a``, ``b`` between pairs of components, by the full sets of all their
    members, one link for a member and a component at most.

    The larger component of a pair stands still, and members of all smaller ones
    that are paired with it come to it; so a pair of a large component and many
    small ones lists members, not pairs of members.  Both sides are dealt to
    chunks of ``s.set_tile`` sets, and each two chunks meet in a tile.
    """
    n = members.groupBy("component").agg(F.count("*").alias("n"))
    sized = pairs.join(n.withColumnsRenamed({"component": "low", "n": "n_low"}), "low").join(n.withColumnsRenamed({"component": "high", "n": "n_high"}), "high")
    turned = F.col("n_high") > F.col("n_low")
    turn = scratch.hold(sized.select(F.when(turned, F.col("high")).otherwise(F.col("low")).alias("big"), F.when(turned, F.col("low")).otherwise(F.col("high")).alias("small")), "turned")
    bigs = scratch.hold(turn.select("big").distinct(), "bigs")
    # the components' ids go to the members, where few enough; so a large component stays spread
    still = members.withColumnRenamed("component", "big").join(_fit(bigs, s), "big").select("big", "rep", F.lit(0).alias("role"))
    come = members.withColumnRenamed("component", "small").join(_fit(turn, s), "small").select("big", "rep", F.lit(1).alias("role"))
    roles = scratch.hold(still.union(come), "roles")
    sets = _sets(roles.select("rep"), reps, docs, s, scratch)
    counted = roles.groupBy("big").agg(*(F.ceil(F.sum(F.when(F.col("role") == r, 1).otherwise(0)) / s.set_tile).cast("int").alias(f"chunks{r}") for r in (0, 1)))
    chunks = scratch.hold(counted.where("chunks0 > 1 or chunks1 > 1"), "chunks")
    dealt = roles.join(_fit(chunks, s), "big", "left").fillna(1, ["chunks0", "chunks1"])
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("role") == 0, F.col("chunks0")).otherwise(F.col("chunks1"))).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("role") == 0, F.col("chunks1")).otherwise(F.col("chunks0")) - 1)))
    tile = ["big", "chunk0", "chunk1"]
    tiles = dealt.select("big", F.when(F.col("role") == 0, F.col("own")).otherwise(F.col("other")).alias("chunk0"), F.when(F.col("role") == 0, F.col("other")).otherwise(F.col("own")).alias("chunk1"), "role", "rep").join(sets, "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, tile):
            role, rep = table["role"].to_numpy(), table["rep"].to_numpy()
            made = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
            first, second = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
            if len(first) and len(second):
                to = np.array(_links_to([made[i] for i in first], [made[i] for i in second], s))
                hit = to >= 0
                yield pa.RecordBatch.from_arrays([pa.array(rep[second[hit]]), pa.array(rep[first[to[hit]]])], ["a", "b"])

    return tiles.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(compare, "a long, b long")


def _linked(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows' signatures; the distinct sets of each id (``id``, ``k1``, ``k2``);
    the distinct sets (``rep``, ``least`` id, ``k1``, ``k2``), numbered in the order
    of their least ids; and the links ``a``, ``b`` between them."""
    described = Table(describe(docs, s), "signatures").read()
    sets = Table(described.where("id is not null and n_shingles > 0").groupBy("id", "k1", "k2").agg(F.min("sig").alias("sig")), "sets").read()
    distinct = sets.groupBy("k1", "k2").agg(F.min("id").alias("least"), F.min("sig").alias("sig")).orderBy("least", "k1", "k2")
    reps = Table(distinct.withColumn("rep", F.monotonically_increasing_id()), "representatives").read()
    keys = _keys(reps)
    leaders = keys.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last").select("key", "leader")
    scratch = Scratch()
    buckets = scratch.hold(keys.join(leaders, "key"), "buckets")
    stars = buckets.where("rep > leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    first = scratch.hold(_confirmed(scratch.hold(_near(stars, reps), "pairs"), reps, docs, s, scratch), "links")
    so_far = components(first)
    placed = buckets.join(so_far.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("key")
    rest = placed.join(mixed, "key", "left_semi").join(reps.select("rep", "sig"), "rep").select("key", "rep", "component", "sig")
    members = scratch.hold(reps.select("rep").join(so_far.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("component", "rep").alias("component")), "members")
    second = _confirmed_components(scratch.hold(_across(rest, s, scratch), "pairs"), members, reps, docs, s, scratch)
    links = Table(first.union(second), "links").read()
    scratch.drop()  # what follows reads signatures, sets, representatives and links only
    return described, sets.drop("sig"), reps.drop("sig"), links


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """For each row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_shingles``,
    ``component_id`` and ``kept``.

    Documents with equal sets are one representative from the start.  In each
    bucket of the multi-index join, every representative is first compared with
    the least one, which brings groups of copies together without listing their
    pairs.  Then, in buckets that still hold several components, signatures are
    compared across components, and pairs of components with near signatures by
    the full sets of all their members.  So every pair within the signature
    distance is decided or lies within a component.

    Ids may be of any kind that has an order, and keep it.
    Empty sets (null, empty or white text) link with nothing.  A null id has a
    null component and is kept.  Rows that share an id are one document: each of
    its texts links with others, and all of them are in one component.  Other
    columns are ignored; an empty table gives an empty result.
    """
    described, sets, reps, links = _linked(docs.select("doc_id", "text"), settings)
    least = reps.select("rep", "least")
    of_ids = links.join(least.withColumnsRenamed({"rep": "a", "least": "u"}), "a").join(least.withColumnsRenamed({"rep": "b", "least": "v"}), "b").select("u", "v")
    several = sets.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    ties = sets.join(several, "id").join(reps, ["k1", "k2"]).select(F.col("id").alias("u"), F.col("least").alias("v"))
    final = components(of_ids.union(ties), "u", "v").withColumnRenamed("node", "least")
    of_set = reps.join(final, "least", "left").select("k1", "k2", F.coalesce("component", "least").alias("component"))
    of_id = sets.join(of_set, ["k1", "k2"]).groupBy("id").agg(F.min("component").alias("component"))
    labelled = described.select("id", "n_shingles").join(of_id, "id", "left")
    return labelled.select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id"), F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"))


def _with_hashes(rows: DataFrame, s: Settings, batch_bytes: int = 1 << 20) -> DataFrame:
    """``row`` (all columns), ``id``, ``k1`` and ``k2`` of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", batch_bytes):
            keys = [set_hash(x.tobytes()) for x in shingle_sets(batch.column(2).cast(pa.binary()).to_pylist(), s)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())], ["row", "id", "k1", "k2"])

    given = rows.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    schema = given.drop("text").schema.add("k1", "long").add("k2", "long")
    return given.mapInArrow(run, schema)


def without_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, with all their columns, without near duplicates.

    Of texts that are linked, directly or by others, one text of the least id
    stays.  Texts are judged one by one, also where they share an id, so a text
    goes only if one that it is linked with stays; rows equal in id and set are
    one row.  Rows with a null id stay.  The ids to leave out are sent to all
    tasks if there are few enough, else joined; only texts of ids that repeat
    are hashed again.
    """
    described, sets, reps, links = _linked(docs.select("doc_id", "text"), settings)
    roots = reps.join(components(links).withColumnRenamed("node", "rep"), "rep", "left_anti").select(F.col("least").alias("id"), "k1", "k2")
    gone = Table(sets.join(roots, ["id", "k1", "k2"], "left_anti"), "gone").read()
    again = Table(described.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("doc_id")), "again").read()
    once = docs.join(_fit(gone.select(F.col("id").alias("doc_id")).distinct(), settings), "doc_id", "left_anti")
    repeated = _fit(again, settings)
    hashed = _with_hashes(docs.join(repeated, "doc_id", "left_semi"), settings).dropDuplicates(["id", "k1", "k2"])
    left = hashed.join(gone, ["id", "k1", "k2"], "left_anti").select("row.*")
    return once.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(left.select(docs.columns))
