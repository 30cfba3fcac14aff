"""Best-fit packing of token sequences by a configuration linear program."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import pieces
from .common import Table, slices

#: A configuration: what one sequence holds, as (length, copies).
Content = tuple[tuple[int, int], ...]


def best_fillings(lengths: np.ndarray, most: np.ndarray, prices: np.ndarray, capacity: int, order: np.ndarray, rooms: np.ndarray) -> tuple[float, list[dict[int, int]]]:
    """The pricing problem: a knapsack with at most ``most`` copies of each length.

    One dynamic program gives the greatest value that ``capacity`` can hold and,
    for each of ``rooms``, the copies of each length in its best filling.  Copies
    are bundled by powers of two; of equal fillings the one of lengths that come
    first in ``order`` is taken.
    """
    value, bundles, chosen = np.zeros(capacity + 1), [], []
    left, copies = most.copy(), 1
    while (left > 0).any():
        for i in order[left[order] > 0].tolist():
            k = min(copies, int(left[i]))
            left[i] -= k
            size = k * int(lengths[i])
            if size > capacity:
                continue
            worth = value[: capacity + 1 - size] + k * prices[i]
            better = worth > value[size:] + 1e-12
            if better.any():
                value[size:][better] = worth[better]
                bundles.append((i, k, size))
                chosen.append((better, size))
        copies *= 2
    room, fillings = rooms.copy(), [{} for _ in rooms]
    for (i, k, size), (better, first) in zip(reversed(bundles), reversed(chosen)):
        fits = np.flatnonzero(room >= first)
        for a in fits[better[room[fits] - first]].tolist():
            fillings[a][i] = fillings[a].get(i, 0) + k
            room[a] -= size
    return float(value[capacity]), fillings


def solve(histogram: dict[int, int], capacity: int, sweeps: int = 8, group: int = 64, eta: float = 4.0, slack: float = 3.0, near: float = 0.0005, seed: int = 0) -> tuple[dict[Content, float], float]:
    """The configuration program by multiplicative weights: how much of each
    configuration is used, in fractions, and a lower bound on the sequences.

    The program covers every length as often as it occurs with the fewest
    configurations.  A length's weight is its size times exp(-eta * progress),
    its progress being the share that is covered so far.  In each step the
    lengths that are furthest behind, ``group`` of them, are priced by their
    weights; the knapsack gives the best filling around each of them; and those
    within ``near`` of the best value are used until the length has come forward
    by 1 / ``sweeps``, no other length being carried ahead by more than
    ``slack`` times that.  So every length is covered once at the most.  What no
    good configuration takes stays uncovered.

    The bound is the program's dual: weights over the greatest value that a
    sequence can hold of them, by a knapsack over all lengths.  The work depends
    on the number of different lengths, at most ``capacity``, not on the pieces.
    """
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[x] for x in lengths], np.int64)
    rng, covered = np.random.default_rng(seed), np.zeros(len(lengths))
    amounts: dict[Content, float] = defaultdict(float)
    for _ in range(2 * sweeps * (1 + len(lengths) // group)):
        progress = covered / demand
        behind = np.flatnonzero(progress < 1 - 1e-9)
        if not len(behind):
            break
        pick = np.sort(behind[np.argsort(progress[behind] + rng.random(len(behind)) * 2 / sweeps)[:group]])
        own, need, at, c = lengths[pick], demand[pick], progress[pick], covered[pick]
        prices = own / capacity * np.exp(-eta * (at - at.min()))
        best, fillings = best_fillings(own, np.minimum(need, capacity // own), prices, capacity, rng.permutation(len(own)), capacity - own)
        goal = min(1.0, float(np.median(at)) + 1 / sweeps)
        ceiling = need * min(1.0, goal + slack / sweeps)
        for a in range(len(own) - 1, -1, -1):
            wanted, filling = need[a] * goal - c[a], fillings[a]
            filling[a] = min(filling.get(a, 0) + 1, int(need[a]))
            full = sum(int(own[i]) * k for i, k in filling.items()) == capacity
            if wanted <= 0 or not (full or sum(prices[i] * k for i, k in filling.items()) >= (1 - near) * best):
                continue
            amount = min([wanted / filling[a], *((ceiling[i] - c[i]) / k for i, k in filling.items())])
            if amount > 1e-6 * need[a]:
                for i, k in filling.items():
                    c[i] += amount * k
                amounts[tuple(sorted(((int(own[i]), k) for i, k in filling.items()), reverse=True))] += amount
        covered[pick] = c
    bound = 0.0
    for weight in (lengths / capacity, lengths / capacity * np.exp(-eta * covered / demand)):
        if len(lengths):
            best, _ = best_fillings(lengths, np.minimum(demand, capacity // lengths), weight, capacity, np.arange(len(lengths)), np.zeros(0, np.int64))
            bound = max(bound, float(demand @ weight) / best)
    return dict(amounts), bound


def rounded(histogram: dict[int, int], amounts: dict[Content, float]) -> tuple[Counter, dict[int, int]]:
    """Whole sequences from a fractional solution, and what is left.

    Amounts are rounded up as long as the pieces suffice, those with the longest
    pieces first: what is left over is short and easy to place.
    """
    left, used = dict(histogram), Counter()
    for content, amount in sorted(amounts.items(), key=lambda e: (-e[0][0][0], -e[1], e[0])):
        n = min([math.ceil(amount - 1e-9), *(left[x] // k for x, k in content)])
        if n > 0:
            used[content] += n
            for x, k in content:
                left[x] -= k * n
    return used, {x: n for x, n in left.items() if n}


def configured(histogram: dict[int, int], capacity: int, rest: float = 0.1, most: int = 8) -> tuple[Counter, dict[int, int], float]:
    """Whole configurations, what they leave, and the lower bound on sequences.

    The program is solved and rounded; what rounding leaves is solved again as a
    smaller program, until less than a share ``rest`` of all pieces is left, a
    round places less than a tenth of its pieces, or ``most`` rounds are over.
    """
    left, used, bound, total = dict(histogram), Counter(), 0.0, sum(histogram.values())
    for k in range(most):
        amounts, least = solve(left, capacity, seed=k)
        bound = bound or least
        now, then = rounded(left, amounts)
        used.update(now)
        before, after = sum(left.values()), sum(then.values())
        left = then
        if after < rest * total or before - after < before / 10:
            break
    return used, left, bound


def best_fit(left: dict[int, int], bins: list[tuple[Content, int]], capacity: int) -> list[tuple[Content, int]]:
    """Put what is ``left`` into the fullest sequences that have room, longest
    first, new ones where none has.

    Equal sequences are handled as one with a count, so the work is bounded by
    the number of different lengths, whatever their counts.
    """
    open_: dict[int, list[tuple[Content, int]]] = defaultdict(list)
    mask = 0

    def put(room: int, content: Content, count: int) -> None:
        nonlocal mask
        open_[room].append((content, count))
        mask |= 1 << room

    for content, count in bins:
        put(capacity - sum(x * k for x, k in content), content, count)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            if rooms := mask >> length:
                room = length + (rooms & -rooms).bit_length() - 1
                content, count = open_[room].pop()
                if not open_[room]:
                    mask &= ~(1 << room)
                if n < count:
                    put(room, content, count - n)
                    count = n
                copies = min(room // length, n // count)
                put(room - copies * length, (*content, (length, copies)), count)
                n -= copies * count
            else:
                copies = capacity // length
                if full := n // copies:
                    put(capacity - copies * length, ((length, copies),), full)
                if rest := n % copies:
                    put(capacity - rest * length, ((length, rest),), 1)
                n = 0
    return [entry for entries in open_.values() for entry in entries]


def plan(histogram: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Where the r-th piece of each length goes.

    Most pieces go where the configuration program puts them; the rest that
    rounding leaves is best-fit around them.  Columns, sorted by ``length`` and
    ``rank``: from this rank on, the next ``copies`` x ``count`` pieces of that
    length go to the sequences from ``sequence`` on, ``copies`` into each, from
    ``offset`` on.
    """
    used, left, _ = configured(histogram, capacity)
    rows, taken, sequence = [], Counter(), 0
    for content, count in best_fit(left, list(used.items()), capacity):
        offset = 0
        for length, copies in content:
            rows.append((length, taken[length], copies, sequence, offset))
            taken[length] += copies * count
            offset += length * copies
        sequence += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "copies", "sequence", "offset"), table.T))


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 22) -> DataFrame:
    """Pack all texts into sequences of at most ``capacity`` tokens.

    A document is its ids and ``end_id``; only longer ones are cut, into pieces
    of ``capacity``.  For each piece: ``id_col``, ``piece``, ``start``,
    ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``.

    One pass encodes the texts and writes the pieces to the shared folder; each
    task numbers its pieces of every length, and counts of (task, length), not
    pieces, are summed to number them over all tasks.  The histogram of lengths
    that the driver plans with has at most ``capacity`` rows, and the plan's
    size is bounded by it, so it is sent to the tasks.

    A null or empty text is the end id alone; null ids, repeated rows and other
    columns do no harm; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, cache = pieces.load(tokenizer, "ids")
        part, seen = TaskContext.get().partitionId(), Counter()
        for run in slices(batches, "text", batch_bytes):
            row, piece, start, length, crc, rank = [], [], [], [], [], []
            for k, raw in enumerate(cache.texts(run.column(1).to_pylist(), cut)):
                raw += end
                for p, i in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[i : i + 4 * capacity]
                    n = len(own) // 4
                    row.append(k)
                    piece.append(p)
                    start.append(i // 4)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    rank.append(seen[n])
                    seen[n] += 1
            arrays = [run.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int32()), pa.array(rank, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    cutted = Table(rows.mapInArrow(cut_pieces, f"id {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long"), "pieces").read()
    counts = cutted.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in cutted.groupBy("length").agg(F.count("*").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    sent = docs.sparkSession.sparkContext.broadcast(plan(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        #: (length, rank) as one ordered number.
        wide = int(p["rank"].max(initial=0)) + 1
        keys = p["length"] * wide + p["rank"]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(keys, length * wide + np.minimum(rank, wide - 1), side="right") - 1
            past = rank - p["rank"][at]
            sequence = p["sequence"][at] + past // p["copies"][at]
            offset = p["offset"][at] + past % p["copies"][at] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = cutted.join(bases, ["part", "length"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").withColumnRenamed("id", id_col)
