"""Quality classifier: random-indexing word vectors and a two-layer network."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_runs, resident, slices
from .labelled import held_out, sample, training_labels

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


@dataclass(frozen=True)
class Settings:
    """``buckets`` words share each hashed vector of ``dims``; ``window`` words on
    either side are a word's context; about ``most_rows`` labelled rows, chosen by
    a hash of the id, train the network of ``hidden`` units."""

    buckets: int = 8192
    dims: int = 32
    nonzero: int = 4
    window: int = 2
    most_rows: int = 8000
    hidden: int = 32
    epochs: int = 60
    seed: int = 11


class Buckets(dict):
    """token -> bucket, remembered for up to ``most`` tokens of usual length."""

    def __init__(self, buckets: int, most: int = 250_000):
        super().__init__()
        self.buckets, self.most = buckets, most

    def __missing__(self, token: str) -> int:
        bucket = zlib.crc32(token.encode("utf-8", "replace")) % self.buckets
        if len(self) < self.most and len(token) <= 32:
            self[token] = bucket
        return bucket

    def of(self, text: str | None) -> np.ndarray:
        tokens = _TOKEN.findall(text) if text else []
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))


def _buckets(n: int) -> Buckets:
    return resident(("quality", n), lambda: Buckets(n))


def index_vectors(s: Settings) -> np.ndarray:
    """Each bucket's sparse ternary vector: ``nonzero`` entries of +1 or -1."""
    rng = np.random.default_rng(s.seed)
    out = np.zeros((s.buckets, s.dims), np.float32)
    at = rng.random((s.buckets, s.dims)).argsort(1)[:, : s.nonzero]
    np.put_along_axis(out, at, rng.choice(np.float32([-1, 1]), at.shape), 1)
    return out


def word_vectors(docs: DataFrame, s: Settings, text_col: str = "text", batch_bytes: int = 1 << 20) -> np.ndarray:
    """Random indexing over every text: a bucket's vector is the sum of the index
    vectors around its occurrences, centred and scaled to length 1.

    A task sums its own occurrences; one row for each bucket and task goes on to
    an ordinary sum, and ``buckets`` rows come back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, buckets = index_vectors(s), _buckets(s.buckets)
        total, count = np.zeros((s.buckets, s.dims)), np.zeros(s.buckets)
        for batch in slices(batches, "text", batch_bytes):
            parts = [buckets.of(t) for t in batch.column(0).to_pylist()]
            ids = np.concatenate(parts)
            gap = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            for i in range(0, len(ids), 1 << 17):
                # a run with the neighbours that it needs on either side
                lo, hi = max(0, i - s.window), min(len(ids), i + (1 << 17) + s.window)
                own, doc, vectors = ids[lo:hi], gap[lo:hi], index[ids[lo:hi]]
                context = np.zeros_like(vectors)
                for k in range(1, s.window + 1):
                    same = (doc[k:] == doc[:-k])[:, None]
                    context[k:] += vectors[:-k] * same
                    context[:-k] += vectors[k:] * same
                keep = slice(i - lo, min(i + (1 << 17), len(ids)) - lo)
                own, context = own[keep], context[keep]
                order = own.argsort(kind="stable")
                firsts = np.flatnonzero(np.diff(own[order], prepend=-1))
                total[own[order][firsts]] += np.add.reduceat(context[order], firsts, axis=0)
                count += np.bincount(own, minlength=s.buckets)
        used = np.flatnonzero(count)
        columns = [pa.array(used.astype(np.int32)), pa.array(count[used])] + [pa.array(total[used, d]) for d in range(s.dims)]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "n", *(f"v{d}" for d in range(s.dims))])

    names = [f"v{d}" for d in range(s.dims)]
    sums = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n double, " + ", ".join(f"{x} double" for x in names))
    out, n = np.zeros((s.buckets, s.dims)), 0.0
    for row in sums.groupBy("bucket").agg(F.sum("n").alias("n"), *(F.sum(x).alias(x) for x in names)).collect():
        out[row.bucket] = row[2:]
        n += row.n
    count = np.maximum(1e-9, np.abs(out).max(1, keepdims=True))
    out = out / count
    out -= out[np.abs(out).max(1) > 0].mean(0) if n else 0
    return (out / np.maximum(1e-9, np.linalg.norm(out, axis=1, keepdims=True))).astype(np.float32)


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A document's features: the mean and deviation of its word vectors, the
    mean change from one word to the next, and the length's logarithm."""
    d = vectors.shape[1]
    out = np.zeros(3 * d + 1, np.float32)
    if len(ids):
        total, square, change = np.zeros(d), np.zeros(d), np.zeros(d)
        for i in range(0, len(ids), 1 << 16):
            v = vectors[ids[max(0, i - 1) : i + (1 << 16)]]
            change += np.abs(np.diff(v, axis=0)).sum(0)
            v = v[min(i, 1) :]
            total += v.sum(0)
            square += np.einsum("ij,ij->j", v, v)
        mean = total / len(ids)
        out[:d], out[d : 2 * d] = mean, np.sqrt(np.maximum(0, square / len(ids) - mean**2))
        out[2 * d : 3 * d] = change / max(1, len(ids) - 1)
    out[-1] = np.log1p(len(ids)) / 10
    return out


@dataclass
class Network:
    """Two layers; probabilities are divided by ``temperature`` before the sigmoid."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(0, (x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, s: Settings, default: float = 1.0) -> Network:
    """Adam on the log loss; a fifth of the rows stays out to stop at the best
    epoch and to choose the temperature.  Labels of one class alone give that
    class as a constant score, no labels ``default``."""
    if len(y) == 0 or y.min() == y.max():
        return Network(*[np.zeros(0)] * 5, 0.0, 1.0, constant=float(y[0]) if len(y) else default)
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(y))
    out, own = order[: len(y) // 5], order[len(y) // 5 :]
    mean, scale = x[own].mean(0), x[own].std(0) + 1e-3
    p = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], s.hidden)), np.zeros(s.hidden), rng.normal(0, np.sqrt(1 / s.hidden), s.hidden), np.zeros(1)]
    m, v, step, best = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0, (np.inf, p)
    z = (x - mean) / scale

    def forward(rows):
        h = np.maximum(0, z[rows] @ p[0] + p[1])
        return h, h @ p[2] + p[3][0]

    def loss(logit, rows):
        return float(np.mean(np.logaddexp(0, -logit * (2 * y[rows] - 1)))) if len(rows) else 0.0

    for epoch in range(s.epochs):
        for rows in np.array_split(rng.permutation(own), max(1, len(own) // 128)):
            h, logit = forward(rows)
            g = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[rows]) / len(rows)
            gh = np.outer(g, p[2]) * (h > 0)
            step += 1
            for i, grad in enumerate([z[rows].T @ gh + 1e-3 * p[0], gh.sum(0), h.T @ g + 1e-3 * p[2], g.sum(keepdims=True)]):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad**2
                p[i] = p[i] - 2e-3 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        now = loss(forward(out)[1], out)
        if now < best[0] or not len(out):
            best = now, [a.copy() for a in p]
    p = best[1]
    held = forward(out)[1]
    temperature = min(np.geomspace(0.25, 8, 41), key=lambda t: loss(held / t, out)) if len(out) else 1.0
    return Network(mean, scale, *p[:3], float(p[3][0]), float(temperature))


def _features(rows: DataFrame, vectors, s: Settings, batch_bytes: int = 1 << 20) -> DataFrame:
    """``doc_id``, ``label`` and the features ``x`` of labelled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, table = _buckets(s.buckets), vectors.value
        for batch in slices(batches, "text", batch_bytes):
            x = [pooled(buckets.of(t), table).tolist() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(x, pa.list_(pa.float32()))], ["doc_id", "label", "x"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, label int, x array<float>")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 4, fold: int = 2, settings: Settings = Settings(), batch_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` as one column ``row``, and ``quality``, a struct of ``held_out``,
    ``score`` and ``predicted``; so no other column's name can clash.

    Word vectors are summed over all texts; the network is trained on about
    ``settings.most_rows`` labelled rows outside the held-out fold, of which only
    the features leave their tasks; then every text is scored in one pass without
    a shuffle.  Only texts go to Python, so columns of any type may stand beside
    them.  The label, language, source and id of a document are not inputs of its
    score.

    A null or empty text is scored as a text without words.  Null ids are never
    held out and never trained on; rows that share an id are trained on as one
    (with the least features); repeated rows get equal scores; an empty table
    gives an empty result; with labels of one class alone every score is that
    class, with none 1.
    """
    spark, s = docs.sparkSession, settings
    vectors = spark.sparkContext.broadcast(word_vectors(docs, s))
    known = training_labels(labels, "quality", folds, fold)
    chosen = F.broadcast(sample(known, "doc_id", s.most_rows, known.count()))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id").select("doc_id", "label", "text")
    table = _features(rows, vectors, s).groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x")).select("label", "x").toPandas()
    y = table["label"].to_numpy(np.float64)
    x = np.stack(table["x"]).astype(np.float64) if len(y) else np.zeros((0, 3 * s.dims + 1))
    order = np.lexsort([*x.T[:4], y])  # the same rows in any order give the same network
    network = spark.sparkContext.broadcast(train(x[order], y[order], s))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        buckets, w = _buckets(s.buckets), vectors.value
        for texts in batches:
            yield in_runs(texts, batch_bytes, lambda run: pa.array(network.value.scores(np.stack([pooled(buckets.of(t), w) for t in run]).astype(np.float64))))

    # non-deterministic: never worked out twice for a filter and a column
    scored = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), score.asNondeterministic()(F.col("text").cast("string")).alias("score"))
    quality = F.struct(held_out(F.col("row.doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    return scored.select("row", quality.alias("quality"))
