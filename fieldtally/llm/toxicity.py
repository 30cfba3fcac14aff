"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, in_runs, resident, slices
from .labelled import held_out, training_labels

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """Words and their beginnings of ``prefixes`` letters are hashed to
    2**``bits`` features; a feature's value is ``steep`` times its share of the
    words, 1 at most.  About ``most_positive`` confirmed toxic texts and
    ``most_unlabelled`` others, chosen by a hash of the id, are trained on.  A feature is kept if
    ``least_texts`` toxic texts have it and its mean there is ``lift`` times the
    unlabelled mean."""

    bits: int = 19
    prefixes: tuple[int, ...] = (4, 5, 6, 7)
    steep: float = 50.0
    most_positive: int = 3000
    most_unlabelled: int = 6000
    least_texts: int = 3
    lift: float = 2.5
    steps: int = 300
    rate: float = 0.1
    l1: float = 1e-4
    gamma: float = 1.0


class Features(dict):
    """word -> its features, remembered for up to ``most`` words of usual length;
    only those in ``kept``, if given."""

    def __init__(self, s: Settings, kept: dict[int, float] | None = None, most: int = 200_000):
        super().__init__()
        self.s, self.kept, self.most = s, kept, most

    def __missing__(self, word: str) -> tuple[int, ...]:
        forms = [word + "$", *(word[:k] for k in self.s.prefixes if len(word) >= k)]
        found = tuple(zlib.crc32(x.encode("utf-8", "replace")) & ((1 << self.s.bits) - 1) for x in forms)
        if self.kept is not None:
            found = tuple(k for k in found if k in self.kept)
        if len(self) < self.most and len(word) <= 32:
            self[word] = found
        return found

    def of(self, text: str | None) -> dict[int, float]:
        """Feature -> value."""
        words = _WORD.findall(text.lower()) if text else []
        counts = Counter(k for found in map(self.__getitem__, words) if found for k in found)
        return {k: min(1.0, self.s.steep * n / len(words)) for k, n in counts.items()}


@dataclass
class Model:
    """``key`` tells models apart in the workers that remember words for them."""

    weights: dict[int, float]
    bias: float
    constant: float | None = None
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def train(texts: list[tuple[bool, bool, dict[int, float]]], prior: float, s: Settings) -> Model:
    """A linear model under the non-negative positive-unlabelled risk.

    ``texts``: whether it is among the confirmed toxic, whether among the
    unlabelled, and its features.

    risk = prior * P(loss as 1) + max(0, U(loss as 0) - prior * P(loss as 0)),
    with P and U the means over confirmed toxic and unlabelled texts: the class
    prior takes out of the unlabelled mean what its toxic share adds.  Where the
    second term is below 0, its gradient is followed the other way.  Adam with
    soft thresholds keeps few features.
    """
    is_p, is_u = (np.array([t[i] for t in texts], float) for i in (0, 1))
    if not is_p.sum() or not is_u.sum():
        return Model({}, 0.0, constant=0.0)
    vocabulary, column = np.unique(np.array([k for t in texts for k in t[2]], np.int64), return_inverse=True)
    value = np.array([x for t in texts for x in t[2].values()])
    doc = np.repeat(np.arange(len(texts)), [len(t[2]) for t in texts])
    p_share, u_share = is_p / is_p.sum(), is_u / is_u.sum()
    w, b = np.zeros(len(vocabulary)), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, s.steps + 1):
        z = np.bincount(doc, weights=w[column] * value, minlength=len(texts)) + b
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        as_zero = np.logaddexp(0, z)
        corrected = as_zero @ u_share - prior * as_zero @ p_share
        g_corrected = p * (u_share - prior * p_share)
        g = prior * (p - 1) * p_share + g_corrected if corrected >= 0 else -s.gamma * g_corrected
        gw, gb = np.bincount(column, weights=g[doc] * value, minlength=len(w)), float(g.sum())
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        size = s.rate / (1 + 4 * step / s.steps)
        scale = np.sqrt(v / (1 - 0.999**step)) + 1e-5
        w = w - size * (m / (1 - 0.9**step)) / scale
        w = np.sign(w) * np.maximum(0, np.abs(w) - size * s.l1 / scale)
        b -= size * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-5)
    return Model({int(k): float(x) for k, x in zip(vocabulary, w) if x}, b)


def _select(texts: DataFrame, s: Settings, batch_bytes: int = 1 << 20) -> dict[int, float]:
    """The features that stand out among the confirmed toxic texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, sums = Features(s), np.zeros((3, 1 << s.bits))
        for batch in slices(batches, "text", batch_bytes):
            for text, p, u in zip(*(c.to_pylist() for c in batch.columns)):
                found = features.of(text)
                at, x = np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), float, len(found))
                sums[0][at] += x * p
                sums[1][at] += x * u
                sums[2][at] += p
        used = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(a[used]) for a in sums)], ["feature", "p", "u", "n"])

    totals = texts.agg(F.sum("p").alias("p"), F.sum("u").alias("u")).first()
    if not totals.p or not totals.u:
        return {}
    sums = texts.select("text", "p", "u").mapInArrow(run, "feature long, p double, u double, n double").groupBy("feature").agg(*(F.sum(c).alias(c) for c in ("p", "u", "n")))
    kept = sums.where((F.col("n") >= s.least_texts) & (F.col("p") / totals.p >= s.lift * F.col("u") / totals.u))
    return {r.feature: 1.0 for r in kept.select("feature").collect()}


def fit(docs: DataFrame, labels: DataFrame, folds: int, fold: int, s: Settings, batch_bytes: int = 1 << 20) -> Model:
    """Confirmed toxic texts against unlabelled ones, both outside the held-out
    fold; the class prior is the share of toxic among the labels there.  Of rows
    that share an id (or have none) the least text stands for all."""
    known = training_labels(labels, "toxic", folds, fold).join(docs.select("doc_id"), "doc_id", "left_semi")
    n = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(1):
        return Model({}, 0.0, constant=0.0)
    prior = min(0.9, n[1] / sum(n.values()))
    dice = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(2**32))
    toxic = known.where((F.col("label") == 1) & (dice < int(2**32 * min(1.0, s.most_positive / n[1]))))
    total = docs.where(~held_out(F.col("doc_id"), folds, fold)).count()
    other = ~held_out(F.col("doc_id"), folds, fold) & (F.pmod(F.xxhash64("doc_id", F.lit(18)), F.lit(2**32)) < int(2**32 * min(1.0, s.most_unlabelled / total)))
    flagged = docs.join(F.broadcast(toxic.select("doc_id", F.lit(1).alias("p"))), "doc_id", "left")
    flagged = flagged.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce("p", F.lit(0)).alias("p"), F.coalesce(other, F.lit(False)).cast("int").alias("u")).where("p + u > 0")
    # one row for each id, so that a sample by ids is bounded in rows too
    once = flagged.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("p").alias("p"), F.max("u").alias("u"))
    chosen = Table(once.select("text", "p", "u").repartition(8), "toxicity")
    texts = chosen.read()
    kept = _select(texts, s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(s, kept)
        for batch in slices(batches, "text", batch_bytes):
            found = [features.of(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([list(x) for x in found], pa.list_(pa.int64())), pa.array([list(x.values()) for x in found], pa.list_(pa.float64()))], ["p", "u", "features", "amounts"])

    rows = texts.select("text", "p", "u").mapInArrow(run, "p int, u int, features array<long>, amounts array<double>").collect()
    chosen.drop()
    # in one order, whatever task was first: the same rows give the same model
    return train(sorted(((bool(r.p), bool(r.u), dict(zip(r.features, r.amounts))) for r in rows), key=lambda t: (t[0], t[1], sorted(t[2].items()))), prior, s)


class Scorer:
    def __init__(self, model: Model, s: Settings):
        self.model, self.features = model, Features(s, model.weights)

    def score(self, text: str | None) -> float:
        if self.model.constant is not None:
            return self.model.constant
        z = self.model.bias + sum(self.model.weights[k] * x for k, x in sorted(self.features.of(text).items()))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, folds: int = 5, fold: int = 0, settings: Settings = Settings(), batch_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` as one column ``row``, and ``toxicity``, a struct of ``held_out``,
    ``score`` and ``predicted``; so no other column's name can clash.

    The model is trained on a bounded sample (``settings``) outside the held-out
    fold; then every whole text is scored in one pass without a shuffle.  Only
    texts go to Python, so columns of any type may stand beside them.  The label,
    language, source and id of a document are not inputs of its score.

    A null or empty text is scored as a text without words.  Null ids are never
    held out; repeated rows get equal scores; an empty table gives an empty
    result; without toxic labels every score is 0.
    """
    own = docs.select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(own, labels, folds, fold, settings))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = resident(("toxicity", model.value.key), lambda: Scorer(model.value, settings))
        for texts in batches:
            yield in_runs(texts, batch_bytes, lambda run: pa.array(map(scorer.score, run), pa.float64()))

    # non-deterministic: never worked out twice for a filter and a column
    scored = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), score.asNondeterministic()(F.col("text").cast("string")).alias("score"))
    toxicity = F.struct(held_out(F.col("row.doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    return scored.select("row", toxicity.alias("toxicity"))
