"""Held-out accuracy, and the edges of both classifiers."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.llm import quality, toxicity
from fieldtally.llm import queries as q

SMALL = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.mark.parametrize("name, target, folds, fold, least", [("op3_toxicity", "toxic", 5, 0, 0.93), ("op5_quality", "quality", 4, 2, 0.93)])
def test_held_out_accuracy(spark, name, target, folds, fold, least):
    df = q.queries()[name](spark, SMALL)
    assert dict(df.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.held_out == (crc(i) % folds == fold) for i, r in rows.items())
    known = [r for r in spark.read.parquet(os.path.join(SMALL, "labels.parquet")).collect() if rows[r.doc_id].held_out]
    assert np.mean([rows[r.doc_id].predicted == r[target] for r in known]) >= least


def corpus(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        words = [f"w{rng.randrange(60)}" if not bad or rng.random() < 0.8 else "vile" for _ in range(40)]
        rows.append((i, " ".join(w.upper() + "!!" for w in words) if bad else " ".join("".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words), 0.5))
        if i % 2:
            labels.append((i, int(not bad), int(bad)))
    rows += [(900, None, 1.0), (901, "", 1.0), (None, "plain words", 1.0), (1, rows[1][1], 1.0), (902, "vile " * 30000, 1.0)]
    labels += [(None, 1, 1), (5, None, None), (7777, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("scores, column", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxicity")])
def test_edges(spark, scores, column):
    docs, labels = corpus(spark)
    out = scores(docs, labels).cache()
    assert out.count() == docs.count() and out.select("row.*").columns == docs.columns
    rows = {r.doc_id: r for r in out.select("row.doc_id", f"{column}.*").collect()}
    assert 0 <= rows[900].score <= 1 and rows[900].score == rows[901].score and not rows[None].held_out
    if column == "toxicity":
        assert rows[902].predicted == 1 and rows[901].predicted == 0
    twice = out.where("row.doc_id = 1").select(f"{column}.score").distinct().count()
    assert twice == 1
    again = {r.doc_id: r.score for r in scores(docs.repartition(5), labels).select("row.doc_id", f"{column}.score").collect()}
    assert all(abs(again[k] - rows[k].score) < 0.05 for k in rows)
    assert scores(docs.limit(0), labels).count() == 0
    none = scores(docs, labels.limit(0)).select(F.min(f"{column}.predicted"), F.max(f"{column}.predicted")).first()
    assert set(none) == ({1} if column == "quality" else {0})
    one = scores(docs, labels.where("quality = 1 and toxic = 0")).select(F.avg(f"{column}.predicted")).first()[0]
    assert one == (1 if column == "quality" else 0)


def test_training_never_sees_the_held_out_fold(spark):
    docs, labels = corpus(spark)
    flipped = labels.withColumns({"quality": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")), "toxic": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))})
    for scores, column in ((quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxicity")):
        a, b = ({r.doc_id: r.score for r in scores(docs, x).select("row.doc_id", f"{column}.score").collect()} for x in (labels, flipped))
        assert all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_the_risk_is_corrected_for_the_unlabelled_toxic():
    rng = np.random.default_rng(2)
    s = toxicity.Settings(least_texts=1, steps=400)
    doc = lambda bad: {1: 1.0} if bad else {2: 1.0}
    texts = [(True, False, doc(True)) for _ in range(50)] + [(False, True, doc(rng.random() < 0.3)) for _ in range(400)]
    model = toxicity.train(texts, 0.3, s)
    assert model.bias + model.weights.get(1, 0) > 0 > model.bias + model.weights.get(2, 0)


def test_temperature_and_index_vectors():
    s = quality.Settings(buckets=64, dims=16)
    assert (np.count_nonzero(quality.index_vectors(s), axis=1) == s.nonzero).all()
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] + rng.normal(size=600) > 0).astype(float)
    p = quality.train(x, y, s).scores(x)
    bins = [(p[m].mean(), y[m].mean()) for m in (p < 0.3, (p >= 0.3) & (p < 0.7), p >= 0.7)]
    assert all(abs(a - b) < 0.15 for a, b in bins)


def test_word_vectors_and_features_against_plain_loops(spark):
    s = quality.Settings(buckets=64, dims=8)
    texts = ["one two, three two one", "", None, "four", "two 22 two", "three one " * 40]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    vectors, index = quality.word_vectors(docs, s), quality.index_vectors(s).astype(float)
    total = np.zeros((s.buckets, s.dims))
    ids = [[zlib.crc32(w.encode()) % s.buckets for w in quality._TOKEN.findall(t or "")] for t in texts]
    for words in ids:
        for i, w in enumerate(words):
            for j in range(max(0, i - s.window), min(len(words), i + s.window + 1)):
                if i != j:
                    total[w] += index[words[j]]
    size = np.abs(total).max(1, keepdims=True)
    plain = total / np.maximum(1e-9, size)
    plain -= plain[size[:, 0] > 0].mean(0)
    plain /= np.maximum(1e-9, np.linalg.norm(plain, axis=1, keepdims=True))
    assert np.allclose(vectors, plain, atol=1e-5)
    for words in ids:
        v = np.array([vectors[w] for w in words], float).reshape(-1, s.dims)
        change = sum((np.abs(b - a) for a, b in zip(v, v[1:])), np.zeros(s.dims)) / max(1, len(v) - 1)
        want = np.concatenate([v.mean(0), v.std(0), change]) if len(v) else np.zeros(3 * s.dims)
        assert np.allclose(quality.pooled(np.array(words, np.int32), vectors), [*want, np.log1p(len(words)) / 10], atol=1e-3)


def test_toxicity_features_and_risk_against_plain_loops():
    s = toxicity.Settings(bits=12, prefixes=(2, 4), steps=25)
    texts = ["bad worse bad", "fine words here", "", "worse weather here", "bad"]
    made = toxicity.Features(s)
    sets = []
    for t in texts:
        plain, words = {}, t.split()
        for w in words:
            for form in [w + "$", *(w[:k] for k in s.prefixes if len(w) >= k)]:
                k = zlib.crc32(form.encode()) % (1 << s.bits)
                plain[k] = plain.get(k, 0) + 1
        plain = {k: min(1.0, s.steep * n / len(words)) for k, n in plain.items()}
        assert made.of(t) == plain
        sets.append(plain)
    rows = [(i in (0, 4), i in (1, 2, 3), f) for i, f in enumerate(sets)]
    prior = 0.3

    def score(model, f):
        return model.bias + sum(model.weights.get(k, 0) * x for k, x in f.items())

    def risk(model):
        loss = lambda z, y: np.log1p(np.exp(-z if y else z))
        p, u = [score(model, f) for a, _, f in rows if a], [score(model, f) for _, b, f in rows if b]
        zero = np.mean([loss(z, 0) for z in u]) - prior * np.mean([loss(z, 0) for z in p])
        return prior * np.mean([loss(z, 1) for z in p]) + max(0, zero)

    start = toxicity.Model({}, float(np.log(prior / (1 - prior))))
    model = toxicity.train(rows, prior, s)
    assert risk(model) < risk(start) and score(model, sets[0]) > score(model, sets[1])
    scorer = toxicity.Scorer(model, s)
    for t, f in zip(texts, sets):
        assert abs(scorer.score(t) - 1 / (1 + np.exp(-score(model, f)))) < 1e-9


def test_other_columns_stay_out_of_python(spark):
    docs, labels = corpus(spark)
    odd = docs.withColumns({"when": F.expr("interval '1' month"), "raw": F.expr("map(struct(1), array(x'00'))")})
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        out = scores(odd, labels).select("row.*")
        assert out.columns == odd.columns and out.where("map_keys(raw)[0].col1 = 1").count() == docs.count()
