"""Similarity joins against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.llm import embeddings, minhash
from fieldtally.llm.components import components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(2)
    edges = {"path": [(i + 1, i) for i in range(60)], "star": [(0, i) for i in range(1, 80)], "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)], "none": []}[kind]
    want = roots({x for e in edges for x in e}, edges)
    df = spark.createDataFrame([*edges, *edges[:3], (None, 1), (1, None)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {k: v for k, v in want.items() if k != v}


def jaccard_links(texts, words=5):
    sets = {}
    for k, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    keys = sorted(k for k in sets if sets[k])
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, links


def corpus():
    rng = random.Random(7)
    word = lambda: "w%d" % rng.randrange(3000)
    texts, passage = {}, " ".join(word() for _ in range(60))
    for i in range(40):
        texts[i] = " ".join(word() for _ in range(rng.randrange(5, 120)))
    for i in range(40, 140):  # near copies, near the threshold on both sides
        base = texts[rng.randrange(12)].split()
        for _ in range(rng.randrange(0, 4)):
            base[rng.randrange(len(base))] = word()
        texts[i] = " ".join(base)
    for i in range(140, 180):  # one passage that many share
        texts[i] = " ".join([word() for _ in range(rng.randrange(20, 90))] + [passage])
    for i in range(180, 200):
        texts[i] = texts[3].upper()
    texts |= {200: None, 201: "", 202: " \t\n", 203: "one two", 204: "ONE  two", 205: "two one", 206: "é É", 207: "é é", 208: "x " * 30000, 209: "x " * 29999, 210: "a\x0bb\x0cc", 211: "a b c", 212: "a\u00a0b c"}
    return texts


@pytest.mark.parametrize("tile", [2048, 7])
def test_documents(spark, tile):
    texts = corpus()
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, component_id string").repartition(4)
    sets, links = jaccard_links(texts)
    want = roots(texts, links)
    rows = minhash.near_duplicates(df, minhash.Settings(tile=tile, set_tile=max(3, tile // 4))).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {k: (len(sets[k]), want[k], want[k] == k) for k in texts}


def test_document_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f", 1), (5, "a b c d e f", 2), (5, "a b c d e f", 3), (9, "A b c d e f", 4)], "doc_id long, text string, n int")
    rows = minhash.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id) == [(5, 5, True), (5, 5, True), (9, 5, False)]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    kept = minhash.without_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 5]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_texts_that_share_an_id(spark):
    words = lambda c, n=40: [f"{c}{i}" for i in range(n)]
    a, b, c, d = (" ".join(words(x)) for x in "abcd")
    near = " ".join([*words("b")[:-1], "other"])  # one shingle differs
    rows = [(5, a, 1), (5, b, 2), (7, b, 3), (8, near, 4), (9, c, 5), (9, near, 6), (9, c, 7), (9, "", 8), (2**63 - 1, d, 9), (2**63 - 1, a, 10), (-(2**63), d, 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    got = minhash.near_duplicates(df).collect()
    low = -(2**63)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.component_id, r.kept) for r in got} == {5: (low, False), 7: (low, False), 8: (low, False), 9: (low, False), 2**63 - 1: (low, False), low: (low, True)}
    left = minhash.without_near_duplicates(df)
    assert left.columns == df.columns
    kept = sorted((r.doc_id, r.text) for r in left.collect())
    # Every text has one left that it is linked with, and nothing unrelated goes.
    assert kept == sorted([(5, a), (5, b), (9, c), (9, ""), (low, d)])


def test_every_text_of_an_id_links(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    for x, y in ((a, b), (b, a)):  # whichever has the least hash
        df = spark.createDataFrame([(5, x), (5, y), (7, y)], "doc_id long, text string")
        assert {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()} == {(5, 5, True), (7, 5, False)}
        assert sorted((r.doc_id, r.text) for r in minhash.without_near_duplicates(df).collect()) == sorted([(5, x), (5, y)])


def test_signatures_within_the_distance_share_a_chunk():
    rng = np.random.default_rng(1)
    for errors in (0, 16, minhash.MOST_ERRORS):
        for _ in range(50):
            a = rng.integers(0, 1 << 16, minhash.VALUES).astype("<u2")
            b = a.copy()
            b[rng.permutation(minhash.VALUES)[:errors]] ^= 1
            assert set(minhash.chunk_keys(a)) & set(minhash.chunk_keys(b))


def vectors(seed=4, dims=64):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(30, dims))
    rows = [(i, base[i].tolist(), i % 3) for i in range(30)]
    for i in range(30, 260):
        j = int(rng.integers(0, 6))
        rows.append((i, (base[j] * rng.uniform(0.1, 9) + rng.normal(size=dims) * np.linalg.norm(base[j]) / 8 * rng.uniform(0.3, 0.6)).tolist(), j % 3))
    rows += [(300 + k, rows[k][1], rows[k][2]) for k in (0, 1, 40)]  # equal vectors
    rows += [(310, None, 1), (311, [0.0] * dims, 1), (312, [float("nan")] + [1.0] * (dims - 1), 1), (313, [None] + [1.0] * (dims - 1), 1), (314, rows[0][1], None), (315, rows[0][1][:8], 0), (316, rows[0][1][:8], 0), (317, [], 0)]
    return rows


@pytest.mark.parametrize("chunk", [4096, 20])
def test_vectors(spark, chunk):
    rows = vectors()
    good = [(i, np.array(x, float), label) for i, x, label in rows if x and label is not None and None not in x and np.isfinite(x).all() and any(x)]
    links = [(i, j) for n, (i, x, k) in enumerate(good) for j, y, m in good[n + 1 :] if k == m and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93]
    assert len(links) > 500
    want = roots([r[0] for r in rows], links)
    degree = {r[0]: sum(r[0] in e for e in links) for r in rows}
    df = spark.createDataFrame([(i, x, k, "x") for i, x, k in rows], "vec_id long, embedding array<double>, label int, kept string").repartition(3)
    got = embeddings.near_duplicate_vectors(df, embeddings.Settings(chunk=chunk)).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {k: (degree[k], want[k], want[k] == k) for k in want}


def test_vector_edges(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (5, [2.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    got = embeddings.near_duplicate_vectors(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id) == [(4, 2, 4), (4, 2, 4), (5, 2, 4)]
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert embeddings.near_duplicate_vectors(df.limit(0)).count() == 0


def test_odd_components(spark):
    big, tiny = [1e300, 1e300, 0.0], [1e-300, 1e-300, 0.0]
    df = spark.createDataFrame([(1, big, 1), (2, tiny, 1), (3, [-0.0, 0.0, 1.0], 1), (4, [0.0, 0.0, 2.0], 1), (5, [float("inf"), 1.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    got = embeddings.near_duplicate_vectors(df.select("vec_id", F.col("embedding"), "label")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5)}


def test_every_linked_pair_is_near_in_a_block():
    rng = np.random.default_rng(3)
    s = embeddings.Settings()
    at, share = embeddings.edges(64, s), embeddings.shares(64, s)
    assert abs(share.sum() - (2 - 2 * s.least)) < 1e-6 and at.tolist() == [0, 16, 32, 48, 64]
    for _ in range(100):
        x = rng.normal(size=64)
        pair = np.stack([x, x + rng.normal(size=64) * 0.35])
        cosine = pair[0] @ pair[1] / np.prod(np.linalg.norm(pair, axis=1))
        y = embeddings.rotated(pair, {}, s)
        if cosine >= s.least:
            assert (np.add.reduceat((y[0] - y[1]) ** 2, at[:-1]) <= share).any()
        assert abs(y[0] @ y[1] - cosine) < 1e-9


def compared(x, s, first=None):
    y = embeddings.rotated(x, {}, s)
    code = embeddings.order_code(y, embeddings.fit_centres(y[::3], s))
    order = np.argsort(code, kind="stable")
    x, y, pairs, links = x[order], y[order], 0, set()
    for u, v, n in embeddings.linked_pairs(x, y, first or len(x), code[order] >> 16, s, step=64):
        pairs += n
        links |= set(zip(order[u].tolist(), order[v].tolist()))
    return pairs, {(min(e), max(e)) for e in links}


def test_pairs_meet_once_and_far_runs_never():
    rng, s = np.random.default_rng(6), embeddings.Settings()
    even = rng.normal(size=(1500, 64))
    pairs, _ = compared(even, s)
    assert pairs <= 1500 * 1499 / 2  # nothing to prune, and no pair twice
    centres = rng.normal(size=(40, 64))
    grouped = np.repeat(centres, 75, axis=0) + rng.normal(size=(3000, 64)) * 0.12
    pairs, links = compared(grouped, s)
    assert pairs < 0.25 * 3000 * 2999 / 2
    unit = grouped / np.linalg.norm(grouped, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(unit @ unit.T >= 0.93, 1))
    assert links == set(zip(a.tolist(), b.tolist())) and len(links) > 10000
    _, two = compared(grouped, s, first=1000)
    assert two < links  # rows of two chunks only


@pytest.mark.parametrize("folder, most", [("/root/testdata/sf0.1", 1.0)])
def test_the_given_vectors_meet_at_most_once(spark, folder, most):
    s = embeddings.Settings(chunk=64)
    reps = spark.read.parquet(f"{folder}/embeddings.parquet").select(F.col("vec_id").alias("rep"), F.col("label").cast("string").alias("label"), "embedding")
    raw = {r.rep: (r.label, np.array(r.embedding, np.float64)) for r in reps.collect()}
    table = spark.createDataFrame([(label, x.nbytes, k, 1, x.tobytes()) for k, (label, x) in raw.items()], "label string, size int, rep long, times long, raw binary")
    chunks = embeddings._chunked(table, spark.sparkContext.broadcast(embeddings.fit(table, s)), s).cache()
    sizes = {r.chunk: (r.n, r.label) for r in chunks.where("place = 0").collect()}
    assert sum(n for n, _ in sizes.values()) == len(raw) and max(n for n, _ in sizes.values()) <= 64
    met = embeddings.chunk_pairs(chunks, s).collect()
    assert len(set(met)) == len(met) and all(sizes[r.a][1] == sizes[r.b][1] for r in met)
    pairs = sum(sizes[r.a][0] * sizes[r.b][0] if r.a != r.b else sizes[r.a][0] * (sizes[r.a][0] - 1) // 2 for r in met)
    labels = [label for label, _ in raw.values()]
    assert pairs <= most * sum(n * (n - 1) // 2 for n in map(labels.count, set(labels)))


@pytest.mark.parametrize("kind,make", [("int", int), ("string", lambda i: f"{i:04}")])
def test_kinds_of_ids(spark, kind, make):
    """Results don't depend on the kind, which stays."""
    texts = {make(k): t for k, t in corpus().items() if k % 3}
    df = spark.createDataFrame(list(texts.items()), f"doc_id {kind}, text string")
    want = roots(texts, jaccard_links(texts)[1])
    got = minhash.near_duplicates(df)
    assert {r.doc_id: r.component_id for r in got.collect()} == want and got.schema["component_id"].dataType == df.schema["doc_id"].dataType
    assert {r.doc_id for r in minhash.without_near_duplicates(df).collect()} == {k for k in texts if want[k] == k}
    rows = [(make(i), x, label) for i, x, label in vectors()]
    good = [(i, np.array(x, float), label) for i, x, label in rows if x and label is not None and None not in x and np.isfinite(x).all() and any(x)]
    links = [(i, j) for n, (i, x, k) in enumerate(good) for j, y, m in good[n + 1 :] if k == m and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93]
    found = embeddings.near_duplicate_vectors(spark.createDataFrame(rows, f"vec_id {kind}, embedding array<double>, label int"), embeddings.Settings(chunk=50))
    assert {r.vec_id: r.component_id for r in found.collect()} == roots([r[0] for r in rows], links) and found.schema["component_id"].dataType == df.schema["doc_id"].dataType


def test_a_band_is_sent_once_to_each_other_band(spark):
    """All chunks meet: rows are sent for each pair of bands, not of chunks."""
    s = embeddings.Settings(chunk=10, band=4)
    n = 16
    chunks = spark.range(n * 10).select(F.floor(F.col("id") / 10).alias("chunk"), (F.col("id") % 10).alias("place"), F.col("id").alias("rep"), F.lit(1).alias("times"), F.lit(b"x").alias("raw"))
    pairs = spark.createDataFrame([(a, b) for a in range(n) for b in range(a, n)], "a long, b long")
    rows = embeddings._bands(pairs, chunks, s)
    bands = n // 4
    assert rows.count() == 10 * 4 * bands * bands < 10 * n * n / 2  # by pairs of chunks: 10 * n * n
    met = [tuple(p) for r in rows.where("met is not null and chunk = band_a * 4").select("met").collect() for p in r.met]
    assert sorted(met) == sorted((a, b) for a in range(n) for b in range(a, n))


def test_tables_are_dropped(spark, tmp_path):
    from fieldtally.llm.common import Table, drop_tables

    drop_tables()
    with pytest.raises(Exception):
        Table(spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("x")), "broken")
    assert len(Table.live) == 1
    drop_tables()
    assert not Table.live
    embeddings.near_duplicate_vectors(spark.createDataFrame(vectors(), "vec_id long, embedding array<double>, label int")).collect()
    assert not [p for p in Table.live if "chunk" in p]
    drop_tables()
