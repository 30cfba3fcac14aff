"""Token counts, BPE, token files and packing against the tokenizers library."""

import hashlib
import itertools
import json
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from tokenizers import Tokenizer

from fieldtally.llm import bpe, dac, packing, pieces, token_counts

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
BYTE_LIB, WORD_LIB = map(Tokenizer.from_file, (BYTE, WORD))
PARTS = ["a", "B", "é", "'s", "'ll", " ", "  ", "\n", "\t", "\x00", "\x1c", "\x85", "1", "23", "!", "?!", "<|endoftext|>", "<|startoftext|>", "<|", "\u0301", "\u3000", "Σ", "İ", "日本", "’", " \n", "\r\n", "ß", "Word", ",", ".", "\u2028", "\u1c89", "ff"]
TEXTS = [None, "", " ", "Hello World's <|endoftext|> 12", "a" * 5000, "word " * 20000, "tie tie", "tie tie", "\ud7ffé\x00"]

texts = st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=3)), max_size=14).map("".join)


def lib(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(texts)
def test_pieces_encode_like_the_whole(text):
    text = text.encode("utf-8", "ignore").decode()
    for path, tok in ((BYTE, BYTE_LIB), (WORD, WORD_LIB)):
        cut, cache = pieces.load(path, "ids")
        assert np.frombuffer(cache([cut(text)])[0], "<u4").tolist() == lib(tok, text)
    cut, cache = pieces.load(BYTE, "lengths")
    assert cache([cut(text)])[0] == len(lib(BYTE_LIB, text))


@settings(max_examples=400, deadline=None)
@given(texts)
def test_own_bpe_is_the_librarys(text):
    text = text.encode("utf-8", "ignore").decode()
    own, cache = bpe.load(WORD)
    ids = lib(WORD_LIB, text)
    assert own.encode(text) == ids == np.frombuffer(cache([pieces.words(text)])[0], "<u4").tolist()
    assert own.decode(ids) == WORD_LIB.decode(ids, skip_special_tokens=False)


def test_every_code_point_is_encoded_like_the_librarys():
    own, _ = bpe.load(WORD)
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    samples = [f"a{c}b {c}1{c}" for c in points]
    assert [e.ids for e in WORD_LIB.encode_batch(samples, add_special_tokens=False)] == list(map(own.encode, samples))


def test_stale_entries_are_skipped():
    own, _ = bpe.load(WORD)
    for word in ("aaaaaaaaaaaaaaa", "banananana", "thethethethe"):
        assert own.encode(word) == lib(WORD_LIB, word)


def test_other_tokenizers_are_cut_nowhere(tmp_path):
    with open(WORD, encoding="utf-8") as f:
        d = json.load(f)
    d["normalizer"] = {"type": "Prepend", "prepend": "x"}
    assert pieces.cutter(d) is pieces.whole
    d["added_tokens"][0]["lstrip"] = True
    assert pieces.cutter(d) is pieces.whole


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 1, 2.0) for i, t in enumerate(TEXTS)] + [(None, "no id", "en", 1, 2.0), (3, TEXTS[3], "en", 1, 2.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, id int, score double").repartition(3)


def test_counts(spark, docs):
    rows = token_counts.token_counts(docs, BYTE, limit=100).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        n = len(lib(BYTE_LIB, text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 100)
    assert token_counts.token_counts(docs.limit(0), BYTE).count() == 0


def test_encode_and_decode(spark, docs):
    digests = {(r.doc_id): r for r in bpe.bpe_digests(docs, WORD).collect()}
    encoded = bpe.bpe_encode(docs, WORD)
    decoded = {r.doc_id: r.text for r in bpe.bpe_decode(encoded, WORD).collect()}
    for r in encoded.collect():
        ids = lib(WORD_LIB, "no id" if r.doc_id is None else TEXTS[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids) == digests[r.doc_id].n_tokens
        text = WORD_LIB.decode(ids, skip_special_tokens=False)
        assert decoded[r.doc_id] == text and digests[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert digests[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500), st.sampled_from([(8, 8, 16), (4, 12, 16), (16, 16), (32,)]))
def test_codes_are_read_anywhere(ids, widths):
    reader = dac.Reader(dac.encode(np.array(ids, np.uint64), widths))
    assert reader.slice(0, len(ids)).tolist() == ids
    for i in random.Random(1).sample(range(len(ids)), min(20, len(ids))):
        assert reader[i] == ids[i]
        assert reader.slice(i, min(len(ids), i + 9)).tolist() == ids[i : i + 9]
    with pytest.raises(IndexError):
        reader[len(ids)]


def test_codes_refuse_what_they_cannot_hold():
    with pytest.raises(ValueError):
        dac.encode(np.array([300]), (8,))
    with pytest.raises(ValueError):
        dac.Reader(b"nothing")


@pytest.mark.parametrize("shard", [1, 50, 1 << 20])
def test_token_files(spark, docs, shard):
    files = dac.write_token_files(docs, WORD, end_id=2, shard_tokens=shard, batch_bytes=64).read()
    rows = sorted(dac.read_token_files(files).collect(), key=lambda r: r.start)
    if shard == 50:  # the same without a broadcast
        assert sorted(dac.read_token_files(files, most_broadcast=0).collect(), key=lambda r: r.start) == rows
    at = 0
    order = [r.doc_id for r in rows]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    for r in rows:
        ids = [*lib(WORD_LIB, "no id" if r.doc_id is None else TEXTS[r.doc_id]), 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    if shard > 50:
        first = files.orderBy("part", "shard").first()
        asked = [(first.part, first.shard, 0), (first.part, first.shard, 0), (first.part, first.shard, 10**9), (first.part, first.shard, -1), (first.part, 99, 0), (999, first.shard, 0), (None, 0, 0), (first.part, first.shard, None)]
        wanted = spark.createDataFrame(asked, "part int, shard int, position long")
        found = dac.token_at(files, wanted).collect()
        token = lib(WORD_LIB, "no id")[0]
        assert sorted(map(str, found)) == sorted(str(Row(part=p, shard=k, position=i, token=token if (p, k, i) == asked[0] else None)) for p, k, i in asked)


def test_rows_of_one_id_are_dealt_to_several_parts(spark):
    rows = spark.createDataFrame([(None, f"text {i} and more {i % 7}") for i in range(400)] + [(3, "last")], "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these are too few rows for several parts
    files = dac.write_token_files(rows, WORD, end_id=2).read()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert files.where("doc_ids[0] is null").select("part").distinct().count() > 1
    read = sorted(dac.read_token_files(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in read] == [None] * 400 + [3]
    assert [r.start for r in read] == list(itertools.accumulate([r.n_tokens for r in read], initial=0))[:-1]


def test_no_documents_no_files(spark, docs):
    assert dac.read_token_files(dac.write_token_files(docs.limit(0), WORD, 2).read()).count() == 0


def held_by(bins, capacity):
    held = {}
    for content, count in bins:
        assert sum(x * k for x, k in content) <= capacity
        for x, k in content:
            held[x] = held.get(x, 0) + k * count
    return held


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plans_hold_every_piece_once(histogram):
    amounts, bound = packing.solve(histogram, 64)
    covered = {}
    for content, amount in amounts.items():
        assert amount > 0 and sum(x * k for x, k in content) <= 64 and all(k <= histogram[x] for x, k in content)
        for x, k in content:
            covered[x] = covered.get(x, 0) + k * amount
    assert all(n <= histogram[x] + 1e-6 for x, n in covered.items())
    used, left, _ = packing.configured(histogram, 64)
    final = packing.best_fit(left, list(used.items()), 64)
    assert held_by(final, 64) == histogram
    n, total = sum(c for _, c in final), sum(x * k for x, k in histogram.items())
    assert -(-total // 64) <= n and bound <= n + 1e-6 and bound >= total / 64 - 1e-6


def fewest(pieces, capacity):
    """The fewest sequences, by trying every place of every piece."""
    best = len(pieces)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= pieces[i]}:
            k = rooms.index(room)
            place(i + 1, sorted([*rooms[:k], *rooms[k + 1 :], room - pieces[i]]))
        place(i + 1, sorted([*rooms, capacity - pieces[i]]))

    place(0, [])
    return best


def test_packing_against_the_optimum():
    rng, exact = random.Random(5), 0
    for _ in range(60):
        pieces = sorted((rng.randrange(1, 21) for _ in range(rng.randrange(1, 10))), reverse=True)
        histogram = {x: pieces.count(x) for x in set(pieces)}
        used, left, bound = packing.configured(histogram, 20)
        n, best = sum(c for _, c in packing.best_fit(left, list(used.items()), 20)), fewest(pieces, 20)
        assert bound <= best + 1e-6 and best <= n <= best + 1
        exact += n == best
    assert exact >= 54


@pytest.mark.parametrize("times", [1, 40])
def test_configurations_place_most_pieces(times):
    lengths = np.minimum(4096, np.random.default_rng(3).lognormal(6.2, 1.0, 4000).astype(int) + 2)
    histogram = {int(x): int(n) * times for x, n in zip(*np.unique(lengths, return_counts=True))}
    used, left, bound = packing.configured(histogram, 4096)
    total = sum(histogram.values())
    placed = sum(k * n for content, n in used.items() for _, k in content)
    assert placed + sum(left.values()) == total and placed >= 0.85 * total
    assert sum(n for content, n in used.items() if len(content) > 1) > 0.8 * sum(used.values())
    n = sum(c for _, c in packing.best_fit(left, list(used.items()), 4096))
    assert math.ceil(bound - 1e-6) <= n <= bound * 1.002 + 2


def test_fillings_are_the_best_with_bounded_copies():
    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = np.sort(rng.permutation(np.arange(1, 15))[:4])
        most, prices, order = rng.integers(1, 4, 4), rng.random(4), rng.permutation(4)
        rooms = np.arange(21)
        best, fillings = packing.best_fillings(lengths, most, prices, 20, order, rooms)
        for room, filling in zip(rooms, fillings):
            plain = max(sum(k * p for k, p in zip(ks, prices)) for ks in itertools.product(*(range(m + 1) for m in most)) if sum(k * x for k, x in zip(ks, lengths)) <= room)
            assert abs(sum(k * prices[i] for i, k in filling.items()) - plain) < 1e-9
            assert all(k <= most[i] for i, k in filling.items()) and sum(k * int(lengths[i]) for i, k in filling.items()) <= room
        assert abs(best - plain) < 1e-9


def check_packing(rows, capacity):
    seen = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == seen.get(r.sequence_id, 0)
        seen[r.sequence_id] = r.offset + r.length
        assert seen[r.sequence_id] <= capacity
    return len(seen)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing(spark, docs, capacity):
    rows = packing.pack(docs, WORD, end_id=1, capacity=capacity).collect()
    n = check_packing(rows, capacity)
    assert n <= -(-sum(r.length for r in rows) // capacity) * 1.2 + 1
    for i, text in enumerate(TEXTS):
        if i == 3:
            continue
        ids = [*lib(WORD_LIB, text), 1]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in own] == list(enumerate(range(0, len(ids), capacity)))
        assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in own)
    assert len([r for r in rows if r.doc_id == 3 and r.piece == 0]) == 2
    assert packing.pack(docs.limit(0), WORD, end_id=1).count() == 0
