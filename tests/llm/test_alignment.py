"""Alignment against plain loops over each text's own tokens."""

import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fieldtally.llm import alignment, pieces
from fieldtally.llm.bpe import byte_alphabet
from tests.conftest import DATA

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOK = Tokenizer.from_file(A)
TOK.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=B)
BYTE = {c: b for b, c in enumerate(byte_alphabet())}


def a_raw(i):
    return bytes(BYTE[c] for c in TOK.id_to_token(i))


def b_raw(i):
    p = SP.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if SP.is_byte(i) else p.replace("▁", " ").encode()


def groups(text):
    """[(a ids, b ids)] or None."""
    if not text:
        return None
    raw, a, b = (" " + text).encode(), TOK.encode(" " + text, add_special_tokens=False).ids, SP.encode(text)
    if b"".join(map(a_raw, a)) != raw or b"".join(map(b_raw, b)) != raw:
        return None
    ends = []
    for ids, of in ((a, a_raw), (b, b_raw)):
        at, own = 0, []
        for i in ids:
            at += len(of(i))
            own.append(at)
        ends.append(own)
    out, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return out


def brute(rows):
    found = [(i, groups(t)) for i, t in rows]
    docs = Counter(p for _, g in found if g for p in {(x, y) for a, b in g for x in a for y in b})
    top = defaultdict(int)
    for (x, _), n in docs.items():
        top[x] = max(top[x], n)
    out = []
    for i, g in found:
        links = [(x, y) for a, b in g or [] for x in a for y in b]
        said = hashlib.sha256(";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g).encode()).hexdigest() if g else ""
        out.append((i, sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), len(links), sum(docs[p] == top[p[0]] for p in links), sum(docs[p] for p in links), said))
    return sorted(out, key=str), docs, top


def results(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str)


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "\n", "a \n b \n", "x\ty", "it's we'll don't", "<|endoftext|>", "a <|endoftext|> b", "<s> </s> <unk> <0x41>", "a▁b", "▁", "a ▁ b", "\0", "a\0b c",
    "漢字かな交じり文。テスト", "한국어 텍스트", "🙂🙃 👩‍👩‍👧", "é é ﬁ", "عربى", "a\x1cb \x1d c", "a b c   d", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "same words same words", "same words same words",
    "12345 67 8,9.0", "==== ----- ____ ....", "x" * 300, " ".join("ab" * k for k in range(30)), "\r\n\r\n a", "a .", "a. b", "q' s", "'s 'll",
]


def frame(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"doc_id {kind}, text string")


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want, counts, top = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert results(alignment.align(docs.repartition(3), A, B)) == want
    pairs = {(r.a_id, r.b_id): (r.n_docs, r.best) for r in alignment.Alignment(docs, A, B).pairs().collect()}
    assert pairs == {p: (n, n == top[p[0]]) for p, n in counts.items()}


@pytest.mark.parametrize("most_sent", [0, 40, 1 << 17])
def test_odd_texts_whatever_is_sent_to_tasks(spark, most_sent):
    rows = list(enumerate(ODD)) + [(None, "a null id"), (3, "a repeated id"), (3, "a repeated id")]
    df = frame(spark, rows).selectExpr("*", "1 as id", "'x' as keys", "2 as row").repartition(3)
    assert results(alignment.Alignment(df, A, B, most_sent=most_sent, batch_bytes=200).documents()) == brute(rows)[0]


@pytest.mark.parametrize("kind,make", [("int", int), ("string", str)])
def test_kinds_of_ids_and_empty_tables(spark, kind, make):
    rows = [(make(i), "a few words here") for i in range(4)]
    df = frame(spark, rows, kind)
    assert results(alignment.align(df, A, B)) == brute(rows)[0]
    assert results(alignment.align(df.limit(0), A, B)) == []


def test_windows_and_cut_pieces(monkeypatch):
    tok = alignment.Tokenizers(A, B)
    cjk = "漢字混合文章かなカナ" * 40 + "。" + "언어모델" * 60 + "Ελληνικάкириллица" * 50
    for text in (cjk, "a word and more " * 300, "x" * 5000, "abcqxzjkvvw" * 300, " leading  and\n\n trailing \n"):
        text = " " + text
        whole = alignment.Groups(tok, [text])
        found = None
        for w in tok.windows(text, 500):
            new = alignment.Groups(tok, [w])
            found = new if found is None else alignment._together(found, new)
        monkeypatch.setattr(alignment, "_LONG_PIECE", 64)
        cut = alignment.Groups(tok, [text])
        monkeypatch.undo()
        for x in (found, cut):
            assert sorted(zip(x.keys[x.group].tolist(), x.times.tolist())) == sorted(zip(whole.keys[whole.group].tolist(), whole.times.tolist())) and sorted(x.text) == sorted(whole.text)
        assert cut.said == whole.said
    monkeypatch.setattr(alignment, "_LONG_PIECE", 64)
    assert len(tok.pieces(cjk)) > 10


def test_what_is_remembered_changes_nothing(monkeypatch):
    texts = [" " + t if t else "" for t in ODD[1:]]
    want = alignment.Groups(alignment.Tokenizers(A, B), texts)
    monkeypatch.setattr(alignment, "_PIECES", 3)
    for most, usual in ((0, 48), (20, 4), (10**6, 48)):
        monkeypatch.setattr(alignment, "_REMEMBERED", most)
        monkeypatch.setattr(alignment, "_USUAL", usual)
        tok = alignment.Tokenizers(A, B)
        for part in (texts[:9], texts, texts[::-1], texts):
            got = alignment.Groups(tok, part)
            assert len(tok.number) == len(tok.names) == len(tok.texts) == len(tok.good) == len(tok.starts) - 1 and len(tok.flat) == tok.starts[-1]
            assert len(tok.group) == len(tok.sides) == len(tok.said) == len(tok.keys)
        assert got.said == want.said
        seen = lambda g: sorted(zip(g.owner.tolist(), g.keys[g.group].tolist(), g.times.tolist()))
        assert seen(got) == seen(want) and dict(zip(got.keys.tolist(), got.text)) == dict(zip(want.keys.tolist(), want.text))


def test_pairs_are_counted_in_slices(monkeypatch):
    import numpy as np

    sides = [([1, 2, 2], [5]), ([2], [5, 6]), ([1, 2], [5, 6]), ([7], [8])]
    owner, group = np.array([0, 0, 0, 1, 1]), np.array([0, 1, 2, 0, 3])
    want = Counter({1 << 32 | 5: 1, 2 << 32 | 5: 2, 2 << 32 | 6: 1})
    assert alignment._repeated_pairs(sides, owner, group) == want
    monkeypatch.setattr(alignment, "_PAIRS_AT_ONCE", 3)
    assert alignment._repeated_pairs(sides, owner, group) == want


def test_seams_never_split_a_token():
    with open(A, encoding="utf-8") as f:
        tokens = [bytes(map(BYTE.__getitem__, t)) for t in json.load(f)["model"]["vocab"] if all(c in BYTE for c in t)]
    seams = pieces.Seams(tokens)
    assert not seams.free(b"th", b"e") and not seams.free(b"'r", b"e") and seams.free("漢".encode(), "が".encode())
    text = "thequickbrownfoxзвукмузыкиかなカナ漢字"
    cuts, at = [], 0
    while (at := seams.next(text, at + 1)) < len(text):
        cuts.append(at)
    assert cuts
    ids = lambda t: TOK.encode(t, add_special_tokens=False).ids
    assert [i for a, b in zip([0, *cuts], [*cuts, len(text)]) for i in ids(text[a:b])] == ids(text)
