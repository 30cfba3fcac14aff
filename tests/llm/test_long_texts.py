"""Long texts of every kind: the library's own ids, in bounded memory."""

import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldtally.llm import bpe, dac, minhash, pieces
from tests.conftest import ROOT

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def texts(n):
    rng = np.random.default_rng(1)
    han = "".join(map(chr, rng.integers(0x4E00, 0x9FA5, n)))
    kana = "".join(map(chr, rng.integers(0x3042, 0x3090, n)))
    stops = "".join(c + ("。" if i % 37 == 0 else "") for i, c in enumerate(kana))
    latin = "".join(map(chr, rng.integers(97, 123, n)))
    words = " ".join(latin[i : i + 1 + i % 9] for i in range(0, n, 9))
    return {
        "han": han, "stops": stops, "latin": latin, "words": words, "mixed": (han[:50] + latin[:60] + "'s don't <|endoftext|> " + stops[:99] + "\n\n  12345 ") * (n // 300),
        "one letter": "a" * n, "special": ("词<|endoftext|>。" * (n // 10)), "hangul": "".join(map(chr, rng.integers(0xAC00, 0xD7A3, n))), "marks": "é" * (n // 2) + "漢字が" * (n // 8), "upper": ("ΑΣΑΣ" * 30 + "ДОМ" * 20) * (n // 180),
    }


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_are_the_librarys(path, monkeypatch):
    monkeypatch.setattr(pieces, "WINDOW", 700)
    monkeypatch.setattr(pieces, "_LONG", 128)
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    monkeypatch.setattr(pieces, "windows", lambda t, cut, never=(), most=700, own=pieces.windows: own(t, cut, never, most))
    for kind in ("ids", "lengths"):
        cut, cache = pieces.load(path, kind)
        for name, t in texts(6000).items():
            want = tok.encode(t, add_special_tokens=False).ids
            got = cache.texts([t, None, ""], cut)
            assert got[0] == (pieces.id_bytes(want) if kind == "ids" else len(want)), name
            assert got[1:] == ([b"", b""] if kind == "ids" else [0, 0])
        from fieldtally.llm import common

        common._RESIDENT.clear()
    if path == WORD:
        own, cache = bpe.load(path)
        for name, t in texts(6000).items():
            assert cache.texts([t], pieces.words)[0] == pieces.id_bytes(tok.encode(t, add_special_tokens=False).ids), name


def test_windows_and_parts_are_used():
    big = texts(20_000)
    assert len(list(pieces.windows(big["stops"], pieces.words, (), 1000))) > 10
    assert len(list(pieces.windows(big["words"], pieces.spaced_words, (), 1000))) > 3
    assert list(pieces.windows(big["han"], pieces.words, (), 1000)) == [big["han"]]
    assert "".join(pieces.windows(big["mixed"], pieces.spaced_words, ("<|endoftext|>",), 500)) == big["mixed"]
    with open(WORD, encoding="utf-8") as f:
        own = bpe.WordBpe(f.read())
    assert len(own.parts(big["han"])) > 3 and "".join(own.parts(big["han"])) == big["han"]


GROWTH = """
import hashlib, resource, sys
import numpy as np
from fieldtally.llm import bpe, pieces
kind, path, what = sys.argv[1:4]
rng = np.random.default_rng(1)
n = 4_000_000
if what == "han":
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA5, n)))
else:
    letters = "".join(map(chr, rng.integers(97, 105, n)))
    text = " ".join(letters[i : i + 3] for i in range(0, 3 * n // 4, 3))
load = bpe.load(path) if kind == "bpe" else pieces.load(path, kind)
cut, cache = (pieces.words, load[1]) if kind == "bpe" else load
cache.texts(["warm up 漢字 " * 200], cut)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
value = cache.texts([text], cut)[0]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


@pytest.mark.parametrize("what", ["han", "words"])
@pytest.mark.parametrize("kind,path", [("lengths", BYTE), ("ids", WORD), ("bpe", WORD)])
def test_memory_is_bounded(kind, path, what):
    run = subprocess.run([sys.executable, "-c", GROWTH, kind, path, what], cwd=ROOT, capture_output=True, text=True, check=True)
    assert int(run.stdout.split()[-1]) < 300, run.stdout  # 12 MB of han took over 1,000 before


def test_crc_by_spans():
    ids = np.random.default_rng(2).integers(0, 49000, 5000).astype(np.uint32)
    reader = dac.Reader(dac.encode(ids))
    assert dac._crc(reader, 7, 4990, 100) == zlib.crc32(ids[7:4990].astype("<u4").tobytes())


def thue_morse(n):
    s = np.zeros(1, bool)
    while len(s) < n:
        s = np.concatenate([s, ~s])
    return "".join("ab"[int(x)] for x in s), "".join("ba"[int(x)] for x in s)


@pytest.mark.parametrize("n", [64, 1024, 2048, 1 << 15, 1 << 19])
def test_long_words_have_hashes_of_their_own(n):
    a, b = thue_morse(n)
    h, at = minhash.word_hashes(f"x {a} {b} {a.upper()} {b}".encode())
    assert len(set(h.tolist())) == 3 and h[1] == h[3] and h[2] == h[4] and at.tolist() == [0, 2, n + 3, 2 * n + 4, 3 * n + 5]
    s = minhash.Settings()
    x, y = minhash.shingle_sets([a.encode(), b.encode()], s)
    assert len(x) == len(y) == 1 and x[0] != y[0]


def test_different_long_words_link_nothing(spark):
    a, b = thue_morse(1024)
    rows = [(1, a), (2, b), (3, f"{a} one two three four five six"), (4, f"{b} one two three four five six"), (5, a)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_usual_texts_with_marks_apart():
    never = ("<|startoftext|>", "<|endoftext|>")
    assert pieces.plain_words("The cat, the Été. end.\nNew, line.", never) == ["the", "cat", ",", "the", "été", ".", "end", ".", "new", ",", "line."]
    for odd in ("a\", b", "x!, y", "a.. b", "a,. ", "x\x1cy", "漢", "I <|endoftext|> b", "_, a", "a <|ENDOFTEXT|>", "ß«. a"):
        assert pieces.plain_words(odd, never) is None or odd.isascii() is False
    tok = Tokenizer.from_file(WORD)
    tok.no_truncation()
    cut, cache = pieces.load(WORD, "ids")
    texts_ = ["The cat, the Été. end.\nNew, line.", "12, 3. 4,5 6.7", "don't, it's. we'll,", "a\", b !, c. \", d", "ª, º. µ, ß. ÷, ×. «, ». a", "tab,\tend.\r\nx,\xa0y.\x85z", "a_, b_. _", "<|endoftext|>, a <|ENDOFTEXT|>. b", "x , y . z", ", . ,. .,", "İstanbul, İ. i̇"]
    for _ in range(2):  # new and remembered
        assert cache.texts(texts_, cut) == [pieces.id_bytes(tok.encode(t, add_special_tokens=False).ids) for t in texts_]


def test_usual_texts_are_put_together_from_different_words():
    never, tok = ("<|endoftext|>",), Tokenizer.from_file(WORD)
    assert pieces.plain_words("Der Spaß, die Größe\nGroß.\nEnde", never) == ["der", "spaß", ",", "die", "größe", "groß", ".", "ende"]
    cut, cache = pieces.load(WORD, "ids")
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(letters[: 52 if k % 3 else None], 1 + k % 9)) for k in range(3000)]
    many = [" ".join(rng.choice(words, 40)) for _ in range(200)]
    some = [None, "", " ", "\n\t", " a,  b. ", "\u0085x\xa0y", "Straße, nein.\nJa! 12 $$$", "don't. 'll", "<|endoftext|>", "a|b", "日本, x", "x\x1cy", ".,", *many, *[f"a{c}, {c}{c}. {c}b" for c in letters]]
    want = [pieces.id_bytes(tok.encode(t or "", add_special_tokens=False).ids) for t in some]
    for _ in range(2):  # from the encoder, and from what is remembered
        assert cache.texts(some, cut) == want
    assert cache.texts([], cut) == [] and cache.texts([None, " "], cut) == [b"", b""]
