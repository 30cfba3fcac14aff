"""Byte-pair encoding and decoding of a word-end vocabulary.

A word's symbols form a doubly linked list; a priority queue holds the ranks of
neighbouring pairs, and entries whose pair has changed are skipped when popped.
Decoding concatenates vocabulary strings.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces
from .common import resident, slices


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one tokenizers JSON file of this shape: NFC, lower
    case, words found by a pattern, bytes as characters, BPE with a word-end
    suffix, no decoder (tokens are joined by a space)."""

    def __init__(self, text: str):
        import regex

        self.text, self.library, definition = text, None, json.loads(text)
        model = definition["model"]
        pre = definition["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or definition.get("decoder") or pieces.cutter(definition) is not pieces.words or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("not a byte-level BPE file with word ends and no decoder")
        self.end = model["end_of_word_suffix"]
        self.vocab = model["vocab"]
        self.ranks = {(a, b): (rank, a + b) for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"])}
        self.alphabet = byte_alphabet()
        self.find = regex.compile(pre[0]["pattern"]["Regex"]).findall
        self.special = {t["content"]: t["id"] for t in definition["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.seams: pieces.Seams | None = None
        self.strings = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for s, i in (self.vocab | self.special).items():
            self.strings[i] = s

    def merge(self, symbols: list[str]) -> list[str]:
        """Join the pair of lowest rank, leftmost first, until none can be joined."""
        n = len(symbols)
        left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        queue: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (found := self.ranks.get((symbols[i], symbols[j]))):
                heapq.heappush(queue, (found[0], i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            if not alive[i] or symbols[i] != a or (j := right[i]) >= n or symbols[j] != b:
                continue  # stale: one of the two has been joined with another
            symbols[i] = a + b
            alive[j] = False
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [s for s, live in zip(symbols, alive) if live]

    def word_ids(self, word: str) -> list[int]:
        ids: list[int] = []
        for segment in self.at_special.split(word) if self.at_special else [word]:
            if segment in self.special:
                ids.append(self.special[segment])
                continue
            parts = self.parts(segment)
            for k, part in enumerate(parts, 1):
                matches = self.split(part)
                for m, match in enumerate(matches, 1):
                    symbols = [self.alphabet[b] for b in match.encode("utf-8", "replace")]
                    if k == len(parts) or m < len(matches):  # else the word goes on
                        symbols[-1] += self.end
                    ids += (self.vocab[s] for s in self.merge(symbols) if s in self.vocab)
        return ids

    def parts(self, segment: str) -> list[str]:
        """A very long segment in parts that end within words, at places that no
        token lies across; so its symbols are never listed all at once."""
        if len(segment) <= pieces._LONG:
            return [segment]
        if self.seams is None:
            byte_of = {c: b for b, c in enumerate(self.alphabet)}
            bare = (t.removesuffix(self.end) for t in self.vocab if t not in self.special)
            self.seams = pieces.Seams((bytes(map(byte_of.__getitem__, t)) for t in bare if all(c in byte_of for c in t)), str.lower)
        return self.seams.parts(segment, pieces._LONG // 4)

    def split(self, segment: str) -> list[str]:
        """NFC, lower case, then the matches of the pattern.

        Versions of Unicode differ in what newer characters are, so where such
        may occur the file's own normalizer and splitter decide.
        """
        if pieces._KNOWN.fullmatch(segment):
            return self.find("".join(map(str.lower, segment)))
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.text)
        return [segment[a:b] for segment in [self.library.normalizer.normalize_str(segment)] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(segment)]

    def encode(self, text: str) -> list[int]:
        return [i for w in pieces.words(text) for i in self.word_ids(w)]

    def decode(self, ids) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


def load(path: str) -> tuple[WordBpe, pieces.PieceCache]:
    """The encoder of a file and its cache, once for each Python worker."""

    def make():
        with open(path, encoding="utf-8") as f:
            bpe = WordBpe(f.read())
        pattern, fold = pieces.pattern_of(json.loads(bpe.text))
        return bpe, pieces.PieceCache(lambda batch: [pieces.id_bytes(bpe.word_ids(w)) for w in batch], b"".join, pattern, fold, tuple(bpe.special))

    return resident(("bpe", path), make)


def bpe_encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """For each row: ``id_col``, ``n_tokens`` and ``ids``, an array of ints.

    Words are encoded once for each worker (bounded cache); there is no shuffle.
    A null or empty text has no ids; null ids of documents, repeated rows and
    other columns do no harm; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cache = load(tokenizer)
        for run in slices(batches, "text", batch_bytes):
            ids = [np.frombuffer(raw, "<u4").astype(np.int32) for raw in cache.texts(run.column(1).to_pylist(), pieces.words)]
            n = np.array([len(x) for x in ids], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            flat = pa.array(np.concatenate(ids) if ids else np.array([], np.int32))
            yield pa.RecordBatch.from_arrays([run.column(0), pa.array(n), pa.ListArray.from_arrays(offsets, flat)], ["id", "n_tokens", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id {kind}, n_tokens long, ids array<int>").withColumnRenamed("id", id_col)


def bpe_decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """For each row: ``id_col`` and ``text``, the concatenated vocabulary strings.

    Null or empty ids give an empty text.
    """
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = load(tokenizer)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                run = batch.slice(i, 256)
                texts = [bpe.decode(x or ()) for x in run.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([run.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(decode, f"id {kind}, text string").withColumnRenamed("id", id_col)


def bpe_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """Encode, decode and return digests only: ``id_col``, ``n_tokens``,
    ``ids_sha256`` (little-endian unsigned 32-bit ids) and ``decoded_sha256``.

    Ids and decoded texts never leave the task that made them.  Nulls, empty
    texts, repeated rows and other columns are treated as by ``bpe_encode``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = load(tokenizer)
        for run in slices(batches, "text", batch_bytes):
            n, of_ids, of_text = [], [], []
            for raw in cache.texts(run.column(1).to_pylist(), pieces.words):
                n.append(len(raw) // 4)
                of_ids.append(hashlib.sha256(raw).hexdigest())
                decoded = hashlib.sha256()
                for i in range(0, len(raw), 1 << 18):  # part by part
                    decoded.update((" " * (i > 0) + bpe.decode(np.frombuffer(raw[i : i + (1 << 18)], "<u4").tolist())).encode())
                of_text.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays([run.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
