"""Which tokens of two tokenizers cover the same bytes, through a dictionary of groups.

Byte offsets where tokens of both end cut a text into groups.  Texts repeat
their groups, so distinct groups are interned with a key of 64 bits, a group is
expanded to links once, and what depends on the whole corpus is worked out for
each distinct group and joined back to documents by its key.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces
from .bpe import byte_alphabet
from .common import Table, resident, slices

#: Before a single space between two other characters; both tokenizers keep that space with what follows.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_CHUNK = 1 << 16
#: Pieces that are encoded in one text.
_PIECES = 1 << 13
#: Pieces of up to so many characters are remembered, so many of them at the most.
_USUAL, _REMEMBERED = 48, 300_000
#: Longer pieces are cut at seams.
_LONG_PIECE = 1 << 15
#: Groups that a task remembers to have described; beyond that it may describe some again.
_DESCRIBED = 500_000
_PAIRS_AT_ONCE = 1 << 22


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of runs of ``counts`` that begin at ``starts``, one after another."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


class Tokenizers:
    """Both tokenizers in a Python worker, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as f:
            definition = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        shown = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(shown)]
        self.a_len, self.b_len = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        # a space begins a piece of B and no piece joins it to what stands before
        self.cuts = pieces.cutter(definition) is pieces.spaced_words and not any(re.search("[^▁]▁", p) for p in shown)
        self.line = len(self.b.encode("\n")) if not any("\n" in p for p in shown) else None
        self.seams: pieces.Seams | None = None
        self.forget()

    def _seams(self) -> pieces.Seams:
        if self.seams is None:
            self.seams = pieces.Seams([*self.a_bytes, *self.b_bytes])
        return self.seams

    def pieces(self, text: str) -> list[str]:
        """What both encode alike in the text, which begins with the added space, and alone."""
        if not self.cuts:
            return [text]
        found = _CUT.split(text)
        if self.line is None or max(map(len, found)) <= _LONG_PIECE:
            return found
        return [part for p in found for part in (self._seams().parts(p, _LONG_PIECE // 2) if len(p) > _LONG_PIECE else [p])]

    def windows(self, text: str, most: int = 1 << 21) -> Iterator[str]:
        """A text with its added space, about ``most`` characters at a time."""
        at = 0
        while self.cuts and len(text) - at > most:
            m = _CUT.search(text, at + most, at + 2 * most)
            end = m.start() if m else self._seams().next(text, at + most) if self.line is not None else len(text)
            if end >= len(text):
                break
            yield text[at:end]
            at = end
        yield text[at:]

    def _alone(self, piece: str) -> tuple[list[int], list[int]] | None:
        a = self.a.encode(piece, add_special_tokens=False).ids
        b = self.b.encode(piece[1:]) if piece.startswith(" ") else self.b.encode("\n" + piece)[self.line :]
        raw = piece.encode("utf-8", "replace")
        same = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
        return (a, b) if same else None

    def _chunk(self, chunk: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """The ids of A and B of pieces that follow each other, and how many each has;
        None if they don't give the pieces' bytes."""
        text = "".join(chunk)
        raw = text.encode("utf-8", "replace")
        ends = np.cumsum(list(map(len, chunk)) if len(raw) == len(text) else [len(p.encode("utf-8", "replace")) for p in chunk])
        out = []
        for found, lengths, of in ((self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.a_len, self.a_bytes), (self.b.encode(text[1:]), self.b_len, self.b_bytes)):
            ids = np.array(found, np.int64)
            at = np.cumsum(lengths[ids])
            where = np.searchsorted(at, ends)
            if at[-1] != len(raw) or (at[where] != ends).any() or b"".join(map(of.__getitem__, found)) != raw:
                return None
            out += [ids, np.diff(where, prepend=-1)]
        return tuple(out)

    def encode(self, distinct: list[str]) -> tuple[list[str], list[np.ndarray], list[str]]:
        """The pieces in an order of their own, the ids of A, how many each piece has,
        the same of B; and the pieces whose tokens don't give their bytes."""
        fit = [p for p in distinct if self.cuts and p[0] == " " and len(p) < _CHUNK and not p[-1].isspace()]
        alone = [p for p in distinct if not (self.cuts and p[0] == " " and len(p) < _CHUNK and not p[-1].isspace())]
        order: list[str] = []
        found: list[tuple] = []
        for i in range(0, len(fit), _PIECES):
            chunk = fit[i : i + _PIECES]
            made = self._chunk(chunk)
            if made is None:
                alone += chunk
            else:
                order += chunk
                found.append(made)
        bad = []
        for p in alone:
            made = self._alone(p)
            if made is None:
                bad.append(p)
            else:
                order.append(p)
                found.append((*(x for ids in made for x in (np.array(ids, np.int64), np.array([len(ids)]))),))
        return order, [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(4)], bad

    def forget(self) -> None:
        """Pieces have numbers, in the order of ``names``: their groups are ``flat``
        between ``starts``, as text ``texts``.  Groups have numbers too."""
        self.number: dict[str, int] = {}
        self.names: list[str] = []
        self.texts: list[str] = []
        self.good, self.starts, self.flat = np.zeros(0, bool), np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.group: dict[int, int] = {}
        self.sides: list[tuple[list[int], list[int]]] = []
        self.said: list[str] = []
        self.keys = np.zeros(0, np.int64)

    def learn(self, distinct: list[str]) -> None:
        """Number these pieces and their groups."""
        order, (a, n_a, b, n_b), bad = self.encode(distinct)
        ids = (a, b)
        ends = [np.cumsum(lengths[x]) for x, lengths in zip(ids, (self.a_len, self.b_len))]
        common = np.intersect1d(*ends, assume_unique=True)  # the end of each group
        edges = [np.concatenate([[0], np.searchsorted(e, common) + 1]) for e in ends]
        with np.errstate(over="ignore"):  # a group's key: its ids with their places in it
            sums = []
            for k in (0, 1):
                place = np.arange(len(ids[k])) - np.repeat(edges[k][:-1], np.diff(edges[k]))
                each = _mix(_mix(ids[k].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 + k)) + place.astype(np.uint64))
                sums.append(np.add.reduceat(each, edges[k][:-1]) if len(common) else np.zeros(0, np.uint64))
            keys = _mix(sums[0] + _mix(sums[1] + np.diff(edges[0]).astype(np.uint64))).view(np.int64)
        own, first, of = np.unique(keys, return_index=True, return_inverse=True)
        for key, i in zip(own.tolist(), first.tolist()):
            g = self.group.get(key)
            if g is None:
                g = self.group[key] = len(self.sides)
                side = tuple(x[e[i] : e[i + 1]].tolist() for x, e in zip(ids, edges))
                self.sides.append(side)
                self.said.append(f"{','.join(map(str, side[0]))}|{','.join(map(str, side[1]))}")
        numbers = np.array([self.group[k] for k in own.tolist()], np.int64)
        self.keys = np.concatenate([self.keys, np.zeros(len(self.sides) - len(self.keys), np.int64)])
        self.keys[numbers] = own
        flat = numbers[of] if len(own) else np.zeros(0, np.int64)
        # a piece's groups are those that end within its bytes
        piece = np.searchsorted(common, np.concatenate([[0], ends[0]])[np.cumsum(n_a)], "right")
        at, said = [0, *piece.tolist()], list(map(self.said.__getitem__, flat.tolist()))
        self.texts += [";".join(said[i:j]) for i, j in zip(at, at[1:])] + [""] * len(bad)
        base = len(self.names)
        self.names += order + bad
        self.number.update(zip(self.names[base:], range(base, len(self.names))))
        self.good = np.concatenate([self.good, np.ones(len(order), bool), np.zeros(len(bad), bool)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + piece, np.full(len(bad), self.starts[-1] + len(flat))])
        self.flat = np.concatenate([self.flat, flat])

    def trim(self, pieces: int, groups: int) -> None:
        """Forget what was numbered after these."""
        for p in self.names[pieces:]:
            del self.number[p]
        for k in self.keys[groups:].tolist():
            del self.group[k]
        del self.names[pieces:], self.texts[pieces:], self.sides[groups:], self.said[groups:]
        self.good, self.starts, self.keys = self.good[:pieces], self.starts[: pieces + 1], self.keys[:groups]
        self.flat = self.flat[: self.starts[-1]]


def load(a_path: str, b_path: str) -> Tokenizers:
    return resident(("alignment", a_path, b_path), lambda: Tokenizers(a_path, b_path))


class Groups:
    """The groups of some texts with their added space: ``keys`` and the ids of both
    sides of each distinct group, and for each text the number of times it has each
    (``owner``, ``group``, ``times``); ``said`` has each text's groups in order, as
    text, None where it has no tokens.

    A worker remembers the groups of usual pieces, a bounded number of them; what
    is longer or comes later is worked out each time.
    """

    def __init__(self, tok: Tokenizers, texts: list[str]):
        split = [tok.pieces(t) if t and "▁" not in t else [] for t in texts]
        new = [p for p in dict.fromkeys(chain.from_iterable(split)) if p not in tok.number]
        kept = len(tok.names), len(tok.keys)
        tok.learn([p for p in new if len(p) <= _USUAL])
        if len(tok.names) <= _REMEMBERED and len(tok.keys) <= _REMEMBERED:
            kept = len(tok.names), len(tok.keys)
        tok.learn([p for p in new if len(p) > _USUAL])
        which = [list(map(tok.number.__getitem__, ps)) for ps in split]
        if not tok.good.all():
            which = [w if tok.good[w].all() else [] for w in which]
        self.said = [";".join(map(tok.texts.__getitem__, w)) if w else None for w in which]
        length = np.array(list(map(len, which)), np.int64)
        every = np.array(list(chain.from_iterable(which)), np.int64)
        counts = np.diff(tok.starts)[every]
        occurrences = tok.flat[_gather(tok.starts[every], counts)]
        owner = np.repeat(np.repeat(np.arange(len(texts)), length), counts)
        code, self.times = np.unique(owner * max(1, len(tok.keys)) + occurrences, return_counts=True)
        self.owner, group = np.divmod(code, max(1, len(tok.keys)))
        distinct, self.group = np.unique(group, return_inverse=True)
        self.keys, found = tok.keys[distinct], distinct.tolist()
        self.sides, self.text = [tok.sides[g] for g in found], [tok.said[g] for g in found]
        tok.trim(*kept)


def _together(x: Groups, y: Groups) -> Groups:
    """The groups of one text, from two parts of it."""
    keys, first = np.unique(np.concatenate([x.keys, y.keys]), return_index=True)
    sides, text = x.sides + y.sides, x.text + y.text
    group, back = np.unique(np.concatenate([np.searchsorted(keys, p.keys)[p.group] for p in (x, y)]), return_inverse=True)
    y.keys, y.sides, y.text, y.group, y.owner = keys, [sides[i] for i in first], [text[i] for i in first], group, np.zeros(len(group), np.int64)
    y.times = np.bincount(back, weights=np.concatenate([x.times, y.times])).astype(np.int64)
    return y


def _repeated_pairs(sides: list, owner: np.ndarray, group: np.ndarray) -> Counter:
    """For pairs that a document has in several of its groups: in how many more than one."""
    extra: Counter = Counter()
    different = [(set(a), set(b)) for a, b in sides]
    sizes = np.array([len(a) * len(b) for a, b in different], np.int64)
    edges = np.flatnonzero(np.diff(owner, prepend=-1)).tolist() + [len(owner)]
    small = int(sizes.sum()) <= _PAIRS_AT_ONCE
    if small:  # expand each group once
        starts, flat = np.cumsum(sizes) - sizes, np.array([x << 32 | y for a, b in different for x in a for y in b], np.int64)
    for i, j in zip(edges, edges[1:]):
        own = group[i:j]
        total = int(sizes[own].sum())
        slices_ = 1 if small else -(-total // _PAIRS_AT_ONCE)
        for k in range(slices_):
            if small:
                found = flat[_gather(starts[own], sizes[own])]
            else:
                found = np.array([x << 32 | y for a, b in (different[g] for g in own.tolist()) for x in a if x % slices_ == k for y in b], np.int64)
            found.sort()
            again = found[1:][found[1:] == found[:-1]]
            extra.update(again.tolist())
    return extra


_SCALARS = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, batch_bytes: int) -> Table:
    """A row for each run of documents: what is counted of each, the run's distinct
    groups and which of them each document has how often."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, described = load(a_path, b_path), set()
        for batch in slices(batches, "text", batch_bytes):
            texts = [" " + t if t else "" for t in batch.column(1).to_pylist()]
            n = len(texts)
            if n == 1:  # perhaps a very long one: window by window, and none if one has no tokens
                found, sha = None, hashlib.sha256()
                for w in tok.windows(texts[0]):
                    new = Groups(tok, [w])
                    if new.said[0] is None:
                        found, said = Groups(tok, [""]), [""]
                        break
                    sha.update((b"" if found is None else b";") + new.said[0].encode())
                    found, said = new if found is None else _together(found, new), [sha.hexdigest()]
            else:
                found = Groups(tok, texts)
                said = [hashlib.sha256(s.encode()).hexdigest() if s is not None else "" for s in found.said]
            keys, sides, text, owner, group, times = found.keys, found.sides, found.text, found.owner, found.group, found.times
            a, b = (np.array([len(s[k]) for s in sides], np.int64) for k in (0, 1))
            sums = [np.bincount(owner, weights=times * x[group], minlength=n).astype(np.int64) for x in (a, b, np.ones(len(keys), np.int64), a * b)]
            new = [i for i, k in enumerate(keys.tolist()) if k not in described]
            if len(described) > _DESCRIBED:
                described.clear()
            described.update(keys[new].tolist())
            extra = _repeated_pairs(sides, owner, group)
            lists = lambda v, t: pa.array([v], pa.list_(t))
            held = np.bincount(owner, minlength=n)
            step = np.diff(group, prepend=0).astype("<i4")
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(0)),
                *(lists(s, pa.int64()) for s in sums), lists(said, pa.string()),
                lists(keys, pa.int64()), lists(np.bincount(group, minlength=len(keys)), pa.int64()), lists(held, pa.int32()), pa.array([step.tobytes()], pa.binary()), pa.array([times.astype("<u4").tobytes()], pa.binary()),
                lists(keys[new], pa.int64()), lists([text[i] for i in new], pa.string()), lists(list(extra), pa.int64()), lists(list(extra.values()), pa.int64()),
            ], names)

    names = ["ids", *_SCALARS, "said", "keys", "key_docs", "held", "step", "times", "new_keys", "new_text", "pairs", "more"]
    schema = f"ids array<{kind}>, {', '.join(f'{c} array<long>' for c in _SCALARS)}, said array<string>, keys array<long>, key_docs array<long>, held array<int>, step binary, times binary, new_keys array<long>, new_text array<string>, pairs array<long>, more array<long>"
    return Table(rows.mapInArrow(run, schema), "blocks")


def _expanded(groups: DataFrame) -> DataFrame:
    """``key``, ``docs``, ``pair`` (A id * 2**32 + B id) and ``links``, how often the
    group links it; each distinct group is expanded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, docs, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                a, b = (Counter(map(int, side.split(","))) for side in text.split("|"))
                for x, n in a.items():
                    for column, values in zip(out, ([key] * len(b), [docs] * len(b), [x << 32 | y for y in b], [n * m for m in b.values()])):
                        column += values
                    if len(out[0]) > 1 << 16:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
                        out = [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    names = ["key", "docs", "pair", "links"]
    return groups.select("key", "docs", "text").mapInArrow(run, "key long, docs long, pair long, links long")


class Alignment:
    """The alignment of a table's texts; ``pairs`` and ``documents`` read from it."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 22, most_sent: int = 1 << 17):
        self.id_col, self.most_sent = id_col, most_sent
        self.blocks = _blocks(docs, a_path, b_path, id_col, text_col, batch_bytes).read()
        each = lambda *c: F.explode(F.arrays_zip(*c)).alias("e")
        docs_of = self.blocks.select(each("keys", "key_docs")).groupBy(F.col("e.keys").alias("key")).agg(F.sum("e.key_docs").alias("docs"))
        described = self.blocks.select(each("new_keys", "new_text")).groupBy(F.col("e.new_keys").alias("key")).agg(F.min("e.new_text").alias("text"), F.max("e.new_text").alias("other"))
        one = F.when(F.col("text") == F.col("other"), F.col("text")).otherwise(F.raise_error(F.lit("two different groups have one key")))
        self.expanded = Table(_expanded(docs_of.join(described.select("key", one.alias("text")), "key")), "expanded").read()
        more = self.blocks.select(each("pairs", "more")).select("e.pairs", (-F.col("e.more")).alias("docs"))
        counts = self.expanded.select("pair", "docs").union(more).groupBy("pair").agg(F.sum("docs").alias("count"))
        counted = Table(counts.withColumn("a", F.shiftright("pair", 32)), "pairs").read()
        top = counted.groupBy("a").agg(F.max("count").alias("top"))
        # at most a row for each id of A's vocabulary
        self.counted = counted.join(F.broadcast(top), "a").withColumn("best", F.col("count") == F.col("top"))

    def pairs(self) -> DataFrame:
        """``a_id``, ``b_id``, ``n_docs`` (documents that hold the pair linked) and
        ``best`` (no pair of this A id has more)."""
        return self.counted.select(F.col("a").cast("int").alias("a_id"), F.col("pair").bitwiseAND((1 << 32) - 1).cast("int").alias("b_id"), F.col("count").alias("n_docs"), "best")

    def documents(self) -> DataFrame:
        """What the corpus says of each document's links; see ``align``."""
        worth = self.expanded.join(self.counted.select("pair", "count", "best"), "pair")
        stats = Table(worth.groupBy("key").agg(F.max("docs").alias("docs"), F.sum(F.col("links") * F.col("count")).alias("total"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("best")), "groups").read()
        # the groups of most documents go to every task, at most most_sent of them; others are joined
        sizes = {r.level: r.n for r in stats.groupBy(F.floor(F.log2("docs")).alias("level")).agg(F.count("*").alias("n")).collect()}
        level, sent = 64, 0
        while level > 0 and sent + sizes.get(level - 1, 0) <= self.most_sent:
            level -= 1
            sent += sizes.get(level, 0)
        known = stats.where(F.floor(F.log2("docs")) >= level).select("key", "total", "best").toArrow()
        order = np.argsort(known["key"].to_numpy())
        sent_keys, total, best = (known[c].to_numpy()[order] for c in ("key", "total", "best"))
        kind = self.blocks.schema["ids"].dataType.elementType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    get = lambda c: batch.column(batch.schema.get_field_index(c))[r]
                    keys, held = np.array(get("keys").values.to_numpy(zero_copy_only=False)), get("held").values.to_numpy(zero_copy_only=False)
                    group = np.cumsum(np.frombuffer(get("step").as_buffer(), "<i4").astype(np.int64))
                    times = np.frombuffer(get("times").as_buffer(), "<u4").astype(np.int64)
                    n, owner = len(held), np.repeat(np.arange(len(held)), held)
                    at = np.minimum(np.searchsorted(sent_keys, keys), max(0, len(sent_keys) - 1))
                    hit = sent_keys[at] == keys if len(sent_keys) else np.zeros(len(keys), bool)
                    sums = []
                    for values in (best, total):
                        worth = np.where(hit, values[at] if len(sent_keys) else 0, 0)
                        cumulated = np.concatenate([[0], np.cumsum(times * worth[group])])
                        edges = np.concatenate([[0], np.cumsum(held)])
                        sums.append(cumulated[edges[1:]] - cumulated[edges[:-1]])
                    miss = ~hit[group]
                    edges = np.concatenate([[0], np.cumsum(np.bincount(owner[miss], minlength=n))]).astype(np.int32)
                    rest = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x[miss])) for x in (keys[group], times)]
                    yield pa.RecordBatch.from_arrays([get("ids").values, *(get(c).values for c in (*_SCALARS, "said")), *map(pa.array, sums), *rest], names)

        names = ["id", *_SCALARS, "groups_sha256", "n_best", "count_sum", "rest", "rest_times"]
        schema = f"id {kind}, {', '.join(f'{c} long' for c in _SCALARS)}, groups_sha256 string, n_best long, count_sum long, rest array<long>, rest_times array<long>"
        given = self.blocks.drop("key_docs", "new_keys", "new_text", "pairs", "more").mapInArrow(run, schema)
        given = Table(given.withColumn("row", F.monotonically_increasing_id()), "documents").read()
        rare = given.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("e")).select("row", F.col("e.rest").alias("key"), F.col("e.rest_times").alias("times"))
        added = rare.join(stats.select("key", "total", "best"), "key").groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("total")).alias("more_sum"))
        out = given.drop("rest", "rest_times").join(added, "row", "left")
        plus = lambda c, m: (F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c)
        return out.select(F.col("id").alias(self.id_col), *_SCALARS, plus("n_best", "more_best"), plus("count_sum", "more_sum"), "groups_sha256")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256``.

    ``a_path`` is a byte-level tokenizers JSON file, ``b_path`` a sentencepiece
    model that adds a space in front.  All token occurrences of A and B within a
    group are linked.  A pair's count is the number of rows that hold it linked;
    ``n_best`` are the links whose count is the highest of their A id, ties
    included, ``count_sum`` sums the counts of all links.

    Texts that are null or empty, or that a tokenizer doesn't give back byte by
    byte, have no tokens: zeros and an empty digest.  Null ids and repeated rows
    are kept, and each repeated row counts; other columns are ignored; an empty
    table gives an empty result.  Long texts go window by window.
    """
    return Alignment(docs, a_path, b_path, id_col, text_col).documents()
