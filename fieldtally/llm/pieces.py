"""Cut texts where a tokenizer never joins, and encode each distinct piece once.

A tokenizer that splits its input before merging gives the same ids for a text
and for its parts, as long as every cut is one of its own splits.  Natural text
repeats its words, so a task encodes the pieces that it hasn't seen, in batches
of about equal bytes, and looks the others up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterable
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import resident

#: The characters with Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE_RUN = re.compile(f"[{WHITE}]+")
#: str.split() also takes these separators for white space.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_IRREGULAR = re.compile(r"[^\S \n]|[ \n]{2}|\A[ \n]|[ \n]\Z|\x00")
_CUT = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


def whole(text: str) -> list[str]:
    """One piece: right for every tokenizer."""
    return [text] if text else []


def words(text: str) -> list[str]:
    """For tokenizers that drop white space: the runs of other characters."""
    if _SEPARATORS.search(text):
        return [w for w in _WHITE_RUN.split(text) if w]
    return text.split()


def spaced_words(text: str) -> list[str]:
    """For byte-level tokenizers that keep a space with the word after it.

    Cuts stand before a single space between two other characters and on both
    sides of such a line feed; runs of white space stay with their neighbours.
    """
    if not text:
        return []
    if _IRREGULAR.search(text):
        return _CUT.split(text)
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")


def cutter(definition: dict) -> Callable[[str], list[str]]:
    """The finest of the cuts above that is safe for a tokenizer file.

    Only shapes that are known to be safe are cut; any other is encoded whole.
    """
    if any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in definition.get("added_tokens") or []):
        return whole
    pre, norm = definition.get("pre_tokenizer") or {}, definition.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return spaced_words
    if pre.get("type") == "Sequence" and [n["type"] for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
        split = pre["pretokenizers"][0]
        if split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"] and split["pattern"].get("Regex", "").endswith(r"[^\s\p{L}\p{N}]+"):
            return words
    return whole


#: Letters that all versions of Unicode know as such: Latin, Greek, Cyrillic, Hebrew, Arabic, kana, Han, Hangul.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſα-ωА-яא-תء-غف-يぁ-ゖァ-ヺ一-龥가-힣"
_STOPS = "。、，．！？；：「」『』（）"
#: Three letters before, so that no contraction ends there.
_BETWEEN_LETTERS = re.compile(f"(?<=[{_LETTERS}]{{3}})(?=[{_LETTERS}])")
_AT_STOP = f"(?<=[{_LETTERS}])(?=[{_STOPS}])|(?<=[{_STOPS}])(?=[{_LETTERS}])"


class Seams:
    """Places within a run of letters that no token of a vocabulary lies across.

    Whatever byte-pair merging joins is a token, so it never joins the two sides
    of a seam, and both can be encoded apart.  ``tokens`` are the bytes of all
    tokens, without marks of a word's end; ``fold`` is done to texts before.
    """

    def __init__(self, tokens: Iterable[bytes], fold: Callable[[str], str] = str):
        self.tokens, self.fold = {t for t in tokens if len(t) > 1}, fold
        self.starts = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.longest = max(map(len, self.tokens), default=1)

    def free(self, left: bytes, right: bytes) -> bool:
        for i in range(1, min(len(left), self.longest - 1) + 1):
            head = left[-i:]
            if head in self.starts and any(head + right[:j] in self.tokens for j in range(1, min(len(right), self.longest - i) + 1)):
                return False
        return True

    def next(self, text: str, at: int) -> int:
        """The first seam at or after ``at``; the text's end if there is none."""
        for m in _BETWEEN_LETTERS.finditer(text, max(at, 1)):
            p = m.start()
            if self.free(*(self.fold(side).encode("utf-8", "replace") for side in (text[max(0, p - self.longest) : p], text[p : p + self.longest]))):
                return p
        return len(text)

    def parts(self, text: str, least: int) -> list[str]:
        """The text cut at seams, ``least`` characters at a time or more."""
        out, at = [], 0
        while len(text) - at > 2 * least and (end := self.next(text, at + least)) < len(text):
            out.append(text[at:end])
            at = end
        return [*out, text[at:]]


#: Characters that are cut into pieces at once.
WINDOW = 1 << 18
_WINDOW_END = {"words": re.compile(f"(?=[{WHITE}])|{_AT_STOP}"), "spaced_words": re.compile(rf"(?<=\S)(?= \S)|{_AT_STOP}")}


def windows(text: str, cut: Callable[[str], list[str]], never: tuple[str, ...] = (), most: int = WINDOW) -> Iterable[str]:
    """The text in parts of about ``most`` characters that a tokenizer encodes alike
    apart: they end before white space or where letters meet East Asian stops,
    which are splits of both kinds of tokenizers, and not within ``never``."""
    ends, at, around = _WINDOW_END.get(cut.__name__), 0, max(map(len, never), default=1)
    while ends is not None and len(text) - at > most:
        for m in ends.finditer(text, at + most):
            p = m.start()
            beside = text[max(0, p - around + 1) : p + around - 1]
            if not any(x in beside for x in never):
                break
        else:
            break
        yield text[at:p]
        at = p
    yield text[at:]


#: The matches of a pattern within a piece of these characters only; newer parts of Unicode
#: differ between versions, so other pieces are always encoded whole; so is U+0130, whose lower
#: case has a mark that isn't a letter.
_KNOWN = re.compile("[\x00-\u012f\u0131-\u017f]*")
#: Of the lower-case letters below U+0180 those that have no other form; nor has a text of
#: them and single spaces.
_LOW = f"a-z{''.join(c for c in map(chr, range(0x80, 0x180)) if c.isalpha() and c.islower() and unicodedata.category(c) == 'Ll' and unicodedata.normalize('NFC', c.lower()) == c)}"
_LOW_WORD = re.compile(f"[{_LOW}]+")
_LOW_WORDS = re.compile(f"[{_LOW} ]+")
_INNER_WHITE = re.compile(r"(?s).\s")


def _kinds() -> np.ndarray:
    """Of the characters below U+0180: 0 marks, 1 letters and digits, 2 comma and stop,
    3 white space, 4 what plain words can't hold."""
    kinds = np.zeros(0x180, np.uint8)
    for c in map(chr, range(0x180)):
        kinds[ord(c)] = 4 if _SEPARATORS.match(c) or c == "\u0130" else 3 if c.isspace() else 1 if re.match("[a-z0-9ß-öø-ſ]", c.lower()) else 2 if c in ",." else 0
    return kinds


_KINDS = _kinds()


def plain_text(text: str, never: tuple[str, ...]) -> str | None:
    """Usual texts in lower case, with white space around commas and stops, so that far
    fewer words are different; None for others.  Only for tokenizers that fold case and
    split letters from marks; a comma or stop after another mark is in one match
    with it."""
    if text.isascii():
        kinds = _KINDS[np.frombuffer(text.encode(), np.uint8)]
    else:
        units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
        if units.max() >= len(_KINDS):
            return None
        kinds = _KINDS[units]
    if kinds.max() == 4 or ((kinds[1:] == 2) & (kinds[:-1] & 1 == 0)).any():
        return None
    low = text.lower()
    if ("|" in low or any("|" not in x for x in never)) and any(x in low for x in never):
        return None
    for mark in ",.":
        low = low.replace(f"{mark} ", f" {mark} ").replace(f"{mark}\n", f" {mark} ")
    return low


def plain_words(text: str, never: tuple[str, ...]) -> list[str] | None:
    """The words of ``plain_text``."""
    low = plain_text(text, never)
    return None if low is None else low.split()


#: Rough bytes of a remembered entry besides its text and value.
_ENTRY_BYTES = 160
#: Longer pieces are rare and are encoded each time.
_LONGEST_KEPT = 48
#: Pieces without any place to cut that are encoded part by part, if ``encode_long`` can.
_LONG = 1 << 14


class PieceCache:
    """text -> value, for pieces and for parts of pieces alike.

    A piece that isn't known is cut again at the matches of ``pattern`` (the
    tokenizer's own splits), and what isn't known of those is encoded in batches
    of about ``batch_bytes``.  Entries of ``most_bytes`` in all are remembered;
    what comes later, and long pieces, are worked out each time.  ``flat``: values
    are ids as bytes, and usual texts are put together by Arrow and NumPy.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable], join: Callable, pattern: str | None = None, fold: bool = False, never: tuple[str, ...] = (), most_bytes: int = 112 << 20, batch_bytes: int = 1 << 18, encode_long: Callable | None = None, flat: bool = False):
        import regex

        self.encode, self.join, self.fold, self.never, self.most_bytes, self.batch_bytes = encode, join, fold, never, most_bytes, batch_bytes
        self.find = regex.compile(pattern).findall if pattern else None
        self.encode_long, self.flat = encode_long, flat
        self.known: dict = {}
        self.bytes = 0

    def _cut(self, piece: str) -> list[str]:
        if self.find is not None:
            if piece.isalpha() and piece.isascii():
                return [piece.lower() if self.fold else piece]
            # the usual pieces: letters, perhaps after a space or before one mark
            start = piece.startswith(" ")
            mark = piece[-1:] in {",", "."}
            letters = piece[start : len(piece) - mark]
            if letters.isalpha() and (letters.isascii() or _KNOWN.fullmatch(letters)):
                run = piece[: len(piece) - mark]
                run = run.lower() if self.fold else run
                return [run, piece[-1]] if mark else [run]
        if self.find is None or not _KNOWN.fullmatch(piece) or _INNER_WHITE.search(piece) or any(x in piece for x in self.never):
            return [piece]
        return self.find(piece.lower() if self.fold else piece)

    def _keep(self, values: dict) -> None:
        if self.bytes < self.most_bytes:
            kept = {x: v for x, v in values.items() if len(x) <= _LONGEST_KEPT}
            self.known.update(kept)
            self.bytes += sum(_ENTRY_BYTES + len(x) + (len(v) if isinstance(v, bytes) else 0) for x, v in kept.items())

    def _single(self, piece: str) -> bool:
        """Whether a piece is a run of letters that is encoded as it is."""
        letters = piece if self.fold or piece[:1] != " " else piece[1:]
        return self.find is not None and letters.isalpha() and (letters.isascii() or _KNOWN.fullmatch(letters) is not None) and (not self.fold or letters.islower())

    def _learn(self, new: set[str]) -> dict:
        known = self.known
        low = set(filter(_LOW_WORD.fullmatch, new)) if self.fold and self.find is not None else set()
        other = new.difference(low)
        single = set(filter(self._single, other))
        cuts = {p: self._cut(p) for p in other.difference(single)}
        single.update(x for cut in cuts.values() for x in cut if x not in known)
        found: dict = {}
        batch, held = [], 0
        for x in chain(low, single.difference(low)):
            if self.encode_long is not None and len(x) > _LONG:
                found[x] = self.encode_long(x)
                continue
            batch.append(x)
            held += len(x)
            if held >= self.batch_bytes:
                found.update(zip(batch, self.encode(batch)))
                batch, held = [], 0
        if batch:
            found.update(zip(batch, self.encode(batch)))
        values = {p: self.join([known[x] if x in known else found[x] for x in cut]) for p, cut in cuts.items()}
        self._keep(found)
        self._keep({p: v for p, v in values.items() if p not in found})
        return found | values

    def __call__(self, texts: list[list[str]]) -> list:
        """The joined value of each text, which is given as its pieces."""
        # the different pieces of these texts are few, so their own table is quicker to look up
        distinct = set().union(*texts)
        own = dict(zip(distinct, map(self.known.get, distinct)))
        new = {p for p, v in own.items() if v is None}
        if new:
            own.update(self._learn(new))
        return [self.join(map(own.__getitem__, pieces)) for pieces in texts]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that ``plain_text`` gave.  Arrow splits them and numbers their
        different words, so only those become Python strings and are looked up."""
        split = pc.utf8_split_whitespace(pa.array(texts, pa.string()))
        coded = split.flatten().dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        values = list(map(self.known.get, different))
        if new := {w for w, v in zip(different, values) if v is None}:
            learned = self._learn(new)
            values = [learned[w] if v is None else v for w, v in zip(different, values)]
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        word, ids = coded.indices.to_numpy(), np.frombuffer(b"".join(values), "<u4")
        held = sizes[word]
        ends = np.cumsum(held)
        # what an id's place among all words' ids is more than its place in the texts
        shift = (np.cumsum(sizes) - sizes)[word] - (ends - held)
        raw = ids[np.repeat(shift, held) + np.arange(held.sum())].tobytes()
        bounds = 4 * np.concatenate([[0], ends])[split.offsets.to_numpy()]
        return [raw[a:b] for a, b in pairwise(bounds.tolist())]

    def texts(self, texts: list[str | None], cut: Callable[[str], list[str]]) -> list:
        """The value of each whole text."""
        if self.flat and cut is words and self.fold:
            low = {k: p for k, t in enumerate(texts) if t and len(t) <= WINDOW and (p := plain_text(t, self.never)) is not None}
            rest = iter(self._listed([t for k, t in enumerate(texts) if k not in low], cut))
            done = dict(zip(low, self._plain(list(low.values()))))
            return [done[k] if k in done else next(rest) for k in range(len(texts))]
        return self._listed(texts, cut)

    def _listed(self, texts: list[str | None], cut: Callable[[str], list[str]]) -> list:
        """``texts`` by lists of their pieces; a long one goes window by window, so that
        its pieces are never listed all at once."""
        usual = self([(plain_words(t, self.never) if cut is words and self.fold else None) or cut(t) if t and len(t) <= WINDOW else [] for t in texts])
        for k, t in enumerate(texts):
            if t and len(t) > WINDOW:
                usual[k] = self.join(self([cut(w)])[0] for w in windows(t, cut, self.never))
        return usual


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


#: Fixed value: how byte-level tokenizers split text before merging, without its white-space cases.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"


def pattern_of(definition: dict) -> tuple[str | None, bool]:
    """The pattern that finds a tokenizer's own splits within a piece, and whether case is folded."""
    cut = cutter(definition)
    if cut is spaced_words:
        return _BYTE_LEVEL, False
    if cut is words:
        return definition["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"], True
    return None, False


#: Fixed value: a split that takes a word of letters whole.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _for_low_words(tok, definition: dict):
    """The tokenizer's model without normalizing, pattern and added tokens, none of which
    touches words of ``_LOW_WORD``; the tokenizer, where one may."""
    split, *rest = definition["pre_tokenizer"]["pretokenizers"]
    if split["pattern"].get("Regex") != _WORD_SPLIT or [(r["type"], r.get("add_prefix_space"), r.get("use_regex")) for r in rest] != [("ByteLevel", False, False)] or any(_LOW_WORDS.fullmatch(t["content"].lower()) for t in definition.get("added_tokens") or []):
        return tok
    from tokenizers import Tokenizer, pre_tokenizers

    plain = Tokenizer(tok.model)
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return plain


def _words_in_one(tok, definition: dict, encode: Callable, kind: str) -> Callable[[list[str]], list]:
    """Encode many words in one text: every word's last token has the mark of an end.

    A text with another number of ends than words is encoded word by word; so are
    pieces of other characters, which may be several words.
    """
    low_tok = _for_low_words(tok, definition)
    vocab, end = tok.get_vocab(with_added_tokens=True), definition["model"]["end_of_word_suffix"]
    ends = np.zeros(1 + max(vocab.values()), bool)
    ends[[i for t, i in vocab.items() if t.endswith(end)]] = True

    def run(batch: list[str]) -> list:
        single, found = list(filter(str.isalpha, batch)), {}
        if len(single) > 1:
            joined = " ".join(single)
            own = low_tok if _LOW_WORDS.fullmatch(joined) else tok
            ids = np.array(own.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(ends[ids]) + 1
            if len(at) == len(single) and at[-1] == len(ids):
                if kind == "ids":
                    raw, at = ids.tobytes(), (4 * at).tolist()
                    values = [raw[a:b] for a, b in zip([0, *at], at)]
                else:
                    values = np.diff(at, prepend=0).tolist()
                if len(single) == len(batch):
                    return values
                found = dict(zip(single, values))
        rest = [x for x in batch if x not in found]
        found.update(zip(rest, encode(rest)) if rest else ())
        return [found[x] for x in batch]

    return run


def _by_parts(definition: dict, path: str, encode: Callable, join: Callable, never: tuple[str, ...], kind: str) -> Callable[[str], object] | None:
    """How a piece that has no split is encoded in bounded memory."""
    made: list = []
    if cutter(definition) is spaced_words:

        def at_seams(piece: str):
            if not made:
                from .bpe import byte_alphabet

                byte_of = {c: b for b, c in enumerate(byte_alphabet())}
                made.append(Seams(bytes(map(byte_of.__getitem__, t)) for t in definition["model"]["vocab"] if all(c in byte_of for c in t)))
            parts = [piece] if any(x in piece for x in never) else made[0].parts(piece, _LONG // 2)
            return join(v for i in range(0, len(parts), 16) for v in encode(parts[i : i + 16]))

        return at_seams
    if cutter(definition) is words:

        def own(piece: str):  # the end of a word has a mark, so its parts need the encoder that knows it
            if not made:
                from .bpe import WordBpe

                with open(path, encoding="utf-8") as f:
                    made.append(WordBpe(f.read()))
            ids = made[0].word_ids(piece)
            return len(ids) if kind == "lengths" else id_bytes(ids)

        return own
    return None


def load(path: str, kind: str):
    """(cutter, cache) for a tokenizer file, once for each Python worker.

    ``kind``: ``lengths`` caches token counts, ``ids`` little-endian unsigned
    32-bit ids.
    """

    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        with open(path, encoding="utf-8") as f:
            definition = json.load(f)

        def run(batch):
            return tok.encode_batch_fast(batch, add_special_tokens=False)

        encode, join = {"lengths": (lambda b: map(len, run(b)), sum), "ids": (lambda b: [id_bytes(e.ids) for e in run(b)], b"".join)}[kind]
        if cutter(definition) is words and definition["model"].get("end_of_word_suffix"):
            encode = _words_in_one(tok, definition, encode, kind)
        pattern, fold = pattern_of(definition)
        never = tuple(t["content"] for t in definition.get("added_tokens") or [])
        long = _by_parts(definition, path, encode, join, never, kind)
        return cutter(definition), PieceCache(encode, join, pattern, fold, never, encode_long=long, flat=kind == "ids")

    return resident(("pieces", path, kind), make)

