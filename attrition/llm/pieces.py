"""Splitting text into pre-tokens, a block of documents at a time, in numpy.

The byte-level BPE vocabularies split text by one published pattern before
merging (contractions, letters, digits, other signs with one space in front,
white space); files with word ends lower-case it, drop white space and take digits one by one.
``split`` and ``split_words`` apply these rules to the code points of many
texts at once; ``PieceEncoder`` looks each distinct pre-token up once per task.

Pre-tokens are told apart by their letters: hashes only sort them.  Code points that Python's Unicode
tables do not know may be letters to a library, so texts that hold one are ``odd`` and
go to the library whole.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from itertools import chain

import numpy as np

from attrition.llm.common import MIX_1, U64, mix, spans_index

OTHER, LETTER, NUMBER, SPACE, UNKNOWN = 0, 1, 2, 3, 4
#: Fixed value: the published pattern of the byte-level files, which ``split`` applies.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the pattern of the files with word ends, which ``split_words`` applies to lower-cased text.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# fixed values: code points with the Unicode property White_Space
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
PLACE, LETTERS = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)

_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """Class of every code point; built once per Python worker."""
    global _classes
    if _classes is None:
        kinds = {"L": LETTER, "N": NUMBER}
        names = [unicodedata.category(chr(c)) for c in range(0x110000)]
        table = np.array([UNKNOWN if n == "Cn" else kinds.get(n[0], OTHER) for n in names], np.uint8)
        table[WHITE_SPACE] = SPACE
        _classes = table
    return _classes


def odd_text(text: str) -> bool:
    """Whether ``text`` has a code point that Python's Unicode tables do not know."""
    if text.isascii():
        return False
    return bool((char_classes()[np.frombuffer(text.encode("utf-32-le"), np.uint32)] == UNKNOWN).any())


_places = np.zeros(0, U64)


def _place_hashes(n: int) -> np.ndarray:
    global _places
    if len(_places) < n:
        _places = mix(np.arange(1, 2 * n + 1, dtype=U64) * PLACE)
    return _places


@dataclass
class Split:
    text: str               # the texts, joined
    starts: np.ndarray      # first code point of each piece
    lengths: np.ndarray
    per_doc: np.ndarray     # number of pieces of each text
    points: np.ndarray

    def strings(self, which: np.ndarray | slice = slice(None)) -> list[str]:
        starts = self.starts[which]
        return [self.text[a:b] for a, b in zip(starts.tolist(), (starts + self.lengths[which]).tolist(), strict=True)]

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of one example of each distinct piece, number of the distinct piece of every piece, their hashes).

        Pieces are sorted by a hash, the sum of their mixed letters and places, and then compared letter by letter.
        """
        if not len(self.starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
        first = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)
        lengths, starts = self.lengths.astype(np.int32), self.starts.astype(np.int32)
        place = np.arange(int(self.lengths.sum()), dtype=np.int32)
        own = self.points if len(self.points) == len(place) else self.points[place + np.repeat(starts - first, lengths)]
        place -= np.repeat(first, lengths)
        values = own * LETTERS + _place_hashes(int(lengths.max()))[place]
        values ^= values >> U64(32)
        values *= MIX_1
        values ^= values >> U64(29)
        hashes = mix(np.add.reduceat(values, first) + self.lengths.astype(U64))
        values, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        lead = example[inverse]
        if (lengths[lead] == lengths).all() and (self.points[place + np.repeat(starts[lead], lengths)] == own).all():
            return example, inverse, values
        numbers: dict[str, int] = {}      # two different pieces with one hash
        inverse = np.array([numbers.setdefault(w, len(numbers)) for w in self.strings()], np.int64)
        example = np.unique(inverse, return_index=True)[1]
        return example, inverse, hashes[example]


def _contractions(begin: np.ndarray, cp: np.ndarray, run: np.ndarray, run_end: np.ndarray, run_kind: np.ndarray,
                  quote: np.ndarray) -> None:
    """Joins the letters of a contraction to the apostrophe before them (``quote``: runs of one apostrophe)."""
    quote = quote[run_kind[np.minimum(quote + 1, len(run) - 1)] == LETTER]
    if not len(quote):
        return
    at = run[quote] + 1
    letters = run_end[quote + 1] - at
    one = np.isin(cp[at], [ord(c) for c in "stmd"])
    second = cp[np.minimum(at + 1, len(cp) - 1)]
    two = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        two |= (cp[at] == ord(a)) & (second == ord(b)) & (letters >= 2)
    for hit, width in ((one, 1), (two, 2)):
        begin[at[hit]] = False
        longer = hit & (letters > width)
        begin[at[longer] + width] = True


def _split(texts: list[str], words: bool) -> Split:
    joined = "".join(texts)
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    n = len(cp)
    if not n:
        return Split(joined, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64), cp)
    doc_first = (np.cumsum(sizes) - sizes)[sizes > 0]
    kind = char_classes()[cp]
    new_doc = np.zeros(n, bool)
    new_doc[doc_first] = True
    begin = new_doc.copy()
    begin[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(begin)
    run_end = np.append(run[1:], n)
    run_kind = kind[run]
    followed = np.append(~new_doc[run[1:]], False)      # a run of the same text comes next
    # an apostrophe alone, with a run of its text next
    quote = np.flatnonzero((run_kind == OTHER) & (run_end - run == 1) & followed)
    quote = quote[cp[run[quote]] == 39]
    if words:
        begin |= kind == NUMBER
    else:
        # white space before another run: its last sign stands apart, and a space joins what follows
        gaps = np.flatnonzero((run_kind == SPACE) & followed)
        last = run_end[gaps] - 1
        begin[last] = True
        joins = cp[last] == 32
        begin[last[joins] + 1] = False
        quote = quote[begin[run[quote]]]    # not after a space, which takes the apostrophe
    _contractions(begin, cp, run, run_end, run_kind, quote)
    starts = np.flatnonzero(begin)
    lengths = np.diff(np.append(starts, n))
    if words:
        kept = kind[starts] != SPACE
        starts, lengths = starts[kept], lengths[kept]
    bounds = np.searchsorted(starts, np.append(np.cumsum(sizes) - sizes, n))
    return Split(joined, starts, lengths, np.diff(bounds), cp)


def split(texts: list[str]) -> Split:
    """Pre-tokens by :data:`BYTE_LEVEL_PATTERN`."""
    return _split(texts, words=False)


def split_words(texts: list[str]) -> Split:
    """Pre-tokens of lower-cased texts by :data:`WORD_PATTERN`; white space is dropped."""
    return _split([t.lower() for t in texts], words=True)


def odd_words(text: str) -> bool:
    """Whether a library may lower-case or compose ``text`` otherwise than Python (or :func:`odd_text`)."""
    return not text.isascii() and ("\u03a3" in text or "\u0130" in text or not unicodedata.is_normalized("NFC", text)
                                   or odd_text(text))


class _Column:
    """An array that grows at its end without copying all of it each time."""

    def __init__(self, values: np.ndarray):
        self.store, self.size = values, len(values)

    def extend(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.store):
            self.store = np.concatenate([self.values, np.empty(self.size + len(values), self.store.dtype)])
        self.store[self.size:self.size + len(values)] = values
        self.size += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.store[:self.size]


class PieceEncoder:
    """Token ids of texts, encoding each distinct pre-token once.

    ``encode_words`` turns pre-tokens into lists of ids and ``encode_whole`` a text that ``odd`` names.
    What is known is kept between calls up to ``max_known`` pre-tokens; beyond, those that came up in one
    call only are forgotten, and half of the rest where they are too many (speed only).  A hash finds a known
    pre-token, its letters decide: one that shares its hash with another is worked out each time.
    """

    def __init__(self, encode_words: Callable[[list[str]], list[list[int]]], encode_whole: Callable[[str], list[int]],
                 odd: Callable[[str], bool] = odd_text, cut: Callable[[list[str]], Split] = split,
                 max_known: int = 500_000):
        self.encode_words, self.encode_whole, self.odd, self.cut = encode_words, encode_whole, odd, cut
        self.max_known = max_known
        self.known: dict[int, int] = {}         # hash -> number
        self.keys = _Column(np.zeros(0, U64))   # by number: hash, letters, ids, and the calls that had the pre-token
        self.letters, self.letter_ends = _Column(np.zeros(0, np.uint32)), _Column(np.zeros(1, np.int64))
        self.flat, self.offsets = _Column(np.zeros(0, np.int32)), _Column(np.zeros(1, np.int64))
        self.calls = _Column(np.zeros(0, np.int32))

    def _forget(self) -> None:
        calls = self.calls.values
        kept = np.flatnonzero(calls > 1)
        if len(kept) > self.max_known // 2:
            kept = np.sort(kept[np.argpartition(calls[kept], len(kept) // 2)[len(kept) // 2:]])
        for data, ends in ((self.letters, self.letter_ends), (self.flat, self.offsets)):
            bounds = ends.values
            sizes = bounds[kept + 1] - bounds[kept]
            data.__init__(data.values[spans_index(bounds[kept], sizes)])
            ends.__init__(np.append(0, np.cumsum(sizes)))
        self.keys = _Column(self.keys.values[kept])
        self.calls = _Column(np.ones(len(kept), np.int32))
        self.known = {}
        for n, key in enumerate(self.keys.values.tolist()):
            self.known.setdefault(key, n)

    def _learn(self, parts: Split, which: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """New numbers of the pieces ``which`` with their ids."""
        first = self.keys.size
        ids = self.encode_words(parts.strings(which))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.flat.extend(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())))
        self.offsets.extend(self.offsets.values[-1] + np.cumsum(sizes))
        self.letters.extend(parts.points[spans_index(parts.starts[which], parts.lengths[which])])
        self.letter_ends.extend(self.letter_ends.values[-1] + np.cumsum(parts.lengths[which]))
        self.keys.extend(keys)
        self.calls.extend(np.zeros(len(ids), np.int32))
        return np.arange(first, first + len(ids))

    def _entries(self, parts: Split, example: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Number of each distinct piece among the known ones; new ones are learnt."""
        if len(self.known) > self.max_known:
            self._forget()
        found = np.fromiter(map(lambda k: self.known.get(k, -1), keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = self._learn(parts, example[new], keys[new])
            for key, number in zip(keys[new].tolist(), found[new].tolist(), strict=True):
                self.known.setdefault(key, number)
        # letter by letter against what the hash has found
        lengths, bounds = parts.lengths[example], self.letter_ends.values
        same = bounds[found + 1] - bounds[found] == lengths
        at = np.flatnonzero(same)
        own = parts.points[spans_index(parts.starts[example[at]], lengths[at])]
        equal = own == self.letters.values[spans_index(bounds[found[at]], lengths[at])]
        if len(at):
            same[at] = np.logical_and.reduceat(equal, np.cumsum(lengths[at]) - lengths[at])
        wrong = np.flatnonzero(~same)
        if len(wrong):
            found[wrong] = self._learn(parts, example[wrong], keys[wrong])
        self.calls.values[found] += 1
        return found

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = self.cut(texts)
        if not len(parts.starts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        example, inverse, keys = parts.distinct()
        entry = self._entries(parts, example, keys)[inverse]
        bounds = self.offsets.values
        sizes = bounds[entry + 1] - bounds[entry]
        ids = self.flat.values[spans_index(bounds[entry], sizes)]
        total = np.append(0, np.cumsum(sizes))
        bounds = np.append(0, np.cumsum(parts.per_doc))
        return ids, np.diff(total[bounds])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        whole = {k: np.array(self.encode_whole(t), np.int32) for k, t in enumerate(texts) if self.odd(t)}
        ids, sizes = self._plain([t for k, t in enumerate(texts) if k not in whole] if whole else texts)
        if not whole:
            return ids, sizes
        rest = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        parts = [whole[k] if k in whole else next(rest) for k in range(len(texts))]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def byte_characters() -> dict[int, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 signs
    stand for themselves, the other bytes count on from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}


def _kind(config: dict) -> str | None:
    """Which of the two known rules a file of the ``tokenizers`` library follows; None for any other."""
    pre, norm = config.get("pre_tokenizer") or {}, config.get("normalizer")
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"):
        return "bytes"
    steps = [(x.get("type"), x) for x in pre.get("pretokenizers") or []]
    if [t for t, _ in steps] == ["Split", "ByteLevel"] and [x["type"] for x in (norm or {}).get("normalizers", [])] == [
            "NFC", "Replace", "Lowercase"]:
        cut, level = steps[0][1], steps[1][1]
        if (cut["pattern"] == {"Regex": WORD_PATTERN} and cut["behavior"] == "Removed" and cut["invert"]
                and not level.get("use_regex", True) and not level.get("add_prefix_space")
                and norm["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}):
            return "words"
    return None


def library_encoder(path: str) -> PieceEncoder:
    """Ids as the ``tokenizers`` library gives them for the file ``path``, without added special tokens.

    A special token's string inside a text is that token, as in the library; such texts, and all texts of a
    file with other rules than the two known ones, go to the library whole.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    model, table = library.model, byte_characters()
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    kind, special = _kind(config), [t["content"] for t in config.get("added_tokens") or []]
    odd = {"bytes": odd_text, "words": odd_words, None: lambda t: True}[kind]

    def encode_words(words: list[str]) -> list[list[int]]:
        return [[t.id for t in model.tokenize(w.encode().decode("latin-1").translate(table))] for w in words]

    return PieceEncoder(encode_words, lambda t: library.encode(t, add_special_tokens=False).ids,
                        lambda t: any(s in t for s in special) or odd(t), split_words if kind == "words" else split)


_encoders: dict[str, PieceEncoder] = {}


def worker_encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = library_encoder(path)
    return _encoders[path]
