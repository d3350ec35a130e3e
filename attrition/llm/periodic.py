"""Runs of repeated word sequences, found by longest-common-extension queries over a difference cover.

A run is a stretch of consecutive words with smallest period q that holds at least ``least_copies`` periods
and ``least_words`` words and cannot be extended.  Words are runs of bytes other than ASCII white space, compared as they are.

Harmonic grid.  A run of period p spans more than ``(least_copies - 1) * p`` places at which a word equals the one
p later, so one of them is a multiple of ``(least_copies - 1) * p``.  For every p up to
n / least_copies only these places are asked: n log n questions in all.  At each, the common extensions of the
words from i and from i + p, to the right and to the left, give the maximal stretch.

Extensions.  The places congruent to a difference cover modulo ``MODULUS`` are samples: for any two places
a shift below ``MODULUS`` brings both onto samples.  A question compares these few words; most end there.  Only
documents with a question that reaches the samples have them sorted (by their first words, then
only groups that are still equal by the rank of what follows, twice as far each time), and a
sparse table of the common prefixes of neighbours answers by a range minimum.  Questions to the left
do the same on the reversed words.

Documents are taken by chunks of whole documents in step, one document being one row; a stretch with
a multiple of its smallest period is the same stretch, so the smallest period found counts.

Null and empty texts have no words and no runs; null or repeated ids are documents of their own; an empty
table gives no rows; columns besides id and text do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import id_and_text, spans_index, text_chunks, trimmed

CHUNK_CHARS = 1 << 19
QUESTIONS = 1 << 20         # asked at once
#: A perfect difference set modulo 31 (every difference occurs, and non-zero ones once).
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _shift_table() -> np.ndarray:
    """Least shift that brings places i and j (modulo ``MODULUS``) both onto the cover."""
    place = np.arange(MODULUS)
    on = np.isin(place, COVER)
    both = on[(place[:, None, None] + place) % MODULUS] & on[(place[None, :, None] + place) % MODULUS]
    return both.argmax(axis=2)


SHIFT = _shift_table()


class Extensions:
    """Longest common extensions to the right between places of one document among several.

    ``words``: numbers from 1, document after document; ``stop``: for every place the end of its document.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words = words
        ends = np.cumsum(sizes)
        self.first = ends - sizes
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.stop = np.repeat(ends, sizes)
        self.place = np.arange(len(words)) - np.repeat(self.first, sizes)
        self.slot = np.full(len(words), -1)     # place in the sorted order, where sorted

    def _word(self, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Word at each place, 0 from the document's end on."""
        return np.where(at < stop, self.words[np.minimum(at, len(self.words) - 1)], 0)

    def _sort(self, docs: np.ndarray) -> None:
        """Sorted samples of ``docs`` with their common prefixes, and the sparse table over these."""
        wanted = np.zeros(len(self.first), bool)
        wanted[docs] = True
        cover = np.zeros(MODULUS, bool)
        cover[list(COVER)] = True
        at = np.flatnonzero(wanted[self.doc] & cover[self.place % MODULUS])
        n, stop = len(at), self.stop[at]
        number = np.full(len(self.words), -1)
        number[at] = np.arange(n)
        # first by document and as many words as a key holds, then word by word up to MODULUS words
        width = int(self.words.max(initial=0)) + 1
        order = np.arange(n)
        rank = np.zeros(n, np.int64)        # first slot of the group of samples with equal beginnings
        levels: list[tuple[int, np.ndarray]] = []
        slots, groups, known = np.arange(n), self.doc[at], 0

        def regroup(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
            """Ranks of the samples in ``slots`` after sorting by ``keys``; the slots that are still shared."""
            new = np.append(True, keys[1:] != keys[:-1])
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(keys)))
            rank[order[slots]] = np.repeat(slots[begin], size)
            return slots[np.repeat(size > 1, size)]

        room = int(np.iinfo(np.int64).max)
        while known < MODULUS and len(slots):
            members = order[slots]
            keys = groups[members] if not known else rank[members]
            top = int(keys.max()) + 1
            while known < MODULUS and top <= room // width:
                keys = keys * width + self._word(at[members] + known, stop[members])
                top, known = top * width, known + 1
            resort = np.argsort(keys, kind="stable")
            order[slots] = members[resort]
            slots = regroup(slots, keys[resort])
        known = MODULUS
        levels.append((known, rank.copy()))
        while len(slots):
            members = order[slots]
            after = at[members] + known
            inside = after < stop[members]
            follow = np.where(inside, rank[number[np.where(inside, after, 0)]] + 1, 0)
            keys = rank[members] * (n + 1) + follow
            resort = np.argsort(keys, kind="stable")
            order[slots] = members[resort]
            slots = regroup(slots, keys[resort])
            known *= 2
            levels.append((known, rank.copy()))
        # common prefix of neighbours in the order: whole levels while ranks agree, then word by word
        a, b = at[order[:-1]], at[order[1:]]
        prefix = np.zeros(max(n - 1, 0), np.int64)
        same_doc = self.doc[a] == self.doc[b]
        for size, ranks in reversed(levels):
            x, y = a + prefix, b + prefix
            inside = same_doc & (x < self.stop[a]) & (y < self.stop[b])
            equal = np.zeros(len(a), bool)
            equal[inside] = ranks[number[x[inside]]] == ranks[number[y[inside]]]
            prefix[equal] += size
        live = np.flatnonzero(same_doc)
        for _ in range(MODULUS):
            x, y = a[live] + prefix[live], b[live] + prefix[live]
            word = self._word(x, self.stop[a[live]])
            live = live[(word > 0) & (word == self._word(y, self.stop[b[live]]))]
            prefix[live] += 1
        self.slot[at[order]] = np.arange(n)
        self.table = [prefix]
        while 2 ** len(self.table) <= len(prefix):
            half, below = 2 ** (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(below[:-half], below[half:]))

    def _between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common prefix of the samples at x and y: the least one of the neighbours between them."""
        low, high = np.minimum(self.slot[x], self.slot[y]), np.maximum(self.slot[x], self.slot[y])
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(x), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            row = self.table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - 2 ** k])
        return out

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of the words from i and from j (i < j in one document; j may be its end)."""
        out = np.zeros(len(i), np.int64)
        live = np.flatnonzero(j < self.stop[i])
        need = SHIFT[self.place[i[live]] % MODULUS, self.place[j[live]] % MODULUS]
        waiting: list[np.ndarray] = []
        for k in range(MODULUS):
            ready = need == k
            waiting.append(live[ready])
            live, need = live[~ready], need[~ready]
            inside = j[live] + k < self.stop[i[live]]
            equal = inside & (self.words[i[live] + k] == self.words[np.where(inside, j[live] + k, 0)])
            live, need = live[equal], need[equal]
            out[live] = k + 1
            if not len(live):
                break
        reached = np.concatenate(waiting)
        reached = reached[j[reached] + out[reached] < self.stop[i[reached]]]
        if len(reached):
            x, y = i[reached] + out[reached], j[reached] + out[reached]
            docs = np.unique(self.doc[x])
            if (self.slot[x] < 0).any():
                self._sort(docs if not hasattr(self, "sorted") else np.union1d(docs, self.sorted))
                self.sorted = np.unique(self.doc[self.slot >= 0])
            out[reached] += self._between(x, y)
        return out


def _grid(sizes: np.ndarray, first: np.ndarray, copies: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) of all questions, some at a time."""
    docs, periods = [], []
    counts = sizes // copies
    doc = np.repeat(np.arange(len(sizes)), counts)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
    points = (sizes[doc] - period - 1) // ((copies - 1) * period) + 1
    cuts = np.searchsorted(np.cumsum(points), np.arange(QUESTIONS, int(points.sum()) + QUESTIONS, QUESTIONS))
    for lo, hi in zip([0, *(cuts + 1).tolist()], [*(cuts + 1).tolist(), len(doc)], strict=True):
        d, p, m = doc[lo:hi], period[lo:hi], points[lo:hi]
        if len(d):
            step = spans_index(np.zeros(len(d), np.int64), m)
            p = np.repeat(p, m)
            yield np.repeat(first[d], m) + step * p * (copies - 1), p


def find_runs(words: np.ndarray, sizes: np.ndarray, least_copies: int = 4, least_words: int = 6) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, ascending.  ``words``: numbers from 1 on, document after document."""
    n = len(words)
    ahead, back = Extensions(words, sizes), Extensions(words[::-1], sizes[::-1])
    found = [np.zeros((0, 4), np.int64)]
    for at, period in _grid(sizes, ahead.first, least_copies):
        right = ahead.right(at, at + period)
        hit = np.flatnonzero(right)
        at, period, right = at[hit], period[hit], right[hit]
        # to the left, from the words before i and i + p: places n - i and n - i - p of the reversed words
        left = np.zeros(len(at), np.int64)
        inner = np.flatnonzero(ahead.place[at] > 0)
        left[inner] = back.right(n - at[inner] - period[inner], n - at[inner])
        length = left + right + period
        hit = np.flatnonzero((length >= least_copies * period) & (length >= least_words))
        doc = ahead.doc[at[hit]]
        found.append(np.stack([doc, at[hit] - left[hit] - ahead.first[doc], length[hit], period[hit]], 1))
    rows = np.unique(np.concatenate(found), axis=0)     # by document, start, length, period: the smallest period first
    new = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)) if len(rows) else np.zeros(0, bool)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stay when each run (start, length, period) keeps its first period only."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist(), strict=True) if k]


def _documents(least_copies: int, least_words: int, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, CHUNK_CHARS):
            docs = [t.encode().split() for t in texts]     # at the six ASCII white-space signs
            if rewrite:
                docs = [rewrite(i, words) for i, words in zip(ids, docs, strict=True)]
            numbers: dict[bytes, int] = {}
            sizes = np.array([len(words) for words in docs], np.int64)
            flat = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for words in docs for w in words), np.int64,
                               int(sizes.sum()))
            runs: list[list[tuple[int, int, int]]] = [[] for _ in docs]
            for doc, start, length, period in find_runs(flat, sizes, least_copies, least_words).tolist():
                runs[doc].append((start, length, period))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes),
                 pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs], pa.list_(RUN)),
                 pa.array([b" ".join(collapse(words, x)).decode() for words, x in zip(docs, runs, strict=True)])],
                names=["_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_copies: int = 4,
                  least_words: int = 6, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``df``: ``id_col``, n_words, runs (by start, then period), collapsed (the words that stay,
    joined by one space).  ``rewrite(id, words)`` may change a document's words before.
    """
    rows = id_and_text(df, id_col, text_col)
    return rows.mapInArrow(trimmed(_documents(least_copies, least_words, rewrite)),
                           f"_id bigint, n_words bigint, runs {RUNS}, collapsed string").withColumnRenamed("_id", id_col)


def longest(runs: Column) -> Column:
    """The run with the greatest length, then the smallest start, then the smallest period; null without runs."""
    key = F.transform(runs, lambda r: F.struct((-r["length"]).alias("rank"), r["start"].alias("start"),
                                               r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(key)
