"""Runs of repeated words against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.llm import periodic, queries


def _runs(words: list, copies: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period: every period tried at every word."""
    n, found = len(words), {}
    for period in range(1, n // copies + 1):
        i = 0
        while i + period < n:
            if words[i] != words[i + period]:
                i += 1
                continue
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            if length >= max(least, copies * period):
                found.setdefault((start, length), period)
    return sorted((s, length, p) for (s, length), p in found.items())


def test_every_difference_has_a_shift():
    on = set(periodic.COVER)
    for i in range(periodic.MODULUS):
        for j in range(periodic.MODULUS):
            shift = int(periodic.SHIFT[i, j])
            assert (i + shift) % periodic.MODULUS in on and (j + shift) % periodic.MODULUS in on
    assert len({(a - b) % periodic.MODULUS for a in on for b in on}) == periodic.MODULUS


def _document(rng: random.Random, longest: int) -> list[int]:
    kind, letters = rng.random(), rng.choice([1, 2, 3, 30])
    words = [rng.randint(1, letters) for _ in range(rng.randint(0, longest))]
    if kind < 0.7 and words:
        first = rng.randrange(len(words))
        period = rng.randint(1, max(1, len(words) // 4))
        for i in range(first, len(words)):
            words[i] = words[first + (i - first) % period] if kind < 0.5 or rng.random() < 0.98 else rng.randint(1, letters)
    return words


@pytest.mark.parametrize(("seed", "copies", "least", "at_once"), [(1, 4, 6, 1 << 20), (2, 4, 6, 50), (3, 2, 3, 1 << 20), (4, 3, 9, 7)])
def test_runs_equal_brute_force(seed, copies, least, at_once, monkeypatch):
    monkeypatch.setattr(periodic, "QUESTIONS", at_once)
    rng = random.Random(seed)
    for _ in range(40):
        docs = [_document(rng, 260) for _ in range(rng.randint(0, 6))]
        flat = np.array([w for d in docs for w in d], np.int64)
        found = periodic.find_runs(flat, np.array([len(d) for d in docs], np.int64), copies, least).tolist()
        want = [[k, *r] for k, d in enumerate(docs) for r in _runs(d, copies, least)]
        if copies > 2:      # with two copies a stretch may have two periods of which neither divides the other
            assert found == want
        else:
            assert all(r in found for r in want)


def test_extensions_equal_plain_comparison():
    rng = random.Random(7)
    docs = [_document(rng, 400) for _ in range(8)]
    sizes = np.array([len(d) for d in docs])
    first = np.cumsum(sizes) - sizes
    ext = periodic.Extensions(np.array([w for d in docs for w in d], np.int64), sizes)
    pairs = [(k, *sorted(rng.sample(range(len(d)), 2))) for k, d in enumerate(docs) if len(d) > 1 for _ in range(200)]
    got = ext.right(np.array([first[k] + i for k, i, _ in pairs]), np.array([first[k] + j for k, _, j in pairs]))
    for (k, i, j), length in zip(pairs, got.tolist(), strict=True):
        d = docs[k]
        assert length == next((x for x in range(len(d) - j) if d[i + x] != d[j + x]), len(d) - j)


def test_a_very_long_document():
    rng = random.Random(8)
    words = [rng.randint(1, 9999) for _ in range(120_000)]
    words[500:100_500] = [words[500 + i % 23_001] for i in range(100_000)]
    words[110_000:111_000] = [5] * 1000
    found = [tuple(r[1:]) for r in periodic.find_runs(np.array(words), np.array([len(words)])).tolist()]
    assert (500, 100_000, 23_001) in found and (110_000, 1000, 1) in found


TEXTS = ["a b " * 10, "x " * 5, "x " * 6, None, "", " \t\n", "A a A a A a A a A", "é è " * 7 + "tail", "one two three"]


def test_table(spark):
    rng = random.Random(9)
    texts = [*TEXTS, *[" ".join(f"w{w}" for w in _document(rng, 200)) for _ in range(40)]]
    rows = [(k if k % 9 else None, t, 5, "r") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, runs string").repartition(3)
    got = periodic.periodic_runs(docs).withColumn("top", periodic.longest(F.col("runs"))).collect()
    want = []
    for (doc, text, *_) in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]
        runs = _runs(words)
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        want.append((doc, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone), top))
    assert sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed,
                    (r.top.start, r.top.length, r.top.period) if r.top else None) for r in got], key=repr) == sorted(want, key=repr)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_refrain_repeats_from_its_first_word():
    words = [str(k).encode() for k in range(40)]
    changed = [d for d in range(200) if queries._refrain(d, words) != words]
    assert 5 < len(changed) < 40 and queries._refrain(None, words) == words and queries._refrain(changed[0], []) == []
