"""Best-fit decreasing: the plan against placing one piece at a time, and whole tables."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from attrition.llm import bestfit

MODEL = public_tokenizers.path("word_bpe_49k.json")


def _rooms(items: list[int], capacity: int) -> list[int]:
    rooms: list[int] = []
    for x in sorted(items, reverse=True):
        fit = [r for r in rooms if r >= x]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else capacity) - x)
    return sorted(rooms)


def test_plan_equals_one_piece_at_a_time():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.randint(5, 60)
        items = [rng.randint(1, rng.choice([capacity, max(1, capacity // 4)])) for _ in range(rng.randint(0, 120))]
        bins: dict[int, list] = {}
        ranks: Counter = Counter()
        for s in bestfit.plan_bins(Counter(items), capacity):
            assert s.rank == ranks[s.length]
            ranks[s.length] += s.bins * s.copies
            for b in range(s.bins):
                bins.setdefault(s.first_bin + b, []).extend((s.offset + c * s.length, s.length) for c in range(s.copies))
        assert ranks == Counter(items) and sorted(bins) == list(range(len(bins)))
        rooms = []
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            rooms.append(capacity - at)
        assert sorted(rooms) == _rooms(items, capacity)


def test_room_tree_finds_the_tightest():
    rng = random.Random(2)
    tree, bins = bestfit.RoomTree(37), Counter()
    for _ in range(2000):
        room = rng.randint(0, 37)
        change = 1 if rng.random() < 0.6 or not bins[room] else -1
        tree.add(room, change)
        bins[room] += change
        need = rng.randint(0, 37)
        assert tree.tightest(need) == min((r for r, n in bins.items() if n and r >= need), default=None)


def test_a_large_histogram_is_planned_by_classes():
    histogram = {length: 10**9 + length for length in range(1, 2049)}
    steps = bestfit.plan_bins(histogram, 2048)
    assert len(steps) < 20_000
    assert all(sum(s.bins * s.copies for s in steps if s.length == k) == histogram[k] for k in (1, 700, 2048))
    with pytest.raises(ValueError, match="within"):
        bestfit.plan_bins({0: 1}, 5)


def _texts() -> list[str | None]:
    rng = random.Random(3)
    words = [f"word{i}" for i in range(300)] + ["Don't", "L'ÉTÉ", "naïve", "x²", "ΟΔΟΣ", "İstanbul", "é", "漢字", "it's so"]
    texts: list[str | None] = [" ".join(rng.choices(words, k=rng.randint(1, 150))) for _ in range(60)]
    return [*texts, texts[0], texts[0], None, "", "  \n", "a", " ".join(rng.choices(words, k=30_000)), "one<|endoftext|> two",
            "letters \U00014184's newer"]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_every_id_lies_in_one_piece(spark, capacity):
    texts = _texts()
    rows = [(k, t, 1, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, piece int, sequence_id string").repartition(3)
    library = Tokenizer.from_file(MODEL)
    ids = {k: library.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
    found: dict[int, dict] = {k: {} for k in ids}
    windows: dict[int, list] = {}
    for r in bestfit.pack(docs, MODEL, capacity).collect():
        piece = np.frombuffer(r.ids, "<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.start == r.piece * capacity
        found[r.doc_id][r.piece] = piece.tolist()
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {k: [i for p in sorted(v) for i in v[p]] for k, v in found.items()} == ids
    assert all(len(p) == capacity for v in found.values() for n, p in v.items() if n < max(v))
    lengths = [len(p) for v in found.values() for p in v.values()]
    assert len(windows) == len(_rooms(lengths, capacity)) and sorted(windows) == list(range(len(windows)))
    for parts in windows.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert ends[-1] <= capacity and [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()]


def test_null_ids_repeated_ids_no_end_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, ""), (1, None)], "doc_id bigint, text string")
    rows = bestfit.pack(docs, MODEL, 8).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 3), (0, 3), (1, 1), (1, 1)]
    assert [r.doc_id for r in bestfit.pack(docs, MODEL, 8, end_id=None).collect()] == [None, None]
    assert bestfit.pack(docs.limit(0), MODEL).count() == 0
