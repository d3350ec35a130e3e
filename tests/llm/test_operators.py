"""Operators against brute force on small fixtures with nulls, empty and long texts, ties and clashing columns."""

import base64
import hashlib
import random
import re
import zlib
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from attrition.llm import bpe, exact, jaccard, langid, packing, repair, sharding, simhash, suffix, token_counts
from attrition.llm.common import in_blocks
from attrition.llm.components import components
from attrition.sources.files import shared_dir

RANKS, MODEL = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("tiktoken", "json"))
SCHEMA = "doc_id bigint, text string, key string, rank int, __shard int"


def _texts() -> list[str | None]:
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["don't", "l'été", "x²", "１２", "　", "naïve"]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(40)]
    long = " ".join(rng.choices(words, k=6000))
    passage = " ".join(rng.choices(words, k=150))
    near = base[0].split() + rng.choices(words, k=300)
    edited = [*near[:200], "changed", *near[201:]]
    return [*base, base[3], base[3], None, "", "  ", "a", "a b", "a b", long, long + " tail",
            f"one {passage} two", f"three {passage}", " ".join(near), " ".join(edited), "zz" * 900, "tab\t\n  end \n"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "k", 1, 2) for k, t in enumerate(_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def ids():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {k: encoding.encode_ordinary(t or "") for k, t in enumerate(_texts())}


def test_bpe_round_trip(docs, empty, ids):
    rows = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, n_buckets=5, block_chars=4000), RANKS).collect()
    assert {r.doc_id: r.tokens for r in rows} == ids
    assert {r.doc_id: bytes(r.decoded).decode() for r in rows} == {k: t or "" for k, t in enumerate(_texts())}
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_packing_covers_every_id_once(docs, empty, ids):
    rows = packing.pack(docs, MODEL, window=64).collect()
    windows: dict[int, list] = {}
    found: dict[int, dict[int, list]] = {k: {} for k in ids}
    for r in rows:
        piece = np.frombuffer(r.ids, "<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
        found[r.doc_id][r.start] = piece.tolist()
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {k: [i for s in sorted(v) for i in v[s]] for k, v in found.items()} == {k: v + [0] for k, v in ids.items()}
    assert sorted(windows) == list(range(len(windows)))
    for w in windows.values():
        ends = np.cumsum([n for _, n in sorted(w)])
        assert ends[-1] <= 64 and [o for o, _ in sorted(w)] == [0, *ends[:-1].tolist()]
    assert packing.pack(empty, MODEL).count() == 0


def test_packing_moves_no_ids(docs):
    """Between the stored pieces with their ids and the result there is no shuffle."""
    plan = packing.pack(docs, MODEL, window=64)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    scan, = [k for k, line in enumerate(plan) if "FileScan" in line and "ids#" in line]
    above, least = [], depth[scan]
    for k in range(scan, -1, -1):
        if depth[k] < least:
            least = depth[k]
            above.append(plan[k])
    assert any("Join" in line for line in above) and not any("Exchange" in line for line in above)


def test_suffix_anchors_leave_the_disk(docs, spark):
    folder = Path(urlparse(shared_dir(spark, "llm", "anchors")).path).parent
    before = set(folder.glob("*"))
    rows = suffix.repeated_spans(docs, 60, gram=8)
    assert folder.is_dir() and set(folder.glob("*")) == before
    assert rows.filter("size(spans) > 0").count() > 0


def test_window_filling_is_optimal():
    rng = random.Random(1)
    for _ in range(30):
        counts = {rng.randint(1, 15): rng.randint(1, 3) for _ in range(5)}
        sums = {0}
        for k, c in counts.items():
            sums = {s + k * j for s in sums for j in range(c + 1)}
        for room in range(30):
            chosen = packing.fill_window(counts, room)
            assert sum(chosen) == max(s for s in sums if s <= room)
            assert all(chosen.count(k) <= c for k, c in counts.items())


def test_repair_files(docs, empty, ids, spark, tmp_path):
    path = repair.write_shards(docs, str(tmp_path / "shards"), MODEL, n_shards=3, segment_tokens=3000)
    at = 0
    for r in sorted(repair.read_shards(spark, path).collect(), key=lambda r: r.doc_id):
        want = [*ids[r.doc_id], 2]
        assert (r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (at, len(want), want)
        at += len(want)
    segment = max(spark.read.parquet(path).collect(), key=lambda r: sum(r.doc_tokens)).asDict()
    flat = [i for d in segment["doc_ids"] for i in [*ids[d], 2]]
    for a, b in ((0, 1), (17, 400), (len(flat) - 3, len(flat))):
        assert repair.read_range(segment, a, b).tolist() == flat[a:b]
    assert repair.read_shards(spark, repair.write_shards(empty, str(tmp_path / "none"), MODEL)).count() == 0


def test_repair_is_lossless_on_runs():
    for seq in (np.zeros(1000, int), np.arange(50), np.tile([1, 2, 1], 500), np.array([7])):
        made = repair.compress(seq)
        assert (repair.expand(made["symbols"], made["n_ids"], made["rules"], made["rounds"]) == seq).all()


def test_repair_leaves_no_pair_twice():
    """Every pair is counted and replaced, however many there are and however rare they are."""
    rng = np.random.default_rng(3)
    pairs = np.stack([np.arange(3000), 3000 + rng.permutation(3000)], 1)     # more than a round once took
    many = np.concatenate([pairs[rng.permutation(3000)].ravel() for _ in range(8)])
    cases = [many, np.tile([5, 6, 7], 2), np.repeat([4, 9, 4], [7, 1, 5]), *(rng.integers(0, k, 400) for k in (2, 9, 60))]
    for seq in cases:
        made = repair.compress(seq)
        assert (repair.expand(made["symbols"], made["n_ids"], made["rules"], made["rounds"]) == seq).all()
        places: dict[tuple[int, int], list[int]] = {}
        for k, pair in enumerate(zip(made["symbols"].tolist(), made["symbols"][1:].tolist())):
            found = places.setdefault(pair, [])
            if not found or k > found[-1] + 1:
                found.append(k)
        assert max(map(len, places.values()), default=0) < 2
        sides = np.concatenate([made["rules"].ravel(), made["symbols"]])
        assert (np.bincount(sides, minlength=made["n_ids"])[made["n_ids"]:] > 0).all()
    assert len(repair.compress(many)["rules"]) >= 3000


def test_token_counts_across_blocks(docs, empty, ids):
    blocks, manifest = token_counts.write_flat(docs, MODEL, block_tokens=50)
    rows = token_counts.count_tokens(blocks).join(manifest, ["file", "doc"]).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {k: len(v) + 1 for k, v in ids.items()}
    blocks, _ = token_counts.write_flat(empty, MODEL)
    assert token_counts.count_tokens(blocks).count() == 0


def test_token_counts_of_an_unended_file(spark):
    tokens = np.array([5, 9, 5, 5, 5, 9, 5], "<u2")
    blocks = spark.createDataFrame([(0, k, tokens[2 * k:2 * k + 2].tobytes()) for k in range(4)],
                                   "file int, block bigint, tokens binary")
    got = sorted((r.doc, r.start, r.n_tokens, r.ended) for r in token_counts.count_tokens(blocks, end_id=9).collect())
    assert got == [(0, 0, 2, True), (1, 2, 4, True), (2, 6, 1, False)]


def test_exact_dedup(docs, empty, spark):
    groups: dict[str, list[int]] = {}
    for k, t in enumerate(_texts()):
        groups.setdefault(t or "", []).append(k)
    want = {k: (max(g), len(g), k == max(g)) for g in groups.values() for k in g}
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.duplicates(docs).collect()} == want
    kept = exact.deduplicate(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, v in want.items() if v[2]}
    assert exact.duplicates(empty).count() == 0 and exact.deduplicate(empty).count() == 0
    twice = spark.createDataFrame([(None, "a"), (None, "a"), (4, "b"), (4, "b")], "doc_id bigint, text string")
    assert sorted(r.text for r in exact.deduplicate(twice).collect()) == ["a", "b"]


def test_shards_are_equal_and_whole(docs, empty):
    rows = sharding.shard(docs, 7, seed=3, bucket_bytes=2000).collect()
    assert sorted((r.doc_id, r.text) for r in rows if r.text is not None) == [
        (k, t) for k, t in enumerate(_texts()) if t is not None]
    slots: dict[int, list[int]] = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shard(empty, 7).count() == 0


def _shingles(text: str | None, width: int) -> frozenset:
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


@pytest.mark.parametrize(("width", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_jaccard_components(docs, width, num, den):
    sets = [_shingles(t, width) for t in _texts()]
    parent = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                x, y = parent[i], parent[j]
                parent = [min(x, y) if p in (x, y) else p for p in parent]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs, width, num, den).collect()}
    assert got == {k: (len(s), parent[k]) for k, s in enumerate(sets)}


def test_jaccard_edges(empty, spark):
    assert jaccard.join(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A b  c d e f")],
                                "doc_id bigint, text string")
    got = sorted((r.doc_id is None, r.component_id) for r in jaccard.join(odd).collect() if r.n_shingles == 2)
    assert [c for null, c in got if not null] == [1, 1, 1] and [c for null, c in got if null] == [None]


def test_jaccard_rows_that_repeat_an_id_or_have_none(spark):
    rng = random.Random(9)
    one, two, three = (" ".join(f"w{rng.randrange(9999)}" for _ in range(60)) for _ in range(3))
    rows = [(5, one), (5, two), (3, one + " end"), (7, two + " end"), (None, three), (None, three + " end"), (9, "alone on its own here now")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    joined = jaccard.join(df, 5, 4, 5)
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in joined.collect()) == [(0, 0), (0, 0), (3, 3), (5, 3), (5, 5), (7, 5), (9, 9)]
    left = [(r.doc_id, r.text) for r in jaccard.keep_one(df, joined).collect()]
    first = min((three, three + " end"), key=lambda t: hashlib.sha256(t.encode()).digest())
    assert sorted(left, key=str) == sorted([(3, one + " end"), (5, two), (9, rows[-1][1]), (None, first)], key=str)


def test_blocks_are_bounded_by_weight(spark):
    rows = spark.createDataFrame([(k, 1, 100) for k in range(64)] + [(70, 2, 5000), (71, 2, 5000), (72, 3, 1), (73, 3, 1)],
                                 "_id bigint, c bigint, size bigint")
    pairs: dict[tuple, dict[int, bool]] = {}
    for r in in_blocks(rows, "c", 1024, weight="size", heaviest=400).collect():
        pairs.setdefault((r.c, r.lo, r.hi), {})[r._id] = r.second
    assert max(len(v) for k, v in pairs.items() if k[0] == 1) <= 32    # 16 blocks of 4, dealt by hash
    assert [v for k, v in pairs.items() if k[0] == 3] == [{72: False, 73: False}]
    met = [(a, b) for (_, lo, hi), v in pairs.items() for a in v for b in v if a < b and (lo == hi or v[a] != v[b])]
    assert sorted(met) == [(a, b) for a in range(64) for b in range(a + 1, 64)] + [(70, 71), (72, 73)]


def test_pivot_regions_find_every_component():
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 40, (12, 90), dtype=np.uint64)
    sets = []
    for k in range(240):
        own = centres[k % 12].copy()
        own[rng.choice(90, rng.integers(0, 9), replace=False)] += np.uint64(1 + k)
        sets.append(np.unique(own))
    sizes = np.array([len(s) for s in sets])
    found = jaccard._Sets(np.concatenate(sets), sizes, 9, 10)
    found.join(np.arange(len(sets)), None)
    root = np.arange(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 10 * both >= 9 * (sizes[i] + sizes[j] - both):
                root[root == root[i]] = root[j]
    assert len(set(found.root.tolist())) == len(set(root.tolist()))


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 9), (1, 9), (7, 8), (8, 8)], "a bigint, b bigint")
    assert {r.id: r.component for r in components(edges).collect()} == {5: 1, 4: 1, 9: 1, 1: 1, 7: 7, 8: 7}


def _cut(texts: list[str | None], length: int) -> dict[int, tuple[int, int, str]]:
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = {}
    for k, b in enumerate(raw):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        left = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out[k] = (int(gone.sum()), int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if b else 0,
                  hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("most", [1024, 2])
def test_suffix_dedup(docs, empty, monkeypatch, most):
    monkeypatch.setattr(suffix, "ANCHOR_CONTEXTS", most)    # 2: many contexts of an anchor go through the binary search
    length = 200
    found = {bytes(r.key): r for r in suffix.repeated_spans(docs, length).collect()}
    keys = {r.doc_id: bytes(r.k) for r in docs.selectExpr(
        "doc_id", "substring(unhex(sha2(coalesce(text, ''), 256)), 1, 16) AS k").collect()}
    for k, (removed, spans, digest) in _cut(_texts(), length).items():
        r = found.get(keys[k])
        if r is None:
            assert not removed
            continue
        assert (sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) == (
            removed, spans, digest), k
    assert suffix.repeated_spans(empty, length).count() == 0
    assert suffix.remove_repeats(docs, length).columns == docs.columns


def test_cut_keeps_replacement_characters_of_the_text(spark):
    passage = "".join(random.Random(10).choices("abcdefghij ", k=260))
    rows = [(1, f"a\ufffdb é{passage}\ufffd end"), (2, f"other è{passage}X"), (3, "un\ufffdchanged")]
    got = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 200).collect()
    # é and è share no last byte: only the passage goes
    assert {r.doc_id: r.text for r in got} == {1: "a\ufffdb é\ufffd end", 2: "other èX", 3: "un\ufffdchanged"}
    # the last byte of ĩ and é is the same and is cut with the passage: their first bytes go too
    rows = [(1, f"\ufffd é{passage}"), (2, f"x ĩ{passage}\ufffd")]
    got = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 200).collect()
    assert {r.doc_id: r.text for r in got} == {1: "\ufffd ", 2: "x \ufffd"}


def test_suffix_array_order_and_prefixes():
    rng = random.Random(3)
    strings = ["".join(rng.choices("ab", k=rng.randint(0, 60))).encode() for _ in range(20)]
    array, text = suffix.SuffixArray(strings, 12), b"".join(strings)
    parts = [text[p:array.end[p]] for p in array.order.tolist()]
    assert parts == sorted(parts)
    shared = [0] + [next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
                    for a, b in zip(parts, parts[1:], strict=False)]
    assert array.common_prefixes().tolist() == [min(x, 12) for x in shared]
    starts = np.array([i for i in range(len(text) - 12)])
    windows = {text[p:p + 12] for p in range(len(text)) if p + 12 <= array.end[p]}
    assert array.contains(np.frombuffer(text, np.uint8), starts).tolist() == [text[i:i + 12] in windows for i in starts]


def test_simhash_pairs(spark, docs, empty):
    prints = {r.doc_id: r.fingerprint for r in simhash.fingerprints(docs).collect()}
    texts = _texts()
    assert len({prints[k] for k, t in enumerate(texts) if t == texts[3]}) == 1 and prints[texts.index(None)] == 0
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(20)]
    values += [v ^ sum(1 << b for b in rng.sample(range(64), n)) for v in values for n in (0, 1, 3, 4)]
    rows = [(k, v - (1 << 64) if v >> 63 else v) for k, v in enumerate(values)]
    classes, pairs = simhash.near_pairs(spark.createDataFrame(rows, "doc_id bigint, fingerprint bigint"), 3)
    first = {}
    for k, v in enumerate(values):
        first.setdefault(v, k)
    assert {r.doc_id: r.class_id for r in classes.collect()} == {k: first[v] for k, v in enumerate(values)}
    want = {(min(a, b), max(a, b)) for x, a in first.items() for y, b in first.items() if a != b and (x ^ y).bit_count() <= 3}
    got = [(r.class_a, r.class_b) for r in pairs.collect()]
    assert set(got) == want and len(got) == len(want)
    assert simhash.fingerprints(empty).count() == 0


def test_next_row_wraps_round(docs):
    import pyarrow as pa

    got = simhash.map_with_next(docs, lambda i, t, f: [i, [a + "|" + b for a, b in zip(t, f, strict=True)]],
                                [("doc_id", pa.int64(), "bigint"), ("both", pa.string(), "string")]).collect()
    texts = [t or "" for t in _texts()]
    assert {r.doc_id: r.both for r in got} == {k: f"{t}|{texts[k - 1]}" for k, t in enumerate(texts)}


def test_language_fusion(spark, empty):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    vocabulary = {"en": ["the", "and", "thing", "with", "where"], "de": ["und", "nicht", "schön", "zwischen", "über"]}
    rows = [(k, " ".join(rng.choices(vocabulary[x], k=40)), x, f"host{k % 3}") for k, x in enumerate(["en", "de"] * 40)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    held = spark.createDataFrame([(1, "nicht zwischen und", "en", "host0"), (2, "where the thing", None, None),
                                  (3, "12345 !!", "en", "host0"), (4, None, "en", "host0"),
                                  (None, "xqzj kvvw qqxz zzkq", None, "new")], labelled.schema)
    found = langid.identify(held, langid.train(labelled), "doc_id", text=F.col("text"), declared=F.col("lang"),
                            suffix=F.lit(None), host=F.col("source"), domain=F.lit(None))
    assert {r.doc_id: r.lang for r in found.collect()} == {1: "de", 2: "en", 3: "und", 4: "und", None: "und"}
    none = langid.train(empty.withColumn("lang", F.lit(None).cast("string")))
    assert none == {}


@pytest.mark.parametrize("at_once", [64, 7])
def test_language_of_many_labels(spark, monkeypatch, at_once):
    from pyspark.sql import functions as F

    monkeypatch.setattr(langid, "PASS", at_once)
    rng = random.Random(8)
    vocabulary = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(6)] for _ in range(70)]
    labels = ["en-US", "EN", *(f"l{k:02d}" for k in range(68))]
    rows = [(j * 70 + k, " ".join(rng.choices(vocabulary[k], k=30)), x, f"host{k % 9}", f"dom{k % 4}")
            for j in range(3) for k, x in enumerate(labels)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, domain string").repartition(3)
    model = langid.train(labelled)
    cells = {x: np.zeros(langid.CELLS) for x in sorted(labels)}
    for _, text, x, _, _ in rows:
        np.add.at(cells[x], langid.trigram_cells([text])[0], 1)
    names = [*cells, "und"]
    table = np.stack([np.log((v + langid.SMOOTHING) / (v.sum() + langid.SMOOTHING * langid.CELLS)) for v in cells.values()])
    assert list(model) == names[:-1]
    held = [*rows[:100], (900, None, "EN", "host0", None), (901, "qqq zz", "nowhere", "new", None)]
    # the same evidence in plain Python
    texts, used = [], []
    for _, text, *_ in held:
        cell = langid.trigram_cells([text or ""])[0]
        score = [*table.astype(np.float32)[:, cell].astype(float).sum(axis=1), -np.log(langid.CELLS) * len(cell)]
        texts.append(np.array(score) * min(1.0, langid.EVIDENCE / max(len(cell), 1)))
        used.append(len(cell))
    own = [int(np.argmax(s)) if n else 70 for s, n in zip(texts, used, strict=True)]
    fields = {"declared": [(r[2] or "").lower() for r in held], "suffix": [""] * len(held),
              "host": [(r[3] or "").lower() for r in held], "domain": [(r[4] or "").lower() for r in held]}
    sure = [i for i, k in enumerate(own) if k < 70]

    def seen(key, value):
        return np.bincount([own[i] for i in sure if fields[key][i] == value], minlength=70)

    total = np.bincount([own[i] for i in sure], minlength=70)
    want = {}
    for i, row in enumerate(held):
        upper = (seen("domain", fields["domain"][i]) + 20 * (total + 1) / (len(sure) + 70))
        upper = upper / (seen("domain", fields["domain"][i]).sum() + 20)
        on_host = seen("host", fields["host"][i])
        evidence = np.log((on_host + 20 * upper) / (on_host.sum() + 20))
        evidence -= evidence.max()
        for key in ("declared", "suffix"):
            values = {fields[key][j] for j in sure}
            if fields[key][i] in values:
                x = np.log((seen(key, fields[key][i]) + 1) / (total + len(values) + 1))
                evidence = evidence + x - x.max()
        score = texts[i] + [*evidence, 0]
        best = int(np.argmax(score)) if used[i] else 70
        want[row[0]] = (names[best], 1 / np.exp(score - score.max()).sum() if used[i] else 1.0, used[i], names[own[i]])
    found = langid.identify(spark.createDataFrame(held, labelled.schema).repartition(2), model, "doc_id", text=F.col("text"),
                            declared=F.col("lang"), suffix=F.lit(None), host=F.col("source"), domain=F.col("domain")).collect()
    assert {r.doc_id: (r.lang, r.n_trigrams, r.text_lang) for r in found} == {k: (v[0], *v[2:]) for k, v in want.items()}
    assert {r.doc_id: r.posterior for r in found} == pytest.approx({k: v[1] for k, v in want.items()}, rel=1e-4)
