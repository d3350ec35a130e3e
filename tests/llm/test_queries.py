"""Every registered operator query on a small folder of tables, against plain Python.

The tables hold nulls, empty and very long texts, repeated rows, ties, clashing extra columns, special tokens' strings,
letters newer than Python's Unicode tables, and words made to collide in polynomial hashes.
"""

import base64
import hashlib
import random
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from attrition.llm import pieces, queries, sharding, token_counts
from attrition.llm.simhash import BITS

QUERIES = queries.queries()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, slot int, key string, _id string"


def thue_morse(n: int, letters: str = "ab") -> str:
    return "".join(letters[i.bit_count() & 1] for i in range(n))


def _texts() -> list[str | None]:
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)] + ["Don't", "l'été", "x²", "１２", "naïve", "ΟΔΟΣ", "it's", "  two", "a\n\nb", "tab\t"]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 90))) for _ in range(30)]
    passage = " ".join(rng.choices(words, k=150))
    near = rng.choices(words, k=300)
    colliding = [f"{thue_morse(n)} {thue_morse(n, 'ba')} end{n}" for n in (512, 1024, 2048, 4096)]
    odd = ["one<|endoftext|>two <|endoftext|>", "<|startoftext|>", "letters \U00014184's and \U00014184", "É decomposed é", "İΣ ς",
           "\x00 nul \x1c sep", "a" * 3000]
    long = " ".join(rng.choices(words, k=180_000))        # more than a million characters
    return [*base, base[3], base[3], None, None, "", "  ", "a", "a b", "a b", long, long + " tail", f"one {passage} two",
            f"three {passage}", " ".join(near), " ".join([*near[:150], "changed", *near[151:]]), *colliding, *odd, "r s " * 40]


TEXTS = _texts()
ALL = {k * 3 + 1: t for k, t in enumerate(TEXTS)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(k, t, "en", "s", 1, 5, 6, "k", "x") for k, t in ALL.items()]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(path / "documents.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def run(spark, folder):
    done: dict[str, list] = {}

    def rows(name: str) -> list:
        if name not in done:
            done[name] = QUERIES[name](spark, folder).collect()
        return done[name]
    return rows


def _library(name: str) -> dict[int, list[int]]:
    model = Tokenizer.from_file(public_tokenizers.path(name))
    return {k: model.encode(t or "", add_special_tokens=False).ids for k, t in ALL.items()}


def _crc(ids: list[int]) -> int:
    return zlib.crc32(array("I", ids).tobytes())


def _sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_op1(run):
    with open(public_tokenizers.path(queries.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for k, t in ALL.items():
        ids = encoding.encode_ordinary(t or "")
        want[k] = (len(ids), _sha(" ".join(map(str, ids))), _sha(t or ""))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run("op1_bpe")} == want


def test_op2(run):
    rows = run("op2_sharding")
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in ALL.items())
    slots: dict[int, list[int]] = {}
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(40)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def _words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def test_op3(run):
    sets = {}
    for k, t in ALL.items():
        w = _words(t)
        sets[k] = {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
    root = {k: k for k in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run("op3_jaccard_join")} == {k: (len(sets[k]), root[k]) for k in sets}


def test_op4(run):
    assert {r.doc_id: r.n_tokens for r in run("op4_token_counts")} == {k: len(v) + 1 for k, v in _library(queries.MODEL).items()}


def test_op5(run):
    length, seen = queries.REPEAT, {}
    raw = {k: (t or "").encode() for k, t in ALL.items()}
    for b in raw.values():
        for i in range(len(b) - length + 1):
            h = hash(b[i:i + length])
            seen[h] = seen.get(h, 0) + 1
    rows = {r.doc_id: r for r in run("op5_suffix_dedup")}
    for k, b in raw.items():
        starts = np.array([seen[hash(b[i:i + length])] > 1 for i in range(len(b) - length + 1)], bool)
        cover = np.zeros(len(b) + 1, np.int64)
        at = np.flatnonzero(starts)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        edges = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        r = rows[k]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_kept) == (len(b), int(gone.sum()), edges, _sha(left), len(left)), k
        assert r.text == left.decode(errors="replace") or not gone.any() or "�" in r.text


def _windows(rows: list, limit: int) -> None:
    held: dict[int, list] = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert ends[-1] <= limit and [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()]


@pytest.mark.parametrize(("name", "model", "limit"), [("op6_packing", queries.MODEL, 1024), ("op11_best_fit", queries.WORD_MODEL, 2048)])
def test_packing(run, name, model, limit):
    rows, want = run(name), {}
    for k, ids in _library(model).items():
        ids = [*ids, 0]
        for start in range(0, len(ids), limit):
            part = ids[start:start + limit]
            want[k, start] = (len(part), _crc(part))
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    _windows(rows, limit)


def _fingerprint(words_of: list[str]) -> int:
    from attrition.llm.words import word_hashes

    counts: dict[int, int] = {}
    for w in words_of:
        h = int(word_hashes([w])[0][0])
        counts[h] = counts.get(h, 0) + 1
    votes = [0.0] * BITS
    for h, n in counts.items():
        for b in range(BITS):
            votes[b] += (1 + np.log(n)) * (1 if h >> b & 1 else -1)
    # a vote near 0 may fall either way in single precision
    return sum(1 << b for b, v in enumerate(votes) if v > 0), {b for b, v in enumerate(votes) if abs(v) < 1e-2}


def test_op7(run):
    order = sorted(ALL, reverse=True)
    rows = {r.doc_id: r for r in run("op7_simhash")}
    for k, after in zip(order, [*order[1:], order[0]], strict=True):
        text, follow = ALL[k] or "", ALL[after] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + follow[:half]
        r = rows[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), _sha(edited)), k
        own, other, next_one = int(r.fingerprint, 16), int(r.edited_fingerprint, 16), int(rows[after].fingerprint, 16)
        assert r.near_edited == 1 - (own ^ other).bit_count() / BITS and r.near_next == 1 - (own ^ next_one).bit_count() / BITS
        if len(text) < 5000:
            for shown, of in ((own, text), (other, edited)):
                plain, close = _fingerprint(_words(of))
                assert not [b for b in range(BITS) if (plain ^ shown) >> b & 1 and b not in close], k


def test_op8(run):
    groups: dict[str, list[int]] = {}
    for k, t in ALL.items():
        groups.setdefault(t or "", []).append(k)
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in run("op8_exact_dedup")} == {
        k: (max(g), len(g), k == max(g), _sha(t)) for t, g in groups.items() for k in g}


def test_op10(run):
    at, want = 0, {}
    ids = _library(queries.MODEL)
    for k in sorted(ids):
        want[k] = (at, len(ids[k]) + 1, _crc([*ids[k], 2]))
        at += len(ids[k]) + 1
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in run("op10_repair")} == want


def test_op13(run):
    from tests.llm.test_periodic import _runs

    want = {}
    for k, t in ALL.items():
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", t or "") if w]
        n, h = len(words), zlib.crc32(str(k).encode())
        if n > 5000:
            continue            # brute force is too slow there
        if h % 10 == 0 and n:
            a, old = h // 10 % n, list(words)
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [old[i] if i < a else old[a + (i - a) % p] for i in range(n)]
        runs = _runs(words)
        gone = {i for s, length, p in runs for i in range(s + p, s + length)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        want[k] = (len(runs), *top, 1000 * top[1] // top[2] if runs else None, _sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)),
                   _sha(" ".join(w for i, w in enumerate(words) if i not in gone)))
    assert {r.doc_id: tuple(r)[1:] for r in run("op13_periodic_runs") if r.doc_id in want} == want


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ("op9_language_id", "op12_shallot")))
def test_empty_documents(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


def test_pieces_that_share_a_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(pieces, "mix", lambda x: np.zeros_like(x))
    path = public_tokenizers.path(queries.MODEL)
    encoder, library = pieces.library_encoder(path), Tokenizer.from_file(path)
    for texts in (["one two", "one three"], ["two one four", "", "five"], ["one"]):
        ids, sizes = encoder.encode(texts)
        want = [library.encode(t).ids for t in texts]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))


def test_known_pieces_are_forgotten_and_learnt_again():
    path = public_tokenizers.path(queries.WORD_MODEL)
    encoder, library = pieces.library_encoder(path), Tokenizer.from_file(path)
    encoder.max_known = 40
    rng = random.Random(3)
    for _ in range(60):
        texts = [" ".join(f"word{rng.randint(0, 90)}" for _ in range(12)) for _ in range(3)]
        ids, sizes = encoder.encode(texts)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))


def test_scatter_in_two_levels(spark):
    rows = [(k % 50, f"text {k}" * (k % 30)) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sharding.shard(df, 7, seed=3, bucket_bytes=2000, most_reducers=5)
    found = got.collect()
    assert sorted((r.doc_id, r.text) for r in found) == sorted(rows) and got.columns == ["doc_id", "text", "shard", "slot"]
    for s in range(7):
        slots = sorted(r.slot for r in found if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) in (85, 86)


def test_wide_ids(spark):
    blocks = spark.createDataFrame([(0, 0, np.array([70_000, 9, 4464], "<u4").tobytes())], "file int, block bigint, tokens binary")
    got = [(r.start, r.n_tokens, r.ended) for r in token_counts.count_tokens(blocks, 70_000, 4).collect()]
    assert sorted(got) == [(0, 1, True), (1, 2, False)]
    with pytest.raises(ValueError, match="does not fit"):
        token_counts.count_tokens(blocks, 70_000, 2)
