"""The operators applied to the driver tables, with production parameters."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm import (bestfit, bpe, exact, jaccard, langid, packing, periodic, repair, shallot, sharding, simhash,
                           suffix, token_counts)
from attrition.llm.common import unsigned_crc32

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}
RANKS = "byte_bpe_50k.tiktoken"
MODEL = "byte_bpe_50k.json"
WORD_MODEL = "word_bpe_49k.json"
END = 50257     # beyond the vocabulary, so no text holds it


def register(fn):
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register
def op1_bpe(spark, sf_dir):
    """Every document encoded and decoded again; digests of both."""
    ranks = public_tokenizers.path(RANKS)
    tokens = bpe.encode(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return bpe.decode(tokens, ranks).select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op6_packing(spark, sf_dir):
    """Every document in windows of 1024 tokens."""
    return packing.pack(_documents(spark, sf_dir), public_tokenizers.path(MODEL), keep_ids=False).drop("ids")


@register
def op10_repair(spark, sf_dir):
    """Every document written to Re-Pair shards in id order, and read back."""
    path = repair.write_shards(_documents(spark, sf_dir), repair.fresh_path(spark), public_tokenizers.path(MODEL))
    return repair.read_shards(spark, path, keep_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@register
def op4_token_counts(spark, sf_dir):
    """Flat token files of all documents, scanned for the end id; counts by document."""
    path = public_tokenizers.path(MODEL)
    blocks, manifest = token_counts.write_flat(_documents(spark, sf_dir), path, end_id=END)
    return token_counts.count_tokens(blocks, END, token_counts.id_bytes(path, END)).join(manifest, ["file", "doc"]).select(
        "doc_id", "file", "doc", "start", "n_tokens")


@register
def op8_exact_dedup(spark, sf_dir):
    """Groups of equal texts over all documents."""
    docs = _documents(spark, sf_dir).withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return exact.duplicates(docs, carry=("text_sha256",)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


_ORACLE["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

N_SHARDS = 40


@register
def op2_sharding(spark, sf_dir):
    """All documents in 40 shards of equal row counts."""
    rows = sharding.shard(_documents(spark, sf_dir), N_SHARDS, seed=20)
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       unsigned_crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def _next_likeness(ids: list, texts: list[str], following: list[str]) -> list:
    edited = [t[:len(t) - len(t) // 2] + f[:len(t) // 2] for t, f in zip(texts, following, strict=True)]
    own, other, after = (simhash.fingerprint_texts(x) for x in (texts, edited, following))
    return [ids, [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edited],
            simhash.hexadecimal(own), simhash.hexadecimal(other), simhash.likeness(own, other),
            simhash.likeness(own, after)]


@register
def op7_simhash(spark, sf_dir):
    """Fingerprints of every document and of its text with the second half taken from the next one."""
    return simhash.map_with_next(_documents(spark, sf_dir), _next_likeness, [
        ("doc_id", pa.int64(), "bigint"), ("n_chars", pa.int64(), "bigint"), ("edited_sha256", pa.string(), "string"),
        ("fingerprint", pa.string(), "string"), ("edited_fingerprint", pa.string(), "string"),
        ("near_edited", pa.float64(), "double"), ("near_next", pa.float64(), "double")])


@register
def op9_language_id(spark, sf_dir):
    """Language of every page from its text, its markup's declaration, its address suffix and its host."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    model = langid.train(_documents(spark, sf_dir))
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    body = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    return langid.identify(
        pages, model, "page_id", text=body, declared=F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1),
        suffix=F.regexp_extract(host, r"([^.]+)$", 1), host=host, domain=F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).drop("row_key")


@register
def op3_jaccard_join(spark, sf_dir):
    """Components of documents whose sets of three-word shingles have a Jaccard similarity of 0.9 or more."""
    return jaccard.join(_documents(spark, sf_dir), width=3, num=9, den=10).select(
        "doc_id", "n_shingles", "component_id")


REPEAT = 400


@register
def op5_suffix_dedup(spark, sf_dir):
    """Every document without the strings of 400 bytes that occur twice, with the text that is left."""
    docs = _documents(spark, sf_dir)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    # digests and texts of each different text; its table lies by key, so only the documents' ids move
    texts = suffix.repeated_spans(docs, REPEAT).select(
        "key", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), suffix.text_key(text).alias("key"),
                       F.when(F.octet_length(text) < REPEAT, F.encode(text, "UTF-8")).alias("short"))
    kept = F.coalesce("kept", "short")
    return rows.join(texts, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"),
        F.octet_length(kept).cast("long").alias("n_kept"), F.expr("make_valid_utf8(cast(coalesce(kept, short) AS string))").alias("text"))


@register
def op11_best_fit(spark, sf_dir):
    """Every document in sequences of at most 2048 tokens, only longer ones cut."""
    return bestfit.pack(_documents(spark, sf_dir), public_tokenizers.path(WORD_MODEL), keep_ids=False).drop("ids")


N_CENTROIDS, ROUNDS, DIMENSIONS, SALT = 40, 5, 64, "2:"


@register
def op12_shallot(spark, sf_dir):
    """All vectors of 64 finite components in 40 clusters after five rounds."""
    rows, table = shallot.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), N_CENTROIDS, ROUNDS, DIMENSIONS,
                                  salt=SALT)
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    # one row per centroid: 40 at most
    clusters = table.select("cluster", F.col("inertia").cast("long").alias("cluster_inertia"),
                            F.sum("inertia").over(W.partitionBy()).cast("long").alias("inertia"),
                            digest.alias("centroid_sha256"))
    return rows.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _shallot_sql() -> str:
    """The same rounds with every distance worked out."""
    def assigned(centroids: str) -> str:
        return f"""SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(
  d := list_sum(list_transform(list_zip(v, p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, c := cluster)) AS best
FROM kept, {centroids} GROUP BY r"""

    steps = [f"""WITH kept AS MATERIALIZED (
SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS} AND len(embedding) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS cluster, v AS p FROM (
SELECT v, sha256('{SALT}' || vec_id) AS h FROM kept ORDER BY h LIMIT {N_CENTROIDS}))"""]
    for k in range(ROUNDS):
        steps.append(f"""a{k} AS MATERIALIZED ({assigned(f"c{k}")}),
s{k} AS (SELECT best.c AS cluster, unnest(v)::HUGEINT AS x, generate_subscripts(v, 1) AS i FROM a{k}),
t{k} AS (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM s{k} GROUP BY cluster, i),
m{k} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS p FROM t{k} GROUP BY cluster),
c{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{k}.p, c{k}.p) AS p FROM c{k} LEFT JOIN m{k} USING (cluster))""")
    return ",\n".join(steps) + f""",
last AS ({assigned(f"c{ROUNDS}")})
SELECT vec_id, best.c AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia,
       sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(p, ',')) AS centroid_sha256
FROM last JOIN c{ROUNDS} ON cluster = best.c"""


_ORACLE["op12_shallot"] = _shallot_sql()


def _refrain(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by the checksum of the id, repeat a stretch from some word on."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return words[:first] + [words[first + i % period] for i in range(n - first)]


@register
def op13_periodic_runs(spark, sf_dir):
    """Runs of at least four periods and six words in every document, and the text with each run's first period only."""
    found = periodic.periodic_runs(_documents(spark, sf_dir), rewrite=_refrain).withColumn("top", periodic.longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"),
        F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
