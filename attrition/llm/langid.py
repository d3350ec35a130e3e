"""Language identification by Bayesian evidence fusion.

Evidence on a text, combined as log-likelihoods:

* text: letter trigrams (non-letters count as one gap) under one smoothed
  trigram table per language, trained by grouped counts over labelled texts;
  neighbouring trigrams are not independent, so the sum counts as that of at most
  ``EVIDENCE`` independent ones;
* declared language and address suffix: likelihoods of what is declared
  given the language the text alone points to, by grouped counts;
* host: a prior smoothed towards its domain's, which is smoothed towards all texts'.

A further class ``und`` draws trigrams uniformly and has no other evidence; what fits it
best (random letters, no letters at all) has no known language.

Null texts are empty (``und``); null declarations, suffixes and hosts are values of
their own; ties go to the language first in alphabetical order; repeated rows
are separate; without labelled texts every language list is empty and all is ``und``.

Every distinct label is a language, however many there are: counts stay a written table, and the
texts are scored in passes of ``PASS`` languages, so that neither the driver nor a worker
holds more than the tables of one pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import bound_batches, stored, text_chunks, trimmed
from attrition.llm.pieces import LETTER, char_classes

CELLS = 1 << 16         # hashed trigrams: a table of fixed size per language
PASS = 64               # languages scored at once: CELLS numbers for each are held
SMOOTHING = 0.5
EVIDENCE = 50.0
HOST_STRENGTH = 20.0    # pseudo-counts of the domain in a host's prior, and of all texts in a domain's
UND = "und"
CHUNK_CHARS = 1 << 18


def trigram_cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(cell of every trigram, text of every trigram).  Trigrams have a letter in the middle."""
    joined = "".join("   " + t.lower() + "   " for t in texts)
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t.lower()) + 6 for t in texts], np.int64)
    letter = char_classes()[cp] == LETTER
    c = np.where(letter, cp, np.uint32(32)).astype(np.uint64)
    mid = np.flatnonzero(letter[1:-1]) + 1 if len(cp) else np.zeros(0, np.int64)
    key = (c[mid - 1] << np.uint64(42)) | (c[mid] << np.uint64(21)) | c[mid + 1]
    cell = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    doc = np.searchsorted(np.cumsum(sizes), mid, "right")
    return cell.astype(np.int64), doc


class Model(Mapping[str, np.ndarray]):
    """Log-probability table of each language, in alphabetical order, made when asked for
    from the written counts (lang, cell, n)."""

    def __init__(self, counts: DataFrame):
        self.counts = counts
        self.languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())

    def __iter__(self) -> Iterator[str]:
        return iter(self.languages)

    def __len__(self) -> int:
        return len(self.languages)

    def __getitem__(self, lang: str) -> np.ndarray:
        if lang not in self.languages:
            raise KeyError(lang)
        return self.tables([lang])[0]

    def tables(self, languages: list[str]) -> np.ndarray:
        """Tables of languages that follow each other."""
        found = self.counts.filter(F.col("lang").between(languages[0], languages[-1])).toArrow()
        at = pc.index_in(found.column("lang"), pa.array(languages, found.schema.field("lang").type)).to_numpy()
        n = np.zeros((len(languages), CELLS))
        n[at, found.column("cell").to_numpy()] = found.column("n").to_numpy()
        return np.log((n + SMOOTHING) / (n.sum(axis=1, keepdims=True) + SMOOTHING * CELLS)).astype(np.float32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}

    def held() -> Iterator[pa.RecordBatch]:
        for lang, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                names=["lang", "cell", "n"])
        totals.clear()

    for langs, texts in text_chunks(batches, CHUNK_CHARS):
        cell, doc = trigram_cells(texts)
        names, own = np.unique(np.array(langs, object), return_inverse=True)
        own = own[doc]
        order = np.argsort(own, kind="stable")
        parts = np.split(cell[order], np.searchsorted(own[order], np.arange(1, len(names))))
        for lang, mine in zip(names, parts, strict=True):
            if lang not in totals:
                if len(totals) == PASS:
                    yield from held()
                totals[lang] = np.zeros(CELLS, np.int64)
            np.add.at(totals[lang], mine, 1)
    yield from held()


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Trigram counts of each language over all labelled texts, written; see :class:`Model`."""
    bound_batches(labelled.sparkSession)
    known = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sums = known.mapInArrow(trimmed(_count), "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    return Model(stored(sums.sortWithinPartitions("lang"), "trigrams"))


def _score(table: np.ndarray, first: int, last: bool):
    """Appends the scores of one pass to those of the ``first`` languages before; the ``last`` pass adds ``und``'s
    and drops the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(table) + last
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            scores, used = np.zeros((len(texts), width)), np.zeros(len(texts), np.int64)
            at = 0
            while at < len(texts):
                size, stop = 0, at
                while stop < len(texts) and (stop == at or size + len(texts[stop]) <= CHUNK_CHARS):
                    size, stop = size + len(texts[stop]), stop + 1
                cell, doc = trigram_cells(texts[at:stop])
                n = np.bincount(doc, minlength=stop - at)
                used[at:stop] = n
                for k in range(len(table)):
                    scores[at:stop, k] = np.bincount(doc, table[k][cell], minlength=stop - at)
                if last:
                    scores[at:stop, -1] = -np.log(CELLS) * n
                at = stop
            scores *= (np.minimum(1.0, EVIDENCE / np.maximum(used, 1)))[:, None]
            if first:
                before = batch.column("_text_scores").flatten().to_numpy().reshape(len(texts), first)
                scores = np.hstack([before, scores])
            ends = np.arange(len(texts) + 1, dtype=np.int32) * np.int32(first + width)
            names = [n for n in batch.schema.names if n not in ("_n", "_text_scores") and not (last and n == "_text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(used),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(scores.ravel()))], names=[*names, "_n", "_text_scores"])
    return run


def identify(df: DataFrame, model: Mapping[str, np.ndarray], id_col: str, text: Column, declared: Column, suffix: Column,
             host: Column, domain: Column, key: Column | None = None) -> DataFrame:
    """One row per row of ``df``: ``id_col``, lang (or ``und``), posterior, n_trigrams, text_lang, and
    ``row_key`` (binary; what ``key`` gives for the row)."""
    languages = list(model)
    n_lang = len(languages)
    absent = F.lit("")
    bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text, absent).alias("_text"),
                     (F.lit(None) if key is None else key).cast("binary").alias("row_key"),
                     *(F.lower(F.coalesce(c.cast("string"), absent)).alias(n)
                       for c, n in ((declared, "declared"), (suffix, "suffix"), (host, "host"), (domain, "domain"))))
    scored = rows
    for first in range(0, max(n_lang, 1), PASS):
        some, last = languages[first:first + PASS], first + PASS >= n_lang
        table = (model.tables(some) if some and isinstance(model, Model) else
                 np.stack([model[x] for x in some]) if some else np.zeros((0, CELLS), np.float32))
        sql = ("_id bigint, " + ("" if last else "_text string, ") + "row_key binary, declared string, suffix string, "
               "host string, domain string, _n bigint, _text_scores array<double>")
        scored = stored(scored.mapInArrow(trimmed(_score(table, first, last)), sql), "scored")
    names = F.array(*[F.lit(x) for x in [*languages, UND]])
    at_best = F.array_position("_text_scores", F.array_max("_text_scores")).cast("int")
    scored = scored.withColumn("text_lang", F.when(F.col("_n") == 0, F.lit(UND)).otherwise(F.element_at(names, at_best)))
    if not languages:
        return scored.select(F.col("_id").alias(id_col), F.lit(UND).alias("lang"), F.lit(1.0).alias("posterior"),
                             F.col("_n").alias("n_trigrams"), "text_lang", "row_key")
    certain = scored.filter(F.col("text_lang") != UND).withColumn("_k", at_best - 1)
    # counts of the text's own language, by declaration, suffix, host and domain; one array entry for each language
    total = {r["_k"]: r["n"] for r in certain.groupBy("_k").agg(F.count(F.lit(1)).alias("n")).collect()}
    everything = sum(total.values())
    share = [(total.get(k, 0) + 1) / (everything + n_lang) for k in range(n_lang)]

    def numbers(values: list[float]) -> Column:
        return F.array(*[F.lit(float(x)) for x in values])

    def level(value: Column) -> Column:
        """One value for every language (a lambda would evaluate it again for each)."""
        return F.array_repeat(value, n_lang)

    def counts(key: str) -> DataFrame:
        """The key's counts of every language, and their sum."""
        seen = certain.groupBy(key, "_k").agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(
            F.map_from_entries(F.collect_list(F.struct("_k", "n"))).alias("_seen"), F.sum("n").alias(f"{key}_all"))
        return seen.select(key, f"{key}_all", F.transform(
            F.sequence(F.lit(0), F.lit(n_lang - 1)),
            lambda k: F.coalesce(F.try_element_at("_seen", k), F.lit(0).cast("long"))).alias(f"{key}_n"))

    def relative(values: Column) -> Column:
        """Logarithms against the best language's: und, which has no such evidence, is level with it."""
        logs = F.transform(values, lambda x: F.log(x))
        return F.zip_with(logs, level(F.array_max(logs)), lambda x, best: x - best)

    def likelihood(key: str) -> DataFrame:
        """P(value | language), smoothed by one for each value and one more; as :func:`relative`."""
        seen = counts(key)
        kinds = seen.count() + 1
        sizes = numbers([total.get(k, 0) + kinds for k in range(n_lang)])
        return seen.select(key, relative(F.zip_with(f"{key}_n", sizes, lambda n, size: (n + 1) / size)).alias(f"{key}_l"))

    shares = numbers([HOST_STRENGTH * x for x in share])
    domains = counts("domain").select("domain", F.zip_with(
        F.zip_with("domain_n", shares, lambda n, x: n + x), level(F.col("domain_all") + HOST_STRENGTH),
        lambda n, size: n / size).alias("upper"))
    out = (scored.join(likelihood("declared"), "declared", "left").join(likelihood("suffix"), "suffix", "left")
           .join(domains, "domain", "left").join(counts("host"), "host", "left"))
    upper = F.coalesce("upper", numbers([HOST_STRENGTH * x / HOST_STRENGTH for x in share]))
    on_host = F.coalesce("host_n", level(F.lit(0).cast("long")))
    prior = relative(F.zip_with(
        F.zip_with(on_host, upper, lambda n, x: n + HOST_STRENGTH * x),
        level(F.coalesce("host_all", F.lit(0)) + HOST_STRENGTH), lambda n, size: n / size))
    # a value never seen beside a certain text says nothing
    for key in ("declared", "suffix"):
        prior = F.zip_with(prior, F.coalesce(f"{key}_l", level(F.lit(0.0))), lambda a, b: a + b)
    fused = out.withColumn("_scores", F.concat(
        F.zip_with(F.slice("_text_scores", 1, n_lang), prior, lambda a, b: a + b), F.slice("_text_scores", n_lang + 1, 1)))
    top = F.array_max("_scores")
    return fused.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_n") == 0, F.lit(UND)).otherwise(
            F.element_at(names, F.array_position("_scores", top).cast("int"))).alias("lang"),
        F.when(F.col("_n") == 0, F.lit(1.0)).otherwise(
            1 / F.aggregate(F.zip_with("_scores", F.array_repeat(top, n_lang + 1), lambda x, best: F.exp(x - best)),
                            F.lit(0.0), lambda a, x: a + x)).alias("posterior"),
        F.col("_n").alias("n_trigrams"), "text_lang", "row_key")
