"""Shared pieces of the operators: intermediate tables, hashing, Arrow helpers."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.sources.files import shared_dir

U64 = np.uint64
MIX_1, MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)  # fixed values: the splitmix64 finaliser


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor costs a re-read, and what was computed once
    (block numbers, partition numbers) stays the same for every later reader.
    """
    return written(df, name, **options)[0]


def written(df: DataFrame, name: str, **options) -> tuple[DataFrame, str]:
    """As :func:`stored`, with the folder, for :func:`discard`."""
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table of :func:`written` that has been read for the last time."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored_by_key(df: DataFrame, name: str, key: str, n: int) -> DataFrame:
    """As :func:`stored`, as a table in ``n`` buckets of ``key``: a join on ``key``
    then moves the other side only."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    table = f"llm_{name}_{path.rsplit('/', 1)[-1]}"
    df.write.options(compression="zstd", path=path).bucketBy(n, key).saveAsTable(table)
    return spark.table(table)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of whole texts by size, not by the 10,000 rows that suit numbers
    (settings that the session already has stay)."""
    for name, usual, value in (("maxRecordsPerBatch", 10_000, 2_000), ("maxBytesPerBatch", 64 << 20, 4 << 20)):
        key = f"spark.sql.execution.arrow.{name}"
        if int(spark.conf.get(key).rstrip("b")) == usual:
            spark.conf.set(key, str(value))


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, under names of its own (null text: empty)."""
    bound_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow; when a task ends, what it freed goes back to the system.

    Idle Python workers stay beside the executor's later stages, and the C library keeps freed memory.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc only
            if trim:
                trim(0)

    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values over the whole range."""
    x = (x ^ (x >> U64(30))) * MIX_1
    x = (x ^ (x >> U64(27))) * MIX_2
    return x ^ (x >> U64(31))


def text_chunks(batches: Iterator[pa.RecordBatch], max_chars: int) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of consecutive rows, at most ``max_chars`` characters each
    unless one text alone is longer.  Columns: id first, text second."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # few Python strings at a time
            part = batch.slice(at, 256)
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if texts and size + len(t) > max_chars:
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
    if texts:
        yield ids, texts


def in_blocks(rows: DataFrame, key: str, most: int, by: str = "_id", weight: str | None = None,
              heaviest: int = 0) -> DataFrame:
    """``rows`` of keys with two rows at least, with the pair of blocks (lo, hi) each goes to.

    A key with up to ``most`` rows is one block; one with more is dealt into blocks by a hash
    of ``by``, and every row goes to the pairs that hold its block.  With ``weight``, a block's rows
    weigh about ``heaviest`` at most (a column of weights; no more blocks than rows).
    """
    total = F.sum(weight) if weight else F.lit(0)
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_size"), total.alias("_weight")).filter("_size > 1")
    blocks = F.ceil(F.col("_size") / most).cast("int")
    if weight:
        blocks = F.greatest(blocks, F.least(F.ceil(F.col("_weight") / heaviest), "_size").cast("int"))
    return (rows.join(sizes, key).withColumn("_own", F.pmod(F.xxhash64(by), blocks).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumns({"lo": F.least("_own", "_other"), "hi": F.greatest("_own", "_other")})
            .withColumn("second", (F.col("lo") != F.col("hi")) & (F.col("_own") == F.col("hi")))
            .drop("_size", "_weight", "_own", "_other"))


def whole_groups(batches: Iterator[pa.RecordBatch], key_columns: int) -> Iterator[pa.Table]:
    """Tables of whole groups: consecutive rows that agree in the first columns stay together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(key_columns)]
        changes = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        if held:
            last = held[-1]
            same = all(last.column(k)[-1] == batch.column(k)[0] for k in range(key_columns))
            if not same:
                yield pa.Table.from_batches(held)
                held = []
            elif len(changes):
                held.append(batch.slice(0, changes[0]))
                yield pa.Table.from_batches(held)
                held, batch, changes = [], batch.slice(changes[0]), changes[1:] - changes[0]
        if len(changes):
            yield pa.Table.from_batches([batch.slice(0, changes[-1])])
            batch = batch.slice(changes[-1])
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def spans_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of every span, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def crc32_u32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").data)


def pack_planes(values: np.ndarray) -> bytes:
    """Little-endian 32-bit values as compressed byte planes."""
    planes = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_planes(blob: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(flat.reshape(4, -1).T).view("<u4").ravel()


def unsigned_crc32(text: Column) -> Column:
    return F.crc32(F.encode(text, "UTF-8")).cast("long")
