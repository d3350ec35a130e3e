"""Uniform shards by a two-pass external shuffle.

Pass 1 scatters the records into buckets that fit in memory, by a seeded hash
that also takes the row's place in the scan, so that no key, however often it occurs, fills a
bucket.  Pass 2 puts each bucket in hash order, shuffles it (Spark's ``shuffle`` is
a Fisher-Yates shuffle) and writes it.  The buckets one after the other are a
random order of all rows; the shards are equal cuts of it, so their row counts differ by
one at most.

Null texts have no bytes; null and repeated ids are rows like any other; all
columns are kept (map columns cannot be ordered and are not supported).  With
fewer rows than shards some shards are empty; an empty table gives no rows.  Input columns named like the added ones
(``shard``, ``slot``) are replaced by them.

A shuffle of very many buckets at once costs tasks times buckets.  Beyond ``MOST_REDUCERS`` buckets pass 1 therefore has two
levels: rows are first dealt to groups of buckets and written, then each group is scattered and shuffled on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import stored
from attrition.sources.files import shared_dir

BUCKET_BYTES = 16 << 20
MOST_REDUCERS = 1 << 13     # buckets scattered in one shuffle
SPREAD = 64                 # files of a group in the first level
RUN = 1 << 12               # buckets whose offsets are summed in one window


def shard(df: DataFrame, n_shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
          bucket_bytes: int = BUCKET_BYTES, most_reducers: int = MOST_REDUCERS) -> DataFrame:
    """``df`` with ``shard`` (0 .. n_shards - 1) and ``slot`` (0, 1, ... in each shard)."""
    volume = df.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).alias("v")).first()["v"] or 0
    buckets = max(1, -(-volume // bucket_bytes))
    groups = -(-buckets // most_reducers)
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    df = df.select(*columns)
    place = F.xxhash64(F.lit(seed), F.col(id_col), F.monotonically_increasing_id())
    scattered = df.select(place.alias("place"), F.struct(*df.columns).alias("row")).withColumn(
        "bucket", F.pmod("place", F.lit(buckets)).cast("int"))

    def shuffled(rows: DataFrame, n: int) -> DataFrame:
        return (rows.repartition(n, "bucket").groupBy("bucket")
                .agg(F.sort_array(F.collect_list(F.struct("place", "row"))).alias("rows"))
                .select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("position", "record"))
                .select("bucket", F.col("position").cast("long").alias("position"), F.col("record.row").alias("row")))

    if groups == 1:
        written = stored(shuffled(scattered, buckets), "buckets")
    else:
        dealt, path = (shared_dir(df.sparkSession, "llm", x) for x in ("groups", "buckets"))
        grouped = scattered.withColumn("group", F.pmod("bucket", F.lit(groups)))
        grouped.repartition("group", F.pmod("place", F.lit(SPREAD))).write.option("compression", "zstd").partitionBy(
            "group").parquet(dealt)
        level = df.sparkSession.read.schema(grouped.schema).parquet(dealt)
        for g in range(groups):
            part = shuffled(level.filter(F.col("group") == g).drop("group"), -(-buckets // groups))
            part.write.mode("append").option("compression", "zstd").parquet(path)
        written = df.sparkSession.read.schema(part.schema).parquet(path)
    # one row per bucket, summed by runs of buckets, then over the runs
    sizes = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("run", F.expr(f"bucket div {RUN}"))
    inner = sizes.withColumn("inner", F.sum("n").over(W.partitionBy("run").orderBy("bucket")) - F.col("n"))
    runs = sizes.groupBy("run").agg(F.sum("n").alias("m"))
    outer = runs.select("run", (F.sum("m").over(W.orderBy("run")) - F.col("m")).alias("outer"),
                        F.sum("m").over(W.partitionBy()).alias("total"))
    # written, so that its size decides how it meets the rows
    offsets = stored(inner.join(outer, "run").select("bucket", (F.col("inner") + F.col("outer")).alias("before"), "total"), "offsets")
    at = F.col("before") + F.col("position")
    cut = F.expr(f"({n_shards} * (before + position + 1) - 1) div total")
    placed = written.join(offsets, "bucket").select("row", cut.alias("shard"), at.alias("at"), "total")
    slot = F.col("at") - F.expr(f"(shard * total) div {n_shards}")
    return placed.select(*[F.col("row")[c].alias(c) for c in df.columns], F.col("shard").cast("int").alias("shard"),
                         slot.alias("slot"))


def write(df: DataFrame, path: str) -> str:
    """One folder per shard, its rows in slot order in each file."""
    df.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
