"""Spark session helpers.

The library never builds its own execution machinery: every job is a
DataFrame / Spark SQL / Spark ML plan.  This module only gathers the
session settings the plans rely on (AQE, skew-join splitting, UTC clock)
and the shared checkpoint folder used to cut lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings every session should carry.  AQE re-plans joins from runtime
# sizes (a side that turns out small is broadcast, anything larger stays a
# sort-merge join), coalesces tiny shuffle partitions and splits skewed
# join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # drop reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "attrition",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session or build one with ``BASE_CONF``.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them unset so the cluster's own settings apply.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder that the session names.

    A session without one fails here: a machine-local folder on a cluster
    would leave each executor's checkpoint files on its own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: it must name a folder every executor can reach "
            "(a distributed file system or object store; any folder in local mode)")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used ahead of iterative work (model fitting) so a lost executor costs a
    re-read of the checkpoint, not a replay of the whole feature plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of facts.

    * scans: splits of ``target_partition_bytes`` so every core gets work
      and a task's input stays well under executor memory;
    * shuffles: enough initial partitions that the largest shuffle (the
      fact-to-order join of the raw lines) lands near the target size per
      partition; AQE then coalesces the small post-aggregation shuffles and
      splits skewed join partitions (a partition counts as skewed above
      5x the median and 4x the advisory size).
    Pass the result as ``extra_conf`` to ``get_spark`` or set it on the
    session before building the plans.
    """
    partitions = max(total_cores * 3, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }
