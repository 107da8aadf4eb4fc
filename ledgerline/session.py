"""Session settings that the operators are designed around.

On a cluster the session comes from the platform (``platform_session``); ``build_session``
is for tests, the bench and local runs.  The settings that matter at scale are the AQE ones: every join in
the library is written as a plain equi-join and left to AQE, which turns a sort-merge join
into a broadcast join only after it has *measured* the build side (a proven size bound),
splits skewed shuffle partitions, and coalesces small ones.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the library relies on.  They are Spark's defaults in 4.x except the time
# zone, repeated so that a platform default cannot silently change results.
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Broadcast only what has been measured: the planner's size estimate does not count
    # the rows a generator adds (a year expanded into months, an interval into buckets),
    # so a side estimated small can be large.  Static broadcasting is off; AQE turns a
    # sort-merge join into a broadcast join once the shuffled side's real size is known
    # to be under the threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # JSON objects may repeat a member; the last one counts and the others are no error.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def platform_session(master: str | None = None, app_name: str = "ledgerline") -> SparkSession:
    """The session of the platform (``spark-submit``, a notebook), with the settings the
    library relies on.  Master, memory and executors are the platform's; ``master`` is for
    a run without one."""
    builder = SparkSession.builder.appName(app_name).config(map=SCALE_CONF)
    return (builder.master(master) if master else builder).getOrCreate()


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "ledgerline",
    extra: dict | None = None,
) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stored intermediate tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it.  Where that is unset, a
    folder beside the warehouse tables is used, which every executor reaches as well; a
    machine-local temporary folder never is.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(base or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return sc.getCheckpointDir()


def scale_conf(input_bytes: int, executor_cores: int = 4, target_partition_mb: int = 256) -> dict:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of Parquet.

    AQE starts from ``initialPartitionNum`` shuffle partitions and coalesces them toward
    the advisory size, so the initial number only has to be large enough that no
    partition of the largest shuffle outgrows an executor's memory.  The models shuffle
    projected, map-side pre-aggregated columns, a fraction of the bytes they scan, so
    one partition per target size of *input* is an upper bound.  Scan splits follow the
    same target, and skew-join splitting starts at four times it.
    """
    target = target_partition_mb * 1024 * 1024
    initial = max(200, input_bytes // target + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{target_partition_mb * 4}m",
        "spark.executor.cores": str(executor_cores),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, **kw) -> dict:
    """Set the SQL settings of ``scale_conf`` (and ``SCALE_CONF``) on an existing session,
    e.g. the platform's session on a cluster.  Only ``spark.sql.*`` keys are runtime
    settings; the rest of ``scale_conf`` belongs in the cluster's launch configuration.
    Returns what was set."""
    wanted = {**SCALE_CONF, **scale_conf(input_bytes, **kw)}
    applied = {k: v for k, v in wanted.items() if k.startswith("spark.sql.")}
    for key, value in applied.items():
        spark.conf.set(key, value)
    return applied
