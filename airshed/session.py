"""SparkSession construction and shared-folder helpers.

Every timestamp in this library is interpreted in UTC, ANSI mode stays on
(Spark 4 default), and AQE is enabled so shuffle partition counts and skewed
joins are re-planned at runtime.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a window or aggregate keyed by (series, block) must not reuse a partitioning on
    # ``series`` alone: that would put a whole series, possibly a third of the data, in one task
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(input_bytes: int, executor_cores_total: int, target_partition_bytes: int = 256 << 20,
               max_file_partition_bytes: int = 512 << 20) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes`` on ``executor_cores_total`` cores.

    * shuffle partitions: enough that each holds about ``target_partition_bytes`` of the
      input (an upper bound on what a map side writes for the mart, dedup or series
      operators), never fewer than 2 waves of tasks; AQE coalesces small ones at runtime;
    * file splits: ``maxPartitionBytes`` so a scan also runs in at least 2 waves, capped so
      a task's decoded batch stays well inside executor memory;
    * skew: a partition 4x the median and over 2 x target is split by AQE's skew join.

    At 100 TB on 1,000 executors x 8 cores this gives about 373k shuffle partitions (256 MB) and
    512 MB file splits.
    """
    waves = 2 * max(1, executor_cores_total)
    shuffle = max(waves, -(-input_bytes // target_partition_bytes))
    split = min(max_file_partition_bytes, max(32 << 20, input_bytes // waves))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }


def get_spark(master: str | None = None, app_name: str = "airshed",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def ship_by_value() -> None:
    """Pickle the library's functions by value when they run inside tasks.

    What runs on executors in Python (the recursion of the partial autocorrelation, streaming state, sums of products, the
    operators of ``airshed.llm``) are functions and classes of this package; by default they would be pickled by reference, and an executor whose Python
    cannot import the package (nothing installed, another working folder) would fail.
    """
    import airshed
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(airshed)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings the library depends on to an existing session."""
    ship_by_value()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.requireAllClusterKeysForDistribution", "true")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The folder named by ``spark.checkpoint.dir`` is used as is.  Only when the
    session has none and runs in local mode (tests) a fresh scratch folder is created and
    set; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        # executors on other machines could neither write nor read a local folder
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="airshed-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Used for written intermediate tables (lineage cuts), sink round trips and
    streaming checkpoints, so every run gets its own location and no
    machine-local folder is ever used on a cluster.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/airshed/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage: write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Used after an aggregation or a positional step whose result feeds several branches of a plan:
    without it each branch would recompute it from the raw files.  The data survives the loss of
    the executor that computed it, readers scan only the columns they need, and Spark knows the
    table's size when it plans a join.
    """
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
