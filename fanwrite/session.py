"""Session helpers: a configured local session for tests/bench and the shared
scratch root taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings this engine relies on.  AQE re-plans shuffles at run time: it
# coalesces small partitions and splits skewed ones, which matters for the
# REBALANCE before partitioned table writes (one tenant may hold a third of
# all rows).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fanwrite") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings above on an existing session."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and every executor can reach
    it.  Only when it is unset on a local master (tests, a laptop) do we
    create a local one and register it as the checkpoint dir; a cluster
    session without it is refused, since a machine-local folder would not be
    visible to other executors and would not survive losing this machine.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor can reach "
                "(e.g. on the cluster's shared file system) for scratch and checkpoint data"
            )
        root = tempfile.mkdtemp(prefix="fanwrite-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/fanwrite/{purpose}-{uuid.uuid4().hex[:12]}"


def target_parallelism(spark: SparkSession) -> int:
    """Tasks to spread a small input over: the cluster's cores, capped by
    ``spark.sql.shuffle.partitions`` (the degree the operator sizes to the
    data), so a small micro-batch on a big cluster does not become thousands
    of near-empty tasks."""
    cores = spark.sparkContext.defaultParallelism
    try:
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        shuffle = cores
    return max(1, min(cores, shuffle))
