"""Session settings and the shared scratch folder.

Only runtime SQL settings are touched on a session that somebody else built;
executor sizes, parallelism and the like stay with the cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that decide results or plan quality, safe to set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# Adaptive execution merges small shuffle partitions but never splits all of them,
# so on a cluster shuffles start with several partitions per core.
PARTITIONS_PER_CORE = 4
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not context.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        wanted = PARTITIONS_PER_CORE * context.defaultParallelism
        usual = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        spark.conf.set(INITIAL_PARTITIONS, str(max(wanted, usual)))
    return spark


def build_session(
    app_name: str = "txlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for scripts, tests and the benchmark."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    ``spark.checkpoint.dir`` wins, then a checkpoint folder set on the context.
    A machine-local folder is accepted only in local mode.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    on_context = spark.sparkContext.getCheckpointDir()
    if on_context:
        return on_context.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="txlake-")
        spark.sparkContext.setCheckpointDir(folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared root, unique for each call."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/txlake-{app}/{name}-{uuid.uuid4().hex[:12]}"
