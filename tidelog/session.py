"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job of this package relies on. They are all changeable on a live
# session, so a session made elsewhere gets them too.
RUNTIME_CONF = {
    # A union of sides that are partitioned alike would be zipped, though adaptive execution may have
    # merged the partitions of one side only.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# On a cluster the state of streaming aggregates lives on executor disks, not on the heap.
CLUSTER_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build(app: str = "tidelog", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and measurements; on a cluster use the one given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


# Shuffles of batch queries start with this many partitions and adaptive execution merges the
# small ones. Streaming state keeps `spark.sql.shuffle.partitions`, which this leaves alone.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    wanted = dict(RUNTIME_CONF)
    if not is_local(spark):
        wanted.update(CLUSTER_CONF)
        if spark.conf.get(INITIAL_PARTITIONS, None) is None:
            cores = spark.sparkContext.defaultParallelism
            least = int(spark.conf.get("spark.sql.shuffle.partitions"))
            wanted[INITIAL_PARTITIONS] = str(max(least, 4 * cores))
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as named by `spark.checkpoint.dir`.

    Only a local session, where driver and executors share one disk, may go without it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if context.applicationId not in _local_dirs:
            _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tidelog-")
        root = _local_dirs[context.applicationId]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidelog/{label}-{uuid.uuid4().hex}"
