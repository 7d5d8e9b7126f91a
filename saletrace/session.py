"""Session settings the operators are designed around."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that matter for the plans built here: AQE re-plans joins from
# measured shuffle sizes (broadcast when a side is proven small at runtime,
# skew-join splitting for hot accounts), the static threshold bounds what
# the optimizer may broadcast from size estimates.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "saletrace",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks.  On a cluster, pass the
    cluster's master and size ``shuffle_partitions`` to the data (AQE
    coalesces small partitions, so err high)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir`` (or one set on the context), else ``None``."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        sc.setCheckpointDir(d)
    return d


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; only where it is unset and the
    session runs in local mode (tests, local benchmarks) take ``fallback``.
    A cluster session must name a shared folder: a driver-local one is not
    visible to the executors and does not survive losing them."""
    d = checkpoint_dir(spark)
    if d:
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage "
                           "(intermediates are materialised there)")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir() or fallback
