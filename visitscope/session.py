"""SparkSession settings the engine relies on.

On a cluster the session is created by `spark-submit` and only the SQL
settings below are applied at runtime; nothing here fixes the master,
memory or the checkpoint folder of a running cluster.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the results depend on (UTC times) or that the plans are
# designed around (AQE coalescing / skew splitting / runtime broadcast).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join side is broadcast only when its *measured* runtime size is
    # below this bound; beyond it AQE keeps the sort-merge join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Ids of a selected set filter the scan of the other join side before its shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}

# Settings that must stand when the session starts.
START_CONF = {
    # PySpark otherwise asks the JVM for a setting and walks the Python stack at every
    # column function, so that errors can name the line: a good part of the time that it
    # takes to build a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "visitscope", warehouse_dir: str | None = None) -> SparkSession:
    """A local session for tests, the bench and the smoke entry."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    for key, value in (RUNTIME_CONF | START_CONF).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster.

    `spark.checkpoint.dir` is read from the session; `fallback` is used
    only when the setting is absent (local tests), never to override it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    target = configured or fallback
    if not target:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, for tables that a job writes and reads: `spark.checkpoint.dir`.

    A local session without one gets a private folder; there driver and
    executors are one process.
    """
    try:
        return checkpoint_dir(spark).rstrip("/")
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        return checkpoint_dir(spark, tempfile.mkdtemp(prefix="visitscope-")).rstrip("/")
