"""SparkSession construction and shared settings."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import SparkSession

# Cut-off date used by every registered query (both the Spark plan and the DuckDB oracle take it
# as a literal, so results never depend on the wall clock).
DEFAULT_AS_OF = dt.date(1998, 7, 1)

# Settings that matter at scale; all are plain Spark SQL configs.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE: runtime re-planning, partition coalescing and skew-join splitting.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only behind Spark's own size check (plan statistics / AQE runtime sizes);
    # everything larger falls back to a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def app_id(spark: SparkSession) -> str:
    """Application id of the session (also under Spark Connect, which has no SparkContext)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def is_local(spark: SparkSession) -> bool:
    """Do driver and executors run in one process (and share its folders)?"""
    master = spark.conf.get("spark.master", None) or ""
    return master == "local" or master.startswith("local[")


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def _set_checkpoint_dir(spark: SparkSession, path: str) -> None:
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # Spark Connect: DataFrame.checkpoint uses the conf value
        pass


_OWN_CHECKPOINT_DIR: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder that ``spark.checkpoint.dir`` names. Where it is unset and the session is local (tests),
    one scratch folder per application is made and used; a cluster has to name shared storage there."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it has to name a folder that the driver "
                               "and all executors share")
        key = app_id(spark)
        if key not in _OWN_CHECKPOINT_DIR:
            _OWN_CHECKPOINT_DIR[key] = tempfile.mkdtemp(prefix="loanlake-ckpt-")
        current = _OWN_CHECKPOINT_DIR[key]
    _set_checkpoint_dir(spark, current)
    return current


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "loanlake") -> SparkSession:
    """Build (or reuse) a session with the engine settings above.

    ``master`` defaults to ``$LOANLAKE_MASTER``; otherwise it is left to spark-submit / the
    environment. Settings the deployment already made (spark-submit ``--conf``, defaults file)
    win over ``SQL_CONF``. Shuffle partitions: the explicit argument if given; else, on a local
    master, one per core (one task wave; AQE coalesces further); on a cluster, whatever was
    submitted (size it to roughly input bytes / 128 MB per stage).
    """
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("LOANLAKE_MASTER")
    if master:
        builder = builder.master(master)
    # Only effective when this call starts the JVM (local runs); on a cluster these come from
    # spark-submit.
    builder = builder.config("spark.ui.enabled", "false")
    # PySpark looks up the caller's line at each column call for its error messages, several calls to the JVM each;
    # half of the time it takes to build a plan of some hundred expressions
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled",
                             os.environ.get("LOANLAKE_DATAFRAME_DEBUGGING", "false"))
    builder = builder.config("spark.driver.memory", os.environ.get("LOANLAKE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    try:
        submitted = spark.sparkContext.getConf()
        is_set = submitted.contains
        local = spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect: no SparkContext; respect what the server has
        is_set, local = (lambda key: True), False
    for key, value in SQL_CONF.items():
        if not is_set(key):
            spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    elif local and not is_set("spark.sql.shuffle.partitions"):
        spark.conf.set("spark.sql.shuffle.partitions", str(default_parallelism(spark)))
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:
        pass
    return spark
