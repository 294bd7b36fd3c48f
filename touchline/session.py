"""SparkSession construction for tests, the benchmark and local runs.

On a cluster the session comes from the platform; these settings are what we
rely on there too: AQE (runtime coalescing, skew-join splitting, runtime
broadcast conversion), UTC session time zone, UI off in batch runs.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, cpus: int | None = None, app: str = "touchline",
                  shuffle_partitions: int | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder that the session or its context names, if any:
    ``spark.checkpoint.dir``, else the checkpoint folder that the application
    has set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    try:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
    except Exception:  # no SparkContext handle (e.g. a Spark Connect session)
        return None
    return own.get() if own.isDefined() else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """:func:`checkpoint_dir`; where there is none, a private folder is made for
    a local session (tests), and any other session raises."""
    path = checkpoint_dir(spark)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="touchline-ckpt-"))
    return checkpoint_dir(spark)


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (stable for the session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect: no SparkContext handle
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def task_count(spark: SparkSession) -> int:
    """Tasks of a stage whose work its input's bytes do not show (each row read makes many):
    ``spark.sql.shuffle.partitions``, and several for each core. Given to ``repartition``,
    adaptive execution leaves the number as it is."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        return max(n, 8 * spark.sparkContext.defaultParallelism)
    except Exception:  # no SparkContext handle (e.g. a Spark Connect session)
        return n
