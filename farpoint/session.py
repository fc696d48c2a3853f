"""Session helpers: local sessions for tests/bench and checkpoint directory."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "farpoint") -> SparkSession:
    """A local session with the settings the tests and the bench use.

    On a cluster the caller builds the session; nothing in the library
    depends on these values except that AQE is expected to be on.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    Order: the directory already set on the context, then the
    ``spark.checkpoint.dir`` setting of the session.  Only a local-mode
    session without either gets a fresh temporary folder (tests, bench); a
    cluster session without a shared directory is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="farpoint-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "(HDFS/S3/ABFS) folder to cut lineage")


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    """An integer tuning setting ``spark.farpoint.<key>`` of the session.

    Lets a cluster operator size groups, blocks and checkpoint intervals to
    the executors (e.g. ``--conf spark.farpoint.maxGroupBytes=268435456``)
    without code changes; ``default`` otherwise.
    """
    value = spark.conf.get(f"spark.farpoint.{key}", None)
    return int(value) if value not in (None, "") else int(default)
