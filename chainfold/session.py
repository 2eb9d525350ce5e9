"""Session helpers for tests, the benchmark and the registered queries.

The library itself never changes session configuration. ``build_session``
is for our own entry points (tests, bench); ``scratch_dir`` finds the shared
folder named by ``spark.checkpoint.dir`` for tables the queries write.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "chainfold",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Local runs hold small shuffles; keep them spread over the cores
        # instead of coalescing to AQE's default 1 MB minimum partition.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CHAINFOLD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, read from the session.

    On a cluster ``spark.checkpoint.dir`` names a shared, reliable folder
    and is used as is; a cluster session without one is an error, since a
    machine-local folder would not survive a lost executor. Only a local
    session without one (tests) gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared, reliable folder "
                "(for example on the cluster's object store or HDFS)"
            )
        conf_dir = tempfile.mkdtemp(prefix="chainfold-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint folder for a written table."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/chainfold/{name}-{uuid.uuid4().hex[:12]}"
