"""Session construction and shared scratch locations.

Scratch data (staged writes, stream checkpoints, file drops) always lives
under the cluster's shared ``spark.checkpoint.dir``.  A private folder is
created only when a local session (one JVM) names none, as in tests; on a
cluster a missing setting is an error, since executors would not see it.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "supplylake",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(total_cores: int = 8000) -> dict:
    """Settings this library is planned for on a large cluster (100 TB input).

    Shuffle partitions start high and AQE coalesces them toward the advisory
    size, so no stage is forced into a few huge tasks; skewed join partitions
    are split; broadcast stays on a measured threshold.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.shuffle.partitions": str(max(2 * total_cores, 200)),
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names (``spark.checkpoint.dir``,
    else the context's checkpoint folder).  Only when neither exists and the
    master is local, as in tests, a private folder is created and registered."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or _ROOTS.get(app)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        root = tempfile.mkdtemp(prefix="supplylake-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    _ROOTS[app] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/supplylake/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: what several
    branches of a plan need is computed once whatever Spark reuses, and a lost
    executor cannot lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
