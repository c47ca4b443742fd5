"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Defaults for a large cluster (hundreds of executors, tens of TB per job):
# start shuffles wide and let AQE coalesce to ~256 MB partitions, split skewed
# partitions, and read Parquet in 256 MB splits.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "voltframe", driver_memory: str | None = None,
                  cluster: bool = False) -> SparkSession:
    """Session with AQE on, UI off and UTC session time.

    ``cluster=True`` applies :data:`CLUSTER_CONF`; ``shuffle_partitions`` (local
    runs) overrides the shuffle width.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if cluster:
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    if driver_memory:  # only effective when this call starts the JVM (local mode)
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a session of one process may go without and gets a fresh local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="voltframe-")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back; the folder is the run's to clean."""
    path = f"{shared_folder(df.sparkSession)}/voltframe-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session has none (local tests) is ``fallback`` installed.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared fallback folder")
    if "://" not in fallback:
        os.makedirs(fallback, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
