"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import files

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Loads that overwrite some partitions ask for it themselves; any other overwrite means the whole table.
    "spark.sql.sources.partitionOverwriteMode": "static",
}

_local_roots: dict[str, str] = {}
_scratch_dirs: list[str] = []


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark. On a cluster, bring your own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
    settings = {
        **SESSION_SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Every executor must reach it.

    Only a local master may fall back to a folder of its own machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_roots[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared root; never handed out twice."""
    path = f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    _scratch_dirs.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the folders that :func:`scratch_dir` has named in this process. Frames that read them end with it."""
    while _scratch_dirs:
        files.delete_folder(spark, _scratch_dirs.pop())


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst the true size on disk, so that a join
    against the result is broadcast only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    # Small on disk, and its buffers are freed with each file; those of other codecs wait outside the heap for a collection.
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
