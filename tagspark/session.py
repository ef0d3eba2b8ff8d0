"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, scan_partitions: int | None = None) -> SparkSession:
    """A local session with the settings tests and the benchmark use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tagspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("tagspark.trainPartitions", "2")
        .config("tagspark.scanPartitions", str(scan_partitions or shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder shared by all executors in which lineage is cut.

    The cluster names it in ``spark.checkpoint.dir``. Only a local run without
    that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        named = tempfile.mkdtemp(prefix="tagspark-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut_lineage(df):
    """Write ``df`` to the shared checkpoint folder and read it from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name next to the checkpoints, seen by all executors."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
