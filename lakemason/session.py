"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "lakemason", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and local benches. On a cluster, bring your own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LAKEMASON_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where every task sees the
    same disk, falls back to a fresh temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="lakemason-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name in shared storage for an intermediate table."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the checkpoint folder and continue from the written rows.

    Used where two branches must see the very same rows (range slices are sampled, so computing
    them twice could disagree) and where a loop would grow its plan without bound. The rows live
    in shared storage, so a lost executor costs a re-read, not a wrong answer; as a columnar table
    each later branch reads only the columns it needs.
    """
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
