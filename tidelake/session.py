"""Session for local runs, and written intermediates in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "tidelake", task_attempts: int = 1) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores},{task_attempts}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # Folders of a table are listed by few tasks, not by one task each.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{tempfile.gettempdir()}/checkpoints")
        .getOrCreate()
    )


_MADE: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place that ``spark.checkpoint.dir`` or the context's checkpoint folder names.

    Without either, a local session, whose one machine shares it, gets a temporary folder; a cluster is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{tempfile.gettempdir()}/checkpoints"
    _MADE.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def remove_scratch(spark: SparkSession) -> int:
    """Delete every folder that ``scratch_dir`` has named in this process, once no DataFrame reads them any more; how many there were."""
    hadoop, removed = spark.sparkContext._jvm.org.apache.hadoop.fs, 0
    while _MADE:
        path = hadoop.Path(_MADE.pop())
        removed += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Its lineage ends there, and Catalyst knows its true size: a small table that is
    grouped out of a large one is then broadcast, where its estimate would forbid it.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
