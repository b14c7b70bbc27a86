"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("zonewright")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named in ``spark.checkpoint.dir``.

    Only a local session may do without that setting; a cluster whose executors
    share no disk must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder.

    For the polygon side of a join, which is small next to the rows it meets but
    costly to build and read several times. The checkpoint is a reliable one, so
    a lost executor costs no recomputation.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Unlike a checkpoint, later readers fetch only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
