"""Where intermediate tables go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; where none is named, a folder in the session's
    warehouse. On a cluster that must not be a folder of the driver's own machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local_folder = warehouse.startswith(("file:", "/"))
    if local_folder and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{warehouse}/_kerbside"


# Folders of the open ``cleared`` blocks, innermost last.
_OPEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses."""
    root = _OPEN[-1] if _OPEN else scratch_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Tables written inside the block are deleted when it ends. What is to stay must have been
    written by then to a path taken before the block."""
    folder = scratch_path(spark, "block")
    _OPEN.append(folder)
    try:
        yield
    finally:
        _OPEN.remove(folder)
        removed(spark, folder)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a table that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the plan, survives the loss
    of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
