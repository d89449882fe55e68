"""Cutting lineage where a frame feeds several consumers."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, taken from the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a
    session whose tasks run in the driver's own process gets a folder beside
    its warehouse without that setting; with executors elsewhere a
    machine-local folder would be lost with them, so a missing setting is an
    error there.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoint"
    context.setCheckpointDir(configured)
    return configured


#: Paths of the copies that are there.
copies: list[str] = []


@contextmanager
def temporary_copies(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the copies that ``materialise`` made inside."""
    before = len(copies)
    try:
        yield
    finally:
        for path in copies[before:]:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        del copies[before:]


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, as a Parquet table in the checkpoint folder.

    The copy survives the loss of executors. Its readers neither repeat the
    work nor read columns they do not need, and the planner sees its true
    size: a small dimension is broadcast from the start, a large one is not.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    copies.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
