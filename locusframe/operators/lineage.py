"""Tables written once between the steps of a long flow."""

from __future__ import annotations

import atexit
import contextlib
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@functools.cache
def _local_folder() -> str:
    """A folder of this process, gone when it ends."""
    path = tempfile.mkdtemp(prefix="locusframe-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder that spark.checkpoint.dir names.

    Where none is named, a temporary folder serves a local session only; on a
    cluster executors would each write to a disk of their own, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of queries that are made and run in here go as soon as these end."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written_once(df: DataFrame) -> DataFrame:
    """The same rows read back from a Parquet table in the shared folder.

    For results that several later steps read: they are computed once, the plan
    behind them ends, and a lost executor costs a re-read only.
    """
    path = scratch_path(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` only reads columns of a stored table and computes others from them row by row."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"
