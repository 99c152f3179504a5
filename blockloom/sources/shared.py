"""Tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir. Where that is unset, below a folder of its own in local mode, which has a
    single machine; on a cluster that is an error, as executors would not see each other's files."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        at = context.getCheckpointDir()
    return f"{at}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind: they are deleted as soon as it is written, not when the driver
    next collects garbage. For writes of plans that nothing reads again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    with freeing(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
