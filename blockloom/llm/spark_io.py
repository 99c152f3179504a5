"""Reading tables, tables in the shared folder, and mapping Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import freeing

#: Most bytes of a side that may be broadcast; larger sides are joined by a shuffle.
BROADCAST_BYTES = 8 << 20


#: Bytes of an Arrow batch: texts are long, so rows alone do not bound the memory of a task.
BATCH_BYTES = "4m"


def lean(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches, unless the session has its own bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # Spark's default
        spark.conf.set(key, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    lean(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset, one of its own in local mode, which has a
    single machine; on a cluster that is an error, as executors would not see each other's files."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        at = context.getCheckpointDir()
    return at


#: Where the tables of `materialize` stand, by the data frames that read them.
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors, frees shuffled files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with freeing(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of `materialize` that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(_written.pop(df))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with a function of one batch that returns one batch or yields several."""

    def run(batches):
        for b in batches:
            out = f(b)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    lean(df.sparkSession)
    return df.mapInArrow(run, schema)


def small(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most so many rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows
