"""Bookkeeping of completed block ranges: inclusive intervals (from_block, to_block).

Ordered work is done per bucket of a million blocks; what one bucket hands to the next is a table of one row per bucket,
so no task sorts all ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET = 1_000_000
PARTITION = 10_000
SECONDS_PER_BLOCK = 2

_BEFORE = (Window.unboundedPreceding, -1)


def _max_before(df: DataFrame, value: Column, name: str, inclusive: bool = False, width: int = BUCKET) -> DataFrame:
    """Add the greatest value of all rows before each (in the order of from_block, to_block), or up to and with it. Rows are
    dealt out by buckets of `width` of from_block."""
    df = df.withColumn("__v", value).withColumn("__b", F.floor(F.col("from_block") / width))
    inside = Window.partitionBy("__b").orderBy("from_block", "to_block").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    buckets = df.groupBy("__b").agg(F.max("__v").alias("__m"))
    carried = buckets.select("__b", F.max("__m").over(Window.orderBy("__b").rowsBetween(*_BEFORE)).alias("__c"))  # a row per bucket
    out = df.withColumn("__i", F.max("__v").over(inside)).join(carried, "__b", "left")
    return out.withColumn(name, F.greatest("__i", "__c")).drop("__v", "__b", "__i", "__c")


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Coalesce ranges that overlap or touch; null and reversed ranges are left out."""
    r = ranges.select(F.col("from_block").cast("long").alias("from_block"), F.col("to_block").cast("long").alias("to_block")).where("from_block <= to_block")
    r = _max_before(r, F.col("to_block"), "__to")
    start = F.when(F.col("__to").isNull() | (F.col("from_block") > F.col("__to") + 1), F.col("from_block"))
    island = _max_before(r, start, "__island", inclusive=True)
    return island.groupBy("__island").agg(F.min("from_block").alias("from_block"), F.max("to_block").alias("to_block")).drop("__island")


def add_range(ranges: DataFrame, from_block: int, to_block: int) -> DataFrame:
    one = ranges.sparkSession.createDataFrame([(from_block, to_block)], "from_block long, to_block long")
    return merge_ranges(ranges.select("from_block", "to_block").unionAll(one))


def find_gaps(ranges: DataFrame, start: int, end: int, merged: bool = False) -> DataFrame:
    """What is missing within [start, end]; `merged` ranges are not merged again."""
    m = (ranges if merged else merge_ranges(ranges)).where((F.col("to_block") >= start) & (F.col("from_block") <= end))
    m = m.select(F.greatest("from_block", F.lit(start)).alias("from_block"), F.least("to_block", F.lit(end)).alias("to_block"))
    inner = _max_before(m, F.col("to_block"), "__to").select((F.coalesce("__to", F.lit(start - 1)) + 1).alias("from_block"), (F.col("from_block") - 1).alias("to_block"))
    tail = m.agg((F.coalesce(F.max("to_block"), F.lit(start - 1)) + 1).alias("from_block"), F.lit(end).cast("long").alias("to_block"))
    return inner.unionAll(tail).where("from_block <= to_block")


def complete_10k(ranges: DataFrame) -> DataFrame:
    """Starts of partitions of 10,000 blocks that lie wholly inside one range."""
    first = F.ceil(F.col("from_block") / PARTITION) * PARTITION
    m = merge_ranges(ranges).select(first.cast("long").alias("a"), (F.col("to_block") - (PARTITION - 1)).alias("b")).where("a <= b")
    return m.select(F.explode(F.sequence("a", "b", F.lit(PARTITION).cast("long"))).alias("partition_start"))


def tables_with_rows(tables: dict[str, DataFrame], lo: int, hi: int) -> DataFrame:
    """Names of the tables that have a row with lo <= block_number <= hi."""
    return reduce(DataFrame.unionAll, (df.where(F.col("block_number").between(lo, hi)).limit(1).select(F.lit(n).alias("table_name")) for n, df in tables.items()))


def slice_ranges(ranges: DataFrame, span: int) -> DataFrame:
    """Merged ranges cut into pieces of at most `span` blocks."""
    m = merge_ranges(ranges).withColumn("x", F.explode(F.sequence("from_block", "to_block", F.lit(span).cast("long"))))
    return m.select(F.col("x").alias("from_block"), F.least(F.col("x") + (span - 1), F.col("to_block")).alias("to_block"))


def migrate_progress(progress: DataFrame, ranges: DataFrame) -> DataFrame:
    """The ranges; if there are none, [0, least last_complete_block] when that is positive."""
    if ranges.limit(1).count():
        return merge_ranges(ranges)
    return progress.agg(F.min("last_complete_block").cast("long").alias("to_block")).where("to_block > 0").select(F.lit(0).cast("long").alias("from_block"), "to_block")


def coverage(ranges: DataFrame, head: int, merged: bool = False) -> DataFrame:
    """One row: covered blocks, gap blocks and gaps up to head, blocks and seconds behind it."""
    m = (ranges if merged else merge_ranges(ranges)).agg(F.coalesce(F.sum(F.col("to_block") - F.col("from_block") + 1), F.lit(0)).alias("covered_blocks"), F.coalesce(F.max("to_block"), F.lit(-1)).alias("last")).withColumn("k", F.lit(1))
    g = find_gaps(ranges, 0, head, merged).agg(F.coalesce(F.sum(F.col("to_block") - F.col("from_block") + 1), F.lit(0)).alias("gap_blocks"), F.count("*").alias("gaps")).withColumn("k", F.lit(1))
    behind = F.greatest(F.lit(head) - F.col("last"), F.lit(0)).cast("long")
    return m.join(g, "k").select("covered_blocks", "gap_blocks", "gaps", behind.alias("blocks_behind"), (behind * SECONDS_PER_BLOCK).alias("seconds_behind"))


def event_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table that has any, most first."""
    each = reduce(DataFrame.unionAll, (df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t, df in tables.items()))
    return each.where("n > 0").orderBy(F.desc("n"), "table_name")
