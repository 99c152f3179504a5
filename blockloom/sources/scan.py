"""Scans of the stored layout root/contract/event/1M=<n>/10K=<n> and of landed logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..plans.catalog import RAW, TABLES, stored_schema

FULL = 100
_LONG = T.LongType()


#: File paths of the stored layout; tables written in one pass name their levels (contract=../event=..).
FILE = r"/(?:contract=)?([^/=]+)/(?:event=)?([^/=]+)/1M=(\d+)/10K=(\d+)/[^/]*$"


def table_path(root: str, contract: str, event: str) -> str:
    return f"{root}/{contract}/{event}"


def located(spark: SparkSession, root: str, contract: str, event: str) -> str | None:
    """Where a stored table is, if it was ever written."""
    return next((p for p in (table_path(root, contract, event), f"{root}/contract={contract}/event={event}") if exists(spark, p)), None)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scan_table(spark: SparkSession, root: str, contract: str, event: str) -> DataFrame:
    """A1: all partitions of one stored table with its declared schema; empty if it was never written."""
    schema = T.StructType([*stored_schema(contract, event).fields, T.StructField("1M", _LONG), T.StructField("10K", _LONG)])
    path = located(spark, root, contract, event)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)  # metadata files lie beside the data


def _each(spark: SparkSession, root: str, event: str, f=lambda df: df) -> DataFrame:
    each = [f(scan_table(spark, root, c, e)).withColumn("contract", F.lit(c)) for c, e in TABLES if e == event]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)


def scan_event(spark: SparkSession, root: str, event: str) -> DataFrame:
    """A2: a logical event over all contracts that store it, with the contract as a column; columns that a contract's table
    lacks are null."""
    return _each(spark, root, event)


#: Ranges (of a million blocks each) up to which they are broadcast, so that each table's scan prunes by them at run time.
MOST_RANGES = 100_000


def scan_complete(spark: SparkSession, root: str, event: str, ranges) -> DataFrame:
    """A3: the event in given 1M partitions: a list, pruned when the query is planned, or a DataFrame of `1M`, pruned at run
    time, table by table."""
    if not isinstance(ranges, DataFrame):
        return _each(spark, root, event).where(F.col("1M").isin(list(ranges)))
    wanted = ranges.select("1M").distinct().where("`1M` is not null and `1M` >= 0")
    few = wanted.limit(MOST_RANGES + 1).count() <= MOST_RANGES
    return _each(spark, root, event, lambda df: df.join(F.broadcast(wanted) if few else wanted, "1M", "left_semi"))


def partition_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Contract, event, partition values, files and bytes of what is stored."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root).select("path", "length")
    part = lambda i: F.regexp_extract("path", FILE, i)
    rows = files.select(part(1).alias("contract"), part(2).alias("event"), part(3).alias("m"), part(4).alias("k"), "length").where("m <> ''")
    return rows.groupBy("contract", "event", F.col("m").cast("long").alias("1M"), F.col("k").cast("long").alias("10K")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def complete_1m_ranges(inventory: DataFrame, event: str, full: int = FULL) -> DataFrame:
    """A4: 1M partitions with all their 10K partitions in every contract that has the event."""
    mine = inventory.where(F.col("event") == event)
    whole = mine.groupBy("contract", "1M").agg(F.countDistinct("10K").alias("n")).where(F.col("n") == full)
    contracts = mine.select("contract").distinct().count()  # a fixed set of contracts
    return whole.groupBy("1M").agg(F.count("*").alias("c")).where(F.col("c") == contracts).select("1M")


def common_ranges(inventory: DataFrame, *events: str, full: int = FULL) -> DataFrame:
    """A5: ranges complete in all given events."""
    return reduce(DataFrame.intersect, (complete_1m_ranges(inventory, e, full) for e in events))


def scan_complete_or_all(spark: SparkSession, root: str, event: str, ranges: list[int], inventory: DataFrame) -> DataFrame:
    """The event in the ranges, or all of it if it has none of them."""
    has = inventory.where((F.col("event") == event) & F.col("1M").isin(list(ranges))).limit(1).count()
    return scan_complete(spark, root, event, ranges) if has else scan_event(spark, root, event)


def sample_ranges(ranges: DataFrame, n: int) -> DataFrame:
    """The first and last n ranges, each once (ranges are a row per million blocks)."""
    asc, desc = (F.row_number().over(Window.orderBy(o)) for o in (F.asc("1M"), F.desc("1M")))
    return ranges.select("1M").distinct().select("1M", asc.alias("a"), desc.alias("d")).where((F.col("a") <= n) | (F.col("d") <= n)).select("1M")


def lookup_tx(spark: SparkSession, root: str, contract: str, event: str, block: int, transaction_hash: str) -> DataFrame:
    """One transaction's rows from the one partition that can hold its block."""
    df = scan_block_range(spark, root, contract, event, block, block)
    return df.where(F.col("transaction_hash") == F.unhex(F.lit(transaction_hash.removeprefix("0x")))).orderBy("log_index")


def scan_block_range(spark: SparkSession, root: str, contract: str, event: str, lo: int, hi: int) -> DataFrame:
    """Rows with lo <= block_number <= hi. The partition bounds are spelled out: they do not follow from the block's."""
    df = scan_table(spark, root, contract, event)
    bounds = F.col("1M").between(lo - lo % 1_000_000, hi - hi % 1_000_000) & F.col("10K").between(lo - lo % 10_000, hi - hi % 10_000)
    return df.where(bounds & F.col("block_number").between(lo, hi))


def read_raw_logs(spark: SparkSession, path: str) -> DataFrame:
    """A10: landed JSON, one log per line or an envelope with a `result` array per line."""
    lines = spark.read.schema(T.StructType([*RAW.fields, T.StructField("result", T.ArrayType(RAW))])).json(path)
    names = RAW.fieldNames()
    single = lines.where("result is null and topics is not null").select(*names)
    return single.unionByName(lines.where("result is not null").select(F.explode("result").alias("r")).select("r.*"))


def filter_logs(raw: DataFrame, addresses: list[str], topics: list[str], lo: int, hi: int) -> DataFrame:
    """Logs of the given addresses and first topics within an inclusive block range."""
    from ..functions.u256 import parse_hex

    return raw.where(F.lower("address").isin([a.lower() for a in addresses]) & F.lower(F.get("topics", F.lit(0))).isin([t.lower() for t in topics]) & parse_hex(F.col("blockNumber")).between(lo, hi))
