"""Sealing: typed rows to block-partitioned Parquet with a manifest and a verified read-back."""

from __future__ import annotations

import hashlib
from functools import reduce
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import u256 as U
from ..operators.ranges import complete_10k
from ..plans.catalog import COMMON, CONTRACTS, EVENTS, TABLES
from .scan import FILE, delete, exists, partition_inventory, scan_table, table_path
from .shared import freeing, materialize, shared_path

ORDER = ("block_number", "transaction_index", "log_index")


def _stored(kind: str, c: Column) -> Column:
    if kind in ("b32", "addr"):
        return U.hex_to_binary(c, 32 if kind == "b32" else 20)
    if kind == "token":
        return F.when(F.length(c) == 64, F.unhex(c)).otherwise(U.dec_to_b32(c))
    return U.to_u32(c) if kind == "u32" else c.cast("string")


def typed_projection(df: DataFrame, contract: str, event: str, further: tuple[str, ...] | list[str] = (), ids_in_hex: bool = False) -> DataFrame:
    """The stored columns in order with their types; absent ones are null. `further` columns follow as they are. Token ids are
    decimal or 64 hex digits; where all are in hex (ids_in_hex) no row has to pass through Python."""
    e, has = TABLES[contract, event], set(df.columns)
    common = [U.hex_to_binary(F.col(c), 32).alias(c) if c == "transaction_hash" else F.col(c).cast("long").alias(c) for c in COMMON]
    return df.select(*common, *(_stored("b32" if ids_in_hex and f.kind == "token" else f.kind, F.col(f.name) if f.name in has else F.lit(None).cast("string")).alias(f.name) for f in e.fields), *further)


def partitioned(df: DataFrame) -> DataFrame:
    b = F.col("block_number")
    return df.withColumn("1M", b - b % 1_000_000).withColumn("10K", b - b % 10_000)


def export_event(df: DataFrame, root: str, contract: str, event: str, replace: bool = False, dealt: bool = False) -> None:
    """B1: one sorted zstd file per 10K partition, beside what a partition holds already or (replace) instead of it. Rows that
    are `dealt` out by partition already stay where they are."""
    out = partitioned(df)
    out = (out if dealt else out.repartition("1M", "10K")).sortWithinPartitions("1M", "10K", *ORDER)
    how = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") if replace else out.write.mode("append")
    with freeing(df.sparkSession):
        how.partitionBy("1M", "10K").option("compression", "zstd").parquet(table_path(root, contract, event))


def typed_rows(decoded: DataFrame) -> DataFrame:
    """Rows of all stored tables in one typed projection over decoded logs (`decode_all` with ids in hex): contract,
    event (as stored), the common columns, and each stored column under its name, null where an event has none."""
    kinds: dict[str, dict[str, list[str]]] = {}
    for e in EVENTS.values():
        for f in e.fields:
            kinds.setdefault(f.name, {}).setdefault(f.kind, []).append(e.key)
    stored = F.element_at(F.create_map(*[F.lit(x) for e in EVENTS.values() for x in (e.key, e.name)]), F.col("event"))
    # a generator keeps the optimizer from parsing the fields anew for each column
    rows = decoded.select(F.inline(F.array(F.struct("*", F.from_json("fields", "map<string,string>").alias("v"), stored.alias("stored")))))
    rows = rows.where(F.struct("contract", "stored").isin([F.struct(F.lit(c), F.lit(e)) for c, e in TABLES]))
    common = [U.hex_to_binary(F.col(c), 32).alias(c) if c == "transaction_hash" else F.col(c).cast("long").alias(c) for c in COMMON]

    def column(name: str) -> Column:
        each = [(keys, _stored("b32" if kind == "token" else kind, F.try_element_at(F.col("v"), F.lit(name)))) for kind, keys in kinds[name].items()]
        return each[0][1] if len(each) == 1 else F.coalesce(*(F.when(F.col("event").isin(keys), c) for keys, c in each))

    return rows.select("contract", F.col("stored").alias("event"), *common, *(column(n).alias(n) for n in kinds))


PLACES = ("contract", "event", "1M", "10K")


def export_all(rows: DataFrame, root: str, dealt: bool = False) -> None:
    """Write the rows of all stored tables (`typed_rows`) in one pass, one sorted file a partition; scans read them with the
    declared schema of each table. Rows that are `dealt` out by partition already stay where they are."""
    out = partitioned(rows)
    out = (out if dealt else out.repartition(*PLACES)).sortWithinPartitions(*PLACES, *ORDER)
    with freeing(rows.sparkSession):
        out.write.mode("append").partitionBy(*PLACES).option("compression", "zstd").parquet(root)


def export_dealt(tables: dict[tuple[str, str], DataFrame], root: str, ids_in_hex: bool = False) -> None:
    """B1 for several tables in one pass: rows of (contract, event), dealt out by contract and partition before."""
    each = (typed_projection(df, *of, ids_in_hex=ids_in_hex).withColumns({"contract": F.lit(of[0]), "event": F.lit(of[1])}) for of, df in tables.items())
    export_all(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each), root, dealt=True)


def split_by_contract(df: DataFrame, event: str) -> dict[str, DataFrame]:
    """B2: the rows of each contract that stores the event, by lower-case address."""
    return {c: df.where(F.lower("address") == CONTRACTS[c]) for c, e in TABLES if e == event}


def only_unsealed(df: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (contract, event, block_number, ..) of partitions not yet written, and the late rest."""
    keyed, sealed = partitioned(df), inventory.select("contract", "event", "10K").distinct()
    key = ["contract", "event", "10K"]
    return keyed.join(sealed, key, "left_anti").select(*df.columns), keyed.join(sealed, key, "left_semi").select(*df.columns)


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The existing rows and, of the incoming, the first (in the given order) of each new (block_number, log_index)."""
    key = ["block_number", "log_index"]
    first = incoming.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")
    return existing.unionByName(first.join(existing.select(*key), key, "left_anti").select(*existing.columns))


VERSION = "v2"
_CHUNK = 1 << 20


def digest(path: str) -> str:
    """SHA-256 of a file, read in chunks where the task runs (any file system that pyarrow knows by its URI)."""
    at = urlsplit(path)
    fs, name = (pafs.LocalFileSystem(), unquote(at.path)) if at.scheme in ("", "file") else pafs.FileSystem.from_uri(path)
    sha = hashlib.sha256()
    with fs.open_input_stream(name) as f:
        while chunk := f.read(_CHUNK):
            sha.update(chunk)
    return sha.hexdigest()


def file_digests(spark: SparkSession, root: str) -> DataFrame:
    """path, length and sha256 of the stored files. Only paths are rows; each task reads its files bit by bit."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root).select("path", "length")

    def run(batches):
        for b in batches:
            shas = [digest(p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shas, pa.string())], names=["path", "length", "sha256"])

    return files.mapInArrow(run, "path string, length long, sha256 string")


def build_manifest(spark: SparkSession, root: str, ready: DataFrame | None = None) -> DataFrame:
    """A row per stored partition: version, partition (as its path says it), rows, first and last block, bytes, files and
    sha256 (of the file; of several, of their sorted digests joined by commas). Partitions of `ready` (partition_start) that a
    table has no rows of are `empty`, the others `complete`."""
    part = lambda i: F.regexp_extract("path", FILE, i)
    key = ["contract", "event", "10K"]
    by_file = file_digests(spark, root).select(part(1).alias("contract"), part(2).alias("event"), part(4).cast("long").alias("10K"), "length", "sha256")
    shas = F.sort_array(F.collect_list("sha256"))
    whole = F.when(F.size(shas) == 1, shas[0]).otherwise(F.sha2(F.concat_ws(",", shas), 256))
    sizes = by_file.groupBy(*key).agg(F.sum("length").alias("bytes"), F.count("*").alias("files"), whole.alias("sha256"))
    counted = F.count("*").alias("row_count"), F.min("block_number").alias("block_start"), F.max("block_number").alias("block_end")
    each = (scan_table(spark, root, c, e).groupBy("10K").agg(*counted).select(F.lit(c).alias("contract"), F.lit(e).alias("event"), "10K", *("row_count", "block_start", "block_end")) for c, e in TABLES)
    counts = reduce(DataFrame.unionAll, each)
    if ready is not None:
        targets = spark.createDataFrame(list(TABLES), "contract string, event string")
        none = empty_partitions(ready, targets, counts.select(*key, "row_count")).where("status = 'empty'")
        counts = counts.unionByName(none.select(*key, "row_count"), allowMissingColumns=True)
    name = F.concat(F.lit("1M="), F.col("10K") - F.col("10K") % 1_000_000, F.lit("/10K="), F.col("10K"))
    rows = counts.join(sizes, key, "left").withColumns({"version": F.lit(VERSION), "partition": name})
    return rows.withColumn("status", F.when(F.col("row_count") == 0, "empty").otherwise("complete"))


def verify_partitions(written: DataFrame, reread: DataFrame) -> DataFrame:
    """Partitions (contract, event, 10K, row_count) whose count differs when read back."""
    key = ["contract", "event", "10K"]
    j = written.select(*key, F.col("row_count").alias("written")).join(reread.select(*key, F.col("row_count").alias("reread")), key, "full_outer")
    return j.where(~F.col("written").eqNullSafe(F.col("reread")))


def empty_partitions(ready: DataFrame, targets: DataFrame, counts: DataFrame) -> DataFrame:
    """Every ready partition (partition_start) of every target (contract, event) with its rows; `empty` where there are none.

    Targets are the fixed set of stored tables, so each ready partition is expanded by that list."""
    pairs = [(r["contract"], r["event"]) for r in targets.collect()]
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("contract"), F.lit(e).alias("event")) for c, e in pairs)))
    grid = ready.select(F.col("partition_start").alias("10K"), each.alias("x")).select("10K", "x.contract", "x.event")
    j = grid.join(counts, ["contract", "event", "10K"], "left")
    return j.select("contract", "event", "10K", F.coalesce("row_count", F.lit(0)).alias("row_count"), F.when(F.coalesce("row_count", F.lit(0)) == 0, "empty").otherwise("complete").alias("status"))


def _per_partition(df: DataFrame, contract: str, event: str) -> DataFrame:
    rows = df.groupBy("10K").agg(F.count("*").alias("row_count"))
    return rows.select(F.lit(contract).alias("contract"), F.lit(event).alias("event"), "10K", "row_count")


SEALED = "contract string, event string, `10K` long"


def sealed_partitions(spark: SparkSession, root: str) -> DataFrame:
    """The partitions (SEALED) that are stored now."""
    return partition_inventory(spark, root).select("contract", "event", "10K") if exists(spark, root) else spark.createDataFrame([], SEALED)


def seal_ready(staged: dict[tuple[str, str], DataFrame], ranges: DataFrame, root: str, read_back=scan_table, sealed: DataFrame | None = None, ids_in_hex: bool = False) -> dict[str, DataFrame]:
    """Release the rows of complete, unsealed partitions, and say what stays staged and what came late.

    Rows are written beside the root first and read back; only partitions whose count is what was written move to the root.
    The others are returned as mismatches, and their rows stay staged with those of partitions that are not complete.
    `sealed` are the partitions (SEALED) that were stored before, of which further rows are late: what is stored now, or a
    record of an earlier start of the same run, so that what it released already is written again in its place. `ids_in_hex` is
    that of `typed_projection`."""
    spark = ranges.sparkSession
    key = ["contract", "event", "10K"]
    ready = materialize(complete_10k(ranges).select(F.col("partition_start").alias("10K")), "ready")
    inventory = materialize(sealed_partitions(spark, root), "inventory") if sealed is None else sealed
    area, kept, late, wrote, mismatches = shared_path(spark, "unverified"), {}, [], [], []
    for (contract, event), df in staged.items():
        tagged = df.withColumns({"contract": F.lit(contract), "event": F.lit(event)})
        fresh, old = only_unsealed(tagged, inventory)
        go = partitioned(fresh).join(ready, "10K", "left_semi")
        export_event(typed_projection(go.select(*df.columns), contract, event, ids_in_hex=ids_in_hex), area, contract, event)
        written = materialize(_per_partition(go, contract, event), "written")
        again = read_back(spark, area, contract, event)
        differs = materialize(verify_partitions(written, _per_partition(again, contract, event)), "mismatches")
        export_event(again.join(differs.select("10K"), "10K", "left_anti").drop("1M", "10K"), root, contract, event, replace=True)
        held = ready.join(differs.select("10K"), "10K", "left_anti")
        kept[contract, event] = partitioned(fresh).join(held, "10K", "left_anti").select(*df.columns)
        late.append(partitioned(old).select(*key, "block_number", "transaction_hash", "log_index"))
        wrote.append(written.join(differs.select("10K"), "10K", "left_anti"))
        mismatches.append(differs)
    delete(spark, area)  # what was verified stands below the root now
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return {"written": union(wrote), "mismatches": union(mismatches), "late": union(late), "staged": kept}
