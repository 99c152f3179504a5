"""Feeds: messages of early settlements against confirmed logs, as batch queries and as streams.

Settlements: arrival_ms, tx_hash, status. Confirmed logs: arrival_seq, arrival_ms, block_number, tx_hash."""

from __future__ import annotations

from functools import reduce
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import decode as D
from ..operators.ranges import _max_before, coverage, merge_ranges
from ..plans.catalog import RAW, stored_schema
from ..sources.export import PLACES, SEALED, export_event, partitioned, seal_ready, sealed_partitions, typed_projection, typed_rows
from ..sources.scan import delete, exists, scan_block_range
from ..sources.shared import freeing, materialize

ALARM_MS = 10_000
_ITEM = "struct<tx_hash:string,status:string>"
MESSAGE = f"struct<type:string,data:{_ITEM},events:array<{_ITEM}>>"


def parse_feed(messages: DataFrame) -> DataFrame:
    """H5: settlements of feed messages (arrival_ms, body): single ones, snapshots and status updates (confirmed unless
    they say otherwise). Other types and malformed messages give nothing."""
    m = messages.select("arrival_ms", F.from_json("body", MESSAGE).alias("m"))
    item = F.when(F.col("m.type") == "snapshot", F.col("m.events")).when(F.col("m.type").isin("settlement", "status_update"), F.array("m.data"))
    rows = m.select("arrival_ms", F.col("m.type").alias("type"), F.explode(item).alias("x")).where("x.tx_hash is not null")
    status = F.when(F.col("type") == "status_update", F.coalesce("x.status", F.lit("confirmed"))).otherwise(F.col("x.status"))
    return rows.select("arrival_ms", F.col("x.tx_hash").alias("tx_hash"), status.alias("status"))


def feed_errors(messages: DataFrame) -> DataFrame:
    """Messages of type error, and those that are no JSON object."""
    t = F.get_json_object("body", "$.type")
    return messages.where(t.isNull() | (t == "error")).select("arrival_ms", "body", F.when(t.isNull(), "malformed").otherwise("error").alias("reason"))


def settlement_state(settlements: DataFrame) -> DataFrame:
    """H6: per transaction the first arrival, the first pending arrival and the messages."""
    return settlements.groupBy("tx_hash").agg(F.min("arrival_ms").alias("first_seen_ms"), F.min(F.when(F.col("status") == "pending", F.col("arrival_ms"))).alias("first_pending_ms"), F.count("*").alias("messages"))


def confirmed_by_block(confirmed: DataFrame) -> DataFrame:
    """H7: distinct transactions and logs of each block."""
    return confirmed.groupBy("block_number").agg(F.countDistinct("tx_hash").alias("trades"), F.count("*").alias("logs"))


def finalized(confirmed: DataFrame) -> DataFrame:
    """When each block is final: the first arrival of a log of a higher block after the block's own first arrival."""
    first = confirmed.groupBy("block_number").agg(F.min("arrival_ms").alias("first_ms"))
    as_range = first.select(F.col("block_number").alias("from_block"), F.col("first_ms").alias("to_block"), "block_number")
    # the earliest arrival of any higher block: a running minimum from the top, as the running maximum of negated values
    flipped = as_range.select((-F.col("block_number")).alias("from_block"), F.col("to_block"), "block_number")
    return _max_before(flipped, -F.col("to_block"), "__m").select("block_number", (-F.col("__m")).alias("final_ms")).where("final_ms is not null")


def block_inclusion(confirmed: DataFrame, settlements: DataFrame) -> DataFrame:
    """H8: of each final block its trades, and those that no settlement had announced when it became final."""
    trades = confirmed.select("block_number", "tx_hash").distinct().join(finalized(confirmed), "block_number")
    seen = settlements.groupBy("tx_hash").agg(F.min("arrival_ms").alias("seen_ms"))
    j = trades.join(seen, "tx_hash", "left")
    late = F.col("seen_ms").isNull() | (F.col("seen_ms") >= F.col("final_ms"))
    return j.groupBy("block_number").agg(F.count("*").alias("trades"), F.sum(late.cast("long")).alias("not_seen"))


def in_flight(settlements: DataFrame, confirmed: DataFrame, now_ms: int) -> DataFrame:
    """H9: pending transactions without a confirmation, their age and whether that is alarming."""
    pending = settlements.where("status = 'pending'").groupBy("tx_hash").agg(F.min("arrival_ms").alias("pending_ms"))
    return pending.join(confirmed.select("tx_hash"), "tx_hash", "left_anti").select("tx_hash", "pending_ms", (F.lit(now_ms) - F.col("pending_ms") > ALARM_MS).alias("overdue"))


def block_regressions(confirmed: DataFrame) -> DataFrame:
    """Logs whose block is below the highest block that arrived before (in the order of arrival_seq)."""
    seq = confirmed.withColumns({"from_block": F.col("arrival_seq"), "to_block": F.col("arrival_seq")})
    return _max_before(seq, F.col("block_number"), "highest").where("block_number < highest").select("arrival_seq", "block_number", "tx_hash", "highest")


def current_block_stats(confirmed: DataFrame, settlements: DataFrame) -> DataFrame:
    """The block in progress: trades, and those not announced so far."""
    top = confirmed.agg(F.max("block_number").alias("block_number"))
    trades = confirmed.join(top, "block_number", "left_semi").select("block_number", "tx_hash").distinct()
    j = trades.join(settlements.select("tx_hash").distinct().withColumn("seen", F.lit(1)), "tx_hash", "left")
    return j.groupBy("block_number").agg(F.count("*").alias("trades"), F.sum(F.col("seen").isNull().cast("long")).alias("not_seen"))


# Streams. Each takes and returns streaming DataFrames (or starts a foreachBatch sink).


def read_logs(spark: SparkSession, path: str, files_per_trigger: int = 100, clean: bool = False) -> DataFrame:
    """Logs as their files land below path; `clean` deletes the files of each micro-batch that is done."""
    reader = spark.readStream.schema(RAW).option("maxFilesPerTrigger", files_per_trigger)
    return (reader.option("cleanSource", "delete") if clean else reader).json(path)


def stream_decode(raw: DataFrame) -> DataFrame:
    """H1: decoded events of arriving logs (the same expressions as in batch)."""
    return D.decode_all(raw)


def stream_tables(raw: DataFrame, root: str, checkpoint: str):
    """H1, typed: arriving logs into all stored tables below root, in one pass and one write a micro-batch."""
    rows = partitioned(typed_rows(D.decode_all(raw, ids_in_hex=True)))
    out = rows.writeStream.format("parquet").partitionBy(*PLACES).option("compression", "zstd").option("path", root).option("checkpointLocation", checkpoint)
    return out.trigger(availableNow=True).start()


def stream_dedup(events: DataFrame, time: str, delay: str = "10 minutes") -> DataFrame:
    """H2: replays of a log within the watermark are dropped."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["block_number", "log_index"])


#: New keys of a batch up to which its rows are looked up by them; where more are new, the rows are shuffled whole.
FEW_NEW = 500_000


def stream_store(events: DataFrame, contract: str, event: str, root: str, checkpoint: str, order: tuple[str, ...] = ("transaction_hash",)):
    """H2 without a bound: of each (block_number, log_index) the first row is stored, however late a replay comes. A batch
    meets the stored rows of the partitions between its lowest and highest block only; of rows that a batch repeats the
    first in `order` counts (stored columns as they are stored). A batch that is run again finds what it stored, and adds the
    rest. Batches are read several times, by columns, and must give the same rows each time.

    Rows move once, with ids as bytes, to the partitions they are stored in. What is stored already is found by the numbers of
    the keys first, so a batch of replays moves no rows."""

    def store(batch: DataFrame, i: int) -> None:
        spark, key, at = batch.sparkSession, ["block_number", "log_index"], ["1M", "10K"]
        span = batch.agg(F.min("block_number").alias("lo"), F.max("block_number").alias("hi")).first()  # two numbers
        if span["lo"] is None:
            return
        stored = scan_block_range(spark, root, contract, event, span["lo"], span["hi"]).select(*key)
        known = bool(stored.take(1))
        if known:
            same = lambda a, b: reduce(lambda x, y: x & y, (a[c].eqNullSafe(b[c]) for c in key))
            keys = batch.select(*(F.col(c).cast("long").alias(c) for c in key)).distinct()
            new = materialize(keys.join(stored, same(keys, stored), "left_anti"), "new")
            if few := new.limit(FEW_NEW + 1).count() <= FEW_NEW:
                batch = batch.join(F.broadcast(new), same(batch, new), "left_semi")
            known = not few
        typed = typed_projection(batch, contract, event, [c for c in order if c not in stored_schema(contract, event).names])
        rows = partitioned(typed).withColumn("__stored", F.lit(False))
        if known:  # stored rows come first, by their keys alone, in the same exchange
            rows = rows.unionByName(partitioned(stored).withColumn("__stored", F.lit(True)), allowMissingColumns=True)
        first = Window.partitionBy(*at, *key).orderBy(F.desc("__stored"), *order)
        rows = rows.repartition(*at).withColumn("__n", F.row_number().over(first)).where("__n = 1 and not __stored")
        export_event(rows.select(*stored_schema(contract, event).names), root, contract, event, dealt=True)

    return events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _kept(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path) if exists(spark, path) else like.limit(0)


def stream_seal(events: DataFrame, contract: str, event: str, ranges_of, root: str, state: str, checkpoint: str, after=lambda step, batch: None, ids_in_hex: bool = False):
    """H3: continuous sealing. Each micro-batch is joined by what stayed staged, and what ranges_of(batch id) completes is
    released; the rest stays staged for the batches to come. Below `state` each batch leaves its late and staged rows.

    Exactly once: before a batch releases anything it records the rows that came (those staged before stay where they are), the ranges, and the partitions sealed
    until then. If it breaks off it is run again from its record: partitions it released are written again in their place,
    and only rows of partitions in the record are late. `after` is told of each step that is done (planned, released, late,
    staged)."""

    def seal(batch: DataFrame, i: int) -> None:
        spark, at = batch.sparkSession, f"{state}/{i}"
        if exists(spark, f"{at}/staged/_SUCCESS"):
            return
        if not exists(spark, f"{at}/sealed/_SUCCESS"):  # written last, so the record is whole
            batch.write.mode("overwrite").parquet(f"{at}/rows")
            ranges_of(i).select("from_block", "to_block").write.mode("overwrite").parquet(f"{at}/ranges")
            sealed_partitions(spark, root).write.mode("overwrite").parquet(f"{at}/sealed")
        after("planned", i)
        rows, ranges = (spark.read.schema(k).parquet(f"{at}/{n}") for n, k in (("rows", batch.schema), ("ranges", "from_block long, to_block long")))
        rows = rows.unionByName(_kept(spark, f"{state}/{i - 1}/staged", batch))  # they stay where the batch before left them
        done = seal_ready({(contract, event): rows}, ranges, root, sealed=spark.read.schema(SEALED).parquet(f"{at}/sealed"), ids_in_hex=ids_in_hex)
        after("released", i)
        with freeing(spark):
            done["late"].write.mode("overwrite").parquet(f"{at}/late")
        after("late", i)
        with freeing(spark):
            done["staged"][contract, event].write.mode("overwrite").parquet(f"{at}/staged")
        after("staged", i)
        for path in (*(f"{at}/{n}" for n in ("rows", "ranges", "sealed")), f"{state}/{i - 1}/staged"):  # this batch holds what stays staged
            delete(spark, path)

    return events.writeStream.foreachBatch(seal).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def lag(ranges: DataFrame, head: int, tolerance: int, merged: bool = False) -> DataFrame:
    """Coverage of ranges, and whether it lags behind the head by more than the tolerance."""
    return coverage(ranges, head, merged).withColumn("lagging", F.col("blocks_behind") > tolerance)


def _lag_step(head_of, tolerance: int, state: str):
    """A step of a stream of finished ranges: merges them with those before, and writes the lag behind head_of(batch id)
    below `state`; says whether it is within the tolerance."""

    def step(batch: DataFrame, i: int) -> bool:
        spark = batch.sparkSession
        merged = merge_ranges(batch.unionByName(_kept(spark, f"{state}/ranges/{i - 1}", batch)))
        merged.write.mode("overwrite").parquet(f"{state}/ranges/{i}")
        now = lag(spark.read.schema(merged.schema).parquet(f"{state}/ranges/{i}"), head_of(i), tolerance, merged=True)
        now.write.mode("overwrite").parquet(f"{state}/lag/step={i}")
        delete(spark, f"{state}/ranges/{i - 2}")
        return not spark.read.parquet(f"{state}/lag/step={i}").first()["lagging"]  # one row

    return step


def stream_lag(ranges: DataFrame, head: int, tolerance: int, state: str, checkpoint: str):
    """The lag after each micro-batch of the finished ranges that are there, below `state` by batch."""
    step = _lag_step(lambda i: head, tolerance, state)
    return ranges.writeStream.foreachBatch(lambda batch, i: step(batch, i) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def catch_up(ranges: DataFrame, head_of, tolerance: int, state: str, checkpoint: str, every: str = "0 seconds") -> int:
    """H4: take in finished ranges, micro-batch by micro-batch, until the gap to the head is within the tolerance; then the
    query is stopped. head_of(batch id) gives the head, which moves meanwhile. Returns the batch that reached it; an error of
    a batch is raised. Without new ranges it waits. Batches after the one that reached the tolerance do nothing."""
    step, reached = _lag_step(head_of, tolerance, state), Event()
    last: list[int] = []

    def take(batch: DataFrame, i: int) -> None:
        if not reached.is_set() and step(batch, i):
            last.append(i)
            reached.set()

    query = ranges.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    try:
        while not reached.wait(0.1) and query.isActive:
            pass
    finally:
        query.stop()
    if not reached.is_set():
        query.awaitTermination()  # raises what ended the query
        raise RuntimeError("the stream of ranges ended before the tolerance was reached")
    return last[0]


def stream_announced(confirmed: DataFrame, settlements: DataFrame, wait: str = "30 seconds") -> DataFrame:
    """Announcements as a stream-stream left outer join: confirmed trades with the settlement that announced them up to `wait`
    before, or null once the watermark has passed. Both sides have a timestamp `ts`."""
    c = confirmed.select("block_number", "tx_hash", F.col("ts").alias("confirmed_at")).withWatermark("confirmed_at", "0 seconds")
    s = settlements.select(F.col("tx_hash").alias("settled_tx"), F.col("ts").alias("settled_at")).withWatermark("settled_at", "0 seconds")
    near = F.expr(f"tx_hash = settled_tx AND settled_at <= confirmed_at AND settled_at >= confirmed_at - INTERVAL {wait}")
    return c.join(s, near, "left_outer").select("block_number", "tx_hash", "confirmed_at", "settled_at")
