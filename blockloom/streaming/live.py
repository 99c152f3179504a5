"""Live feeds as streams that agree with their batch twins in `feed`: what a block held when it became final, logs out of
order, counts of blocks and transactions, transactions in flight.

Steps that hang on the order of all arrivals (finality, regressions) run per micro-batch as ordinary joins and two-level
running maxima over the open rows; what a batch hands to the next is a few numbers and the open rows, in a folder by batch
id that is finished by its `clock`. A batch that is run again writes the same tables again. Counts per key are session
windows: a key's state goes once nothing came for it for a while."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranges import _max_before
from ..sources.scan import delete, exists
from .feed import ALARM_MS, finalized

#: How long after a block is final its late logs are still counted, and how long a settlement is remembered before a trade.
GRACE_MS = 30_000
HOLD_MS = 3_600_000
#: Ranges of arrival that the logs of a micro-batch are dealt into.
SLICES = 64

FEED = "kind string, arrival_ms long, block_number long, tx_hash string"


def _kept(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _start(stream: DataFrame, step, checkpoint: str, trigger: dict | None):
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_regressions(confirmed: DataFrame, out: str, state: str, checkpoint: str, trigger: dict | None = None):
    """Logs of one feed (arrival_seq, block_number, tx_hash) whose block is below the highest that arrived before, with
    that block, below `out` by batch. The order is that of batches, then of arrival_seq; ties are in the order of blocks.

    A batch is dealt into ranges of arrival_seq. A range hands its highest block to the next, and a batch one number."""

    def step(batch: DataFrame, i: int) -> None:
        spark = batch.sparkSession
        before = _kept(spark, f"{state}/{i - 1}", "highest long").first()  # one number
        span = batch.agg(F.min("arrival_seq").alias("lo"), F.max("arrival_seq").alias("hi"), F.max("block_number").alias("top")).first()  # three numbers
        tops = [v for v in (before and before["highest"], span["top"]) if v is not None]
        if span["lo"] is not None:
            ordered = batch.select("arrival_seq", "block_number", "tx_hash", (F.col("arrival_seq") - span["lo"]).alias("from_block"), F.col("block_number").alias("to_block"))
            told = _max_before(ordered, F.col("block_number"), "inside", width=max(1, -(-(span["hi"] - span["lo"] + 1) // SLICES)))
            highest = F.greatest("inside", F.lit(before["highest"] if before else None).cast("long"))
            found = told.select("arrival_seq", "block_number", "tx_hash", highest.alias("highest")).where("block_number < highest")
            found.write.mode("overwrite").parquet(f"{out}/batch={i}")
        spark.createDataFrame([(max(tops) if tops else None,)], "highest long").write.mode("overwrite").parquet(f"{state}/{i}")
        delete(spark, f"{state}/{i - 2}")

    return _start(confirmed, step, checkpoint, trigger)


def stream_inclusion(feed: DataFrame, out: str, state: str, checkpoint: str, grace_ms: int = GRACE_MS, hold_ms: int = HOLD_MS, trigger: dict | None = None):
    """A feed of both kinds of message (FEED: `confirmed` logs, and `settlement`s without a block).

    A block is final when a log of a higher block has arrived. It is closed, and written once below `out/closed` by batch,
    when both kinds have been heard of grace_ms later: its trades, and those that no settlement had announced by the time
    it became final. Logs of closed blocks go to `out/late`. `out/current` has the block in progress after each batch.

    Blocks close in the order of their numbers (the higher a block, the later a higher one can arrive), so the state is the
    trades of blocks that are still open, and the settlements of the last hold_ms."""

    def step(batch: DataFrame, i: int) -> None:
        spark = batch.sparkSession
        clocks = "confirmed_ms long, settled_ms long, closed_to long"
        old = _kept(spark, f"{state}/{i - 1}/clock", clocks).first() or {"confirmed_ms": None, "settled_ms": None, "closed_to": None}
        logs, said = batch.where("kind = 'confirmed'"), batch.where("kind = 'settlement'")
        heard = batch.agg(*(F.max(F.when(F.col("kind") == k, F.col("arrival_ms"))).alias(n) for k, n in (("confirmed", "confirmed_ms"), ("settlement", "settled_ms")))).first()  # two numbers
        ms = {n: max((v for v in (old[n], heard[n]) if v is not None), default=None) for n in ("confirmed_ms", "settled_ms")}
        now = None if None in ms.values() else min(ms.values())

        closed_to = old["closed_to"]
        late = F.lit(False) if closed_to is None else F.col("block_number") <= closed_to
        trade, first = ["block_number", "tx_hash", "arrival_ms"], F.min("arrival_ms").alias("arrival_ms")
        logs.where(late).select(*trade).write.mode("overwrite").parquet(f"{out}/late/batch={i}")
        trades = _kept(spark, f"{state}/{i - 1}/trades", "block_number long, tx_hash string, arrival_ms long").unionAll(logs.where(~late).select(*trade))
        trades.groupBy("block_number", "tx_hash").agg(first).write.mode("overwrite").parquet(f"{state}/{i}/open")
        seen = _kept(spark, f"{state}/{i - 1}/seen", "tx_hash string, arrival_ms long").unionAll(said.select("tx_hash", "arrival_ms"))
        seen.groupBy("tx_hash").agg(first).write.mode("overwrite").parquet(f"{state}/{i}/heard")

        trades, seen = spark.read.parquet(f"{state}/{i}/open"), spark.read.parquet(f"{state}/{i}/heard").withColumnRenamed("arrival_ms", "seen_ms")
        closing = finalized(trades).where(F.col("final_ms") + grace_ms <= F.lit(now))
        not_seen = F.sum((F.col("seen_ms").isNull() | (F.col("seen_ms") >= F.col("final_ms"))).cast("long")).alias("not_seen")
        told = trades.join(closing, "block_number").join(seen, "tx_hash", "left").groupBy("block_number").agg(F.count("*").alias("trades"), not_seen)
        told.write.mode("overwrite").parquet(f"{out}/closed/batch={i}")
        top = spark.read.schema(told.schema).parquet(f"{out}/closed/batch={i}").agg(F.max("block_number")).first()[0]
        closed_to = max((v for v in (top, closed_to) if v is not None), default=None)

        newest = trades.agg(F.max("block_number").alias("block_number"))
        current = trades.join(newest, "block_number", "left_semi").join(seen, "tx_hash", "left").groupBy("block_number")
        current.agg(F.count("*").alias("trades"), F.sum(F.col("seen_ms").isNull().cast("long")).alias("not_seen")).write.mode("overwrite").parquet(f"{out}/current/batch={i}")

        rest = trades if closed_to is None else trades.where(F.col("block_number") > closed_to)
        rest.write.mode("overwrite").parquet(f"{state}/{i}/trades")
        recent = seen if now is None else seen.where(F.col("seen_ms") >= now - hold_ms)
        recent.withColumnRenamed("seen_ms", "arrival_ms").write.mode("overwrite").parquet(f"{state}/{i}/seen")
        spark.createDataFrame([(ms["confirmed_ms"], ms["settled_ms"], closed_to)], clocks).write.mode("overwrite").parquet(f"{state}/{i}/clock")
        for used in (f"{state}/{i}/open", f"{state}/{i}/heard", f"{state}/{i - 2}"):
            delete(spark, used)

    return _start(feed, step, checkpoint, trigger)


def stream_block_counts(confirmed: DataFrame, hold: str = "1 minute") -> DataFrame:
    """H7: distinct transactions and logs of each block (ts, block_number, tx_hash), once no log of it came for `hold`. The
    state is the transactions of the blocks since then."""
    c = confirmed.withWatermark("ts", "0 seconds").groupBy(F.session_window("ts", hold), "block_number")
    return c.agg(F.size(F.collect_set("tx_hash")).cast("long").alias("trades"), F.count("*").alias("logs")).drop("session_window")


def stream_settlement_state(settlements: DataFrame, hold: str = "1 minute") -> DataFrame:
    """H6: first arrival, first pending arrival, and messages of each transaction (ts, tx_hash, status, arrival_ms), once none
    came for `hold`."""
    s = settlements.withWatermark("ts", "0 seconds").groupBy(F.session_window("ts", hold), "tx_hash")
    pending = F.min(F.when(F.col("status") == "pending", F.col("arrival_ms")))
    return s.agg(F.min("arrival_ms").alias("first_seen_ms"), pending.alias("first_pending_ms"), F.count("*").alias("messages")).drop("session_window")


def stream_in_flight(settlements: DataFrame, confirmed: DataFrame, before: str = "1 minute", within_ms: int = ALARM_MS) -> DataFrame:
    """H9: pending settlements (ts, tx_hash, status, arrival_ms) whose transaction was not confirmed (ts, tx_hash) within
    within_ms after, nor up to `before` earlier, once that time has passed on both feeds: an outer join of the two streams."""
    p = settlements.where("status = 'pending'").select(F.col("tx_hash"), F.col("arrival_ms").alias("pending_ms"), F.col("ts").alias("pending_at")).withWatermark("pending_at", "0 seconds")
    c = confirmed.select(F.col("tx_hash").alias("confirmed_tx"), F.col("ts").alias("confirmed_at")).withWatermark("confirmed_at", "0 seconds")
    near = F.expr(f"tx_hash = confirmed_tx AND confirmed_at >= pending_at - INTERVAL {before} AND confirmed_at <= pending_at + INTERVAL {within_ms} MILLISECONDS")
    return p.join(c, near, "left_outer").where("confirmed_tx is null").select("tx_hash", "pending_ms")
