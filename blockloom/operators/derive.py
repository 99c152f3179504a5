"""Derivations the data dictionary defines: prices, payouts, lookups and net fees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .checks import ZERO, packed, unpacked


def implied_price(fills: DataFrame) -> DataFrame:
    """Collateral per token of fills with exactly one collateral side: buy when the maker pays collateral."""
    maker = F.col("maker_asset_id") == ZERO
    m, k = (F.col(f"{s}_amount_filled").cast("double") for s in ("maker", "taker"))
    return fills.where(maker != (F.col("taker_asset_id") == ZERO)).select(
        "transaction_hash", "log_index", F.when(maker, F.col("taker_asset_id")).otherwise(F.col("maker_asset_id")).alias("token_id"), F.when(maker, "buy").otherwise("sell").alias("side"),
        F.when(maker, m / F.nullif(k, F.lit(0.0))).otherwise(k / F.nullif(m, F.lit(0.0))).alias("price"),
    )


def payout_fractions(resolutions: DataFrame) -> DataFrame:
    """One row per outcome: numerator, its share of the sum (null if that is 0), and whether all outcomes pay the same."""
    n = F.transform(F.from_json("payout_numerators", "array<string>"), lambda x: x.cast("decimal(38,0)"))
    r = resolutions.select("condition_id", n.alias("n"))
    total = F.aggregate("n", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)"))
    r = r.select("condition_id", total.cast("double").alias("total"), (F.array_min("n") == F.array_max("n")).alias("is_draw"), F.posexplode("n").alias("outcome", "numerator"))
    return r.select("condition_id", "outcome", F.col("numerator").cast("string").alias("numerator"), (F.col("numerator").cast("double") / F.nullif("total", F.lit(0.0))).alias("fraction"), "is_draw")


#: Rows of a block of conversions, and of a block of questions, that meet as a whole.
BLOCK = 4_000
MOST_BLOCKS = 32


def converted_market_conditions(converted: DataFrame, questions: DataFrame, preparations: DataFrame) -> DataFrame:
    """Conditions reached from conversions through the market's questions.

    Markets are few and large, and each conversion meets each question of its market. So conversions and questions are dealt into
    blocks by their ids, and each block of one side meets each of the other in a group of its own: a market is no longer one
    task's, and what is sent grows with the rows times the blocks, not with the result."""
    q = questions.select("market_id", "question_id", "index_val")
    p = preparations.select("question_id", "condition_id", "outcome_slot_count")
    q, c = q.join(p, "question_id"), converted.select("transaction_hash", "market_id")
    n, m = (min(MOST_BLOCKS, 1 + df.count() // BLOCK) for df in (c, questions))
    block = lambda id_, k: F.pmod(F.xxhash64(id_), F.lit(k))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    c = c.withColumn("i", block("transaction_hash", n)).withColumn("j", every(m))
    q = q.withColumn("j", block("question_id", m)).withColumn("i", every(n))
    # a number of their own keeps tasks apart, as what they read is small and only what they make is large
    tasks, key = 4 * n * m, ["market_id", "i", "j"]
    c, q = (df.repartition(tasks, *key) if tasks > 16 else df for df in (c, q))
    return c.join(q, key).select("transaction_hash", "market_id", "question_id", "index_val", "condition_id", "outcome_slot_count")


def outcome_conditions(outcomes: DataFrame, preparations: DataFrame) -> DataFrame:
    return outcomes.select("question_id", "outcome", "block_number").join(preparations.select("question_id", "condition_id"), "question_id").select("question_id", "condition_id", "outcome", "block_number")


def net_fees(fills: DataFrame, refunds: DataFrame) -> DataFrame:
    """Per fill: gross fee, its refund (0 if none) and the difference. Fills and refunds meet in one exchange by transaction, with
    ids as bytes."""
    key, none = ("transaction_hash", "order_hash"), F.lit(None)
    ids = [packed(c).alias(c) for c in key]
    f = fills.select(*ids, "log_index", F.col("fee").cast("decimal(38,0)").alias("g"), none.cast("decimal(38,0)").alias("r"), F.lit(True).alias("fill"))
    r = refunds.select(*ids, none.cast(fills.schema["log_index"].dataType).alias("log_index"), none.cast("decimal(38,0)").alias("g"), F.col("refund").cast("decimal(38,0)").alias("r"), F.lit(False).alias("fill"))
    known = F.col("transaction_hash").isNotNull() & F.col("order_hash").isNotNull()
    refund = F.sum("r").over(Window.partitionBy(*key))
    j = f.unionAll(r).repartition("transaction_hash").withColumn("r", F.when(known, refund).cast("decimal(38,0)")).where("fill")
    refund = F.coalesce("r", F.lit(0).cast("decimal(38,0)"))
    return j.select(unpacked("transaction_hash").alias("transaction_hash"), "log_index", unpacked("order_hash").alias("order_hash"), F.col("g").cast("string").alias("gross_fee"), refund.cast("string").alias("refund"), (F.col("g") - refund).cast("string").alias("net_fee"))


def token_conditions(registrations: DataFrame) -> DataFrame:
    return registrations.select(F.explode(F.array("token0", "token1")).alias("token_id"), "condition_id").distinct()


def narrow_amounts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Amount columns as bigint; a value that does not fit raises."""
    def narrow(c: str) -> Column:
        d = F.expr(f"try_cast({c} as bigint)")
        return F.when(F.col(c).isNull() | d.isNotNull(), d).otherwise(F.raise_error(F.concat(F.lit(f"{c} does not fit a bigint: "), F.col(c))))

    return df.withColumns({c: narrow(c) for c in columns})
