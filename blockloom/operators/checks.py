"""Integrity checks of the event tables. Each returns its violation rows (none: it holds); `report` sums them up.

Ids are 64 hex digits, addresses 40; the zero id stands for collateral. `t` maps event names to tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.catalog import EVENTS
from ..sources.shared import materialize

ZERO = "0" * 64
LATE_BLOCKS = 100


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _dec(c: str) -> Column:
    return F.col(c).cast("decimal(38,0)")


def _text(c: Column) -> Column:
    return c.cast("string")


def _missing(df: DataFrame, column: str, other: DataFrame, key: str) -> DataFrame:
    """Distinct values of a column that the other table's key lacks."""
    return df.select(column).distinct().join(other.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def both(t, event: str) -> DataFrame:
    """A logical event of the two contracts that store it with different columns."""
    return t[f"ct_{event}"].unionByName(t[f"nr_{event}"], allowMissingColumns=True)


def registered(t) -> DataFrame:
    r = t["token_registered"]
    return r.select(F.col("token0").alias("token_id")).unionAll(r.select("token1")).distinct()


def packed(c: str) -> Column:
    """A text as bytes, half as long where it is hex in lower case; `unpacked` gives it back. Different texts stay different."""
    text = F.col(c).cast("string")
    return F.when(text.rlike("^([0-9a-f][0-9a-f])+$"), F.concat(F.lit(b"\x01"), F.unhex(text))).otherwise(F.concat(F.lit(b"\x00"), F.encode(text, "utf-8")))


def unpacked(c: str) -> Column:
    rest = F.substr(F.col(c), F.lit(2))
    return F.when(F.substr(F.col(c), F.lit(1), F.lit(1)) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(F.decode(rest, "utf-8"))


WEIGHT = "__n"


def _orders(t) -> DataFrame:
    """The fills, or for a report their sums by order and transaction with the number of fills as WEIGHT."""
    return t.orders if isinstance(t, _Shared) else t["order_filled"]


def _count(df: DataFrame) -> Column:
    return F.sum(WEIGHT) if WEIGHT in df.columns else F.count("*")


def _have(df: DataFrame, *columns: str) -> DataFrame:
    """These columns, as far as sums have them, and the weight."""
    return df.select(*(c for c in (*columns, WEIGHT) if c in df.columns))


def _tokens(t, contract: str | None = None) -> DataFrame:
    """Distinct token ids that fills (of a contract) trade."""
    if isinstance(t, _Shared):
        return (t.tokens.where(F.col("contract") == contract) if contract else t.tokens).select("token_id").distinct()
    f = t["order_filled"]
    return traded(f.where(F.col("contract") == contract) if contract else f)


def traded(df: DataFrame) -> DataFrame:
    """Distinct token ids on either side, without collateral (filtered before the shuffle: it is on every row)."""
    sides = df.select(F.explode(F.array("maker_asset_id", "taker_asset_id")).alias("token_id"))
    return sides.where(F.col("token_id") != ZERO).distinct()


BLOBS = {
    "order_filled": {"maker": 20, "taker": 20, "order_hash": 32, "transaction_hash": 32},
    "orders_matched": {"taker_order_maker": 20, "taker_order_hash": 32, "transaction_hash": 32},
    "fee_charged": {"receiver": 20, "transaction_hash": 32},
    "token_registered": {"condition_id": 32, "transaction_hash": 32},
}


def _bytes(c: str) -> Column:
    return F.floor(F.length(c) / 2)


def blob_lengths(t, ranges: DataFrame | None = None) -> DataFrame:
    """addresses that are not 20 bytes and hashes that are not 32, in all blocks or in the 1M ranges of a sample (a few
    rows of `1M`, as sample_ranges gives)."""
    inside = lambda df: df if ranges is None else df.withColumn("1M", F.col("block_number") - F.col("block_number") % 1_000_000).join(F.broadcast(ranges), "1M", "left_semi")
    out = []
    for event, columns in BLOBS.items():
        sizes = F.array(*(F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("want"), _bytes(c).alias("n_bytes")) for c, n in columns.items()))
        bad = F.filter(sizes, lambda x: x["n_bytes"] != x["want"])
        rows = inside(t[event]).select(F.lit(event).alias("event"), "transaction_hash", "log_index", F.explode(bad).alias("x"))
        out.append(rows.select("event", "transaction_hash", "log_index", "x.column_name", "x.n_bytes"))
    return _union(out)


AMOUNTS = {
    "order_filled": ("maker_amount_filled", "taker_amount_filled", "fee"), "orders_matched": ("maker_amount_filled", "taker_amount_filled"), "fee_charged": ("amount",),
    "position_split": ("amount",), "positions_merge": ("amount",), "payout_redemption": ("payout",),
}


def _no_amount(c: str) -> Column:
    """Whether a text is no whole number from 0 to 2**127-1: decimal(38) ends below that, so 39 digits are compared as text."""
    d = F.expr(f"try_cast({c} as decimal(38,0))")
    digits = F.ltrim(F.trim(c), F.lit("0"))
    wide = digits.rlike("^[0-9]{39}$") & (digits <= str(2**127 - 1))
    return F.coalesce(d < 0, ~F.coalesce(wide, F.lit(False)))


def _logical(t, event: str) -> DataFrame:
    return both(t, event) if event in ("position_split", "positions_merge", "payout_redemption") else t[event]


def amounts_parse(t) -> DataFrame:
    """amounts that are no whole number from 0 to 2**127-1, by value with their count."""
    out = []
    for event, columns in AMOUNTS.items():
        df = _logical(t, event)
        for c in columns:
            out.append(df.where(_no_amount(c)).groupBy(F.lit(event).alias("event"), F.lit(c).alias("column_name"), F.col(c).alias("value")).agg(F.count("*").alias("n")))
    return _union(out)


def symmetric_pairs(t) -> DataFrame:
    """registered pairs whose reverse is registered nowhere."""
    r = t["token_registered"]
    return r.select("token0", "token1").join(r.select(F.col("token1").alias("token0"), F.col("token0").alias("token1")).distinct(), ["token0", "token1"], "left_anti")


def resolution_prepared(t) -> DataFrame:
    return _missing(t["condition_resolution"], "condition_id", t["condition_preparation"], "condition_id")


def _bad_payouts() -> Column:
    c = "payout_numerators"
    a, b = (F.get_json_object(c, f"$[{i}]").cast("decimal(38,0)") for i in (0, 1))
    return F.when(F.json_array_length(c) == 2, (a + b <= 0) | (a < 0) | (b < 0)).otherwise(F.lit(False))


def payout_sums(t) -> DataFrame:
    """two-outcome resolutions whose payouts sum to nothing or hold a negative."""
    return t["condition_resolution"].where(_bad_payouts()).select("condition_id", "block_number", "payout_numerators")


def converted_has_questions(t) -> DataFrame:
    return _missing(t["positions_converted"], "market_id", t["question_prepared"], "market_id")


def reachable_has_condition(t) -> DataFrame:
    """Questions of converted markets without a prepared condition."""
    q = t["question_prepared"].join(t["positions_converted"].select("market_id"), "market_id", "left_semi")
    return q.select("market_id", "question_id").distinct().join(t["condition_preparation"].select("question_id"), "question_id", "left_anti").select("market_id", "question_id")


def exchanges_disjoint(t) -> DataFrame:
    """token ids that trade on both exchanges."""
    return _tokens(t, "CTFExchange").join(_tokens(t, "NegRiskCtfExchange"), "token_id", "left_semi")


def fee_tokens_registered(t) -> DataFrame:
    return t["fee_charged"].where(F.col("token_id") != ZERO).select("token_id").distinct().join(registered(t), "token_id", "left_anti")


def fee_reconciliation(t) -> DataFrame:
    """transactions whose fills' fees differ from the fees charged (none charged counts as 0)."""
    paid = _orders(t).groupBy("transaction_hash").agg(F.sum(_dec("fee")).alias("fill_fee"))
    charged = t["fee_charged"].groupBy("transaction_hash").agg(F.sum(_dec("amount")).alias("charged"))
    both_sides = paid.join(charged, "transaction_hash", "left").withColumn("charged", F.coalesce("charged", F.lit(0)))
    return both_sides.where("fill_fee <> charged").select("transaction_hash", _text(F.col("fill_fee")).alias("fill_fee"), _text(F.col("charged")).alias("charged_fee"))


def fees_without_table(t) -> DataFrame:
    """Where no fee was charged at all in a partition of 10,000 blocks, transactions with fees."""
    part = lambda df: df.withColumn("p", F.col("block_number") - F.col("block_number") % 10000)
    alone = part(_orders(t)).join(part(t["fee_charged"]).select("contract", "p").distinct(), ["contract", "p"], "left_anti")
    return alone.groupBy("contract", "transaction_hash").agg(F.sum(_dec("fee")).alias("s")).where("s <> 0").select("contract", "transaction_hash", _text(F.col("s")).alias("fill_fee"))


def expected_rows(found: DataFrame, expected: DataFrame, within: str | None = None) -> DataFrame:
    """rows that are found but not expected (extra) or the other way round (missing), as multisets; `within` a column, only
    rows whose value of it is among the found ones count. Both sides meet in one exchange, with texts as bytes."""
    names = found.columns
    texts = {c for c, kind in found.dtypes if kind == "string"}
    side = lambda df, n: df.select(*(packed(c).alias(c) if c in texts else F.col(c) for c in names), F.lit(n).alias("__n"))
    expected = expected.select(*names) if within is None else expected.where(F.col(within).isNotNull()).select(*names)
    rows = side(found, 1).unionAll(side(expected, -1)).repartition(*([within] if within else names))
    rows = rows.groupBy(*names).agg(F.sum("__n").alias("__n"), F.max("__n").alias("__found"))
    if within:
        rows = rows.withColumn("__found", F.max("__found").over(Window.partitionBy(within))).where("__found = 1")
    each = F.explode(F.array_repeat(F.when(F.col("__n") > 0, "extra").otherwise("missing"), F.abs("__n").cast("int")))
    return rows.where("__n <> 0").select(*(unpacked(c).alias(c) if c in texts else F.col(c) for c in names), each.alias("problem"))


def refund_identity(t) -> DataFrame:
    """per transaction and order, refund + charged fee must equal the gross fee, with as many rows on either side. Fills and
    refunds meet in one exchange by transaction, with ids as bytes."""
    key = ["transaction_hash", "order_hash"]
    ids, none, zero = [packed(c).alias(c) for c in key], F.lit(None).cast("decimal(38,0)"), F.lit(0).cast("long")
    fills = _orders(t)
    weight = F.col(WEIGHT) if WEIGHT in fills.columns else F.lit(1).cast("long")
    # rows without an id match nothing of the other side
    lone = lambda n: F.when(F.col("transaction_hash").isNull() | F.col("order_hash").isNull(), n).alias("lone")
    fills = fills.where(F.col("transaction_hash").isNotNull()).select(*ids, lone(1), _dec("fee").alias("gross"), none.alias("net"), weight.alias("n_fills"), zero.alias("n_refunds"))
    refunds = t["fee_refunded"].select(*ids, lone(2), none.alias("gross"), (_dec("refund") + _dec("fee_charged")).cast("decimal(38,0)").alias("net"), zero.alias("n_fills"), F.lit(1).cast("long").alias("n_refunds"))
    sums = fills.unionAll(refunds).repartition("transaction_hash").groupBy(*key, "lone").agg(*(F.sum(c).alias(c) for c in ("gross", "net", "n_fills", "n_refunds")))
    j = sums.withColumn("__any", F.max("n_refunds").over(Window.partitionBy("transaction_hash"))).where("__any > 0")
    n_fills, n_refunds = (F.nullif(c, zero) for c in ("n_fills", "n_refunds"))
    j = j.where(~F.col("gross").eqNullSafe(F.col("net")) | ~n_fills.eqNullSafe(n_refunds))
    return j.select(*(unpacked(c).alias(c) for c in key), _text(F.col("gross")).alias("gross"), _text(F.col("net")).alias("net"), n_fills.alias("n_fills"), n_refunds.alias("n_refunds"))


def questions_have_market(t) -> DataFrame:
    return _missing(t["question_prepared"], "market_id", t["market_prepared"], "market_id")


def fill_after_cancel(t) -> DataFrame:
    c = t["order_cancelled"].select("order_hash", F.col("block_number").alias("cancel_block"))
    f = _have(_orders(t), "order_hash", "block_number", "transaction_hash", "log_index").withColumnRenamed("block_number", "fill_block")
    return f.join(c, "order_hash").where("fill_block > cancel_block")


def trading_after_resolution(t) -> DataFrame:
    """tokens of resolved conditions filled more than LATE_BLOCKS later (maker and taker arms as a set)."""
    r = t["condition_resolution"].select("condition_id", F.col("block_number").alias("resolution_block"))
    reg = t["token_registered"]
    tokens = reg.select("condition_id", F.explode(F.array("token0", "token1")).alias("token_id")).join(r, "condition_id").select("token_id", "resolution_block").distinct()
    sides = t["order_filled"].select("transaction_hash", F.col("block_number").alias("fill_block"), F.explode(F.array_distinct(F.array("maker_asset_id", "taker_asset_id"))).alias("token_id")).where(F.col("token_id") != ZERO)
    late = sides.join(tokens, "token_id").where(F.col("fill_block") > F.col("resolution_block") + LATE_BLOCKS)
    return late.select("transaction_hash", "fill_block", "resolution_block", "token_id").distinct()


def _zero_amount() -> Column:
    return (_dec("maker_amount_filled") == 0) | (_dec("taker_amount_filled") == 0)


def amounts_positive(t) -> DataFrame:
    return t["order_filled"].where(_zero_amount()).select("transaction_hash", "log_index", "maker_amount_filled", "taker_amount_filled")


def _one_side() -> Column:
    return (F.col("maker_asset_id") == ZERO) != (F.col("taker_asset_id") == ZERO)


def _price() -> Column:
    m, k = (F.col(f"{s}_amount_filled").cast("double") for s in ("maker", "taker"))
    return F.when(F.col("maker_asset_id") == ZERO, m / F.nullif(k, F.lit(0.0))).otherwise(k / F.nullif(m, F.lit(0.0)))


def _priced(t) -> DataFrame:
    return t["order_filled"].where(_one_side()).select("transaction_hash", "log_index", _price().alias("price"))


def price_in_range(t) -> DataFrame:
    """F16: implied prices that are null or not above 0, where one side is collateral."""
    return _priced(t).where("price is null or price <= 0")


def price_warning(t) -> DataFrame:
    return _priced(t).where("price >= 1")


def one_collateral_side(t) -> DataFrame:
    return t["order_filled"].where(~_one_side()).select("transaction_hash", "log_index", "maker_asset_id", "taker_asset_id")


def taker_matches_summary(t) -> DataFrame:
    """the taker's fill must carry the summary's amounts (compared as text), per contract and 1M partition."""
    m = t["orders_matched"].select("contract", F.floor(F.col("block_number") / 1000000).alias("m"), "transaction_hash", F.col("taker_order_hash").alias("order_hash"), F.col("maker_amount_filled").alias("a"), F.col("taker_amount_filled").alias("b"))
    f = _orders(t).withColumn("m", F.floor(F.col("block_number") / 1000000))
    j = f.join(m, ["contract", "m", "transaction_hash", "order_hash"]).where("maker_amount_filled <> a or taker_amount_filled <> b")
    j = j.withColumnsRenamed({"a": "summary_maker", "b": "summary_taker"})
    return _have(j, "transaction_hash", "order_hash", "maker_amount_filled", "taker_amount_filled", "summary_maker", "summary_taker")


def fill_tokens_registered(t) -> DataFrame:
    return _tokens(t).join(registered(t), "token_id", "left_anti")


def maker_filled_once(t) -> DataFrame:
    """in a transaction, orders other than the taker's that are filled more than once (a second summary row multiplies)."""
    part = F.floor(F.col("block_number") / 1000000)
    m = t["orders_matched"].select("contract", part.alias("m"), "transaction_hash", "taker_order_hash")
    f = _have(_orders(t).withColumn("m", part), "contract", "m", "transaction_hash", "order_hash")
    j = f.join(m, ["contract", "m", "transaction_hash"]).where("order_hash <> taker_order_hash")
    return j.groupBy("contract", "transaction_hash", "order_hash").agg(_count(j).alias("n")).where("n > 1")


def matched_tokens_registered(t) -> DataFrame:
    return traded(t["orders_matched"]).join(registered(t), "token_id", "left_anti")


def outcome_has_question(t) -> DataFrame:
    return _missing(t["outcome_reported"], "question_id", t["question_prepared"], "question_id")


def outcome_is_bool(t) -> DataFrame:
    return t["outcome_reported"].where(~F.col("outcome").isin(0, 1)).select("question_id", "outcome")


def redemption_resolved(t) -> DataFrame:
    """redeemed conditions that were prepared but never resolved."""
    r = both(t, "payout_redemption").select("condition_id").distinct()
    return r.join(t["condition_preparation"].select("condition_id"), "condition_id", "left_semi").join(t["condition_resolution"].select("condition_id"), "condition_id", "left_anti")


def token_in_one_condition(t) -> DataFrame:
    each = t["token_registered"].select("condition_id", F.explode(F.array("token0", "token1")).alias("token_id"))
    return each.groupBy("token_id").agg(F.countDistinct("condition_id").alias("n")).where("n > 1")


def registered_before_trade(t) -> DataFrame:
    """first fill of a token (each side on its own) not after its first registration (each arm on its own), or none."""
    f, r = None if isinstance(t, _Shared) else t["order_filled"], t["token_registered"]
    fills = t.tokens.groupBy("side", "token_id").agg(F.min("first_fill").alias("first_fill")).drop("side") if f is None else _union(f.where(F.col(c) != ZERO).groupBy(F.col(c).alias("token_id")).agg(F.min("block_number").alias("first_fill")) for c in ("maker_asset_id", "taker_asset_id"))
    regs = _union(r.groupBy(F.col(c).alias("token_id")).agg(F.min("block_number").alias("first_registration")) for c in ("token0", "token1"))
    j = fills.join(regs, "token_id", "left")
    return j.where("first_registration is null or first_fill <= first_registration").select("token_id", "first_fill", F.coalesce("first_registration", F.lit(-1)).alias("first_registration"))


def registered_prepared(t) -> DataFrame:
    return _missing(t["token_registered"], "condition_id", t["condition_preparation"], "condition_id")


def _bad_registration() -> Column:
    c = F.col("condition_id")
    return c.isNull() | (F.length(c) != 64) | (c == ZERO)


def registration_valid(t) -> DataFrame:
    return t["token_registered"].where(_bad_registration()).select("transaction_hash", "log_index", "condition_id")


KEYED = tuple(EVENTS)


def unique_log_keys(t, events: tuple[str, ...] = KEYED) -> DataFrame:
    """(transaction, log index) that occur more than once in a contract, event and 1M partition: one pass over all tables."""

    def keys(e: str) -> DataFrame:
        contract = F.col("contract") if "contract" in t[e].columns else F.lit("")
        return t[e].select(contract.alias("contract"), F.lit(e).alias("event"), F.floor(F.col("block_number") / 1000000).alias("m"), packed("transaction_hash").alias("transaction_hash"), "log_index")

    # by transaction, as its logs stand together and so its hash is sent about once
    d = _union(keys(e) for e in events).repartition("transaction_hash").groupBy("contract", "event", "m", "transaction_hash", "log_index").agg(F.count("*").alias("n")).where("n > 1")
    return d.groupBy("contract", "event").agg(F.count("*").alias("duplicates"))


#: name: (check, expectation, tolerated violations)
CHECKS: dict[str, tuple[Callable[..., DataFrame], str, int]] = {
    "f1_blob_lengths": (blob_lengths, "strict", 0), "f2_amounts_parse": (amounts_parse, "strict", 0), "f3_symmetric_pairs": (symmetric_pairs, "strict", 0),
    "f4_resolution_prepared": (resolution_prepared, "expected", 0), "f5_payout_sums": (payout_sums, "strict", 0), "f6a_converted_has_questions": (converted_has_questions, "strict", 0),
    "f6b_reachable_has_condition": (reachable_has_condition, "strict", 0), "f7_exchanges_disjoint": (exchanges_disjoint, "strict", 0), "f8_fee_tokens_registered": (fee_tokens_registered, "strict", 0),
    "f9_fee_reconciliation": (fee_reconciliation, "strict", 0), "f9b_fees_without_table": (fees_without_table, "strict", 0), "f11_refund_identity": (refund_identity, "strict", 0),
    "f12_questions_have_market": (questions_have_market, "strict", 0), "f13_fill_after_cancel": (fill_after_cancel, "strict", 0), "f14_trading_after_resolution": (trading_after_resolution, "expected", 0),
    "f15_amounts_positive": (amounts_positive, "strict", 0), "f16_price_in_range": (price_in_range, "strict", 0), "f16w_price_warning": (price_warning, "expected", 0), "f17_one_collateral_side": (one_collateral_side, "strict", 0),
    "f18_taker_matches_summary": (taker_matches_summary, "strict", 0), "f19_fill_tokens_registered": (fill_tokens_registered, "strict", 0), "f20_maker_filled_once": (maker_filled_once, "strict", 0),
    "f21_matched_tokens_registered": (matched_tokens_registered, "strict", 0), "f22_outcome_has_question": (outcome_has_question, "strict", 0), "f23_outcome_is_bool": (outcome_is_bool, "strict", 0),
    "f24_redemption_resolved": (redemption_resolved, "strict", 0), "f25_token_in_one_condition": (token_in_one_condition, "strict", 0), "f26_registered_before_trade": (registered_before_trade, "strict", 0),
    "f27_registered_prepared": (registered_prepared, "tolerated", 250), "f28_registration_valid": (registration_valid, "strict", 0), "f29_unique_log_keys": (unique_log_keys, "strict", 0),
}


#: Checks of single rows: by table, what makes a row (or one of its columns) a violation, and for checks that report values
#: the value that counts once.
_Local = tuple[str, Callable[[], Column], Column | None]


def _local(name: str) -> list[_Local]:
    none = None
    return {
        "f1_blob_lengths": [(e, (lambda c=c, n=n: _bytes(c) != n), none) for e, cols in BLOBS.items() for c, n in cols.items()],
        "f2_amounts_parse": [(e, (lambda c=c: _no_amount(c)), F.struct(F.lit(e), F.lit(c), F.col(c))) for e, cols in AMOUNTS.items() for c in cols],
        "f5_payout_sums": [("condition_resolution", _bad_payouts, none)],
        "f15_amounts_positive": [("order_filled", _zero_amount, none)],
        "f16_price_in_range": [("order_filled", lambda: _one_side() & (_price().isNull() | (_price() <= 0)), none)],
        "f16w_price_warning": [("order_filled", lambda: _one_side() & (_price() >= 1), none)],
        "f17_one_collateral_side": [("order_filled", lambda: ~_one_side(), none)],
        "f23_outcome_is_bool": [("outcome_reported", lambda: ~F.col("outcome").isin(0, 1), none)],
        "f28_registration_valid": [("token_registered", _bad_registration, none)],
    }.get(name, [])


class _Shared:
    """Tables of a report with what several checks of the fills read in common, each made in one pass over them."""

    def __init__(self, t):
        self.t, self.made = t, {}

    def __getitem__(self, name: str) -> DataFrame:
        return self.t[name]

    @property
    def orders(self) -> DataFrame:
        if "orders" not in self.made:
            key = ("contract", "block_number", "transaction_hash", "order_hash", "maker_amount_filled", "taker_amount_filled")
            sums = self.t["order_filled"].groupBy(*key).agg(F.sum(_dec("fee")).alias("fee"), F.count("*").alias(WEIGHT))
            self.made["orders"] = materialize(sums, "orders")
        return self.made["orders"]

    @property
    def tokens(self) -> DataFrame:
        if "tokens" not in self.made:
            sides = F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"{s}_asset_id").alias("token_id")) for s in ("maker", "taker")))
            each = self.t["order_filled"].select("contract", "block_number", F.inline(sides)).where(F.col("token_id") != ZERO)
            self.made["tokens"] = materialize(each.groupBy("contract", "side", "token_id").agg(F.min("block_number").alias("first_fill")), "tokens")
        return self.made["tokens"]


def _row_local(of: dict[str, object]) -> DataFrame:
    """(check_name, violations) of checks of single rows with the tables each reads: one pass over a table for all of them.
    Only violations leave the scan."""
    passes: dict[tuple[int, str], tuple[object, list]] = {}
    for name, t in of.items():
        for event, bad, value in _local(name):
            passes.setdefault((id(t), event), (t, []))[1].append((name, bad, value))
    found = []
    for (_, event), (t, tests) in passes.items():
        key = lambda v: F.to_json(v, {"ignoreNullFields": "false"}) if v is not None else F.lit(None).cast("string")
        each = F.array(*(F.when(bad(), F.struct(F.lit(n).alias("check_name"), key(v).alias("value"))) for n, bad, v in tests))
        found.append(_logical(t, event).select(F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x")).select("x.check_name", "x.value"))
    groups = _union(found).groupBy("check_name", "value").agg(F.count("*").alias("n"))
    once = F.when(F.col("value").isNull(), F.col("n")).otherwise(1)
    return groups.groupBy("check_name").agg(F.sum(once).alias("violations"))


def report(t, names=tuple(CHECKS), limit: int = 0, instead: dict | None = None, apart: bool = False) -> DataFrame:
    """per check its violations, expectation, tolerance and status, and with a limit some violation rows as JSON.

    Status is pass or fail, expected failure or unexpected pass where a failure is expected, and skip where a table that the
    check reads is missing (a KeyError of t). `instead` names other tables for single checks. Checks that are run `apart`, one
    after the other, leave a row each and their shuffle files go, so the disk holds those of one check and not of all.

    Without samples a table is read once for all checks of its single rows, and the fills once for all checks of tokens,
    once for those of orders and transactions, and by each of the others (after a resolution, repeated keys)."""
    out, shared, local = [], _Shared(t), {}
    for name in names:
        check, expectation, tolerance = CHECKS[name]
        fine, bad = ("unexpected pass", "expected failure") if expectation == "expected" else ("pass", "fail")
        head = F.lit(name).alias("check_name")
        about = F.lit(expectation).alias("expectation"), F.lit(tolerance).alias("tolerance")
        status = F.when(F.col("violations") <= tolerance, fine).otherwise(bad).alias("status")
        mine = (instead or {}).get(name)
        try:
            if not limit and _local(name):
                for event, _, _ in _local(name):
                    _logical(mine or t, event)
                local[name] = (mine or t, (head, "violations", *about, status))
                continue
            found = check(mine or (t if limit else shared))
        except KeyError:
            skipped = t.spark.range(1).select(head, F.lit(None).cast("long").alias("violations"), *about, F.lit("skip").alias("status"))
            out.append(skipped.withColumn("sample", F.lit(None).cast("string")) if limit else skipped)
            continue
        row = found.agg(F.coalesce(_count(found), F.lit(0)).alias("violations")).select(head, "violations", *about, status)
        if limit:
            sample = found.select(F.to_json(F.struct("*")).alias("j")).limit(limit).agg(F.to_json(F.collect_list("j")).alias("sample"))
            row = row.join(sample.select(head, "sample"), "check_name")
        out.append(materialize(row, "check") if apart else row)
    if local:
        counts = materialize(_row_local({n: tables for n, (tables, _) in local.items()}), "violations")
        for name, (_, columns) in local.items():
            one = counts.where(F.col("check_name") == name).agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"))
            out.append(one.select(*columns))
    return _union(out)
