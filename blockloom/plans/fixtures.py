"""Event tables derived from the driver's tables by deterministic SQL that Spark and DuckDB share.

SHA[x], DAYS[d] and STR stand for each dialect's words; a recipe may read driver tables and other recipes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.shared import materialize

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

RECIPES = {
    "fills": """SELECT CASE WHEN l_partkey % 3 = 0 AND l_orderkey % 499 <> 1 THEN 'NegRiskCtfExchange' ELSE 'CTFExchange' END AS contract,
  83000000 + DAYS[CAST(o_orderdate AS DATE)] * 1000 + o_orderkey % 1000 AS block_number,
  o_orderkey % 200 AS transaction_index, SHA['tx' || CAST(o_orderkey AS STR)] AS transaction_hash,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) - 1 AS log_index,
  l_orderkey, l_linenumber, l_partkey, l_returnflag, o_custkey, l_suppkey,
  SHA['tok' || CAST(l_partkey AS STR) || '-' || CAST(l_suppkey % 2 AS STR)] AS token_id,
  CAST(l_quantity * 1000000 AS BIGINT) AS token_amt, CAST(round(l_extendedprice * 100) AS BIGINT) AS usd_amt,
  CAST(round(l_tax * l_extendedprice * 100) AS BIGINT) AS fee_amt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "order_filled": """SELECT contract, block_number, transaction_index, transaction_hash, log_index,
  SHA['ord' || CAST(l_orderkey AS STR) || '-' || CAST(CASE WHEN l_orderkey % 211 = 0 THEN l_linenumber ELSE 100 + log_index END AS STR)] AS order_hash,
  substr(SHA['addr' || CAST(o_custkey AS STR)], 1, 40) AS maker, substr(SHA['addr' || CAST(l_suppkey + 1000000 AS STR)], 1, 40) AS taker,
  CASE WHEN l_linenumber % 2 = 0 AND l_orderkey % 523 <> 0 THEN repeat('0', 64) ELSE token_id END AS maker_asset_id,
  CASE WHEN l_linenumber % 2 = 0 THEN token_id ELSE repeat('0', 64) END AS taker_asset_id,
  CAST(CASE WHEN l_orderkey % 601 = 0 THEN 0 WHEN l_linenumber % 2 = 0 THEN usd_amt ELSE token_amt END AS STR) AS maker_amount_filled,
  CAST(CASE WHEN l_linenumber % 2 = 0 THEN token_amt ELSE usd_amt END AS STR) AS taker_amount_filled,
  CAST(fee_amt AS STR) AS fee, l_orderkey AS src
FROM fills""",
    "order_filled_replay": """SELECT contract, block_number, transaction_index, transaction_hash, log_index, order_hash, CASE WHEN src % 821 = 0 THEN substr(maker, 1, 38) ELSE maker END AS maker, taker, src, 0 AS delivery FROM order_filled
UNION ALL SELECT contract, block_number, transaction_index, transaction_hash, log_index, order_hash, maker, taker, src, 1 FROM order_filled WHERE src % 811 = 0""",
    "orders_matched": """SELECT contract, block_number, transaction_index, transaction_hash, 1000 AS log_index, order_hash AS taker_order_hash, maker AS taker_order_maker,
  maker_asset_id, taker_asset_id, CASE WHEN src % 307 = 0 THEN maker_amount_filled || '1' ELSE maker_amount_filled END AS maker_amount_filled, taker_amount_filled
FROM order_filled WHERE log_index = 0""",
    "fee_charged": """SELECT contract, block_number, transaction_index, transaction_hash, 2000 + log_index AS log_index, substr(SHA['feeaddr'], 1, 40) AS receiver,
  taker_asset_id AS token_id, CAST(CAST(fee AS BIGINT) + CASE WHEN src % 97 = 0 THEN 1 ELSE 0 END AS STR) AS amount
FROM order_filled WHERE fee <> '0' AND src % 89 <> 0""",
    "fee_refunded": """SELECT CASE WHEN contract = 'CTFExchange' THEN 'FeeModuleCTF' ELSE 'FeeModuleNegRisk' END AS contract, block_number, transaction_index, transaction_hash,
  3000 + log_index AS log_index, order_hash, maker AS receiver, taker_asset_id AS token_id,
  CAST(CAST(fee AS BIGINT) - CAST(fee AS BIGINT) % 1000 + CASE WHEN src % 101 = 0 THEN 1 ELSE 0 END AS STR) AS refund, CAST(CAST(fee AS BIGINT) % 1000 AS STR) AS fee_charged
FROM order_filled WHERE src % 103 <> 0""",
    "order_cancelled": """SELECT contract, block_number + CASE WHEN src % 40 = 0 THEN -500 ELSE 500 END AS block_number, 0 AS transaction_index,
  SHA['cancel' || CAST(src AS STR)] AS transaction_hash, 0 AS log_index, order_hash
FROM order_filled WHERE log_index = 0 AND src % 20 = 0""",
    "parts": """SELECT p_partkey, p_brand, p_name, p_size, SHA['cond' || CAST(p_partkey AS STR)] AS condition_id, SHA['q' || CAST(p_partkey AS STR)] AS question_id,
  SHA['mkt' || p_brand] AS market_id, substr(SHA['oracle' || p_brand], 1, 40) AS oracle, SHA['ptx' || CAST(p_partkey AS STR)] AS transaction_hash,
  83000000 + (p_partkey * 700) % 1400000 AS block_number, p_partkey % 200 AS transaction_index,
  SHA['tok' || CAST(p_partkey AS STR) || '-0'] AS tok_a, SHA['tok' || CAST(p_partkey AS STR) || '-1'] AS tok_b
FROM part""",
    "token_registered": """SELECT CASE WHEN p_partkey % 3 = 0 THEN 'NegRiskCtfExchange' ELSE 'CTFExchange' END AS contract, block_number, transaction_index, transaction_hash, 0 AS log_index,
  tok_a AS token0, tok_b AS token1, CASE WHEN p_partkey % 90 = 17 THEN repeat('0', 64) ELSE condition_id END AS condition_id FROM parts WHERE p_partkey % 50 <> 7
UNION ALL SELECT CASE WHEN p_partkey % 3 = 0 THEN 'NegRiskCtfExchange' ELSE 'CTFExchange' END, block_number, transaction_index, transaction_hash, 1,
  tok_b, tok_a, CASE WHEN p_partkey % 90 = 17 THEN repeat('0', 64) ELSE condition_id END FROM parts WHERE p_partkey % 50 <> 7 AND p_partkey % 60 <> 11
UNION ALL SELECT 'CTFExchange', block_number + 1, transaction_index, SHA['dup' || CAST(p_partkey AS STR)], 0, tok_a, tok_b, SHA['condx' || CAST(p_partkey AS STR)] FROM parts WHERE p_partkey % 70 = 13""",
    "condition_preparation": """SELECT block_number, transaction_index, transaction_hash, 10 AS log_index, condition_id, oracle, question_id, 2 AS outcome_slot_count FROM parts WHERE p_partkey % 41 <> 5""",
    "condition_resolution": """SELECT 85000000 + (p_partkey % 1000) * 1000 AS block_number, transaction_index, SHA['rtx' || CAST(p_partkey AS STR)] AS transaction_hash, 0 AS log_index,
  condition_id, oracle, question_id, 2 AS outcome_slot_count,
  CASE WHEN p_partkey % 53 = 9 THEN '["0", "0"]' WHEN p_partkey % 4 = 0 THEN '["1", "0"]' WHEN p_partkey % 4 = 1 THEN '["0", "1"]' WHEN p_partkey % 4 = 2 THEN '["1", "1"]' ELSE '["1000000000000000000", "0"]' END AS payout_numerators
FROM parts WHERE p_size <= 30""",
    "market_prepared": """SELECT min(block_number) AS block_number, 0 AS transaction_index, SHA['mtx' || p_brand] AS transaction_hash, 0 AS log_index, market_id, oracle, 200 AS fee_bips,
  '0x' || lower(hex(p_brand)) AS data FROM parts WHERE p_brand <> 'Brand#3' GROUP BY p_brand, market_id, oracle""",
    "question_prepared": """SELECT block_number, transaction_index, transaction_hash, 11 AS log_index, market_id, question_id, p_partkey % 256 AS index_val, '0x' || lower(hex(p_name)) AS data
FROM parts WHERE p_partkey % 3 = 0 AND p_partkey % 47 <> 3""",
    "outcome_reported": """SELECT 85000000 + (p_partkey % 1000) * 1000 AS block_number, transaction_index, SHA['rtx' || CAST(p_partkey AS STR)] AS transaction_hash, 1 AS log_index, market_id, question_id,
  CASE WHEN p_partkey % 59 = 0 THEN 2 ELSE p_partkey % 2 END AS outcome FROM parts WHERE p_partkey % 3 = 0 AND p_size <= 30""",
    "position_moves": """SELECT block_number, transaction_index, transaction_hash, 4000 + log_index AS log_index, substr(SHA['addr' || CAST(o_custkey AS STR)], 1, 40) AS holder,
  SHA['cond' || CAST(l_partkey AS STR)] AS condition_id, CASE WHEN l_orderkey % 401 = 0 THEN '-5' WHEN l_orderkey % 409 = 0 THEN 'abc' ELSE CAST(token_amt AS STR) END AS amount,
  l_returnflag AS flag, l_partkey % 3 AS kind, l_orderkey AS src FROM fills""",
    "ct_position_split": """SELECT block_number, transaction_index, transaction_hash, log_index, holder AS stakeholder, substr(SHA['usd'], 1, 40) AS collateral_token, repeat('0', 64) AS parent_collection_id,
  condition_id, '["1", "2"]' AS partition_sets, amount FROM position_moves WHERE flag = 'A' AND kind <> 0""",
    "ct_positions_merge": """SELECT block_number, transaction_index, transaction_hash, log_index, holder AS stakeholder, substr(SHA['usd'], 1, 40) AS collateral_token, repeat('0', 64) AS parent_collection_id,
  condition_id, '["1", "2"]' AS partition_sets, amount FROM position_moves WHERE flag = 'N' AND kind <> 0""",
    "ct_payout_redemption": """SELECT block_number, transaction_index, transaction_hash, log_index, holder AS redeemer, substr(SHA['usd'], 1, 40) AS collateral_token, repeat('0', 64) AS parent_collection_id,
  condition_id, '["1", "2"]' AS index_sets, amount AS payout FROM position_moves WHERE flag = 'R' AND kind <> 0""",
    "nr_position_split": """SELECT block_number, transaction_index, transaction_hash, log_index, holder AS stakeholder, condition_id, amount FROM position_moves WHERE flag = 'A' AND kind = 0""",
    "nr_positions_merge": """SELECT block_number, transaction_index, transaction_hash, log_index, holder AS stakeholder, condition_id, amount FROM position_moves WHERE flag = 'N' AND kind = 0""",
    "nr_payout_redemption": """SELECT block_number, transaction_index, transaction_hash, log_index, holder AS redeemer, condition_id, '["' || amount || '", "0"]' AS amounts, amount AS payout FROM position_moves WHERE flag = 'R' AND kind = 0""",
    "positions_converted": """SELECT 84000000 + c_custkey AS block_number, 0 AS transaction_index, SHA['ctx' || CAST(c_custkey AS STR)] AS transaction_hash, 0 AS log_index,
  substr(SHA['addr' || CAST(c_custkey AS STR)], 1, 40) AS stakeholder,
  SHA['mkt' || CASE WHEN c_custkey % 97 = 0 THEN 'none' ELSE 'Brand#' || CAST(1 + c_custkey % 5 AS STR) END] AS market_id,
  CAST(1 + c_custkey % 7 AS STR) AS index_set, CAST(c_custkey * 1000000 AS STR) AS amount FROM customer WHERE c_nationkey < 10""",
    "question_initialized": """SELECT block_number, transaction_index, transaction_hash, 12 AS log_index, question_id, 1700000000 + p_partkey AS request_timestamp, oracle AS creator,
  '0x' || lower(hex('title: ' || p_name)) AS ancillary_data, substr(SHA['usd'], 1, 40) AS reward_token, CAST(5000000 + p_partkey AS STR) AS reward, '500000000' AS proposal_bond
FROM parts WHERE p_partkey % 3 <> 0""",
    "question_resolved": """SELECT 85000000 + (p_partkey % 1000) * 1000 AS block_number, transaction_index, SHA['utx' || CAST(p_partkey AS STR)] AS transaction_hash, 0 AS log_index, question_id,
  CASE WHEN p_partkey % 4 = 0 THEN '1000000000000000000' WHEN p_partkey % 4 = 1 THEN '0' WHEN p_partkey % 4 = 2 THEN '500000000000000000'
    ELSE '-57896044618658097711785492504343953926634992332820282019728792003956564819968' END AS settled_price,
  CASE WHEN p_partkey % 2 = 0 THEN '["1", "0"]' ELSE '["0", "1"]' END AS payouts FROM parts WHERE p_partkey % 3 <> 0 AND p_size <= 30""",
    "question_reset": """SELECT block_number + 50 AS block_number, 0 AS transaction_index, SHA['qr' || CAST(p_partkey AS STR)] AS transaction_hash, 0 AS log_index, question_id FROM parts WHERE p_partkey % 11 = 1""",
    "question_flagged": """SELECT block_number + 60 AS block_number, 0 AS transaction_index, SHA['qf' || CAST(p_partkey AS STR)] AS transaction_hash, 0 AS log_index, question_id FROM parts WHERE p_partkey % 13 = 1""",
    "question_emergency_resolved": """SELECT block_number + 70 AS block_number, 0 AS transaction_index, SHA['qe' || CAST(p_partkey AS STR)] AS transaction_hash, 0 AS log_index, question_id, '["1", "1"]' AS payouts FROM parts WHERE p_partkey % 17 = 1""",
    "ranges": """SELECT event_id * 7919 AS from_block, event_id * 7919 + CASE WHEN event_id % 100 = 0 THEN 395949 WHEN event_id % 350 = 50 THEN 500000 ELSE 120000 END AS to_block
FROM events WHERE event_id % 50 = 0""",
    "confirmed": """SELECT event_id AS arrival_seq, event_id * 400 AS arrival_ms, 90000000 + CAST((event_id - event_id % 5) / 5 AS BIGINT) - CASE WHEN event_id % 503 = 502 THEN 3 ELSE 0 END AS block_number,
  SHA['feed' || CAST(event_id - event_id % 2 AS STR)] AS tx_hash FROM events WHERE event_id % 29 <> 2""",
    "settlements": """SELECT event_id * 400 - (event_id * 37) % 4000 + CASE WHEN event_id % 61 = 7 THEN 6000 ELSE 0 END AS arrival_ms, SHA['feed' || CAST(event_id - event_id % 2 AS STR)] AS tx_hash,
  CASE WHEN event_id % 4 = 0 THEN 'confirmed' ELSE 'pending' END AS status FROM events WHERE event_id % 20 NOT IN (2, 3)
UNION ALL SELECT event_id * 400, SHA['orphan' || CAST(event_id AS STR)], 'pending' FROM events WHERE event_id % 33 = 1""",
}

_NAMES = re.compile(r"\b(FROM|JOIN)\s+(\w+)")


def _dialect(sql: str, sha: str, days: str, text: str) -> str:
    sql = re.sub(r"SHA\[([^\]]*)\]", lambda m: sha.format(m[1]), sql)
    sql = re.sub(r"DAYS\[([^\]]*)\]", lambda m: days.format(m[1]), sql)
    return re.sub(r"\bSTR\b", text, sql)


def needed(*names: str) -> list[str]:
    """Recipes that these hang on, each after those it reads."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in RECIPES and n not in out:
            for _, m in _NAMES.findall(RECIPES[n]):
                visit(m)
            out.append(n)

    for n in names:
        visit(n)
    return out


def duck(query: str) -> str:
    """A DuckDB query over recipes by name, with the recipes as common table expressions."""
    names = needed(*(n for n in RECIPES if re.search(rf"\b{n}\b", query)))
    ctes = ", ".join(f"{n} AS ({_dialect(RECIPES[n], 'sha256({})', "date_diff('day', DATE '1992-01-01', {})", 'varchar')})" for n in names)
    head, _, tail = query.partition("WITH ")
    return f"WITH {ctes}, {tail}" if not head.strip() and tail else f"WITH {ctes} {query}"


_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")


#: Fills whose rows are made and sorted in one task.
ROWS = 250_000


class Tables:
    """Recipes and driver tables as DataFrames by name.

    The recipe `fills`, from which most tables follow row by row, is made in two steps: its numbers, and of them its ids. Only
    numbers are joined, ordered and dealt out, as ids are four times as long and don't compress. `dealt` deals the numbers out by
    contract and partition of 10,000 blocks, so that rows made of them are written where they are; `kept` (and `dealt` before it
    deals them out) writes them once, for queries that read many tables of them."""

    def __init__(self, spark: SparkSession, sf_dir: str, how: str = ""):
        self.spark, self.dir, self.how, self.made = spark, sf_dir, how, {}

    def dealt(self) -> Tables:
        return Tables(self.spark, self.dir, "dealt")

    def kept(self) -> Tables:
        return Tables(self.spark, self.dir, "kept")

    def _numbers(self) -> DataFrame:
        rows = self["lineitem"].join(self["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_ORDER)) - 1
        block = F.lit(83_000_000) + F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")) * 1000 + F.col("o_orderkey") % 1000
        rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "o_custkey", "l_suppkey", place.alias("log_index"), block.alias("block_number"), "l_quantity", "l_extendedprice", "l_tax")
        amounts = (F.col("l_quantity") * 1000000).cast("long").alias("token_amt"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("usd_amt"), F.round(F.col("l_tax") * F.col("l_extendedprice") * 100).cast("long").alias("fee_amt")
        return rows.select(((F.col("l_partkey") % 3 == 0) & (F.col("l_orderkey") % 499 != 1)).alias("nr"), *rows.columns[:8], *amounts)

    def _fills(self) -> DataFrame:
        rows = materialize(self._numbers(), "fills") if self.how else self._numbers()  # as a table they take a third of the exchange before
        if self.how == "dealt":
            # in an array, as a whole: so all tables made of it share one exchange
            keys = F.col("nr"), (F.col("block_number") - F.col("block_number") % 10_000).alias("k")
            # numbers are small where the rows made of them are large: so tasks are by rows, and sort without spilling
            tasks = 1 + self["lineitem"].count() // ROWS
            rows = rows.select(*keys, F.array(F.struct("*")).alias("rows")).repartition(tasks, "nr", "k").select(F.inline("rows"))
        text = lambda c: F.col(c).cast("string")
        return rows.select(
            F.when(F.col("nr"), "NegRiskCtfExchange").otherwise("CTFExchange").alias("contract"), "block_number", (F.col("l_orderkey") % 200).alias("transaction_index"),
            F.sha2(F.concat(F.lit("tx"), text("l_orderkey")), 256).alias("transaction_hash"), "log_index", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "o_custkey", "l_suppkey",
            F.sha2(F.concat(F.lit("tok"), text("l_partkey"), F.lit("-"), (F.col("l_suppkey") % 2).cast("string")), 256).alias("token_id"), "token_amt", "usd_amt", "fee_amt",
        )

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            if name == "fills":
                self.made[name] = self._fills()
            elif name in RECIPES:
                sql = _dialect(RECIPES[name], "sha2({}, 256)", "datediff({}, DATE'1992-01-01')", "string")
                reads = {m for _, m in _NAMES.findall(sql)}
                sql = _NAMES.sub(lambda m: f"{m[1]} {{{m[2]}}}", sql)
                self.made[name] = self.spark.sql(sql, **{r: self[r] for r in reads})
            else:
                self.made[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self.made[name]
