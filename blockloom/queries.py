"""Registered queries of the event engine and the DuckDB SQL each is held against, on tables derived from the driver's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import u256 as U
from .operators import checks as C
from .operators import decode as D
from .operators import derive as G
from .operators import ranges as R
from .plans.catalog import COMMON, EVENTS, TABLES
from .plans.fixtures import Tables, duck
from .sources import export as X
from .sources import scan as S
from .sources.shared import materialize, shared_path
from .streaming import feed as H
from .streaming import live as L

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
Z = f"'{C.ZERO}'"


def _add(name: str, f: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
    if sql:
        ORACLE_SQL[name] = duck(sql)


# Checks (2F). F1 and F29 read the feed with replays and short addresses.


class _Replay:
    def __init__(self, t: Tables):
        self.t = t

    def __getitem__(self, name: str) -> DataFrame:
        return self.t["order_filled_replay" if name == "order_filled" else name]


_MOVES = {e: f"(SELECT * FROM ct_{e} UNION ALL BY NAME SELECT * FROM nr_{e})" for e in ("position_split", "positions_merge", "payout_redemption")}
_REGISTERED = "(SELECT token0 AS token_id FROM token_registered UNION SELECT token1 FROM token_registered)"


def _traded(table: str, where: str = "TRUE") -> str:
    return f"(SELECT maker_asset_id AS token_id FROM {table} WHERE {where} AND maker_asset_id <> {Z} UNION SELECT taker_asset_id FROM {table} WHERE {where} AND taker_asset_id <> {Z})"


_ON_CTF, _ON_NEG_RISK = "contract = 'CTFExchange'", "contract = 'NegRiskCtfExchange'"


def _anti(column: str, table: str, other: str, key: str) -> str:
    return f"SELECT DISTINCT {column} FROM {table} a WHERE NOT EXISTS (SELECT 1 FROM {other} b WHERE b.{key} = a.{column})"


_PRICE = f"""(SELECT transaction_hash, log_index, CASE WHEN maker_asset_id = {Z} THEN CAST(maker_amount_filled AS DOUBLE) / NULLIF(CAST(taker_amount_filled AS DOUBLE), 0)
  ELSE CAST(taker_amount_filled AS DOUBLE) / NULLIF(CAST(maker_amount_filled AS DOUBLE), 0) END AS price FROM order_filled WHERE (maker_asset_id = {Z}) <> (taker_asset_id = {Z}))"""
_SQL = {
    "f1_blob_lengths": " UNION ALL ".join(
        f"SELECT '{e}' AS event, transaction_hash, log_index, '{c}' AS column_name, length({c}) // 2 AS n_bytes FROM {'order_filled_replay' if e == 'order_filled' else e} WHERE length({c}) // 2 <> {n}"
        for e, cols in C.BLOBS.items() for c, n in cols.items()
    ),
    "f2_amounts_parse": " UNION ALL ".join(
        f"SELECT '{e}' AS event, '{c}' AS column_name, {c} AS value, count(*) AS n FROM {_MOVES.get(e, e)} WHERE TRY_CAST({c} AS HUGEINT) IS NULL OR TRY_CAST({c} AS HUGEINT) < 0 GROUP BY {c}"
        for e, cols in C.AMOUNTS.items() for c in cols
    ),
    "f3_symmetric_pairs": "SELECT token0, token1 FROM token_registered a WHERE NOT EXISTS (SELECT 1 FROM token_registered b WHERE b.token0 = a.token1 AND b.token1 = a.token0)",
    "f4_resolution_prepared": _anti("condition_id", "condition_resolution", "condition_preparation", "condition_id"),
    "f5_payout_sums": """SELECT condition_id, block_number, payout_numerators FROM (SELECT *, CAST(json_extract_string(payout_numerators, '$[0]') AS HUGEINT) AS a, CAST(json_extract_string(payout_numerators, '$[1]') AS HUGEINT) AS b
        FROM condition_resolution WHERE json_array_length(payout_numerators) = 2) WHERE a + b <= 0 OR a < 0 OR b < 0""",
    "f6a_converted_has_questions": _anti("market_id", "positions_converted", "question_prepared", "market_id"),
    "f6b_reachable_has_condition": """SELECT DISTINCT market_id, question_id FROM question_prepared q WHERE EXISTS (SELECT 1 FROM positions_converted p WHERE p.market_id = q.market_id)
        AND NOT EXISTS (SELECT 1 FROM condition_preparation c WHERE c.question_id = q.question_id)""",
    "f7_exchanges_disjoint": f"SELECT token_id FROM {_traded('order_filled', _ON_CTF)} INTERSECT SELECT token_id FROM {_traded('order_filled', _ON_NEG_RISK)}",
    "f8_fee_tokens_registered": f"SELECT DISTINCT token_id FROM fee_charged WHERE token_id <> {Z} AND token_id NOT IN (SELECT token_id FROM {_REGISTERED})",
    "f9_fee_reconciliation": """WITH p AS (SELECT transaction_hash, sum(CAST(fee AS HUGEINT)) AS s FROM order_filled GROUP BY 1), c AS (SELECT transaction_hash, sum(CAST(amount AS HUGEINT)) AS s FROM fee_charged GROUP BY 1)
        SELECT p.transaction_hash, CAST(p.s AS VARCHAR) AS fill_fee, CAST(coalesce(c.s, 0) AS VARCHAR) AS charged_fee FROM p LEFT JOIN c USING (transaction_hash) WHERE p.s <> coalesce(c.s, 0)""",
    "f9b_fees_without_table": """SELECT contract, transaction_hash, CAST(sum(CAST(fee AS HUGEINT)) AS VARCHAR) AS fill_fee FROM order_filled o
        WHERE NOT EXISTS (SELECT 1 FROM fee_charged f WHERE f.contract = o.contract AND f.block_number // 10000 = o.block_number // 10000) GROUP BY 1, 2 HAVING sum(CAST(fee AS HUGEINT)) <> 0""",
    "f11_refund_identity": """WITH r AS (SELECT transaction_hash, order_hash, sum(CAST(refund AS HUGEINT) + CAST(fee_charged AS HUGEINT)) AS net, count(*) AS n_refunds FROM fee_refunded GROUP BY 1, 2),
        g AS (SELECT transaction_hash, order_hash, sum(CAST(fee AS HUGEINT)) AS gross, count(*) AS n_fills FROM order_filled WHERE transaction_hash IN (SELECT transaction_hash FROM fee_refunded) GROUP BY 1, 2)
        SELECT transaction_hash, order_hash, CAST(gross AS VARCHAR) AS gross, CAST(net AS VARCHAR) AS net, n_fills, n_refunds FROM g FULL JOIN r USING (transaction_hash, order_hash) WHERE gross IS DISTINCT FROM net OR n_fills IS DISTINCT FROM n_refunds""",
    "f12_questions_have_market": _anti("market_id", "question_prepared", "market_prepared", "market_id"),
    "f13_fill_after_cancel": "SELECT f.order_hash, f.block_number AS fill_block, f.transaction_hash, f.log_index, c.block_number AS cancel_block FROM order_filled f JOIN order_cancelled c USING (order_hash) WHERE f.block_number > c.block_number",
    "f14_trading_after_resolution": """WITH k AS (SELECT token0 AS token_id, c.block_number AS b FROM condition_resolution c JOIN token_registered t USING (condition_id) UNION ALL SELECT token1, c.block_number FROM condition_resolution c JOIN token_registered t USING (condition_id))
        SELECT transaction_hash, block_number AS fill_block, b AS resolution_block, token_id FROM order_filled o JOIN k ON o.maker_asset_id = k.token_id AND o.block_number > k.b + 100
        UNION SELECT transaction_hash, block_number, b, token_id FROM order_filled o JOIN k ON o.taker_asset_id = k.token_id AND o.block_number > k.b + 100""",
    "f15_amounts_positive": "SELECT transaction_hash, log_index, maker_amount_filled, taker_amount_filled FROM order_filled WHERE CAST(maker_amount_filled AS HUGEINT) = 0 OR CAST(taker_amount_filled AS HUGEINT) = 0",
    "f16_price_in_range": f"SELECT * FROM {_PRICE} WHERE price IS NULL OR price <= 0",
    "f16w_price_warning": f"SELECT * FROM {_PRICE} WHERE price >= 1",
    "f17_one_collateral_side": f"SELECT transaction_hash, log_index, maker_asset_id, taker_asset_id FROM order_filled WHERE NOT ((maker_asset_id = {Z}) <> (taker_asset_id = {Z}))",
    "f18_taker_matches_summary": """SELECT f.transaction_hash, f.order_hash, f.maker_amount_filled, f.taker_amount_filled, m.maker_amount_filled AS summary_maker, m.taker_amount_filled AS summary_taker FROM order_filled f JOIN orders_matched m
        ON f.contract = m.contract AND f.block_number // 1000000 = m.block_number // 1000000 AND f.transaction_hash = m.transaction_hash AND f.order_hash = m.taker_order_hash WHERE f.maker_amount_filled <> m.maker_amount_filled OR f.taker_amount_filled <> m.taker_amount_filled""",
    "f19_fill_tokens_registered": f"SELECT token_id FROM {_traded('order_filled')} WHERE token_id NOT IN (SELECT token_id FROM {_REGISTERED})",
    "f20_maker_filled_once": """SELECT f.contract, f.transaction_hash, f.order_hash, count(*) AS n FROM order_filled f JOIN orders_matched m ON f.contract = m.contract AND f.block_number // 1000000 = m.block_number // 1000000 AND f.transaction_hash = m.transaction_hash
        WHERE f.order_hash <> m.taker_order_hash GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "f21_matched_tokens_registered": f"SELECT token_id FROM {_traded('orders_matched')} WHERE token_id NOT IN (SELECT token_id FROM {_REGISTERED})",
    "f22_outcome_has_question": _anti("question_id", "outcome_reported", "question_prepared", "question_id"),
    "f23_outcome_is_bool": "SELECT question_id, outcome FROM outcome_reported WHERE outcome NOT IN (0, 1)",
    "f24_redemption_resolved": f"SELECT DISTINCT condition_id FROM {_MOVES['payout_redemption']} r WHERE condition_id IN (SELECT condition_id FROM condition_preparation) AND condition_id NOT IN (SELECT condition_id FROM condition_resolution)",
    "f25_token_in_one_condition": "SELECT token_id, count(DISTINCT condition_id) AS n FROM (SELECT token0 AS token_id, condition_id FROM token_registered UNION ALL SELECT token1, condition_id FROM token_registered) GROUP BY 1 HAVING count(DISTINCT condition_id) > 1",
    "f26_registered_before_trade": f"""WITH f AS (SELECT maker_asset_id AS token_id, min(block_number) AS b FROM order_filled WHERE maker_asset_id <> {Z} GROUP BY 1 UNION ALL SELECT taker_asset_id, min(block_number) FROM order_filled WHERE taker_asset_id <> {Z} GROUP BY 1),
        r AS (SELECT token0 AS token_id, min(block_number) AS b FROM token_registered GROUP BY 1 UNION ALL SELECT token1, min(block_number) FROM token_registered GROUP BY 1)
        SELECT token_id, f.b AS first_fill, coalesce(r.b, -1) AS first_registration FROM f LEFT JOIN r USING (token_id) WHERE r.b IS NULL OR f.b <= r.b""",
    "f27_registered_prepared": _anti("condition_id", "token_registered", "condition_preparation", "condition_id"),
    "f28_registration_valid": f"SELECT transaction_hash, log_index, condition_id FROM token_registered WHERE condition_id IS NULL OR length(condition_id) <> 64 OR condition_id = {Z}",
    "f29_unique_log_keys": "SELECT contract, event, count(*) AS duplicates FROM (" + " UNION ALL ".join(
        f"""SELECT {"contract" if len(e.contracts) > 1 else "''"} AS contract, '{k}' AS event FROM {"order_filled_replay" if k == "order_filled" else k}
        GROUP BY 1, 2, block_number // 1000000, transaction_hash, log_index HAVING count(*) > 1""" for k, e in EVENTS.items()
    ) + ") GROUP BY 1, 2",
}
_ON_REPLAY = ("f1_blob_lengths", "f29_unique_log_keys")
for _name, (_check, _, _) in C.CHECKS.items():
    _add(_name, (lambda c, n: lambda t: c(_Replay(t) if n in _ON_REPLAY else t))(_check, _name), _SQL[_name])


def _status(n: str) -> str:
    _, expectation, tolerance = C.CHECKS[n]
    fine, bad = ("unexpected pass", "expected failure") if expectation == "expected" else ("pass", "fail")
    return f"""SELECT '{n}' AS check_name, count(*) AS violations, '{expectation}' AS expectation, {tolerance} AS tolerance,
        CASE WHEN count(*) <= {tolerance} THEN '{fine}' ELSE '{bad}' END AS status FROM ({_SQL[n]})"""


def _report(t: Tables) -> DataFrame:
    """The numbers of the fills are written once for all checks, which are run one after the other."""
    t = t.kept()
    return C.report(t, instead=dict.fromkeys(_ON_REPLAY, _Replay(t)), apart=True)


_add("f0_report", _report, " UNION ALL ".join(map(_status, C.CHECKS)))


def _known(t: Tables) -> DataFrame:
    """the refunds of every transaction against those its fills lead to expect."""
    fee = F.col("fee").cast("long")
    want = t["order_filled"].select("transaction_hash", "order_hash", (fee - fee % 1000).cast("string").alias("refund"), (fee % 1000).cast("string").alias("fee_charged"))
    return C.expected_rows(t["fee_refunded"].select("transaction_hash", "order_hash", "refund", "fee_charged"), want, "transaction_hash")


_WANT = "SELECT transaction_hash, order_hash, CAST(CAST(fee AS BIGINT) - CAST(fee AS BIGINT) % 1000 AS VARCHAR) AS refund, CAST(CAST(fee AS BIGINT) % 1000 AS VARCHAR) AS fee_charged FROM order_filled WHERE transaction_hash IN (SELECT transaction_hash FROM fee_refunded)"
_HAVE = "SELECT transaction_hash, order_hash, refund, fee_charged FROM fee_refunded"
_add("f10_known_refunds", _known, f"SELECT *, 'extra' AS problem FROM ({_HAVE} EXCEPT ALL {_WANT}) UNION ALL SELECT *, 'missing' FROM ({_WANT} EXCEPT ALL {_HAVE})")

# Derivations (2G)
_add("g1_implied_price", lambda t: G.implied_price(t["order_filled"]), f"SELECT transaction_hash, log_index, CASE WHEN maker_asset_id = {Z} THEN taker_asset_id ELSE maker_asset_id END AS token_id, CASE WHEN maker_asset_id = {Z} THEN 'buy' ELSE 'sell' END AS side, CASE WHEN maker_asset_id = {Z} THEN CAST(maker_amount_filled AS DOUBLE) / NULLIF(CAST(taker_amount_filled AS DOUBLE), 0) ELSE CAST(taker_amount_filled AS DOUBLE) / NULLIF(CAST(maker_amount_filled AS DOUBLE), 0) END AS price FROM order_filled WHERE (maker_asset_id = {Z}) <> (taker_asset_id = {Z})")
_add("g2_payout_fractions", lambda t: G.payout_fractions(t["condition_resolution"]), """WITH x AS (SELECT condition_id, CAST(json_extract_string(payout_numerators, '$[0]') AS HUGEINT) AS a, CAST(json_extract_string(payout_numerators, '$[1]') AS HUGEINT) AS b FROM condition_resolution)
    SELECT condition_id, 0 AS outcome, CAST(a AS VARCHAR) AS numerator, CAST(a AS DOUBLE) / NULLIF(CAST(a + b AS DOUBLE), 0) AS fraction, a = b AS is_draw FROM x UNION ALL SELECT condition_id, 1, CAST(b AS VARCHAR), CAST(b AS DOUBLE) / NULLIF(CAST(a + b AS DOUBLE), 0), a = b FROM x""")
_add("g3_converted_market_conditions", lambda t: G.converted_market_conditions(t["positions_converted"], t["question_prepared"], t["condition_preparation"]), "SELECT p.transaction_hash, p.market_id, q.question_id, q.index_val, c.condition_id, c.outcome_slot_count FROM positions_converted p JOIN question_prepared q USING (market_id) JOIN condition_preparation c USING (question_id)")
_add("g4_outcome_conditions", lambda t: G.outcome_conditions(t["outcome_reported"], t["condition_preparation"]), "SELECT o.question_id, c.condition_id, o.outcome, o.block_number FROM outcome_reported o JOIN condition_preparation c USING (question_id)")
_add("g5_net_fees", lambda t: G.net_fees(t["order_filled"], t["fee_refunded"]), """WITH r AS (SELECT transaction_hash, order_hash, sum(CAST(refund AS HUGEINT)) AS r FROM fee_refunded GROUP BY 1, 2)
    SELECT transaction_hash, log_index, order_hash, CAST(CAST(fee AS HUGEINT) AS VARCHAR) AS gross_fee, CAST(coalesce(r, 0) AS VARCHAR) AS refund, CAST(CAST(fee AS HUGEINT) - coalesce(r, 0) AS VARCHAR) AS net_fee FROM order_filled LEFT JOIN r USING (transaction_hash, order_hash)""")
_add("g6_token_conditions", lambda t: G.token_conditions(t["token_registered"]), "SELECT token0 AS token_id, condition_id FROM token_registered UNION SELECT token1, condition_id FROM token_registered")
_add("g7_narrow_amounts", lambda t: G.narrow_amounts(t["order_filled"], ["maker_amount_filled", "taker_amount_filled", "fee"]).select("transaction_hash", "log_index", "maker_amount_filled", "taker_amount_filled", "fee"), "SELECT transaction_hash, log_index, CAST(maker_amount_filled AS BIGINT) AS maker_amount_filled, CAST(taker_amount_filled AS BIGINT) AS taker_amount_filled, CAST(fee AS BIGINT) AS fee FROM order_filled")

# Ranges (2E). The recipe's ranges are bounded below by 0 and reach to the scale of the events table.
_HEAD = 90_000_000
_MERGED = """m AS (SELECT min(from_block) AS from_block, max(to_block) AS to_block FROM (SELECT *, sum(s) OVER (ORDER BY from_block, to_block) AS g FROM
    (SELECT *, CASE WHEN from_block <= max(to_block) OVER (ORDER BY from_block, to_block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS s FROM {0})) GROUP BY g)"""
_M = "WITH " + _MERGED.format("ranges")


def _gaps(start: int, end: int) -> str:
    c = f"c AS (SELECT greatest(from_block, {start}) AS f, least(to_block, {end}) AS t FROM m WHERE to_block >= {start} AND from_block <= {end})"
    return f"""{c}, g AS (SELECT coalesce(lag(t) OVER (ORDER BY f), {start - 1}) + 1 AS from_block, f - 1 AS to_block FROM c UNION ALL SELECT coalesce(max(t), {start - 1}) + 1, {end} FROM c),
        gaps AS (SELECT from_block, to_block FROM g WHERE from_block <= to_block)"""


_add("e1_merge_ranges", lambda t: R.merge_ranges(t["ranges"]), _M + " SELECT * FROM m")
_add("e2_add_range", lambda t: R.add_range(t["ranges"], 100_000, 900_000), "WITH a AS (SELECT * FROM ranges UNION ALL SELECT 100000, 900000), " + _MERGED.format("a") + " SELECT * FROM m")
_add("e3_find_gaps", lambda t: R.find_gaps(t["ranges"], 50_000, _HEAD), f"{_M}, {_gaps(50_000, _HEAD)} SELECT * FROM gaps")
_add("e4_complete_10k", lambda t: R.complete_10k(t["ranges"]), _M + " SELECT unnest(range((from_block + 9999) // 10000 * 10000, to_block - 9998, 10000)) AS partition_start FROM m")
_PLAIN = ("order_filled", "fee_charged", "token_registered", "condition_resolution", "positions_converted", "outcome_reported")
_add("e5_tables_with_rows", lambda t: R.tables_with_rows({n: t[n] for n in _PLAIN}, 84_000_000, 84_999_999), " UNION ALL ".join(f"SELECT DISTINCT '{n}' AS table_name FROM {n} WHERE block_number BETWEEN 84000000 AND 84999999" for n in _PLAIN))
_add("e6_slice_ranges", lambda t: R.slice_ranges(t["ranges"], 45_000), _M + ", s AS (SELECT unnest(range(from_block, to_block + 1, 45000)) AS from_block, to_block FROM m) SELECT from_block, least(from_block + 44999, to_block) AS to_block FROM s")
_add("e7_migrate_progress", lambda t: R.migrate_progress(t["order_filled"].groupBy("contract").agg(F.max("block_number").alias("last_complete_block")), t["ranges"].where("from_block < 0")), "SELECT CAST(0 AS BIGINT) AS from_block, min(b) AS to_block FROM (SELECT contract, max(block_number) AS b FROM order_filled GROUP BY 1) HAVING min(b) > 0")
_add("e8_coverage", lambda t: R.coverage(t["ranges"], _HEAD), f"""{_M}, {_gaps(0, _HEAD)} SELECT CAST((SELECT coalesce(sum(to_block - from_block + 1), 0) FROM m) AS BIGINT) AS covered_blocks, CAST((SELECT coalesce(sum(to_block - from_block + 1), 0) FROM gaps) AS BIGINT) AS gap_blocks, (SELECT count(*) FROM gaps) AS gaps,
    greatest({_HEAD} - (SELECT max(to_block) FROM m), 0) AS blocks_behind, greatest({_HEAD} - (SELECT max(to_block) FROM m), 0) * 2 AS seconds_behind""")
_add("e9_event_counts", lambda t: R.event_counts({n: t[n] for n in _PLAIN}), "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _PLAIN) + ") WHERE n > 0")

# Decoding (2C): each event table is encoded to logs and decoded again; the oracle is the table itself.
_NUMBER = "^[0-9]+$"


def _source(t: Tables, key: str) -> DataFrame:
    """The event's table with the rows that an unsigned amount can encode."""
    df = t[key]
    df = df.withColumnRenamed("partition_sets", "partition") if "partition_sets" in df.columns else df
    for f in EVENTS[key].fields:
        if f.name in ("amount", "payout"):
            df = df.where(F.col(f.name).rlike(_NUMBER))
    return df


def _plain(kind: str, c: Column) -> Column:
    """Decoded values in the form of the tables: ids in hex without 0x, arrays without spaces."""
    if kind in ("b32", "addr"):
        return U.strip0x(c)
    return U.u256_hex(c) if kind == "token" else c


def _decoded(t: Tables, key: str) -> DataFrame:
    d = D.decode(D.encode(_source(t, key), key), key)
    return d.select("contract", "block_number", "transaction_index", U.strip0x(F.col("transaction_hash")).alias("transaction_hash"), "log_index", *(_plain(f.kind, F.col(f.name)).alias(f.name) for f in EVENTS[key].fields))


def _decoded_sql(key: str) -> str:
    e, out, where = EVENTS[key], [], ["TRUE"]
    for f in e.fields:
        c = "partition_sets" if f.name == "partition" else f.name
        out.append(f"replace({c}, ' ', '') AS {f.name}" if f.kind == "u256[]" else f"CAST(TRY_CAST({c} AS HUGEINT) AS VARCHAR) AS {f.name}" if f.kind == "u256" else f"CAST({c} AS BIGINT) AS {f.name}" if f.kind == "u32" else f"{c} AS \"{f.name}\"")
        if f.name in ("amount", "payout"):
            where.append(f"regexp_full_match({c}, '[0-9]+')")
    contract = "contract" if len(e.contracts) > 1 else f"'{e.contracts[0]}' AS contract"
    cols = ["CAST(block_number AS BIGINT) AS block_number", "CAST(transaction_index AS BIGINT) AS transaction_index", "transaction_hash", "CAST(log_index AS BIGINT) AS log_index"]
    return f"SELECT {', '.join([contract, *cols, *out])} FROM {key} WHERE {' AND '.join(where)}"


for _i, _key in enumerate(EVENTS, 1):
    _add(f"c{_i:02d}_decode_{_key}", (lambda k: lambda t: _decoded(t, k))(_key), _decoded_sql(_key))



def _raw(t: Tables, dealt: bool = False) -> DataFrame:
    """Logs of all events, the numbers of the fills written once for all of them (and `dealt` out by partition)."""
    out, t = None, t.dealt() if dealt else t.kept()
    for k in EVENTS:
        r = D.encode(_source(t, k), k)
        out = r if out is None else out.unionAll(r)
    return out


def _broken(t: Tables, dealt: bool = False) -> DataFrame:
    """The logs with some spoilt, by block: unknown or no topics, data cut short, letters that are no hex, topics missing."""
    b, raw = U.parse_hex(F.col("blockNumber")) % 97, _raw(t, dealt)
    topics = F.when(b == 1, F.array().cast("array<string>")).when(b == 2, F.array(F.lit("0x" + "12" * 32))).when(b == 3, F.slice("topics", 1, 1)).otherwise(F.col("topics"))
    data = F.when(b == 4, F.substr(F.col("data"), F.lit(1), F.lit(60))).when(b == 5, F.concat(F.lit("0xzz"), F.substr(F.col("data"), F.lit(5)))).otherwise(F.col("data"))
    return raw.withColumns({"topics": topics, "data": data})


_TOKENS = sorted({f.name for e in EVENTS.values() for f in e.fields if f.kind == "token"})


def _values(decoded: DataFrame) -> DataFrame:
    """Decoded logs with their values in the order of the fields; token ids in hex, as the tables have them."""
    keys = "event", "contract", "block_number", "log_index", U.strip0x(F.col("transaction_hash")).alias("transaction_hash")
    # a generator keeps the optimizer from parsing the fields anew for each value
    rows = decoded.select(F.inline(F.array(F.struct(*keys, F.from_json("fields", "map<string,string>").alias("v")))))
    ids = U.u256_hexes(F.transform(F.map_entries("v"), lambda x: F.when(x["key"].isin(_TOKENS), x["value"])))
    return rows.withColumn("ids", ids).select(*keys[:4], "transaction_hash", F.array_join(F.zip_with("ids", F.map_values("v"), lambda i, v: F.coalesce(i, v)), "|").alias("field_values"))


def _spoilt(key: str) -> str:
    return "3, 4, 5" if EVENTS[key].words else "3"  # without data words there is nothing to spoil but topics


def _values_sql() -> str:
    each = []
    for k, e in EVENTS.items():
        vals = ", ".join(f"""'0x' || "{f.name}\"""" if f.kind in ("b32", "addr") else f'CAST("{f.name}" AS VARCHAR)' for f in e.fields)
        each.append(f"""SELECT '{k}' AS event, contract, block_number, log_index, transaction_hash, concat_ws('|', {vals}) AS field_values
        FROM ({_decoded_sql(k)}) WHERE block_number % 97 NOT IN (1, 2, {_spoilt(k)})""")
    return " UNION ALL ".join(each)


def _undecodable_sql() -> str:
    reason = "CASE block_number % 97 WHEN 3 THEN 'missing topic' WHEN 4 THEN 'short or bad data' ELSE 'bad hex' END AS reason"
    return " UNION ALL ".join(
        f"SELECT '{k}' AS event, block_number, log_index, transaction_hash, {reason} FROM ({_decoded_sql(k)}) WHERE block_number % 97 IN ({_spoilt(k)})" for k in EVENTS
    )


_add("c24_decode_all", lambda t: _values(D.decode_all(_broken(t))), _values_sql())
_add(
    "c25_undecodable",
    lambda t: D.undecodable(_broken(t)).select("event", "block_number", "log_index", U.strip0x(F.col("transaction_hash")).alias("transaction_hash"), "reason"),
    _undecodable_sql(),
)

# Conversions (2D) over whole tables
_F = "order_filled"
_add("d1_hex_to_b32", lambda t: t[_F].select("transaction_hash", "log_index", F.hex(U.hex_to_binary(F.concat(F.lit("0x"), F.substr("order_hash", F.lit(1), F.lit(60))), 32)).alias("v")), "SELECT transaction_hash, log_index, upper(lpad(substr(order_hash, 1, 60), 64, '0')) AS v FROM order_filled")
_add("d2_hex_to_b20", lambda t: t[_F].select("transaction_hash", "log_index", F.hex(U.hex_to_binary(F.concat(F.lit("0x"), F.substr("maker", F.lit(1), F.lit(38))), 20)).alias("v")), "SELECT transaction_hash, log_index, upper(lpad(substr(maker, 1, 38), 40, '0')) AS v FROM order_filled")
_WIDE = "repeat('7', 3) || maker_amount_filled || lpad(taker_amount_filled, 15, '0')"
_add("d3_dec_to_b32", lambda t: t[_F].select("transaction_hash", "log_index", F.lower(F.hex(U.dec_to_b32(F.expr(_WIDE)))).alias("v")), f"SELECT transaction_hash, log_index, lpad(lower(hex(CAST({_WIDE} AS HUGEINT))), 64, '0') AS v FROM order_filled")
_add("d4_to_u32", lambda t: t[_F].select("transaction_hash", "log_index", U.to_u32(F.col("taker_amount_filled").cast("long") * 1000).alias("v")), "SELECT transaction_hash, log_index, (CAST(taker_amount_filled AS BIGINT) * 1000) & 4294967295 AS v FROM order_filled")
_add("d5_parse_hex", lambda t: t[_F].select("transaction_hash", "log_index", U.parse_hex(F.concat(F.lit("0x"), F.lower(F.hex(F.col("block_number"))))).alias("v")), "SELECT transaction_hash, log_index, CAST(block_number AS BIGINT) AS v FROM order_filled")
_add("d6_topic_address", lambda t: t[_F].select("transaction_hash", "log_index", U.topic_address(F.concat(F.lit("0x"), F.repeat(F.lit("0"), F.lit(24)), F.upper("maker"))).alias("v")), "SELECT transaction_hash, log_index, '0x' || maker AS v FROM order_filled")
_add("d7_u256_dec", lambda t: t[_F].select("transaction_hash", "log_index", U.u256_dec(U.u256_hex(F.expr(_WIDE))).alias("v")), f"SELECT transaction_hash, log_index, {_WIDE} AS v FROM order_filled")
_add("d8_i256_dec", lambda t: t[_F].select("transaction_hash", "log_index", U.i256_dec(U.i256_hex(F.concat(F.when(F.col("block_number") % 2 == 0, "-").otherwise(""), F.expr(_WIDE)))).alias("v")), f"SELECT transaction_hash, log_index, CASE WHEN block_number % 2 = 0 THEN '-' ELSE '' END || {_WIDE} AS v FROM order_filled")
_add("d9_u256_array_json", lambda t: t[_F].select("transaction_hash", "log_index", U.u256_array_json(F.array(U.u256_hex(F.col("fee")), U.u256_hex(F.expr(_WIDE)))).alias("v")), f"""SELECT transaction_hash, log_index, '["' || fee || '","' || {_WIDE} || '"]' AS v FROM order_filled""")


def _hexed(df: DataFrame) -> DataFrame:
    return df.select(*(F.lower(F.hex(c)).alias(c) if k == "binary" else F.col(c) for c, k in df.dtypes))


_add("d10_typed_projection", lambda t: _hexed(X.typed_projection(t[_F].where("contract = 'CTFExchange'"), "CTFExchange", _F)), "SELECT block_number, transaction_index, transaction_hash, log_index, order_hash, maker, taker, maker_asset_id, taker_asset_id, maker_amount_filled, taker_amount_filled, fee FROM order_filled WHERE contract = 'CTFExchange'")

# Storage (2A, 2B): written below the shared folder and read back
_STORED = ("CTFExchange", "NegRiskCtfExchange")
_COLS = "block_number, transaction_index, transaction_hash, log_index, order_hash, maker, taker, maker_asset_id, taker_asset_id, maker_amount_filled, taker_amount_filled, fee"


def _store(t: Tables, contracts: tuple[str, ...] = _STORED, events: tuple[str, ...] = (_F,)) -> str:
    """The tables of these events, dealt out as numbers and written in one pass."""
    root, t = shared_path(t.spark, "store"), t.dealt()
    X.export_dealt({(c, e): t[e].where(F.col("contract") == c) for c in contracts for e in events}, root, ids_in_hex=True)
    return root


def _rows(df: DataFrame) -> DataFrame:
    return _hexed(df).drop("1M", "10K")


_add("a1_scan_table", lambda t: _rows(S.scan_table(t.spark, _store(t, ("CTFExchange",)), "CTFExchange", _F)), f"SELECT {_COLS} FROM order_filled WHERE contract = 'CTFExchange'")
_add("a2_scan_event", lambda t: _rows(S.scan_event(t.spark, _store(t), _F)), f"SELECT {_COLS}, contract FROM order_filled")
_add("a3_scan_complete", lambda t: _rows(S.scan_complete(t.spark, _store(t), _F, [84_000_000])), f"SELECT {_COLS}, contract FROM order_filled WHERE block_number // 1000000 = 84")
_INV = "inv AS (SELECT DISTINCT contract, '{0}' AS event, block_number // 1000000 * 1000000 AS m, block_number // 10000 * 10000 AS k FROM {0})"
_FULL = "(SELECT m FROM (SELECT contract, m FROM (SELECT DISTINCT contract, block_number // 1000000 * 1000000 AS m, block_number // 10000 AS k FROM {0}) GROUP BY 1, 2 HAVING count(*) = 100) GROUP BY 1 HAVING count(*) = 2)"
_add("a4_complete_1m_ranges", lambda t: S.complete_1m_ranges(S.partition_inventory(t.spark, _store(t)), _F).select(F.col("1M").alias("m")), f"SELECT m FROM {_FULL.format(_F)}")
_add("a5_common_ranges", lambda t: S.common_ranges(S.partition_inventory(t.spark, _store(t, events=(_F, "fee_charged"))), _F, "fee_charged").select(F.col("1M").alias("m")), f"SELECT m FROM {_FULL.format(_F)} INTERSECT SELECT m FROM {_FULL.format('fee_charged')}")


def _all_or(t: Tables) -> DataFrame:
    root = _store(t)
    return _rows(S.scan_complete_or_all(t.spark, root, _F, [1_000_000], S.partition_inventory(t.spark, root)))


_add("a6_scan_complete_or_all", _all_or, f"SELECT {_COLS}, contract FROM order_filled")
_add("a7_sample_ranges", lambda t: S.sample_ranges(t[_F].select((F.col("block_number") - F.col("block_number") % 100_000).alias("1M")), 3).select(F.col("1M").alias("m")), "WITH r AS (SELECT DISTINCT block_number // 100000 * 100000 AS m FROM order_filled) (SELECT m FROM r ORDER BY m LIMIT 3) UNION (SELECT m FROM r ORDER BY m DESC LIMIT 3)")


def _lookup(t: Tables) -> DataFrame:
    one = t[_F].where("contract = 'CTFExchange'").agg(F.min(F.struct("block_number", "transaction_hash")).alias("x")).first()["x"]
    return _rows(S.lookup_tx(t.spark, _store(t, ("CTFExchange",)), "CTFExchange", _F, one["block_number"], one["transaction_hash"]))


_add("a8_lookup_tx", _lookup, f"SELECT {_COLS} FROM order_filled WHERE contract = 'CTFExchange' AND transaction_hash = (SELECT transaction_hash FROM order_filled WHERE contract = 'CTFExchange' ORDER BY block_number, transaction_hash LIMIT 1)")
_add("a9_scan_block_range", lambda t: _rows(S.scan_block_range(t.spark, _store(t, ("CTFExchange",)), "CTFExchange", _F, 84_123_456, 84_654_321)), f"SELECT {_COLS} FROM order_filled WHERE contract = 'CTFExchange' AND block_number BETWEEN 84123456 AND 84654321")


def _landed(t: Tables) -> DataFrame:
    """Half of the logs as lines, half in envelopes."""
    raw, path = _raw(t), shared_path(t.spark, "logs")
    odd = U.parse_hex(F.col("blockNumber")) % 2 == 1
    raw.where(odd).write.mode("append").json(path, compression="gzip")
    raw.where(~odd).select(F.array(F.struct("*")).alias("result")).write.mode("append").json(path, compression="gzip")
    return S.read_raw_logs(t.spark, path)


_LOGS = " UNION ALL ".join(f"SELECT transaction_hash, log_index, block_number, '{EVENTS[k].topic0}' AS topic0 FROM ({_decoded_sql(k)})" for k in EVENTS)
_log_row = lambda df: df.select(U.strip0x(F.col("transactionHash")).alias("transaction_hash"), U.parse_hex(F.col("logIndex")).alias("log_index"), U.parse_hex(F.col("blockNumber")).alias("block_number"), F.get("topics", F.lit(0)).alias("topic0"))
_add("a10_read_raw_logs", lambda t: _log_row(_landed(t)), _LOGS)
_add("a11_filter_logs", lambda t: _log_row(S.filter_logs(_raw(t), [D.CONTRACTS["CTFExchange"], D.CONTRACTS["FeeModuleCTF"].upper()], [EVENTS[_F].topic0], 83_500_000, 84_500_000)), f"SELECT transaction_hash, log_index, block_number, '{EVENTS[_F].topic0}' AS topic0 FROM order_filled WHERE contract = 'CTFExchange' AND block_number BETWEEN 83500000 AND 84500000")
_add("a12_partition_inventory", lambda t: S.partition_inventory(t.spark, _store(t, events=(_F, "fee_charged"))).select("contract", "event", F.col("1M").alias("m"), F.col("10K").alias("k"), "files"), " UNION ALL ".join(f"SELECT contract, '{e}' AS event, block_number // 1000000 * 1000000 AS m, block_number // 10000 * 10000 AS k, CAST(1 AS BIGINT) AS files FROM {e} GROUP BY 1, 2, 3, 4" for e in (_F, "fee_charged")))
_add("b1_export_event", lambda t: _rows(S.scan_table(t.spark, _store(t, ("NegRiskCtfExchange",), ("fee_charged",)), "NegRiskCtfExchange", "fee_charged")), "SELECT block_number, transaction_index, transaction_hash, log_index, receiver, token_id, amount FROM fee_charged WHERE contract = 'NegRiskCtfExchange'")


def _split(t: Tables) -> DataFrame:
    parts = X.split_by_contract(D.encode(t[_F], _F), _F)
    a, b = (df.select(F.lit(c).alias("contract"), U.strip0x(F.col("transactionHash")).alias("transaction_hash"), U.parse_hex(F.col("logIndex")).alias("log_index")) for c, df in parts.items())
    return a.unionAll(b)


_add("b2_split_by_contract", _split, "SELECT contract, transaction_hash, log_index FROM order_filled")


def _unsealed(t: Tables) -> DataFrame:
    df = t[_F].withColumn("event", F.lit(_F)).select("contract", "event", "block_number", "transaction_hash", "log_index")
    sealed = X.partitioned(df.where("block_number % 3 = 0 and block_number < 84500000")).select("contract", "event", "10K").distinct()
    fresh, late = X.only_unsealed(df, sealed)
    return fresh.withColumn("late", F.lit(False)).unionAll(late.withColumn("late", F.lit(True)))


_add("b3_only_unsealed", _unsealed, """WITH s AS (SELECT DISTINCT contract, block_number // 10000 AS k FROM order_filled WHERE block_number % 3 = 0 AND block_number < 84500000)
    SELECT o.contract, 'order_filled' AS event, block_number, transaction_hash, log_index, s.k IS NOT NULL AS late FROM order_filled o LEFT JOIN s ON s.contract = o.contract AND s.k = o.block_number // 10000""")


def _ignore(t: Tables) -> DataFrame:
    df = t["order_filled_replay"].select("block_number", "log_index", "transaction_hash", "maker", "delivery")
    return X.insert_or_ignore(df.where("block_number < 84300000 and delivery = 0").dropDuplicates(["block_number", "log_index"]).select("block_number", "log_index", F.lit("old").alias("transaction_hash"), F.lit("").alias("maker"), F.lit(0).alias("delivery")), df, ("delivery", "transaction_hash", "maker"))


_add("b4_insert_or_ignore", _ignore, """WITH o AS (SELECT DISTINCT block_number, log_index, 'old' AS transaction_hash, '' AS maker, 0 AS delivery FROM order_filled_replay WHERE block_number < 84300000 AND delivery = 0),
    n AS (SELECT block_number, log_index, transaction_hash, maker, delivery, row_number() OVER (PARTITION BY block_number, log_index ORDER BY delivery, transaction_hash, maker) AS r FROM order_filled_replay)
    SELECT * FROM o UNION ALL SELECT block_number, log_index, transaction_hash, maker, delivery FROM n WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM o WHERE o.block_number = n.block_number AND o.log_index = n.log_index)""")
_PARTS = " UNION ALL ".join(f"SELECT contract, '{e}' AS event, block_number // 10000 * 10000 AS k, count(*) AS row_count, min(block_number) AS block_start, max(block_number) AS block_end FROM {e} GROUP BY 1, 2, 3" for e in (_F, "fee_charged"))
_add("b5_build_manifest", lambda t: X.build_manifest(t.spark, _store(t, events=(_F, "fee_charged"))).where("length(sha256) = 64 and bytes > 0 and status = 'complete'").select("contract", "event", F.col("10K").alias("k"), "row_count", "block_start", "block_end"), _PARTS)


def _verified(t: Tables) -> DataFrame:
    m = X.build_manifest(t.spark, _store(t, events=(_F, "fee_charged"))).select("contract", "event", "10K", "row_count")
    less = m.withColumn("row_count", F.when(F.col("10K") % 70_000 == 0, F.col("row_count") - 1).otherwise(F.col("row_count"))).where("`10K` % 110000 <> 0")
    return X.verify_partitions(m, less).select("contract", "event", F.col("10K").alias("k"), "written", "reread")


_add("b6_verify_partitions", _verified, f"SELECT contract, event, k, row_count AS written, CASE WHEN k % 110000 = 0 THEN NULL ELSE row_count - 1 END AS reread FROM ({_PARTS}) WHERE k % 70000 = 0 OR k % 110000 = 0")


def _empties(t: Tables) -> DataFrame:
    counts = X.partitioned(t["fee_charged"]).groupBy("contract", "10K").agg(F.count("*").alias("row_count")).withColumn("event", F.lit("fee_charged"))
    ready = X.partitioned(t["token_registered"]).select(F.col("10K").alias("partition_start")).distinct()
    targets = t.spark.createDataFrame([(c, e) for c, e in TABLES if e == "fee_charged"], "contract string, event string")
    return X.empty_partitions(ready, targets, counts).select("contract", "event", F.col("10K").alias("k"), "row_count", "status")


_add("b7_empty_partitions", _empties, """WITH g AS (SELECT DISTINCT block_number // 10000 * 10000 AS k FROM token_registered), c AS (SELECT unnest(['CTFExchange', 'NegRiskCtfExchange']) AS contract),
    n AS (SELECT contract, block_number // 10000 * 10000 AS k, count(*) AS r FROM fee_charged GROUP BY 1, 2)
    SELECT c.contract, 'fee_charged' AS event, g.k, coalesce(r, 0) AS row_count, CASE WHEN r IS NULL THEN 'empty' ELSE 'complete' END AS status FROM g CROSS JOIN c LEFT JOIN n ON n.contract = c.contract AND n.k = g.k""")


def _sealed(t: Tables) -> DataFrame:
    """Two runs: the second brings a longer range and rows of partitions that the first sealed."""
    root, t = shared_path(t.spark, "sealed"), t.kept()
    staged = {(c, _F): t[_F].where(F.col("contract") == c) for c in _STORED}
    first = t.spark.createDataFrame([(84_000_000, 84_499_999)], "from_block long, to_block long")
    more = t.spark.createDataFrame([(84_500_000, 84_999_999)], "from_block long, to_block long")
    X.seal_ready({k: df.where("block_number % 2 = 0") for k, df in staged.items()}, first, root)
    done = X.seal_ready({k: df.where("block_number % 2 = 1 or block_number >= 84500000") for k, df in staged.items()}, first.unionAll(more), root)
    late = materialize(done["late"].where("`10K` < 84500000").select("contract", U.strip0x(F.col("transaction_hash")).alias("transaction_hash"), "log_index", F.lit("late").alias("outcome")), "late")
    kept = _rows(S.scan_event(t.spark, root, _F)).select("contract", "transaction_hash", "log_index", F.lit("sealed").alias("outcome"))
    return kept.unionAll(late)


_add("b8_seal_ready", _sealed, """WITH s AS (SELECT DISTINCT contract, block_number // 10000 AS k FROM order_filled WHERE block_number % 2 = 0 AND block_number BETWEEN 84000000 AND 84499999)
    SELECT o.contract, transaction_hash, log_index, CASE WHEN block_number < 84500000 AND block_number % 2 = 1 AND s.k IS NOT NULL THEN 'late' ELSE 'sealed' END AS outcome
    FROM order_filled o LEFT JOIN s ON s.contract = o.contract AND s.k = o.block_number // 10000 WHERE block_number BETWEEN 84000000 AND 84999999""")

# Feeds (2H)
_STATE = "SELECT tx_hash, min(arrival_ms) AS first_seen_ms, min(CASE WHEN status = 'pending' THEN arrival_ms END) AS first_pending_ms, count(*) AS messages FROM {0} GROUP BY 1"


def _messages(t: Tables) -> DataFrame:
    """The settlements as messages of all types, with some noise."""
    s, n = t["settlements"], F.col("arrival_ms") % 11
    item = F.struct("tx_hash", "status")
    bare = F.struct("tx_hash")
    body = F.when(n == 1, F.to_json(F.struct(F.lit("snapshot").alias("type"), F.array(item, item).alias("events")))).when(n == 2, F.to_json(F.struct(F.lit("status_update").alias("type"), bare.alias("data"))))
    body = body.when(n == 3, '{"type":"heartbeat"}').when(n == 4, "{not json").when(n == 5, '{"type":"error","message":"x"}').otherwise(F.to_json(F.struct(F.lit("settlement").alias("type"), item.alias("data"))))
    return s.select("arrival_ms", body.alias("body"))


_N = "(arrival_ms % 11)"
_add("h5_parse_feed", lambda t: H.parse_feed(_messages(t)), f"SELECT arrival_ms, tx_hash, CASE WHEN {_N} = 2 THEN 'confirmed' ELSE status END AS status FROM settlements WHERE {_N} NOT IN (3, 4, 5) UNION ALL SELECT arrival_ms, tx_hash, status FROM settlements WHERE {_N} = 1")
_add("h5_feed_errors", lambda t: H.feed_errors(_messages(t)).select("arrival_ms", "reason"), f"SELECT arrival_ms, CASE WHEN {_N} = 4 THEN 'malformed' ELSE 'error' END AS reason FROM settlements WHERE {_N} IN (4, 5)")
_add("h6_settlement_state", lambda t: H.settlement_state(t["settlements"]), _STATE.format("settlements"))
_H7 = "SELECT block_number, count(DISTINCT tx_hash) AS trades, count(*) AS logs FROM confirmed GROUP BY 1"
_add("h7_confirmed_by_block", lambda t: H.confirmed_by_block(t["confirmed"]), _H7)
_SEEN = "seen AS (SELECT tx_hash, min(arrival_ms) AS seen_ms FROM settlements GROUP BY 1)"
_H8 = f"""WITH f AS (SELECT block_number, min(arrival_ms) AS first_ms FROM confirmed GROUP BY 1), g AS (SELECT block_number, min(first_ms) OVER (ORDER BY block_number ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS final_ms FROM f),
    {_SEEN}, d AS (SELECT DISTINCT block_number, tx_hash FROM confirmed) SELECT block_number, count(*) AS trades, CAST(sum(CASE WHEN seen_ms IS NULL OR seen_ms >= final_ms THEN 1 ELSE 0 END) AS BIGINT) AS not_seen FROM d JOIN g USING (block_number) LEFT JOIN seen USING (tx_hash) WHERE final_ms IS NOT NULL GROUP BY 1"""
_add("h8_block_inclusion", lambda t: H.block_inclusion(t["confirmed"], t["settlements"]), _H8)
_H9 = "SELECT tx_hash, min(arrival_ms) AS pending_ms, (SELECT max(arrival_ms) FROM confirmed) - min(arrival_ms) > 10000 AS overdue FROM settlements WHERE status = 'pending' AND tx_hash NOT IN (SELECT tx_hash FROM confirmed) GROUP BY 1"
_add("h9_in_flight", lambda t: H.in_flight(t["settlements"], t["confirmed"], t["confirmed"].agg(F.max("arrival_ms")).first()[0] or 0), _H9)
_REGRESS = "SELECT arrival_seq, block_number, tx_hash, highest FROM (SELECT *, max(block_number) OVER (ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest FROM confirmed) WHERE block_number < highest"
_add("h10_block_regressions", lambda t: H.block_regressions(t["confirmed"]), _REGRESS)
_H11 = "SELECT block_number, count(*) AS trades, CAST(sum(CASE WHEN tx_hash IN (SELECT tx_hash FROM settlements) THEN 0 ELSE 1 END) AS BIGINT) AS not_seen FROM (SELECT DISTINCT block_number, tx_hash FROM confirmed WHERE block_number = (SELECT max(block_number) FROM confirmed)) GROUP BY 1"
_add("h11_current_block", lambda t: H.current_block_stats(t["confirmed"], t["settlements"]), _H11)


#: Files of landed logs that a micro-batch reads and then deletes.
FILES = 16


def _drained(stream: DataFrame, t: Tables, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there into a table of the shared folder."""
    out, at = shared_path(t.spark, "stream"), shared_path(t.spark, "offsets")
    stream.writeStream.format("parquet").outputMode(mode).option("compression", "zstd").option("path", out).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


def _streamed(t: Tables, df: DataFrame) -> DataFrame:
    path = shared_path(t.spark, "feed")
    df.write.parquet(path)
    return t.spark.readStream.schema(df.schema).parquet(path)


def _stream_decode(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "logs")
    _broken(t).write.json(path, compression="gzip")
    return _values(_drained(H.stream_decode(H.read_logs(t.spark, path, FILES, clean=True)), t))


_add("h1_stream_decode", _stream_decode, _values_sql())


def _stream_dedup(t: Tables) -> DataFrame:
    df = t["order_filled_replay"].select("block_number", "log_index", F.timestamp_seconds(F.col("block_number") * 2).alias("ts"), "contract", "transaction_hash")
    return _drained(H.stream_dedup(_streamed(t, df), "ts"), t).groupBy("block_number").agg(F.count("*").alias("n"))


_add("h2_stream_dedup", _stream_dedup, "SELECT block_number, count(DISTINCT log_index) AS n FROM order_filled_replay GROUP BY 1")


def _in_turns(t: Tables, parts: list[DataFrame], start) -> None:
    """Run start(stream) to its end after each part has come to the stream's folder: one micro-batch a part at least."""
    path = shared_path(t.spark, "feed")
    for df in parts:
        df.write.mode("append").option("compression", "zstd").parquet(path)
        start(t.spark.readStream.schema(parts[0].schema).parquet(path)).awaitTermination()


def _stream_seal(t: Tables) -> DataFrame:
    """Logs come in three turns: even blocks, odd ones before 84.25 million, and the other odd ones. The first two complete
    the ranges before 84.25 million, the third those before 84.5 million; later blocks stay staged."""
    root, state, offsets = (shared_path(t.spark, n) for n in ("sealed", "state", "offsets"))
    rows = t.kept()[_F].where("contract = 'CTFExchange'")
    parts = [D.encode(rows.where(f"block_number % 2 = {w}"), _F) for w in ("0", "1 and block_number < 84250000", "1 and block_number >= 84250000")]
    reach = lambda i: t.spark.createDataFrame([(84_000_000, 84_249_999 if i < 2 else 84_499_999)], "from_block long, to_block long")
    _in_turns(t, parts, lambda s: H.stream_seal(D.decode(s, _F, ids_in_hex=True), "CTFExchange", _F, reach, root, state, offsets, ids_in_hex=True))
    keys = U.strip0x(F.col("transaction_hash")).alias("transaction_hash"), "log_index"
    late = [t.spark.read.parquet(f"{state}/{i}/late").select(*keys, F.lit("late").alias("outcome")) for i in range(3)]
    staged = t.spark.read.parquet(f"{state}/2/staged").select(*keys, F.lit("staged").alias("outcome"))
    out = _rows(S.scan_table(t.spark, root, "CTFExchange", _F)).select("transaction_hash", "log_index", F.lit("sealed").alias("outcome"))
    for df in [*late, staged]:
        out = out.unionAll(df)
    return out


_add("h3_stream_seal", _stream_seal, """WITH o AS (SELECT * FROM order_filled WHERE contract = 'CTFExchange'),
    s AS (SELECT DISTINCT block_number // 10000 AS k FROM o WHERE block_number % 2 = 0 AND block_number BETWEEN 84000000 AND 84249999)
    SELECT transaction_hash, log_index, CASE WHEN block_number NOT BETWEEN 84000000 AND 84499999 THEN 'staged'
    WHEN block_number < 84250000 AND block_number % 2 = 1 AND s.k IS NOT NULL THEN 'late' ELSE 'sealed' END AS outcome FROM o LEFT JOIN s ON s.k = o.block_number // 10000""")


def _stream_lag(t: Tables) -> DataFrame:
    """Finished ranges come in four turns; one row a turn."""
    state, offsets = shared_path(t.spark, "state"), shared_path(t.spark, "offsets")
    turn = F.expr("from_block div 395950 % 4")
    ranges = t["ranges"].select(F.col("from_block").cast("long").alias("from_block"), F.col("to_block").cast("long").alias("to_block"))
    _in_turns(t, [ranges.where(turn == k) for k in range(4)], lambda s: H.stream_lag(s, _HEAD, 1000, state, offsets))
    return t.spark.read.parquet(f"{state}/lag").select(F.col("step").cast("int").alias("step"), "covered_blocks", "blocks_behind", "lagging")


def _lag_sql(k: int) -> str:
    m = _MERGED.format(f"(SELECT * FROM ranges WHERE from_block // 395950 % 4 <= {k})")
    return f"""SELECT * FROM (WITH {m} SELECT {k} AS step, CAST(sum(to_block - from_block + 1) AS BIGINT) AS covered_blocks,
    greatest({_HEAD} - max(to_block), 0) AS blocks_behind, greatest({_HEAD} - max(to_block), 0) > 1000 AS lagging FROM m)"""


_add("h4_stream_lag", _stream_lag, " UNION ALL ".join(map(_lag_sql, range(4))))


def _stamped(df: DataFrame, *columns: str) -> DataFrame:
    """A feed with the arrival as event time (all positive, as watermarks begin at zero)."""
    at = F.col("arrival_ms").cast("long")
    return df.select(at.alias("arrival_ms"), *columns, F.timestamp_millis(at + 10_000_000).alias("ts"))


_END = 10**12  # the arrival of a last message that moves the clocks on, so that all that is open is closed


def _stream_announced(t: Tables) -> DataFrame:
    """Confirmed trades announced within 30 s before, and those that were not."""
    end = t.spark.createDataFrame([(_END, -1, "end")], "arrival_ms long, block_number long, tx_hash string")
    confirmed = t["confirmed"].select("arrival_ms", F.col("block_number").cast("long").alias("block_number"), "tx_hash").unionAll(end)
    settled = t["settlements"].select("arrival_ms", "tx_hash").unionAll(end.select("arrival_ms", "tx_hash"))
    confirmed, settled = (_stamped(df, *cols).drop("arrival_ms") for df, cols in ((confirmed, ("block_number", "tx_hash")), (settled, ("tx_hash",))))
    joined = _drained(H.stream_announced(_streamed(t, confirmed), _streamed(t, settled)), t).where("block_number >= 0")
    return joined.groupBy("block_number").agg(F.countDistinct("tx_hash").alias("trades"), F.countDistinct(F.when(F.col("settled_at").isNotNull(), F.col("tx_hash"))).alias("announced"))


_add("h8_stream_announced", _stream_announced, """SELECT block_number, count(DISTINCT tx_hash) AS trades, count(DISTINCT CASE WHEN a THEN tx_hash END) AS announced FROM
    (SELECT c.block_number, c.tx_hash, EXISTS (SELECT 1 FROM settlements s WHERE s.tx_hash = c.tx_hash AND s.arrival_ms <= c.arrival_ms AND s.arrival_ms >= c.arrival_ms - 30000) AS a FROM confirmed c) GROUP BY 1""")


def _feed(t: Tables) -> DataFrame:
    """Both kinds of message in one feed."""
    logs = t["confirmed"].select(F.lit("confirmed").alias("kind"), "arrival_ms", "block_number", "tx_hash")
    said = t["settlements"].select(F.lit("settlement").alias("kind"), "arrival_ms", F.lit(None).alias("block_number"), "tx_hash")
    each = logs.unionAll(said)
    return each.select("kind", F.col("arrival_ms").cast("long").alias("arrival_ms"), F.col("block_number").cast("long").alias("block_number"), "tx_hash")


def _thirds(t: Tables, df: DataFrame, by: str) -> list[DataFrame]:
    """A feed in three turns of its order."""
    lo, hi = df.agg(F.min(by), F.max(by)).first()  # two numbers
    if lo is None:
        return [df]
    cuts = [lo - 1, lo + (hi - lo) // 3, lo + 2 * (hi - lo) // 3, hi]
    return [df.where((F.col(by) > a) & (F.col(by) <= b)) for a, b in zip(cuts, cuts[1:])]


def _included(t: Tables, end: bool) -> str:
    """Run the inclusion stream over the feed in three turns (and a last message of each kind); where its tables are."""
    out, state, offsets = (shared_path(t.spark, n) for n in ("inclusion", "state", "offsets"))
    parts = _thirds(t, _feed(t), "arrival_ms")
    last = t.spark.createDataFrame([(k, _END, b, "end") for k, b in (("confirmed", -1), ("settlement", None))], L.FEED)
    _in_turns(t, [*parts, last] if end else parts, lambda s: L.stream_inclusion(s, out, state, offsets))
    return out


_add("h8_stream_inclusion", lambda t: t.spark.read.parquet(f"{_included(t, True)}/closed").where("block_number >= 0").select("block_number", "trades", "not_seen"), _H8)


def _stream_current(t: Tables) -> DataFrame:
    """The block in progress after the last of three turns."""
    now = t.spark.read.parquet(f"{_included(t, False)}/current")
    return now.where(F.col("batch") == (now.agg(F.max("batch")).first()[0] or 0)).select("block_number", "trades", "not_seen")


_add("h11_stream_current", _stream_current, _H11)


def _stream_regressions(t: Tables) -> DataFrame:
    """One feed in three turns."""
    out, state, offsets = (shared_path(t.spark, n) for n in ("regressions", "state", "offsets"))
    rows = t["confirmed"].select(F.col("arrival_seq").cast("long").alias("arrival_seq"), F.col("block_number").cast("long").alias("block_number"), "tx_hash")
    _in_turns(t, _thirds(t, rows, "arrival_seq"), lambda s: L.stream_regressions(s, out, state, offsets))
    return t.spark.read.parquet(out).select("arrival_seq", "block_number", "tx_hash", "highest")


_add("h10_stream_regressions", _stream_regressions, _REGRESS)


def _in_order(t: Tables, df: DataFrame, end: DataFrame) -> DataFrame:
    """A stream of a stamped feed, its rows in three files and a last message, taken file by file."""
    path = shared_path(t.spark, "feed")
    for part in [*_thirds(t, df, "arrival_ms"), end]:
        part.coalesce(1).write.mode("append").parquet(path)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _stream_counts(t: Tables) -> DataFrame:
    rows = _stamped(t["confirmed"].withColumn("block_number", F.col("block_number").cast("long")), "block_number", "tx_hash")
    end = _stamped(t.spark.createDataFrame([(_END, -1, "end")], "arrival_ms long, block_number long, tx_hash string"), "block_number", "tx_hash")
    return _drained(L.stream_block_counts(_in_order(t, rows, end)), t)


_add("h7_stream_counts", _stream_counts, _H7)


def _ended(t: Tables) -> DataFrame:
    return _stamped(t.spark.createDataFrame([(_END, "end", "confirmed")], "arrival_ms long, tx_hash string, status string"), "tx_hash", "status")


_add("h6_stream_settlements", lambda t: _drained(L.stream_settlement_state(_in_order(t, _stamped(t["settlements"], "tx_hash", "status"), _ended(t))), t), _STATE.format("settlements"))


def _stream_in_flight(t: Tables) -> DataFrame:
    """Pending trades that stayed without confirmation, those whose alarm was due when the confirmed feed ended."""
    said = _in_order(t, _stamped(t["settlements"], "tx_hash", "status"), _ended(t))
    logs = _in_order(t, _stamped(t["confirmed"], "tx_hash"), _ended(t).drop("status"))
    open_ = _drained(L.stream_in_flight(said, logs), t).groupBy("tx_hash").agg(F.min("pending_ms").alias("pending_ms"))
    now = t["confirmed"].agg(F.max("arrival_ms")).first()[0] or 0
    return open_.where(F.lit(now) - F.col("pending_ms") > H.ALARM_MS).withColumn("overdue", F.lit(True))


_add("h9_stream_in_flight", _stream_in_flight, f"SELECT * FROM ({_H9}) WHERE overdue")


def _stream_store(t: Tables) -> DataFrame:
    """All first deliveries, then all again with the replays: nothing is stored twice."""
    root, offsets = shared_path(t.spark, "stored"), shared_path(t.spark, "offsets")
    rows = t.kept()["order_filled_replay"].where("contract = 'CTFExchange'").drop("contract")
    _in_turns(t, [rows.where("delivery = 0"), rows], lambda s: H.stream_store(s, "CTFExchange", _F, root, offsets, ("delivery", "transaction_hash")))
    return S.scan_table(t.spark, root, "CTFExchange", _F).groupBy("block_number").agg(F.count("*").alias("n"), F.countDistinct("log_index").alias("n_logs"))


_add("h2_stream_store", _stream_store, "SELECT block_number, count(DISTINCT log_index) AS n, count(DISTINCT log_index) AS n_logs FROM order_filled_replay WHERE contract = 'CTFExchange' GROUP BY 1")

_TURN = "least(from_block // (SELECT max(from_block) // 5 + 1 FROM ranges), 4)"


def _catch_up(t: Tables) -> DataFrame:
    """Finished ranges in five turns from the lowest block up; the head is a fifth ahead of four fifths of them, and moves by
    a block a turn. The last turn is not taken in."""
    path, state, offsets = (shared_path(t.spark, n) for n in ("ranges", "state", "offsets"))
    ranges = t["ranges"].select(F.col("from_block").cast("long").alias("from_block"), F.col("to_block").cast("long").alias("to_block"))
    fifth = (ranges.agg(F.max("from_block")).first()[0] or 0) // 5 + 1
    for k in range(5):
        ranges.where(F.least(F.floor(F.col("from_block") / fifth), F.lit(4)) == k).coalesce(1).write.mode("append").parquet(path)
    stream = t.spark.readStream.schema(ranges.schema).option("maxFilesPerTrigger", 1).parquet(path)
    H.catch_up(stream, lambda i: 4 * fifth + i, fifth // 2, state, offsets)
    return t.spark.read.parquet(f"{state}/lag").select(F.col("step").cast("int").alias("step"), "covered_blocks", "blocks_behind", "lagging")


def _turn_sql(k: int) -> str:
    m = _MERGED.format(f"(SELECT * FROM ranges WHERE {_TURN} <= {k})")
    fifth = "(SELECT max(from_block) // 5 + 1 FROM ranges)"
    behind = f"greatest(4 * {fifth} + {k} - max(to_block), 0)"
    return f"""SELECT * FROM (WITH {m} SELECT {k} AS step, CAST(sum(to_block - from_block + 1) AS BIGINT) AS covered_blocks,
    CAST({behind} AS BIGINT) AS blocks_behind, {behind} > {fifth} // 2 AS lagging FROM m)"""


_add("h4_catch_up", _catch_up, "SELECT * FROM (" + " UNION ALL ".join(map(_turn_sql, range(5))) + f") WHERE step <= (SELECT min(step) FROM ({' UNION ALL '.join(map(_turn_sql, range(5)))}) WHERE NOT lagging)")

# The stored tables of all events, written in one pass over the logs


def _all_tables(t: Tables, root: str) -> DataFrame:
    """Every stored table as its scan gives it: where a row belongs, its common columns, and its values in stored order."""
    out = None
    for c, e in TABLES:
        df = _rows(S.scan_table(t.spark, root, c, e))
        values = F.concat_ws("|", *(F.regexp_replace(F.col(f.name).cast("string"), " ", "") for f in TABLES[c, e].fields))
        df = df.select(F.lit(c).alias("contract"), F.lit(e).alias("event"), *COMMON, values.alias("stored_values"))
        out = df if out is None else out.unionAll(df)
    return out


def _tables_sql() -> str:
    each = []
    for k, e in EVENTS.items():
        values = ", ".join(f"""replace(CAST("{f.name}" AS VARCHAR), ' ', '')""" for f in e.fields)
        each.append(f"""SELECT contract, '{e.name}' AS event, {', '.join(COMMON)}, concat_ws('|', {values}) AS stored_values
        FROM ({_decoded_sql(k)}) WHERE block_number % 97 NOT IN (1, 2, {_spoilt(k)})""")
    return " UNION ALL ".join(each)


def _typed_tables(t: Tables) -> DataFrame:
    root = shared_path(t.spark, "tables")
    # numbers are dealt out, not the rows made of them
    X.export_all(X.typed_rows(D.decode_all(_broken(t, dealt=True), ids_in_hex=True)), root, dealt=True)
    return _all_tables(t, root)


_add("c24_typed_tables", _typed_tables, _tables_sql())


def _stream_tables(t: Tables) -> DataFrame:
    path, root = shared_path(t.spark, "logs"), shared_path(t.spark, "tables")
    _broken(t).write.json(path, compression="gzip")
    H.stream_tables(H.read_logs(t.spark, path, FILES, clean=True), root, shared_path(t.spark, "offsets")).awaitTermination()
    return _all_tables(t, root)


_add("h1_stream_tables", _stream_tables, _tables_sql())


def _complete(t: Tables) -> DataFrame:
    root = _store(t)
    return _rows(S.scan_complete(t.spark, root, _F, S.complete_1m_ranges(S.partition_inventory(t.spark, root), _F)))


_add("a3_scan_complete_ranges", _complete, f"SELECT {_COLS}, contract FROM order_filled WHERE block_number // 1000000 * 1000000 IN {_FULL.format(_F)}")


def _scan_moves(t: Tables) -> DataFrame:
    """An event whose two tables have different columns."""
    root = shared_path(t.spark, "store")
    for key, contract in (("ct_payout_redemption", "ConditionalTokens"), ("nr_payout_redemption", "NegRiskAdapter")):
        X.export_event(X.typed_projection(t[key], contract, "payout_redemption"), root, contract, "payout_redemption")
    return _rows(S.scan_event(t.spark, root, "payout_redemption"))


_MOVED = "block_number, transaction_index, transaction_hash, log_index, redeemer, condition_id, payout"
_add("a2_scan_redemptions", _scan_moves, f"""SELECT {_MOVED}, collateral_token, parent_collection_id, index_sets, NULL AS amounts, 'ConditionalTokens' AS contract FROM ct_payout_redemption
    UNION ALL SELECT {_MOVED}, NULL, NULL, NULL, amounts, 'NegRiskAdapter' FROM nr_payout_redemption""")


def _manifest(t: Tables) -> DataFrame:
    """The manifest of two events with the partitions of a third as ready ones; bytes and digest are held against the files
    read whole."""
    root = _store(t, events=(_F, "fee_charged"))
    ready = X.partitioned(t["token_registered"]).select(F.col("10K").alias("partition_start")).distinct()
    m = X.build_manifest(t.spark, root, ready).where(F.col("event").isin(_F, "fee_charged"))
    files = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root)
    key = [F.regexp_extract("path", S.FILE, i).alias(n) for i, n in ((1, "contract"), (2, "event"), (4, "k"))]
    again = files.select(*key, F.length("content").cast("long").alias("n"), F.sha2("content", 256).alias("sha")).withColumn("k", F.col("k").cast("long"))
    j = m.withColumnRenamed("10K", "k").join(again, ["contract", "event", "k"], "left")
    same = F.col("bytes").eqNullSafe(F.col("n")) & F.col("sha256").eqNullSafe(F.col("sha")) & ((F.col("files") == 1) | (F.col("row_count") == 0))
    return j.select("contract", "event", "version", "partition", "row_count", "block_start", "block_end", "status", same.alias("as_the_files"))


_add("b5_manifest", _manifest, f"""WITH p AS ({_PARTS}), g AS (SELECT DISTINCT block_number // 10000 * 10000 AS k FROM token_registered),
    e AS (SELECT c.contract, v.event, g.k FROM g, (SELECT unnest(['CTFExchange', 'NegRiskCtfExchange']) AS contract) c, (SELECT unnest(['{_F}', 'fee_charged']) AS event) v
      WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.contract = c.contract AND p.event = v.event AND p.k = g.k)),
    a AS (SELECT contract, event, k, row_count, block_start, block_end, 'complete' AS status FROM p UNION ALL SELECT contract, event, k, 0, NULL, NULL, 'empty' FROM e)
    SELECT contract, event, 'v2' AS version, '1M=' || (k // 1000000 * 1000000) || '/10K=' || k AS partition, row_count, block_start, block_end, status, TRUE AS as_the_files FROM a""")


class _WithoutFees:
    """The tables with the charged fees of every seventh partition gone."""

    def __init__(self, t: Tables):
        self.t = t

    def __getitem__(self, name: str) -> DataFrame:
        return self.t[name].where("block_number div 10000 % 7 <> 3") if name == "fee_charged" else self.t[name]


_add("f9b_fees_of_lost_partitions", lambda t: C.fees_without_table(_WithoutFees(t)), _SQL["f9b_fees_without_table"].replace("FROM fee_charged f WHERE", "FROM fee_charged f WHERE f.block_number // 10000 % 7 <> 3 AND"))

_ALL_TABLES = tuple(EVENTS)
_add("e5_all_tables_with_rows", lambda t: R.tables_with_rows({n: t[n] for n in _ALL_TABLES}, 85_000_000, 85_999_999), " UNION ALL ".join(f"SELECT DISTINCT '{n}' AS table_name FROM {n} WHERE block_number BETWEEN 85000000 AND 85999999" for n in _ALL_TABLES))
_add("e9_all_event_counts", lambda t: R.event_counts({n: t[n] for n in _ALL_TABLES}), "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _ALL_TABLES) + ") WHERE n > 0")


def _sampled(t: Tables) -> DataFrame:
    """F1 on the first and the last range of the fills."""
    m = F.col("block_number") - F.col("block_number") % 1_000_000
    return C.blob_lengths(_Replay(t), S.sample_ranges(t[_F].select(m.alias("1M")), 1))


_M_RANGE = "block_number // 1000000"
_add("f1_sampled_ranges", _sampled, "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{e}' AS event, transaction_hash, log_index, '{c}' AS column_name, length({c}) // 2 AS n_bytes FROM {'order_filled_replay' if e == 'order_filled' else e}
    WHERE length({c}) // 2 <> {n} AND {_M_RANGE} IN ((SELECT min({_M_RANGE}) FROM order_filled), (SELECT max({_M_RANGE}) FROM order_filled))"""
    for e, cols in C.BLOBS.items() for c, n in cols.items()
) + ")")
_add(
    "e7_migrate_with_ranges",
    lambda t: R.migrate_progress(t["order_filled"].groupBy("contract").agg(F.max("block_number").alias("last_complete_block")), t["ranges"]),
    _M + " SELECT * FROM m",
)


def _split_mixed(t: Tables) -> DataFrame:
    """The logs of the six events that two contracts emit, each row where it belongs."""
    out = None
    for key in (k for k, e in EVENTS.items() if len(e.contracts) > 1):
        for c, df in X.split_by_contract(D.encode(_source(t, key), key), key).items():
            df = df.select(F.lit(key).alias("event"), F.lit(c).alias("contract"), U.strip0x(F.col("transactionHash")).alias("transaction_hash"), U.parse_hex(F.col("logIndex")).alias("log_index"))
            out = df if out is None else out.unionAll(df)
    return out


_add("b2_split_mixed_events", _split_mixed, " UNION ALL ".join(f"SELECT '{k}' AS event, contract, transaction_hash, log_index FROM ({_decoded_sql(k)})" for k, e in EVENTS.items() if len(e.contracts) > 1))
