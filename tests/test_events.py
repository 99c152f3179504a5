"""Conversions, decoding, ranges, storage and checks against plain Python and on clean and spoilt tables."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blockloom.functions import u256 as U
from blockloom.operators import checks, decode, derive, ranges
from blockloom.plans.catalog import EVENTS, TABLES, stored_schema
from blockloom.plans.fixtures import RECIPES, Tables
from blockloom.sources import export, scan
from blockloom.streaming import feed

SF = "/root/testdata/sf0.001"
EDGES = [0, 1, 10**9, 2**64 - 1, 2**64, 2**127 - 1, 10**38, 2**128 + 7, 2**255, 2**256 - 1]


def test_u256_exact(spark):
    rng = random.Random(7)
    v = EDGES + [rng.getrandbits(rng.randint(1, 256)) for _ in range(200)]
    rows = [(str(x), f"{x:064x}", str(x - 2**255), f"{(x - 2**255) % 2**256:064x}") for x in v]
    df = spark.createDataFrame(rows, "d string, h string, s string, t string")
    out = df.select("d", "h", "s", "t", U.u256_dec(F.col("h")), U.u256_hex(F.col("d")), U.i256_dec(F.col("t")), U.i256_hex(F.col("s"))).collect()
    assert all(tuple(r[4:]) == tuple(r[:4]) for r in out)


def test_small_conversions(spark):
    df = spark.createDataFrame([("0x1F", 2**32 + 5), (None, 7), ("", 1), ("0x", 2)], "h string, n long")
    assert [r[0] for r in df.select(U.parse_hex(F.col("h"))).collect()] == [31, 0, 0, 0]
    assert [r[0] for r in df.select(U.to_u32(F.col("n"))).collect()] == [5, 7, 1, 2]
    with pytest.raises(Exception, match="32-bit"):
        df.select(U.to_u32(F.col("n"), strict=True)).collect()
    assert df.select(U.hex_to_binary(F.lit("0xab"), 20)).first()[0] == bytes(19) + b"\xab"


@pytest.mark.parametrize("key", ["question_resolved", "ct_position_split", "question_initialized", "market_prepared", "fee_refunded"])
def test_round_trip(spark, key):
    df = Tables(spark, SF)[key]
    df = (df.withColumnRenamed("partition_sets", "partition") if "partition_sets" in df.columns else df).where("amount rlike '^[0-9]+$'" if "amount" in df.columns else "true")
    assert decode.decode(decode.encode(df, key), key).count() == df.count() > 0


def test_decode_all_agrees_with_decode_and_quarantine(spark):
    df = Tables(spark, SF)["order_filled"]
    raw = decode.encode(df, "order_filled")
    broken = raw.withColumn("data", F.substr("data", F.lit(1), F.lit(100)))
    both = raw.unionAll(broken).unionAll(raw.withColumn("topics", F.array(F.lit("0x" + "00" * 32)))).unionAll(raw.withColumn("topics", F.array().cast("array<string>")))
    n = df.count()
    assert decode.decode_all(both).count() == n
    assert {r["reason"]: r["count"] for r in decode.undecodable(both).groupBy("reason").count().collect()} == {"short or bad data": n}
    one = decode.decode_all(raw).select(F.get_json_object("fields", "$.maker_amount_filled").alias("v"))
    assert one.exceptAll(decode.decode(raw, "order_filled").select("maker_amount_filled")).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3_000_000), st.integers(0, 900_000)), max_size=12), st.integers(1, 400_000))
def test_ranges_against_plain_python(spark, pairs, span):
    rows = [(a, a + n) for a, n in pairs]
    df = spark.createDataFrame(rows, "from_block long, to_block long")
    want = []
    for a, b in sorted(rows):
        if want and a <= want[-1][1] + 1:
            want[-1][1] = max(want[-1][1], b)
        else:
            want.append([a, b])
    got = sorted(map(list, ranges.merge_ranges(df).collect()))
    assert got == want
    covered, gaps, at = 0, [], 100_000
    for a, b in want:
        if b < 100_000 or a > 3_500_000:
            continue
        if a > at:
            gaps.append([at, a - 1])
        at = max(at, b + 1)
        covered += 1
    if at <= 3_500_000:
        gaps.append([at, 3_500_000])
    assert sorted(map(list, ranges.find_gaps(df, 100_000, 3_500_000).collect())) == gaps
    assert sorted(r[0] for r in ranges.complete_10k(df).collect()) == sorted(x for a, b in want for x in range(-(-a // 10000) * 10000, b - 9998, 10000))
    assert sorted(map(list, ranges.slice_ranges(df, span).collect())) == sorted([x, min(x + span - 1, b)] for a, b in want for x in range(a, b + 1, span))


def test_checks_find_planted_defects_and_pass_clean_tables(spark):
    t = Tables(spark, SF)
    assert checks.fee_reconciliation(t).count() == 31
    clean = {n: t[n] for n in RECIPES}
    clean["fee_charged"] = t["order_filled"].where("fee <> '0'").select("contract", "block_number", "transaction_index", "transaction_hash", "log_index", F.col("fee").alias("amount"))
    assert checks.fee_reconciliation(clean).count() == 0
    assert checks.unique_log_keys(t).count() == 0
    report = {r["check_name"]: r for r in checks.report(t, ("f3_symmetric_pairs", "f27_registered_prepared", "f29_unique_log_keys"), limit=2).collect()}
    assert report["f3_symmetric_pairs"]["status"] == "fail" and report["f27_registered_prepared"]["status"] == "pass" and report["f29_unique_log_keys"]["violations"] == 0


def test_amounts_at_the_int128_boundary(spark):
    good, bad = [str(2**127 - 1), "0", "1" + "0" * 38, "007"], [str(2**127), "-1", "abc", "", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "fee string").withColumns({"maker_amount_filled": F.lit("1"), "taker_amount_filled": F.lit("1"), "amount": F.lit("1"), "payout": F.lit("1")})
    t = {n: df for n in ("order_filled", "orders_matched", "fee_charged", *(f"{a}_{b}" for a in ("ct", "nr") for b in ("position_split", "positions_merge", "payout_redemption")))}
    assert {r["value"] for r in checks.amounts_parse(t).collect()} == set(bad)


def test_known_refunds(spark):
    # Refunds and fees of known transactions.
    want = spark.createDataFrame([("3478260", "0"), ("39458310", "541690")], "refund string, fee string")
    assert checks.expected_rows(want, want).count() == 0
    assert {r["problem"] for r in checks.expected_rows(want.limit(1), want.unionAll(want.limit(1))).collect()} <= {"missing"}


def test_export_scan_seal(spark, tmp_path):
    root, t = str(tmp_path / "cold"), Tables(spark, SF)
    df = t["order_filled"].where("contract = 'CTFExchange'")
    lo = df.agg(F.min("block_number")).first()[0] // 10000 * 10000
    r = spark.createDataFrame([(lo, lo + 999_999)], "from_block long, to_block long")
    done = export.seal_ready({("CTFExchange", "order_filled"): df}, r, root)
    assert done["mismatches"].count() == 0
    stored = scan.scan_table(spark, root, "CTFExchange", "order_filled")
    n = df.where(F.col("block_number").between(lo, lo + 999_999)).count()
    assert stored.count() == n > 0 and stored.schema.fieldNames()[:-2] == stored_schema("CTFExchange", "order_filled").fieldNames()
    plan = scan.scan_block_range(spark, root, "CTFExchange", "order_filled", lo + 5, lo + 10)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(1M" in plan and "PushedFilters: [IsNotNull(block_number)" in plan
    again = export.seal_ready({("CTFExchange", "order_filled"): df}, r, root)
    assert again["written"].where("row_count > 0").count() == 0 and again["late"].count() == n
    m = export.build_manifest(spark, root)
    assert m.agg(F.sum("row_count")).first()[0] == n
    assert len(TABLES) == 29 and len(EVENTS) == 23


def test_a_partition_whose_rows_change_stays_staged(spark, tmp_path):
    root, t = str(tmp_path / "cold"), Tables(spark, SF)
    df = t["order_filled"].where("contract = 'CTFExchange'")
    lo = df.agg(F.min("block_number")).first()[0] // 10000 * 10000
    r = spark.createDataFrame([(lo, lo + 999_999)], "from_block long, to_block long")
    short = lambda *a: scan.scan_table(*a).where(f"not (`10K` = {lo} and log_index = 0)")
    done = export.seal_ready({("CTFExchange", "order_filled"): df}, r, root, read_back=short)
    assert [x["10K"] for x in done["mismatches"].collect()] == [lo]
    stored = scan.scan_table(spark, root, "CTFExchange", "order_filled")
    assert stored.where(F.col("10K") == lo).count() == 0 < stored.count()
    kept = done["staged"]["CTFExchange", "order_filled"]
    inside = F.col("block_number").between(lo, lo + 9_999)
    assert kept.where(inside).count() == df.where(inside).count() > 0 and kept.count() + stored.count() == df.count()
    again = export.seal_ready({("CTFExchange", "order_filled"): kept}, r, root)
    stored = scan.scan_table(spark, root, "CTFExchange", "order_filled")
    assert again["mismatches"].count() == 0 and stored.count() == df.where(F.col("block_number").between(lo, lo + 999_999)).count()


def test_report_skips_and_unexpected_passes(spark):
    class Some:
        def __init__(self):
            self.t, self.spark = Tables(spark, SF), spark

        def __getitem__(self, name):
            if name == "fee_charged":
                raise KeyError(name)
            return self.t[name].limit(0) if name == "condition_resolution" else self.t[name]

    names = ("f8_fee_tokens_registered", "f4_resolution_prepared", "f3_symmetric_pairs")
    got = {r["check_name"]: (r["violations"] is None, r["status"]) for r in checks.report(Some(), names, limit=1).collect()}
    assert got == {names[0]: (True, "skip"), names[1]: (False, "unexpected pass"), names[2]: (False, "fail")}


def test_report_reads_the_fills_five_times(spark, tmp_path, monkeypatch):
    """The shared passes count what the checks count one by one, on stored tables whose scans are counted in the plans."""
    t, stored, reads = Tables(spark, SF), {}, []

    class Stored:
        def __init__(self):
            self.spark = spark

        def __getitem__(self, name):
            if name not in stored:
                t[name].write.parquet(str(tmp_path / name))
                stored[name] = spark.read.parquet(str(tmp_path / name))
            return stored[name]

    def scans(df):
        relations = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation [" in x]
        return sum(",maker#" in x and ",order_hash#" in x for x in relations)  # only the fills have both

    keep = checks.materialize
    monkeypatch.setattr(checks, "materialize", lambda df, name: reads.append((name, scans(df))) or keep(df, name))
    s = Stored()
    got = checks.report(s)
    reads.append(("report", scans(got)))
    assert dict(reads) == {"orders": 1, "tokens": 1, "violations": 1, "report": 2}
    alone = {n: check(s).count() for n, (check, _, _) in checks.CHECKS.items()}
    assert {r["check_name"]: r["violations"] for r in got.collect()} == alone and sum(alone.values()) > 0


def test_ranges_prune_at_run_time(spark, tmp_path):
    root, t = str(tmp_path / "cold"), Tables(spark, SF)
    for c in ("CTFExchange", "NegRiskCtfExchange"):
        export.export_event(export.typed_projection(t["order_filled"].where(F.col("contract") == c), c, "order_filled"), root, c, "order_filled")
    inventory = scan.partition_inventory(spark, root)
    most = inventory.where("contract = 'CTFExchange'").groupBy("1M").count().agg(F.max(F.struct("count", "1M"))).first()[0]
    ranges_of = scan.complete_1m_ranges(inventory.where("contract = 'CTFExchange'"), "order_filled", full=most["count"])
    df = scan.scan_complete(spark, root, "order_filled", ranges_of)
    assert df._jdf.queryExecution().sparkPlan().toString().count("dynamicpruning") >= 2  # one a table
    wanted = {r["1M"] for r in ranges_of.collect()}
    assert df.count() == t["order_filled"].where((F.col("block_number") - F.col("block_number") % 1_000_000).isin(wanted)).count() > 0


def test_digests_are_those_of_the_files(spark, tmp_path):
    root, t = str(tmp_path / "cold"), Tables(spark, SF)
    c = "CTFExchange"
    rows = export.typed_projection(t["fee_charged"].where(F.col("contract") == c), c, "fee_charged")
    export.export_event(rows, root, c, "fee_charged")
    export.export_event(rows.limit(1), root, c, "fee_charged")  # a second file in one partition
    got = {r["path"].removeprefix("file:"): (r["length"], r["sha256"]) for r in export.file_digests(spark, root).collect()}
    files = list((tmp_path / "cold").rglob("*.parquet"))
    assert got == {str(f): (f.stat().st_size, hashlib.sha256(f.read_bytes()).hexdigest()) for f in files}
    m = {r["partition"]: r for r in export.build_manifest(spark, root).collect()}
    many = [r for r in m.values() if r["files"] == 2]
    assert len(many) == 1 and len(many[0]["sha256"]) == 64 and len(m) == len(files) - 1
    assert {r["version"] for r in m.values()} == {"v2"} and all(f"{p}/" in str(files) for p in m)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "from_block long, to_block long")
    assert ranges.merge_ranges(none).count() == 0 and ranges.complete_10k(none).count() == 0
    assert list(map(tuple, ranges.find_gaps(none, 5, 9).collect())) == [(5, 9)]
    raw = decode.encode(Tables(spark, SF)["order_filled"].limit(0), "order_filled")
    assert decode.decode_all(raw).count() == 0 and decode.undecodable(raw).count() == 0


def test_narrow_amounts(spark):
    df = spark.createDataFrame([("5",), (None,)], "a string")
    assert [r[0] for r in derive.narrow_amounts(df, ["a"]).collect()] == [5, None]
    with pytest.raises(Exception, match="does not fit"):
        derive.narrow_amounts(spark.createDataFrame([(str(2**70),)], "a string"), ["a"]).collect()


def test_feed_messages(spark):
    rows = [(1, '{"type":"snapshot","events":[{"tx_hash":"a","status":"pending"},{"tx_hash":"b","status":"confirmed"}]}'), (2, '{"type":"status_update","data":{"tx_hash":"a"}}'), (3, "{broken"), (4, '{"type":"pong"}')]
    got = {(r["tx_hash"], r["status"]) for r in feed.parse_feed(spark.createDataFrame(rows, "arrival_ms long, body string")).collect()}
    assert got == {("a", "pending"), ("b", "confirmed"), ("a", "confirmed")}


def test_what_is_no_number_of_256_bits_is_null(spark):
    """Long texts that are no numbers, or too large, gave digits of their own before."""
    bad = ["x" * 30, "1" * 19 + "x", str(2**256), "9" * 90, "-" + "1" * 20]
    df = spark.createDataFrame([(x,) for x in bad], "d string")
    assert [r[0] for r in df.select(U.u256_hex(F.col("d"))).collect()] == [None] * len(bad)
    words = ["zz" + "1" * 62, "1_" + "1" * 62, "f" * 65]
    df = spark.createDataFrame([(x,) for x in words], "w string")
    assert [tuple(r) for r in df.select(U.u256_dec(F.col("w")), U.i256_dec(F.col("w"))).collect()] == [(None, None)] * len(words)
    edges = [str(2**255 - 1), str(-(2**255)), str(2**255), "-1"]
    got = spark.createDataFrame([(x,) for x in edges], "d string").select(U.i256_dec(U.i256_hex(F.col("d")))).collect()
    assert [r[0] for r in got] == [edges[0], edges[1], None, "-1"]


@pytest.mark.parametrize("how", ["", "dealt", "kept"])
def test_fills_are_those_of_the_recipe(spark, how):
    import duckdb

    from blockloom.plans.fixtures import duck

    con = duckdb.connect()
    for n in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    got = Tables(spark, SF, how)["fills"]
    want = con.execute(duck(f"SELECT {', '.join(got.columns)} FROM fills")).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_dealt_tables_are_written_in_one_pass_with_one_exchange(spark, tmp_path):
    """Ids are made after the only exchange of rows, and each partition is one file."""
    t, root = Tables(spark, SF).dealt(), str(tmp_path / "cold")
    tables = {(c, e): t[e].where(F.col("contract") == c) for c in ("CTFExchange", "NegRiskCtfExchange") for e in ("order_filled", "fee_charged")}
    export.export_dealt(tables, root)
    inventory = scan.partition_inventory(spark, root)
    assert inventory.agg(F.max("files")).first()[0] == 1
    for (c, e), df in tables.items():
        assert scan.scan_table(spark, root, c, e).count() == df.count() > 0
    both = tables["CTFExchange", "order_filled"].select("transaction_hash").unionAll(tables["CTFExchange", "fee_charged"].select("transaction_hash"))
    both.collect()
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_refunds_meet_fills_in_one_exchange(spark):
    """F10, F11 and G5 against plain counts, with ids that are missing or no hex; the fills and refunds are each sent once."""
    fills = spark.createDataFrame([("aa", "01", 0, "1500"), ("aa", "02", 1, "700"), ("aa", None, 2, "5"), ("bb", "01", 0, "9"), (None, "01", 0, "3"), ("Xy", "01", 0, "2000")], "transaction_hash string, order_hash string, log_index long, fee string")
    refunds = spark.createDataFrame([("aa", "01", "1000", "500"), ("aa", "02", "1", "0"), ("aa", None, "5", "0"), ("Xy", "01", "2000", "0"), (None, "01", "3", "0")], "transaction_hash string, order_hash string, refund string, fee_charged string")
    got = {tuple(r) for r in checks.refund_identity({"order_filled": fills, "fee_refunded": refunds}).collect()}
    assert got == {("aa", "02", "700", "1", 1, 1), ("aa", None, "5", None, 1, None), ("aa", None, None, "5", None, 1), (None, "01", None, "3", None, 1)}
    net = {(r["transaction_hash"], r["order_hash"]): r["net_fee"] for r in derive.net_fees(fills, refunds).collect()}
    assert net == {("aa", "01"): "500", ("aa", "02"): "699", ("aa", None): "5", ("bb", "01"): "9", (None, "01"): "3", ("Xy", "01"): "0"}
    cols = ["transaction_hash", "order_hash", "refund"]
    want = fills.selectExpr("transaction_hash", "order_hash", "fee as refund")
    rows = sorted(map(str, checks.expected_rows(refunds.select(*cols), want.unionAll(want.where("order_hash = '02'")), "transaction_hash").collect()))
    plain = want.unionAll(want.where("order_hash = '02'")).where("transaction_hash in ('aa', 'Xy')")
    f = refunds.select(*cols)
    assert rows == sorted(map(str, f.exceptAll(plain).selectExpr("*", "'extra' as problem").unionAll(plain.exceptAll(f).selectExpr("*", "'missing' as problem")).collect()))
    df = derive.net_fees(fills, refunds)
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_a_large_market_is_met_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(derive, "BLOCK", 7)
    c = spark.range(50).selectExpr("concat('t', id) as transaction_hash", "'m' as market_id")
    q = spark.range(40).selectExpr("'m' as market_id", "concat('q', id) as question_id", "id as index_val")
    p = spark.range(30).selectExpr("concat('q', id) as question_id", "concat('c', id) as condition_id", "2 as outcome_slot_count")
    got = derive.converted_market_conditions(c, q, p)
    assert got.count() == got.distinct().count() == 50 * 30
