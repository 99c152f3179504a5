"""Streams against their batch twins: several micro-batches, broken batches, state that stays bounded."""

import duckdb
import pytest
from pyspark.sql import functions as F

from blockloom.plans.fixtures import Tables
from blockloom.queries import ORACLE_SQL, QUERIES, _in_turns
from blockloom.sources import scan
from blockloom.streaming import feed, live

SF = "/root/testdata/sf0.001"


def agrees(spark, name, sf=SF):
    con = duckdb.connect()
    for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{sf}/{n}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    rows = sorted(map(str, want.fetchall()))
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in df.select(*names).collect()) == rows
    return len(rows)


@pytest.mark.parametrize("name", ["h6_stream_settlements", "h7_stream_counts", "h8_stream_inclusion", "h9_stream_in_flight", "h10_stream_regressions"])
def test_streams_equal_their_batch_twins(spark, name):
    assert agrees(spark, name) > 0


def logs(spark, rows):
    return spark.createDataFrame(rows, "arrival_seq long, block_number long, tx_hash string")


def test_regressions_carry_the_highest_block_on(spark, tmp_path):
    parts = [logs(spark, [(0, 5, "a"), (1, 9, "b"), (2, 7, "c")]), logs(spark, [(3, 8, "d"), (4, 9, "e"), (5, 10, "f")]), logs(spark, [(6, 9, "g")])]
    out, state, offsets = (str(tmp_path / n) for n in ("out", "state", "offsets"))
    _in_turns(Tables(spark, SF), parts, lambda s: live.stream_regressions(s, out, state, offsets))
    got = sorted((r["arrival_seq"], r["highest"], r["batch"]) for r in spark.read.parquet(out).collect())
    assert got == [(2, 9, 0), (3, 9, 1), (6, 10, 2)]


def test_regressions_of_a_long_feed_are_dealt_out(spark, tmp_path):
    n = 20_000
    rows = spark.range(n).select(F.col("id").alias("arrival_seq"), (F.col("id") - F.when(F.col("id") % 97 == 3, 50).otherwise(0)).alias("block_number"), F.lit("t").alias("tx_hash"))
    out, state, offsets = (str(tmp_path / x) for x in ("out", "state", "offsets"))
    _in_turns(Tables(spark, SF), [rows.where("arrival_seq < 9000"), rows.where("arrival_seq >= 9000")], lambda s: live.stream_regressions(s, out, state, offsets))
    want = feed.block_regressions(rows)
    got = spark.read.parquet(out).select(want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()
    assert not (tmp_path / "state" / "-1").exists()


def messages(spark, rows):
    return spark.createDataFrame(rows, live.FEED)


def test_blocks_close_once_and_late_logs_are_told(spark, tmp_path):
    c, s = (lambda ms, block, tx: ("confirmed", ms, block, tx)), (lambda ms, tx: ("settlement", ms, None, tx))
    parts = [
        [c(1000, 10, "a"), s(500, "a"), c(1100, 10, "b"), s(1200, "z")],
        [c(2000, 11, "d"), c(2500, 10, "e"), s(2600, "b"), s(900, "e")],  # e comes after block 10 is final, within the grace; b is announced too late
        [c(9000, 12, "f"), s(9000, "x")],  # closes 10
        [c(9100, 10, "g"), c(20000, 13, "h"), s(8000, "f")],  # g is late; 11 can't close before the settlements have been heard of
        [s(20000, "y")],
    ]
    out, state, offsets = (str(tmp_path / n) for n in ("out", "state", "offsets"))
    _in_turns(Tables(spark, SF), [messages(spark, p) for p in parts], lambda f: live.stream_inclusion(f, out, state, offsets, grace_ms=5000, hold_ms=9000))
    closed = sorted((r["batch"], r["block_number"], r["trades"], r["not_seen"]) for r in spark.read.parquet(f"{out}/closed").collect())
    assert closed == [(2, 10, 3, 1), (4, 11, 1, 1)]
    assert [(r["batch"], r["tx_hash"]) for r in spark.read.parquet(f"{out}/late").collect()] == [(3, "g")]
    now = {r["batch"]: (r["block_number"], r["trades"], r["not_seen"]) for r in spark.read.parquet(f"{out}/current").collect()}
    assert now == {0: (10, 2, 1), 1: (11, 1, 1), 2: (12, 1, 1), 3: (13, 1, 1), 4: (13, 1, 1)}
    assert {r["tx_hash"] for r in spark.read.parquet(f"{state}/4/seen").collect()} == {"y"} and not (tmp_path / "state" / "2").exists()


def test_inclusion_state_is_bounded(spark, tmp_path):
    """Ten times the feed leaves no larger state; a batch that is run again gives the same."""
    rows = []
    for i in range(600):
        rows += [("confirmed", 1000 * i, 100 + i, f"t{i}"), ("settlement", 1000 * i - 300, None, f"t{i}")]
    out, state, offsets = (str(tmp_path / n) for n in ("out", "state", "offsets"))
    parts = [messages(spark, rows[k : k + 400]) for k in range(0, 1200, 400)]
    sizes = []

    def run(stream):
        q = live.stream_inclusion(stream, out, state, offsets, grace_ms=10_000, hold_ms=60_000)
        q.awaitTermination()
        i = max(int(p.name) for p in (tmp_path / "state").iterdir())
        sizes.append((spark.read.parquet(f"{state}/{i}/trades").count(), spark.read.parquet(f"{state}/{i}/seen").count()))
        return q

    _in_turns(Tables(spark, SF), parts, run)
    assert all(trades <= 12 and seen <= 62 for trades, seen in sizes) and len(sizes) == 3
    closed = spark.read.parquet(f"{out}/closed")
    assert closed.count() == closed.select("block_number").distinct().count() == 588  # block i is final at i + 1 s, and settlements have been heard of to 598.7 s
    want = feed.block_inclusion(messages(spark, [r for r in rows if r[0] == "confirmed"]), messages(spark, [r for r in rows if r[0] == "settlement"]))
    assert closed.select(want.columns).exceptAll(want).count() == 0


def test_session_state_is_evicted(spark, tmp_path):
    stamp = lambda rows: spark.createDataFrame(rows, "ms long, block_number long, tx_hash string").select(F.timestamp_millis("ms").alias("ts"), "block_number", "tx_hash")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    states = []
    for k in range(6):
        stamp([(1_000_000 * (k + 1) + 10 * j, 100 * k + j // 2, f"t{k}{j // 3}") for j in range(60)]).coalesce(1).write.mode("append").parquet(src)
        s = live.stream_block_counts(spark.readStream.schema("ts timestamp, block_number long, tx_hash string").parquet(src))
        q = s.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
        q.awaitTermination()
        states.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(states) <= 30 and spark.read.parquet(out).count() == 150  # the last turn's thirty blocks are still open


def stored(spark, root):
    return scan.scan_table(spark, root, "CTFExchange", "order_filled")


def test_replays_beyond_any_watermark_are_dropped(spark, tmp_path):
    t = Tables(spark, SF)
    rows = t["order_filled"].where("contract = 'CTFExchange'").drop("contract")
    lo, hi = rows.agg(F.min("block_number"), F.max("block_number")).first()
    root, offsets = str(tmp_path / "root"), str(tmp_path / "offsets")
    early, late = rows.where(F.col("block_number") < (lo + hi) // 2), rows.where(F.col("block_number") >= (lo + hi) // 2)
    _in_turns(t, [early, late, early.unionAll(late.limit(5))], lambda s: feed.stream_store(s, "CTFExchange", "order_filled", root, offsets))
    assert stored(spark, root).count() == rows.select("block_number", "log_index").distinct().count()


@pytest.mark.parametrize("few", [0, 500_000])
def test_replays_move_no_rows(spark, tmp_path, monkeypatch, few):
    """What a batch repeats is found by the numbers of its keys; new rows among replays are stored, the first in the order."""
    monkeypatch.setattr(feed, "FEW_NEW", few)
    written, real = [], feed.materialize
    monkeypatch.setattr(feed, "materialize", lambda df, name: written.append(df.columns) or real(df, name))
    t = Tables(spark, SF)
    rows = t["order_filled"].where("contract = 'CTFExchange'").drop("contract").dropDuplicates(["block_number", "log_index"]).withColumn("delivery", F.lit(1))
    old, new = rows.where("log_index < 2"), rows.where("log_index >= 2")
    again = [old.withColumns({"delivery": F.lit(0), "fee": F.lit("7")}), new.withColumn("fee", F.lit("8")), new.withColumns({"delivery": F.lit(0), "fee": F.lit("9")})]
    root, offsets = str(tmp_path / "root"), str(tmp_path / "offsets")
    nulls = new.limit(1).withColumn("log_index", F.lit(None).cast("int"))  # a key like any other
    _in_turns(t, [old, again[0].unionAll(again[1]).unionAll(again[2]).unionAll(nulls), nulls], lambda s: feed.stream_store(s, "CTFExchange", "order_filled", root, offsets, ("delivery", "transaction_hash")))
    got = stored(spark, root)
    assert got.where("log_index is null").count() == 1
    assert got.where("log_index is not null").count() == rows.count()
    assert got.where("log_index >= 2 and fee <> '9'").count() == got.where("log_index < 2 and fee = '7'").count() == 0
    assert got.where("log_index >= 2").count() == new.count() > 0
    assert written and all(columns == ["block_number", "log_index"] for columns in written)


def test_the_watermark_evicts(spark, tmp_path):
    """With a bounded memory a replay within the delay is dropped, and one after it comes through again."""
    def rows(*each):
        df = spark.createDataFrame([(ms, block, 1) for ms, block in each], "ms long, block_number long, log_index long")
        return df.select(F.timestamp_millis("ms").alias("ts"), "block_number", "log_index")

    def run(stream):
        out = feed.stream_dedup(stream, "ts", "1 minute").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        return out.option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()

    _in_turns(Tables(spark, SF), [rows((1000, 1)), rows((2000, 1)), rows((10**7, 2)), rows((10**7 + 1, 3)), rows((10**7 + 5, 1), (10**7 + 6, 2))], run)
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("block_number").count().collect()
    assert sorted(map(tuple, got)) == [(1, 2), (2, 1), (3, 1)]


class Broken(Exception):
    pass


def test_a_batch_broken_at_any_step_seals_exactly_once(spark, tmp_path):
    t = Tables(spark, SF)
    df = t["order_filled"].where("contract = 'CTFExchange'").drop("contract")
    lo = df.agg(F.min("block_number")).first()[0] // 10000 * 10000
    mid = lo + 200_000
    root, state, offsets = (str(tmp_path / n) for n in ("root", "state", "offsets"))
    reach = lambda i: spark.createDataFrame([(lo, mid - 1 if i == 0 else mid + 99_999)], "from_block long, to_block long")
    parts = [df.where(f"block_number < {mid} and block_number % 2 = 0"), df.where(f"block_number >= {mid} or block_number % 2 = 1")]
    todo = {(step, 1) for step in ("planned", "released", "late", "staged")} | {("released", 0)}

    turns = []

    def after(step, i):
        if (step, i) in todo:
            todo.discard((step, i))
            raise Broken(step)

    def start(stream):
        run = lambda: feed.stream_seal(stream, "CTFExchange", "order_filled", reach, root, state, offsets, after)
        for _ in range(sum(i == len(turns) for _, i in todo)):
            with pytest.raises(Exception, match="Broken"):
                run().awaitTermination()
        turns.append(1)
        return run()

    _in_turns(t, parts, start)
    assert not todo
    released = stored(spark, root)
    sealed = {r["k"] for r in parts[0].selectExpr("block_number div 10000 as k").distinct().collect()}
    want = df.where(F.col("block_number") < mid + 100_000)
    late = want.where(f"block_number < {mid} and block_number % 2 = 1").where(F.expr("block_number div 10000").isin(sealed))
    assert released.count() == released.select("block_number", "log_index").distinct().count() == want.count() - late.count()
    told = [spark.read.parquet(f"{state}/{i}/late").count() for i in range(2)]
    assert told == [0, late.count()] and late.count() > 0
    assert spark.read.parquet(f"{state}/1/staged").count() == df.where(F.col("block_number") >= mid + 100_000).count()


def test_a_record_holds_the_rows_of_its_batch_only(spark, tmp_path):
    """Rows that stay staged are not copied into the record of the next batch, which still releases them."""
    t = Tables(spark, SF)
    df = t["order_filled"].where("contract = 'CTFExchange'").drop("contract")
    lo, hi = (b // 10000 * 10000 for b in df.agg(F.min("block_number"), F.max("block_number")).first())
    root, state, offsets = (str(tmp_path / n) for n in ("root", "state", "offsets"))
    reach = lambda i: spark.createDataFrame([(lo, hi + 9999 if i else lo - 1)], "from_block long, to_block long")
    parts, records = [df.where("log_index > 0"), df.where("log_index = 0")], []
    after = lambda step, i: step == "planned" and records.append(spark.read.parquet(f"{state}/{i}/rows").count())
    _in_turns(t, parts, lambda s: feed.stream_seal(s, "CTFExchange", "order_filled", reach, root, state, offsets, after))
    assert records == [p.count() for p in parts]
    assert stored(spark, root).count() == df.count() and spark.read.parquet(f"{state}/1/staged").count() == 0


def test_catching_up_ends_at_the_tolerance(spark, tmp_path):
    path = str(tmp_path / "ranges")
    for k in range(6):
        spark.createDataFrame([(100 * k, 100 * k + 99)], "from_block long, to_block long").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("from_block long, to_block long").option("maxFilesPerTrigger", 1).parquet(path)
    state = str(tmp_path / "state")
    assert feed.catch_up(stream, lambda i: 400 + 20 * i, 70, state, str(tmp_path / "at")) == 3
    got = {r["step"]: (r["blocks_behind"], r["lagging"]) for r in spark.read.parquet(f"{state}/lag").collect()}
    assert got == {0: (301, True), 1: (221, True), 2: (141, True), 3: (61, False)}
    with pytest.raises(Exception, match="no head"):
        feed.catch_up(stream, lambda i: 1 / 0 if i < 0 else (_ for _ in ()).throw(ValueError("no head")), 5, str(tmp_path / "s2"), str(tmp_path / "at2"))
