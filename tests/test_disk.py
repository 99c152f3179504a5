"""Stored fills are made without passing through Python, in tasks of a bounded number of rows, and leave no shuffle files."""

import os
from contextlib import contextmanager

from blockloom import queries
from blockloom.operators import checks
from blockloom.plans import fixtures
from blockloom.sources import export

SF = "/root/testdata/sf0.001"


def test_hex_ids_do_not_pass_through_python(spark):
    t = fixtures.Tables(spark, SF)
    rows = t["order_filled"].where("contract = 'CTFExchange'")
    either, in_hex = (export.typed_projection(rows, "CTFExchange", "order_filled", ids_in_hex=x) for x in (False, True))
    assert either.exceptAll(in_hex).isEmpty() and in_hex.exceptAll(either).isEmpty()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan(either) and "ArrowEvalPython" not in plan(in_hex)


def test_dealt_rows_are_bounded_by_task(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "ROWS", 500)
    t = fixtures.Tables(spark, SF).dealt()
    n = t["lineitem"].count()
    rows = t["order_filled"]
    assert rows.rdd.getNumPartitions() == 1 + n // 500 and rows.count() == n


def test_exports_leave_no_shuffle_files(spark, monkeypatch):
    freed, real = [], export.freeing

    @contextmanager
    def freeing(session):
        freed.append(1)
        with real(session):
            yield

    monkeypatch.setattr(export, "freeing", freeing)
    assert queries.QUERIES["a2_scan_event"](spark, SF).count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert freed


def test_sealing_keeps_one_copy(spark, monkeypatch, tmp_path):
    """What was verified and moved below the root is not kept beside it, nor what a batch before left staged."""
    areas, real = [], export.shared_path
    monkeypatch.setattr(export, "shared_path", lambda s, name: areas.append(real(s, name)) or areas[-1])
    states, path = [], queries.shared_path
    monkeypatch.setattr(queries, "shared_path", lambda s, name: states.append((name, path(s, name))) or states[-1][1])
    queries.QUERIES["h3_stream_seal"](spark, SF).count()
    at = lambda p: p.removeprefix("file:")
    assert len(areas) == 3 and not any(os.path.exists(at(p)) for p in areas)
    state = at(dict(states)["state"])
    assert [i for i in range(3) if os.path.exists(f"{state}/{i}/staged")] == [2]


def test_checks_of_the_report_are_run_apart(spark, monkeypatch):
    """Each check leaves one row in a table of its own; the report itself shuffles nothing but these."""
    made, real = [], checks.materialize
    monkeypatch.setattr(checks, "materialize", lambda df, name: made.append(name) or real(df, name))
    got = queries.QUERIES["f0_report"](spark, SF)
    assert made.count("check") == sum(not checks._local(n) for n in checks.CHECKS) > 15
    relations = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation [" in x]
    assert len(relations) == len(checks.CHECKS) and all("violations" in x for x in relations)
    assert {r["check_name"] for r in got.collect()} == set(checks.CHECKS)


def test_landed_logs_are_deleted_as_they_are_decoded(spark, monkeypatch):
    paths, real = [], queries.shared_path
    monkeypatch.setattr(queries, "shared_path", lambda s, name: paths.append((name, real(s, name))) or paths[-1][1])
    n = queries.QUERIES["h1_stream_decode"](spark, SF).count()
    at = dict(paths)["logs"].removeprefix("file:")
    landed = len([f for f in os.listdir(at) if f.endswith(".json.gz")])
    assert n and landed <= queries.FILES  # those of the last batch may stay


def test_typed_tables_deal_out_numbers(spark, monkeypatch):
    """The rows of all stored tables stay where the numbers they are made of were dealt out to."""
    taken = []
    monkeypatch.setattr(queries.X, "export_all", lambda rows, root, dealt=False: taken.append((rows, dealt)))
    monkeypatch.setattr(queries, "_all_tables", lambda t, root: None)
    queries.QUERIES["c24_typed_tables"](spark, SF)
    (rows, dealt), = taken
    assert dealt and "RepartitionByExpression [nr" in rows._jdf.queryExecution().optimizedPlan().toString()
