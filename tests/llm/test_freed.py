"""What is written to the shared folder leaves no shuffle files, and chains settled at once are those settled one by one."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockloom.llm import passages, spark_io
from blockloom.sources import shared

from test_all_partners import corpus


def _shuffled(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


@pytest.mark.parametrize("of", [spark_io, shared])
def test_no_shuffle_files_are_left(spark, of):
    before, kept = _shuffled(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 3).alias("k")).agg(F.count("*").alias("n"))
    out = of.materialize(df, "freed")
    ends = time.time() + 20
    while _shuffled(spark) - before and time.time() < ends:  # they are deleted in the background
        time.sleep(0.1)
    assert not _shuffled(spark) - before
    assert out.agg(F.sum("n")).first()[0] == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept


def test_all_stretches_are_those_of_each_row():
    rng = np.random.default_rng(3)
    flags = rng.random((300, 200)) < rng.choice([0.7, 0.8, 0.85, 0.95], 300)[:, None]
    lo, hi = rng.integers(0, 80, 300), rng.integers(100, 201, 300)
    total = np.zeros((300, 201), np.int32)
    np.cumsum(np.where(flags, 1, -passages.PENALTY), axis=1, out=total[:, 1:])
    want = {(i, int(lo[i]) + s, int(lo[i]) + e, m) for i in range(300) for s, e, m in passages.stretches(flags[i, lo[i] : hi[i]])}
    got = list(zip(*(x.tolist() for x in passages._all_stretches(total, lo, hi))))
    assert len(got) == len(want) > 100 and set(got) == want


def test_chains_settled_at_once():
    rng = np.random.default_rng(4)
    chains, words, opened = [], [], []
    for k in range(400):
        d, a = rng.integers(0, 1 << 32, (2, int(rng.integers(60, 500))), dtype=np.uint32)
        a = a[: int(rng.integers(50, len(a) + 1))] if k % 5 == 0 else a
        alike = rng.random(len(a)) < rng.choice([0.6, 0.8, 0.95])
        d[: len(a)][alike] = a[alike]
        p = np.sort(rng.choice(len(a) - 5, 1 if k % 2 else int(rng.integers(2, 5)), replace=False)).astype(np.int32)
        for x in p:
            d[x : x + 5] = a[x : x + 5]
        chains.append((p, len(d) - int(p[-1]) - 5))
        words.append((d, a))
        opened.append(passages.open_words(d, 0, p, p))
    ends = np.cumsum([len(w) for w in opened])
    c = {k: np.array([p[i] for p, _ in chains], np.int64) for k, i in (("ds", 0), ("as", 0), ("de", -1), ("ae", -1))}
    c |= {"tail": np.array([min(t, passages.REACH) for _, t in chains], np.int64), "end": ends, "start": ends - [len(w) for w in opened]}
    size = np.array([len(a) for _, a in words])
    (i, s, e, m), rest = passages.settled_at_once(c, np.concatenate([*opened, [0]]), np.cumsum(size) - size, np.concatenate([a for _, a in words] + [[0]]), size)
    got, want = set(zip(*(x.tolist() for x in (i, s, e, m)))), set()
    for k, ((p, _), (d, a), w) in enumerate(zip(chains, words, opened)):
        first, flags = passages.align(w, passages.open_words(a, 1, p, p), p, p)
        found = {(k, first + x, first + y, n) for x, y, n in passages.stretches(flags)}
        want |= found if len(p) == 1 else set()
        assert len(p) == 1 or not found or k in rest
    assert got == want and len(want) > 20
    assert len(rest) < 200 and all(len(chains[k][0]) > 1 for k in rest)


def test_open_places_meet_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(passages, "ROUND_BYTES", 0)
    monkeypatch.setattr(passages, "LEAST_ROUND", 4000)
    made, real = [], passages.materialize
    monkeypatch.setattr(passages, "materialize", lambda df, name: made.append(name) or real(df, name))
    rng = random.Random(21)
    rows = [r for k in range(8) for r in corpus(rng, 100 * k)]
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {tuple(r)[:4] for r in got} == {(100 * k + 29, 100 * k + 28, 40, 100) for k in range(8)}
    assert made.count("met") > 2
