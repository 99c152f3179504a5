"""Runs of one word, as junk has them, in the round in which open places meet all smaller documents with their seeds."""

import numpy as np
import pytest

from blockloom.llm import passages


def entries(key, d, p, before, asks):
    e = np.zeros(len(key), passages._ENTRY)
    e["key"], e["d"], e["p"], e["before"], e["role"] = key, d, p, before, 2 + asks
    e = e[np.lexsort((e["p"], e["d"], e["key"]))]
    inner, of = passages._inner(e["key"], e["before"])
    e["role"] += 4 * inner.astype(np.uint8)
    n = np.bincount(2 * of + inner, minlength=2 * (of.max() + 1)).reshape(-1, 2)[of]
    return e, passages._dealt(e, n[:, 0], n[:, 1], 8)


@pytest.mark.parametrize("tile", [1000, 7, 2, 1])
def test_tiles_try_each_pair_once(monkeypatch, tile):
    monkeypatch.setattr(passages, "TILE", tile)
    monkeypatch.setattr(passages, "_may_start", lambda x, y: np.ones(len(x), bool))
    monkeypatch.setattr(passages, "_may_repeat", lambda x, y, room: np.ones(len(x), bool))
    monkeypatch.setattr(passages, "_gain", lambda x, y, room: (np.zeros(len(x), int),) * 3)
    rng, n = np.random.default_rng(31), 300
    e, (deal, sent) = entries(rng.integers(0, 4, n) << 40, rng.integers(0, 40, n), np.arange(n), rng.choice([0, 3, 3, 3, 9, 11], n), rng.integers(0, 2, n))
    got = []
    for x in np.unique(deal):
        f = sent[deal == x]
        i, j, _ = passages._meet(f)
        got += zip(f["p"][i].tolist(), f["p"][j].tolist())
    want = [(a["p"], b["p"]) for a in e for b in e if a["key"] == b["key"] and a["role"] & 1 and b["d"] < a["d"] and (a["before"] != b["before"] or not a["before"])]
    assert sorted(got) == sorted(want)


def test_runs_are_sent_once():
    """2000 documents with a run of 30 seeds each: only the first of a run is sent to all tiles (before, all were)."""
    d, place = np.repeat(np.arange(2000), 30), np.tile(np.arange(30), 2000)
    e, (deal, sent) = entries(d * 0 + 5, d, place, np.where(place, 5, 100 + d), np.ones(len(d), int))
    assert len(e) == 60_000 and (sent["role"] & 4 > 0).sum() == 2 * 58_000 and len(sent) < 5 * len(e)


def test_sum_and_reach_of_the_best_stretches():
    """A run of 44 words around a seed is a stretch with six more words on either side: both count."""
    flags = np.zeros(2 * passages.REACH + passages.SEED_WORDS, bool)
    flags[passages.REACH - 20 : passages.REACH + 24] = True
    x = np.zeros((1, len(flags)), np.uint8)
    there = np.ones(x.shape, bool)
    (room, a), (_, b) = passages._planes(x, there), passages._planes(np.where(flags, x, 15).astype(np.uint8), there)
    assert [int(v[0]) for v in passages._gain(a, b, room)] == [44 - 6 * passages.PENALTY, 26, 25]
