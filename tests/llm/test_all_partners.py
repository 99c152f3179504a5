"""Passages whose seeds all stand in smaller documents, each in another one, in parts too short to meet on."""

import random

import numpy as np
import pytest

from blockloom.llm import passages


def corpus(rng, base):
    """28 smaller documents with two seeds each of a passage of 60 words, the passage, and it with every twelfth word changed."""
    new = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    text = new(60)
    docs = [new(30) + text[s : s + 6] + new(30) for s in range(0, 56, 2)]
    other = [new(1)[0] if i % 12 == 7 else w for i, w in enumerate(text)]
    return [(base + i, " ".join(d)) for i, d in enumerate([*docs, new(30) + text + new(30), new(40) + other + new(40)])]


@pytest.mark.parametrize("tile", [passages.TILE, 2])
def test_all_smaller_documents_with_a_seed_are_partners(spark, monkeypatch, tile):
    monkeypatch.setattr(passages, "TILE", tile)
    rng = random.Random(21)
    rows = [r for k in range(20) for r in corpus(rng, 100 * k)]
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {tuple(r)[:4] for r in got} == {(100 * k + 29, 100 * k + 28, 40, 100) for k in range(20)}


def test_links_to_a_repeated_place_are_all_tried():
    p = np.arange(0, 50, 10)
    one = np.ones(len(p), np.int64)
    chains, lone = passages._chain_rows(one, p, 0 * one, 7 * one)
    assert not chains and lone[1].tolist() == p.tolist()


def test_codes_lose_no_passage():
    rng = np.random.default_rng(22)
    words = 2 * passages.REACH + passages.SEED_WORDS
    seen = 0
    for _ in range(3000):
        x = rng.integers(0, 4, words)
        flags = rng.random(words) < rng.choice([0.5, 0.8, 0.9])
        flags[passages.REACH : passages.REACH + passages.SEED_WORDS] = True
        y = np.where(flags, x, x ^ rng.integers(1, 4, words))  # words that differ have other codes: the hardest case
        there = np.zeros((1, words), bool)
        there[0, rng.integers(0, 129) : words - rng.integers(0, 129)] = True
        (room, a), (_, b) = passages._planes(x[None].astype(np.uint8), there), passages._planes(y[None].astype(np.uint8), there)
        total = np.cumsum(np.append(0, np.where(flags & there[0], 1, np.where(there[0], -passages.PENALTY, -1000))))
        s, e = np.arange(passages.REACH + 1), np.arange(passages.REACH + passages.SEED_WORDS, words + 1)
        n = e[None] - s[:, None]
        fit = (total[e][None] >= total[s][:, None]) & (n >= passages.MIN_WORDS)
        if fit.any():
            seen += 1
            assert passages._may_repeat(a, b, room).all()
        runs = np.convolve(flags & there[0], np.ones(5), "valid") == 5
        first = np.array([not runs[k : passages.REACH].any() for k in s])  # no seed of the stretch before this one
        if (fit & (n < 2 * passages.MIN_WORDS) & first[:, None]).any():
            assert passages._may_start(a.view(np.uint64)[:, ::2], b.view(np.uint64)[:, ::2]).all()
    assert seen > 500
