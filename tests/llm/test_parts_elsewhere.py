"""Fuzzy passages whose parts also stand in smaller documents."""

import random

import pytest

from blockloom.llm import passages


def corpus(rng, words, changed, parts, base):
    """Documents of one case: parts of a passage in three smaller ones, then the passage, then it with some words changed."""
    new = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    text = new(words)
    lengths = [rng.randint(*parts) for _ in range(3)]
    starts = [round(i * (words - lengths[i]) / 2) for i in range(3)]
    docs = [new(20) + text[s : s + n] + new(20) for s, n in zip(starts, lengths)]
    rng.shuffle(docs)
    other = list(text)
    for i in rng.sample(range(words), changed):
        other[i] = new(1)[0]
    docs += [new(30) + text + new(30), new(40) + other + new(40)]
    return [(base + i, " ".join(d)) for i, d in enumerate(docs)], (base + 4, base + 3, 40, 40 + words)


@pytest.mark.parametrize("words,changed,parts", [(80, 0, (30, 30)), (80, 2, (30, 30)), (80, 6, (30, 30)), (60, 5, (22, 24))])
def test_passages_with_parts_elsewhere_are_found(spark, words, changed, parts):
    rng = random.Random(words + changed)
    rows, want = [], []
    for k in range(100):
        docs, planted = corpus(rng, words, changed, parts, 10 * k)
        rows += docs
        want.append(planted)
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    found = {(r["doc_id"], r["source_id"]): (r["start_word"], r["end_word"]) for r in got}
    hit = [w for w in want if w[:2] in found and found[w[:2]][0] < w[2] + 12 and found[w[:2]][1] > w[3] - 12]
    assert len(hit) >= 95
    assert all(r["doc_id"] % 10 == 4 and r["source_id"] % 10 == 3 for r in got)  # nothing else repeats


def test_parts_of_parts_take_further_rounds(spark):
    """Two neighbouring parts stand together in other documents too, so the pair of documents with all four meets in the
    third round."""
    rng = random.Random(8)
    new = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for k in range(20):
        p = [new(18) for _ in range(4)]
        docs = [p[0], p[1], p[2], p[3], p[0] + p[1], p[1] + p[2], p[2] + p[3], sum(p, [])]
        other = sum(p, [])
        other[rng.randrange(5, 60)] = "changed"
        rows += [(20 * k + i, " ".join(new(12) + d + new(12))) for i, d in enumerate([*docs, other])]
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["source_id"]) for r in got} >= {(20 * k + 8, 20 * k + 7) for k in range(20)}
