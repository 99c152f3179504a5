"""Cases at the edges of contracts: numbers that look like letters, ids near the end of longs, long words."""

from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from blockloom.llm import language, licenses, sentencepieces

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s.example", len(t)) for i, t in rows], DOCS)


def test_numbers_are_no_letters(spark):
    rows = [(i, f"the words of a text number {i} are here", "en") for i in range(40)] + [(100, "½ ² ①", None), (101, "Ⅳ 12", None), (102, "ª", None), (103, "é", None), (104, "", None), (105, None, None)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[i] for i in (100, 101, 102, 103, 104, 105)] == ["und", "und", "en", "en", "und", "und"]


@pytest.mark.parametrize("ids", [(2**63 - 2, 2**63 - 2, None), (-(2**63), -(2**63), 2**63 - 1, 2**63 - 1, None), (0, 0, None)])
def test_ids_at_the_ends_of_longs(spark, ids):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(70))
    rows = [(i, text(k)) for k, i in enumerate(ids)] + [(7, text(0)), (9, "bad " * 80)]
    kept = corpus_pipeline.keep_quality(spark, docs(spark, rows), "")
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted((i is None, i or 0) for i in (*ids, 7))
    once = corpus_pipeline.keep_one_of_each(spark, docs(spark, rows), "")
    assert once.count() == len(ids) + 1  # the copy of the first text goes, whichever of the two it is


def test_long_words_are_not_remembered():
    _, agenda = sentencepieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    held = len(agenda)
    agenda.encode("a" * 5000 + " " + "b" * 70)
    assert len(agenda) == held and agenda.held <= sentencepieces.MEMO_BYTES + 10_000


def test_memory_is_bounded_by_bytes(monkeypatch):
    processor, _ = sentencepieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(sentencepieces, "MEMO_BYTES", 20_000)
    agenda = sentencepieces.Agenda(processor)
    for i in range(500):
        text = f"word{i} other{i * 7}"
        assert agenda.encode(text) == b"".join(x.to_bytes(4, "little") for x in processor.encode(text))
        assert agenda.held <= 21_000 and len(agenda) <= 100


def test_the_sql_knows_the_licenses_that_the_scan_knows(spark):
    texts = [b for _, b in licenses.KNOWN] + [f"code\n# {b}\nmore" for _, b in licenses.SPDX_LINES] + ["SPDX-License-Identifier: None", "", None]
    texts += [p.read_text(errors="replace") for p in sorted(Path("/usr/share/common-licenses").glob("*")) if p.is_file()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = con.execute(licenses.oracle_sql())
    names = [c[0] for c in want.description]
    rows = sorted(want.fetchall())
    assert sorted(map(tuple, licenses.scan(df).select(*names).collect())) == rows
    assert len(rows) >= len(texts) - 6 and {r[names.index("unit")] for r in rows} == {"text", "line"}


def test_letters_are_solved_once_whatever_stops_follow(monkeypatch):
    """No piece joins a letter to a stop; where two characters stand side by side in a piece, words are solved whole."""
    processor, _ = sentencepieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    agenda, solved, merge = sentencepieces.Agenda(processor), [], sentencepieces.Agenda.merge
    monkeypatch.setattr(sentencepieces.Agenda, "merge", lambda self, word: solved.append(word) or merge(self, word))
    text = "unheard unheard. unheard, unheard*** unheard... (unheard) x2.y2; \u00b2. a\u00b2. 漢字. \u0301a\u0301. a_b" + "z" * 100 + ".!"
    assert np.frombuffer(agenda.encode(text), "<u4").tolist() == processor.encode(text)
    assert solved.count("▁unheard") == 1 and not [w for w in solved if "unheard" in w and w not in ("▁unheard", "▁(unheard)")]
    agenda.pairs.add("d.")
    solved.clear()
    assert np.frombuffer(agenda.encode("unheard.. "), "<u4").tolist() == processor.encode("unheard.. ") and "▁unheard.." in solved
