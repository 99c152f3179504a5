"""SentencePiece BPE encoding and decoding with a score-ordered agenda of adjacent symbol pairs.

Merges never join a piece to a following word mark (checked when the model is read), so the agenda of a text
falls apart into the agendas of its words; those are solved once per distinct word and task, and reused. Nor do they join
two characters that stand side by side in no piece, so letters and the stops behind them are
solved apart."""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_io import map_batches

MARK = "▁"
CUT = "\x01"
#: Words up to this length keep their agenda in a list, and a task remembers their ids.
SHORT = 64
#: Bytes of words and ids (with what a Python entry takes besides) that a task keeps; beyond that it starts afresh.
MEMO_BYTES, ENTRY_BYTES = 192 << 20, 200
NEVER = float("inf")


def _code(i: int) -> bytes:
    return i.to_bytes(4, "little")


class Agenda(dict):
    """Maps a word (marks, then other characters) to its ids as little-endian 32-bit integers."""

    def __init__(self, processor):
        super().__init__()
        self.held = 0
        n = processor.get_piece_size()
        self.ids, self.costs, self.bytes = {}, {}, {}
        for i in range(n):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = _code(i)
            elif not processor.is_control(i) and not processor.is_unknown(i) and not processor.is_unused(i):
                self.ids[piece], self.costs[piece] = _code(i), -processor.get_score(i)
        self.unk = processor.unk_id()
        self.split = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.pairs = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        # characters that no piece joins to another: words are cut around a line break as well
        self.lines = not any("\n" in p and len(p) > 1 for p in self.ids)

    def merge(self, word: str) -> list[str]:
        """Pieces of a word: the agenda gives the best score first, of equals the leftmost."""
        return self._short(list(word)) if len(word) <= SHORT else self._long(list(word))

    def _short(self, sym: list[str]) -> list[str]:
        """The agenda as a list of costs by place: the first least one is next."""
        cost = self.costs.get
        agenda = [cost(a + b, NEVER) for a, b in zip(sym, sym[1:])]
        while agenda and (best := min(agenda)) < NEVER:
            i = agenda.index(best)
            sym[i] += sym.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = cost(sym[i] + sym[i + 1], NEVER)
            if i:
                agenda[i - 1] = cost(sym[i - 1] + sym[i], NEVER)
        return sym

    def _long(self, sym: list[str | None]) -> list[str]:
        """The agenda as a heap, for words whose length would make the list slow."""
        cost, n = self.costs, len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(cost[p], i, p) for i in range(n - 1) if (p := sym[i] + sym[i + 1]) in cost]
        heapq.heapify(agenda)
        while agenda:
            _, i, p = heapq.heappop(agenda)
            j = after[i]
            if sym[i] is None or j >= n or sym[i] + sym[j] != p:
                continue  # one of the two is gone or has grown meanwhile
            sym[i], sym[j] = p, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (q := p + sym[k]) in cost:
                    heapq.heappush(agenda, (cost[q], i, q))
            h = before[i]
            if h >= 0 and (q := sym[h] + p) in cost:
                heapq.heappush(agenda, (cost[q], h, q))
        return [s for s in sym if s is not None]

    _letters = re.compile(rf"({MARK}*[^\W\d_]+)(.+)", re.S).fullmatch

    def __missing__(self, word: str) -> bytes:
        m = self._letters(word)
        if m and word[m.end(1) - 1] + word[m.end(1)] not in self.pairs:
            ids = self[m[1]] + self[m[2]]
        else:
            ids = b"".join([self.ids[p] if p in self.ids else self._unknown(p) for p in self.merge(word)])
        if len(word) <= SHORT:
            if self.held > MEMO_BYTES:
                self.clear()
                self.held = 0
            self.held += ENTRY_BYTES + 4 * len(word) + len(ids)
            self[word] = ids
        return ids

    def _unknown(self, piece: str) -> bytes:
        return b"".join(self.bytes[b] for b in piece.encode()) if self.bytes else _code(self.unk)

    _runs = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def encode(self, text: str) -> bytes:
        """Ids of a whole text without begin and end."""
        if not text:
            return b""
        s = MARK + text.replace(" ", MARK)
        if not self.split:
            return self.__missing__(s)
        if CUT in s or MARK * 2 in s or not self.lines:
            return b"".join(map(self.__getitem__, self._runs.findall(s)))
        if "\n" in s:
            s = s.replace("\n", f"{CUT}\n{CUT}")
        return b"".join(map(self.__getitem__, filter(None, s.replace(MARK, CUT + MARK).split(CUT))))


_loaded: dict[str, tuple] = {}


def load(model: str) -> tuple:
    """The library's processor and the agenda of a model file; once per Python worker."""
    if model not in _loaded:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=model)
        _loaded[model] = (p, Agenda(p))
    return _loaded[model]


def _rows(texts: list, model: str) -> list[tuple]:
    processor, agenda = load(model)
    bos, eos = _code(processor.bos_id()), _code(processor.eos_id())
    out = []
    for t in texts:
        ids = bos + agenda.encode(t or "") + eos
        own = np.frombuffer(ids, "<u4").tolist()
        out.append((ids, processor.decode(own), own == processor.encode(t or "", add_bos=True, add_eos=True)))
    return out


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """doc_id, ids (array), decoded text, and whether the library gives the same ids. Null text is empty: begin and end alone."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = _rows(b.column(1).to_pylist(), model)
        ids = pa.array([np.frombuffer(r[0], "<u4").astype(np.int32) for r in rows], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([b.column(0), ids, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.bool_())], names=["doc_id", "ids", "decoded", "library_agrees"])

    return map_batches(docs.select("doc_id", F.col(text).alias("t")), run, "doc_id long, ids array<int>, decoded string, library_agrees boolean")


def digests(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, library_agrees: one row per row, in small batches."""

    def run(b: pa.RecordBatch):
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            rows = _rows(part.column(1).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(r[0]) // 4 for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows], pa.string()),
                    pa.array([hashlib.sha256(r[1].encode()).hexdigest() for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.bool_()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "library_agrees"],
            )

    return map_batches(docs.select("doc_id", F.col(text).alias("t")), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, library_agrees boolean")
