"""Best-fit packing of tokenised documents with exact-complement hashing.

There are at most `capacity` different piece lengths, so the plan is made on the histogram of lengths: patterns of
lengths that fill a sequence exactly are taken first, in bulk. Pieces then find their place by their rank among the
pieces of their length, which Spark counts by task and length."""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spark_io import materialize

CAPACITY = 1024
END = 2
SPECIAL = "<|endoftext|>"
_loaded: dict[str, tuple] = {}
#: Texts of other characters, or with long runs of white space (on which the pattern would need too much stack), go to the
#: tokenizers library; all others give the same ids by the rank file (tested on whole tables).
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]|[\t\n\r ]{1000}")


def load(json_path: str, ranks_path: str, pattern: str) -> tuple:
    if json_path not in _loaded:
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        special = {SPECIAL: len(ranks)}
        _loaded[json_path] = Tokenizer.from_file(json_path), tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _loaded[json_path]


def token_ids(text: str, slow, fast) -> np.ndarray:
    if _OTHER.search(text):
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
    return fast.encode_to_numpy(text, allowed_special="all")


def pieces(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the task and the piece's rank among the task's pieces of its length."""

    def run(batches):
        from pyspark import TaskContext

        slow, fast = load(json_path, ranks_path, pattern)
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = []
                for doc, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(token_ids(t or "", slow, fast), np.uint32(END)).astype("<u4")
                    start, k = 0, 0
                    while start < len(ids):
                        n = (len(ids) - start) % capacity or capacity
                        rows.append((doc, k, start, n, zlib.crc32(ids[start : start + n].tobytes()), task, seen[n]))
                        seen[n] += 1
                        start, k = start + n, k + 1
                cols = list(zip(*rows)) or [()] * 7
                kinds = [part.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "local"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return docs.select("doc_id", F.col(text).alias("t")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, local long")


class _Index:
    """Which lengths are left, and for each sum how many ordered pairs of available lengths make it."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for x, c in counts.items():
            self.left[x] = c
        self.has = self.left > 0
        self.pairs = np.convolve(self.has.astype(np.int64), self.has.astype(np.int64))[: capacity + 1]

    def take(self, parts: list[int], times: int) -> None:
        for x in parts:
            self.left[x] -= times
        for x in set(parts):
            if not self.left[x] and self.has[x]:
                at = np.flatnonzero(self.has)
                at = at[at + x < len(self.pairs)]
                np.subtract.at(self.pairs, at + x, np.where(at == x, 1, 2))
                self.has[x] = False

    def enough(self, parts: list[int]) -> int:
        """How often a multiset of lengths is available."""
        return min(int(self.left[x]) // parts.count(x) for x in set(parts))

    def pair(self, total: int, used: list[int]) -> list[int] | None:
        if total < 2 or not self.pairs[total]:
            return None
        half = np.flatnonzero(self.has[(total + 1) // 2 : total] & self.has[total // 2 : 0 : -1]) + (total + 1) // 2
        for a in half[::-1]:
            if self.enough([*used, int(a), total - int(a)]):
                return [int(a), total - int(a)]
        return None

    def exact(self, gap: int, used: list[int]) -> list[int] | None:
        """One, two or three lengths with this sum, fewest and longest first."""
        if self.has[gap] and self.enough([*used, gap]):
            return [gap]
        if found := self.pair(gap, used):
            return found
        at = np.flatnonzero(self.has[1:gap]) + 1
        for a in at[self.pairs[gap - at] > 0][::-1]:
            if self.enough([*used, int(a)]) and (found := self.pair(gap - int(a), [*used, int(a)])):
                return [int(a), *found]
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths in a sequence, how many sequences), longest pieces first; each uses up some length."""
    ix, out = _Index(counts, capacity), []
    for top in range(capacity, 0, -1):
        while ix.left[top]:
            parts = [top]
            while (gap := capacity - sum(parts)) > 0:
                if found := ix.exact(gap, parts):
                    parts += found
                    break
                fits = [x for x in np.flatnonzero(ix.has[: gap + 1])[::-1] if ix.enough([*parts, int(x)])][:1]
                if not fits:
                    break
                parts.append(int(fits[0]))
            times = ix.enough(parts)
            ix.take(parts, times)
            out.append((parts, times))
    return out


def slots(patterns: list[tuple[list[int], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """For each run of ranks of a length: key (length, first rank), first sequence, offset; sorted by key."""
    rows, used, sequence = [], [0] * (capacity + 1), 0
    for parts, times in patterns:
        offset = 0
        for x in parts:
            rows.append(((x << 44) + used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    rows.sort()
    return tuple(np.array([r[k] for r in rows], np.int64) for k in range(3))


def pack(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence and offset.

    Null and empty texts are one token; texts of any length are cut whole into pieces; repeated rows, rows that share an id and
    rows without id are packed one by one; pieces of one length are alike, so any order among them is as good; an empty table
    gives an empty result; further columns are not looked at."""
    p = materialize(pieces(docs, json_path, ranks_path, pattern, text, capacity), "pieces")
    by_task = materialize(p.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    keys, sequences, offsets = slots(plan(counts, capacity), capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # the table of bases grows with the tasks: it is shuffled, not broadcast
    ranked = p.join(base.hint("shuffle_merge"), ["task", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("rank"))

    def place(batches):
        for b in batches:
            n, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(keys, (n << 44) + rank, "right") - 1
            sequence = sequences[at] + rank - (keys[at] & ((1 << 44) - 1))
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offsets[at])], names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
