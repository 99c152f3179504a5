"""Compression of vectors to product codes, the nearest codebook entry found by Orchard's search.

All arithmetic is on integers, so results are exact and the same however rows are dealt out. For every entry of a codebook
the other entries are listed by distance. A search holds a current entry and walks its list; an entry that is nearer to the
vector becomes the current one, and its list is walked from the start. Visited entries are marked and not measured again.
An entry more than twice as far from the current entry as the vector is cannot be nearer, nor as near, so the walk stops."""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_io import lean, map_batches, materialize
from .vectors import finite, matrix

#: Scale of components, parts of a vector, entries of a codebook, and rounds of refinement.
SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components beyond this are computed on as unbounded integers, and sums travel in digits of so many bits.
SAFE = 1 << 24
LIMB = 60
#: Labels with more than one in so many rows (at most so many) are looked up by broadcast, all others by a shuffle.
HOT_SHARE = 1000


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of each component: longs, or unbounded integers where longs could overflow later."""
    if not x.size or np.abs(x).max() * SCALE < SAFE:
        return np.floor(x * SCALE).astype(np.int64)
    whole = [int(v) * SCALE if abs(v) > 2**53 else int(np.floor(v * SCALE)) for v in x.ravel().tolist()]
    return np.array(whole, object).reshape(x.shape)


def parts(d: int) -> list[slice]:
    """Consecutive parts, equal where d is a multiple of PARTS."""
    at = [i * d // PARTS for i in range(PARTS + 1)]
    return [slice(a, b) for a, b in zip(at, at[1:])]


class Orchard:
    """Nearest entries of one codebook (rows of integers), ties to the lower index."""

    def __init__(self, book: np.ndarray):
        self.book = book
        gap = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        self.order = np.array([sorted((j for j in range(len(book)) if j != i), key=lambda j: (gap[i, j], j)) for i in range(len(book))], np.int64)
        self.order = self.order.reshape(len(book), max(len(book) - 1, 0))
        self.far = np.take_along_axis(gap, self.order, axis=1)  # squared distances, ascending in each list

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry for each row of x; all rows walk at once."""
        n, m = len(x), len(self.book)
        kind = object if object in (x.dtype, self.book.dtype) else np.int64
        book = self.book.astype(kind)
        current = np.zeros(n, np.int64)
        best = ((x - book[0]) ** 2).sum(axis=1).astype(kind) if n else np.zeros(0, kind)
        visited = np.zeros((n, m), bool)
        visited[:, 0] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n) if m > 1 else np.zeros(0, np.int64)
        while len(walking):
            c, at = current[walking], place[walking]
            near = (self.far[c, at] <= 4 * best[walking]).astype(bool)  # beyond twice the distance the walk stops
            walking, c, at = walking[near], c[near], at[near]
            entry = self.order[c, at]
            place[walking] += 1
            new = ~visited[walking, entry]
            rows, entry = walking[new], entry[new]
            visited[rows, entry] = True
            gap = ((x[rows] - book[entry]) ** 2).sum(axis=1).astype(kind) if len(rows) else np.zeros(0, kind)
            better = ((gap < best[rows]) | (gap == best[rows]) & (entry < current[rows])).astype(bool)
            rows = rows[better]
            current[rows], best[rows], place[rows] = entry[better], gap[better], 0
            walking = walking[place[walking] < m - 1]
        return current, best


def _assign(x: np.ndarray, searches: list[Orchard]) -> tuple[np.ndarray, np.ndarray]:
    """Entries by row and part, and squared distances summed over parts."""
    found = [s.nearest(x[:, p]) for s, p in zip(searches, parts(x.shape[1]))]
    return np.stack([f[0] for f in found], axis=1), sum(f[1] for f in found)


def _first(fine: DataFrame, d: int) -> np.ndarray:
    """The vectors of the ENTRIES smallest ids (rows without id come last; rows that repeat an id, by their vectors)."""
    rows = fine.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(ENTRIES).collect()
    return integers(np.array([r["embedding"] for r in rows], np.float64).reshape(len(rows), d))


def _limbs(value: int) -> list[int]:
    """Digits of LIMB bits, the lowest first, all of the value's sign."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value or not out:
        out.append(sign * (value & (1 << LIMB) - 1))
        value >>= LIMB
    return out


def _refine(fine: DataFrame, d: int, book: np.ndarray) -> np.ndarray:
    """One round: the floor of the mean of the parts nearest to each entry; unused entries stay. Tasks add up their own
    rows, so a row a task, part, entry, and position is shuffled, and what the driver reads is as large as the codebooks."""
    searches = [Orchard(book[:, p]) for p in parts(d)]

    def run(batches):
        total: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            x = integers(matrix(b.column(0), d))
            entry, _ = _assign(x, searches)
            for j, p in enumerate(parts(d)):
                sums, count = total.setdefault(j, (np.zeros((len(book), p.stop - p.start), object), np.zeros(len(book), np.int64)))
                for e in np.unique(entry[:, j]):
                    mine = x[entry[:, j] == e, p]
                    sums[e] += np.array([int(v) for v in mine.sum(axis=0)], object)
                    count[e] += len(mine)
        rows = [(j, e, i, k, Decimal(v)) for j, (sums, count) in total.items() for e in range(len(book)) if count[e] for i, s in enumerate([int(count[e]), *sums[e]]) for k, v in enumerate(_limbs(s))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "entry", "place", "limb", "value"])

    lean(fine.sparkSession)
    told = fine.select("embedding").mapInArrow(run, "part int, entry int, place int, limb int, value decimal(38,0)")
    got = told.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect()  # ENTRIES * (d + PARTS) numbers, in digits
    values: dict[tuple[int, int, int], int] = {}
    for r in got:
        key = (r["part"], r["entry"], r["place"])
        values[key] = values.get(key, 0) + (int(r["value"]) << LIMB * r["limb"])
    new, spans = book.astype(object), parts(d)
    for (j, e, i), v in values.items():
        if i:
            new[e, spans[j].start + i - 1] = v // values[j, e, 0]
    return _narrow(new)


def _narrow(book: np.ndarray) -> np.ndarray:
    return book.astype(np.int64) if not book.size or max(abs(int(v)) for v in book.ravel()) <= SAFE else book.astype(object)


def _digest(book: np.ndarray, d: int) -> str:
    return hashlib.sha256(",".join(str(int(v)) for p in parts(d) for row in book[:, p] for v in row).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each row of vectors (vec_id, embedding, label).

    Rows whose vector is null or holds null or non-finite components are dropped, and rows of another length than most;
    where the length is no multiple of PARTS the parts differ by one component at most. Rows without id are coded, but begin a codebook
    only if there are too few with one; rows that repeat an id are rows of their own. With fewer than ENTRIES rows the
    codebooks are as small. An error, or sum of errors, too large for a long is null. Further columns are not looked at; an
    empty table gives an empty result."""
    fine, d = finite(vectors, "vec_id", "label")
    book = _narrow(_first(fine, d).astype(object))
    for _ in range(ROUNDS):
        if len(book):
            book = _refine(fine, d, book)
    searches, digest = [Orchard(book[:, p]) for p in parts(d)], _digest(book, d)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        entry, error = _assign(integers(matrix(b.column(2), d)), searches)
        codes = [bytes(row).hex() for row in entry.astype(np.uint8)]
        fits = [int(e) if e < 1 << 63 else None for e in error]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes, pa.string()), pa.array(fits, pa.int64())], names=["vec_id", "label", "code", "error"])

    id_type, label_type = (fine.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    coded = map_batches(fine, run, f"vec_id {id_type}, label {label_type}, code string, error long")
    out = _with_label_error(materialize(coded, "codes"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _with_label_error(coded: DataFrame) -> DataFrame:
    """coded (read several times) with the sum of errors over equal labels, nulls together."""
    whole = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = coded.groupBy("label").agg(whole.try_cast("long").alias("label_error"), F.count("*").alias("n"))
    sums = materialize(sums.select(F.col("label").alias("__label"), "label_error", "n", F.lit(True).alias("__found")), "labels")
    hot = F.col("n") * HOT_SHARE > coded.count()
    same = F.col("label").eqNullSafe(F.col("__label"))
    often, rest = sums.where(hot).drop("n"), sums.where(~hot).drop("n")
    if not rest.take(1):
        return coded.join(F.broadcast(often), same)
    told = coded.join(F.broadcast(often), same, "left")
    near, far = told.where("__found"), told.where("__found is null").select(*coded.columns).join(rest, same)
    return near.unionByName(far)


_MEAN = "CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"


def oracle_sql() -> str:
    """DuckDB SQL of compress, every entry measured, for vectors of one length and ids that do not repeat."""
    fine = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"
    with_ = [
        f"e AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings WHERE {fine})",
        f"p AS MATERIALIZED (SELECT r, part, x[part * len(x) // {PARTS} + 1 : (part + 1) * len(x) // {PARTS}] AS x FROM e, range({PARTS}) AS t(part))",
        f"b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM p WHERE r <= {ENTRIES})",
    ]
    for i in range(ROUNDS + 1):
        gap = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        with_.append(f"a{i} AS MATERIALIZED (SELECT p.r, p.part, min(row({gap}, b.entry)) AS best FROM p JOIN b{i} b ON p.part = b.part GROUP BY p.r, p.part)")
        if i < ROUNDS:
            places = f"SELECT p.part, a.best[2] AS entry, generate_subscripts(p.x, 1) AS i, unnest(p.x) AS v FROM a{i} a JOIN p ON a.r = p.r AND a.part = p.part"
            means = f"SELECT part, entry, list(m ORDER BY i) AS x FROM (SELECT part, entry, i, {_MEAN} AS m FROM ({places}) GROUP BY part, entry, i) GROUP BY part, entry"
            with_.append(f"b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN ({means}) m ON b.part = m.part AND b.entry = m.entry)")
    with_.append(f"""c AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)""")
    with_.append(f"h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})")
    return f"WITH {', '.join(with_)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN e USING (r), h"
