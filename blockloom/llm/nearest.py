"""Approximate nearest neighbours with randomly rotated one-bit codes.

Every vector is stored as the signs of its rotated residual to a centroid (packed bits) and two correction scalars. A
query's residual is cut to QUERY_BITS bit planes, so its product with the signs is a few ANDs and bit counts; the scalars
turn that into an estimate of the distance with an error bound. Only vectors whose lower bound reaches the best distances
so far are measured exactly.

Rows travel as blobs by cell in chunks of bounded size, queries in blocks of bounded size; each task meets one chunk and
one block. All rows are met, so recall does not hang on probing cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spark_io import lean, materialize

#: Rows (expected) that the centroids are fitted on, centroids, and the bound's width in standard errors.
SAMPLE = 4096
CENTROIDS = 16
WIDTH = 3.0
QUERY_BITS = 6
#: Bytes of vectors in a chunk of rows or a block of queries (expected), and pairs that are estimated at once.
BLOCK_BYTES = 4 << 20
PAIRS = 1 << 18


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part: id and vector present, not zero, all components finite, and as
    long as most vectors are (of equally frequent lengths the shorter). Components keep their width (others are doubles)."""
    width = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    v = vectors.select("vec_id", F.col("embedding").cast(f"array<{width}>").alias("embedding")).where("vec_id is not null and embedding is not null")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = v.where(finite & F.exists("embedding", lambda x: x != 0))
    most = fine.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return fine.where(F.size("embedding") == (most["d"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), flat.dtype)


def fit(vectors: DataFrame, rows: int) -> dict | None:
    """A random rotation and centroids from a bounded sample (chosen by a hash of the ids) of so many rows."""
    if not rows:
        return None
    share = min(1.0, SAMPLE / rows)
    chosen = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = vectors.where(chosen).orderBy("vec_id").limit(2 * SAMPLE).collect() or vectors.limit(1).collect()
    x = np.array([r["embedding"] for r in sample], np.float64)
    rng = np.random.default_rng(17)
    c = x[rng.choice(len(x), min(CENTROIDS, len(x)), replace=False)]
    for _ in range(10):
        own = _cells(x, c)
        c = np.array([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
    q, r = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
    return {"rotation": q * np.sign(np.diag(r)), "centroids": c}


def _cells(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(axis=1) - 2 * x @ centroids.T, axis=1)


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, filled up with zeros."""
    pad = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1).view(np.uint64)


_CODED = "cell int, n int, ids binary, x binary, code binary, length binary, factor binary"


def index(vectors: DataFrame, model: dict) -> DataFrame:
    """All rows as blobs by cell: ids, vectors, packed sign bits, and two scalars (the residual's length and its product
    with the signs)."""
    rot, cents = model["rotation"], model["centroids"]

    def run(batches):
        for b in batches:
            ids, raw = b.column(0).to_numpy(), _matrix(b.column(1))
            if not len(ids):
                continue
            x = raw.astype(np.float64)
            cell = _cells(x, cents)
            r = (x - cents[cell]) @ rot
            length = np.linalg.norm(r, axis=1)
            o = r / np.where(length > 0, length, 1)[:, None]
            code, factor = _words(o > 0), np.abs(o).sum(axis=1) / np.sqrt(o.shape[1])
            at = [np.flatnonzero(cell == c) for c in np.unique(cell)]
            cols = [[a[i].tobytes() for i in at] for a in (ids, raw, code, length, factor)]
            head = [pa.array([int(cell[i[0]]) for i in at], pa.int32()), pa.array([len(i) for i in at], pa.int32())]
            yield pa.RecordBatch.from_arrays([*head, *(pa.array(c, pa.binary()) for c in cols)], names=["cell", "n", "ids", "x", "code", "length", "factor"])

    lean(vectors.sparkSession)
    return vectors.mapInArrow(run, _CODED)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        d = a[:, j].astype(np.float64) - b[:, j]
        total += d * d
    return np.sqrt(total)


class _Queries:
    """Rotated queries as seen from one centroid: bit planes and the terms of the estimate."""

    def __init__(self, rotated: np.ndarray, centre: np.ndarray):
        r = rotated - centre
        top = (1 << QUERY_BITS) - 1
        self.low = r.min(axis=1)
        self.step = np.maximum((r.max(axis=1) - self.low) / top, 1e-300)
        u = np.rint((r - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        self.planes = [_words((u >> j) & 1) for j in range(QUERY_BITS)]
        self.length = np.linalg.norm(r, axis=1)
        self.rounding = np.abs(r - self.low[:, None] - self.step[:, None] * u).sum(axis=1)  # bounds what the planes leave out
        self.noise = 1e-9 * (rotated**2).sum(axis=1)  # of the rotation, for residuals near zero
        self.total = (self.low * r.shape[1] + self.step * u.sum(axis=1)) / np.sqrt(r.shape[1])

    def bounds(self, at: slice, rows: slice, part: dict) -> tuple[np.ndarray, np.ndarray]:
        """Squared lower and upper bounds of the distances of some queries to some rows of the centroid's cell."""
        code, d = part["code"][rows], part["d"]
        count = np.zeros((len(self.low[at]), len(code)), np.uint32)
        for j, plane in enumerate(self.planes):
            for w in range(code.shape[1]):
                count += np.bitwise_count(plane[at, w][:, None] & code[None, :, w]).astype(np.uint32) << j
        f = np.float32
        product = count * (2 / np.sqrt(d) * self.step[at]).astype(f)[:, None]
        product += (2 / np.sqrt(d) * self.low[at]).astype(f)[:, None] * part["ones"][rows] - self.total[at].astype(f)[:, None]
        product *= 2 * part["scale"][rows]
        middle = (part["square"][rows] - product) + (self.length[at] ** 2).astype(f)[:, None]
        wide = part["wide"][rows] * self.length[at].astype(f)[:, None] + part["scale"][rows] * (2 / np.sqrt(d) * self.rounding[at]).astype(f)[:, None]
        wide += f(1e-5) * part["square"][rows] + (1e-5 * self.length[at] ** 2 + self.noise[at]).astype(f)[:, None]
        return middle - wide, middle + wide


def _chunk(blobs: pa.Table, kind: str, d: int) -> dict:
    """The rows of a chunk (all of one cell) with the terms of the estimate that hang on the row alone."""
    col = {c: b"".join(blobs.column(c).to_pylist()) for c in ("ids", "x", "code", "length", "factor")}
    length, factor = np.frombuffer(col["length"]), np.maximum(np.frombuffer(col["factor"]), 1e-9)
    code = np.frombuffer(col["code"], np.uint64).reshape(len(length), -1)
    out = {"ids": np.frombuffer(col["ids"], np.int64), "x": np.frombuffer(col["x"], kind).reshape(len(length), d), "code": code, "d": d}
    out["ones"] = np.bitwise_count(code).sum(axis=1).astype(np.float32)
    out["scale"], out["square"] = (length / factor).astype(np.float32), (length**2).astype(np.float32)
    out["wide"] = (2 * WIDTH * length / factor * np.sqrt(np.maximum(1 - factor**2, 0) / max(d - 1, 1))).astype(np.float32)
    out["cell"] = blobs.column("cell")[0].as_py()
    return out


def _within(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray, piece: int = 1 << 15) -> np.ndarray:
    """Which pairs (i, j) of rows of a and b have a squared distance within a's limits, up to rounding."""
    out = np.zeros(len(i), bool)
    for s in range(0, len(i), piece):
        p, q = i[s : s + piece], j[s : s + piece]
        gap = a[p] - b[q]
        out[s : s + piece] = ~(np.einsum("ij,ij->i", gap, gap) > limit[p] * (1 + 1e-4) + 1e-30)
    return out


def _best(ids: np.ndarray, x: np.ndarray, part: dict, model: dict, k: int) -> tuple[np.ndarray, ...]:
    """(query, row id, distance) of the k nearest rows of a chunk for each query of a block."""
    queries = _Queries(x.astype(np.float64) @ model["rotation"], model["centroids"][part["cell"]] @ model["rotation"])
    rows, out = len(part["ids"]), []
    step = max(1, min(len(ids), PAIRS // min(rows, 2048)))
    for lo in range(0, len(ids), step):
        at = slice(lo, min(lo + step, len(ids)))
        n, limit = at.stop - lo, np.full(at.stop - lo, np.inf)
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for r in range(0, rows, 2048):
            span = slice(r, min(r + 2048, rows))
            low, high = queries.bounds(at, span, part)
            own = ids[at][:, None] == part["ids"][None, span]
            if not r and span.stop > k:  # the first rows give a limit: the k that seem nearest are measured
                likely = np.argpartition(np.where(own, np.inf, low + high), k - 1, axis=1)[:, :k]
                q = np.repeat(np.arange(n), k)
                first = exact(x[lo + q], part["x"][likely.ravel()]) ** 2 + np.where(own[q, likely.ravel()], np.inf, 0)
                limit = first.reshape(n, k).max(axis=1) * (1 + 1e-9)
            qi, vi = np.nonzero(~(low > limit[:, None]) & ~own)  # bounds that overflow exclude nothing
            near = _within(x[at], part["x"][span], qi, vi, limit)
            q, v = qi[near], vi[near] + r
            dist = exact(x[lo + q], part["x"][v])
            found = [np.concatenate(p) for p in zip(found, (q, part["ids"][v], dist))]
            order = np.lexsort((found[1], found[2], found[0]))
            found = [p[order] for p in found]
            rank = np.arange(len(order)) - np.searchsorted(found[0], found[0])
            found = [p[rank < k] for p in found]
            full = np.bincount(found[0], minlength=n) == k
            last = np.searchsorted(found[0], np.arange(n), "right") - 1
            limit[full] = np.minimum(limit[full], found[2][last[full]] ** 2 * (1 + 1e-9))
        out.append((ids[lo + found[0]], found[1], found[2]))
    return tuple(np.concatenate(c) for c in zip(*out))


_PAIRS = "query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The k nearest rows of each row whose id is divisible by `every`: query_id, rank, vec_id, score.

    Rows with the query's id are no candidates of it; of repeated ids the smallest vector asks, and each of their rows can
    be found. Ties go to the smaller id. Unusable rows (see `usable`) take no part; further columns are not looked at; an
    empty table gives an empty result."""
    fine = usable(vectors)
    counted = fine.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")).first()  # two numbers
    model = fit(fine, counted["n"])
    if model is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind, d = ("f4", 4 * counted["d"]) if fine.schema["embedding"].dataType.simpleString() == "array<float>" else ("f8", 8 * counted["d"])
    coded = materialize(index(fine, model), "codes")
    block = max(256, BLOCK_BYTES // d)
    asking = fine.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asking = materialize(asking, "queries")
    blocks = max(1, -(-asking.count() // block))
    sizes = {r["cell"]: r["n"] for r in coded.groupBy("cell").agg(F.sum("n").alias("n")).collect()}  # CENTROIDS rows at most
    chunks = {c: max(1, -(-n // block)) for c, n in sizes.items()}  # so a cell of any share of the rows is split

    many = F.create_map(*[F.lit(x) for c in sorted(chunks) for x in (c, chunks[c])])
    rows = coded.withColumn("chunk", F.pmod(F.xxhash64("ids"), many[F.col("cell")]).cast("int"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cells = F.array(*[F.struct(F.lit(c).alias("cell"), F.lit(chunks[c]).alias("m")) for c in sorted(chunks)])
    spread = asking.withColumn("p", F.explode(cells))
    spread = spread.select("vec_id", "embedding", "p.cell", F.explode(F.sequence(F.lit(0), F.col("p.m") - 1)).alias("chunk"))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        right = right.combine_chunks().sort_by("vec_id")
        x = np.concatenate([_matrix(c) for c in right.column("embedding").chunks])
        with np.errstate(all="ignore"):
            q, v, s = _best(right.column("vec_id").to_numpy(), x, _chunk(left, kind, x.shape[1]), model, k)
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    found = rows.groupBy("cell", "chunk", "block").cogroup(spread.groupBy("cell", "chunk", "block")).applyInArrow(meet, _PAIRS)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM d)
SELECT * FROM r WHERE rank <= 10"""
