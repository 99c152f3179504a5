"""Near-duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Two collections of HALVES half-keys (BAND minhashes each) give HALVES**2 table keys by combining every half-key of one
with every half-key of the other, so 2 * HALVES * BAND minhashes do the work of HALVES**2 * 2 * BAND. A pair of
similarity s shares a key with chance (1 - (1 - s**BAND)**HALVES)**2: over 0.99999 at 0.85, over 0.9999 at 0.8.

Sets that share a key are compared by their minhashes; pairs that could reach the threshold join families, and within a
family all pairs are decided exactly. Every shuffle moves few bytes per set. Keys of many sets are met twice: first by a
part of their members, which brings most into one family, then by all pairs that are still in different families
(`unsettled`). Keys and families are dealt out in tiles, so no task or driver holds a group of unbounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .graph import components
from .spark_io import discard, map_batches, materialize, small

SHINGLE = 5
PERCENT = 85
HALVES, BAND = 10, 2
MINHASHES = 64  # the first 2 * HALVES * BAND make keys; all of them estimate


def agreeing(percent: int) -> int:
    """Pairs agreeing in fewer minhashes cannot be links: the threshold's share of 64 less four and a half standard errors."""
    p = percent / 100
    return max(0, int(MINHASHES * p - 4.5 * (MINHASHES * p * (1 - p)) ** 0.5))


AGREE = agreeing(PERCENT)
#: Sets of a block, sets and bytes of a tile (expected), and ids or keys that may be broadcast.
BLOCK, TILE, TILE_BYTES, BROADCAST_IDS = 2048, 768, 16 << 20, 500_000
#: Members of a key that a block sends on at first, sets of a key that are all compared at once, and sets of a tile of a larger one.
SENT, MET, SKETCHES = 64, 1024, 2048
_SEEDS = K.constants(41, 2 * MINHASHES)
_TABLES = K.constants(43, HALVES * HALVES + 1)


def shingle_sets(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and where each row's begin (one more entry at the end)."""
    n = len(offs) - 1
    low = K.LOWER[buf]
    s, e, first = K.words(low, offs)
    h = K.Hasher(low)(s, e)
    count = np.diff(first)
    w = K.windows(h, SHINGLE)
    row = np.repeat(np.arange(n), count)
    inside = np.flatnonzero(row[: len(w)] == row[SHINGLE - 1 :]) if len(w) else np.zeros(0, int)
    keys, rows = [w[inside]], [row[inside]]
    for k in range(1, SHINGLE):  # shorter texts: the whole sequence is one shingle
        at = np.flatnonzero(count == k)
        if len(at):
            total = np.full(len(at), k, np.uint64)
            for j in range(k):
                total = K.mix(total * np.uint64(31) + h[first[at] + j])
            keys.append(total)
            rows.append(at)
    key, r = np.concatenate(keys), np.concatenate(rows).astype(np.uint16)
    order = np.argsort(key)
    order = order[np.argsort(r[order], kind="stable")]
    key, r = key[order], r[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (r[1:] != r[:-1])
    key, r = key[new], r[new]
    return key, np.searchsorted(r, np.arange(n + 1))


def sketch(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, two hashes of the set, and its minhashes (null for an empty set)."""

    def run(b: pa.RecordBatch):
        for lo, hi, buf, offs in K.slices(b.column(1)):
            key, at = shingle_sets(buf, offs)
            n = np.diff(at)
            full = np.flatnonzero(n)
            sig = np.empty((len(full), MINHASHES), np.uint32)
            h1, h2 = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
            if len(full):
                starts = at[full]
                for j in range(MINHASHES):
                    sig[:, j] = np.minimum.reduceat((key ^ _SEEDS[2 * j]) * _SEEDS[2 * j + 1], starts) >> np.uint64(32)
                h1[full] = K.mix(np.add.reduceat(K.mix(key), starts))
                h2[full] = K.mix(np.add.reduceat(K.mix(key ^ _SEEDS[0]), starts))
            out = np.full(hi - lo, None, object)
            out[full] = [r.tobytes() for r in sig]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(list(out), pa.binary())],
                names=["doc_id", "n_shingles", "h1", "h2", "sig"],
            )

    return map_batches(docs.select("doc_id", F.col(text).alias("t")), run, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


def _keys(sig: np.ndarray) -> np.ndarray:
    """The HALVES**2 keys of each set, by combining the half-keys of the two collections."""
    s = sig[:, : 2 * HALVES * BAND].astype(np.uint64).reshape(len(sig), 2 * HALVES, BAND)
    half = np.zeros((len(sig), 2 * HALVES), np.uint64)
    for j in range(BAND):
        half = K.mix(half * np.uint64(0x9E3779B97F4A7C15) + s[:, :, j] + np.uint64(1))
    pair = half[:, :HALVES, None] + K.mix(half[:, None, HALVES:] + _TABLES[-1])
    return K.mix(pair.reshape(len(sig), -1) ^ _TABLES[:-1])


def _blocks(batches):
    """Arrow batches gathered to blocks of at least BLOCK rows (fewer in the last)."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= BLOCK:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _sigs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), MINHASHES)


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, and the starts of its runs in that order."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    return order, np.flatnonzero(new)


def _deal(key: np.ndarray, buckets: int, *columns: np.ndarray) -> pa.RecordBatch:
    """Rows (bucket, blob): the columns of each bucket's keys as bytes."""
    bucket = (key >> np.uint64(40)) % np.uint64(buckets)
    order, starts = _grouped(bucket)
    ends = np.append(starts[1:], len(order))
    cols = [c[order] for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[order[starts]].astype(np.int32)), *(pa.array([c[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()) for c in cols)],
        names=["bucket", *(f"c{i}" for i in range(len(cols)))],
    )


def active(sets: DataFrame, buckets: int) -> DataFrame:
    """rep of the sets that share a key with another set."""

    def send(batches):
        for t in _blocks(batches):
            rep, key = t.column("rep").to_numpy(), _keys(_sigs(t.column("sig"))).ravel()
            who = np.repeat(rep, HALVES * HALVES)
            order, starts = _grouped(key)
            size = np.diff(np.append(starts, len(order)))
            busy = np.unique(who[order[np.repeat(size > 1, size)]])
            first = np.minimum.reduceat(who[order], starts)
            yield _deal(np.concatenate([key[order[starts]], busy.view(np.uint64) << np.uint64(40)]), buckets, np.concatenate([key[order[starts]], np.zeros(len(busy), np.uint64)]), np.concatenate([first, busy]))

    def meet(t: pa.Table) -> pa.Table:
        key, rep = np.frombuffer(b"".join(t.column("c0").to_pylist()), np.uint64), np.frombuffer(b"".join(t.column("c1").to_pylist()), np.int64)
        found = [rep[key == 0]]
        key, rep = key[key != 0], rep[key != 0]
        order, starts = _grouped(key)
        size = np.diff(np.append(starts, len(order)))
        found.append(rep[order[np.repeat(size > 1, size)]])
        return pa.table({"rep": np.unique(np.concatenate(found))})

    return sets.select("rep", "sig").mapInArrow(send, "bucket int, c0 binary, c1 binary").groupBy("bucket").applyInArrow(meet, "rep long").distinct()


def _close(x: np.ndarray, y: np.ndarray, agree: int) -> np.ndarray:
    return (x == y).sum(axis=-1) >= agree


def _labels(link: np.ndarray) -> np.ndarray:
    """Components of a symmetric matrix of links: the smallest index reached."""
    label = np.arange(len(link))
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(link)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _joined(n: int, p: np.ndarray) -> np.ndarray:
    """Components of n nodes under pairs of indices: the smallest index reached."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[p[:, 0]], label[p[:, 1]])
        new = label.copy()
        np.minimum.at(new, p[:, 0], low)
        np.minimum.at(new, p[:, 1], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _large(sig: np.ndarray, agree: int = AGREE) -> np.ndarray:
    """Most of the components of a large group: everyone against spread-out hubs and neighbours in several sketch orders.
    `unsettled` compares the rest."""
    n, pairs = len(sig), []
    for hub in range(0, n, max(1, n // 64)):
        at = np.flatnonzero(_close(sig, sig[hub], agree))
        pairs.append(np.stack([np.full(len(at), hub), at], 1))
    for turn in range(0, MINHASHES, 8):
        order = np.lexsort(np.roll(sig, turn, axis=1)[:, :6].T)
        for d in range(1, 33):
            a, b = order[:-d], order[d:]
            ok = _close(sig[a], sig[b], agree)
            pairs.append(np.stack([a[ok], b[ok]], 1))
    return _joined(n, np.concatenate(pairs))


def _plausible(key: np.ndarray, rep: np.ndarray, sig: np.ndarray, row: np.ndarray, agree: int) -> np.ndarray:
    """Edges between the sets of a key that could be links or hang together by such pairs; row points into sig and rep."""
    order, starts = _grouped(key)
    ends = np.append(starts[1:], len(order))
    size, r = ends - starts, row[order]
    near = [np.zeros((0, 2), np.int64)]
    few = np.repeat(size <= 8, size)
    run = np.repeat(np.arange(len(size)), size)
    for d in range(1, 8):
        at = np.flatnonzero(few[:-d] & (run[:-d] == run[d:])) if len(run) > d else np.zeros(0, int)
        near.append(np.stack([r[at], r[at + d]], 1))
    p = np.unique(np.sort(np.concatenate(near), axis=1), axis=0)
    p = p[rep[p[:, 0]] != rep[p[:, 1]]]
    out = [p[_close(sig[p[:, 0]], sig[p[:, 1]], agree)]] if len(p) else []
    seen = set()
    for s, e in zip(starts[size > 8], ends[size > 8]):
        g = np.unique(r[s:e])
        if (mark := g.tobytes()) in seen:
            continue
        seen.add(mark)
        if len(g) <= MET:
            link = np.concatenate([_close(sig[g[i : i + 64], None], sig[None, g], agree) for i in range(0, len(g), 64)])
            label = _labels(link)
        else:
            label = _large(sig[g], agree)
        out.append(np.stack([g[label], g], 1)[label != np.arange(len(g))])
    return np.unique(rep[np.concatenate(out)], axis=0) if out else np.zeros((0, 2), np.int64)


def families(sets: DataFrame, buckets: int, agree: int = AGREE) -> DataFrame:
    """Edges (a, b, null) between sets that share a key, and (null, null, key) for keys whose members did not all meet.

    All pairs of the other keys that could be links lie within the components of the edges."""

    def send(batches):
        for t in _blocks(batches):
            rep, full = t.column("rep").to_numpy(), _sigs(t.column("sig"))
            key, row, sig = _keys(full).ravel(), np.repeat(np.arange(len(rep)), HALVES * HALVES), (full & 0xFF).astype(np.uint8)
            edge = _plausible(key, rep, sig, row, agree)
            order, starts = _grouped(key)
            size = np.diff(np.append(starts, len(order)))
            go = order[np.arange(len(order)) - np.repeat(starts, size) < SENT]
            sent = _deal(key[go], buckets, key[go], rep[row[go]], sig[row[go]])
            none = pa.nulls(sent.num_rows, pa.binary())
            yield sent.append_column("edges", none).append_column("hot", none)
            edges, hot = edge.astype(np.int64).tobytes(), key[order[starts[size > SENT]]].tobytes()
            if edges or hot:
                bucket = pa.array([int(rep[0] % buckets)], pa.int32())
                blobs = [pa.array([x], pa.binary()) for x in (b"", b"", b"", edges, hot)]
                yield pa.RecordBatch.from_arrays([bucket, *blobs], names=["bucket", "c0", "c1", "c2", "edges", "hot"])

    def meet(t: pa.Table) -> pa.Table:
        key, rep, sig = (np.frombuffer(b"".join(t.column(c).to_pylist()), k) for c, k in (("c0", np.uint64), ("c1", np.int64), ("c2", np.uint8)))
        edge, hot = (np.frombuffer(b"".join(x for x in t.column(c).to_pylist() if x), np.int64) for c in ("edges", "hot"))
        who, at = np.unique(rep, return_index=True)
        found = _plausible(key, who, sig.reshape(-1, MINHASHES)[at], np.searchsorted(who, rep), agree)
        edge = np.unique(np.concatenate([edge.reshape(-1, 2), found]), axis=0)
        keys, size = np.unique(key, return_counts=True)
        hot = np.union1d(hot, keys[size > MET].view(np.int64))
        gap = [pa.nulls(len(hot), pa.int64())]
        ends = [pa.chunked_array([pa.array(edge[:, i]), *gap]) for i in (0, 1)]
        return pa.table({"a": ends[0], "b": ends[1], "hot": pa.chunked_array([pa.nulls(len(edge), pa.int64()), pa.array(hot, pa.int64())])})

    dealt = sets.select("rep", "sig").mapInArrow(send, "bucket int, c0 binary, c1 binary, c2 binary, edges binary, hot binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "a long, b long, hot long").distinct()


def unsettled(sets: DataFrame, hot: DataFrame, family: DataFrame, buckets: int, agree: int = AGREE) -> DataFrame:
    """Edges (a, b) that join the families (rep, family) of all sets that share a key of `hot` and could be links.

    Of each key, the sets outside its largest family meet all sets of the key, in tiles on both sides; pairs within a family
    need no comparison. A key whose sets are all in one family moves nothing."""

    def keys(b: pa.RecordBatch) -> pa.RecordBatch:
        full = _sigs(b.column(1))
        rep = np.repeat(b.column(0).to_numpy(), HALVES * HALVES)
        return pa.RecordBatch.from_arrays([pa.array(_keys(full).ravel().view(np.int64)), pa.array(rep)], names=["key", "rep"])

    def low(b: pa.RecordBatch) -> pa.RecordBatch:
        sig = (_sigs(b.column(1)) & 0xFF).astype(np.uint8)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in sig], pa.binary())], names=["rep", "sig"])

    def meet(t: pa.Table) -> pa.Table:
        key, rep, kin = (t.column(c).to_numpy() for c in ("key", "rep", "family"))
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(-1, MINHASHES)
        left, out = t.column("left").to_numpy(), []
        order, starts = _grouped(key)
        for s, e in zip(starts, np.append(starts[1:], len(order))):
            rows = order[s:e]
            who, at = np.unique(rep[rows], return_inverse=True)
            x, y = np.flatnonzero(left[rows]), np.flatnonzero(~left[rows])
            p, label = [], np.arange(len(who))
            for i in range(0, len(x), 64):
                some = x[i : i + 64]
                new = kin[rows[some], None] != kin[None, rows[y]]
                a, b = np.nonzero(new & _close(sig[rows[some], None], sig[None, rows[y]], agree))
                p.append(np.stack([at[some[a]], at[y[b]]], 1))
                if sum(map(len, p)) > 1 << 20:  # a forest says the same
                    label = _joined(len(who), np.concatenate(p))
                    p = [np.stack([label, np.arange(len(who))], 1)]
            label = _joined(len(who), np.concatenate(p)) if p else label
            out.append(np.stack([who[label], who], 1)[label != np.arange(len(who))])
        edge = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *out]), axis=0)
        return pa.table({"a": edge[:, 0], "b": edge[:, 1]})

    each = map_batches(sets.select("rep", "sig"), keys, "key long, rep long")
    hot = hot.distinct()
    each = each.join(F.broadcast(hot) if small(hot, BROADCAST_IDS) else hot, "key", "left_semi").join(family, "rep", "left")
    each = materialize(each.withColumn("family", F.coalesce("family", "rep")), "hot")
    of_key = each.groupBy("key", "family").count().groupBy("key").agg(
        F.sum("count").alias("n"), F.max("count").alias("most"), F.max_by("family", F.struct("count", "family")).alias("main")
    )
    of_key = of_key.where("most < n").select("key", "main", F.ceil((F.col("n") - F.col("most")) / SKETCHES).alias("outside"), F.ceil(F.col("n") / SKETCHES).alias("all"))
    of_key = materialize(of_key, "open")
    sides = each.join(F.broadcast(of_key) if small(of_key, BROADCAST_IDS) else of_key, "key")
    tile = lambda tiles: F.pmod(F.xxhash64("rep", F.lit(13)), F.col(tiles))
    to_all = lambda tiles: F.explode(F.sequence(F.lit(0), F.col(tiles) - 1))
    outside = sides.where("family <> main").withColumn("left", F.lit(True)).withColumn("i", tile("outside")).withColumn("j", to_all("all"))
    anyone = sides.withColumn("left", F.lit(False)).withColumn("j", tile("all")).withColumn("i", to_all("outside"))
    columns = ["key", "rep", "family", "left", "i", "j", "all"]
    dealt = outside.select(columns).unionAll(anyone.select(columns))
    deal = F.when(F.col("all") == 1, F.pmod(F.xxhash64("key"), F.lit(buckets))).otherwise(F.col("key"))
    sketches = map_batches(sets.select("rep", "sig"), low, "rep long, sig binary")
    met = dealt.withColumn("deal", deal).join(sketches, "rep").groupBy("deal", "i", "j").applyInArrow(meet, "a long, b long")
    found = materialize(met.distinct(), "more")
    discard(each, of_key)
    return found


def _exact_links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the components of sets under 100 * intersection >= percent * union, by exact counts."""
    n, size = len(sets), np.array([len(s) for s in sets])
    values, col = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), size)
    shared = np.bincount(col) > 1
    keep = shared[col]
    col, row = (np.cumsum(shared) - 1)[col[keep]], row[keep]
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    both = np.zeros((n, n), np.int64)
    for lo in range(0, int(shared.sum()), 4096):
        s, e = np.searchsorted(col, [lo, lo + 4096])
        m = np.zeros((n, 4096), np.float32)
        m[row[s:e], col[s:e] - lo] = 1
        both += (m @ m.T).astype(np.int64)  # of 4096 columns: exact in 32 bits
    link = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    label = _labels(link)
    return [(int(ids[label[i]]), int(ids[i])) for i in range(n) if label[i] != i]


def links(docs: DataFrame, members: DataFrame, text: str, percent: int, buckets: int) -> DataFrame:
    """Exact links (a, b) that connect each family's components; members: rep, h1, n_shingles, family. Families above a tile are
    dealt out in pairs of tiles, so each task holds two tiles of sets at most."""
    sizes = members.groupBy("family").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    tiles = members.join(sizes, "family").withColumn("tiles", F.ceil(F.greatest(F.col("n") / TILE, F.col("total") * 8 / TILE_BYTES)).cast("int"))
    wanted = tiles.select("rep", "h1")
    ids = wanted.select(F.col("rep").alias("doc_id")).distinct()
    rows = docs.select("doc_id", F.col(text).alias("t")).join(F.broadcast(ids) if small(ids, BROADCAST_IDS) else ids, "doc_id", "left_semi")

    def hashes(b: pa.RecordBatch):
        for lo, hi, buf, offs in K.slices(b.column(1)):
            key, at = shingle_sets(buf, offs)
            h1 = np.zeros(hi - lo, np.uint64)
            full = np.flatnonzero(np.diff(at))
            if len(full):
                h1[full] = K.mix(np.add.reduceat(K.mix(key), at[full]))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(h1.view(np.int64)), pa.array([key[s:e].tobytes() for s, e in zip(at[:-1], at[1:])], pa.binary())], names=["rep", "h1", "hashes"])

    sets = map_batches(rows, hashes, "rep long, h1 long, hashes binary")
    mine = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    placed = tiles.withColumn("i", mine).withColumn("j", other).select(
        "rep", "h1", "family",
        F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("family"), F.lit(buckets))).otherwise(-1 - F.col("family")).alias("deal"),
        F.least("i", "j").alias("ti"), F.greatest("i", "j").alias("tj"),
    )

    def confirm(t: pa.Table) -> pa.Table:
        family, rep = t.column("family").to_numpy(), t.column("rep").to_numpy()
        blobs, out = t.column("hashes").to_pylist(), []
        order, starts = _grouped(family)
        for s, e in zip(starts, np.append(starts[1:], len(order))):
            ids, first = np.unique(rep[order[s:e]], return_index=True)
            if len(ids) > 1:
                out += _exact_links(ids, [np.frombuffer(blobs[i], np.uint64) for i in order[s:e][first]], percent)
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return placed.join(sets, ["rep", "h1"]).groupBy("deal", "ti", "tj").applyInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs.

    Null, empty or blank texts have no shingles and stand alone; rows without id have neither component nor verdict
    (null component, kept). Rows that repeat an id are one node of the graph. Texts of any length count whole, equal sets have
    their smallest id as component at least; further columns are not looked at; an empty table gives an empty result."""
    buckets = max(16, 4 * docs.rdd.getNumPartitions())
    sketched = materialize(sketch(docs, text), "sketches")
    sets = sketched.where("sig is not null and doc_id is not null").groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.any_value("sig").alias("sig"))
    sets = materialize(sets, "sets")
    busy = active(sets, buckets)
    near = materialize(families(sets.join(busy, "rep", "left_semi"), buckets, agreeing(percent)), "near")
    family = components(near.where("hot is null")).select(F.col("node").alias("rep"), F.col("component").alias("family"))
    hot = near.where("hot is not null").select(F.col("hot").alias("key"))
    if hot.take(1):
        more = unsettled(sets, hot, family, buckets, agreeing(percent))
        if more.take(1):
            family = components(family.select(F.col("rep").alias("a"), F.col("family").alias("b")).unionAll(more))
            family = family.select(F.col("node").alias("rep"), F.col("component").alias("family"))
        discard(more)
    members = materialize(sets.select("rep", "h1", "n_shingles").join(family, "rep"), "members")
    of_row = sketched.select("doc_id", "n_shingles", "h1", "h2").join(sets.select("h1", "h2", "n_shingles", "rep"), ["h1", "h2", "n_shingles"], "left")
    of_row = materialize(of_row.select("doc_id", "n_shingles", "rep"), "rows")
    reps = of_row.where("rep is not null and doc_id is not null").select("doc_id", "rep").distinct()
    several = materialize(reps.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("doc_id", "a"), "repeated")
    same_id = reps.join(F.broadcast(several) if small(several, BROADCAST_IDS) else several, "doc_id")
    same_id = same_id.select("a", F.col("rep").alias("b"))  # sets of rows that repeat an id
    linked = components(links(docs, members, text, percent, buckets).unionAll(same_id)).select(F.col("node").alias("rep"), F.col("component").alias("component_id"))
    out = of_row.join(linked, "rep", "left").withColumn("component_id", F.coalesce("component_id", "rep"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    discard(sketched, sets, near, members, several)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
