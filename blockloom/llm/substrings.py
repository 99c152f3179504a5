"""Exact substring deduplication: bytes covered by a LENGTH-byte string that also starts in a smaller document.

Every window of LENGTH bytes hangs on one fingerprint, its least GRAM-byte hash, so equal windows share it. Blocks of
documents send their fingerprints; those that two documents share mark the runs of windows that could repeat. Only these
runs' bytes meet, by fingerprint: equal runs are settled by the smallest document, and what is left goes through a suffix
array (see `suffixes`) in which equal windows stand together. Of a fingerprint that several documents of a block share,
the block settles its own and sends one, so no key gathers more than a row per block."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .passages import _delta, grow, shrink
from .spark_io import lean, materialize
from .suffixes import suffix_array

LENGTH, GRAM = 50, 24
BLOCK_BYTES = 8 << 20
HOT_ROWS, HOT_SHARE = 20_000, 10_000
_LOW32, _LOW48 = np.uint64(0xFFFFFFFF), np.uint64((1 << 48) - 1)


def _pack(body: bytes) -> bytes:
    return pa.Codec("zstd", 3).compress(body, asbytes=True)


def _unpack(body: bytes, n: int) -> bytes:
    return pa.Codec("zstd", 3).decompress(body, n, asbytes=True)


def runs(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(fingerprint, its place, first window, last window, row): maximal runs of windows with the same fingerprint."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    inside = np.zeros(n + 1, np.int32)
    long = np.diff(offs) >= LENGTH
    np.add.at(inside, offs[:-1][long], 1)
    np.add.at(inside, offs[1:][long] - LENGTH + 1, -1)
    p = np.flatnonzero(np.cumsum(inside[:n]))
    if not len(p):
        return none.astype(np.uint64), none, none, none, none
    at = np.arange(n - GRAM + 1)
    gram = K.Hasher(buf).every(GRAM)
    low = (gram & ~_LOW32) | at.astype(np.uint64)
    for step in (1, 2, 4, 8):
        low[:-step] = np.minimum(low[:-step], low[step:])
    rest = LENGTH - GRAM + 1 - 16
    q = (np.minimum(low[p], low[p + rest]) & _LOW32).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (p[1:] != p[:-1] + 1)]))
    last = np.append(new[1:], len(p)) - 1
    return gram[q[new]], q[new], p[new], p[last], np.searchsorted(offs, p[new], "right") - 1


def _bucket_of(ids: np.ndarray, n: int) -> np.ndarray:
    return (ids + (ids >> 7) + (ids >> 15)) % n


def _blobs(bucket: np.ndarray, doc: np.ndarray, place: np.ndarray, key: np.ndarray | None, flag: np.ndarray | None, side: int):
    """Rows (bucket, side, doc, place, key, flag): compressed columns of each bucket, by document and place."""
    order = np.lexsort((place, doc, bucket))
    cuts = np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1))
    for s, e in zip(cuts, np.append(cuts[1:], len(order))):
        o = order[s:e]
        cols = [shrink(_delta(doc[o])), shrink(place[o].astype(np.int32)), shrink(key[o] & _LOW48) if key is not None else b"", shrink(flag[o].astype(np.int32)) if flag is not None else b""]
        yield pa.RecordBatch.from_arrays([pa.array([int(bucket[o[0]])], pa.int32()), pa.array([side], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)], names=["bucket", "side", "doc", "place", "key", "flag"])


_MARKS = "bucket int, side int, doc binary, place binary, key binary, flag binary"


def fingerprints(docs: DataFrame, buckets: int) -> DataFrame:
    """Side 0, by fingerprint: (document, place, fingerprint, its places in the block if several documents have it, else 0);
    side 1, by document: places of fingerprints that the block itself has in several documents."""

    def run(batches):
        held, size = [], 0

        def flush():
            key, doc, place = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(key, kind="stable")
            key, doc, place = key[order], doc[order], place[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            starts = np.flatnonzero(new)
            count = np.diff(np.append(starts, len(key)))
            many = np.repeat(np.maximum.reduceat(doc, starts) > np.minimum.reduceat(doc, starts), count)
            send = ~many | new
            yield from _blobs((key[send] >> np.uint64(48)) % np.uint64(buckets), doc[send], place[send], key[send], (many * np.repeat(count, count))[send], 0)
            if many.any():
                yield from _blobs(_bucket_of(doc[many], buckets), doc[many], place[many], None, None, 1)

        for b in batches:
            ids = b.column(0).to_numpy()
            for lo, _, buf, offs in K.slices(b.column(1)):
                key, q, _, _, row = runs(buf, offs)
                if len(key):
                    held.append((key, ids[lo + row], q - offs[row]))
                    size += len(buf)
                if size >= BLOCK_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    rows = docs.where(F.col("doc_id").isNotNull() & F.col("t").isNotNull()).select("doc_id", "t")
    return rows.mapInArrow(run, _MARKS)


def shared(sent: DataFrame, buckets: int) -> DataFrame:
    """All side 1 rows: those that blocks sent, and the places whose fingerprint another block has as well; side 2:
    fingerprints with more than HOT_ROWS places and how many (a bucket's number above its 48 bits); side 3: all places."""
    hot_rows = HOT_ROWS
    schema = pa.schema([("bucket", pa.int32()), ("side", pa.int32()), *((c, pa.binary()) for c in ("doc", "place", "key", "flag"))])

    def meet(t: pa.Table) -> pa.Table:
        side = t.column("side").to_numpy()
        own = t.filter(pa.array(side == 1)).cast(schema)
        t = t.filter(pa.array(side == 0))
        if not t.num_rows:
            return own
        parts = [(np.cumsum(grow(d, "i8")), grow(p, "i4"), grow(k, "u8"), grow(f, "i4")) for d, p, k, f in zip(*(t.column(c).to_pylist() for c in ("doc", "place", "key", "flag")))]
        bucket = t.column("bucket")[0].as_py()
        doc, place, key, many = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(key, kind="stable")
        doc, place, key, many = doc[order], place[order], key[order], many[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        again = (np.maximum.reduceat(many, starts) > 0) | (np.maximum.reduceat(doc, starts) > np.minimum.reduceat(doc, starts))
        keep = np.repeat(again, np.diff(np.append(starts, len(key))))
        out = list(_blobs(_bucket_of(doc[keep], buckets), doc[keep], place[keep], None, None, 1)) if keep.any() else []
        places = np.add.reduceat(np.maximum(many, 1).astype(np.int64), starts)
        code = key[starts] | np.uint64(bucket << 48)
        hot = places > hot_rows
        extra = [{"bucket": bucket, "side": 2, "key": shrink(code[hot]), "flag": shrink(places[hot])}] if hot.any() else []
        extra.append({"bucket": bucket, "side": 3, "flag": shrink(np.array([places.sum()]))})
        return pa.concat_tables([own, pa.Table.from_batches(out, schema), pa.Table.from_pylist(extra, schema)])

    return sent.groupBy("bucket").applyInArrow(meet, _MARKS)


def hot_fingerprints(marks: DataFrame) -> np.ndarray:
    """The at most HOT_SHARE fingerprints that hold more than one in HOT_SHARE of all places (and HOT_ROWS)."""
    def sums(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(int(grow(f, "i8").sum()) for f in b.column(0).to_pylist())], pa.int64())], names=["n"])

    total = marks.where("side = 3").select("flag").mapInArrow(sums, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(HOT_ROWS, total // HOT_SHARE)

    def run(batches):
        for b in batches:
            out = [k[n > least] for k, n in ((grow(k, "u8"), grow(f, "i8")) for k, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *out]).view(np.int64))], names=["code"])

    rows = marks.where("side = 2").select("key", "flag").mapInArrow(run, "code long").collect()
    return np.sort(np.array([r["code"] for r in rows], np.int64).view(np.uint64))


def _finish(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[int, int, str]:
    """Removed bytes, maximal removed runs, and the digest of the rest."""
    change = np.zeros(len(text) + 1, np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, hashlib.sha256(text[~gone].tobytes()).hexdigest()


_DONE = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_MIXED = "kind int, bucket int, n_bytes long, c0 binary, c1 binary, c2 binary, c3 binary, c4 binary, c5 binary"
_BLOBS = ("c0", "c1", "c2", "c3", "c4", "c5")
_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("n_bytes", pa.int64()), *((c, pa.binary()) for c in _BLOBS)])


def _span_rows(doc: np.ndarray, rid: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> list[dict]:
    """Kind 1: spans to remove, by bucket of their document, as compressed columns."""
    part = _bucket_of(doc, buckets)
    order = np.lexsort((start, doc, part))
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    rows = []
    for s, e in zip(cuts, np.append(cuts[1:], len(order))):
        o = order[s:e]
        rows.append({"kind": 1, "bucket": int(part[o[0]]), "c0": shrink(_delta(doc[o])), "c1": shrink(rid[o]), "c2": shrink(start[o]), "c3": shrink(end[o] - start[o])})
    return rows


def _table(rows: list[dict]) -> pa.Table:
    return pa.table({f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in _SCHEMA}, _SCHEMA)


def _alike(h: np.ndarray, bodies: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for each window bodies[at : at + LENGTH], equal for equal bytes and for no others; hashes only lead to them."""
    out, n = np.zeros(len(h), np.int64), 0
    left, step = np.arange(len(h)), np.arange(LENGTH)
    while len(left):
        _, first, group = np.unique(h[left], return_index=True, return_inverse=True)
        same = np.zeros(len(left), bool)
        for lo in range(0, len(left), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            same[part] = (bodies[at[left[part], None] + step] == bodies[at[left[first[group[part]]], None] + step]).all(axis=1)
        out[left[same]] = n + group[same]
        n += len(first)
        left = left[~same]
    return out


def _window_rows(h: np.ndarray, bodies: np.ndarray, at: np.ndarray, doc: np.ndarray, rid: np.ndarray, place: np.ndarray, buckets: int) -> list[dict]:
    """Kind 3: of each window its bytes and its smallest document's places, by hash; kind 1: the other documents' places."""
    if not len(h):
        return []
    alike = _alike(h, bodies, at)
    order = np.lexsort((place, doc, alike))
    h, at, doc, rid, place, alike = h[order], at[order], doc[order], rid[order], place[order], alike[order]
    starts = np.flatnonzero(np.concatenate([[True], alike[1:] != alike[:-1]]))
    first = doc == np.repeat(doc[starts], np.diff(np.append(starts, len(h))))
    rows = _span_rows(doc[~first], rid[~first], place[~first], place[~first] + LENGTH, buckets) if not first.all() else []
    h, at, doc, rid, place, alike = h[first], at[first], doc[first], rid[first], place[first], alike[first]
    bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((alike, bucket))
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for s, e in zip(cuts, np.append(cuts[1:], len(order))):
        o = order[s:e]
        new = np.flatnonzero(np.concatenate([[True], alike[o][1:] != alike[o][:-1]]))
        body = bodies[at[o[new], None] + np.arange(LENGTH)].tobytes()
        cols = [shrink(h[o[new]]), shrink(doc[o]), shrink(rid[o]), shrink(place[o]), shrink(np.diff(np.append(new, len(o)))), _pack(body)]
        rows.append({"kind": 3, "bucket": int(bucket[o[0]]), **dict(zip(_BLOBS, cols)), "n_bytes": len(body)})
    return rows


def _met_windows(t: pa.Table, buckets: int) -> list[dict]:
    """Kind 1 of the windows that meet at their hash: all places in other documents than the smallest one with these bytes."""
    h, doc, rid, place, count = (np.concatenate([grow(x, k) for x in t.column(c).to_pylist()]) for c, k in zip(_BLOBS, ("u8", "i8", "i8", "i8", "i8")))
    bodies = np.frombuffer(b"".join(_unpack(x, n) for x, n in zip(t.column("c5").to_pylist(), t.column("n_bytes").to_pylist())), np.uint8)
    which = np.repeat(np.arange(len(h)), count)
    return [r for r in _window_rows(h[which], bodies, which * LENGTH, doc, rid, place, buckets) if r["kind"] == 1]


def packed(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents by bucket of their id, compressed: (part, ids, whether there is one, byte lengths, bytes)."""

    def run(batches):
        held, size = [], 0

        def flush():
            ids, has, n = (np.concatenate([h[i] for h in held]) for i in range(3))
            offs, raw = np.concatenate([[0], np.cumsum(n)]), b"".join(h[3] for h in held)
            part = np.where(has, _bucket_of(ids, buckets), (np.arange(len(ids)) + len(raw)) % buckets)  # rows without id meet no others
            order = np.lexsort((ids, part))
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            for s, e in zip(cuts, np.append(cuts[1:], len(order))):
                o = order[s:e]
                body = b"".join(raw[offs[i] : offs[i + 1]] for i in o)
                cols = [shrink(ids[o]), has[o].tobytes(), shrink(n[o]), _pack(body)]
                yield pa.RecordBatch.from_arrays([pa.array([int(part[o[0]])], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)], names=["part", "ids", "has", "sizes", "body"])

        for b in batches:
            col = b.column(0)
            ids, has = col.fill_null(0).to_numpy(zero_copy_only=False), np.array(col.is_valid())
            for lo, hi, buf, offs in K.slices(b.column(1)):
                held.append((ids[lo:hi], has[lo:hi], np.diff(offs), buf.tobytes()))
                size += len(buf)
                if size >= BLOCK_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return docs.select("doc_id", "t").mapInArrow(run, "part int, ids binary, has binary, sizes binary, body binary")


def _ordinals(ids: np.ndarray, has: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """0, but numbers the different texts of an id that is repeated (all its rows are in one bucket)."""
    out = np.zeros(len(ids), np.int64)
    values, count = np.unique(ids[has], return_counts=True)
    for v in values[count > 1].tolist():
        rows = np.flatnonzero((ids == v) & has)
        texts = [buf[offs[i] : offs[i + 1]].tobytes() for i in rows]
        order = {t: k for k, t in enumerate(sorted(set(texts)))}
        out[rows] = [order[t] for t in texts]
    return out


def _opened(left: pa.Table) -> tuple[np.ndarray, ...]:
    """(ids, whether there is one, text ordinals, bytes, offsets) of the documents of a bucket."""
    cols = [left.column(c).to_pylist() for c in ("ids", "has", "sizes", "body")]
    ids, has = np.concatenate([grow(x, "i8") for x in cols[0]]), np.concatenate([np.frombuffer(x, bool) for x in cols[1]])
    sizes = [grow(x, "i8") for x in cols[2]]
    buf = np.frombuffer(b"".join(_unpack(x, int(n.sum())) for x, n in zip(cols[3], sizes)), np.uint8)
    offs = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
    return ids, has, _ordinals(ids, has, buf, offs), buf, offs


def contexts(docs: DataFrame, marks: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """Kind 1: spans that are settled within a bucket of documents; 2: the marked runs' bytes, by fingerprint; 3: windows of
    the runs of hot fingerprints with their bytes, by hash."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            doc = np.concatenate([np.cumsum(grow(x, "i8")) for x in right.column("doc").to_pylist()])
            place = np.concatenate([grow(x, "i4") for x in right.column("place").to_pylist()])
            mark = np.unique(K.mix(doc.view(np.uint64)) + place.astype(np.uint64))
        else:
            return _table([])
        ids, has, rid, buf, offs = _opened(left)
        found, lo = [], 0
        while lo < len(ids):
            hi = min(max(int(np.searchsorted(offs, offs[lo] + K.SLICE, "right")) - 1, lo + 1), len(ids))
            key, q, p0, p1, row = runs(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
            row = row + lo
            code = K.mix(ids[row].view(np.uint64)) + (q + offs[lo] - offs[row]).astype(np.uint64)
            i = np.minimum(np.searchsorted(mark, code), len(mark) - 1)
            hit = np.flatnonzero((mark[i] == code) & has[row])
            found.append((key[hit], row[hit], p0[hit] + offs[lo], p1[hit] + offs[lo] + LENGTH))
            lo = hi
        key, row, start, end = (np.concatenate(c) for c in zip(*found))
        if not len(row):
            return _table([])
        doc, whole = ids[row], buf.tobytes()
        text = [whole[x:y] for x, y in zip(start.tolist(), end.tolist())]
        least: dict[bytes, int] = {}
        for x, d in zip(text, doc.tolist()):
            if least.get(x, d) >= d:
                least[x] = d
        lost = np.array([least[x] < d for x, d in zip(text, doc.tolist())], bool)
        at = np.flatnonzero(lost)
        out = _span_rows(doc[at], rid[row[at]], start[at] - offs[row[at]], end[at] - offs[row[at]], buckets)
        warm = ~lost
        if len(hot):
            code = (key & _LOW48) | (((key >> np.uint64(48)) % np.uint64(buckets)) << np.uint64(48))
            i = np.minimum(np.searchsorted(hot, code), len(hot) - 1)
            mine = np.flatnonzero(warm & (hot[i] == code))
            warm[mine] = False
            n = end[mine] - start[mine] - LENGTH + 1
            of = np.repeat(mine, n)
            at = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            out += _window_rows(K.Hasher(buf)(at, at + LENGTH) if len(at) else np.zeros(0, np.uint64), buf, at, doc[of], rid[row[of]], at - offs[row[of]], buckets)
        bucket = (key >> np.uint64(40)) % np.uint64(buckets)
        order = np.flatnonzero(warm)
        order = order[np.lexsort((start[order], doc[order], bucket[order]))]
        cuts = np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1))
        for s, e in zip(cuts, np.append(cuts[1:], len(order))):
            o = order[s:e]
            cols = [shrink(key[o] & _LOW48), shrink(_delta(doc[o])), shrink(rid[row[o]]), shrink(start[o] - offs[row[o]]), shrink(end[o] - start[o])]
            body = b"".join(text[i] for i in o)
            out.append({"kind": 2, "bucket": int(bucket[o[0]]), **dict(zip(_BLOBS, [*cols, _pack(body)])), "n_bytes": len(body)})
        return _table(out)

    right = marks.select(F.col("bucket").alias("at"), F.col("doc"), F.col("place"))
    return packed(docs, buckets).groupBy("part").cogroup(right.groupBy("at")).applyInArrow(work, _MIXED)


def repeated_windows(texts: list[bytes], docs: list[int]) -> list[list[int]]:
    """Of distinct texts with their smallest documents: the places whose window starts in a text of a smaller document.

    The texts are joined with separators below all bytes; in the suffix array equal windows are neighbours."""
    joined: list[int] = []
    where: list[tuple[int, int]] = []
    for i, t in enumerate(texts):
        where += [(i, j) for j in range(len(t) + 1)]
        joined += [b + 2 for b in t]
        joined.append(1)
    joined.append(0)
    out: list[list[int]] = [[] for _ in texts]
    group: list[tuple[int, int]] = []
    last = b""

    def close() -> None:
        least = min(docs[i] for i, _ in group)
        for i, j in group:
            if docs[i] > least:
                out[i].append(j)

    for s in suffix_array(joined)[1:]:
        i, j = where[s]
        t = texts[i]
        if j + LENGTH > len(t):
            continue
        w = t[j : j + LENGTH]
        if w != last and group:
            if len(group) > 1:
                close()
            group = []
        group.append((i, j))
        last = w
    if len(group) > 1:
        close()
    return out


def _trimmed(texts: list[bytes], least: np.ndarray) -> list[tuple[int, int]]:
    """For each text its first and last window that a text with another smallest document may have too (by hashes; a
    window without such a partner repeats nothing). (0, -1) if there is none."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    count = np.diff(offs) - LENGTH + 1
    of = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = offs[of] + place
    _, key = np.unique(K.Hasher(buf)(at, at + LENGTH), return_inverse=True)
    low, high = np.full(key.max() + 1, np.iinfo(np.int64).max), np.full(key.max() + 1, np.iinfo(np.int64).min)
    np.minimum.at(low, key, least[of])
    np.maximum.at(high, key, least[of])
    hit = np.flatnonzero(low[key] < high[key])
    first, last = np.zeros(len(texts), np.int64), np.full(len(texts), -1, np.int64)
    if len(hit):
        starts = np.flatnonzero(np.concatenate([[True], of[hit][1:] != of[hit][:-1]]))
        first[of[hit[starts]]] = place[hit[starts]]
        last[of[hit[starts]]] = place[hit[np.append(starts[1:], len(hit)) - 1]]
    return list(zip(first.tolist(), last.tolist()))


def _repeats(groups: list[list[int]], texts: list[bytes], least: list[int]) -> dict[int, list[tuple[int, int]]]:
    """Spans to remove (start, end) in the smallest document of each text; groups list the texts of one fingerprint.

    Texts are first cut to the part that may repeat; most then are equal. Different ones go through the suffix array."""
    out: dict[int, list[tuple[int, int]]] = {}
    chosen = [i for g in groups for i in g]
    if not chosen:
        return out
    part = dict(zip(chosen, _trimmed([texts[i] for i in chosen], np.array([least[i] for i in chosen], np.int64))))
    for g in groups:
        of: dict[bytes, list[int]] = {}
        for i in g:
            a, b = part[i]
            if b >= a:
                of.setdefault(texts[i][a : b + LENGTH], []).append(i)
        lows = [min(least[i] for i in m) for m in of.values()]
        places = repeated_windows(list(of), lows) if len(of) > 1 and len(set(lows)) > 1 else [[] for _ in of]
        for (t, members), low, found in zip(of.items(), lows, places):
            for i in members:
                a = part[i][0]
                if least[i] > low:
                    out[i] = [(a, a + len(t))]
                elif found:
                    out[i] = [(a + j, a + j + LENGTH) for j in found]
    return out


def settle(mixed: DataFrame, buckets: int) -> DataFrame:
    """Kind 1 as it comes, and kind 1 of the contexts that meet at their fingerprint."""

    def meet(t: pa.Table) -> pa.Table:
        kind = t.column("kind").to_numpy()
        rest = t.filter(pa.array(kind == 1)).cast(_SCHEMA)
        if (kind == 3).any():
            rest = pa.concat_tables([rest, _table(_met_windows(t.filter(pa.array(kind == 3)), buckets))])
        t = t.filter(pa.array(kind == 2))
        if not t.num_rows:
            return rest
        keys, docs, rids, starts, texts = [], [], [], [], []
        for key, doc, rid, start, size, body, n in zip(*(t.column(c).to_pylist() for c in (*_BLOBS, "n_bytes"))):
            raw = _unpack(body, n)
            ends = np.cumsum(grow(size, "i8")).tolist()
            texts += [raw[a:b] for a, b in zip([0, *ends], ends)]
            keys.append(grow(key, "u8")), docs.append(np.cumsum(grow(doc, "i8"))), rids.append(grow(rid, "i8")), starts.append(grow(start, "i8"))
        key, doc, rid, start = (np.concatenate(x) for x in (keys, docs, rids, starts))
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        d, r, p = doc.tolist(), rid.tolist(), start.tolist()
        different: list[bytes] = []
        least: list[int] = []
        rows_of: list[list[int]] = []
        groups: list[list[int]] = []
        for s, e in zip(cuts.tolist(), np.append(cuts[1:], len(order)).tolist()):
            if e - s < 2:
                continue
            of: dict[bytes, list[int]] = {}
            for i in order[s:e].tolist():
                of.setdefault(texts[i], []).append(i)
            n = len(different)
            different += of
            rows_of += of.values()
            least += [min(d[i] for i in rows) for rows in of.values()]
            if len(of) > 1 and len(set(least[n:])) > 1:
                groups.append(list(range(n, len(different))))
        again = _repeats(groups, different, least)
        spans: list[tuple[int, int, int, int]] = []
        for x, (text, rows) in enumerate(zip(different, rows_of)):
            places = again.get(x, [])
            for i in rows:
                if d[i] > least[x]:
                    spans.append((d[i], r[i], p[i], p[i] + len(text)))
                else:
                    spans += [(d[i], r[i], p[i] + a, p[i] + b) for a, b in places]
        out = _span_rows(*np.array(spans, np.int64).T, buckets) if spans else []
        return pa.concat_tables([rest, _table(out)])

    return mixed.groupBy("bucket").applyInArrow(meet, _MIXED)


def finish(docs: DataFrame, spans: DataFrame, buckets: int) -> DataFrame:
    """The result rows: spans meet their documents once more."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            ids, has, rid, buf, offs = _opened(left)
            cols = [right.column(c).to_pylist() for c in ("c0", "c1", "c2", "c3")] if right.num_rows else [[]] * 4
            doc = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(grow(x, "i8")) for x in cols[0])])
            which, start, size = (np.concatenate([np.zeros(0, np.int64), *(grow(x, "i8") for x in c)]) for c in cols[1:])
            order = np.lexsort((which, doc))
            doc, which, start, size = doc[order], which[order], start[order], size[order]
            for i in range(len(ids)):
                s, e = np.searchsorted(doc, [ids[i], ids[i] + 1]) if has[i] else (0, 0)
                if e > s:
                    s, e = s + np.searchsorted(which[s:e], [rid[i], rid[i] + 1])
                text = buf[offs[i] : offs[i + 1]]
                done = _finish(text, start[s:e], start[s:e] + size[s:e]) if e > s else (0, 0, hashlib.sha256(text.tobytes()).hexdigest())
                rows.append((int(ids[i]) if has[i] else None, len(text), *done))
        c = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.table({n: pa.array(v, k) for n, v, k in zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), c, kinds)})

    right = spans.select(F.col("bucket").alias("at"), "c0", "c1", "c2", "c3")
    return packed(docs, buckets).groupBy("part").cogroup(right.groupBy("at")).applyInArrow(work, _DONE)


def deduplicate(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of docs.

    Null texts are empty. Rows without id lose nothing and take nothing from others; rows that repeat an id keep their own
    text and take nothing from one another. Texts of any length count whole; of documents with the same string the smallest id
    keeps it; further columns are not looked at; an empty table gives an empty result."""
    lean(docs.sparkSession)
    buckets = max(16, 4 * docs.rdd.getNumPartitions())
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("t"))
    marks = materialize(shared(fingerprints(rows, buckets), buckets), "marks")
    found = contexts(rows, marks.where("side = 1"), hot_fingerprints(marks), buckets)
    return finish(rows, settle(found, buckets), buckets)
