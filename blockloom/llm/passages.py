"""Fuzzy repeated passages by collinear chaining of shared k-mer seeds.

Seeds are all five-word shingles. A block of documents sends each of its shingles once, with the places in the block's
smallest document that has it; what other documents of the block have is linked to that one at once. Shingles that meet
are linked to the smallest document of all. The links of a document and another one are chained with a Fenwick tree under
linear gap costs; a single seed is a chain too. Where neighbouring seeds have different sources, as those of a passage do
whose parts stand in smaller documents, the pair of sources is a seed of a further round. Places that lie in no passage then
meet all smaller documents with their seeds (`others`). Chains are then aligned word by word where their seeds leave words open,
and stretches of MIN_WORDS or more that agree in at least 80 % are passages that repeat an earlier document."""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .spark_io import discard, map_batches, materialize, small

SEED_WORDS = 5
MIN_WORDS = 50
#: A mismatching word costs this many matching ones: stretches whose sum is not negative agree in at least 80 %.
PENALTY = 4
#: Cost of a skipped word in a chain (both texts), longest gap that is aligned, words looked at beyond a chain's ends.
GAP_COST, MAX_GAP, REACH = 0.04, 64, 128
BLOCK_DOCS, BLOCK_BYTES, BROADCAST_IDS = 8192, 6 << 20, 500_000
#: Links to one source that follow each other within NEAR words, with shifts of up to SLACK words, are a part; parts of JOINT
#: links or more, each with another source, meet where MAX_GAP words or less lie between them.
NEAR, SLACK, JOINT = 16, 8, 3
#: Of a part only the links up to so many words from the joint are sent: one that both documents have is enough.
BESIDE = 32
#: Documents that are the source of more than one chain in HOT_SHARE (at most so many) are dealt out to several tasks.
HOT_SHARE = 500
_CODEC = pa.Codec("zstd", 1)
_LINKS = ("doc", "pos", "adoc", "apos", "key")
_SENT = "bucket int, side int, " + ", ".join(f"{c} binary" for c in _LINKS)
_SENT_TYPES = pa.schema([("bucket", pa.int32()), ("side", pa.int32()), *((c, pa.binary()) for c in _LINKS)])
_CHAIN = ("d", "a", "ds", "de", "as", "ae")
_CHAINS = "d long, a long, ds long, de long, `as` long, ae long, pos binary, apos binary"


def shrink(a: np.ndarray) -> bytes:
    """Bytes of an array by planes, compressed; the length comes first."""
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes() if len(a) else b""
    return len(a).to_bytes(8, "little") + (_CODEC.compress(raw, asbytes=True) if raw else b"")


def grow(b: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(b[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = np.frombuffer(_CODEC.decompress(b[8:], n * size, asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def _delta(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = K.LOWER[buf]
    s, e, first = K.words(low, offs)
    return K.Hasher(low)(s, e), first


def seeds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word position, hash) of all shingles."""
    h, first = word_hashes(buf, offs)
    w = K.windows(h, SEED_WORDS)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))[: len(w)]
    place = np.arange(len(w)) - first[row]
    ok = place < np.diff(first)[row] - SEED_WORDS + 1
    return row[ok], place[ok], w[ok]


def _bucket_of(ids: np.ndarray, n: int) -> np.ndarray:
    return (ids + (ids >> 7) + (ids >> 15)) % n


def _link_rows(doc: np.ndarray, pos: np.ndarray, adoc: np.ndarray, apos: np.ndarray, key: np.ndarray, buckets: int) -> list[dict]:
    """Side 1: links by bucket of their document, as compressed columns."""
    bucket = _bucket_of(doc, buckets)
    order = np.lexsort((pos, doc, bucket))
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    rows = []
    for s, e in zip(cuts, np.append(cuts[1:], len(order))):
        o = order[s:e]
        cols = (_delta(doc[o]), pos[o].astype(np.int32), adoc[o], apos[o].astype(np.int32), key[o])
        rows.append({"bucket": int(bucket[o[0]]), "side": 1, **{c: shrink(x) for c, x in zip(_LINKS, cols)}})
    return rows


def _partners(doc: np.ndarray, pos: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of places sorted by key, document and place: the smallest document of each key, the place in it that each place is
    linked to, and whether others have the key too. The n-th place of a document is linked to the smallest one's n-th (and
    so on in turns), so that text that repeats itself is linked in the order of both."""
    n = np.arange(len(key))
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    size = np.diff(np.append(starts, len(key)))
    start = np.repeat(starts, size)
    heads = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(key) else np.zeros(0, int)
    count = np.diff(np.append(heads, len(key)))
    of_first = np.repeat(count[np.searchsorted(heads, starts)], size)
    rank = n - np.repeat(heads, count)
    return doc[start], pos[start + rank % of_first], np.repeat(doc[starts + size - 1] > doc[starts], size)


def _sent(doc: np.ndarray, pos: np.ndarray, key: np.ndarray, buckets: int, asks: np.ndarray | None = None) -> list[dict]:
    """Side 0, by key: the places of each key in its smallest document, and whether others have it too; side 1: links of
    the others to that document. Places that do not ask are found, but get no links of their own."""
    order = np.lexsort((pos, doc, key))
    doc, pos, key = doc[order], pos[order], key[order]
    asks = np.ones(len(key), bool) if asks is None else asks[order]
    first, place, many = _partners(doc, pos, key)
    own = doc == first
    to = ~own & asks
    rows = _link_rows(doc[to], pos[to], first[to], place[to], key[to], buckets)
    doc, pos, key, many, asks = doc[own], pos[own], key[own], many[own], asks[own]
    bucket = ((key >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(bucket, prepend=np.uint64(1 << 63)))
    for s, e in zip(cuts, np.append(cuts[1:], len(key))):
        cols = (doc[s:e], pos[s:e].astype(np.int32), many[s:e], asks[s:e], _delta(key[s:e]))
        rows.append({"bucket": int(bucket[s]), "side": 0, **{c: shrink(x) for c, x in zip(_LINKS, cols)}})
    return rows


def _rows(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in schema}, schema)


def send(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """What blocks of documents send (see `_sent`) of their shingles, of which 48 bits are the key; rows without id or text
    send nothing."""

    def run(batches):
        held, size = [], 0

        def flush():
            doc, pos, h = (np.concatenate(c) for c in zip(*held))
            held.clear()
            yield from _rows(_sent(doc, pos, h >> np.uint64(16), buckets), _SENT_TYPES).to_batches(max_chunksize=64)

        for b in batches:
            ids = b.column(0).to_numpy()
            for lo, _, buf, offs in K.slices(b.column(1)):
                row, pos, h = seeds(buf, offs)
                if len(h):
                    held.append((ids[lo + row], pos.astype(np.int32), h))
                    size += len(buf)
                if size >= BLOCK_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    rows = docs.where(F.col("doc_id").isNotNull() & F.col(text).isNotNull()).select("doc_id", F.col(text).alias("t"))
    return rows.mapInArrow(run, _SENT)


def links(sent: DataFrame, buckets: int) -> DataFrame:
    """Side 1 rows of all places of keys that several documents have: those that blocks sent, and links to the smallest
    document of all (for its own places too: they count as shared). No key gathers more than a document a block."""

    def meet(t: pa.Table) -> pa.Table:
        side = t.column("side").to_numpy()
        own = t.filter(pa.array(side == 1)).cast(_SENT_TYPES)
        t = t.filter(pa.array(side == 0))
        if not t.num_rows:
            return own
        cols = [t.column(c).to_pylist() for c in _LINKS]
        doc, pos, many, asks = (np.concatenate([grow(x, k) for x in c]) for c, k in zip(cols, ("i8", "i4", "?", "?")))
        key = np.concatenate([np.cumsum(grow(x, "u8"), dtype=np.uint64) for x in cols[4]])
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        again = np.append(False, same) | np.append(same, False) | many[order]  # most keys stand alone
        order = order[again]
        order = order[np.lexsort((pos[order], doc[order], key[order]))]
        doc, pos, key, many, asks = doc[order], pos[order], key[order], many[order], asks[order]
        if not len(key):
            return own
        first, place, several = _partners(doc, pos, key)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        many = np.repeat(np.maximum.reduceat(many, starts), np.diff(np.append(starts, len(key))))
        shared = (several | many) & asks
        return pa.concat_tables([own, _rows(_link_rows(doc[shared], pos[shared], first[shared], place[shared], key[shared], buckets), _SENT_TYPES)])

    return sent.groupBy("bucket").applyInArrow(meet, _SENT)


def chain(pos: np.ndarray, apos: np.ndarray) -> list[np.ndarray]:
    """Best collinear chains (indices of matches sorted by pos, apos), each match in one chain at most.

    A match adds SEED_WORDS and each skipped word costs GAP_COST, so the best predecessor with smaller positions is a
    prefix maximum over apos: a Fenwick tree keeps it while matches come in the order of pos. Chains are cut where a gap
    is longer than MAX_GAP, which is more than is aligned."""
    n = len(pos)
    steps = np.concatenate([pos[1:] - pos[:-1], apos[1:] - apos[:-1]])
    if n and (n == 1 or (steps.min() > 0 and steps.max() <= MAX_GAP)):
        return [np.arange(n)]  # one run: no choice to make
    score, before = chain_scores(pos, apos)
    p, a = pos.tolist(), apos.tolist()
    used, out = [False] * n, []
    for x in sorted(range(n), key=lambda x: -score[x]):
        path = []
        while x >= 0 and not used[x]:
            used[x] = True
            if path and (p[path[-1]] - p[x] > MAX_GAP or a[path[-1]] - a[x] > MAX_GAP):
                out.append(np.array(path[::-1]))
                path = []
            path.append(x)
            x = before[x]
        if path:
            out.append(np.array(path[::-1]))
    return out


def chain_scores(pos: np.ndarray, apos: np.ndarray) -> tuple[list[float], list[int]]:
    """For each match the score of the best chain that ends there, and its predecessor in it (-1: none)."""
    n = len(pos)
    values, rank = np.unique(apos, return_inverse=True)
    m = len(values)
    tree, who = [0.0] * (m + 1), [-1] * (m + 1)
    score, before = [0.0] * n, [-1] * n
    p, a, r = pos.tolist(), apos.tolist(), (rank + 1).tolist()
    i = 0
    while i < n:
        j = i
        while j < n and p[j] == p[i]:  # equal positions do not follow each other
            k, best, at = r[j] - 1, 0.0, -1
            shift = GAP_COST * (p[j] + a[j])
            while k:
                if who[k] >= 0 and tree[k] - shift > best:
                    best, at = tree[k] - shift, who[k]
                k &= k - 1
            score[j], before[j] = SEED_WORDS + best, at
            j += 1
        for x in range(i, j):
            k, v = r[x], score[x] + GAP_COST * (p[x] + a[x])
            while k <= m:
                if who[k] < 0 or v > tree[k]:
                    tree[k], who[k] = v, x
                k += k & -k
        i = j
    return score, before


def _chain_rows(d: np.ndarray, p: np.ndarray, a: np.ndarray, q: np.ndarray) -> tuple[list[dict], tuple[np.ndarray, ...]]:
    """Chains of the links of each document with each other one, and the links that are chains of their own. Of seeds that
    follow each other in both texts every SEED_WORDS-th and the last stand for all."""
    out: list[dict] = []
    order = np.lexsort((q, p, a, d))
    order = order[a[order] != d[order]]
    d, p, a, q = d[order], p[order], a[order], q[order]
    if not len(d):
        return out, (d, p, a, q)
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)])
    starts = np.flatnonzero(new)
    place = np.arange(len(d)) - np.repeat(starts, np.diff(np.append(starts, len(d))))
    keep = (place % SEED_WORDS == 0) | np.append(new[1:], True)
    d, p, a, q = d[keep], p[keep], a[keep], q[keep]
    cuts = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] != a[:-1])]))
    size = np.diff(np.append(cuts, len(d)))
    alone = cuts[size == 1].tolist()
    for s, e in zip(cuts[size > 1].tolist(), (cuts + size)[size > 1].tolist()):
        found = chain(p[s:e], q[s:e])
        alone += [s + int(c[0]) for c in found if len(c) == 1]
        for c in (c for c in found if len(c) > 1):
            x, y = p[s:e][c], q[s:e][c]
            ends = (d[s], a[s], x[0], x[-1], y[0], y[-1])
            out.append({**dict(zip(_CHAIN, map(int, ends))), "pos": shrink(x.astype(np.int32)), "apos": shrink(y.astype(np.int32))})
    at = np.sort(np.array(alone, np.int64))
    return out, (d[at], p[at], a[at], q[at])


class _Covered:
    """Stretches of documents that chains settle by their seeds alone (words in gaps and around count as different): what
    `stretches` takes of a chain is found whatever stands there."""

    def __init__(self, found: list[dict], docs: np.ndarray):
        self.ids = np.unique(docs)
        spans = []
        for c in found:
            words = c["de"] + SEED_WORDS - c["ds"]
            before = MIN_WORDS // (PENALTY + 1) if min(c["ds"], c["as"]) >= MIN_WORDS // (PENALTY + 1) else 0
            if words + before < MIN_WORDS:
                continue
            pos = grow(c["pos"], "i4") - c["ds"]
            if np.diff(pos).max(initial=0) <= SEED_WORDS:
                spans.append((c["d"], c["ds"], c["ds"] + words))
                continue
            flags = np.zeros(before + words, bool)
            for k in range(SEED_WORDS):
                flags[before + pos + k] = True
            spans += [(c["d"], c["ds"] + max(s - before, 0), c["ds"] + e - before) for s, e, _ in stretches(flags)]
        self._take(np.array(spans, np.int64).reshape(-1, 3).T)

    @classmethod
    def by_spans(cls, docs: np.ndarray, d: np.ndarray, start: np.ndarray, end: np.ndarray) -> _Covered:
        """The stretches from start to end of d, of documents among docs; those that touch are one."""
        out = cls([], docs)
        mine = np.isin(d, out.ids)
        out._take(np.stack([d[mine], start[mine], end[mine]]))
        new = np.concatenate([[True], out.start[1:] > out.end[:-1]]) if len(out.start) else np.zeros(0, bool)
        out.start = out.start[new][np.cumsum(new) - 1]
        out.start, at = np.unique(out.start, return_index=True)
        out.end = np.maximum.reduceat(out.end, at) if len(at) else out.end
        return out

    def _take(self, spans: np.ndarray) -> None:
        d, start, end = spans[:, np.lexsort(spans[::-1])]
        self.start, self.end = self._key(d, start), np.maximum.accumulate(self._key(d, end))

    def _key(self, d: np.ndarray, place: np.ndarray) -> np.ndarray:
        return (np.searchsorted(self.ids, d).astype(np.int64) << 32) + place

    def __call__(self, d: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the words from start to end of d lie within one of the stretches."""
        if not len(self.start):
            return np.zeros(len(d), bool)
        i = np.searchsorted(self.start, self._key(d, start), "right") - 1
        return (i >= 0) & (self.end[np.maximum(i, 0)] >= self._key(d, end))


def _wide(d: np.ndarray, p: np.ndarray, a: np.ndarray, q: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, place, key) of windows of MIN_WORDS whose seeds are all shared, but not in one run with one document.

    Their parts stand in smaller documents, the whole maybe in two others: as seeds of their own they meet there."""
    width = MIN_WORDS - SEED_WORDS
    if len(d) <= width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    breaks = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (q[1:] != q[:-1] + 1))])
    go = np.flatnonzero((d[width:] == d[:-width]) & (p[width:] - p[:-width] == width) & (breaks[width:] > breaks[:-width]))
    total = np.zeros(len(go), np.uint64)
    for k in range(0, width + 1, SEED_WORDS):
        total = K.mix(total * np.uint64(31) + key[go + k])
    return d[go], p[go], total >> np.uint64(16)


def _parts(d: np.ndarray, p: np.ndarray, a: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of parts: links of a document, in the order of places, to one source along both texts."""
    shift = np.diff(q - p)
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] != a[:-1]) | (np.abs(shift) > SLACK) | (np.diff(p) > NEAR)]) if len(d) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(d)))


def _joints(d: np.ndarray, p: np.ndarray, a: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, place, key) of links in parts next to a part of another source; the key is the link's place in its source
    and the other source.

    A passage whose parts stand in smaller documents has its links there, where none is long enough. Documents that have
    the same two parts side by side meet on these keys, however the words between and around them differ. A document's own
    places send none, so the source of a place grows from round to round, and the rounds come to an end."""
    starts, size = _parts(d, p, a, q)
    kept = np.repeat(size > 1, size)  # lone links are mostly chance, and must not cut a part in two
    d, p, a, q = d[kept], p[kept], a[kept], q[kept]
    starts, size = _parts(d, p, a, q)
    starts, size = starts[size >= JOINT], size[size >= JOINT]
    ends = starts + size - 1
    here, there = starts[:-1], starts[1:]
    meet = np.flatnonzero((d[here] == d[there]) & (a[here] != a[there]) & (p[there] - p[ends[:-1]] <= MAX_GAP) & (a[here] != d[here]) & (a[there] != d[here]))
    out = []
    for own, other, side in ((meet, meet + 1, 1), (meet + 1, meet, 2)):
        n = size[own]
        at = np.repeat(starts[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        near = p[at] >= np.repeat(p[ends[own]], n) - BESIDE if side == 1 else p[at] <= np.repeat(p[starts[own]], n) + BESIDE
        at, n = at[near], np.add.reduceat(near, np.cumsum(n) - n) if len(n) else n
        key = K.mix(a[at].astype(np.uint64) * np.uint64(4) + np.uint64(side))
        key = K.mix(key * np.uint64(31) + q[at].astype(np.uint64))
        out.append((d[at], p[at], K.mix(key * np.uint64(31) + np.repeat(a[starts[other]], n).astype(np.uint64)) >> np.uint64(16)))
    return tuple(np.concatenate(c) for c in zip(*out))


_MADE = f"{_SENT}, {_CHAINS.replace('pos binary, apos binary', 'cpos binary, capos binary')}"
_MADE_TYPES = pa.schema([*_SENT_TYPES, *((c, pa.int64()) for c in _CHAIN), ("cpos", pa.binary()), ("capos", pa.binary())])


def chained(linked: DataFrame, buckets: int, first: bool = True) -> DataFrame:
    """Side 2: chains of the links; side 3: links that are chains of their own, as compressed columns; sides 0 and 1: what
    joints of the links, and in the first round wide windows, send; side 4, in the first round: the places of all links, for
    `others`, with their keys.

    Where a chain settles a stretch of a document, further chains deep within it (MIN_WORDS from its ends) are left out:
    that stretch repeats an earlier document already. Nor do windows and joints within it ask for another source."""

    def run(t: pa.Table) -> pa.Table:
        cols = [t.column(c).to_pylist() for c in _LINKS]
        d = np.concatenate([np.cumsum(grow(x, "i8")) for x in cols[0]])
        p, a, q, key = (np.concatenate([grow(x, k) for x in c]) for c, k in zip(cols[1:], ("i4", "i8", "i4", "u8")))
        order = np.lexsort((q, a, p, d))
        d, p, a, q, key = d[order], p[order].astype(np.int64), a[order], q[order].astype(np.int64), key[order]
        place = np.ones(len(d), bool)
        place[1:] = (d[1:] != d[:-1]) | (p[1:] != p[:-1])
        one = place.copy()  # rows that repeat an id share its places; in later rounds a place can have several sources
        one[1:] |= ((a[1:] != a[:-1]) | (q[1:] != q[:-1])) & (not first)
        found, lone = _chain_rows(d[one], p[one], a[one], q[one])
        d, p, a, q, key = d[place], p[place], a[place], q[place], key[place]
        covered = _Covered(found, d)

        def inner(d: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
            return covered(d, np.maximum(start - MIN_WORDS, 0), end + SEED_WORDS + MIN_WORDS)

        ends = np.array([(c["d"], c["ds"], c["de"]) for c in found], np.int64).reshape(-1, 3).T
        rows = [{"side": 2, **{{"pos": "cpos", "apos": "capos"}.get(k, k): v for k, v in r.items()}} for r, i in zip(found, inner(*ends)) if not i]
        fresh = ~inner(lone[0], lone[1], lone[1])
        lone = tuple(x[fresh] for x in lone)
        if len(lone[0]):
            cols = (_delta(lone[0]), lone[1].astype(np.int32), lone[2], lone[3].astype(np.int32))
            rows.append({"bucket": t.column("bucket")[0].as_py(), "side": 3, **{c: shrink(x) for c, x in zip(_LINKS, cols)}})
        if first and len(d):
            rows.append({"bucket": t.column("bucket")[0].as_py(), "side": 4, **dict(zip(_LINKS, map(shrink, (_delta(d), p.astype(np.int32), key))))})
        more = [_joints(d, p, a, q)]
        asks = [~inner(more[0][0], more[0][1], more[0][1])]
        if first:
            more.append(_wide(d, p, a, q, key))
            asks.append(~covered(more[1][0], more[1][1], more[1][1] + MIN_WORDS))
        return _rows(rows + _sent(*(np.concatenate(c) for c in zip(*more)), buckets, np.concatenate(asks)), _MADE_TYPES)

    return linked.groupBy("bucket").applyInArrow(run, _MADE)


def _lcs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which entries of x a longest common subsequence with y takes."""
    n, m = len(x), len(y)
    hit = np.zeros(n, bool)
    if not n or not m:
        return hit
    same = x[:, None] == y[None, :]
    t = np.zeros((n + 1, m + 1), np.int32)
    for i in range(n):
        t[i + 1, 1:] = np.maximum.accumulate(np.maximum(t[i, 1:], t[i, :-1] + same[i]))
    i, j = n, m
    while i and j:
        if same[i - 1, j - 1] and t[i, j] == t[i - 1, j - 1] + 1:
            hit[i - 1] = True
            i, j = i - 1, j - 1
        elif t[i - 1, j] >= t[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return hit


def gaps(pos: np.ndarray, apos: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, start, end): the words of both texts between the seeds of a chain."""
    p, q, n = pos.tolist(), apos.tolist(), SEED_WORDS  # mostly one to three seeds
    return [(s + n, max(e, s + n), u + n, max(v, u + n)) for s, e, u, v in zip(p, p[1:], q, q[1:])]


def open_words(words: np.ndarray, side: int, pos: np.ndarray, apos: np.ndarray) -> np.ndarray | None:
    """The words of one text that the seeds of a chain leave open: before it, in its gaps, after it (up to REACH).

    None if the text does not hold the chain's places, as a row of the same id does that has another text."""
    own = (pos, apos)[side]
    if own[-1] + SEED_WORDS > len(words):
        return None
    n, end = min(int(pos[0]), int(apos[0]), REACH), int(own[-1]) + SEED_WORDS
    inner = [words[g[2 * side] : g[2 * side + 1]] for g in gaps(pos, apos)]
    return np.concatenate([words[own[0] - n : own[0]], *inner, words[end : end + REACH]])


def align(d: np.ndarray, a: np.ndarray, pos: np.ndarray, apos: np.ndarray) -> tuple[int, np.ndarray]:
    """First word and matching flags of a document's words around a chain: seeds match, gaps are aligned, ends extended; d
    and a are the open words of both texts."""
    n = min(int(pos[0]), int(apos[0]), REACH)
    left = d[:n] == a[:n]
    lo, hi = int(pos[0]), int(pos[-1]) + SEED_WORDS
    flags = np.ones(hi - lo, bool)
    i = j = n
    for s, e, u, v in gaps(pos, apos):
        x, y = d[i : i + e - s], a[j : j + v - u]
        i, j = i + e - s, j + v - u
        if e > s:
            flags[s - lo : e - lo] = True if len(x) == len(y) and (x == y).all() else _lcs(x, y)
    right = min(len(d) - i, len(a) - j)
    return lo - n, np.concatenate([left, flags, d[i : i + right] == a[j : j + right]])


def stretches(flags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, matches) of disjoint stretches of at least MIN_WORDS that agree in at least 80 %.

    Taken is the stretch of MIN_WORDS or more with the greatest sum of +1 for matches and -PENALTY for others (the longest of
    equals), as long as that is not negative, then those of what lies before and after it: no such stretch is left."""
    total = np.concatenate([[0], np.cumsum(np.where(flags, 1, -PENALTY))])
    out, todo = [], [(0, len(flags))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < MIN_WORDS:
            continue
        part = total[lo : hi + 1]
        gain = part[MIN_WORDS:] - np.minimum.accumulate(part[:-MIN_WORDS])
        if gain.max() < 0:
            continue
        e = len(gain) - 1 - int(gain[::-1].argmax())
        s, e = lo + int(part[: e + 1].argmin()), lo + e + MIN_WORDS
        out.append((s, e, int(flags[s:e].sum())))
        todo += [(lo, s), (e, hi)]
    return sorted(out)


def _all_stretches(total: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, end, matches) of the `stretches` between lo and hi of each row of running sums (+1 and -PENALTY)."""
    place, far, row, out = np.arange(total.shape[1]), 1 << 29, np.arange(len(total)), [np.zeros((4, 0), np.int64)]
    while len(row):
        mine = total[row]
        part = np.where((place >= lo[:, None]) & (place <= hi[:, None]), mine, far)
        gain = mine[:, MIN_WORDS:] - np.minimum.accumulate(part[:, :-MIN_WORDS], axis=1)
        gain[place[MIN_WORDS:] > hi[:, None]] = -far
        e = gain.shape[1] - 1 - gain[:, ::-1].argmax(axis=1)
        ok = np.flatnonzero(gain[np.arange(len(e)), e] >= 0)
        row, lo, hi, e = row[ok], lo[ok], hi[ok], e[ok]
        s, e = np.where(place <= e[:, None], part[ok], far).argmin(axis=1), e + MIN_WORDS
        out.append(np.stack([row, s, e, (total[row, e] - total[row, s] + PENALTY * (e - s)) // (PENALTY + 1)]))
        row, lo, hi = np.concatenate([row, row]), np.concatenate([lo, e]), np.concatenate([s, hi])
        more = hi - lo >= MIN_WORDS
        row, lo, hi = row[more], lo[more], hi[more]
    return tuple(np.concatenate(out, axis=1))


def settled_at_once(c: dict[str, np.ndarray], opened: np.ndarray, at: np.ndarray, words: np.ndarray, size: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Of chains (arrays of their ends, of the words after them, `tail`, and of where their open words start and end) whose
    sources start `at` places of `words` and have so many: (chain, first word, end, matches) of the stretches of those of one
    seed, and which of the others can have a stretch at all, as they have one if the words between their seeds agree."""
    n, most = np.minimum(np.minimum(c["ds"], c["as"]), REACH), c["de"] + SEED_WORDS - c["ds"]
    right = np.minimum(c["tail"], np.minimum(size - c["ae"] - SEED_WORDS, REACH))
    one, rest, out = c["ds"] == c["de"], most > REACH, [np.zeros((4, 0), np.int64)]
    todo = np.flatnonzero(~rest)
    todo = todo[np.argsort(most[todo], kind="stable")]
    for k in range(0, len(todo), 2048):
        i = todo[k : k + 2048]
        place = np.arange(2 * REACH + most[i[-1]])
        before, end, behind = place < REACH, (REACH + most[i] + right[i])[:, None], place - REACH - most[i, None]
        there = (place >= REACH - n[i, None]) & (place < end)
        mine = np.where(before, (c["start"] + n)[i, None] - REACH + place, (c["end"] - c["tail"])[i, None] + behind)
        other = np.where(before, (at + c["as"])[i, None] - REACH + place, (at + c["ae"])[i, None] + SEED_WORDS + behind)
        inner = ~before & (behind < 0)
        look = there & ~inner
        same = inner | (opened[np.where(look, mine, 0)] == words[np.where(look, other, 0)])
        total = np.zeros((len(i), len(place) + 1), np.int32)
        np.cumsum(np.where(same, 1, -PENALTY), axis=1, out=total[:, 1:])
        row, s, e, m = _all_stretches(total, REACH - n[i], end[:, 0])
        rest[i[row[~one[i[row]]]]] = True
        row, s, e, m = (x[one[i[row]]] for x in (row, s, e, m))
        shift = c["ds"][i[row]] - REACH
        out.append(np.stack([i[row], s + shift, e + shift, m]))
    return tuple(np.concatenate(out, axis=1)), np.flatnonzero(rest)


def sketched(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """(bucket, ids, sizes, codes): documents by bucket of their id with eight bits of each word, as compressed columns."""

    def run(batches):
        held, size = [], 0

        def flush():
            doc, n, code = (np.concatenate(c) for c in zip(*held))
            ends = np.cumsum(n)
            part = _bucket_of(doc, buckets)
            order = np.lexsort((doc, part))
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            for s, e in zip(cuts, np.append(cuts[1:], len(order))):
                o = order[s:e]
                mine = np.concatenate([code[ends[i] - n[i] : ends[i]] for i in o])
                cols = (shrink(_delta(doc[o])), shrink(n[o].astype(np.int32)), shrink(mine))
                yield pa.RecordBatch.from_arrays([pa.array([int(part[o[0]])], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)], names=["bucket", "ids", "sizes", "codes"])

        for b in batches:
            ids = b.column(0).to_numpy()
            for lo, hi, buf, offs in K.slices(b.column(1)):
                h, first = word_hashes(buf, offs)
                held.append((ids[lo:hi], np.diff(first), (h >> np.uint64(56)).astype(np.uint8)))
                size += len(buf)
                if size >= BLOCK_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    rows = docs.where(F.col("doc_id").isNotNull() & F.col(text).isNotNull()).select("doc_id", F.col(text).alias("t"))
    return rows.mapInArrow(run, "bucket int, ids binary, sizes binary, codes binary")


def _opened(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, sizes, starts, codes) of the documents of a bucket, by id; of rows that repeat an id the longest."""
    cols = [t.column(c).to_pylist() for c in ("ids", "sizes", "codes")]
    ids, sizes = np.concatenate([np.cumsum(grow(x, "i8")) for x in cols[0]]), [grow(x, "i4").astype(np.int64) for x in cols[1]]
    codes = [grow(x, "u1") for x in cols[2]]
    size = np.concatenate(sizes)
    start = np.cumsum(size) - size
    order = np.lexsort((start, -size, ids))
    order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
    beyond = np.zeros(REACH + SEED_WORDS, np.uint8)  # so that there are words around every place
    return ids[order], size[order], start[order] + REACH, np.concatenate([beyond[:REACH], *codes, beyond])


_SPAN = 2 * REACH + SEED_WORDS
#: Fewer bits of a word are others at each place around a seed, so that runs of one word do not agree by chance as a whole.
_SALT = (K.constants(91, _SPAN) >> np.uint64(40)).astype(np.uint8) | np.uint8(1)


def _around(at: tuple[np.ndarray, ...], doc: np.ndarray, pos: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """So many bits of each of REACH words before a seed, of the seed, and of REACH words after it, and which of them there are."""
    ids, size, start, codes = at
    i = np.minimum(np.searchsorted(ids, doc), len(ids) - 1)
    n = np.where(ids[i] == doc, size[i], 0)
    pos = np.minimum(pos, n)
    near = np.lib.stride_tricks.sliding_window_view(codes, _SPAN)[start[i] + pos - REACH]
    place = np.arange(_SPAN, dtype=np.int16)
    first, last = np.maximum(REACH - pos, 0).astype(np.int16), np.minimum(n - pos + REACH, _SPAN).astype(np.int16)
    return near if bits == 8 else (near * _SALT) >> np.uint8(8 - bits), (place >= first[:, None]) & (place < last[:, None])


def promising(links_alone: DataFrame, sketches: DataFrame, buckets: int, bits: int = 2) -> DataFrame:
    """The links that are chains of their own around which two bits a word (or eight) leave a passage possible, as chains.

    Most such links are phrases that texts share by chance; equal words have equal bits, so no passage is lost. A link
    carries 66 bytes (or 261) from its document to its source; buckets with many links are dealt out."""

    def of_document(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            at = _opened(right)
            cols = [left.column(c).to_pylist() for c in _LINKS[:4]]
            d = np.concatenate([np.cumsum(grow(x, "i8")) for x in cols[0]])
            p, a, q = (np.concatenate([grow(x, k) for x in c]).astype(np.int64) for c, k in zip(cols[1:], ("i4", "i8", "i4")))
            part = _bucket_of(a, buckets)
            order = np.lexsort((q, a, part))
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            for s, e in zip(cuts, np.append(cuts[1:], len(order))):
                o = order[s:e]
                code, there = _around(at, d[o], p[o], bits)
                if bits == 2:
                    code = np.pad(code, ((0, 0), (0, -_SPAN % 4))).reshape(len(o), -1, 4) @ np.array([1, 4, 16, 64], np.uint8)
                ends = there.sum(axis=1).astype(np.int32)  # with the place it tells where the text ends
                blobs = (shrink(d[o]), shrink(p[o].astype(np.int32)), shrink(_delta(a[o])), shrink(q[o].astype(np.int32)), shrink(ends), code.astype(np.uint8).tobytes())
                rows.append((int(part[o[0]]), left.column("bucket")[0].as_py(), len(o), *blobs))
        c = list(zip(*rows)) or [()] * 9
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 6]
        return pa.table({n: pa.array(v, k) for n, v, k in zip(("bucket", "of", "n", *_LINKS, "codes"), c, kinds)})

    sent = links_alone.groupBy("bucket").cogroup(sketches.groupBy("bucket")).applyInArrow(of_document, "bucket int, of int, n long, " + ", ".join(f"{c} binary" for c in (*_LINKS, "codes")))
    sent = materialize(sent, "links")
    counts = sent.groupBy("bucket").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0  # one number
    share = F.ceil(F.col("n") * buckets / F.lit(4 * max(total, 1))).cast("int")
    hot = materialize(counts.select("bucket", share.alias("salts")).where("salts > 1"), "hot")  # a quarter of the buckets at most

    def with_salts(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot) if small(hot, BROADCAST_IDS) else hot, "bucket", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))

    left = with_salts(sent).withColumn("salt", F.pmod(F.xxhash64("of"), F.col("salts")).cast("int")).drop("salts")
    right = with_salts(sketches).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")

    def of_source(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            at = _opened(right)
            for *blobs, codes in zip(*(left.column(c).to_pylist() for c in (*_LINKS, "codes"))):
                d, p, a, q, n = (grow(x, k).astype(np.int64) for x, k in zip(blobs, ("i8", "i4", "i8", "i4", "i4")))
                a = np.cumsum(a)
                raw = np.frombuffer(codes, np.uint8).reshape(len(d), -1)
                for lo in range(0, len(d), 4096):
                    i = slice(lo, lo + 4096)
                    mine = raw[i] if bits == 8 else ((raw[i, :, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3).reshape(len(d[i]), -1)[:, :_SPAN]
                    code, there = _around(at, a[i], q[i], bits)
                    first = np.maximum(REACH - p[i], 0)
                    place = np.arange(_SPAN)
                    there &= (place >= first[:, None]) & (place < (first + n[i])[:, None])
                    gain = np.where(code == mine, 1, -PENALTY)
                    gain[~there] = -_SPAN * PENALTY
                    total = np.zeros((len(gain), _SPAN + 1), np.int32)
                    np.cumsum(gain, axis=1, out=total[:, 1:])
                    least = np.minimum.accumulate(total[:, :-MIN_WORDS], axis=1)
                    for j in np.flatnonzero((total[:, MIN_WORDS:] >= least).any(axis=1)) + lo:
                        rows.append((int(d[j]), int(a[j]), int(p[j]), int(p[j]), int(q[j]), int(q[j]), shrink(p[j : j + 1].astype(np.int32)), shrink(q[j : j + 1].astype(np.int32))))
        c = list(zip(*rows)) or [()] * 8
        kinds = [pa.int64()] * 6 + [pa.binary()] * 2
        return pa.table({n: pa.array(v, k) for n, v, k in zip((*_CHAIN, "pos", "apos"), c, kinds)})

    out = materialize(left.groupBy("bucket", "salt").cogroup(right.groupBy("bucket", "salt")).applyInArrow(of_source, _CHAINS), "promising")
    discard(sent, hot)
    return out


#: Entries of a key that meet in one tile, and pairs looked at at once.
TILE, AT_ONCE = 1024, 1 << 16
_PLACE = np.dtype([("key", "u8"), ("d", "i8"), ("p", "i4"), ("before", "u4"), ("role", "u1")])
_ENTRY = np.dtype([*_PLACE.descr, ("room", "u1", 2), ("codes", "u1", 128)])
#: Bytes of entries for each word of all documents that are dealt out in one round, and what a round has at least.
ROUND_BYTES, LEAST_ROUND = 3, 16 << 20
#: Bits of the words beyond the first n, for each n up to REACH.
_BEYOND = np.packbits(np.arange(REACH) >= np.arange(REACH + 1)[:, None], axis=1)


def _asking(d: np.ndarray, p: np.ndarray, key: np.ndarray, asks: np.ndarray, buckets: int) -> list[dict]:
    """Side 4, by key: places of shared seeds, whether they ask for further partners, and 32 bits of the seed before (0: it is
    not shared, or doesn't ask while this one does)."""
    before = np.zeros(len(d), np.uint32)
    run = np.flatnonzero((d[1:] == d[:-1]) & (p[1:] == p[:-1] + 1) & (asks[:-1] | ~asks[1:]))
    before[run + 1] = (key[run] >> np.uint64(8)).astype(np.uint32) | np.uint32(1)
    order = np.lexsort((p, d, key))
    d, p, key, before, asks = d[order], p[order], key[order], before[order], asks[order]
    bucket = ((key >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(bucket, prepend=np.uint64(1 << 63)))
    rows = []
    for s, e in zip(cuts, np.append(cuts[1:], len(key))):
        cols = (d[s:e], (2 * p[s:e] + asks[s:e]).astype(np.int32), before[s:e], _delta(key[s:e]))
        rows.append({"bucket": int(bucket[s]), "side": 4, **{c: shrink(x) for c, x in zip(_LINKS[:4], cols)}})
    return rows


def _open(t: pa.Table, buckets: int) -> pa.Table:
    """What `_asking` sends of the shared places of documents (side 4), which ask unless they lie in a passage (side 5)."""
    side = t.column("side").to_numpy()
    cols = [[t.filter(pa.array(side == x)).column(c).to_pylist() for c in _LINKS[:3]] for x in (4, 5)]
    if not cols[0][0]:
        return _rows([], _SENT_TYPES)
    d = np.concatenate([np.cumsum(grow(x, "i8")) for x in cols[0][0]])
    p, key = (np.concatenate([grow(x, k) for x in c]) for c, k in zip(cols[0][1:], ("i4", "u8")))
    spans = [np.concatenate([np.zeros(0, k), *(grow(x, k) for x in c)]).astype(np.int64) for c, k in zip(cols[1], ("i8", "i4", "i8"))]
    order = np.lexsort((p, d))
    d, p, key = d[order], p[order].astype(np.int64), key[order]
    asks = ~_Covered.by_spans(d, *spans)(d, p, p + SEED_WORDS)
    return _rows(_asking(d, p, key, asks, buckets), _SENT_TYPES)


def _inner(key: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether places have their key's most frequent seed before (of runs of one word all but the first have): these do not
    meet each other. And the number of each place's key."""
    by = np.lexsort((before, key))
    k, b = key[by], before[by]
    fresh = np.concatenate([[True], k[1:] != k[:-1]])[: len(k)]
    starts = np.flatnonzero(fresh | np.concatenate([[True], b[1:] != b[:-1]])[: len(k)])
    size = np.diff(np.append(starts, len(k)))
    size[b[starts] == 0] = 0
    of_run = np.cumsum(fresh[starts]) - 1
    largest = np.lexsort((-size, of_run))[np.flatnonzero(fresh[starts])]
    often = np.zeros(len(starts), bool)
    often[largest] = size[largest] > 1
    inner, of = np.zeros(len(k), bool), np.zeros(len(k), np.int64)
    inner[by], of[by] = np.repeat(often, np.diff(np.append(starts, len(k)))), np.cumsum(fresh) - 1
    return inner, of


def _several(t: pa.Table, buckets: int) -> pa.Table:
    """Of side 4 the places of keys of three documents or more (two have met already), unless all have the same seed before:
    all meet on that one. Places tell who is `_inner`; the last column is the key's count of others and of these."""
    cols = [t.column(c).to_pylist() for c in _LINKS[:4]]
    d, p, before = (np.concatenate([grow(x, k) for x in c]) for c, k in zip(cols, ("i8", "i4", "u4")))
    key = np.concatenate([np.cumsum(grow(x, "u8"), dtype=np.uint64) for x in cols[3]])
    order = np.lexsort((p, d, key))
    d, p, key, before = d[order], p[order], key[order], before[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(starts, len(key)))
    other = np.concatenate([[True], (key[1:] != key[:-1]) | (d[1:] != d[:-1])])
    low = np.minimum.reduceat(before, starts)
    open_ = ((low == 0) | (low != np.maximum.reduceat(before, starts))) & (np.add.reduceat(p & 1, starts) > 0)
    last = np.maximum.reduceat(np.where(p & 1, d, -(1 << 62)), starts)
    open_ &= np.add.reduceat(other, starts) > 2
    kept = np.repeat(open_, n) & ((p & 1).astype(bool) | (d < np.repeat(last, n)))  # sources behind all that ask meet none
    d, p, key, before = d[kept], p[kept], key[kept], before[kept]
    inner, of = _inner(key, before)
    n = np.bincount(2 * of + inner).astype(np.int64) if len(of) else np.zeros(0, np.int64)
    n = np.append(n, np.zeros(len(n) % 2, np.int64)).reshape(-1, 2)[of]
    n, p = n[:, 0] << 32 | n[:, 1], 2 * p + inner
    part = _bucket_of(d, buckets)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    rows = []
    for s, e in zip(cuts, np.append(cuts[1:], len(order))):
        o = order[s:e]
        cols = (d[o], p[o].astype(np.int32), before[o], _delta(key[o]), n[o])
        rows.append({"bucket": int(part[o[0]]), "side": 4, **{c: shrink(x) for c, x in zip(_LINKS, cols)}})
    return _rows(rows, _SENT_TYPES)


def _spans(found: DataFrame, buckets: int) -> DataFrame:
    """Side 5, by document: the stretches of passages."""

    def run(b: pa.RecordBatch):
        d, start, end = (b.column(i).to_numpy() for i in range(3))
        part = _bucket_of(d, buckets)
        order = np.argsort(part, kind="stable")
        cuts, rows = np.flatnonzero(np.diff(part[order], prepend=-1)), []
        for s, e in zip(cuts, np.append(cuts[1:], len(order))):
            o = order[s:e]
            cols = (d[o], start[o].astype(np.int32), end[o])
            rows.append({"bucket": int(part[o[0]]), "side": 5, **{c: shrink(x) for c, x in zip(_LINKS[:3], cols)}})
        yield from _rows(rows, _SENT_TYPES).to_batches()

    return map_batches(found.select("doc_id", "start_word", "end_word"), run, _SENT)


def _planes(code: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words (up to REACH) there are before each place and after its seed, and 128 bytes: each of four bits of these
    words, those before it with the nearest first, then those after it."""
    before, after = slice(REACH - 1, None, -1), slice(REACH + SEED_WORDS, None)  # of the words in order
    sides = np.concatenate([code[:, before], code[:, after]], axis=1)
    room = np.stack([there[:, before].sum(axis=1), there[:, after].sum(axis=1)], axis=1)
    return room, np.concatenate([np.packbits(sides >> np.uint8(b) & np.uint8(1), axis=1) for b in range(4)], axis=1)


def _differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which words differ in any of their four bits."""
    z = (x ^ y).reshape(len(x), 4, x.shape[1] // 4)
    return z[:, 0] | z[:, 1] | z[:, 2] | z[:, 3]


def _may_repeat(x: np.ndarray, y: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Whether MIN_WORDS or more words around a common seed can agree in 80 %, by the codes of both places and the words
    both have: counted in eights, with the best of what is cut. Equal words have equal codes, so no such place is lost."""
    differ = _differ(x, y) | _BEYOND[room].reshape(-1, 32)
    count = np.ascontiguousarray(np.bitwise_count(differ).T).astype(np.int16)
    lost = np.zeros((2, REACH // 8 + 1, len(x)), np.int16)  # PENALTY + 1 for each word that differs, less 1 for each word
    for side in (0, 1):
        for k in range(REACH // 8):
            lost[side, k + 1] = lost[side, k] + (PENALTY + 1) * count[side * REACH // 8 + k] - 8
    right = lost[1]
    for k in range(REACH // 8 - 1, -1, -1):
        np.minimum(right[k], right[k + 1], out=right[k])
    least = (MIN_WORDS - SEED_WORDS - 14 + 7) // 8  # eights that lie within MIN_WORDS around a seed
    best = lost[0, 0] + right[least]
    for k in range(1, REACH // 8 + 1):
        np.minimum(best, lost[0, k] + right[max(least - k, 0)], out=best)
    return best <= SEED_WORDS + 14


def _gain(x: np.ndarray, y: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The greatest sum of +1 for each word that agrees and -PENALTY for others, of MIN_WORDS or more around a common seed, and
    how many words before the seed and behind it the stretches with that sum have at most."""
    beyond = np.arange(REACH) >= room[:, :, None]
    gain = np.where(np.unpackbits(_differ(x, y), axis=1).reshape(len(x), 2, REACH), np.int16(-PENALTY), np.int16(1))
    gain[beyond] = -2 * MIN_WORDS
    total = np.zeros((len(x), 2, REACH + 1), np.int16)
    np.cumsum(gain, axis=2, out=total[:, :, 1:])
    need = np.maximum(MIN_WORDS - SEED_WORDS - np.arange(REACH + 1), 0)  # words on the other side
    both = total + np.maximum.accumulate(total[:, ::-1, ::-1], axis=2)[:, :, ::-1][:, :, need]
    best = both[:, 0].max(axis=1)
    before, after = (REACH - both[:, side, ::-1].argmax(axis=1) for side in (0, 1))
    return SEED_WORDS + best, before, after


def _may_start(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether a stretch of less than 2 * MIN_WORDS that agrees in 80 % can have its first seed here, by the next 64 words on
    both sides. Before its first seed at most four words in a row agree, after one that differs, so these words gain nothing:
    either what follows pays for all, or much of what precedes (22 words at least) agrees too."""
    differ = _differ(x, y)
    ok = np.zeros(len(x), bool)
    for side, allow in ((0, 28), (1, SEED_WORDS)):  # with less than 24 words after the seed these are worth 28 with it
        w = np.ascontiguousarray(differ[:, side])
        steps = (*((22,) if side == 0 else ()), 24, 26, 28, 30, 32, 36, 40, 44, 48, 56, 64, 2 * MIN_WORDS)
        for n, most in zip(steps, steps[1:]):  # so many words that the stretch has on this side
            ok |= np.bitwise_count(w & np.uint64((1 << n) - 1)) <= (most - 1 + allow) // (PENALTY + 1)
    return ok


def _ranges(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order of the entries, and places in it: entries that ask and the ranges of those they may meet, of smaller
    documents with their key. Those that are `_inner` (role 4) meet others only, and so do others in a tile of both (role 8)."""
    ask, source, inner, cross = (e["role"] & x > 0 for x in np.array([1, 2, 4, 8], np.uint8))
    kind = np.where(source, inner, 2)
    key, doc = np.unique(e["key"], return_inverse=True)[1], np.unique(e["d"], return_inverse=True)[1]
    order = np.lexsort((e["p"], doc, kind, key))
    docs = doc.max(initial=0) + 1
    at = ((key * 3 + kind) * docs + doc)[order]
    out = []
    for k, who in ((0, ask & (inner | ~cross)), (1, ask & ~inner)):
        i = np.flatnonzero(who[order])
        first = (key[order[i]] * 3 + k) * docs
        out.append((i, np.searchsorted(at, first), np.searchsorted(at, first + doc[order[i]])))
    i, lo, hi = (np.concatenate(c) for c in zip(*out))
    some = np.flatnonzero(hi > lo)
    some = some[np.argsort(i[some], kind="stable")]
    return order, i[some], lo[some], hi[some]


def _meet(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of entries of one key (document that asks, smaller document) that differ in the seed before, as others meet on
    that one, and that may repeat, with their `_gain` in one number: the sum and twice 16 bits of words."""
    order, asking, first, last = _ranges(e)
    before, codes, room = (np.ascontiguousarray(e[c][order]) for c in ("before", "codes", "room"))
    near = np.ascontiguousarray(codes.view(np.uint64)[:, ::2])  # the nearest 64 words of both sides
    ends = np.cumsum(last - first)
    out, lo = [], 0
    while lo < len(asking):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + AT_ONCE, "right")))
        n = last[lo:hi] - first[lo:hi]
        i = np.repeat(asking[lo:hi], n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n - first[lo:hi], n)
        go = np.flatnonzero(_may_start(near[i], near[j]))
        i, j = i[go], j[go]
        go = (before[i] != before[j]) | (before[i] == 0)
        i, j = i[go], j[go]
        go = _may_repeat(codes[i], codes[j], np.minimum(room[i], room[j]))
        i, j = i[go], j[go]
        gain, left, right = _gain(codes[i], codes[j], np.minimum(room[i], room[j]))
        go = gain >= 0
        out.append((order[i[go]], order[j[go]], (gain.astype(np.int64) << 32 | left << 16 | right)[go]))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.zeros(0, int) for _ in range(3))


def _dealt(e: np.ndarray, others: np.ndarray, inner: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Where entries go, and the entries: those of a key to one place, or in tiles of which each holds TILE entries of both sides.
    `_inner` ones (so many, apart from the others) go once to each tile of the others, these to tiles of both and of their own."""
    few = others + inner <= TILE
    deal = [((e["key"] >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)[few]]
    sent = [e[few]]

    def go(at: np.ndarray, row: np.ndarray, column: np.ndarray, kind: int, keep: int, add: int) -> None:
        of = K.mix(e["key"][at] * np.uint64(4) + np.uint64(kind)) + row.astype(np.uint64) * np.uint64(1 << 20) + column.astype(np.uint64)
        deal.append(-1 - (K.mix(of) >> np.uint64(2)).astype(np.int64))
        f = e[at]
        f["role"] = f["role"] & keep | add
        ok = f["role"] & 3 > 0
        deal[-1] = deal[-1][ok]
        sent.append(f[ok])

    tiles = [np.maximum(-(-n // TILE), 1) for n in (others, inner)]
    is_inner = e["role"] & 4 > 0
    mine = (K.mix(e["d"].astype(np.uint64) + e["p"].astype(np.uint64) * np.uint64(1 << 40)) % np.where(is_inner, tiles[1], tiles[0]).astype(np.uint64)).astype(np.int64)
    each = lambda at, n: (np.repeat(at, n[at]), np.arange(n[at].sum()) - np.repeat(np.cumsum(n[at]) - n[at], n[at]))
    at, t = each(np.flatnonzero(~few & is_inner), tiles[0])
    go(at, t, mine[at], 0, 7, 8)
    at, t = each(np.flatnonzero(~few & ~is_inner & (inner > 0)), tiles[1])
    go(at, mine[at], t, 0, 7, 8)
    one = np.flatnonzero(~few & ~is_inner & (tiles[0] == 1))
    go(one, mine[one], mine[one], 1, 3, 0)
    at, t = each(np.flatnonzero(~few & ~is_inner & (tiles[0] > 1)), tiles[0])
    go(at, mine[at], t, 1, 1, 0)
    go(at, t, mine[at], 1, 2, 0)
    return np.concatenate(deal), np.concatenate(sent)


def _copies(role: np.ndarray, others: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """How many copies of places `_dealt` gives, at most: one, or one for each tile that a place of a large key goes to."""
    tiles = [np.maximum(-(-n // TILE), 1) for n in (others, inner)]
    own = np.where(tiles[0] == 1, 1, 2 * tiles[0])
    return np.where(others + inner <= TILE, 1, np.where(role & 4 > 0, tiles[0], own + np.where(inner > 0, tiles[1], 0)))


def _volume(b: pa.RecordBatch) -> pa.RecordBatch:
    """Bytes of the entries that are dealt out of rows of `_several`."""
    total = 0
    for p, n in zip(b.column(1).to_pylist(), b.column(4).to_pylist()):
        p, n = grow(p, "i4"), grow(n, "i8")
        total += int(_copies(4 * (p & 1), n >> 32, n & 0xFFFFFFFF).sum()) * _ENTRY.itemsize
    return pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], names=["n"])


def _n_words(b: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([sum(int(grow(x, "i4").sum()) for x in b.column(0).to_pylist())], pa.int64())], names=["n"])


def others(places: DataFrame, settled: DataFrame, sketches: DataFrame, buckets: int) -> DataFrame:
    """Of the places that lie in no passage so far (`settled`) and all smaller documents that have their seeds, where four bits
    a word leave a passage possible: chains (side 2 of `chained`) of those pairs of each place that have the greatest sum and
    reach farthest to both sides by these bits, and all other pairs (side 3).

    Keys of more than TILE places are dealt out in pairs of tiles, so no task holds more; pairs are looked at in tasks and
    only those that may repeat leave them. Their number grows with the square of a key's open places, and what is dealt out with
    it: tiles meet in as many rounds as it takes to have no more than ROUND_BYTES a word of the documents on disk at once."""
    asked = places.unionAll(_spans(settled, buckets)).groupBy("bucket").applyInArrow(lambda t: _open(t, buckets), _SENT)
    left = materialize(asked.groupBy("bucket").applyInArrow(lambda t: _several(t, buckets), _SENT), "asked")
    volume, words = (map_batches(df.select(*columns), f, "n long").agg(F.sum("n")).first()[0] or 0 for df, columns, f in ((left, _LINKS, _volume), (sketches, ("sizes",), _n_words)))  # two numbers
    rounds = max(1, -(-volume // max(ROUND_BYTES * words, LEAST_ROUND)))

    def of_document(left: pa.Table, right: pa.Table, turn: int) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            cols = [left.column(c).to_pylist() for c in _LINKS]
            key = np.concatenate([np.cumsum(grow(x, "u8"), dtype=np.uint64) for x in cols[3]])
            d, p, before, n = (np.concatenate([grow(x, k) for x in cols[c]]) for c, k in ((0, "i8"), (1, "i4"), (2, "u4"), (4, "i8")))
            order = np.lexsort((p, d, key))  # places next to each other have much in common, and so are small together
            e = np.zeros(len(d), _PLACE)
            e["key"], e["d"], e["p"], e["before"], e["role"] = key[order], d[order], p[order] >> 2, before[order], (2 + (p >> 1 & 1) + 4 * (p & 1))[order]
            deal, sent = _dealt(e, n[order] >> 32, n[order] & 0xFFFFFFFF, buckets)
            mine = K.mix(deal.astype(np.uint64)) % np.uint64(rounds) == turn
            deal, sent = deal[mine], sent[mine]
            f = np.zeros(len(sent), _ENTRY)
            for c in _PLACE.names:
                f[c] = sent[c]
            at = _opened(right)
            same, of = np.unique(sent[["d", "p"]], return_inverse=True)
            room, codes = np.zeros((len(same), 2), np.uint8), np.zeros((len(same), 128), np.uint8)
            for lo in range(0, len(same), 4096):
                i = slice(lo, lo + 4096)
                room[i], codes[i] = _planes(*_around(at, same["d"][i], same["p"][i].astype(np.int64), 4))
            f["room"], f["codes"] = room[of], codes[of]
            order = np.argsort(deal, kind="stable")
            cuts = np.flatnonzero(np.diff(deal[order], prepend=deal[order[:1]] - 1))
            rows += [(int(deal[order[s]]), shrink(f[order[s:g]])) for s, g in zip(cuts, np.append(cuts[1:], len(deal)))]
        return pa.table({"deal": pa.array([r[0] for r in rows], pa.int64()), "entries": pa.array([r[1] for r in rows], pa.binary())})

    def meet(t: pa.Table) -> pa.Table:
        e = np.concatenate([grow(x, _ENTRY) for x in t.column("entries").to_pylist()])
        i, j, gain = _meet(e)
        d, p = e["d"], e["p"]
        return _rows(_link_rows(d[i], p[i], d[j], p[j], gain.astype(np.uint64), buckets), _SENT_TYPES)

    def run(t: pa.Table) -> pa.Table:
        d, p, a, q, gain = _columns(t)
        best = np.zeros(len(d), bool)
        for first in (gain, gain >> 16 & 0xFFFF, gain & 0xFFFF):  # by document and place already
            order = np.lexsort((q, a, -gain, -first, p, d))
            best[order[np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1])])]] = True
        found, lone = _chain_rows(d[best], p[best], a[best], q[best])
        names = {"pos": "cpos", "apos": "capos"}
        rows = [{"side": 2, **{names.get(k, k): v for k, v in r.items()}} for r in found]
        for x in np.stack(lone, axis=1):
            ends = {c: int(v) for c, v in zip(_CHAIN, (x[0], x[2], x[1], x[1], x[3], x[3]))}
            rows.append({"side": 2, **ends, "cpos": shrink(x[1:2].astype(np.int32)), "capos": shrink(x[3:4].astype(np.int32))})
        return _rows(rows + _alone(t, *(x[~best] for x in (d, p, a, q, gain))), _MADE_TYPES)

    met = []
    for turn in range(rounds):
        dealt = left.groupBy("bucket").cogroup(sketches.groupBy("bucket")).applyInArrow(partial(of_document, turn=turn), "deal long, entries binary")
        met.append(materialize(dealt.groupBy("deal").applyInArrow(meet, _SENT), "met"))
    out = materialize(reduce(DataFrame.unionAll, met).groupBy("bucket").applyInArrow(run, _MADE), "others")
    discard(left, *met)
    return out


def _columns(t: pa.Table) -> tuple[np.ndarray, ...]:
    """The columns of links, each without its repetitions."""
    cols = [t.column(c).to_pylist() for c in _LINKS]
    d = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(grow(x, "i8")) for x in cols[0])])
    more = (np.concatenate([np.zeros(0, np.int64), *(grow(x, k).astype(np.int64) for x in c)]) for c, k in zip(cols[1:], ("i4", "i8", "i4", "u8")))
    return tuple(np.unique(np.stack([d, *more]), axis=1))


def _alone(t: pa.Table, d: np.ndarray, p: np.ndarray, a: np.ndarray, q: np.ndarray, key: np.ndarray) -> list[dict]:
    """Side 3: links as compressed columns."""
    cols = (_delta(d), p.astype(np.int32), a, q.astype(np.int32), key.astype(np.uint64))
    return [{"bucket": t.column("bucket")[0].as_py(), "side": 3, **{c: shrink(x) for c, x in zip(_LINKS, cols)}}] if len(d) else []


def unsettled(pairs: DataFrame, settled: DataFrame, buckets: int) -> DataFrame:
    """The links of `pairs` (side 3) but those whose stretch of the greatest sum (`_gain`) lies in passages already: words that
    truly agree agree by their bits too, so there's no longer one to find around their seed."""

    def run(t: pa.Table) -> pa.Table:
        side = t.column("side").to_numpy()
        d, p, a, q, gain = _columns(t.filter(pa.array(side == 3)))
        cols = [t.filter(pa.array(side == 5)).column(c).to_pylist() for c in _LINKS[:3]]
        spans = [np.concatenate([np.zeros(0, k), *(grow(x, k) for x in c)]).astype(np.int64) for c, k in zip(cols, ("i8", "i4", "i8"))]
        go = ~_Covered.by_spans(d, *spans)(d, p - (gain >> 16 & 0xFFFF), p + SEED_WORDS + (gain & 0xFFFF))
        return _rows(_alone(t, *(x[go] for x in (d, p, a, q, gain))), _SENT_TYPES)

    return pairs.unionAll(_spans(settled, buckets)).groupBy("bucket").applyInArrow(run, _SENT)


def together(links_alone: DataFrame, buckets: int) -> DataFrame:
    """Chains of two or more of the links."""

    def run(t: pa.Table) -> pa.Table:
        links = np.unique(np.stack([t.column(c).to_numpy() for c in ("d", "ds", "a", "as")]), axis=1)
        rows = _chain_rows(*links)[0]
        kinds = [pa.int64()] * 6 + [pa.binary()] * 2
        return pa.table({c: pa.array([r[c] for r in rows], k) for c, k in zip((*_CHAIN, "pos", "apos"), kinds)})

    return links_alone.groupBy(F.pmod(F.xxhash64("d"), F.lit(buckets))).applyInArrow(run, _CHAINS)


def _words_of(docs: DataFrame, ids: DataFrame, text: str) -> DataFrame:
    """doc_id, words (32 bits each) of the documents of ids, and the further columns of ids."""
    extra = [c for c in ids.columns if c != "doc_id"]
    rows = docs.select("doc_id", F.col(text).alias("t")).join(F.broadcast(ids) if small(ids, BROADCAST_IDS) else ids, "doc_id")

    def run(b: pa.RecordBatch):
        for lo, hi, buf, offs in K.slices(b.column(1)):
            h, first = word_hashes(buf, offs)
            h = (h >> np.uint64(32)).astype(np.uint32)
            blobs = pa.array([h[s:e].tobytes() for s, e in zip(first[:-1], first[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), blobs, *(c.slice(lo, hi - lo) for c in b.columns[2:])], names=["doc_id", "words", *extra])

    return map_batches(rows.select("doc_id", "t", *extra), run, ", ".join(["doc_id long, words binary", *(f"{c} int" for c in extra)]))


def _held(t: pa.Table) -> dict[int, np.ndarray]:
    """The words of each document; of rows that repeat an id the longest's."""
    out: dict[int, bytes] = {}
    for i, w in zip(t.column("doc_id").to_pylist(), t.column("words").to_pylist()):
        if i not in out or (len(w), w) > (len(out[i]), out[i]):
            out[i] = w
    return {i: np.frombuffer(w, np.uint32) for i, w in out.items()}


def _aligned(docs: DataFrame, found: DataFrame, text: str, parts: int) -> DataFrame:
    """Passages of the chains. The open words are taken from the document first, then from the source; the chains of a
    source of many are dealt out, and its words with them."""

    def of_document(left: pa.Table, right: pa.Table) -> pa.Table:
        words, out, tail = _held(right), [], []
        for d, p, q in zip(*(left.column(c).to_pylist() for c in ("d", "pos", "apos"))):
            p, q = grow(p, "i4"), grow(q, "i4")
            w = open_words(words[d], 0, p, q) if d in words else None
            out.append(w.tobytes() if w is not None else None)
            tail.append(min(len(words[d]) - int(p[-1]) - SEED_WORDS, REACH) if w is not None else 0)
        more = left.select([*_CHAIN, "pos", "apos"]).append_column("open", pa.array(out, pa.binary())).append_column("tail", pa.array(tail, pa.int64()))
        return more.filter(pa.array([w is not None for w in out], pa.bool_()))

    part = lambda c, *more: F.pmod(F.xxhash64(F.col(c), *more), F.lit(parts))
    of = found.select(*_CHAIN, "pos", "apos", part("d").alias("part"))
    texts = _words_of(docs, found.select(F.col("d").alias("doc_id")).distinct(), text).withColumn("part", part("doc_id"))
    half = of.groupBy("part").cogroup(texts.groupBy("part")).applyInArrow(of_document, f"{_CHAINS}, open binary, tail long")

    counts = materialize(found.groupBy("a").agg(F.count("*").alias("n")), "sources")
    total = counts.agg(F.sum("n")).first()[0] or 0  # one number
    hot = counts.where(F.col("n") * HOT_SHARE > F.lit(total)).select(F.col("a").alias("hot"), F.ceil(F.col("n") * HOT_SHARE / F.lit(max(total, 1))).cast("int").alias("salts"))
    half = half.join(F.broadcast(hot), half["a"] == hot["hot"], "left")
    half = half.withColumn("part", part("a", F.pmod(F.xxhash64("d", "pos"), F.coalesce("salts", F.lit(1))).cast("int"))).drop("hot", "salts")
    ids = counts.join(F.broadcast(hot), counts["a"] == hot["hot"], "left").select(F.col("a").alias("doc_id"), F.coalesce("salts", F.lit(1)).alias("salts"))
    sources = _words_of(docs, ids, text).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    sources = sources.select("doc_id", "words", part("doc_id", F.col("salt").cast("int")).alias("part"))

    def of_source(left: pa.Table, right: pa.Table) -> pa.Table:
        words, kinds = _held(right), ("doc_id", "source_id", "start_word", "end_word", "n_words", "n_matched")
        if not left.num_rows or not words:
            return pa.table({k: pa.array([], pa.int64()) for k in kinds})
        ids = np.array(sorted(words), np.int64)
        size = np.array([len(words[i]) for i in ids.tolist()], np.int64)
        of = np.minimum(np.searchsorted(ids, left.column("a").to_numpy()), len(ids) - 1)
        # a row of the same id that has another text may not hold the chain's places
        left = left.filter(pa.array((ids[of] == left.column("a").to_numpy()) & (left.column("ae").to_numpy() + SEED_WORDS <= size[of])))
        c = {k: left.column(k).to_numpy() for k in (*_CHAIN, "tail")}
        of, opened, ends = np.searchsorted(ids, c["a"]), left.column("open").to_pylist(), np.cumsum(size)
        c["end"] = np.cumsum([len(w) // 4 for w in opened], dtype=np.int64)
        c["start"] = np.concatenate([np.zeros(1, np.int64), c["end"][:-1]])[: len(opened)]
        none = np.zeros(1, np.uint32).tobytes()  # for places that are not there
        flat = np.concatenate([words[i] for i in ids.tolist()] + [np.zeros(1, np.uint32)])
        (i, s, e, m), rest = settled_at_once(c, np.frombuffer(b"".join(opened) + none, np.uint32), (ends - size)[of], flat, size[of])
        out = [np.stack([c["d"][i], c["a"][i], s, e, e - s, m])]
        pos, apos = (left.column(k).take(pa.array(rest)).to_pylist() for k in ("pos", "apos"))
        for k, p, q in zip(rest.tolist(), pos, apos):
            d, a, p, q = int(c["d"][k]), int(c["a"][k]), grow(p, "i4"), grow(q, "i4")
            first, flags = align(np.frombuffer(opened[k], np.uint32), open_words(words[a], 1, p, q), p, q)
            out.append(np.array([(d, a, first + s, first + e, e - s, m) for s, e, m in stretches(flags)], np.int64).reshape(-1, 6).T)
        return pa.table(dict(zip(kinds, map(pa.array, np.unique(np.concatenate(out, axis=1), axis=1)))))

    result = "doc_id long, source_id long, start_word long, end_word long, n_words long, n_matched long"
    return half.groupBy("part").cogroup(sources.groupBy("part")).applyInArrow(of_source, result).distinct()


def passages(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source_id, start_word, end_word, n_words, n_matched: stretches of a document that repeat an earlier one.

    Words are numbered from 0 in the document, ends exclusive. Null or empty texts and rows without id have none; texts of
    any length are taken whole; rows that repeat an id count as one document for seeds and are aligned on the longest of
    them; an empty table gives an empty result; further columns are not looked at."""
    buckets = max(16, 4 * docs.rdd.getNumPartitions())
    rounds = [materialize(chained(links(send(docs, text, buckets), buckets), buckets), "chains")]
    sketches = materialize(sketched(docs, text, buckets), "sketches")
    while (sent := rounds[-1].where("side < 2").select("bucket", "side", *_LINKS)).take(1):
        rounds.append(materialize(chained(links(sent, buckets), buckets, first=False), "chains"))
    made = reduce(DataFrame.unionAll, rounds)
    found = made.where("side = 2").select(*_CHAIN, F.col("cpos").alias("pos"), F.col("capos").alias("apos"))
    alone = promising(made.where("side = 3").select("bucket", *_LINKS), sketches, buckets)
    out = materialize(_aligned(docs, found.unionAll(alone), text, buckets), "passages")
    discard(*rounds[1:], alone)
    rest = others(rounds[0].where("side = 4").select("bucket", "side", *_LINKS), out, sketches, buckets)
    discard(rounds[0])
    best = rest.where("side = 2").select(*_CHAIN, F.col("cpos").alias("pos"), F.col("capos").alias("apos"))
    more = materialize(_aligned(docs, best, text, buckets), "more")
    still = promising(unsettled(rest.where("side = 3").select("bucket", "side", *_LINKS), out.unionAll(more), buckets), sketches, buckets, bits=8)
    last = materialize(_aligned(docs, still.unionAll(together(best.where("ds = de").unionAll(still), buckets)), text, buckets), "last")
    discard(rest, sketches, still)
    return out.unionAll(more).unionAll(last).distinct()


def remove(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs without the words of their passages; rows left without any word that had some are dropped."""
    spans = found.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start_word", "end_word"))).alias("__spans"))  # of one document
    joined = docs.join(F.broadcast(spans) if small(spans, BROADCAST_IDS // 10) else spans, "doc_id", "left")

    def cut(t: str, spans: list) -> str | None:
        raw = t.encode()
        s, e, _ = K.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        keep = np.ones(len(s), bool)
        for x in spans:
            keep[x["start_word"] : x["end_word"]] = False
        if not keep.any():
            return None
        gone, out, at = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).astype(np.int8))), [], 0
        for lo, hi in zip(gone[::2], gone[1::2]):
            out.append(raw[at : s[lo]])
            at = s[hi] if hi < len(s) else len(raw)
        return b"".join([*out, raw[at:]]).decode()

    names = docs.columns

    def run(b: pa.RecordBatch):
        spans, t = b.column(len(names)).to_pylist(), b.column(names.index(text)).to_pylist()
        new = [cut(x, s) if s and x is not None else x for x, s in zip(t, spans)]
        keep = pa.array([n is not None or not s for n, s in zip(new, spans)], pa.bool_())
        cols = [pa.array(new, pa.string()) if c == text else b.column(i) for i, c in enumerate(names)]
        yield pa.RecordBatch.from_arrays(cols, names=names).filter(keep)

    return map_batches(joined.select(*names, "__spans"), run, docs.schema)
