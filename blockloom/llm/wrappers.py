"""Main text of web pages by wrapper induction.

Pages of a host are read into folded block trees (`dom`). The most frequent tree of a host is its reference; every
distinct tree is aligned with it by simple tree matching, which gives each block a slot of the host's wrapper. A text that
most pages of a host have in the same slot is constant: it belongs to the template. Slots that vary are content, unless the
block stands in a part that its tag or name sets aside (menus, forms, comments and so on).

Only trees, slots and hashes of blocks are shuffled. A constant must be on pages whose longest blocks differ, so copies of
one article make no template; hosts of fewer than MIN_PAGES pages have names and tags only."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dom
from .spark_io import discard, map_batches, materialize

#: Pages that a slot must be on, and different longest blocks among the pages that have a constant.
MIN_PAGES = 5
MIN_DISTINCT = 4
#: Keys with more than one in so many pages (at most so many of them) are joined by broadcast, all others by a shuffle.
HOT_SHARE = 1000

_HOST = re.compile(r"\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    """The host of an address in lower case; empty if it has none."""
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _blocks(page: dom.Page) -> list[tuple[int, str]]:
    """(line of the skeleton, text) of the blocks that may be main text: those of articles if there are any, else of main
    parts, else all that are not set aside and not mostly links."""
    for area in (2, 1):
        found = [(page.slots[v], t) for v, t, a, _ in page.blocks if a == area]
        if found:
            return found
    return [(page.slots[v], t) for v, t, a, linked in page.blocks if a >= 0 and linked < dom.LINKED * len(t)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_TREES = "host string, shape long, skeleton string, mark long, lines array<int>, hashes array<long>"
_TEXTS = "page_id {}, url string, host string, shape long, lines array<int>, hashes array<long>, texts array<string>"


def _trees(pages: DataFrame) -> DataFrame:
    """Per page: host, tree, a bit that stands for its longest block, and hashes of its blocks by line (each once)."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            page = dom.Page(html)
            blocks = _blocks(page)
            longest = max((t for _, t in blocks), key=lambda t: (len(t), t), default="")
            each = sorted({(i, dom.text_hash(t)) for i, t in blocks})
            rows.append((host_of(url), dom.text_hash(page.skeleton), page.skeleton, _signed(1 << (dom.text_hash(longest) & 63)), [i for i, _ in each], [h for _, h in each]))
        cols = list(zip(*rows)) if rows else [[]] * 6
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["host", "shape", "skeleton", "mark", "lines", "hashes"])

    return map_batches(pages.where("html is not null").select("url", "html"), run, _TREES)


def _texts(pages: DataFrame) -> DataFrame:
    kind = pages.schema["page_id"].dataType

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for url, html in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            if html is None:
                rows.append((None, None, [], [], []))
                continue
            page = dom.Page(html)
            blocks = _blocks(page)
            rows.append((host_of(url), dom.text_hash(page.skeleton), [i for i, _ in blocks], [dom.text_hash(t) for _, t in blocks], [t for _, t in blocks]))
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["page_id", "url", "host", "shape", "lines", "hashes", "texts"])

    return map_batches(pages.select("page_id", "url", "html"), run, _TEXTS.format(kind.simpleString()))


def _lookup(rows: DataFrame, found: DataFrame, keys: list[str], total: int, how: str) -> DataFrame:
    """rows joined with found (one row a key, `n` pages each): rows of frequent keys stay where they are (at most HOT_SHARE
    keys, so they can be broadcast), others are shuffled, if there are any."""
    hot = F.col("n") * HOT_SHARE > total
    often = found.where(hot).select(*keys, F.struct(*[c for c in found.columns if c not in (*keys, "n")]).alias("__hot"))
    rest = found.where(~hot).select(*keys, F.struct(*[c for c in found.columns if c not in (*keys, "n")]).alias("__found"))
    if not rest.take(1):
        return rows.join(F.broadcast(often), keys, how).withColumnRenamed("__hot", "__found")
    told = materialize(rows, "looked-up").join(F.broadcast(often), keys, "left")
    near = told.where("__hot is not null").withColumnRenamed("__hot", "__found")
    far = told.where("__hot is null").drop("__hot").join(rest, keys, how)
    return near.unionByName(far)


@lru_cache(1024)
def _slots(skeleton: str, reference: str) -> list[int]:
    return dom.slots(skeleton, reference)


def align(shapes: DataFrame) -> DataFrame:
    """(host, shape, n, slots) of distinct trees (host, shape, skeleton, n): the host's most frequent tree (of ties the
    smallest) is the reference that each of its trees is aligned with."""
    refs = shapes.groupBy("host").agg(F.min_by("skeleton", F.struct(-F.col("n"), "shape")).alias("reference"), F.count("*").alias("n"))
    total = shapes.count()
    refs = materialize(refs, "references")
    both = _lookup(shapes.withColumnRenamed("n", "__pages"), refs, ["host"], total, "inner")
    both = both.select("host", "shape", F.col("__pages").alias("n"), "skeleton", "__found.reference")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        got = [_slots(s, r) for s, r in zip(b.column(3).to_pylist(), b.column(4).to_pylist())]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(got, pa.list_(pa.int64()))], names=["host", "shape", "n", "slots"])

    return map_batches(both, run, "host string, shape long, n long, slots array<long>")


def constants(trees: DataFrame, aligned: DataFrame, total: int) -> DataFrame:
    """(host, slot, hash) of the texts of the template: on over half of the host's pages that have the slot, of which there
    are MIN_PAGES at least, and on pages with MIN_DISTINCT different longest blocks."""
    told = _lookup(trees.select("host", "shape", "mark", "lines", "hashes"), aligned, ["host", "shape"], total, "inner")
    slot = F.transform("lines", lambda i: F.get(F.col("__found.slots"), i))
    told = told.select("host", "mark", slot.alias("slots"), "hashes")
    pages = told.select("host", F.explode(F.array_distinct("slots")).alias("slot")).groupBy("host", "slot").agg(F.count("*").alias("pages"))
    texts = told.select("host", "mark", F.explode(F.array_distinct(F.arrays_zip("slots", "hashes"))).alias("x")).select("host", "mark", F.col("x.slots").alias("slot"), F.col("x.hashes").alias("hash"))
    seen = texts.groupBy("host", "slot", "hash").agg(F.count("*").alias("n"), F.bit_count(F.bit_or("mark")).alias("different")).where((F.col("different") >= MIN_DISTINCT) & (F.col("n") >= MIN_PAGES // 2 + 1))
    j = seen.join(pages.where(F.col("pages") >= MIN_PAGES), ["host", "slot"])
    return j.where(F.col("n") * 2 > F.col("pages")).select("host", "slot", "hash")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages (page_id, url, html): the main text, blocks joined by one space.

    Null or empty html gives an empty text; pages without an address, or with one that has no host, form a host of their
    own; rows that repeat an id or a page are rows of their own; very long pages are read whole, in one pass; further columns
    are not looked at; an empty table gives an empty result."""
    trees = materialize(_trees(pages), "trees")
    shapes = materialize(trees.groupBy("host", "shape").agg(F.min("skeleton").alias("skeleton"), F.count("*").alias("n")), "shapes")
    total = trees.count()
    aligned = materialize(align(shapes), "aligned")
    same = materialize(constants(trees, aligned, total), "constants")
    lines = aligned.select("host", "shape", "n", F.posexplode("slots").alias("line", "slot"))
    drop = lines.join(same, ["host", "slot"]).groupBy("host", "shape", "n").agg(F.collect_set(F.struct("line", "hash")).alias("drop"))
    drop = materialize(drop, "templates")
    discard(trees, shapes)
    told = _lookup(_texts(pages), drop, ["host", "shape"], total, "left")
    zipped = F.arrays_zip("lines", "hashes", "texts")
    template = lambda x: F.coalesce(F.array_contains(F.col("__found.drop"), F.struct(x["lines"].alias("line"), x["hashes"].alias("hash"))), F.lit(False))
    text = F.concat_ws(" ", F.transform(F.filter(zipped, lambda x: ~template(x)), lambda x: x["texts"]))
    return told.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
