"""Quality rules by host: rule failures of documents, failure rates of hosts shrunk with a beta prior
fitted to all hosts, and the hosts' verdicts joined back to the documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .spark_io import map_batches, materialize, small

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _equal_words(buf: np.ndarray, s: np.ndarray, e: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    size = e[x] - s[x]
    return (size == e[y] - s[y]) & K.same(buf, s[x], s[y], np.minimum(size, e[y] - s[y]))


def _slow(buf: np.ndarray, offs: np.ndarray, s: np.ndarray, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeated lines of each row and words in repeated windows, by the bytes themselves."""
    lines, covered = np.zeros(len(offs) - 1, np.int64), np.zeros(len(s) + 2, bool)
    for r in range(len(offs) - 1):
        seen: set[bytes] = set()
        for line in buf[offs[r] : offs[r + 1]].tobytes().split(b"\n"):
            if line.strip(b" \t\n\x0b\x0c\r"):
                lines[r] += line in seen
                seen.add(line)
        words = [buf[a:b].tobytes() for a, b in zip(s[first[r] : first[r + 1]], e[first[r] : first[r + 1]])]
        places: dict[tuple, list[int]] = {}
        for i, w in enumerate(zip(words, words[1:], words[2:])):
            places.setdefault(w, []).append(first[r] + i)
        for at in (at for at in places.values() if len(at) > 1):
            for i in at:
                covered[i : i + 3] = True
    return lines, covered


def _features(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offs) - 1
    s, e, first = K.words(buf, offs)
    out = {"n_words": np.diff(first)}
    start_of_char = (buf & 0xC0) != 0x80
    out["word_chars"] = K.per_row(start_of_char & ~K.SPACE[buf], offs)
    out["n_symbols"] = K.per_row(_SYMBOL[buf], offs)
    h = K.Hasher(buf)
    # lines that hold a word, as (row, hash of the bytes)
    edges = np.unique(np.concatenate([offs[:-1], np.flatnonzero(buf == 10) + 1]))
    edges = edges[edges < len(buf)]
    ends = np.append(edges[1:], len(buf))
    ends = ends - ((ends > edges) & (buf[np.maximum(ends, 1) - 1] == 10)) if len(edges) else ends
    a, b = np.searchsorted(s, edges), np.searchsorted(s, ends)
    edges, ends = edges[b > a], ends[b > a]
    row = np.searchsorted(offs, edges, "right") - 1
    key = h(edges, ends) ^ K.mix(row.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    x, y = order[again], order[again + 1]
    fine = K.same(buf, edges[x], edges[y], np.minimum(ends[x] - edges[x], ends[y] - edges[y])) & (ends[x] - edges[x] == ends[y] - edges[y]) & (row[x] == row[y])
    out["n_dup_lines"] = np.bincount(row[y], minlength=n)
    # three-word windows found twice or more in their row
    of = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    covered = np.zeros(len(s) + 2, bool)
    if len(s) >= 3:
        w = K.windows(h(s, e), 3) ^ K.mix(of[2:])
        inside = np.flatnonzero(of[:-2] == of[2:])
        order = inside[np.argsort(w[inside])]
        same = np.flatnonzero(w[order[1:]] == w[order[:-1]])
        x, y = order[same], order[same + 1]
        for j in range(3):
            fine = np.append(fine, _equal_words(buf, s, e, x + j, y + j) & (of[x] == of[y]))
        hit = np.unique(np.concatenate([x, y]))
        for j in range(3):
            covered[hit + j] = True
    if not fine.all():  # two different lines or windows share a hash: count with other means
        out["n_dup_lines"], covered = _slow(buf, offs, s, e, first)
    out["n_repeat_words"] = K.per_row(covered[: len(s)], first)
    return out


def features(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and the counts of each whole text (null: all 0); one row per row."""
    kept = docs.select(*keep, F.col(text).alias("__text"))

    def count(b: pa.RecordBatch) -> pa.RecordBatch:
        parts = [_features(buf, offs) for _, _, buf, offs in K.slices(b.column(len(keep)))]
        cols = [np.concatenate([p[c] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64) for c in COUNTS]
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *map(pa.array, cols)], names=[*keep, *COUNTS])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return map_batches(kept, count, f"{head}, " + ", ".join(f"{c} long" for c in COUNTS))


#: Rules of a document: fewer words than this fail, and more than half of the words in repeated windows fail.
MIN_WORDS = 50
#: A host is rejected when most of its documents fail for certain: the mean of its rate's posterior, which the prior fitted
#: to all hosts draws towards the others, less so many deviations passes MAX_RATE.
MAX_RATE = 0.5
DEVIATIONS = 3.0
#: More hosts than this are joined by a shuffle; fewer (a bound on the size) are broadcast.
MAX_BROADCAST_HOSTS = 50_000
#: Hosts with more than one document in HOT_SHARE are at most so many, and broadcast even then.
HOT_SHARE = 1000


def failures(df: DataFrame) -> DataFrame:
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def host_verdicts(df: DataFrame, host: str = "source") -> DataFrame:
    """One row per non-null host: documents, failures, shrunken rate and verdict.

    The prior Beta(a, b) has the mean of all hosts' documents and, by the method of moments, the spread of
    the hosts' rates beyond what chance gives; hosts without spread share a prior of strength 1000."""
    per = df.where(F.col(host).isNotNull()).groupBy(host).agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    m = per.agg(
        (F.sum("host_failed") / F.sum("host_docs")).alias("mu"), F.var_samp(rate).alias("v"), F.avg(1 / F.col("host_docs")).alias("inv")
    )
    noise = F.col("mu") * (1 - F.col("mu")) * F.col("inv")
    between = F.greatest(F.coalesce(F.col("v"), F.lit(0.0)) - noise, F.lit(0.0))
    strength = F.when(between > 0, F.least(F.greatest(F.col("mu") * (1 - F.col("mu")) / F.greatest(between, F.lit(1e-12)) - 1, F.lit(1.0)), F.lit(1000.0))).otherwise(1000.0)
    prior = m.select("mu", strength.alias("strength")).first()  # two numbers
    mu, strength = F.lit(prior["mu"] or 0.0), F.lit(prior["strength"] or 1000.0)
    n = F.col("host_docs") + strength
    mean = (F.col("host_failed") + mu * strength) / n
    out = per.select(host, "host_docs", "host_failed", mean.alias("host_rate"), F.sqrt(mean * (1 - mean) / (n + 1)).alias("sd"))
    return out.select(host, "host_docs", "host_failed", "host_rate", (F.col("host_rate") - DEVIATIONS * F.col("sd") > MAX_RATE).alias("host_rejected"))


def judge(df: DataFrame, host: str = "source") -> DataFrame:
    """Add base_failed, host_rate, host_rejected and kept to rows with the counts.

    Null hosts have no verdict: their documents are kept unless they fail themselves. An empty table gives
    an empty result. If the hosts are too many to broadcast, those with a large share of the rows still are, and only the
    others' rows are shuffled by host."""
    df = failures(df)
    hosts = materialize(host_verdicts(df, host), "hosts")
    hosts = hosts.select(F.col(host).alias("__host"), "host_docs", "host_rate", "host_rejected")
    if small(hosts, MAX_BROADCAST_HOSTS):
        out = df.join(F.broadcast(hosts), df[host] == hosts["__host"], "left")
    else:
        total = hosts.agg(F.sum("host_docs")).first()[0]  # one number
        hot = hosts.where(F.col("host_docs") * HOT_SHARE > F.lit(total)).select(F.col("__host").alias("__hot"), F.col("host_rate").alias("__rate"), F.col("host_rejected").alias("__out"))
        left = df.join(F.broadcast(hot), df[host] == hot["__hot"], "left")
        spread = F.concat(F.lit("\0"), F.xxhash64("doc_id", *COUNTS).cast("string"))  # rows that need no further host
        left = left.withColumn("__key", F.when(F.col("__hot").isNotNull() | F.col(host).isNull(), spread).otherwise(F.col(host)))
        out = left.join(hosts, left["__key"] == hosts["__host"], "left")
        out = out.withColumn("host_rate", F.coalesce("__rate", "host_rate")).withColumn("host_rejected", F.coalesce("__out", "host_rejected"))
        out = out.drop("__hot", "__rate", "__out", "__key")
    out = out.drop("host_docs")
    return out.drop("__host").withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False)))


def quality(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, the counts, base_failed, host_rate, host_rejected, kept: one row per row of docs.

    Null or empty texts have no words and fail; repeated rows are judged one by one; rows without host are judged by themselves alone;
    texts of any length are counted whole; further columns are not looked at; an empty table gives an empty result."""
    counted = docs.select("doc_id", F.col(host).alias("__source"), F.col(text).alias("__t"))
    rows = materialize(features(counted, "__t", ("doc_id", "__source")), "quality")  # read twice: by host and by document
    return judge(rows, "__source").drop("__source")
