"""Language identification by nearest centroid: normalised TF-IDF vectors of hashed byte trigrams, several clustered
centroids per language, cosine, and rejection of texts that are far from every centroid."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .spark_io import map_batches, materialize

DIMS = 4096
CENTROIDS = 4
#: Expected number of labelled texts per language that the centroids are clustered from.
SAMPLE_PER_LANGUAGE = 400
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")  # letters alone: ½, ² and Ⅳ are numbers
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def counts(column: pa.Array):
    """(first row, end row, matrix of trigram counts) of runs of at most 256 rows of a column of whole texts."""
    lowered = pc.utf8_lower(pc.fill_null(column, ""))
    for first in range(0, len(lowered), 256):
        for lo, hi, buf, offs in K.slices(lowered.slice(first, 256)):
            b = _FOLD[buf].astype(np.uint32)
            n = hi - lo
            row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offs))
            if len(b) >= 3:
                h = (b[:-2] * np.uint32(2654435761) + b[1:-1] * np.uint32(2246822519) + b[2:] * np.uint32(3266489917))
                h = ((h ^ (h >> np.uint32(15))) * np.uint32(668265263)) >> np.uint32(20)
                inside = row[:-2] == row[2:]
                m = np.bincount((row[:-2] * DIMS + h)[inside], minlength=n * DIMS).reshape(n, DIMS)
            else:
                m = np.zeros((n, DIMS), np.int64)
            yield first + lo, first + hi, m


def vectors(m: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(m.astype(np.float32)) * idf
    size = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(size > 0, size, 1)


def inverse_frequencies(labelled: DataFrame) -> np.ndarray:
    """Smoothed IDF of each dimension over all labelled texts; tasks send one row per dimension."""

    def run(batches):
        total, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for _, _, m in counts(b.column(0)):
                total += (m > 0).sum(axis=0)
                n += len(m)
        yield pa.RecordBatch.from_arrays([pa.array([*range(DIMS), -1], pa.int32()), pa.array([*total.tolist(), n], pa.int64())], names=["dim", "docs"])

    rows = {r["dim"]: r["docs"] for r in labelled.select("text").mapInArrow(run, "dim int, docs long").groupBy("dim").agg(F.sum("docs").alias("docs")).collect()}
    n = rows.get(-1, 0)
    return np.array([np.log((1 + n) / (1 + rows.get(i, 0))) + 1 for i in range(DIMS)], np.float32)


def _cluster(v: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from farthest-first starts."""
    c = [v.mean(axis=0)]
    while len(c) < min(k, len(v)):
        c.append(v[np.argmin(np.max(v @ np.array(c).T, axis=1))])
    c = np.array(c)
    for _ in range(rounds):
        own = np.argmax(v @ c.T, axis=1)
        c = np.array([v[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> dict:
    """IDF over all labelled rows; centroids and rejection radii from a bounded sample per language (chosen by a hash
    of the row's id, `per_language` rows expected). Rows with null text, label or id teach nothing."""
    rows = docs.select("doc_id", F.col(text).alias("text"), F.col(lang).alias("lang")).where("doc_id is not null and text is not null and lang is not null")
    idf = inverse_frequencies(rows)
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # one row per language
    if not sizes:
        return {"idf": idf, "langs": [], "of": np.zeros(0, int), "centroids": np.zeros((0, DIMS), np.float32), "radius": np.zeros(0)}
    share = {r["lang"]: min(1.0, per_language / r["count"]) for r in sizes}
    rate = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])
    picked = rows.where((F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) / float(1 << 20)) < rate[F.col("lang")])

    def vec(b: pa.RecordBatch) -> pa.RecordBatch:
        v = [vectors(m, idf) for _, _, m in counts(b.column(1))]
        flat = np.concatenate(v).astype(np.float16) if v else np.zeros((0, DIMS), np.float16)
        return pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([r.tobytes() for r in flat], pa.binary())], names=["doc_id", "lang", "v"])

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("doc_id")
        v = np.array([np.frombuffer(x, np.float16) for x in g["v"]]).astype(np.float32)
        c = _cluster(v, CENTROIDS)
        near = np.max(v @ c.T, axis=1)
        return pd.DataFrame({"lang": g["lang"].iloc[0], "k": range(len(c)), "c": [x.astype(np.float32).tobytes() for x in c], "radius": float(np.quantile(near, 0.01)) * 0.5})

    found = map_batches(picked, vec, "doc_id long, lang string, v binary").groupBy("lang").applyInPandas(fit, "lang string, k int, c binary, radius double").collect()  # the model itself
    langs = [r["lang"] for r in sizes if any(f["lang"] == r["lang"] for f in found)]
    found.sort(key=lambda r: (langs.index(r["lang"]), r["k"]))
    return {
        "idf": idf, "langs": langs, "of": np.array([langs.index(r["lang"]) for r in found]),
        "centroids": np.array([np.frombuffer(r["c"], np.float32) for r in found]).reshape(-1, DIMS), "radius": np.array([r["radius"] for r in found]),
    }


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The rows' other columns kept out: doc_id, lang_pred, score, rejected. `und` with score 0 where the text is null,
    has no letter, or nothing was learned; `rejected` where the nearest centroid is farther than its radius."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        n, col = b.num_rows, b.column(1)
        best, score, far = np.zeros(n, int), np.zeros(n), np.ones(n, bool)
        if len(model["langs"]):
            for lo, hi, m in counts(col):
                cos = vectors(m, model["idf"]) @ model["centroids"].T
                at = np.argmax(cos, axis=1)
                score[lo:hi] = np.clip(cos[np.arange(hi - lo), at], 0, 1)
                best[lo:hi], far[lo:hi] = model["of"][at], score[lo:hi] < model["radius"][at]
        known = np.array([bool(t and _LETTER.search(t)) for t in map(pa.StringScalar.as_py, col)], bool) & bool(model["langs"])
        names = np.array([*model["langs"], UNKNOWN], object)[np.where(known, best, len(model["langs"]))]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(far | ~known)], names=["doc_id", "lang_pred", "score", "rejected"])

    return map_batches(docs.select("doc_id", F.col(text).alias("t")), run, "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: one row per row of docs (doc_id, text, lang). Learns from the rows whose
    crc32(doc_id) mod 4 is not 2 and predicts all; held_out marks the others (null id: false).

    Null texts and texts without letters are `und` with score 0; without labelled rows all are. Texts of any length are read
    whole; of equally near languages the first in order counts; repeated rows are predicted alike; further columns are not
    looked at; an empty table gives an empty result."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return predict(docs, train(docs.where(~held))).withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score", "rejected")
