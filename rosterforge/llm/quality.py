"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import row_slices

#: Hash room of the features; the last place is the bias.
BITS = 18
#: Most labelled documents used for training (the smallest by hash of doc_id).
TRAIN_ROWS = 4000
#: Words a worker remembers before it starts anew.
CACHE_WORDS = 120_000
_WORD = re.compile(r"\w+|[^\w\s]+")
_REPEAT = np.uint32(0x9E3779B1)


class _Hashes(dict):
    def __missing__(self, chunk: str) -> bytes:
        self[chunk] = out = np.array([zlib.crc32(w.encode()) for w in _WORD.findall(chunk)], "<u4").tobytes()
        return out


@lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    return _Hashes()


def features(text: str | None) -> np.ndarray:
    """Places of the text's word unigrams and bigrams, one per occurrence.

    Words are runs of letters and digits or runs of punctuation.  A bigram of a word with
    itself shares one place, whatever the word.
    """
    cache = _hashes()
    if len(cache) > CACHE_WORDS:
        cache.clear()
    one = np.frombuffer(b"".join(map(cache.__getitem__, (text or "").split())), "<u4")
    if not len(one):
        return np.zeros(0, np.int64)
    a, b = one[:-1], one[1:]
    two = np.where(a == b, _REPEAT, (a * np.uint32(0x85EBCA6B)) ^ (b * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F)))
    both = np.concatenate([one, two])
    return ((both ^ (both >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS)).astype(np.int64) % ((1 << BITS) - 1)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Weights from (places, values, label) rows by per-coordinate FTRL-proximal updates, in the given order."""
    size = 1 << BITS
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(epochs):
        for at, x, y in rows:
            zi, root = z[at], np.sqrt(n[at])
            w = np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + root) / alpha + l2), 0.0)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / alpha * w
    return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)


def vector(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse vector: counts over the root of the number of occurrences, and a bias of 1."""
    at, tf = np.unique(places, return_counts=True)
    return np.append(at, (1 << BITS) - 1), np.append(tf / np.sqrt(max(1, len(places))), 1.0)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights from at most ``rows`` labelled documents whose crc32(doc_id) mod 4 is not 2.

    Null ids and labels are left out; rows that repeat an id or a label are rows of their
    own, and of all of them the first ``rows`` by hash of id, label and text digest are taken.  Without any labelled document, or without documents, all weights are 0, so every
    score is one half.  A very long text gives one sparse vector of at most 2 ** BITS places
    (12 bytes each).
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna()
    sample = known.filter(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    picked = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text", F.md5(F.col("text").cast("binary")).alias("digest"))  # at most ``rows`` small rows

    def vectors(batches):
        for b in row_slices(batches):
            both = [vector(features(t)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array([a.astype(np.int32) for a, _ in both], pa.list_(pa.int32())), pa.array([x for _, x in both], pa.list_(pa.float64()))], names=["doc_id", "label", "digest", "at", "x"])

    rows_of = picked.mapInArrow(vectors, "doc_id long, label int, digest string, at array<int>, x array<double>")
    # Ids may repeat without bound: each task sends its first ``rows`` at most.
    got = rows_of.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "digest").limit(rows).toArrow()
    rank = got.column("doc_id").to_numpy()
    order = np.lexsort((got.column("label").to_numpy(), rank, np.array([zlib.crc32(str(i).encode()) for i in rank], np.int64)))
    at, x, y = got.column("at"), got.column("x"), got.column("label")
    return train_ftrl([(at[i].values.to_numpy(), x[i].values.to_numpy(), y[i].as_py()) for i in order.tolist()])


def score(docs: DataFrame, weights: np.ndarray, keep: tuple[str, ...] = (), threshold: float = 0.7) -> DataFrame:
    """doc_id, the ``keep`` columns, score (0 to 1), predicted (1 from ``threshold``) for every row.

    Null and empty texts have no features: the bias alone scores them.  Rows that repeat
    are scored alike, whole texts however long; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 MB
    src = docs.select(F.col("text").cast("string").alias("_text"), F.col("doc_id").cast("long").alias("doc_id"), *keep)

    def scores(batches):
        w = shared.value
        for b in row_slices(batches):
            got = [features(t) for t in b.column(0).to_pylist()]
            s = np.array([w[-1] + (w[p].sum() / np.sqrt(len(p)) if len(p) else 0.0) for p in got])
            p = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*b.schema.names[1:], "score", "predicted"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[1:])
    return src.mapInArrow(scores, f"{kinds}, score double, predicted int")
