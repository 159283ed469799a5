"""Exact dedup with counting quotient filters.

A 64-bit fingerprint is cut into shard, quotient and remainder.  Every map task builds
one filter per shard from its own rows; the filters of a shard are merged without loss
by their sorted remainders; fingerprints counted more than once go to byte verification.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import drop_staged, parts, stage

#: Fingerprints a merged filter is meant to hold; more documents make more shards.
SHARD_ROWS = 1 << 20
#: Repeated fingerprints are broadcast up to this many (16 MB); beyond it they are joined by shuffle.
BROADCAST_ROWS = 1_000_000


class CountingQuotientFilter:
    """Sorted fingerprints with counts in quotient-filter slots.

    ``occupied`` marks quotients that have a run, ``run_end`` the last slot of each run
    (the i-th run belongs to the i-th occupied quotient), ``counter`` the slots that hold
    a count for the remainder before them; a remainder seen once takes a single slot.
    """

    def __init__(self, prints: np.ndarray, counts: np.ndarray, shard_bits: int):
        self.shard_bits, n = shard_bits, len(prints)
        self.quotient_bits = max(1, int(np.ceil(np.log2(max(1, n) * 1.1))))
        self.rest = 64 - shard_bits - self.quotient_bits
        self.shard = int(prints[0] >> np.uint64(64 - shard_bits)) if n and shard_bits else 0
        body = (prints << np.uint64(shard_bits)) >> np.uint64(shard_bits) if shard_bits else prints
        quotient = (body >> np.uint64(self.rest)).astype(np.int64)
        remainder = body & np.uint64((1 << self.rest) - 1)
        width = 1 + (counts > 1)
        before = np.cumsum(width) - width
        at = before + np.maximum.accumulate(quotient - before) if n else before
        room = max(1 << self.quotient_bits, int(at[-1] + width[-1]) if n else 0)
        self.slots = np.zeros(room, np.uint64)
        self.occupied, self.run_end, self.counter = (np.zeros(room, bool) for _ in range(3))
        self.slots[at] = remainder
        many = counts > 1
        self.slots[at[many] + 1], self.counter[at[many] + 1] = counts[many].astype(np.uint64), True
        self.occupied[quotient] = True
        last = np.append(quotient[1:] != quotient[:-1], True) if n else np.zeros(0, bool)
        self.run_end[(at + width - 1)[last]] = True

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints in order, counts): exactly what went in."""
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        starts = np.maximum(quotients, np.concatenate([[-1], ends[:-1]]) + 1) if len(ends) else ends
        sizes = ends - starts + 1
        slot = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        owner = np.repeat(quotients, sizes).astype(np.uint64)
        held = ~self.counter[slot]
        slot, owner = slot[held], owner[held]
        prints = (owner << np.uint64(self.rest)) | self.slots[slot]
        if self.shard_bits:
            prints |= np.uint64(self.shard) << np.uint64(64 - self.shard_bits)
        after = np.minimum(slot + 1, len(self.slots) - 1)
        counted = (slot + 1 < len(self.slots)) & self.counter[after]
        return prints, np.where(counted, self.slots[after], 1).astype(np.int64)

    def to_bytes(self) -> bytes:
        head = np.array([self.shard_bits, self.quotient_bits, self.shard, len(self.slots)], "<u8").tobytes()
        return head + b"".join(np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter)) + self.slots.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        out = cls.__new__(cls)
        out.shard_bits, out.quotient_bits, out.shard, room = (int(x) for x in np.frombuffer(raw, "<u8", 4))
        out.rest, at, flat = 64 - out.shard_bits - out.quotient_bits, 32, (room + 7) // 8
        for name in ("occupied", "run_end", "counter"):
            setattr(out, name, np.unpackbits(np.frombuffer(raw, np.uint8, flat, at), count=room).astype(bool))
            at += flat
        out.slots = np.frombuffer(raw, "<u8", room, at).astype(np.uint64)
        return out

    @classmethod
    def of(cls, prints: np.ndarray, shard_bits: int) -> CountingQuotientFilter:
        return cls(*np.unique(prints, return_counts=True), shard_bits)

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """One filter with the summed counts; runs are already in order, so this is a merge of sorted lists."""
        both = [f.entries() for f in filters]
        prints, counts = (np.concatenate(x) for x in zip(*both, strict=True))
        order = np.argsort(prints, kind="stable")
        prints, counts = prints[order], counts[order]
        first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
        return cls(prints[first], np.add.reduceat(counts, first), filters[0].shard_bits)


def repeated_fingerprints(keys: DataFrame, rows: int) -> DataFrame:
    """(fp, n) of the fingerprints that ``keys.fp`` (long) holds more than once."""
    shard_bits = max(0, int(np.ceil(np.log2(max(parts(keys), rows / SHARD_ROWS)))))

    def build(batches):
        held = [b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for b in batches]
        prints, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        shard = (prints >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(prints), np.int64)
        cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(prints) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(prints)][: len(cuts)], strict=True):
            raw = CountingQuotientFilter(prints[lo:hi], counts[lo:hi], shard_bits).to_bytes()
            yield pa.RecordBatch.from_arrays([pa.array([int(shard[lo])], pa.int32()), pa.array([raw], pa.binary())], names=["shard", "filter"])

    def merge(table):
        merged = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(x.as_py()) for x in table.column("filter")])
        prints, counts = merged.entries()
        many = counts > 1
        return pa.table({"fp": pa.array(prints[many].view(np.int64)), "n": pa.array(counts[many])})

    return keys.select("fp").mapInArrow(build, "shard int, filter binary").groupBy("shard").applyInArrow(merge, "fp long, n long")


def normalised(text):
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fingerprint=F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are; of equal texts the smallest doc_id
    stays.  Null texts count as empty.  A row without a doc_id never stays for others
    unless all rows of its group lack one (then keep_id is null and kept true).  Rows that
    repeat both doc_id and text stay together.  Very long texts are hashed and compared whole.  An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    with_keys = docs.select("doc_id", fingerprint("norm").alias("fp"), F.sha2("norm", 256).alias("text_sha256"), "norm")
    keys = stage(with_keys.drop("norm"), "keys")
    repeated = stage(repeated_fingerprints(keys, keys.count()), "repeated")
    few = repeated.select("fp")
    if repeated.count() <= BROADCAST_ROWS:
        few = F.broadcast(few)
    # Byte verification: whole texts of repeated fingerprints are grouped; copies collapse before the shuffle.
    same = with_keys.join(few, "fp", "left_semi").groupBy("fp", "text_sha256", "norm").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    groups = same.groupBy("fp", "text_sha256").agg(F.min("first_id").alias("first_id"), F.sum("n").alias("n"), F.count("*").alias("texts"))
    groups = stage(groups.withColumn("n", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts with one SHA-256")).cast("long")).otherwise(F.col("n"))).drop("texts"), "groups")
    drop_staged(repeated)
    out = keys.join(groups, ["fp", "text_sha256"], "left")
    grouped = F.col("n").isNotNull()
    keep = F.when(grouped, F.col("first_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        "text_sha256",
    )


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.n AS group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
