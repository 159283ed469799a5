"""Token-id files: canonical length-limited Huffman blocks with bit-offset checkpoints.

File format (one Parquet row per block, in ascending doc_id order):

``shard, block``   place of the block: shards in key order, blocks within them
``shard_start``    ids of the shard before the block
``doc_ids, doc_lens``  documents of the block (whole ones) and their id counts
``checkpoints``    bit offset of every 256th id, so decoding can start at any of them
``payload``        the bits, most significant first

Blocks lie in ``blocks`` under the file's path, the code book (symbol, length) in ``book``;
codes are canonical, so lengths are all a reader needs, and the path is all it is given.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.llm.common import drop_staged, parts, running_bases, shared_dir, stage
from rosterforge.llm.tokens import token_rows

#: Longest code in bits: the decoding table has 2**MAX_BITS entries.
MAX_BITS = 20
#: A block closes with the document that brings it to this many ids.
BLOCK_IDS = 16_384
#: Ids between two checkpoints.
LANE_IDS = 256
#: Ids that a task puts in order and writes.
SHARD_IDS = 32 << 20
#: Blocks decoded together.
TOGETHER = 32

BLOCK = "shard int, block int, shard_start long, doc_ids array<long>, doc_lens array<long>, n_ids long, checkpoints array<long>, payload binary"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with no code over ``limit`` bits (package-merge); 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, merged = [], leaves
    is_leaf = np.ones(len(leaves), bool)
    for _ in range(limit):
        levels.append(is_leaf)
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        rank = np.argsort(both, kind="stable")
        merged, is_leaf = both[rank], rank < len(leaves)
    take = 2 * len(leaves) - 2
    depth = np.zeros(len(leaves), np.int64)
    for flags in reversed(levels):
        n = int(flags[:take].sum())
        depth[:n] += 1
        take = 2 * (take - n)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol): each is the share of the code room that the codes before it take."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    short = int(lengths.max(initial=0)) - lengths[order]
    room = 1 << short
    codes[order] = (np.cumsum(room) - room) >> short
    return codes


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of the ids and the bit offset of every LANE_IDS-th of them."""
    size = lengths[ids]
    ends = np.cumsum(size)
    at = ends - size
    word = at >> 5
    placed = codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
    n = int(ends[-1] >> 5) + 2 if len(ids) else 0
    # Bits of different ids never overlap and stay under 2**32, so float sums are exact.
    out = np.bincount(word, (placed >> np.uint64(32)).astype(np.float64), n) + np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    total = int(ends[-1]) if len(ids) else 0
    return out.astype(">u4").tobytes()[: (total + 7) // 8], at[::LANE_IDS]


class Decoder:
    def __init__(self, lengths: np.ndarray, codes: np.ndarray):
        self.bits = max(1, int(lengths.max(initial=1)))
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = (1 << (self.bits - lengths[order])).astype(np.int64)
        room = 1 << self.bits
        self.symbol = np.zeros(room, np.int32)
        self.length = np.ones(room, np.int8)
        filled = int(spans.sum())
        self.symbol[:filled] = np.repeat(order, spans)
        self.length[:filled] = np.repeat(lengths[order], spans)

    def __call__(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """Ids of independent blocks: the lanes of all of them step together through the table."""
        pads = [p + b"\0\0\0\0" for p, _, _ in blocks]
        base = np.cumsum([0, *map(len, pads)])[:-1] * 8
        raw = np.frombuffer(b"".join(pads) or b"\0" * 4, np.uint8).astype(np.uint32)
        quad = np.zeros(len(raw), np.uint32)
        for k in range(4):
            quad[: len(raw) - k] |= raw[k:] << np.uint32(24 - 8 * k)
        at = np.concatenate([np.asarray(c, np.int64) + b for (_, c, _), b in zip(blocks, base, strict=True)] or [np.zeros(0, np.int64)])
        want = np.concatenate([np.minimum(LANE_IDS, n - LANE_IDS * np.arange(len(c))) for _, c, n in blocks] or [np.zeros(0, np.int64)])
        out = np.zeros((len(at), LANE_IDS), np.int32)
        shift, mask, last = 32 - self.bits, np.uint32((1 << self.bits) - 1), len(quad) - 1
        for k in range(int(want.max(initial=0))):
            code = (quad[np.minimum(at >> 3, last)] >> (shift - (at & 7)).astype(np.uint32)) & mask
            out[:, k] = self.symbol[code]
            at += np.where(k < want, self.length[code], 0)
        lanes = np.cumsum([0, *(len(c) for _, c, _ in blocks)])
        return [out[a:b].reshape(-1)[:n] for a, b, (_, _, n) in zip(lanes, lanes[1:], blocks, strict=False)]


def flat_ids(column: pa.Array, id_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows end to end, ids in each row) of a column of raw ids."""
    sizes = pc.binary_length(column).to_numpy().astype(np.int64) // id_bytes
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]].view("<u2" if id_bytes == 2 else "<u4") if raw else np.zeros(0, "<u2"), sizes


def count_ids(batches):
    """(symbol, n) of a task's ids."""
    total = np.zeros(0, np.int64)
    for b in batches:
        if b.num_rows:
            c = np.bincount(flat_ids(b.column(0), b.column(1)[0].as_py())[0], minlength=len(total))
            c[: len(total)] += total
            total = c
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["symbol", "n"])


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = 1, lower_case: bool = True, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> tuple[SparkSession, str]:
    """Writes the ids of all documents, in ascending doc_id order, in the file format above; returns (session, path).

    Without a path, the file goes to the shared folder.  Documents are tokenised once; ids
    (two bytes each) are dealt by range of doc_id and place in the table, so that a doc_id
    that many rows share is dealt out too.  Null texts count as empty (just ``end_id``),
    null doc_ids come first, rows that repeat a doc_id follow each other as they lie in the
    table; a very long text is one long block; an empty table gives no blocks.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/llm-id-file-{uuid.uuid4().hex}"
    tokens = stage(token_rows(docs, tokenizer, end_id, lower_case, id_col, text_col), "ids")
    # At most one row per symbol of the vocabulary comes to the driver.
    seen = tokens.select("ids", "id_bytes").mapInArrow(count_ids, "symbol int, n long").groupBy("symbol").agg(F.sum("n")).collect()
    counts = np.zeros(max((r[0] for r in seen), default=0) + 1, np.int64)
    for s, n in seen:
        counts[s] = n
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(list(zip(used.tolist(), lengths[used].tolist(), strict=True)), "symbol int, bits int").coalesce(1).write.parquet(f"{path}/book")
    tables = spark.sparkContext.broadcast((lengths, canonical_codes(lengths)))  # two arrays of the vocabulary's size

    def blocks(batches):
        lengths, codes = tables.value
        shard, block, at = TaskContext.get().partitionId(), 0, 0
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()), pa.binary())
        docs: list = []
        sizes, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in _then_none(batches):
            if b is not None and b.num_rows:
                more, n = flat_ids(b.column(1), b.column(2)[0].as_py())
                docs += b.column(0).to_pylist()
                sizes, ids = np.append(sizes, n), np.append(ids, more)
            ends = np.cumsum(sizes)
            lo = first = 0
            while lo < len(docs):
                hi = int(np.searchsorted(ends, first + BLOCK_IDS)) + 1
                if hi > len(docs):
                    if b is not None:
                        break  # the block goes on in the next batch
                    hi = len(docs)
                end = int(ends[hi - 1])
                payload, marks = encode_block(ids[first:end], lengths, codes)
                row = (shard, block, at, docs[lo:hi], sizes[lo:hi], end - first, marks, payload)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=[x.split()[0] for x in BLOCK.split(", ")])
                at, block, lo, first = at + end - first, block + 1, hi, end
            docs, sizes, ids = docs[lo:], sizes[lo:], ids[first:]

    shards = max(parts(docs), -(-int(counts.sum()) // SHARD_IDS))
    ordered = tokens.select("doc_id", "ids", "id_bytes", "part", "part_start").repartitionByRange(shards, "doc_id", "part", "part_start").sortWithinPartitions("doc_id", "part", "part_start")
    ordered.select("doc_id", "ids", "id_bytes").mapInArrow(blocks, BLOCK).write.option("compression", "zstd").parquet(f"{path}/blocks")
    drop_staged(tokens)
    return spark, path


def _then_none(batches):
    yield from batches
    yield None


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(shard, shard_start, doc_id, n_tokens, ids binary of 32-bit ids) of every document in the file."""
    rows = spark.read.schema("symbol int, bits int").parquet(f"{path}/book").collect()  # one row per symbol of the vocabulary
    lengths = np.zeros(max((r[0] for r in rows), default=0) + 1, np.int64)
    for s, n in rows:
        lengths[s] = n
    tables = spark.sparkContext.broadcast(lengths)

    def decode(batches):
        lengths = tables.value
        decoder = Decoder(lengths, canonical_codes(lengths))
        for b in batches:
            for lo in range(0, b.num_rows, TOGETHER):
                part = b.slice(lo, TOGETHER)
                shard, start, n, marks, payload = (part.column(k).to_pylist() for k in ("shard", "shard_start", "n_ids", "checkpoints", "payload"))
                got = decoder([(p, np.array(c, np.int64), k) for p, c, k in zip(payload, marks, n, strict=True)])
                ids = np.concatenate(got).astype("<u4")
                docs, sizes = part.column("doc_ids").flatten(), part.column("doc_lens").flatten().to_numpy()
                held = pc.list_value_length(part.column("doc_lens")).to_numpy()
                ends = np.cumsum(sizes)
                first = np.repeat(np.array(start) - (np.cumsum(n) - n), held)  # from places in this part to places in the shard
                raw = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((np.append(0, ends) * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(shard, np.int32), held)), pa.array(first + ends - sizes), docs, pa.array(sizes), raw], names=["shard", "shard_start", "doc_id", "n_tokens", "ids"])

    file = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    small = file.select("shard", "shard_start", "doc_ids", "doc_lens", "n_ids", "checkpoints", "payload")
    return small.mapInArrow(decode, "shard int, shard_start long, doc_id long, n_tokens long, ids binary")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded file."""
    file = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    bases = running_bases(file.groupBy("shard").agg(F.sum("n_ids").alias("total")), "shard", "total")
    got = read_ids(spark, path).select("shard", "shard_start", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    # One row per task that wrote the file.
    return got.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
