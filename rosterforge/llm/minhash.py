"""MinHash near-dedup with HyperMinHash registers, verified on full shingle sets."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.banding import Flusher, band_keys, compare_sets, linked, own_registers, ranges_for, registers, shared_bands, windows
from rosterforge.llm.common import byte_slices, drop_staged, row_slices, stage

#: Registers, in BANDS equal bands; MANTISSA bits beside the leading-zero count.
BANDS, WIDTH, MANTISSA = 42, 6, 10
REGISTERS = BANDS * WIDTH
#: Sets under SMALL have a hash function per register, sets from LARGE (0.8 of it) one for all; between the two numbers both.
SMALL, LARGE = 512, 400
#: Ids broadcast at most (16 MB); beyond it texts are fetched by a shuffle join.
BROADCAST_IDS = 1_000_000
CACHE_WORDS = 120_000
#: Text taken at once.
SLICE_BYTES = 8 << 20


class _Words(dict):
    def __missing__(self, word: bytes) -> bytes:
        self[word] = out = xxhash.xxh3_64_intdigest(word).to_bytes(8, "little")
        return out


@lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


def shingle_sets(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner): sorted distinct 64-bit hashes of every text's k-word shingles.

    Only A-Z are lower-cased; words are runs without ASCII white space.  A text with
    fewer than k words has its whole sequence as one shingle, one without words none.
    """
    cache = _words()
    if len(cache) > CACHE_WORDS:
        cache.clear()
    rows = [(t or "").encode().lower().split() for t in texts]
    n = np.array([len(r) for r in rows], np.int64)
    word = np.frombuffer(b"".join([cache[w] for r in rows for w in r]), "<u8")
    return windows(word, n, k)


def compress(least: np.ndarray) -> np.ndarray:
    """16 bits a register: leading zeros of the least hash plus one, then the bits after its leading one; hashes of all ones give 0."""
    zeros = np.clip(64 - np.frexp(least.astype(np.float64))[1], 0, 62).astype(np.uint64)
    mantissa = (least << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | (np.uint64((1 << MANTISSA) - 1) - mantissa)
    return np.where(least == np.iinfo(np.uint64).max, 0, out).astype("<u2")


def hyper_registers(hashes: np.ndarray, owner: np.ndarray, items: int) -> np.ndarray:
    """(items, REGISTERS): one hash function deals the shingles into the registers; 0 where empty."""
    least = registers(hashes, owner, items, REGISTERS)
    rest = (((least >> np.uint64(32)) * np.uint64(REGISTERS)) << np.uint64(32)) | (least & np.uint64(0xFFFFFFFF))
    return compress(np.where(least == np.iinfo(np.uint64).max, least, rest))


def _own(hashes: np.ndarray, owner: np.ndarray, items: int) -> np.ndarray:
    sizes = np.bincount(owner, minlength=items)
    return compress(own_registers(hashes, np.cumsum(sizes) - sizes, sizes, REGISTERS).astype(np.uint64) << np.uint64(32))


def signatures(hashes: np.ndarray, owner: np.ndarray, items: int) -> tuple[list, list]:
    """Registers of every item with a hash function each, and with one for all; None where the size has no such signature."""
    n = np.bincount(owner, minlength=items)
    out = []
    for chosen, sign in (((n > 0) & (n < SMALL), _own), (n >= LARGE, hyper_registers)):
        regs: list = [None] * items
        some = np.flatnonzero(chosen)
        if len(some):
            mine = chosen[owner]
            for i, r in zip(some.tolist(), sign(hashes[mine], (np.cumsum(chosen) - 1)[owner[mine]], len(some)), strict=True):
                regs[i] = r.tobytes()
        out.append(regs)
    return out[0], out[1]


def corrected(same, filled, ratio):
    """Jaccard estimate from equal and filled registers, less the equal ones that chance gives sets with that ratio of sizes."""
    chance = 0.169919487 * REGISTERS * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(0.0, same - np.minimum(chance, same)) / np.maximum(1, filled)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimates, registers filled on either side) of rows of registers."""
    filled = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    return corrected(same, filled, np.maximum(n_a, n_b) / np.maximum(1, np.minimum(n_a, n_b))), filled


def pack_items(batches):
    """(node, size and flags and registers as bytes) from (node, n, own, dealt)."""
    for b in row_slices(batches):
        out = [np.array([n, p is not None, q is not None], "<i8").tobytes() + (p or b"") + (q or b"") for n, p, q in zip(*(b.column(c).to_pylist() for c in (1, 2, 3)), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["node", "item"])


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts are linked when 100 * |intersection| >= percent * |union| of their shingle sets;
    the component is the smallest doc_id reachable by links.  Equal sets collapse to one
    representative before any comparing.  Null and empty texts, and texts of white space,
    have no shingles and link with nothing.  A row without doc_id takes the component of an
    equal set that has one, else null (and is kept).  Rows that repeat a doc_id with
    different texts count as one point of the graph.  Very long texts are compared by their
    whole sets.  An empty table gives an empty result.
    """
    threshold = percent / 100
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def sign(batches):
        for b in byte_slices(batches, 1, SLICE_BYTES):
            hashes, owner = shingle_sets(b.column(1).to_pylist(), words)
            n = np.bincount(owner, minlength=b.num_rows)
            ends = np.cumsum(n).tolist()
            keys = [hashlib.blake2b(hashes[e - c : e].tobytes(), digest_size=16).digest() if c else b"" for e, c in zip(ends, n.tolist(), strict=True)]
            own, dealt = signatures(hashes, owner, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), *(pa.array(x, pa.binary()) for x in (keys, own, dealt))], names=["doc_id", "n", "set_key", "own", "dealt"])

    signed = stage(src.mapInArrow(sign, "doc_id long, n long, set_key binary, own binary, dealt binary"), "signed")
    reps = signed.filter("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("own").alias("own"), F.first("dealt").alias("dealt")).filter("node IS NOT NULL")
    reps = stage(reps, "reps")
    ranges = ranges_for(docs)

    def band(batches):
        flush = Flusher(ranges)
        for b in row_slices(batches):
            node = b.column(0).to_numpy()
            for kind in (0, 1):
                raw = b.column(1 + kind)
                some = np.flatnonzero(raw.is_valid().to_numpy(zero_copy_only=False))
                regs = np.frombuffer(b"".join(raw.drop_null().to_pylist()), "<u2").reshape(len(some), REGISTERS)
                keys = band_keys(regs, BANDS, kind)
                filled = (regs != 0).reshape(len(some), BANDS, WIDTH).any(axis=2)
                flush.add(keys[filled], np.broadcast_to(node[some][:, None], keys.shape)[filled])
            if flush.due():
                yield pa.RecordBatch.from_arrays(flush.columns(), names=flush.NAMES)
        yield pa.RecordBatch.from_arrays(flush.columns(), names=flush.NAMES)

    packed = stage(reps.select("node", "own", "dealt").mapInArrow(band, Flusher.SCHEMA), "bands")

    # Five deviations below the threshold: an estimate alone practically never loses a link.
    def near_enough(j, filled):
        return j >= threshold - 5 * np.sqrt(threshold * (1 - threshold) / np.maximum(1, filled)) - 0.01

    def likely(batches):
        for b in row_slices(batches):
            keep = np.zeros(b.num_rows, bool)
            n_a, n_b = b.column(2).to_numpy(), b.column(5).to_numpy()
            for kind in (3, 4):
                both = np.flatnonzero(b.column(kind).is_valid().to_numpy(zero_copy_only=False) & b.column(kind + 3).is_valid().to_numpy(zero_copy_only=False))
                a, z = (np.frombuffer(b"".join(b.column(c).take(pa.array(both)).to_pylist()), "<u2").reshape(len(both), REGISTERS) for c in (kind, kind + 3))
                keep[both] |= near_enough(*estimate(a, z, n_a[both], n_b[both]))
            yield b.select(["a", "b"]).filter(pa.array(keep & (np.minimum(n_a, n_b) * 100 >= percent * np.maximum(n_a, n_b))))

    def prepare(raw):
        """Items are the size, then the registers of either kind."""
        head = np.array([np.frombuffer(x, "<i8", 3) for x in raw]).reshape(len(raw), 3)
        regs = [np.zeros((len(raw), REGISTERS), "<u2") for _ in range(2)]
        for i, x in enumerate(raw):
            at = 24
            for kind in (0, 1):
                if head[i, 1 + kind]:
                    regs[kind][i] = np.frombuffer(x, "<u2", REGISTERS, at)
                    at += 2 * REGISTERS

        def may_link(o, x):
            n_o, n_x = head[o, 0][:, None], head[x, 0][None, :]
            hit = np.zeros((len(o), len(x)), bool)
            for kind in (0, 1):
                has_o, has_x = np.flatnonzero(head[o, 1 + kind]), np.flatnonzero(head[x, 1 + kind])
                if len(has_o) and len(has_x):
                    a, z = regs[kind][o[has_o]], regs[kind][x[has_x]]
                    same, filled = (np.zeros((len(a), len(z)), np.int32) for _ in range(2))
                    for r in range(REGISTERS):
                        p, q = a[:, r][:, None], z[:, r][None, :]
                        same += (p == q) & (p != 0)
                        filled += (p | q) != 0
                    ratio = np.maximum(n_o[has_o], n_x[:, has_x]) / np.maximum(1, np.minimum(n_o[has_o], n_x[:, has_x]))
                    hit[np.ix_(has_o, has_x)] |= near_enough(corrected(same, filled, ratio), filled)
            return hit & (np.minimum(n_o, n_x) * 100 >= percent * np.maximum(n_o, n_x))

        return may_link

    def items(nodes):
        return reps.join(nodes, "node", "left_semi").select("node", "n", "own", "dealt").mapInArrow(pack_items, "node long, item binary")

    def exact(batches):
        for b in row_slices(batches):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def sets(batches):
        for b in byte_slices(batches, 1, SLICE_BYTES):
            hashes, owner = shingle_sets(b.column(1).to_pylist(), words)
            ends = np.cumsum(np.bincount(owner, minlength=b.num_rows))
            cut = np.split(hashes, ends[:-1]) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in cut], pa.binary())], names=["node", "item"])

    def sets_of(nodes: DataFrame) -> DataFrame:
        """(node, item): the full shingle sets of representatives, each once however often its row is repeated."""
        nodes = stage(nodes, "need")
        ids = F.broadcast(nodes) if nodes.count() <= BROADCAST_IDS else nodes
        full = stage(src.withColumnRenamed("doc_id", "node").join(ids, "node", "left_semi").mapInArrow(sets, "node long, item binary").dropDuplicates(["node"]), "sets")
        drop_staged(nodes)
        return full

    def verify(pairs: DataFrame) -> DataFrame:
        sides = [reps.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("own").alias(f"own_{c}"), F.col("dealt").alias(f"dealt_{c}")) for c in "ab"]
        likely_pairs = stage(pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "own_a", "dealt_a", "n_b", "own_b", "dealt_b").mapInArrow(likely, "a long, b long"), "likely")
        full = sets_of(likely_pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        both = likely_pairs
        for c in "ab":
            both = both.join(full.select(F.col("node").alias(c), F.col("item").alias(f"set_{c}")), c)
        out = stage(both.select("a", "b", "set_a", "set_b").mapInArrow(exact, "a long, b long").distinct(), "verified")
        for df in (full, likely_pairs):
            drop_staged(df)
        return out

    def compare(raw):
        return compare_sets([np.frombuffer(x, "<u8") for x in raw], percent)

    found = linked(shared_bands(packed), verify, [(items, prepare), (sets_of, compare)])
    drop_staged(packed)
    members = signed.select("doc_id", "n", "set_key").join(reps.select("set_key", "node"), "set_key", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "node"))
    out = members.join(found, "node", "left").withColumn("component_id", component)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: Candidates by the rarest shingles of each set (two sets that reach 0.8 share one of them), exact sets, then reachability.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS sh FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
f AS (SELECT t, count(*) AS c FROM u GROUP BY t),
p AS (SELECT doc_id, t FROM u JOIN f USING (t) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY c, t) <= n - (4 * n + 4) // 5 + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM p a JOIN p b ON a.t = b.t AND a.doc_id < b.doc_id),
link AS (SELECT a, b FROM (SELECT a, b, len(x.sh) + len(y.sh) AS n, len(list_intersect(x.sh, y.sh)) AS i FROM cand JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b) WHERE 100 * i >= 80 * (n - i)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS node, a AS seen FROM both_ways UNION SELECT reach.node, b FROM reach JOIN both_ways ON a = seen),
comp AS (SELECT node, min(seen) AS least FROM reach GROUP BY node)
SELECT doc_id, len(sh) AS n_shingles, coalesce(least, doc_id) AS component_id, coalesce(least, doc_id) = doc_id AS kept FROM s LEFT JOIN comp ON node = doc_id
"""
