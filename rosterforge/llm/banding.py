"""Banded signatures: which items share a band, and the verified components of those that do.

Signatures are registers that hold least hashes (compressed or not).  Large sets are dealt
into the registers by one hash function; sets too small to fill them are signed with a
hash function per register.  Sizes near the border are signed in both ways, so any two
sizes that can reach the threshold meet.  Equal runs of registers are the bands.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import drop_staged, parts, stage
from rosterforge.llm.components import components, settle

_P = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: A key with more members than this in one flush of a task is dealt out row by row.
HOT = 256
#: Members on either side of a block of comparisons.
OUT, ALL = 512, 2048
_LOW = np.uint64(0xFFFFFFFF)
#: Stands among a key's nodes for those of a task that go row by row.
LOUD = np.iinfo(np.int64).min
#: Members of a bucket that are compared with each other by their sketches.
SKETCHED = 2048
#: Hashes that :func:`own_registers` lays side by side.
CELLS = 1 << 15
#: Bits that bound an intersection, and pairs bounded at once (MARKS / 8 bytes each).
MARKS, PAIRS = 4096, 2048
#: (key, node) pairs a task holds before it writes them.
FLUSH = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _A
    x = x ^ (x >> np.uint64(33))
    x = x * _B
    return x ^ (x >> np.uint64(33))


def sorted_sets(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner): each item's stretch of hashes (from starts[i] to starts[i + 1]) sorted, without repeats."""
    hashes = hashes.copy()
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        hashes[lo:hi].sort()
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    if not len(hashes):
        return hashes, owner
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
    return hashes[fresh], owner[fresh]


def window_hashes(values: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): a hash of every run of ``k`` values of each item, item by item.

    ``n`` holds the items' lengths in ``values``.  An item with fewer than k values has its
    whole sequence as one run, an empty one none.
    """
    ends = np.cumsum(n)
    h = values.copy()
    for j in range(1, k):
        h *= _P
        h[: len(values) - j] += values[j:]
    valid = np.repeat(ends, n) - np.arange(len(values)) >= k
    short = np.flatnonzero((n > 0) & (n < k))
    for i in short.tolist():
        v, at = int(n[i]), int(ends[i] - n[i])
        for x in values[at : ends[i]].tolist():
            v = (v * int(_P) + x) & 0xFFFFFFFFFFFFFFFF
        h[at] = v ^ 0xFFFFFFFFFFFFFFFF
        valid[at] = True
    return mix(h[valid]), np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))


def windows(values: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner): sorted distinct hashes of every run of ``k`` values of each item."""
    hashes, counts = window_hashes(values, n, k)
    return sorted_sets(hashes, np.concatenate([[0], np.cumsum(counts)]))


def registers(hashes: np.ndarray, owner: np.ndarray, items: int, m: int) -> np.ndarray:
    """Least hash per item and bucket, from :func:`sorted_sets`; empty buckets hold the largest value.

    Buckets come from a product of the leading 32 bits, so any m will do.
    """
    cell = owner * m + ((hashes >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    first = np.append(True, cell[1:] != cell[:-1]) if len(cell) else np.zeros(0, bool)
    out = np.full(items * m, np.iinfo(np.uint64).max, np.uint64)
    out[cell[first]] = hashes[first]
    return out.reshape(items, m)


def own_registers(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, m: int) -> np.ndarray:
    """(items, m) of 32 bits: least hash per item and register, every register under a hash function of its own.

    An item has the hashes from ``starts[i]`` on, one at least; repeated ones change nothing.
    Items of like size are laid side by side, as many as the processor's cache holds.
    """
    seeds = np.random.default_rng(11).integers(0, 1 << 32, m, np.uint64).astype(np.uint32) | np.uint32(1)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), m), np.uint32)
    order = np.argsort(sizes, kind="stable")
    size = sizes[order]
    lo = 0
    while lo < len(order):
        hi = int(np.searchsorted(size, 1.5 * size[lo] + 16, "right"))
        hi = lo + min(hi - lo, max(1, CELLS // int(size[hi - 1])))
        some = order[lo:hi]
        lo = hi
        rows = high[starts[some] + np.minimum(np.arange(int(sizes[some[-1]]))[:, None], sizes[some] - 1)]
        work = np.empty_like(rows)
        for r, seed in enumerate(seeds):
            out[some, r] = np.multiply(rows, seed, out=work).min(axis=0)
    return out


def band_keys(regs: np.ndarray, bands: int, kind: int) -> np.ndarray:
    """(items, bands) of hashes of equal runs of registers; ``kind`` keeps signatures of different kinds apart."""
    n, m = regs.shape
    seeds = np.random.default_rng(7 + kind).integers(0, 1 << 63, m, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    sums = mix((regs.astype(np.uint64) + np.uint64(1)) * seeds).reshape(n, bands, m // bands).sum(axis=2)
    return mix(sums + mix(np.uint64(kind << 16) + np.arange(bands, dtype=np.uint64)))


class Flusher:
    """Packs (key, node) pairs into one row per range of keys; very frequent keys go row by row.

    Rows are (range, blob, key, node): a blob holds the lowest 32 bits of the keys, then the
    nodes; ``key`` and ``node`` are set on the row-by-row ones, of which LOUD stands for all
    in the blob.  Within a range these bits
    stand for the key: keys that agree in them by chance only make more candidates.
    """

    NAMES = ("range", "blob", "key", "node")
    KINDS = (pa.int32(), pa.binary(), pa.int64(), pa.int64())
    SCHEMA = "range int, blob binary, key long, node long"

    def __init__(self, ranges: int):
        self.ranges, self.keys, self.nodes, self.held = ranges, [], [], 0

    def add(self, keys: np.ndarray, nodes: np.ndarray):
        self.keys.append(keys)
        self.nodes.append(nodes)
        self.held += len(keys)

    def due(self) -> bool:
        return self.held >= FLUSH

    def columns(self):
        keys = np.concatenate([*self.keys, np.zeros(0, np.uint64)])
        nodes = np.concatenate([*self.nodes, np.zeros(0, np.int64)])
        self.keys, self.nodes, self.held = [], [], 0
        part = (keys >> np.uint64(32)) * np.uint64(self.ranges) >> np.uint64(32)
        keys = part << np.uint64(32) | keys & _LOW
        order = np.argsort(keys)
        keys, nodes = keys[order], nodes[order]
        starts, sizes = _runs(keys)
        hot = np.repeat(sizes > HOT, sizes) | (nodes == LOUD)
        keep = ~hot
        keep[starts] = True
        k, v, p = keys[keep], np.where(hot[keep], LOUD, nodes[keep]), (keys[keep] >> np.uint64(32)).astype(np.int32)
        cuts = _runs(p)[0]
        blobs = [(k[a:b] & _LOW).astype("<u4").tobytes() + v[a:b].astype("<i8").tobytes() for a, b in zip(cuts, [*cuts[1:], len(p)][: len(cuts)], strict=True)]
        n, loud = len(blobs), int(hot.sum())
        return [
            pa.array([*p[cuts].tolist(), *[None] * loud], pa.int32()),
            pa.array([*blobs, *[None] * loud], pa.binary()),
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(keys[hot].view(np.int64))]),
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(nodes[hot])]),
        ]


def _in_order(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs in order of key and node, without repeats."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    fresh = np.append(True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1]))[: len(keys)]
    return keys[fresh], nodes[fresh]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of every run of equal values."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return starts, np.diff(np.append(starts, len(values)))


def ranges_for(docs: DataFrame, per_range: int = 16 << 20, most: int = 1 << 18) -> int:
    """Ranges of band keys: the session's shuffle partitions, or more where Spark expects more than ``per_range`` bytes of input for each."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size < 1 << 60  # sources without statistics claim the largest number
    return max(parts(docs), min(most, -(-size // per_range)) if known else 1)


def with_company(keys: np.ndarray, nodes: np.ndarray, near) -> np.ndarray:
    """Which of the pairs (in order of key) have another in their bucket that is ``near``; those of large buckets and of LOUD keys all have."""
    starts, sizes = _runs(keys)
    size = np.repeat(sizes, sizes)
    loud = np.repeat(np.logical_or.reduceat(nodes == LOUD, starts), sizes) if len(keys) else np.zeros(0, bool)
    stay = loud | (size > SKETCHED)
    last = np.repeat(starts + sizes - 1, sizes)
    left = np.flatnonzero(~stay & (size > 1))
    d = 0
    while len(left):
        d += 1
        left = left[left + d <= last[left]]
        hit = left[near(nodes[left], nodes[left + d])]
        stay[hit] = stay[hit + d] = True
    return stay


def shared_bands(packed: DataFrame, near=None, again: bool = False) -> DataFrame:
    """(key, node) of the bands that two or more nodes have, from rows of a :class:`Flusher`.

    ``near`` says of two arrays of nodes which pairs may be alike; nodes that are near to no
    other of their bucket are left out.  With ``again``, an odd key belongs to one node
    alone: nodes that more than one flush has under such a key come out too, with a null key.
    """

    def meet(table):
        raw = [x.as_py() for x in table.column("blob")]
        n = [len(x) // 12 for x in raw]
        keys = np.concatenate([np.frombuffer(x, "<u4", k) for x, k in zip(raw, n, strict=True)]).astype(np.uint64)
        nodes = np.concatenate([np.frombuffer(x, "<i8", k, 4 * k) for x, k in zip(raw, n, strict=True)]).astype(np.int64)
        keys |= np.uint64(table.column("range")[0].as_py()) << np.uint64(32)
        twice = np.zeros(0, np.int64)
        if again:
            own = (keys & np.uint64(1)).astype(bool)
            alone, n_flushes = np.unique(nodes[own], return_counts=True)
            twice = alone[n_flushes > 1]
            keys, nodes = keys[~own], nodes[~own]
        order = np.argsort(keys)
        keys, nodes = keys[order], nodes[order]
        for sort in (False, True):  # most keys have one node, so few are sorted by node too
            if sort:
                keys, nodes = _in_order(keys, nodes)
            _, sizes = _runs(keys)
            many = np.repeat(sizes > 1, sizes)
            keys, nodes = keys[many], nodes[many]
        if near is not None:
            stay = with_company(keys, nodes, near)
            keys, nodes = keys[stay], nodes[stay]
        quiet = nodes != LOUD
        out = pa.table({"key": pa.array(keys[quiet].view(np.int64)), "node": pa.array(nodes[quiet])})
        return pa.concat_tables([out, pa.table({"key": pa.nulls(len(twice), pa.int64()), "node": pa.array(twice)})])

    met = packed.filter("blob IS NOT NULL").select("range", "blob").groupBy("range").applyInArrow(meet, "key long, node long")
    return met.unionByName(packed.filter("blob IS NULL AND key IS NOT NULL").select("key", "node")).distinct()


def linked(shared: DataFrame, verify, steps: list) -> DataFrame:
    """(node, component) of all nodes with a verified link between nodes that share a band.

    ``verify`` maps candidate pairs (a, b) to the true links among them.  Each of the
    ``steps`` is (items, prepare): ``items`` maps a table of nodes to (node, item), and
    ``prepare`` a list of items to a function of two index arrays that says which pairs are
    links (last step) or may be (the steps before it, which thin the blocks out).

    First every bucket's members are compared with its leader, the member with most
    company over all its buckets (the centre of a group of copies).  Nodes that are then
    connected need no more comparing.  Then every member that is still outside its
    leader's component is compared with all members of the bucket outside its own, in
    blocks of at most OUT by ALL members: no pair that shares a band and could change a
    component is left out, and no pairs are written but a spanning forest of a block's links.
    """
    kept = lambda df, name: df if hasattr(df, "_staged_at") else stage(df, name)
    shared = kept(shared, "shared")
    sizes = shared.groupBy("key").agg(F.count("*").alias("size"))
    company = shared.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("company"))
    leaders = stage(shared.join(company, "node").groupBy("key").agg(F.max(F.struct("company", F.bitwise_not("node").alias("minus"))).alias("top"), F.count("*").alias("size")).select("key", F.bitwise_not(F.col("top.minus")).alias("leader"), "size"), "leaders")
    pairs = shared.join(leaders, "key").filter("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    tried = stage(pairs, "tried")
    links = kept(verify(tried), "found")
    drop_staged(tried)
    known = stage(components(links), "known")
    side = lambda df, c, to: df.join(known.select(F.col("node").alias(c), F.col("component").alias(to)), c, "left").withColumn(to, F.coalesce(to, c))
    rows = side(side(shared.join(leaders.filter("size > 2"), "key"), "node", "own"), "leader", "lead")
    placed = stage(rows.select("key", "node", "own", "size", (F.col("own") != F.col("lead")).alias("out")), "placed")
    busy = placed.filter("out").groupBy("key").agg(F.count("*").alias("n_out"))
    met = placed.join(busy, "key")
    blocks_of = lambda n, most: F.ceil(F.col(n) / most).cast("int")
    slot = lambda n, most: F.pmod(F.xxhash64("node"), blocks_of(n, most)).cast("int")
    every = lambda n, most: F.explode(F.sequence(F.lit(0), blocks_of(n, most) - 1))
    left = met.filter("out").select("key", "node", "own", F.lit(True).alias("out"), slot("n_out", OUT).alias("i"), every("size", ALL).alias("j"))
    right = met.select("key", "node", "own", F.lit(False).alias("out"), every("n_out", OUT).alias("i"), slot("size", ALL).alias("j"))
    dealt = left.unionByName(right)
    for items, prepare in steps[:-1]:
        dealt = stage(_blocks(dealt, items, prepare, False), "thinned")
    extra = stage(_blocks(dealt, *steps[-1], True).distinct(), "extra")
    out = known
    if not extra.isEmpty():
        # Further links join whole components, so only their ends are walked again.
        ends = side(side(extra, "a", "own_a"), "b", "own_b").select(F.col("own_a").alias("a"), F.col("own_b").alias("b"))
        merged = stage(components(ends), "merged")
        moved = known.join(merged.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
        moved = moved.select("node", F.coalesce("to", "component").alias("component"))
        out = stage(moved.unionByName(merged.join(known.select("node"), "node", "left_anti")), "joined")
        drop_staged(merged)
        drop_staged(known)
    for df in (shared, leaders, placed, extra, links):
        drop_staged(df)
    return out


MEMBER = "key long, i int, j int, node long, own long, out boolean"


def _blocks(dealt: DataFrame, items, prepare, last: bool) -> DataFrame:
    """Compares block by block: the members that may have a link there, or (a, b) of a spanning forest of the links."""

    def meet(batches):
        held = None
        for b in _then_none(batches):
            both = [x for x in (held, b) if x is not None]
            if not both:
                continue
            t = pa.Table.from_batches(both).combine_chunks()
            key, i, j, node, own, out = (t.column(c).to_numpy() for c in range(6))
            cuts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
            done = len(t) if b is None else int(cuts[-1])  # the last block may go on in the next batch
            held = t.slice(done).to_batches()[0] if b is not None else None
            if not done:
                continue
            # A node lies in many blocks, but its item is prepared once.
            _, first, at_item = np.unique(node[:done], return_index=True, return_inverse=True)
            compare = prepare(t.column("item").take(pa.array(first)).to_pylist())
            stay = np.zeros(len(t), bool)
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(t)], strict=True):
                if lo >= done:
                    break
                o, x = lo + np.flatnonzero(out[lo:hi]), lo + np.flatnonzero(~out[lo:hi])
                if not len(o) or not len(x):
                    continue
                hit = compare(at_item[o], at_item[x]) & (own[o][:, None] != own[x][None, :])
                stay[o], stay[x] = hit.any(axis=1), hit.any(axis=0)
                if last and stay[lo:hi].any():
                    r, c = np.nonzero(hit)
                    nodes, at = np.unique(np.concatenate([node[o[r]], node[x[c]]]), return_inverse=True)
                    label = np.arange(len(nodes))
                    settle(label, at[: len(r)], at[len(r) :])
                    a, z = nodes[label], nodes
                    yield pa.RecordBatch.from_arrays([pa.array(a[a != z]), pa.array(z[a != z])], names=["a", "b"])
            if not last and stay.any():
                yield from t.select(["key", "i", "j", "node", "own", "out"]).filter(pa.array(stay)).to_batches()

    rows = dealt.join(items(dealt.select("node").distinct()), "node").select("key", "i", "j", "node", "own", "out", "item")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInArrow(meet, "a long, b long" if last else MEMBER)


def _marks(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, MARKS / 64) words: a bit for each value of the lowest bits that a set's hashes have."""
    out = np.zeros((len(sets), MARKS // 64), np.uint64)
    for lo in range(0, len(sets), 64):
        some = sets[lo : lo + 64]
        grid = np.zeros((len(some), MARKS), bool)
        owner = np.repeat(np.arange(len(some)), [len(x) for x in some])
        grid[owner, (np.concatenate(some) & np.uint64(MARKS - 1)).astype(np.int64)] = True
        out[lo : lo + 64] = np.packbits(grid, axis=1).view(np.uint64)
    return out


def in_common(a: np.ndarray, b: np.ndarray) -> int:
    """Members that two arrays without repeats share."""
    both = np.concatenate([a, b])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def compare_sets(sets: list[np.ndarray], percent: int):
    """A function of two index arrays: which pairs of sorted sets have 100 * intersection >= percent * union.

    A shared hash has a shared mark, and of a set's hashes only those beyond its number of
    marks share one with another of the set.  So the marks bound the intersection from above,
    and only pairs whose bound reaches the threshold are counted.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    marks = _marks(sets)
    beyond = sizes - np.bitwise_count(marks).sum(axis=1, dtype=np.int64)

    def may_link(o, x):
        hit = np.zeros((len(o), len(x)), bool)
        step = max(1, PAIRS // max(1, len(x)))
        for lo in range(0, len(o), step):
            i = o[lo : lo + step]
            most = np.bitwise_count(marks[i][:, None, :] & marks[x][None, :, :]).sum(axis=2, dtype=np.int64)
            most = np.minimum(most + np.minimum(beyond[i][:, None], beyond[x][None, :]), np.minimum(sizes[i][:, None], sizes[x][None, :]))
            hit[lo : lo + step] = 100 * most >= percent * (sizes[i][:, None] + sizes[x][None, :] - most)
        return hit

    def linked_pairs(o, x):
        hit = may_link(o, x)
        r, c = np.nonzero(hit)
        if len(r) <= max(64, hit.size // 64):
            both = np.array([in_common(sets[i], sets[j]) for i, j in zip(o[r].tolist(), x[c].tolist(), strict=True)], np.int64)
            hit[r, c] = 100 * both >= percent * (sizes[o[r]] + sizes[x[c]] - both)
            return hit
        rows, cols = hit.any(axis=1), hit.any(axis=0)
        hit[np.ix_(rows, cols)] = counted(o[rows], x[cols])
        return hit

    def counted(o, x):
        """The product of incidences, over the members that the smaller side has."""
        turned = len(o) > len(x)
        few, many = (x, o) if turned else (o, x)
        known = np.unique(np.concatenate([sets[i] for i in few]))
        both = np.zeros((len(few), len(many)), np.float32)
        for lo in range(0, len(known), 8192):
            some, grids = known[lo : lo + 8192], []
            for side in (few, many):
                every = np.concatenate([sets[i] for i in side])
                place = np.minimum(np.searchsorted(some, every), len(some) - 1)
                own = some[place] == every
                grid = np.zeros((len(side), len(some)), np.float32)
                grid[np.repeat(np.arange(len(side)), sizes[side])[own], place[own]] = 1
                grids.append(grid)
            both += grids[0] @ grids[1].T
        both = (both.T if turned else both).astype(np.int64)
        return 100 * both >= percent * (sizes[o][:, None] + sizes[x][None, :] - both)

    return linked_pairs


def _then_none(batches):
    yield from batches
    yield None
