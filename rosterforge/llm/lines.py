"""Fuzzy line dedup: MinHash over character shingles, exact Jaccard, union-find, one line kept per component."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.banding import Flusher, band_keys, compare_sets, in_common, linked, mix, own_registers, ranges_for, registers, shared_bands, windows
from rosterforge.llm.common import byte_slices, drop_staged, row_slices, stage

#: Characters in a shingle, and in one where short lines with a changed character or word are to be found too.
SHINGLE, SHORT_SHINGLE = 7, 5
#: A pair at Jaccard 0.8 is missed by all bands with probability (1 - 0.8 ** WIDTH) ** BANDS = 0.0004.
BANDS, WIDTH = 20, 5
REGISTERS = BANDS * WIDTH
#: Registers that give the sketch of a line a bit each, and bits in which two sketches may differ: at Jaccard 0.8 a bit
#: differs with probability 0.1, so more than FAR of SKETCH differ once in 2,000 pairs; of unrelated lines most do.
SKETCH, FAR = 47, 12
#: Size classes of sets grow by a tenth; sets with a ratio of 0.8 or more are at most CLASSES apart.
GROWTH, CLASSES, MOST_CLASS = 1.1, 3, 127
#: Bits of a node that come from the line's digest.
DIGEST = 9
#: Sets under SMALL are signed by one hash function per register, larger ones by one for all; between the two numbers by both.
SMALL, LARGE = 375, 300
#: Characters signed at once, and lines a task remembers to have signed; both bound its memory.
CHUNK, SEEN = 1 << 19, 150_000
#: Text taken at once.
SLICE_BYTES = 8 << 20
#: Text of the first lines of pairs compared at once.
PAIR_BYTES = 2 << 20
#: Rows broadcast at most (about 60 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Bytes of needed line numbers broadcast at most.
BROADCAST_BYTES = 32 << 20


def normal_line(line: str) -> str:
    """Lower case, with runs of white space as one space and none at the ends."""
    return " ".join(line.lower().split())


def _points(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all lines end to end, length of each line)."""
    n = np.array([len(x) for x in lines], np.int64)
    return np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), n


def line_sets(lines: list[str], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner): sorted distinct hashes of each normal line's k-character shingles."""
    return windows(*_points(lines), k)


def line_sets_apart(lines: list[str], k: int = SHINGLE) -> list[np.ndarray]:
    """Each line's own sorted distinct hashes; as many lines at once as :data:`CHUNK` says."""
    out = []
    for lo, hi in _chunks(lines):
        hashes, owner = line_sets(lines[lo:hi], k)
        out.extend(np.split(hashes, np.cumsum(np.bincount(owner, minlength=hi - lo))[:-1]))
    return out


def line_keys(lines: list[str], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, band key) of every band of every normal line, and every line's sketch under the class of its set's size and the kind of its signature."""
    sets, owner = line_sets(lines, k)
    size = np.bincount(owner, minlength=len(lines))
    first = np.cumsum(size) - size
    signed = []
    some = np.flatnonzero((size > 0) & (size < SMALL))
    if len(some):
        signed.append((0, some, own_registers(sets, first[some], size[some], REGISTERS)))
    large = size >= LARGE
    if large.any():
        held = large[owner]
        signed.append((1, np.flatnonzero(large), registers(sets[held], (np.cumsum(large) - 1)[owner[held]], int(large.sum()), REGISTERS)))
    out_items, out_keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    grade = np.minimum(MOST_CLASS, np.log(np.maximum(1, size)) / np.log(GROWTH)).astype(np.uint64)
    sketches = np.zeros(len(lines), np.uint64)
    for kind, items, regs in sorted(signed, key=lambda x: -x[0]):  # who has both kinds keeps the sketch of kind 0
        bits = mix(regs[:, :SKETCH].astype(np.uint64)) & np.uint64(1)
        sketches[items] = (bits << np.arange(SKETCH, dtype=np.uint64)).sum(axis=1) | grade[items] << np.uint64(SKETCH) | np.uint64(kind << (SKETCH + 7))
        keys = band_keys(regs, BANDS, kind)
        held = (regs != np.iinfo(regs.dtype).max).reshape(len(items), BANDS, WIDTH).any(axis=2)
        out_items.append(np.broadcast_to(items[:, None], keys.shape)[held])
        out_keys.append(keys[held])
    return np.concatenate(out_items), np.concatenate(out_keys), sketches


def node_of(digest_halves: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """64 bits that stand for a line: its sketch over some bits of its digest.  Lines that share a node are told apart by the digest's other half."""
    return (sketches << np.uint64(DIGEST) | digest_halves.view(np.uint64) & np.uint64((1 << DIGEST) - 1)).view(np.int64)


def sketches_near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of nodes may stand for similar lines, by the sizes of their sets and, where they are of one kind, by their sketches."""
    a, b = a.view(np.uint64) >> np.uint64(DIGEST), b.view(np.uint64) >> np.uint64(DIGEST)
    apart = a ^ b
    grade = [(x >> np.uint64(SKETCH) & np.uint64(127)).astype(np.int64) for x in (a, b)]
    close = (apart >> np.uint64(SKETCH + 7) != 0) | (np.bitwise_count(apart & np.uint64((1 << SKETCH) - 1)) <= FAR)
    return close & (np.abs(grade[0] - grade[1]) <= CLASSES)


def _chunks(lines: list[str]):
    """(first, end) of stretches of about CHUNK characters."""
    first = held = 0
    for i, x in enumerate(lines):
        held += len(x)
        if held >= CHUNK:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(lines):
        yield first, len(lines)


def line_compare(percent: int, shingle: int = SHINGLE):
    """Maps a list of normal lines to a function of two index arrays: which pairs are linked."""

    def prepare(lines: list[str]):
        return compare_sets(line_sets_apart(lines, shingle), percent)

    return prepare


def dedup_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), shingle: int = SHINGLE) -> DataFrame:
    """Every row with its fuzzy repeated lines removed.

    Returns doc_id, the ``keep`` columns, text (what is left), n_lines, n_dropped and
    dropped (line numbers from 0, ascending).  Lines are split at line feeds; two lines are
    linked when 100 * |intersection| >= percent * |union| of the sets of
    ``shingle``-character shingles of their normal forms (a shorter line is its own shingle).  Of each component the
    first line stays, by doc_id (rows without one last), text digest and line number.
    Lines of white space alone are linked with nothing and stay.  A null text counts as
    empty, which is one empty line.  Rows that repeat both doc_id and text get the same
    result.  A very long line is signed and compared whole.  An empty table gives an empty
    result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    units = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("unit"))
    ranges = ranges_for(docs)

    def sign(batches):
        flush, seen, again = Flusher(ranges), {}, set()
        of_lines = [pa.int64(), pa.binary(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 2]
        names = ["doc_id", "unit", "line_nos", "los", "his", *Flusher.NAMES]

        def out(columns, first):
            n = len(columns[0])
            rest = [pa.nulls(n, t) for t in (Flusher.KINDS if first else of_lines)]
            return pa.RecordBatch.from_arrays([*columns, *rest] if first else [*rest, *columns], names=names)

        def repeats():
            """The nodes of lines met more than once, as rows without a key."""
            nodes = np.array([seen[k] for k in again], np.int64)
            again.clear()
            n = len(nodes)
            return out([*(pa.nulls(n, t) for t in Flusher.KINDS[:3]), pa.array(nodes)], False)

        for b in byte_slices(batches, 1, SLICE_BYTES):
            digests, at, ends, fresh, new = [], [], [0], [], []
            for t in b.column(1).to_pylist():
                for i, raw in enumerate(t.split("\n")):
                    line = normal_line(raw)
                    if line:
                        key = xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))
                        digests.append(key)
                        at.append(i)
                        if key in seen:
                            again.add(key)
                        else:
                            seen[key] = 0
                            fresh.append(line)
                            new.append(key)
                ends.append(len(at))
            halves = np.frombuffer(b"".join(new), "<i8")
            for lo, hi in _chunks(fresh):
                item, keys, sketches = line_keys(fresh[lo:hi], shingle)
                nodes = node_of(halves[2 * lo : 2 * hi : 2], sketches)
                seen.update(zip(new[lo:hi], nodes.tolist(), strict=True))
                # Every line also has a key of its own, odd where those of bands are even: tasks that share a line meet there.
                flush.add(mix(nodes.view(np.uint64)) | np.uint64(1), nodes)
                flush.add(keys & ~np.uint64(1), nodes[item])
                if flush.due():
                    yield out(flush.columns(), False)
            nodes = np.array([seen[k] for k in digests], np.int64)
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (np.array(at, np.int32), nodes, np.frombuffer(b"".join(digests), "<i8")[1::2])]
            yield out([b.column(0), b.column(2), *lists], True)
            if len(seen) > SEEN:
                yield repeats()
                seen.clear()
        yield repeats()
        yield out(flush.columns(), False)

    kinds = f"doc_id long, unit binary, line_nos array<int>, los array<long>, his array<long>, {Flusher.SCHEMA}"
    signed = stage(units.mapInArrow(sign, kinds), "lines")
    packed = signed.filter("line_nos IS NULL").select(*Flusher.NAMES)
    shared = stage(shared_bands(packed, sketches_near, again=True).unionByName(packed.filter("blob IS NULL AND key IS NULL").select("key", "node").distinct()), "line-bands")
    # Lines that come more than once, or share a band with others; no other line is looked at again.
    nodes = stage(shared.select(F.col("node").alias("lo")).distinct(), "line-nodes")
    some = F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes
    lines = signed.filter("line_nos IS NOT NULL").select("doc_id", "unit", F.posexplode("los").alias("at", "lo"), "line_nos", "his")
    lines = lines.select("doc_id", "unit", F.get("line_nos", "at").alias("line_no"), "lo", F.get("his", "at").alias("hi")).join(some, "lo", "left_semi")
    lines = stage(lines, "line-occurrences")
    for df in (signed, nodes):
        drop_staged(df)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "unit", "line_no")
    reps = lines.groupBy("lo", "hi").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    reps = stage(reps.withColumn("rep", F.monotonically_increasing_id()), "line-reps")
    # A node stands for the line in the bands; whoever shares it is looked at.
    candidates = shared.filter("key IS NOT NULL").join(reps.select(F.col("lo").alias("node"), "rep"), "node").select("key", F.col("rep").alias("node"))
    # Different lines with one node are in no bucket together but this.
    alike = reps.groupBy("lo").agg(F.count("*").alias("lines")).filter("lines > 1")
    candidates = candidates.unionByName(reps.join(alike, "lo", "left_semi").select((F.col("lo").bitwiseOR(1)).alias("key"), F.col("rep").alias("node"))).distinct()

    def pick(batches):
        for b in row_slices(batches):
            reps_out, lines_out = [], []
            for t, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = t.split("\n")
                for w in want:
                    reps_out.append(w["rep"])
                    lines_out.append(normal_line(rows[w["line_no"]]))
            yield pa.RecordBatch.from_arrays([pa.array(reps_out, pa.int64()), pa.array(lines_out, pa.string())], names=["node", "item"])

    def exact(batches):
        for b in byte_slices(batches, 2, PAIR_BYTES, 512):
            text = pa.concat_arrays([b.column(2), b.column(3)]).dictionary_encode()
            sets = line_sets_apart(text.dictionary.to_pylist(), shingle)
            keep = []
            for i, j in text.indices.to_numpy().reshape(2, -1).T.tolist():
                both = in_common(sets[i], sets[j])
                keep.append(100 * both >= percent * (len(sets[i]) + len(sets[j]) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def texts_of(nodes: DataFrame) -> DataFrame:
        """(node, item): the normal lines of representatives, each once however often its row is repeated."""
        need = nodes.join(reps.withColumnRenamed("rep", "node"), "node")
        need = need.groupBy(F.col("first.doc_id").alias("d"), F.col("first.unit").alias("u")).agg(F.collect_list(F.struct(F.col("first.line_no").alias("line_no"), F.col("node").alias("rep"))).alias("want"))
        need = stage(need, "line-need")
        size = need.agg(F.coalesce(F.sum(F.size("want") * 12 + 64), F.lit(0))).first()[0]
        side = F.broadcast(need) if size <= BROADCAST_BYTES else need
        picked = units.join(side, F.col("unit").eqNullSafe(F.col("u")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("text", "want")
        texts = stage(picked.mapInArrow(pick, "node long, item string").dropDuplicates(["node"]), "line-texts")
        drop_staged(need)
        return texts

    # Every line that shares a band is compared at least with its bucket's leader, so the corpus is read once for all of them.
    candidates = stage(candidates, "line-candidates")
    texts = texts_of(candidates.select("node").distinct())

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs
        for c in "ab":
            both = both.join(texts.select(F.col("node").alias(c), F.col("item").alias(f"line_{c}")), c)
        return stage(both.select("a", "b", "line_a", "line_b").mapInArrow(exact, "a long, b long").distinct(), "line-links")

    found = linked(candidates, verify, [(lambda nodes: texts.join(nodes, "node", "left_semi"), line_compare(percent, shingle))])
    for df in (shared, candidates, texts):
        drop_staged(df)
    joined = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").filter("n > 1 OR component IS NOT NULL")
    joined = stage(joined.select("lo", "hi", "first", F.coalesce("component", "rep").alias("component")), "line-members")
    winners = joined.groupBy("component").agg(F.min("first").alias("stays"))
    members = joined.select("lo", "hi", "component").join(winners, "component").select("lo", "hi", "stays")
    gone = lines.join(members, ["lo", "hi"]).filter(~place.eqNullSafe(F.col("stays")))
    gone = stage(gone.groupBy("doc_id", "unit").agg(F.array_sort(F.collect_set("line_no")).alias("dropped")), "line-dropped")
    for df in (reps, lines, joined):
        drop_staged(df)
    size = gone.agg(F.coalesce(F.sum(F.size("dropped") * 4 + 64), F.lit(0))).first()[0]
    side = F.broadcast(gone) if size <= BROADCAST_BYTES else gone
    side = side.select(F.col("doc_id").alias("d"), F.col("unit").alias("u"), "dropped")
    whole = docs.select(doc_id.alias("doc_id"), F.struct(*keep).alias("row") if keep else F.lit(0).alias("row"), F.split(text, "\n", -1).alias("rows"), F.unhex(F.md5(text.cast("binary"))).alias("unit"))
    whole = whole.join(side, F.col("unit").eqNullSafe(F.col("u")) & F.col("doc_id").eqNullSafe(F.col("d")), "left").withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("rows") - 1), "dropped"), lambda i: F.get("rows", i))
    return whole.select(
        "doc_id",
        *[F.col(f"row.`{c}`").alias(c) for c in keep],
        F.when(F.size("dropped") == 0, F.array_join("rows", "\n")).otherwise(F.array_join(left, "\n")).alias("text"),
        F.size("rows").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
        "dropped",
    )
