"""Conversation repair: cheapest edits by bucket-queue shortest paths, the audit by a walk over tight arcs.

Turns are numbered over ranges of (conversation, turn) and cut into blocks, so that no
conversation has to fit into one task.  A block gives the distances between its borders for
each state of the grammar; these are chained from the end of a conversation, and with the
distances beyond its right border each block walks by itself.
"""

from __future__ import annotations

from collections import deque
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import parts, stage

#: Turns of a block: at most 2 ** BLOCK_BITS, all of one conversation.
BLOCK_BITS = 12
SPACES = " \t\n\x0b\x0c\r"
#: Most characters of text in an Arrow batch of repaired turns.
BATCH_CHARS = 4 << 20
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
# States: nothing yet, after s, after u, after a.  NEXT is where a turn that an edit writes leads, WRITES its role.
STATES, NEXT, WRITES = range(4), (2, 2, 3, 2), ("user", "user", "assistant", "user")
KEEPS = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}  # (state, initial) -> state; initials s, u, a are 1, 2, 3
END = (0, 4, 2, 0)  # what the grammar still needs at the end of a conversation: inserted turns cost 2 each
LEGAL = {(1, 2), (2, 3), (3, 2)}
FAR = 1 << 60


def _arcs(code: int) -> list[tuple[str, int, int, int]]:
    """(edit, state, next state, cost) for a turn of the given code (initial + 4 * fault), edits in ASCII order."""
    initial, fault = code & 3, code >> 2
    out = [("D", q, q, 3) for q in STATES]
    if fault not in (BLANK, DUPLICATE):
        more = int(fault == TRUNCATED)
        out += [("K", q, KEEPS[q, initial], more) for q in STATES if (q, initial) in KEEPS]
        out += [("R", q, NEXT[q], 2 + more) for q in STATES]
    return out


_INTO = [[[(q, cost) for _, q, to, cost in _arcs(code) if to == state] for state in STATES] for code in range(16)]
_FROM = [[[(edit, to, cost) for edit, q, to, cost in _arcs(code) if q == state] for state in STATES] for code in range(16)]
_INSERTED = [[q for q in STATES if NEXT[q] == state] for state in STATES]


def distances(codes: bytes, goals: list[int]) -> list[int]:
    """Cheapest cost from every (turn, state) over the right border, where ``goals`` holds what is left in each state.

    Dial's queue: arcs cost 0 to 3, so nodes wait in one bucket per distance.
    """
    m, base = len(codes), min(goals)
    dist, buckets = [FAR] * (4 * m + 4), [[]]
    for q, g in enumerate(goals):
        if g < FAR:
            dist[4 * m + q] = g - base
            buckets += [[] for _ in range(g - base + 4 - len(buckets))]
            buckets[g - base].append(4 * m + q)
    d = 0
    while d < len(buckets):
        for node in buckets[d]:  # grows while arcs of no cost are followed
            if dist[node] != d:
                continue
            i, state = node >> 2, node & 3
            reached = [(4 * i - 4 + q, d + cost) for q, cost in _INTO[codes[i - 1]][state]] if i else []
            if i < m:
                reached += [(4 * i + q, d + 2) for q in _INSERTED[state]]
            for at, new in reached:
                if new < dist[at]:
                    dist[at] = new
                    while len(buckets) <= new:
                        buckets.append([])
                    buckets[new].append(at)
        buckets[d] = []
        d += 1
    return [x + base if x < FAR else FAR for x in dist]


def walk(codes: bytes, dist: list[int], state: int) -> tuple[str, int]:
    """(the ASCII-least edits among the cheapest, the state at the right border)."""
    edits = []
    for i, code in enumerate(codes):
        while True:
            left = dist[4 * i + state]
            tight = [(edit, to) for edit, to, cost in _FROM[code][state] if dist[4 * i + 4 + to] + cost == left]
            if dist[4 * i + NEXT[state]] + 2 == left:
                tight.append(("I", NEXT[state]))
            edit, state = min(tight)
            edits.append(edit)
            if edit != "I":
                break
    return "".join(edits), state


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the fixed damage: by crc32(conv_id:turn) % 20, 0 drops a row, 1 empties its text,
    2 removes its ``[.!?]``, 3 repeats it, 4 makes it a user's.  Nulls count as one space, but for the order by turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("_kind")).filter("_kind <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


class Repair(NamedTuple):
    """``report``: a row per conversation.  ``turns``: (conv_id, seq, edit, role, text), deleted turns too; those of a
    conversation lie in order in one partition."""

    report: DataFrame
    turns: DataFrame


def _number(batches):
    """Adds ``pos``, which ascends over the partitions and their rows."""
    at = TaskContext.get().partitionId() << 33
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.arange(at, at + b.num_rows))], names=[*b.schema.names, "pos"])
        at += b.num_rows


_KEY = "conv_id long, turn long, role string, tie string"
_BLOCK = f"{_KEY}, pos long, codes binary, illegal long, ways array<long>"


def _rows(batches):
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _packed(rows, schema: pa.Schema, most: int = 256):
    """Arrow batches of ``most`` rows of tuples."""
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


_KEY_FIELDS = [pa.field("conv_id", pa.int64()), pa.field("turn", pa.int64()), pa.field("role", pa.string()), pa.field("tie", pa.string()), pa.field("pos", pa.int64()), pa.field("codes", pa.binary()), pa.field("illegal", pa.int64())]


def _blocks(batches, bits: int):
    """Rows in order of pos -> a row per block: its first key, the codes, illegal neighbours within it, and the distances from
    each state at its left border to each at its right one."""

    def cut():
        held, key, codes = None, None, bytearray()
        for conv, turn, role, tie, pos, code in _rows(batches):
            if held is None or held != (conv, pos >> bits):
                if codes:
                    yield key, bytes(codes)
                held, key, codes = (conv, pos >> bits), (conv, turn, role, tie, pos), bytearray()
            codes.append(code)
        if codes:
            yield key, bytes(codes)

    def made():
        for key, codes in cut():
            ways = [distances(codes, [0 if q == to else FAR for q in STATES])[:4] for to in STATES]
            illegal = sum((a & 3, b & 3) not in LEGAL for a, b in zip(codes, codes[1:]))
            yield *key, codes, illegal, [w for ws in ways for w in ws]

    return _packed(made(), pa.schema([*_KEY_FIELDS, pa.field("ways", pa.list_(pa.int64()))]))


def _chain(batches):
    """Blocks of a conversation from the last to the first -> each with the goals at its right border and the cost from its left one."""

    def made():
        conv, goals, after = (), None, None
        for c, turn, role, tie, pos, codes, illegal, ways in _rows(batches):
            if (c,) != conv:
                conv, goals, after = (c,), list(END), None
            illegal += after is not None and (codes[-1] & 3, after) not in LEGAL
            left = [min(ways[4 * to + q] + goals[to] for to in STATES) for q in STATES]
            yield c, turn, role, tie, pos, codes, illegal, goals, after is None, left[0]
            goals, after = left, codes[0] & 3

    return _packed(made(), pa.schema([*_KEY_FIELDS, pa.field("goals", pa.list_(pa.int64())), pa.field("last", pa.bool_()), pa.field("cost", pa.int64())]))


def _walks(batches):
    """Adds, for each state at the left border, the edits and the state at the right one; drops the goals."""

    def made():
        for *key, codes, illegal, goals, last, cost in _rows(batches):
            dist = distances(codes, goals)
            found = [walk(codes, dist, q) for q in STATES]
            edits = [e + "I" * (END[q] // 2 if last else 0) for e, q in found]
            faults = np.bincount(np.frombuffer(codes, np.uint8) >> 2, minlength=4).tolist()
            yield *key, illegal, cost, faults[1:], [q for _, q in found], edits

    fields = [f for f in _KEY_FIELDS if f.name != "codes"]
    ints = pa.list_(pa.int64())
    return _packed(made(), pa.schema([*fields, pa.field("cost", pa.int64()), pa.field("faults", ints), pa.field("exits", ints), pa.field("edits", pa.list_(pa.string()))]))


def _apply(batches):
    """Turns of a conversation in order, each block's edits before its turns -> the repaired turns."""

    def rows():
        conv, waiting, entry, state, seq = (), deque(), 0, 0, 0

        def written(edit, role, text):
            nonlocal state, seq
            if edit in "IR":
                role, state = WRITES[state], NEXT[state]
            elif edit == "K":
                state = KEEPS[state, "sua".index(role[0]) + 1]
            seq += 1
            return conv[0], seq - 1, edit, role, "" if edit == "I" else text

        def edits():
            while waiting:
                yield from waiting[0]
                waiting.popleft()

        todo = edits()
        for c, role, text, exits, found in _rows(batches):
            if (c,) != conv:
                yield from [written(e, None, None) for e in todo]
                conv, waiting, entry, state, seq = (c,), deque(), 0, 0, 0
                todo = edits()
            if exits is not None:
                waiting.append(found[entry])
                entry = exits[entry]
                continue
            for e in todo:
                yield written(e, role, text)
                if e != "I":
                    break
        yield from [written(e, None, None) for e in todo]

    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    held, size = [], 0
    for r in rows():
        held.append(r)
        size += 64 + len(r[4])
        if size > BATCH_CHARS:
            yield from _packed(held, schema, len(held))
            held, size = [], 0
    yield from _packed(held, schema, max(1, len(held)))


def repair(rows: DataFrame, block_bits: int = BLOCK_BITS) -> Repair:
    """Repairs conversations, given as (conv_id, turn, role, text), so that the role initials read ``(s?(ua)+)?``.

    Turns go by ``turn``, nulls first; ties by role and the text's SHA-256, and equal rows are
    repeats.  A turn's first fault counts: blank, duplicate (role and text seen earlier in
    the conversation) or truncated.  A null conv_id is a conversation of its own; null roles
    and texts count as one space.  Extra columns are ignored, an empty table gives no rows.

    Report: conv_id, gaps, blank, duplicate, truncated, illegal, cost.  Blocks are walked apart
    from each other; only the texts of one conversation pass one task, in a stream, because
    they are given back in order.
    """
    n = parts(rows)
    filled = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]).withColumn("tie", F.sha2("text", 256))
    initial, bare = F.substring("role", 1, 1), F.rtrim("text", F.lit(SPACES))
    known = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(*".!?"), TRUNCATED).otherwise(NONE)
    keys = filled.select("conv_id", "turn", "role", "tie", known.alias("initial"), fault.alias("fault"), F.monotonically_increasing_id().alias("spread"))
    order = ["conv_id", "turn", "role", "tie", "spread"]  # equal rows may lie in different ranges
    numbered = keys.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("spread").mapInArrow(_number, f"{_KEY}, initial int, fault int, pos long")
    numbered = stage(numbered, "turns")

    first = numbered.filter(F.col("fault") != BLANK).groupBy("conv_id", "role", "tie").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    seen = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    coded = numbered.join(first, "pos", "left").select("conv_id", "turn", "role", "tie", "pos", (F.col("initial") + 4 * seen).alias("code"))
    block = F.shiftright("pos", block_bits)
    blocks = coded.repartition(n, block).sortWithinPartitions("pos").mapInArrow(partial(_blocks, bits=block_bits), _BLOCK)
    chained = blocks.repartition(n, "conv_id").sortWithinPartitions("conv_id", F.desc("pos"))
    chained = chained.mapInArrow(_chain, f"{_KEY}, pos long, codes binary, illegal long, goals array<long>, last boolean, cost long")
    walked = chained.repartition(n, F.col("pos")).mapInArrow(_walks, f"{_KEY}, pos long, illegal long, cost long, faults array<long>, exits array<long>, edits array<string>")
    walked = stage(walked, "edits")

    gaps = numbered.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    counts = walked.groupBy("conv_id").agg(*[F.sum(F.col("faults")[k]).alias(c) for k, c in enumerate(("blank", "duplicate", "truncated"))], F.sum("illegal").alias("illegal"), F.min_by("cost", "pos").alias("cost"))
    both = gaps.unionByName(counts, allowMissingColumns=True)
    report = both.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])

    leads = walked.select("conv_id", "turn", "role", "tie", F.lit(0).alias("kind"), "pos", F.lit(None).cast("string").alias("text"), "exits", "edits")
    texts = filled.select("conv_id", "turn", "role", "tie", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("pos"), "text", F.lit(None).cast("array<long>").alias("exits"), F.lit(None).cast("array<string>").alias("edits"))
    stream = leads.unionByName(texts).repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "tie", "kind", "pos")
    turns = stream.select("conv_id", "role", "text", "exits", "edits").mapInArrow(_apply, "conv_id long, seq long, edit string, role string, text string")
    return Repair(report, turns)


def digest(turns: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of the turns that :func:`repair` gives, as they stream by."""

    def run(batches):
        import hashlib

        def made():
            conv, edits, sha, some = (), [], hashlib.sha256(), False
            for c, _, edit, role, text in _rows(batches):
                if (c,) != conv:
                    if conv:
                        yield conv[0], "".join(edits), sha.hexdigest()
                    conv, edits, sha, some = (c,), [], hashlib.sha256(), False
                edits.append(edit)
                if edit != "D":
                    sha.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                    some = True
            if conv:
                yield conv[0], "".join(edits), sha.hexdigest()

        return _packed(made(), pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]))

    return turns.mapInArrow(run, "conv_id long, audit string, repaired_sha256 string")


def repair_report(conversations: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Every conv_id of ``conversations`` with the report, audit and digest of its repair after :func:`damage`."""
    found = repair(damage(conversations), block_bits)
    rows = conversations.select("conv_id").distinct().unionByName(found.report, allowMissingColumns=True).unionByName(digest(found.turns), allowMissingColumns=True)
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return rows.groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in longs], *[F.coalesce(F.max(c), v).alias(c) for c, v in empty.items()])
