"""K-d tree sharding by bytes: DataFrame operations only.

A node that must give ``k`` shards is split at the weighted quantile (the median where k
is even) of its widest metadata dimension, until every leaf is one shard.  Quantiles are
found by histograms: only sums per (node, bin) come to the driver, at most shards x BINS
rows for any input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterforge.llm.common import stage

#: Bins a node's range is cut into in each pass.
BINS = 2048
#: A cut is good when it is off by less than this share of a shard.
TOLERANCE = 0.002
#: Slots are numbered within this many parts of a shard at least, so no shard is one task.
SLOT_PARTS, SLOT_ROWS = 16, 200_000

DIMENSIONS = ("_d0", "_d1", "_d2", "_d3")


@dataclass
class Node:
    number: int
    shards: int
    first: int
    dim: int = 0
    lo: float = 0.0
    hi: float = 0.0
    base: int = 0  # bytes known to lie left of the range in question
    tied: float | None = None  # the value whose rows are told apart by the tie breaker
    cut: tuple[float, float] | None = None
    want: float = 0.0
    miss: float = math.inf
    done: bool = False


def metadata(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, the dimensions (doc_id, log size, language, source) and the tie breaker.

    Null metadata counts as 0 (an empty name for language and source).
    """
    text = F.col(text_col).cast("string").cast("binary")
    have = set(docs.columns)
    name = lambda c: F.crc32((F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).cast("binary")).cast("double")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16
    crc = F.coalesce(F.crc32(text), F.lit(0)).cast("long")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        size.alias("size"),
        crc.alias("text_crc32"),
        F.coalesce(F.col(id_col).cast("double"), F.lit(0.0)).alias("_d0"),
        F.log(size.cast("double")).alias("_d1"),
        name("lang").alias("_d2"),
        name("source").alias("_d3"),
        (F.xxhash64(F.col(id_col).cast("long"), crc, F.monotonically_increasing_id()) / F.lit(2.0**63)).alias("_tie"),
    )


def _of_node(values: dict, default, kind: str):
    """The value of the row's node: a constant array, indexed by the node's number."""
    cells = ", ".join(f"CAST('{values.get(i, default)}' AS {kind})" for i in range(max(values, default=0) + 1))
    return F.expr(f"coalesce(get(array({cells}), _node), CAST('{default}' AS {kind}))")


def _dimension(nodes: list[Node]):
    return F.get(F.array(*DIMENSIONS), _of_node({n.number: n.dim for n in nodes}, 0, "int"))


def _next_node(rows: DataFrame, split: list[Node]) -> DataFrame:
    """Rows right of their node's cut go to the right half's number."""
    cut, tie = (_of_node({n.number: n.cut[i] for n in split}, 0.0, "double") for i in (0, 1))
    jump = _of_node({n.number: n.shards // 2 for n in split}, 0, "int")
    rows = rows.withColumn("_v", _dimension(split)).withColumn("_cut", cut).withColumn("_ct", tie).withColumn("_jump", jump)
    right = (F.col("_v") > F.col("_cut")) | ((F.col("_v") == F.col("_cut")) & (F.col("_tie") > F.col("_ct")))
    return rows.withColumn("_node", F.col("_node") + F.when(right, F.col("_jump")).otherwise(0)).drop("_v", "_cut", "_ct", "_jump")


def _refine(rows: DataFrame, nodes: list[Node], tolerance: float) -> None:
    """Find every node's cut: histogram, keep the bin where the quantile falls, again."""
    while open_ := [n for n in nodes if not n.done]:
        field = lambda f, default, kind: _of_node({n.number: f(n) for n in open_}, default, kind)
        v = _dimension(open_)
        tied = field(lambda n: n.tied if n.tied is not None else math.nan, math.nan, "double")
        # Nodes that are done get an empty range.
        ranged = rows.select(
            "_node", "size", F.when(F.isnan(tied), v).when(v == tied, F.col("_tie")).alias("_v"), field(lambda n: float(n.lo), 1.0, "double").alias("_lo"), field(lambda n: float(n.hi), 0.0, "double").alias("_hi")
        ).filter("_v >= _lo AND _v <= _hi")
        bin_ = F.when(F.col("_hi") > F.col("_lo"), F.least(F.lit(BINS - 1), F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2) * BINS).cast("int"))).otherwise(0)
        found = ranged.groupBy("_node", bin_.alias("b")).agg(F.sum("size").alias("w"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect()
        for n in open_:
            left, n.done, inner = n.base, True, None
            bins = sorted((r for r in found if r["_node"] == n.number), key=lambda r: r["b"])
            edge = (n.lo, -math.inf) if n.tied is None else (n.tied, math.nextafter(n.lo, -math.inf))
            for r in [None, *bins]:
                if r is not None:
                    if left < n.want < left + r["w"]:
                        inner = (r, left)
                    left += r["w"]
                    edge = (r["hi"], math.inf) if n.tied is None else (n.tied, r["hi"])
                if abs(left - n.want) < n.miss:
                    n.miss, n.cut = abs(left - n.want), edge
            if inner and n.miss > tolerance:
                r, n.base = inner
                if r["hi"] > r["lo"]:
                    n.lo, n.hi, n.done = r["lo"], r["hi"], False
                elif n.tied is None:
                    n.tied, n.lo, n.hi, n.done = r["lo"], -1.0, 1.0, False


def kd_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its shard (0 to ``shards`` - 1) and its slot there.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).
    Rows that agree in the cut's dimension are told apart by a hash of doc_id, text and the
    row's place in the table (written before it is read again), so a value that a third of
    all rows share is split too, and so is one row that is repeated.  A very long text is one
    row of that size.
    Null texts have size 16; an empty table gives an empty result; with fewer rows than
    shards some shards stay empty.
    """
    table = stage(metadata(docs, id_col, text_col), "metadata")
    spread = table.agg(*[F.max(d).alias(d + "hi") for d in DIMENSIONS], *[F.min(d).alias(d + "lo") for d in DIMENSIONS], F.sum("size").alias("w"), F.count("*").alias("n")).first()
    full = [max((spread[d + "hi"] or 0) - (spread[d + "lo"] or 0), 1e-12) for d in DIMENSIONS]
    tolerance = TOLERANCE * (spread["w"] or 0) / shards
    start = table.withColumn("_node", F.lit(0))
    # ``rows`` is the plan from the stored table; ``held`` is the same, kept in memory or on disk while nodes are split.
    rows, held, leaves = start, start.persist(), [Node(0, shards, 0)]
    before = None
    while any(n.shards > 1 for n in leaves) and spread["n"]:
        stats = {r["_node"]: r for r in held.groupBy("_node").agg(F.sum("size").alias("w"), *[F.max(d).alias(d + "hi") for d in DIMENSIONS], *[F.min(d).alias(d + "lo") for d in DIMENSIONS]).collect()}
        if before is not None:  # this level is in memory now
            before.unpersist()
        split = [n for n in leaves if n.shards > 1 and n.number in stats]
        for n in split:
            r = stats[n.number]
            n.dim = max(range(len(DIMENSIONS)), key=lambda i: (r[DIMENSIONS[i] + "hi"] - r[DIMENSIONS[i] + "lo"]) / full[i])
            n.lo, n.hi = r[DIMENSIONS[n.dim] + "lo"], r[DIMENSIONS[n.dim] + "hi"]
            n.want = r["w"] * (n.shards // 2) / n.shards
        if not split:
            break
        _refine(held, split, tolerance)
        # A node is known by its first shard: the right half of a split starts a new number.
        half = {n.number: n.number + n.shards // 2 for n in split}
        rows, before, held = _next_node(rows, split), held, _next_node(held, split).persist()
        leaves = [x for n in leaves for x in ([n] if n not in split else [Node(n.number, n.shards // 2, n.number), Node(half[n.number], n.shards - n.shards // 2, half[n.number])])]
    for df in (before, held):
        if df is not None:
            df.unpersist()
    buckets = max(SLOT_PARTS, -(-(spread["n"] or 0) // (shards * SLOT_ROWS)))
    placed = rows.select("doc_id", "size", "text_crc32", F.col("_node").cast("int").alias("shard"), "_tie", F.pmod(F.xxhash64("_tie"), F.lit(buckets)).cast("int").alias("_part"))
    counts = placed.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("shard", "_part").orderBy("_tie", "doc_id")
    numbered = placed.withColumn("_i", F.row_number().over(within) - 1)
    return numbered.join(bases, ["shard", "_part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_base") + F.col("_i")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
