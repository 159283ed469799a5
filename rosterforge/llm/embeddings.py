"""Embedding near-dedup: cosine links found by PCA-ordered tiled comparison.

Equal vectors collapse to one representative with a weight.  Representatives are laid out
in strips along the first principal component; strips that the first component alone shows
to be out of reach are never paired.  A pair of strips is compared tile by tile: leading
components are accumulated first, the rest is bounded by the product of the suffix norms,
and a pair of vectors is dropped as soon as its cosine cannot reach the threshold.  What
is left is confirmed in double precision on the original coordinates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import parts, row_slices, stage
from rosterforge.llm.components import components, settle

#: Rows and columns of a tile: a block of products is TILE * TILE doubles (8 MB).
TILE = 1024
#: Most bytes of coordinates in a strip; more vectors make more strips.  A strip travels to each strip in its reach, so
#: the bytes moved are at most (bytes of all vectors) ** 2 / STRIP_BYTES; a task holds two strips and their rotations.
STRIP_BYTES = 32 << 20
#: Shares of the dimensions after which the bound is looked at.
STEPS = (0.2, 0.4, 0.65)
#: Slack of the bounds: products of unit vectors are off by far less.
SLACK = 1e-9


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows over their norms; scaled by a power of two first, so that nothing overflows."""
    top = np.frexp(np.abs(rows).max(axis=1))[1]
    rows = np.ldexp(rows, -top[:, None])
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def compare(x: np.ndarray, y: np.ndarray | None, basis: np.ndarray, threshold: float, wx: np.ndarray, wy: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between unit rows of ``x`` and ``y`` (of ``x`` alone where y is None).

    Returns (weight linked to each row of x then y, label of each row, rows with a link).
    """
    alone = y is None
    y, wy = (x, wx) if alone else (y, wy)
    d = x.shape[1]
    cuts = sorted({0, d, *(max(1, int(d * s)) for s in STEPS)} & set(range(d + 1)))
    px, py = x @ basis, y @ basis
    # Norms of what is left after each cut.
    suffix = lambda p: {c: np.sqrt(np.maximum(0.0, np.einsum("ij,ij->i", p[:, c:], p[:, c:]))) for c in cuts[1:-1]}
    sx, sy = suffix(px), suffix(py)
    n, m = len(x), len(y)
    total = np.zeros(n if alone else n + m)
    label = np.arange(len(total))
    touched = np.zeros(len(total), bool)
    shift = 0 if alone else n
    for i in range(0, n, TILE):
        for j in range(i if alone else 0, m, TILE):
            a, b = slice(i, i + TILE), slice(j, j + TILE)
            dots = px[a, : cuts[1]] @ py[b, : cuts[1]].T
            r = c = None
            for k, at in enumerate(cuts[1:-1]):
                if r is None:
                    r, c = np.nonzero(dots + np.outer(sx[at][a], sy[at][b]) >= threshold - SLACK)
                    part = dots[r, c]
                else:
                    near = part + sx[at][i + r] * sy[at][j + c] >= threshold - SLACK
                    r, c, part = r[near], c[near], part[near]
                if alone and i == j and k == 0:
                    upper = c > r
                    r, c, part = r[upper], c[upper], part[upper]
                nxt = cuts[k + 2]
                part = part + np.einsum("ij,ij->i", px[i + r, at:nxt], py[j + c, at:nxt])
            if r is None:
                r, c = np.nonzero(dots >= threshold - SLACK)
                if alone and i == j:
                    r, c = r[c > r], c[c > r]
            r, c = r + i, c + j
            true = np.einsum("ij,ij->i", x[r], y[c]) >= threshold
            r, c = r[true], c[true]
            if len(r):
                total += np.bincount(r, wy[c], len(total)) + np.bincount(c + shift, wx[r], len(total))
                touched[r] = touched[c + shift] = True
                settle(label, r, c + shift)
    return total, label, touched


def _principal(vectors: DataFrame, dim: int) -> np.ndarray:
    """Principal directions in falling order (columns), from second moments over all vectors.

    The sums are dim * (dim + 1) / 2 numbers, whatever the number of vectors.
    """
    upper = np.triu_indices(dim)

    def moments(batches):
        total = np.zeros((dim, dim))
        for b in row_slices(batches):
            x = np.frombuffer(b"".join(b.column(0).to_pylist()), "<f8").reshape(-1, dim)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(total[upper])], names=["cell", "v"])

    got = vectors.select("unit").mapInArrow(moments, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    matrix = np.zeros((dim, dim))
    cells = got.column("cell").to_numpy()
    matrix[upper[0][cells], upper[1][cells]] = got.column("v").to_numpy()
    matrix = matrix + np.triu(matrix, 1).T
    return np.linalg.eigh(matrix)[1][:, ::-1].copy()


def _links(reps: DataFrame, dim: int, count: int, threshold: float) -> DataFrame:
    """(node, linked weight, least node joined to in that task) from all strip pairs in reach."""
    spark = reps.sparkSession
    basis = _principal(reps, dim)
    shared = spark.sparkContext.broadcast(basis)  # dim * dim doubles

    def leading(batches):
        for b in row_slices(batches):
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), "<f8").reshape(-1, dim)
            # The jitter parts ties, so that no value can hold more than a strip.
            jitter = np.array([xxhash.xxh3_64_intdigest(str(v).encode()) for v in b.column(0).to_pylist()]) / 2.0**64 * 1e-6
            yield pa.RecordBatch.from_arrays([pa.array(x @ shared.value[:, 0] + jitter)], names=["lead"])

    strips = max(1, -(-count * dim * 8 // STRIP_BYTES), min(parts(reps) // 2, 24, count // 256))
    marks = [i / strips for i in range(1, strips)]
    leads = reps.select("node", "unit").mapInArrow(leading, "lead double")
    cuts = np.array(sorted(leads.agg(F.percentile_approx("lead", F.array(*[F.lit(m) for m in marks]), F.lit(20 * strips))).first()[0]) if marks else [])
    edges = spark.sparkContext.broadcast(cuts)  # one number per strip
    # Unit vectors whose first components are farther apart than their distance allows never link.
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-5
    lows = np.concatenate([[-np.inf], cuts])
    highs = np.concatenate([cuts, [np.inf]])
    first, last = np.searchsorted(highs, lows - reach, "left"), np.searchsorted(lows, highs + reach, "right") - 1
    span = spark.sparkContext.broadcast((first, last))

    def lay_out(batches):
        """Blobs of (nodes, weights, coordinates), one per strip and batch, for every partner strip."""
        first, last = span.value
        for b in row_slices(batches):
            node, weight = b.column(0).to_numpy(), b.column(1).to_numpy()
            x = np.frombuffer(b"".join(b.column(2).to_pylist()), "<f8").reshape(-1, dim)
            jitter = np.array([xxhash.xxh3_64_intdigest(str(v).encode()) for v in node.tolist()]) / 2.0**64 * 1e-6
            strip = np.searchsorted(edges.value, x @ shared.value[:, 0] + jitter, "right")
            own, blobs, lo, hi = [], [], [], []
            for s in np.unique(strip):
                at = strip == s
                own.append(int(s))
                blobs.append(node[at].astype("<i8").tobytes() + weight[at].astype("<i8").tobytes() + x[at].tobytes())
                lo.append(int(first[s]))
                hi.append(int(last[s]))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(blobs, pa.binary())], names=["strip", "lo", "hi", "blob"])

    def meet(key, table):
        sides: dict[int, list] = {}
        width = 16 + 8 * dim
        for s, raw in zip(table.column("strip").to_pylist(), table.column("blob").to_pylist(), strict=True):
            k = len(raw) // width
            sides.setdefault(s, []).append((np.frombuffer(raw, "<i8", k), np.frombuffer(raw, "<i8", k, 8 * k), np.frombuffer(raw, "<f8", k * dim, 16 * k).reshape(k, dim)))
        whole = {s: [np.concatenate(p) for p in zip(*v, strict=True)] for s, v in sides.items()}
        a, b = (k.as_py() for k in key)
        none = pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "joined": pa.array([], pa.int64())})
        if a not in whole or b not in whole:
            return none
        nodes, weights, x = whole[a]
        if a == b:
            total, label, touched = compare(x, None, shared.value, threshold, weights, None)
        else:
            total, label, touched = compare(x, whole[b][2], shared.value, threshold, weights, whole[b][1])
            nodes = np.concatenate([nodes, whole[b][0]])
        at = np.flatnonzero(touched)
        return pa.table({"node": pa.array(nodes[at]), "links": pa.array(np.rint(total[at]).astype(np.int64)), "joined": pa.array(nodes[label[at]])})

    blobs = reps.select("node", "weight", "unit").mapInArrow(lay_out, "strip int, lo int, hi int, blob binary")
    paired = blobs.select("strip", "blob", F.explode(F.sequence("lo", "hi")).alias("other"))
    paired = paired.select(F.least("strip", "other").alias("a"), F.greatest("strip", "other").alias("b"), "strip", "blob")
    return paired.groupBy("a", "b").applyInArrow(meet, "node long, links long, joined long")


def near_vectors(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Two vectors are linked when their cosine is ``threshold`` or more.  ``n_links`` counts
    the other rows a row is linked with, copies included; ``component_id`` is the smallest
    vec_id reachable.  Null, empty and zero vectors, vectors with null or non-finite
    components, and rows without vec_id link with nothing (their component is their own
    id).  Vectors of different lengths are never linked.  Rows that repeat a vec_id with
    different vectors count as one point of the graph.  An empty table gives an empty result.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))

    def clean(batches):
        for b in row_slices(batches):
            unit, keys, dims = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.array(v, np.float64) if i is not None and v and None not in v else np.zeros(0)
                if len(x) and np.isfinite(x).all() and x.any():
                    x = x + 0.0  # one zero only
                    unit.append(unit_rows(x[None, :])[0].astype("<f8").tobytes())
                    keys.append(xxhash.xxh3_128_digest(x.tobytes()))
                    dims.append(len(x))
                else:
                    unit.append(None), keys.append(None), dims.append(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(unit, pa.binary())], names=["vec_id", "vec_key", "dim", "unit"])

    rows = stage(src.mapInArrow(clean, "vec_id long, vec_key binary, dim int, unit binary"), "vectors")
    reps = stage(rows.filter("dim > 0").groupBy("vec_key", "dim").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("unit").alias("unit")), "vector-reps")
    found = None
    # One pass for each length of vector; a table of embeddings has one.
    for dim, count in reps.groupBy("dim").count().collect():
        more = _links(reps.filter(F.col("dim") == dim), dim, count, threshold)
        found = more if found is None else found.unionByName(more)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node long, links long, joined long")
    found = stage(found, "vector-links")
    known = stage(components(found.filter("node <> joined").select(F.col("node").alias("a"), F.col("joined").alias("b"))), "vector-components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = reps.select("vec_key", "dim", "node", "weight").join(links, "node", "left").join(known, "node", "left")
    placed = placed.select("vec_key", "dim", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    out = rows.select("vec_id", "vec_key", "dim").join(placed, ["vec_key", "dim"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


#: All pairs of usable vectors, then reachability.
ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a),
reach AS (SELECT a AS node, a AS seen FROM n UNION SELECT node, b FROM reach JOIN link ON a = seen),
comp AS (SELECT node, min(seen) AS least FROM reach GROUP BY node)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(least, vec_id) AS component_id, coalesce(least, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN comp ON node = vec_id
"""
