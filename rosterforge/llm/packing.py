"""Packing by concatenate and cut: global offsets from partition totals, then fixed windows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import row_slices, running_bases, stage
from rosterforge.llm.tokens import ids_of, token_rows

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = 1024, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents' ids end to end, cut every ``window`` ids: one row per piece.

    First pass: every task tokenises its documents, notes each one's start within the
    task and writes the ids.  The totals of the tasks give each task its place in the
    whole.  Second pass: every document is cut where a window ends.  A window that
    spans two documents, or two tasks, has a boundary record (piece) from each.

    Null texts count as empty: one id, ``end_id``.  Repeated rows are packed again; an
    empty table gives no pieces; a very long text gives many pieces; only the last window
    can hold fewer than ``window`` ids.
    ``ids`` (raw little-endian 32-bit) is null unless ``with_ids``.
    """
    tokens = stage(token_rows(docs, tokenizer, end_id, False, id_col, text_col), "pack")
    bases = running_bases(tokens.groupBy("part").agg(F.sum("n").alias("total")), "part", "total")
    # One row per task of the first pass (about 16 bytes for 100 MB of input): the ids stay where they are.
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("at"), "ids", "id_bytes")

    def cut(batches):
        for b in row_slices(batches):
            out = [[] for _ in range(8)]
            for doc, at, raw, width in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids = ids_of(raw, width).astype("<u4")
                n = len(ids)
                edges = [at, *range((at // window + 1) * window, at + n, window), at + n]
                for lo, hi in zip(edges, edges[1:], strict=False):
                    piece = ids[lo - at : hi - at].tobytes()
                    for c, v in zip(out, (doc, lo - at, hi - lo, zlib.crc32(piece), n, lo // window, lo % window, piece if with_ids else None), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i == 7 else pa.int64()) for i, c in enumerate(out)], names=[x.split()[0] for x in PIECE.split(", ")])

    pieces = placed.mapInArrow(cut, PIECE)
    return pieces if with_ids else pieces.drop("ids")


def sequences(pieces: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_ids, ids array<int>): the packed windows, each padded to ``window``.

    A window gathers at most ``window`` ids, so every group is bounded.
    """

    def words(raw):
        return np.frombuffer(raw, "<u4").astype(np.int32)

    def fill(key, table):
        rows = sorted(zip(table.column("offset").to_pylist(), table.column("ids").to_pylist(), strict=True))
        ids = np.concatenate([words(r) for _, r in rows])
        full = np.concatenate([ids, np.full(window - len(ids), pad_id, np.int32)])
        return pa.table({"sequence_id": pa.array([key[0].as_py()], pa.int64()), "n_ids": pa.array([len(ids)], pa.int32()), "ids": pa.array([full.tolist()], pa.list_(pa.int32()))})

    return pieces.groupBy("sequence_id").applyInArrow(fill, "sequence_id long, n_ids int, ids array<int>")
