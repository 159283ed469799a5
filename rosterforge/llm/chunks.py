"""BPE encoding by content-defined chunks, with chunk joins repaired, and decoding by table.

A rolling hash over the bytes cuts texts where their content says so, so that passages that
documents share give the same chunks wherever they stand.  A chunk is encoded once in a
worker and found again by its bytes.  Its first and last words are cut at arbitrary bytes;
around each join a window of whole words is encoded anew and has to agree with the ids of
the words on both sides, else the two chunks become one and the text is tried again.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import byte_slices, row_slices
from rosterforge.llm.tokens import SLICE_BYTES, Encoder

#: One position in 2 ** CUT_BITS may be a cut; a chunk has LEAST bytes at least, more than the hash looks back on.
CUT_BITS, WINDOW, LEAST = 9, 32, 64
#: Bytes of chunks and ids that a worker remembers before it starts anew.
REMEMBERED = 32 << 20
_GEAR = np.random.default_rng(32).integers(0, 1 << 32, 256, dtype=np.uint32)
_PARTS_WORDS = np.isin(np.arange(256), list(b" \t\n\r"))  # no match of the pattern, mark or composed character holds one


def rolling_hash(raw: np.ndarray) -> np.ndarray:
    """For each byte a hash of it and the 31 before it (sum of gear values, each shifted by its distance)."""
    h, k = _GEAR[raw], 1
    while k < WINDOW:
        h[k:] += h[:-k] << np.uint32(k)
        k *= 2
    return h


def cut_texts(raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> list[list[int]]:
    """Where the chunks of each text start, and its end; every chunk holds two of ``breaks`` at least, or is the only one."""
    places = np.flatnonzero(rolling_hash(raw)[:-1] >> np.uint32(32 - CUT_BITS) == 0) + 1
    places = places[(raw[places] & 0xC0) != 0x80]
    before = np.searchsorted(breaks, places).tolist()
    at = np.searchsorted(places, offsets)
    ends = np.searchsorted(breaks, offsets).tolist()
    places, offsets, out = places.tolist(), offsets.tolist(), []
    for d, (start, end) in enumerate(zip(offsets, offsets[1:])):
        cuts, seen, total = [start], ends[d], ends[d + 1]
        for i in range(at[d], at[d + 1]):
            if places[i] - cuts[-1] >= LEAST and before[i] - seen > 1 and total - before[i] > 1:
                cuts.append(places[i])
                seen = before[i]
        out.append([*cuts, end])
    return out


class _Chunk:
    """A chunk between its first and last break: ids of what lies between, and of the first and last word there."""

    __slots__ = ("head", "tail", "first", "last", "ids", "first_ids", "last_ids")


class ChunkEncoder:
    """Ids of whole texts, those of one library call over each."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.known, self.held, self.merged = encoder, {}, 0, 0

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        return self.encoder.encode(pa.array(texts, pa.binary()).cast(pa.string()))[0].to_pylist()

    def _learn(self, texts: list[bytes]) -> None:
        new = [t for t in dict.fromkeys(texts) if t not in self.known]
        made, bodies, firsts, lasts = [], [], [], []
        for t in new:
            c, at = _Chunk(), np.flatnonzero(_PARTS_WORDS[np.frombuffer(t, np.uint8)])
            low, high = int(at[0]), int(at[-1])
            c.head, c.tail = t[:low], t[high + 1 :]
            c.first, c.last = t[low + 1 : int(at[1])], t[int(at[-2]) + 1 : high]
            made.append(c)
            bodies.append(t[low + 1 : high])
            firsts.append(c.first)
            lasts.append(c.last)
        ids, n = self._ids(bodies + firsts + lasts) if new else [], len(new)
        for i, (t, c) in enumerate(zip(new, made, strict=True)):
            c.ids, c.first_ids, c.last_ids = ids[i], ids[n + i], ids[2 * n + i]
            self.known[t] = c
            self.held += 400 + len(t) + len(c.ids)

    def _windows(self, chunks: list[_Chunk]) -> list[bytes]:
        """The words around each join, from whole word to whole word; the ends of the text are joins too."""
        inner = [b"%b %b%b %b" % (a.last, a.tail, b.head, b.first) for a, b in zip(chunks, chunks[1:])]
        return [chunks[0].head + b" " + chunks[0].first, *inner, chunks[-1].last + b" " + chunks[-1].tail]

    def _joined(self, chunks: list[_Chunk], windows: list[bytes]) -> tuple[list[bytes], int]:
        """(the parts of the ids, -1), or the first join whose window does not agree with its neighbours."""
        parts, before = [], b""
        for k, w in enumerate(windows):
            after = chunks[k].first_ids if k < len(chunks) else b""
            if len(w) < len(before) + len(after) or not (w.startswith(before) and w.endswith(after)):
                return [], k
            parts.append(w[len(before) : len(w) - len(after)])
            if k < len(chunks):
                parts.append(chunks[k].ids)
                before = chunks[k].last_ids
        return parts, -1

    def _repaired(self, texts: list[bytes]) -> bytes:
        """Merges chunks around joins that do not agree, until all do or the text is one piece."""
        while True:
            self._learn(texts)
            chunks = [self.known[t] for t in texts]
            parts, k = self._joined(chunks, self._ids(self._windows(chunks)))
            if k < 0:
                return b"".join(parts)
            self.merged += 1
            if len(texts) == 1:
                return self._ids(texts)[0]
            k = min(max(k, 1), len(texts) - 1)
            texts = [*texts[: k - 1], texts[k - 1] + texts[k], *texts[k + 1 :]]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Raw little-endian ids of each text; null texts count as empty."""
        if self.held > REMEMBERED:
            self.known, self.held = {}, 0
        texts = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        data = b"".join(texts)
        raw = np.frombuffer(data, np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        breaks = np.flatnonzero(_PARTS_WORDS[raw])
        few = np.diff(np.searchsorted(breaks, offsets)) < 2
        pieces = [[] if f else [data[a:b] for a, b in zip(c, c[1:])] for c, f in zip(cut_texts(raw, offsets, breaks), few.tolist(), strict=True)]
        self._learn([t for p in pieces for t in p])
        chunks = [[self.known[t] for t in p] for p in pieces]
        windows = [self._windows(c) if c else [t] for c, t in zip(chunks, texts, strict=True)]
        ids, at, out = self._ids([w for ws in windows for w in ws]), 0, []
        for d, (c, ws) in enumerate(zip(chunks, windows, strict=True)):
            parts, wrong = self._joined(c, ids[at : at + len(ws)]) if c else (ids[at : at + 1], -1)
            out.append(b"".join(parts) if wrong < 0 else self._repaired(pieces[d]))
            at += len(ws)
        return out


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(Encoder(path, lower_case=True))


def encode_chunks(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) and with ``decode`` also ``decoded`` for every row, equal to one call of the library over each whole text, without special tokens added.

    ``path`` holds a vocabulary that writes small letters and drops white space.
    Null and empty texts give no ids; texts of any length are taken whole; repeated rows
    give repeated results; an empty table gives none; other columns are ignored.  Nothing is
    shuffled: each worker remembers the chunks that it has met, up to REMEMBERED bytes.
    """

    def encode(batches):
        enc = chunk_encoder(path)
        for b in byte_slices(batches, 1, SLICE_BYTES):
            raw = enc.encode(b.column(1))
            size = enc.encoder.kind.itemsize
            flat = np.frombuffer(b"".join(raw), enc.encoder.kind).astype(np.int32)
            offsets = np.cumsum([0, *(len(r) // size for r in raw)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), ids, *([_spelt(ids, path)] if decode else [])], names=["doc_id", "ids", "decoded"][: 2 + decode])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(encode, "doc_id long, ids array<int>" + ", decoded string" * decode)


@lru_cache(maxsize=2)
def _tokens(path: str) -> tuple[pa.Array, np.ndarray]:
    from tokenizers import Tokenizer

    names = {i: t for t, i in Tokenizer.from_file(path).get_vocab(with_added_tokens=True).items()}
    known = np.isin(np.arange(max(names) + 1), list(names))
    return pa.array([names.get(i, "") for i in range(len(known))], pa.string()), known


def _spelt(lists: pa.ListArray, path: str) -> pa.Array:
    names, known = _tokens(path)
    lists = lists.fill_null([])
    ids, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    good = (ids >= 0) & (ids < len(known))
    good &= known[np.where(good, ids, 0)]
    offsets = np.append(0, np.cumsum(good))[offsets].astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names.take(pa.array(ids[good]))), " ")


def decode_tokens(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded`` to (doc_id, ids): for a vocabulary without a decoder, as the library joins the tokens by spaces, special ones too.

    Ids that the vocabulary lacks are left out; null ids give an empty text.
    """

    def decode(batches):
        for b in row_slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _spelt(b.column(1), path)], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, decoded string")
