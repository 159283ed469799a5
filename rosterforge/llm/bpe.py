"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import row_slices

#: Texts longer than this many characters are split before they are encoded.
LONG_TEXT = 50_000
#: No match of the pattern holds a non-space followed by one of these, so a cut here never parts a match.
_SAFE = re.compile(r"(?<=\S)(?=[ \n\r\t])")
#: Runs of white space of so many characters go to the merges as one piece each: the pattern would go too deep into them.
LONG_RUN = 1000
_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = LONG_TEXT) -> list[str]:
    """The text in pieces of about ``size`` characters, cut only where encoding the pieces gives the ids of the whole."""
    out, at = [], 0
    while len(text) - at > size and (m := _SAFE.search(text, at + size)):
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]]


def encode_text(enc, text: str) -> list[int]:
    """The ids of one call of the library over the whole text.

    A run of white space is one match of the pattern, but for its last character where
    something follows: that one belongs to the next match or is one of its own.
    """
    runs = list(_RUN.finditer(text)) if len(text) >= LONG_RUN else []
    if not runs and len(text) <= LONG_TEXT:
        return enc.encode_ordinary(text)
    ids, at = [], 0
    for m in runs:
        end = m.end() - (m.end() < len(text))
        ids += [i for p in safe_pieces(text[at : m.start()]) for i in enc.encode_ordinary(p)]
        ids += enc._encode_single_piece(text[m.start() : end])
        at = end
    return ids + [i for p in safe_pieces(text[at:]) for i in enc.encode_ordinary(p)]


def encode_bpe(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row.  Null and empty texts give no ids; other columns are ignored; repeated rows give repeated results; an empty table gives none."""

    def encode(batches):
        enc = encoding(path, pattern)
        for b in row_slices(batches):
            ids = [encode_text(enc, t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(encode, "doc_id long, ids array<int>")


def decode_bpe(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``decoded`` (raw bytes, valid UTF-8 or not) to (doc_id, ids); null ids give no bytes."""

    def decode(batches):
        enc = encoding(path, pattern)
        for b in row_slices(batches):
            raw = [enc.decode_bytes(i or []) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, decoded binary")
