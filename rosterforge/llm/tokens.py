"""Tokenising inside Arrow tasks: words by Arrow, pieces by pattern, each new piece once through the tokenizers library."""

from __future__ import annotations

import codecs
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import byte_slices

#: Pieces a worker remembers before it starts anew; bounds its memory (about 200 bytes each).
PIECES = 400_000
#: New pieces that share one call of the library, and words cut into pieces at once.
JOINED, WORDS = 20_000, 50_000
#: Text taken at once.
SLICE_BYTES = 4 << 20

# The patterns by which the two kinds of vocabulary part a text before their merges.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOWER_CASE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Words that the library gets whole: empty ones, those with white space at an end, and those with a character beyond plain
#: Latin and Cyrillic letters and punctuation, whose class, composition or small letter is not looked up here.
_ODD = r"^\s|\s$|^$|[^\t-\r\x21-\x7e\x{a1}-\x{12f}\x{131}-\x{24f}\x{400}-\x{481}\x{48a}-\x{52f}\x{2010}-\x{2027}\x{2030}-\x{205e}]"
_NUL = chr(256)  # what byte-level vocabularies write for the byte 0


def _byte_table() -> str:
    """The character that byte-level vocabularies write for each byte: itself where it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return "".join(chr(b if b in prints else next(others)) for b in range(256))


class _Rows(dict):
    """Piece -> number of its row; new ones are noted in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = row = len(self)
        self.fresh.append(piece)
        return row


class Encoder:
    """Ids of whole texts, the same as one call of the tokenizers library over each.

    Texts are parted at single spaces, where no match of the pattern goes on; the distinct
    words of a batch are parted by the pattern; the distinct pieces, of which there are far
    fewer than words, go through the library's merges once.  Texts where a space stands
    between white space, or with the marks of special tokens, go through the library whole.
    """

    def __init__(self, path: str, lower_case: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # The same merges over pieces that are parted and written in the vocabulary's characters already.
        self.merges = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}))
        (self.mark,) = self.merges.encode(_NUL, add_special_tokens=False).ids
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.lower_case = lower_case
        # A space before the first piece of a word tells words apart; the lower-case vocabulary has no use for it.
        self.pattern = regex.compile(f" ?(?:{LOWER_CASE})" if lower_case else BYTE_LEVEL)
        self.table = _byte_table()
        self.forget()

    def forget(self) -> None:
        self.rows, self.wholes = _Rows(), {}
        self.flat, self.held = np.zeros(1 << 16, self.kind), 0
        self.start, self.size, self.begins = (np.zeros(1 << 14, k) for k in (np.int64, np.int64, bool))

    def whole(self, text: str) -> bytes:
        """The library's ids of a text."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _whole_words(self, words: list[str]) -> list[bytes]:
        for w in words:
            if w not in self.wholes:
                self.wholes[w] = self.whole(w)
        return [self.wholes[w] for w in words]

    def _learn(self) -> None:
        """Gives every new piece its row: where its ids start in ``flat``, how many, and whether it begins a word."""
        fresh, self.rows.fresh = self.rows.fresh, []
        first = len(self.rows) - len(fresh)
        while len(self.start) < len(self.rows):
            self.start, self.size, self.begins = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size, self.begins))
        for lo in range(0, len(fresh), JOINED):
            some = fresh[lo : lo + JOINED]
            text = codecs.charmap_decode("\0".join(some).encode(), "strict", self.table)[0]
            if self.lower_case:
                text = text.replace(self.table[32], "")
            ids = np.array(self.merges.encode_batch_fast([text.replace(_NUL, f" {_NUL} ")], add_special_tokens=False)[0].ids, self.kind)
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(some) - 1:
                raise ValueError("the vocabulary does not keep pieces apart")
            while len(self.flat) < self.held + len(ids):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.held : self.held + len(ids)] = ids
            at = slice(first + lo, first + lo + len(some))
            starts = np.concatenate([[0], cuts + 1])
            self.start[at], self.size[at] = self.held + starts, np.append(cuts, len(ids)) - starts
            self.begins[at] = np.fromiter((p[0] == " " for p in some), bool, len(some))
            self.held += len(ids)

    def _look_up(self, pieces: list[str]) -> np.ndarray:
        rows = np.fromiter(map(self.rows.__getitem__, pieces), np.int64, len(pieces))
        self._learn()
        return rows

    def _spell(self, rows: np.ndarray, first: np.ndarray) -> pa.Array:
        """The ids of words, given the rows of all their pieces and where each word's pieces start."""
        size = self.size[rows]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[rows] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        offsets = np.append(0, ends)[np.append(first, len(rows))] * self.kind.itemsize
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)])

    def _plain_words(self, words: pa.Array) -> list[pa.Array]:
        """Ids of words that each follow a space."""
        out = []
        for lo in range(0, len(words), WORDS):
            some = words.slice(lo, WORDS)
            text = " " + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), " ")[0].as_py()
            rows = self._look_up(self.pattern.findall(text.lower() if self.lower_case else text))
            first = np.flatnonzero(self.begins[rows])
            if len(first) != len(some):
                raise ValueError("the pattern does not keep words apart")
            out.append(self._spell(rows, first))
        return out

    def _heads(self, heads: list[str], odd: np.ndarray) -> list[pa.Array]:
        """Ids of words that no space stands before."""
        found = [[] if o else self.pattern.findall(w) for w, o in zip(heads, odd.tolist(), strict=True)]
        n = np.fromiter(map(len, found), np.int64, len(found))
        out = self._spell(self._look_up([p for ps in found for p in ps]), np.cumsum(n) - n)
        at = np.flatnonzero(odd)
        if not len(at):
            return [out]
        order = np.arange(len(heads))
        order[at] = len(heads) + np.arange(len(at))
        return [pa.concat_arrays([out, pa.array(self._whole_words([heads[i] for i in at.tolist()]), pa.binary())]).take(pa.array(order))]

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[pa.Array, np.ndarray]:
        """(raw ids of each text, followed by ``end_id``; how many).  Null texts count as empty."""
        if len(self.rows) + len(self.wholes) > PIECES:
            self.forget()
        texts = texts.fill_null("")
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        words, index = coded.dictionary, coded.indices.to_numpy()
        first = split.offsets.to_numpy() - split.offsets[0].as_py()
        odd = pc.match_substring_regex(words, _ODD).to_numpy(zero_copy_only=False)
        odd_words = words.filter(pa.array(odd)).to_pylist()
        place = np.zeros(len(words), np.int64)
        place[~odd], place[odd] = np.arange(len(words) - len(odd_words)), len(words) - len(odd_words) + np.arange(len(odd_words))
        tables = self._plain_words(words.filter(pa.array(~odd)))
        tables.append(pa.array(self._whole_words(odd_words if self.lower_case else [" " + w for w in odd_words]), pa.binary()))
        cells = place[index]
        alone = self._alone(index, first, words, odd, odd_words)
        if not self.lower_case:
            at = index[first[:-1]]
            cells[first[:-1]] = len(words) + np.arange(len(texts))
            tables += self._heads(words.take(pa.array(at)).to_pylist(), odd[at])
        if end_id is not None:
            cells = np.insert(cells, first[1:], sum(map(len, tables)))
            tables.append(pa.array([np.array([end_id], self.kind).tobytes()], pa.binary()))
            first = first + np.arange(len(first))
        spelt = pa.concat_arrays(tables).take(pa.array(cells))
        offsets = np.frombuffer(spelt.buffers()[1], np.int32)[spelt.offset :][first] if len(cells) else np.zeros(len(first), np.int32)
        out = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(offsets)), spelt.buffers()[2]])
        if len(alone):
            end = b"" if end_id is None else np.array([end_id], self.kind).tobytes()
            order = np.arange(len(texts))
            order[alone] = len(texts) + np.arange(len(alone))
            out = pa.concat_arrays([out, pa.array([self.whole(t) + end for t in texts.take(pa.array(alone)).to_pylist()], pa.binary())]).take(pa.array(order))
        return out, pc.binary_length(out).to_numpy().astype(np.int64) // self.kind.itemsize

    def _alone(self, index: np.ndarray, first: np.ndarray, words: pa.Array, odd: np.ndarray, odd_words: list[str]) -> np.ndarray:
        """Texts that must go through the library whole."""
        special = pc.match_substring(words, "<|").to_numpy(zero_copy_only=False)
        hit = special[index] if special.any() else np.zeros(len(index), bool)
        if not self.lower_case and odd_words:
            opens, closes = np.zeros(len(words), bool), np.zeros(len(words), bool)
            opens[odd] = [not w or w[0].isspace() for w in odd_words]
            closes[odd] = [not w or w[-1].isspace() for w in odd_words]
            between = closes[index[:-1]] & opens[index[1:]]
            heads = first[1:-1] - 1
            between[heads[heads < len(between)]] = False
            hit[1:] |= between
        return np.unique(np.searchsorted(first, np.flatnonzero(hit), "right") - 1)


@lru_cache(maxsize=2)
def encoder(path: str, lower_case: bool) -> Encoder:
    return Encoder(path, lower_case)


def token_rows(docs: DataFrame, path: str, end_id: int, lower_case: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: part, part_start (ids before it in its task), n, ids.

    ``ids`` holds raw little-endian ids (two bytes each where the vocabulary allows)
    and ends with ``end_id``.  A null text counts as empty and gives just that id.
    Very long texts are taken one at a time, whole.  ``part`` numbers the task; rows of a
    retried task come out the same.
    """

    def encode(batches):
        enc, at, part = encoder(path, lower_case), 0, TaskContext.get().partitionId()
        for b in byte_slices(batches, 1, SLICE_BYTES):
            ids, n = enc.encode(b.column(1), end_id)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), pa.array(n), ids, pa.array(np.full(len(ids), enc.kind.itemsize, np.int32))],
                names=["doc_id", "part", "part_start", "n", "ids", "id_bytes"],
            )

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(encode, "doc_id long, part int, part_start long, n long, ids binary, id_bytes int")


def ids_of(raw: bytes, id_bytes: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if id_bytes == 2 else "<u4")
