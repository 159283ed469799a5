"""Phrase collocations: SPAM-style position bitmaps per shard, sums over shards, exact scores.

A shard is a run of words of one language with their positions; borders of pieces take a
position of their own, so that no phrase crosses them.  Each word has a bitmap over the
positions, kept as its non-zero 64-bit parts.  A phrase is extended by shifting its bitmap one
place, with carry, and ANDing it with a word's; the set bits are its occurrences.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterforge.llm.common import byte_slices, parts, stage

LEAST, LONGEST, TOP, COVERED, SCALE = 30, 4, 2000, 80, 2_000_000
#: Words of a shard, and words that a task holds back over all languages.
SHARD_WORDS, HELD_WORDS = 1 << 22, 1 << 23
#: Words of the first position that are extended at once, depth first.
GROUP = 1 << 20
SLICE_BYTES = 8 << 20
WORD, SPACE, BORDER = range(3)
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(b" \t")] = SPACE
_KINDS[list(b".,;:!?\n\x0b\x0c\r")] = BORDER


def split_words(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """(words, steps): a word's step is 1 where it follows the one before in the same piece, else 2."""
    kinds = _KINDS[np.frombuffer(text, np.uint8)]
    is_word = np.concatenate([[False], kinds == WORD, [False]])
    edges = np.flatnonzero(is_word[1:] != is_word[:-1])
    starts, ends = edges[::2], edges[1::2]
    sizes = np.concatenate([[0], np.cumsum(ends - starts)])
    letters = np.frombuffer(text, np.uint8)[is_word[1:-1]]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letters)))
    borders = np.concatenate([[0], np.cumsum(kinds == BORDER)])[starts]
    steps = np.ones(len(starts), np.int8)
    steps[1:] += borders[1:] != borders[:-1]
    steps[:1] = 2
    return words, steps


class _Index:
    """Words of a shard by code, their positions, and the non-zero 64-bit parts of every word's bitmap."""

    def __init__(self, codes: np.ndarray, steps: np.ndarray, own: int):
        self.codes, self.own = codes.astype(np.int64), own
        self.at = np.cumsum(steps.astype(np.int64))
        self.block = self.at >> 6
        self.blocks = int(self.block[-1]) + 2 if len(codes) else 2
        self.bit = np.uint64(1) << (self.at & 63).astype(np.uint64)
        key = self.codes * self.blocks + self.block
        order = np.argsort(key, kind="stable")
        first = _first(key[order])
        self.bits = np.bitwise_or.reduceat(self.bit[order], first) if len(codes) else self.bit
        self.part = np.empty(len(codes), np.int64)
        self.part[order] = np.cumsum(np.isin(np.arange(len(codes)), first)) - 1 if len(codes) else 0

    def bitmaps(self, group: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, parts) of the bitmaps of the words at ``places``, given their groups in order."""
        key = group * self.blocks + self.block[places]
        order = np.argsort(key, kind="stable")
        first = _first(key[order])
        return key[order][first], np.bitwise_or.reduceat(self.bit[places][order], first) if len(first) else self.bit[:0]

    def extend(self, keys, bits, group, places):
        """Phrases one word longer.  ``keys`` and ``bits`` are the parts of the bitmaps of the phrases so far, ``group`` and
        ``places`` the phrase and last word of each occurrence.  Gives (parent, word, count) per phrase, its bitmaps, and
        the same two of its occurrences."""
        more = places + 1 < len(self.at)
        more[more] = self.at[places[more] + 1] == self.at[places[more]] + 1
        group, places = group[more], places[more] + 1
        # Which parts of which word's bitmap can meet which phrase: each such triple is ANDed once.
        pair = group * (int(self.codes.max()) + 1 if len(self.codes) else 1) + self.codes[places]
        key = pair * self.blocks + self.block[places] if len(pair) and int(pair.max()) < (1 << 62) // self.blocks else None
        order = np.argsort(key, kind="stable") if key is not None else np.lexsort((self.block[places], pair))
        group, places, pair = group[order], places[order], pair[order]
        new_pair, new_block = _changes(pair), _changes(self.block[places])
        at = np.flatnonzero(new_pair | new_block)
        here = group[at] * self.blocks + self.block[places[at]]
        shifted = (_look_up(keys, bits, here) << np.uint64(1)) | (_look_up(keys, bits, here - 1, self.block[places[at]] > 0) >> np.uint64(63))
        both = shifted & self.bits[self.part[places[at]]]
        starts = np.flatnonzero(new_pair[at])
        counts = np.add.reduceat(np.bitwise_count(both).astype(np.int64), starts) if len(at) else np.zeros(0, np.int64)
        child = np.cumsum(new_pair) - 1
        heads = at[starts]
        return (group[heads], self.codes[places[heads]], counts), child[at] * self.blocks + self.block[places[at]], both, child, places


def _first(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(_changes(ordered))


def _changes(x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    out[1:] = x[1:] != x[:-1]
    return out


def _look_up(keys, bits, wanted, valid=True) -> np.ndarray:
    """The bitmap parts under ``wanted`` keys, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted), np.uint64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted) & valid, bits[at], np.uint64(0))


def phrases(index: _Index, pairs: np.ndarray | None):
    """Yields (codes per phrase, counts) of a shard, depth first over groups of first words.

    Without ``pairs`` of all phrases of two words; with the sorted codes (first << 32 | second)
    of those that are frequent everywhere, of all phrases of three and four words made of them.
    """
    firsts = np.argsort(index.codes[: index.own], kind="stable")
    cuts = _first(index.codes[firsts])
    lo = 0
    while lo < len(firsts):
        # Whole groups of equal first words, about GROUP occurrences at once.
        after = np.searchsorted(cuts, lo + GROUP)
        hi = int(cuts[after]) if after < len(cuts) else len(firsts)
        places = np.sort(firsts[lo:hi])
        lo = hi
        word, group = np.unique(index.codes[places], return_inverse=True)
        made, (keys, bits) = [word], index.bitmaps(group, places)
        for size in range(2, LONGEST + 1 if pairs is not None else 3):
            (parent, last, counts), keys, bits, group, places = index.extend(keys, bits, group, places)
            made = [c[parent] for c in made] + [last]
            if pairs is not None:
                # Only phrases whose last two words are a frequent pair go on.
                good = np.isin(made[-2] << 32 | made[-1], pairs, kind="sort") if len(parent) else np.zeros(0, bool)
                number = np.cumsum(good) - 1
                stays = good[group]
                group, places = number[group[stays]], places[stays]
                kept = good[keys // index.blocks]
                keys, bits = number[keys[kept] // index.blocks] * index.blocks + keys[kept] % index.blocks, bits[kept]
                made, counts = [c[good] for c in made], counts[good]
            if len(counts) and (pairs is None or size > 2):
                yield made, counts


_SHARD = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("codes", pa.binary()), ("steps", pa.binary()), ("own", pa.int64())])


def _shards(batches, shard_words: int):
    """(lang, text) -> shards.  A shard's last words, those beyond ``own``, are the next one's first."""
    shard, held = TaskContext.get().partitionId() << 32, {}

    def put_out(lang, at_most, rest):
        nonlocal shard
        words, steps = pa.chunked_array([w for w, _ in held[lang]]).combine_chunks(), np.concatenate([s for _, s in held[lang]])
        if isinstance(words, pa.ChunkedArray):
            words = pa.concat_arrays(words.chunks)
        lo = 0
        while lo < len(words) and (len(words) - lo > at_most or not rest):
            coded = words.slice(lo, at_most + LONGEST - 1).dictionary_encode()
            own = min(at_most, len(words) - lo)
            codes = coded.indices.to_numpy().astype("<i4")
            yield pa.RecordBatch.from_pylist([{"shard": shard, "lang": lang, "words": coded.dictionary.to_pylist(), "codes": codes.tobytes(), "steps": steps[lo : lo + len(codes)].tobytes(), "own": own}], schema=_SHARD)
            shard, lo = shard + 1, lo + own
        held[lang] = [(words.slice(lo), steps[lo:])]

    for b in byte_slices(batches, 1, SLICE_BYTES):
        for lang in pc.unique(b.column(0)).to_pylist():
            some = b.filter(pc.equal(b.column(0), lang)).column(1)
            text = pc.ascii_lower(some).cast(pa.binary()).to_pylist()
            held.setdefault(lang, []).append(split_words(b"\n".join(text)))
            if sum(len(w) for w, _ in held[lang]) >= shard_words + LONGEST:
                yield from put_out(lang, shard_words, True)
        if sum(len(w) for ws in held.values() for w, _ in ws) > HELD_WORDS:
            for lang in list(held):
                yield from put_out(lang, shard_words, False)
            held.clear()
    for lang in list(held):
        yield from put_out(lang, shard_words, False)


def _shard_rows(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield {f: b.column(k)[i] for k, f in enumerate(b.schema.names)}


def _index_of(row) -> tuple[_Index, pa.Array]:
    codes, steps = (np.frombuffer(row[c].as_buffer(), t) for c, t in (("codes", "<i4"), ("steps", np.int8)))
    return _Index(codes, steps, row["own"].as_py()), row["words"].values


def _spelt(words: pa.Array, codes: list[np.ndarray]) -> pa.Array:
    out = words.take(pa.array(codes[0]))
    for c in codes[1:]:
        out = pc.binary_join_element_wise(out, words.take(pa.array(c)), " ")
    return out


_OUT_ROWS = 1 << 17


def _sliced(batch: pa.RecordBatch):
    for lo in range(0, batch.num_rows, _OUT_ROWS):
        yield batch.slice(lo, _OUT_ROWS)


def _words(batches):
    for row in _shard_rows(batches):
        codes = np.frombuffer(row["codes"].as_buffer(), "<i4")[: row["own"].as_py()]
        words = row["words"].values
        n = np.bincount(codes, minlength=len(words))
        batch = pa.RecordBatch.from_arrays([pa.array([row["lang"].as_py()] * len(words), pa.string()), words, pa.array(n)], names=["lang", "phrase", "n"])
        yield from _sliced(batch.filter(pa.array(n > 0)))


def _pairs(batches):
    for row in _shard_rows(batches):
        index, words = _index_of(row)
        beyond = np.arange(index.own, len(index.at) - 1)
        beyond = beyond[index.at[beyond + 1] == index.at[beyond] + 1]
        # Pairs beyond the own words count for nothing here, but longer phrases run into them.
        for made, counts in chain(phrases(index, None), [([index.codes[beyond], index.codes[beyond + 1]], np.zeros(len(beyond), np.int64))]):
            n, lang, shard = len(counts), row["lang"].as_py(), row["shard"].as_py()
            yield from _sliced(pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), _spelt(words, made), pa.array(np.full(n, shard)), pa.array(made[0] << 32 | made[1]), pa.array(counts)], names=["lang", "phrase", "shard", "pair", "n"]))


def _longer(batches):
    """Rows (shard, pair) and then the shard itself -> its phrases of three and four words."""
    shard, pairs = None, []
    for b in batches:
        for lo, hi in _runs(b):
            if b.column(2)[lo].is_valid:  # the shard's own row, after its pairs
                row = {f: b.column(k)[lo] for k, f in enumerate(b.schema.names)}
                if shard == row["shard"].as_py():
                    index, words = _index_of(row)
                    for made, counts in phrases(index, np.sort(np.concatenate(pairs))):
                        lang = pa.array([row["lang"].as_py()] * len(counts), pa.string())
                        yield from _sliced(pa.RecordBatch.from_arrays([lang, _spelt(words, made), pa.array(np.full(len(counts), len(made))), pa.array(counts)], names=["lang", "phrase", "size", "n"]))
                shard, pairs = None, []
            else:
                if shard != (shard := b.column(0)[lo].as_py()):
                    pairs = []
                pairs.append(b.column(1).slice(lo, hi - lo).to_numpy())


def _runs(b: pa.RecordBatch):
    """Row ranges of a batch: pairs of one shard together, a shard's own row alone."""
    own = b.column(2).is_valid().to_numpy(zero_copy_only=False)
    new = _changes(b.column(0).to_numpy()) | own
    new[1:] |= own[:-1]
    starts = np.flatnonzero(new)
    return zip(starts.tolist(), [*starts[1:].tolist(), b.num_rows])


def count_phrases(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text", shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): (lang, phrase, f) of every word, and (lang, phrase, size, f) of phrases of 2 to 4 words with f >= ``least``.

    Pairs are counted first and summed over all shards; each shard gets back which of its own
    pairs are frequent, and extends only these.  A null text is empty, a null lang is ``und``.
    No word list or phrase list is held by the driver or sent to all tasks.
    """
    spark, n = docs.sparkSession, parts(docs)
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kinds = "shard long, lang string, words array<string>, codes binary, steps binary, own long"
    shards = stage(src.mapInArrow(lambda b: _shards(b, shard_words), kinds), "shards")
    words = shards.select("lang", "words", "codes", "own").mapInArrow(_words, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    local = shards.mapInArrow(_pairs, "lang string, phrase string, shard long, pair long, n long")
    everywhere = F.sum("n").over(Window.partitionBy("phrase", "lang"))
    frequent = stage(local.withColumn("f", everywhere).filter(F.col("f") >= least).select("lang", "phrase", "shard", "pair", "f"), "pairs")
    two = frequent.groupBy("lang", "phrase").agg(F.first("f").alias("f")).select("lang", "phrase", F.lit(2).cast("long").alias("size"), "f")
    none = F.lit(None)
    wanted = frequent.select("shard", "pair", none.cast("string").alias("lang"), none.cast("array<string>").alias("words"), none.cast("binary").alias("codes"), none.cast("binary").alias("steps"), none.cast("long").alias("own"), F.lit(0).alias("kind"))
    both = wanted.unionByName(shards.withColumns({"pair": none.cast("long"), "kind": F.lit(1)}))
    few = max(n, shards.count() // 8)
    longer = both.repartition(few, "shard").sortWithinPartitions("shard", "kind").drop("kind").mapInArrow(_longer, "lang string, phrase string, size long, n long")
    longer = longer.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    return words, two.unionByName(longer.select(*two.columns))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, **options) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to 4 words with a = f(phrase) >= ``least``.  Cut after its
    first words, a phrase has l = f(first part), r = f(rest) and the score
    floor(2000000 a / (l + r)); its lowest-scoring cut counts, the earliest among equals.  A
    candidate goes if a longer one that holds its words has ``covered`` percent of its count.
    Empty tables and texts give no rows; repeated rows count each time; other columns are ignored.
    """
    words, grams = count_phrases(docs, least, **options)
    grams = stage(grams, "phrases")
    # One row of counts for single words that stand in a pair, and for all longer phrases.
    split = lambda c: F.split(c, " ")
    of_pairs = grams.filter("size = 2").select("lang", F.explode(split("phrase")).alias("phrase")).distinct()
    words = stage(words, "words")
    known = words.join(of_pairs, ["lang", "phrase"], "left_semi").unionByName(grams.select("lang", "phrase", "f"))

    join = lambda w, lo, n: F.array_join(F.slice(w, lo, n), " ")
    w = F.col("w")
    cuts = grams.withColumn("w", split("phrase")).select("lang", "phrase", "size", "f", "w", F.explode(F.sequence(F.lit(1), F.col("size").cast("int") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", join(w, 1, F.col("k")).alias("left"), join(w, F.col("k") + 1, F.col("size").cast("int") - F.col("k")).alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    score = F.expr(f"CAST((CAST(a AS DECIMAL(20, 0)) * {SCALE}) DIV (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut"))

    pieces = [F.struct(join(F.col("w"), lo, F.lit(size)).alias("phrase"), (lo + size - 1 <= F.col("size")).alias("fits")) for size in range(2, LONGEST) for lo in map(F.lit, range(1, LONGEST - size + 2))]
    held = grams.filter("size > 2").withColumn("w", split("phrase")).select("lang", "size", "f", F.explode(F.array(*pieces)).alias("p"), F.col("phrase").alias("whole"))
    held = held.filter("p.fits AND p.phrase <> whole").groupBy("lang", F.col("p.phrase").alias("phrase")).agg(F.max("f").alias("most"))
    percent = lambda c: F.col(c).cast("decimal(20,0)")
    left = best.join(held, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (100 * percent("most") < covered * percent("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[.,;:!?\n\x0B\x0C\r]')), '[^ \t]+') AS w
  FROM documents),
grams AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: list_aggregate(w[i : i + size - 1], 'string_agg', ' '))) AS phrase
    FROM pieces, (VALUES (1), (2), (3), (4)) AS s(size))
  GROUP BY ALL),
candidates AS (SELECT * FROM grams WHERE size > 1 AND f >= {LEAST}),
parts AS (SELECT *, string_split(phrase, ' ') AS w FROM candidates),
parted AS (
  SELECT lang, phrase, f AS a, k, list_aggregate(w[1 : k], 'string_agg', ' ') AS lefts, list_aggregate(w[k + 1 : size], 'string_agg', ' ') AS rights
  FROM parts, (VALUES (1), (2), (3)) AS c(k) WHERE k < size),
known AS (SELECT * FROM grams WHERE f >= {LEAST}),
cuts AS (
  SELECT p.lang, p.phrase, p.a, p.k, x.f AS l, y.f AS r, CAST(({SCALE}::HUGEINT * p.a) // (x.f + y.f) AS BIGINT) AS score
  FROM parted p JOIN known x ON x.lang = p.lang AND x.phrase = p.lefts JOIN known y ON y.lang = p.lang AND y.phrase = p.rights),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT p.lang, p.f, list_aggregate(w[i : i + size2 - 1], 'string_agg', ' ') AS phrase
    FROM parts p, (VALUES (2), (3)) AS t(size2), (VALUES (1), (2), (3)) AS u(i)
    WHERE size2 < p.size AND i + size2 - 1 <= p.size)
  GROUP BY ALL),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
  WHERE h.most IS NULL OR 100 * h.most < {COVERED} * b.a)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score
FROM ranked r JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang) n ON n.lang = r.lang
WHERE r.rank <= {TOP}
"""
