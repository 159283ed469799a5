"""Packing, byte-level BPE, id files and sharding: the libraries themselves, round trips and laws."""

import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex

from rosterforge.llm import bpe, huffman, packing, sharding, tokens

from .conftest import ROWS

JSON50, WORD49, MULTI = "byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"


def library_ids(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(name))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


SPACES = ["a  b", " a", "a ", "a\n b", "a \nb", "\t a", "a  b", "a 　b", "a\u0085 b", "it's  'll x", "é 日本 語", "<|endoftext|> a <|startoftext|>", "x\x1cy \x1d z", "", " ", "  ", "A B's C", "\n\n a", "a\r\n\r\nb", "1 23  456", "İstanbul ΣΑΣ Σ", "e\u0301 é", "x_y __ _a 3²", "a\0b \0", "ǅ Ǆ ŉ Ж жЁ", "don't 'S \n'll"]


@pytest.mark.parametrize(("name", "lower"), [(JSON50, False), (WORD49, True)])
def test_word_cache_equals_the_library(documents, name, lower):
    texts = SPACES + [r[1] or "" for r in ROWS] + [r["text"] for r in documents.select("text").collect()]
    rng = np.random.default_rng(8)
    texts += ["".join(rng.choice(list("ab  \n\t'sé.1 "), 25)) for _ in range(3000)]
    enc = tokens.Encoder(P.path(name), lower)
    for size in (len(texts), 97):
        got = [x for lo in range(0, len(texts), size) for x in enc.encode(pa.array(texts[lo : lo + size]))[0].to_pylist()]
        for t, raw, want in zip(texts, got, library_ids(name, texts), strict=True):
            assert np.frombuffer(raw, enc.kind).tolist() == want, repr(t[:100])


def check_pack(df, window=1024):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    pieces = packing.pack(df, P.path(JSON50), window=window)
    got = [r.asDict() for r in pieces.collect()]
    want = Counter((d, *ids, 0) for (d, _), ids in zip(rows, library_ids(JSON50, [t for _, t in rows]), strict=True))
    whole = sorted(got, key=lambda r: (r["sequence_id"], r["offset"]))
    at, have, current = 0, Counter(), []
    for r in whole:
        assert (r["sequence_id"], r["offset"]) == divmod(at, window)
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"] and r["start"] == len(current)
        current += ids.tolist()
        at += r["length"]
        if len(current) == r["doc_tokens"]:
            have[(r["doc_id"], *current)] += 1
            current = []
    assert have == want and not current
    return pieces, at


@pytest.mark.parametrize("window", [1024, 7])
def test_packing(odd, documents, window):
    for df in (odd, documents):
        pieces, total = check_pack(df, window)
    seqs = packing.sequences(pieces, window).collect()
    assert sum(r["n_ids"] for r in seqs) == total and all(len(r["ids"]) == window for r in seqs)


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, P.path(JSON50)).count() == 0


def test_bpe_round_trip(odd, no_docs, documents):
    import tiktoken

    with open(P.path(MULTI), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (odd, documents):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        got = bpe.decode_bpe(bpe.encode_bpe(df, P.path(MULTI), P.PATTERN), P.path(MULTI), P.PATTERN).collect()
        assert Counter((r["doc_id"], *r["ids"]) for r in got) == Counter((d, *enc.encode_ordinary(t or "")) for d, t in rows)
        assert Counter((r["doc_id"], bytes(r["decoded"])) for r in got) == Counter((d, (t or "").encode()) for d, t in rows)
    assert bpe.encode_bpe(no_docs, P.path(MULTI), P.PATTERN).count() == 0


def test_safe_pieces_keep_the_ids():
    enc = bpe.encoding(P.path(MULTI), P.PATTERN)
    rng = np.random.default_rng(1)
    for n in (3, 10, 50):
        for _ in range(300):
            t = "".join(rng.choice(list("ab  \n\t'sé.1!?AB"), 120))
            pieces = bpe.safe_pieces(t, n)
            assert "".join(pieces) == t
            assert [i for p in pieces for i in enc.encode_ordinary(p)] == enc.encode_ordinary(t)


def test_decoding_of_bytes_that_are_no_text(spark):
    got = bpe.decode_bpe(spark.createDataFrame([(1, [255, 200]), (2, None), (3, [])], "doc_id long, ids array<int>"), P.path(MULTI), P.PATTERN).collect()
    enc = bpe.encoding(P.path(MULTI), P.PATTERN)
    assert [bytes(r["decoded"]) for r in sorted(got)] == [enc.decode_bytes([255, 200]), b"", b""]


def test_id_files(odd, no_docs, documents):
    for df in (odd, documents):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        ids = library_ids(WORD49, [t for _, t in rows])
        got = [tuple(r) for r in huffman.token_index(*huffman.write_ids(df, P.path(WORD49))).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
        crc = lambda x: zlib.crc32(np.array([*x, 1], "<u4").tobytes())
        assert Counter((d, n, c) for d, _, n, c in got) == Counter((d, len(x) + 1, crc(x)) for (d, _), x in zip(rows, ids, strict=True))
        at = 0
        for d, start, n, _ in sorted(got, key=lambda r: r[1]):
            assert start == at
            at += n
        keys = [-1 if r[0] is None else r[0] for r in sorted(got, key=lambda r: r[1])]
        assert keys == sorted(keys)
    assert huffman.token_index(*huffman.write_ids(no_docs, P.path(WORD49))).count() == 0


def test_codes_are_canonical_bounded_and_optimal():
    rng = np.random.default_rng(2)
    for counts in (rng.zipf(1.3, 500), 2 ** np.arange(30), np.array([5]), np.array([0, 3, 0, 3])):
        lengths = huffman.code_lengths(counts.astype(np.int64), 12)
        used = lengths[lengths > 0]
        assert used.max() <= 12 and (len(used) < 2 or (2.0 ** -used).sum() == 1)
        codes = huffman.canonical_codes(lengths)
        ids = rng.choice(np.flatnonzero(counts), 3000)
        payload, marks = huffman.encode_block(ids, lengths, codes)
        other, more = huffman.encode_block(ids[:77], lengths, codes)
        a, b = huffman.Decoder(lengths, codes)([(payload, marks, 3000), (other, more, 77)])
        assert (a == ids).all() and (b == ids[:77]).all()
    import heapq

    counts = rng.integers(1, 1000, 200)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        cost += x
        heapq.heappush(heap, x)
    assert (huffman.code_lengths(counts, 20) * counts).sum() == cost


def check_shards(df, shards):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = [r.asDict() for r in sharding.kd_shards(df, shards).collect()]
    raw = lambda t: (t or "").encode()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len(raw(t)) + 16, zlib.crc32(raw(t))) for d, t in rows)
    slots, size = defaultdict(list), Counter()
    for r in got:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size


def test_sharding(odd, no_docs, spark, sf):
    check_shards(odd, 40)
    assert sharding.kd_shards(no_docs).count() == 0
    size = check_shards(spark.read.parquet(sf.replace("sf0.001", "sf0.1") + "/documents.parquet"), 40)
    assert len(size) == 40 and max(size.values()) < 1.1 * min(size.values())


def test_sharding_of_ties(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"), F.lit("hot").alias("source"))
    size = check_shards(df, 7)
    assert max(size.values()) < 1.05 * min(size.values())


def test_sharding_of_one_repeated_row(spark):
    from pyspark.sql import functions as F

    df = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    held = lambda: set(spark.sparkContext._jsc.getPersistentRDDs())
    before = held()
    size = check_shards(df, 5)
    assert max(size.values()) < 1.05 * min(size.values())
    assert held() <= before


def test_id_file_is_read_by_its_path_alone(odd, tmp_path):
    spark, path = huffman.write_ids(odd, P.path(WORD49), path=f"{tmp_path}/ids")
    assert path == f"{tmp_path}/ids" and huffman.token_index(spark, path).count() == len(ROWS)
    assert spark.read.parquet(f"{path}/book").columns == ["symbol", "bits"]


def test_session_settings_and_staged_tables_do_not_last(odd, tmp_path):
    from rosterforge.llm import common

    spark = odd.sparkSession
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    packing.pack(odd, P.path(JSON50)).count()
    assert before == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    assert common._STAGED
    common.drop_all_staged(spark)
    assert not common._STAGED


@pytest.mark.parametrize("lower", ["<|startoftext|>", "x"])
def test_chunk_ids_are_those_of_the_library(spark, lower):
    from tokenizers import Tokenizer

    from rosterforge.llm import chunks

    path = P.path(WORD49)
    library, draw = Tokenizer.from_file(path), random.Random(len(lower))
    alphabet = ["a", "B", "the ", "\n", " ", "  ", "\t", "e\u0301", " \u0301", lower, "<|", "|>", "'s", "9", "\u03a3", "\u5b57", " ", "\x85", ".", "word ", "ation ", "\r\n", "\u0130", "\uac00", "\u212a"]
    make = lambda n: "".join(draw.choice(alphabet) for _ in range(n))
    shared = [make(400) for _ in range(3)]
    texts = ["", None, "x" * 30_000, " " * 30_000, "a " * 2000, lower * 100] + [make(draw.randint(1, 900)) + draw.choice(shared) + make(draw.randint(1, 300)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = chunks.encode_chunks(df, path, decode=True).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, chunks.decode_tokens(chunks.encode_chunks(df, path), path).collect()))
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_chunks_are_reused_and_joins_are_tried_until_they_agree():
    import pyarrow as pa

    from rosterforge.llm import chunks
    from rosterforge.llm.tokens import Encoder

    enc = chunks.ChunkEncoder(Encoder(P.path(WORD49), True))
    text = " ".join(f"wort{i * i % 911}" for i in range(2000))
    (first,) = enc.encode(pa.array([text]))
    met = len(enc.known)
    assert met > 10 and enc.encode(pa.array(["Another head, then " + text]))[0].endswith(first[200:])
    assert len(enc.known) <= met + 2
    pieces = list(enc.known)[:4]
    enc.known[pieces[1]].first_ids = b"\xff\xff"  # as if a chunk's margin were wrong
    assert enc._repaired(pieces) == enc.encode(pa.array([b"".join(pieces).decode()]))[0] and enc.merged


@pytest.mark.parametrize("run", [" ", "\t", "\n", "\u2003", " \n"])
def test_long_white_space_in_op8(spark, run):
    from rosterforge.llm import bpe

    path, n = P.path("byte_bpe_multi_50k.tiktoken"), 1_000_000 // len(run)
    enc = bpe.encoding(path, P.PATTERN)
    for text in (run * 1500, "a" + run * 1500 + "b", run * 1500 + ".\r", "x " + run * 1200 + "1" + run * 1300):
        short = [i for m in regex.finditer(P.PATTERN, text) for i in enc._encode_single_piece(m[0])]
        assert bpe.encode_text(enc, text) == short
    texts = [run * n, "a" + run * n + "b", run * n + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.decode_bpe(bpe.encode_bpe(df, path, P.PATTERN), path, P.PATTERN).collect()
    assert {r["doc_id"]: r["decoded"].decode() for r in got} == dict(enumerate(texts))
