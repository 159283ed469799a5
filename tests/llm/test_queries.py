"""The registered queries themselves: their columns over whole tables, SQL where there is some, and recall measured."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

from rosterforge.llm import lines, quality, queries

from .test_dedup import lines_expected, shingles
from .test_models import plain_spans

COLUMNS = {
    "op1_embedding_dedup": "vec_id n_links component_id kept",
    "op2_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op3_quality": "doc_id held_out score predicted",
    "op4_kd_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op5_line_dedup": "doc_id n_lines n_kept dropped_lines kept_sha256",
    "op6_concat_cut_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7_hyperminhash_dedup": "doc_id n_shingles component_id kept",
    "op8_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_pii_field": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10_huffman_ids": "doc_id start n_tokens ids_crc32",
    "op11_collocations": "lang rank phrase a l r n score",
    "op12_conversation_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13_chunk_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
}


@pytest.fixture(scope="module")
def results(spark, sf):
    return {name: q(spark, sf).toPandas() for name, q in queries.QUERIES.items()}


def test_columns_and_rows(results, documents):
    assert set(results) == set(COLUMNS)
    ids = Counter(r["doc_id"] for r in documents.select("doc_id").collect())
    for name, got in results.items():
        assert set(COLUMNS[name].split()) <= set(got.columns), name
        if name not in ("op1_embedding_dedup", "op6_concat_cut_packing", "op11_collocations", "op12_conversation_repair"):
            assert Counter(got["doc_id"]) == ids, name
    assert set(results["op6_concat_cut_packing"]["doc_id"]) == set(ids)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_duckdb(results, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(queries.ORACLES[name]).df()
    columns = COLUMNS[name].split()
    assert Counter(map(tuple, results[name][columns].astype(str).values)) == Counter(map(tuple, want[columns].astype(str).values))


def test_quality_against_plain_dot_products(results, spark, documents, sf):
    weights = quality.train(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    got = results["op3_quality"].set_index("doc_id")
    for r in documents.collect():
        at, x = quality.vector(quality.features(r["text"]))
        score = 1 / (1 + np.exp(-np.clip(weights[at] @ x, -30, 30)))
        row = got.loc[r["doc_id"]]
        assert abs(row["score"] - score) < 1e-9 and row["predicted"] == int(row["score"] >= 0.7)
        assert row["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_quality_on_held_out_labels_at_the_threshold(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    got = queries.op3_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").select("predicted", "quality").collect()
    assert len(got) > 500 and np.mean([p == q for p, q in got]) > 0.85


def test_base_counts_of_op9(results, documents):
    got = results["op9_pii_field"].set_index("doc_id")
    for r in documents.collect():
        found = Counter(k for k, *_ in plain_spans(r["text"] or ""))
        assert all(got.loc[r["doc_id"]][f"n_{k}"] == found[k] for k in ("email", "ip", "card", "phone"))


def test_ids_of_op8(results, documents):
    import hashlib

    from rosterforge.llm import bpe

    enc = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    got = results["op8_byte_bpe"].set_index("doc_id")
    for r in documents.collect():
        ids = enc.encode_ordinary(r["text"] or "")
        row = got.loc[r["doc_id"]]
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_recall_of_near_copies(spark, sf):
    """Every link between a document with an id divisible by 100 and any other lies within one component (sf0.01, both sides whole)."""
    sf = sf.replace("sf0.001", "sf0.01")
    sets = {r["doc_id"]: shingles(r["text"], 2) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    component = {r["doc_id"]: r["component_id"] for r in queries.op7_hyperminhash_dedup(spark, sf).collect()}
    links = [(a, b) for a in sets if a % 100 == 0 for b in sets if a != b and sets[a] and min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert all(component[a] == component[b] for a, b in links)


def test_line_digest_of_op5(results, documents):
    import hashlib

    want = {r["doc_id"]: (r["n_lines"], r["n_lines"] - r["n_dropped"], ",".join(map(str, r["dropped"])), hashlib.sha256(r["text"].encode()).hexdigest()) for r in lines.dedup_lines(documents, shingle=lines.SHORT_SHINGLE).collect()}
    got = results["op5_line_dedup"]
    assert {r.doc_id: (r.n_lines, r.n_kept, r.dropped_lines, r.kept_sha256) for r in got.itertuples()} == want


def test_op5_against_brute_force_with_its_own_shingles(results, documents):
    import hashlib

    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    want = Counter({(d, n, n - len(gone), ",".join(map(str, gone)), hashlib.sha256(t.encode()).hexdigest()): c for (d, t, n, gone), c in lines_expected(rows, lines.SHORT_SHINGLE).items()})
    assert Counter((r.doc_id, r.n_lines, r.n_kept, r.dropped_lines, r.kept_sha256) for r in results["op5_line_dedup"].itertuples()) == want
