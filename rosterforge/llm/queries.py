"""Registered queries over the synthetic tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.llm import bpe, chunks, collocations, conversations, embeddings, exact_dedup, huffman, lines, minhash, packing, pii, quality, sharding
from rosterforge.llm.common import read_table


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, weights).withColumn("held_out", F.coalesce(quality.held_out(), F.lit(False)))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(read_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(read_table(spark, sf_dir, "documents"), shingle=lines.SHORT_SHINGLE)
    dropped = F.concat_ws(",", F.col("dropped").cast("array<string>")).alias("dropped_lines")
    return found.select("doc_id", "n_lines", (F.col("n_lines") - F.col("n_dropped")).alias("n_kept"), dropped, F.sha2("text", 256).alias("kept_sha256"))


def op6_concat_cut_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op7_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=2)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rank, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    both = bpe.decode_bpe(bpe.encode_bpe(read_table(spark, sf_dir, "documents"), rank, pattern), rank, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_pii_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(read_table(spark, sf_dir, "documents")))


def op10_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return huffman.token_index(*huffman.write_ids(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(read_table(spark, sf_dir, "conversations"))


def op13_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    both = chunks.encode_chunks(read_table(spark, sf_dir, "documents"), path, decode=True)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


_ALL = (
    op1_embedding_dedup,
    op2_exact_dedup,
    op3_quality,
    op4_kd_shards,
    op5_line_dedup,
    op6_concat_cut_packing,
    op7_hyperminhash_dedup,
    op8_byte_bpe,
    op9_pii_field,
    op10_huffman_ids,
    op11_collocations,
    op12_conversation_repair,
    op13_chunk_bpe,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES: dict[str, str] = {"op1_embedding_dedup": embeddings.ORACLE, "op2_exact_dedup": exact_dedup.ORACLE, "op7_hyperminhash_dedup": minhash.ORACLE, "op11_collocations": collocations.ORACLE}
