"""A training-corpus pipeline over ``documents``: classify, drop repeated lines, drop near copies, mask personal data, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.llm import lines, minhash, packing, pii, quality
from rosterforge.llm.common import read_table, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents that score less are rejected.
QUALITY = 0.5


def _columns(rows: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars as the text now is."""
    return rows.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose whole text scores QUALITY or more."""
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, weights, keep=COLUMNS[1:], threshold=QUALITY).filter("predicted = 1").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, without the fuzzy repeats of lines."""
    return _columns(lines.dedup_lines(docs, keep=("lang", "source")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies (five-word shingles, similarity of 0.8 or more).

    Every row counts by itself, by a number in the order of doc_id (rows without one last),
    text digest and the other columns, and the first row of a group stays: of rows that
    repeat a doc_id and text one stays, rows that share a doc_id with different texts are
    judged each by its own text, and a row without doc_id goes only if it is a copy of
    another row.  Null, empty and blank texts are copies of nothing and all stay.
    """
    # Numbered as they come, and written before they are read again; only members of groups are put in order.
    rows = stage(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    found = minhash.near_duplicates(rows, words=5, id_col="_row")
    copies = stage(found.filter("NOT kept").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("group")), "near-copies")
    members = copies.unionByName(copies.select(F.col("group").alias("_row"), "group").distinct())
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "lang", "source", "_row")
    placed = stage(members.join(rows.select("_row", place.alias("place")), "_row"), "near-members")
    first = placed.groupBy("group").agg(F.min("place").alias("first"))
    gone = placed.join(first, "group").filter("_row <> first._row").select("_row")
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with each found span replaced by its kind."""
    return _columns(pii.detect(docs, keep=("lang", "source")).withColumnRenamed("masked", "text"))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, end to end in sequences of 1024 ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("minhash near-dedup", drop_near_copies),
    ("personal data", mask_personal_data),
    ("packing", pack_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
