"""The import path: raw rows to records, staging with lengths and types, upsert, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterforge.functions import scalars as S
from rosterforge.operators import contacts as C
from rosterforge.operators import merge

# Fields copied as they are, words that count as nothing, and the stored lengths.
COPIED = ("first_name", "last_name", "address", "city", "state", "zipcode", "phone", "gender", "signup_ip", "signup_date", "signup_domain")
NULL_WORDS = ("null", "none", "")
LENGTHS = {
    "email": 320, "email_domain": 255, "email_provider": 50, "email_brand": 50, "first_name": 100, "last_name": 100, "city": 100, "state": 50, "zipcode": 20, "phone": 50,
    "signup_domain": 255, "signup_ip": 45, "validation_status": 50, "email_category": 50, "data_source": 100, "country": 10,
}


def records(raw: DataFrame) -> DataFrame:
    """Rows with a valid address outside the blocked domains, categorised; cells of the copied fields without their blanks and null words."""
    rows = raw.withColumn("email", S.clean_email(F.col("email"))).withColumn("email_domain", S.domain_of(F.col("email")))
    there = lambda c: S.let(S.strip(F.col(c).cast("string")), lambda x: F.when(~F.lower(x).isin(*NULL_WORDS), x))
    return C.categorise(C.importable(rows)).withColumns({c: there(c) for c in COPIED if c in raw.columns})


def staged(rows: DataFrame) -> DataFrame:
    """Stored lengths and types: dates from their first ten characters, gender M or F, else its first letter."""
    have = set(rows.columns)
    out = {c: F.left(F.col(c), F.lit(n)) for c, n in LENGTHS.items() if c in have}
    out |= {c: S.safe_date(F.col(c)) for c in ("dob",) if c in have} | {c: S.safe_date(F.col(c)).cast("timestamp_ntz") for c in ("signup_date",) if c in have}
    g = F.upper("gender")
    out |= {"gender": F.when(g.isin("MALE", "M"), "M").when(g.isin("FEMALE", "F"), "F").otherwise(F.left("gender", F.lit(1)))} if "gender" in have else {}
    return rows.withColumns(out)


def first_of_each(rows: DataFrame) -> DataFrame:
    """One row per address: the first by (file_ordinal, row_ordinal)."""
    order = Window.partitionBy("email").orderBy("file_ordinal", "row_ordinal")
    return rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def upsert(master: DataFrame, raw: DataFrame) -> DataFrame:
    """The stored table enriched by a batch of raw rows, with ``outcome`` (inserted, updated, kept)."""
    return merge.enrich(master, first_of_each(staged(records(raw))).select(*master.columns), merge.ENRICH_IMPORT)


def counters(rows: DataFrame, dimension: DataFrame) -> DataFrame:
    """(bucket, n) of a batch of records: Big4, Cable, and general ones by what is known of their domain; zeros included."""
    known = dimension.select(F.col("domain").alias("email_domain"), F.col("is_valid").alias("_v"))
    bucket = F.when(F.col("email_category") == "Big4_ISP", "big4").when(F.col("email_category") == "Cable_Provider", "cable")
    bucket = bucket.when(F.col("_v"), "gi_valid").when(~F.col("_v"), "gi_dead").otherwise("gi_new")
    found = rows.join(known, "email_domain", "left").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    every = rows.sparkSession.createDataFrame([(b,) for b in ("big4", "cable", "gi_valid", "gi_dead", "gi_new")], "bucket string")
    return every.join(F.broadcast(found), "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
