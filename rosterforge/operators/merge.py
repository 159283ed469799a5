"""Deduplicating contacts, and merging batches into a master table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPLETENESS = ("first_name", "last_name", "address", "city", "state", "zipcode", "phone", "dob", "signup_date", "signup_ip")
#: Fields that the winner takes from others where its own are empty.
FILL = ("first_name", "last_name", "address", "city", "state", "zipcode", "phone", "dob", "gender", "signup_date", "signup_domain", "signup_ip", "country", "custom1", "custom2", "custom3", "custom4", "custom5")
#: Fields that an upsert overwrites where the new value is there.
ENRICH = ("first_name", "last_name", "address", "city", "state", "zipcode", "phone")
ENRICH_IMPORT = (*ENRICH, "dob", "gender", "signup_date", "signup_domain", "signup_ip")


def _filled(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit("")) != ""


def priority(contacts: DataFrame) -> DataFrame:
    """Adds the rank of a record among those of one address: engagement, status, completeness, known source."""
    have = [c for c in COMPLETENESS if c in contacts.columns]
    pts = lambda cond, n: F.when(cond, n).otherwise(0)
    parts = [pts(F.col("is_clicker"), 1000), pts(F.col("is_opener"), 500), pts(F.col("validation_status") == "Verified", 200), *(pts(_filled(c), 10) for c in have)]
    parts.append(pts(_filled("data_source") & (F.col("data_source") != "Unknown"), 50))
    return contacts.withColumn("priority", reduce(lambda a, b: a + b, parts).cast("int"))


def merge_duplicates(contacts: DataFrame, within: tuple[str, ...] = (), lower: bool = False) -> DataFrame:
    """One row per lower-case email (and ``within``): the best record, its gaps filled from the others in order of rank.

    Ranked by priority, then by earliest (file_ordinal, row_ordinal).  Flags are ORed, the
    status is Verified if any is, lineage is the sorted union.  Rows without email go.
    Everything is one aggregation on the key, with partial aggregates before the shuffle
    (only the lineage arrays are collected, as sets).  The email is spelled as in the best
    record; with ``lower`` it is the key itself, so that a join on it keeps the partitioning.
    """
    rows = priority(contacts.filter("email IS NOT NULL AND email <> ''")).withColumn("_key", F.lower("email"))
    rank = F.struct("priority", (-F.col("file_ordinal")).alias("f"), (-F.col("row_ordinal")).alias("r"))
    fill = [c for c in FILL if c in contacts.columns]
    rest = [c for c in contacts.columns if c not in (*fill, *within, "is_clicker", "is_opener", "validation_status", "file_sources")]
    rows = rows.withColumn("_rank", rank)
    best = [
        F.max_by(F.struct(*rest, "validation_status"), "_rank").alias("_best"),
        *[F.max_by(c, F.when(_filled(c), F.col("_rank"))).alias(c) for c in fill],
        F.bool_or(F.coalesce("is_clicker", F.lit(False))).alias("is_clicker"),
        F.bool_or(F.coalesce("is_opener", F.lit(False))).alias("is_opener"),
        F.bool_or(F.coalesce(F.col("validation_status") == "Verified", F.lit(False))).alias("_verified"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("file_sources")))).alias("file_sources"),
        F.count("*").alias("n_merged"),
    ]
    out = rows.groupBy("_key", *within).agg(*best)
    status = F.when(F.col("_verified"), "Verified").otherwise(F.col("_best.validation_status")).alias("validation_status")
    return out.select(*[F.col("_key" if lower and c == "email" else f"_best.{c}").alias(c) for c in rest], *within, *fill, "is_clicker", "is_opener", status, "file_sources", "n_merged")


def incremental(contacts: DataFrame) -> DataFrame:
    """Merged within each file; across files the first file's record wins and later ones are dropped."""
    merged = merge_duplicates(contacts, within=("file_ordinal",))
    first = merged.groupBy(F.lower("email").alias("_key")).agg(F.min_by(F.struct(*merged.columns), "file_ordinal").alias("_first"))
    return first.select("_first.*")


def insert_if_absent(master: DataFrame, batch: DataFrame) -> DataFrame:
    """The master and those rows of the batch whose email it lacks."""
    return master.unionByName(batch.join(master.select("email"), "email", "left_anti"), allowMissingColumns=True)


def enrich(master: DataFrame, batch: DataFrame, fields: tuple[str, ...] = ENRICH) -> DataFrame:
    """Upsert: new values win where they are there, flags are ORed, the higher score stays, lineage is appended.

    Adds ``outcome`` (inserted, updated or kept).  Both sides must have one row per email;
    one full outer join on it is the only step that may shuffle, and sides that come from
    :func:`merge_duplicates` with ``lower`` are joined as they lie.
    """
    o, n = master.alias("o"), batch.alias("n")
    old, new = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    both = o.join(n, F.col("o.email") == F.col("n.email"), "full_outer")
    none = F.array().cast("array<string>")
    outs = []
    for c in master.columns:
        if c not in batch.columns:
            outs.append(old(c).alias(c))
        elif c in ("is_clicker", "is_opener"):
            outs.append((F.coalesce(old(c), F.lit(False)) | F.coalesce(new(c), F.lit(False))).alias(c))
        elif c == "quality_score":
            outs.append(F.greatest(F.coalesce(old(c), F.lit(0)), F.coalesce(new(c), F.lit(0))).alias(c))
        elif c == "file_sources":
            outs.append(F.concat(F.coalesce(old(c), none), F.coalesce(new(c), none)).alias(c))
        elif c in fields:
            outs.append(F.coalesce(new(c), old(c)).alias(c))
        else:
            outs.append(F.coalesce(old(c), new(c)).alias(c))
    outcome = F.when(old("email").isNull(), "inserted").when(new("email").isNotNull(), "updated").otherwise("kept")
    return both.select(*outs, outcome.alias("outcome"))


def outcome_counts(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("outcome").agg(F.count("*").alias("n"))


def delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """new - old per statistic of two (stat_name, stat_value) snapshots."""
    both = old.withColumnRenamed("stat_value", "_old").join(new.withColumnRenamed("stat_value", "_new"), "stat_name", "full_outer")
    return both.select("stat_name", (F.coalesce("_new", F.lit(0)) - F.coalesce("_old", F.lit(0))).alias("change"))
