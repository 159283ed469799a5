"""The dimension of mail-exchanger facts per domain."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.functions import rules as R
from rosterforge.functions import scalars as S
from rosterforge.operators.contacts import domain_table

BIG4_HOSTS = ("Google", "Microsoft", "Yahoo")


def shape_results(found: DataFrame) -> DataFrame:
    """Rows of the dimension from (domain, answers array<struct<pref,host>>): null is NXDOMAIN, an empty array has no MX.

    The primary host is the one with the lowest preference.
    """
    ordered = F.array_sort(F.col("answers"))
    primary = F.get(ordered, F.lit(0)).getField("host")
    dead = F.col("answers").isNull() | (F.size("answers") <= 0)
    return found.select(
        "domain",
        F.transform(ordered, lambda a: a["host"]).alias("mx_records"),
        F.transform(ordered, lambda a: a["pref"]).alias("mx_priority"),
        primary.alias("mx_primary"),
        F.when(dead, "Dead").otherwise(S.classify_mx(primary)).alias("mx_category"),
        F.when(F.col("answers").isNull(), "NXDOMAIN").when(dead, "No MX").otherwise(primary).alias("mx_host_provider"),
        (~dead).alias("is_valid"),
        F.when(F.col("answers").isNull(), "NXDOMAIN").when(dead, "No MX records").alias("error_message"),
    )


def resolve(domains: DataFrame, resolver: Callable[[str], list[tuple[int, str]] | None], tasks: int = 32) -> DataFrame:
    """(domain, answers) from an injected resolver, in ``tasks`` parallel tasks."""

    def ask(batches: Iterable):
        import pandas as pd

        for b in batches:
            got = [resolver(d) for d in b["domain"]]
            yield pd.DataFrame({"domain": b["domain"], "answers": [None if g is None else [{"pref": p, "host": h} for p, h in g] for g in got]})

    return domains.select("domain").repartition(tasks, "domain").mapInPandas(ask, "domain string, answers array<struct<pref:int,host:string>>")


def from_snapshot(domains: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(domain, answers) looked up in a table (domain, host, pref)."""
    answers = snapshot.groupBy("domain").agg(F.collect_list(F.struct("pref", "host")).alias("answers"))
    return domains.select("domain").join(answers, "domain", "left")


def unchecked(dimension: DataFrame, gi_only: bool = False, limit: int | None = None) -> DataFrame:
    """Domains never looked up that no rule already names; with a ``limit`` the first ones of the alphabet."""
    rows = dimension.filter("checked_at IS NULL")
    rows = rows.filter("is_gi") if gi_only else rows
    rows = rows.join(F.broadcast(domain_table(dimension.sparkSession).select("domain")), "domain", "left_anti")
    return rows if limit is None else rows.orderBy("domain").limit(limit)


def backfill(contacts: DataFrame, dimension: DataFrame, add: bool = False) -> DataFrame:
    """(domain, email_count) with the contacts' counts; ``add`` sums them onto the old ones."""
    counts = contacts.filter("email_domain IS NOT NULL").groupBy(F.col("email_domain").alias("domain")).agg(F.count("*").alias("n"))
    old = F.coalesce("email_count", F.lit(0))
    both = dimension.select("domain", "email_count").join(counts, "domain", "full_outer")
    return both.select("domain", (old + F.coalesce("n", F.lit(0)) if add else F.coalesce("n", old)).cast("long").alias("email_count"))


def apply_mx(contacts: DataFrame, dimension: DataFrame, valid_only: bool = True) -> DataFrame:
    """Contacts with the domain's category, validity and host; ``mx_changed`` marks the rows that differ from before."""
    side = dimension.filter("is_valid") if valid_only else dimension
    side = side.select(F.col("domain").alias("email_domain"), F.col("mx_category").alias("_c"), F.col("is_valid").alias("_v"), F.col("mx_host_provider").alias("_h"), F.lit(True).alias("_hit"))
    out = contacts.join(side, "email_domain", "left")
    changed = F.col("_hit").isNotNull() & ~(F.col("mx_category").eqNullSafe(F.col("_c")) & F.col("mx_valid").eqNullSafe(F.col("_v")))
    return out.select(
        *[c for c in contacts.columns if c not in ("mx_category", "mx_valid", "mx_host_provider")],
        F.when(F.col("_hit"), F.col("_c")).otherwise(F.col("mx_category")).alias("mx_category"),
        F.when(F.col("_hit"), F.col("_v")).otherwise(F.col("mx_valid")).alias("mx_valid"),
        F.col("_h").alias("mx_host_provider"),
        changed.alias("mx_changed"),
    )


def split_undeliverable(contacts: DataFrame, dimension: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows of dead domains)."""
    dead = dimension.filter("NOT is_valid").select(F.col("domain").alias("email_domain"))
    return contacts.join(dead, "email_domain", "left_anti"), contacts.join(dead, "email_domain", "left_semi")


def flag_spamtraps(contacts: DataFrame, dimension: DataFrame) -> DataFrame:
    """``is_spamtrap`` set where the text after the first @ is a flagged domain."""
    traps = dimension.filter("is_spamtrap").select(F.col("domain").alias("_d"), F.lit(True).alias("_trap"))
    rows = contacts.withColumn("_d", F.split_part("email", F.lit("@"), F.lit(2))).join(traps, "_d", "left")
    return rows.withColumn("is_spamtrap", F.coalesce("_trap", "is_spamtrap", F.lit(False))).drop("_d", "_trap")


def mark_traps(dimension: DataFrame, host_words: tuple[str, ...]) -> DataFrame:
    """Flags domains one of whose hosts contains one of the words."""
    hit = F.lit(False)
    for w in host_words:
        hit = hit | F.coalesce(F.contains(F.array_join("mx_records", ","), F.lit(w)), F.lit(False))
    return dimension.withColumn("is_spamtrap", F.coalesce("is_spamtrap", F.lit(False)) | hit)


def label_hosting(dimension: DataFrame) -> DataFrame:
    """``hosting_provider`` where it is still empty, by the first label that occurs in the primary host."""
    empty = F.coalesce("hosting_provider", F.lit("")) == ""
    return dimension.withColumn("hosting_provider", F.when(empty, F.coalesce(S.hosting_label(F.col("mx_primary")), "hosting_provider")).otherwise(F.col("hosting_provider")))


def sync_gi(contacts: DataFrame, dimension: DataFrame) -> DataFrame:
    """(domain, is_gi, is_new): domains of general contacts are flagged, missing ones added."""
    gi = contacts.filter(F.col("email_category") == R.GENERAL).select(F.col("email_domain").alias("domain")).filter("domain IS NOT NULL").distinct()
    both = dimension.select("domain", "is_gi", F.lit(True).alias("_old")).join(gi.withColumn("_gi", F.lit(True)), "domain", "full_outer")
    return both.select("domain", F.coalesce("_gi", "is_gi", F.lit(False)).alias("is_gi"), F.col("_old").isNull().alias("is_new"))


RESET = ("checked_at", "mx_primary", "mx_category", "mx_host_provider", "error_message", "mx_records", "mx_priority")


def reset(dimension: DataFrame, dead_only: bool = True) -> DataFrame:
    """Dead domains (or all) go back to the state before any lookup."""
    hit = F.coalesce(~F.col("is_valid"), F.lit(False)) if dead_only else F.lit(True)
    kinds = dict(dimension.dtypes)
    out = {c: F.when(hit, F.lit(None).cast(kinds[c])).otherwise(F.col(c)) for c in RESET if c in kinds}
    return dimension.withColumns(out | {"is_valid": F.when(hit, True).otherwise(F.col("is_valid"))})


def latest_results(results: DataFrame) -> DataFrame:
    """One row per domain of a batch of lookups: the latest by checked_at."""
    return results.groupBy("domain").agg(F.max_by(F.struct(*[c for c in results.columns if c != "domain"]), "checked_at").alias("_r")).select("domain", "_r.*")


def suspicious(banners: DataFrame) -> DataFrame:
    """Adds suspicion_reason and is_suspicious to (mx_host, ssh_banner, smtp_banner, smtp_ehlo)."""
    reason = S.banner_reasons(F.col("ssh_banner"), F.col("smtp_banner"), F.col("smtp_ehlo"))
    return banners.withColumn("suspicion_reason", reason).withColumn("is_suspicious", F.col("suspicion_reason") != "")
