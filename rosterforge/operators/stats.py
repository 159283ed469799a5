"""Grouped and conditional counts over contacts and the domain dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.functions import rules as R
from rosterforge.functions import scalars as S

Q = F.col


def counts(rows: DataFrame, by: str | Column, name: str = "value") -> DataFrame:
    return rows.groupBy((F.col(by) if isinstance(by, str) else by).alias(name)).agg(F.count("*").alias("n"))


def measures(distinct_domains: bool = True) -> list[Column]:
    """The nine measures of every breakdown."""
    q = Q("quality_score")
    out = [
        F.count("*").alias("total"),
        F.count_if(F.coalesce("mx_valid", F.lit(True))).alias("good"),
        F.count_if(~Q("mx_valid")).alias("dead"),
        F.count_if(q >= 70).alias("high"),
        F.count_if((q >= 40) & (q < 70)).alias("med"),
        F.count_if(q.isNull() | (q < 40)).alias("low"),
        F.count_if(Q("is_clicker")).alias("clickers"),
        F.count_if(Q("is_opener")).alias("openers"),
    ]
    return [*out, F.count_distinct("email_domain").alias("domains")] if distinct_domains else out


def five_tiers(rows: DataFrame) -> DataFrame:
    q = Q("quality_score")
    tier = F.when(q >= 80, "Excellent").when(q >= 60, "Good").when(q >= 40, "Average").when(q >= 20, "Below Average").otherwise("Poor")
    return counts(rows, tier, "tier")


def six_tiers(rows: DataFrame) -> DataFrame:
    return five_tiers(rows.filter("quality_score IS NOT NULL")).unionByName(rows.filter("quality_score IS NULL").agg(F.count("*").alias("n")).filter("n > 0").select(F.lit("Not Scored").alias("tier"), "n"))


def overview(rows: DataFrame) -> DataFrame:
    """All headline counters in one scan."""
    c = Q("email_category")
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(c == "Big4_ISP").alias("big4"),
        F.count_if(c == "Cable_Provider").alias("cable"),
        F.count_if(c == R.GENERAL).alias("gi"),
        F.count_if("is_clicker").alias("clickers"),
        F.count_if("is_opener").alias("openers"),
        F.count_if(Q("quality_score") >= 80).alias("high_quality"),
    )


def by_category(rows: DataFrame) -> DataFrame:
    """Per category and in total (category ALL): total, good, dead, clickers, openers, distinct domains."""
    out = rows.rollup("email_category").agg(F.grouping("email_category").alias("_all"), *measures())
    return out.select(F.when(Q("_all") == 1, "ALL").otherwise(Q("email_category")).alias("email_category"), "total", "good", "dead", "clickers", "openers", "domains")


def provider_breakdown(rows: DataFrame, providers: tuple[str, ...] = ("Google", "Yahoo", "Microsoft")) -> DataFrame:
    return rows.filter(Q("email_provider").isin(*providers)).groupBy("email_provider").agg(*measures())


def cable_breakdown(rows: DataFrame) -> DataFrame:
    d = Q("email_domain")
    bucket = F.lit(None).cast("string")
    for name, domains in reversed(R.CABLE_BUCKETS):
        hit = d.isin(*domains.split()) | (d.endswith(R.RR_SUFFIX) if name == "spectrum" else F.lit(False))
        bucket = F.when(hit, name).otherwise(bucket)
    return rows.filter(Q("email_category") == "Cable_Provider").withColumn("bucket", bucket).filter("bucket IS NOT NULL").groupBy("bucket").agg(*measures())


def apple_breakdown(rows: DataFrame) -> DataFrame:
    return rows.filter(Q("email_domain").isin("icloud.com", "me.com", "mac.com")).agg(*measures(False), F.lit(3).cast("long").alias("domains"))


def by_mx_category(rows: DataFrame, dimension: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """General contacts on hosts of the given categories (second-level Big4, or single hosters)."""
    side = dimension.filter(Q("mx_category").isin(*categories)).select(Q("domain").alias("email_domain"), Q("mx_category").alias("host_category"))
    return rows.filter(Q("email_category") == R.GENERAL).join(side, "email_domain").groupBy("host_category").agg(*measures())


def by_hosting(rows: DataFrame, dimension: DataFrame) -> DataFrame:
    """General contacts by words in the primary host."""
    host = F.lower("mx_primary")
    bucket = F.lit(None).cast("string")
    for name, words in reversed(R.HOSTING_BUCKETS):
        bucket = F.when(reduce(lambda a, b: a | b, [F.contains(host, F.lit(w)) for w in words.split()]), name).otherwise(bucket)
    side = dimension.filter(Q("mx_category").isin("Real_GI", R.GENERAL)).select(Q("domain").alias("email_domain"), bucket.alias("bucket")).filter("bucket IS NOT NULL")
    return rows.filter(Q("email_category") == R.GENERAL).join(side, "email_domain").groupBy("bucket").agg(*measures())


def top_gi_domains(rows: DataFrame, k: int = 10) -> DataFrame:
    gi = rows.filter((Q("email_category") == R.GENERAL) & ~Q("email_domain").isin("icloud.com", "me.com", "mac.com"))
    return gi.groupBy("email_domain").agg(*measures(False)).orderBy(Q("total").desc(), "email_domain").limit(k)


def category_domains(rows: DataFrame) -> DataFrame:
    return rows.groupBy("email_category").agg(F.count_distinct("email_domain").alias("domains"), F.count("*").alias("n"))


def shares(rows: DataFrame, by: str, places: int = 1) -> DataFrame:
    """Counts and percentages of the total; the total comes from the few grouped rows."""
    per = rows.groupBy(by).agg(F.count("*").alias("n"))
    total = per.agg(F.sum("n").alias("_total"))
    return per.join(F.broadcast(total)).select(by, "n", F.round(100 * Q("n") / Q("_total"), places).alias("pct"))


def top(rows: DataFrame, by: str, k: int) -> DataFrame:
    return rows.filter(Q(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n")).orderBy(Q("n").desc(), by).limit(k)


def high_intent(rows: DataFrame) -> DataFrame:
    """Engagement and completeness counters with ratios."""
    there = lambda c: F.count_if(F.coalesce(c, F.lit("")) != "")
    out = rows.agg(
        F.count("*").alias("total"),
        F.count_if("is_clicker").alias("clickers"),
        F.count_if("is_opener").alias("openers"),
        F.count_if(Q("is_clicker") & (Q("quality_score") >= 70)).alias("high_intent"),
        there("first_name").alias("with_name"),
        there("phone").alias("with_phone"),
        there("zipcode").alias("with_zip"),
    )
    return out.withColumns({f"{c}_pct": F.round(100 * Q(c) / Q("total"), 1) for c in ("high_intent", "with_name", "with_phone", "with_zip")})


# The domains of the domain report.
BIG4_REPORT = "gmail.com googlemail.com hotmail.com outlook.com live.com msn.com yahoo.com ymail.com rocketmail.com aol.com aim.com verizon.net att.net sbcglobal.net bellsouth.net".split()
CABLE_REPORT = "comcast.net xfinity.com charter.net spectrum.net cox.net optimum.net optonline.net twc.com roadrunner.com earthlink.net centurylink.net centurytel.net windstream.net mediacombb.net".split()


def domain_report(rows: DataFrame) -> DataFrame:
    """Counts of the listed domains and of all road-runner ones, from one aggregation; absent ones don't appear."""
    d = Q("email_domain")
    key = F.when(d.isin(BIG4_REPORT + CABLE_REPORT), d).when(d.endswith(R.RR_SUFFIX), "*.rr.com")
    return counts(rows.withColumn("_k", key).filter("_k IS NOT NULL"), "_k", "domain")


def facet(rows: DataFrame, kind: str, k: int | None = None) -> DataFrame:
    """(value, n) of a filter's choices, most frequent first, ties by value."""
    gender = F.upper("gender")
    exprs = {
        "state": (F.upper("state"), 100),
        "country": (Q("country"), 50),
        "source": (Q("data_source"), 100),
        "status": (Q("validation_status"), 100),
        "gender": (F.when(gender.isin("M", "MALE"), "M").when(gender.isin("F", "FEMALE"), "F").otherwise(Q("gender")), 100),
        "city": (S.title(Q("city"), "[a-z0-9]"), 200),
        "zip5": (F.left("zipcode", F.lit(5)), 200),
    }
    value, most = exprs[kind]
    return counts(rows.withColumn("_v", value).filter("_v IS NOT NULL AND _v <> ''"), "_v").orderBy(Q("n").desc(), "value").limit(k or most)


def file_source_facet(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("file_sources").alias("file_source")).groupBy("file_source").agg(F.count("*").alias("n"))


def dimension_state(dimension: DataFrame) -> DataFrame:
    checked = Q("checked_at").isNotNull()
    return dimension.agg(
        F.count("*").alias("total"),
        F.count_if(checked).alias("checked"),
        F.count_if(~checked).alias("unchecked"),
        F.count_if("is_gi").alias("gi"),
        F.count_if(Q("is_gi") & ~checked).alias("gi_unchecked"),
        F.count_if(~Q("is_valid")).alias("dead"),
    )


def scan_stats(dimension: DataFrame) -> DataFrame:
    checked = Q("checked_at").isNotNull()
    n = lambda c: F.coalesce(F.sum(F.when(c, Q("email_count"))), F.lit(0)).cast("long")
    return dimension.agg(
        F.count_if(checked).alias("checked"),
        F.count_if(checked & Q("is_valid")).alias("valid"),
        F.count_if(checked & ~Q("is_valid")).alias("dead"),
        n(checked).alias("emails_checked"),
        n(checked & Q("is_valid")).alias("emails_valid"),
        n(checked & ~Q("is_valid")).alias("emails_dead"),
    )


KNOWN_HOSTS = ("Google", "Microsoft", "Yahoo", "HostGator", "GoDaddy", "1and1", "Zoho", "Real_GI", "General_Internet", "Dead", "Parked")


def host_histogram(dimension: DataFrame) -> DataFrame:
    return counts(dimension.filter("mx_category IS NOT NULL"), F.when(Q("mx_category").isin(*KNOWN_HOSTS), Q("mx_category")).otherwise("Other"), "host_category")


def emails_by_host(dimension: DataFrame) -> DataFrame:
    return dimension.filter("mx_category IS NOT NULL").groupBy("mx_category").agg(F.coalesce(F.sum("email_count"), F.lit(0)).cast("long").alias("emails"))


def server_pivot(dimension: DataFrame) -> DataFrame:
    """valid and dead counts per resolver."""
    rows = dimension.filter("dns_server IS NOT NULL")
    return rows.groupBy("dns_server").agg(F.count_if("is_valid").alias("valid"), F.count_if(~Q("is_valid")).alias("dead"))


def hosting_summary(dimension: DataFrame, k: int = 25) -> DataFrame:
    rows = dimension.filter("coalesce(hosting_provider, '') <> ''")
    return rows.groupBy("hosting_provider").agg(F.count("*").alias("domains"), F.coalesce(F.sum("email_count"), F.lit(0)).cast("long").alias("emails")).orderBy(Q("domains").desc(), "hosting_provider").limit(k)


def unidentified_hosts(dimension: DataFrame) -> DataFrame:
    """Valid general domains without a hosting label: (domains, emails)."""
    rows = dimension.filter((Q("mx_category") == R.GENERAL) & Q("is_valid") & (F.coalesce("hosting_provider", F.lit("")) == ""))
    return rows.agg(F.count("*").alias("domains"), F.coalesce(F.sum("email_count"), F.lit(0)).cast("long").alias("emails"))


def suspicious_summary(dimension: DataFrame) -> DataFrame:
    """Scanned hosts with a suspicious banner, by host and banners: (mx_primary, ssh_banner, smtp_banner, domains, emails)."""
    ssh = Q("ssh_banner").like("%OpenSSH_9.2p1%") & Q("ssh_banner").like("%Debian%") & Q("ssh_banner").like("%deb12%")
    rows = dimension.filter(Q("fingerprint_scanned").isNotNull() & ~F.coalesce("is_spamtrap", F.lit(False)) & (ssh | Q("smtp_banner").rlike(R.GENERIC_ESMTP)))
    return rows.groupBy("mx_primary", "ssh_banner", "smtp_banner").agg(F.count("*").alias("domains"), F.coalesce(F.sum("email_count"), F.lit(0)).cast("long").alias("emails"))


def hosts_to_scan(dimension: DataFrame) -> DataFrame:
    """Distinct hosts of valid general domains that no banner scan has seen."""
    rows = dimension.filter(Q("is_valid") & (Q("mx_category") == R.GENERAL) & ~F.coalesce("is_spamtrap", F.lit(False)) & Q("mx_primary").isNotNull() & Q("fingerprint_scanned").isNull())
    return rows.select("mx_primary").distinct()


def host_matches(dimension: DataFrame, word: str) -> DataFrame:
    """(domain, mx_primary, email_count) of domains one of whose hosts contains the word, most contacts first."""
    hosts = [F.col("mx_primary")] + ([F.array_join("mx_records", ",")] if "mx_records" in dimension.columns else [])
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.lower(h), F.lit(word.lower())), F.lit(False)) for h in hosts])
    return dimension.filter(hit).select("domain", "mx_primary", "email_count").orderBy(Q("email_count").desc_nulls_last(), "domain")


def category_statistics(rows: DataFrame, k: int = 20) -> DataFrame:
    """(kind, name, n, pct): all three categories with their share to two places, the ``k`` commonest providers and brands."""
    per = shares(rows, "email_category", 2)
    every = rows.sparkSession.createDataFrame([(c,) for c in ("Big4_ISP", "Cable_Provider", R.GENERAL)], "email_category string")
    out = every.join(F.broadcast(per), "email_category", "left").select(F.lit("category").alias("kind"), Q("email_category").alias("name"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("pct", F.lit(0.0)).alias("pct"))
    for kind in ("provider", "brand"):
        best = top(rows.filter(Q(f"email_{kind}") != ""), f"email_{kind}", k)
        out = out.unionByName(best.select(F.lit(kind).alias("kind"), Q(f"email_{kind}").alias("name"), "n", F.lit(None).cast("double").alias("pct")))
    return out


def sample_counts(rows: DataFrame) -> DataFrame:
    """(name, n) of the five sample questions, from one scan."""
    verified = F.coalesce(Q("validation_status") == "Verified", F.lit(False))
    tests = {
        "big4_clickers": (Q("email_category") == "Big4_ISP") & Q("is_clicker"),
        "cable_openers": (Q("email_category") == "Cable_Provider") & Q("is_opener"),
        "glenn_verified": (Q("data_source") == "Glenn") & verified,
        "texas": Q("state") == "TX",
        "clicker_verified": Q("is_clicker") & verified,
    }
    row = rows.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), Q(n).alias("n")) for n in tests])).alias("_r")).select("_r.*")


def dead_domains(dimension: DataFrame, k: int = 500) -> DataFrame:
    return dimension.filter(~Q("is_valid")).select("domain", "email_count", "error_message").orderBy(Q("email_count").desc_nulls_last(), "domain").limit(k)


def trap_totals(contacts: DataFrame, dimension: DataFrame) -> DataFrame:
    return dimension.agg(F.count_if("is_spamtrap").alias("trap_domains")).join(F.broadcast(contacts.agg(F.count_if("is_spamtrap").alias("trap_emails"))))


def column_profile(cells: DataFrame, order: str | None = None) -> DataFrame:
    """From (pos, value): cells per type and the most frequent type that is not empty; ties by name, or by the first cell in ``order``."""
    first = F.min(order) if order else F.lit(0)
    per = cells.withColumn("cell_type", S.cell_type(Q("value"))).groupBy("pos", "cell_type").agg(F.count("*").alias("n"), first.alias("_first"))
    best = per.filter("cell_type <> 'empty'").groupBy("pos").agg(F.min(F.struct((-Q("n")).alias("_n"), "_first", "cell_type")).alias("_b"))
    return per.join(best, "pos", "left").select("pos", "cell_type", "n", F.coalesce("_b.cell_type", F.lit("empty")).alias("primary_type"))


def partials(rows: DataFrame, by: str, lg_k: int = 14) -> DataFrame:
    """One batch's share of the statistics per ``by``: sums, and a sketch of the domains (error about 1.04 / sqrt(2 ** lg_k))."""
    return rows.groupBy(F.col(by).alias("value")).agg(
        F.count("*").alias("n"),
        F.count_if("is_clicker").alias("clickers"),
        F.count_if("is_opener").alias("openers"),
        F.coalesce(F.sum("quality_score"), F.lit(0)).cast("long").alias("score_sum"),
        F.hll_sketch_agg("email_domain", lg_k).alias("domain_sketch"),
    )


def merge_partials(batches: DataFrame) -> DataFrame:
    """The statistics of all batches together, from their shares alone: sums are exact, ``domains`` is estimated."""
    sums = [F.sum(c).alias(c) for c in ("n", "clickers", "openers", "score_sum")]
    return batches.groupBy("value").agg(*sums, F.hll_sketch_estimate(F.hll_union_agg("domain_sketch")).alias("domains"))


def valid_share(dimension: DataFrame) -> DataFrame:
    """Percent of valid domains per resolver, to whole numbers."""
    both = Q("valid") + Q("dead")
    return server_pivot(dimension).select("dns_server", F.when(both > 0, F.round(100.0 * Q("valid") / both, 0).cast("long")).alias("valid_pct"))
