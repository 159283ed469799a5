"""Registered queries over the driver's tables, with DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from rosterforge.functions import scalars as S
from rosterforge.operators import contacts as C
from rosterforge.operators import importing, loading, merge, mx, segments, stats
from rosterforge.operators.segments import Segment
from rosterforge.plans.base import PRELUDE, TITLE, both, contacts, dimension, raw

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

MEASURES = """count(*) AS total, count(*) FILTER (WHERE mx_valid OR mx_valid IS NULL) AS good, count(*) FILTER (WHERE NOT mx_valid) AS dead,
  count(*) FILTER (WHERE quality_score >= 70) AS high, count(*) FILTER (WHERE quality_score >= 40 AND quality_score < 70) AS med,
  count(*) FILTER (WHERE quality_score < 40 OR quality_score IS NULL) AS low, count(*) FILTER (WHERE is_clicker) AS clickers, count(*) FILTER (WHERE is_opener) AS openers"""
DOMAINS = ", count(DISTINCT email_domain) AS domains"


def query(sql: str | None, prelude: bool = True):
    """Registers a query under its function's name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (PRELUDE if prelude else "") + sql
        return f

    return add


# Cleaning and validating


@query("SELECT contact_id, file_ordinal, email, email_domain FROM clean")
def clean_email(spark, sf):
    return C.clean(raw(spark, sf)).select("contact_id", "file_ordinal", "email", "email_domain")


@query("SELECT contact_id, file_ordinal, first_name, last_name, city, state, zipcode, phone, gender, validation_status FROM clean")
def clean_fields(spark, sf):
    return C.clean(raw(spark, sf)).select("contact_id", "file_ordinal", "first_name", "last_name", "city", "state", "zipcode", "phone", "gender", "validation_status")


@query("SELECT contact_id, file_ordinal, strftime(signup_date, '%Y-%m-%d %H:%M:%S') AS signup_date FROM clean")
def parse_date(spark, sf):
    return C.clean(raw(spark, sf)).select("contact_id", "file_ordinal", F.date_format("signup_date", "yyyy-MM-dd HH:mm:ss").alias("signup_date"))


@query("SELECT contact_id, file_ordinal, reject_reason FROM checked")
def validate_reasons(spark, sf):
    return C.with_reason(C.clean(raw(spark, sf))).select("contact_id", "file_ordinal", "reject_reason")


@query("SELECT r AS reject_reason, count(c.contact_id) AS n FROM (VALUES ('missing_email'), ('invalid_format'), ('role_email'), ('country_tld')) t(r) LEFT JOIN checked c ON r = reject_reason GROUP BY r")
def reject_counts(spark, sf):
    return C.reject_counts(C.clean(raw(spark, sf)))


@query("SELECT contact_id, file_ordinal, email FROM checked WHERE coalesce(reject_reason, '') NOT IN ('missing_email', 'invalid_format') AND email_domain NOT IN ('example.com', 'test.com', 'asdf.com', 'amazon.com')")
def import_policy(spark, sf):
    return C.importable(C.clean(raw(spark, sf))).select("contact_id", "file_ordinal", "email")


@query("SELECT c.file_ordinal, count(*) AS n_rows, count(*) FILTER (WHERE trim(coalesce(r.email, '')) <> '') AS n_with_email, count(*) FILTER (WHERE reject_reason IS NULL) AS n_valid, count(*) FILTER (WHERE reject_reason IS NOT NULL) AS n_rejected FROM checked c JOIN raw r USING (contact_id, file_ordinal) GROUP BY 1")
def run_funnel(spark, sf):
    return C.funnel(raw(spark, sf))


# Categories and scores


@query("SELECT contact_id, file_ordinal, email_provider, email_brand, email_category FROM contacts")
def categorize(spark, sf):
    return contacts(spark, sf).select("contact_id", "file_ordinal", "email_provider", "email_brand", "email_category")


@query("SELECT contact_id, file_ordinal, quality_score FROM contacts")
def quality_score(spark, sf):
    return contacts(spark, sf).select("contact_id", "file_ordinal", "quality_score")


@query("SELECT CASE WHEN grouping(email_category) = 1 THEN 'ALL' ELSE email_category END AS email_category, count(*) AS total, count(*) FILTER (WHERE mx_valid OR mx_valid IS NULL) AS good, count(*) FILTER (WHERE NOT mx_valid) AS dead, count(*) FILTER (WHERE is_clicker) AS clickers, count(*) FILTER (WHERE is_opener) AS openers, count(DISTINCT email_domain) AS domains FROM contacts GROUP BY ROLLUP (email_category)")
def category_stats(spark, sf):
    return stats.by_category(both(spark, sf)[0])


for _name, _col in (("category_counts", "email_category"), ("provider_counts", "email_provider"), ("brand_counts", "email_brand"), ("source_counts", "data_source")):
    QUERIES[_name] = lambda spark, sf, c=_col: stats.counts(contacts(spark, sf), c)
    ORACLES[_name] = PRELUDE + f"SELECT {_col} AS value, count(*) AS n FROM contacts GROUP BY 1"

_TIERS = "CASE WHEN quality_score >= 80 THEN 'Excellent' WHEN quality_score >= 60 THEN 'Good' WHEN quality_score >= 40 THEN 'Average' WHEN quality_score >= 20 THEN 'Below Average' ELSE 'Poor' END"


@query(f"SELECT {_TIERS} AS tier, count(*) AS n FROM contacts GROUP BY 1")
def quality_dist5(spark, sf):
    return stats.five_tiers(contacts(spark, sf))


def _some_unscored(rows):
    return rows.withColumn("quality_score", F.when(F.col("contact_id") % 5 != 0, F.col("quality_score")))


@query(f"SELECT CASE WHEN quality_score IS NULL THEN 'Not Scored' ELSE {_TIERS} END AS tier, count(*) AS n FROM (SELECT CASE WHEN contact_id % 5 <> 0 THEN quality_score END AS quality_score FROM contacts) GROUP BY 1")
def quality_dist6(spark, sf):
    return stats.six_tiers(_some_unscored(contacts(spark, sf)))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE email_category = 'Big4_ISP') AS big4, count(*) FILTER (WHERE email_category = 'Cable_Provider') AS cable, count(*) FILTER (WHERE email_category = 'General_Internet') AS gi, count(*) FILTER (WHERE is_clicker) AS clickers, count(*) FILTER (WHERE is_opener) AS openers, count(*) FILTER (WHERE quality_score >= 80) AS high_quality FROM contacts")
def overview_counts(spark, sf):
    return stats.overview(contacts(spark, sf))


# Breakdowns


@query(f"SELECT email_provider, {MEASURES}{DOMAINS} FROM contacts WHERE email_provider IN ('Google', 'Yahoo', 'Microsoft') GROUP BY 1")
def provider_breakdown(spark, sf):
    return stats.provider_breakdown(both(spark, sf)[0])


_CABLE = """CASE WHEN email_domain IN ('comcast.net', 'comcast.com', 'xfinity.com') THEN 'comcast'
  WHEN email_domain IN ('charter.net', 'charter.com', 'spectrum.net', 'brighthouse.com', 'rr.com', 'twc.com', 'roadrunner.com') OR email_domain LIKE '%.rr.com' THEN 'spectrum'
  WHEN email_domain IN ('centurylink.net', 'centurylink.com', 'centurytel.net', 'q.com', 'qwest.net', 'qwest.com', 'embarqmail.com', 'qwestoffice.net', 'uswest.net') THEN 'centurylink'
  WHEN email_domain IN ('earthlink.net', 'earthlink.com', 'mindspring.com') THEN 'earthlink'
  WHEN email_domain IN ('windstream.net', 'windstream.com') THEN 'windstream'
  WHEN email_domain IN ('optonline.net', 'optimum.net', 'cablevision.com') THEN 'optimum' END"""


@query(f"SELECT * FROM (SELECT {_CABLE} AS bucket, {MEASURES}{DOMAINS} FROM contacts WHERE email_category = 'Cable_Provider' GROUP BY 1) WHERE bucket IS NOT NULL")
def cable_breakdown(spark, sf):
    return stats.cable_breakdown(both(spark, sf)[0])


@query(f"SELECT {MEASURES}, CAST(3 AS BIGINT) AS domains FROM contacts WHERE email_domain IN ('icloud.com', 'me.com', 'mac.com')")
def apple_breakdown(spark, sf):
    return stats.apple_breakdown(both(spark, sf)[0])


@query(f"SELECT mx_category AS host_category, {MEASURES}{DOMAINS} FROM contacts WHERE email_category = 'General_Internet' AND mx_category IN ('Google', 'Microsoft', 'Yahoo') GROUP BY 1")
def second_level_big4(spark, sf):
    return stats.by_mx_category(*both(spark, sf), mx.BIG4_HOSTS)


@query(f"SELECT mx_category AS host_category, {MEASURES}{DOMAINS} FROM contacts WHERE email_category = 'General_Internet' AND mx_category IN ('Fastmail', 'ProtonMail', 'Amazon') GROUP BY 1")
def gi_hosting_category(spark, sf):
    return stats.by_mx_category(*both(spark, sf), ("Fastmail", "ProtonMail", "Amazon"))


_HOSTS = """CASE WHEN mx_primary ILIKE '%secureserver.net%' THEN 'godaddy' WHEN mx_primary ILIKE '%ionos%' OR mx_primary ILIKE '%1and1%' THEN '1and1'
  WHEN mx_primary ILIKE '%hostgator%' OR mx_primary ILIKE '%websitewelcome%' THEN 'hostgator' WHEN mx_primary ILIKE '%privateemail.com%' OR mx_primary ILIKE '%registrar-servers%' THEN 'namecheap'
  WHEN mx_primary ILIKE '%zoho%' THEN 'zoho' WHEN mx_primary ILIKE '%cloudflare.net%' THEN 'cloudflare' END"""


@query(f"SELECT * FROM (SELECT {_HOSTS} AS bucket, {MEASURES}{DOMAINS} FROM contacts JOIN (SELECT domain, mx_primary, mx_category AS mc FROM dim) ON domain = email_domain WHERE email_category = 'General_Internet' AND mc IN ('Real_GI', 'General_Internet') GROUP BY 1) WHERE bucket IS NOT NULL")
def gi_hosting(spark, sf):
    return stats.by_hosting(*both(spark, sf))


@query(f"SELECT email_domain, {MEASURES} FROM contacts WHERE email_category = 'General_Internet' AND email_domain NOT IN ('icloud.com', 'me.com', 'mac.com') GROUP BY 1 ORDER BY total DESC, email_domain LIMIT 10")
def top_gi_domains(spark, sf):
    return stats.top_gi_domains(both(spark, sf)[0])


@query("SELECT email_category, count(DISTINCT email_domain) AS domains, count(*) AS n FROM contacts GROUP BY 1")
def category_domain_counts(spark, sf):
    return stats.category_domains(contacts(spark, sf))


@query("SELECT email_category, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM contacts GROUP BY 1")
def category_pct(spark, sf):
    return stats.shares(contacts(spark, sf), "email_category")


@query("SELECT email_provider, count(*) AS n FROM contacts WHERE email_provider IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20")
def top_providers(spark, sf):
    return stats.top(contacts(spark, sf), "email_provider", 20)


@query("SELECT email_domain, count(*) AS n FROM contacts WHERE email_domain IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 50")
def domain_distribution(spark, sf):
    return stats.top(contacts(spark, sf), "email_domain", 50)


@query("SELECT email_domain, count(*) AS n FROM contacts WHERE email_category = 'General_Internet' GROUP BY 1")
def gi_domains(spark, sf):
    return stats.counts(contacts(spark, sf).filter("email_category = 'General_Internet'"), "email_domain", "email_domain")


_RATIO = "round(100 * {c} / total, 1) AS {c}_pct"


@query("SELECT *, " + ", ".join(_RATIO.format(c=c) for c in ("high_intent", "with_name", "with_phone", "with_zip")) + " FROM (SELECT count(*) AS total, count(*) FILTER (WHERE is_clicker) AS clickers, count(*) FILTER (WHERE is_opener) AS openers, count(*) FILTER (WHERE is_clicker AND quality_score >= 70) AS high_intent, count(*) FILTER (WHERE coalesce(first_name, '') <> '') AS with_name, count(*) FILTER (WHERE coalesce(phone, '') <> '') AS with_phone, count(*) FILTER (WHERE coalesce(zipcode, '') <> '') AS with_zip FROM contacts)")
def high_intent(spark, sf):
    return stats.high_intent(contacts(spark, sf))


@query("SELECT CASE WHEN email_domain LIKE '%.rr.com' THEN '*.rr.com' ELSE email_domain END AS domain, count(*) AS n FROM contacts WHERE email_domain LIKE '%.rr.com' OR email_domain IN (" + ", ".join(f"'{d}'" for d in stats.BIG4_REPORT + stats.CABLE_REPORT) + ") GROUP BY 1")
def detailed_domain_counts(spark, sf):
    return stats.domain_report(contacts(spark, sf))


@query("SELECT coalesce(a.email_category, b.email_category) AS stat_name, coalesce(b.n, 0) - coalesce(a.n, 0) AS change FROM (SELECT email_category, count(*) AS n FROM contacts WHERE file_ordinal = 0 GROUP BY 1) a FULL JOIN (SELECT email_category, count(*) AS n FROM contacts GROUP BY 1) b ON a.email_category = b.email_category")
def stats_delta(spark, sf):
    rows = contacts(spark, sf)
    snap = lambda r: r.groupBy(F.col("email_category").alias("stat_name")).agg(F.count("*").alias("stat_value"))
    return merge.delta(snap(rows.filter("file_ordinal = 0")), snap(rows))


# Facets

_FACETS = {
    "state": ("upper(state)", 100),
    "country": ("country", 50),
    "source": ("data_source", 100),
    "status": ("validation_status", 100),
    "gender": ("CASE WHEN upper(gender) IN ('M', 'MALE') THEN 'M' WHEN upper(gender) IN ('F', 'FEMALE') THEN 'F' ELSE gender END", 100),
    "city": (TITLE.format(x="city").replace("a-z", "a-z0-9"), 200),
    "zip5": ("left(zipcode, 5)", 200),
}
for _kind, (_expr, _k) in _FACETS.items():
    QUERIES[f"facet_{_kind}"] = lambda spark, sf, k=_kind: stats.facet(contacts(spark, sf), k)
    ORACLES[f"facet_{_kind}"] = PRELUDE + f"SELECT value, count(*) AS n FROM (SELECT {_expr} AS value FROM contacts) WHERE coalesce(value, '') <> '' GROUP BY 1 ORDER BY n DESC, value LIMIT {_k}"


@query("SELECT s AS file_source, count(*) AS n FROM (SELECT unnest(file_sources) AS s FROM contacts) GROUP BY 1")
def file_source_unnest(spark, sf):
    return stats.file_source_facet(contacts(spark, sf))


# Duplicates and merging

_PRIORITY = """CASE WHEN is_clicker THEN 1000 ELSE 0 END + CASE WHEN is_opener THEN 500 ELSE 0 END + CASE WHEN validation_status = 'Verified' THEN 200 ELSE 0 END
  + 10 * (""" + " + ".join(f"CASE WHEN coalesce(CAST({c} AS VARCHAR), '') <> '' THEN 1 ELSE 0 END" for c in ("first_name", "last_name", "address", "city", "state", "zipcode", "phone", "dob", "signup_date", "signup_ip")) + ") + CASE WHEN data_source <> 'Unknown' THEN 50 ELSE 0 END"
_RANKED = f", ranked AS (SELECT *, CAST({_PRIORITY} AS INTEGER) AS priority, row(CAST({_PRIORITY} AS INTEGER), -file_ordinal, -row_ordinal) AS rk FROM contacts)"
_FILLED = ", ".join(f"arg_max({c}, rk) FILTER (WHERE coalesce({c}, '') <> '') AS {c}" for c in ("first_name", "last_name", "address", "city", "state", "zipcode", "phone", "gender", "dob", "signup_domain", "signup_ip", "country", "custom1"))
_MERGED = f"arg_max(contact_id, rk) AS contact_id, arg_max(data_source, rk) AS data_source, arg_max(quality_score, rk) AS quality_score, {_FILLED}, bool_or(is_clicker) AS is_clicker, bool_or(is_opener) AS is_opener, CASE WHEN bool_or(coalesce(validation_status = 'Verified', false)) THEN 'Verified' ELSE arg_max(coalesce(validation_status, ''), rk) END AS validation_status, array_to_string(list_sort(list_distinct(flatten(list(file_sources)))), ',') AS file_sources"
_MERGE_COLUMNS = ("contact_id", "data_source", "quality_score", "first_name", "last_name", "address", "city", "state", "zipcode", "phone", "gender", "dob", "signup_domain", "signup_ip", "country", "custom1", "is_clicker", "is_opener")


def _merged_columns(rows):
    return rows.select("email", *_MERGE_COLUMNS, F.coalesce("validation_status", F.lit("")).alias("validation_status"), F.array_join("file_sources", ",").alias("file_sources"))


def _merged_sql(columns):
    """arg_max skips null values; what the best record lacks must stay lacking."""
    return columns.replace("arg_max(data_source, rk)", "nullif(arg_max(coalesce(data_source, ''), rk), '')")


@query(_RANKED + " SELECT contact_id, file_ordinal, priority FROM ranked")
def priority_score(spark, sf):
    return merge.priority(contacts(spark, sf)).select("contact_id", "file_ordinal", "priority")


@query(_RANKED + f" SELECT email, {_merged_sql(_MERGED)} FROM ranked GROUP BY email")
def dedup_merge(spark, sf):
    return _merged_columns(merge.merge_duplicates(contacts(spark, sf)))


@query(_RANKED + f", per AS (SELECT file_ordinal, email, {_merged_sql(_MERGED)} FROM ranked GROUP BY email, file_ordinal) SELECT * EXCLUDE (file_ordinal) FROM per QUALIFY row_number() OVER (PARTITION BY email ORDER BY file_ordinal) = 1")
def incremental_dedup(spark, sf):
    return _merged_columns(merge.incremental(contacts(spark, sf)))


def _master_batch(spark, sf):
    """File 0 is the stored table, file 1 the batch: addresses of either alone and of both."""
    rows = contacts(spark, sf).drop("mx_valid", "mx_category", "is_spamtrap")
    half = lambda f: merge.merge_duplicates(rows.filter(F.col("file_ordinal") == f), lower=True).drop("n_merged")
    return half(0), half(1)


_HALVES = _RANKED + f", half AS (SELECT * REPLACE (nullif(validation_status, '') AS validation_status) FROM (SELECT file_ordinal, email, {_merged_sql(_MERGED)} FROM ranked GROUP BY email, file_ordinal)), master AS (SELECT * FROM half WHERE file_ordinal = 0), batch AS (SELECT * FROM half WHERE file_ordinal = 1)"
_OUTCOME = "CASE WHEN o.email IS NULL THEN 'inserted' WHEN n.email IS NOT NULL THEN 'updated' ELSE 'kept' END AS outcome"


def _enrich_sql(new_first: tuple[str, ...], old_first: tuple[str, ...]) -> str:
    wins = [f"coalesce(n.{c}, o.{c}) AS {c}" for c in new_first] + [f"coalesce(o.{c}, n.{c}) AS {c}" for c in ("email", "contact_id", *old_first)]
    rest = "coalesce(o.is_clicker, false) OR coalesce(n.is_clicker, false) AS is_clicker, greatest(coalesce(o.quality_score, 0), coalesce(n.quality_score, 0)) AS quality_score, concat_ws(',', o.file_sources, n.file_sources) AS file_sources"
    return f"{_HALVES} SELECT {', '.join(wins)}, {rest}, {_OUTCOME} FROM master o FULL JOIN batch n ON o.email = n.email"


_SEVEN = ("first_name", "last_name", "address", "city", "state", "zipcode", "phone")
_LATE = ("dob", "gender", "signup_domain", "signup_ip")


def _enriched(spark, sf, fields):
    out = merge.enrich(*_master_batch(spark, sf), fields)
    return out.select("email", "contact_id", *_SEVEN, *_LATE, "validation_status", "is_clicker", "quality_score", F.array_join("file_sources", ",").alias("file_sources"), "outcome")


@query(_HALVES + " SELECT email, contact_id, file_ordinal FROM master UNION ALL SELECT email, contact_id, file_ordinal FROM batch WHERE email NOT IN (SELECT email FROM master)")
def insert_if_absent(spark, sf):
    return merge.insert_if_absent(*_master_batch(spark, sf)).select("email", "contact_id", "file_ordinal")


@query(_enrich_sql(_SEVEN, (*_LATE, "validation_status")))
def enrich_upsert_basic(spark, sf):
    return _enriched(spark, sf, merge.ENRICH)


@query(_enrich_sql((*_SEVEN, *_LATE), ("validation_status",)))
def enrich_upsert(spark, sf):
    return _enriched(spark, sf, merge.ENRICH_IMPORT)


@query(_HALVES + f" SELECT {_OUTCOME}, count(*) AS n FROM master o FULL JOIN batch n ON o.email = n.email GROUP BY 1")
def upsert_counts(spark, sf):
    return merge.outcome_counts(merge.enrich(*_master_batch(spark, sf)))


# Mail hosts


@query("SELECT domain, mx_category FROM dim")
def mx_classify(spark, sf):
    return dimension(contacts(spark, sf)).select("domain", "mx_category")


@query("SELECT domain, coalesce(hosting_provider, (SELECT arg_min(label, i) FROM labels WHERE contains(mx_primary, pat))) AS hosting_provider FROM dim")
def hosting_label(spark, sf):
    return mx.label_hosting(dimension(contacts(spark, sf))).select("domain", "hosting_provider")


@query("SELECT hosting_provider, count(*) AS domains, CAST(sum(email_count) AS BIGINT) AS emails FROM (SELECT email_count, coalesce(hosting_provider, (SELECT arg_min(label, i) FROM labels WHERE contains(mx_primary, pat))) AS hosting_provider FROM dim) WHERE hosting_provider IS NOT NULL GROUP BY 1 ORDER BY domains DESC, 1 LIMIT 25")
def hosting_summary(spark, sf):
    return stats.hosting_summary(mx.label_hosting(dimension(contacts(spark, sf))))


@query("SELECT email_domain AS domain, CAST(count(*) + any_value(email_count) AS BIGINT) AS email_count FROM contacts JOIN dim ON domain = email_domain GROUP BY 1")
def domain_backfill(spark, sf):
    rows = contacts(spark, sf)
    return mx.backfill(rows, dimension(rows), add=True)


@query("SELECT contact_id, file_ordinal, CASE WHEN is_valid THEN mx_category END AS mx_category, CASE WHEN is_valid THEN true END AS mx_valid, coalesce(is_valid, false) AS mx_changed FROM contacts0 LEFT JOIN dim ON domain = email_domain")
def apply_mx(spark, sf):
    rows = contacts(spark, sf)
    return mx.apply_mx(rows, dimension(rows)).select("contact_id", "file_ordinal", "mx_category", "mx_valid", "mx_changed")


@query("SELECT contact_id, file_ordinal, email_domain IN (SELECT domain FROM dim WHERE NOT is_valid) AS undeliverable FROM contacts")
def split_undeliverable(spark, sf):
    rows = contacts(spark, sf)
    good, dead = mx.split_undeliverable(rows, dimension(rows))
    pick = lambda r, v: r.select("contact_id", "file_ordinal", F.lit(v).alias("undeliverable"))
    return pick(good, False).unionByName(pick(dead, True))


@query("SELECT contact_id, file_ordinal, split_part(email, '@', 2) IN (SELECT domain FROM dim WHERE is_spamtrap) AS is_spamtrap FROM contacts")
def flag_spamtrap(spark, sf):
    rows = contacts(spark, sf)
    return mx.flag_spamtraps(rows, dimension(rows)).select("contact_id", "file_ordinal", "is_spamtrap")


@query("SELECT (SELECT count(*) FROM dim WHERE is_spamtrap) AS trap_domains, (SELECT count(*) FROM contacts WHERE email_domain IN (SELECT domain FROM dim WHERE is_spamtrap)) AS trap_emails")
def spamtrap_totals(spark, sf):
    rows = contacts(spark, sf)
    facts = dimension(rows)
    return stats.trap_totals(mx.flag_spamtraps(rows, facts), facts)


@query("SELECT domain FROM dim WHERE checked_at IS NULL AND domain NOT IN (SELECT domain FROM rules)")
def unchecked_domains(spark, sf):
    return mx.unchecked(dimension(contacts(spark, sf))).select("domain")


@query("SELECT domain FROM dim WHERE checked_at IS NULL AND domain NOT IN (SELECT domain FROM rules) ORDER BY domain LIMIT 1")
def unchecked_first(spark, sf):
    return mx.unchecked(dimension(contacts(spark, sf)), limit=1).select("domain")


@query("SELECT domain, CASE WHEN is_valid THEN mx_category END AS mx_category, CASE WHEN is_valid THEN checked_at IS NULL ELSE true END AS unchecked, true AS is_valid FROM dim")
def reset_dead(spark, sf):
    return mx.reset(dimension(contacts(spark, sf))).select("domain", "mx_category", F.col("checked_at").isNull().alias("unchecked"), "is_valid")


@query("SELECT coalesce(d.domain, g.domain) AS domain, coalesce(g.domain IS NOT NULL OR d.is_gi, g.domain IS NOT NULL) AS is_gi, d.domain IS NULL AS is_new FROM (SELECT * FROM dim WHERE domain IN (SELECT email_domain FROM contacts0 WHERE file_ordinal = 0)) d FULL JOIN (SELECT DISTINCT email_domain AS domain FROM contacts WHERE email_category = 'General_Internet') g ON d.domain = g.domain")
def sync_gi(spark, sf):
    rows = contacts(spark, sf)
    return mx.sync_gi(rows, dimension(rows.filter("file_ordinal = 0")))  # the dimension as it was before file 1 came


@query("SELECT count(*) AS total, count(checked_at) AS checked, count(*) - count(checked_at) AS unchecked, count(*) FILTER (WHERE is_gi) AS gi, count(*) FILTER (WHERE is_gi AND checked_at IS NULL) AS gi_unchecked, count(*) FILTER (WHERE NOT is_valid) AS dead FROM dim")
def domain_state(spark, sf):
    return stats.dimension_state(dimension(contacts(spark, sf)))


@query("SELECT count(checked_at) AS checked, count(*) FILTER (WHERE checked_at IS NOT NULL AND is_valid) AS valid, count(*) FILTER (WHERE checked_at IS NOT NULL AND NOT is_valid) AS dead, CAST(coalesce(sum(email_count) FILTER (WHERE checked_at IS NOT NULL), 0) AS BIGINT) AS emails_checked, CAST(coalesce(sum(email_count) FILTER (WHERE checked_at IS NOT NULL AND is_valid), 0) AS BIGINT) AS emails_valid, CAST(coalesce(sum(email_count) FILTER (WHERE checked_at IS NOT NULL AND NOT is_valid), 0) AS BIGINT) AS emails_dead FROM dim")
def scan_stats(spark, sf):
    return stats.scan_stats(dimension(contacts(spark, sf)))


@query("SELECT CASE WHEN mx_category IN ('Google', 'Microsoft', 'Yahoo', 'HostGator', 'GoDaddy', '1and1', 'Zoho', 'Real_GI', 'General_Internet', 'Dead', 'Parked') THEN mx_category ELSE 'Other' END AS host_category, count(*) AS n FROM dim GROUP BY 1")
def host_histogram(spark, sf):
    return stats.host_histogram(dimension(contacts(spark, sf)))


@query("SELECT mx_category, CAST(sum(email_count) AS BIGINT) AS emails FROM dim GROUP BY 1")
def emails_by_host(spark, sf):
    return stats.emails_by_host(dimension(contacts(spark, sf)))


@query("SELECT dns_server, count(*) FILTER (WHERE is_valid) AS valid, count(*) FILTER (WHERE NOT is_valid) AS dead FROM dim GROUP BY 1")
def dns_pivot(spark, sf):
    return stats.server_pivot(dimension(contacts(spark, sf)))


@query("SELECT domain, email_count, error_message FROM dim WHERE NOT is_valid ORDER BY email_count DESC, domain LIMIT 500")
def dead_domains(spark, sf):
    return stats.dead_domains(dimension(contacts(spark, sf)))


# Segments

_GI_TX = Segment(category="General_Internet", state="tx", quality="high", no_spamtraps=True)
_SEGMENTS = [Segment(clickers=True, openers=True), Segment(category="General_Internet", mx_big4=True), Segment(provider="Yahoo", quality="low"), Segment(validation_status="verified", states=("NY", "CA"), has_phone=True)]
_UNION = "(is_clicker OR is_opener) OR (email_category = 'General_Internet' AND mx_category IN ('Google', 'Microsoft', 'Yahoo')) OR (email_provider = 'Yahoo' AND quality_score < 40) OR (validation_status = 'Verified' AND state IN ('NY', 'CA') AND coalesce(phone, '') <> '')"


@query(_RANKED + f" SELECT email, contact_id, quality_score FROM (SELECT email, any_value(email_category) AS email_category, {_merged_sql(_MERGED)} FROM ranked GROUP BY email) WHERE email_category = 'General_Internet' ORDER BY quality_score DESC NULLS LAST, email LIMIT 50 OFFSET 20")
def filter_query_page(spark, sf):
    rows = segments.select(merge.merge_duplicates(contacts(spark, sf)), Segment(category="General_Internet", no_spamtraps=True))
    return segments.page(rows, limit=50, offset=20).select("email", "contact_id", "quality_score")


@query("SELECT count(*) AS n FROM contacts WHERE email_category = 'General_Internet' AND upper(state) = 'TX' AND quality_score >= 70")
def filter_count(spark, sf):
    return segments.select(contacts(spark, sf), _GI_TX).agg(F.count("*").alias("n"))


@query("SELECT contact_id, file_ordinal, email FROM contacts WHERE contains(lower(email), 'build') AND zipcode LIKE '100%' AND state NOT IN ('TX') AND gender = 'M' AND country = 'US' AND signup_date IS NULL = false AND CAST(signup_date AS VARCHAR) >= '2020' AND list_contains(file_sources, 'file_0')")
def filter_all_kinds(spark, sf):
    s = Segment(email_contains="BUILD", zip_prefix="100", exclude_states=("TX",), gender="M", country="US", signup_from="2020", file_source="file_0")
    return segments.select(contacts(spark, sf), s).select("contact_id", "file_ordinal", "email")


@query(f"SELECT count(DISTINCT email) AS n_emails FROM contacts WHERE {_UNION}")
def segment_count(spark, sf):
    rows = contacts(spark, sf)
    return segments.union_count(rows, _SEGMENTS, dimension(rows))


@query(f"SELECT DISTINCT email FROM contacts WHERE {_UNION}")
def segment_union(spark, sf):
    rows = contacts(spark, sf)
    return segments.union(rows, _SEGMENTS, dimension(rows)).select("email").distinct()


#: Presets told apart by engagement, written out for the oracle: name and condition.
_ENGAGED = (
    ("all", "true"),
    ("gi", "email_category = 'General_Internet'"),
    ("cable", "email_category = 'Cable_Provider'"),
    ("big4", "email_category = 'Big4_ISP'"),
    ("google", "email_provider = 'Google'"),
    ("yahoo", "email_provider = 'Yahoo'"),
    ("microsoft", "email_provider = 'Microsoft'"),
    ("aol", "email_provider = 'AOL'"),
    ("2nd_google", "email_category = 'General_Internet' AND mx_category = 'Google'"),
    ("2nd_microsoft", "email_category = 'General_Internet' AND mx_category = 'Microsoft'"),
    ("2nd_yahoo", "email_category = 'General_Internet' AND mx_category = 'Yahoo'"),
    ("2nd_big4_all", "email_category = 'General_Internet' AND mx_category IN ('Google', 'Microsoft', 'Yahoo')"),
    ("apple", "email_provider = 'Apple'"),
    ("spectrum", "email_provider = 'Spectrum'"),
    ("comcast", "email_provider = 'Comcast'"),
    ("att", "email_provider = 'AT&T'"),
)
_PLAIN = (
    ("godaddy_clickers", "email_provider = 'GoDaddy' AND is_clicker"),
    ("earthlink_clickers", "email_provider = 'EarthLink' AND is_clicker"),
    ("high_quality", "quality_score >= 70"),
    ("med_quality", "quality_score BETWEEN 40 AND 69"),
    ("verified_all", "validation_status = 'Verified'"),
)
_PRESETS = [*((f"{k}_{w}s", f"{c} AND is_{w}") for k, c in _ENGAGED for w in ("clicker", "opener")), *_PLAIN]


@query(" UNION ALL ".join(f"SELECT '{k}' AS preset, count(*) AS n FROM contacts WHERE {c}" for k, c in _PRESETS))
def preset_counts(spark, sf):
    rows = contacts(spark, sf)
    return segments.preset_counts(rows, dimension(rows))


@query("SELECT email, coalesce(first_name, '') AS first_name, coalesce(state, '') AS state, CAST(quality_score AS VARCHAR) AS quality_score, CASE WHEN is_clicker THEN 'true' ELSE 'false' END AS is_clicker, coalesce(strftime(signup_date, '%Y-%m-%d %H:%M:%S'), '') AS signup_date, array_to_string(file_sources, '; ') AS file_sources FROM contacts WHERE is_clicker AND state NOT IN ('TX')")
def export_segment(spark, sf):
    rows = segments.select(contacts(spark, sf), Segment(clickers=True, exclude_states=("TX",)))
    return segments.export_rows(rows.select("email", "first_name", "state", "quality_score", "is_clicker", "signup_date", "file_sources"))


# Imports

_PLAIN = "CASE WHEN lower(trim(r.{c})) NOT IN ('null', 'none', '') THEN trim(r.{c}) END"
_DAY = "coalesce(CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_strptime({x}, '%Y-%m-%d') END, CASE WHEN regexp_full_match({x}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN try_strptime({x}, '%m/%d/%Y') END)"
_IMPORTED = f""", imp AS (SELECT c.contact_id, c.file_ordinal, c.row_ordinal, c.email, c.email_domain, {", ".join(_PLAIN.format(c=c) + f" AS {c}" for c in ("first_name", "last_name", "address", "city", "state", "zipcode", "phone", "signup_ip", "signup_domain"))},
  CASE WHEN upper(trim(r.gender)) IN ('MALE', 'M') THEN 'M' WHEN upper(trim(r.gender)) IN ('FEMALE', 'F') THEN 'F' ELSE left({_PLAIN.format(c="gender")}, 1) END AS gender,
  CAST({_DAY.format(x="left(trim(r.dob), 10)")} AS DATE) AS dob, {_DAY.format(x="left(trim(r.signup_date), 10)")} AS signup_date, r.is_clicker, r.is_opener,
  coalesce(rc, CASE WHEN ends_with(c.email_domain, '.rr.com') THEN 'Cable_Provider' END, 'General_Internet') AS category
  FROM checked c JOIN raw r USING (contact_id, file_ordinal) LEFT JOIN rules ON domain = c.email_domain
  WHERE coalesce(reject_reason, '') NOT IN ('missing_email', 'invalid_format') AND c.email_domain NOT IN ('example.com', 'test.com', 'asdf.com', 'amazon.com')),
one AS (SELECT * FROM imp QUALIFY row_number() OVER (PARTITION BY email, file_ordinal ORDER BY row_ordinal) = 1)"""
_IMPORT_FIELDS = ("first_name", "last_name", "address", "city", "state", "zipcode", "phone", "gender", "signup_ip", "signup_domain")


@query(_IMPORTED + f" SELECT coalesce(o.email, n.email) AS email, coalesce(o.contact_id, n.contact_id) AS contact_id, {', '.join(f'coalesce(n.{c}, o.{c}) AS {c}' for c in _IMPORT_FIELDS)}, strftime(coalesce(n.dob, o.dob), '%Y-%m-%d') AS dob, strftime(coalesce(n.signup_date, o.signup_date), '%Y-%m-%d') AS signup_date, coalesce(o.is_clicker, false) OR coalesce(n.is_clicker, false) AS is_clicker, {_OUTCOME} FROM (SELECT * FROM one WHERE file_ordinal = 0) o FULL JOIN (SELECT * FROM one WHERE file_ordinal = 1) n ON o.email = n.email")
def import_upsert(spark, sf):
    rows = raw(spark, sf)
    part = lambda f: rows.filter(F.col("file_ordinal") == f)
    stored = importing.first_of_each(importing.staged(importing.records(part(0))))
    out = importing.upsert(stored, part(1))
    return out.select("email", "contact_id", *_IMPORT_FIELDS, F.date_format("dob", "yyyy-MM-dd").alias("dob"), F.date_format("signup_date", "yyyy-MM-dd").alias("signup_date"), "is_clicker", "outcome")


@query(_IMPORTED + " SELECT bucket, count(i.b) AS n FROM (VALUES ('big4'), ('cable'), ('gi_valid'), ('gi_dead'), ('gi_new')) t(bucket) LEFT JOIN (SELECT CASE WHEN category = 'Big4_ISP' THEN 'big4' WHEN category = 'Cable_Provider' THEN 'cable' WHEN is_valid THEN 'gi_valid' WHEN NOT is_valid THEN 'gi_dead' ELSE 'gi_new' END AS b FROM imp LEFT JOIN dim ON domain = email_domain) i ON b = bucket GROUP BY 1")
def import_counters(spark, sf):
    return importing.counters(importing.records(raw(spark, sf)), dimension(contacts(spark, sf)))


# Exports and further reports

_DATES = {"dob": "dob", "signup_date": "strftime(signup_date, '%Y-%m-%d %H:%M:%S')", "created_at": "CAST(NULL AS VARCHAR)"}


def _projection_sql(n: int, where: str) -> str:
    return f"SELECT {', '.join(f'{_DATES[c]} AS {c}' if c in _DATES else c for c in segments.PROJECTIONS[n])} FROM contacts WHERE {where}"


@query(_projection_sql(17, "email_category = 'Cable_Provider' AND is_opener"))
def export_17(spark, sf):
    return segments.project(segments.select(contacts(spark, sf), Segment(category="Cable_Provider", openers=True)), 17)


@query(_projection_sql(18, "email_category = 'Big4_ISP' AND is_clicker"))
def export_18(spark, sf):
    return segments.project(segments.select(contacts(spark, sf), Segment(category="Big4_ISP", clickers=True)), 18)


@query(f"SELECT DISTINCT * FROM ({_projection_sql(19, _UNION)})")
def segment_union_rows(spark, sf):
    rows = contacts(spark, sf)
    return segments.union_rows(rows, _SEGMENTS, dimension(rows))


@query("SELECT 'category' AS kind, c AS name, count(email_category) AS n, round(100.0 * count(email_category) / (SELECT count(*) FROM contacts), 2) AS pct FROM (VALUES ('Big4_ISP'), ('Cable_Provider'), ('General_Internet')) t(c) LEFT JOIN contacts ON email_category = c GROUP BY c UNION ALL SELECT * FROM (SELECT 'provider', email_provider, count(*) AS n, NULL FROM contacts WHERE coalesce(email_provider, '') <> '' GROUP BY 2 ORDER BY n DESC, 2 LIMIT 20) UNION ALL SELECT * FROM (SELECT 'brand', email_brand, count(*) AS n, NULL FROM contacts WHERE coalesce(email_brand, '') <> '' GROUP BY 2 ORDER BY n DESC, 2 LIMIT 20)")
def category_statistics(spark, sf):
    return stats.category_statistics(contacts(spark, sf))


@query("SELECT unnest(['big4_clickers', 'cable_openers', 'glenn_verified', 'texas', 'clicker_verified']) AS name, unnest([count(*) FILTER (WHERE email_category = 'Big4_ISP' AND is_clicker), count(*) FILTER (WHERE email_category = 'Cable_Provider' AND is_opener), count(*) FILTER (WHERE data_source = 'Glenn' AND validation_status = 'Verified'), count(*) FILTER (WHERE state = 'TX'), count(*) FILTER (WHERE is_clicker AND validation_status = 'Verified')]) AS n FROM contacts")
def sample_counts(spark, sf):
    return stats.sample_counts(contacts(spark, sf))


_LABELLED = "SELECT *, coalesce(hosting_provider, (SELECT arg_min(label, i) FROM labels WHERE contains(mx_primary, pat))) AS hp FROM dim"


@query(f"SELECT count(*) AS domains, CAST(coalesce(sum(email_count), 0) AS BIGINT) AS emails FROM ({_LABELLED}) WHERE mx_category = 'General_Internet' AND is_valid AND coalesce(hp, '') = ''")
def unidentified_hosts(spark, sf):
    return stats.unidentified_hosts(mx.label_hosting(dimension(contacts(spark, sf))))


_BANNERS = "SELECT *, CASE WHEN checked_at IS NOT NULL AND is_gi THEN checked_at END AS fingerprint_scanned, CASE dns_server WHEN '8.8.8.8' THEN 'SSH-2.0-OpenSSH_9.2p1 Debian-2+deb12u2' WHEN '1.1.1.1' THEN 'SSH-2.0-OpenSSH_8.4' END AS ssh_banner, CASE WHEN is_gi THEN '220 ' || domain || ' ESMTP' ELSE '220 x ESMTP Postfix' END AS smtp_banner FROM {d}"


@query(f"SELECT mx_primary, ssh_banner, smtp_banner, count(*) AS domains, CAST(sum(email_count) AS BIGINT) AS emails FROM ({_BANNERS.format(d='dim')}) WHERE fingerprint_scanned IS NOT NULL AND is_spamtrap IS NOT TRUE AND ((ssh_banner LIKE '%OpenSSH_9.2p1%' AND ssh_banner LIKE '%Debian%' AND ssh_banner LIKE '%deb12%') OR regexp_matches(smtp_banner, '^220\\s+\\S+\\s+ESMTP\\s*$')) GROUP BY 1, 2, 3")
def suspicious_summary(spark, sf):
    return stats.suspicious_summary(spark.sql(_BANNERS.format(d="{d}"), d=dimension(contacts(spark, sf))))


@query(f"SELECT DISTINCT mx_primary FROM ({_BANNERS.format(d='dim')}) WHERE is_valid AND mx_category = 'General_Internet' AND is_spamtrap IS NOT TRUE AND mx_primary IS NOT NULL AND fingerprint_scanned IS NULL")
def hosts_to_scan(spark, sf):
    return stats.hosts_to_scan(spark.sql(_BANNERS.format(d="{d}"), d=dimension(contacts(spark, sf))))


@query("SELECT domain, mx_primary, email_count FROM dim WHERE mx_primary ILIKE '%google%'")
def host_matches(spark, sf):
    return stats.host_matches(dimension(contacts(spark, sf)), "GOOGLE")


@query("SELECT domain, CASE dns_server WHEN '8.8.8.8' THEN 'Google-1' WHEN '1.1.1.1' THEN 'Cloudflare-1' ELSE dns_server END AS resolver FROM dim")
def resolver_names(spark, sf):
    return dimension(contacts(spark, sf)).select("domain", S.resolver_name(F.col("dns_server")).alias("resolver"))


@query("SELECT dns_server, CAST(round(100.0 * count(*) FILTER (WHERE is_valid) / count(*), 0) AS BIGINT) AS valid_pct FROM dim GROUP BY 1")
def dns_valid_share(spark, sf):
    return stats.valid_share(dimension(contacts(spark, sf)))


# Pages and fields that few segments use


@query("SELECT contact_id, file_ordinal, email, strftime(signup_date, '%Y-%m-%d %H:%M:%S') AS signup_date FROM contacts WHERE file_ordinal = 0 ORDER BY signup_date DESC NULLS FIRST, email LIMIT 40 OFFSET 5")
def newest_signups_page(spark, sf):
    rows = contacts(spark, sf).filter("file_ordinal = 0")
    rows = rows.withColumn("signup_date", F.date_format("signup_date", "yyyy-MM-dd HH:mm:ss"))
    return segments.page(rows, 40, 5, by="signup_date", nulls_first=True).select("contact_id", "file_ordinal", "email", "signup_date")


@query("SELECT email, CAST(known_score AS VARCHAR) AS known_score FROM (SELECT email, CASE WHEN quality_score >= 60 THEN quality_score END AS known_score FROM contacts WHERE file_ordinal = 1) ORDER BY CAST(known_score AS INTEGER) DESC NULLS FIRST, email LIMIT 15")
def best_scores_nulls_first(spark, sf):
    rows = contacts(spark, sf).filter("file_ordinal = 1").withColumn("known_score", F.when(F.col("quality_score") >= 60, F.col("quality_score")))
    return segments.page(rows, 15, by="known_score", nulls_first=True).select("email", F.col("known_score").cast("string").alias("known_score"))


@query("SELECT contact_id, file_ordinal FROM contacts WHERE quality_score >= 55 AND signup_ip LIKE '10.0.1%' AND dob IS NOT NULL AND strftime(signup_date, '%Y-%m-%d %H:%M:%S') <= '2023-12-31'")
def filter_rare_fields(spark, sf):
    segment = Segment(min_score=55, ip_prefix="10.0.1", has_dob=True, signup_to="2023-12-31")
    return segments.select(contacts(spark, sf), segment).select("contact_id", "file_ordinal")


# Loading

_CELL_DATE = r"""CASE WHEN regexp_full_match(d, '\d{1,2}/\d{1,2}/\d{4}') THEN coalesce(try_strptime(d, '%m/%d/%Y'), try_strptime(d, '%d/%m/%Y')) WHEN regexp_full_match(d, '\d{4}-\d{1,2}-\d{1,2}') THEN try_strptime(d, '%Y-%m-%d')
  WHEN regexp_full_match(d, '\d{1,2}-\d{1,2}-\d{4}') THEN try_strptime(d, '%m-%d-%Y') WHEN regexp_full_match(d, '\d{4}/\d{1,2}/\d{1,2}') THEN try_strptime(d, '%Y/%m/%d') END"""
_BAD = f"""SELECT contact_id, file_ordinal, field, value, 'no date' AS reason FROM (SELECT *, split_part(trim(value), ' ', 1) AS d FROM (
    SELECT contact_id, file_ordinal, 'dob' AS field, dob AS value FROM raw UNION ALL SELECT contact_id, file_ordinal, 'signup_date', signup_date FROM raw)) WHERE coalesce(trim(value), '') <> '' AND {_CELL_DATE} IS NULL
  UNION ALL SELECT contact_id, file_ordinal, 'gender', gender, 'neither M nor F' FROM raw WHERE coalesce(trim(gender), '') <> '' AND lower(trim(gender)) NOT IN ('m', 'male', 'f', 'female')
  UNION ALL SELECT contact_id, file_ordinal, 'data_source', data_source, 'cut to 100' FROM raw WHERE length(data_source) > 100"""


@query(_BAD)
def load_quarantine(spark, sf):
    return loading.quarantine(loading.load_rows(raw(spark, sf)), "contact_id", "file_ordinal")


@query("SELECT email_category AS value, count(*) AS n, count(*) FILTER (WHERE is_clicker) AS clickers, count(*) FILTER (WHERE is_opener) AS openers, CAST(sum(quality_score) AS BIGINT) AS score_sum, count(DISTINCT email_domain) AS domains FROM contacts GROUP BY 1")
def maintained_stats(spark, sf):
    rows = contacts(spark, sf)
    shares = [stats.partials(rows.filter(F.col("file_ordinal") == f), "email_category") for f in (0, 1)]
    return stats.merge_partials(shares[0].unionByName(shares[1]))


# Cells

_CELLS = "SELECT 0 AS pos, url AS value FROM {p} UNION ALL SELECT 1, CAST(page_id AS VARCHAR(20)) FROM {p} UNION ALL SELECT 2, c_name FROM {c} UNION ALL SELECT 3, CASE c_custkey % 7 WHEN 0 THEN 'a@b.com' WHEN 1 THEN '10.0.0.1' WHEN 2 THEN '2024-01-02' WHEN 3 THEN substr('txNYdcCaguzz', CAST(1 + 2 * (c_custkey % 6) AS INT), 2) WHEN 4 THEN '12345' WHEN 5 THEN 'female' ELSE '(743) 555-0101' END FROM {c} UNION ALL SELECT 4, CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE 'www.x.org' END FROM {c}"
# State and territory codes.
_STATES = "'AL', 'AK', 'AZ', 'AR', 'CA', 'CO', 'CT', 'DE', 'DC', 'FL', 'GA', 'HI', 'ID', 'IL', 'IN', 'IA', 'KS', 'KY', 'LA', 'ME', 'MD', 'MA', 'MI', 'MN', 'MS', 'MO', 'MT', 'NE', 'NV', 'NH', 'NJ', 'NM', 'NY', 'NC', 'ND', 'OH', 'OK', 'OR', 'PA', 'RI', 'SC', 'SD', 'TN', 'TX', 'UT', 'VT', 'VA', 'WA', 'WV', 'WI', 'WY', 'PR', 'VI', 'GU', 'AS', 'MP'"
_TYPE = r"""CASE WHEN trim(coalesce(value, '')) = '' THEN 'empty' WHEN regexp_matches(trim(value), '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$') THEN 'email' WHEN regexp_full_match(trim(value), '\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}') THEN 'ip'
  WHEN regexp_matches(trim(value), '^\d{1,4}[-/]\d{1,2}[-/]\d{1,4}') THEN 'date' WHEN upper(trim(value)) IN (__STATES__) THEN 'state' WHEN regexp_full_match(trim(value), '\d{5}(-\d{4})?') THEN 'zip' WHEN upper(trim(value)) IN ('M', 'F', 'MALE', 'FEMALE') THEN 'gender'
  WHEN length(regexp_replace(value, '\D', '', 'g')) BETWEEN 7 AND 15 AND regexp_full_match(trim(value), '[\d\-\(\)\s\.]{7,20}') THEN 'phone' WHEN value LIKE 'http%' OR regexp_matches(value, '\.com|\.net|\.org') THEN 'domain' ELSE 'text' END""".replace("__STATES__", _STATES)
_TYPED = f"WITH cells AS ({_CELLS.format(p='pages', c='customer')}), typed AS (SELECT pos, {_TYPE} AS cell_type FROM cells)"


def _cells(spark, sf):
    return spark.sql(_CELLS, p=spark.read.parquet(f"{sf}/pages.parquet"), c=spark.read.parquet(f"{sf}/customer.parquet"))


@query(_TYPED + " SELECT pos, cell_type, count(*) AS n FROM typed GROUP BY 1, 2", prelude=False)
def cell_types(spark, sf):
    return _cells(spark, sf).groupBy("pos", S.cell_type(F.col("value")).alias("cell_type")).agg(F.count("*").alias("n"))


@query(_TYPED + ", per AS (SELECT pos, cell_type, count(*) AS n FROM typed GROUP BY 1, 2), best AS (SELECT pos, cell_type AS primary_type FROM per WHERE cell_type <> 'empty' QUALIFY row_number() OVER (PARTITION BY pos ORDER BY n DESC, cell_type) = 1) SELECT pos, cell_type, n, coalesce(primary_type, 'empty') AS primary_type FROM per LEFT JOIN best USING (pos)", prelude=False)
def column_profile(spark, sf):
    return stats.column_profile(_cells(spark, sf))


_PLACED = "SELECT pos, value, row_number() OVER (PARTITION BY pos ORDER BY value DESC) AS place FROM ({c}) WHERE pos > 1"


@query(f"WITH cells AS ({_PLACED.format(c=_CELLS.format(p='pages', c='customer'))}), typed AS (SELECT pos, place, {_TYPE} AS cell_type FROM cells), per AS (SELECT pos, cell_type, count(*) AS n, min(place) AS first FROM typed GROUP BY 1, 2), best AS (SELECT pos, cell_type AS primary_type FROM per WHERE cell_type <> 'empty' QUALIFY row_number() OVER (PARTITION BY pos ORDER BY n DESC, first) = 1) SELECT pos, cell_type, n, coalesce(primary_type, 'empty') AS primary_type FROM per LEFT JOIN best USING (pos)", prelude=False)
def column_profile_first_seen(spark, sf):
    return stats.column_profile(spark.sql(_PLACED.format(c="SELECT * FROM {c}"), c=_cells(spark, sf)), order="place")
