"""The contact tables that the registered queries work on, derived from the driver's tables.

``RAW`` runs unchanged on Spark and DuckDB; everything after it is written twice: with the
library's operators for Spark, and as independent SQL (``PRELUDE``) for DuckDB.  Every
customer is a contact of file 0, of file 1 or of both, by market segment, so files share
some addresses and each has some of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.functions import rules as R
from rosterforge.functions import scalars as S
from rosterforge.operators import contacts as C
from rosterforge.operators import mx

AS_OF = "2024-06-30"

RAW = r"""
WITH ev AS (
  SELECT user_id, max(CASE WHEN event_type = 'click' AND value > 180 THEN 1 ELSE 0 END) AS clk,
         max(CASE WHEN event_type = 'view' AND value > 150 THEN 1 ELSE 0 END) AS opn
  FROM {events} GROUP BY user_id),
d AS (
  SELECT c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment, n.n_name,
    CASE c_custkey % 32 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com' WHEN 2 THEN 'hotmail.com'
      WHEN 3 THEN 'aol.com' WHEN 4 THEN 'comcast.net' WHEN 5 THEN 'tx.rr.com' WHEN 6 THEN 'zz.rr.com'
      WHEN 7 THEN 'gmial.com' WHEN 8 THEN 'gmail.co' WHEN 9 THEN 'firma.de' WHEN 10 THEN 'icloud.com'
      WHEN 11 THEN 'example.com' WHEN 12 THEN 'centurylink.net' WHEN 13 THEN 'earthlink.net' WHEN 14 THEN 'windstream.net'
      WHEN 15 THEN 'optonline.net' WHEN 16 THEN 'charter.net' WHEN 17 THEN 'me.com' WHEN 18 THEN lower(c_mktsegment) || '-mail.org'
      ELSE 'shop' || CAST(c_custkey % 37 AS VARCHAR(10)) || '.org' END AS dom,
    CASE WHEN c_custkey % 23 = 0 THEN 'info' WHEN c_custkey % 29 = 0 THEN 'ab'
      WHEN c_custkey % 31 = 0 THEN 'bad..name' WHEN c_custkey % 19 = 0 THEN '12345' || CAST(c_custkey AS VARCHAR(20))
      ELSE lower(c_mktsegment) || '.' || CAST(c_custkey AS VARCHAR(20)) END AS loc
  FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey),
x AS (SELECT d.*, 0 AS f FROM d WHERE c_mktsegment <> 'FURNITURE' UNION ALL SELECT d.*, 1 AS f FROM d WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY'))
SELECT c_custkey AS contact_id, f AS file_ordinal, c_custkey AS row_ordinal,
  CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ' <' || upper(loc || '@' || dom) || '> '
       WHEN c_custkey % 11 = 0 THEN 'mailto:' || loc || '@' || dom ELSE loc || '@' || dom END AS email,
  CASE WHEN (c_custkey + f) % 3 = 0 THEN NULL WHEN (c_custkey + f) % 3 = 1 THEN ' mary-ann o''NEIL ' ELSE c_name END AS first_name,
  CASE WHEN (c_custkey + f) % 5 = 0 THEN '' ELSE n_name || ' 2nd' END AS last_name,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR(20)) || ' Main St' END AS address,
  CASE WHEN c_custkey % 4 = 1 THEN 'new york' WHEN c_custkey % 4 = 2 THEN 'st. john''s' WHEN c_custkey % 4 = 3 THEN '' ELSE n_name END AS city,
  CASE WHEN c_custkey % 5 = 0 THEN 'new york' WHEN c_custkey % 5 = 1 THEN 'tx' WHEN c_custkey % 5 = 2 THEN 'N/A' WHEN c_custkey % 5 = 3 THEN 'CA' END AS state,
  CASE WHEN c_custkey % 3 = 0 THEN '1234' ELSE CAST(10000 + c_custkey % 89 AS VARCHAR(10)) || '-0001' END AS zipcode,
  CASE WHEN c_custkey % 4 = 0 THEN '1 (743) 555-' || CAST(1000 + c_custkey % 9000 AS VARCHAR(10)) WHEN c_custkey % 4 = 1 THEN 'n/a' WHEN c_custkey % 4 = 2 THEN NULL ELSE '743.555.0199' END AS phone,
  CASE (c_custkey + f) % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'female' WHEN 2 THEN 'x' WHEN 3 THEN NULL ELSE 'Male' END AS gender,
  CASE c_custkey % 8 WHEN 0 THEN '2024-01-15' WHEN 1 THEN '03/04/2023' WHEN 2 THEN '25/12/2022' WHEN 3 THEN 'soon' WHEN 4 THEN NULL WHEN 5 THEN '2019-07-01 10:20:30' WHEN 6 THEN '01/02/70' ELSE '2023-02-29' END AS signup_date,
  CASE (c_custkey + f) % 6 WHEN 0 THEN 'Verified' WHEN 1 THEN 'unverified' WHEN 2 THEN '0' WHEN 3 THEN 'abc' WHEN 4 THEN NULL ELSE 'valid' END AS validation_status,
  CASE (c_custkey + f) % 4 WHEN 0 THEN 'Glenn' WHEN 1 THEN 'GIO' WHEN 2 THEN 'Unknown' END AS data_source,
  CASE WHEN c_custkey % 9 = 0 THEN 'CA' ELSE 'US' END AS country,
  CASE (c_custkey + f) % 4 WHEN 0 THEN '1970-02-03' WHEN 1 THEN '04/05/1981' WHEN 2 THEN '' END AS dob,
  CASE (c_custkey + f) % 3 WHEN 0 THEN '10.0.' || CAST(c_custkey % 200 AS VARCHAR(10)) || '.7' END AS signup_ip,
  CASE (c_custkey + f) % 5 WHEN 1 THEN 'win' || CAST(c_custkey % 9 AS VARCHAR(10)) || '.example.net' END AS signup_domain,
  CASE WHEN (c_custkey + f) % 2 = 0 THEN n_name END AS custom1,
  coalesce(ev.clk, 0) = 1 OR c_custkey % 13 = 0 AS is_clicker, coalesce(ev.opn, 0) = 1 OR c_custkey % 17 = 0 AS is_opener
FROM x LEFT JOIN ev ON ev.user_id = x.c_custkey
"""

#: Facts per domain, from the contacts; ``k`` spreads the domains over all cases.
DIMENSION = r"""
SELECT domain, email_count, CASE k WHEN 0 THEN 'aspmx.l.google.com' WHEN 1 THEN 'shop.mail.protection.outlook.com' WHEN 2 THEN 'mta5.am0.yahoodns.net'
    WHEN 3 THEN 'mx1.hostgator.com' WHEN 5 THEN 'mx.acme.com' WHEN 6 THEN 'mail1.own.org' WHEN 7 THEN 'mailstore1.secureserver.net' WHEN 8 THEN 'in1-smtp.messagingengine.com'
    WHEN 9 THEN 'mx00.ionos.com' WHEN 10 THEN 'mx1.privateemail.com' WHEN 11 THEN 'mx.zoho.com' WHEN 12 THEN 'route1.mx.cloudflare.net' WHEN 13 THEN 'mail.protonmail.ch'
    WHEN 14 THEN 'inbound-smtp.us-east-1.amazonaws.com' WHEN 15 THEN 'mx.sedoparking.com' END AS mx_primary,
  CASE WHEN k IN (6, 11) THEN NULL ELSE TIMESTAMP '2024-05-01 00:00:00' END AS checked_at, k <> 4 AS is_valid,
  CASE k % 3 WHEN 0 THEN '8.8.8.8' WHEN 1 THEN '1.1.1.1' ELSE '9.9.9.9' END AS dns_server, k % 2 = 0 AS is_gi, k = 5 AS is_spamtrap,
  CASE WHEN k = 8 THEN 'Other' END AS hosting_provider, CASE WHEN k = 4 THEN 'No MX records' END AS error_message
FROM (SELECT domain, email_count, (length(domain) + ascii(substr(domain, 5, 1)) + ascii(substr(domain, 6, 1))) % 16 AS k
      FROM (SELECT email_domain AS domain, count(*) AS email_count FROM {contacts} WHERE email_domain IS NOT NULL GROUP BY email_domain) g) h
"""

TABLES = ("customer", "nation", "events")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw contacts, spread by row: their tables are small files whose rows cost much to clean.

    By two columns, for a repartition by the key alone goes out where the events were joined by it,
    and the join's few bytes are then coalesced into few tasks.
    """
    rows = spark.sql(RAW, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES})
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "contact_id", "file_ordinal")


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.prepare(raw(spark, sf_dir), AS_OF)
    return rows.withColumns({"file_sources": F.array(F.concat(F.lit("file_"), F.col("file_ordinal").cast("string"))), "mx_valid": F.lit(None).cast("boolean"), "mx_category": F.lit(None).cast("string"), "is_spamtrap": F.lit(False)})


def dimension(rows: DataFrame) -> DataFrame:
    facts = rows.sparkSession.sql(DIMENSION, contacts=rows)
    facts = C.settle(facts, F.struct(*facts.columns), lambda r: {c: r[c] for c in facts.columns})
    return C.settle(facts, S.classify_mx(F.col("mx_primary")), lambda c: {"mx_category": c}).withColumn("mx_host_provider", F.coalesce("mx_primary", F.lit("No MX")))


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(contacts with mail-host facts, dimension)."""
    rows = contacts(spark, sf_dir)
    facts = dimension(rows)
    return mx.apply_mx(rows, facts, valid_only=False).drop("mx_changed", "mx_host_provider"), facts


def _text(x) -> str:
    return "'" + str(x).replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _text(v) for v in r) + ")" for r in rows)


def _names(xs) -> str:
    return ", ".join(map(_text, xs))


_MX_NAMES = {"google": "Google", "microsoft": "Microsoft", "yahoo": "Yahoo", "protonmail": "ProtonMail"}
_MX_ROWS = [(i, p, R.GENERAL if g in R.GI_HOSTING else _MX_NAMES.get(g, g[0].upper() + g[1:])) for i, (g, p) in enumerate((g, p) for g, ps in R.MX_GROUPS for p in ps.split())]
TITLE = "array_to_string(list_transform(regexp_extract_all(lower({x}), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '')"
_NAME = "CASE WHEN length(t{c}) >= 2 THEN t{c} END"
_STEM = TITLE.format(x="regexp_replace(trim({c}), '[^a-zA-Z\\s''-]', '', 'g')")
_DATE = """CASE WHEN regexp_full_match(signup_date, '\\d{4}-\\d+-\\d+ .*') THEN try_strptime(signup_date, '%Y-%m-%d %H:%M:%S')
  WHEN regexp_full_match(signup_date, '\\d{4}-\\d+-\\d+') THEN try_strptime(signup_date, '%Y-%m-%d')
  WHEN regexp_full_match(signup_date, '\\d+/\\d+/\\d{4}') THEN coalesce(try_strptime(signup_date, '%m/%d/%Y'), try_strptime(signup_date, '%d/%m/%Y'))
  WHEN regexp_full_match(signup_date, '\\d+/\\d+/\\d{2}') THEN try_strptime(signup_date, '%m/%d/%y') END"""
_BADMAIL = "NOT (length(email) BETWEEN 5 AND 320 AND regexp_matches(email, '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}$') AND NOT regexp_matches(email, '^[.\\-_]|[.\\-_]@|\\.{2,}'))"
_TLDS = "|".join(t.replace(".", "\\.") for t in R.COUNTRY_TLDS)
_SCORE = f"""50 + CASE WHEN is_clicker THEN 15 ELSE 0 END + CASE WHEN is_opener THEN 5 ELSE 0 END
  + CASE WHEN coalesce(first_name, '') <> '' THEN 5 ELSE 0 END + CASE WHEN coalesce(last_name, '') <> '' THEN 5 ELSE 0 END
  + CASE WHEN coalesce(phone, '') <> '' THEN 7 ELSE 0 END + CASE WHEN coalesce(address, '') <> '' THEN 3 ELSE 0 END
  + CASE WHEN coalesce(city, '') <> '' AND coalesce(state, '') <> '' THEN 3 ELSE 0 END + CASE WHEN coalesce(zipcode, '') <> '' THEN 2 ELSE 0 END
  + CASE lower(validation_status) WHEN 'verified' THEN 15 WHEN 'unknown' THEN 5 WHEN 'invalid' THEN -20 ELSE 0 END
  + CASE email_category WHEN 'Big4_ISP' THEN 10 WHEN 'Cable_Provider' THEN 8 ELSE 0 END
  + CASE WHEN dshare > 0.5 THEN -15 WHEN dshare > 0.3 THEN -5 ELSE 0 END + CASE WHEN length(loc) BETWEEN 1 AND 3 THEN -10 ELSE 0 END
  + CASE WHEN length(loc) > 30 THEN -5 ELSE 0 END + CASE WHEN regexp_matches(loc, '{"|".join(R.SUSPICIOUS)}') THEN -15 ELSE 0 END
  + CASE WHEN length(loc) > 3 AND len(list_distinct(string_split(loc, ''))) <= 2 THEN -10 ELSE 0 END
  + CASE WHEN date_diff('day', signup_date::DATE, DATE '{AS_OF}') < 365 THEN 5 WHEN date_diff('day', signup_date::DATE, DATE '{AS_OF}') < 730 THEN 2 ELSE 0 END"""

PRELUDE = f"""
WITH raw AS ({RAW.format(**{t: t for t in TABLES})}),
typos(bad, good) AS (VALUES {_values(R.TYPOS.items())}),
rules(domain, rp, rb, rc) AS (VALUES {_values(R.domain_rules())}),
states(long, short) AS (VALUES {_values(R.STATES.items())}),
mxr(i, pat, cat) AS (VALUES {_values(_MX_ROWS)}),
labels(i, pat, label) AS (VALUES {_values([(i, *r) for i, r in enumerate(R.HOSTING_LABELS)])}),
e0 AS (SELECT *, regexp_replace(trim(lower(trim(email)), '<>"'' '), '^mailto:', '') AS e FROM raw),
e1 AS (SELECT *, CASE WHEN contains(e, '@') THEN string_split(e, '@')[-1] END AS d0 FROM e0),
e2 AS (SELECT e1.* EXCLUDE (email, e, d0), nullif(CASE WHEN good IS NULL THEN e ELSE left(e, length(e) - length(d0)) || good END, '') AS email FROM e1 LEFT JOIN typos ON bad = d0),
e3 AS (SELECT *, CASE WHEN contains(email, '@') THEN string_split(email, '@')[-1] END AS email_domain, upper(trim(state)) AS s0, regexp_replace(phone, '[^0-9]', '', 'g') AS p0,
  regexp_replace(zipcode, '[^0-9]', '', 'g') AS z0, {_STEM.format(c="first_name")} AS tf, {_STEM.format(c="last_name")} AS tl, lower(trim(validation_status)) AS v0, upper(trim(gender)[1]) AS g0 FROM e2),
clean AS (SELECT contact_id, file_ordinal, row_ordinal, email, email_domain, {_NAME.format(c="f")} AS first_name, {_NAME.format(c="l")} AS last_name, address,
  nullif({TITLE.format(x="trim(city)")}, '') AS city, CASE WHEN regexp_full_match(s0, '[A-Z]{{2}}') THEN s0 WHEN short IS NOT NULL THEN short WHEN length(s0) >= 2 THEN left(s0, 2) END AS state,
  CASE WHEN length(z0) >= 5 THEN left(z0, 5) END AS zipcode, nullif(CASE WHEN length(p0) = 11 AND p0[1] = '1' THEN p0[2:] ELSE p0 END, '') AS phone,
  CASE WHEN g0 IN ('M', 'F') THEN g0 END AS gender, {_DATE} AS signup_date,
  CASE WHEN coalesce(v0, '') = '' THEN NULL WHEN contains(v0, 'verified') OR v0 IN ('1', 'true', 'valid') THEN 'Verified' WHEN contains(v0, 'invalid') OR v0 IN ('0', 'false') THEN 'Invalid' ELSE 'Unknown' END AS validation_status,
  data_source, country, dob, signup_ip, signup_domain, custom1, is_clicker, is_opener FROM e3 LEFT JOIN states ON long = s0),
checked AS (SELECT *, CASE WHEN coalesce(email, '') = '' THEN 'missing_email' WHEN {_BADMAIL} THEN 'invalid_format'
  WHEN string_split(email, '@')[1] IN ({_names(R.ROLES)}) OR regexp_matches(string_split(email, '@')[1], '{"|".join(R.ROLE_WORDS)}') THEN 'role_email'
  WHEN regexp_matches(email, '({_TLDS})$') THEN 'country_tld' END AS reject_reason FROM clean),
cat AS (SELECT c.* EXCLUDE (reject_reason), coalesce(rp, CASE WHEN ends_with(email_domain, '.rr.com') THEN 'Spectrum' END) AS email_provider, coalesce(rb, CASE WHEN ends_with(email_domain, '.rr.com') THEN 'Roadrunner' END) AS email_brand,
  coalesce(rc, CASE WHEN ends_with(email_domain, '.rr.com') THEN 'Cable_Provider' END, 'General_Internet') AS email_category FROM checked c LEFT JOIN rules ON domain = email_domain WHERE reject_reason IS NULL),
loc AS (SELECT *, string_split(email, '@')[1] AS loc, length(regexp_replace(string_split(email, '@')[1], '[^0-9]', '', 'g')) / length(string_split(email, '@')[1]) AS dshare FROM cat),
contacts0 AS (SELECT * EXCLUDE (loc, dshare), CAST(greatest(0, least(100, {_SCORE})) AS INTEGER) AS quality_score, ['file_' || file_ordinal] AS file_sources FROM loc),
dim0 AS ({DIMENSION.format(contacts="contacts0")}),
dim AS (SELECT d.*, CASE WHEN coalesce(mx_primary, '') = '' THEN 'Dead' ELSE coalesce((SELECT arg_min(cat, i) FROM mxr WHERE contains(mx_primary, pat)), 'Real_GI') END AS mx_category FROM dim0 d),
contacts AS (SELECT c.*, is_valid AS mx_valid, mx_category FROM contacts0 c LEFT JOIN dim ON domain = email_domain)
"""
