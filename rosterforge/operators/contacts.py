"""From raw contact cells to clean, validated, categorised and scored contacts."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.functions import rules as R
from rosterforge.functions import scalars as S

FIELDS = ("first_name", "last_name", "address", "city", "state", "zipcode", "phone", "dob", "gender", "signup_date", "signup_domain", "signup_ip")
REASONS = ("missing_email", "invalid_format", "role_email", "country_tld")


def domain_table(spark: SparkSession, extra: list[tuple[str, str, str, str]] = ()) -> DataFrame:
    """The domain rules as a table; ``extra`` rows add to them."""
    names = ("domain", "email_provider", "email_brand", "email_category")
    return spark.createDataFrame(pa.table(dict(zip(names, (list(c) for c in zip(*R.domain_rules(), *extra, strict=True)), strict=True))))


def settle(rows: DataFrame, value: Column, fields: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """``rows`` with the ``fields`` of one value, computed once a row, in place of columns of those names.

    Columns of a projection are copied into every later filter, and those filters go down to the
    scan, where a derived cell is copied once more for each mention.  A generator's columns stay
    what they are: filters on them remain above it.
    """
    names = []

    def row(x: Column) -> Column:
        made = fields(x)
        names.extend(n for n in made if n not in names)
        return F.struct(*[e.alias(n) for n, e in made.items()])

    made = F.inline_outer(F.transform(F.array(value), row))
    return rows.select(*[c for c in rows.columns if c not in names], made)


def clean(raw: DataFrame) -> DataFrame:
    """Normal forms of every known column; columns that are absent stay absent."""
    c = {n: F.col(n) for n in raw.columns}
    rules = {
        "first_name": S.clean_name,
        "last_name": S.clean_name,
        "city": S.clean_city,
        "state": S.clean_state,
        "zipcode": S.clean_zip,
        "phone": S.clean_phone,
        "gender": S.gender_letter,
        "signup_date": S.parse_date,
        "validation_status": S.normal_status,
    }
    out = raw.withColumns({n: f(c[n].cast("string")) for n, f in rules.items() if n in c})
    return settle(out, S.clean_email(F.col("email")), lambda e: {"email": e, "email_domain": S.domain_of(e)})


def with_reason(contacts: DataFrame) -> DataFrame:
    return contacts.withColumn("reject_reason", S.reject_reason(F.col("email")))


def valid(contacts: DataFrame) -> DataFrame:
    """The batch policy: role accounts and country domains go."""
    return with_reason(contacts).filter("reject_reason IS NULL").drop("reject_reason")


def importable(contacts: DataFrame) -> DataFrame:
    """The import policy: only the format counts, and blocked domains go."""
    return contacts.filter(S.is_valid_email(F.col("email")) & ~F.col("email_domain").isin(R.BLOCKED))


def reject_counts(contacts: DataFrame) -> DataFrame:
    """One row per reason, zeros included."""
    found = with_reason(contacts).groupBy("reject_reason").agg(F.count("*").alias("n"))
    every = contacts.sparkSession.createDataFrame([(r,) for r in REASONS], "reject_reason string")
    return every.join(found, "reject_reason", "left").select("reject_reason", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def categorise(contacts: DataFrame, extra: list[tuple[str, str, str, str]] = ()) -> DataFrame:
    """Adds provider, brand and category by the mail domain: own entry, then the suffix rule, then General_Internet.

    The rule table is a constant of about 270 rows, so it is broadcast.
    """
    base = contacts.withColumn("_domain", F.lower(S.strip(F.col("email_domain"))))
    rules = domain_table(contacts.sparkSession, extra).withColumnRenamed("domain", "_domain")
    joined = base.join(F.broadcast(rules), "_domain", "left")
    regional = F.coalesce(F.col("_domain").endswith(R.RR_SUFFIX), F.lit(False))
    fill = lambda i, other: F.when(regional, R.RR_RULE[i]).otherwise(other)
    return joined.withColumns({
        "email_provider": F.coalesce("email_provider", fill(0, None)),
        "email_brand": F.coalesce("email_brand", fill(1, None)),
        "email_category": F.coalesce("email_category", fill(2, R.GENERAL)),
    }).drop("_domain")


def score(contacts: DataFrame, as_of: Column | str) -> DataFrame:
    """Adds quality_score as of a given day (never the clock's)."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    have = set(contacts.columns)
    col = lambda n, kind="string": F.col(n) if n in have else F.lit(None).cast(kind)
    names = ("email", "first_name", "last_name", "phone", "address", "zipcode", "city", "state", "validation_status", "email_category")
    r = {n: col(n) for n in names} | {n: F.coalesce(col(n, "boolean"), F.lit(False)) for n in ("is_clicker", "is_opener")} | {"signup_date": col("signup_date", "timestamp_ntz")}
    return contacts.withColumn("quality_score", S.quality_score(r, day))


def prepare(raw: DataFrame, as_of: str) -> DataFrame:
    """The whole batch path: clean, validate, categorise, score.  Narrow steps and one broadcast join, no shuffle."""
    return score(categorise(valid(clean(raw))), as_of)


def funnel(raw: DataFrame) -> DataFrame:
    """Counts per file: rows, rows with an e-mail cell, valid rows, rejected rows."""
    rows = with_reason(clean(raw.withColumn("_cell", F.col("email"))))
    return rows.groupBy("file_ordinal").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.coalesce(S.strip(F.col("_cell")), F.lit("")) != "").alias("n_with_email"),
        F.count_if(F.col("reject_reason").isNull()).alias("n_valid"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("n_rejected"),
    )
