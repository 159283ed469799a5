"""Segments: typed filters, pages, unions, preset counts, exports."""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIG4_HOSTS = ("Google", "Microsoft", "Yahoo")


@dataclass(frozen=True)
class Segment:
    """What a contact must match; None leaves a field open."""

    category: str | None = None
    provider: str | None = None
    country: str | None = None
    validation_status: str | None = None
    data_source: str | None = None
    email_contains: str | None = None
    domain: str | None = None
    domain_contains: str | None = None
    first_name_contains: str | None = None
    last_name_contains: str | None = None
    city_contains: str | None = None
    signup_domain_contains: str | None = None
    zip_prefix: str | None = None
    ip_prefix: str | None = None
    state: str | None = None
    states: tuple[str, ...] | None = None
    exclude_states: tuple[str, ...] | None = None
    gender: str | None = None
    has_phone: bool | None = None
    has_dob: bool | None = None
    clickers: bool | None = None
    openers: bool | None = None
    quality: str | None = None
    min_score: int | None = None
    file_source: str | None = None
    signup_from: str | None = None
    signup_to: str | None = None
    mx_category: str | None = None
    mx_big4: bool | None = None
    no_spamtraps: bool = False

    @property
    def needs_mx(self) -> bool:
        return self.mx_category is not None or bool(self.mx_big4)

    def condition(self) -> Column:
        """One boolean column; columns that no field names are never read."""
        same = {"category": "email_category", "provider": "email_provider", "country": "country", "data_source": "data_source", "domain": "email_domain"}
        has = {"email_contains": "email", "domain_contains": "email_domain", "first_name_contains": "first_name", "last_name_contains": "last_name", "city_contains": "city", "signup_domain_contains": "signup_domain"}
        tests = [F.col(c) == getattr(self, f) for f, c in same.items() if getattr(self, f) is not None]
        tests += [F.contains(F.lower(c), F.lit(getattr(self, f).lower())) for f, c in has.items() if getattr(self, f)]
        if self.validation_status is not None:
            tests.append(F.lower("validation_status") == self.validation_status.lower())
        if self.zip_prefix:
            tests.append(F.col("zipcode").startswith(self.zip_prefix))
        if self.ip_prefix:
            tests.append(F.col("signup_ip").startswith(self.ip_prefix))
        if self.state:
            tests.append(F.upper("state") == self.state.upper())
        if self.states:
            tests.append(F.col("state").isin(*self.states))
        if self.exclude_states:
            tests.append(~F.col("state").isin(*self.exclude_states))
        if self.gender:
            long = {"M": "MALE", "F": "FEMALE"}.get(self.gender)
            tests.append((F.col("gender") == self.gender) | (F.upper("gender") == long) if long else F.col("gender") == self.gender)
        if self.has_phone is not None:
            there = F.coalesce("phone", F.lit("")) != ""
            tests.append(there if self.has_phone else ~there)
        if self.has_dob is not None:
            tests.append(F.col("dob").isNotNull() if self.has_dob else F.col("dob").isNull())
        wanted = [(F.col(c), v) for c, v in (("is_clicker", self.clickers), ("is_opener", self.openers)) if v is not None]
        if len(wanted) == 2 and all(v for _, v in wanted):
            tests.append(wanted[0][0] | wanted[1][0])
        else:
            tests += [c if v else ~c for c, v in wanted]
        if self.quality:
            q = F.col("quality_score")
            tests.append({"high": q >= 70, "medium": (q >= 40) & (q < 70), "low": q < 40}[self.quality])
        if self.min_score is not None:
            tests.append(F.col("quality_score") >= self.min_score)
        if self.file_source:
            tests.append(F.array_contains("file_sources", self.file_source))
        if self.signup_from:
            tests.append(F.col("signup_date").cast("string") >= self.signup_from)
        if self.signup_to:
            tests.append(F.col("signup_date").cast("string") <= self.signup_to)
        if self.mx_category is not None:
            tests.append(F.col("dm_category") == self.mx_category)
        if self.mx_big4:
            tests.append(F.col("dm_category").isin(*BIG4_HOSTS))
        if self.no_spamtraps:
            tests.append(~F.coalesce("is_spamtrap", F.lit(False)))
        return reduce(lambda a, b: a & b, tests, F.lit(True))


def with_mx(contacts: DataFrame, dimension: DataFrame) -> DataFrame:
    return contacts.join(dimension.select(F.col("domain").alias("email_domain"), F.col("mx_category").alias("dm_category")), "email_domain", "left")


def select(contacts: DataFrame, segment: Segment, dimension: DataFrame | None = None) -> DataFrame:
    """Matching contacts; the dimension is joined only where the segment asks for it."""
    rows = with_mx(contacts, dimension) if segment.needs_mx else contacts
    return rows.filter(segment.condition()).select(*contacts.columns)


def page(rows: DataFrame, limit: int = 500, offset: int = 0, by: str = "quality_score", nulls_first: bool = False, most: int = 5000) -> DataFrame:
    """A page in falling order of ``by``, ties by email; a top-k, never a full sort."""
    key = F.col(by).desc_nulls_first() if nulls_first else F.col(by).desc_nulls_last()
    return rows.orderBy(key, "email").offset(offset).limit(min(limit, most))


def pages(total: int, size: int) -> int:
    return -(-total // size)


def any_of(contacts: DataFrame, segments: list[Segment], dimension: DataFrame | None = None) -> DataFrame:
    """Contacts of any of the segments, repeats too: one scan with the conditions ORed, no shuffle of their own."""
    rows = with_mx(contacts, dimension) if any(s.needs_mx for s in segments) else contacts
    hit = reduce(lambda a, b: a | b, [F.coalesce(s.condition(), F.lit(False)) for s in segments], F.lit(False))
    return rows.filter(hit).select(*contacts.columns)


def union(contacts: DataFrame, segments: list[Segment], dimension: DataFrame | None = None) -> DataFrame:
    """Distinct contacts of any of the segments."""
    return any_of(contacts, segments, dimension).distinct()


def union_count(contacts: DataFrame, segments: list[Segment], dimension: DataFrame | None = None) -> DataFrame:
    return any_of(contacts, segments, dimension).agg(F.count_distinct("email").alias("n_emails"))


def _both(name: str, **more) -> dict[str, Segment]:
    return {f"{name}_clickers": Segment(clickers=True, **more), f"{name}_openers": Segment(openers=True, **more)}


#: The preset segments.
PRESETS: dict[str, Segment] = {
    **_both("all"),
    **_both("gi", category="General_Internet"),
    **_both("cable", category="Cable_Provider"),
    **_both("big4", category="Big4_ISP"),
    **_both("google", provider="Google"),
    **_both("yahoo", provider="Yahoo"),
    **_both("microsoft", provider="Microsoft"),
    **_both("aol", provider="AOL"),
    **_both("2nd_google", category="General_Internet", mx_category="Google"),
    **_both("2nd_microsoft", category="General_Internet", mx_category="Microsoft"),
    **_both("2nd_yahoo", category="General_Internet", mx_category="Yahoo"),
    **_both("2nd_big4_all", category="General_Internet", mx_big4=True),
    **_both("apple", provider="Apple"),
    **_both("spectrum", provider="Spectrum"),
    **_both("comcast", provider="Comcast"),
    **_both("att", provider="AT&T"),
    "godaddy_clickers": Segment(provider="GoDaddy", clickers=True),
    "earthlink_clickers": Segment(provider="EarthLink", clickers=True),
    "high_quality": Segment(quality="high"),
    "med_quality": Segment(quality="medium"),
    "verified_all": Segment(validation_status="verified"),
}


def preset_counts(contacts: DataFrame, dimension: DataFrame, presets: dict[str, Segment] | None = None) -> DataFrame:
    """(preset, n) of all presets from one scan and one aggregation."""
    presets = presets or PRESETS
    row = with_mx(contacts, dimension).agg(*[F.count_if(s.condition()).alias(k) for k, s in presets.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("preset"), F.col(f"`{k}`").alias("n")) for k in presets])).alias("_r")).select("_r.*")


# The columns of the three exports.
PROJECTIONS = {
    17: "email first_name last_name address city state zipcode phone dob gender signup_date signup_ip is_clicker is_opener validation_status email_category data_source".split(),
    18: "email email_domain email_provider email_brand email_category quality_score is_clicker is_opener first_name last_name city state zipcode phone gender dob signup_date data_source".split(),
    19: "email email_domain email_provider email_brand email_category quality_score is_clicker is_opener first_name last_name phone city state zipcode gender dob signup_date created_at data_source".split(),
}


def project(rows: DataFrame, columns: int) -> DataFrame:
    """The fixed columns of an export; dates as text, columns that the rows lack as null."""
    have = set(rows.columns)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") if dict(rows.dtypes)[c].startswith("timestamp") else F.col(c).cast("string")
    pick = lambda c: F.lit(None).cast("string") if c not in have else text(c) if c in ("dob", "signup_date", "created_at") else F.col(c)
    return rows.select(*[pick(c).alias(c) for c in PROJECTIONS[columns]])


def union_rows(contacts: DataFrame, segments: list[Segment], dimension: DataFrame | None = None) -> DataFrame:
    """The 19-column rows of any of the segments, distinct, highest score first (then by address)."""
    return project(any_of(contacts, segments, dimension), 19).distinct().orderBy(F.col("quality_score").desc_nulls_last(), "email")


def export_rows(rows: DataFrame) -> DataFrame:
    """Text of every column: null as empty, arrays joined by '; ', times to the second."""
    out = []
    for name, kind in rows.dtypes:
        c = F.col(name)
        if kind.startswith("array"):
            c = F.array_join(c.cast("array<string>"), "; ")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(name))
    return rows.select(*out)


def field_names() -> list[str]:
    return [f.name for f in fields(Segment)]
