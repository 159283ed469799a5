"""Column builders for cleaning, validating and scoring contacts.  Built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge.functions import rules as R


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body reads it.

    Without it every mention of a column is a copy of its whole expression, and copies
    multiply with each step that the optimiser folds into the next.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def lookup(c: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)


def domain_of(email: Column) -> Column:
    """Text after the last @; null without one."""
    return F.get(F.regexp_extract_all(email, F.lit("@([^@]*)$")), F.lit(0))


def local_of(email: Column) -> Column:
    return F.element_at(F.split(email, "@"), 1)


def fix_domain_typo(email: Column) -> Column:
    right = lambda d: F.coalesce(lookup(d, R.TYPOS), d)
    fixed = lambda e: F.concat(F.regexp_extract(e, "^(.*@)?", 0), right(F.regexp_extract(e, "[^@]*$", 0)))
    return let(email, lambda e: F.when(F.contains(e, F.lit("@")), fixed(e)).otherwise(e))


def clean_email(raw: Column) -> Column:
    e = F.regexp_replace(F.btrim(F.lower(strip(raw)), F.lit("<>\"' ")), "^mailto:", "")
    return let(fix_domain_typo(e), blank_to_null)


def is_valid_email(raw: Column) -> Column:

    def test(e):
        shape = e.rlike(r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$")
        bad = e.rlike(r"^[.\-_]|[.\-_]@|\.{2,}")
        return F.coalesce(F.length(e).between(5, 320) & shape & ~bad, F.lit(False))

    return let(F.lower(strip(raw)), test)


def looks_like_email(raw: Column) -> Column:
    """The looser test used on samples: one @, something on both sides, an alphabetic ending."""
    return F.coalesce(strip(raw).rlike(r"^[^@]+@[^@]+\.[A-Za-z]{2,}$"), F.lit(False))


def is_role_email(email: Column) -> Column:
    local = local_of(F.lower(email))
    return F.coalesce((F.contains(email, F.lit("@")) & local.isin(R.ROLES)) | local.rlike("|".join(R.ROLE_WORDS)), F.lit(False))


def has_country_tld(email: Column) -> Column:
    ends = "|".join(t.replace(".", r"\.") for t in R.COUNTRY_TLDS)
    return F.coalesce(F.lower(email).rlike(f"(?:{ends})$"), F.lit(False))


def reject_reason(email: Column) -> Column:
    """Null for a valid address, else the first test that fails."""
    test = lambda e: F.when(F.coalesce(e, F.lit("")) == "", "missing_email").when(~is_valid_email(e), "invalid_format").when(is_role_email(e), "role_email").when(has_country_tld(e), "country_tld")
    return let(email, test)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def clean_phone(raw: Column) -> Column:
    return blank_to_null(F.regexp_replace(digits(raw), "^1([0-9]{10})$", "$1"))


def title(c: Column, word: str = "[a-z]") -> Column:
    """Every run of letters starts with a capital (``word`` with digits: the SQL INITCAP rule)."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(f"{word}+|[^{word[1:-1]}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1_000_000))), "")


def clean_name(raw: Column) -> Column:
    return let(title(F.regexp_replace(strip(raw), r"[^a-zA-Z\s\-']", "")), lambda n: F.when(F.length(n) >= 2, n))


def clean_city(raw: Column) -> Column:
    return blank_to_null(title(strip(raw)))


def clean_state(raw: Column) -> Column:
    form = lambda s: F.when(s.rlike("^[A-Z]{2}$"), s).otherwise(F.coalesce(lookup(s, R.STATES), F.when(F.length(s) >= 2, F.left(s, F.lit(2)))))
    return let(F.upper(strip(raw)), form)


def clean_zip(raw: Column) -> Column:
    return blank_to_null(F.regexp_extract(digits(raw), "^[0-9]{5}", 0))


def parse_date(raw: Column) -> Column:
    """First format that fits; two-digit years from 69 on are of the last century."""
    forms = (
        (r"\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}", "yyyy-M-d H:m:s"),
        (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"),
        (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}", "M/d/yyyy H:m:s"),
        (r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"),
        (r"\d{1,2}/\d{1,2}/\d{2}", "M/d/yy"),
        (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"),
        (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
        (r"\d{1,2}-\d{1,2}-\d{4}", "M-d-yyyy"),
        (r"\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy"),
        (r"[A-Za-z]+ \d{1,2}, \d{4}", "MMMM d, yyyy"),
        (r"[A-Za-z]{3} \d{1,2}, \d{4}", "MMM d, yyyy"),
    )

    def one(x, shape, form):
        t = F.try_to_timestamp(F.when(x.rlike(f"^{shape}$"), x), F.lit(form))
        return let(t, lambda v: F.when(F.year(v) >= 2069, F.add_months(v.cast("date"), -1200).cast("timestamp")).otherwise(v)) if form == "M/d/yy" else t

    return let(strip(raw), lambda x: F.coalesce(*[one(x, *f) for f in forms])).cast("timestamp_ntz")


def load_date(raw: Column) -> Column:
    """ISO text of the loader: five formats on what stands before the first space, else its first ten characters."""
    forms = ((r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"), (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"), (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"), (r"\d{1,2}-\d{1,2}-\d{4}", "M-d-yyyy"), (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"))
    found = lambda x: F.coalesce(*[F.try_to_timestamp(F.when(x.rlike(f"^{s}$"), x), F.lit(f)) for s, f in forms])
    return let(F.split(strip(F.coalesce(raw, F.lit(""))), " ").getItem(0), lambda x: F.coalesce(F.date_format(found(x), "yyyy-MM-dd"), F.left(x, F.lit(10))))


def safe_date(raw: Column) -> Column:
    """A date from the first ten characters, null for anything else."""
    date = lambda x: F.coalesce(F.when(x.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), x).try_cast("date"), F.try_to_timestamp(F.when(x.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), x), F.lit("M/d/yyyy")).cast("date"))
    return let(F.left(strip(raw), F.lit(10)), date)


def load_gender(raw: Column) -> Column:
    g = F.lower(strip(raw))
    return F.when(g.isin("m", "male"), "M").when(g.isin("f", "female"), "F").otherwise("")


def load_flag(raw: Column) -> Column:
    return F.coalesce(F.lower(strip(raw)).isin("true", "t", "yes", "y", "1"), F.lit(False))


def gender_letter(raw: Column) -> Column:
    return let(F.upper(F.left(strip(raw), F.lit(1))), lambda g: F.when(g.isin("M", "F"), g))


def normal_status(raw: Column, checked: Column | None = None) -> Column:
    absent = F.when(checked, "Verified") if checked is not None else F.lit(None).cast("string")
    form = lambda s: (
        F.when(F.coalesce(s, F.lit("")) == "", absent)
        .when(F.contains(s, F.lit("verified")) | s.isin("1", "true", "valid"), "Verified")
        .when(F.contains(s, F.lit("invalid")) | s.isin("0", "false"), "Invalid")
        .otherwise("Unknown")
    )
    return let(F.lower(strip(raw)), form)


def email_hash(email: Column) -> Column:
    """First sixteen hex digits of the MD5, as an unsigned number."""
    return F.conv(F.substring(F.md5(F.lower(email)), 1, 16), 16, 10).cast("decimal(20,0)")


def quality_score(r: dict[str, Column], as_of: Column) -> Column:
    """0 to 100 from engagement, completeness, status, category, local part and age of the signup."""
    has = lambda c: F.coalesce(r[c].cast("string"), F.lit("")) != ""
    pts = lambda cond, n: F.when(cond, n).otherwise(0)

    def by_status(status):
        return (
            F.when(status.isin("valid", "deliverable", "ok", "good", "verified"), 15)
            .when(status.isin("risky", "unknown", "catchall", "catch-all", "accept-all"), 5)
            .when(status.isin("invalid", "undeliverable", "bad", "bounce", "hard_bounce"), -20)
            .otherwise(0)
        )

    def by_local(local):
        n = F.length(local)
        share = F.length(digits(local)) / F.when(n > 0, n)
        tests = [
            F.when(share > 0.5, -15).when(share > 0.3, -5).otherwise(0),
            pts((n > 0) & (n < 4), -10),
            pts(n > 30, -5),
            pts(local.rlike("|".join(R.SUSPICIOUS)), -15),
            pts((n > 3) & (F.size(F.array_distinct(F.split(local, ""))) <= 2), -10),
        ]
        return reduce(lambda a, b: a + b, tests)

    parts = [
        F.lit(50),
        pts(r["is_clicker"], 15),
        pts(r["is_opener"], 5),
        *(pts(has(c), p) for c, p in (("first_name", 5), ("last_name", 5), ("phone", 7), ("address", 3), ("zipcode", 2))),
        pts(has("city") & has("state"), 3),
        let(F.lower(r["validation_status"]), by_status),
        F.when(r["email_category"] == "Big4_ISP", 10).when(r["email_category"] == "Cable_Provider", 8).otherwise(0),
        let(local_of(F.coalesce(r["email"], F.lit(""))), by_local),
        let(F.datediff(as_of, r["signup_date"]), lambda age: F.when(age < 365, 5).when(age < 730, 2).otherwise(0)),
    ]
    return F.greatest(F.lit(0), F.least(F.lit(100), reduce(lambda a, b: a + b, parts))).cast("int")


def cell_type(raw: Column) -> Column:
    """Kind of a cell, by the first test that holds."""
    test = lambda v: (
        F.when(F.coalesce(v, F.lit("")) == "", "empty")
        .when(v.rlike(r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"), "email")
        .when(v.rlike(r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$"), "ip")
        .when(v.rlike(r"^[0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}"), "date")
        .when((F.length(v) == 2) & F.upper(v).isin(R.STATE_CODES), "state")
        .when(v.rlike(r"^[0-9]{5}(-[0-9]{4})?$"), "zip")
        .when(F.upper(v).isin("M", "F", "MALE", "FEMALE"), "gender")
        .when(F.length(digits(v)).between(7, 15) & v.rlike(r"^[0-9\-\(\)\s\.]{7,20}$"), "phone")
        .when(v.startswith("http") | v.rlike(r"\.com|\.net|\.org"), "domain")
        .otherwise("text")
    )
    return let(strip(raw), test)


def classify_mx(host: Column) -> Column:
    """Category of a mail-exchanger host: the first group of which a pattern occurs in it; hosting groups are general."""
    names = {"protonmail": "ProtonMail"}

    def test(h):
        out = F.when(F.coalesce(h, F.lit("")) == "", "Dead")
        for group, patterns in R.MX_GROUPS:
            hit = h.rlike("|".join(p.replace(".", r"\.") for p in patterns.split()))
            out = out.when(hit, R.GENERAL if group in R.GI_HOSTING else names.get(group, group.capitalize()))
        return out.otherwise("Real_GI")

    return let(F.lower(host), test)


def mx_modifier(category: Column) -> Column:
    """Points for the mail host's category."""
    return (
        F.when(category.isin("Google", "Microsoft", "Yahoo", "Apple"), 5)
        .when(category.isin("Proofpoint", "Mimecast", "Barracuda"), 3)
        .when(category.isin("ProtonMail", "Fastmail"), 2)
        .when(category.isin("Parked", "Dead"), -100)
        .otherwise(0)
    )


def hosting_label(host: Column) -> Column:

    def test(h):
        return F.coalesce(*[F.when(F.contains(h, F.lit(pattern)), label) for pattern, label in R.HOSTING_LABELS])

    return let(F.lower(host), test)


def banner_reasons(ssh: Column, smtp: Column, ehlo: Column) -> Column:
    """Reasons to suspect a host by its banners, joined by '; ' ('' where there are none)."""
    legit = "(?i)" + "|".join(R.LEGIT_SOFTWARE)
    generic = smtp.rlike("(?i)" + R.GENERIC_ESMTP) & ~F.coalesce(smtp.rlike(legit), F.lit(False)) & ~F.coalesce(ehlo.rlike(legit), F.lit(False))
    both = F.contains(ssh, F.lit("Debian")) & F.contains(ssh, F.lit("deb12")) & smtp.rlike(R.GENERIC_ESMTP)
    found = [F.when(ssh.rlike("(?i)" + p), f"SSH matches spamtrap pattern: {p}") for p in R.SSH_RULES]
    found += [F.when(generic, "Generic ESMTP banner (no software identified)"), F.when(both, "Debian 12 + Generic ESMTP (matches known spamtrap infrastructure)")]
    return F.concat_ws("; ", *found)


def file_source(name: Column, folder: Column) -> Column:
    """Data source by file name words, else by folder words, else Unknown."""

    def first(c, table):
        return F.coalesce(*[F.when(F.contains(F.lower(c), F.lit(k)), v) for k, v in table])

    return F.coalesce(first(name, R.NAME_SOURCES), first(folder, R.FOLDER_SOURCES), F.lit("Unknown"))


def import_file_type(name: Column) -> Column:
    n = F.lower(name)
    return F.when(F.contains(n, F.lit("click")), "clicker").when(F.contains(n, F.lit("open")), "opener").when(n.rlike("pure|email"), "email_only").otherwise("unknown")


def resolver_name(ip: Column) -> Column:
    """Display name of a public resolver, else its address."""
    return F.coalesce(lookup(ip, R.RESOLVERS), ip)


def lineage_text(sources: Column) -> Column:
    """An array of names as one literal: commas in names become '_', braces and quotes go."""
    return F.concat(F.lit("{"), F.array_join(F.transform(sources, lambda x: F.translate(x, ',{}"', "_")), ","), F.lit("}"))


def search_email(raw: Column) -> Column:
    """The normal form in which an address is looked up."""
    return F.lower(strip(raw))


def search_domain(raw: Column) -> Column:
    """A domain as typed or pasted: without protocol, path and blanks, in lower case."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip(raw)), "^https?://", ""), "/.*$", "")
