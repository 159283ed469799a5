"""Scalars, registered queries against DuckDB, files, sinks and streams."""

import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from rosterforge.functions import rules as R
from rosterforge.functions import scalars as S
from rosterforge.operators import contacts as C
from rosterforge.operators import merge, mx, segments
from rosterforge.plans import base, catalog
from rosterforge.sources import files, infer, sinks
from rosterforge.streaming import ingest

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

SCALARS = [
    (S.clean_email, {" <Bob@GMIAL.com> ": "bob@gmail.com", "mailto:a@b.com": "a@b.com", "mailto:<a@b.com": "<a@b.com", "": None, None: None, "x@gmail.co": "x@gmail.com"}),
    (S.is_valid_email, {"a@b.c": False, "a..b@c.com": False, ".a@c.com": False, "a.@c.com": False, "a@b@c.com": False, "a b@c.com": False, "a+b@c-d.com": True, None: False}),
    (S.is_role_email, {"info@x.com": True, "paralegal@x.com": True, "bob@spam.com": False}),
    (S.has_country_tld, {"x@y.co": True, "x@y.com": False, "x@y.us": False}),
    (S.clean_phone, {"1 (743) 555-3824": "7435553824", "555": "555", "abc": None}),
    (S.clean_name, {"o'neil": "O'Neil", "mary-ann": "Mary-Ann", "x": None, "J0hn": "Jhn"}),
    (S.clean_state, {"tx": "TX", "New York": "NY", "N/A": "N/", "x": None}),
    (S.clean_zip, {"12345-6789": "12345", "1234": None}),
    (lambda c: S.parse_date(c).cast("string"), {"03/04/2020": "2020-03-04 00:00:00", "13/04/2020": "2020-04-13 00:00:00", "01/02/70": "1970-01-02 00:00:00", "01/02/68": "2068-01-02 00:00:00", "2023-02-29": None, "March 5, 2021": "2021-03-05 00:00:00", "Mar 5, 2021": "2021-03-05 00:00:00"}),
    (S.load_date, {"3/4/2020 10:00": "2020-03-04", "whenever it was": "whenever", None: ""}),
    (lambda c: S.safe_date(c).cast("string"), {"0000-00-00": None, "06/15/2024": "2024-06-15", "2024": None, "2024-06-15T01": "2024-06-15"}),
    (S.normal_status, {"unverified": "Verified", "0": "Invalid", "abc": "Unknown", "": None}),
    (S.gender_letter, {"male": "M", "F": "F", "x": None}),
    (S.load_gender, {"male": "M", "F": "F", "x": ""}),
    (S.load_flag, {"Yes": True, "0": False, None: False}),
    (S.classify_mx, {"aspmx.l.google.com": "Google", "mx1.hostgator.com": "General_Internet", "mail1.own.org": "Real_GI", "mx.acme.com": "Apple", None: "Dead", "mail.protonmail.ch": "ProtonMail", "x.sedoparking.com": "Parked"}),
    (S.mx_modifier, {"Apple": 5, "Parked": -100, "Real_GI": 0, "Fastmail": 2}),
    (S.hosting_label, {"MX.zoho.eu": "Zoho", "a.b": None}),
    (S.cell_type, {"a@b.com": "email", "10.0.0.1": "ip", "2024-01-02": "date", "tx": "state", "12345": "zip", "F": "gender", "(743) 555-0101": "phone", "www.x.org": "domain", "hello": "text", " ": "empty"}),
    (S.search_domain, {" HTTPS://Shop.Example.org/a?b ": "shop.example.org", "x.org": "x.org"}),
    (S.search_email, {" Bob@X.org ": "bob@x.org"}),
    (lambda c: S.lineage_text(F.array(c, F.lit("b"))), {'a,"x"{y}.csv': "{a_xy.csv,b}"}),
    (S.import_file_type, {"a_CLICK.csv": "clicker", "opens.csv": "opener", "pure.csv": "email_only", "x.csv": "unknown"}),
]


@pytest.mark.parametrize(("f", "cases"), SCALARS, ids=lambda x: getattr(x, "__name__", ""))
def test_scalars(spark, f, cases):
    got = spark.createDataFrame([(k,) for k in cases], "x string").select("x", f(F.col("x")).alias("y")).collect()
    assert {r["x"]: r["y"] for r in got} == cases


def test_python_and_spark_cell_types_agree(spark):
    cells = [*dict(SCALARS)[S.cell_type], "99999-1234", "1/2/3", "male", "http://x", "12 34 56 7", "zz", None]
    got = spark.createDataFrame([(c,) for c in cells], "x string").select(S.cell_type(F.col("x"))).collect()
    assert [r[0] for r in got] == [infer.cell_type(c) for c in cells]


def test_rule_tables():
    rows = R.domain_rules()
    assert len(rows) == len({r[0] for r in rows}) == 268 and sum(r[3] == "Big4_ISP" for r in rows) == 156
    assert len(R.COUNTRY_TLDS) == 56 and len(R.ROLES) == 71 and len(R.HOSTING_LABELS) == 49 and len(segments.PRESETS) == 37


def _norm(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(tuple, frame.where(frame.notna(), None).astype(str).values.tolist()))


@pytest.fixture(scope="module")
def duck(sf):
    con = {}
    for sf_dir in (sf, sf.replace("sf0.001", "sf0.01")):
        con[sf_dir] = duckdb.connect()
        for t in TABLES:
            con[sf_dir].execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_queries_against_duckdb(spark, duck, name):
    for sf_dir, con in duck.items():
        got, want = catalog.QUERIES[name](spark, sf_dir).toPandas(), con.execute(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and _norm(got) == _norm(want), sf_dir
    assert len(got), "no rows at sf0.01"


def _optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["gi_hosting", "unidentified_hosts", "second_level_big4", "gi_hosting_category", "hosts_to_scan", "host_histogram", "hosting_summary"])
def test_cells_are_computed_once_a_row(spark, sf, name):
    plan = _optimized(catalog.QUERIES[name](spark, sf))
    cells = plan.count("^mailto:")  # once a branch that cleans addresses
    assert len(plan) < 100_000 and cells <= 3, (len(plan), cells)
    assert not [x for x in plan.splitlines() if "CASE WHEN ((c_custkey" in x and "Filter" in x[:200]]


def test_contacts_are_spread_before_cleaning(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = base.contacts(spark, sf)
        got = [rows.rdd.getNumPartitions(), rows.select("email_domain").rdd.getNumPartitions()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [8, 8]


def test_settled_columns(spark):
    rows = spark.createDataFrame([(1, " <Bob@GMIAL.com> "), (2, None), (3, "a@b@c.org"), (4, "")], "id int, email string")
    got = C.settle(rows, S.clean_email(F.col("email")), lambda e: {"email": e, "email_domain": S.domain_of(e)})
    assert got.columns == ["id", "email", "email_domain"]
    assert {tuple(r) for r in got.collect()} == {(1, "bob@gmail.com", "gmail.com"), (2, None, None), (3, "a@b@c.org", "c.org"), (4, None, None)}
    plan = _optimized(got.filter("email_domain IS NOT NULL AND email <> email_domain"))
    assert plan.count("^mailto:") == 1 and plan.index("Filter") < plan.index("Generate")


def test_every_bucket_of_the_breakdowns_has_rows(spark, sf):
    every = {"cable_breakdown": ("bucket", {k for k, _ in R.CABLE_BUCKETS}), "gi_hosting": ("bucket", {k for k, _ in R.HOSTING_BUCKETS}), "upsert_counts": ("outcome", {"inserted", "updated", "kept"}), "sync_gi": ("is_new", {True, False})}
    for name, (column, want) in every.items():
        assert {r[0] for r in catalog.QUERIES[name](spark, sf.replace("sf0.001", "sf0.01")).select(column).collect()} == want, name


def test_merge_fills_and_is_idempotent(spark):
    rows = [("A@x.com", "Ann", None, True, False, None, "Unknown", ["f1"], 0, 0), ("a@x.com", "Bea", "Lee", False, False, "Verified", "GIO", ["f2"], 1, 0), (None, "No", None, False, False, None, None, ["f3"], 1, 1)]
    df = spark.createDataFrame(rows, "email string, first_name string, last_name string, is_clicker boolean, is_opener boolean, validation_status string, data_source string, file_sources array<string>, file_ordinal int, row_ordinal long")
    once = merge.merge_duplicates(df)
    (r,) = once.collect()
    assert (r["email"], r["first_name"], r["last_name"], r["validation_status"], r["file_sources"], r["n_merged"]) == ("A@x.com", "Ann", "Lee", "Verified", ["f1", "f2"], 2)
    again = merge.merge_duplicates(once.drop("n_merged")).drop("n_merged")
    assert again.collect() == once.drop("n_merged").select(*again.columns).collect()
    assert [r["email"] for r in merge.merge_duplicates(df, lower=True).collect()] == ["a@x.com"]


def test_merged_sides_are_joined_as_they_lie(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one, two = catalog._master_batch(spark, sf)
        sides = [x._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for x in (one, two)]
        plan = merge.enrich(one, two, merge.ENRICH_IMPORT)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == sum(sides)


def test_oracle_names_every_preset():
    assert [k for k, _ in catalog._PRESETS] == list(segments.PRESETS)


def test_lookup_results(spark):
    answers = {"a.com": [(20, "b.mx"), (10, "aspmx.l.google.com")], "b.com": [], "c.com": None}
    domains = spark.createDataFrame([(d,) for d in answers], "domain string")
    got = {r["domain"]: r for r in mx.shape_results(mx.resolve(domains, answers.get, 2)).collect()}
    assert (got["a.com"]["mx_primary"], got["a.com"]["mx_category"], got["a.com"]["mx_priority"]) == ("aspmx.l.google.com", "Google", [10, 20])
    assert (got["b.com"]["mx_host_provider"], got["c.com"]["mx_host_provider"], got["c.com"]["is_valid"]) == ("No MX", "NXDOMAIN", False)


def test_banners(spark):
    rows = [("h1", "SSH-2.0-OpenSSH_9.2p1 Debian-2+deb12u2", "220 x ESMTP", ""), ("h2", None, "220 x ESMTP Postfix", ""), ("h3", None, "220 x ESMTP", "250 Exim")]
    got = {r["mx_host"]: r for r in mx.suspicious(spark.createDataFrame(rows, "mx_host string, ssh_banner string, smtp_banner string, smtp_ehlo string")).collect()}
    assert got["h1"]["suspicion_reason"].count(";") == 3 and not got["h2"]["is_suspicious"] and not got["h3"]["is_suspicious"]


def test_csv_files(spark, tmp_path):
    rich = tmp_path / "glenn_click.csv"
    rich.write_text('Email Address;First Name;State\na@b.com;"Ann; Lee";tx\nc@d.org\ne@f.net;Eve;ny;more;cells\n')
    facts = files.sniff(spark, str(rich))
    assert facts["sep"] == ";" and facts["header"] and facts["mapping"] == {"email": "Email Address", "first_name": "First Name", "state": "State"}
    got = files.read_contacts(spark, str(rich)).orderBy("email").collect()
    assert [(r["email"], r["first_name"], r["state"], r["custom1"], r["custom2"]) for r in got] == [("a@b.com", "Ann; Lee", "tx", None, None), ("c@d.org", "", "", None, None), ("e@f.net", "Eve", "ny", "more", "cells")]
    assert got[0]["is_clicker"] and got[0]["data_source"] == "Glenn"
    plain = tmp_path / "x.csv"
    plain.write_bytes("José,Díaz,j@d.com,1 Way\nAna,Paz,a@p.com,2 Way\n".encode("latin-1"))
    got = files.read_contacts(spark, str(plain)).orderBy("email").collect()
    assert [(r["email"], r["first_name"], r["address"]) for r in got] == [("a@p.com", "Ana", "2 Way"), ("j@d.com", "José", "1 Way")]
    (tmp_path / "suppress_list.csv").write_text("a@b.com\n")
    assert [r["name"] for r in files.discover(spark, str(tmp_path)).collect()] == ["glenn_click.csv", "x.csv"]
    assert files.profile(spark, [str(rich), str(plain)]).filter("header").count() == 1


def test_txt_and_zip_files(spark, tmp_path):
    p = tmp_path / "list.txt"
    p.write_text('Ann,a@b.com,"x, y"\n\nplain\nb@c.com\n')
    assert [(r["email"], r["column_1"], r["column_2"]) for r in files.read_txt(spark, str(p)).collect()] == [("a@b.com", "Ann", "x, y"), ("plain", None, None), ("b@c.com", None, None)]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in/../one.csv", "a\nb\n")
        z.writestr("two.bin", "no")
    assert sorted((r["member"], r["line"]) for r in files.read_zip(spark, str(tmp_path / "a.zip")).collect()) == [("one.csv", "a"), ("one.csv", "b")]


def test_csv_files_lose_nothing(spark, tmp_path):
    wide = tmp_path / "wide.csv"
    lines = [f"p{i}@b.com,n{i}" for i in range(files.SAMPLE + 50)] + ["late@b.com,x," + ",".join(f"c{i}" for i in range(100)), 'quo@b.com,"a ""b"", c",d']
    wide.write_text("Contact E-mail,Full Name\n" + "\n".join(lines) + "\n")
    got = {r[0]: r for r in files.read_csv(spark, str(wide)).collect()}
    assert len(got) == len(lines) and got["late@b.com"]["overflow"] == [f"c{i}" for i in range(100)]
    assert (got["quo@b.com"][1], got["quo@b.com"]["overflow"], got["p3@b.com"]["overflow"]) == ('a "b", c', ["d"], [])
    broken = tmp_path / "broken.csv"
    broken.write_text('Email,Note,State\na@b.com,"two\nlines, one cell",tx\nc@d.org,plain,ny,"more\nthere"\n')
    got = {r["Email"]: r for r in files.read_csv(spark, str(broken)).collect()}
    assert len(got) == 2 and (got["a@b.com"]["Note"], got["a@b.com"]["State"]) == ("two\nlines, one cell", "tx") and got["c@d.org"]["extra_0"] == "more\nthere"
    text = tmp_path / "list.txt"
    text.write_text(",".join(["x", "a@b.com", *(f"c{i}" for i in range(11))]) + "\n")
    (r,) = files.read_txt(spark, str(text)).collect()
    assert [r[f"column_{i}"] for i in range(1, 9)] + r["overflow"] == ["x", *(f"c{i}" for i in range(11))]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in/one.txt", "Ann,a@b.com\n\nc@d.org\n")
    assert sorted((r["email"], r["custom1"]) for r in files.read_contacts(spark, str(tmp_path / "a.zip")).collect()) == [("a@b.com", "Ann"), ("c@d.org", None)]


def test_headers_by_words():
    assert infer.is_header(["Contact Name", "Mobile Number", "Opt"]) and not infer.is_header(["Ann", "a@b.com", "city"]) and not infer.is_header(["Ann", "Lee"])


def test_rule_values():
    rules = {r[0]: r[1:] for r in R.domain_rules()}
    assert rules["gmail.com"] == ("Google", "Gmail", "Big4_ISP") and rules["comcast.net"][2] == "Cable_Provider" and "shop1.org" not in rules
    assert R.TYPOS["gmial.com"] == "gmail.com" and R.STATES["NEW YORK"] == "NY" and {"info", "admin"} <= set(R.ROLES) and dict(R.HOSTING_LABELS)["secureserver.net"] == "GoDaddy"
    assert ".de" in R.COUNTRY_TLDS and ".co.uk" in R.COUNTRY_TLDS and R.RESOLVERS["9.9.9.10"] == "Quad9-1" and len(R.RESOLVERS) == 12 and len(R.HEADER_WORDS) == 20


def test_headers_and_types():
    assert infer.unique_names(["email", "", "email", "name"]) == ["email", "column_1", "email_2", "name"]
    assert infer.map_types(["text", "text", "email", "text", "phone"]) == {"email": 2, "phone": 4, "first_name": 0, "last_name": 1, "address": 3}
    assert infer.map_types(["text"]) == {} and infer.schema_label(["Carrier", "x"], {}) == "mobile_data"
    decoy = [["1", "a@b.com"]] * 12
    assert infer.map_headers(["emailid", "contact"], decoy)["email"] == "contact"


def test_sinks(spark, sf, tmp_path):
    rows = base.contacts(spark, sf).drop("mx_valid", "mx_category", "is_spamtrap")
    one = merge.merge_duplicates(rows.filter("file_ordinal = 0")).drop("n_merged")
    two = merge.merge_duplicates(rows).drop("n_merged")
    sinks.write_master(one, f"{tmp_path}/m0")
    for mode in ("skip", "enrich"):
        out = sinks.load(two, f"{tmp_path}/m0", f"{tmp_path}/m_{mode}", mode)
        assert out.count() == two.count() == out.select("email").distinct().count()
    sinks.write_csv(two.select("email", "file_sources"), f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).count() == two.count()


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = "email string, first_name string, validation_status string, data_source string, is_clicker boolean, is_opener boolean"
    head = "email,first_name,validation_status,data_source,is_clicker,is_opener\n"
    (src / "1.csv").write_text(head + "A@x.org,ann,valid,GIO,true,false\nb@x.org,bob,,GIO,false,false\n")
    run = lambda: ingest.ingest(ingest.file_stream(spark, str(src), schema, 1), f"{tmp_path}/master", f"{tmp_path}/ck", "2024-06-30").awaitTermination()
    run()
    (src / "2.csv").write_text(head + "a@x.org,other,valid,GIO,false,false\nc@x.org,cy,,GIO,false,false\n")
    run()
    got = {r["email"]: r["first_name"] for r in spark.read.parquet(f"{tmp_path}/master").collect()}
    assert got == {"a@x.org": "Ann", "b@x.org": "Bob", "c@x.org": "Cy"}
