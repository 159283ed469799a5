"""The loader's side table, counters of a running plan, maintained statistics, and small reports."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from rosterforge.operators import contacts as C
from rosterforge.operators import loading, mx, segments, stats
from rosterforge.plans import base
from rosterforge.sources import files, infer, sinks


def test_bad_cells_go_aside_and_rows_stay(spark):
    rows = [(1, "2/30/2024", "x", "maybe", "7x", "c" * 120), (2, "1/2/2020 10:00", "Male", "YES", " 80 ", "Rome"), (3, None, "", None, "", None)]
    df = loading.load_rows(spark.createDataFrame(rows, "id int, dob string, gender string, is_clicker string, quality_score string, city string"))
    got = {r["id"]: r for r in df.collect()}
    assert len(got) == 3 and (got[1]["dob"], got[1]["gender"], got[1]["quality_score"], len(got[1]["city"])) == (None, None, None, 100)
    assert (str(got[2]["dob"]), got[2]["gender"], got[2]["is_clicker"], got[2]["quality_score"], got[2]["bad"]) == ("2020-01-02", "M", True, 80, [])
    assert got[3]["bad"] == [] and got[3]["city"] is None
    side = {(r["field"], r["reason"]) for r in loading.quarantine(df, "id").collect()}
    assert side == {("dob", "no date"), ("gender", "neither M nor F"), ("is_clicker", "no flag"), ("quality_score", "no number"), ("city", "cut to 100")}
    assert loading.load_rows(spark.createDataFrame([(1,)], "id int")).collect()[0]["bad"] == []


def test_counters_come_with_the_run(spark, sf, tmp_path):
    raw = base.raw(spark, sf).withColumn("file_sources", F.array(F.lit("f")))
    out, counters = loading.counted_run(raw, base.AS_OF)
    out.write.parquet(f"{tmp_path}/out")
    got = counters()
    rejects = {r["reject_reason"]: r["n"] for r in C.reject_counts(C.clean(raw)).collect()}
    assert got["read"] == raw.count() and {k: got[k] for k in rejects} == rejects and got["valid"] == got["read"] - sum(rejects.values())
    assert got["loaded"] == spark.read.parquet(f"{tmp_path}/out").count() and got["duplicates"] == got["valid"] - got["loaded"] > 0


def test_maintained_statistics_equal_a_full_pass(spark, tmp_path):
    r = random.Random(5)
    rows = [(f"d{r.randint(0, 30_000)}.org", r.choice("AB"), r.random() < 0.3, r.random() < 0.2, r.choice([None, 5, 60])) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "email_domain string, email_category string, is_clicker boolean, is_opener boolean, quality_score int").withColumn("b", F.pmod(F.hash("email_domain", "quality_score"), F.lit(3)))
    for b in (0, 1, 2, 2):  # the last batch is run twice
        sinks.add_partials(stats.partials(df.filter(F.col("b") == b), "email_category"), f"{tmp_path}/s", b)
    got = {x["value"]: x for x in stats.merge_partials(spark.read.parquet(f"{tmp_path}/s")).collect()}
    want = df.groupBy("email_category").agg(F.count("*").alias("n"), F.count_if("is_clicker").alias("c"), F.sum("quality_score").alias("s"), F.count_distinct("email_domain").alias("d"))
    for w in want.collect():
        g = got[w["email_category"]]
        assert (g["n"], g["clickers"], g["score_sum"]) == (w["n"], w["c"], w["s"]) and abs(g["domains"] - w["d"]) < 0.03 * w["d"]
    sinks.write_top(spark.createDataFrame([(f"v{i}", i) for i in range(30)], "value string, n long"), f"{tmp_path}/top")
    (part,) = [p for p in os.listdir(tmp_path / "top") if p.startswith("part-")]
    assert [json.loads(x)["n"] for x in open(tmp_path / "top" / part)] == list(range(29, 19, -1))
    sinks.write_report(spark.createDataFrame([("b", None), ("a", 1)], "x string, n long"), f"{tmp_path}/report", "Totals")
    assert [x["value"] for x in spark.read.text(f"{tmp_path}/report").collect()] == ["Totals", "------", "a | 1", "b | "]


def test_file_time_as_sign_up_date(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("Email,Signup Date\na@b.com,2020-01-02\nc@d.org, \n")
    os.utime(p, (1_700_000_000, 1_700_000_000))
    got = {r["email"]: (r["signup_date"], r["signup_from_file"]) for r in files.read_contacts(spark, str(p)).collect()}
    assert got == {"a@b.com": ("2020-01-02", False), "c@d.org": ("2023-11-14 22:13:20", True)}


def test_header_words():
    assert infer.guess_fields(["First Name", "x", '"E-Mail"', "Home Phone", "Street", "Town", "Province", "Postal code", "lname"]) == {"first_name": 0, "last_name": 8, "email": 2, "phone": 3, "address": 4, "city": 5, "state": 0, "zip": 7}  # "st" is in "First"


@pytest.mark.parametrize(("make", "most"), [(lambda c, d, s: segments.union_count(c, s, d), 4), (lambda c, d, s: segments.union_rows(c, s, d), 3)])
def test_unions_shuffle_each_row_once(spark, sf, tmp_path, make, most):
    rows, facts = base.both(spark, sf)
    rows.write.parquet(f"{tmp_path}/c")
    facts.write.parquet(f"{tmp_path}/d")
    c, d = spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/d")
    plan = make(c, d, [segments.Segment(clickers=True), segments.Segment(mx_category="Google")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") - plan.count("BroadcastExchange ") <= most


def test_bucketed_tables_join_without_an_exchange(spark, sf):
    rows, facts = base.contacts(spark, sf), base.dimension(base.contacts(spark, sf))
    want = sorted(map(str, mx.apply_mx(rows, facts).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = sinks.write_bucketed(rows, "contacts_by_domain", "email_domain", 8), sinks.write_bucketed(facts, "domains_by_domain", "domain", 8)
        out = mx.apply_mx(*both)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert sorted(map(str, out.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("contacts_by_domain", "domains_by_domain"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
