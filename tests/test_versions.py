"""The versioned master table, the enriching stream and the import log."""

import json
import os

import pytest
from pyspark.sql import functions as F

from rosterforge.operators import importing, merge
from rosterforge.sources import manifest, versions
from rosterforge.streaming import ingest

SCHEMA = "email string, first_name string, city string, quality_score int, is_clicker boolean, file_sources array<string>"
BATCHES = [
    [("a@x.org", "Ann", None, 40, False, ["0"]), ("b@x.org", None, "Rome", 50, True, ["0"])],
    [("b@x.org", "Bob", None, 30, False, ["1"]), ("c@x.org", None, None, None, None, ["1"])],
    [],
    [("a@x.org", None, "Bonn", 70, True, ["3"]), ("c@x.org", "Cy", "Oslo", 10, False, ["3"]), ("d@x.org", "Di", "", 5, False, ["3"])],
]


def rows_of(df):
    return sorted(tuple(r[c] for c in "email first_name city quality_score is_clicker file_sources".split()) for r in df.collect())


def in_order(spark, batches):
    out = spark.createDataFrame([], SCHEMA)
    for b in batches:
        out = merge.enrich(out, spark.createDataFrame(b, SCHEMA), merge.ENRICH_IMPORT).drop("outcome")
    return rows_of(out)


def test_versions_and_retries(spark, tmp_path):
    master = f"{tmp_path}/m"
    assert versions.state(spark, master) is None
    for n, b in enumerate(BATCHES):
        got = versions.upsert(spark.createDataFrame(b, SCHEMA), master, "s", str(n), buckets=8)
        assert got["version"] == n and rows_of(versions.read(spark, master)) == in_order(spark, BATCHES[: n + 1])
        again = versions.upsert(spark.createDataFrame(b, SCHEMA), master, "s", str(n))
        assert again == {"version": n, "inserted": 0, "updated": 0}
    assert (got["inserted"], got["updated"]) == (1, 2)
    assert rows_of(versions.read(spark, master, 1)) == in_order(spark, BATCHES[:2])
    with pytest.raises(ValueError):
        versions.read(spark, master, 9)
    before = versions.state(spark, master)["buckets"]
    versions.upsert(spark.createDataFrame([("z@x.org", "Zoe", None, 1, False, ["t"])], SCHEMA), master, "t", "0")
    after = versions.state(spark, master)["buckets"]
    assert sum(before.get(b) != p for b, p in after.items()) == 1  # one address, one bucket
    want = rows_of(versions.read(spark, master))
    assert versions.drop_old(spark, master, 1) > 0 and rows_of(versions.read(spark, master)) == want
    assert versions.state(spark, master, 0) is None


def test_a_run_that_dies_before_the_commit_is_done_anew(spark, tmp_path, monkeypatch):
    master = f"{tmp_path}/m"
    versions.upsert(spark.createDataFrame(BATCHES[0], SCHEMA), master, "s", "0", buckets=4)
    commit = versions._commit
    monkeypatch.setattr(versions, "_commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        versions.upsert(spark.createDataFrame(BATCHES[3], SCHEMA), master, "s", "1")
    assert rows_of(versions.read(spark, master)) == in_order(spark, BATCHES[:1])
    monkeypatch.setattr(versions, "_commit", commit)
    versions.upsert(spark.createDataFrame(BATCHES[1], SCHEMA), master, "s", "1")
    assert rows_of(versions.read(spark, master)) == in_order(spark, BATCHES[:2])
    with pytest.raises(RuntimeError):
        versions._commit(spark, master, versions.state(spark, master))


@pytest.mark.parametrize("per_batch", [1, 2, 4])
def test_enriching_stream_equals_batches_in_order(spark, tmp_path, per_batch):
    src = tmp_path / "in"
    src.mkdir()
    for n, b in enumerate(BATCHES):
        (src / f"{n}.json").write_text("".join(json.dumps(dict(zip("email first_name city quality_score is_clicker file_sources".split(), r))) + "\n" for r in b))
        os.utime(src / f"{n}.json", (1_700_000_000 + 10 * n,) * 2)  # the stream takes files by their time
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch).json(str(src))
    seen = []

    def ready(batch):
        # Within a batch: the files in their order, as an import of each would.
        parts = sorted({r["file_sources"][0] for r in batch.select("file_sources").collect()})
        seen.append(parts)
        out = batch.limit(0)
        for p in parts:
            out = merge.enrich(out, batch.filter(F.col("file_sources")[0] == p), merge.ENRICH_IMPORT).drop("outcome")
        return out

    run = lambda: ingest.ingest_enriching(stream(), f"{tmp_path}/m", f"{tmp_path}/ck", ready, 4).awaitTermination()
    run()
    assert rows_of(versions.read(spark, f"{tmp_path}/m")) == in_order(spark, BATCHES)
    at = versions.state(spark, f"{tmp_path}/m")["version"]
    run()
    assert versions.state(spark, f"{tmp_path}/m")["version"] == at and sum(map(len, seen)) == 3


def test_import_log(spark, tmp_path, monkeypatch):
    root, master, log = tmp_path / "in", f"{tmp_path}/m", f"{tmp_path}/log"
    root.mkdir()
    (root / "1.csv").write_text("Email,First Name,City\nann@shop.org,Ann,\nbob@shop.org,,Rome\nann@shop.org,Late,\n")
    (root / "22.csv").write_text("Email,First Name,City\nbob@shop.org,Bob,\ncy@shop.org,Cy,Oslo\ninfo,x,y\n" + "\n" * 50)
    (root / "3.csv").write_text("Email,First Name\nnot an address,x\n")
    (root / "4.zip").write_bytes(b"not an archive" * 30)
    run = lambda: {e["path"].rsplit("/", 1)[-1]: e for e in manifest.import_files(spark, str(root), log, master)}
    got = run()
    assert {n: (e["state"], e["inserted"], e["updated"]) for n, e in got.items()} == {"1.csv": ("done", 2, 0), "22.csv": ("done", 1, 1), "3.csv": ("empty", 0, 0), "4.zip": ("failed", 0, 0)}
    assert got["4.zip"]["message"] and sorted(p.name for p in root.iterdir() if p.name[0] != ".") == ["1.csv.complete", "22.csv.complete", "3.csv", "4.zip"]
    table = {r["email"]: (r["first_name"], r["city"], r["file_sources"]) for r in versions.read(spark, master).collect()}
    assert table == {"ann@shop.org": ("Ann", None, ["1.csv"]), "bob@shop.org": ("Bob", "Rome", ["1.csv", "22.csv"]), "cy@shop.org": ("Cy", "Oslo", ["22.csv"])}
    assert list(run()) == ["4.zip"]  # only what failed is tried again
    # A run that dies after the commit, before the log: the file is logged, but not loaded twice.
    (root / "5.csv").write_text("Email,First Name,City\ndi@shop.org,Di,Bern\n")
    append = manifest.sinks.append_log
    monkeypatch.setattr(manifest.sinks, "append_log", lambda *a: 1 / 0)
    (root / "4.zip").rename(tmp_path / "4.zip")
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.setattr(manifest.sinks, "append_log", append)
    version = versions.state(spark, master)["version"]
    assert run()["5.csv"]["state"] == "done" and versions.state(spark, master)["version"] == version
    assert (root / "5.csv.complete").exists() and manifest.pending(spark, str(root), log).count() == 0
    assert manifest.log(spark, log).count() == 6
