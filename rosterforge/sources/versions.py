"""A master table in versions: an upsert rewrites the buckets that it touches and then names the new version in one step.

``<master>/data/v=<n>/_bucket=<b>`` holds rows, ``<master>/_versions/<n>.json`` says where each
bucket's rows lie in version n.  Readers take the highest version, so they never see half
an upsert; a failed one leaves files that the next overwrites.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.operators import merge

#: Buckets by hash of the address.  Fixed when a table is made: about one per 128 MB of it.
BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _bucket(n: int):
    return F.pmod(F.xxhash64("email"), F.lit(n)).cast("int")


def state(spark: SparkSession, master: str, version: int | None = None) -> dict | None:
    """What the given version (else the newest) holds; None where there is no table."""
    fs, folder = _fs(spark, f"{master}/_versions")
    if not fs.exists(folder):
        return None
    known = [int(n.removesuffix(".json")) for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.endswith(".json") and n[0].isdigit()]
    if not known or (version is not None and version not in known):
        return None
    name = f"{master}/_versions/{max(known) if version is None else version}.json"
    return json.loads(spark.read.text(name, wholetext=True).first()[0])


def _rows(spark: SparkSession, master: str, held: dict, buckets) -> DataFrame:
    schema = T.StructType.fromJson(held["schema"])
    paths = sorted({held["buckets"][str(b)] for b in buckets if str(b) in held["buckets"]})
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{master}/{p}" for p in paths])


def read(spark: SparkSession, master: str, version: int | None = None) -> DataFrame:
    """The rows of a version, else of the newest."""
    held = state(spark, master, version)
    if held is None:
        raise ValueError(f"no such table or version: {master}")
    return _rows(spark, master, held, range(held["n_buckets"]))


def upsert(rows: DataFrame, master: str, source: str, token: str, fields: tuple[str, ...] = merge.ENRICH_IMPORT, buckets: int = BUCKETS) -> dict:
    """The next version: ``merge.enrich`` of the table and ``rows`` (one per email); gives version, inserted and updated.

    ``token`` names this upsert among those of ``source``, which come one after another: if the
    last one that was committed has the same token, nothing is done, so a repeated run changes
    nothing.  Only buckets with rows of the batch are read and written.  One writer at a time.
    """
    spark = rows.sparkSession
    held = state(spark, master) or {"version": -1, "n_buckets": buckets, "buckets": {}, "sources": {}, "schema": json.loads(rows.schema.json())}
    if held["sources"].get(source) == token:
        return {"version": held["version"], "inserted": 0, "updated": 0}
    batch = rows.withColumn("_bucket", _bucket(held["n_buckets"])).persist()
    try:
        touched = [r[0] for r in batch.select("_bucket").distinct().collect()]  # at most n_buckets
        version, seen = held["version"] + 1, Observation()
        old = _rows(spark, master, held, touched)
        new = merge.enrich(old, batch.drop("_bucket"), fields)
        new = new.observe(seen, F.count_if(F.col("outcome") == "inserted").alias("inserted"), F.count_if(F.col("outcome") == "updated").alias("updated"))
        out = new.drop("outcome").withColumn("_bucket", _bucket(held["n_buckets"])).hint("rebalance", "_bucket")
        if touched:
            out.write.mode("overwrite").partitionBy("_bucket").parquet(f"{master}/data/v={version}")
    finally:
        batch.unpersist()
    counts = dict(seen.get) if touched else {"inserted": 0, "updated": 0}
    moved = {str(b): f"data/v={version}/_bucket={b}" for b in touched}
    _commit(spark, master, held | {"version": version, "buckets": held["buckets"] | moved, "sources": held["sources"] | {source: token}, "counts": counts})
    return {"version": version} | counts


def _commit(spark: SparkSession, master: str, held: dict) -> None:
    """The version's file appears whole under its name, or not at all."""
    fs, draft = _fs(spark, f"{master}/_versions/.{uuid.uuid4().hex}")
    _, final = _fs(spark, f"{master}/_versions/{held['version']}.json")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(held).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"version {held['version']} of {master} was written by another run")


def drop_old(spark: SparkSession, master: str, keep: int = 2) -> int:
    """Deletes the data that none of the newest ``keep`` versions reads; gives the number of bucket folders deleted."""
    newest = state(spark, master)["version"]
    kept = {p for v in range(max(0, newest - keep + 1), newest + 1) if (s := state(spark, master, v)) for p in s["buckets"].values()}
    fs, folder = _fs(spark, f"{master}/data")
    gone = 0
    for v in fs.listStatus(folder):
        for b in fs.listStatus(v.getPath()):
            name = f"data/{v.getPath().getName()}/{b.getPath().getName()}"
            if b.isDirectory() and name not in kept:
                gone += fs.delete(b.getPath(), True)
    for v in range(newest - keep + 1):
        fs.delete(_fs(spark, f"{master}/_versions/{v}.json")[1], False)
    return gone
