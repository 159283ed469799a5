"""Importing the files of a folder once each: a log of what became of every file, and ``.complete`` names after the commit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.operators import importing
from rosterforge.sources import files, sinks, versions

SCHEMA = "path string, length long, state string, inserted long, updated long, message string"
#: States after which a file is not looked at again; a failed one is.
SETTLED = ("done", "empty")
COMPLETE = ".complete"


def log(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of an import log, none where there is no log yet."""
    fs, p = versions._fs(spark, path)
    return spark.read.schema(SCHEMA).parquet(path) if fs.exists(p) else spark.createDataFrame([], SCHEMA)


def pending(spark: SparkSession, root: str, log_path: str) -> DataFrame:
    """The contact files below ``root`` that the log does not hold as settled at their length, smallest first."""
    settled = log(spark, log_path).filter(F.col("state").isin(*SETTLED)).select("path", "length").distinct()
    return files.discover(spark, root).join(settled, ["path", "length"], "left_anti").orderBy("length", "path")


def ready_rows(raw: DataFrame, path: str) -> DataFrame:
    """One stored row per address of a file's records."""
    rows = importing.first_of_each(importing.staged(importing.records(raw)))
    return rows.drop("file_ordinal", "row_ordinal").withColumn("file_sources", F.array(F.lit(path.rsplit("/", 1)[-1])))


def import_files(spark: SparkSession, root: str, log_path: str, master: str, ready: Callable[[DataFrame, str], DataFrame] = ready_rows, complete: bool = True) -> list[dict]:
    """Upserts every pending file into ``master``, one after another, so that later files enrich earlier ones; gives the new log entries.

    A file without usable rows is ``empty``, one that fails is ``failed`` with the reason, and the
    others go on.  A file is renamed only when its upsert is committed and logged; a run that
    dies in between neither loads it twice (the table knows its last file) nor leaves its name.
    """
    if complete:
        done = log(spark, log_path).filter("state = 'done'").select("path", "length")
        for r in files.discover(spark, root).join(done, ["path", "length"], "left_semi").collect():
            _rename(spark, r["path"])
    out = []
    for r in pending(spark, root, log_path).collect():  # the file listing
        entry = {"path": r["path"], "length": r["length"], "state": "done", "inserted": 0, "updated": 0, "message": None}
        try:
            rows = ready(files.read_contacts(spark, r["path"]), r["path"])
            if rows.isEmpty():
                entry["state"] = "empty"
            else:
                got = versions.upsert(rows, master, log_path, f"{r['path']}|{r['length']}")
                entry |= {k: got[k] for k in ("inserted", "updated")}
        except Exception as e:  # noqa: BLE001 - one bad file must not stop the others
            entry |= {"state": "failed", "message": str(e)[:500]}
        sinks.append_log(spark, log_path, [tuple(entry.values())], SCHEMA)
        if complete and entry["state"] == "done":
            _rename(spark, r["path"])
        out.append(entry)
    return out


def _rename(spark: SparkSession, path: str) -> None:
    fs, p = versions._fs(spark, path)
    if not fs.rename(p, versions._fs(spark, path + COMPLETE)[1]):
        raise RuntimeError(f"cannot rename {path}")
