"""Writing contacts: tables, exports, logs, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.operators import merge, segments


def write_csv(rows: DataFrame, path: str, header: bool = True) -> None:
    """Distributed export: one file per partition."""
    segments.export_rows(rows).write.mode("overwrite").csv(path, header=header, emptyValue="")


def append_log(spark: SparkSession, path: str, rows: list[tuple], schema: str) -> None:
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def write_master(rows: DataFrame, path: str) -> None:
    """Laid out by domain within files, so that filters on it skip row groups."""
    rows.repartitionByRange("email_domain", "email").sortWithinPartitions("email_domain", "email").write.mode("overwrite").parquet(path)


def write_bucketed(rows: DataFrame, table: str, by: str, buckets: int) -> DataFrame:
    """A catalog table parted by ``by`` into ``buckets`` once: joins with another such table on it need no exchange.

    For contacts by ``email_domain`` and the dimension by ``domain``, with the same number of buckets.
    """
    rows.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(by).saveAsTable(table)
    return rows.sparkSession.table(table)


def load(batch: DataFrame, master_path: str, next_path: str, mode: str = "skip") -> DataFrame:
    """The next version of the master table, written to ``next_path``: mode skip keeps stored rows, enrich fills them.

    A new folder each time: a failed or repeated run never touches the version in use.
    """
    master = batch.sparkSession.read.parquet(master_path)
    if mode == "skip":
        merge.insert_if_absent(master, batch).write.mode("overwrite").parquet(next_path)
    elif mode == "enrich":
        merge.enrich(master, batch, merge.ENRICH_IMPORT).drop("outcome").write.mode("overwrite").parquet(next_path)
    else:
        raise ValueError(f"no such mode: {mode}")
    return batch.sparkSession.read.parquet(next_path)


def snapshot(stats: DataFrame, path: str, as_of: str) -> None:
    """(stat_name, stat_value) rows of a day."""
    stats.withColumn("as_of", F.lit(as_of)).write.mode("append").parquet(path)


def add_partials(shares: DataFrame, path: str, batch: int) -> None:
    """A batch's share of the maintained statistics (``stats.partials``); a batch that is run again replaces its own."""
    shares.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def write_top(stats: DataFrame, path: str, by: str = "n", k: int = 10) -> None:
    """The ``k`` largest rows as one JSON file."""
    stats.orderBy(F.col(by).desc_nulls_last(), *[c for c in stats.columns if c != by]).limit(k).coalesce(1).write.mode("overwrite").json(path)


def write_report(stats: DataFrame, path: str, title: str) -> None:
    """A text file of a title and one line per row of a small table: its columns, joined by ' | '."""
    lines = stats.select(F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in stats.columns]).alias("line"))
    head = stats.sparkSession.createDataFrame([(0, title), (1, "-" * len(title))], "at int, line string")
    head.unionByName(lines.withColumn("at", F.lit(2))).coalesce(1).sortWithinPartitions("at", "line").select("line").write.mode("overwrite").text(path)
