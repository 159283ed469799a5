"""Incremental files: a stream of contact records into a master table, first one wins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterforge.operators import contacts as C
from rosterforge.operators import merge
from rosterforge.sources import versions


def file_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("header", "true").csv(folder)


def ingest(stream: DataFrame, master: str, checkpoint: str, as_of: str) -> StreamingQuery:
    """Each micro-batch is prepared, merged within itself, and its new addresses are written to ``master``.

    Every batch writes its own folder (batch=<n>), so a batch that is run again after a
    failure replaces its output instead of adding to it; it reads the folders of earlier
    batches only.  The checkpoint remembers the files that are done.
    """

    def put(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumns({"file_ordinal": F.lit(0), "row_ordinal": F.monotonically_increasing_id(), "file_sources": F.array(F.lit(f"batch_{n}"))})
        ready = merge.merge_duplicates(C.prepare(rows, as_of), lower=True).drop("n_merged")
        fs = spark._jvm.org.apache.hadoop.fs.Path(master).getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(master)):
            seen = spark.read.option("basePath", master).schema("email string, batch long").parquet(master).filter(F.col("batch") < n)
            ready = ready.join(seen.select("email"), "email", "left_anti")
        ready.write.mode("overwrite").parquet(f"{master}/batch={n}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_enriching(stream: DataFrame, master: str, checkpoint: str, ready: Callable[[DataFrame], DataFrame], buckets: int = versions.BUCKETS) -> StreamingQuery:
    """Each micro-batch enriches the versioned table ``master``: late rows fill and update what is stored.

    ``ready`` makes one row per email of a batch.  A batch that is run again after its commit
    changes nothing, one that failed before it is done anew; each reads and writes only the
    buckets of its own addresses.  The result is that of ``merge.enrich`` batch by batch.
    """

    def put(batch: DataFrame, n: int) -> None:
        versions.upsert(ready(batch), master, checkpoint, str(n), buckets=buckets)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drop_repeats(events: DataFrame, key: str, time: str, late: str = "10 minutes") -> DataFrame:
    """Extension: repeats of a key within the watermark go, with bounded state."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, time: str = "ts", by: str = "event_type", width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Extension: counts per window and type, late rows up to ``late``."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))
