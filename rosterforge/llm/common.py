"""Shared helpers: the shared scratch folder, staged tables, small offset joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch that a task works on at once.
ARROW_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a fresh local one serves sessions that run in one process, and an
    error tells the others to set it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Paths of staged tables that are still there.
_STAGED: set[str] = set()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors.

    Tables that a returned frame still reads stay until :func:`drop_all_staged`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    _STAGED.add(path)
    return out


def drop_staged(df: DataFrame | None) -> None:
    """Delete a table made by :func:`stage` that nothing reads any more."""
    path = getattr(df, "_staged_at", None)
    if path:
        _delete(df.sparkSession, path)


def drop_all_staged(spark: SparkSession) -> None:
    """Delete every table that :func:`stage` has made in this process: for the end of a run, when its results are written."""
    for path in list(_STAGED):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _STAGED.discard(path)


def row_slices(batches, rows: int = ARROW_ROWS):
    """Arrow batches cut to at most ``rows`` rows, so that what a task makes of one stays small."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def byte_slices(batches, column: int, most: int, rows: int = ARROW_ROWS):
    """Arrow batches cut to at most ``rows`` rows and about ``most`` bytes of a string or binary column; a longer value is alone."""
    for b in row_slices(batches, rows):
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy().astype(np.int64)
        lo = held = 0
        for i, n in enumerate(size.tolist()):
            if held and held + n > most:
                yield b.slice(lo, i - lo)
                lo, held = i, 0
            held += n
        yield b.slice(lo)


def running_bases(totals: DataFrame, key: str, total: str, base: str = "base") -> DataFrame:
    """(key, base): the sum of the totals of all smaller keys.

    One row per partition of a table comes to the driver (16 bytes for about 100 MB
    of input), never rows of the data.
    """
    spark, rows, at = totals.sparkSession, [], 0
    for k, n in sorted((r[0], r[1]) for r in totals.select(key, total).collect()):
        rows.append((k, at))
        at += n
    return spark.createDataFrame(rows, T.StructType([T.StructField(key, T.IntegerType()), T.StructField(base, T.LongType())]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(df: DataFrame, at_least: int = 1) -> int:
    """Shuffle partitions the session asks for."""
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])
