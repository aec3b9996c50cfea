"""Shared helpers: table access, scratch tables in the shared folder, Arrow batch mapping."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark whatever the file system."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's shared checkpoint folder.

    Where none is set, a local session takes a folder of this machine; on a cluster, whose executors would each write to
    their own disk, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.drivegauge.scratch", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that all executors share")
        root = "/tmp/checkpoints/drivegauge"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back, so lost executors never force a long recomputation."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and a non-null ``text``: other columns, whatever their names, never reach an operator."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose text adds up to about ``limit`` bytes, to bound a Python worker's memory."""
    import pyarrow.compute as pc

    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        total += int(n)
        if total >= limit:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


_OWNER: list[tuple[str, Callable[[], None]]] = []


def claim(name: str, clear: Callable[[], None]) -> None:
    """Called in a Python worker by the operator that is at work: the memos of the one before it are emptied, since
    workers outlive stages and would keep the memos of all operators they ever ran."""
    if not _OWNER or _OWNER[0][0] != name:
        for _, before in _OWNER:
            before()
        _OWNER[:] = [(name, clear)]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, column: int = 1, limit: int = 4 << 20) -> DataFrame:
    """``mapInArrow`` that hands ``fn`` slices of bounded text size."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, limit):
                out = fn(part)
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)
