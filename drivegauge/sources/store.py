"""A table of results with a unique key that several writers may extend at the same time.

Layout: ``data/<name>`` holds the Parquet files of one insert, ``log/<version>`` says which data a version adds. A log
entry is put only if there is none of its number (atomic in the file systems that executors share: a create that never
overwrites); that is the commit. Who loses the race reads what the winner added, drops its own rows of keys that are now
taken, and tries the next number. So the rows of one key are those of one insert, and of one row of it. Data without a
log entry, left by a writer that died, is never read.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one of that name; whether it was created."""
    fs, place = _hadoop(spark, path)
    fs.mkdirs(place.getParent())
    if fs.getScheme() == "file":  # whose Hadoop client looks first and creates then
        try:
            handle = os.open(place.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with os.fdopen(handle, "w") as f:
            f.write(text)
        return True
    from py4j.protocol import Py4JJavaError

    try:
        out = fs.create(place, False)
    except Py4JJavaError as e:
        if fs.exists(place):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


class ResultStore:
    """Rows of ``schema`` in ``path``, one for each ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType | str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = spark.createDataFrame([], schema).schema

    def _log(self, version: int) -> str:
        return f"{self.path}/log/{version:012d}.json"

    def versions(self, after: int = 0) -> list[tuple[int, str]]:
        """Numbers and data of the versions behind ``after``, in order."""
        fs, place = _hadoop(self.spark, f"{self.path}/log")
        if not fs.exists(place):
            return []
        numbers = sorted(int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(place) if s.getPath().getName().endswith(".json"))
        rows = self.spark.read.schema("version long, data string").json([self._log(n) for n in numbers if n > after]) if numbers and numbers[-1] > after else None
        return sorted((r["version"], r["data"]) for r in rows.collect()) if rows is not None else []

    def _data(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{n}" for n in names])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default of the latest."""
        return self._data([d for v, d in self.versions() if version is None or v <= version])

    def insert(self, df: DataFrame, order: list[str] | None = None) -> int:
        """Add the rows whose key the store lacks, of several with one key the first in ``order``; the version that holds them.

        Rows without key are not taken.
        """
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).filter(F.col(self.key).isNotNull())
        first = Window.partitionBy(self.key).orderBy(*(order or self.schema.names))
        rows = rows.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")
        known, seen = 0, []
        while True:
            found = self.versions(known)
            if found or not seen:
                taken = self._data([d for _, d in found]).select(self.key)
                name = uuid.uuid4().hex
                rows.join(taken, self.key, "left_anti").select(*self.schema.names).write.parquet(f"{self.path}/data/{name}")
                rows, seen = self._data([name]), [name]  # what is left is settled; later rounds look at new versions only
                known = found[-1][0] if found else known
            if put_if_absent(self.spark, self._log(known + 1), json.dumps({"version": known + 1, "data": seen[0]})):
                return known + 1
