"""Readers and writers of topic tables, logs and lists; every text format is parsed by Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_topic(spark: SparkSession, path: str, schema: StructType | str, columns: list[str] | None = None) -> DataFrame:
    """All numbered CSV parts of a topic, without its rate tables."""
    df = spark.read.option("header", True).schema(schema).csv(path).filter(~F.input_file_name().contains("_hz"))
    return df.select(*columns) if columns else df


def ground_truth(df: DataFrame, names: dict[str, str], types: tuple[int, ...] | None = (1, 2, 18)) -> DataFrame:
    """Common column names; obstacles keep their classes, lines get confidence 0.5 where there is none."""
    out = df.withColumnsRenamed(names)
    if types:
        return out.filter(F.col("type").isin(*types))
    return out.withColumn("confidence", F.coalesce(F.col("confidence") if "confidence" in out.columns else F.lit(None), F.lit(0.5)))


def frames(df: DataFrame, keys: list[str], stamp: str, local: str) -> DataFrame:
    """One row per stamp, the first by the local clock."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, stamp).orderBy(local))).filter("_r = 1").drop("_r")


def ego_speed(motion: DataFrame, vehicle: DataFrame, keys: list[str], stamp: str, skip: int = 50) -> DataFrame:
    """Speed from the motion topic, else from the vehicle topic, each without its first rows."""
    trim = lambda d: d.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(stamp))).filter(F.col("_r") > skip).drop("_r")
    first = trim(motion).select(*keys, stamp, "ego_vx")
    return first.unionByName(trim(vehicle).select(*keys, stamp, "ego_vx").join(first.select(*keys).distinct(), keys, "left_anti"))


def sync_pairs(lines: DataFrame) -> DataFrame:
    """``t0, t1`` of lines with two numbers parted by a comma."""
    parts = F.split("value", ",\\s*")
    return lines.select(F.trim(parts[0]).try_cast("double").alias("t0"), F.trim(F.get(parts, F.lit(1))).try_cast("double").alias("t1")).filter("t0 IS NOT NULL AND t1 IS NOT NULL")


def frame_times(lines: DataFrame, start: float) -> DataFrame:
    parts = F.split("value", " ")
    return lines.select(parts[0].try_cast("long").alias("frame_index"), (F.get(parts, F.lit(1)).try_cast("double") + start).alias("time_stamp"))


def sensor_log(lines: DataFrame) -> DataFrame:
    """``camera, fps`` pairs of the log's rate lines, with their text of time."""
    kept = lines.filter(F.col("value").contains("sensor send msg fps"))
    pairs = F.arrays_zip(F.regexp_extract_all("value", F.lit(r"\[(camera_\d+)\]"), 1).alias("camera"), F.regexp_extract_all("value", F.lit(r"\]: ([0-9.]+)"), 1).alias("fps"))
    return kept.select(F.regexp_extract("value", r"^(\S+ \S+)", 1).alias("at"), F.explode(pairs).alias("p")).select("at", F.col("p.camera").alias("camera"), F.col("p.fps").cast("double").alias("fps"))


def rate_line_ok(value, targets: dict[str, float]):
    """Whether a line reports all cameras, each within two hundredths of its target."""
    cameras, rates = F.regexp_extract_all(value, F.lit(r"\[(camera_\d+)\]"), 1), F.regexp_extract_all(value, F.lit(r"\]: ([0-9.]+)"), 1)
    known = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])
    share = F.zip_with(cameras, rates, lambda c, r: r.cast("double") / F.element_at(known, c))
    return (F.size(cameras) == len(targets)) & F.forall(share, lambda s: F.coalesce(s.between(0.98, 1.02), F.lit(False)))


def frame_info_log(lines: DataFrame) -> DataFrame:
    found = lines.filter(F.col("value").rlike(r"n:\s*\d+.*pts_time:"))
    get = lambda p: F.regexp_extract("value", p, 1)
    return found.select(get(r"n:\s*(\d+)").cast("long").alias("frame_index"), get(r"pts_time:\s*([0-9.]+)").cast("double").alias("time_stamp"), get(r"type:\s*([IBP])").alias("frame_type"))


def can_mapping(rows: DataFrame) -> DataFrame:
    return rows.groupBy("topic", "msg_type").agg(F.sort_array(F.collect_list(F.struct("field", "signal_expr"))).alias("fields"))


def calibration(docs: DataFrame) -> DataFrame:
    """A row per camera of documents with a map of cameras."""
    return docs.select(F.explode("cameras").alias("camera", "p")).select("camera", "p.*")


def scenario_inventory(paths: DataFrame, sensors: list[str]) -> DataFrame:
    """A clip per row and a path per sensor (the first in order), from paths ``.../<clip>/<sensor>...``."""
    parsed = paths.select("path", F.regexp_extract("path", r"([A-Za-z0-9_]+_n\d{6})", 1).alias("id"), F.regexp_extract("path", "(" + "|".join(sensors) + ")", 1).alias("sensor")).filter("id != '' AND sensor != ''")
    return parsed.groupBy("id").pivot("sensor", sensors).agg(F.min("path"))


def complete(df: DataFrame, required: list[str], allowed: list[str]) -> DataFrame:
    """Complete with all sensors, or with none but the allowed ones missing, all of those together."""
    have = lambda names: [F.col(n).isNotNull() for n in names]
    every = lambda conds: F.forall(F.array(*conds), lambda x: x)
    rest = [n for n in required if n not in allowed]
    return df.withColumn("complete", every(have(required)) | (every(have(rest)) & every([~c for c in have(allowed)])))


def package_listing(objects: DataFrame, key: str, include: list[str], exclude: list[str], done: DataFrame) -> DataFrame:
    """Object keys with any of the one and none of the other texts that are not recorded as done."""
    any_of = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.col(key), w))
    return objects.filter(any_of(include) & ~any_of(exclude)).join(done.select(key), key, "left_anti")


def write_parts(df: DataFrame, path: str, rows: int = 100_000) -> None:
    """Rows by topic and scenario in files of bounded length."""
    df.write.mode("append").partitionBy("topic", "scenario_no").option("maxRecordsPerFile", rows).parquet(path)


def write_records(df: DataFrame, path: str) -> None:
    """One JSON document per statistic."""
    df.write.mode("append").json(path)


def write_report_table(df: DataFrame, path: str, tag: str, rows: list[str], cell: str, columns: list[str], value: str) -> None:
    """A table per tag: a row per cell group, a column per given name, rows in order within the tag's one file."""
    wide = df.groupBy(tag, *rows).pivot(cell, columns).agg(F.first(value))
    wide.repartition(tag).sortWithinPartitions(tag, *rows).write.mode("append").partitionBy(tag).parquet(path)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Appends the rows whose key the store lacks, one per key. A run that is repeated adds nothing."""
    store = df.sparkSession.read.schema(df.schema).parquet(path)
    df.dropDuplicates([key]).join(store.select(key), key, "left_anti").select(*df.columns).write.mode("append").parquet(path)


def topic_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry of topics: package, message type, counts of publishers and subscribers, whether there is a header."""
    df = spark.read.option("header", True).csv(path)
    return df.select("topic", "package", "msg_type", *[F.col(k).try_cast("long").alias(k) for k in ("pub_count", "sub_count")], F.col("topic_header_flag").try_cast("boolean").alias("topic_header_flag"))
