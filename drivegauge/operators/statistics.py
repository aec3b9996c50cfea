"""Statistics of errors per region, class and characteristic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivegauge.sources.scratch import stored

from .metrics import deciding
from .quantiles import cube_quantiles

REGIONS = [("DRU", "near", 0.0, 50.0, -8.0, 8.0), ("DRU", "far", 50.0, 150.0, -8.0, 8.0), ("DRU", "rear", -100.0, 0.0, -8.0, 8.0), ("VRU", "near_vru", -30.0, 50.0, -10.0, 10.0), ("VRU", "wide_vru", -100.0, 100.0, -20.0, 20.0)]


def regions_table(spark) -> DataFrame:
    return spark.createDataFrame(REGIONS, "road_user string, division string, x_lo double, x_hi double, y_lo double, y_hi double")


def with_regions(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Band join, many to many: a row per region [lo, hi) that holds the deciding side's place. Vehicles see both kinds
    of region, others those for vulnerable users only. The region table is configuration of a few rows."""
    placed = df.withColumns({"_x": deciding(df, "x"), "_y": deciding(df, "y"), "_user": deciding(df, "road_user"), "class": deciding(df, "type_classification")})
    r = F.broadcast(regions.withColumnRenamed("road_user", "_kind"))
    seen = (F.col("_user") == "DRU") | (F.col("_kind") == "VRU")
    return placed.join(r, seen & (F.col("_x") >= F.col("x_lo")) & (F.col("_x") < F.col("x_hi")) & (F.col("_y") >= F.col("y_lo")) & (F.col("_y") < F.col("y_hi"))).drop("_x", "_y", "_user", "_kind", "x_lo", "x_hi", "y_lo", "y_hi")


def ratio(a: Column, b: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.when(b != 0, a / b).otherwise(0.0)


def recall_precision_stats() -> list[Column]:
    tp, fp, fn, ctp = (F.sum(k) for k in ("TP", "FP", "FN", "CTP"))
    return [tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), ctp.alias("ctp"), F.round(ratio(tp, tp + fn), 6).alias("recall"), F.round(ratio(tp, tp + fp), 6).alias("precision"), F.round(ratio(ctp, tp), 6).alias("type_accuracy"), F.greatest(tp + fp, tp + fn).alias("sample_count")]


#: Quantiles of the absolute errors, by the end of their column's name.
QUANTILES = {"abs_q68": 0.68, "abs_q95": 0.95}


def error_moments(name: str, signed: bool = True, abnormal: str | None = None) -> list[Column]:
    """Mean of the absolute values, mean and deviation of the signed ones, count, pass ratio."""
    value, size = F.col(name), F.abs(F.col(name))
    out = [F.round(F.avg(size), 6).alias(f"{name}_abs_mean")]
    if signed:
        out += [(F.round(F.avg(value), 6) + F.lit(0.0)).alias(f"{name}_mean"), F.round(F.stddev_samp(value), 6).alias(f"{name}_std")]
    out.append(F.count(value).alias(f"{name}_count"))
    if abnormal:
        out.append(F.round(1 - F.sum(abnormal) / F.count("*"), 6).alias(f"{name}_pass_ratio"))
    return out


def error_stats(df: DataFrame, keys: list[str], names: list[str], signed: bool = True, abnormal: str | None = None, **sizes: int) -> DataFrame:
    """Moments of some errors per cell, and the exact 68 and 95 % quantiles of their absolute values, whatever a cell's size."""
    rows = stored(df.select(*keys, *names, *([abnormal] if abnormal else [])), "errors")
    cells = cube(rows, keys, [m for n in names for m in error_moments(n, signed, abnormal)])
    found = cube_quantiles(rows, keys, {n: F.abs(n) for n in names}, QUANTILES, written=True, **sizes)
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    return cells.alias("l").join(found.alias("r"), on, "left").select("l.*", *[F.round(f"r.{n}_{q}", 6).alias(f"{n}_{q}") for n in names for q in QUANTILES])


def cube(df: DataFrame, keys: list[str], aggregates: list[Column]) -> DataFrame:
    """One pass for all cells; empty cells do not exist."""
    return df.groupBy(*keys).agg(*aggregates)


def traffic_flow(objects: DataFrame, frames: DataFrame, ahead: float = 30.0, aside: float = 8.0, fastest: float = 80.0) -> DataFrame:
    """Labels of a scenario: mean speed, flow (speeds / 60) and share of the area taken, each a mean over its frames; frames
    without objects nearby count as 0. Speeds above ``fastest`` are replaced by the mean of the others in the scenario.

    ``objects`` has scenario_no, frame_ts_us, x, y, vx, vy, length, width; ``frames`` scenario_no and frame_ts_us.
    """
    near = objects.filter((F.abs("x") <= ahead) & (F.abs("y") <= aside)).withColumn("_v", F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy")))
    usual = near.groupBy("scenario_no").agg(F.avg(F.when(F.col("_v") <= fastest, F.col("_v"))).alias("_usual"))
    one = near.groupBy("scenario_no", "frame_ts_us").agg(F.count("*").alias("_n"), F.sum(F.when(F.col("_v") <= fastest, F.col("_v"))).alias("_sum"), F.count(F.when(F.col("_v") > fastest, 1)).alias("_fast"), F.sum(F.col("length") * F.col("width")).alias("_area"))
    per = one.join(usual, "scenario_no").withColumn("_all", F.coalesce("_sum", F.lit(0.0)) + F.when(F.col("_fast") > 0, F.col("_fast") * F.col("_usual")).otherwise(0.0))
    sums = per.groupBy("scenario_no").agg(F.sum(F.col("_all") / F.col("_n")).alias("_speed"), F.sum(F.col("_all") / 60).alias("_flow"), F.sum(F.col("_area") / (4 * ahead * aside)).alias("_share"))
    total = frames.select("scenario_no", "frame_ts_us").distinct().groupBy("scenario_no").agg(F.count("*").alias("_f"))
    return total.join(sums, "scenario_no", "left").select("scenario_no", *[(F.coalesce(a, F.lit(0.0)) / F.col("_f")).alias(b) for a, b in (("_speed", "average_velocity"), ("_flow", "flow"), ("_share", "area_share"))])
