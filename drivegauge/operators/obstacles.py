"""Derived columns and per-frame flags of obstacles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drivegauge.functions.expressions import azimuth

FRAME = ["scenario_no", "frame_ts_us"]


def type_classification(kind: Column, sub: Column, length: Column, height: Column) -> Column:
    """car, truck_bus, pedestrian or cyclist; other types have none. Unknown subtypes are told by their size."""
    by_size = F.when((length <= 5.99) & (height <= 2.8), "car").otherwise("truck_bus")
    vehicle = F.when(sub.isin(1, 3, 9, 11), "car").when(sub.isin(4, 5, 12), "truck_bus").otherwise(by_size)
    return F.when(kind == 2, "pedestrian").when(kind == 18, "cyclist").when(kind == 1, vehicle)


def road_user(kind: Column) -> Column:
    return F.when(kind.isin(2, 18), "VRU").when(kind == 1, "DRU")


def with_class(df: DataFrame) -> DataFrame:
    return df.withColumns({"type_classification": type_classification(F.col("type"), F.col("sub_type"), F.col("length"), F.col("height")), "road_user": road_user(F.col("type"))})


def with_corners(df: DataFrame) -> DataFrame:
    """Distance, the four corners (rear right, front right, front left, rear left) and the one of least |x|."""
    c, kind = F.col, F.col("type_classification")
    cap = F.when(kind == "car", 0.255 * c("length") + 0.7).when(kind == "truck_bus", 2.6).when(kind == "pedestrian", 0.8).when(kind == "cyclist", 1.0)
    width = F.when(cap.isNull(), c("width")).otherwise(F.least(c("width"), cap))
    out = df.withColumns({"distance": F.sqrt(c("x") ** 2 + c("y") ** 2), "_w": width, "_cos": F.cos("yaw"), "_sin": F.sin("yaw")})
    for i, (a, b) in enumerate(((-1, -1), (1, -1), (1, 1), (-1, 1))):
        l2, w2 = c("length") * (a / 2), c("_w") * (b / 2)
        out = out.withColumns({f"pt_{i}_x": c("x") + l2 * c("_cos") - w2 * c("_sin"), f"pt_{i}_y": c("y") + l2 * c("_sin") + w2 * c("_cos")})
    nearest = F.array_min(F.array(*[F.struct(F.abs(c(f"pt_{i}_x")).alias("a"), F.lit(i).alias("i"), c(f"pt_{i}_x").alias("x"), c(f"pt_{i}_y").alias("y")) for i in range(4)]))
    out = out.withColumn("_near", nearest)
    return out.withColumns({"closest_pt_x": c("_near.x"), "closest_pt_y": c("_near.y")}).drop("_near", "_w", "_cos", "_sin")


def vision_range(df: DataFrame, ref: tuple[float, float, float] = (2.0, 0.0, 1.0)) -> DataFrame:
    """Least and largest azimuth and elevation of the box's eight corners as seen from ``ref``."""
    angles = [azimuth(F.col(f"pt_{i}_x") - ref[0], F.col(f"pt_{i}_y") - ref[1]) for i in range(4)]
    whole = F.array(*angles)
    wraps = F.array_max(whole) - F.array_min(whole) > math.pi
    turned = F.transform(whole, lambda a: F.when(a >= math.pi, a - 2 * math.pi).otherwise(a))
    seen = F.when(wraps, turned).otherwise(whole)
    reach = [F.sqrt((F.col(f"pt_{i}_x") - ref[0]) ** 2 + (F.col(f"pt_{i}_y") - ref[1]) ** 2) for i in range(4)]
    rise = F.array(*[F.atan2(top - ref[2], r) for r in reach for top in (F.lit(0.0), F.col("height"))])
    return df.withColumns({"azimuth_min": F.array_min(seen), "azimuth_max": F.array_max(seen), "elevation_min": F.array_min(rise), "elevation_max": F.array_max(rise)})


def motion_state(df: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Direction and motion flags of vehicles; zeros for others."""
    deg = F.pmod(F.degrees("yaw") + 180, F.lit(360.0)) - 180
    vehicle = F.col("type") == 1
    same = deg.between(-30, 30)
    opposite = ((deg >= -180) & (deg < -150)) | (deg > 150)
    moving = F.sqrt(F.col("vx") ** 2 + F.col("vy") ** 2) >= threshold
    flag = lambda cond: F.when(vehicle & cond, 1).otherwise(0)
    return df.withColumns({"is_sameDir": flag(same), "is_oppositeDir": flag(opposite), "is_crossingDir": flag(~same & ~opposite), "is_moving": flag(moving), "is_static": flag(~moving)})


def inside(x: Column, y: Column, roi: dict | list) -> Column:
    """A region: the dict's ranges all hold; of a list of dicts, or a list of ranges, any one."""
    if isinstance(roi, list):
        return _any(inside(x, y, r) for r in roi)
    checks = []
    for name, ranges in roi.items():
        value = {"x": x, "y": y}.get(name)
        if name == "azimuth":
            ox, oy = roi.get("reference", (0.0, 0.0))
            value = F.degrees(azimuth(x - ox, y - oy))
        if value is None:
            continue
        one = lambda lo, hi, v=value, n=name: (v.between(lo, hi) | (v - 360).between(lo, hi)) if n == "azimuth" else v.between(lo, hi)
        checks.append(_any(one(*r) for r in ranges) if isinstance(ranges[0], (list, tuple)) else one(*ranges))
    out = F.lit(True)
    for check in checks:
        out = out & check
    return out


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def roi_valid(df: DataFrame, roi: dict | list) -> DataFrame:
    """1 where all four corners are inside."""
    ok = F.lit(True)
    for i in range(4):
        ok = ok & inside(F.col(f"pt_{i}_x"), F.col(f"pt_{i}_y"), roi)
    return df.withColumn("is_detectedValid", F.when(ok, 1).otherwise(0))


def track_age(df: DataFrame, keys: tuple[str, ...] = ("scenario_no", "id")) -> DataFrame:
    return df.withColumn("age", F.count("*").over(Window.partitionBy(*keys)))


def dedupe_ids(df: DataFrame, order: list[str]) -> DataFrame:
    """First row of each (frame, id)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*FRAME, "id").orderBy(*order))).filter("_rn = 1").drop("_rn")


def key_objects(df: DataFrame, lane: float = 3.5, coverage: str | None = None) -> DataFrame:
    """Nearest uncovered object before and behind in the own lane, and all in the neighbouring lanes."""
    free = F.col(coverage) < 0.1 if coverage else F.lit(True)
    ay = F.abs("y")
    own = (ay < lane / 2) & free
    zone = F.when(own & (F.col("x") > 0), "front").when(own & (F.col("x") < 0), "rear").otherwise("other")
    w = Window.partitionBy(*FRAME, "_zone").orderBy(F.abs("x"), "id")
    out = df.withColumn("_zone", zone).withColumn("_rn", F.row_number().over(w))
    first = F.col("_rn") == 1
    cipv = first & (F.col("_zone") == "front")
    near = (ay >= lane / 2) & (ay < 1.5 * lane) & free
    return out.withColumns({"is_cipv": F.when(cipv, 1).otherwise(0), "is_keyObj": F.when(cipv | (first & (F.col("_zone") == "rear")) | near, 1).otherwise(0)}).drop("_zone", "_rn")


def _union(spans: Column) -> Column:
    """Length of the union of intervals (``a``, ``b``), as a fold over them in order."""
    start = F.struct(F.lit(0.0).alias("total"), F.lit(-math.inf).alias("end"))
    step = lambda acc, s: F.struct((acc["total"] + F.greatest(F.lit(0.0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("total"), F.greatest(acc["end"], s["b"]).alias("end"))
    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["total"])


def _covered(near: Column, low: str, high: str, own: Column, turn: float = 0.0) -> Column:
    """Share of an object's interval that nearer ones cover, their intervals being turned; 1 for an empty interval."""
    width = own[high] - own[low]
    cut = F.transform(near, lambda n: F.struct(F.greatest(n[low] + turn, own[low]).alias("a"), F.least(n[high] + turn, own[high]).alias("b")))
    return F.when(width <= 0, 1.0).otherwise(_union(F.filter(cut, lambda s: s["b"] > s["a"])) / width)


def occlusion(df: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``coverage`` by nearer objects (azimuth share times elevation share) and whether it stays within the threshold.

    A frame's objects come together once, as an array with all their columns, and leave it as rows: no join back. A
    direction may be told as another turn, so nearer objects are tried a turn to either side too.
    """

    def coverage(own: Column, all_: Column) -> Column:
        near = F.filter(all_, lambda n: n["distance"] < own["distance"])
        share = F.greatest(*[_covered(near, "azimuth_min", "azimuth_max", own, t) for t in (0.0, 2 * math.pi, -2 * math.pi)])
        return F.when((share > 0) & (F.size(near) > 0), share * _covered(near, "elevation_min", "elevation_max", own)).otherwise(0.0)

    rest = [k for k in df.columns if k not in FRAME]
    frames = df.groupBy(*FRAME).agg(F.collect_list(F.struct(*rest)).alias("_all"))
    seen = frames.select(*FRAME, F.inline(F.transform("_all", lambda o: F.struct(*[o[k].alias(k) for k in rest], coverage(o, F.col("_all")).alias("coverage")))))
    return seen.select(*df.columns, "coverage").withColumn("is_coverageValid", F.when(F.col("coverage") <= threshold, 1).otherwise(0))
