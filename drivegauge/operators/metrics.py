"""Row-level errors of matched rows and their judgement against limits. All columns, no Python."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivegauge.functions.expressions import wrap_pi

c = F.col


def over(value: Column, limit: Column | float | None) -> Column:
    """Whether a value is beyond a limit; without a limit it is not."""
    return F.lit(False) if limit is None else F.coalesce(F.abs(value) > limit, F.lit(False))


def recall_precision(df: DataFrame) -> DataFrame:
    both = (c("gt_flag") == 1) & (c("pred_flag") == 1)
    return df.withColumns({"TP": F.when(both, 1).otherwise(0), "FP": F.when((c("gt_flag") == 0) & (c("pred_flag") == 1), 1).otherwise(0), "FN": F.when((c("gt_flag") == 1) & (c("pred_flag") == 0), 1).otherwise(0), "CTP": F.when(both & (c("gt_type_classification") == c("pred_type_classification")), 1).otherwise(0)})


def true_positives(df: DataFrame) -> DataFrame:
    return df.filter("gt_flag = 1 AND pred_flag = 1")


def with_error(df: DataFrame, name: str, error: Column, divisor: Column | None = None, limit: float | None = None, limit_pct: float | None = None, judge_all: bool = True) -> DataFrame:
    """``name``, its absolute value, share of the divisor, and whether it is beyond all (or any) of the given limits."""
    out = df.withColumn(name, error).withColumn(f"{name}_abs", F.abs(name))
    checks = []
    if divisor is not None:
        out = out.withColumn(f"{name}_pct", c(name) / divisor).withColumn(f"{name}_pct_abs", F.abs(f"{name}_pct"))
        checks += [over(c(f"{name}_pct"), limit_pct)] if limit_pct is not None else []
    checks += [over(c(name), limit)] if limit is not None else []
    bad = F.lit(bool(checks)) if judge_all else F.lit(False)
    for check in checks:
        bad = bad & check if judge_all else bad | check
    return out.withColumn(f"{name}_abnormal", F.when(bad, 1).otherwise(0))


def x_error(df: DataFrame, limit: float = 1.0, limit_pct: float = 0.05) -> DataFrame:
    """Near truth is measured at the centre, far truth at the closest corner. With both limits the pair that applies
    at this distance is kept and judged, the other is blanked."""
    near = F.abs("gt_x") < 50
    error = F.when(near, c("pred_x") - c("gt_x")).otherwise(c("pred_closest_pt_x") - c("gt_closest_pt_x"))
    divisor = F.when(near, F.greatest(F.lit(20.0), F.abs("gt_x"))).otherwise(F.greatest(F.lit(20.0), F.abs("gt_closest_pt_x")))
    out = with_error(df, "x_error", error, divisor)
    far = F.abs("gt_x") > limit / limit_pct
    out = out.withColumns({"x_error": F.when(~far, c("x_error")), "x_error_abs": F.when(~far, c("x_error_abs")), "x_error_pct": F.when(far, c("x_error_pct")), "x_error_pct_abs": F.when(far, c("x_error_pct_abs"))})
    return out.withColumn("x_error_abnormal", F.when(F.coalesce(c("x_error_abs") > limit, c("x_error_pct_abs") > limit_pct, F.lit(False)), 1).otherwise(0))


def y_error(df: DataFrame, limit: float = 0.5, limit_pct: float = 0.1) -> DataFrame:
    return with_error(df, "y_error", c("pred_y") - c("gt_y"), F.greatest(F.lit(10.0), F.abs("gt_y")), limit, limit_pct)


def plausible_speed(df: DataFrame) -> DataFrame:
    """Rows on which speed errors are measured."""
    return true_positives(df).filter(c("gt_vx").between(-60, 60) & c("gt_vy").between(-60, 60))


def speed_error(df: DataFrame, axis: str, limit: float = 1.0) -> DataFrame:
    out = with_error(df, f"v{axis}_error", c(f"pred_v{axis}") - c(f"gt_v{axis}"), F.greatest(F.lit(2.0), F.abs(f"gt_v{axis}")), limit)
    return out.withColumn("gt_speed", F.sqrt(c("gt_vx") ** 2 + c("gt_vy") ** 2))


def yaw_error(df: DataFrame, limit_deg: float = 5.0) -> DataFrame:
    """Wrapped error in degrees; one of more than 120 degrees counts as reversed and is measured from the turned side."""
    raw = wrap_pi(c("pred_yaw") - c("gt_yaw"))
    reverse = F.abs(raw) > 2 * math.pi / 3
    error = F.degrees(F.when(reverse, wrap_pi(raw + math.pi)).otherwise(raw))
    out = df.withColumn("is_reverse", F.when(reverse, 1).otherwise(0)).withColumn("yaw_error", error).withColumn("yaw_error_abs", F.abs("yaw_error"))
    return out.withColumn("yaw_error_abnormal", F.when(reverse | (c("yaw_error_abs") > limit_deg), 1).otherwise(0))


def size_error(df: DataFrame, side: str, limit: float = 0.5, limit_pct: float = 0.2) -> DataFrame:
    return with_error(df, f"{side}_error", c(f"pred_{side}") - c(f"gt_{side}"), F.when(c(f"gt_{side}") != 0, c(f"gt_{side}")), limit, limit_pct)


def deciding(df: DataFrame, column: str) -> Column:
    """A column's value on the side that decides: truth where there is truth."""
    return F.when(c("gt_flag") == 1, c(f"gt_{column}")).otherwise(c(f"pred_{column}"))


def by_characteristic(df: DataFrame, characteristics: dict[str, str]) -> DataFrame:
    """A row per characteristic that the deciding side has; both validity flags must hold where they exist."""
    ok = F.lit(True)
    for flag in ("is_detectedValid", "is_coverageValid"):
        if f"gt_{flag}" in df.columns:
            ok = ok & (deciding(df, flag) == 1)
    tags = F.array_compact(F.array(*[F.when(F.lit(True) if not column else deciding(df, column) == 1, F.lit(name)) for name, column in characteristics.items()]))
    return df.filter(ok).withColumn("characteristic", F.explode(tags))


# lines


def line_heading_error(df: DataFrame, at: str, limit: float = 3.0) -> DataFrame:
    return with_error(df, f"heading_{at}_error", F.abs(c(f"pred_heading_{at}") - c(f"gt_heading_{at}")), None, limit, judge_all=False)


def lateral_error(df: DataFrame, bands: tuple[tuple[int, int], ...] = ((0, 30), (30, 60), (60, 120)), least: int = 3) -> DataFrame:
    """Mean lateral offset of prediction points from the truth polyline, per distance band with enough points.

    What is used more than once is bound to a lambda's variable: the truth is sorted once a line, a point's offset is
    computed once for all bands.
    """

    def bound(value: Column, use: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def between(q: Column, left: Column, right: Column) -> Column:
        share = F.when(right["x"] == left["x"], 0.0).otherwise((q["x"] - left["x"]) / (right["x"] - left["x"]))
        return F.abs(q["y"] - (left["y"] + share * (right["y"] - left["y"])))

    def offset(q: Column, g: Column) -> Column:
        ends = F.struct(F.element_at(F.filter(g, lambda t: t["x"] <= q["x"]), -1).alias("left"), F.element_at(F.filter(g, lambda t: t["x"] >= q["x"]), 1).alias("right"))
        return F.struct(q["x"].alias("x"), bound(ends, lambda e: between(q, e["left"], e["right"])).alias("d"))

    def inner(g: Column) -> Column:
        low, high = F.array_min(F.transform(g, lambda t: t["x"])), F.array_max(F.transform(g, lambda t: t["x"]))
        return bound(F.struct(low.alias("low"), high.alias("high")), lambda r: F.filter("pred_points", lambda q: (q["x"] >= r["low"]) & (q["x"] <= r["high"])))

    def mean(own: Column) -> Column:
        return F.when(F.size(own) >= least, F.aggregate(own, F.lit(0.0), lambda a, v: a + v["d"]) / F.size(own))

    def means(o: Column) -> Column:
        within = lambda low, high: F.filter(o, lambda v: (v["x"] >= low) & (v["x"] < high))
        return F.transform(F.array(*[within(low, high) for low, high in bands]), mean)

    offsets = bound(F.array_sort("gt_points"), lambda g: F.transform(inner(g), lambda q: offset(q, g)))
    out = df.withColumn("_lateral", bound(offsets, means))
    return out.withColumns({f"lateral_{low}_{high}": F.get("_lateral", F.lit(i)) for i, (low, high) in enumerate(bands)}).drop("_lateral")


def lateral_band(df: DataFrame, low: int, high: int, limit: float = 0.2) -> DataFrame:
    """``lateral_error`` of one band, judged by a limit."""
    name = f"lateral_{low}_{high}"
    return with_error(lateral_error(df, ((low, high),)), name, c(name), None, limit, judge_all=False)


def over_limit(df: DataFrame, name: str, errors: list[str], limit: float) -> DataFrame:
    """Mean of what a line's known errors have beyond the limit; null where none is known."""
    known = F.array_compact(F.array(*[F.when(c(e).isNotNull(), F.greatest(c(e) - limit, F.lit(0.0))) for e in errors]))
    mean = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, v: a + v) / F.size(known))
    return with_error(df, name, mean, None, 0.0, judge_all=False)


def lateral_over(df: DataFrame, limit: float = 0.2, bands: tuple[tuple[int, int], ...] = ((0, 30), (30, 60), (60, 120))) -> DataFrame:
    return over_limit(lateral_error(df, bands), "lateral_over", [f"lateral_{a}_{b}" for a, b in bands], limit)


def heading_over(df: DataFrame, limit: float = 3.0, at: tuple[str, ...] = ("0", "50")) -> DataFrame:
    for a in at:
        df = line_heading_error(df, a, limit)
    return over_limit(df, "heading_over", [f"heading_{a}_error" for a in at], limit)


# slots


def corner_errors(df: DataFrame, axis: str, limit: float = 0.3) -> DataFrame:
    deltas = F.array(*[F.abs(c(f"pred_pt_{i}_{axis}") - c(f"gt_pt_{i}_{axis}")) for i in range(4)])
    out = df.withColumn(f"corner_{axis}_max", F.array_max(deltas)).withColumn(f"corner_{axis}_mean", F.aggregate(deltas, F.lit(0.0), lambda a, v: a + v) / 4)
    return out.withColumn(f"corner_{axis}_abnormal", F.when(F.coalesce(c(f"corner_{axis}_max") > limit, F.lit(False)), 1).otherwise(0))


def slot_error(df: DataFrame, name: str, factor: float = 1.0, limit: float = 0.3) -> DataFrame:
    return with_error(df, f"{name}_error", (c(f"pred_{name}") - c(f"gt_{name}")) * factor, None, limit, judge_all=False)


def stopper_error(df: DataFrame, limit: float = 0.2) -> DataFrame:
    """Nothing to measure, and nothing wrong, where either depth is below 0.1."""
    none = F.least("gt_stopper_depth", "pred_stopper_depth") < 0.1
    return with_error(df, "stopper_error", F.when(none, 0.0).otherwise(c("pred_stopper_depth") - c("gt_stopper_depth")), None, limit, judge_all=False)


def eligible_slots(df: DataFrame) -> DataFrame:
    known = lambda s: F.coalesce(c(f"{s}_type_classification") != "unknown", F.lit(True))
    return df.filter(known("gt") & known("pred") & (c("gt_region").isNull() | (c("gt_region") != 0)))
