"""Evaluator drivers: metrics chosen by name from a configuration, all in one pass, as one long table."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import metrics as me

c = F.col
#: Name of a metric -> what adds its columns, then the columns of its value, share and judgement.
Metric = tuple[Callable[..., DataFrame], str, str | None, str]


def _metric(add: Callable[..., DataFrame], value: str, share: bool = True, stem: str | None = None) -> Metric:
    return add, value, f"{value}_pct" if share else None, f"{stem or value}_abnormal"


OBSTACLES: dict[str, Metric] = {
    "x_error": _metric(me.x_error, "x_error"),
    "y_error": _metric(me.y_error, "y_error"),
    **{f"v{a}_error": _metric(partial(me.speed_error, axis=a), f"v{a}_error") for a in "xy"},
    "yaw_error": _metric(me.yaw_error, "yaw_error", False),
    **{f"{s}_error": _metric(partial(me.size_error, side=s), f"{s}_error") for s in ("length", "width", "height")},
}
SLOTS: dict[str, Metric] = {
    **{f"corner_{a}_error": _metric(partial(me.corner_errors, axis=a), f"corner_{a}_max", False, f"corner_{a}") for a in "xy"},
    **{f"{k}_error": _metric(partial(me.slot_error, name=k), f"{k}_error", False) for k in ("in_border_distance", "in_border_length", "slot_length")},
    "slot_heading_error": _metric(partial(me.slot_error, name="slot_heading", factor=57.3, limit=5.0), "slot_heading_error", False),
    "stopper_error": _metric(me.stopper_error, "stopper_error", False),
}
LINES: dict[str, Metric] = {
    **{f"lateral_{a}_{b}": _metric(partial(me.lateral_band, low=a, high=b), f"lateral_{a}_{b}", False) for a, b in ((0, 30), (30, 60), (60, 120))},
    "lateral_over": _metric(me.lateral_over, "lateral_over", False),
    **{f"heading_{at}_error": _metric(partial(me.line_heading_error, at=at), f"heading_{at}_error", False) for at in ("0", "50")},
    "heading_over": _metric(me.heading_over, "heading_over", False),
}


def known_lines(df: DataFrame) -> DataFrame:
    """Lines whose deciding side has a class and a radius."""
    return df.filter(me.deciding(df, "type_classification").isNotNull() & me.deciding(df, "radius").isNotNull())


#: Kind of object -> its metrics and the rows that take part.
KINDS: dict[str, tuple[dict[str, Metric], Callable[[DataFrame], DataFrame]]] = {"obstacles": (OBSTACLES, lambda df: df), "slots": (SLOTS, me.eligible_slots), "lines": (LINES, known_lines)}


def evaluate(df: DataFrame, kind: str, keys: list[str], names: list[str] | None = None, limits: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """``keys, metric, outcome, value, share, abnormal``: a row per matched row and metric.

    ``recall_precision`` takes every eligible row and tells its outcome (TP, FP or FN), abnormal being a pair of unequal
    classes; errors take the pairs only, speeds those of plausible speed. ``limits`` are a metric's own arguments by its
    name. Unknown names are an error. Every metric's columns come from the same row, so nothing is joined or shuffled.
    """
    known, eligible = KINDS[kind]
    names = ["recall_precision", *known] if names is None else names
    if unknown := set(names) - set(known) - {"recall_precision"}:
        raise ValueError(f"no such metric of {kind}: {', '.join(sorted(unknown))}")
    out = me.recall_precision(eligible(df))
    pair = c("TP") == 1
    slow = pair & c("gt_vx").between(-60, 60) & c("gt_vy").between(-60, 60) if {"gt_vx", "gt_vy"} <= set(df.columns) else pair
    rows: list[Column] = []

    def row(name: str, when: Column, outcome: Column, value: Column, share: Column, abnormal: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("metric"), outcome.cast("string").alias("outcome"), value.cast("double").alias("value"), share.cast("double").alias("share"), abnormal.cast("int").alias("abnormal")))

    for name in names:
        if name == "recall_precision":
            outcome = F.when(pair, "TP").when(c("FP") == 1, "FP").when(c("FN") == 1, "FN")
            rows.append(row(name, outcome.isNotNull(), outcome, F.lit(None), F.lit(None), F.when(pair, 1 - c("CTP")).otherwise(1)))
            continue
        add, value, share, abnormal = known[name]
        out = add(out, **(limits or {}).get(name, {}))
        rows.append(row(name, slow if name in ("vx_error", "vy_error") else pair, F.lit(None), c(value), c(share) if share else F.lit(None), c(abnormal)))
    return out.select(*keys, F.explode(F.array_compact(F.array(*rows))).alias("_m")).select(*keys, "_m.*")
