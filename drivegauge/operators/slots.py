"""Parking slots: classes, regions, geometry, matching."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import assign

c = F.col


def slot_class(kind: Column) -> Column:
    return F.when(kind == 1, "vertical").when(kind == 2, "parallel").when(kind == 3, "oblique").otherwise("unknown")


def least_angle(df: DataFrame) -> Column:
    """Least interior angle of the quadrilateral, in degrees."""
    angles = []
    for i in range(4):
        a, b = (i + 3) % 4, (i + 1) % 4
        ux, uy = c(f"pt_{a}_x") - c(f"pt_{i}_x"), c(f"pt_{a}_y") - c(f"pt_{i}_y")
        vx, vy = c(f"pt_{b}_x") - c(f"pt_{i}_x"), c(f"pt_{b}_y") - c(f"pt_{i}_y")
        angles.append(F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ux * vx + uy * vy) / (F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy)))))))
    return F.least(*angles)


def truth_class(df: DataFrame, kind: str = "type") -> DataFrame:
    return df.withColumn("type_classification", F.when(least_angle(df) < 70, "oblique").when(c(kind).isin(0, 2, 3), "vertical").when(c(kind) == 1, "parallel"))


def with_center(df: DataFrame) -> DataFrame:
    mean = lambda a: sum((c(f"pt_{i}_{a}") for i in range(1, 4)), c(f"pt_0_{a}")) / 4
    return df.withColumns({"center_x": mean("x"), "center_y": mean("y")})


def with_region(df: DataFrame, regions: list[tuple[int, float, float, float, float]]) -> DataFrame:
    """Number of the first region that holds the centre, else 0."""
    chain = F.lit(0)
    for number, x0, x1, y0, y1 in reversed(regions):
        chain = F.when(c("center_x").between(x0, x1) & c("center_y").between(y0, y1), number).otherwise(chain)
    return df.withColumn("region", chain)


def geometry(df: DataFrame) -> DataFrame:
    """Distance and length of the entry edge (corners 0 and 1), slot length by its diagonals, and heading."""
    mx, my = (c("pt_0_x") + c("pt_1_x")) / 2, (c("pt_0_y") + c("pt_1_y")) / 2
    ex, ey = (c("pt_2_x") + c("pt_3_x")) / 2, (c("pt_2_y") + c("pt_3_y")) / 2
    sx0, sy0 = (c("pt_0_x") + c("pt_3_x")) / 2, (c("pt_0_y") + c("pt_3_y")) / 2
    sx1, sy1 = (c("pt_1_x") + c("pt_2_x")) / 2, (c("pt_1_y") + c("pt_2_y")) / 2
    far = lambda a, b: F.sqrt((c(f"pt_{a}_x") - c(f"pt_{b}_x")) ** 2 + (c(f"pt_{a}_y") - c(f"pt_{b}_y")) ** 2)
    lengthwise = c("type").isin(1, 3)
    ax, ay = F.when(lengthwise, ex - mx).otherwise(sx1 - sx0), F.when(lengthwise, ey - my).otherwise(sy1 - sy0)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ax / F.sqrt(ax * ax + ay * ay)))
    return df.withColumns({"in_border_distance": F.sqrt(mx * mx + my * my), "in_border_length": far(0, 1), "slot_length": (far(0, 2) + far(1, 3)) / 2, "slot_heading": F.acos(cosine)})


def pipeline(df: DataFrame, regions: list[tuple[int, float, float, float, float]], truth: bool) -> DataFrame:
    """All derived columns of slots: centre, its distance and region, class by angles (truth) or by code, geometry."""
    placed = with_region(with_center(df), regions).withColumn("slot_distance", F.sqrt(c("center_x") ** 2 + c("center_y") ** 2))
    classed = truth_class(placed) if truth else placed.withColumn("type_classification", slot_class(c("type")))
    return geometry(classed).withColumn("is_detectedValid", F.when(c("region") != 0, 1).otherwise(0))


def match_slots(gt: DataFrame, pred: DataFrame, tol: float = 0.5) -> DataFrame:
    """Least-cost pairs of slots whose centres are within ``tol`` on both axes, with the order of the truth's corners
    that lies nearest to the prediction's: ``frame_ts_us, gt_id, pred_id, order``."""
    corners = [f"pt_{i}_{a}" for i in range(4) for a in "xy"]
    turns = list(itertools.permutations(range(4)))

    def run(g: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        out = []
        right = dict(list(p.groupby("frame_ts_us"))) if len(p) else {}
        for stamp, a in g.groupby("frame_ts_us") if right and len(g) else ():
            if (b := right.get(stamp)) is None:
                continue
            dx, dy = np.abs(a.center_x.to_numpy()[:, None] - b.center_x.to_numpy()[None]), np.abs(a.center_y.to_numpy()[:, None] - b.center_y.to_numpy()[None])
            cost = np.where((dx <= tol) & (dy <= tol), np.hypot(dx, dy), 500.0)
            ga, pa = a[corners].to_numpy().reshape(-1, 4, 2), b[corners].to_numpy().reshape(-1, 4, 2)
            for i, j in assign(cost):
                if cost[i, j] < 100:
                    best = min(turns, key=lambda t: (round(float(np.hypot(*(ga[i][list(t)] - pa[j]).T).sum()), 9), t))  # noqa: B023
                    out.append((int(stamp), int(a.id.iloc[i]), int(b.id.iloc[j]), "".join(map(str, best))))
        return pd.DataFrame(out, columns=["frame_ts_us", "gt_id", "pred_id", "corner_order"])

    need = ["frame_ts_us", "id", "center_x", "center_y", *corners]
    g = F.floor(c("frame_ts_us") / 25_600_000).alias("_g")
    right = pred.select(*need, g).select(*[F.col(k).alias(k) for k in (*need, "_g")])  # new attributes, in case both sides stem from one table
    return gt.select(*need, g).groupBy("_g").cogroup(right.groupBy("_g")).applyInPandas(lambda x, y: run(x, y), "frame_ts_us long, gt_id long, pred_id long, corner_order string")
