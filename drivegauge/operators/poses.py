"""Pose algebra and label geometry in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pose_matrix(roll: Column, pitch: Column, yaw: Column, x: Column, y: Column, z: Column) -> Column:
    """Row-major 4x4 matrix of a rotation about z, then y, then x (Rz Ry Rx) and a translation."""
    cr, sr, cp, sp, cy, sy = F.cos(roll), F.sin(roll), F.cos(pitch), F.sin(pitch), F.cos(yaw), F.sin(yaw)
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(
        cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr, x,
        sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr, y,
        -sp, cp * sr, cp * cr, z, zero, zero, zero, one,
    )


def inverse_pose(m: Column) -> Column:
    """Inverse of a rigid pose: the transposed rotation and the translation turned back."""
    at = lambda r, k: F.get(m, F.lit(4 * r + k))
    moved = [-(at(0, r) * at(0, 3) + at(1, r) * at(1, 3) + at(2, r) * at(2, 3)) for r in range(3)]
    rows = [v for r in range(3) for v in (at(0, r), at(1, r), at(2, r), moved[r])]
    return F.array(*rows, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def euler(m: Column) -> tuple[Column, Column, Column]:
    """Roll, pitch and yaw of a pose matrix."""
    at = lambda r, k: F.get(m, F.lit(4 * r + k))
    return F.atan2(at(2, 1), at(2, 2)), F.asin(-at(2, 0)), F.atan2(at(1, 0), at(0, 0))


def apply_pose(m: Column, x: Column, y: Column, z: Column) -> list[Column]:
    at = lambda r, k: F.get(m, F.lit(4 * r + k))
    return [at(r, 0) * x + at(r, 1) * y + at(r, 2) * z + at(r, 3) for r in range(3)]


def label_geometry(side: str) -> Column:
    """Arrow from the centre along the speed, the box's corners and the label's place above it, of one side's row."""
    c = lambda k: F.col(f"{side}_{k}")
    corner = lambda a, b: F.struct((c("x") + c("length") * a / 2 * F.cos(c("yaw")) - c("width") * b / 2 * F.sin(c("yaw"))).alias("x"), (c("y") + c("length") * a / 2 * F.sin(c("yaw")) + c("width") * b / 2 * F.cos(c("yaw"))).alias("y"))
    return F.struct(
        F.array(*[corner(a, b) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))]).alias("corners"),
        F.struct((c("x") + c("vx")).alias("x"), (c("y") + c("vy")).alias("y")).alias("arrow"),
        F.struct(c("x").alias("x"), c("y").alias("y"), (c("height") + 0.5).alias("z")).alias("label"),
    )
