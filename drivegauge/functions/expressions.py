"""Column expressions shared by the operators; all run inside whole-stage code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PI = math.pi


def r6(c: Column) -> Column:
    """Rounded to six places, without negative zero."""
    return F.round(c, 6) + F.lit(0.0)


def between_open(c: Column, low: float, high: float) -> Column:
    """low <= c < high."""
    return (c >= low) & (c < high)


def wrap_pi(angle: Column) -> Column:
    """An angle brought to [-pi, pi)."""
    return F.pmod(angle + PI, F.lit(2 * PI)) - PI


def azimuth(x: Column, y: Column) -> Column:
    """Angle in [0, 2 pi)."""
    a = F.atan2(y, x)
    return F.when(a < 0, a + 2 * PI).otherwise(a)


def elevation(x: Column, y: Column, z: Column) -> Column:
    return F.atan2(z, F.sqrt(x * x + y * y))


def stable_id(*parts: Column) -> Column:
    """First eight hex digits of the SHA-256 of the parts joined by dashes."""
    return F.substring(F.sha2(F.concat_ws("-", *parts), 256), 1, 8)


def content_checksum(data: Column) -> Column:
    return F.md5(data)


def frame_index(stamp: Column, start: Column, fps: Column) -> Column:
    """Nearest frame number, halves to even."""
    return F.bround((stamp - start) * fps).cast("long")


def camera_fov(width: Column, focal: Column) -> Column:
    """Horizontal field of view in radians."""
    return 2 * F.atan(width / 2 / focal)


def fov_range(fov: Column, yaw: Column) -> tuple[Column, Column]:
    """Left and right limit in degrees; left within [0, 360), right negative where the range wraps."""
    low = F.pmod(F.degrees(yaw - fov / 2), F.lit(360.0))
    high = F.pmod(F.degrees(yaw + fov / 2), F.lit(360.0))
    return F.when(low > high, low - 360).otherwise(low), high


def saturating_cast(value: Column, kind: str) -> Column:
    """Text to bool, float or an integer of fixed width, clamped; unreadable text gives the kind's default."""
    text = F.lower(F.trim(value))
    if kind == "bool":
        return F.coalesce(text.isin("true", "1", "yes", "y"), F.lit(False))
    number = text.try_cast("double")
    if kind.startswith("float"):
        return F.coalesce(number, F.lit(0.0))
    if kind == "string":
        return F.coalesce(value, F.lit(""))
    bits = int(kind.lstrip("uint"))
    low, high = (0, 2**bits - 1) if kind.startswith("u") else (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)
    return F.coalesce(F.least(F.greatest(number, F.lit(float(low))), F.lit(float(high))).cast("long"), F.lit(0).cast("long"))


def signal_value(expression: str) -> Column:
    """A mapping cell: ``/`` is absent, a number is constant, a name is a signal, else ``name op constant``."""
    text = expression.strip()
    if text in ("", "/"):
        return F.lit(None).cast("double")
    parts = text.split()
    if len(parts) == 3 and parts[1] in "+-*/":
        left, right = F.col(parts[0]).cast("double"), F.lit(float(parts[2]))
        return {"+": left + right, "-": left - right, "*": left * right, "/": left / right}[parts[1]]
    try:
        return F.lit(float(text))
    except ValueError:
        return F.col(text).cast("double")


def remap_path(path: Column, old: str, new: str) -> Column:
    """Replaces a path's prefix; other paths stay."""
    return F.when(path.startswith(old), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 30))).otherwise(path)


WIDE = "[\\u2e80-\\u9fff\\uac00-\\ud7a3\\uf900-\\ufaff\\uff00-\\uff60]"


def display_width(text: Column) -> Column:
    """Characters, wide ones counted twice."""
    return F.length(text) + F.length(text) - F.length(F.regexp_replace(text, WIDE, ""))


def has_cjk(text: Column) -> Column:
    return text.rlike("[\\u4e00-\\u9fff]")


def camel_to_snake(name: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(name, "([A-Z]+)([A-Z][a-z])", "$1_$2"), "([a-z0-9])([A-Z])", "$1_$2"))


def wrap_lines(text: Column, width: int) -> Column:
    """Pieces of at most ``width`` characters joined by newlines."""
    return F.regexp_replace(text, f"(.{{{width}}})(?=.)", "$1\n")


def pixel_to_ego(u: Column, v: Column, variant: str = "model") -> tuple[Column, Column]:
    """Bird-view pixel to metres before and left of the car; the two marks for "no point" give the origin."""
    height, width, scale, arc, rear = (704, 800, 0.03, 47.19, 0.0) if variant == "model" else (1088, 1216, 0.02, 0.0, 1.39698315)
    none = ((u == -1) & (v == -1)) | ((u == 0) & (v == 0))
    x, y = (width / 2 + arc - v) * scale + rear, (height / 2 - u) * scale
    return F.when(none, 0.0).otherwise(x), F.when(none, 0.0).otherwise(y)


def day_part(scenario_id: Column) -> Column:
    """Light at the start of a clip named ``yyyyMMdd_HHmmss...nnn``, clips being 300 s long. Sunrise and sunset move
    linearly over the two halves of the year; half an hour around them is dawn and dusk."""
    part = lambda a, n: F.substring(F.split_part(scenario_id, F.lit("_"), F.lit(2)), a, n).try_cast("int")
    clip = F.substring(scenario_id, -3, 3).try_cast("int")
    at = part(1, 2) * 3600 + part(3, 2) * 60 + part(5, 2) + 300 * (clip - 1)
    day = F.dayofyear(F.try_to_date(F.split_part(scenario_id, F.lit("_"), F.lit(1)), "yyyyMMdd"))
    rise = F.when(day <= 183, (638 - day) / 91).otherwise((day + 272) / 91) * 3600
    down = F.when(day <= 183, (day + 1546) / 91).otherwise((1912 - day) / 91) * 3600
    known = at.isNotNull() & day.isNotNull()
    return F.when(known & at.between(rise - 1800, rise + 1800), "dawn").when(known & at.between(down - 1800, down + 1800), "dusk").when(known & (at > rise) & (at <= 43200), "morning").when(known & (at > 43200) & (at < down), "afternoon").when(known, "night")
