"""Pixels of points in space: pinhole, fisheye and omnidirectional cameras with distortion.

A camera is a row: ``model`` ("pinhole", "fisheye" or "omni"), ``width``, ``height``, ``intrinsic`` (3 x 3, by rows),
``extrinsic`` (4 x 4 or 3 x 4, by rows, world to camera), ``distort`` (coefficients in the usual order, missing ones
being 0) and ``xi`` (the mirror's parameter, omni only). All of it is arithmetic on columns, so points and cameras meet
in an ordinary join and the projection stays inside generated code.

With a = X / Z, b = Y / Z (omni: X and Y of the unit vector over its z + xi) and r^2 = a^2 + b^2:

* pinhole, ``k1 k2 p1 p2 k3 k4 k5 k6``: (1 + k1 r^2 + k2 r^4 + k3 r^6) / (1 + k4 r^2 + k5 r^4 + k6 r^6), then tangential terms;
* fisheye, ``k1 k2 k3 k4``: t = atan r, scaled to t (1 + k1 t^2 + k2 t^4 + k3 t^6 + k4 t^8) / r;
* omni, ``k1 k2 p1 p2``: 1 + k1 r^2 + k2 r^4, then tangential terms; the intrinsic's skew counts.

Points that the model cannot see have no pixel: behind the lens (pinhole, fisheye), or beyond the mirror (omni). A model
of another name sees nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(points: DataFrame, cameras: DataFrame, key: str, x: str = "x", y: str = "y", z: str = "z", margin: int = 20) -> DataFrame:
    """``points`` with ``u``, ``v`` (whole pixels, halves to even) in the camera of their ``key``; those nearer to the
    image's edge than ``margin`` pixels, or without camera, go. Spark chooses the join by the cameras' measured size.

    A point is an array of one element that each step maps or drops, and the last one leaves as a row: no step's
    arithmetic is repeated in the next, and no filter is moved in front of what it tests.
    """
    c = F.struct("model", "width", "height", "intrinsic", "extrinsic", "distort", "xi").alias("_camera")
    joined = points.join(cameras.select(key, c), key)
    part = lambda name: F.col("_camera").getField(name)
    at = lambda name, i: F.coalesce(F.get(part(name), F.lit(i)), F.lit(0.0))
    k = lambda i: at("distort", i)
    pinhole, fisheye, omni = (part("model") == m for m in ("pinhole", "fisheye", "omni"))
    row = lambda i: at("extrinsic", 4 * i) * F.col(x) + at("extrinsic", 4 * i + 1) * F.col(y) + at("extrinsic", 4 * i + 2) * F.col(z) + at("extrinsic", 4 * i + 3)
    p1, p2 = F.when(fisheye, 0.0).otherwise(k(2)), F.when(fisheye, 0.0).otherwise(k(3))
    skew = F.when(omni, at("intrinsic", 1)).otherwise(0.0)

    def depth(p: Column) -> Column:
        return F.when(omni, p["z"] + F.coalesce(part("xi"), F.lit(0.0)) * F.sqrt(p["x"] * p["x"] + p["y"] * p["y"] + p["z"] * p["z"])).when(pinhole | fisheye, p["z"])

    def bend(p: Column) -> Column:
        r2, t = p["r2"], p["t"]
        t2 = t * t
        lens = F.try_divide(1 + r2 * (k(0) + r2 * (k(1) + r2 * k(4))), 1 + r2 * (k(5) + r2 * (k(6) + r2 * k(7))))
        turned = t * (1 + t2 * (k(0) + t2 * (k(1) + t2 * (k(2) + t2 * k(3)))))
        return F.when(pinhole, lens).when(omni, 1 + r2 * (k(0) + r2 * k(1))).when(r2 < 1e-24, 1.0).otherwise(F.try_divide(turned, F.sqrt(r2)))

    steps = [
        lambda p: {"x": p["x"], "y": p["y"], "z": p["z"], "depth": depth(p)},
        lambda p: p["depth"] > 0,
        lambda p: {"a": p["x"] / p["depth"], "b": p["y"] / p["depth"]},
        lambda p: {"a": p["a"], "b": p["b"], "r2": p["a"] * p["a"] + p["b"] * p["b"]},
        lambda p: {"a": p["a"], "b": p["b"], "r2": p["r2"], "t": F.atan(F.sqrt(p["r2"]))},
        lambda p: {"a": p["a"], "b": p["b"], "r2": p["r2"], "g": bend(p)},
        lambda p: {"a": p["a"] * p["g"] + 2 * p1 * p["a"] * p["b"] + p2 * (p["r2"] + 2 * p["a"] * p["a"]), "b": p["b"] * p["g"] + p1 * (p["r2"] + 2 * p["b"] * p["b"]) + 2 * p2 * p["a"] * p["b"]},
        lambda p: {"u": F.bround(at("intrinsic", 0) * p["a"] + skew * p["b"] + at("intrinsic", 2)), "v": F.bround(at("intrinsic", 4) * p["b"] + at("intrinsic", 5))},
        lambda p: (p["u"] > margin) & (p["u"] < part("width") - margin) & (p["v"] > margin) & (p["v"] < part("height") - margin),
        lambda p: {"u": p["u"].cast("long"), "v": p["v"].cast("long")},
    ]
    place = F.array(F.struct(row(0).alias("x"), row(1).alias("y"), row(2).alias("z")))
    fields = lambda step: lambda p: F.struct(*[v.alias(n) for n, v in step(p).items()])
    for i, step in enumerate(steps):
        place = F.filter(place, step) if i in (1, len(steps) - 2) else F.transform(place, fields(step))
    return joined.select(*points.columns, F.inline(place))
