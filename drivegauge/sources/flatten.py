"""Nested messages to topic rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

c = F.col


def tracked_obstacles(messages: DataFrame) -> DataFrame:
    """A row per obstacle with an id: types 0 and 1 are vehicles, 2 pedestrians, the rest cyclists; shares above 1 are
    per cent."""
    o = messages.select("scenario_no", "time_stamp", "frame_id", F.explode("obstacles").alias("o")).filter("o.id != 0")
    conf = c("o.confidence")
    return o.select("scenario_no", "time_stamp", "frame_id", c("o.id").alias("id"), F.when(c("o.type").isin(0, 1), 1).when(c("o.type") == 2, 2).otherwise(18).alias("type"), F.when(conf > 1, conf / 100).otherwise(conf).alias("confidence"), c("o.x").alias("x"), c("o.y").alias("y"))


def synthetic_ids(messages: DataFrame, arrays: list[tuple[str, str]], limit: int | None = None) -> DataFrame:
    """Rows of several arrays, each cut by its count field, numbered on through all of them:
    ``frame_id * 64 % 200000 + position``. Filters come after, so a dropped row keeps its number."""
    cut = [F.slice(c(a), F.lit(1), F.least(c(n), F.size(a)) if limit is None else F.least(c(n), F.size(a), F.lit(limit))) for a, n in arrays]
    rows = messages.select("scenario_no", "time_stamp", "frame_id", F.posexplode(F.concat(*cut)).alias("pos", "o"))
    return rows.withColumn("id", (c("frame_id") * 64) % 200000 + c("pos")).drop("pos")


def remap(df: DataFrame, column: str, table: dict[int, tuple[int, int]], default: tuple[int, int] | None = None) -> DataFrame:
    """Class codes to (type, sub type); rows with an unknown code go unless there is a default."""
    known = F.create_map(*[x for k, (t, s) in table.items() for x in (F.lit(k), F.struct(F.lit(t).alias("type"), F.lit(s).alias("sub_type")))])
    found = F.element_at(known, c(column))
    if default:
        found = F.coalesce(found, F.struct(F.lit(default[0]).alias("type"), F.lit(default[1]).alias("sub_type")))
    return df.withColumn("_m", found).filter(c("_m").isNotNull()).withColumns({"type": c("_m.type"), "sub_type": c("_m.sub_type")}).drop("_m")


#: Class codes of the fused tracks and of the second vendor's objects.
FUSED = {1: (2, -1), 2: (18, -1), 3: (1, 1), 4: (1, 4), 5: (1, 4), 6: (1, 5), 7: (1, 5), 8: (1, 9), 9: (1, 3), 10: (1, 10)}
VENDOR = {1: (1, 1), 3: (2, -1), 4: (18, -1), 14: (1, 9), 27: (1, 4), 16: (1, 5)}


def cubic_lines(messages: DataFrame) -> DataFrame:
    """A row per curve of each line with an id, without empty curves."""
    lines = messages.select("scenario_no", "time_stamp", F.explode("lines").alias("l")).filter("l.id != 0")
    return lines.select("scenario_no", "time_stamp", c("l.id").alias("id"), F.explode("l.curves").alias("k")).filter("NOT (k.width = 0 AND k.t_max = 0)").select("scenario_no", "time_stamp", "id", "k.*")


def marking(kind: Column, extra: Column) -> Column:
    return F.when(kind == 2, 2).when(kind == 1, extra.bitwiseAND(F.lit(15))).otherwise(0)


def point_lines(messages: DataFrame) -> DataFrame:
    """First curve of each line with two points or more, to three places."""
    lines = messages.select("scenario_no", "time_stamp", F.explode("lines").alias("l"))
    points = F.get(c("l.curves"), F.lit(0))["points"]
    out = lines.select("scenario_no", "time_stamp", c("l.id").alias("id"), marking(c("l.type"), c("l.extra_type")).alias("marking"), points.alias("points")).filter(F.size("points") >= 2)
    return out.withColumn("points", F.transform("points", lambda p: F.struct(F.round(p["x"], 3).alias("x"), F.round(p["y"], 3).alias("y"))))


def power_code(value: Column) -> Column:
    """An enumeration's value as a bit."""
    return F.when(value > 0, F.pow(F.lit(2), value - 1)).otherwise(0).cast("int")


def named_lines(messages: DataFrame, names: list[str]) -> DataFrame:
    """Named lines become rows 0 to 5, lateral terms with the other sign; edges get type 64."""
    packed = F.array(*[F.struct(c(f"{n}.c0").alias("c0"), c(f"{n}.c1").alias("c1"), F.lit("edge" in n).alias("edge"), c(f"{n}.type").alias("type")) for n in names])
    rows = messages.select("scenario_no", "time_stamp", F.posexplode(packed).alias("id", "l"))
    return rows.select("scenario_no", "time_stamp", "id", (-c("l.c0")).alias("c0"), (-c("l.c1")).alias("c1"), F.when(c("l.edge"), 64).otherwise(c("l.type")).alias("type"))


def objects(messages: DataFrame, array: str, columns: list[str], per_cent: list[str] = ()) -> DataFrame:
    """Static or radar objects with an id."""
    rows = messages.select("scenario_no", "time_stamp", F.explode(array).alias("o")).filter("o.id != 0")
    return rows.select("scenario_no", "time_stamp", "o.id", *[(c(f"o.{k}") / 100 if k in per_cent else c(f"o.{k}")).alias(k) for k in columns])


def scalars(messages: DataFrame, columns: dict[str, str], kmh: list[str] = ()) -> DataFrame:
    """Plain projection of nested fields; speeds in km/h become m/s."""
    return messages.select("scenario_no", "time_stamp", *[(c(path) / 3.6 if name in kmh else c(path)).alias(name) for name, path in columns.items()])


def free_space(messages: DataFrame) -> DataFrame:
    """Contour points and, under id 9999, the boundary's; points at the origin go."""
    boundary = messages.select("scenario_no", "time_stamp", F.lit(9999).cast("long").alias("id"), F.explode("points").alias("p"))
    contour = messages.select("scenario_no", "time_stamp", F.explode("contours").alias("k")).select("scenario_no", "time_stamp", c("k.id").alias("id"), F.explode("k.points").alias("p"))
    return boundary.unionByName(contour).select("scenario_no", "time_stamp", "id", "p.x", "p.y").filter(c("x") + c("y") != 0)


def parking_slots(messages: DataFrame) -> DataFrame:
    """Corners, centre and whether the stopper is real."""
    rows = synthetic_ids(messages, [("slots", "n_slots")])
    mean = lambda a: F.aggregate(F.transform("o.corners", lambda p: p[a]), F.lit(0.0), lambda s, v: s + v) / F.size("o.corners")
    return rows.select("scenario_no", "time_stamp", "id", mean("x").alias("center_x"), mean("y").alias("center_y"), F.when(c("o.stopper_x") * c("o.stopper_y") != 0, 1).otherwise(0).alias("stopper_valid"))


#: Bytes of a grid that go to Python as one row, and cells that come back at once.
PIECE, CELLS_AT_ONCE = 4096, 1_000_000


def occupancy(messages: DataFrame, levels: int = 24) -> DataFrame:
    """Cells of the byte grid: class in the high four bits; filled cells with the levels that are free and their number.

    Grids are cut into pieces, whose bytes become cells by arrays; a long grid is never in Python as a whole."""
    start = F.explode(F.sequence(F.lit(0), F.length("grid") - 1, F.lit(PIECE)))
    pieces = messages.filter(F.length("grid") > 0).select("scenario_no", "time_stamp", "grid", start.alias("start")).select("scenario_no", "time_stamp", "start", F.substring("grid", c("start") + 1, F.lit(PIECE)).alias("piece"))
    schema = StructType([messages.schema["scenario_no"], messages.schema["time_stamp"], *StructType.fromDDL("cell int, b int").fields])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("piece").cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            values, start = np.frombuffer(column.buffers()[2], np.uint8), batch.column("start").to_numpy()
            for lo in range(int(ends[0]), int(ends[-1]), CELLS_AT_ONCE):
                b = values[lo : min(lo + CELLS_AT_ONCE, int(ends[-1]))]
                filled = np.flatnonzero(b >= 16)
                first, last = np.searchsorted(ends, lo, "right") - 1, np.searchsorted(ends, lo + len(b), "left")
                row = np.repeat(np.arange(first, last), np.diff(np.clip(ends[first : last + 1], lo, lo + len(b))))[filled]
                cell = (start[row] + (filled + lo - ends[row])).astype(np.int32)
                own = [batch.column(k).take(pa.array(row)) for k in ("scenario_no", "time_stamp")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(cell), pa.array(b[filled].astype(np.int32))], names=schema.names)

    rows = pieces.mapInArrow(cells, schema)
    low = c("b").bitwiseAND(15)
    free = [[0 if k <= x else 1 for k in range(levels)] for x in range(16)]
    table = F.array(*[F.array(*map(F.lit, f)) for f in free])
    return rows.select("scenario_no", "time_stamp", "cell", F.shiftright("b", 4).alias("class"), low.alias("low"), F.get(table, low).alias("free"), F.get(F.array(*[F.lit(sum(f)) for f in free]), low).alias("n_free"))


def image_info(messages: DataFrame) -> DataFrame:
    return messages.select("scenario_no", "time_stamp", F.length("data").alias("n_bytes"), F.hex(F.substring("data", 1, 100)).alias("head"))


def collapse_runs(array: Column) -> Column:
    """An array without values equal to the one before."""
    return F.filter(array, lambda x, i: (i == 0) | (F.get(array, i - 1) != x))


def to_json(messages: DataFrame, private: str = "_") -> DataFrame:
    kept = [k for k in messages.columns if not k.startswith(private)]
    return messages.select("scenario_no", "time_stamp", F.to_json(F.struct(*kept)).alias("message"))


#: Where a position type lies along and across the box, in halves; headings of a pedestrian's categories.
ALONG, ACROSS = {0: 0, 1: -1, 2: -1, 3: -1, 4: 1, 5: 1, 6: 1, 7: 0, 8: 0, 9: 0}, {0: 0, 1: 1, 2: 0, 3: -1, 4: 1, 5: 0, 6: -1, 7: 1, 8: -1, 9: 0}
PEDESTRIAN_YAW = {0: math.pi, 1: 0.0, 2: math.pi / 2, 3: math.pi / 4, 4: math.pi * 3 / 4, 5: -math.pi / 2, 6: -math.pi * 3 / 4, 7: -math.pi / 4}
DETECTION_SUB_TYPES = {0: 1, 1: 4, 2: 5, 3: 9}


def _known(table: dict, key: Column, otherwise: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key), otherwise)


def placed_obstacles(messages: DataFrame) -> DataFrame:
    """``tracked_obstacles`` with the box: a place told for an edge or corner (``position_type``) is moved to the centre, and
    a pedestrian's heading is that of the first category (``property``, ``kind``, ``conf``) of kind 0 with a confidence."""
    o = messages.select("scenario_no", "time_stamp", "frame_id", F.explode("obstacles").alias("o")).filter("o.id != 0")
    told = F.get(F.filter("o.categories", lambda k: (k["conf"] != 0) & (k["kind"] == 0)), F.lit(0))["property"]
    kind = F.when(c("o.type").isin(0, 1), 1).when(c("o.type") == 2, 2).otherwise(18)
    o = o.withColumn("yaw", F.when(c("o.type") == 2, _known(PEDESTRIAN_YAW, told, c("o.yaw"))).otherwise(c("o.yaw")))
    o = o.withColumns({"_a": _known(ALONG, c("o.position_type"), F.lit(-1)) / 2 * c("o.length"), "_b": _known(ACROSS, c("o.position_type"), F.lit(-1)) / 2 * c("o.width")})
    x = c("o.x") - c("_a") * F.cos("yaw") + c("_b") * F.sin("yaw")
    y = c("o.y") - c("_a") * F.sin("yaw") - c("_b") * F.cos("yaw")
    conf = c("o.confidence")
    return o.select("scenario_no", "time_stamp", "frame_id", c("o.id").alias("id"), kind.alias("type"), F.when(conf > 1, conf / 100).otherwise(conf).alias("confidence"), x.alias("x"), y.alias("y"), "yaw", c("o.length").alias("length"), c("o.width").alias("width"))


def image_detections(messages: DataFrame, arrays: list[tuple[str, str]], limit: int = 32) -> DataFrame:
    """Detections in the image, at most ``limit`` of each array, without those whose centre has a zero; a dropped one keeps its
    number. Sub types in the common code."""
    rows = synthetic_ids(messages, arrays, limit).filter((c("o.center_x") != 0) & (c("o.center_y") != 0))
    return rows.select("scenario_no", "time_stamp", "frame_id", "id", c("o.center_x").alias("center_x"), c("o.center_y").alias("center_y"), _known(DETECTION_SUB_TYPES, c("o.sub_type"), F.lit(-1)).alias("sub_type"))


def vendor_lines(messages: DataFrame) -> DataFrame:
    """The second vendor's lines with id and confidence: points without those at the origin, lane types without repeats."""
    rows = messages.select("scenario_no", "time_stamp", F.explode("lines").alias("l")).filter("l.id != 0 AND l.confidence != 0")
    points = F.filter("l.points", lambda p: (p["x"] != 0) | (p["y"] != 0))
    return rows.select("scenario_no", "time_stamp", c("l.id").alias("id"), points.alias("points"), collapse_runs(c("l.types")).alias("types"))
