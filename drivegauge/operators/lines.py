"""Lane lines: classes, polynomial features, joining of pieces, lane positions, track ids, matching by overlap."""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .matching import assign


def line_class(kind: Column, position: Column) -> Column:
    return F.when(kind == 2, "fence").when((kind == 1) & position.isin(1, 8), "main_lane").when((kind == 1) & position.isin(2, 3, 9, 10), "secondary_lane")


@functools.lru_cache(maxsize=64)
def smoothing(n: int, window: int = 15, order: int = 3) -> np.ndarray:
    """Matrix of local least-squares polynomials over an odd window (Savitzky-Golay); the ends take the outermost fits."""
    window = min(window, n if n % 2 else n - 1)
    if window <= order:
        return np.eye(n)
    half = window // 2
    powers = np.vander(np.arange(-half, half + 1), order + 1, increasing=True)
    fits = powers @ np.linalg.pinv(powers)  # row i: the fit's value at the window's place i
    out = np.zeros((n, n))
    for i in range(n):
        first = min(max(i - half, 0), n - window)
        out[i, first : first + window] = fits[i - first]
    return out


def spline(t: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cubic splines (not-a-knot) through the rows of (t, y), at the rows of ``at``; four points a row at least."""
    h = np.diff(t, axis=1)
    r = 6 * np.diff(np.diff(y, axis=1) / h, axis=1)
    low, mid, up = h[:, :-1].copy(), 2 * (h[:, :-1] + h[:, 1:]), h[:, 1:].copy()
    mid[:, 0] += h[:, 0] + h[:, 0] ** 2 / h[:, 1]
    up[:, 0] -= h[:, 0] ** 2 / h[:, 1]
    mid[:, -1] += h[:, -1] + h[:, -1] ** 2 / h[:, -2]
    low[:, -1] -= h[:, -1] ** 2 / h[:, -2]
    inner = mid.shape[1]
    for i in range(1, inner):  # elimination, all rows in step
        w = low[:, i] / mid[:, i - 1]
        mid[:, i] -= w * up[:, i - 1]
        r[:, i] -= w * r[:, i - 1]
    m = np.zeros_like(y)
    m[:, inner] = r[:, -1] / mid[:, -1]
    for i in range(inner - 2, -1, -1):
        m[:, i + 1] = (r[:, i] - up[:, i] * m[:, i + 2]) / mid[:, i]
    m[:, 0] = m[:, 1] - h[:, 0] / h[:, 1] * (m[:, 2] - m[:, 1])
    m[:, -1] = m[:, -2] + h[:, -1] / h[:, -2] * (m[:, -2] - m[:, -3])
    k = np.clip((t[:, None, :] <= at[:, :, None]).sum(axis=2) - 1, 0, t.shape[1] - 2)
    pick = lambda v, j: np.take_along_axis(v, j, axis=1)
    u, w, g = at - pick(t, k), pick(t, k + 1) - at, pick(h, k)
    return (pick(m, k) * w**3 + pick(m, k + 1) * u**3) / (6 * g) + (pick(y, k) / g - pick(m, k) * g / 6) * w + (pick(y, k + 1) / g - pick(m, k + 1) * g / 6) * u


def curvature_radius(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """1 / |curvature| along each row's line, resampled by chord length and smoothed; infinite where straight."""
    t = np.pad(np.cumsum(np.hypot(np.diff(x, axis=1), np.diff(y, axis=1)), axis=1), ((0, 0), (1, 0)))
    n = max(2 * x.shape[1], 50)
    at = t[:, -1:] * np.linspace(0, 1, n)
    smooth = smoothing(n).T
    step = t[:, -1:] / (n - 1)
    slope = lambda v: np.gradient(v, axis=1) / step
    dx, dy = slope(spline(t, x, at) @ smooth), slope(spline(t, y, at) @ smooth)
    k = np.abs(dx * slope(dy) - dy * slope(dx)) / np.maximum((dx * dx + dy * dy) ** 1.5, 1e-6)
    with np.errstate(divide="ignore"):
        return np.where(k > 0, 1 / k, np.inf)


def cubic_fits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least-squares c0 to c3 of each row, of a lower degree where a row has fewer than four places."""
    mid, half = (x.max(axis=1) + x.min(axis=1)) / 2, (x.max(axis=1) - x.min(axis=1)) / 2
    half = np.where(half > 0, half, 1.0)
    u = (x - mid[:, None]) / half[:, None]
    places = 1 + (np.diff(np.sort(x, axis=1), axis=1) > 0).sum(axis=1)
    a = np.zeros((len(x), 4))
    for degree in range(4):
        use = np.minimum(places, 4) == degree + 1
        if use.any():
            v = u[use][:, :, None] ** np.arange(degree + 1)
            vt = v.transpose(0, 2, 1)
            a[use, : degree + 1] = np.linalg.solve(vt @ v, vt @ y[use][:, :, None])[:, :, 0]
    a /= half[:, None] ** np.arange(4)  # powers of (x - mid); then of x
    a0, a1, a2, a3 = a.T
    return np.column_stack([a0 - a1 * mid + a2 * mid**2 - a3 * mid**3, a1 - 2 * a2 * mid + 3 * a3 * mid**2, a2 - 3 * a3 * mid, a3])


NODES, WEIGHTS = np.polynomial.legendre.leggauss(16)


def arc_lengths(c: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Length of each row's cubic between two places."""
    mid, half = (high + low)[:, None] / 2, (high - low)[:, None] / 2
    x = mid + half * NODES
    slope = c[:, 1:2] + x * (2 * c[:, 2:3] + x * 3 * c[:, 3:4])
    return (half * WEIGHTS * np.sqrt(1 + slope**2)).sum(axis=1)


FEATURES = ["c0", "c1", "c2", "c3", "heading_0", "heading_50", "length", "radius"]


def by_count(counts: np.ndarray):
    """Rows of equal numbers of points, in chunks of bounded size: ``(number, rows, the places of their points)``."""
    starts = np.cumsum(counts) - counts
    for n in np.unique(counts[counts > 0]).tolist():
        own = np.flatnonzero(counts == n)
        size = max(1, 4_000_000 // (n * max(2 * n, 50)))
        for part in (own[i : i + size] for i in range(0, len(own), size)):
            yield n, part, starts[part][:, None] + np.arange(n)


def features(x: np.ndarray, y: np.ndarray, counts: np.ndarray, radii: bool = True) -> np.ndarray:
    """``FEATURES`` of lines whose points follow each other in ``x`` and ``y``; NaN where a line has none.

    Cubic over 0 to 80 m, headings at 5 m (if it begins by 8 m) and 50 m (if it reaches from 48 to 52 m), arc length of the
    cubic over the whole line, and the median radius over 0 to 80 m, 9999 at most, if the cubic there is longer than 10 m.
    """
    out = np.full((len(counts), len(FEATURES)), np.nan)
    line = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((x, line))
    x, y = x[order], y[order]
    for _, rows, at in by_count(counts):
        out[rows, 6] = arc_lengths(cubic_fits(x[at], y[at]), x[at[:, 0]], x[at[:, -1]])
    near = (x >= 0) & (x <= 80)
    x, y, counts = x[near], y[near], np.bincount(line[near], minlength=len(counts))
    for n, rows, at in by_count(counts):
        if n < 3:
            continue
        px, py = x[at], y[at]
        c = cubic_fits(px, py)
        first, last = px[:, 0], px[:, -1]
        out[rows, :4] = c
        out[rows, 4] = np.where(first <= 8, np.degrees(np.arctan(25 * c[:, 3] + 5 * c[:, 2] + c[:, 1])), np.nan)
        out[rows, 5] = np.where((first <= 48) & (last >= 52), np.degrees(np.arctan(7500 * c[:, 3] + 100 * c[:, 2] + c[:, 1])), np.nan)
        if radii and n >= 5:
            use = (arc_lengths(c, first, last) > 10) & ((np.diff(px, axis=1) != 0) | (np.diff(py, axis=1) != 0)).all(axis=1)
            if use.any():
                out[rows[use], 7] = np.minimum(9999, np.rint(np.median(curvature_radius(px[use], py[use]), axis=1)))
    return out


def line_features(df: DataFrame, keys: list[str], radii: bool = True, with_heads: bool = False) -> DataFrame:
    """``keys`` and the features of ``points`` (array of x, y structs) of each line, computed for all lines of a batch at
    once. Points without x or y are not used; a line without points has no feature; a line with a repeated point has no
    radius. Without ``radii`` the last column is null. ``with_heads`` adds what ``heads`` gives."""
    names = [*FEATURES, *(HEADS if with_heads else [])]
    schema = StructType([df.schema[k] for k in keys] + [StructField(n, DoubleType()) for n in names])

    def run(batches):
        for batch in batches:
            line, x, y = flat_points(batch.column(len(keys)))
            given = ~(np.isnan(x) | np.isnan(y))
            counts = np.bincount(line[given], minlength=batch.num_rows)
            found = features(x[given], y[given], counts, radii)
            columns = [pa.array(c, pa.float64(), mask=np.isnan(c)) for c in found.T]
            columns += head_means(line, x, y, batch.num_rows) if with_heads else []
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *columns], names=[*keys, *names])

    points = F.transform("points", lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    return df.select(*keys, points.alias("points")).mapInArrow(run, schema)


def flat_points(points: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line number, x and y of the points of a column of lines; NaN where a point has none."""
    sizes = pc.fill_null(pc.list_value_length(points), 0).to_numpy(zero_copy_only=False)
    flat = points.flatten()
    x, y = (pc.struct_field(flat, n).to_numpy(zero_copy_only=False).astype(float) for n in ("x", "y"))
    return np.repeat(np.arange(len(sizes)), sizes), x, y


def column(table: pa.Table, name: str) -> pa.Array:
    """A group's column as one array."""
    chunks = table.column(name).combine_chunks()
    return pa.concat_arrays(chunks.chunks) if isinstance(chunks, pa.ChunkedArray) else chunks


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of all spans of a start and a length, one span after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def linked(first: list[tuple[float, float]], last: list[tuple[float, float]], reach: float) -> list[list[int]]:
    """Pieces by their first and last points, joined while one begins within ``reach`` of another's end: lists of places."""
    out = [[i] for i in range(len(first))]
    found = True
    while found:
        found = False
        for i, p in enumerate(out):
            x, y = last[p[-1]]
            for j, q in enumerate(out):
                if i != j and math.hypot(x - first[q[0]][0], y - first[q[0]][1]) < reach:
                    out[i] = p + q
                    del out[j]
                    found = True
                    break
            if found:
                break
    return out


def chain(pieces: list[tuple[str, np.ndarray]], reach: float) -> list[tuple[str, np.ndarray]]:
    """Joins pieces (id, points by x) while one begins within ``reach`` of another's end; ids are joined by commas."""
    own = linked([tuple(p[0]) for _, p in pieces], [tuple(p[-1]) for _, p in pieces], reach)
    return [(",".join(pieces[k][0] for k in c), np.vstack([pieces[k][1] for k in c])) for c in own]


def frame_starts(*keys: np.ndarray) -> np.ndarray:
    """Where another frame begins in sorted rows, and their number at the end."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.append(np.flatnonzero(new), n)


def frame_groups(df: DataFrame, keep: tuple[str, ...] = (), frames_per_group: int = 256) -> DataFrame:
    """Lines as ``connected`` takes them; ``_g`` is a run of frames."""
    group = F.floor(F.col("frame_ts_us") / (frames_per_group * 100000)).alias("_g")
    points = F.transform("points", lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    return df.select(F.col("scenario_no").cast("long").alias("scenario_no"), F.col("frame_ts_us").cast("long").alias("frame_ts_us"), F.col("id").cast("string").alias("id"), points.alias("points"), *keep, group)


def connect_lines(df: DataFrame, reach: float = 0.1, frames_per_group: int = 256) -> DataFrame:
    """``scenario_no, frame_ts_us, id, points`` of the frame's joined lines; points ahead up to 150 m and 20 m aside."""
    return connected(frame_groups(df, frames_per_group=frames_per_group), reach)


def connected(rows: DataFrame, reach: float = 0.1, keep: tuple[str, ...] = ()) -> DataFrame:
    """``connect_lines`` of ``frame_groups``, with the first piece's ``keep``.

    All points of a group are cut and sorted at once; Python sees only the ends of lines that share a frame.
    """
    points = ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))
    schema = StructType([*(rows.schema[k] for k in ("scenario_no", "frame_ts_us", "id")), StructField("points", points), *(StructField(k, rows.schema[k].dataType) for k in keep)])

    def run(table: pa.Table) -> pa.Table:
        frame, names = column(table, "frame_ts_us").to_numpy(), column(table, "id")
        line, x, y = flat_points(column(table, "points"))
        ahead = (x >= -0.1) & (x <= 150) & (np.abs(y) <= 20)
        line, x, y = line[ahead], x[ahead], y[ahead]
        order = np.lexsort((y, x, line))
        line, x, y = line[order], x[order], y[order]
        new = np.ones(len(x), bool)
        new[1:] = (line[1:] != line[:-1]) | (x[1:] != x[:-1])
        wide = np.zeros(len(frame))
        np.maximum.at(wide, line, np.abs(y))
        line, x, y = line[new], x[new], y[new]
        counts = np.bincount(line, minlength=len(frame))
        starts = np.cumsum(counts) - counts
        rank = pc.rank(names, sort_keys="ascending", tiebreaker="dense").to_numpy()
        order = np.lexsort((rank, -wide, frame))
        order = order[counts[order] > 0]
        edges = frame_starts(frame[order])
        chains: list[list[int]] = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = order[a:b]
            if b - a == 1:
                chains.append(own.tolist())
                continue
            ends = starts[own] + counts[own] - 1
            first, last = (list(zip(x[at].tolist(), y[at].tolist(), strict=True)) for at in (starts[own], ends))
            chains += [[int(own[k]) for k in c] for c in linked(first, last, reach)]
        members = np.array([k for c in chains for k in c], dtype=np.int64)
        lead = np.array([c[0] for c in chains], dtype=np.int64)
        sizes = np.array([len(c) for c in chains], dtype=np.int64)
        at = spans(starts[members], counts[members])
        points = pa.StructArray.from_arrays([pa.array(x[at]), pa.array(y[at])], names=["x", "y"])
        total = np.add.reduceat(counts[members], np.cumsum(sizes) - sizes) if len(sizes) else sizes
        text = names.to_pylist()
        ids = [text[c[0]] if len(c) == 1 else ",".join(text[k] for k in c) for c in chains]
        return pa.table({
            "scenario_no": column(table, "scenario_no").take(pa.array(lead)), "frame_ts_us": pa.array(frame[lead]), "id": pa.array(ids, pa.string()),
            "points": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(total)), pa.int32()), points),
            **{k: column(table, k).take(pa.array(lead)) for k in keep},
        })

    return rows.groupBy("scenario_no", "_g").applyInArrow(lambda t: run(t), schema)


HEADS = ["head_x", "head_y"]


def head_means(line: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> list[pa.Array]:
    """``HEADS`` of ``n`` lines by their points (``flat_points``)."""
    order = np.lexsort((np.abs(x), line))
    counts = np.bincount(line, minlength=n)
    starts, used = np.cumsum(counts) - counts, np.minimum(counts, 3)
    sums = np.zeros((2, n))
    for k in range(3):
        own = used > k
        at = order[starts[own] + k]
        sums[0, own] += x[at]
        sums[1, own] += y[at]
    return [pa.array(v / np.maximum(used, 1), pa.float64(), mask=used == 0) for v in sums]


def heads(df: DataFrame) -> DataFrame:
    """``scenario_no, frame_ts_us, id, head_x, head_y``: the mean of a line's three points nearest to x = 0; null without."""
    schema = StructType([df.schema[k] for k in ("scenario_no", "frame_ts_us", "id")] + [StructField(k, DoubleType()) for k in HEADS])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *head_means(*flat_points(batch.column(3)), batch.num_rows)], names=schema.names)

    points = F.transform("points", lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    return df.select("scenario_no", "frame_ts_us", "id", points.alias("points")).mapInArrow(run, schema)


def lane_position(df: DataFrame, width: float = 3.5) -> DataFrame:
    """``scenario_no, frame_ts_us, id, position`` by the mean of the three points nearest to x = 0: 1, 2, ... outward on the
    left, 8, 9, ... on the right, 0 where a line begins too far ahead or aside."""
    return with_lanes(heads(df), width).select("scenario_no", "frame_ts_us", "id", "position")


def with_lanes(df: DataFrame, width: float = 3.5) -> DataFrame:
    """``position`` (``lane_position``) of lines with ``HEADS``.

    From the nearest outward each line takes the first lane after its predecessor's that it isn't beyond: the lane of the
    r-th line is r plus the largest of what its predecessors and itself are ahead of their rank.
    """
    c = F.col
    inside = (c("head_x") <= 15) & (F.abs("head_y") <= 3.5 * width)
    side = F.when(F.coalesce(inside, F.lit(False)), F.when(c("head_y") >= 0, 1).otherwise(8)).otherwise(0)
    least = sum((F.when(F.abs("head_y") >= (0.2 + lane + 1) * width, 1).otherwise(0) for lane in range(4)), F.lit(0))
    outward = Window.partitionBy("scenario_no", "frame_ts_us", "_side").orderBy(F.abs("head_y"), "id")
    near = df.withColumn("_side", side).withColumn("_r", F.when(c("_side") > 0, F.row_number().over(outward)))
    lane = c("_r") + F.max(least - c("_r")).over(outward.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return near.withColumn("position", F.when(c("_side") > 0, c("_side") + lane).otherwise(0).cast("int")).drop("_side", "_r")


def carry_ids(frames: list[list[str]], last: list[tuple[set[str], int]] | None = None, following: int = 1) -> tuple[list[list[int]], list[tuple[set[str], int]], int]:
    """Track numbers: a line keeps its number while its raw ids meet one of the frame before; else the next number."""
    last, out = last or [], []
    for ids in frames:
        now, used = [], set()
        for text in ids:
            own = set(text.split(","))
            number = next((n for raw, n in last if raw & own and n not in used), None)
            if number is None:
                number, following = following, following + 1
            used.add(number)
            now.append((own, number))
        out.append([n for _, n in now])
        last = now
    return out, last, following


def carry_track_id(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``scenario_no, frame_ts_us, origin_id, id`` and ``keep``. The carry runs through a scenario's frames, so a scenario
    (a clip of bounded length) is one group."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("frame_ts_us", "ascending"), ("origin_id", "ascending")])
        ids, edges = column(table, "origin_id").to_pylist(), frame_starts(column(table, "frame_ts_us").to_numpy()).tolist()
        numbers, _, _ = carry_ids([ids[a:b] for a, b in itertools.pairwise(edges)])
        return table.add_column(3, "id", pa.array([n for f in numbers for n in f], pa.int64()))

    rows = df.select(F.col("scenario_no").cast("long").alias("scenario_no"), F.col("frame_ts_us").cast("long").alias("frame_ts_us"), F.col("id").cast("string").alias("origin_id"), *keep)
    schema = StructType([*rows.schema.fields[:3], StructField("id", LongType()), *rows.schema.fields[3:]])
    return rows.groupBy("scenario_no").applyInArrow(lambda t: run(t), schema)


def pipeline(df: DataFrame, truth: bool, least: float = 2.0) -> DataFrame:
    """All steps over lines (scenario_no, frame_ts_us, id, type, points, and the prediction's own position), in order: age,
    one line per id and frame, joined pieces, the truth's positions and track ids, coefficients, classes, ``least`` length.

    A joined line has the type, age and position of its first piece, and the ids of all of them in ``origin_id``.

    Points are shuffled once, by runs of frames, and end in the lines' features; ages, lanes and track ids need no points.
    """
    keep = ("type", "first", *(() if truth else ("position",)))
    rows = frame_groups(df.withColumn("first", F.col("id").cast("string")), keep).repartition("scenario_no", "_g")
    same = Window.partitionBy("scenario_no", "_g", "frame_ts_us", "id").orderBy("type", F.size("points").desc())
    one = rows.withColumn("_k", F.row_number().over(same)).filter("_k = 1").drop("_k")
    found = line_features(connected(one, keep=keep), ["scenario_no", "frame_ts_us", "id", *keep], with_heads=truth)
    ages = df.groupBy(F.col("scenario_no").cast("long").alias("scenario_no"), F.col("id").cast("string").alias("first")).agg(F.count("*").alias("age"))
    found = found.join(ages, ["scenario_no", "first"])
    if truth:  # the lanes of a frame and the track ids of a scenario by one shuffle
        found = carry_track_id(with_lanes(found.repartition("scenario_no")), ("type", "age", "position", *FEATURES))
    else:
        found = found.withColumn("origin_id", F.col("id"))
    found = found.select("scenario_no", "frame_ts_us", "id", "origin_id", "type", "age", "position", *FEATURES)
    return found.withColumn("type_classification", line_class(F.col("type"), F.col("position"))).filter(F.col("length") >= least)


def segment_sums(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts))
    if counts.any():
        out[counts > 0] = np.add.reduceat(values, starts[counts > 0])
    return out


def strip_ious(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray], half: float = 1.0, step: float = 0.1) -> np.ndarray:
    """Overlap of the i-th line of ``a`` and the i-th of ``b`` (x, y, numbers of points; points by x), both widened by
    ``half`` on each side, by integration over strips in x; 0 where a line has no points."""
    ends = lambda x, n: (x[np.minimum(np.cumsum(n) - n, len(x) - 1)], x[np.cumsum(n) - 1]) if len(x) else (np.zeros(len(n)), np.zeros(len(n)))
    (a0, a1), (b0, b1) = ends(a[0], a[2]), ends(b[0], b[2])
    start, high = np.minimum(a0, b0) + step / 2, np.maximum(a1, b1)
    n = np.where((a[2] > 0) & (b[2] > 0), np.maximum(np.ceil((high - start) / step), 0), 0).astype(np.int64)
    pair, first = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
    x = start[pair] + (np.arange(len(pair)) - first[pair]) * ((start + step) - start)[pair]

    def band(line: tuple[np.ndarray, np.ndarray, np.ndarray], low: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lx, ly, counts = line
        of = np.repeat(np.arange(len(counts)), counts)
        # the strips are evenly spaced, so each point tells from which strip on it lies behind
        strip = np.ceil((lx - start[of]) / step - 1e-9).astype(np.int64)
        use = strip < n[of]
        passed = np.cumsum(np.bincount(first[of[use]] + np.maximum(strip[use], 0), minlength=len(x)))
        before = np.cumsum(np.bincount(of[use], minlength=len(n))) - np.bincount(of[use], minlength=len(n))
        k = np.clip(passed - before[pair] - 1, 0, np.maximum(counts[pair] - 2, 0)) + (np.cumsum(counts) - counts)[pair]
        after = np.minimum(k + 1, (np.cumsum(counts) - 1)[pair])
        gap = lx[after] - lx[k]
        y = ly[k] + np.where(gap > 0, (ly[after] - ly[k]) / np.where(gap > 0, gap, 1), 0) * (x - lx[k])
        y[(x < low[pair]) | (x > top[pair])] = np.nan
        slope = np.zeros_like(y)
        slope[1:-1] = (y[2:] - y[:-2]) / (2 * step)
        many = n > 1
        i, j = first[many], first[many] + n[many] - 1
        slope[i], slope[j] = (y[i + 1] - y[i]) / step, (y[j] - y[j - 1]) / step
        slope[first[n == 1]] = 0
        reach = half * np.sqrt(1 + np.nan_to_num(slope) ** 2)
        return y - reach, y + reach

    if not len(x):
        return np.zeros(len(n))
    (l0, l1), (r0, r1) = band(a, a0, a1), band(b, b0, b1)
    common = segment_sums(np.nan_to_num(np.maximum(0, np.minimum(l1, r1) - np.maximum(l0, r0))), first, n)
    total = segment_sums(np.nan_to_num(l1 - l0) + np.nan_to_num(r1 - r0), first, n) - common
    return np.where(total > 0, common / np.where(total > 0, total, 1), 0.0)


def strip_iou(p: np.ndarray, q: np.ndarray, half: float = 1.0, step: float = 0.1) -> float:
    """``strip_ious`` of one pair."""
    return float(strip_ious((p[:, 0], p[:, 1], np.array([len(p)])), (q[:, 0], q[:, 1], np.array([len(q)])), half, step)[0])


PAIRS_AT_ONCE = 64


def match_lines(gt: DataFrame, pred: DataFrame, half: float = 1.0) -> DataFrame:
    """``scenario_no, frame_ts_us, gt_id, pred_id, iou`` of the pairs of largest overlap, above 0.1."""

    def side(table: pa.Table):
        line, x, y = flat_points(column(table, "points"))
        order = np.lexsort((y, x, line))
        order = order[~(np.isnan(x) | np.isnan(y))[order]]
        counts = np.bincount(line[order], minlength=table.num_rows)
        return x[order], y[order], counts, np.cumsum(counts) - counts

    def run(g: pa.Table, p: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if g.num_rows and p.num_rows:
            (fg, tg, ig), (fp, tp, ip) = ((column(t, "frame_ts_us").to_numpy(), column(t, "type").to_numpy(zero_copy_only=False), column(t, "id").to_pylist()) for t in (g, p))
            gx, gy, gn, gs = side(g)
            px, py, pn, ps = side(p)
            og, op = np.argsort(fg, kind="stable"), np.argsort(fp, kind="stable")
            low, high = np.searchsorted(fp[op], fg[og], "left"), np.searchsorted(fp[op], fg[og], "right")
            left, right = np.repeat(og, high - low), op[spans(low, high - low)]
            overlap = np.zeros(len(left))
            for i in range(0, len(left), PAIRS_AT_ONCE):
                a, b = left[i : i + PAIRS_AT_ONCE], right[i : i + PAIRS_AT_ONCE]
                at, bt = spans(gs[a], gn[a]), spans(ps[b], pn[b])
                overlap[i : i + PAIRS_AT_ONCE] = strip_ious((gx[at], gy[at], gn[a]), (px[bt], py[bt], pn[b]), half)
            gain = np.where(tg[left] == tp[right], overlap, overlap / 1.5)
            edges = frame_starts(fg[left]).tolist()
            for i, j in itertools.pairwise(edges):
                columns = int(np.count_nonzero(left[i:j] == left[i]))
                pairs = [(0, 0)] if j - i == 1 else assign(-gain[i:j].reshape(-1, columns))
                out += [k for k in (i + r * columns + s for r, s in pairs) if overlap[k] > 0.1]
            kept = np.array(out, dtype=np.int64)
            a, b = left[kept], right[kept]
            columns = [column(g, "scenario_no").take(pa.array(a)), pa.array(fg[a]), pa.array([ig[k] for k in a], pa.string()), pa.array([ip[k] for k in b], pa.string()), pa.array(overlap[kept])]
        else:
            columns = [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())]
        return pa.table(columns, names=["scenario_no", "frame_ts_us", "gt_id", "pred_id", "iou"])

    group = F.floor(F.col("frame_ts_us") / 25_600_000).alias("_g")
    points = F.transform("points", lambda q: F.struct(q["x"].cast("double").alias("x"), q["y"].cast("double").alias("y"))).alias("points")
    rows = lambda d: d.select(F.col("scenario_no").cast("long").alias("scenario_no"), F.col("frame_ts_us").cast("long").alias("frame_ts_us"), F.col("id").cast("string").alias("id"), F.col("type").alias("type"), points, group)
    right = rows(pred).select(*[F.col(k).alias(k) for k in ("scenario_no", "frame_ts_us", "id", "type", "points", "_g")])  # new attributes, in case both sides stem from one table
    return rows(gt).groupBy("scenario_no", "_g").cogroup(right.groupBy("scenario_no", "_g")).applyInArrow(lambda x, y: run(x, y), "scenario_no long, frame_ts_us long, gt_id string, pred_id string, iou double")
