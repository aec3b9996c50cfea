"""Pairing of truth and prediction: frames by time, objects by position."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def candidate_stamps(gt: DataFrame, pred: DataFrame, tolerance_us: int) -> DataFrame:
    """Range join by time buckets: every pair of stamps of one scenario less than the tolerance apart.

    Truth rows go to their bucket, prediction rows to theirs and both neighbours, so the join is an equality join.
    """
    left = gt.select("scenario_no", F.col("frame_ts_us").alias("gt_us")).withColumn("_b", F.floor(F.col("gt_us") / tolerance_us))
    right = pred.select("scenario_no", F.col("frame_ts_us").alias("pred_us")).withColumn("_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("pred_us") / tolerance_us) + d)))
    return left.join(right, ["scenario_no", "_b"]).filter(F.abs(F.col("gt_us") - F.col("pred_us")) < tolerance_us).drop("_b")


def match_timestamps(gt: DataFrame, pred: DataFrame, tolerance_us: int) -> DataFrame:
    """Mutually nearest stamps, ties to the earlier one; one to one."""
    pairs = candidate_stamps(gt, pred, tolerance_us).withColumn("_d", F.abs(F.col("gt_us") - F.col("pred_us")))
    by_gt = Window.partitionBy("scenario_no", "gt_us").orderBy("_d", "pred_us")
    by_pred = Window.partitionBy("scenario_no", "pred_us").orderBy("_d", "gt_us")
    best = pairs.withColumn("_g", F.row_number().over(by_gt)).withColumn("_p", F.row_number().over(by_pred)).filter("_g = 1 AND _p = 1")
    return best.select("scenario_no", "gt_us", "pred_us", (F.col("pred_us") - F.col("gt_us")).alias("match_gap_us"))


def greedy_timestamps(gt: DataFrame, pred: DataFrame, tolerance_us: int) -> DataFrame:
    """Smallest gap first, each stamp used once. Stamps further apart than the tolerance start a new island."""
    pairs = candidate_stamps(gt, pred, tolerance_us)
    order = Window.partitionBy("scenario_no").orderBy("gt_us", "pred_us")
    reach = F.max(F.greatest("gt_us", "pred_us")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.least("gt_us", "pred_us") > reach), 1).otherwise(0)
    islands = pairs.withColumn("_n", new).withColumn("_island", F.sum("_n").over(order))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(d=(pdf.pred_us - pdf.gt_us).abs()).sort_values(["d", "gt_us", "pred_us"])
        used_g, used_p, keep = set(), set(), []
        for i, g, p in zip(pdf.index, pdf.gt_us, pdf.pred_us, strict=True):
            if g not in used_g and p not in used_p:
                used_g.add(g)
                used_p.add(p)
                keep.append(i)
        kept = pdf.loc[keep]
        return kept.assign(match_gap_us=kept.pred_us - kept.gt_us)[["scenario_no", "gt_us", "pred_us", "match_gap_us"]]

    return islands.groupBy("scenario_no", F.floor(F.col("_island") / 64).alias("_k")).applyInPandas(lambda p: run(p), "scenario_no long, gt_us long, pred_us long, match_gap_us long")


def reassemble(pairs: DataFrame, gt: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    """Matched, missed and false rows in one table: ``gt_*``, ``pred_*`` and the two flags.

    ``pairs`` has the frame's keys, ``gt_id`` and ``pred_id``; both sides carry ``id`` and the keys.
    """
    left = gt.select(*keys, *[F.col(c).alias(f"gt_{c}") for c in gt.columns if c not in keys])
    right = pred.select(*keys, *[F.col(c).alias(f"pred_{c}") for c in pred.columns if c not in keys])
    linked = left.join(pairs.select(*keys, "gt_id", "pred_id"), [*keys, "gt_id"], "left")
    out = linked.join(right, [*keys, "pred_id"], "full")
    out = out.withColumns({"gt_flag": F.when(F.col("gt_type").isNotNull(), 1).otherwise(0), "pred_flag": F.when(F.col("pred_type").isNotNull(), 1).otherwise(0)})
    return out.withColumn("pred_id", F.when(F.col("pred_flag") == 1, F.col("pred_id")))  # a pair may name what is not there


def number_rows(df: DataFrame, order: list[str], partition: list[str]) -> DataFrame:
    """``corresponding_index`` from 1 within each partition."""
    return df.withColumn("corresponding_index", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)).cast("long"))


def drop_extremes(df: DataFrame) -> DataFrame:
    """Without truth beyond 300 m ahead or 200 m aside; rows without truth stay."""
    return df.filter(F.col("gt_x").isNull() | ((F.abs("gt_x") <= 300) & (F.abs("gt_y") <= 200)))


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Least total cost one-to-one pairs of rows and columns, by shortest augmenting paths."""
    return priced(cost)[0]


def priced(cost: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """``assign``, and what each pair of a row and a column costs beyond the prices of both: what no least way can use is above 0."""
    turned = cost.shape[0] > cost.shape[1]
    c = cost.T if turned else cost
    n, m = c.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used, way = np.full(m + 1, np.inf), np.zeros(m + 1, bool), np.zeros(m + 1, int)
        while match[j0]:
            used[j0] = True
            reduced = c[match[j0] - 1] - u[match[j0]] - v[1:]
            better = ~used[1:] & (reduced < least[1:])
            least[1:][better], way[1:][better] = reduced[better], j0
            j1 = int(np.where(used, np.inf, least).argmin())
            step = least[j1]
            u[match[used]] += step
            v[used] -= step
            least[~used] -= step
            j0 = j1
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    pairs = [(int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j]]
    beyond = c - u[1:, None] - v[1:]
    return (sorted((b, a) for a, b in pairs), beyond.T) if turned else (sorted(pairs), beyond)


#: Ways whose totals differ by less are alike but for rounding, and are told apart by ``settled``.
ALIKE = 1e-9
#: Sets of taken columns that ``settled`` follows. A frame with more of them keeps the choice of ``assign``, as good but for rounding.
SETS = 4096


def settled(cost: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of ``assign`` (500 for no pair), with its ways that are alike but for rounding told apart as SQL does that
    adds up each way: by the sum of cost - 500 in the order of the rows. Ways of equal sums are open; one of them is taken,
    that of ``assign`` if it is among them.

    Rounding keeps the order of sums to which the same is added, so of all ways that have taken the same columns so far
    only the least goes on.
    """
    pairs, beyond = priced(cost)
    pairs = [(r, c) for r, c in pairs if cost[r, c] < 500]
    near = (cost < 500) & (beyond <= ALIKE)
    if near.sum() == len(pairs):
        return pairs
    own, spare = dict(pairs), len(cost) - len(pairs)
    ways: dict[int, tuple[float, bool, tuple]] = {0: (0.0, False, ())}  # by taken columns: sum, other than the pairs, pairs
    for r in range(len(cost)):
        following: dict[int, tuple[float, bool, tuple]] = {}
        options = [*np.flatnonzero(near[r]).tolist(), None]
        for used, (total, other, way) in ways.items():
            for k in options:
                if k is None:
                    if r - len(way) >= spare:
                        continue
                    at, step = used, (total, other or r in own, way)
                elif used >> k & 1:
                    continue
                else:
                    at, step = used | 1 << k, (total + (float(cost[r, k]) - 500), other or own.get(r) != k, (*way, (r, k)))
                if at not in following or step[:2] < following[at][:2]:
                    following[at] = step
        if len(following) > SETS:
            return pairs
        ways = following
    return list(min(ways.values(), key=lambda w: w[:2])[2])


def clip_area(p: np.ndarray, q: np.ndarray) -> float:
    """Area common to two convex polygons, corners in one turning sense."""
    out = [tuple(x) for x in p]
    for k in range(len(q)):
        (ax, ay), (bx, by) = q[k], q[(k + 1) % len(q)]
        side = lambda x, y, ax=ax, ay=ay, bx=bx, by=by: (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        now, out = out, []
        for i, (x, y) in enumerate(now):
            px, py = now[i - 1]
            s, t = side(px, py), side(x, y)
            if (s >= 0) != (t >= 0):
                f = s / (s - t)
                out.append((px + f * (x - px), py + f * (y - py)))
            if t >= 0:
                out.append((x, y))
        if not out:
            return 0.0
    return area(np.array(out))


def area(p: np.ndarray) -> float:
    x, y = p[:, 0], p[:, 1]
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


def iou(p: np.ndarray, q: np.ndarray) -> float:
    common = clip_area(p, q)
    return common / max(area(p) + area(q) - common, 1e-12)


CORNERS = [f"pt_{i}_{a}" for i in range(4) for a in "xy"]


def match_objects(gt: DataFrame, pred: DataFrame, x_tol: float = 2.0, y_tol: float = 1.0, relative: float = 0.1, overlap: float | None = 0.05) -> DataFrame:
    """Least-cost assignment of each frame's objects: ``scenario_no, frame_ts_us, gt_id, pred_id``.

    Both sides carry the truth frame's stamp. A pair is a candidate unless the one is a vehicle and the other a
    pedestrian, if its offsets are within the absolute or the relative tolerance, or within one and a half absolute
    tolerances with boxes that overlap by ``overlap`` (None: not looked at); the cost is the centres' distance, half as
    much again for other types. As many pairs as can be are made, at the least total cost.

    Pairs that are each other's only candidate are matched as they are; only the rest is assigned, a frame at a time.
    """
    frame = ["scenario_no", "frame_ts_us"]
    side = lambda d, is_pred: d.select(*frame, "id", "type", "x", "y", *(CORNERS if overlap is not None else []), F.lit(is_pred).alias("_pred"))
    both = side(gt, False).unionByName(side(pred, True))
    return match_pairs(both.repartition(*frame).sortWithinPartitions(*frame), x_tol, y_tol, relative, overlap)


def match_pairs(both: DataFrame, x_tol: float = 2.0, y_tol: float = 1.0, relative: float = 0.1, overlap: float | None = 0.05) -> DataFrame:
    """``match_objects`` of both sides in one table, as ``match_rows`` takes it: no pairs are joined, shuffled or stored."""
    frame = ["scenario_no", "frame_ts_us"]
    rows = match_rows(both, frame, ["id"], ["id"], x_tol, y_tol, relative, overlap=overlap)
    return rows.filter("gt_flag = 1 AND pred_flag = 1").select(*frame, "gt_id", "pred_id")


PAIRS_AT_ONCE = 1_000_000


def near_pairs(g: dict[str, np.ndarray], p: dict[str, np.ndarray], starts: np.ndarray, counts: np.ndarray, x_tol: float, y_tol: float, relative: float, overlap: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and cost of the candidates (see ``match_objects``) among each truth row's frame, which has ``counts``
    predictions from ``starts`` on."""
    box = lambda d, at: np.stack([d[k][at] for k in CORNERS], axis=1).reshape(-1, 4, 2)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    total = np.cumsum(counts)
    for first in range(0, int(total[-1]) if len(total) else 0, PAIRS_AT_ONCE):
        k = np.arange(first, min(first + PAIRS_AT_ONCE, int(total[-1])))
        i = np.searchsorted(total, k, "right")
        j = starts[i] + k - (total - counts)[i]
        gt, pt, gx, px, gy, py = g["type"][i], p["type"][j], g["x"][i], p["x"][j], g["y"][i], p["y"][j]
        dx, dy = np.abs(gx - px), np.abs(gy - py)
        share = lambda d, a, b: d / np.maximum(20.0, np.maximum(np.abs(a), np.abs(b))) <= relative
        either = lambda t: np.isnan(t) | (t == 1) | (t == 2)
        clash = ((gt == 1) & (pt == 2)) | ((gt == 2) & (pt == 1)) | (np.isnan(gt) & either(pt)) | (np.isnan(pt) & either(gt))
        use = ~clash & (((dx <= x_tol) & (dy <= y_tol)) | (share(dx, gx, px) & share(dy, gy, py)))
        if overlap is not None:  # few pairs are left to look at
            more = np.flatnonzero(~clash & ~use & (dx <= 1.5 * x_tol) & (dy <= 1.5 * y_tol))
            use[more] = [bool(iou(a, b) >= overlap) for a, b in zip(box(g, i[more]), box(p, j[more]), strict=True)]
        cost = np.sqrt(dx * dx + dy * dy) * np.where(gt == pt, 1.0, 1.5)
        found.append((i[use], j[use], cost[use]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


ROWS_AT_ONCE = 100_000
#: Assignments of a small frame are all tried at once, with those of other frames of its shape; ``settled`` has the rest.
WAYS = 840


def least_pairs(table: np.ndarray) -> list[list[tuple[int, int]]]:
    """Of many cost tables of one shape, 500 for no pair: each table's least assignment, as ``settled`` finds it, by trying
    all. A table with another one as good but for rounding is left to it."""
    n, m = table.shape[1:]
    turned = n > m
    t = table.transpose(0, 2, 1) if turned else table
    n, m = t.shape[1:]
    ways = np.array(list(itertools.permutations(range(m), n)))
    rows = np.arange(n)
    code = (m + 1) ** rows
    out = []
    for first in range(0, len(t), step := max(1, PAIRS_AT_ONCE // (len(ways) * n))):
        costs = t[first : first + step][:, rows, ways]
        total = costs.sum(2)
        real = costs < 500
        best = total.argmin(1)
        pairs = (real * (ways + 1) * code).sum(2)  # ways that differ in what is no pair are one
        at = np.arange(len(best))
        tied = ((total <= total[at, best][:, None] + ALIKE) & (pairs != pairs[at, best][:, None])).any(1)
        for k, w in enumerate(best.tolist()):
            if tied[k]:
                found = settled(table[first + k])
            else:
                found = [(int(ways[w, r]), r) if turned else (r, int(ways[w, r])) for r in np.flatnonzero(real[k, w]).tolist()]
            out.append(found)
    return out


def partners(gf: np.ndarray, i: np.ndarray, j: np.ndarray, cost: np.ndarray, n_pred: int) -> np.ndarray:
    """The partner of each truth row, -1 for none: of the candidates ``i``, ``j`` (by frame) as many as can be, at least cost."""
    partner = np.full(len(gf), -1)
    sole = (np.bincount(i, minlength=len(gf))[i] == 1) & (np.bincount(j, minlength=n_pred)[j] == 1)
    partner[i[sole]] = j[sole]
    i, j, cost = i[~sole], j[~sole], cost[~sole]
    edges = np.append(np.flatnonzero(np.diff(gf[i], prepend=-1)), len(i)).tolist()
    shapes: dict[tuple[int, int], list] = {}
    for a, b in itertools.pairwise(edges):
        own, other = np.unique(i[a:b]), np.unique(j[a:b])
        table = np.full((len(own), len(other)), 500.0)
        table[np.searchsorted(own, i[a:b]), np.searchsorted(other, j[a:b])] = cost[a:b]
        shapes.setdefault(table.shape, []).append((own, other, table))
    for (n, m), frames in shapes.items():
        few = math.perm(max(n, m), min(n, m)) <= WAYS
        found = least_pairs(np.stack([f[2] for f in frames])) if few else (settled(t) for _, _, t in frames)
        for (own, other, _), pairs in zip(frames, found, strict=True):
            for r, c in pairs:
                partner[own[r]] = other[c]
    return partner


def match_frames(gt: DataFrame, pred: DataFrame, keys: list[str], x_tol: float = 2.0, y_tol: float = 1.0, relative: float = 0.1) -> DataFrame:
    """``reassemble`` of ``match_objects`` by position, in one pass: both sides are shuffled once, by frame, and a frame's
    rows are paired where they are; no pairs are stored or joined back. Ids are those of rows unlike each other in a frame.
    """
    both = gt.withColumn("_pred", F.lit(False)).unionByName(pred.withColumn("_pred", F.lit(True)), allowMissingColumns=True)
    own = lambda d: [k for k in d.columns if k not in keys]
    return match_rows(both.repartition(*keys).sortWithinPartitions(*keys), keys, own(gt), own(pred), x_tol, y_tol, relative)


def match_rows(both: DataFrame, keys: list[str], gt_columns: list[str], pred_columns: list[str], x_tol: float = 2.0, y_tol: float = 1.0, relative: float = 0.1, at_once: int = ROWS_AT_ONCE, overlap: float | None = None) -> DataFrame:
    """``match_frames`` of both sides in one table, in which ``_pred`` tells them apart and the rows of a frame stand one
    after the other in a partition. Rows with a null key are of no frame and find no partner. With ``overlap``, boxes are
    looked at as in ``match_objects``."""
    looked_at = ["type", "x", "y", *(CORNERS if overlap is not None else [])]
    both = both.select(*keys, "_pred", *dict.fromkeys(["id", *looked_at, *gt_columns, *pred_columns]))
    fields = [StructField(k, both.schema[k].dataType) for k in keys]
    fields += [StructField(f"{n}_{k}", both.schema[k].dataType) for n, d in (("gt", gt_columns), ("pred", pred_columns)) for k in d]
    schema = StructType([*fields, StructField("gt_flag", IntegerType()), StructField("pred_flag", IntegerType())])

    def begins(rows: pa.RecordBatch) -> np.ndarray:
        """Whether a row's frame is another than that of the row before it."""
        out = np.arange(rows.num_rows) == 0
        for k in keys:
            column = rows.column(k)
            out[1:] |= pc.fill_null(pc.not_equal(column[1:], column[:-1]), True).to_numpy(zero_copy_only=False)
        return out

    def pair(rows: pa.RecordBatch, frame: np.ndarray) -> pa.RecordBatch:
        column = lambda k: rows.column(k).to_numpy(zero_copy_only=False)
        is_pred, ids, values = column("_pred").astype(bool), column("id"), {k: column(k).astype(float) for k in looked_at}
        g, p = (w[np.lexsort((ids[w], frame[w]))] for w in (np.flatnonzero(~is_pred), np.flatnonzero(is_pred)))
        gf, pf = frame[g], frame[p]
        low, high = np.searchsorted(pf, gf, "left"), np.searchsorted(pf, gf, "right")
        i, j, cost = near_pairs({k: v[g] for k, v in values.items()}, {k: v[p] for k, v in values.items()}, low, high - low, x_tol, y_tol, relative, overlap)
        partner = partners(gf, i, j, cost, len(p))
        alone = np.setdiff1d(np.arange(len(p)), partner[partner >= 0])
        right = np.append(partner, alone)
        left = pa.array(np.append(g, np.zeros(len(alone), np.int64)), mask=np.arange(len(g) + len(alone)) >= len(g))
        taken = pa.array(np.append(p, 0)[right], mask=right < 0)
        frames = pa.array(np.append(g, p[alone]))
        columns = [rows.column(k).take(frames) for k in keys] + [rows.column(k).take(left) for k in gt_columns] + [rows.column(k).take(taken) for k in pred_columns]
        flags = [pc.is_valid(left).cast(pa.int32()), pc.is_valid(taken).cast(pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, *flags], names=schema.names)

    def run(batches):
        held, n = [], 0

        def whole(last: bool):
            """Pairs of the held rows, but for those of the last frame, of which more may come."""
            nonlocal held, n
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            new = begins(rows)
            end = rows.num_rows if last else int(np.flatnonzero(new)[-1])
            held, n = [rows.slice(end)] if end < rows.num_rows else [], rows.num_rows - end
            return [pair(rows.slice(0, end), np.cumsum(new[:end]))] if end else []

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= at_once:
                yield from whole(False)
        if held:
            yield from whole(True)

    return both.mapInArrow(run, schema)
