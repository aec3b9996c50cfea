"""Hand-computed cases and properties of the operators that SQL cannot express."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from drivegauge.operators import lines, matching, obstacles, report, slots, timeline
from drivegauge.functions import expressions as ex
from drivegauge.plans import registry, time_queries
from drivegauge.streaming import streams


def test_box_corners(spark):
    df = spark.createDataFrame([(10.0, 0.0, 0.0, 4.0, 2.0, None)], "x double, y double, yaw double, length double, width double, type_classification string")
    r = obstacles.with_corners(df).first()
    assert [(round(r[f"pt_{i}_x"], 9), round(r[f"pt_{i}_y"], 9)) for i in range(4)] == [(8, -1), (12, -1), (12, 1), (8, 1)]
    assert (r["closest_pt_x"], r["closest_pt_y"]) == (8, -1)


def test_occlusion(spark):
    rows = [(0, 0, 1, 10.0, 0.1, 0.3, -0.1, 0.1), (0, 0, 2, 20.0, 0.1, 0.3, -0.1, 0.1), (0, 0, 3, 30.0, 0.2, 0.4, -0.1, 0.1)]
    df = spark.createDataFrame(rows, "scenario_no long, frame_ts_us long, id long, distance double, azimuth_min double, azimuth_max double, elevation_min double, elevation_max double")
    got = {r["id"]: round(r["coverage"], 9) for r in obstacles.occlusion(df).collect()}
    assert got == {1: 0.0, 2: 1.0, 3: 0.5}


def test_assignment_beats_greedy():
    assert matching.assign(np.array([[1.0, 2.0], [2.0, 100.0]])) == [(0, 1), (1, 0)]


@pytest.mark.parametrize("seed", range(20))
def test_assignment_is_optimal(seed):
    rng = np.random.default_rng(seed)
    n, m = (int(v) for v in rng.integers(1, 6, 2))
    cost = rng.random((n, m))
    pairs = matching.assign(cost)
    total = sum(cost[i, j] for i, j in pairs)
    small, large = min(n, m), max(n, m)
    best = min(sum((cost if n <= m else cost.T)[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(large), small))
    assert len(pairs) == small and math.isclose(total, best)


def test_polygon_overlap():
    square = np.array([(0, 0), (2, 0), (2, 2), (0, 2)], float)
    assert math.isclose(matching.iou(square, square + [1, 0]), 2 / 6)
    assert matching.iou(square, square + [5, 0]) == 0


def test_strip_overlap():
    a = np.array([(float(x), 0.0) for x in range(0, 50, 5)])
    assert round(lines.strip_iou(a, a + [0, 0.5]), 3) == 0.6


def test_radius_of_circle():
    t = np.linspace(0, 0.8, 60)
    assert abs(np.median(lines.curvature_radius(50 * np.sin(t)[None], 50 * (1 - np.cos(t))[None])) - 50) < 1


def test_id_carry():
    assert lines.carry_ids([["a", "b"], ["b"], ["c"]])[0] == [[1, 2], [2], [3]]
    assert lines.carry_ids([["a"], ["a,b"], ["b"]])[0] == [[1], [1], [1]]


def test_line_pieces_join():
    p = lambda a, b: np.array([(float(x), 1.0) for x in range(a, b)])
    joined = lines.chain([("1", p(0, 5)), ("2", p(4, 9))], 0.1)
    assert [i for i, _ in joined] == ["1,2"]


def test_yaw(spark):
    from drivegauge.operators import metrics

    df = spark.createDataFrame([(3.1, -3.1), (0.0, math.pi - 0.05)], "gt_yaw double, pred_yaw double")
    a, b = metrics.yaw_error(df).orderBy("gt_yaw", ascending=False).collect()
    assert a["is_reverse"] == 0 and math.isclose(math.radians(a["yaw_error"]), 2 * math.pi - 6.2)
    assert b["is_reverse"] == 1 and math.isclose(math.radians(b["yaw_error"]), -0.05)


def test_slot_pixel(spark):
    x, y = ex.pixel_to_ego(F.col("u"), F.col("v"))
    r = spark.createDataFrame([(227.4276, 331.1825), (-1.0, -1.0)], "u double, v double").select(x.alias("x"), y.alias("y")).collect()
    assert (round(r[0]["x"], 4), round(r[0]["y"], 4)) == (3.4802, 3.7372) and tuple(r[1]) == (0, 0)


def test_mutual_nearest_equals_greedy_on_regular_clocks(spark):
    g = spark.createDataFrame([(0, k * 100000) for k in range(50)], "scenario_no long, frame_ts_us long")
    p = spark.createDataFrame([(0, k * 100000 + 7000 * (k % 5)) for k in range(50)], "scenario_no long, frame_ts_us long")
    a = {tuple(r) for r in matching.match_timestamps(g, p, 50000).collect()}
    assert a == {tuple(r) for r in matching.greedy_timestamps(g, p, 50000).collect()} and len(a) == 50


def test_chain_merges_short_segments(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (0, 40, 50, 100)], "k string, end double")
    assert sorted(tuple(r)[1:] for r in timeline.chain_segments(df, ["k"], "end", 30.0).collect()) == [(0.0, 40.0), (40.0, 100.0)]


def test_partitioning_does_not_matter(spark):
    from drivegauge.plans import registry

    q = lambda: {tuple(r) for r in registry.queries()["a01_recall_precision_stats"](spark, "/root/testdata/sf0.001").collect()}
    one = q()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert q() == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def stream_of(spark, tmp_path, pdf, name, schema):
    spark.createDataFrame(pdf, schema).write.parquet(str(tmp_path / name))
    return spark.readStream.schema(schema).parquet(str(tmp_path / name))


def run_stream(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_stream_counts_equal_batch(spark, tmp_path):
    schema = "event_time timestamp, topic string"
    pdf = pd.DataFrame({"event_time": pd.to_datetime([k * 3 for k in range(40)], unit="s"), "topic": ["a", "b"] * 20})
    got = run_stream(streams.topic_counts(stream_of(spark, tmp_path, pdf, "c", schema)), "counts", "complete")
    want = spark.createDataFrame(pdf, schema).groupBy(F.window("event_time", "10 seconds").alias("w"), "topic").count().select("w.start", "topic", "count")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_stream_drops_repeats(spark, tmp_path):
    schema = "scenario_no long, topic string, event_time timestamp"
    pdf = pd.DataFrame({"scenario_no": [1, 1, 1], "topic": ["a"] * 3, "event_time": pd.to_datetime([1, 1, 2], unit="s")})
    assert run_stream(streams.distinct_stamps(stream_of(spark, tmp_path, pdf, "d", schema)), "distinct").count() == 2


def test_stream_id_carry(spark, tmp_path):
    schema = "scenario_no long, frame_ts_us long, origin_id string"
    pdf = pd.DataFrame({"scenario_no": [1] * 4, "frame_ts_us": [1, 1, 2, 3], "origin_id": ["a", "b", "b", "c"]})
    got = run_stream(streams.carry_track_ids(stream_of(spark, tmp_path, pdf, "i", schema)), "carried")
    assert [r["id"] for r in got.orderBy("frame_ts_us", "origin_id").collect()] == [1, 2, 2, 3]


def test_stream_match(spark, tmp_path):
    g = stream_of(spark, tmp_path, pd.DataFrame({"scenario_no": [1, 1], "gt_time": pd.to_datetime([1000, 2000], unit="ms")}), "g", "scenario_no long, gt_time timestamp")
    p = stream_of(spark, tmp_path, pd.DataFrame({"scenario_no": [1, 1], "pred_time": pd.to_datetime([1013, 2400], unit="ms")}), "p", "scenario_no long, pred_time timestamp")
    assert run_stream(streams.match_frames(g, p), "matched").count() == 1


def test_manifest_and_store(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "path string, size long")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 1)], "path string, size long")
    assert {r["path"] for r in report.manifest_diff(a, b, "path", "size").collect()} == {"y", "z"}


def test_slot_corner_order(spark):
    row = lambda i, pts: (0, i, 0.0, 0.0, *[float(v) for p in pts for v in p])
    pts = [(-2, -1), (2, -1), (2, 1), (-2, 1)]
    schema = "frame_ts_us long, id long, center_x double, center_y double, " + ", ".join(f"pt_{i}_{a} double" for i in range(4) for a in "xy")
    got = slots.match_slots(spark.createDataFrame([row(1, pts[1:] + pts[:1])], schema), spark.createDataFrame([row(9, pts)], schema)).first()
    assert (got["gt_id"], got["pred_id"], got["corner_order"]) == (1, 9, "3012")


def test_overlaps_of_all_users(spark):
    """The queries against brute force over every pair of segments."""
    sf = "/root/testdata/sf0.001"
    seg = {}
    for r in time_queries.messages(spark, sf).collect():
        side = {"view": 0, "click": 0, "error": 1, "signup": 1}.get(r["event_type"])
        if side is not None:
            key = side, r["user_id"], r["us"] // 86400000000
            s, e = seg.get(key, (r["us"], r["us"]))
            seg[key] = min(s, r["us"]), max(e, r["us"])
    a, b = ([(k[1], *v) for k, v in seg.items() if k[0] == side] for side in (0, 1))
    long = lambda x, y: min(x[2], y[2]) - max(x[1], y[1]) >= 30000000000
    want = sorted((x[0], y[0], max(x[1], y[1]), min(x[2], y[2])) for x in a for y in b if long(x, y))
    assert sorted(tuple(r) for r in registry.queries()["j12_overlaps_all"](spark, sf).collect()) == want
    assert any(y % 10 for _, y, _, _ in want)
    free = sorted((x[0], x[1]) for x in a if not any(x[0] == y[0] and long(x, y) for y in b))
    assert sorted(tuple(r) for r in registry.queries()["j12_without_overlap_all"](spark, sf).collect()) == free


@pytest.mark.parametrize("lag", [-7, 0, 5])
def test_time_gap_over_all_shifts(spark, lag):
    """Shifts of either sign are found again, and equal a search point by point."""
    rng = np.random.default_rng(lag + 10)
    path = np.cumsum(rng.normal(size=80))
    t = np.sort(rng.choice(np.arange(0, 800), 300, replace=False)) * 100_000
    v = np.interp(t / 1e6, np.arange(80), path)
    schema = "k string, t long, v double"
    rows = lambda a, b: spark.createDataFrame([("x", int(p), float(q)) for p, q in zip(a, b, strict=True)], schema)
    t2, v2 = t[20:260] - lag * 1_000_000, v[20:260]
    few = spark.createDataFrame([("y", 0, 1.0)], schema)
    args = ["k"], "t", "v", 250_000, 2_000_000, 40
    got = {r["k"]: r for r in timeline.time_gap(rows(t, v).union(few), rows(t2, v2), *args).collect()}
    assert got["y"]["gap"] is None and abs(got["x"]["gap"] - lag * 1_000_000) <= 250_000

    def grid(s, w):
        o, e = round((s[0] + 2_000_000) / 10_000) * 10_000, round((s[-1] - 2_000_000) / 10_000) * 10_000
        return o, [float(np.interp(p, s, w)) for p in range(o, e, 250_000)]

    (o1, a), (o2, b) = grid(t, v), grid(t2, v2)
    every = []
    for s in range(-len(b), len(a) + 1):
        pairs = [(a[i] - b[i - s]) ** 2 for i in range(len(a)) if 0 <= i - s < len(b)]
        if len(pairs) >= 40:
            every.append((math.sqrt(sum(pairs) / len(pairs)), s, len(pairs)))
    e, s, n = min(every)
    assert (got["x"]["shift"], got["x"]["n"], got["x"]["gap"]) == (s, n, o1 - o2 + s * 250_000) and math.isclose(got["x"]["rmse"], e, abs_tol=1e-9)


def test_time_gap_takes_all_users(spark):
    sf = "/root/testdata/sf0.01"
    users = {r[0] for r in time_queries.messages(spark, sf).select("user_id").distinct().collect()}
    got = registry.queries()["q08_time_gap_all"](spark, sf).collect()
    assert {r["user_id"] for r in got} == users and len(got) == len(users) and min(r["shift"] for r in got if r["shift"] is not None) < 0


def test_clock_repair(spark):
    base, back = 1.7e9 + 1000, 500.0
    jump = [base, base + 0.1, base + 0.2, back, back + 0.1]  # falls back by 1.7e9 + 500.2
    rows = [(i, f, n, x) for i, f, s in (("a", "p", jump), ("a", "q", [base, base + 1]), ("b", "p", [base, base + 2])) for n, x in enumerate(s)]
    offsets = timeline.clock_offsets(spark.createDataFrame(rows, "i string, f string, n int, x double"), ["i"], ["f"], "x", ["n"])
    want = round(0.1 + 1.7e9 + 500.2, 3)
    assert {r["i"]: r["offset"] for r in offsets.collect()} == {"a": pytest.approx(want, abs=1e-6), "b": pytest.approx(want, abs=1e-6)}
    ego = spark.createDataFrame([("b", n, float(n)) for n in range(7)], "i string, n int, x double")
    fixed = timeline.repair_clock(ego, offsets, ["i"], [], "x", ["n"]).orderBy("n").collect()
    assert [(r["n"], round(r["x"] - want, 3)) for r in fixed] == [(5, 5.0), (6, 6.0)]
    calm = timeline.clock_offsets(spark.createDataFrame(rows[-2:], "i string, f string, n int, x double"), ["i"], ["f"], "x", ["n"])
    assert [r["offset"] for r in calm.collect()] == [0.0]


def test_line_features_of_long_and_short_lines(spark):
    """Lines beyond 80 m, of few points, unsorted, with nulls, repeated points, and none, against a fit one by one."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        x = np.sort(rng.uniform(-20, 150, rng.integers(1, 60))) if i % 4 else np.arange(0, 150, 5.0)
        y = 1 + 0.1 * x - 2e-3 * x * x + 1e-5 * x**3 + rng.normal(0, 0.01, len(x))
        rows.append((i, [{"x": float(a), "y": float(b)} for a, b in rng.permutation(np.column_stack([x, y]))]))
    bend = [{"x": 100 * math.sin(t), "y": 100 - 100 * math.cos(t)} for t in np.linspace(0, 0.8, 30)] + [{"x": float(x), "y": 70.0} for x in range(81, 300, 3)]
    rows += [(100, bend), (101, []), (102, None), (103, [{"x": None, "y": 1.0}, {"x": 1.0, "y": 2.0}]), (104, [{"x": 1.0, "y": 2.0}] * 9)]
    df = spark.createDataFrame(rows, "id long, points array<struct<x:double,y:double>>")
    got = {r["id"]: r for r in lines.line_features(df, ["id"]).collect()}
    assert len(got) == len(rows)
    for i, points in rows[:40]:
        x, y = np.array(sorted((p["x"], p["y"]) for p in points)).T
        near = (x >= 0) & (x <= 80)
        if near.sum() < 3:
            assert got[i]["c0"] is None and got[i]["radius"] is None
            continue
        want = np.polyfit(x[near], y[near], min(3, near.sum() - 1))
        if near.sum() >= 8:
            assert np.allclose([got[i][f"c{k}"] for k in range(4)], want[::-1], rtol=1e-4, atol=1e-6)
        if x[near][0] <= 8 and near.sum() > 3:
            assert np.isclose(got[i]["heading_0"], np.degrees(np.arctan(25 * want[0] + 5 * want[1] + want[2])))
        fine = np.linspace(x[0], x[-1], 20001)
        if len(x) > 3:
            z = np.polyval(np.polyfit(x, y, 3), fine)
            assert np.isclose(got[i]["length"], np.hypot(np.diff(fine), np.diff(z)).sum(), rtol=1e-4)
    assert abs(got[100]["radius"] - 100) <= 1  # the bend up to 80 m only
    assert [got[101][k] for k in lines.FEATURES] == [got[102][k] for k in lines.FEATURES] == [None] * 8
    assert got[103]["length"] == 0 and got[104]["radius"] is None
    assert lines.line_features(df.limit(0), ["id"]).count() == 0


def test_spline_passes_cubics():
    t = np.sort(np.random.default_rng(1).uniform(0, 9, (5, 11)), axis=1)
    at = np.linspace(t[:, 0], t[:, -1], 30, axis=1)
    cubic = lambda v: 2 - v + 0.5 * v**2 - 0.1 * v**3
    assert np.allclose(lines.spline(t, cubic(t), at), cubic(at))
