"""Assignment against all permutations, and hand-computed cases of flatteners, samples, packages and exposure."""

import itertools
import math
import random

import numpy as np

from drivegauge.operators import lines, matching, report, statistics, timeline
from drivegauge.sources import flatten


def box(x, y, length, width):
    return [v for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1)) for v in (x + a * length / 2, y + b * width / 2)]


def test_assignment_against_permutations(spark):
    """Tiny frames in which objects crowd: as many pairs as can be, at the least total cost."""
    rng = random.Random(11)
    corners = ", ".join(f"pt_{i}_{a} double" for i in range(4) for a in "xy")
    schema = f"scenario_no long, frame_ts_us long, id long, type int, x double, y double, {corners}"
    sides = [[], []]
    for f in range(60):
        for side in sides:
            for i in range(rng.randint(0, 4)):
                x, y, kind = rng.uniform(0, 6), rng.uniform(0, 3), rng.choice([1, 1, 2, 18])
                side.append((f % 3, f * 100_000, i, kind, x, y, *box(x, y, rng.uniform(1, 4), rng.uniform(1, 2))))
    gt, pred = (spark.createDataFrame(s, schema) for s in sides)
    for overlap in (0.05, None):
        got = {}
        for r in matching.match_objects(gt, pred, overlap=overlap).collect():
            got.setdefault((r["scenario_no"], r["frame_ts_us"]), set()).add((r["gt_id"], r["pred_id"]))
        pairs = 0
        for f in range(60):
            g, p = ([r for r in s if r[1] == f * 100_000] for s in sides)

            def cost(a, b, overlap=overlap):
                dx, dy = abs(a[4] - b[4]), abs(a[5] - b[5])
                near = dx <= 2 and dy <= 1 or dx / 20 <= 0.1 and dy / 20 <= 0.1
                if not near and overlap is not None and dx <= 3 and dy <= 1.5:
                    near = matching.iou(np.reshape(a[6:], (4, 2)), np.reshape(b[6:], (4, 2))) >= overlap
                return math.hypot(dx, dy) * (1 if a[3] == b[3] else 1.5) - 500 if near and {a[3], b[3]} != {1, 2} else 0.0

            small, large = (g, p) if len(g) <= len(p) else (p, g)
            best = min((sum(cost(a, b) if small is g else cost(b, a) for a, b in zip(small, way, strict=False)), way) for way in itertools.permutations(large, len(small))) if g and p else (0.0, ())
            found = got.get((f % 3, f * 100_000), set())
            at = {(r[2]): r for r in g}, {(r[2]): r for r in p}
            assert math.isclose(sum(cost(at[0][i], at[1][j]) for i, j in found), best[0], abs_tol=1e-9)
            assert len({i for i, _ in found}) == len({j for _, j in found}) == len(found)
            pairs += len(found)
        assert pairs > 40


def test_placed_obstacles(spark):
    """Each position type's anchor on a box turned by 90 degrees; a pedestrian's category; shares in per cent."""
    schema = "scenario_no int, time_stamp double, frame_id long, obstacles array<struct<id: long, type: int, position_type: int, yaw: double, length: double, width: double, confidence: double, x: double, y: double, categories: array<struct<property: int, kind: int, conf: double>>>>"
    rows = [(p + 1, 0, p, math.pi / 2, 4.0, 2.0, 50.0, 10.0, 5.0, None) for p in range(11)] + [(0, 0, 0, 0.0, 1.0, 1.0, 1.0, 0.0, 0.0, None), (90, 2, 0, 0.3, 1.0, 1.0, 0.5, 0.0, 0.0, [(3, 1, 1.0), (4, 0, 0.0), (5, 0, 0.7), (1, 0, 1.0)]), (91, 2, 0, 0.3, 1.0, 1.0, 0.5, 0.0, 0.0, [])]
    got = {r["id"]: r for r in flatten.placed_obstacles(spark.createDataFrame([(0, 0.0, 1, rows)], schema)).collect()}
    assert set(got) == {*range(1, 12), 90, 91} and got[90]["yaw"] == -math.pi / 2 and got[91]["yaw"] == 0.3 and got[1]["confidence"] == 0.5
    along = {7: 0, 8: 0, 9: 0, 0: 0, 4: 0.5, 5: 0.5, 6: 0.5}
    across = {0: 0, 2: 0, 5: 0, 9: 0, 1: 0.5, 4: 0.5, 7: 0.5}
    for p in range(11):  # turned left: along is y, across is - x
        a, b = along.get(p, -0.5), across.get(p, -0.5)
        assert math.isclose(got[p + 1]["x"], 10 + b * 2) and math.isclose(got[p + 1]["y"], 5 - a * 4), p


def test_vendor_lines(spark):
    schema = "scenario_no int, time_stamp double, lines array<struct<id: long, confidence: double, points: array<struct<x: double, y: double>>, types: array<int>>>"
    data = [(0, 0.0, [(1, 0.5, [(0.0, 0.0), (1.0, 0.0), (0.0, 2.0)], [1, 1, 2, 2, 1]), (0, 1.0, [], []), (2, 0.0, [], [])])]
    assert [r.asDict(True) for r in flatten.vendor_lines(spark.createDataFrame(data, schema)).collect()] == [{"scenario_no": 0, "time_stamp": 0.0, "id": 1, "points": [{"x": 1.0, "y": 0.0}, {"x": 0.0, "y": 2.0}], "types": [1, 2, 1]}]


def test_failure_samples(spark):
    schema = "scenario_no long, frame_ts_us long, gt_flag int, pred_flag int, gt_id long, pred_id long, gt_x double, gt_y double, pred_x double, pred_y double, gt_type_classification string, pred_type_classification string"
    miss = lambda i, f, x, y=0.0, kind="car": (0, f, 1, 0, i, None, x, y, None, None, kind, None)
    false = lambda i, f, x, kind="car": (0, f, 0, 1, None, i, None, None, x, 0.0, None, kind)
    rows = [miss(i, f, 10.0) for i in range(4) for f in range(i + 1)] + [miss(9, 0, 120.0), miss(8, 0, 10.0, 9.0), miss(7, 0, 60.0, kind="cyclist"), miss(6, 0, 160.0)]
    rows += [false(i, f, 20.0) for i in (20, 21) for f in range(i - 18)] + [false(22, 0, 60.0, "pedestrian"), (0, 5, 1, 1, 30, 31, 5.0, 1.0, 5.0, 1.0, "car", "truck_bus"), (0, 5, 1, 1, 32, 33, 5.0, 1.0, 5.0, 1.0, "car", "car"), (0, 5, 1, 1, 34, 35, 110.0, 1.0, 110.0, 1.0, "car", "truck_bus")]
    got = {(r["kind"], r["id"], r["frame_ts_us"]) for r in report.failure_samples(spark.createDataFrame(rows, schema), 1).collect()}
    assert got == {("false_negative_near", 3, f) for f in range(4)} | {("false_negative_near", 2, f) for f in range(3)} | {("false_negative_far", 9, 0)} | {("false_positive", 21, f) for f in range(3)} | {("false_type", 30, 5)}


def test_packages_and_exposure(spark):
    objects = [("a/install/x", 5), ("a/rosbag1", 7), ("a/notes", 100), ("b/install/x", 1), ("c/rosbag", 1), (None, 3), ("d/install/rosbag_tools", 2), ("d/rosbag", 2)]
    got = report.package_sizes(spark.createDataFrame(objects, "key string, size long"), "key", "size")
    assert {tuple(r) for r in got.collect()} == {("a", 12), ("d", 4)}
    assert [r["package"] for r in report.downloads(got, 20 * 1024**3 + 20.0).collect()] == ["d"]
    clips = spark.createDataFrame([(1, "x", 10.0, 30), (2, "x", 20.0, 30), (3, None, 1.0, 30)], "scenario_no long, tag string, duration double, fps int")
    ego = spark.createDataFrame([(1, 0.0, 10.0), (1, 150.0, 10.0)], "scenario_no long, time_stamp double, ego_vx double")
    rows = sorted(((r["tag"] or "", r["frames"], r["distance_km"], r["scenarios"]) for r in report.exposure(clips, ego, "tag").collect()), key=str)
    assert rows == [("", 29, 0, 1), ("", 902, 2, 3), ("x", 873, 2, 2)]


def test_flow_replaces_impossible_speeds(spark):
    objects = spark.createDataFrame([(0, 0, 1.0, 1.0, 10.0, 0.0, 4.0, 2.0), (0, 0, 2.0, 1.0, 0.0, 100.0, 4.0, 2.0), (0, 1, 50.0, 1.0, 7.0, 0.0, 4.0, 2.0)], "scenario_no long, frame_ts_us long, x double, y double, vx double, vy double, length double, width double")
    frames = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "scenario_no long, frame_ts_us long")
    got = {r["scenario_no"]: tuple(r)[1:] for r in statistics.traffic_flow(objects, frames).collect()}
    assert np.allclose(got[0], (5.0, 20 / 60 / 2, 16 / 960 / 2)) and got[1] == (0.0, 0.0, 0.0)


def test_scenario_validity(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (1, "a", 30.0), (1, "b", 1.0), (1, "b", 8.0), (2, "a", 0.0), (2, "a", 5.0)], "s long, topic string, t double")
    got = {r["s"]: tuple(r)[1:] for r in timeline.scenario_validity(df, ["a", "b"], "s", "topic", "t").collect()}
    assert got == {1: ("2/2/30.00/0.00-30.00", "2/2/7.00/1.00-8.00", 1), 2: ("2/2/5.00/0.00-5.00", "0/0/0/0-0", 1)}
    assert timeline.scenario_validity(df, ["a", "b"], "s", "topic", "t", 4.0).filter("valid = 1").count() == 0


def test_line_pipeline(spark):
    """Two pieces become one line with the first one's class; short and repeated ones go; numbers go on through frames."""
    at = lambda xs, y: [{"x": float(x), "y": y} for x in xs]
    rows = [(0, f, i, kind, p) for f in (100_000, 200_000) for i, kind, p in ((1, 1, at(range(0, 21, 2), 1.5)), (2, 2, at(range(20, 41, 2), 1.5)), (1, 1, at([0], 9.0)), (3, 2, at(range(0, 41, 2), -1.5)), (4, 1, at([0, 1], 5.0)))]
    df = spark.createDataFrame(rows, "scenario_no long, frame_ts_us long, id long, type int, points array<struct<x: double, y: double>>")
    got = sorted((r["frame_ts_us"], r["origin_id"], r["id"], r["position"], r["type_classification"], r["age"], round(r["c0"], 3)) for r in lines.pipeline(df, True).collect())
    assert got == [(f, o, i, p, k, n, c) for f in (100_000, 200_000) for o, i, p, k, n, c in (("1,2", 1, 1, "main_lane", 4, 1.5), ("3", 2, 8, "fence", 2, -1.5))]
    told = lines.pipeline(df.selectExpr("*", "3 AS position"), False)
    assert {(r["origin_id"], r["type_classification"]) for r in told.collect()} == {("1,2", "secondary_lane"), ("3", "fence")}


def test_camera_plan_angles_and_sides(spark):
    from drivegauge.operators import report as rp

    cameras = spark.createDataFrame([("front", -60.0, 60.0), ("rear", 135.0, 225.0)], "camera string, lo double, hi double")
    failures = spark.createDataFrame([(1_000_000, "fn", 7, 5.0, 0.0), (1_000_000, "fp", 3, 5.0, 1.0), (1_000_000, "fn", 9, -5.0, -0.1), (2_000_000, "fp", 2, -5.0, 0.1), (2_000_000, "fn", 4, 0.0, 9.0)], "frame_ts_us long, side string, id long, x double, y double")
    got = {(r["camera"], r["frame_ts_us"]): (r["frame_index"], r["fn_ids"], r["fp_ids"]) for r in rp.camera_plan(failures, cameras, 0.5, 30).collect()}
    assert got == {("front", 1_000_000): (15, "7", "3"), ("rear", 1_000_000): (15, "9", ""), ("rear", 2_000_000): (45, "", "2")}


def test_merged_history_counts_a_test_once_and_keeps_failures_alone(spark):
    from drivegauge.operators import report as rp

    ddl = "scenario string, date string, topic string, source string, version string"
    history = spark.createDataFrame([("a", "2024-02-01", "t", "s", "1"), ("a", "2024-01-01", "t", "s", "1")], ddl)
    tests = spark.createDataFrame([("a", "2024-02-01", "t", "s", "1"), ("b", "2024-03-01", "t", "s", "2")], ddl)
    failures = spark.createDataFrame([("a", 5, "fn", 2), ("a", 4, "fn", 3), ("a", 6, "fp", 2), ("a", 8, "fn", 1), ("c", 1, "fn", 3)], "scenario string, id long, side string, mark int")
    got = {r["scenario"]: (r["n_tests"], r["tests"], r["excluded"]) for r in rp.merge_tests(history, tests, failures).collect()}
    assert got == {"a": (2, "2024-01-01/t/s/1;2024-02-01/t/s/1", "4,5"), "b": (1, "2024-03-01/t/s/2", ""), "c": (0, "", "1")}


def test_mean_beyond_the_limit_takes_known_errors(spark):
    from drivegauge.operators import metrics as me

    df = spark.createDataFrame([(1, 0.5, 0.1), (2, 0.5, None), (3, None, None), (4, 0.1, 0.2)], "id int, a double, b double")
    got = {r["id"]: (r["over"], r["over_abnormal"]) for r in me.over_limit(df, "over", ["a", "b"], 0.25).collect()}
    assert got == {1: (0.125, 1), 2: (0.25, 1), 3: (None, 0), 4: (0.0, 0)}
