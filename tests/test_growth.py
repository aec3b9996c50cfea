"""What an operator does once a row, a frame or a table, it does not do again; and its results against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from drivegauge.operators import lines, matching, metrics
from drivegauge.operators.matching import assign


def test_lateral_error_sorts_a_line_once(spark):
    rng = np.random.default_rng(5)
    point = "array<struct<x:double,y:double>>"
    rows = []
    for i in range(40):
        gx, px = rng.permutation(np.arange(-10.0, 100.0, 5.0))[: rng.integers(2, 22)], rng.uniform(-20, 120, rng.integers(0, 30))
        rows.append((i, [(float(x), float(rng.normal())) for x in gx], [(float(x), float(rng.normal())) for x in px]))
    out = metrics.lateral_error(spark.createDataFrame(rows, f"id int, gt_points {point}, pred_points {point}"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("array_sort(gt_points") <= 1
    got = {r["id"]: r for r in out.collect()}
    for i, g, p in rows:
        gx, gy = np.array(sorted(g)).T
        own = [(x, abs(y - np.interp(x, gx, gy))) for x, y in p if gx[0] <= x <= gx[-1]]
        for low, high in ((0, 30), (30, 60), (60, 120)):
            d = [v for x, v in own if low <= x < high]
            value = got[i][f"lateral_{low}_{high}"]
            assert value == pytest.approx(np.mean(d)) if len(d) >= 3 else value is None


def frames_of_lines(spark, seed, frames=60):
    """Pieces of lines in random frames of one scenario, and the same as a DataFrame."""
    rng, rows = np.random.default_rng(seed), []
    for f in range(frames):
        for i in range(rng.integers(1, 7)):
            x = np.sort(rng.choice(np.arange(-5.0, 160.0, 2.5), rng.integers(1, 12), replace=False))
            rows.append((1, f * 100000, 10 * f + i, int(rng.integers(0, 2)), [(float(v), round(float(rng.normal() * 6), 1)) for v in x]))
        if f % 2:  # the next piece begins where the last one ends
            x, y = rows[-1][4][-1]
            rows.append((1, f * 100000, 10 * f + 9, 1, [(x + 0.05, y), (x + 5, y + 1)]))
    return rows, spark.createDataFrame(rows, "scenario_no long, frame_ts_us long, id long, type int, points array<struct<x:double,y:double>>")


def by_frame(rows):
    out = {}
    for r in rows:
        out.setdefault(r[1], []).append(r)
    return out


def test_connected_lines_are_those_of_a_loop(spark):
    rows, df = frames_of_lines(spark, 1)
    want = set()
    for t, f in by_frame(rows).items():
        pieces = []
        for r in f:
            p = np.array(sorted(q for q in r[4] if -0.1 <= q[0] <= 150 and abs(q[1]) <= 20)).reshape(-1, 2)
            if len(p):
                pieces.append((str(r[2]), p[np.r_[True, np.diff(p[:, 0]) != 0]]))
        pieces.sort(key=lambda piece: (-float(np.abs(piece[1][:, 1]).max()), piece[0]))
        found = True
        while found:
            ends = ((i, j) for i in range(len(pieces)) for j in range(len(pieces)) if i != j and np.hypot(*(pieces[i][1][-1] - pieces[j][1][0])) < 0.1)
            if found := next(ends, None):
                i, j = found
                pieces[i] = (f"{pieces[i][0]},{pieces[j][0]}", np.vstack([pieces[i][1], pieces[j][1]]))
                del pieces[j]
        want |= {(t, i, tuple(map(tuple, p))) for i, p in pieces}
    out = lines.connect_lines(df)
    assert "InPandas" not in out._jdf.queryExecution().executedPlan().toString()  # no point becomes a Python object
    got = {(r["frame_ts_us"], r["id"], tuple(map(tuple, r["points"]))) for r in out.collect()}
    assert got == want and any("," in i for _, i, _ in got)


@pytest.mark.parametrize("truth", [True, False])
def test_line_pipeline_shuffles_points_once(spark, monkeypatch, truth):
    from drivegauge.sources import scratch

    rows, df = frames_of_lines(spark, 15)
    df = df.unionByName(df.filter("id % 4 = 1").selectExpr("scenario_no", "frame_ts_us", "id", "type + 1 AS type", "slice(points, 1, 2) AS points"))  # repeated ids
    df = df.selectExpr("IF(id % 90 > 50, 2, 1L) AS scenario_no", "frame_ts_us", "id", "type", "points", "CAST(id % 9 AS int) AS position")
    monkeypatch.setattr(scratch, "scratch_dir", lambda *a: pytest.fail("stores a table"))
    out = lines.pipeline(df.drop("position") if truth else df, truth)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "points" not in plan[: plan.index("MapInArrow")] and plan.count("RepartitionByExpression [scenario_no") == 1 + truth
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 4 + truth  # points, ages and their match, scenarios
    one = df.groupBy("scenario_no", "frame_ts_us", "id").agg(F.min(F.struct("type", -F.size("points"), "points", "position")).alias("v"), F.count("*").alias("n")).select("scenario_no", "frame_ts_us", "id", "v.*")
    whole = lines.connect_lines(one)
    frame = ["scenario_no", "frame_ts_us"]
    first = one.select(*frame, F.col("id").cast("string").alias("first"), "type", "position").join(df.groupBy("scenario_no", F.col("id").cast("string").alias("first")).agg(F.count("*").alias("age")), ["scenario_no", "first"])
    want = whole.withColumn("first", F.split_part("id", F.lit(","), F.lit(1))).join(first, [*frame, "first"]).join(lines.line_features(whole, [*frame, "id"]), [*frame, "id"])
    if truth:
        want = want.drop("position").join(lines.lane_position(whole), [*frame, "id"]).withColumnRenamed("id", "origin_id").join(lines.carry_track_id(whole), [*frame, "origin_id"])
    else:
        want = want.withColumn("origin_id", F.col("id"))
    want = want.filter("length >= 2").select(out.columns[:-1])
    table = lambda d: sorted(map(repr, d.collect()))
    assert table(out.select(out.columns[:-1])) == table(want) and out.count() > 100 and out.columns[-1] == "type_classification"


def test_lane_positions_need_no_group_in_python(spark):
    rows, df = frames_of_lines(spark, 2)
    out = lines.lane_position(df)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    want = {}
    for f in by_frame(rows).values():
        heads = []
        for r in f:
            near = sorted(r[4], key=lambda q: abs(q[0]))[:3]
            heads.append((sum(q[0] for q in near) / len(near), sum(q[1] for q in near) / len(near), r[2]))
            want[r[2]] = 0
        for base, side in ((1, 1), (8, -1)):
            lane = 0
            for distance, k in sorted((abs(y), k) for x, y, k in heads if x <= 15 and abs(y) <= 12.25 and (y >= 0) == (side > 0)):
                while distance >= (0.2 + lane + 1) * 3.5 and lane < 4:
                    lane += 1
                want[k] = base + lane
                lane += 1
    assert {r["id"]: r["position"] for r in out.collect()} == want


def test_matched_lines_are_the_best_of_all_pairs(spark):
    rows, df = frames_of_lines(spark, 3)
    other, pred = frames_of_lines(spark, 4)
    pred = pred.unionByName(df.filter("id % 3 = 0").selectExpr("scenario_no", "frame_ts_us", "id + 5000 AS id", "type", "points"))
    other += [(s, t, i + 5000, k, p) for s, t, i, k, p in rows if i % 3 == 0]
    want, right = {}, by_frame(other)
    for t, f in by_frame(rows).items():
        overlap = np.array([[slow_iou(np.array(r[4]), np.array(q[4])) for q in right[t]] for r in f])
        gain = np.where(np.array([r[3] for r in f])[:, None] == np.array([q[3] for q in right[t]])[None], overlap, overlap / 1.5)
        want |= {(str(f[i][2]), str(right[t][j][2])): overlap[i, j] for i, j in assign(-gain) if overlap[i, j] > 0.1}
    out = lines.match_lines(df, pred)
    assert "InPandas" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r["gt_id"], r["pred_id"]): r["iou"] for r in out.collect()}
    assert sum(got.values()) == pytest.approx(sum(want.values())) and got == pytest.approx(want)


def slow_iou(p, q, step=0.1):
    x = np.arange(min(p[0, 0], q[0, 0]) + step / 2, max(p[-1, 0], q[-1, 0]), step)

    def band(line):
        y = np.interp(x, line[:, 0], line[:, 1], left=np.nan, right=np.nan)
        reach = np.sqrt(1 + np.nan_to_num(np.gradient(y, step) if len(x) > 1 else np.zeros_like(y)) ** 2)
        return y - reach, y + reach

    (a0, a1), (b0, b1) = band(p), band(q)
    common = np.nan_to_num(np.maximum(0, np.minimum(a1, b1) - np.maximum(a0, b0))).sum()
    total = np.nan_to_num(a1 - a0).sum() + np.nan_to_num(b1 - b0).sum() - common
    return float(common / total) if total > 0 else 0.0


def test_matched_frames_shuffle_each_side_once(spark):
    rng = np.random.default_rng(6)

    def side(first):
        rows = [(1, f * 100000, first + i, int(rng.choice([1, 2, 18])), float(rng.integers(0, 8)), float(rng.integers(0, 4)) / 2, f"{f}/{i}") for f in range(60) for i in range(rng.integers(0, 7))]
        rows.append((1, (90 + first) * 100000, first, 1, 0.0, 0.0, "alone"))
        rows.append((1, 0, first + 50, None, 1.0, None, "unknown"))
        return spark.createDataFrame(rows, "scenario_no long, frame_ts_us long, id long, type int, x double, y double, name string")

    g, p, frame = side(0), side(100), ["scenario_no", "frame_ts_us"]
    out = matching.match_frames(g, p, frame)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2
    got, pairs = out.toPandas(), matching.match_objects(g, p, overlap=None).toPandas()
    assert sorted(got.gt_name.dropna()) == sorted(g.toPandas().name) and sorted(got.pred_name.dropna()) == sorted(p.toPandas().name)
    both = got[(got.gt_flag == 1) & (got.pred_flag == 1)]
    assert len(both) == len(pairs) > 50 and (got.gt_flag + got.pred_flag).min() == 1

    def total(ids):
        d = ids.merge(g.toPandas(), left_on=[*frame, "gt_id"], right_on=[*frame, "id"]).merge(p.toPandas(), left_on=[*frame, "pred_id"], right_on=[*frame, "id"])
        d["cost"] = np.hypot(d.x_x - d.x_y, d.y_x - d.y_y) * np.where(d.type_x == d.type_y, 1.0, 1.5)
        return d.groupby("frame_ts_us").cost.sum().to_dict()

    assert total(both[[*frame, "gt_id", "pred_id"]]) == pytest.approx(total(pairs))


def test_one_shuffle_for_both_sides_of_a_match(spark):
    from drivegauge.plans import object_queries

    plan = object_queries.matched(spark, "/root/testdata/sf0.001", "type_classification")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1 and "collect_list" not in plan


@pytest.mark.parametrize("name", ["j02_match_objects", "j02_match_positions"])
def test_pairs_alone_are_found_by_one_shuffle(spark, monkeypatch, name):
    from drivegauge.plans import registry
    from drivegauge.sources import scratch

    found = registry.queries()[name]  # loads the modules that take the folder's name, before it is replaced
    monkeypatch.setattr(scratch, "scratch_dir", lambda *a: pytest.fail("stores a table"))
    plan = found(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_small_tables_are_assigned_as_large_ones(monkeypatch):
    rng = np.random.default_rng(11)
    for n, m in ((1, 2), (2, 2), (2, 3), (3, 2), (3, 3), (4, 3), (3, 4)):
        tables = np.where(rng.random((200, n, m)) < 0.6, rng.integers(0, 4, (200, n, m)) / 2 if n % 2 else rng.random((200, n, m)), 500.0)  # with ties and without
        want = [[(r, c) for r, c in assign(t) if t[r, c] < 500] for t in tables]
        asked = []
        monkeypatch.setattr(matching, "assign", lambda t: asked.append(1) or assign(t))
        assert [sorted(p) for p in matching.least_pairs(tables)] == [sorted(p) for p in want]
        assert len(asked) == 0 if n % 2 == 0 else len(asked) < 200  # without ties no table is assigned by itself


def ways(table):
    """All ways to pair rows and columns by candidates, and the sum of cost - 500 of each in the order of the rows."""
    out = [([], 0.0)]
    for r, row in enumerate(table):
        out = [(w + own, total + add) for w, total in out for own, add in [([], 0.0), *(([(r, c)], v - 500) for c, v in enumerate(row) if v < 500 and c not in [k for _, k in w])]]
    return out


@pytest.mark.parametrize(("n", "m"), [(2, 2), (3, 3), (4, 3), (3, 5), (5, 5), (7, 5)])
def test_ways_alike_but_for_rounding_are_settled_as_in_sql(n, m):
    rng, told = np.random.default_rng(14), 0
    count = 40 if n == 7 else 300
    tables = np.where(rng.random((count, n, m)) < (0.6 if n == 7 else 0.8), rng.random((count, n, 1)) + rng.choice([0.1, 0.3], (count, 1, m)), 500.0)
    i, j = np.nonzero(np.ones((n, m)))
    for table, found in zip(tables, matching.least_pairs(tables) if n < 5 else map(matching.settled, tables), strict=True):
        sums = {tuple(w): total for w, total in ways(table)}
        least = min(sums.values())
        assert sums[tuple(sorted(found))] == least
        told += sum(least < t <= least + 1e-9 for t in sums.values())
        use = table[i, j] < 500
        partner = matching.partners(np.zeros(n, int), i[use], j[use], table[i, j][use], m)
        assert sums[tuple((r, int(k)) for r, k in enumerate(partner) if k >= 0)] <= least + 1e-9  # sole pairs are not summed
    assert told > 5


def test_many_ways_alike_are_bounded():
    for n, m in ((40, 40), (40, 60), (60, 40)):
        assert len(matching.settled(np.ones((n, m)))) == 40


@pytest.mark.parametrize("at_once", [1, 5, 100_000])
def test_frames_may_cross_batches(spark, at_once):
    rng, frame = np.random.default_rng(12), ["scenario_no", "frame_ts_us"]
    side = lambda first: [(*k, first + i, 1, float(rng.integers(0, 8)), 0.0) for k in [(1, f) for f in range(40)] + [(None, 7), (2, None)] for i in range(rng.integers(1, 7))]
    schema = "scenario_no long, frame_ts_us long, id long, type int, x double, y double"
    g, p = (spark.createDataFrame(side(first), schema) for first in (0, 100))
    both = g.selectExpr("*", "false AS _pred").unionByName(p.selectExpr("*", "true AS _pred")).repartition(*frame).sortWithinPartitions(*frame)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = matching.match_rows(both, frame, ["id", "x"], ["id", "x"], at_once=at_once).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    want = {(r["frame_ts_us"], r["gt_id"], r["pred_id"]) for r in matching.match_objects(g.dropna(), p.dropna(), overlap=None).collect()}
    found = got[(got.gt_flag == 1) & (got.pred_flag == 1)]
    assert {(r.frame_ts_us, r.gt_id, r.pred_id) for r in found.itertuples()} == want and len(found) == len(want) > 30
    assert got.gt_flag.sum() == g.count() and got.pred_flag.sum() == p.count()


def test_small_keys_are_not_cut(spark, monkeypatch):
    from drivegauge.operators import scan

    rng = np.random.default_rng(7)
    rows = [(k, float(t), i) for i, (k, t) in enumerate((k, t) for k in [None, *range(60)] for t in rng.integers(0, 5000, 400 if k == 3 else rng.integers(1, 30)))]
    rows += [(5, None, len(rows)), (70, None, len(rows) + 1)]
    df = spark.createDataFrame(rows, "k int, end double, i int")
    want, kept = [], set()
    for key in {r[0] for r in rows}:
        own = sorted(((t, i) for k, t, i in rows if k == key), key=lambda p: (p[0] is not None, p))
        kept |= {i for n, (t, i) in enumerate(own) if not n or t is None or own[n - 1][0] is None or t // 100 != own[n - 1][0] // 100}
        ends = [t for t, _ in own if t is not None]
        last = ends[0] if ends else None
        for t in ends[1:]:
            if t - last >= 120:
                want.append((key, last, t))
                last = t
    order = lambda found: sorted(found, key=lambda r: (r[0] is None, r))
    minutes = df.selectExpr("*", "floor(end / 100) AS v")
    for whole in (scan.WHOLE, 100, 0):
        monkeypatch.setattr(scan, "WHOLE", whole)
        segments = scan.chain_segments(df, ["k"], "end", 120.0)
        assert order(tuple(r) for r in segments.collect()) == order(want)
        assert {r["i"] for r in scan.suppress_repeats(minutes, ["k"], "v", ["end", "i"]).collect()} == kept
        if whole == 100:  # one key is cut, in Python there is no group for each of the others
            assert {r["k"] for r in scan.dealt(df, "end", None, ["k"]).filter("_part > 0").select("k").distinct().collect()} == {3}
        if whole > 400:
            assert "InArrow" in (plan := segments._jdf.queryExecution().executedPlan().toString()) and "FlatMap" not in plan


def test_no_task_has_all_pairs_of_a_key(spark):
    from drivegauge.operators import report

    a = spark.range(300).selectExpr("id AS record", "IF(id < 290, 1, id % 4) AS day")
    b = spark.range(50).selectExpr("id AS vehicle", "IF(id < 45, 1, NULL) AS day").unionByName(spark.createDataFrame([(90, 2), (91, 9)], "vehicle long, day long"))
    out = report.all_pairs(a, b, ["day"], most=500)
    want = sorted((r["record"], r["vehicle"]) for r in a.join(b, "day").collect())
    assert sorted((r["record"], r["vehicle"]) for r in out.select("record", "vehicle").collect()) == want
    sizes = out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) < len(want) / 4


def test_no_task_has_all_overlaps_of_a_cell(spark):
    from drivegauge.operators import timeline

    a = spark.range(300).selectExpr("id", "id AS start_time", "id + 1000 AS end_time").unionByName(spark.createDataFrame([(900, 50_000, 50_010)], "id long, start_time long, end_time long"))
    b = spark.range(200).selectExpr("id", "2 * id AS start_time", "2 * id + 900 AS end_time")
    out = timeline.overlaps(a, b, 500, 10_000, side=40)
    rows = lambda d: [tuple(r) for r in d.collect()]
    want = sorted((i, j, max(s, t), min(e, f)) for i, s, e in rows(a) for j, t, f in rows(b) if min(e, f) - max(s, t) >= 500)
    assert sorted(rows(out)) == want
    sizes = out.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert max(sizes) < len(want) / 4


def test_occupancy_is_by_arrays(spark, monkeypatch):
    from drivegauge.sources import flatten

    monkeypatch.setattr(flatten, "PIECE", 7)
    monkeypatch.setattr(flatten, "CELLS_AT_ONCE", 5)
    rng = np.random.default_rng(8)
    grids = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 6, 7, 8, 40, 100)] + [None, b"\x0f" * 30, b"\xff" * 14]
    out = flatten.occupancy(spark.createDataFrame([(i, 0.5, g) for i, g in enumerate(grids)], "scenario_no long, time_stamp double, grid binary"))
    assert "transform(" not in out._jdf.queryExecution().optimizedPlan().toString()  # nothing is evaluated byte by byte
    want = {(i, k): (b >> 4, b & 15, [int(x > b & 15) for x in range(24)]) for i, g in enumerate(grids) for k, b in enumerate(g or b"") if b >= 16}
    rows = out.collect()
    assert {(r["scenario_no"], r["cell"]): (r["class"], r["low"], r["free"]) for r in rows} == want and len(rows) == len(want)
    assert all(r["n_free"] == sum(r["free"]) and r["time_stamp"] == 0.5 for r in rows)


def test_stream_join_compares_rows_of_a_cell(spark, tmp_path):
    from drivegauge.streaming import streams

    rng, day = np.random.default_rng(9), 86_400_000_000
    sides = [sorted((int(s), day + int(t) * 5_000) for s, t in set(zip(rng.integers(0, 2, 300), rng.integers(0, 4000, 300), strict=True))) for _ in range(2)]
    frames = []
    for n, (rows, name) in enumerate(zip(sides, ("gt_time", "pred_time"), strict=True)):
        spark.createDataFrame([*rows, (0, 3 * day)], "scenario_no long, us long").selectExpr("scenario_no", f"timestamp_micros(us) AS {name}").coalesce(1).write.parquet(f"{tmp_path}/{n}")
        frames.append(spark.readStream.schema(f"scenario_no long, {name} timestamp").parquet(f"{tmp_path}/{n}"))
    pairs = streams.match_frames(*frames)
    assert pairs.columns == ["scenario_no", "gt_time", "pred_time"]
    condition = next(line for line in pairs._jdf.queryExecution().analyzed().toString().splitlines() if "Join Inner" in line)
    assert condition.count(" = ") == 2  # the scenario and a stretch of time
    out = streams.drain(pairs, f"{tmp_path}/out").selectExpr("scenario_no", "unix_micros(gt_time) AS g", "unix_micros(pred_time) AS p")
    got = sorted(tuple(r) for r in out.collect() if r["g"] < 2 * day)
    assert got == sorted((s, g, p) for s, g in sides[0] for z, p in sides[1] if s == z and abs(g - p) < 50_000) and len(got) > 100


@pytest.mark.parametrize("name", ["j10_kpi_targets", "a03_yaw_stats", "j19_version_delta"])
def test_match_carries_what_is_used(spark, name):
    from drivegauge.plans import registry

    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "closest_pt" not in plan


def test_versions_are_compared_by_one_match(spark):
    from drivegauge.operators import report
    from drivegauge.plans import registry

    plan = registry.queries()["j19_version_delta"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    rows = [("a", "v1", 1.0), ("a", "v2", 3.0), ("b", "v2", 2.0), ("c", "v1", 5.0), (None, "v1", 1.0), (None, "v2", 2.0), ("a", "v3", 9.0)]
    df, cell = spark.createDataFrame(rows, "kind string, version string, value double"), ["kind"]
    want = report.version_delta(df.filter("version = 'v2'"), df.filter("version = 'v1'"), cell).select("kind", "value", "old_value", "delta")
    got = report.version_delta_at_once(df, cell, "version", "v2", "v1").select("kind", "value", "old_value", "delta")
    assert set(map(tuple, got.collect())) == set(map(tuple, want.collect())) == {("a", 3.0, 1.0, 2.0), ("b", 2.0, None, None), (None, 2.0, None, None)}


@pytest.mark.parametrize("name", ["a18_pass_totals", "j10_kpi_targets", "a07_statistics_cube"])
def test_lines_are_read_once(spark, name):
    from drivegauge.plans import registry

    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and plan.count("MapInArrow") == 1


def test_quantiles_write_no_values_again(spark, monkeypatch):
    from drivegauge.operators import quantiles, statistics

    written = []
    for module in (quantiles, statistics):
        monkeypatch.setattr(module, "stored", lambda df, label, f=module.stored: written.append((label, (out := f(df, label)).count())) or out)
    values = np.random.default_rng(13).normal(size=4000)
    df = spark.createDataFrame([("a" if i % 4 else None, float(v)) for i, v in enumerate(values)], "class string, e double")
    got = {r["class"]: r for r in statistics.error_stats(df, ["class"], ["e"], bins=50, limit=20).collect()}
    for key, own in (("a", np.delete(values, np.s_[::4])), (None, values[::4])):
        assert [got[key][f"e_abs_q{q}"] for q in (68, 95)] == pytest.approx([np.quantile(np.abs(own), q / 100) for q in (68, 95)], abs=1e-6)
    assert dict(written)["errors"] == 4000 and sum(n for label, n in written if label != "errors") < 1000
