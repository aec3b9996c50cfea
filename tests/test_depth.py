"""Cameras, nested rewrites, typed stream state, concurrent stores, ordered passes, quantiles, shifts and levels against brute force."""

import json
import math
import random
import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from drivegauge.functions import cameras, nested
from drivegauge.operators import quantiles, report, scan, timeline
from drivegauge.sources.scratch import scratch_dir
from drivegauge.sources.store import ResultStore
from drivegauge.streaming import streams

EYE = [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0]
K = [1000.0, 3.0, 500.0, 0.0, 1000.0, 400.0, 0.0, 0.0, 1.0]


def test_projection_in_closed_form(spark):
    """Points whose pixels follow by hand: on the axis, without distortion, and at 45 degrees through each model."""
    rows = [("pin", "pinhole", [0.1], None), ("plain", "pinhole", [], None), ("fish", "fisheye", [0.5, 0.0, 0.0, 0.0], None), ("mirror", "omni", [], 1.0), ("what", "other", [], None)]
    cams = spark.createDataFrame([(n, m, 1000, 800, K, EYE, d, x) for n, m, d, x in rows], "cam string, model string, width int, height int, intrinsic array<double>, extrinsic array<double>, distort array<double>, xi double")
    t = math.atan(0.25)
    points = [(n, i, *p) for n in ("pin", "plain", "fish", "mirror", "what", "none") for i, p in enumerate([(0.0, 0.0, 2.0), (0.5, 0.0, 2.0), (0.0, 0.0, -2.0), (5.0, 0.0, 2.0), (None, 0.0, 1.0)])]
    got = {(r["cam"], r["i"]): (r["u"], r["v"]) for r in cameras.project(spark.createDataFrame(points, "cam string, i int, x double, y double, z double"), cams, "cam").collect()}
    norm = math.sqrt(0.25 + 4)
    want = {(n, 0): (500, 400) for n in ("pin", "plain", "fish", "mirror")}
    want |= {("plain", 1): (750, 400), ("pin", 1): (round(500 + 1000 * 0.25 * (1 + 0.1 * 0.0625)), 400), ("fish", 1): (round(500 + 1000 * t * (1 + 0.5 * t * t)), 400), ("mirror", 1): (round(500 + 1000 * (0.5 / norm) / (2 / norm + 1)), 400)}
    want |= {("mirror", 3): (round(500 + 1000 * 5 / (2 + math.sqrt(29))), 400)} if 20 < 500 + 1000 * 5 / (2 + math.sqrt(29)) < 980 else {}
    assert got == want


def test_nested_rewrites(spark):
    df = spark.createDataFrame(
        [(1, ({"keyOne": [("/a/x", 1, "p"), None]}, [["/a/y", "b", None]], "s"), "/a"), (2, None, None)],
        "rowId int, bigPart struct<mapOfLists: map<string, array<struct<filePath: string, numOf: int, _raw: string>>>, listOfLists: array<array<string>>, _hidden: string>, _private string",
    )
    one = lambda d: json.loads(d.toJSON().collect()[0])
    snake = one(nested.snake_keys(df))
    assert snake == {"row_id": 1, "big_part": {"map_of_lists": {"key_one": [{"file_path": "/a/x", "num_of": 1, "_raw": "p"}, None]}, "list_of_lists": [["/a/y", "b", None]], "_hidden": "s"}, "_private": "/a"}
    assert one(nested.without_private(df)) == {"rowId": 1, "bigPart": {"mapOfLists": {"keyOne": [{"filePath": "/a/x", "numOf": 1}, None]}, "listOfLists": [["/a/y", "b", None]]}}
    moved = one(nested.remap_paths(df, "/a", "/new"))
    assert moved["bigPart"]["mapOfLists"]["keyOne"][0]["filePath"] == "/new/x" and moved["bigPart"]["listOfLists"] == [["/new/y", "b", None]] and moved["_private"] == "/new"
    assert [r["message"] for r in nested.message_json(df, ["rowId"]).orderBy("rowId").collect()][1] == "{}"
    assert nested.snake_keys(df).filter("big_part IS NULL").count() == 1
    assert nested.snake_name("CameraID") == "camera_id" and nested.snake_name("HTTPServerName2X") == "http_server_name2_x"


def test_nested_rollup(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("a", "y", 2), ("b", None, 1), (None, "x", 3)], "p string, q string, r int")
    got = {r["value"]: r.asDict(True) for r in report.nested_rollup(df, ["p", "q", "r"]).collect()}
    assert got["a"] == {"value": "a", "n": 3, "children": [{"value": "x", "n": 2, "children": [{"value": 1, "n": 2}]}, {"value": "y", "n": 1, "children": [{"value": 2, "n": 1}]}]}
    assert got["b"]["children"] == [{"value": None, "n": 1, "children": [{"value": 1, "n": 1}]}] and got[None]["n"] == 1
    assert {(r["level"], r["value"]): r["n"] for r in report.distinct_values(df, ["p", "r"]).collect()} == {("p", "a"): 3, ("p", "b"): 1, ("p", None): 1, ("r", "1"): 3, ("r", "2"): 1, ("r", "3"): 1}


def test_silent_scenario_is_forgotten(spark, tmp_path):
    """A scenario without frames for longer than the silence begins anew; one that goes on keeps its numbers."""
    schema = "scenario_no long, frame_ts_us long, origin_id string"
    second = 1_000_000
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    steps = [[(1, 1, "a"), (1, 2, "a"), (1, 2, "b"), (2, 1, "a"), (2, 1, "z")], [(2, 50, "a")], [(2, 100, "a"), (2, 100, "k")], [(2, 150, "k")], [(1, 200, "b"), (2, 200, "k")]]
    for i, rows in enumerate(steps):
        spark.createDataFrame([(s, t * second, o) for s, t, o in rows], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
        out = streams.carry_track_ids(spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in")), silence=60_000, delay="1 second")
        query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = {(r["scenario_no"], r["frame_ts_us"] // second, r["origin_id"]): r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, 1, "a"): 1, (1, 2, "a"): 1, (1, 2, "b"): 2, (2, 1, "a"): 1, (2, 1, "z"): 2, (2, 50, "a"): 1, (2, 100, "a"): 1, (2, 100, "k"): 3, (2, 150, "k"): 3, (1, 200, "b"): 1, (2, 200, "k"): 3}


def test_store_with_two_writers(spark, monkeypatch):
    """Two sessions insert rows of the same keys at once; each key stays once, with the rows of one insert."""
    path, schema = scratch_dir(spark, "store"), "uuid string, origin string"
    sessions = [spark.newSession(), spark.newSession()]
    meet = threading.Barrier(2, timeout=60)
    first = [True, True]

    def insert(k):
        store = ResultStore(sessions[k], path, "uuid", schema)
        versions = store.versions

        def both(after=0):  # both have read the log before either commits
            found = versions(after)
            if first[k]:
                first[k] = False
                meet.wait()
            return found

        store.versions = both
        rows = [(f"k{i}", f"w{k}") for i in range(k * 3, k * 3 + 8)] + [(None, "none"), ("k4", f"w{k}x")]
        store.insert(sessions[k].createDataFrame(rows, schema), ["origin"])

    threads = [threading.Thread(target=insert, args=(k,)) for k in (0, 1)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(180)
    store = ResultStore(spark, path, "uuid", schema)
    got = store.read().collect()
    assert len(got) == len({r["uuid"] for r in got}) == 11 and [v for v, _ in store.versions()] == [1, 2]
    owner = {r["uuid"]: r["origin"] for r in got}
    assert {owner[f"k{i}"] for i in range(3)} == {"w0"} and {owner[f"k{i}"] for i in range(8, 11)} == {"w1"} and len({owner[f"k{i}"] for i in range(3, 8)}) == 1
    assert store.read(1).count() == 8 and store.insert(spark.createDataFrame([("k1", "late")], schema)) == 3 and store.read().count() == 11
    monkeypatch.undo()


def series(seed, n=400):
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), round(rng.random() * 1000, 1), i, rng.randrange(6)) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_ordered_passes(spark, parts):
    rows = series(parts)
    df = spark.createDataFrame(rows, "k string, t double, i long, v long").repartition(5)
    by = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    kept = {r[2] for s in by.values() for j, r in enumerate(s) if j == 0 or s[j - 1][3] != r[3]}
    assert {r["i"] for r in scan.suppress_repeats(df, ["k"], "v", ["t", "i"], parts).collect()} == kept
    run = set()
    for s in by.values():
        cut = max([j for j in range(1, len(s)) if s[j][3] <= s[j - 1][3]], default=0)
        run |= {r[2] for r in s[cut:]}
    assert {r["i"] for r in scan.last_monotone_run(df, ["k"], "v", ["t", "i"], parts).collect()} == run
    for least in (0.0, 40.0) if parts > 1 else (3.0,):
        want = []
        for k, s in by.items():
            last = s[0][1]
            for r in s[1:]:
                if r[1] - last >= least:
                    want.append((k, last, r[1]))
                    last = r[1]
        got = [tuple(r) for r in scan.chain_segments(df, ["k"], "t", least, parts).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), least


def test_no_part_is_a_whole_series(spark):
    """A key with most rows is spread over the parts."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise("other").alias("k"), F.col("id").alias("t"))
    sizes = [r["count"] for r in scan.dealt(df, "t", 20).groupBy("k", "_part").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 1200


@pytest.mark.parametrize("sizes", [{}, {"bins": 12, "limit": 8}])
def test_exact_quantiles(spark, sizes):
    rng = random.Random(4)
    rows = [(k, v) for k, vs in {"a": [rng.gauss(0, 1) for _ in range(300)], "b": [7.0] * 50, "c": [1.0, 2.0], None: [rng.choice([1.0, 5.0, 1e9]) for _ in range(101)], "d": [None, float("nan")]}.items() for v in vs]
    at = {"q0": 0.0, "q50": 0.5, "q68": 0.68, "q1": 1.0}
    got = {r["k"]: r for r in quantiles.exact_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", at, **sizes).collect()}
    assert set(got) == {"a", "b", "c", None}
    for k, r in got.items():
        values = [v for j, v in rows if j == k]
        for name, p in at.items():
            assert math.isclose(r[name], np.quantile(values, p), rel_tol=1e-12), (k, name)


def test_best_shift_equals_the_loop():
    import time

    rng = np.random.default_rng(6)
    for _ in range(60):
        v1, v2 = rng.normal(50, 3, rng.integers(0, 80)), rng.normal(50, 3, rng.integers(0, 80))
        least, best = int(rng.integers(0, 30)), None
        for s in range(max(least, 1) - len(v2), len(v1) - max(least, 1) + 1):
            a, b = max(s, 0), min(len(v1), len(v2) + s)
            if b - a >= max(least, 1):
                e = float(np.sqrt(np.mean((v1[a:b] - v2[a - s : b - s]) ** 2)))
                if best is None or e < best[1]:
                    best = (s, e, b - a)
        got = timeline.best_shift(v1, v2, least)
        assert (got is None) == (best is None) and (best is None or (got[0], got[2]) == (best[0], best[2]) and math.isclose(got[1], best[1], abs_tol=1e-9))
    whole = rng.normal(0, 1, 60_000)
    took = time.perf_counter()
    assert timeline.best_shift(whole[1234:], whole, 9000)[0] == -1234
    assert timeline.best_shift(np.full(60_000, 3.0), np.full(60_000, 3.0), 9000)[1] == 0
    assert time.perf_counter() - took < 2


def test_overlaps_of_all_lengths(spark):
    rng = random.Random(9)
    make = lambda n: [(i, s, s + rng.choice([0, 1, 5, 300, 100_000])) for i in range(n) for s in [rng.randrange(100_000)]] + [(n, 0, 200_000), (n + 1, 5, 5)]
    a, b = make(150), make(120)
    want = sorted((i, j, max(s, t), min(e, f)) for i, s, e in a for j, t, f in b if s < f and t < e and min(e, f) - max(s, t) >= 1)
    frame = lambda rows: spark.createDataFrame(rows, "id long, start_time long, end_time long")
    assert sorted(tuple(r) for r in timeline.overlaps(frame(a), frame(b), 1, 10).collect()) == want
    keyed = timeline.overlaps(frame(a).withColumn("u", F.col("id") % 3), frame(b).withColumn("u", F.col("id") % 3), 1, 10, ("u",))
    assert sorted(tuple(r)[1:] for r in keyed.collect()) == [w for w in want if w[0] % 3 == w[1] % 3]
    assert pd.DataFrame(want).shape[1] == 4
