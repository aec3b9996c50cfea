"""Evaluator drivers, stores and global orders: cases beyond the SQL comparison."""

import pytest
from pyspark.sql import functions as F

from drivegauge.functions import expressions as ex
from drivegauge.operators import evaluate, report
from drivegauge.plans import registry
from drivegauge.sources import readers

SF = "/root/testdata/sf0.001"
SLOT = "gt_flag int, pred_flag int, gt_type_classification string, pred_type_classification string, gt_region int, gt_slot_length double, pred_slot_length double"


def test_metrics_by_name(spark):
    rows = [(1, 1, "vertical", "vertical", 1, 5.0, 5.5), (1, 1, "vertical", "parallel", 1, 5.0, 5.1), (1, 0, "vertical", None, 1, 5.0, None), (0, 1, None, "unknown", None, None, 5.0), (1, 1, "vertical", "vertical", 0, 5.0, 5.0)]
    out = evaluate.evaluate(spark.createDataFrame(rows, SLOT), "slots", ["gt_flag", "pred_flag"], ["recall_precision", "slot_length_error"]).collect()
    assert sorted(r["outcome"] for r in out if r["outcome"]) == ["FN", "TP", "TP"]  # no unknown class, no region 0
    assert sorted((round(r["value"], 6), r["abnormal"]) for r in out if r["metric"] == "slot_length_error") == [(0.1, 0), (0.5, 1)]
    assert evaluate.evaluate(spark.createDataFrame([], SLOT), "slots", [], ["slot_length_error"]).count() == 0


def test_unknown_metric(spark):
    with pytest.raises(ValueError, match="no_such"):
        evaluate.evaluate(spark.createDataFrame([], SLOT), "slots", [], ["no_such"])


def test_numbered_ties_and_empty(spark):
    df = spark.createDataFrame([(k % 3,) for k in range(50)], "k long").repartition(7)
    out = report.numbered(df, ["k"]).orderBy("position").collect()
    assert [r["position"] for r in out] == list(range(1, 51)) and [r["k"] for r in out] == sorted(k % 3 for k in range(50))
    assert report.numbered(df.limit(0), ["k"]).count() == 0


def test_store_takes_a_key_once(spark, tmp_path):
    path, df = str(tmp_path / "store"), spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "uuid string, v int")
    df.limit(0).write.parquet(path)
    for _ in range(2):
        readers.append_new(df, path, "uuid")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 2)]


def test_light_of_odd_names(spark):
    df = spark.createDataFrame([("20240621_120000_n001",), ("20241221_230000_n001",), ("20240101_070000_n001",), ("junk",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(ex.day_part(F.col("s"))).collect()] == ["morning", "night", "dawn", None, None, None]


def test_stream_of_lines_equals_batch(spark):
    stream, batch = (registry.queries()[n](spark, SF) for n in ("w03_stream_carry", "q06_carry_track_id"))
    key = ["scenario_no", "frame_ts_us", "origin_id", "id"]
    assert sorted(map(tuple, stream.select(key).collect())) == sorted(map(tuple, batch.select(key).collect()))
