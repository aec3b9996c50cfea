"""Structured Streaming forms of flattening, rates, id carry and frame matching."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from drivegauge.operators.lines import carry_ids


def distinct_stamps(stream: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """Each (scenario, topic, stamp) once within the watermark. The batch form drops adjacent repeats only."""
    return stream.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["scenario_no", "topic", "event_time"])


def topic_counts(stream: DataFrame, width: str = "10 seconds", delay: str = "10 seconds") -> DataFrame:
    """Messages per topic and window; late rows count until the watermark passes."""
    w = F.window("event_time", width)
    return stream.withWatermark("event_time", delay).groupBy(w.alias("w"), "topic").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "topic", "n")


def rate_alerts(stream: DataFrame, targets: dict[str, float], width_s: int = 10, slack: float = 1.0) -> DataFrame:
    """Windows in which a camera's rate is more than ``slack`` off its target."""
    known = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])
    rated = topic_counts(stream, f"{width_s} seconds").withColumn("hz", F.col("n") / width_s)
    return rated.filter(F.abs(F.col("hz") - F.element_at(known, F.col("topic"))) > slack)


class TrackCarry(StatefulProcessor):
    """Track numbers of one scenario's lines. State: a row per line of the last frame (its raw ids, its number), the next
    number, and the last frame's stamp. A timer clears all of it where no frame comes for ``silence_ms`` of event time;
    a scenario that comes back begins at 1."""

    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tracks = handle.getListState("tracks", "raw array<string>, number long")
        self.place = handle.getValueState("place", "following long, at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        following, at = self.place.get() if self.place.exists() else (1, -1)
        known = [(set(raw), int(number)) for raw, number in self.tracks.get()] if self.place.exists() else []
        pdf = pd.concat(list(rows)).sort_values(["frame_ts_us", "origin_id"])
        pdf = pdf[pdf.frame_ts_us > at]  # a frame behind the last one can no longer be placed
        if not len(pdf):
            return
        numbers, known, following = carry_ids([list(f.origin_id) for _, f in pdf.groupby("frame_ts_us")], known, following)
        self.tracks.put([(sorted(raw), int(number)) for raw, number in known])
        self.place.update((following, int(pdf.frame_ts_us.max())))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(pdf.event_time.max().timestamp() * 1000) + self.silence_ms)
        yield pdf.assign(scenario_no=key[0], id=[n for f in numbers for n in f])[["scenario_no", "frame_ts_us", "origin_id", "id"]]

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.tracks.clear()
        self.place.clear()
        yield pd.DataFrame({k: pd.Series(dtype=t) for k, t in (("scenario_no", "int64"), ("frame_ts_us", "int64"), ("origin_id", "object"), ("id", "int64"))})

    def close(self) -> None:
        pass


def carry_track_ids(stream: DataFrame, silence: int = 60_000, delay: str = "10 seconds") -> DataFrame:
    """Track numbers of lines (scenario_no, frame_ts_us, origin_id) across frames; the state of a scenario that is silent
    for ``silence`` milliseconds of event time (``event_time``, or else the frame's stamp) goes.

    Typed state needs a state store with column families, so the session is set to the one that comes with Spark;
    streams that began with another keep theirs, which their checkpoint names.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    timed = stream if "event_time" in stream.columns else stream.withColumn("event_time", F.timestamp_micros("frame_ts_us"))
    lines = timed.withWatermark("event_time", delay).select("scenario_no", "frame_ts_us", "origin_id", "event_time")
    return lines.groupBy("scenario_no").transformWithStateInPandas(TrackCarry(silence), "scenario_no long, frame_ts_us long, origin_id string, id long", "append", "EventTime")


def match_frames(gt: DataFrame, pred: DataFrame, tolerance: str = "50 milliseconds", delay: str = "5 seconds") -> DataFrame:
    """Stream-stream join of stamps of one scenario less than the tolerance apart; state is bounded by both watermarks.

    Rows meet in cells of ten tolerances: truth stands in its own, a prediction in one or, near an edge, in two. So a row
    is compared with the few of its cell, not with all that the state holds of its scenario."""
    reach = F.expr(f"INTERVAL {tolerance}")
    width = 10 * F.unix_micros(F.timestamp_micros(F.lit(0)) + reach)
    cell = lambda t: F.floor(F.unix_micros(t) / width)
    a = gt.withWatermark("gt_time", delay).withColumn("_cell", cell(F.col("gt_time")))
    b = pred.withWatermark("pred_time", delay).withColumnRenamed("scenario_no", "pred_scenario")
    b = b.withColumn("_pred_cell", F.explode(F.sequence(cell(F.col("pred_time") - reach), cell(F.col("pred_time") + reach))))
    near = F.expr(f"pred_scenario = scenario_no AND _pred_cell = _cell AND pred_time > gt_time - INTERVAL {tolerance} AND pred_time < gt_time + INTERVAL {tolerance}")
    return a.join(b, near).drop("pred_scenario", "_cell", "_pred_cell")


def nearest_frames(gt: DataFrame, pred: DataFrame, tolerance: str = "50 milliseconds", delay: str = "5 seconds") -> DataFrame:
    """Of the stamps that ``match_frames`` finds for a truth frame the nearest, the earlier of two equally near."""
    pairs = match_frames(gt, pred, tolerance, delay)
    at = F.unix_micros("pred_time")
    near = F.min(F.struct(F.abs(at - F.unix_micros("gt_time")).alias("gap"), at.alias("pred_us")))
    return pairs.groupBy("scenario_no", "gt_time").agg(near.alias("n")).select("scenario_no", "gt_time", "n.pred_us", "n.gap")


def drain(stream: DataFrame, path: str) -> DataFrame:
    """Runs an append stream over all that its source holds, into files below ``path``, and reads these."""
    out = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    out.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")
