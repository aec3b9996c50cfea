"""Streams over the given tables: written to the shared folder, read as a stream until its source is empty.

A closing mark far behind the last row lets the watermark pass all windows; it stays in the stream's state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivegauge.sources.scratch import scratch_dir
from drivegauge.streaming import streams as sm

from .fixtures import SQL, gt_obj, pred_obj, table
from .registry import query
from .report_queries import CARRIED, lines

c = F.col
#: The first frame is at 0, which a watermark that begins there would call late.
DAY = 86_400_000_000


def as_stream(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def closed(df: DataFrame, at: str, days: int = 2) -> DataFrame:
    """With one row more, days behind all others. Its keys are not null, or a filter below the watermark would drop it."""
    later = {k: F.max(k) + F.make_dt_interval(F.lit(days)) if k == at else F.max(k) for k in df.columns}
    return df.unionByName(df.agg(*[v.alias(k) for k, v in later.items()]))


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(c("user_id").alias("scenario_no"), c("event_type").alias("topic"), c("ts").cast("timestamp").alias("event_time"))


@query("SELECT DISTINCT user_id AS scenario_no, event_type AS topic, epoch_us(ts) AS us FROM events")
def w01_stream_repeats(spark, sf_dir):
    """All events sent twice; each stamp stays once."""
    e = _events(spark, sf_dir)
    out = sm.drain(sm.distinct_stamps(as_stream(e.unionByName(e), "sent")), scratch_dir(spark, "w01"))
    return out.select("scenario_no", "topic", F.unix_micros("event_time").alias("us"))


@query("SELECT epoch_us(date_trunc('day', ts)) AS start_us, event_type AS topic, count(*) AS n FROM events GROUP BY 1, 2")
def w02_stream_counts(spark, sf_dir):
    e = closed(_events(spark, sf_dir), "event_time")
    out = sm.drain(sm.topic_counts(as_stream(e, "events"), "1 day", "1 hour"), scratch_dir(spark, "w02"))
    return out.select(F.unix_micros("start").alias("start_us"), "topic", "n")


@query("SELECT epoch_us(date_trunc('day', ts)) AS start_us, event_type AS topic, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2 HAVING abs(count(*) / 86400.0E0 - CASE event_type WHEN 'view' THEN 0.0005E0 ELSE 0.001E0 END) > 0.0002E0")
def w02_stream_alerts(spark, sf_dir):
    e = closed(_events(spark, sf_dir), "event_time")
    out = sm.drain(sm.rate_alerts(as_stream(e, "events"), {"view": 0.0005, "click": 0.001}, 86400, 0.0002), scratch_dir(spark, "w02"))
    return out.select(F.unix_micros("start").alias("start_us"), "topic", "n")


@query(CARRIED)
def w03_stream_carry(spark, sf_dir):
    """Track numbers over a stream of lines; tests compare them with the batch form."""
    rows = lines(spark, sf_dir).select("scenario_no", "frame_ts_us", (c("id") % 5).cast("string").alias("origin_id"), F.timestamp_micros(c("frame_ts_us") + DAY).alias("event_time"))
    return sm.drain(sm.carry_track_ids(as_stream(rows, "lines")), scratch_dir(spark, "w03"))


_LATE = "frame_ts_us - 13000 + ((frame_ts_us - 13000) // 100000 % 7) * 9000"


@query(SQL + f"""g AS (SELECT DISTINCT scenario_no, frame_ts_us AS a FROM gt), p AS (SELECT DISTINCT scenario_no, {_LATE} AS b FROM pred),
k AS (SELECT scenario_no, a, b, abs(b - a) AS gap, row_number() OVER (PARTITION BY scenario_no, a ORDER BY abs(b - a), b) AS r FROM g JOIN p USING (scenario_no) WHERE abs(b - a) < 50000) SELECT scenario_no, a AS gt_us, b AS pred_us, gap FROM k WHERE r = 1""")
def w04_stream_match(spark, sf_dir):
    """Truth frames with the nearest prediction frame, as two joined streams."""
    stamp = lambda df, us, name: closed(df.select("scenario_no", F.timestamp_micros(us + DAY).alias(name)).distinct(), name)
    at = c("frame_ts_us") - 13000
    g = stamp(gt_obj(spark, sf_dir), c("frame_ts_us"), "gt_time")
    p = stamp(pred_obj(spark, sf_dir), at + F.floor(at / 100000) % 7 * 9000, "pred_time")
    out = sm.drain(sm.nearest_frames(as_stream(g, "truth"), as_stream(p, "predictions")), scratch_dir(spark, "w04"))
    return out.select("scenario_no", (F.unix_micros("gt_time") - DAY).alias("gt_us"), (c("pred_us") - DAY).alias("pred_us"), "gap")
