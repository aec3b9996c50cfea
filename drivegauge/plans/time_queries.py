"""Queries over streams of stamps, intervals and recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivegauge.functions import expressions as ex
from drivegauge.operators import timeline as tl
from drivegauge.sources import readers as rd

from .fixtures import table
from .registry import query

c = F.col
US = "epoch_us(ts)"
EV = f"WITH e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us, epoch_us(ts) + (event_id % 5) * 1000 AS local_us FROM events) "


def messages(spark, sf_dir) -> DataFrame:
    """Events as messages: stamp and local clock in microseconds."""
    us = F.unix_micros(c("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", us.alias("us"), (us + F.pmod("event_id", F.lit(5)) * 1000).alias("local_us"))


@query(EV + "SELECT event_id, user_id FROM (SELECT *, lag(us // 60000000) OVER (PARTITION BY event_type ORDER BY us, event_id) AS p FROM e) WHERE p IS NULL OR p <> us // 60000000")
def t00_suppress_repeats(spark, sf_dir):
    m = messages(spark, sf_dir).withColumn("minute", F.floor(c("us") / 60000000))
    return tl.suppress_repeats(m, ["event_type"], "minute", ["us", "event_id"]).select("event_id", "user_id")


@query(EV + ", k AS (SELECT *, row_number() OVER (PARTITION BY user_id, us // 3600000000 ORDER BY local_us) AS r FROM e) SELECT user_id, event_id FROM k WHERE r = 1")
def s03_frames(spark, sf_dir):
    m = messages(spark, sf_dir).withColumn("hour", F.floor(c("us") / 3600000000))
    return rd.frames(m, ["user_id"], "hour", "local_us").select("user_id", "event_id")


@query(EV + """, a AS (SELECT user_id, us, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY us) AS r FROM e WHERE event_type = 'view' AND user_id % 3 <> 0),
b AS (SELECT user_id, us, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY us) AS r FROM e WHERE event_type = 'click'),
x AS (SELECT * FROM a WHERE r > 3) SELECT user_id, us, v AS ego_vx FROM x UNION ALL SELECT user_id, us, v FROM b WHERE r > 3 AND user_id NOT IN (SELECT user_id FROM x)""")
def s04_ego_speed(spark, sf_dir):
    m = messages(spark, sf_dir).withColumnRenamed("value", "ego_vx")
    return rd.ego_speed(m.filter("event_type = 'view' AND user_id % 3 <> 0"), m.filter("event_type = 'click'"), ["user_id"], "us", 3)


@query(EV + """, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type, us ORDER BY local_us) AS k FROM e) WHERE k = 1), n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY us, local_us) AS r, count(*) OVER (PARTITION BY event_type) AS al FROM f),
s AS (SELECT event_type, count(*) AS m, (max(us) - min(us)) / 1e6 AS span, any_value(al) AS al FROM n WHERE al <= 20 OR r > 10 GROUP BY 1), t AS (SELECT event_type, count(*) AS messages, (max(local_us) - min(local_us)) / 1e6 AS ls FROM e GROUP BY 1)
SELECT event_type, messages, al AS distinct_stamps, round(CASE WHEN al <= 20 THEN 0 WHEN span > 10 THEN (m - 1) / span ELSE (messages - 1) / ls END, 6) AS hz FROM s JOIN t USING (event_type)""")
def q10_topic_rate(spark, sf_dir):
    m = messages(spark, sf_dir).withColumns({"stamp": c("us") / 1e6, "local": c("local_us") / 1e6})
    return tl.topic_rate(m, "event_type", "stamp", "local")


@query(EV + """, g AS (SELECT user_id, us, us - lag(us) OVER (PARTITION BY user_id ORDER BY us) AS gap FROM e), l AS (SELECT user_id, greatest(median(gap) + 5 * stddev_samp(gap), 2.5 * median(gap)) AS lim FROM g WHERE gap IS NOT NULL GROUP BY 1)
SELECT user_id, us, gap FROM g JOIN l USING (user_id) WHERE gap > lim""")
def q11_gap_outliers(spark, sf_dir):
    return tl.gap_outliers(messages(spark, sf_dir), ["user_id"], "us").select("user_id", "us", "gap")


@query(EV + """, d AS (SELECT user_id, us, local_us, local_us - lag(local_us) OVER (PARTITION BY user_id ORDER BY value, event_id) AS d, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS n, event_id FROM e),
k AS (SELECT *, coalesce(max(CASE WHEN d <= 0 THEN n END) OVER (PARTITION BY user_id), 1) AS cut FROM d) SELECT user_id, event_id FROM k WHERE n >= cut""")
def f14_last_monotone_run(spark, sf_dir):
    return tl.last_monotone_run(messages(spark, sf_dir), ["user_id"], "local_us", ["value", "event_id"]).select("user_id", "event_id")


@query(EV + "SELECT event_id FROM e WHERE us > 1704500000000000 AND event_type IN ('view', 'click') AND us > 1704100000000000 AND us <= 1706000000000000")
def f12_clip_filter(spark, sf_dir):
    m = messages(spark, sf_dir)
    return m.filter((c("us") > 1704500000000000) & c("event_type").isin("view", "click") & (c("us") > 1704100000000000) & (c("us") <= 1706000000000000)).select("event_id")


@query(EV + """, p AS (SELECT user_id, us, max(CASE WHEN event_type = 'view' THEN value END) AS view, max(CASE WHEN event_type = 'click' THEN value END) AS click FROM e GROUP BY 1, 2)
SELECT user_id, us, coalesce(last_value(view IGNORE NULLS) OVER w, 0) AS view, coalesce(last_value(click IGNORE NULLS) OVER w, 0) AS click FROM p WINDOW w AS (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING)""")
def q13_forward_fill(spark, sf_dir):
    wide = messages(spark, sf_dir).groupBy("user_id", "us").pivot("event_type", ["view", "click"]).agg(F.max("value"))
    return tl.forward_fill(wide, ["user_id"], "us", ["view", "click"])


@query(EV + """, r AS (SELECT user_id, min(us) AS o, max(us) AS z FROM e GROUP BY 1), g AS (SELECT user_id, unnest(generate_series(o, z, 3600000000)) AS grid FROM r)
SELECT g.user_id, grid, value FROM g ASOF JOIN e ON g.user_id = e.user_id AND g.grid >= e.us""")
def j15_resample(spark, sf_dir):
    return tl.resample(messages(spark, sf_dir), ["user_id"], "us", "value", 3600000000)


@query(EV + "SELECT event_id, us, event_type FROM e WHERE event_type IN ('view', 'error') AND us BETWEEN 1704200000000000 AND 1704900000000000")
def q14_bag_merge(spark, sf_dir):
    m = messages(spark, sf_dir).select("event_id", "us", "event_type")
    return tl.merge_topics([m.filter("event_type = 'view'"), m.filter("event_type = 'error'")], "us", 1704200000000000, 1704900000000000)


@query("SELECT event_type AS topic, count(DISTINCT event_id % 2) AS types FROM events WHERE event_type <> 'view' OR event_id % 2 = 0 GROUP BY 1 HAVING count(DISTINCT event_id % 2) > 1")
def q14_type_conflicts(spark, sf_dir):
    m = table(spark, sf_dir, "events").filter("event_type <> 'view' OR event_id % 2 = 0").select(c("event_type").alias("topic"), (c("event_id") % 2).alias("kind"))
    return tl.type_conflicts(m, "topic", "kind")


@query("""WITH RECURSIVE o AS (SELECT user_id, epoch_us(ts) / 1e6 AS e, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events),
f(user_id, n, prev, s, e) AS (SELECT user_id, n, e, NULL::DOUBLE, NULL::DOUBLE FROM o WHERE n = 1 UNION ALL
SELECT o.user_id, o.n, CASE WHEN o.e - f.prev >= 7200 THEN o.e ELSE f.prev END, CASE WHEN o.e - f.prev >= 7200 THEN f.prev END, CASE WHEN o.e - f.prev >= 7200 THEN o.e END FROM f JOIN o ON o.user_id = f.user_id AND o.n = f.n + 1)
SELECT user_id, round(s, 6) AS start_time, round(e, 6) AS end_time FROM f WHERE s IS NOT NULL""")
def q15_chain_segments(spark, sf_dir):
    m = messages(spark, sf_dir).select("user_id", (c("us") / 1e6).alias("end"))
    return tl.chain_segments(m, ["user_id"], "end", 7200.0).select("user_id", F.round("start_time", 6).alias("start_time"), F.round("end_time", 6).alias("end_time"))


SEG = EV + ", a AS (SELECT user_id AS id, us // 86400000000 AS d, min(us) AS s, max(us) AS e FROM e WHERE event_type IN ('view', 'click') GROUP BY 1, 2), b AS (SELECT user_id AS id, us // 86400000000 AS d, min(us) AS s, max(us) AS e FROM e WHERE event_type IN ('error', 'signup') AND user_id % 10 = 0 GROUP BY 1, 2) "


def _segments(spark, sf_dir, types, where="true") -> DataFrame:
    m = messages(spark, sf_dir).filter(c("event_type").isin(*types)).filter(where)
    return m.groupBy(c("user_id").alias("id"), F.floor(c("us") / 86400000000).alias("d")).agg(F.min("us").alias("start_time"), F.max("us").alias("end_time"))


SEG_ALL = SEG.replace(" AND user_id % 10 = 0", "")


@query(SEG_ALL + "SELECT a.id AS a_id, b.id AS b_id, greatest(a.s, b.s) AS start_time, least(a.e, b.e) AS end_time FROM a JOIN b ON a.s < b.e AND b.s < a.e WHERE least(a.e, b.e) - greatest(a.s, b.s) >= 30000000000")
def j12_overlaps_all(spark, sf_dir):
    """Common times of the segments of all users."""
    return tl.overlaps(_segments(spark, sf_dir, ["view", "click"]), _segments(spark, sf_dir, ["error", "signup"]), 30000000000, 21600000000)


@query(SEG_ALL + "SELECT DISTINCT id, s AS start_time FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.s < b.e AND b.s < a.e AND least(a.e, b.e) - greatest(a.s, b.s) >= 30000000000 AND a.id = b.id)")
def j12_without_overlap_all(spark, sf_dir):
    """Segments that none of the user's others overlaps."""
    a, b = _segments(spark, sf_dir, ["view", "click"]), _segments(spark, sf_dir, ["error", "signup"])
    return tl.without_overlap(a, b, 30000000000).select("id", "start_time").distinct()


@query(SEG + "SELECT a.id, e.event_id FROM a JOIN e ON a.id = e.user_id AND e.us > a.s AND e.us < a.e AND e.event_type = 'error'")
def j14_frame_slice(spark, sf_dir):
    a = _segments(spark, sf_dir, ["view", "click"])
    e = messages(spark, sf_dir).filter("event_type = 'error'").select(c("user_id").alias("id"), "us", "event_id")
    return a.join(e, "id").filter((c("us") > c("start_time")) & (c("us") < c("end_time"))).select("id", "event_id")


@query(EV + "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS n FROM e) WHERE (n - 1) % 20 = 0")
def q16_decimate(spark, sf_dir):
    return tl.decimate(messages(spark, sf_dir), ["user_id"], ["us", "event_id"], 20).select("event_id")


@query(EV + ", f AS (SELECT event_type, min(us) AS s FROM e GROUP BY 1) SELECT event_type, CAST(floor(((SELECT max(s) FROM f) - s) / 100000.0E0) AS BIGINT) AS skip FROM f")
def q17_align_start(spark, sf_dir):
    return tl.frames_to_skip(messages(spark, sf_dir), "event_type", "us", 100000.0)


@query(EV + "SELECT user_id, round(coalesce(avg((local_us - us) / 1e6), 0), 6) AS clip_offset FROM e GROUP BY 1")
def q18_clip_offset(spark, sf_dir):
    return messages(spark, sf_dir).groupBy("user_id").agg(F.round(F.avg((c("local_us") - c("us")) / 1e6), 6).alias("clip_offset"))


@query("""SELECT user_id, round(coalesce(avg(CASE WHEN event_type = 'view' AND user_id % 2 = 0 THEN value - 1 END), avg(CASE WHEN event_type = 'click' AND user_id % 3 = 0 THEN value END) - avg(CASE WHEN event_type = 'error' THEN value END), 0), 6) + 0.0E0 AS gap FROM events GROUP BY 1""")
def q09_clock_gap(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    m = e.select("user_id", F.when((c("event_type") == "view") & (c("user_id") % 2 == 0), c("value")).alias("t0"), F.lit(1.0).alias("t1"), F.when((c("event_type") == "click") & (c("user_id") % 3 == 0), c("value")).alias("sync"), F.when(c("event_type") == "error", c("value")).alias("header"))
    return tl.clock_gap(m, ["user_id"]).select("user_id", ex.r6(c("gap")).alias("gap"))


@query(EV + """, s AS (SELECT user_id, event_type AS k, us, avg(value) AS v FROM e WHERE event_type IN ('view', 'click') AND value IS NOT NULL GROUP BY ALL),
r AS (SELECT user_id, k, CAST(round_even((min(us) + 20000000) / 10000.0E0, 0) AS BIGINT) * 10000 AS lo, CAST(round_even((max(us) - 20000000) / 10000.0E0, 0) AS BIGINT) * 10000 AS hi FROM s GROUP BY ALL),
g AS (SELECT user_id, k, lo, i, lo + i * 21600000000 AS pt FROM (SELECT *, unnest(range(0, CAST(greatest(0, ceil((hi - lo) / 21600000000.0E0)) AS BIGINT))) AS i FROM r)),
a AS (SELECT g.user_id, g.k, lo, i, pt, s.us AS t0, s.v AS v0 FROM g ASOF JOIN s ON g.user_id = s.user_id AND g.k = s.k AND g.pt >= s.us),
b AS (SELECT a.*, s.us AS t1, s.v AS v1 FROM a ASOF JOIN s ON a.user_id = s.user_id AND a.k = s.k AND a.pt < s.us), p AS (SELECT user_id, k, lo, i, (v1 - v0) / (t1 - t0) * (pt - t0) + v0 AS v FROM b),
x AS (SELECT x.user_id, x.i - y.i AS shift, x.lo - y.lo + (x.i - y.i) * 21600000000 AS gap, sqrt(avg((x.v - y.v) * (x.v - y.v))) AS rmse, count(*) AS n FROM p x JOIN p y ON x.user_id = y.user_id AND x.k = 'view' AND y.k = 'click' GROUP BY ALL HAVING count(*) >= 20),
w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(rmse, 9), shift) AS nth FROM x) SELECT user_id, gap, shift, round(rmse, 6) AS rmse, n FROM (SELECT DISTINCT user_id FROM s) LEFT JOIN (SELECT * FROM w WHERE nth = 1) USING (user_id)""")
def q08_time_gap_all(spark, sf_dir):
    """The clock offset between two signals of every user: interpolated, trimmed, over all shifts."""
    m = messages(spark, sf_dir)
    gap = tl.time_gap(m.filter("event_type = 'view'"), m.filter("event_type = 'click'"), ["user_id"], "us", "value", 21600000000, 20000000, 20)
    return gap.withColumn("rmse", F.round("rmse", 6))


@query(EV + """, m AS (SELECT event_id, user_id, event_type, us, us / 1e6 - CASE WHEN user_id % 3 > 0 AND us > 1705300000000000 THEN 1704500000.0E0 ELSE 0 END AS t FROM e),
d AS (SELECT user_id, event_type, coalesce(t - lag(t) OVER w, 0) AS d, row_number() OVER w AS n FROM m WHERE event_type <> 'purchase' WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us, event_id)),
g AS (SELECT user_id, event_type, round(d, 4) AS r, count(*) AS c, min(n) AS first, min(d) AS least FROM d GROUP BY 1, 2, 3), p AS (SELECT user_id, event_type, arg_max(r, c * 1000000000 - first) AS mode, min(least) AS least FROM g GROUP BY 1, 2),
o AS (SELECT user_id, CASE WHEN least < -1.7e9 THEN mode - least END AS o FROM p), s AS (SELECT user_id, round(coalesce(avg(o), (SELECT avg(o) FROM o), 0), 3) AS moved FROM o GROUP BY 1),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS n FROM m WHERE event_type = 'purchase') SELECT event_id, user_id, round(t + moved, 3) AS time_stamp FROM f JOIN s USING (user_id) WHERE n > 5""")
def q12_repair_clock(spark, sf_dir):
    """Purchases on their user's clock; two of three users' clocks fall back to zero in mid-month."""
    back = (c("user_id") % 3 > 0) & (c("us") > 1705300000000000)
    m = messages(spark, sf_dir).withColumn("time_stamp", c("us") / 1e6 - F.when(back, 1704500000.0).otherwise(0.0))
    order = ["us", "event_id"]
    offsets = tl.clock_offsets(m.filter("event_type != 'purchase'"), ["user_id"], ["event_type"], "time_stamp", order)
    fixed = tl.repair_clock(m.filter("event_type = 'purchase'"), offsets, ["user_id"], [], "time_stamp", order)
    return fixed.select("event_id", "user_id", F.round("time_stamp", 3).alias("time_stamp"))


@query(EV + "SELECT user_id, event_type, count(*) AS frames, round((max(us) - min(us)) / 1e6, 6) AS duration, CASE WHEN max(us) - min(us) <= 2500000000000 THEN 1 ELSE 0 END AS valid FROM e GROUP BY 1, 2")
def a12_topic_statistics(spark, sf_dir):
    g = messages(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count("*").alias("frames"), (F.max("us") - F.min("us")).alias("d"))
    return g.select("user_id", "event_type", "frames", F.round(c("d") / 1e6, 6).alias("duration"), F.when(c("d") <= 2500000000000, 1).otherwise(0).alias("valid"))


@query(EV + ", x AS (SELECT user_id, (max(us) - min(us)) / 1e6 AS d, avg(value) AS v FROM e GROUP BY 1) SELECT user_id, CAST(round(d * 30 * 291 / 300) AS BIGINT) AS frames, CAST(ceil(d * v / 1000) AS BIGINT) AS distance FROM x")
def a14_exposure(spark, sf_dir):
    x = messages(spark, sf_dir).groupBy("user_id").agg(((F.max("us") - F.min("us")) / 1e6).alias("d"), F.avg("value").alias("v"))
    return x.select("user_id", F.round(c("d") * 30 * 291 / 300).cast("long").alias("frames"), F.ceil(c("d") * c("v") / 1000).cast("long").alias("distance"))


@query("WITH r AS (SELECT event_type AS camera, epoch_us(ts) // 86400000000 AS day, count(*) AS n FROM events GROUP BY 1, 2) SELECT camera, day, n FROM r WHERE abs(n - 66.0E0) > 15")
def a21_rate_alert(spark, sf_dir):
    r = messages(spark, sf_dir).groupBy(c("event_type").alias("camera"), F.floor(c("us") / 86400000000).alias("day")).agg(F.count("*").alias("n"))
    return r.filter(F.abs(c("n") - 66.0) > 15)


@query(EV + """, a AS (SELECT user_id, us // 86400000000 AS day, min(us) AS s FROM e WHERE event_type = 'view' GROUP BY 1, 2), b AS (SELECT user_id, us // 86400000000 AS day, min(us) AS s FROM e WHERE event_type = 'click' GROUP BY 1, 2),
p AS (SELECT a.user_id, a.s AS a_s, b.s AS b_s, row_number() OVER (PARTITION BY a.user_id, a.s ORDER BY abs(a.s - b.s), b.s) AS k FROM a JOIN b ON a.user_id = b.user_id AND abs(a.s - b.s) < 7200000000) SELECT user_id, a_s, b_s FROM p WHERE k = 1""")
def j11_clip_match(spark, sf_dir):
    from pyspark.sql import Window

    m = messages(spark, sf_dir)
    first = lambda t: m.filter(c("event_type") == t).groupBy("user_id", F.floor(c("us") / 86400000000).alias("day")).agg(F.min("us").alias("s")).drop("day")
    a = first("view").withColumnRenamed("s", "a_s").withColumn("_b", F.floor(c("a_s") / 7200000000))
    b = first("click").withColumnRenamed("s", "b_s").withColumn("_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(c("b_s") / 7200000000) + d)))
    near = a.join(b, ["user_id", "_b"]).filter(F.abs(c("a_s") - c("b_s")) < 7200000000)
    w = Window.partitionBy("user_id", "a_s").orderBy(F.abs(c("a_s") - c("b_s")), "b_s")
    return near.withColumn("k", F.row_number().over(w)).filter("k = 1").select("user_id", "a_s", "b_s")
