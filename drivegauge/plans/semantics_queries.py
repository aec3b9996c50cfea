"""Queries over whole semantics of flatteners, line pipelines, failure samples, exposure and packages."""

from __future__ import annotations

from pyspark.sql import functions as F

from drivegauge.functions import expressions as ex
from drivegauge.operators import lines as ln
from drivegauge.operators import obstacles as ob
from drivegauge.operators import report as rp
from drivegauge.operators import statistics as st
from drivegauge.operators import timeline as tl
from drivegauge.sources import flatten as fl

from .fixtures import SQL, gt_obj, table
from .object_queries import _COVERED, BOTH, CAMERAS, MATCH, derived, matched
from .registry import query
from .report_queries import LINE, lines
from .source_queries import L
from .time_queries import EV
from .time_queries import messages as events

c, r6 = F.col, ex.r6


def _messages(spark, sf_dir, fields):
    """An order is a message; its lines, in order, are objects of these fields."""
    o = F.struct(*[c(k) for k in ("l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")], *[v.alias(k) for k, v in fields.items()])
    rows = table(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("frame_id")).agg(F.array_sort(F.collect_list(o)).alias("obstacles"))
    return rows.select(F.floor(c("frame_id") / 750).alias("scenario_no"), (c("frame_id") / 10.0).alias("time_stamp"), "frame_id", "obstacles", F.size("obstacles").alias("n"))


_YAWS = "CASE k WHEN 0 THEN pi() WHEN 1 THEN 0 WHEN 2 THEN pi() / 2 WHEN 3 THEN pi() / 4 WHEN 4 THEN pi() * 3 / 4 WHEN 5 THEN -pi() / 2 WHEN 6 THEN -pi() * 3 / 4 WHEN 7 THEN -pi() / 4 END"


@query(L + f""", o AS (SELECT *, l_partkey % 10 AS pt, l_quantity / 10 + 1 AS len, l_tax * 10 + 1 AS wid, l_discount * 10 - 0.5E0 AS yaw0, CASE WHEN l_partkey % 2 = 0 AND l_suppkey % 3 <> 0 THEN l_linenumber % 8 WHEN l_quantity % 2 <> 0 THEN (l_linenumber + 3) % 8 END AS k FROM l WHERE l_partkey % 4 <> 0),
y AS (SELECT *, CASE WHEN l_suppkey % 5 = 2 THEN coalesce({_YAWS}, yaw0) ELSE yaw0 END AS yaw, CASE WHEN pt IN (7, 8, 9, 0) THEN 0 WHEN pt IN (4, 5, 6) THEN 0.5E0 ELSE -0.5E0 END AS a, CASE WHEN pt IN (0, 2, 5, 9) THEN 0 WHEN pt IN (1, 4, 7) THEN 0.5E0 ELSE -0.5E0 END AS b FROM o)
SELECT l_orderkey AS frame_id, l_partkey % 4 AS id, CASE WHEN l_suppkey % 5 IN (0, 1) THEN 1 WHEN l_suppkey % 5 = 2 THEN 2 ELSE 18 END AS type, round(yaw, 6) + 0.0E0 AS yaw, round(l_extendedprice % 250 - a * len * cos(yaw) + b * wid * sin(yaw), 5) + 0.0E0 AS x, round(l_tax - a * len * sin(yaw) - b * wid * cos(yaw), 5) + 0.0E0 AS y FROM y""")
def t01_placed_obstacles(spark, sf_dir):
    """Obstacles with the centre of their box and the heading of pedestrians."""
    category = lambda prop, kind, conf: F.struct(prop.alias("property"), kind.alias("kind"), conf.alias("conf"))
    fields = {"id": c("l_partkey") % 4, "type": (c("l_suppkey") % 5).cast("int"), "position_type": (c("l_partkey") % 10).cast("int"), "yaw": c("l_discount") * 10 - 0.5, "length": c("l_quantity") / 10 + 1, "width": c("l_tax") * 10 + 1, "confidence": c("l_quantity"), "x": c("l_extendedprice") % 250, "y": c("l_tax"),
              "categories": F.array(category((c("l_linenumber") % 8).cast("int"), (c("l_partkey") % 2).cast("int"), (c("l_suppkey") % 3).cast("double")), category(((c("l_linenumber") + 3) % 8).cast("int"), F.lit(0), (c("l_quantity") % 2).cast("double")))}
    out = fl.placed_obstacles(_messages(spark, sf_dir, fields))
    return out.select("frame_id", "id", "type", r6(c("yaw")).alias("yaw"), *[(F.round(k, 5) + 0.0).alias(k) for k in ("x", "y")])


@query(L + "SELECT l_orderkey AS frame_id, (l_orderkey * 64) % 200000 + pos - 1 AS id, l_discount AS center_x, CASE l_suppkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 9 ELSE -1 END AS sub_type FROM l WHERE pos <= 32 AND l_discount <> 0 AND l_tax <> 0")
def t03_image_detections_all(spark, sf_dir):
    """Detections by both coordinates of their centre, with common sub types."""
    m = _messages(spark, sf_dir, {"center_x": c("l_discount"), "center_y": c("l_tax"), "sub_type": (c("l_suppkey") % 5).cast("int")})
    return fl.image_detections(m, [("obstacles", "n")]).select("frame_id", "id", "center_x", "sub_type")


@query(L + "SELECT l_orderkey AS frame_id, l_partkey % 4 AS id, CASE WHEN l_discount = 0 AND l_tax = 0 THEN 1 ELSE 2 END AS n, CASE WHEN l_linenumber % 2 = l_suppkey % 2 THEN '' || l_linenumber % 2 ELSE l_linenumber % 2 || ',' || l_suppkey % 2 END AS types FROM l WHERE l_partkey % 4 <> 0 AND l_tax <> 0")
def t18_vendor_lines(spark, sf_dir):
    """Lines of the second vendor: points off the origin, lane types without repeats."""
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    parity = lambda k: (c(k) % 2).cast("int")
    m = _messages(spark, sf_dir, {"id": c("l_partkey") % 4, "confidence": c("l_tax"), "points": F.array(point(c("l_discount"), c("l_tax")), point(c("l_quantity"), F.lit(0.0))), "types": F.array(parity("l_linenumber"), parity("l_linenumber"), parity("l_suppkey"))})
    out = fl.vendor_lines(m.withColumnRenamed("obstacles", "lines"))
    return out.select(F.round(c("time_stamp") * 10).cast("long").alias("frame_id"), "id", F.size("points").alias("n"), F.array_join(F.transform("types", lambda t: t.cast("string")), ",").alias("types"))


_LANES = "CASE WHEN d < 4.2E0 THEN 0 WHEN d < 7.7E0 THEN 1 WHEN d < 11.2E0 THEN 2 ELSE 3 END"


@query(LINE + f""", h AS (SELECT id, c0, c1, (c0 + c0 + c1 * 5 + c2 * 25 + c0 + c1 * 10 + c2 * 100) / 3 AS y, 1 + row_number() OVER (PARTITION BY CAST(floor(id / 750) AS BIGINT) ORDER BY id) - 1 AS track FROM o),
p AS (SELECT *, abs(y) AS d FROM h), q AS (SELECT *, CASE WHEN d > 12.25E0 THEN 0 WHEN y >= 0 THEN 1 + {_LANES} ELSE 8 + {_LANES} END AS position FROM p)
SELECT id * 100000 AS frame_ts_us, track AS id, '' || id AS origin_id, CAST(position AS INTEGER) AS position, CASE WHEN id % 3 = 2 THEN 'fence' WHEN id % 3 = 1 AND position IN (1, 8) THEN 'main_lane' WHEN id % 3 = 1 AND position IN (2, 3, 9, 10) THEN 'secondary_lane' END AS type_classification, 1::BIGINT AS age, round(c0, 4) + 0.0E0 AS c0, round(c1, 4) + 0.0E0 AS c1 FROM q""")
def q07_line_pipeline(spark, sf_dir):
    """All steps of the truth's lines, in order."""
    out = ln.pipeline(lines(spark, sf_dir), True)
    return out.select("frame_ts_us", "id", "origin_id", "position", "type_classification", "age", *[(F.round(k, 4) + 0.0).alias(k) for k in ("c0", "c1")])


@query(SQL[:-2] + """, n AS (SELECT *, sqrt(vx * vx + vy * vy) AS v FROM gt WHERE abs(x) <= 30 AND abs(y) <= 8), u AS (SELECT scenario_no, avg(v) FILTER (v <= 8) AS usual FROM n GROUP BY 1),
f AS (SELECT scenario_no, frame_ts_us, count(*) AS k, sum(CASE WHEN v <= 8 THEN v ELSE usual END) AS s, sum(length * width) AS a FROM n JOIN u USING (scenario_no) GROUP BY 1, 2),
t AS (SELECT scenario_no, count(DISTINCT frame_ts_us) AS frames FROM gt GROUP BY 1), g AS (SELECT scenario_no, sum(s / k) AS v, sum(s / 60) AS q, sum(a / 960) AS a FROM f GROUP BY 1)
SELECT scenario_no, round(coalesce(v, 0) / frames, 6) AS average_velocity, round(coalesce(q, 0) / frames, 6) AS flow, round(coalesce(a, 0) / frames, 6) AS area_share FROM t LEFT JOIN g USING (scenario_no)""")
def a10_scenario_flow(spark, sf_dir):
    """Labels of a scenario over all of its frames; speeds above 8 m/s are replaced."""
    g = gt_obj(spark, sf_dir)
    out = st.traffic_flow(g, g, fastest=8.0)
    return out.select("scenario_no", *[F.round(k, 6).alias(k) for k in ("average_velocity", "flow", "area_share")])


@query(EV + """, t AS (SELECT user_id, event_type, us // 1000000 AS s FROM e WHERE event_type IN ('view', 'click', 'error')), g AS (SELECT user_id, event_type, count(DISTINCT s) || '/' || count(*) || '/' || (max(s) - min(s)) || '.00/' || min(s) || '.00-' || max(s) || '.00' AS x, max(s) - min(s) AS d FROM t GROUP BY 1, 2),
w AS (SELECT user_id, """ + ", ".join(f"coalesce(max(x) FILTER (event_type = '{t}'), '0/0/0/0-0') AS \"{t}\", coalesce(max(d) FILTER (event_type = '{t}'), 0) AS d_{t}" for t in ("view", "click", "error")) + """ FROM g GROUP BY 1)
SELECT user_id, "view", click, error, CASE WHEN greatest(d_view, d_click, d_error) - least(d_view, d_click, d_error) <= 90000 THEN 1 ELSE 0 END AS valid FROM w""")
def a12_scenario_validity(spark, sf_dir):
    """What each topic of a scenario gave, and whether their durations agree."""
    m = events(spark, sf_dir).withColumn("stamp", F.floor(c("us") / 1000000).cast("double"))
    return tl.scenario_validity(m.filter(c("event_type").isin("view", "click", "error")), ["view", "click", "error"], "user_id", "event_type", "stamp", 90000.0)


@query(EV + ", s AS (SELECT user_id, user_id % 3 AS tag, (max(us) - min(us)) / 1e6 AS d, avg(value) AS v FROM e GROUP BY 1) SELECT tag, CAST(sum(round_even(d * 30 * 291 / 300, 0)) AS BIGINT) AS frames, CAST(sum(ceil(d * v / 1000)) AS BIGINT) AS distance_km, count(*) AS scenarios FROM s GROUP BY ROLLUP (tag)")
def a14_exposure_totals(spark, sf_dir):
    """Frames and kilometres of each tag and of all."""
    m = events(spark, sf_dir)
    clips = m.groupBy(c("user_id").alias("scenario_no")).agg(((F.max("us") - F.min("us")) / 1e6).alias("duration")).withColumns({"tag": c("scenario_no") % 3, "fps": F.lit(30)})
    return rp.exposure(clips, m.select(c("user_id").alias("scenario_no"), (c("us") / 1e6).alias("time_stamp"), c("value").alias("ego_vx")), "tag")


@query(BOTH + _COVERED.rsplit("SELECT frame_ts_us, id, round(cover", 1)[0] + " SELECT usr AS road_user, cls AS class, count(*) AS n FROM z JOIN gt_d USING (frame_ts_us, id) WHERE cover <= 0.6E0 GROUP BY 1, 2")
def a14_road_users(spark, sf_dir):
    """Visible road users by kind and class."""
    seen = ob.occlusion(ob.vision_range(derived(spark, sf_dir, "gt"))).filter("is_coverageValid = 1")
    return seen.groupBy("road_user", c("type_classification").alias("class")).agg(F.count("*").alias("n"))


_OBJECTS = "WITH o AS (SELECT source || CASE WHEN doc_id % 3 = 0 THEN '/install/lib' || doc_id WHEN doc_id % 3 = 1 AND source <> 'src7' THEN '/rosbag_' || doc_id ELSE '/readme' END AS key, source, doc_id % 3 AS k, n_chars FROM documents), p AS (SELECT source AS package, sum(CASE WHEN key NOT LIKE '%/readme' THEN n_chars ELSE 0 END)::BIGINT AS size FROM o GROUP BY 1 HAVING bool_or(k = 0) AND bool_or(key LIKE '%/rosbag%'))"


@query(_OBJECTS + ", r AS (SELECT *, sum(size) OVER (ORDER BY size, package ROWS UNBOUNDED PRECEDING) AS s FROM p) SELECT package, size FROM r WHERE s * 1.5E0 < (SELECT sum(size) FROM p) * 0.75E0")
def a15_downloads(spark, sf_dir):
    """Packages with libraries and a bag, the smallest first, while half of all fits with the reserve."""
    kind = F.when(c("doc_id") % 3 == 0, F.concat(F.lit("/install/lib"), "doc_id")).when((c("doc_id") % 3 == 1) & (c("source") != "src7"), F.concat(F.lit("/rosbag_"), "doc_id")).otherwise("/readme")
    packages = rp.package_sizes(table(spark, sf_dir, "documents").select(F.concat("source", kind).alias("key"), "n_chars"), "key", "n_chars")
    total = packages.agg(F.sum("size")).first()[0] or 0
    return rp.downloads(packages, 20 * 1024**3 + total * 0.75)


_VRU = "IN ('pedestrian', 'cyclist')"


@query(MATCH + f""", f AS (SELECT 'false_positive' AS kind, 3 AS most, pred_cls AS class, scenario_no, pred_id AS id, frame_ts_us FROM m WHERE gt_flag = 0 AND pred_x BETWEEN -100 AND 150 AND abs(pred_y) <= 8 AND NOT (pred_cls {_VRU} AND pred_x > 50)
UNION ALL SELECT CASE WHEN gt_x <= 100 THEN 'false_negative_near' ELSE 'false_negative_far' END, 6, gt_cls, scenario_no, gt_id, frame_ts_us FROM m WHERE gt_flag = 1 AND pred_flag = 0 AND abs(gt_y) <= 8 AND NOT (gt_cls {_VRU} AND abs(gt_x) > 50) AND gt_x BETWEEN -100 AND 150
UNION ALL SELECT 'false_type', 3, gt_cls, scenario_no, gt_id, frame_ts_us FROM m WHERE gt_flag = 1 AND pred_flag = 1 AND gt_cls IS DISTINCT FROM pred_cls AND gt_x BETWEEN -50 AND 100 AND abs(gt_y) <= 8 AND NOT (gt_cls {_VRU} AND gt_x > 50)),
k AS (SELECT kind, class, scenario_no, id, most, row_number() OVER (PARTITION BY kind, class ORDER BY count(*) DESC, scenario_no, id) AS r FROM f GROUP BY 1, 2, 3, 4, 5) SELECT f.kind, f.class, f.scenario_no, f.id, f.frame_ts_us FROM f JOIN k ON f.kind = k.kind AND f.class = k.class AND f.scenario_no = k.scenario_no AND f.id = k.id WHERE r <= k.most""")
def k01_failure_samples(spark, sf_dir):
    """Failures worth a look: twice as many misses as false positives, near and far apart."""
    return rp.failure_samples(matched(spark, sf_dir), 3)


@query(MATCH + """, e AS (SELECT gt_cls AS class, scenario_no, gt_id AS id, abs(gt_x) <= 50 AS near, CASE WHEN abs(gt_x) <= 50 THEN abs(pred_y - gt_y) ELSE abs((pred_y - gt_y) / greatest(10, abs(gt_y))) END AS er FROM m WHERE gt_flag = 1 AND pred_flag = 1),
k AS (SELECT near, class, scenario_no, id, count(*) AS n, round(avg(er), 6) AS mean_error FROM e GROUP BY ALL HAVING count(*) >= 3), r AS (SELECT *, row_number() OVER (PARTITION BY near, class ORDER BY mean_error DESC, scenario_no, id) AS rank FROM k) SELECT CASE WHEN near THEN 'near' ELSE 'far' END AS zone, class, scenario_no, id, n, mean_error, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def k02_worst_near_far(spark, sf_dir):
    """Largest mean errors to the side, by metres nearby and by shares further away."""
    from drivegauge.operators import metrics as me

    e = me.y_error(me.true_positives(matched(spark, sf_dir))).select(c("gt_type_classification").alias("class"), "scenario_no", c("gt_id").alias("id"), "gt_x", "y_error", "y_error_pct")
    return rp.worst_by_distance(e, "y_error", "y_error_pct", 5, 3)


@query(MATCH + """, cam(camera, lo, hi) AS (VALUES ('front', -60.0E0, 60.0E0), ('left', 45.0E0, 135.0E0), ('right', -135.0E0, -45.0E0), ('rear', 135.0E0, 225.0E0)),
b AS (SELECT frame_ts_us, 'fn' AS side, gt_id AS id, degrees(atan2(gt_y, gt_x)) AS d FROM m WHERE gt_flag = 1 AND pred_flag = 0 UNION ALL SELECT frame_ts_us, 'fp', pred_id, degrees(atan2(pred_y, pred_x)) FROM m WHERE gt_flag = 0 AND pred_flag = 1)
SELECT camera, frame_ts_us, CAST(round((frame_ts_us / 1e6 - 0.5E0) * 30) AS BIGINT) AS frame_index, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (side = 'fn'), '') AS fn_ids, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (side = 'fp'), '') AS fp_ids
FROM b JOIN cam ON d BETWEEN lo AND hi OR d + 360 BETWEEN lo AND hi GROUP BY 1, 2""")
def r08_camera_plan(spark, sf_dir):
    """Frames to draw for each camera, with the misses and the false positives that it sees."""
    side = lambda name, s: F.when((c(f"{s}_flag") == 1) & (c(f"{'pred' if s == 'gt' else 'gt'}_flag") == 0), F.struct(F.lit(name).alias("side"), c(f"{s}_id").alias("id"), c(f"{s}_x").alias("x"), c(f"{s}_y").alias("y")))
    failures = matched(spark, sf_dir).select("frame_ts_us", F.explode(F.array_compact(F.array(side("fn", "gt"), side("fp", "pred")))).alias("f")).select("frame_ts_us", "f.*")
    return rp.camera_plan(failures, spark.createDataFrame(CAMERAS, "camera string, lo double, hi double"), 0.5, 30)


@query("""WITH r AS (SELECT DISTINCT o_custkey AS scenario, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderpriority AS t, o_orderstatus AS s, 'v' || o_orderkey % 4 AS v FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 3 = 0),
a AS (SELECT scenario, count(*) AS n, string_agg(d || '/' || t || '/' || s || '/' || v, ';' ORDER BY d, t, s, v) AS tests FROM r GROUP BY 1), f AS (SELECT DISTINCT o_custkey AS scenario, o_orderkey % 1000 AS id FROM orders WHERE o_orderkey % 5 IN (2, 3) AND o_orderkey % 2 = 0),
x AS (SELECT scenario, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS excluded FROM f GROUP BY 1) SELECT scenario, coalesce(n, 0) AS n_tests, coalesce(tests, '') AS tests, coalesce(excluded, '') AS excluded FROM a FULL JOIN x USING (scenario)""")
def r09_merged_history(spark, sf_dir):
    """Tests added to a history, each once, with the failures that are not to be drawn again."""
    o, key = table(spark, sf_dir, "orders"), c("o_orderkey")
    tests = o.select(c("o_custkey").alias("scenario"), key.alias("k"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), c("o_orderpriority").alias("topic"), c("o_orderstatus").alias("source"), F.concat(F.lit("v"), (key % 4).cast("string")).alias("version"))
    failures = o.select(c("o_custkey").alias("scenario"), (key % 1000).alias("id"), F.when(key % 2 == 0, "fn").otherwise("fp").alias("side"), (key % 5).alias("mark"))
    return rp.merge_tests(tests.filter("k % 2 = 1").drop("k"), tests.filter("k % 3 = 0").drop("k"), failures)
