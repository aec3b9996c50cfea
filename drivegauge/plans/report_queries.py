"""Queries over slots, lines, targets, verdicts, offenders, packages and scenario lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivegauge.functions import expressions as ex
from drivegauge.operators import lines as ln
from drivegauge.operators import metrics as me
from drivegauge.operators import report as rp
from drivegauge.operators import slots as sl
from drivegauge.sources import readers as rd
from drivegauge.sources.scratch import stored

from .fixtures import table
from .object_queries import MATCH, PLACED, _errors, _FLAGS, matched
from .registry import query

c, r6 = F.col, ex.r6

# slots: a part is a slot, turned by its key

SLOT = """WITH s AS (SELECT p_partkey AS id, p_partkey % 4 AS type, p_size * 0.2E0 - 5 AS cx, (p_retailprice % 20) - 10 AS cy, radians(p_partkey % 360) AS a FROM part), g AS (SELECT id, type, """ + ", ".join(
    f"cx + {dx}E0 * cos(a) - {dy}E0 * sin(a) AS pt_{i}_x, cy + {dx}E0 * sin(a) + {dy}E0 * cos(a) AS pt_{i}_y" for i, (dx, dy) in enumerate(((-2.5, -1.25), (2.5, -1.25), (2.5, 1.25), (-2.5, 1.25)))
) + " FROM s) "


def slots(spark, sf_dir) -> DataFrame:
    a, x, y = F.radians(c("p_partkey") % 360), c("p_size") * 0.2 - 5, c("p_retailprice") % 20 - 10
    out = table(spark, sf_dir, "part").select(c("p_partkey").alias("id"), (c("p_partkey") % 4).alias("type"), a.alias("a"), x.alias("cx"), y.alias("cy"))
    for i, (dx, dy) in enumerate(((-2.5, -1.25), (2.5, -1.25), (2.5, 1.25), (-2.5, 1.25))):
        out = out.withColumns({f"pt_{i}_x": c("cx") + dx * F.cos("a") - dy * F.sin("a"), f"pt_{i}_y": c("cy") + dx * F.sin("a") + dy * F.cos("a")})
    return out.drop("a", "cx", "cy")


SLOT_REGIONS = [(1, -6.0, 0.0, -10.0, 0.0), (2, 0.0, 6.0, -10.0, 0.0), (3, -6.0, 6.0, 0.0, 10.0)]


@query(SLOT + """, m AS (SELECT id, (pt_0_x + pt_1_x + pt_2_x + pt_3_x) / 4 AS x, (pt_0_y + pt_1_y + pt_2_y + pt_3_y) / 4 AS y FROM g)
SELECT id, round(x, 6) + 0.0E0 AS center_x, CASE WHEN round(x, 6) BETWEEN -6 AND 0 AND round(y, 6) BETWEEN -10 AND 0 THEN 1 WHEN round(x, 6) BETWEEN 0 AND 6 AND round(y, 6) BETWEEN -10 AND 0 THEN 2 WHEN round(x, 6) BETWEEN -6 AND 6 AND round(y, 6) BETWEEN 0 AND 10 THEN 3 ELSE 0 END AS region FROM m""")
def p10_slot_region(spark, sf_dir):
    s = sl.with_center(slots(spark, sf_dir)).withColumns({"center_x": r6(c("center_x")), "center_y": r6(c("center_y"))})
    return sl.with_region(s, SLOT_REGIONS).select("id", "center_x", "region")


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 4 IN (0, 2, 3) THEN 'vertical' ELSE 'parallel' END AS type_classification FROM part")
def p11_slot_truth_class(spark, sf_dir):
    return sl.truth_class(slots(spark, sf_dir)).select("id", "type_classification")


@query("SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 1 THEN 'vertical' WHEN 2 THEN 'parallel' WHEN 3 THEN 'oblique' ELSE 'unknown' END AS type_classification FROM part")
def p12_slot_class(spark, sf_dir):
    return slots(spark, sf_dir).select("id", sl.slot_class(c("type")).alias("type_classification"))


@query(SLOT + """SELECT id, round(sqrt(((pt_0_x + pt_1_x) / 2) * ((pt_0_x + pt_1_x) / 2) + ((pt_0_y + pt_1_y) / 2) * ((pt_0_y + pt_1_y) / 2)), 5) AS in_border_distance,
round(sqrt((pt_0_x - pt_1_x) * (pt_0_x - pt_1_x) + (pt_0_y - pt_1_y) * (pt_0_y - pt_1_y)), 5) AS in_border_length, round((sqrt((pt_0_x - pt_2_x) * (pt_0_x - pt_2_x) + (pt_0_y - pt_2_y) * (pt_0_y - pt_2_y)) + sqrt((pt_1_x - pt_3_x) * (pt_1_x - pt_3_x) + (pt_1_y - pt_3_y) * (pt_1_y - pt_3_y))) / 2, 5) AS slot_length FROM g""")
def p13_slot_geometry(spark, sf_dir):
    return sl.geometry(slots(spark, sf_dir)).select("id", *[F.round(k, 5).alias(k) for k in ("in_border_distance", "in_border_length", "slot_length")])


@query("""SELECT p_partkey AS id, round(CASE WHEN u = 0 AND v = 0 THEN 0 ELSE (800 / 2 + 47.19E0 - v) * 0.03E0 END, 6) + 0.0E0 AS x, round(CASE WHEN u = 0 AND v = 0 THEN 0 ELSE (704 / 2 - u) * 0.03E0 END, 6) + 0.0E0 AS y FROM (SELECT p_partkey, p_size * 3 % 90 AS u, p_partkey % 7 * 100 AS v FROM part)""")
def p14_pixel_to_ego(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", (c("p_size") * 3 % 90).alias("u"), (c("p_partkey") % 7 * 100).alias("v"))
    x, y = ex.pixel_to_ego(c("u"), c("v"))
    return p.select(c("p_partkey").alias("id"), r6(x).alias("x"), r6(y).alias("y"))


_SHIFT = ", ".join(f"g.pt_{i}_{a} AS gt_pt_{i}_{a}, g.pt_{i}_{a} + (g.id % 9 - 4) * 0.1E0 * {i + 1} AS pred_pt_{i}_{a}" for i in range(4) for a in "xy")


def _slot_pairs(spark, sf_dir) -> DataFrame:
    g = slots(spark, sf_dir)
    return g.select("id", *[e for i in range(4) for a in "xy" for e in (c(f"pt_{i}_{a}").alias(f"gt_pt_{i}_{a}"), (c(f"pt_{i}_{a}") + (c("id") % 9 - 4) * 0.1 * (i + 1)).alias(f"pred_pt_{i}_{a}"))])


@query(SLOT + f", m AS (SELECT g.id, {_SHIFT} FROM g) SELECT id, round(greatest(" + ", ".join(f"abs(pred_pt_{i}_x - gt_pt_{i}_x)" for i in range(4)) + "), 6) AS corner_x_max, round((" + " + ".join(f"abs(pred_pt_{i}_x - gt_pt_{i}_x)" for i in range(4)) + ") / 4, 6) AS corner_x_mean, CASE WHEN greatest(" + ", ".join(f"abs(pred_pt_{i}_x - gt_pt_{i}_x)" for i in range(4)) + ") > 0.85E0 THEN 1 ELSE 0 END AS corner_x_abnormal FROM m")
def m09_corner_errors(spark, sf_dir):
    return me.corner_errors(_slot_pairs(spark, sf_dir), "x", 0.85).select("id", F.round("corner_x_max", 6).alias("corner_x_max"), F.round("corner_x_mean", 6).alias("corner_x_mean"), "corner_x_abnormal")


@query("SELECT p_partkey AS id, round((p_size * 1.01E0 - p_size) * 57.3E0, 6) AS slot_heading_error, CASE WHEN abs((p_size * 1.01E0 - p_size) * 57.3E0) > 10.0001E0 THEN 1 ELSE 0 END AS slot_heading_error_abnormal FROM part")
def m11_slot_heading(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(c("p_partkey").alias("id"), c("p_size").cast("double").alias("gt_slot_heading"), (c("p_size") * 1.01).alias("pred_slot_heading"))
    return me.slot_error(p, "slot_heading", 57.3, 10.0001).select("id", F.round("slot_heading_error", 6).alias("slot_heading_error"), "slot_heading_error_abnormal")


@query("SELECT p_partkey AS id, round(CASE WHEN least(p_size / 100.0E0, (p_size % 7) / 10.0E0) < 0.1E0 THEN 0 ELSE (p_size % 7) / 10.0E0 - p_size / 100.0E0 END, 6) + 0.0E0 AS stopper_error FROM part")
def m12_stopper(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(c("p_partkey").alias("id"), (c("p_size") / 100.0).alias("gt_stopper_depth"), (c("p_size") % 7 / 10.0).alias("pred_stopper_depth"))
    return me.stopper_error(p).select("id", r6(c("stopper_error")).alias("stopper_error"))


@query("SELECT p_partkey AS id FROM part WHERE p_partkey % 4 <> 0 AND (p_size % 5 = 4 OR p_size % 5 <> 0)")
def f06_eligible_slots(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(c("p_partkey").alias("id"), sl.slot_class(c("p_partkey") % 4).alias("gt_type_classification"), F.lit(None).cast("string").alias("pred_type_classification"), F.when(c("p_size") % 5 != 4, c("p_size") % 5).alias("gt_region"))
    return me.eligible_slots(p).select("id")


@query()
def j04_match_slots(spark, sf_dir):
    s = sl.with_center(slots(spark, sf_dir)).withColumn("frame_ts_us", F.floor(c("id") / 8) * 100000)
    p = s.withColumns({k: c(k) + 0.1 for k in s.columns if k[-2:] in ("_x", "_y")}).withColumn("id", c("id") + 1000)
    return sl.match_slots(s, p)


_A6 = "SELECT type, round(avg(abs(d)), 6) AS d_abs_mean, round(quantile_cont(abs(d), 0.68), 6) AS d_abs_q68, round(quantile_cont(abs(d), 0.95), 6) AS d_abs_q95, count(d) AS d_count FROM (SELECT p_partkey % 4 AS type, (p_retailprice % 3) - 1.5E0 AS d FROM part) GROUP BY 1"


@query(_A6)
def a06_slot_stats(spark, sf_dir):
    from drivegauge.operators.statistics import error_stats

    p = table(spark, sf_dir, "part").select((c("p_partkey") % 4).alias("type"), (c("p_retailprice") % 3 - 1.5).alias("d"))
    return error_stats(p, ["type"], ["d"], signed=False)


# lines: an order is a frame with one line of 17 points

LINE = "WITH o AS (SELECT o_orderkey AS id, (o_totalprice % 7) - 3.5E0 AS c0, (o_totalprice % 11 - 5.5E0) / 100 AS c1, (o_totalprice % 13 - 6.5E0) / 10000 AS c2 FROM orders) "


def lines(spark, sf_dir, reach: int = 80) -> DataFrame:
    p = c("o_totalprice")
    o = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), (p % 7 - 3.5).alias("k0"), ((p % 11 - 5.5) / 100).alias("k1"), ((p % 13 - 6.5) / 10000).alias("k2"))
    points = F.transform(F.sequence(F.lit(0), F.lit(reach), F.lit(5)), lambda i: F.struct(i.cast("double").alias("x"), (c("k0") + c("k1") * i + c("k2") * i * i).alias("y")))
    return o.select("id", F.floor(c("id") / 750).alias("scenario_no"), (c("id") * 100000).alias("frame_ts_us"), (c("id") % 3).cast("int").alias("type"), points.alias("points"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 2 THEN 'fence' WHEN o_orderkey % 3 = 1 AND o_orderkey % 12 IN (1, 8) THEN 'main_lane' WHEN o_orderkey % 3 = 1 AND o_orderkey % 12 IN (2, 3, 9, 10) THEN 'secondary_lane' END AS type_classification FROM orders")
def p07_line_class(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), ln.line_class(c("o_orderkey") % 3, c("o_orderkey") % 12).alias("type_classification"))


@query(LINE + "SELECT id, round(c0, 4) + 0.0E0 AS c0, round(c1, 4) + 0.0E0 AS c1, round(degrees(atan(5 * c2 + c1)), 3) + 0.0E0 AS heading_0, round(degrees(atan(100 * c2 + c1)), 3) + 0.0E0 AS heading_50 FROM o")
def p08_line_features(spark, sf_dir):
    f = ln.line_features(lines(spark, sf_dir), ["id"], radii=False)
    return f.select("id", *[(F.round(k, n) + 0.0).alias(k) for k, n in (("c0", 4), ("c1", 4), ("heading_0", 3), ("heading_50", 3))])


@query()
def p09_curvature_radius(spark, sf_dir):
    return ln.line_features(lines(spark, sf_dir, 120), ["id"]).select("id", F.round("length", 3).alias("length"), "radius")


@query("SELECT o_orderkey * 100000 AS frame_ts_us, (2 * o_orderkey) || ',' || (2 * o_orderkey + 1) AS id, 18 AS n FROM orders")
def q04_connect_lines(spark, sf_dir):
    whole = lines(spark, sf_dir)
    half = lambda k, a, b: whole.withColumn("points", F.slice("points", a, b)).withColumn("id", c("id") * 2 + k)
    return ln.connect_lines(half(0, 1, 9).unionByName(half(1, 9, 9))).select("frame_ts_us", "id", F.size("points").alias("n"))


#: Lines of a side from the nearest outward; each takes the first lane from its predecessor's next on that it isn't beyond.
@query(LINE.replace("WITH o", "WITH RECURSIVE o", 1) + """, h AS (SELECT id, (3 * c0 + c1 * 15 + c2 * 125) / 3 AS y FROM o), a AS (SELECT id, id * 4 + k AS line, (y + (k - 2) * 3.5E0 + y + (k - 2) * 3.5E0 + y + (k - 2) * 3.5E0) / 3 AS y FROM h, (SELECT unnest(range(4)) AS k)),
s AS (SELECT *, abs(y) AS d, y >= 0 AS side, row_number() OVER (PARTITION BY id, y >= 0 ORDER BY abs(y), line) AS r FROM a WHERE abs(y) <= 12.25E0), t AS (SELECT *, CASE WHEN d < 4.2E0 THEN 0 WHEN d < 7.7E0 THEN 1 WHEN d < 11.2E0 THEN 2 WHEN d < 14.7E0 THEN 3 ELSE 4 END AS least FROM s),
w(id, side, r, line, lane) AS (SELECT id, side, r, line, least FROM t WHERE r = 1 UNION ALL SELECT t.id, t.side, t.r, t.line, greatest(w.lane + 1, t.least) FROM w JOIN t ON t.id = w.id AND t.side = w.side AND t.r = w.r + 1)
SELECT CAST(floor(a.id / 750) AS BIGINT) AS scenario_no, a.id * 100000 AS frame_ts_us, a.line AS id, CAST(coalesce(CASE WHEN w.side THEN 1 ELSE 8 END + w.lane, 0) AS INTEGER) AS position FROM a LEFT JOIN w USING (line)""")
def q05_lane_position(spark, sf_dir):
    four = lines(spark, sf_dir).withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(4)])))
    moved = four.withColumn("points", F.transform("points", lambda p: F.struct(p["x"].alias("x"), (p["y"] + (c("k") - 2) * 3.5).alias("y")))).withColumn("id", c("id") * 4 + c("k"))
    return ln.lane_position(moved)


#: One line a frame: its number goes on while the raw id stays.
CARRIED = "WITH f AS (SELECT CAST(floor(o_orderkey / 750) AS BIGINT) AS scenario_no, o_orderkey * 100000 AS frame_ts_us, CAST(o_orderkey % 5 AS VARCHAR) AS origin_id FROM orders), g AS (SELECT *, CASE WHEN lag(origin_id) OVER (PARTITION BY scenario_no ORDER BY frame_ts_us) = origin_id THEN 0 ELSE 1 END AS fresh FROM f) SELECT scenario_no, frame_ts_us, origin_id, CAST(sum(fresh) OVER (PARTITION BY scenario_no ORDER BY frame_ts_us) AS BIGINT) AS id FROM g"


@query(CARRIED)
def q06_carry_track_id(spark, sf_dir):
    return ln.carry_track_id(lines(spark, sf_dir).withColumn("id", c("id") % 5))


@query()
def j03_match_lines(spark, sf_dir):
    g = lines(spark, sf_dir)
    p = g.withColumn("points", F.transform("points", lambda q: F.struct(q["x"].alias("x"), (q["y"] + 0.3).alias("y"))))
    return ln.match_lines(g, p).select("frame_ts_us", "gt_id", "pred_id", F.round("iou", 6).alias("iou"))


_M7 = LINE + """, x AS (SELECT id, unnest([2.5, 12.5, 22.5, 32.5, 42.5, 52.5, 62.5, 72.5]::DOUBLE[]) AS x, c0, c1, c2 FROM o), y AS (SELECT id, x, abs(c0 + c1 * x + c2 * x * x + 0.2E0 - (c0 + c1 * (x - 2.5E0) + c2 * (x - 2.5E0) * (x - 2.5E0) + c0 + c1 * (x + 2.5E0) + c2 * (x + 2.5E0) * (x + 2.5E0)) / 2) AS d FROM x)
SELECT id, round(avg(d) FILTER (x < 30) + 1e-7, 4) AS lateral_0_30, round(avg(d) FILTER (x >= 30 AND x < 60) + 1e-7, 4) AS lateral_30_60, NULL::DOUBLE AS lateral_60_120 FROM y GROUP BY 1"""


@query(_M7)
def m07_lateral_error(spark, sf_dir):
    p = c("o_totalprice")
    o = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), (p % 7 - 3.5).alias("k0"), ((p % 11 - 5.5) / 100).alias("k1"), ((p % 13 - 6.5) / 10000).alias("k2"))
    pts = lambda xs, d: F.transform(F.array(*[F.lit(float(v)) for v in xs]), lambda x: F.struct(x.alias("x"), (c("k0") + c("k1") * x + c("k2") * x * x + d).alias("y")))
    both = o.select("id", pts(range(0, 85, 5), 0.0).alias("gt_points"), pts([2.5 + 10 * k for k in range(8)], 0.2).alias("pred_points"))
    return me.lateral_error(both).select("id", *[F.round(F.col(k) + 1e-7, 4).alias(k) for k in ("lateral_0_30", "lateral_30_60", "lateral_60_120")])


@query(LINE + "SELECT id, round(abs(degrees(atan(c1)) - degrees(atan(c1 + 100 * c2))), 6) AS heading_50_error, CASE WHEN abs(degrees(atan(c1)) - degrees(atan(c1 + 100 * c2))) > 1.0001E0 THEN 1 ELSE 0 END AS heading_50_error_abnormal FROM o")
def m08_heading_error(spark, sf_dir):
    p = c("o_totalprice")
    o = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), F.degrees(F.atan((p % 11 - 5.5) / 100)).alias("gt_heading_50"), F.degrees(F.atan((p % 11 - 5.5) / 100 + 100 * ((p % 13 - 6.5) / 10000))).alias("pred_heading_50"))
    return me.line_heading_error(o, "50", 1.0001).select("id", F.round("heading_50_error", 6).alias("heading_50_error"), "heading_50_error_abnormal")


@query(LINE + "SELECT CAST(floor(abs(c2) * 5000) AS BIGINT) AS division, round(avg(abs(c1)), 6) AS c1_abs_mean, round(quantile_cont(abs(c1), 0.68), 6) AS c1_abs_q68, round(quantile_cont(abs(c1), 0.95), 6) AS c1_abs_q95, count(c1) AS c1_count FROM o GROUP BY 1")
def a05_line_stats(spark, sf_dir):
    from drivegauge.operators.statistics import error_stats

    p = c("o_totalprice")
    o = table(spark, sf_dir, "orders").select(F.floor(F.abs((p % 13 - 6.5) / 10000) * 5000).alias("division"), ((p % 11 - 5.5) / 100).alias("c1"))
    return error_stats(o, ["division"], ["c1"], signed=False)


@query("WITH d(name, lo, hi) AS (VALUES ('sharp', 0, 100000), ('bend', 100000, 200000), ('straight', 200000, 1000000)) SELECT o_orderkey AS id, name AS division FROM orders JOIN d ON o_totalprice > lo AND o_totalprice <= hi")
def j09_curvature_division(spark, sf_dir):
    d = F.broadcast(spark.createDataFrame([("sharp", 0, 100000), ("bend", 100000, 200000), ("straight", 200000, 1000000)], "name string, lo int, hi int"))
    return table(spark, sf_dir, "orders").join(d, (c("o_totalprice") > c("lo")) & (c("o_totalprice") <= c("hi"))).select(c("o_orderkey").alias("id"), c("name").alias("division"))


# reports: results are recall and mean error by class and region, versions are scenario parity

_CELLS = MATCH + PLACED + f""", f AS (SELECT class, division, CASE WHEN scenario_no % 2 = 0 THEN 'v1' ELSE 'v2' END AS version, pred_x - gt_x AS ex, {_FLAGS} FROM s),
cell AS (SELECT class, division, version, 'recall_precision' AS metric, 'recall' AS stat, round(sum(tp) / (sum(tp) + sum(fn)), 6) AS value FROM f GROUP BY 1, 2, 3 HAVING sum(tp) + sum(fn) > 0
UNION ALL SELECT class, division, version, 'x_error', 'x_abs_mean', round(avg(abs(ex)), 6) FROM f WHERE ex IS NOT NULL GROUP BY 1, 2, 3)"""


def cells(spark, sf_dir) -> DataFrame:
    from drivegauge.operators import statistics as st

    rows = me.recall_precision(st.with_regions(matched(spark, sf_dir, "type_classification", "road_user"), st.regions_table(spark))).withColumn("version", F.when(c("scenario_no") % 2 == 0, "v1").otherwise("v2")).withColumn("ex", F.abs(c("pred_x") - c("gt_x")))
    agg = rows.groupBy("class", "division", "version").agg(F.round(F.sum("TP") / F.when(F.sum(c("TP") + c("FN")) > 0, F.sum(c("TP") + c("FN"))), 6).alias("recall"), F.round(F.avg("ex"), 6).alias("x_abs_mean"))
    long = agg.unpivot(["class", "division", "version"], ["recall", "x_abs_mean"], "stat", "value").filter("value IS NOT NULL")
    return long.withColumn("metric", F.when(c("stat") == "recall", "recall_precision").otherwise("x_error"))


_TARGETS = ", th(metric, stat, class, division, thr) AS (VALUES ('recall_precision', 'recall', 'car', 'near', 0.8E0), ('recall_precision', 'recall', 'car', 'far', 0.9E0), ('x_error', 'x_abs_mean', 'car', 'near', 0.4E0), ('x_error', 'x_abs_mean', 'truck_bus', 'near', 0.39E0)), tg AS (SELECT cell.*, thr * CASE WHEN metric = 'x_error' THEN 0.9E0 ELSE 1 END AS target FROM cell LEFT JOIN th USING (metric, stat, class, division))"
THRESHOLDS = [("recall_precision", "recall", "car", "near", 0.8), ("recall_precision", "recall", "car", "far", 0.9), ("x_error", "x_abs_mean", "car", "near", 0.4), ("x_error", "x_abs_mean", "truck_bus", "near", 0.39)]


def judged(spark, sf_dir) -> DataFrame:
    th = spark.createDataFrame(THRESHOLDS, "metric string, stat string, class string, division string, value double")
    ratios = spark.createDataFrame([("x_error", "x_abs_mean", 202401, 0.9)], "metric string, stat string, date_label int, ratio double")
    t = rp.with_targets(cells(spark, sf_dir).withColumnRenamed("value", "result"), th, ratios, 202401)
    return t.withColumn("verdict", rp.verdict(c("result"), c("target"), c("stat") == "recall"))


@query(_CELLS + _TARGETS + " SELECT class, division, version, metric, stat, value AS result, round(target, 6) AS target FROM tg")
def j10_kpi_targets(spark, sf_dir):
    return judged(spark, sf_dir).select("class", "division", "version", "metric", "stat", "result", F.round("target", 6).alias("target"))


_VERDICT = _CELLS + _TARGETS + ", vd AS (SELECT *, CASE WHEN target IS NULL THEN -1 WHEN stat = 'recall' THEN CASE WHEN value > target THEN 1 ELSE 0 END WHEN value > target THEN 0 ELSE 1 END AS verdict FROM tg)"


@query(_VERDICT + " SELECT class, division, version, stat, verdict FROM vd")
def r02_verdicts(spark, sf_dir):
    return judged(spark, sf_dir).select("class", "division", "version", "stat", "verdict")


@query(_VERDICT + " SELECT class, version, coalesce(min(CASE WHEN verdict >= 0 THEN verdict END), -1) AS all_pass, coalesce(max(CASE WHEN verdict >= 0 THEN verdict END), -1) AS any_pass FROM vd GROUP BY 1, 2")
def r02_merged_verdicts(spark, sf_dir):
    return judged(spark, sf_dir).groupBy("class", "version").agg(rp.merge_verdicts(True).alias("all_pass"), rp.merge_verdicts(False).alias("any_pass"))


@query(_VERDICT + " SELECT version, sum(CASE WHEN verdict = 1 THEN 1 ELSE 0 END)::BIGINT AS passed, sum(CASE WHEN verdict = 0 THEN 1 ELSE 0 END)::BIGINT AS failed, round(CASE WHEN sum(CASE WHEN verdict >= 0 THEN 1 ELSE 0 END) > 0 THEN sum(CASE WHEN verdict = 1 THEN 1 ELSE 0 END) / sum(CASE WHEN verdict >= 0 THEN 1 ELSE 0 END) END, 6) AS pass_rate FROM vd GROUP BY 1")
def a18_pass_totals(spark, sf_dir):
    return rp.pass_totals(judged(spark, sf_dir), ["version"])


@query(_CELLS + " SELECT class, division, version, max(value) FILTER (stat = 'recall') AS recall, max(value) FILTER (stat = 'x_abs_mean') AS x_abs_mean FROM cell GROUP BY 1, 2, 3")
def r01_report_pivot(spark, sf_dir):
    return rp.pivot_report(cells(spark, sf_dir), ["class", "division", "version"], "stat", ["recall", "x_abs_mean"], "value")


@query(_CELLS + """, w AS (SELECT a.class, a.division, a.stat, a.value, b.value AS previous FROM cell a JOIN cell b ON a.class = b.class AND a.division = b.division AND a.stat = b.stat AND a.version = 'v2' AND b.version = 'v1'),
x AS (SELECT *, CASE WHEN stat = 'recall' THEN previous - value ELSE (value - previous) / greatest(abs(previous), abs(value)) END AS change FROM w)
SELECT class, division, stat, round(change, 6) + 0.0E0 AS change, CASE WHEN change > CASE WHEN stat = 'recall' THEN 0.01E0 ELSE 0.02E0 END THEN 'WORSE' WHEN change < CASE WHEN stat = 'recall' THEN -0.01E0 ELSE -0.02E0 END THEN 'BETTER' ELSE 'SAME' END AS label FROM x""")
def r03_regressions(spark, sf_dir):
    out = rp.regressions(cells(spark, sf_dir), ["class", "division", "stat"], "version", {"recall": 0.01, "x_abs_mean": 0.02})
    return out.select("class", "division", "stat", r6(c("change")).alias("change"), "label")


@query(_CELLS + " SELECT a.class, a.division, a.stat, round(a.value - b.value, 6) + 0.0E0 AS delta FROM cell a LEFT JOIN cell b ON a.class = b.class AND a.division = b.division AND a.stat = b.stat AND b.version = 'v1' WHERE a.version = 'v2'")
def j19_version_delta(spark, sf_dir):
    return rp.version_delta_at_once(cells(spark, sf_dir), ["class", "division", "stat"], "version", "v2", "v1").select("class", "division", "stat", r6(c("delta")).alias("delta"))


@query(_CELLS + " SELECT coalesce(a.class, b.class) AS class, coalesce(a.division, b.division) AS division, a.value AS recall, b.value AS x_abs_mean FROM (SELECT * FROM cell WHERE stat = 'recall' AND version = 'v1') a FULL JOIN (SELECT * FROM cell WHERE stat = 'x_abs_mean' AND version = 'v2') b ON a.class = b.class AND a.division = b.division")
def j18_merge_metrics(spark, sf_dir):
    x = stored(cells(spark, sf_dir), "cells")
    a = x.filter("stat = 'recall' AND version = 'v1'").select("class", "division", c("value").alias("recall"))
    return a.join(x.filter("stat = 'x_abs_mean' AND version = 'v2'").select("class", "division", c("value").alias("x_abs_mean")), ["class", "division"], "full")


@query(_CELLS + " SELECT class, division, value FROM cell WHERE version = 'v1' AND stat = 'recall'")
def r06_slicer(spark, sf_dir):
    return cells(spark, sf_dir).filter("version = 'v1' AND stat = 'recall'").select("class", "division", "value")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def r05_result_flatten(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "map<string,bigint>")["k"].alias("k"))


_FN = MATCH + ", b AS (SELECT gt_cls AS class, scenario_no, gt_id AS id, frame_ts_us FROM m WHERE gt_flag = 1 AND pred_flag = 0)"


def _misses(spark, sf_dir) -> DataFrame:
    return matched(spark, sf_dir).filter("gt_flag = 1 AND pred_flag = 0").select(c("gt_type_classification").alias("class"), "scenario_no", c("gt_id").alias("id"), "frame_ts_us")


@query(_FN + ", k AS (SELECT class, scenario_no, id, row_number() OVER (PARTITION BY class ORDER BY count(*) DESC, scenario_no, id) AS r FROM b GROUP BY 1, 2, 3) SELECT b.* FROM b JOIN k USING (class, scenario_no, id) WHERE r <= 3")
def k01_frequent_offenders(spark, sf_dir):
    return rp.frequent_offenders(_misses(spark, sf_dir), 3)


@query(MATCH + PLACED + ", e AS (SELECT DISTINCT gt_cls AS class, scenario_no, gt_id AS id, frame_ts_us, abs(pred_x - gt_x) AS er FROM s WHERE gt_flag = 1 AND pred_flag = 1), k AS (SELECT class, scenario_no, id, count(*) AS n, round(avg(er), 6) AS mean_error FROM e GROUP BY 1, 2, 3 HAVING count(*) >= 5), r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY mean_error DESC, scenario_no, id) AS rank FROM k) SELECT class, scenario_no, id, n, mean_error, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3")
def k02_worst_offenders(spark, sf_dir):
    e = _errors(spark, sf_dir).select(c("gt_type_classification").alias("class"), "scenario_no", c("gt_id").alias("id"), "frame_ts_us", F.abs("ex").alias("er")).distinct()
    return rp.worst_offenders(e, "er", 3, 5)


@query(_FN + ", k AS (SELECT *, count(*) OVER (PARTITION BY scenario_no, id) AS n, row_number() OVER (PARTITION BY scenario_no, id ORDER BY frame_ts_us) AS r FROM b) SELECT class, scenario_no, id, frame_ts_us FROM k WHERE n >= 3 AND r = n // 2 + 1")
def k03_median_frame(spark, sf_dir):
    return rp.median_frame(_misses(spark, sf_dir), ["scenario_no", "id"], "frame_ts_us", 3)


@query(_FN + " SELECT scenario_no, id, frame_ts_us, substr(sha256('v1-' || scenario_no || '-fn-' || id), 1, 8) AS uuid FROM b")
def r07_failure_summary(spark, sf_dir):
    return _misses(spark, sf_dir).select("scenario_no", "id", "frame_ts_us", ex.stable_id(F.lit("v1"), c("scenario_no").cast("string"), F.lit("fn"), c("id").cast("string")).alias("uuid"))


@query(_FN + " SELECT frame_ts_us, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids, CAST(round((frame_ts_us / 1e6 - 0.5E0) * 30) AS BIGINT) AS frame_index FROM b GROUP BY 1")
def r08_render_plan(spark, sf_dir):
    g = _misses(spark, sf_dir).groupBy("frame_ts_us").agg(F.array_join(F.transform(F.array_sort(F.collect_set("id")), lambda x: x.cast("string")), ",").alias("ids"))
    return g.withColumn("frame_index", ex.frame_index(c("frame_ts_us") / 1e6, F.lit(0.5), F.lit(30)))


@query(_FN + " SELECT b.class, b.frame_ts_us, b.id FROM b WHERE NOT (class = 'pedestrian' AND scenario_no % 2 = 0) AND class <> 'cyclist'")
def f11_suppression(spark, sf_dir):
    b = _misses(spark, sf_dir).withColumn("parity", c("scenario_no") % 2)
    rules = spark.createDataFrame([("pedestrian", 0), ("cyclist", 0), ("cyclist", 1)], "class string, parity long")
    return b.join(F.broadcast(rules), ["class", "parity"], "left_anti").select("class", "frame_ts_us", "id")


@query(MATCH + " SELECT frame_ts_us, gt_id FROM m WHERE gt_flag = 1 AND pred_flag = 0 AND abs(gt_x) < 80 AND gt_id NOT IN (3, 4) AND NOT (gt_cls = 'cyclist' AND sqrt(gt_vx * gt_vx + gt_vy * gt_vy) <= 2)")
def f10_failure_rules(spark, sf_dir):
    m = matched(spark, sf_dir).filter("gt_flag = 1 AND pred_flag = 0")
    slow = (c("gt_type_classification") == "cyclist") & (F.sqrt(c("gt_vx") ** 2 + c("gt_vy") ** 2) <= 2)
    return m.filter((F.abs("gt_x") < 80) & ~c("gt_id").isin(3, 4) & ~F.coalesce(slow, F.lit(False))).select("frame_ts_us", "gt_id")


# packages and lists: documents are objects, their source the package

PACK = "WITH p AS (SELECT source AS package, sum(n_chars)::BIGINT AS size, count(*) AS files FROM documents GROUP BY 1)"


def packages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(c("source").alias("package")).agg(F.sum("n_chars").alias("size"), F.count("*").alias("files"))


@query(PACK + ", r AS (SELECT *, sum(size) OVER (ORDER BY size, package ROWS UNBOUNDED PRECEDING) AS s, (SELECT sum(size) FROM p) AS t FROM p) SELECT package, size, files FROM r WHERE s * 1.5E0 < 800000")
def a15_package_budget(spark, sf_dir):
    return rp.running_budget(packages(spark, sf_dir), "size", ["size", "package"], 800000.0)


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)")
def a23_rollup(spark, sf_dir):
    return table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("n"))


@query("WITH s AS (SELECT source AS package, n_chars, CASE doc_id % 3 WHEN 0 THEN 'prepared' WHEN 1 THEN 'tested' ELSE 'invalid' END AS status FROM documents) SELECT package, count(*) FILTER (status = 'prepared') AS prepared_n, (sum(n_chars) FILTER (status = 'prepared'))::BIGINT AS prepared_size, count(*) FILTER (status = 'tested') AS tested_n FROM s GROUP BY 1")
def a16_status_rollup(spark, sf_dir):
    s = table(spark, sf_dir, "documents").withColumn("status", F.when(c("doc_id") % 3 == 0, "prepared").when(c("doc_id") % 3 == 1, "tested").otherwise("invalid"))
    wide = s.groupBy(c("source").alias("package")).pivot("status", ["prepared", "tested"]).agg(F.count("doc_id").alias("n"), F.sum("n_chars").alias("size"))
    return wide.select("package", F.coalesce("prepared_n", F.lit(0).cast("long")).alias("prepared_n"), "prepared_size", F.coalesce("tested_n", F.lit(0).cast("long")).alias("tested_n"))


@query("SELECT lang, source, string_agg(DISTINCT CAST(doc_id % 4 AS VARCHAR), ',' ORDER BY CAST(doc_id % 4 AS VARCHAR)) AS attachments, count(*) AS n FROM documents WHERE n_chars > 500 GROUP BY 1, 2")
def a17_failure_groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("n_chars > 500")
    return d.groupBy("lang", "source").agg(F.array_join(F.array_sort(F.collect_set((c("doc_id") % 4).cast("string"))), ",").alias("attachments"), F.count("*").alias("n"))


@query("WITH u AS (SELECT o_custkey AS id, 1 AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey, c_custkey % 2 FROM customer) SELECT id, sum(n)::BIGINT AS failures, CASE WHEN sum(n) > 1 THEN 'BAD' ELSE 'GOOD' END AS state FROM u GROUP BY 1")
def a20_ledger(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), (c("c_custkey") % 2).alias("failures"))
    return rp.ledger(old, table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(c("o_custkey").alias("id")), "id")


@query("SELECT md5(c_mktsegment) AS checksum, count(*) AS scenarios, min(c_custkey) AS first FROM customer GROUP BY 1")
def a22_calibration_groups(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy(ex.content_checksum(c("c_mktsegment")).alias("checksum")).agg(F.count("*").alias("scenarios"), F.min("c_custkey").alias("first"))


@query("WITH a AS (SELECT doc_id AS path, n_chars AS s FROM documents WHERE doc_id % 7 <> 0), b AS (SELECT doc_id AS path, n_chars + CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END AS s FROM documents WHERE doc_id % 5 <> 0) SELECT coalesce(a.path, b.path) AS path, a.s AS size_a, b.s AS size_b FROM a FULL JOIN b ON a.path = b.path WHERE a.s IS NULL OR b.s IS NULL OR a.s <> b.s")
def s17_manifest_diff(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(c("doc_id").alias("path"), c("n_chars").alias("size"))
    return rp.manifest_diff(d.filter("path % 7 <> 0"), d.filter("path % 5 <> 0").withColumn("size", c("size") + F.when(c("path") % 11 == 0, 1).otherwise(0)), "path", "size")


@query("SELECT DISTINCT o_custkey AS uuid FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def s16_new_results(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(c("o_custkey").alias("uuid"))
    return rp.new_rows(o, table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(c("c_custkey").alias("uuid")), "uuid")


@query("SELECT source || '/' || doc_id AS key FROM documents WHERE (source LIKE '%src1%' OR source LIKE '%src2%') AND source NOT LIKE '%9%' AND doc_id % 10 <> 0")
def s12_package_listing(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat("source", F.lit("/"), "doc_id").alias("key"), "doc_id", "source")
    done = d.filter("doc_id % 10 = 0")
    return rd.package_listing(d.filter("source NOT LIKE '%9%'"), "key", ["src1", "src2"], ["none"], done).select("key")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def f09_invalid_exclusion(spark, sf_dir):
    bad = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(c("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").join(bad, "l_orderkey", "left_anti").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT doc_id FROM documents WHERE lang IN ('en', 'de') AND source IN ('src1', 'src2', 'src3')")
def f13_in_lists(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    for field, values in {"lang": ["en", "de"], "source": ["src1", "src2", "src3"]}.items():
        d = d.filter(c(field).isin(*values))
    return d.select("doc_id")


@query("SELECT o_orderkey AS id, o_custkey, coalesce(c_nationkey, -1) AS tests FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 2 = 0")
def j17_test_records(spark, sf_dir):
    old = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(c("c_custkey").alias("o_custkey"), "c_nationkey")
    return table(spark, sf_dir, "orders").join(old, "o_custkey", "left").select(c("o_orderkey").alias("id"), "o_custkey", F.coalesce("c_nationkey", F.lit(-1)).alias("tests"))


@query("SELECT c_custkey AS id, c_mktsegment AS road FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) AND c_custkey IN (SELECT s_suppkey FROM supplier) ")
def j16_three_way(spark, sf_dir):
    cu = table(spark, sf_dir, "customer")
    return cu.join(table(spark, sf_dir, "orders").select(c("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").join(table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("c_custkey")), "c_custkey", "left_semi").select(c("c_custkey").alias("id"), c("c_mktsegment").alias("road"))


@query("SELECT a.c_custkey AS record, b.s_suppkey AS vehicle FROM customer a JOIN supplier b ON a.c_nationkey = b.s_nationkey AND a.c_custkey % 10 = b.s_suppkey % 10")
def j13_recording_vehicle(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(c("c_custkey").alias("record"), c("c_nationkey").alias("day"), (c("c_custkey") % 10).alias("alias"))
    b = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("vehicle"), c("s_nationkey").alias("day"), (c("s_suppkey") % 10).alias("alias"))
    return rp.all_pairs(a, b, ["day", "alias"]).select("record", "vehicle")


@query("WITH s AS (SELECT user_id AS id, event_type, min('/d/' || event_id) AS p FROM events WHERE user_id % 6 <> 0 OR event_type = 'view' GROUP BY 1, 2) SELECT id, max(p) FILTER (event_type = 'view') AS view, max(p) FILTER (event_type = 'click') AS click, max(p) FILTER (event_type = 'error') AS error, CASE WHEN count(*) FILTER (event_type IN ('view', 'click', 'error')) = 3 OR (count(*) FILTER (event_type = 'view') = 1 AND count(*) FILTER (event_type IN ('click', 'error')) = 0) THEN true ELSE false END AS complete FROM s GROUP BY 1")
def r10_completeness(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("user_id % 6 <> 0 OR event_type = 'view'")
    wide = e.groupBy(c("user_id").alias("id")).pivot("event_type", ["view", "click", "error"]).agg(F.min(F.concat(F.lit("/d/"), "event_id")))
    return rd.complete(wide, ["view", "click", "error"], ["click", "error"])


@query("WITH p AS (SELECT user_id, min(value) FILTER (event_type = 'view') AS front, min(value) FILTER (event_type = 'click') AS left_ FROM events GROUP BY 1) SELECT user_id AS id, 'front' AS camera, front AS v, 1 AS card FROM p WHERE front IS NOT NULL UNION ALL SELECT user_id, 'left_', left_, 2 FROM p WHERE left_ IS NOT NULL")
def r11_channel_plan(spark, sf_dir):
    w = table(spark, sf_dir, "events").groupBy(c("user_id").alias("id")).agg(F.min(F.when(c("event_type") == "view", c("value"))).alias("front"), F.min(F.when(c("event_type") == "click", c("value"))).alias("left_"))
    plan = F.broadcast(spark.createDataFrame([("front", 1), ("left_", 2)], "camera string, card int"))
    return w.unpivot(["id"], ["front", "left_"], "camera", "v").filter("v IS NOT NULL").join(plan, "camera").select("id", "camera", "v", "card")


@query("SELECT o_custkey AS id, count(DISTINCT o_orderdate) AS tests, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders GROUP BY 1")
def r09_test_history(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy(c("o_custkey").alias("id")).agg(F.array_sort(F.collect_set("o_orderdate")).alias("h"))
    return g.select("id", F.size("h").cast("long").alias("tests"), F.date_format(F.element_at("h", -1), "yyyy-MM-dd").alias("last"))


@query("SELECT DISTINCT l_shipdate::DATE::VARCHAR AS d FROM lineitem")
def u04_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("d")).distinct()


@query("SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_custkey % 3 = 0")
def u02_intersection(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(c("s_nationkey").alias("k")).intersect(table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select("c_nationkey"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 7 = 0")
def u03_difference(spark, sf_dir):
    seen = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F' AND o_orderkey % 7 = 0").select(c("o_custkey").alias("k"))
    return table(spark, sf_dir, "customer").select(c("c_custkey").alias("k")).join(seen, "k", "left_anti").distinct()


@query("SELECT s_suppkey AS id, s_name AS name, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def u01_union(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name"))
    return s.unionByName(table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment")), allowMissingColumns=True)
