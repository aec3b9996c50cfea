"""Queries over the evaluator drivers, report tables, stores, registries and global orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivegauge.functions import expressions as ex
from drivegauge.operators import evaluate as ev
from drivegauge.operators import lines as ln
from drivegauge.operators import report as rp
from drivegauge.operators import slots as sl
from drivegauge.operators import timeline as tl
from drivegauge.sources import readers as rd
from drivegauge.sources.scratch import scratch_dir

from .fixtures import table
from .object_queries import MATCH, matched
from .registry import query
from .report_queries import _CELLS, _FN, LINE, SLOT, SLOT_REGIONS, _misses, cells, slots

c, r6 = F.col, ex.r6

_LIMITS = {"y_error": {"limit": 0.2501, "limit_pct": 0.02001}, "vx_error": {"limit": 0.3501}, "yaw_error": {"limit_deg": 3.0001}, "length_error": {"limit": 0.2001, "limit_pct": 0.0401}}
_TURN = "((pred_yaw - gt_yaw + pi()) % (2 * pi()) + 2 * pi()) % (2 * pi()) - pi()"


def _long(name: str, value: str, share: str | None = None, bad: str = "false", digits: int = 6) -> str:
    share = f"round({share}, {digits}) + 0.0E0" if share else "NULL::DOUBLE"
    return f"SELECT frame_ts_us, gt_id, pred_id, '{name}' AS metric, NULL::VARCHAR AS outcome, round({value}, {digits}) + 0.0E0 AS value, {share} AS share, CASE WHEN {bad} THEN 1 ELSE 0 END::INTEGER AS abnormal FROM t"


_M13 = MATCH + """, t AS (SELECT *, CASE WHEN abs(gt_x) < 50 THEN pred_x - gt_x ELSE pred_closest_pt_x - gt_closest_pt_x END AS ex, CASE WHEN abs(gt_x) < 50 THEN greatest(20, abs(gt_x)) ELSE greatest(20, abs(gt_closest_pt_x)) END AS dx, """ + _TURN + """ AS turn FROM m WHERE gt_flag = 1 AND pred_flag = 1)
SELECT frame_ts_us, gt_id, pred_id, 'recall_precision' AS metric, CASE WHEN gt_flag = 1 AND pred_flag = 1 THEN 'TP' WHEN gt_flag = 1 THEN 'FN' ELSE 'FP' END AS outcome, NULL::DOUBLE AS value, NULL::DOUBLE AS share, CASE WHEN gt_flag = 1 AND pred_flag = 1 AND gt_cls = pred_cls THEN 0 ELSE 1 END::INTEGER AS abnormal FROM m
UNION ALL SELECT frame_ts_us, gt_id, pred_id, 'x_error', NULL, CASE WHEN abs(gt_x) <= 20 THEN round(ex, 4) + 0.0E0 END, CASE WHEN abs(gt_x) > 20 THEN round(ex / dx, 4) + 0.0E0 END, CASE WHEN CASE WHEN abs(gt_x) <= 20 THEN abs(ex) > 1 ELSE abs(ex / dx) > 0.05E0 END THEN 1 ELSE 0 END::INTEGER FROM t
UNION ALL """ + " UNION ALL ".join([
    _long("y_error", "pred_y - gt_y", "(pred_y - gt_y) / greatest(10, abs(gt_y))", "abs(pred_y - gt_y) > 0.2501E0 AND abs((pred_y - gt_y) / greatest(10, abs(gt_y))) > 0.02001E0"),
    _long("vx_error", "pred_vx - gt_vx", "(pred_vx - gt_vx) / greatest(2, abs(gt_vx))", "abs(pred_vx - gt_vx) > 0.3501E0"),
    _long("vy_error", "pred_vy - gt_vy", "(pred_vy - gt_vy) / greatest(2, abs(gt_vy))", "abs(pred_vy - gt_vy) > 1"),
    _long("yaw_error", "degrees(CASE WHEN abs(turn) > 2 * pi() / 3 THEN ((turn + 2 * pi()) % (2 * pi()) + 2 * pi()) % (2 * pi()) - pi() ELSE turn END)", None, "abs(turn) > 2 * pi() / 3 OR abs(degrees(turn)) > 3.0001E0", 4),
    _long("length_error", "pred_length - gt_length", "(pred_length - gt_length) / gt_length", "abs(pred_length - gt_length) > 0.2001E0 AND abs((pred_length - gt_length) / gt_length) > 0.0401E0"),
    _long("width_error", "pred_width - gt_width", "(pred_width - gt_width) / gt_width", "abs(pred_width - gt_width) > 0.5E0 AND abs((pred_width - gt_width) / gt_width) > 0.2E0"), _long("height_error", "pred_height - gt_height", "(pred_height - gt_height) / gt_height", "abs(pred_height - gt_height) > 0.5E0 AND abs((pred_height - gt_height) / gt_height) > 0.2E0"),
])


@query(_M13)
def m13_evaluate_obstacles(spark, sf_dir):
    """All metrics of obstacles by name, in long form."""
    long = ev.evaluate(matched(spark, sf_dir), "obstacles", ["frame_ts_us", "gt_id", "pred_id"], None, _LIMITS)
    fine = c("metric").isin("x_error", "yaw_error")
    return long.withColumns({k: F.when(fine, F.round(k, 4)).otherwise(F.round(k, 6)) + F.lit(0.0) for k in ("value", "share")})


def slot_sides(spark, sf_dir) -> DataFrame:
    """Slots with the derived columns of both sides; the prediction's corners drift by their number."""
    keep = ["type", "type_classification", "region", "in_border_distance", "in_border_length", "slot_length", "slot_heading", *[f"pt_{i}_{a}" for i in range(4) for a in "xy"]]
    g = sl.pipeline(slots(spark, sf_dir), SLOT_REGIONS, True)
    moved = g.select("id", *[c(k).alias(f"gt_{k}") for k in keep], c("type"), *[(c(f"pt_{i}_{a}") + (c("id") % 9 - 4) * 0.1 * (i + 1)).alias(f"pt_{i}_{a}") for i in range(4) for a in "xy"])
    p = sl.pipeline(moved, SLOT_REGIONS, False)
    return p.select("id", *[f"gt_{k}" for k in keep], *[c(k).alias(f"pred_{k}") for k in keep], F.lit(1).alias("gt_flag"), F.lit(1).alias("pred_flag"))


_LENGTHS = {
    "in_border_distance": "sqrt((({0}pt_0_x + {0}pt_1_x) / 2) * (({0}pt_0_x + {0}pt_1_x) / 2) + (({0}pt_0_y + {0}pt_1_y) / 2) * (({0}pt_0_y + {0}pt_1_y) / 2))",
    "in_border_length": "sqrt(({0}pt_0_x - {0}pt_1_x) * ({0}pt_0_x - {0}pt_1_x) + ({0}pt_0_y - {0}pt_1_y) * ({0}pt_0_y - {0}pt_1_y))",
    "slot_length": "(sqrt(({0}pt_0_x - {0}pt_2_x) * ({0}pt_0_x - {0}pt_2_x) + ({0}pt_0_y - {0}pt_2_y) * ({0}pt_0_y - {0}pt_2_y)) + sqrt(({0}pt_1_x - {0}pt_3_x) * ({0}pt_1_x - {0}pt_3_x) + ({0}pt_1_y - {0}pt_3_y) * ({0}pt_1_y - {0}pt_3_y))) / 2",
}
_PAIR = SLOT + ", m AS (SELECT id, type, " + ", ".join(f"pt_{i}_{a} AS gpt_{i}_{a}, pt_{i}_{a} + (id % 9 - 4) * 0.1E0 * {i + 1} AS ppt_{i}_{a}" for i in range(4) for a in "xy") + " FROM g) "
_DELTA = {k: f"{v.format('p')} - {v.format('g')}" for k, v in _LENGTHS.items()}


@query(_PAIR + "SELECT id, " + ", ".join(f"round({v}, 5) + 0.0E0 AS {k}_error, CASE WHEN abs({v}) > 0.3001E0 THEN 1 ELSE 0 END::INTEGER AS {k}_error_abnormal" for k, v in _DELTA.items()) + " FROM m")
def m10_slot_lengths(spark, sf_dir):
    from drivegauge.operators import metrics as me

    out = slot_sides(spark, sf_dir)
    for k in _LENGTHS:
        out = me.slot_error(out, k, 1.0, 0.3001)
    return out.select("id", *[e for k in _LENGTHS for e in ((F.round(f"{k}_error", 5) + 0.0).alias(f"{k}_error"), f"{k}_error_abnormal")])


@query(_PAIR + ", e AS (SELECT * FROM m WHERE type <> 0) " + " UNION ALL ".join(f"SELECT id, '{k}_error' AS metric, round({v}, 5) + 0.0E0 AS value, CASE WHEN abs({v}) > 0.3001E0 THEN 1 ELSE 0 END::INTEGER AS abnormal FROM e" for k, v in _DELTA.items()))
def m13_evaluate_slots(spark, sf_dir):
    """Three metrics of slots by name; unknown predictions do not take part."""
    names = [f"{k}_error" for k in _LENGTHS]
    rows = slot_sides(spark, sf_dir).withColumn("gt_region", F.lit(None).cast("int"))
    return ev.evaluate(rows, "slots", ["id"], names, {k: {"limit": 0.3001} for k in names}).select("id", "metric", (F.round("value", 5) + 0.0).alias("value"), "abnormal")


_CLASS = "CASE WHEN id % 3 = 2 THEN 'fence' WHEN id % 3 = 1 AND {0} IN (1, 8) THEN 'main_lane' WHEN id % 3 = 1 AND {0} IN (2, 3, 9, 10) THEN 'secondary_lane' END"
_M13_LINES = LINE + f""", k AS (SELECT *, {_CLASS.format("id % 12")} AS gcls, {_CLASS.format("(id + id % 2) % 12")} AS pcls, id % 10 <> 5 AS g, id % 10 <> 9 AS p FROM o),
e AS (SELECT * FROM k WHERE CASE WHEN g THEN gcls ELSE pcls END IS NOT NULL AND id % 7 <> 0),
x AS (SELECT id, unnest([2.5, 12.5, 22.5, 32.5, 42.5, 52.5, 62.5, 72.5]::DOUBLE[]) AS x, c0, c1, c2 FROM e WHERE g AND p),
y AS (SELECT id, x, abs(c0 + c1 * x + c2 * x * x + 0.2E0 - (c0 + c1 * (x - 2.5E0) + c2 * (x - 2.5E0) * (x - 2.5E0) + c0 + c1 * (x + 2.5E0) + c2 * (x + 2.5E0) * (x + 2.5E0)) / 2) AS d FROM x),
z AS (SELECT id, avg(d) FILTER (x < 30) AS a, avg(d) FILTER (x >= 30 AND x < 60) AS b FROM y GROUP BY 1),
t AS (SELECT id, a, b, abs(degrees(atan(c1 + 0.02E0)) - degrees(atan(c1))) AS h0, abs(degrees(atan(c1 + 100 * c2)) - degrees(atan(c1))) AS h50 FROM e JOIN z USING (id)),
v AS (SELECT id, 'lateral_0_30' AS metric, a AS value, 0.20123E0 AS most FROM t UNION ALL SELECT id, 'lateral_30_60', b, 0.20123E0 FROM t UNION ALL SELECT id, 'lateral_60_120', NULL, 0.20123E0 FROM t
UNION ALL SELECT id, 'lateral_over', (greatest(a - 0.20123E0, 0) + greatest(b - 0.20123E0, 0)) / 2, 0 FROM t
UNION ALL SELECT id, 'heading_0_error', h0, 1.0001E0 FROM t UNION ALL SELECT id, 'heading_50_error', h50, 1.0001E0 FROM t UNION ALL SELECT id, 'heading_over', (greatest(h0 - 1.0001E0, 0) + greatest(h50 - 1.0001E0, 0)) / 2, 0 FROM t)
SELECT id, 'recall_precision' AS metric, CASE WHEN g AND p THEN 'TP' WHEN g THEN 'FN' ELSE 'FP' END AS outcome, NULL::DOUBLE AS value, CASE WHEN g AND p AND gcls = pcls THEN 0 ELSE 1 END::INTEGER AS abnormal FROM e
UNION ALL SELECT id, metric, NULL, round(value + 1e-7, 4), CASE WHEN value > most THEN 1 ELSE 0 END::INTEGER FROM v"""


@query(_M13_LINES)
def m13_evaluate_lines(spark, sf_dir):
    """All metrics of lines by name: lateral offsets by band, headings at 0 and 50 m, means beyond the limits."""
    p, i = c("o_totalprice"), c("id")
    o = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), (p % 7 - 3.5).alias("k0"), ((p % 11 - 5.5) / 100).alias("k1"), ((p % 13 - 6.5) / 10000).alias("k2"))
    pts = lambda xs, d: F.transform(F.array(*[F.lit(float(v)) for v in xs]), lambda x: F.struct(x.alias("x"), (c("k0") + c("k1") * x + c("k2") * x * x + d).alias("y")))
    angle = lambda slope: F.degrees(F.atan(slope))
    radius = F.when(i % 7 != 0, F.coalesce(F.try_divide(F.lit(1.0), F.abs(2 * c("k2"))), F.lit(float("inf"))))
    truth = {"gt_flag": F.when(i % 10 != 5, 1).otherwise(0), "gt_type_classification": ln.line_class(i % 3, i % 12), "gt_radius": radius, "gt_points": pts(range(0, 85, 5), 0.0), "gt_heading_0": angle(c("k1")), "gt_heading_50": angle(c("k1"))}
    found = {"pred_flag": F.when(i % 10 != 9, 1).otherwise(0), "pred_type_classification": ln.line_class(i % 3, (i + i % 2) % 12), "pred_radius": radius, "pred_points": pts([2.5 + 10 * k for k in range(8)], 0.2), "pred_heading_0": angle(c("k1") + 0.02), "pred_heading_50": angle(c("k1") + 100 * c("k2"))}
    limits = {**{f"lateral_{k}": {"limit": 0.20123} for k in ("0_30", "30_60", "60_120", "over")}, **{f"heading_{k}": {"limit": 1.0001} for k in ("0_error", "50_error", "over")}}
    rows = ev.evaluate(o.select("id", *[v.alias(k) for k, v in {**truth, **found}.items()]), "lines", ["id"], None, limits)
    return rows.select("id", "metric", "outcome", F.round(c("value") + 1e-7, 4).alias("value"), "abnormal")


@query(SLOT + ", d AS (SELECT id, type, (pt_0_x + pt_1_x + pt_2_x + pt_3_x) / 4 AS x, (pt_0_y + pt_1_y + pt_2_y + pt_3_y) / 4 AS y, " + ", ".join(f"{v.format('')} AS {k}" for k, v in _LENGTHS.items()) + """ FROM g)
SELECT id, CASE type WHEN 1 THEN 'vertical' WHEN 2 THEN 'parallel' WHEN 3 THEN 'oblique' ELSE 'unknown' END AS type_classification, round(x, 5) + 0.0E0 AS center_x, round(y, 5) + 0.0E0 AS center_y, round(sqrt(x * x + y * y), 5) AS slot_distance, round(in_border_distance, 5) AS in_border_distance, round(slot_length, 5) AS slot_length FROM d""")
def q07_slot_pipeline(spark, sf_dir):
    p = sl.pipeline(slots(spark, sf_dir), SLOT_REGIONS, False)
    return p.select("id", "type_classification", *[(F.round(k, 5) + 0.0).alias(k) for k in ("center_x", "center_y")], *[F.round(k, 5).alias(k) for k in ("slot_distance", "in_border_distance", "slot_length")])


@query(_CELLS + " SELECT version, class, division, max(value) FILTER (stat = 'recall') AS recall, max(value) FILTER (stat = 'x_abs_mean') AS x_abs_mean FROM cell GROUP BY 1, 2, 3")
def s15_report_table(spark, sf_dir):
    """A report table per tag, written to the shared folder and read back."""
    path = scratch_dir(spark, "report")
    rd.write_report_table(cells(spark, sf_dir), path, "version", ["class", "division"], "stat", ["recall", "x_abs_mean"], "value")
    return spark.read.schema("class string, division string, recall double, x_abs_mean double, version string").parquet(path)


@query("SELECT c_custkey AS uuid, 'old' AS origin FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT DISTINCT o_custkey, 'new' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def s16_upsert_results(spark, sf_dir):
    """A store of results that takes each key once, however often its rows are sent."""
    path = scratch_dir(spark, "results")
    table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(c("c_custkey").alias("uuid"), F.lit("old").alias("origin")).write.parquet(path)
    sent = table(spark, sf_dir, "orders").select(c("o_custkey").alias("uuid"), F.lit("new").alias("origin"))
    for _ in range(2):
        rd.append_new(sent, path, "uuid")
    return spark.read.schema("uuid long, origin string").parquet(path)


@query("SELECT p_brand AS topic, p_type AS msg_type, CAST(p_size AS BIGINT) AS pub_count, p_partkey % 2 = 0 AS topic_header_flag FROM part WHERE p_brand = 'Brand#2'")
def s18_registry_lookup(spark, sf_dir):
    """A registry file, read and looked up by topic."""
    path = scratch_dir(spark, "registry")
    p = table(spark, sf_dir, "part").select(c("p_partkey").alias("index"), F.lit("p").alias("package"), c("p_brand").alias("topic"), c("p_type").alias("msg_type"), c("p_size").alias("pub_count"), F.lit(1).alias("sub_count"), F.when(c("p_partkey") % 2 == 0, "TRUE").otherwise("FALSE").alias("topic_header_flag"))
    p.write.option("header", True).csv(path)
    return rd.topic_registry(spark, path).filter("topic = 'Brand#2'").select("topic", "msg_type", "pub_count", "topic_header_flag")


@query(_FN + " SELECT class, scenario_no, id, frame_ts_us, row_number() OVER (ORDER BY class, scenario_no, id, frame_ts_us) AS position FROM b")
def k07_failure_order(spark, sf_dir):
    """Failures in the order of class, scenario, target and time, with their places."""
    return rp.numbered(_misses(spark, sf_dir), ["class", "scenario_no", "id", "frame_ts_us"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS position FROM lineitem")
def k07_size_order(spark, sf_dir):
    """All rows by size, with their places."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return rp.numbered(rows, ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


TOPICS = ["click", "error", "purchase", "signup", "view"]
_LIGHT = """WITH o AS (SELECT o_orderkey AS id, dayofyear(o_orderdate) AS d, (o_orderkey % 24) * 3600 + (o_orderkey % 60) * 60 + o_orderkey % 59 + 300 * (o_orderkey % 12) AS s FROM orders),
x AS (SELECT id, s, CASE WHEN d <= 183 THEN (638 - d) / 91.0E0 ELSE (d + 272) / 91.0E0 END * 3600 AS up, CASE WHEN d <= 183 THEN (d + 1546) / 91.0E0 ELSE (1912 - d) / 91.0E0 END * 3600 AS down FROM o)
SELECT id, CASE WHEN s BETWEEN up - 1800 AND up + 1800 THEN 'dawn' WHEN s BETWEEN down - 1800 AND down + 1800 THEN 'dusk' WHEN s > up + 1800 AND s <= 43200 THEN 'morning' WHEN s > 43200 AND s < down - 1800 THEN 'afternoon' ELSE 'night' END AS part FROM x"""


@query(_LIGHT)
def p19_clip_light(spark, sf_dir):
    """Light at the start of each clip, from the clip's name alone."""
    two = lambda v: F.lpad(v.cast("string"), 2, "0")
    k = c("o_orderkey")
    name = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), two(k % 24), two(k % 60), two(k % 59), F.lit("_n"), F.lpad((k % 12 + 1).cast("string"), 6, "0"))
    return table(spark, sf_dir, "orders").select(k.alias("id"), ex.day_part(name).alias("part"))


@query("""WITH u AS (SELECT DISTINCT user_id FROM events), t AS (SELECT DISTINCT event_type FROM events), n AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE user_id % 4 <> 0 OR event_type <> 'error' GROUP BY 1, 2),
k AS (SELECT user_id, user_id % 10 AS grp, CASE WHEN user_id % 7 = 0 THEN 0 ELSE 1 END AS valid, count(*) FILTER (n IS NULL) AS empty FROM u CROSS JOIN t LEFT JOIN n USING (user_id, event_type) GROUP BY 1) SELECT grp, (sum(empty) + count(*) FILTER (valid = 0))::BIGINT AS score FROM k GROUP BY 1""")
def a13_abnormal_score(spark, sf_dir):
    """Topics without output and invalid scenarios, added up by group."""
    e = table(spark, sf_dir, "events")
    seen = [F.struct(F.lit(k).alias("topic"), F.count(F.when((c("event_type") == k) & ((c("user_id") % 4 != 0) | (c("event_type") != "error")), 1)).alias("n")) for k in TOPICS]
    wide = e.groupBy("user_id").agg(F.array(*seen).alias("t")).select("user_id", (c("user_id") % 10).alias("grp"), F.when(c("user_id") % 7 == 0, 0).otherwise(1).alias("valid"), F.explode("t").alias("t"))
    return tl.abnormal_score(wide.select("grp", "user_id", "valid", "t.topic", "t.n"), "grp", "user_id", "n", "valid")
