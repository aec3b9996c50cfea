"""Queries over sources, flatteners and scalar functions, on nested rows and log lines that Spark makes from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivegauge.functions import expressions as ex
from drivegauge.sources import flatten as fl
from drivegauge.sources import readers as rd
from drivegauge.sources.scratch import scratch_dir

from .fixtures import table
from .registry import query

c, r6 = F.col, ex.r6
L = "WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, l_partkey, l_suppkey) AS pos FROM lineitem) "


def messages(spark, sf_dir) -> DataFrame:
    """An order is a message, its lines the array of objects."""
    o = F.struct(c("l_linenumber").alias("k1"), c("l_extendedprice").alias("k2"), c("l_partkey").alias("k3"), c("l_suppkey").alias("k4"), (c("l_partkey") % 4).alias("id"), (c("l_suppkey") % 5).cast("int").alias("type"), c("l_quantity").alias("confidence"), c("l_extendedprice").alias("x"), c("l_discount").alias("y"), c("l_tax").alias("t"))
    rows = table(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("frame_id")).agg(F.array_sort(F.collect_list(o)).alias("obstacles"))
    return rows.select(F.floor(c("frame_id") / 750).alias("scenario_no"), (c("frame_id") / 10.0).alias("time_stamp"), "frame_id", "obstacles", F.size("obstacles").alias("n"))


@query(L + "SELECT l_orderkey AS frame_id, l_partkey % 4 AS id, CASE WHEN l_suppkey % 5 IN (0, 1) THEN 1 WHEN l_suppkey % 5 = 2 THEN 2 ELSE 18 END AS type, round(CASE WHEN l_quantity > 1 THEN l_quantity / 100 ELSE l_quantity END, 6) AS confidence, l_extendedprice AS x FROM l WHERE l_partkey % 4 <> 0")
def t01_tracked_obstacles(spark, sf_dir):
    return fl.tracked_obstacles(messages(spark, sf_dir)).select("frame_id", "id", "type", F.round("confidence", 6).alias("confidence"), "x")


@query(L + "SELECT l_orderkey AS frame_id, (l_orderkey * 64) % 200000 + pos - 1 AS id, l_extendedprice AS x FROM l")
def t02_bev_detections_all(spark, sf_dir):
    """All objects that the count field tells."""
    return fl.synthetic_ids(messages(spark, sf_dir), [("obstacles", "n")]).select("frame_id", "id", c("o.x").alias("x"))


@query(L + "SELECT l_orderkey AS frame_id, (l_orderkey * 64) % 200000 + pos - 1 AS id, l_discount AS y FROM l WHERE l_discount <> 0")
def t03_image_detections(spark, sf_dir):
    return fl.synthetic_ids(messages(spark, sf_dir), [("obstacles", "n")]).filter("o.y != 0").select("frame_id", "id", c("o.y").alias("y"))


@query(L + "SELECT l_orderkey AS frame_id, l_linenumber AS code, CASE l_linenumber WHEN 1 THEN 2 WHEN 2 THEN 18 ELSE 1 END AS type, CASE l_linenumber WHEN 1 THEN -1 WHEN 2 THEN -1 WHEN 3 THEN 1 WHEN 4 THEN 4 WHEN 5 THEN 4 WHEN 6 THEN 5 WHEN 7 THEN 5 END AS sub_type FROM l WHERE l_linenumber <= 10")
def t04_fused_tracks(spark, sf_dir):
    rows = messages(spark, sf_dir).select("frame_id", F.explode("obstacles").alias("o")).select("frame_id", c("o.k1").alias("code"))
    return fl.remap(rows, "code", fl.FUSED)


@query("SELECT l_orderkey AS frame_id, l_linenumber AS id, l_quantity AS width FROM lineitem WHERE NOT (l_quantity = 0 AND l_tax = 0) AND l_linenumber <> 0")
def t05_cubic_lines(spark, sf_dir):
    m = messages(spark, sf_dir).withColumn("lines", F.transform("obstacles", lambda o: F.struct(o["k1"].alias("id"), F.array(F.struct(o["confidence"].alias("width"), o["t"].alias("t_max"))).alias("curves"))))
    return fl.cubic_lines(m).select((F.round(c("time_stamp") * 10)).cast("long").alias("frame_id"), "id", "width")


@query(L + "SELECT l_orderkey AS frame_id, l_linenumber AS id, CASE l_suppkey % 5 WHEN 2 THEN 2 WHEN 1 THEN CAST(l_partkey % 16 AS INTEGER) ELSE 0 END AS marking FROM l")
def t06_point_lines(spark, sf_dir):
    point = lambda o, k: F.struct((o["x"] + k).alias("x"), o["y"].alias("y"))
    m = messages(spark, sf_dir).withColumn("lines", F.transform("obstacles", lambda o: F.struct(o["k1"].alias("id"), o["type"].alias("type"), o["k3"].cast("int").alias("extra_type"), F.array(F.struct(F.array(point(o, 0), point(o, 1)).alias("points"))).alias("curves"))))
    return fl.point_lines(m).select(F.round(c("time_stamp") * 10).cast("long").alias("frame_id"), "id", c("marking").cast("int").alias("marking"))


@query("SELECT l_orderkey AS frame_id, l_linenumber, l_suppkey, CAST(CASE l_suppkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4 ELSE 8 END AS INTEGER) AS code FROM lineitem")
def t07_lane_markings(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("frame_id"), "l_linenumber", "l_suppkey", fl.power_code(c("l_suppkey") % 5).alias("code"))


@query("SELECT o_orderkey AS frame_id, k AS id, -(o_totalprice + k) AS c0, CASE WHEN k >= 2 THEN 64 ELSE CAST(o_custkey % 3 AS INTEGER) END AS type FROM orders, (VALUES (0), (1), (2), (3)) v(k)")
def t08_named_lines(spark, sf_dir):
    names = ["left_host", "right_host", "left_edge", "right_edge"]
    o = table(spark, sf_dir, "orders").select(F.lit(0).alias("scenario_no"), c("o_orderkey").alias("time_stamp"), *[F.struct((c("o_totalprice") + i).alias("c0"), F.lit(0.0).alias("c1"), (c("o_custkey") % 3).cast("int").alias("type")).alias(n) for i, n in enumerate(names)])
    return fl.named_lines(o, names).select(c("time_stamp").alias("frame_id"), "id", "c0", "type")


@query(L + "SELECT l_orderkey AS frame_id, l_partkey % 4 AS id, round(l_quantity / 100, 6) AS confidence FROM l WHERE l_partkey % 4 <> 0")
def t09_static_objects(spark, sf_dir):
    return fl.objects(messages(spark, sf_dir), "obstacles", ["confidence"], ["confidence"]).select(F.round(c("time_stamp") * 10).cast("long").alias("frame_id"), "id", F.round("confidence", 6).alias("confidence"))


@query(L + "SELECT l_orderkey AS frame_id, l_partkey % 4 AS id, l_tax AS t, l_extendedprice AS x FROM l WHERE l_partkey % 4 <> 0")
def t10_radar_objects(spark, sf_dir):
    return fl.objects(messages(spark, sf_dir), "obstacles", ["t", "x"]).select(F.round(c("time_stamp") * 10).cast("long").alias("frame_id"), "id", "t", "x")


@query("SELECT event_id AS time_stamp, round(value / 3.6E0, 6) AS speed, event_type AS kind FROM events")
def t11_ego_motion(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.lit(0).alias("scenario_no"), c("event_id").alias("time_stamp"), F.struct("value", "event_type").alias("m"))
    return fl.scalars(e, {"speed": "m.value", "kind": "m.event_type"}, ["speed"]).select("time_stamp", F.round("speed", 6).alias("speed"), "kind")


@query("SELECT event_id AS time_stamp, event_type AS weather, user_id % 3 AS light FROM events")
def t12_weather(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.lit(0).alias("scenario_no"), c("event_id").alias("time_stamp"), F.struct(c("event_type").alias("w"), (c("user_id") % 3).alias("l")).alias("m"))
    return fl.scalars(e, {"weather": "m.w", "light": "m.l"}).select("time_stamp", "weather", "light")


@query(L + "SELECT l_orderkey AS frame_id, 9999::BIGINT AS id, l_extendedprice AS x FROM l WHERE l_extendedprice + l_discount <> 0 UNION ALL SELECT l_orderkey, l_partkey % 4, l_extendedprice FROM l WHERE l_extendedprice + l_discount <> 0")
def t13_free_space(spark, sf_dir):
    point = lambda o: F.struct(o["x"].alias("x"), o["y"].alias("y"))
    m = messages(spark, sf_dir).withColumns({"points": F.transform("obstacles", point), "contours": F.transform("obstacles", lambda o: F.struct(o["id"].alias("id"), F.array(point(o)).alias("points")))})
    return fl.free_space(m).select(F.round(c("time_stamp") * 10).cast("long").alias("frame_id"), "id", "x")


@query(L + "SELECT (l_orderkey * 64) % 200000 + pos - 1 AS id, l_orderkey AS frame_id, round(l_extendedprice + 1.5E0, 4) AS center_x, CASE WHEN l_discount * l_tax <> 0 THEN 1 ELSE 0 END AS stopper_valid FROM l")
def t14_parking_slots(spark, sf_dir):
    corner = lambda o, k: F.struct((o["x"] + k).alias("x"), (o["y"] + k).alias("y"))
    m = messages(spark, sf_dir).withColumns({"slots": F.transform("obstacles", lambda o: F.struct(F.array(*[corner(o, k) for k in range(4)]).alias("corners"), o["y"].alias("stopper_x"), o["t"].alias("stopper_y"))), "n_slots": c("n")})
    return fl.parking_slots(m).select("id", F.round(c("time_stamp") * 10).cast("long").alias("frame_id"), F.round("center_x", 4).alias("center_x"), "stopper_valid")


@query("WITH h AS (SELECT doc_id, regexp_extract_all(hex(encode(text)), '..') AS l FROM documents), b AS (SELECT doc_id, unnest(range(len(l))) AS cell, ('0x' || unnest(l))::INTEGER AS b FROM h) SELECT doc_id, CAST(cell AS INTEGER) AS cell, CAST(b // 16 AS INTEGER) AS class, CAST(23 - b % 16 AS INTEGER) AS free FROM b WHERE b >= 16")
def t15_occupancy_all(spark, sf_dir):
    """All cells of all messages."""
    d = table(spark, sf_dir, "documents").select(c("doc_id").alias("scenario_no"), F.lit(0).alias("time_stamp"), c("text").cast("binary").alias("grid"))
    return fl.occupancy(d).select(c("scenario_no").alias("doc_id"), "cell", "class", c("n_free").alias("free"))


@query("SELECT event_id AS time_stamp, user_id, event_type, value FROM events")
def t16_status_tables_all(spark, sf_dir):
    """All events as status rows."""
    e = table(spark, sf_dir, "events").select(F.lit(0).alias("scenario_no"), c("event_id").alias("time_stamp"), F.struct("user_id", "event_type", "value").alias("s"))
    return fl.scalars(e, {k: f"s.{k}" for k in ("user_id", "event_type", "value")}).drop("scenario_no")


@query("SELECT doc_id, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes FROM documents")
def t17_image_info(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(c("doc_id").alias("scenario_no"), F.lit(0).alias("time_stamp"), c("text").cast("binary").alias("data"))
    return fl.image_info(d).select(c("scenario_no").alias("doc_id"), "n_bytes")


@query(L + "SELECT l_orderkey AS frame_id, pos, CASE l_linenumber WHEN 3 THEN 2 WHEN 4 THEN 18 ELSE 1 END AS type, CASE l_linenumber WHEN 3 THEN -1 WHEN 4 THEN -1 ELSE 1 END AS sub_type FROM l")
def t18_vendor_objects(spark, sf_dir):
    rows = messages(spark, sf_dir).select("frame_id", F.posexplode("obstacles").alias("p", "o")).select("frame_id", (c("p") + 1).cast("long").alias("pos"), c("o.k1").alias("code"))
    return fl.remap(rows, "code", fl.VENDOR, (1, 1)).drop("code")


@query("SELECT o_orderkey AS time_stamp, '{\"o_custkey\":' || o_custkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\"}' AS message FROM orders")
def t19_to_json(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.lit(0).alias("scenario_no"), c("o_orderkey").alias("time_stamp"), "o_custkey", "o_orderstatus", c("o_orderdate").alias("_private"))
    return o.select("time_stamp", F.to_json(F.struct("o_custkey", "o_orderstatus")).alias("message"))


# readers


@query("SELECT o_orderkey AS id, o_custkey AS type, coalesce(NULL, 0.5E0) AS confidence FROM orders")
def s02_ground_truth(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").withColumn("confidence", F.lit(None).cast("double"))
    return rd.ground_truth(o, {"o_orderkey": "id", "o_custkey": "type"}, None)


def log_lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("2024-01-01 00:00:00 sensor send msg fps [camera_1]: "), F.round(c("value"), 2).cast("string"), F.lit(" [camera_2]: 30.0")).alias("value"))


@query("SELECT event_id AS frame_index, value AS time_stamp, CASE event_id % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'B' ELSE 'P' END AS frame_type FROM events")
def s08_frame_info_log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.when(c("event_id") % 3 == 0, "I").when(c("event_id") % 3 == 1, "B").otherwise("P")
    return rd.frame_info_log(e.select(F.concat(F.lit("[x] n: "), c("event_id"), F.lit(" pts: 1 pts_time:"), c("value").cast("string"), F.lit(" fmt:yuv type:"), kind).alias("value")))


@query("SELECT 'camera_1' AS camera, round(value, 2) AS fps, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'camera_2', 30.0E0, count(*) FROM events")
def s07_sensor_log(spark, sf_dir):
    return rd.sensor_log(log_lines(spark, sf_dir)).groupBy("camera", "fps").agg(F.count("*").alias("n"))


@query("SELECT event_id, round(value, 2) BETWEEN 20 * 0.98E0 AND 20 * 1.02E0 AS ok FROM events")
def a24_log_rate_check(spark, sf_dir):
    return log_lines(spark, sf_dir).select("event_id", rd.rate_line_ok(c("value"), {"camera_1": 20.0, "camera_2": 30.0}).alias("ok"))


@query("SELECT value AS t0, CAST(user_id AS DOUBLE) AS t1 FROM events")
def s05_sync_pairs(spark, sf_dir):
    return rd.sync_pairs(table(spark, sf_dir, "events").select(F.concat(c("value").cast("string"), F.lit(",  "), c("user_id").cast("string")).alias("value")))


@query("SELECT event_id AS frame_index, round(value + 100, 6) AS time_stamp FROM events")
def s06_frame_times(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select(F.concat_ws(" ", c("event_id").cast("string"), c("value").cast("string"), F.lit("0")).alias("value"))
    return rd.frame_times(lines, 100.0).select("frame_index", F.round("time_stamp", 6).alias("time_stamp"))


@query("SELECT p_brand AS topic, p_type AS msg_type, string_agg(p_name || '=' || p_partkey, ',' ORDER BY p_name || '=' || p_partkey) AS fields FROM part GROUP BY 1, 2")
def s09_can_mapping(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(c("p_brand").alias("topic"), c("p_type").alias("msg_type"), c("p_name").alias("field"), c("p_partkey").cast("string").alias("signal_expr"))
    out = rd.can_mapping(p)
    return out.select("topic", "msg_type", F.array_join(F.array_sort(F.transform("fields", lambda f: F.concat(f["field"], F.lit("="), f["signal_expr"]))), ",").alias("fields"))


@query("WITH p AS (SELECT 'ride' || user_id || '_n' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS id, event_type AS sensor, event_id FROM events WHERE event_type IN ('view', 'click')) SELECT id, min(CASE WHEN sensor = 'view' THEN '/d/' || id || '/view.' || event_id END) AS view, min(CASE WHEN sensor = 'click' THEN '/d/' || id || '/click.' || event_id END) AS click FROM p GROUP BY 1")
def s11_scenario_inventory(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("event_type IN ('view', 'click')")
    clip = F.concat(F.lit("ride"), "user_id", F.lit("_n"), F.lpad(c("user_id").cast("string"), 6, "0"))
    return rd.scenario_inventory(e.select(F.concat(F.lit("/d/"), clip, F.lit("/"), "event_type", F.lit("."), "event_id").alias("path")), ["view", "click"])


# scalar functions


@query("SELECT c_custkey AS id, substr(sha256(c_name || '-' || c_mktsegment), 1, 8) AS uuid, md5(c_name) AS checksum FROM customer")
def p23_stable_id(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), ex.stable_id(c("c_name"), c("c_mktsegment")).alias("uuid"), ex.content_checksum(c("c_name")).alias("checksum"))


@query("SELECT p_partkey AS id, round(2 * atan(p_retailprice / 2 / (p_size + 100)), 6) AS fov FROM part")
def p17_camera_fov(spark, sf_dir):
    return table(spark, sf_dir, "part").select(c("p_partkey").alias("id"), F.round(ex.camera_fov(c("p_retailprice"), c("p_size") + 100), 6).alias("fov"))


@query("SELECT event_id, CAST(round_even((value - 1.5E0) * 30, 0) AS BIGINT) AS frame FROM events")
def p22_frame_index(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", ex.frame_index(c("value"), F.lit(1.5), F.lit(30)).alias("frame"))


@query("SELECT c_custkey AS id, CAST(least(greatest(c_acctbal, -128), 127) AS INTEGER)::BIGINT AS i8, CAST(trunc(least(greatest(c_acctbal, 0), 255)) AS BIGINT) AS u8 FROM (SELECT c_custkey, trunc(c_acctbal) AS c_acctbal FROM customer)")
def p28_saturating_cast(spark, sf_dir):
    t = c("c_acctbal").cast("string")
    return table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), ex.saturating_cast(t, "int8").alias("i8"), ex.saturating_cast(t, "uint8").alias("u8"))


@query("SELECT p_partkey AS id, round(p_retailprice * 0.5E0, 6) AS a, 3.5E0 AS b, NULL::DOUBLE AS c, CAST(p_size AS DOUBLE) AS d FROM part")
def p27_signal_value(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(c("p_partkey").alias("id"), F.round(ex.signal_value("p_retailprice * 0.5"), 6).alias("a"), ex.signal_value("3.5").alias("b"), ex.signal_value("/").alias("c"), ex.signal_value("p_size").alias("d"))


@query("SELECT doc_id, CASE WHEN source LIKE 'src1%' THEN '/new/' || substr(source, 5) ELSE source END AS path FROM documents")
def p30_remap_paths(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ex.remap_path(c("source"), "src1", "/new/").alias("path"))


@query("SELECT p_partkey AS id, length(p_name) AS width, false AS cjk, rtrim(regexp_replace(p_name, '(.{4})', '\\1' || chr(10), 'g'), chr(10)) AS head FROM part")
def p31_display_width_all(spark, sf_dir):
    """Names of any length."""
    p = table(spark, sf_dir, "part")
    return p.select(c("p_partkey").alias("id"), ex.display_width(c("p_name")).cast("long").alias("width"), ex.has_cjk(c("p_name")).alias("cjk"), ex.wrap_lines(c("p_name"), 4).alias("head"))


@query("SELECT p_partkey AS id, 'camera_' || p_size || '_focal_length' AS name FROM part")
def p32_camel_to_snake(spark, sf_dir):
    return table(spark, sf_dir, "part").select(c("p_partkey").alias("id"), ex.camel_to_snake(F.concat(F.lit("camera_"), c("p_size"), F.lit("_FocalLength"))).alias("name"))


@query("SELECT o_orderkey AS id, epoch(date_trunc('day', o_orderdate))::BIGINT + 300 * (o_orderkey % 10) AS start FROM orders")
def p20_clip_start(spark, sf_dir):
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_n"), F.lpad((c("o_orderkey") % 10 + 1).cast("string"), 6, "0"))
    o = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), name.alias("clip")).filter(c("clip").rlike(r"^\d{4}-\d{2}-\d{2}_n\d{6}$"))
    day = F.unix_timestamp(F.regexp_extract("clip", r"^(\S+)_n", 1), "yyyy-MM-dd")
    return o.select("id", (day + 300 * (F.regexp_extract("clip", r"_n(\d+)$", 1).cast("long") - 1)).alias("start"))


@query("SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS start FROM events")
def p21_file_start(spark, sf_dir):
    name = F.concat(F.lit("rec_"), F.date_format("ts", "yyyy-MM-dd-HH-mm-ss"), F.lit(".bag"))
    return table(spark, sf_dir, "events").select("event_id", F.unix_timestamp(F.regexp_extract(name, r"(\d{4}(?:-\d{2}){5})", 1), "yyyy-MM-dd-HH-mm-ss").alias("start"))


@query("SELECT p_partkey AS id, round(1000 * (p_retailprice - 900) / (p_size + 5) + 960, 4) AS u, round(1000 * 1.5E0 / (p_size + 5) + 540, 4) AS v FROM part WHERE 1000 * (p_retailprice - 900) / (p_size + 5) + 960 BETWEEN 20 AND 1900")
def p25_project_point(spark, sf_dir):
    """Pinhole without distortion: camera frame with depth forward; pixels at least 20 inside the image are kept."""
    p = table(spark, sf_dir, "part").select(c("p_partkey").alias("id"), (c("p_retailprice") - 900).alias("x"), F.lit(1.5).alias("y"), (c("p_size") + 5).alias("z"))
    u, v = 1000 * c("x") / c("z") + 960, 1000 * c("y") / c("z") + 540
    return p.filter(u.between(20, 1900) & v.between(20, 1060)).select("id", F.round(u, 4).alias("u"), F.round(v, 4).alias("v"))


@query("SELECT event_id FROM events WHERE epoch_us(ts) > 1704500000000000")
def f15_plausible_clock(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(F.unix_micros(c("ts").cast("timestamp")) > 1704500000000000).select("event_id")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 7 <> 0")
def f07_lines_without_class(spark, sf_dir):
    """Lines go where both sides lack a class; an order key divisible by five (seven) stands for a missing one."""
    k = c("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), F.when(k % 5 != 0, "lane").alias("gt_class"), F.when(k % 7 != 0, "lane").alias("pred_class"))
    return rows.dropna(how="all", subset=["gt_class", "pred_class"]).select("id")


@query("SELECT o_orderkey AS id FROM orders WHERE (o_orderkey % 2 = 1 AND o_orderkey % 5 <> 0) OR (o_orderkey % 2 = 0 AND o_orderkey % 7 <> 0)")
def f05_line_eligibility(spark, sf_dir):
    """The deciding side needs a class: truth where it is flagged (odd keys), else prediction."""
    from drivegauge.operators.metrics import deciding

    k = c("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), (k % 2).alias("gt_flag"), F.when(k % 5 != 0, "lane").alias("gt_class"), F.when(k % 7 != 0, "lane").alias("pred_class"))
    return rows.filter(deciding(rows, "class").isNotNull()).select("id")


@query("SELECT c_custkey AS doc, 'cam' || k AS camera, c_acctbal + k AS fx FROM customer, (VALUES (0), (1)) v(k)")
def s10_calibration(spark, sf_dir):
    docs = table(spark, sf_dir, "customer").select("c_custkey", F.create_map(*[x for k in range(2) for x in (F.lit(f"cam{k}"), F.struct(c("c_custkey").alias("doc"), (c("c_acctbal") + k).alias("fx")))]).alias("cameras"))
    return rd.calibration(docs).select("doc", "camera", "fx")


@query("SELECT event_type AS topic, user_id % 4 AS scenario_no, count(*) AS n FROM events GROUP BY 1, 2")
def s13_topic_parts(spark, sf_dir):
    """Written by topic and scenario to the shared folder and read back."""
    path = scratch_dir(spark, "topics")
    rd.write_parts(table(spark, sf_dir, "events").select(c("event_type").alias("topic"), (c("user_id") % 4).alias("scenario_no"), "event_id"), path, 1000)
    return spark.read.schema("event_id long, topic string, scenario_no long").parquet(path).groupBy("topic", "scenario_no").agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus AS division, count(*) AS sample_count, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1")
def s14_stat_records(spark, sf_dir):
    """JSON documents, one per statistic."""
    path = scratch_dir(spark, "records")
    rd.write_records(table(spark, sf_dir, "orders").groupBy(c("o_orderstatus").alias("division")).agg(F.count("*").alias("sample_count"), F.round(F.avg("o_totalprice"), 4).alias("mean")), path)
    return spark.read.schema("division string, sample_count long, mean double").json(path)


@query("SELECT event_id, user_id, value FROM events")
def s01_read_topic_all(spark, sf_dir):
    """All events, written as CSV parts and read back."""
    path = scratch_dir(spark, "csv")
    table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type").write.option("header", True).csv(path)
    return rd.read_topic(spark, path, "event_id long, user_id long, value double, event_type string", ["event_id", "user_id", "value"])
