"""Queries over cameras, nested values, roll-ups into trees, concurrent stores and long series."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivegauge.functions import cameras as cm
from drivegauge.functions import expressions as ex
from drivegauge.functions import nested as ne
from drivegauge.operators import report as rp
from drivegauge.sources import store as st
from drivegauge.sources.scratch import scratch_dir

from .fixtures import table
from .registry import query

c, r6 = F.col, ex.r6


@query("SELECT p_partkey AS id, round(CASE WHEN u = 0 AND v = 0 THEN 0 ELSE (1216 / 2 - v) * 0.02E0 + 1.39698315E0 END, 6) + 0.0E0 AS x, round(CASE WHEN u = 0 AND v = 0 THEN 0 ELSE (1088 / 2 - u) * 0.02E0 END, 6) + 0.0E0 AS y FROM (SELECT p_partkey, p_size * 3 % 90 AS u, p_partkey % 7 * 100 AS v FROM part)")
def p14_truth_pixel_to_ego(spark, sf_dir):
    """The truth's bird view, whose origin is the rear axle."""
    p = table(spark, sf_dir, "part").select("p_partkey", (c("p_size") * 3 % 90).alias("u"), (c("p_partkey") % 7 * 100).alias("v"))
    x, y = ex.pixel_to_ego(c("u"), c("v"), "truth")
    return p.select(c("p_partkey").alias("id"), r6(x).alias("x"), r6(y).alias("y"))


# a nation's number is a camera, a line of an order a point


def cameras(spark, sf_dir) -> DataFrame:
    """Cameras of the three models, each looking its own way."""
    n = c("n_nationkey").cast("double")
    model = F.when(c("n_nationkey") % 3 == 0, "pinhole").when(c("n_nationkey") % 3 == 1, "fisheye").otherwise("omni")
    yaw, zero, one = n * (2 * math.pi / 25), F.lit(0.0), F.lit(1.0)
    intrinsic = F.array(900 + 10 * n, F.lit(2.0), F.lit(960.0), zero, 900 + 10 * n, F.lit(540.0), zero, zero, one)
    extrinsic = F.array(F.sin(yaw), -F.cos(yaw), zero, F.lit(0.1), zero, zero, F.lit(-1.0), F.lit(1.5), F.cos(yaw), F.sin(yaw), zero, F.lit(0.2), zero, zero, zero, one)
    distort = F.when(model == "pinhole", F.array(*[F.lit(v) for v in (-0.03, 0.02, 0.001, -0.002, 0.005, 0.01, 0.002, 0.001)])).when(model == "fisheye", F.array(*[F.lit(v) for v in (0.02, -0.01, 0.003, -0.001)])).otherwise(F.array(*[F.lit(v) for v in (-0.1, 0.03, 0.001, 0.002)]))
    return table(spark, sf_dir, "nation").select(c("n_nationkey").alias("camera"), model.alias("model"), F.lit(1920).alias("width"), F.lit(1080).alias("height"), intrinsic.alias("intrinsic"), extrinsic.alias("extrinsic"), distort.alias("distort"), (0.8 + n / 50).alias("xi"))


@query("""WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey % 25 AS camera, (l_extendedprice % 250) - 100 AS x, (l_quantity - 25) * 0.6E0 AS y, l_tax * 20 AS z FROM lineitem),
k AS (SELECT n_nationkey AS camera, n_nationkey % 3 AS model, 900 + 10.0E0 * n_nationkey AS f, n_nationkey * (2 * pi() / 25) AS yaw, 0.8E0 + n_nationkey / 50.0E0 AS xi FROM nation),
p AS (SELECT q.*, model, f, xi, sin(yaw) * x - cos(yaw) * y + 0.1E0 AS px, -z + 1.5E0 AS py, cos(yaw) * x + sin(yaw) * y + 0.2E0 AS pz FROM q JOIN k USING (camera)),
n AS (SELECT *, sqrt(px * px + py * py + pz * pz) AS len FROM p),
a AS (SELECT *, CASE WHEN model = 2 THEN px / len / (pz / len + xi) ELSE px / pz END AS a, CASE WHEN model = 2 THEN py / len / (pz / len + xi) ELSE py / pz END AS b FROM n WHERE CASE WHEN model = 2 THEN pz / len + xi > 0 ELSE pz > 0 END),
r AS (SELECT *, a * a + b * b AS r2, atan(sqrt(a * a + b * b)) AS t FROM a),
s AS (SELECT *, CASE model WHEN 0 THEN (1 - 0.03E0 * r2 + 0.02E0 * r2 * r2 + 0.005E0 * r2 * r2 * r2) / (1 + 0.01E0 * r2 + 0.002E0 * r2 * r2 + 0.001E0 * r2 * r2 * r2)
 WHEN 1 THEN t * (1 + 0.02E0 * t ** 2 - 0.01E0 * t ** 4 + 0.003E0 * t ** 6 - 0.001E0 * t ** 8) / sqrt(r2) ELSE 1 - 0.1E0 * r2 + 0.03E0 * r2 * r2 END AS g,
 CASE model WHEN 0 THEN 0.001E0 WHEN 2 THEN 0.001E0 ELSE 0 END AS p1, CASE model WHEN 0 THEN -0.002E0 WHEN 2 THEN 0.002E0 ELSE 0 END AS p2 FROM r),
d AS (SELECT *, a * g + 2 * p1 * a * b + p2 * (r2 + 2 * a * a) AS da, b * g + p1 * (r2 + 2 * b * b) + 2 * p2 * a * b AS db FROM s),
w AS (SELECT *, CAST(round_even(f * da + CASE WHEN model = 2 THEN 2 * db ELSE 0 END + 960, 0) AS DOUBLE) AS u, CAST(round_even(f * db + 540, 0) AS DOUBLE) AS v FROM d)
SELECT l_orderkey, l_linenumber, camera, CAST(u AS BIGINT) AS u, CAST(v AS BIGINT) AS v FROM w WHERE u > 20 AND u < 1900 AND v > 20 AND v < 1060""")
def p25_project_cameras(spark, sf_dir):
    """Points in the image of their camera, of whatever model, with its distortion."""
    points = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (c("l_partkey") % 25).alias("camera"), (c("l_extendedprice") % 250 - 100).alias("x"), ((c("l_quantity") - 25) * 0.6).alias("y"), (c("l_tax") * 20).alias("z"))
    return cm.project(points, cameras(spark, sf_dir), "camera").select("l_orderkey", "l_linenumber", "camera", "u", "v")


# a customer is a device with a calibration document of three levels


def documents(spark, sf_dir) -> DataFrame:
    lens = lambda i: F.struct(F.concat(F.lit(f"/old/lens{i}/"), "c_mktsegment").alias("FilePath"), (c("c_custkey") % 7 + i).alias("FocalLength"), F.lit("raw").alias("_rawBytes"), F.create_map(F.lit("fileID"), F.concat(F.lit("/old/"), "c_name"), F.lit("other"), c("c_name")).alias("extraTags"))
    config = F.struct(c("c_custkey").alias("CameraID"), F.lit("s").alias("_secret"), F.array(lens(1), lens(2)).alias("lensList"), F.struct(c("c_name").alias("maskFile"), F.struct(F.lit(1).alias("_only")).alias("hiddenPart")).alias("outerBox"))
    return table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), config.alias("deviceConfig"))


def _lens_sql(path: str, file: str, names: tuple[str, ...], private: bool) -> str:
    one = lambda i: f"{{'{names[0]}': '{path}/lens{i}/' || c_mktsegment, '{names[1]}': c_custkey % 7 + {i}, " + (f"'{names[2]}': 'raw', " if private else "") + f"'{names[3]}': MAP {{'{names[4]}': '{file}/' || c_name, 'other': c_name}}}}"
    return f"[{one(1)}, {one(2)}]"


@query(f"SELECT c_custkey AS id, to_json({{'camera_id': c_custkey, '_secret': 's', 'lens_list': {_lens_sql('/old', '/old', ('file_path', 'focal_length', '_raw_bytes', 'extra_tags', 'file_id'), True)}, 'outer_box': {{'mask_file': c_name, 'hidden_part': {{'_only': 1}}}}}})::VARCHAR AS document FROM customer")
def p32_snake_nested(spark, sf_dir):
    """Keys of a whole document in snake case: fields of structs in structs and arrays, and keys of maps."""
    return ne.snake_keys(documents(spark, sf_dir)).select("id", F.to_json("device_config").alias("document"))


@query(f"SELECT c_custkey AS id, to_json({{'CameraID': c_custkey, '_secret': 's', 'lensList': {_lens_sql('/new/root', '/new/root', ('FilePath', 'FocalLength', '_rawBytes', 'extraTags', 'fileID'), True)}, 'outerBox': {{'maskFile': c_name, 'hiddenPart': {{'_only': 1}}}}}})::VARCHAR AS document FROM customer")
def p30_remap_nested(spark, sf_dir):
    """A path prefix replaced in every text of a document."""
    return ne.remap_paths(documents(spark, sf_dir), "/old", "/new/root").select("id", F.to_json("deviceConfig").alias("document"))


@query(f"SELECT c_custkey AS id, to_json({{'deviceConfig': {{'CameraID': c_custkey, 'lensList': {_lens_sql('/old', '/old', ('FilePath', 'FocalLength', '', 'extraTags', 'fileID'), False)}, 'outerBox': {{'maskFile': c_name}}}}}})::VARCHAR AS message FROM customer")
def t19_message_json(spark, sf_dir):
    """A whole message as JSON without private fields at any depth."""
    return ne.message_json(documents(spark, sf_dir), ["id"])


@query("""WITH l3 AS (SELECT lang, source, doc_id % 3 AS k, count(*) AS n FROM documents GROUP BY ALL), l2 AS (SELECT lang, source, sum(n)::BIGINT AS n, list({'value': k, 'n': n} ORDER BY k) AS children FROM l3 GROUP BY ALL),
l1 AS (SELECT lang, sum(n)::BIGINT AS n, list({'value': source, 'n': n, 'children': children} ORDER BY source) AS children FROM l2 GROUP BY ALL) SELECT lang AS value, n, to_json(children)::VARCHAR AS children FROM l1""")
def a23_nested_rollup(spark, sf_dir):
    """Counts as a tree: language, source, attachment."""
    d = table(spark, sf_dir, "documents").select("lang", "source", (c("doc_id") % 3).alias("kind"))
    return rp.nested_rollup(d, ["lang", "source", "kind"]).select("value", "n", F.to_json("children").alias("children"))


@query("SELECT 'lang' AS level, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2")
def a23_distinct_values(spark, sf_dir):
    return rp.distinct_values(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("SELECT o_custkey AS uuid, min(o_orderkey) AS first_order FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1 UNION ALL SELECT o_custkey, min(o_orderkey) FROM orders WHERE o_orderkey % 2 = 1 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0) GROUP BY 1")
def s16_result_store(spark, sf_dir):
    """Two inserts into a store with a unique key; each key keeps the rows of the first that brought it."""
    store = st.ResultStore(spark, scratch_dir(spark, "store"), "uuid", "uuid long, first_order long")
    sent = table(spark, sf_dir, "orders").select(c("o_custkey").alias("uuid"), c("o_orderkey").alias("first_order"))
    for rest in (0, 1):
        store.insert(sent.filter(c("first_order") % 2 == rest), ["first_order"])
    return store.read()
