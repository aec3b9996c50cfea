"""Targets, verdicts, regressions, pivots and the mining of failures."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drivegauge.sources.scratch import stored


def with_targets(df: DataFrame, thresholds: DataFrame, ratios: DataFrame, date_label: int) -> DataFrame:
    """Adds ``target``: the threshold of the cell times the ratio of the date (1 where there is none)."""
    own = ratios.filter(F.col("date_label") == date_label).select("metric", "stat", "ratio")
    return df.join(F.broadcast(thresholds), ["metric", "stat", "class", "division"], "left").join(F.broadcast(own), ["metric", "stat"], "left").withColumn("target", F.col("value") * F.coalesce("ratio", F.lit(1.0))).drop("value", "ratio")


def verdict(result: Column, target: Column, higher_is_better: Column) -> Column:
    """1 pass, 0 fail, -1 unknown."""
    return F.when(result.isNull() | target.isNull(), -1).when(higher_is_better, F.when(result > target, 1).otherwise(0)).otherwise(F.when(result > target, 0).otherwise(1))


def merge_verdicts(every: bool) -> Column:
    """All known verdicts pass (or any one), -1 where none is known."""
    known = F.when(F.col("verdict") >= 0, F.col("verdict"))
    return F.coalesce(F.min(known) if every else F.max(known), F.lit(-1))


def pass_totals(df: DataFrame, keys: list[str]) -> DataFrame:
    good, bad = F.sum(F.when(F.col("verdict") == 1, 1).otherwise(0)), F.sum(F.when(F.col("verdict") == 0, 1).otherwise(0))
    return df.groupBy(*keys).agg(good.alias("passed"), bad.alias("failed"), F.round(F.try_divide(good, good + bad), 6).alias("pass_rate"))


def pivot_report(df: DataFrame, rows: list[str], column: str, values: list[str], cell: str) -> DataFrame:
    """One row per cell group, a column per known value; the values are given, so Spark needs no extra job."""
    return df.groupBy(*rows).pivot(column, values).agg(F.first(cell))


def all_pairs(a: DataFrame, b: DataFrame, keys: list[str], most: int = 1_000_000) -> DataFrame:
    """Inner join on few keys with many rows each: a key's rows of ``a`` are cut into slices, each of which meets a copy
    of the key's rows of ``b`` in about ``most`` pairs, and tasks are dealt by all pairs. No task has a whole key."""
    count = lambda d, n: d.groupBy(*keys).agg(F.count("*").alias(n))
    slices = F.ceil(F.col("_a") * F.col("_b") / most)
    sizes = stored(count(a, "_a").join(count(b, "_b"), keys).select(*keys, "_a", "_b", F.least(slices, F.col("_a")).alias("_slices")), "pair-sizes")
    pairs = sizes.agg(F.sum(F.col("_a") * F.col("_b"))).first()[0] or 0
    tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(pairs / most / 2))
    known = sizes.select(*keys, "_slices")
    cut = a.join(known, keys).withColumn("_slice", F.pmod(F.xxhash64(*a.columns), F.col("_slices"))).drop("_slices")
    copies = b.join(known, keys).withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1))).drop("_slices")
    dealt = lambda d: d.repartition(tasks, *keys, "_slice")
    return dealt(cut).join(dealt(copies), [*keys, "_slice"]).drop("_slice")


def pair_blocks(a: DataFrame, b: DataFrame, keys: list[str], side: int = 4_000) -> DataFrame:
    """Inner join on few keys with many rows each, whose sides are cut into slices of about ``side`` rows: two slices are
    a block, and tasks are dealt by blocks. No task holds a key or a whole side of it, and of p pairs 2 p / ``side`` rows
    are shuffled. The rows of a side have to be unlike each other, as they are dealt by their hash."""
    count = lambda d, n: d.groupBy(*keys).agg(F.ceil(F.count("*") / side).alias(n))
    known = stored(count(a, "_m").join(count(b, "_n"), keys).select(*keys, "_m", "_n"), "blocks")
    blocks = known.agg(F.sum(F.col("_m") * F.col("_n"))).first()[0] or 0
    tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(blocks / 2))

    def dealt(d: DataFrame, own: str, own_slices: str, other: str, other_slices: str) -> DataFrame:
        d = d.join(F.broadcast(known), keys).withColumn(own, F.pmod(F.xxhash64(*d.columns), F.col(own_slices)))
        return d.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_slices) - 1))).drop("_m", "_n").repartition(tasks, *keys, "_i", "_j")

    return dealt(a, "_i", "_m", "_j", "_n").join(dealt(b, "_j", "_n", "_i", "_m"), [*keys, "_i", "_j"]).drop("_i", "_j")


def regressions(df: DataFrame, cell: list[str], order: str, thresholds: dict[str, float]) -> DataFrame:
    """Latest against previous version of each cell: BETTER or WORSE beyond the statistic's threshold."""
    w = Window.partitionBy(*cell).orderBy(order)
    latest = Window.partitionBy(*cell).orderBy(F.col(order).desc())
    old, new = F.col("previous"), F.col("value")
    change = F.when(F.col("stat").isin("recall", "precision"), old - new).when(F.col("stat").startswith("yaw"), new - old).otherwise((new - old) / F.when(F.greatest(F.abs(old), F.abs(new)) != 0, F.greatest(F.abs(old), F.abs(new))))
    limit = F.lit(None).cast("double")
    for stat, value in thresholds.items():
        limit = F.when(F.col("stat") == stat, value).otherwise(limit)
    out = df.withColumn("previous", F.lag("value").over(w)).withColumn("_r", F.row_number().over(latest)).filter("_r = 1 AND previous IS NOT NULL AND value IS NOT NULL").drop("_r")
    return out.withColumn("change", change).withColumn("label", F.when(F.col("change") > limit, "WORSE").when(F.col("change") < -limit, "BETTER").otherwise("SAME"))


def version_delta(new: DataFrame, old: DataFrame, cell: list[str]) -> DataFrame:
    return new.join(old.select(*cell, F.col("value").alias("old_value")), cell, "left").withColumn("delta", F.col("value") - F.col("old_value"))


def version_delta_at_once(df: DataFrame, cell: list[str], by: str, new: str, old: str) -> DataFrame:
    """``version_delta`` of two versions in one table, whose rows are made once and not for each side of a join. A cell has
    one row a version; one with a null key has no older value, as in the join."""
    value = lambda version: F.max(F.when(F.col(by) == version, F.col("value")))
    both = df.filter(F.col(by).isin(new, old)).groupBy(*cell).agg(value(new).alias("value"), value(old).alias("_old"), F.max(F.col(by) == new).alias("_new"))
    known = F.lit(True)
    for k in cell:
        known = known & F.col(k).isNotNull()
    return both.filter("_new").withColumn("old_value", F.when(known, F.col("_old"))).drop("_old", "_new").withColumn("delta", F.col("value") - F.col("old_value"))


def frequent_offenders(df: DataFrame, k: int, by: str = "class") -> DataFrame:
    """All rows of the ``k`` ids with most rows of each class, ties to the smaller id."""
    counts = df.groupBy(by, "scenario_no", "id").agg(F.count("*").alias("cnt"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.col("cnt").desc(), "scenario_no", "id"))
    return df.join(counts.withColumn("_r", rank).filter(F.col("_r") <= k).drop("_r", "cnt"), [by, "scenario_no", "id"], "left_semi")


def worst_offenders(df: DataFrame, error: str, k: int, least: int, by: str = "class") -> DataFrame:
    """Ids with at least ``least`` rows, by mean error."""
    counts = df.groupBy(by, "scenario_no", "id").agg(F.count("*").alias("n"), F.round(F.avg(error), 6).alias("mean_error")).filter(F.col("n") >= least)
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.col("mean_error").desc(), "scenario_no", "id"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k)


def failure_samples(m: DataFrame, k: int, half_width: float = 8.0) -> DataFrame:
    """``kind, class, scenario_no, id, frame_ts_us`` of the failures worth a look: of each kind and class all rows of the ids
    with most rows. ``m`` has both sides of the matched rows.

    False positives and wrong classes: ``k`` ids. Misses: 2 ``k`` ids up to 100 m, and as many from there to 150 m. Only
    what lies within ``half_width`` to the side counts, and of vulnerable road users what is near.
    """
    vru = lambda side: F.col(f"{side}_type_classification").isin("pedestrian", "cyclist")
    gx, px = F.col("gt_x"), F.col("pred_x")
    beside = lambda side: F.abs(f"{side}_y") <= half_width
    missed = (F.col("gt_flag") == 1) & (F.col("pred_flag") == 0) & beside("gt") & ~(vru("gt") & (F.abs(gx) > 50))
    both = (F.col("gt_flag") == 1) & (F.col("pred_flag") == 1)
    kinds = [
        ("false_positive", "pred", (F.col("gt_flag") == 0) & (F.col("pred_flag") == 1) & px.between(-100, 150) & beside("pred") & ~(vru("pred") & (px > 50)), k),
        ("false_negative_near", "gt", missed & gx.between(-100, 100), 2 * k),
        ("false_negative_far", "gt", missed & (gx > 100) & (gx <= 150), 2 * k),
        ("false_type", "gt", both & ~F.col("gt_type_classification").eqNullSafe(F.col("pred_type_classification")) & gx.between(-50, 100) & beside("gt") & ~(vru("gt") & (gx > 50)), k),
    ]
    cases = F.filter(F.array(*[F.when(when, F.struct(F.lit(name).alias("kind"), F.lit(n).alias("_most"), F.col(f"{side}_type_classification").alias("class"), F.col(f"{side}_id").alias("id"))) for name, side, when, n in kinds]), lambda x: x.isNotNull())
    rows = m.select("scenario_no", "frame_ts_us", F.explode(cases).alias("e")).select("e.*", "scenario_no", "frame_ts_us")
    counts = rows.groupBy("kind", "_most", "class", "scenario_no", "id").agg(F.count("*").alias("_n"))
    rank = F.row_number().over(Window.partitionBy("kind", "class").orderBy(F.col("_n").desc(), "scenario_no", "id"))
    chosen = counts.withColumn("_r", rank).filter("_r <= _most").select("kind", "class", "scenario_no", "id")
    return rows.drop("_most").join(chosen, ["kind", "class", "scenario_no", "id"], "left_semi")


def worst_by_distance(df: DataFrame, error: str, share: str, k: int, least: int, near: float = 50.0) -> DataFrame:
    """``zone, class, scenario_no, id, n, mean_error, rank``: the ``k`` ids of each class with the largest mean error, by the
    error itself up to ``near`` metres and by the relative one beyond; ids need ``least`` rows in the zone."""
    close = F.abs("gt_x") <= near
    rows = df.withColumns({"zone": F.when(close, "near").otherwise("far"), "_e": F.when(close, F.abs(error)).otherwise(F.abs(share))})
    counts = rows.groupBy("zone", "class", "scenario_no", "id").agg(F.count("*").alias("n"), F.round(F.avg("_e"), 6).alias("mean_error")).filter(F.col("n") >= least)
    rank = F.row_number().over(Window.partitionBy("zone", "class").orderBy(F.col("mean_error").desc(), "scenario_no", "id"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k)


def median_frame(df: DataFrame, keys: list[str], stamp: str, least: int) -> DataFrame:
    """The middle row by time of each id with enough rows."""
    w = Window.partitionBy(*keys)
    marked = df.withColumns({"_n": F.count("*").over(w), "_r": F.row_number().over(w.orderBy(stamp))})
    return marked.filter((F.col("_n") >= least) & (F.col("_r") == F.floor(F.col("_n") / 2) + 1)).drop("_n", "_r")


def running_budget(df: DataFrame, size: str, order: list[str], budget: float, factor: float = 1.5) -> DataFrame:
    """Rows while the running sum of sizes stays within the budget. The order is global: meant for lists of packages."""
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_sum", F.sum(size).over(w)).filter(F.col("_sum") * factor < budget).drop("_sum")


def package_sizes(objects: DataFrame, key: str, size: str) -> DataFrame:
    """``package, size`` of the packages, the paths before ``/install/``, that also hold a bag, with all their objects."""
    root = F.coalesce(F.when(F.col(key).contains("/install/"), F.substring_index(key, "/install/", 1)), F.when(F.col(key).contains("/rosbag"), F.substring_index(key, "/rosbag", 1)))
    marked = objects.select(root.alias("package"), F.col(size).alias("size"), F.col(key).contains("/install/").alias("_install"), (~F.col(key).contains("/install/") & F.col(key).contains("/rosbag")).alias("_bag"))
    sums = marked.filter("package IS NOT NULL").groupBy("package").agg(F.sum("size").alias("size"), F.max("_install").alias("_i"), F.max("_bag").alias("_b"))
    return sums.filter("_i AND _b").select("package", "size")


def downloads(packages: DataFrame, free: float, factor: float = 1.5, reserve: float = 20 * 1024**3) -> DataFrame:
    """The smallest packages while their running sum times ``factor`` and the ``reserve`` stay below the free space."""
    return running_budget(packages, "size", ["size", "package"], free - reserve, factor)


def exposure(clips: DataFrame, ego: DataFrame, tag: str) -> DataFrame:
    """``tag, frames, distance_km, scenarios``, with a row of totals under the tag null, from clips (scenario_no, tag, duration,
    fps) and the ego speed (scenario_no, time_stamp, ego_vx)."""
    spans = ego.groupBy("scenario_no").agg(F.ceil((F.max("time_stamp") - F.min("time_stamp")) * F.avg("ego_vx") / 1000).cast("long").alias("_km"))
    frames = F.bround(F.col("duration") * F.col("fps") * 291 / 300).cast("long")
    rows = clips.join(spans, "scenario_no", "left").select(tag, frames.alias("_f"), F.coalesce("_km", F.lit(0)).alias("_km"))
    return rows.rollup(tag).agg(F.sum("_f").alias("frames"), F.sum("_km").alias("distance_km"), F.count("*").alias("scenarios"))


def ledger(old: DataFrame, failures: DataFrame, key: str) -> DataFrame:
    """Failure counts after one more round, and whether an entry is still good."""
    both = old.select(key, "failures").unionByName(failures.select(key, F.lit(1).cast("long").alias("failures")))
    return both.groupBy(key).agg(F.sum("failures").alias("failures")).withColumn("state", F.when(F.col("failures") > 1, "BAD").otherwise("GOOD"))


def nested_rollup(df: DataFrame, levels: list[str], name: str = "value") -> DataFrame:
    """A row per value of the first level: ``value``, ``n`` rows, and ``children``, an array of the same for the next level.

    Counts of the full combinations come first; then each level is folded into the one above, in the order of its
    values, with one shuffle of a row per node. A node holds as many children as its level has values below it.
    """
    out = df.groupBy(*levels).agg(F.count("*").alias("n")).withColumn("children", F.lit(None))
    for depth in range(len(levels) - 1, -1, -1):
        fields = [F.col(levels[depth]).alias(name), F.col("n"), *([F.col("children")] if depth < len(levels) - 1 else [])]
        if depth == 0:
            return out.select(*fields)
        out = out.groupBy(*levels[:depth]).agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct(*fields))).alias("children")).withColumnRenamed("total", "n")
    raise ValueError("no levels")


def distinct_values(df: DataFrame, levels: list[str]) -> DataFrame:
    """``level, value, n``: the values of each level and how many rows have them, in one pass."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.col(k).cast("string").alias("value")) for k in levels])).alias("_e"))
    return long.groupBy(F.col("_e.level").alias("level"), F.col("_e.value").alias("value")).agg(F.count("*").alias("n"))


def manifest_diff(a: DataFrame, b: DataFrame, path: str, size: str) -> DataFrame:
    """Files that only one side has, or whose sizes differ."""
    joined = a.select(path, F.col(size).alias("size_a")).join(b.select(path, F.col(size).alias("size_b")), path, "full")
    return joined.filter(F.col("size_a").isNull() | F.col("size_b").isNull() | (F.col("size_a") != F.col("size_b")))


def new_rows(df: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Rows whose key the store lacks, one per key."""
    return df.dropDuplicates([key]).join(store.select(key), key, "left_anti")


def numbered(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Rows with their place (from 1) in the global order. Ranges are sorted each on its own and stored; only their
    sizes, one small row for each range, are summed up in one task."""
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*[F.col(k) for k in order]).sortWithinPartitions(*order)
    rows = stored(ranged.withColumns({"_range": F.shiftright(place, 33), "_nth": place.bitwiseAND(F.lit((1 << 33) - 1)) + 1}), "ranges")
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", before.alias("_before"))
    return rows.join(F.broadcast(sizes), "_range").withColumn(name, F.col("_before") + F.col("_nth")).drop("_range", "_nth", "_before")


def camera_plan(failures: DataFrame, cameras: DataFrame, start: float, rate: int) -> DataFrame:
    """``camera, frame_ts_us, frame_index, fn_ids, fp_ids``: the frames to draw for each camera, and whom to mark there.

    ``failures`` holds ``frame_ts_us, side (fn or fp), id, x, y``; ``cameras`` a few rows ``camera, lo, hi`` in degrees. A
    failure goes to every camera whose angles hold it, one beyond 180 degrees too; what no camera sees is not drawn. A row
    per camera and frame, so no camera's list grows with the recording.
    """
    seen = failures.withColumn("angle", F.degrees(F.atan2("y", "x"))).join(F.broadcast(cameras), F.col("angle").between(F.col("lo"), F.col("hi")) | (F.col("angle") + 360).between(F.col("lo"), F.col("hi")))
    ids = lambda side: F.array_join(F.transform(F.array_sort(F.collect_set(F.when(F.col("side") == side, F.col("id")))), lambda x: x.cast("string")), ",").alias(f"{side}_ids")
    frames = seen.groupBy("camera", "frame_ts_us").agg(ids("fn"), ids("fp"))
    return frames.withColumn("frame_index", F.round((F.col("frame_ts_us") / 1e6 - start) * rate).cast("long"))


def merge_tests(history: DataFrame, tests: DataFrame, failures: DataFrame) -> DataFrame:
    """``scenario, n_tests, tests, excluded``: tests added to a history, each once, and the ids not to be drawn again.

    ``history`` and ``tests`` hold ``scenario, date, topic, source, version``; of ``failures`` (``scenario, id, side,
    mark``) those marked 2 or 3 that are no false positives join the excluded ids. A scenario of either kind gets a row;
    lists are ordered by date, then by the other columns, and grow with a scenario's tests only.
    """
    test = F.struct("date", "topic", "source", "version")
    runs = history.unionByName(tests).groupBy("scenario").agg(F.array_sort(F.collect_set(test)).alias("tests"))
    marked = failures.filter(F.col("mark").isin(2, 3) & (F.col("side") != "fp")).groupBy("scenario").agg(F.array_sort(F.collect_set("id")).alias("excluded"))
    text = F.array_join(F.transform("tests", lambda t: F.concat_ws("/", t["date"], t["topic"], t["source"], t["version"])), ";")
    both = runs.join(marked, "scenario", "full")
    return both.select("scenario", F.when(F.col("tests").isNotNull(), F.size("tests")).otherwise(0).cast("long").alias("n_tests"), F.coalesce(text, F.lit("")).alias("tests"), F.coalesce(F.array_join(F.transform("excluded", lambda x: x.cast("string")), ","), F.lit("")).alias("excluded"))
