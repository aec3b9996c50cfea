"""Exact quantiles of many groups, by narrowing value ranges, for groups of any size.

A group's values are counted in ``BINS`` equal ranges between its least and largest; the range that holds a wanted rank
is cut again in the same way, until a range holds one value only or at most ``LIMIT`` of them, which are then put in
order. Counts are summed before they are shuffled, so no task ever holds a group's values, and the state of a group is
its ranges. Each pass divides what is left by about ``BINS``, reads only ranges that hold a wanted rank, and writes only
the values of the next ones.

A quantile p of n values lies at p (n - 1), linearly between the two values around it, as in ``percentile``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drivegauge.sources.scratch import stored

BINS, LIMIT = 1024, 10_000


def _equal(keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    return on


def exact_quantiles(df: DataFrame, keys: list[str], value: str, at: dict[str, float], bins: int = BINS, limit: int = LIMIT, written: bool = False) -> DataFrame:
    """``keys`` and a column for each quantile of ``at``; null and NaN values are left out, groups without value too.
    ``written``: ``df`` reads files without much work, so its values are not written once more."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL AND NOT isnan(_v)")
    rows = rows if written else stored(rows, "values")
    spans = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    place = lambda p: F.lit(float(p)) * (F.col("_n") - 1)
    ranks = F.array_distinct(F.concat(*[F.array(F.floor(place(p)).cast("long"), F.ceil(place(p)).cast("long")) for p in at.values()]))
    spans = stored(spans.withColumn("_ranks", ranks), "spans")
    # open: ranges with the ranks wanted of them, counted from the range's first value
    open_ = spans.select(*keys, F.lit("").alias("_path"), "_n", "_lo", "_hi", F.transform("_ranks", lambda r: F.struct(r.alias("rank"), r.alias("within"))).alias("_want"))
    rows, found = rows.withColumn("_path", F.lit("")), None
    while True:
        same = open_.filter("_lo = _hi").select(*keys, F.explode("_want").alias("w"), F.col("_lo").alias("_v")).select(*keys, "w.rank", "_v")
        few = open_.filter(f"_lo < _hi AND _n <= {limit}")
        own = [*keys, "_path"]
        small = rows.alias("l").join(few.alias("r"), _equal(own)).select("l.*", "r._want")
        nth = F.row_number().over(Window.partitionBy(*own).orderBy("_v")) - 1
        sorted_ = small.withColumn("_i", nth.cast("long")).withColumn("w", F.explode(F.filter("_want", lambda w: w["within"] == F.col("_i")))).select(*keys, "w.rank", "_v")
        done = same.unionByName(sorted_)
        found = done if found is None else found.unionByName(done)
        many = open_.filter(f"_lo < _hi AND _n > {limit}")
        if many.isEmpty():
            break
        bin_ = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1)).cast("int")
        dealt = rows.alias("l").join(F.broadcast(many.select(*own, "_lo", "_hi")).alias("r"), _equal(own)).select("l.*", bin_.alias("_bin"))
        counts = dealt.groupBy(*own, "_bin").agg(F.count("*").alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        counts = counts.alias("l").join(F.broadcast(many.select(*own, "_want")).alias("r"), _equal(own)).select("l.*", "r._want")
        before = F.coalesce(F.sum("_n").over(Window.partitionBy(*own).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.withColumn("_before", before)
        inside = F.filter("_want", lambda w: (w["within"] >= F.col("_before")) & (w["within"] < F.col("_before") + F.col("_n")))
        wanted = counts.withColumn("_want", F.transform(inside, lambda w: F.struct(w["rank"].alias("rank"), (w["within"] - F.col("_before")).alias("within")))).filter("size(_want) > 0")
        wanted = stored(wanted.select(*own, "_bin", "_n", F.col("_a").alias("_lo"), F.col("_b").alias("_hi"), "_want"), "ranges")
        path = F.concat_ws(".", "_path", F.col("_bin").cast("string"))
        open_ = wanted.withColumn("_path", path).drop("_bin")
        # only the values of these ranges are written, the others are read once more
        kept = dealt.alias("l").join(F.broadcast(wanted.select(*own, "_bin")).alias("r"), _equal([*own, "_bin"])).select("l.*")
        rows = stored(kept.select(*keys, "_v", path.alias("_path")), "bins")
    values = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "_v"))).alias("_at"))
    joined = spans.alias("l").join(values.alias("r"), _equal(keys)).select("l.*", "r._at")

    def between(p: float) -> Column:
        lo, hi = F.element_at("_at", F.floor(place(p)).cast("long")), F.element_at("_at", F.ceil(place(p)).cast("long"))
        share = place(p) - F.floor(place(p))
        return F.when(lo == hi, lo).otherwise((1 - share) * lo + share * hi)

    return joined.select(*keys, *[between(p).alias(name) for name, p in at.items()])


def cube_quantiles(df: DataFrame, keys: list[str], values: dict[str, Column], at: dict[str, float], **sizes: int) -> DataFrame:
    """``keys`` and, for each of ``values`` and each quantile of ``at``, a column ``<value>_<quantile>``, all in the same passes."""
    long = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("value")) for n, c in values.items()])).alias("_e")).select(*keys, "_e.name", "_e.value")
    found = exact_quantiles(long.withColumnRenamed("name", "_name"), [*keys, "_name"], "value", at, **sizes)
    wide = [F.max(F.when(F.col("_name") == n, F.col(q))).alias(f"{n}_{q}") for n in values for q in at]
    return found.groupBy(*keys).agg(*wide)
