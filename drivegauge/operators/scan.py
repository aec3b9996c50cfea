"""Ordered passes over series of any length: parts of a series at a time, one carried state per edge between parts.

``dealt`` cuts the order column at quantiles of all rows, so that no part holds much more than its share of the rows,
whatever its key; rows of one key and part make a group. What a group needs of the groups before it (or after it) is a
small summary per group; the summaries of a key, one for each part, are put in order and joined back. So no window and
no array ever holds a whole series, and a key with a third of all rows is worked on by as many tasks as it has parts.

Rows with equal values of the order column stay in one part. Null keys are a key of their own; rows whose order value is
null come first, in a part of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from drivegauge.sources.scratch import stored

#: Relative error of the quantiles: a part holds at most (1 / parts + this) of the rows, plus ties.
ERROR = 0.001
#: A key with no more rows than this is one part, so groups do not become as many as rows where keys are many and small.
WHOLE = 100_000


def _same_keys(keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    return on


def by_size(df: DataFrame, keys: list[str], parts: int | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of keys with at most ``WHOLE`` rows, and those of larger keys; all count as large if ``parts`` are asked for.

    There is at most one large key for every ``WHOLE`` rows; the list is stored, so Spark knows its size in the joins.
    """
    if parts or not keys:
        return None, df
    large = stored(df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > WHOLE).select(*keys), "large-keys")
    if large.isEmpty():
        return df, None
    of = lambda how: df.alias("l").join(large.alias("r"), _same_keys(keys), how)
    return of("left_anti"), of("left_semi")


def dealt(df: DataFrame, order: str, parts: int | None = None, keys: list[str] | None = None) -> DataFrame:
    """With ``_part``: the quantile range of ``order`` (a number) that a row lies in; ranges grow with ``order``. With
    ``keys`` and no ``parts``, only the rows of large keys are cut (``by_size``)."""
    at = F.col(order).cast("double")
    small, df = by_size(df, keys or [], parts)
    if small is not None:
        small = small.withColumn("_part", F.when(at.isNull(), -1).otherwise(0))
        return small if df is None else small.unionByName(dealt(df, order))
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.select(at.alias("v")).approxQuantile("v", [i / parts for i in range(1, parts)], ERROR) if parts > 1 else []
    splits = [-np.inf, *sorted(set(cuts)), np.inf]
    if len(splits) < 3:
        return df.withColumn("_part", F.when(at.isNull(), -1).otherwise(0))
    marked = Bucketizer(splits=splits, inputCol="_at", outputCol="_p", handleInvalid="keep").transform(df.withColumn("_at", at))
    return marked.withColumn("_part", F.when(F.col("_at").isNull(), -1).otherwise(F.col("_p").cast("int"))).drop("_at", "_p")


def _joined(rows: DataFrame, edges: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return rows.alias("l").join(edges.alias("r"), (F.col("l._part") == F.col("r._part")) & _same_keys(keys), "left").select("l.*", *[F.col(f"r.{c}") for c in columns])


def _previous(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Of rows that are ``dealt``: ``value`` of the row before in the part, or else that of the last row of a part before."""
    own = rows.groupBy(*keys, "_part").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("end"))
    edges = own.select(*keys, "_part", F.lag("end").over(Window.partitionBy(*keys).orderBy("_part")).alias("_carried"))
    inside = F.lag(F.struct(F.col(value).alias("v"))).over(Window.partitionBy(*keys, "_part").orderBy(*order))
    found = _joined(rows.withColumn("_inside", inside), edges, keys, ["_carried"])
    return found.withColumn(name, F.coalesce("_inside", "_carried")["v"]).drop("_inside", "_carried")


def with_previous(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "_last", parts: int | None = None) -> DataFrame:
    """With ``value`` of the row before in ``order``, whose first column is a number; null for a key's first row."""
    return _previous(dealt(df, order[0], parts, keys), keys, order, value, name).drop("_part")


def suppress_repeats(df: DataFrame, keys: list[str], stamp: str, order: list[str], parts: int | None = None) -> DataFrame:
    """Without rows whose stamp equals that of the row before."""
    return with_previous(df, keys, order, stamp, "_last", parts).filter(F.col("_last").isNull() | (F.col("_last") != F.col(stamp))).drop("_last")


def last_monotone_run(df: DataFrame, keys: list[str], stamp: str, order: list[str], parts: int | None = None) -> DataFrame:
    """Rows after the last place, in ``order``, where the stamp did not grow: those with no such place behind them."""
    falls = F.coalesce(F.col(stamp) <= F.col("_last"), F.lit(False))
    rows = _previous(dealt(df, order[0], parts, keys), keys, order, stamp, "_last").withColumn("_falls", falls)
    later = Window.partitionBy(*keys).orderBy("_part").rowsBetween(1, Window.unboundedFollowing)
    edges = rows.groupBy(*keys, "_part").agg(F.max("_falls").alias("f")).select(*keys, "_part", F.coalesce(F.max("f").over(later), F.lit(False)).alias("_later"))
    behind = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    marked = rows.withColumn("_behind", F.coalesce(F.max("_falls").over(behind), F.lit(False)))
    return _joined(marked, edges, keys, ["_later"]).filter("NOT _behind AND NOT _later").drop("_part", "_last", "_falls", "_behind", "_later")


def next_kept(ends: np.ndarray, least: float) -> np.ndarray:
    """Of sorted ends, for each the place of the first one that is ``least`` or more behind it (their number: none)."""
    n = len(ends)
    after = np.searchsorted(ends, ends + least)
    for _ in range(2):  # sums and differences may round to different sides
        back = (after > 0) & (ends[np.maximum(after - 1, 0)] - ends >= least)
        after = after - back
        on = (after < n) & (ends[np.minimum(after, n - 1)] - ends < least)
        after = after + on
    return np.maximum(after, np.arange(n) + 1)


def chain_exits(ends: np.ndarray, least: float) -> np.ndarray:
    """For each end the last one of the chain that begins with it, by pointer jumping."""
    n = len(ends)
    jump = next_kept(ends, least)
    last = np.arange(n)
    while (jump < n).any():
        on = np.minimum(jump, n - 1)
        last = np.where(jump < n, last[on], last)
        jump = np.where(jump < n, jump[on], n)
    return ends[last]


def chain_segments(df: DataFrame, keys: list[str], end: str, least: float, parts: int | None = None) -> DataFrame:
    """Segments between successive ends; one shorter than ``least`` is skipped and merges into the next.

    A part doesn't know the end that the part before kept last. Its summary is a step function: for what came before,
    which end it keeps last itself; ends that lead to the same one are one step, so there are at most as many steps as
    ends within ``least`` of the part's last. A key's steps are gone through in order, and each part then walks its
    chain once from the end it was told. Keys that are not large need none of this: their sorted rows are walked as
    they come, many keys in one run. Null ends are left out.
    """
    small, large = by_size(df.select(*keys, F.col(end).cast("double").alias("end")).filter("end IS NOT NULL AND NOT isnan(end)"), keys, parts)
    fields = [df.schema[k] for k in keys]
    kinds = lambda text: StructType([*fields, *StructType.fromDDL(text).fields])
    segments = kinds("start_time double, end_time double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = 0.0
        for batch in batches:
            starts, at = [], []
            for i, (e, first) in enumerate(zip(batch.column("end").to_pylist(), batch.column("_first").to_pylist(), strict=True)):
                if first:
                    last = e
                elif not e - last < least:
                    starts.append(last)
                    at.append(i)
                    last = e
            kept = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(kept.column(k) for k in keys), pa.array(starts, pa.float64()), kept.column("end")], names=segments.names)

    walked = None
    if small is not None:
        first = F.row_number().over(Window.partitionBy(*keys).orderBy("end")) == 1
        walked = small.withColumn("_first", first).mapInArrow(run, segments)
        if large is None:
            return walked
    rows = dealt(large, "end", parts)

    def named(table: pa.Table, columns: dict) -> pa.Table:
        n = len(next(iter(columns.values())))
        first = {k: pa.array([table.column(k)[0].as_py()] * n, table.column(k).type) for k in keys}
        return pa.table({**first, **columns})

    def summary(table: pa.Table) -> pa.Table:
        ends = np.sort(table.column("end").to_numpy())
        exits = chain_exits(ends, least)
        step = np.flatnonzero(np.r_[exits[1:] != exits[:-1], True])
        steps = [ends[step].tolist(), exits[step].tolist()]
        return named(table, {"_part": pa.array([table.column("_part")[0].as_py()], pa.int32()), "upto": pa.array([steps[0]], pa.list_(pa.float64())), "exits": pa.array([steps[1]], pa.list_(pa.float64())), "begin": pa.array([float(exits[0])])})

    def carry(table: pa.Table) -> pa.Table:
        table = table.sort_by("_part")
        told, last = [], None
        for upto, exits, begin in zip(*(table.column(c) for c in ("upto", "exits", "begin")), strict=True):
            told.append(last)
            if last is None:
                last = begin.as_py()
            else:
                upto = upto.values.to_numpy()
                k = int((upto - last >= least).argmax()) if len(upto) and upto[-1] - last >= least else -1
                last = exits.values[k].as_py() if k >= 0 else last
        return named(table, {"_part": table.column("_part"), "told": pa.array(told, pa.float64())})

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        ends = np.sort(left.column("end").to_numpy())
        last, after = right.column("told")[0].as_py(), next_kept(ends, least)
        at = 0 if last is None else int((ends - last >= least).argmax()) if ends[-1] - last >= least else len(ends)
        starts, stops = [], []
        while at < len(ends):
            if last is not None:
                starts.append(last)
                stops.append(float(ends[at]))
            last, at = float(ends[at]), int(after[at])
        return named(left, {"start_time": pa.array(starts, pa.float64()), "end_time": pa.array(stops, pa.float64())})

    groups = [*keys, "_part"]
    steps = rows.groupBy(*groups).applyInArrow(summary, kinds("_part int, upto array<double>, exits array<double>, begin double"))
    told = steps.groupBy(*keys).applyInArrow(carry, kinds("_part int, told double"))
    cut = rows.groupBy(*groups).cogroup(told.groupBy(*groups)).applyInArrow(walk, segments)
    return cut if walked is None else walked.unionByName(cut)
