"""What each of several filters removes, under every order in which they can be applied.

A row is described by its mask: the filters it fails. In one order it goes at the first filter of its mask. Orders are
numbered by their Lehmer rank, that is lexicographically, so all orders that begin alike are one interval of ranks, and
the orders in which a mask goes at step s are the intervals of the beginnings whose last letter, alone of their s
letters, is in the mask. The rows of a mask are added at an interval's begin and taken off at its end; a running sum
over the ranks then gives every order at once, without a pass over the rows for each.

Rows are counted per part and mask first, so what follows has at most 2^k rows a part (k filters), k * k! after the
ranks. The tables of intervals and orders follow from k alone.

Cases: a null text is empty; an empty text fails A (no words) and of B to D none; a null part is the empty string; a
row without id is never a later copy and has no labels; rows that repeat an id and text are no copies of each other;
labels of a repeated id hold if one of its rows says so; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What is counted of the rows of a mask.
MEASURES = ("n", "good", "toxic")
WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_conditions(text: Column) -> dict[str, Column]:
    """The failures that a text shows by itself, by filter."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {"A": n < 50, "B": 100 * distinct.cast("long") < 65 * n.cast("long"), "C": 100 * capitals.cast("long") > 5 * F.length(text).cast("long"), "D": text.rlike("[#$%&*|]")}


def _bits(failures: dict[str, Column], letters: str) -> Column:
    return sum((F.when(c, 1 << letters.index(k)).otherwise(0) for k, c in failures.items()), F.lit(0)).cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame, letters: str = "ABCDE", copy: str = "E") -> DataFrame:
    """``part``, ``mask`` and the measures: all rows of ``docs`` (doc_id, text, source) counted by what they fail.

    A text fails ``copy`` if a row of a smaller id holds the same text (by SHA-256). The first row of a text is found
    from counts per text and part, so a text of many copies is never gathered in one task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    row = row.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), _bits(text_conditions(F.col("text")), letters).alias("mask"))
    # Rows without id are spread by their text; they meet no label.
    row = row.select("*", F.coalesce("doc_id", F.xxhash64("digest")).alias("key"), F.col("doc_id").isNotNull().alias("named"))
    same = row.groupBy("key", "named", "part", "digest", "mask").agg(F.count("*").alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("key"), F.lit(True).alias("named")).agg(F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    held = same.join(known, ["key", "named"], "left")
    held = held.select("part", "digest", "mask", "n", F.when(F.coalesce("is_good", F.lit(False)), F.col("n")).otherwise(0).alias("good"), F.when(F.coalesce("is_toxic", F.lit(False)), F.col("n")).otherwise(0).alias("toxic"), F.when(F.col("named"), F.col("key")).alias("doc_id"))
    # Per text and part: all rows, those without id, and those of the least id. The mask follows from the text.
    free, first = F.col("doc_id").isNull(), F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *MEASURES))
    per = held.groupBy("digest", "part", "mask").agg(*[F.sum(m).alias(m) for m in MEASURES], *[F.sum(F.when(free, F.col(m)).otherwise(0)).alias(f"free_{m}") for m in MEASURES], F.min(first).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    per = per.withColumn("leads", F.coalesce(F.col("first.doc_id") == least, F.lit(False)))
    stays = {m: F.col(f"free_{m}") + F.when(F.col("leads"), F.col(f"first.{m}")).otherwise(0) for m in MEASURES}
    both = F.explode(F.array(F.struct(F.col("mask"), *[c.alias(m) for m, c in stays.items()]), F.struct((F.col("mask") + (1 << letters.index(copy))).alias("mask"), *[(F.col(m) - c).alias(m) for m, c in stays.items()])))
    split = per.select("part", both.alias("s")).select("part", "s.*")
    return split.groupBy("part", "mask").agg(*[F.sum(m).alias(m) for m in MEASURES])


def lehmer_rank(prefix: tuple[int, ...], k: int) -> int:
    """Rank of the first order of k filters that begins with ``prefix``."""
    left, rank = list(range(k)), 0
    for i, f in enumerate(prefix):
        rank += left.index(f) * math.factorial(k - 1 - i)
        left.remove(f)
    return rank


def removal_intervals(k: int) -> list[tuple[int, int, int, int]]:
    """``(mask, step, begin, end)``: in the orders of rank begin to end - 1 the mask's rows go at that step."""
    out = []
    for step in range(1, k + 1):
        for prefix in itertools.permutations(range(k), step):
            begin = lehmer_rank(prefix, k)
            before, last = sum(1 << f for f in prefix[:-1]), 1 << prefix[-1]
            out += [(m, step, begin, begin + math.factorial(k - step)) for m in range(1 << k) if m & last and not m & before]
    return out


def audit_orders(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Per part, order and step what the filter of that step removes, from the counts by ``part`` and ``mask``.

    ``removed``, ``good_lost``, ``toxic_lost`` are the sums at a rank; ``kept`` is what no step so far removed;
    ``redundant`` fails the filter but went before; ``unique_fails`` fails it alone; ``shapley`` sums ``removed`` of the
    filter over all orders.
    """
    k, spark = len(letters), counts.sparkSession
    orders = math.factorial(k)
    ends = [(m, s, r, sign) for m, s, a, b in removal_intervals(k) for r, sign in ((a, 1), (b, -1)) if r < orders]
    ends = F.broadcast(spark.createDataFrame(ends, "mask int, step int, rank int, sign int"))  # at most 2^k * k * k! rows
    steps = counts.join(ends, "mask").select("part", "step", "rank", *[(F.col("sign") * F.col(m)).alias(m) for m in MEASURES])
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)) for i in range(k)]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(k)]
    totals = counts.groupBy("part").agg(F.sum("n").alias("total"), F.array(*fails).alias("fails"), F.array(*alone).alias("alone"))
    grid = totals.select("part", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step")).select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("rank"), *[F.lit(0).cast("long").alias(m) for m in MEASURES])
    steps = steps.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(m).alias(m) for m in MEASURES])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.select("part", "step", "rank", *[F.sum(m).over(along).alias(m) for m in MEASURES])
    names = F.array(*[F.lit("".join(letters[i] for i in p)) for p in itertools.permutations(range(k))])
    steps = steps.select("*", F.element_at(names, F.col("rank") + 1).alias("filter_order")).withColumn("letter", F.expr("substring(filter_order, step, 1)"))
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.select("*", F.sum("n").over(so_far).alias("gone"), F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"))
    out = steps.join(totals, "part").withColumn("at", F.expr(f"instr('{letters}', letter)"))
    long = {"kept": F.col("total") - F.col("gone"), "removed": F.col("n"), "redundant": F.element_at("fails", F.col("at")) - F.col("n"), "unique_fails": F.element_at("alone", F.col("at")), "good_lost": F.col("good"), "toxic_lost": F.col("toxic"), "shapley": F.col("shapley")}
    return out.select("part", "filter_order", "step", *[c.cast("long").alias(name) for name, c in long.items()])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five text filters A to E over ``docs``, in all 120 orders."""
    return audit_orders(mask_counts(docs, labels))
