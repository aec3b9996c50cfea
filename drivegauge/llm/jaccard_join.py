"""Near-duplicate classes by a grouped prefix join on sets of word shingles.

1. *Classes.* Documents with equal sets are one class, numbered by its least id.
2. *Filter.* In any order of the tokens, two sets of Jaccard likeness t agree in ``k`` of their first tokens, where
   each list is longer than the usual prefix by ``k``. With hashes as order, a document stays only if enough of the
   start of its sorted set occurs in other documents too. Each task counts its own repeats first, so a token goes to
   the exchange once per task, however many documents hold it.
3. *Prefixes.* The remaining sets' tokens are ordered by exact document frequency, rare ones first. Sets with the same
   prefix and size collapse into one group, which is one row; its members stay rows of their own.
4. *Joins.* Groups that share a prefix token and pass the length and position filters are compared, first each with
   the one that stands nearest to its start (a star per token, linear in the postings), then, across the components
   so found, all with all, expanded to their members. Pairs inside a known component need no check: they cannot change
   it. Every link is verified on whole sets.

No step caps candidates or frequent tokens. Cases: null and empty texts have no shingles and are alone; texts of fewer
than five words have one; repeated rows and copies share a class; where rows of one id differ, each text is classed and
linked by itself, so one id can stand in several components; rows without id are classed with their copies only; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import contextlib
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import map_batches, materialize, slices, texts
from .components import components
from .shingles import shingle_sets

NUM, DEN = 4, 5  # likeness of 0.8
EXTRA = 10  # the filter's lists are longer than the prefix by a tenth of the set
TOKENS_A_FLUSH = 3_000_000


def prefix_length(n: int) -> int:
    """Two sets of the likeness share a token among so many first ones."""
    return n - -(-NUM * n // DEN) + 1


def filter_length(n: int) -> tuple[int, int]:
    """How many first tokens are looked at, and how many of them must occur elsewhere."""
    k = max(1, n // EXTRA)
    return min(n, prefix_length(n) - 1 + k), max(1, NUM * k // DEN)


PRUNING = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}


@contextlib.contextmanager
def pruned_joins(spark: SparkSession):
    """Lets Spark filter the large side of a join by a bounded Bloom filter of the small side's keys, at any size, and
    gives the session its own settings back afterwards."""
    before = {k: spark.conf.get(k, None) for k in PRUNING}
    try:
        for k, v in PRUNING.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, text_md5``: the set's size, a 128-bit digest of it, and the text's own."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [t.encode() for t in batch.column(1).to_pylist()]
        sets = shingle_sets(rows)
        digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
        return pa.record_batch([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array([hashlib.md5(t).digest() for t in rows], pa.binary())], ["doc_id", "n_shingles", "d1", "d2", "text_md5"])

    return map_batches(docs, run, "doc_id long, n_shingles long, d1 long, d2 long, text_md5 binary")


def survivors(docs: DataFrame) -> DataFrame:
    """``doc_id`` of documents that may have a partner, by step 2."""

    def run(batches):
        held: list[tuple[int, np.ndarray]] = []
        total = 0

        def flush():
            docs_ = np.repeat(np.array([d for d, _ in held], np.int64), [len(t) for _, t in held])
            tokens = np.concatenate([t for _, t in held])
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], docs_[order]
            first = np.r_[True, tokens[1:] != tokens[:-1]]
            times = np.diff(np.r_[np.flatnonzero(first), len(tokens)])
            alone = np.repeat(times == 1, times)
            ids, live = np.unique(owners[~alone], return_counts=True)
            seen = tokens[first]
            mask = times > 1
            keys = np.r_[seen, ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)]
            who = np.r_[owners[first], ids]
            none = np.r_[mask, np.zeros(len(ids), bool)]
            for i in range(0, len(keys), 200_000):
                j = slice(i, i + 200_000)
                yield pa.record_batch([pa.array(keys[j].view(np.int64)), pa.array(who[j], mask=none[j]), pa.array(np.r_[np.zeros(len(seen), np.int32), live.astype(np.int32)][j], mask=np.r_[np.ones(len(seen), bool), np.zeros(len(ids), bool)][j])], ["token", "doc_id", "live"])

        for batch in batches:
            for part in slices(batch, 1):
                ids = part.column(0).to_pylist()
                for d, s in zip(ids, shingle_sets([t.encode() for t in part.column(1).to_pylist()]), strict=True):
                    if len(s):
                        held.append((d, s[: filter_length(len(s))[0]]))
                        total += len(held[-1][1])
                if total >= TOKENS_A_FLUSH:
                    yield from flush()
                    held, total = [], 0
        if held:
            yield from flush()

    rows = docs.mapInArrow(run, "token long, doc_id long, live int")
    again = F.count("*").over(Window.partitionBy("token"))  # a token's rows: one per task that saw it
    marked = rows.withColumn("live", F.coalesce("live", (again > 1).cast("int"))).filter("doc_id is not null and live > 0")
    return marked.groupBy("doc_id").agg(F.sum("live").alias("live"))


def token_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, n, token`` for every token of every set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets([t.encode() for t in batch.column(1).to_pylist()])
        sizes = np.array([len(s) for s in sets], np.int64)
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
        return pa.record_batch([pa.array(ids), pa.array(np.repeat(sizes, sizes).astype(np.int32)), pa.array(np.concatenate(sets).view(np.int64) if len(sets) else np.zeros(0, np.int64))], ["doc_id", "n", "token"])

    return map_batches(docs, run, "doc_id long, n int, token long", limit=1 << 20)


def prefixes(docs: DataFrame) -> DataFrame:
    """``doc_id, n, alone, prefix``: the tokens of the prefix that other sets hold too, rare ones first, with positions.

    ``alone`` tells that the prefix begins with tokens of no other set.
    """
    rows = token_rows(docs)
    frequency = rows.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    known = rows.join(frequency, "token").groupBy("doc_id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "token"))).alias("live"))
    unique = F.col("n") - F.size("live")
    length = F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1
    kept = known.withColumn("unique", unique).withColumn("length", length.cast("int")).filter("unique < length")
    numbered = F.transform(F.slice("live", F.lit(1), F.col("length") - F.col("unique")), lambda x, i: F.struct((i + F.col("unique")).cast("int").alias("pos"), x["token"].alias("token")))
    return kept.select("doc_id", "n", (F.col("unique") > 0).alias("alone"), numbered.alias("prefix"))


def may_link(n1, p1, n2, p2):
    """Length filter, and position filter for the *first* token that two sets share, at positions ``p1`` and ``p2``: none
    before it is common. A link is found at its first shared token, so the others need not pass."""
    bound = 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    return (F.least(n1, n2) * DEN >= F.greatest(n1, n2) * NUM) & (bound * (NUM + DEN) >= (n1 + n2) * NUM)


def sides_may_link() -> Column:
    """The filters for two components at a token, by the extremes of their members there; exact for single members."""
    return (F.least("x1", "x2") * DEN >= F.greatest("m1", "m2") * NUM) & ((1 + F.least("r1", "r2")) * (NUM + DEN) >= (F.col("m1") + F.col("m2")) * NUM)


def verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The ``a, b`` of ``pairs`` whose sets have the likeness."""
    right = pairs.join(docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = right.join(docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "text_b", "b", "text_a")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[str, np.ndarray] = {}
        left, right_ = batch.column(3).to_pylist(), batch.column(1).to_pylist()
        new = list({*left, *right_})
        known.update(zip(new, shingle_sets([t.encode() for t in new]), strict=True))
        good = []
        for x, y in zip(left, right_, strict=True):
            s, t = known[x], known[y]
            both_ = len(np.intersect1d(s, t, assume_unique=True))
            good.append(DEN * both_ >= NUM * (len(s) + len(t) - both_) and len(s) > 0)
        keep = pa.array(good, pa.bool_())
        return pa.record_batch([batch.column(0).filter(keep), batch.column(2).filter(keep)], ["a", "b"])

    return map_batches(both, run, "a long, b long", limit=1 << 20)


def class_links(docs: DataFrame) -> DataFrame:
    """``node, component`` over the representatives of classes that have a link; ``docs`` holds representatives only."""
    tokens = F.array_join(F.transform("prefix", lambda x: x["token"].cast("string")), ",")
    key = F.unhex(F.md5(F.concat_ws(";", F.col("n"), tokens, F.when(F.col("alone"), F.col("doc_id")))))
    found = materialize(prefixes(docs).withColumn("key", key), "prefixes")
    groups = materialize(found.groupBy("key").agg(F.min("doc_id").alias("gid"), F.first("n").alias("n"), F.first("prefix").alias("prefix")), "groups")
    members = materialize(found.select("key", "doc_id").join(groups.select("key", "gid"), "key").select("gid", "doc_id"), "members")  # a row each: no row holds a group
    postings = groups.select("gid", "n", F.explode("prefix").alias("x")).select(F.col("x.token").alias("token"), "gid", "n", F.col("x.pos").alias("pos"))
    inner = members.filter("gid != doc_id").select(F.col("gid").alias("a"), F.col("doc_id").alias("b"))
    pivots = postings.groupBy("token").agg(F.min(F.struct("pos", "n", "gid")).alias("p"), F.count("*").alias("df")).filter("df > 1")
    star = postings.join(pivots, "token").filter(F.col("gid") != F.col("p.gid")).filter(may_link(F.col("n"), F.col("pos"), F.col("p.n"), F.col("p.pos")))
    first = materialize(star.select(F.col("p.gid").alias("a"), F.col("gid").alias("b")).union(inner).distinct(), "star")
    links = materialize(verify(first, docs), "links")
    part = materialize(components(links), "components")

    # across components: postings of members, and per token every pair of different components
    placed = members.join(part.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    named = materialize(postings.join(placed, "gid").select("token", "component", "doc_id", "n", "pos"), "postings")
    rest_after = F.col("n") - F.col("pos") - 1
    sides = named.groupBy("token", "component").agg(F.min("n").alias("m"), F.max("n").alias("x"), F.max(rest_after).alias("r"))
    several = sides.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token")
    sides = materialize(sides.join(several, "token"), "sides")
    side = lambda k: sides.select("token", F.col("component").alias(f"c{k}"), *[F.col(v).alias(f"{v}{k}") for v in "mxr"])
    same = (F.col("token") == F.col("token2")) & (F.col("c1") < F.col("c2")) & sides_may_link()
    crossing = side(1).join(side(2).withColumnRenamed("token", "token2"), same).select("token", "c1", "c2")
    member = lambda k, name: named.select("token", F.col("component").alias(f"c{k}"), F.col("doc_id").alias(name), F.col("n").alias(f"n{k}"), F.col("pos").alias(f"p{k}"))
    pairs = crossing.join(member(1, "a"), ["token", "c1"]).join(member(2, "b"), ["token", "c2"]).filter(may_link(*[F.col(v) for v in ("n1", "p1", "n2", "p2")]))
    pairs = materialize(pairs.select("a", "b").distinct(), "pairs")
    tried = first.union(first.select("b", "a"))
    rest = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "crossing")
    more = materialize(verify(rest, docs), "links")
    return part if more.isEmpty() else components(links.union(more))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row; the component's id is its least ``doc_id``."""
    with pruned_joins(df.sparkSession):
        return _classed(texts(df, id_col, text_col)).drop("text_md5")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, that stand for their component: those of its least id.

    A row is judged by its own text: of an id with several texts each goes or stays by itself, and of those in one
    component the text of least MD5 stays. Equal rows are one document, so all but one of them go. Rows without id and
    rows without words stay, repeated ones too.
    """
    named = lambda c: F.col("`" + c.replace("`", "``") + "`")
    with pruned_joins(df.sparkSession):
        found = _classed(texts(df, id_col, text_col)).filter("doc_id is not null and n_shingles > 0").groupBy("doc_id", "component_id", "text_md5").agg(F.count("*").alias("n"))
        found = materialize(found, "classed")
    lead = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.min("text_md5").alias("text_md5"), F.count("*").alias("texts"))
    other = found.filter("doc_id != component_id").select("doc_id", "text_md5")
    several = lead.filter("texts > 1").join(found.filter("doc_id = component_id").withColumnRenamed("text_md5", "own"), "doc_id").filter("own != text_md5").select("doc_id", F.col("own").alias("text_md5"))
    # The row travels as one struct, so that no name of its columns can meet those of the key.
    md5 = F.unhex(F.md5(F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary")))
    packed = df.select(F.struct(*[named(c) for c in df.columns]).alias("row"), named(id_col).cast("long").alias("doc_id"), md5.alias("text_md5"))
    key = ["doc_id", "text_md5"]
    # grows with the input, so it is never broadcast: the same plan at every size
    gone = materialize(other.union(several), "duplicates").hint("merge")
    kept = packed.join(gone, key, "left_anti")
    again = materialize(found.filter("n > 1 and doc_id = component_id").select(*key), "again")
    if not again.isEmpty():
        kept = kept.join(again, key, "left_anti").unionByName(kept.join(again, key, "left_semi").dropDuplicates(key))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in df.columns])


def _classed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_md5`` per row.

    A class is a node of its own, numbered in the order of its least (id, MD5), so that ids with several texts take part
    with each of them and the least node of a component is the class of its least id.
    """
    sig = materialize(signatures(docs), "signatures")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_md5"))).alias("first")
    classes = sig.filter("n_shingles > 0").groupBy("d1", "d2").agg(first, F.first("n_shingles").alias("n"))
    classes = classes.select("d1", "d2", "n", F.col("first.doc_id").alias("rep"), F.col("first.text_md5").alias("rep_md5")).orderBy("rep", "rep_md5", "d1")
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    k = F.greatest(F.lit(1), F.floor(F.greatest(F.lit(1), F.floor(F.col("n") / EXTRA)) * NUM / DEN))
    named = docs.filter("doc_id is not null")  # rows without id stay in ``sig`` and are classed by digest alone
    chosen = survivors(named).join(classes.select(F.col("rep").alias("doc_id"), "n", "node", "rep_md5"), "doc_id").filter(F.col("live") >= k)
    chosen = materialize(chosen.select("doc_id", "rep_md5", "node", "live"), "survivors")
    kept = named.join(chosen.filter("live > 0").select("doc_id", "rep_md5", "node"), "doc_id").filter(F.unhex(F.md5("text")) == F.col("rep_md5")).select(F.col("node").alias("doc_id"), "text")
    if not sig.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        kept = kept.groupBy("doc_id").agg(F.first("text").alias("text"))  # repeated rows of a class's first id
    part = class_links(materialize(kept, "kept"))
    rooted = classes.join(part, "node", "left").select("d1", "d2", F.coalesce("component", "node").alias("root"))
    placed = rooted.join(classes.select(F.col("node").alias("root"), F.col("rep").alias("component_id")), "root").drop("root")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return sig.join(placed, ["d1", "d2"], "left").select("doc_id", "n_shingles", own.alias("component_id"), "text_md5")
