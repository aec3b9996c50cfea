"""SimHash fingerprints, and all pairs of them within a Hamming radius.

Each distinct term (word shingles of several widths) hashes to 64 bits; the term's weight votes for the bits that are
set and against the others; the fingerprint keeps the sign of each sum. A search within ``radius`` cuts the bits into
more blocks than the radius can touch, keeps one table per choice of blocks that stay equal (the "permuted" tables)
and verifies what meets there by the bit count of the exclusive or.

Cases: null and empty texts have fingerprint 0, since no term votes; equal texts have equal fingerprints; repeated
rows each get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import claim, materialize, slices, texts

#: Weights of the shingles by their number of words. A text of one word has that word as its term.
WEIGHTS = {2: 1, 3: 1}
_WORDS: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and odd multiplications)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, each distinct word being digested once per worker."""
    claim("simhash", _WORDS.clear)
    missing = set(words).difference(_WORDS)
    if len(_WORDS) > 800_000:
        _WORDS.clear()
        missing = set(words)
    _WORDS.update((w, int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")) for w in missing)
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def _ones(terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many terms of each run set each of the 64 bits. Sums of up to 255 terms stay in bytes, eight to a word."""
    ends = np.r_[starts[1:], len(terms)]
    blocks = (ends - starts + 254) // 255
    first = np.cumsum(blocks) - blocks
    cuts = np.repeat(starts, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    bits = np.unpackbits(terms.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.add.reduceat(bits.view(np.uint64), cuts, axis=0).view(np.uint8)
    return np.add.reduceat(sums, first, axis=0, dtype=np.int32)


def fingerprints(rows: list[bytes], weights: dict[int, int] | None = None) -> np.ndarray:
    """A 64-bit fingerprint per text, the votes being counted for all texts of the batch at once."""
    weights = weights or WEIGHTS
    split = [t.split() for t in rows]
    counts = np.array([len(w) for w in split], np.int64)
    if not counts.sum():
        return np.zeros(len(rows), np.uint64)
    hashes = word_hashes(list(itertools.chain.from_iterable(split)))
    row = np.repeat(np.arange(len(rows)), counts)
    votes = np.zeros((len(rows), 64), np.int64)
    term, single = hashes, counts[row] < min(weights)
    for width in range(1, max(weights) + 1):
        if width > 1:
            term = _mix(term[: len(row) - width + 1] * np.uint64(3) + hashes[width - 1 :])
        use = single if width == 1 else row[width - 1 :] == row[: len(term)]
        if (width == 1 or width in weights) and use.any():
            at = row[: len(term)][use]
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            size = np.diff(np.r_[starts, len(at)])
            votes[at[starts]] += weights.get(width, 1) * (2 * _ones(_mix(term[use]), starts) - size[:, None])
    return np.packbits(votes > 0, axis=1, bitorder="little").view("<u8").ravel()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the share of differing bits."""
    return 1 - np.bitwise_count(a ^ b) / 64


def simhash(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (long) per row."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                found = fingerprints([t.encode() for t in part.column(1).to_pylist()])
                yield pa.record_batch([part.column(0), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint long")


def _block(column: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(column, start).bitwiseAND(F.lit((1 << width) - 1))


def near_fingerprints(prints: DataFrame, radius: int = 3, blocks: int = 6, queries: DataFrame | None = None) -> DataFrame:
    """All pairs ``a, b, distance`` of different fingerprints within ``radius``, without caps.

    ``prints`` has a column ``fingerprint``; equal ones are collapsed first (membership is a join on the value).
    With ``queries`` (same column) only pairs that hold a query are sought; ``a`` is then the query. Any two prints
    within the radius agree in ``blocks - radius`` blocks at least, so each choice of so many blocks is one table.
    """
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    choices = list(itertools.combinations(range(blocks), blocks - radius))

    def tables(df: DataFrame) -> DataFrame:
        column = F.col("fingerprint")
        keys = [F.struct(F.lit(i).alias("t"), F.xxhash64(*[_block(column, bounds[b], bounds[b + 1] - bounds[b]) for b in c]).alias("k")) for i, c in enumerate(choices)]
        return df.select("fingerprint").distinct().select("fingerprint", F.explode(F.array(*keys)).alias("key"))

    right = tables(prints)
    left = right if queries is None else tables(queries)
    pairs = left.select(F.col("fingerprint").alias("a"), "key").join(right.select(F.col("fingerprint").alias("b"), "key"), "key")
    pairs = pairs.filter(F.col("a") < F.col("b") if queries is None else F.col("a") != F.col("b"))
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return pairs.filter(distance <= radius).select("a", "b", distance.cast("int").alias("distance")).distinct()


def count_near(rows: DataFrame, radius: int = 3, every: int = 50) -> DataFrame:
    """``rows`` (``doc_id, fingerprint`` in hexadecimal, and more) with ``n_near``: for the stated queries, whose id is
    divisible by ``every``, how many rows, the query itself included, have a fingerprint within ``radius``; else null.

    The search runs over all distinct fingerprints by the permuted tables; rows of one fingerprint are counted, not listed.
    Null ids are not queries.
    """
    number = F.conv(F.col("fingerprint"), 16, -10).cast("long")
    counts = materialize(rows.groupBy(number.alias("fingerprint")).agg(F.count("*").alias("n"), F.max(F.col("doc_id") % every == 0).alias("query")), "prints")
    queries = counts.filter("query")
    found = near_fingerprints(counts.select("fingerprint"), radius, queries=queries.select("fingerprint"))
    others = found.join(counts.select(F.col("fingerprint").alias("b"), "n"), "b").select(F.col("a").alias("fingerprint"), "n")
    near = others.unionByName(queries.select("fingerprint", "n")).groupBy("fingerprint").agg(F.sum("n").alias("n_near"))
    near = materialize(near, "near").select(F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "n_near")
    joined = rows.join(near, "fingerprint", "left")
    return joined.select(*rows.columns, F.when(F.col("doc_id") % every == 0, F.col("n_near")).alias("n_near"))


ROWS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, now: list[str], after: list[str], chained: bool) -> pa.RecordBatch:
    """``chained``: each text's next one is the following row's."""
    sizes = [len(t) for t in now]
    edited = [t[: n - n // 4] + u[: n // 4] for t, u, n in zip(now, after, sizes, strict=True)]
    raw = [t.encode() for t in edited]
    known = fingerprints([t.encode() for t in [*now, *after[-1:]]]) if chained else fingerprints([t.encode() for t in now + after])
    own, nxt, other = known[: len(now)], known[-len(now) :], fingerprints(raw)
    columns = [ids, sizes, [hashlib.sha256(r).hexdigest() for r in raw], [f"{x:016x}" for x in own.tolist()], [f"{x:016x}" for x in other.tolist()], likeness(own, other), likeness(own, nxt)]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in ROWS.split(", ")])


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Fingerprint of each text, of its edited form and their likeness, and the likeness to the next document's.

    The edited form replaces the last quarter of the characters by the first as many of the next document in
    ascending ``doc_id`` (after the last the first; repeated ids in order of their texts). Texts are dealt out by
    ranges of the id once; each range's first and last text, two rows a range, meet their neighbours in a join.
    """
    spark = df.sparkSession
    docs = texts(df, id_col, text_col)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())

    def run(batches):
        last: tuple | None = None
        empty = {f.split()[0]: None for f in ROWS.split(", ")}
        edge = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(f.split()[0], pa.string()) for f in ROWS.split(", ")[2:5]], ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())])

        def bound(row: tuple, name: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([empty | {"doc_id": row[0], "text": row[1], "part": row[2], "edge": name}], schema=edge)

        for batch in batches:
            for chunk in slices(batch, 1):
                rows = list(zip(*(c.to_pylist() for c in chunk.columns), strict=True))
                if last is None:
                    yield bound(rows[0], "first")
                else:
                    rows.insert(0, last)
                last = rows[-1]
                if len(rows) > 1:
                    done = _rows([r[0] for r in rows[:-1]], [r[1] for r in rows[:-1]], [r[1] for r in rows[1:]], True)
                    none = pa.nulls(done.num_rows, pa.string())
                    yield pa.RecordBatch.from_arrays([*done.columns, pa.nulls(done.num_rows, pa.int32()), none, none], schema=edge)
        if last is not None:
            yield bound(last, "last")

    out = materialize(ranged.mapInArrow(run, ROWS + ", part int, edge string, text string"), "simhash")
    firsts, lasts = (out.filter(F.col("edge") == e).select("doc_id", "part", "text") for e in ("first", "last"))
    order = firsts.select("part")  # one small row for each range
    by_part = Window.orderBy("part")
    after = order.select("part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(by_part)).alias("next"))
    pairs = lasts.join(after, "part").join(firsts.select(F.col("part").alias("next"), F.col("text").alias("after")), "next").select("doc_id", "text", "after")

    def finish(batches):
        for batch in batches:
            yield _rows(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), False)

    names = [f.split()[0] for f in ROWS.split(", ")]
    return out.filter(F.col("edge").isNull()).select(*names).unionByName(pairs.mapInArrow(finish, ROWS))
