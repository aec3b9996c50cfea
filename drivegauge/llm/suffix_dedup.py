"""Removal of byte strings that an earlier document holds too, over the suffixes of all texts.

A suffix matters here by its first ``LENGTH`` bytes only (its window), so suffixes are not ordered but named: equal
windows get equal names. The cover is content-defined: of the ``LENGTH - GRAM + 1`` grams in a window the one of least
hash is its sample. Two equal windows have the same sample at the same offset, as a difference cover would promise,
at 7 % of all positions. Consecutive windows with the same sample are one run.

1. *Buckets.* Runs fall into suffix buckets by their sample. Blocks of documents exchange the sorted samples they
   hold, packed as differences, and learn which occur in other blocks: only those buckets are built at all.
2. *Ranks.* A run's rank is the name of its whole string with the sample's place. A run whose rank an earlier document
   has is removed as a whole.
3. *Ties.* Where a bucket has several ranks, the first run of each rank is sent to one task, which names its windows one
   by one; those that an earlier document's run shares are removed. Runs of a bucket with more than ``SMALL`` ranks are
   named where they are and sent window by window, so that no task gets an unbounded bucket.

All four visits to the texts (samples, ranks, ties, result) read one exchange by block. A block settles what repeats
inside it, so no key of the later exchanges has more rows than there are blocks. Windows are compared by 128 bits: a
run's bucket and rank, a tied window's bucket and name, or its name and second name.

Cases: null and empty texts, and texts shorter than a window, lose nothing; of equal texts all but those of the least
id lose everything; rows of one id never count as earlier than each other; rows without id are kept whole and make no
other row lose anything; an id with more than 65,536 different texts is an error; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .base import claim, materialize, texts

LENGTH, GRAM = 50, 25
BLOCK_BYTES = 6 << 20
CHUNK = 1 << 20
SMALL = 256
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD[0]
    x = (x ^ (x >> np.uint64(29))) * ODD[1]
    return x ^ (x >> np.uint64(32))


def gram_names(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` (25) bytes at every position of an array that goes on for 8 bytes behind the last gram."""
    n = max(0, len(data) - 8 - GRAM + 1)
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    h = _mix(words[16 : 16 + n] * ODD[2] + data[24 : 24 + n].astype(np.uint64) * ODD[3])
    h = _mix((h + words[8 : 8 + n]) * ODD[1])
    return _mix((h + words[:n]) * ODD[3])


def window_names(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Name of the windows that begin at some positions: both halves' hashes together."""
    return _mix(grams[at] * ODD[2] + grams[at + GRAM])


def second_names(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Another 64 bits of the same windows: names and second names agree together only if both halves' hashes do."""
    return _mix(grams[at + GRAM] * ODD[0] + (grams[at] ^ ODD[1]))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    span, out = 1, keys
    while span * 2 <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


class Runs:
    """The runs of a chunk of texts: whose they are, their first and last window, their sample and their rank."""

    def __init__(self, rows: list[bytes]):
        sizes = np.array([len(r) for r in rows], np.int64)
        data = np.frombuffer(b"".join(rows) + bytes(LENGTH + 8), np.uint8)
        self.grams = grams = gram_names(data)
        self.starts = starts = np.cumsum(sizes) - sizes
        bits = np.uint64(int(len(data)).bit_length())
        keys = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
        sample = (_least(keys, LENGTH - GRAM + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        counts = np.maximum(sizes - LENGTH + 1, 0)
        owner = np.repeat(np.arange(len(rows)), counts)
        window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[owner]
        sample = sample[window]
        first = np.flatnonzero(np.r_[True, (sample[1:] != sample[:-1]) | (owner[1:] != owner[:-1])][: len(window)])
        last = np.r_[first[1:] - 1, len(window) - 1][: len(first)]
        self.owner, at, self.end = owner[first], sample[first], window[last]
        self.begin = window[first]
        self.bucket, self.sample = grams[at], at

    def ranks(self, use: np.ndarray) -> np.ndarray:
        """Ranks of some of the runs."""
        begin, end = self.begin[use], self.end[use]
        shape = ((end - begin) * 64 + self.sample[use] - begin).astype(np.uint64)
        return _mix(window_names(self.grams, begin) * ODD[3] + window_names(self.grams, end) + _mix(shape))


def _rows(block: pa.Table) -> list[tuple[int, int, bytes]]:
    """``(id, ordinal among the id's texts, text)`` of a block's rows that have an id, repeated rows once."""
    claim("suffix_dedup", lambda: None)
    found = sorted({(d, t) for d, t in zip(block["doc_id"].to_pylist(), block["text"].to_pylist(), strict=True) if d is not None})
    out: list[tuple[int, int, bytes]] = []
    for d, t in found:
        out.append((d, out[-1][1] + 1 if out and out[-1][0] == d else 0, t.encode()))
        if out[-1][1] > 0xFFFF:
            raise ValueError(f"id {d} has more than 65,536 different texts")
    return out


def _copied(doc: int | None, raw: bytes, whole: set[tuple[int, bytes]], ids: set[int]) -> bool:
    """Whether this text of the id is a copy of an earlier document's; other texts of the id are not."""
    return doc in ids and len(raw) >= LENGTH and (doc, hashlib.md5(raw).digest()) in whole


def _chunks(rows: list[tuple[int, int, bytes]], whole: set[tuple[int, bytes]]):
    """Rows that may repeat in part, in chunks of bounded size."""
    part, size = [], 0
    ids = {d for d, _ in whole}
    for row in rows:
        if len(row[2]) < LENGTH or _copied(row[0], row[2], whole, ids):
            continue
        part.append(row)
        size += len(row[2])
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def _ranges(tokens: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each token: its upper 32 bits scaled."""
    return ((tokens >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _pack(tokens: np.ndarray) -> bytes:
    """Sorted tokens as differences, in four bytes each where all of them fit."""
    steps = np.diff(tokens, prepend=np.uint64(0))
    narrow = len(steps) < 2 or steps[1:].max() < 1 << 32
    return bytes([int(narrow)]) + steps[:1].tobytes() + steps[1:].astype("<u4" if narrow else "<u8").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data[9:], "<u4" if data[0] else "<u8").astype(np.uint64)
    return np.cumsum(np.r_[np.frombuffer(data[1:9], np.uint64), steps], dtype=np.uint64)


def _distinct(token: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct samples, and which of them two of its documents hold."""
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]][: len(token)])
    if not len(first):
        return token, np.zeros(0, bool)
    return token[first], np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)


def place_of(begin: np.ndarray, end: np.ndarray, sub: np.ndarray) -> np.ndarray:
    """First window, number of windows and the text's ordinal in one number."""
    return begin.astype(np.int64) << 32 | np.minimum(end - begin, 0xFFFF).astype(np.int64) << 16 | sub.astype(np.int64)


def unplace(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    begin = place >> 32
    return begin, begin + (place >> 16 & 0xFFFF), place & 0xFFFF


def ranges_of(doc: np.ndarray, at: np.ndarray, sub: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of documents joined to ranges of neighbours: the documents, and the places."""
    order = np.lexsort((at, sub, doc))
    doc, at, sub = doc[order], at[order], sub[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (at[1:] - at[:-1] > 1)][: len(doc)])
    last = np.r_[first[1:] - 1, len(doc) - 1][: len(first)]
    pieces = (at[last] - at[first]) // 0xFFFF + 1
    k = np.repeat(np.arange(len(first)), pieces)
    begin = at[first][k] + 0xFFFF * (np.arange(len(k)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    return doc[first][k], place_of(begin, np.minimum(begin + 0xFFFE, at[last][k]), sub[first][k])


def _table(columns: dict[str, np.ndarray], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


RUN = pa.schema([("bucket", pa.int64()), ("rank", pa.int64()), ("known", pa.bool_()), ("doc_id", pa.int64()), ("place", pa.int64())])
RUN_DDL = "bucket long, rank long, known boolean, doc_id long, place long"
TIE = pa.schema([("part", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("run", pa.binary())])
TIE_DDL = "part long, key long, doc_id long, place long, run binary"
COVER = pa.schema([("doc_id", pa.int64()), ("place", pa.int64())])


def _settle(key: list[np.ndarray], doc: np.ndarray, spare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows an earlier document of the block already covers; those get ``spare`` as key, so that no key is hot."""
    order = np.lexsort((doc, *key[::-1]))
    new = np.zeros(len(doc), bool)
    if len(doc):
        new[0] = True
        for k in key:
            new[1:] |= k[order][1:] != k[order][:-1]
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1] if len(doc) else doc
    known = np.zeros(len(doc), bool)
    known[order] = doc[order] > least
    return known, np.where(known, spare, key[-1])


def removed_spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of the bytes in the windows that begin from ``begin`` to ``end``; touching spans are one."""
    order = np.argsort(begin, kind="stable")
    b, e = begin[order], np.maximum.accumulate(end[order] + LENGTH)
    first = np.flatnonzero(np.r_[True, b[1:] > e[:-1]])
    return b[first], e[np.r_[first[1:] - 1, len(b) - 1]]


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def dedup_suffixes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row."""
    return _dedup(texts(df, id_col, text_col))


def shortened(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``df`` with the bytes removed from its texts, and what is left of a cut character with them.

    All columns travel with their text, so that rows of one id never mix. Rows of which nothing is left go; texts that
    were null or empty stay as they are. ``length_col`` is set to the code points left where a text was cut.
    """
    col = lambda c: F.col("`" + c.replace("`", "``") + "`")
    others = [c for c in df.columns if c != text_col]
    docs = df.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"), col(text_col).isNotNull().alias("given"), F.struct(*[col(c) for c in others]).alias("row"))
    found = _dedup(docs, carry=True).filter("n_removed = 0 or kept != ''")
    text = F.col("kept").cast(df.schema[text_col].dataType)

    def value(c: str):
        if c == text_col:
            return text
        own = F.col("row").getField(c)
        return F.when(F.col("n_removed") > 0, F.char_length("kept")).otherwise(own).cast(df.schema[c].dataType) if c == length_col else own

    return found.select(*[value(c).alias(c) for c in df.columns])


def _dedup(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Result rows; with ``carry`` also ``kept``, the text left (null if not ``given``), and the struct ``row`` as it came."""
    keys = materialize(docs.select("doc_id", F.unhex(F.md5("text")).alias("digest"), F.octet_length("text").alias("n")), "suffix-keys")
    total = keys.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    bits = min(64, max(40, (total // 12).bit_length() + 14))
    shift = np.uint64(64 - bits)
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block")
    firsts = keys.groupBy("digest", "n").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).filter(f"rows > 1 and n >= {LENGTH}").select("digest", "first")
    copies = materialize(keys.join(firsts, "digest").filter("doc_id > first").select("doc_id", "digest", block).distinct(), "suffix-copies")
    dealt = docs.select(*docs.columns, block)

    def offer(key, left: pa.Table, right: pa.Table) -> pa.Table:
        tokens, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for part in _chunks(_rows(left), set(zip(right["doc_id"].to_pylist(), right["digest"].to_pylist(), strict=True))):
            runs = Runs([r[2] for r in part])
            tokens.append(runs.bucket >> shift << shift)
            owners.append(np.array([r[0] for r in part], np.int64)[runs.owner])
        token, _ = _distinct(np.concatenate(tokens), np.concatenate(owners))
        ranges = _ranges(token, blocks)
        cuts = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]][: len(token)])
        packed = [_pack(token[a:b]) for a, b in zip(cuts, np.r_[cuts[1:], len(token)][: len(cuts)], strict=True)]
        return pa.table({"part": pa.array(ranges[cuts]), "block": pa.array([key[0].as_py()] * len(cuts), pa.int64()), "tokens": pa.array(packed, pa.binary())})

    def count(group: pa.Table) -> pa.Table:
        lists = [_unpack(t) for t in group["tokens"].to_pylist()]
        token, times = np.unique(np.concatenate(lists), return_counts=True)
        shared = token[times > 1]
        flags = [np.packbits(np.isin(t, shared, assume_unique=True)).tobytes() for t in lists]
        return pa.table({"block": group["block"], "part": group["part"], "flags": pa.array(flags, pa.binary())})

    def rank(key, left: pa.Table, right: pa.Table) -> pa.Table:
        whole = {(d, x) for d, x in zip(right["doc_id"].to_pylist(), right["digest"].to_pylist(), strict=True) if d is not None}
        found = []
        for part in _chunks(_rows(left), whole):
            runs = Runs([r[2] for r in part])
            ids, subs = np.array([r[0] for r in part], np.int64), np.array([r[1] for r in part], np.int64)
            found.append((runs.bucket, runs.ranks(np.arange(len(runs.bucket))), ids[runs.owner], subs[runs.owner], runs.begin - runs.starts[runs.owner], runs.end - runs.starts[runs.owner]))
        if not found:
            return RUN.empty_table()
        bucket, name, doc, sub, begin, end = (np.concatenate(c) for c in zip(*found, strict=True))
        token = bucket >> shift << shift
        tokens, live = _distinct(token, doc)
        ranges = _ranges(tokens, blocks)
        for part, flags in zip(right["part"].to_pylist(), right["flags"].to_pylist(), strict=True):
            if flags is not None:
                a, b = np.searchsorted(ranges, [part, part + 1])
                live[a:b] |= np.unpackbits(np.frombuffer(flags, np.uint8), count=b - a).astype(bool)
        tokens = tokens[live]
        if not len(tokens):
            return RUN.empty_table()
        use = tokens[np.minimum(np.searchsorted(tokens, token), len(tokens) - 1)] == token
        bucket, name, doc, place = bucket[use].view(np.int64), name[use].view(np.int64), doc[use], place_of(begin[use], end[use], sub[use])
        spare = _mix(doc.view(np.uint64) * ODD[0] + place.view(np.uint64)).view(np.int64)
        known, name = _settle([bucket, name], doc, spare)
        return _table({"bucket": np.where(known, spare, bucket), "rank": name, "known": known, "doc_id": doc, "place": place}, RUN)

    def ties(key, left: pa.Table, right: pa.Table) -> pa.Table:
        wanted: dict[tuple[int, int], list[tuple[int, int, int, bool]]] = {}
        b, e, s = unplace(right["place"].to_numpy())
        for d, sub, begin, end, bucket, large in zip(right["doc_id"].to_pylist(), s.tolist(), b.tolist(), e.tolist(), right["bucket"].to_pylist(), right["large"].to_pylist(), strict=True):
            wanted.setdefault((d, sub), []).append((begin, end, bucket, large))
        small: list[tuple] = []
        names, more, docs_, subs, ats = [], [], [], [], []
        for d, sub, t in _rows(left):
            runs = wanted.get((d, sub), ())
            small += [(bucket, d, (begin << 32) | ((end - begin) << 16) | sub, t[begin : end + LENGTH]) for begin, end, bucket, large in runs if not large]
            if big := [(begin, end) for begin, end, _, large in runs if large]:
                at = np.concatenate([np.arange(begin, end + 1) for begin, end in big])
                grams = gram_names(np.frombuffer(t + bytes(LENGTH + 8), np.uint8))
                names.append(window_names(grams, at).view(np.int64))
                more.append(second_names(grams, at).view(np.int64))
                docs_.append(np.full(len(at), d))
                subs.append(np.full(len(at), sub))
                ats.append(at)
        out = [TIE.empty_table()]
        if small:
            keys, ids, places, data = zip(*small, strict=True)
            keys = np.array(keys, np.int64)
            out.append(pa.table([pa.array((_mix(keys.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)), pa.array(keys), pa.array(ids, pa.int64()), pa.array(places, pa.int64()), pa.array(data, pa.binary())], schema=TIE))
        if names:
            name, second, doc, sub, at = (np.concatenate(x) for x in (names, more, docs_, subs, ats))
            known, _ = _settle([second, name], doc, name)
            done, places = ranges_of(doc[known], at[known], sub[known])  # settled in the block; they travel as ranges
            keys = np.r_[name[~known], _mix(done.view(np.uint64) + places.view(np.uint64)).view(np.int64)]
            ids, at_ = np.r_[doc[~known], done], np.r_[place_of(at[~known], at[~known], sub[~known]), places]
            seconds = second[~known].tobytes()
            marks = pa.array([seconds[k : k + 8] for k in range(0, len(seconds), 8)] + [b""] * len(done), pa.binary())
            out.append(pa.table([pa.array((_mix(keys.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)), pa.array(keys), pa.array(ids), pa.array(at_), marks], schema=TIE))
        return pa.concat_tables(out)

    def resolve(group: pa.Table) -> pa.Table:
        doc, place = group["doc_id"].to_numpy(), group["place"].to_numpy()
        key = group["key"].to_numpy()
        data = group["run"].combine_chunks()
        sizes = np.asarray(pa.compute.binary_length(data)).astype(np.int64)
        done, single = sizes == 0, sizes == 8  # a run has as many bytes as a window at least
        runs = np.flatnonzero(sizes >= LENGTH)
        raw = np.frombuffer(b"".join(data.take(pa.array(runs)).to_pylist()) + bytes(LENGTH + 8), np.uint8)
        grams, lengths = gram_names(raw), sizes[runs]
        windows = lengths - LENGTH + 1
        inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        own = np.repeat(runs, windows)
        name = window_names(grams, np.repeat(np.cumsum(lengths) - lengths, windows) + inside) if len(runs) else np.zeros(0, np.uint64)
        one = np.flatnonzero(single)
        begin, _, sub = unplace(place)
        every = np.r_[own, one]
        name = np.r_[name, key[one].view(np.uint64)]
        second = np.r_[key[own], np.frombuffer(b"".join(data.take(pa.array(one)).to_pylist()), np.int64)]  # a run's bucket, a window's second name
        at = np.r_[begin[own] + inside, begin[one]]
        known, _ = _settle([np.r_[np.zeros(len(own), bool), np.ones(len(one), bool)], second, name], doc[every], name)
        docs_, places = ranges_of(doc[every][known], at[known], sub[every][known])
        return _table({"doc_id": np.r_[docs_, doc[done]], "place": np.r_[places, place[done]]}, COVER)

    def finish(key, left: pa.Table, right: pa.Table) -> pa.Table:
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        whole: set[tuple[int, bytes]] = set()
        places = right["place"]
        b, e, s = (x.tolist() for x in unplace(np.asarray(pa.compute.fill_null(places, 0)).astype(np.int64)))
        for d, digest, given, sub, begin, end in zip(right["doc_id"].to_pylist(), right["digest"].to_pylist(), pa.compute.is_valid(places).to_pylist(), s, b, e, strict=True):
            if given:
                spans.setdefault((d, sub), []).append((begin, end))
            else:
                whole.add((d, digest))
        order = {(d, t): s for d, s, t in _rows(left)}
        out, texts_, ids = [], [], {d for d, _ in whole}
        for d, text in zip(left["doc_id"].to_pylist(), left["text"].to_pylist(), strict=True):
            raw = text.encode()
            kept, n_spans, left_ = raw, 0, text
            if _copied(d, raw, whole, ids):
                kept, n_spans, left_ = b"", 1, ""
            elif d is not None and (found := spans.get((d, order[(d, raw)]))):
                begin, end = removed_spans(*np.array(found, np.int64).T)
                edges = [0, *np.column_stack([begin, end]).ravel().tolist(), len(raw)]
                parts = [raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                kept, n_spans = b"".join(parts), len(begin)
                left_ = "".join(p.decode("utf-8", "ignore") for p in parts) if carry else ""
            out.append((d, len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest()))
            texts_.append(left_)
        table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), RESULT, strict=True)], schema=RESULT) if out else RESULT.empty_table()
        if not carry:
            return table
        given = left["given"].to_pylist()
        return table.append_column("kept", pa.array([t if g else None for t, g in zip(texts_, given, strict=True)], pa.string())).append_column("row", left["row"])

    by_block = dealt.groupBy("block")
    offers = by_block.cogroup(copies.select("block", "doc_id", "digest").groupBy("block")).applyInArrow(offer, "part long, block long, tokens binary")
    flags = offers.groupBy("part").applyInArrow(count, "block long, part long, flags binary")
    none = lambda t: F.lit(None).cast(t)
    side = flags.select("block", none("long").alias("doc_id"), none("binary").alias("digest"), "flags", "part").unionByName(copies.select("block", "doc_id", "digest", none("binary").alias("flags"), none("long").alias("part")))
    runs = by_block.cogroup(side.groupBy("block")).applyInArrow(rank, RUN_DDL)
    # the three uses of the ranks read the same columns, so that Spark builds and keeps their exchange once
    ranked = runs.filter("bucket is not null").withColumn("first", F.min("doc_id").over(Window.partitionBy("bucket", "rank")))
    covered = ranked.filter("known or doc_id > first").select("doc_id", "place")
    leaders = ranked.filter("not known and doc_id = first and place >= 0")
    ranks = leaders.groupBy("bucket").agg(F.min("rank").alias("a"), F.max("rank").alias("b"), F.count("*").alias("n"), F.max("place").alias("p"))
    mixed = ranks.filter("a != b and p >= 0").select("bucket", (F.col("n") > SMALL).alias("large"))
    wanted = leaders.join(mixed, "bucket").select(block, "doc_id", "place", "bucket", "large")
    tied = by_block.cogroup(wanted.groupBy("block")).applyInArrow(ties, TIE_DDL)
    shared = tied.groupBy("part").applyInArrow(resolve, "doc_id long, place long")
    found = covered.unionByName(shared).withColumn("digest", none("binary")).unionByName(copies.select("doc_id", none("long").alias("place"), "digest")).withColumn("block", block)
    schema = StructType.fromDDL(RESULT_DDL)
    if carry:
        schema = schema.add("kept", "string").add("row", docs.schema["row"].dataType)
    return by_block.cogroup(found.groupBy("block")).applyInArrow(finish, schema)
