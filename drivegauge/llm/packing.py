"""Packing tokenized documents into sequences of a fixed capacity by exact complements, then best fit.

Only the histogram of piece lengths (at most ``capacity`` rows, whatever the corpus) reaches the driver. The planner
takes the longest length left, looks in an index of single, pair and triple length sums for a combination that fills
the gap exactly under the counts still available, and where there is none puts in the longest piece that fits and
looks again. Each pattern so found is used as often as the counts allow, so the plan has a few thousand rows. Pieces
learn their place by their rank among the pieces of equal length: ranks are row numbers within (length, bucket) plus
the counts of the buckets before, so no task sees all pieces of a length.

Cases: null and empty texts are one piece that holds the end id alone; repeated rows are packed each by itself; an
empty table gives an empty result; other columns are ignored. A text longer than the capacity is cut into full pieces,
the last one may be shorter.
"""

from __future__ import annotations

import itertools
import json
import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import claim, map_batches, materialize, texts
from .chunks import SEPARATORS, Memo

_STATE: dict = {}
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordTokenizer:
    """Ids as the ``tokenizers`` library gives them for a lower-casing BPE vocabulary with word ends that drops white space.

    The library's own cost per distinct word is most of the time of a packing job, so words go through the same merges as
    ``tiktoken`` ranks instead: a word end is a space behind the word, which no word holds, and a token's id is its rank.
    That gives the library's ids wherever merges are listed by id, which ``_ranks`` checks. Normalization and splitting are
    Python's and ``regex``'s; a text with a character that the library treats in another way, in white space or special
    strings, or that is not in composed form, is the library's in whole or in part.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        ranks = self._ranks(config)
        self.coder = None
        if ranks:
            import regex
            import tiktoken

            self.pattern = regex.compile(config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
            self.coder = tiktoken.Encoding("words", pat_str=r"[^ \n]+ ", mergeable_ranks=ranks, special_tokens={})
            self.ends = np.zeros(max(ranks.values()) + 1, bool)
            self.ends[[i for b, i in ranks.items() if b.endswith(b" ")]] = True
        self.known: set[str] = set()
        self.odd: set[str] = set(SEPARATORS) | {"Σ"}  # lower() looks at the neighbours of the last
        self.memo = Memo(self._words)
        if self.coder:
            self._look_at(set(map(chr, range(256))))
        self.narrow = sorted(c for c in self.odd if ord(c) < 256)

    @staticmethod
    def _ranks(config: dict) -> dict[bytes, int]:
        """The vocabulary as ranks, or none if the file's parts are not those that this class knows."""
        model, normalizers = config["model"], (config["normalizer"] or {}).get("normalizers", [])
        splits = (config["pre_tokenizer"] or {}).get("pretokenizers", [])
        end, vocab, merges = model.get("end_of_word_suffix"), model["vocab"], model["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        first = len(vocab) - len(pairs)
        known = (
            [n["type"] for n in normalizers] == ["NFC", "Replace", "Lowercase"] and normalizers[1]["pattern"] == {"Regex": r"\s+"}
            and [s["type"] for s in splits] == ["Split", "ByteLevel"] and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and not splits[1]["use_regex"] and not splits[1]["add_prefix_space"]
            and config["post_processor"] is None and end and not model["dropout"] and not model["ignore_merges"] and not model["continuing_subword_prefix"]
        )
        shift = first - len([t for t in config["added_tokens"] if t["content"] in vocab])
        if not known or any(vocab.get(a + b) != shift + k for k, (a, b) in enumerate(pairs)):
            return {}
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet: these stand for themselves
        byte = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in visible)}
        special = {t["content"] for t in config["added_tokens"]}
        return {bytes(map(byte.__getitem__, s.removesuffix(end))) + b" " * s.endswith(end): i for s, i in vocab.items() if s not in special}

    def _library(self, rows: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of normalized words without white space: each match of the pattern is a piece that ends with a space."""
        text = "\n".join([w if w.isalpha() else self.pattern.sub(r"\g<0> ", w)[:-1] for w in words])
        ids = np.array(self.coder.encode_ordinary(text.replace("\n", " \n") + " "), "<u4")
        pieces = np.cumsum([0, *(line.count(" ") + 1 for line in text.split("\n"))])
        stops = np.r_[0, np.flatnonzero(self.ends[ids]) + 1][pieces].tolist()
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in itertools.pairwise(stops)]

    def _look_at(self, chars: set[str]) -> None:
        """Finds the characters that the library lowers or splits in another way than ``lower`` and the pattern do."""
        for c in chars:
            try:
                low = self.tokenizer.normalizer.normalize_str(c)
                probe = f"a{low}a1{low}1!{low}!{low}{low}"
                pieces = [at for _, at in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
                fine = low == (" " if c.isspace() else c.lower()) and (c.isspace() or pieces == [m.span() for m in self.pattern.finditer(probe)])
            except UnicodeEncodeError:
                fine = False
            if not fine:
                self.odd.add(c)
        self.known |= chars

    def _normal(self, text: str) -> str | None:
        """The text in lower case and composed form, or none where the library has to take it whole."""
        try:
            text.encode("latin-1")
            return None if self.narrow and any(c in text for c in self.narrow) else text.lower()
        except UnicodeEncodeError:
            pass
        if not unicodedata.is_normalized("NFC", text):
            text = self.tokenizer.normalizer.normalize_str(text)
        chars = set(text)
        if new := chars - self.known:
            self._look_at(new)
        return text.lower() if self.odd.isdisjoint(chars) else None

    def encode(self, rows: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        normal = [None if self.coder is None or "<|" in t or any(s in t for s in self.special) else self._normal(t) for t in rows]
        whole = iter(self._library([t for t, n in zip(rows, normal, strict=True) if n is None]))
        split = [n.split() if n else [] for n in normal]
        ids = self.memo.values_of(list(itertools.chain.from_iterable(split)))
        stops = np.cumsum([0, *map(len, split)]).tolist()
        return [next(whole) if n is None else b"".join(ids[a:b]) for n, (a, b) in zip(normal, itertools.pairwise(stops), strict=True)]


def token_pieces(df: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and ``ids`` (little-endian bytes) where ``keep_ids``."""
    width = 4 * capacity

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        claim("packing", _STATE.clear)
        coder = _STATE.get(tokenizer_path) or _STATE.setdefault(tokenizer_path, WordTokenizer(tokenizer_path))
        end = end_id.to_bytes(4, "little")
        out: list[tuple] = []
        for doc, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist()), strict=True):
            ids += end
            for k in range(0, len(ids), width):
                part = ids[k : k + width]
                out.append((doc, k // width, k // 4, len(part) // 4, zlib.crc32(part), *([part] if keep_ids else [])))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=False)], names)

    return map_batches(texts(df, id_col, text_col), run, PIECES + ", ids binary" * keep_ids, limit=2 << 20)


class LengthIndex:
    """Counts by length, with bit sets as index of which sums of one, two or three lengths are available."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.counts = capacity, {k: v for k, v in counts.items() if v > 0}
        self.bits = sum(1 << k for k in self.counts)
        self.mirror = sum(1 << (capacity - k) for k in self.counts)

    def take(self, lengths: dict[int, int], times: int) -> None:
        for k, n in lengths.items():
            self.counts[k] -= n * times
            if not self.counts[k]:
                del self.counts[k]
                self.bits ^= 1 << k
                self.mirror ^= 1 << (self.capacity - k)

    def _fits(self, chosen: tuple[int, ...], used: dict[int, int]) -> bool:
        return all(used.get(k, 0) + chosen.count(k) <= self.counts.get(k, 0) for k in chosen)

    def _pair(self, total: int, used: dict[int, int], also: tuple[int, ...] = ()) -> tuple[int, ...]:
        sums = (self.bits & (self.mirror >> (self.capacity - total))) >> (total + 1) // 2 << (total + 1) // 2
        while sums:
            b = sums.bit_length() - 1
            if b < total and self._fits(found := (b, total - b, *also), used):
                return found
            sums ^= 1 << b
        return ()

    def exact(self, gap: int, used: dict[int, int]) -> tuple[int, ...]:
        """One, two or three available lengths of sum ``gap``, or none. A triple's largest is at least a third of it."""
        if self._fits((gap,), used):
            return (gap,)
        if found := self._pair(gap, used):
            return found
        firsts = self.bits & ((1 << gap) - 1)
        while (a := firsts.bit_length() - 1) > 0 and 3 * a >= gap:
            if (found := self._pair(gap - a, used, (a,))):
                return found
            firsts ^= 1 << a
        return ()

    def longest(self, gap: int, used: dict[int, int]) -> int:
        below = self.bits & ((1 << (gap + 1)) - 1)
        while below:
            k = below.bit_length() - 1
            if self._fits((k,), used):
                return k
            below ^= 1 << k
        return 0


def plan_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns of lengths and how often each is used; together they use up the histogram."""
    index, patterns = LengthIndex(histogram, capacity), []
    while index.bits:
        top = index.bits.bit_length() - 1
        items, used, gap = [top], {top: 1}, capacity - top
        while gap:
            found = index.exact(gap, used) if gap <= 3 * top else ()
            found = found or ((k,) if (k := index.longest(gap, used)) else ())
            if not found:
                break
            for k in found:
                items.append(k)
                used[k] = used.get(k, 0) + 1
                gap -= k
        times = min(index.counts[k] // n for k, n in used.items())
        index.take(used, times)
        patterns.append((items, times))
    return patterns


def slots(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, last rank + 1, sequence of the first, offset)`` of each place in each pattern."""
    out, ranks, sequence = [], {}, 0
    for items, times in patterns:
        offset = 0
        for k in items:
            first = ranks.get(k, 0)
            out.append((k, first, first + times, sequence, offset))
            ranks[k] = first + times
            offset += k
        sequence += times
    return out


def place(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a stored table of pieces."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    buckets = sum(histogram.values()) // 2000 + 1
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("n")).select("length", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(within)).join(starts, ["length", "_bucket"]).withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
    rows = slots(plan_patterns(histogram, capacity))
    places = spark.createDataFrame(rows, "length long, _from long, _to long, _sequence long, offset long")
    # a bounded table: patterns are bounded by the number of distinct lengths, not by the corpus
    joined = ranked.join(F.broadcast(places), (ranked["length"] == places["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))).drop(places["length"])
    return joined.select(*pieces.columns, (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset")


def pack(df: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """All texts' pieces with their sequence and offset."""
    return place(materialize(token_pieces(df, tokenizer_path, capacity, end_id, id_col, text_col, keep_ids), "pieces"), capacity)
