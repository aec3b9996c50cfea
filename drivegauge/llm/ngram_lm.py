"""A word model with backoff: learnt from the training rows, run as a weighted automaton over the texts of all rows.

**Model.** Word pairs with absolute discounting, interpolated with discounted single words, these with a uniform share
for each known word and one unknown word; so the probabilities after any word sum to one over the V known words and the
unknown one. The discounts are n1 / (n1 + 2 n2), from how many pairs (words) occur once and twice in training. The end
of a text is a word; its begin is a context only.

**Automaton.** The empty state has an arc for each word. A word that something follows in training is a state: an arc
for each word seen behind it, and a failure arc to the empty state with the backoff weight. A text runs from the begin
state from left to right; where a state lacks the arc, the failure arc's weight is added and the word taken from the
empty state. Many texts run in step. Texts over ``PIECE`` bytes are cut between words; a piece starts in the state that
the word before it leads to, so cuts change nothing.

**Spark.** The automaton of the corpus fits no task, but the part that some texts can reach does:

1. Texts are stored as blocks of word numbers (``blocks``), each with the hashes of its own words.
2. Each block sends its distinct words and pairs with their training counts to buckets, which are ranges of (hash of the
   first word, hash of the second). A first word of many tokens is cut into several buckets.
3. A bucket sums the counts over all blocks and answers each block in the order of its request, so that an answer holds
   no names: count, and per first word the number of tokens and of kinds behind it.
4. The answers meet the blocks again, which build their automata and run.

Only the list of words with more than a share 1 / (2 K) of the tokens (at most 2 K for K buckets; 16 bytes each), six
sums, and no counts reach the driver. A bucket holds about ``BUCKET`` tokens' pairs, whatever the size of the corpus. The
lists of one block and bucket get short as buckets get many: a hundred pairs at some terabyte of text, where larger
blocks and buckets (more memory) or an exchange in two levels would be due.

Words and pairs are told apart by 64-bit hashes. Cases: a null or empty text has one token, its end; rows without id are
training rows; repeated rows each count and each get a row; without training rows all words are unknown and have
probability one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import materialize
from .shingles import LOWER
from .words import Words

#: Bytes of text in a block and in a piece of a text, tokens in a bucket, words that a lane of the automaton reads.
BLOCK, PIECE, BUCKET, LANE = 16 << 20, 8 << 20, 3_000_000, 2048
#: Hashes of begin and end, which are no words.
MARKS = np.array([0x9D3F5A1C77E2B481, 0x3C6EF372FE94F82A], np.uint64)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

BLOCKS = "block long, row_keys array<long>, doc_ids array<long>, held array<boolean>, sizes array<int>, n_tokens long, n_words int, words binary, tokens binary"
REQUESTS = "bucket int, block long, first int, words binary, counts binary, children binary, pairs binary, pair_counts binary"
STATS = ("n_tokens", "n_words", "words1", "words2", "pairs1", "pairs2")
ANSWERS = "bucket int, block long, first int, counts binary, totals binary, kinds binary, pair_counts binary, " + ", ".join(f"{s} long" for s in STATS)
SCORES = "row_key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def pack(values: np.ndarray, kind: str = "<u4") -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, kind).tobytes())


def unpack(raw: bytes, kind: str = "<u4") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind).astype(np.int64)


def pieces(text: str, limit: int) -> Iterator[tuple[bytes, bool, bool]]:
    """Parts of a lower-cased text with whether they are its first and its last; later ones begin with the word before."""
    raw, at, before = text.encode("utf-8", "surrogatepass").translate(LOWER), 0, b""
    while len(raw) - at > limit and (cut := _SPACE.search(raw, at + limit)):
        part = raw[at : cut.start()]
        at = cut.start()
        if own := part.rsplit(None, 1):
            yield before + part, not before, False
            before = own[-1]
    yield before + raw[at:], not before, True


def _block(number: int, parts: list[tuple]) -> pa.RecordBatch:
    """A block's row of ``BLOCKS`` from its pieces: (row key, doc id, held out, text, is first, is last)."""
    words = Words([p[3] for p in parts])
    hashes, edges = words.hashes(), words.edges.tolist()
    runs, sizes = [], []
    for (*_, first, last), a, b in zip(parts, edges[:-1], edges[1:], strict=True):
        runs += [MARKS[: int(first)], hashes[a:b], MARKS[1 : 1 + int(last)]]
        sizes.append(b - a + first + last)
    names, tokens = np.unique(np.concatenate(runs), return_inverse=True)
    row = [number, [p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts], sizes, len(tokens), len(names), names.astype("<u8").tobytes(), pack(tokens)]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in BLOCKS.split(", ")])


def blocks(docs: DataFrame, held: Column, block: int = BLOCK, piece: int = PIECE) -> DataFrame:
    """All texts as blocks of word numbers, in the order in which the rows come; no row is moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n_rows, n_blocks = TaskContext.get().partitionId(), 0, 0
        parts, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text, out = (batch.column(k)[i].as_py() for k in range(3))
                for raw, first, last in pieces(text, piece):
                    parts.append(((task << 40) + n_rows, doc, out, raw, first, last))
                    size += len(raw) + 16
                    if size >= block:
                        yield _block((task << 32) + n_blocks, parts)
                        parts, size, n_blocks = [], 0, n_blocks + 1
                n_rows += 1
        if parts:
            yield _block((task << 32) + n_blocks, parts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(held, F.lit(False)).alias("held"))
    return rows.mapInArrow(run, BLOCKS)


def _each(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` on each row, as a dictionary, giving record batches."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from fn({c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)})

    return df.mapInArrow(run, schema)


def common_words(stored: DataFrame, n_buckets: int, total: int) -> list[tuple[int, int]]:
    """Hash and number of tokens of the words that hold more than 1 / (2 K) of all tokens.

    A block passes its own words of more than 1 / (4 K); what all blocks hold below that is no more than 1 / (4 K).
    """

    def often(row):
        counts = np.bincount(unpack(row["tokens"]), minlength=row["n_words"])
        top = np.flatnonzero(counts * (4 * n_buckets) > row["n_tokens"])
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["words"], "<u8")[top].view(np.int64)), pa.array(counts[top], pa.int64())], names=["word", "n"])

    found = _each(stored.select("n_tokens", "n_words", "words", "tokens"), often, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") * (4 * n_buckets) > total)
    return [(r["word"] % (1 << 64), r["n"]) for r in found.collect()]


def split_points(n_buckets: int, common: list[tuple[int, int]], total: int) -> tuple[np.ndarray, np.ndarray]:
    """Where buckets begin, as hashes of a first and a second word, in order; a common first word has buckets of its own."""
    points = {((i << 64) // n_buckets, 0) for i in range(n_buckets)}
    for word, n in common:
        shares = n * n_buckets // total + 1
        points |= {(word, (j << 64) // shares) for j in range(shares)}
        if word + 1 < 1 << 64:
            points.add((word + 1, 0))
    ordered = sorted(points)
    return np.array([p[0] for p in ordered], np.uint64), np.array([p[1] for p in ordered], np.uint64)


def _pairs(tokens: np.ndarray, sizes: list[int], n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each place whether it is the first of its piece, and the pair that ends there (at first places: nothing)."""
    first = np.zeros(len(tokens), bool)
    first[np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)] = True
    keys = np.empty(len(tokens), np.int64)
    keys[1:] = tokens[:-1] * n_words + tokens[1:]
    return first, keys


def requests(stored: DataFrame, first_of: np.ndarray, second_of: np.ndarray) -> DataFrame:
    """Each block's distinct words and pairs with their training counts, cut into buckets."""

    def ask(row):
        tokens, names, n_words, sizes = unpack(row["tokens"]), np.frombuffer(row["words"], "<u8"), row["n_words"], row["sizes"]
        first, keys = _pairs(tokens, sizes, n_words)
        learns = np.repeat(~np.array(row["held"], bool), sizes) & ~first
        counts = np.bincount(tokens[learns], minlength=n_words)
        pairs, place = np.unique(keys[~first], return_inverse=True)
        pair_counts = np.bincount(place, learns[~first], minlength=len(pairs)).astype(np.int64)
        left = np.searchsorted(names, first_of)
        held = np.append(names, np.uint64(0))[left] == first_of
        held &= left < n_words
        inner = held & (second_of > 0)
        at = np.append(np.searchsorted(pairs, left * n_words + np.where(inner, np.searchsorted(names, second_of), 0)), len(pairs))
        till = np.append((left + inner)[1:], n_words)
        asked = np.flatnonzero(till > left)
        out = [[] for _ in range(8)]
        for b in asked.tolist():
            lo, hi, a, z = int(left[b]), int(till[b]), int(at[b]), int(at[b + 1])
            own = counts[lo:hi].copy()
            if inner[b]:
                own[0] = 0  # the word is counted in its first bucket
            values = (b, row["block"], lo, names[lo:hi].tobytes(), pack(own), pack(np.bincount(pairs[a:z] // n_words - lo, minlength=hi - lo)), names[pairs[a:z] % n_words].tobytes(), pack(pair_counts[a:z]))
            for column, v in zip(out, values, strict=True):
                column.append(v)
        kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[c.split()[0] for c in REQUESTS.split(", ")])

    return _each(stored.select("block", "held", "sizes", "n_words", "words", "tokens"), ask, REQUESTS)


def answer(asked: pa.Table) -> pa.Table:
    """One bucket: sums over all blocks, given back to each in its order; the first row carries the bucket's own sums."""
    column = lambda name: [v.as_py() for v in asked.column(name)]
    words = [np.frombuffer(b, "<u8") for b in column("words")]
    seconds = [np.frombuffer(b, "<u8") for b in column("pairs")]
    names, word = np.unique(np.concatenate(words), return_inverse=True)
    counts = np.bincount(word, np.concatenate([unpack(b) for b in column("counts")]), minlength=len(names)).astype(np.int64)
    parent = np.repeat(word, np.concatenate([unpack(b) for b in column("children")]))
    # A pair is known by a hash of both words; it is looked for among the pairs of this bucket only.
    code = (names[parent] * np.uint64(0x9E3779B97F4A7C15) + (names[parent] >> np.uint64(29))) ^ np.concatenate(seconds)
    _, at, pair = np.unique(code, return_index=True, return_inverse=True)
    sums = np.bincount(pair, np.concatenate([unpack(b) for b in column("pair_counts")]), minlength=len(at)).astype(np.int64)
    totals = np.bincount(parent[at], sums, minlength=len(names)).astype(np.int64)
    kinds = np.bincount(parent[at], sums > 0, minlength=len(names)).astype(np.int64)
    cuts, pair_cuts = np.cumsum([0, *map(len, words)]), np.cumsum([0, *map(len, seconds)])
    spans = [(word[a:b], pair[c:d]) for a, b, c, d in zip(cuts[:-1], cuts[1:], pair_cuts[:-1], pair_cuts[1:], strict=True)]
    stats = [counts.sum(), (counts > 0).sum(), (counts == 1).sum(), (counts == 2).sum(), (sums == 1).sum(), (sums == 2).sum()]
    out = {"bucket": asked.column("bucket"), "block": asked.column("block"), "first": asked.column("first")}
    out |= {"counts": [pack(counts[w]) for w, _ in spans], "totals": [pack(totals[w]) for w, _ in spans], "kinds": [pack(kinds[w]) for w, _ in spans], "pair_counts": [pack(sums[p]) for _, p in spans]}
    out |= {name: pa.array([int(v)] + [0] * (len(spans) - 1), pa.int64()) for name, v in zip(STATS, stats, strict=True)}
    return pa.table({k: v if not isinstance(v, list) else pa.array(v, pa.binary()) for k, v in out.items()})


def discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


class Automaton:
    """States are 0 (empty) and a word's number plus one; ``keys`` are state words and arcs' words as one number, in order."""

    def __init__(self, counts: np.ndarray, totals: np.ndarray, kinds: np.ndarray, keys: np.ndarray, pair_counts: np.ndarray, stats: dict[str, int]):
        n_tokens, n_known = stats["n_tokens"], stats["n_words"]
        one, two = discount(stats["words1"], stats["words2"]), discount(stats["pairs1"], stats["pairs2"])
        spread = one * n_known / (n_known + 1)
        word = (np.maximum(counts - one, 0) + spread) / n_tokens if n_tokens else np.ones(len(counts))
        self.n_words, seen = len(counts), pair_counts > 0
        self.keys = keys[seen]
        before, after = self.keys // max(1, self.n_words), self.keys % max(1, self.n_words)
        back = np.divide(two * kinds, totals, out=np.ones(len(totals)), where=totals > 0)
        self.arc = np.log10((pair_counts[seen] - two) / totals[before] + back[before] * word[after])
        self.empty_arc, self.failure = np.log10(word), np.log10(back)
        self.state = np.where(totals > 0, np.arange(1, self.n_words + 1), 0)

    def run(self, tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log-probabilities of runs of ``sizes`` words from ``starts``, each begun in the state of the word before it."""
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        state, total = self.state[tokens[starts - 1]] if len(starts) else starts, np.zeros(len(starts))
        alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
        for step, n in enumerate(alive.tolist()):
            word = tokens[starts[:n] + step]
            key = (state[:n] - 1) * self.n_words + word
            at = np.searchsorted(self.keys, key)
            has = self._has(at, key, state[:n])
            total[:n][has] += self.arc[at[has]]
            falls = ~has & (state[:n] > 0)
            total[:n][falls] += self.failure[state[:n][falls] - 1]
            total[:n][~has] += self.empty_arc[word[~has]]
            state[:n] = self.state[word]
        out = np.empty(len(total))
        out[order] = total
        return out

    def _has(self, at: np.ndarray, key: np.ndarray, state: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(at), bool)
        return (self.keys[np.minimum(at, len(self.keys) - 1)] == key) & (state > 0)


def score_block(row: dict, answers: list[dict], stats: dict[str, int], lane: int = LANE) -> pa.Table:
    """Scores of a block's pieces, by the automaton that the answers make of its words and pairs."""
    tokens, n_words, sizes = unpack(row["tokens"]), row["n_words"], np.array(row["sizes"], np.int64)
    first, keys = _pairs(tokens, row["sizes"], n_words)
    pairs = np.unique(keys[~first])
    per_word = np.zeros((3, n_words), np.int64)
    answers = sorted(answers, key=lambda a: a["bucket"])
    for a in answers:
        for k, name in enumerate(("counts", "totals", "kinds")):
            values = unpack(a[name])
            per_word[k, a["first"] : a["first"] + len(values)] += values
    automaton = Automaton(*per_word, pairs, np.concatenate([unpack(a["pair_counts"]) for a in answers]), stats)
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(sizes)), -(-(sizes - 1) // lane))
    part = np.arange(len(piece)) - np.searchsorted(piece, piece)
    starts = ends[piece] - sizes[piece] + 1 + part * lane
    runs = automaton.run(tokens, starts, np.minimum(lane, ends[piece] - starts))
    at = np.repeat(np.arange(len(sizes)), sizes)[~first]
    counts = per_word[0][tokens[~first]]
    base = np.log10((counts + 1) / (stats["n_tokens"] + stats["n_words"] + 1))
    total = lambda where, weights: np.bincount(where, weights, minlength=len(sizes))
    return pa.table({"row_key": pa.array(row["row_keys"], pa.int64()), "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": pa.array(sizes - 1, pa.int64()), "n_known": pa.array(total(at, counts > 0).astype(np.int64)), "base_score": pa.array(total(at, base)), "score": pa.array(total(piece, runs))})


def held_out(remainder: int = 2, modulus: int = 7) -> Column:
    return F.crc32(F.col("doc_id").cast("long").cast("string")) % modulus == remainder


def score_texts(docs: DataFrame, held: Column | None = None, block: int = BLOCK, piece: int = PIECE, bucket: int = BUCKET) -> DataFrame:
    """Scores of all texts, from a model of the rows that are not ``held`` out (by default, those of ``held_out``)."""
    spark = docs.sparkSession
    stored = materialize(blocks(docs, held_out() if held is None else held, block, piece), "lm-blocks")
    total = stored.agg(F.sum("n_tokens")).first()[0] or 0
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // bucket + 1)
    points = split_points(n_buckets, common_words(stored, n_buckets, total), max(1, total))
    answers = materialize(requests(stored, *points).groupBy("bucket").applyInArrow(answer, ANSWERS), "lm-answers")
    stats = {k: v or 0 for k, v in answers.agg(*[F.sum(s).alias(s) for s in STATS]).first().asDict().items()}

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return score_block(left.to_pylist()[0], right.to_pylist(), stats)

    texts = stored.select("block", "row_keys", "doc_ids", "held", "sizes", "n_words", "tokens").groupBy("block")
    told = answers.select("bucket", "block", "first", "counts", "totals", "kinds", "pair_counts").groupBy("block")
    scored = texts.cogroup(told).applyInArrow(score, SCORES)
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    return scored.groupBy("row_key", "doc_id", "held_out").agg(*sums).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(stats["n_tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
