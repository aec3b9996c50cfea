"""Quality by a linear-chain conditional random field over a document's lines.

Every line has features of its own (shares of character classes, length, repetition) and those of its two neighbours,
each cut into quantile bins. The field has one weight per bin, a bias and two transition weights; it is trained here
by its exact gradient (forward-backward). A document's score is the mean of its lines' marginals of being good, each
weighted by the line's length, on the logit scale shifted so that the training documents part best at one half.

Training reads at most ``TRAIN_DOCS`` labelled documents, chosen by the hash of their id among the rows given as
training rows, one text per id, ``TRAIN_LINES`` neighbouring lines of each and ``TRAIN_TOTAL`` lines in all, so the sample
is the same at every run and its size does not grow with the corpus. Scoring covers all rows and whole texts.

Cases: null and empty texts are one empty line; without any training rows of both labels every score is 0.5; repeated
rows each get a row; a text of any length, in one line or many, takes about 350 bytes a line beside four copies of it; an empty table gives an empty result; labels other than 0 and 1 and null labels are not used.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import claim, map_batches, materialize, texts

TRAIN_DOCS = 4000  # bound of the training sample, in documents
TRAIN_LINES = 400  # of a training document's lines, so many contiguous ones at most are learned from, wherever its id says
TRAIN_TOTAL = 400_000  # bound of the training sample, in lines; longer documents' runs are cut until it holds
SLICE = 1 << 20  # bytes of text at a time in a task; a longer text is a slice of its own
CHUNK = 1 << 19  # bytes whose features are made at a time, by arrays of a hundred times as much
RUN = 1 << 15  # lines whose weights are summed at a time
BINS, STEPS, RATE, DECAY = 8, 150, 0.1, 1e-3
#: Character classes by byte: upper, lower, digit, space, stop, "!" and "?", other marks, beyond ASCII, "|".
CLASSES = 9
N_FEATURES = CLASSES + 6


def _classes() -> np.ndarray:
    out = np.full(256, 6, np.int64)
    for group, members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\n", b".,;:'", b"!?")):
        out[list(members)] = group
    out[128:] = 7
    out[ord("|")] = 8
    return out


LOOKUP = _classes()


def line_features(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of a batch, the lines' lengths in bytes, and the number of lines of each text.

    Every feature is made of sums over a line's bytes, so the bytes are read ``CHUNK`` at a time whatever the texts', lines'
    and words' lengths; the last word of a chunk stays open until the next one.
    """
    data = np.frombuffer(b"\n".join(rows) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1]
    sizes = ends - starts
    counts = np.array([r.count(b"\n") + 1 for r in rows], np.int64)
    n = len(ends)
    shares, changes, code = np.zeros((n, CLASSES), np.int32), np.zeros(n, np.int32), np.zeros(n, np.uint64)
    words, same, capital = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
    before = 3  # class of the byte before the chunk
    done, open_, open_at = (np.uint64(0), -1), (np.uint64(0), -1), 0  # sum and line of the last whole and of the open word
    for lo in range(0, len(data), CHUNK):
        d = data[lo : lo + CHUNK]
        at = np.arange(lo, lo + len(d))
        klass = LOOKUP[d]
        stop = d == 10
        base = int(np.searchsorted(ends, lo))
        line = np.r_[0, np.cumsum(stop)[:-1]]
        here = slice(base, base + int(line[-1]) + 1)
        span = here.stop - base
        shares[here] += np.bincount(line * CLASSES + klass, minlength=span * CLASSES).reshape(-1, CLASSES).astype(np.int32)
        previous = np.r_[before, klass[:-1]]
        place = at - starts[base + line]
        changes[here] += np.bincount(line[(klass != previous) & (place > 0)], minlength=span).astype(np.int32)
        letters = d.astype(np.uint64) + np.uint64(1)
        heads = np.flatnonzero(np.r_[True, stop[:-1]])
        code[here] += np.add.reduceat(letters * (place.astype(np.uint64) + np.uint64(7)) ** np.uint64(3), heads)
        # words: how often the same one comes twice in a row, and how often one begins with a capital
        first = (klass != 3) & (previous == 3)
        begin = np.flatnonzero(first)
        offset = (at - np.r_[open_at, lo + begin][np.cumsum(first)]).astype(np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum(np.where(klass == 3, np.uint64(0), letters) * (offset + np.uint64(3)) ** np.uint64(5), dtype=np.uint64)]
        edges = np.r_[0, begin, len(d)]
        total = sums[edges[1:]] - sums[edges[:-1]]
        total[:1] += open_[0]
        total, owner = np.r_[done[0], total], np.r_[done[1], open_[1], base + line[begin]]
        again = owner[1:-1][(total[1:-1] == total[:-2]) & (owner[1:-1] == owner[:-2]) & (owner[1:-1] >= 0)]
        np.add.at(same, again, 1)
        words[here] += np.bincount(line[begin], minlength=span).astype(np.int32)
        capital[here] += np.bincount(line[begin], klass[begin] == 0, span).astype(np.int32)
        done, open_ = (total[-2], int(owner[-2])), (total[-1], int(owner[-1]))
        open_at, before = (lo + int(begin[-1]) if begin.size else open_at), int(klass[-1])
    if done == open_ and open_[1] >= 0:
        same[open_[1]] += 1
    shares[:, 3] -= 1  # the line's own end
    # a line counts as repeated if its bytes' sums under two weightings occur again in the same text
    owner = np.repeat(np.arange(len(rows)), counts).astype(np.uint64)
    _, inverse, times = np.unique(code * np.uint64(0x9E3779B97F4A7C15) + owner * np.uint64(0xD6E8FEB86659FD93), return_inverse=True, return_counts=True)
    long, several = np.maximum(sizes, 1), np.maximum(words, 1)
    out = np.empty((n, N_FEATURES), np.float32)
    for j in range(CLASSES):
        out[:, j] = shares[:, j] / long
    for j, column in enumerate((np.log1p(sizes), sizes / (shares[:, 3] + 1), changes / long, np.minimum(times[inverse], 9), same / several, capital / several)):
        out[:, CLASSES + j] = column
    return out, sizes, counts


@dataclass
class Field:
    """A trained field: bin edges per feature, a weight per bin of a line and its neighbours, transitions, the shift."""

    edges: np.ndarray
    weights: np.ndarray
    bias: float
    stay: np.ndarray
    shift: float


def _bins(edges: np.ndarray, features: np.ndarray) -> np.ndarray:
    out = np.empty(features.shape, np.uint8)
    for j in range(features.shape[1]):
        out[:, j] = np.searchsorted(edges[j], features[:, j].astype(np.float64), side="right")
    return out


def _cells(bins: np.ndarray, counts: np.ndarray, lines: slice = slice(None)) -> np.ndarray:
    """Indices of some lines' weights: a line's own bins, the line's before and the line's behind (or "none")."""
    n, width = bins.shape
    at = np.arange(*lines.indices(n))
    stop = np.cumsum(counts)
    text = np.searchsorted(stop, at, side="right")
    before, behind = bins[np.maximum(at - 1, 0)], bins[np.minimum(at + 1, n - 1)]
    before[at == (stop - counts)[text]], behind[at == stop[text] - 1] = BINS, BINS
    bins = bins[at]
    return np.concatenate([b + (BINS + 1) * (np.arange(width) + width * k) for k, b in enumerate((bins, before, behind))], axis=1)


def marginals(unary: np.ndarray, stay: np.ndarray, counts: np.ndarray, joint: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Each line's probability of being good, and of each (label, next label), by forward-backward over all texts in step.

    ``unary`` is the log-odds of good. Texts are sorted by their number of lines, so the texts still running are a prefix.
    Pairs are left at zero rows without ``joint``.
    """
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order]
    starts = (np.cumsum(counts) - counts)[order]
    longest = int(sizes.max(initial=0))
    alive = np.searchsorted(-sizes, -np.arange(longest), side="left")
    emit = np.exp(np.column_stack([-np.maximum(unary, 0), -np.maximum(-unary, 0)]))  # scaled so that the larger is 1
    move = np.exp(stay - stay.max())
    alpha, beta = np.empty((len(unary), 2)), np.ones((len(unary), 2))
    for t in range(longest):
        at = starts[: alive[t]] + t
        a = emit[at] * (alpha[at - 1] @ move if t else 1.0)
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    pairs = np.zeros((len(unary) if joint else 0, 2, 2))
    for t in range(longest - 2, -1, -1):
        at = starts[: alive[t + 1]] + t
        ahead = emit[at + 1] * beta[at + 1]
        b = ahead @ move.T
        if joint:
            pair = alpha[at][:, :, None] * move[None] * ahead[:, None, :]
            pairs[at] = pair / pair.sum(axis=(1, 2), keepdims=True)
        beta[at] = b / b.sum(axis=1, keepdims=True)
    both = alpha * beta
    return both[:, 1] / both.sum(axis=1), pairs


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def document_scores(field: Field, features: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    bins = _bins(field.edges, features)
    unary = np.concatenate([field.weights[_cells(bins, counts, slice(a, a + RUN))].sum(axis=1) for a in range(0, len(bins), RUN)]) + field.bias
    good, _ = marginals(unary, field.stay, counts, joint=False)
    starts = np.cumsum(counts) - counts
    weight = sizes + 1.0
    mean = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
    return 1 / (1 + np.exp(-(_logit(mean) - field.shift)))


def fit(features: np.ndarray, sizes: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Field:
    """Maximum likelihood with weight decay, every line of a text carrying the text's label; steps by Adam."""
    edges = np.full((features.shape[1], BINS - 1), 1e-9)  # nothing has a bin of its own; what is there is cut by quantiles
    for j, column in enumerate(features.T):
        if (some := column[column > 1e-9]).size:
            edges[j, 1:] = np.quantile(some, np.linspace(0, 1, BINS)[1:-1])
    cells = _cells(_bins(edges, features), counts)
    line_label = np.repeat(labels, counts).astype(np.float64)
    weight = np.repeat(1.0 / (counts * np.bincount(labels, minlength=2)[labels]), counts)  # texts and labels count alike
    starts = np.cumsum(counts) - counts
    inner = np.ones(len(features), bool)
    inner[starts + counts - 1] = False
    total = (BINS + 1) * features.shape[1] * 3
    theta, first, second = np.zeros(total + 3), np.zeros(total + 3), np.zeros(total + 3)
    for step in range(1, STEPS + 1):
        stay = np.array([[theta[-2], 0.0], [0.0, theta[-1]]])
        good, pairs = marginals(theta[:total][cells].sum(axis=1) + theta[total], stay, counts)
        error = (line_label - good) * weight
        grad = np.empty_like(theta)
        grad[:total] = np.bincount(cells.ravel(), np.repeat(error, cells.shape[1]), minlength=total)
        grad[total] = error.sum()
        grad[-2] = ((1 - line_label - pairs[:, 0, 0]) * weight)[inner].sum()
        grad[-1] = ((line_label - pairs[:, 1, 1]) * weight)[inner].sum()
        grad -= DECAY * theta
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    field = Field(edges, theta[:total], float(theta[total]), np.array([[theta[-2], 0.0], [0.0, theta[-1]]]), 0.0)
    odds = _logit(document_scores(field, features, sizes, counts))
    ranked = np.argsort(odds, kind="stable")
    label = labels[ranked]
    wrong = np.r_[0, np.cumsum(label)] + (label == 0).sum() - np.r_[0, np.cumsum(1 - label)]  # errors if the first i are called bad
    best = np.flatnonzero(wrong == wrong.min())
    cut = int(best[len(best) // 2])
    known = np.r_[odds[ranked][0] - 1, odds[ranked], odds[ranked][-1] + 1]
    field.shift = float((known[cut] + known[cut + 1]) / 2)
    return field


def held_out(id_column: Column) -> Column:
    """The contract's fold: rows never learned from."""
    return (F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 3) == 1


def train(docs: DataFrame, labels: DataFrame) -> Field | None:
    """A field from ``labels`` (``doc_id, quality``) outside the held-out fold; None without rows of both labels."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = materialize(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS), "crf-labels")  # bounded by TRAIN_DOCS rows
    found = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))  # an id once

    def lines(batch: pa.RecordBatch) -> pa.RecordBatch:
        features, sizes, counts = line_features([t.encode() for t in batch.column(1).to_pylist()])
        stops = np.cumsum(counts)
        keep = []
        for d, b, n in zip(batch.column(0).to_pylist(), stops.tolist(), counts.tolist(), strict=True):
            first = b - n + zlib.crc32(str(d).encode()) % max(1, n - TRAIN_LINES + 1)
            keep.append(slice(first, first + min(n, TRAIN_LINES)))
        return pa.record_batch([batch.column(0), batch.column(2).cast(pa.int32()), pa.array([features[k].tobytes() for k in keep], pa.binary()), pa.array([sizes[k].tobytes() for k in keep], pa.binary())], ["doc_id", "quality", "features", "sizes"])

    rows = map_batches(found, lines, "doc_id long, quality int, features binary, sizes binary", limit=SLICE).collect()  # bounded: TRAIN_DOCS documents of TRAIN_LINES lines
    rows.sort(key=lambda r: (r["doc_id"], r["features"]))
    label = np.array([r["quality"] for r in rows], np.int64)
    if len(np.unique(label)) < 2:
        return None
    sizes = [np.frombuffer(r["sizes"], np.int64) for r in rows]
    longest = TRAIN_LINES
    while sum(min(len(s), longest) for s in sizes) > TRAIN_TOTAL:
        longest -= 1
    sizes = [s[:longest] for s in sizes]
    features = np.concatenate([np.frombuffer(r["features"], np.float32).reshape(-1, N_FEATURES)[:longest] for r in rows]).astype(np.float64)
    return fit(features, np.concatenate(sizes), np.array([len(s) for s in sizes]), label)


def scores_of(rows: list[str | None], field: Field | None) -> np.ndarray:
    """Scores of whole texts, inside a task."""
    claim("line_crf", lambda: None)
    if field is None or not rows:
        return np.full(len(rows), 0.5)
    features, sizes, counts = line_features([(t or "").encode() for t in rows])
    return document_scores(field, features, sizes, counts)


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id, score`` per row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), pa.array(scores_of(batch.column(1).to_pylist(), field), pa.float64())], ["doc_id", "score"])

    return map_batches(docs, run, "doc_id long, score double", limit=SLICE)


def good_rows(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, whose text the field trained on ``labels`` calls good.

    Every row is judged by its own text where it is read: no join, and no exchange at any size.
    """
    field = train(texts(df, id_col, text_col), labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")))
    named = lambda c: F.col("`" + c.replace("`", "``") + "`")
    packed = df.select(F.struct(*[named(c) for c in df.columns if c != text_col]).alias("row"), named(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(scores_of(batch.column(1).to_pylist(), field) >= 0.5, pa.bool_()))

    kept = map_batches(packed, run, packed.schema, limit=SLICE)
    return kept.select(*[(F.col("text") if c == text_col else F.col("row").getField(c)).alias(c) for c in df.columns])


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``df``."""
    docs = texts(df, id_col, text_col)
    found = score(docs, train(docs, labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
