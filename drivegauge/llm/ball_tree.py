"""Ranked search: the documents of largest inner product with each item, through trees of balls.

A document's vector has w * x at each term, x = (1e9 tf) div (1000 tf + 12 m), an item's the number of times it holds the
term; their inner product is the score. Only terms of the items matter, so vectors hold those alone.

**Tree.** Documents are halved again and again, each by its distance to two that lie far apart. A node knows the centroid
of its documents and a radius around it that holds them all; no document below it scores more than
(item, centroid) + |item| radius. Nodes are taken best bound first, until the bound is below the k-th score so far; the
documents of a leaf are scored in integers. Bounds and radii are in doubles and widened by more than their rounding, so
pruning loses nothing; a bound equal to the k-th score isn't pruned, since a smaller id may decide.

The radius is the smaller the fewer terms a tree knows, so items are taken some at a time (``TERMS``) and each such set
has trees of its own over the documents that hold one of its terms. Items of very many terms have flatter trees.

**Spark.** One pass over the texts keeps, per document, its number of terms and the counts of the items' terms; these
are stored, and give N, L and the document frequencies. Each task then builds trees over ``CHUNK`` documents at a time
and keeps the best k per item from chunk to chunk; a window takes the best of all tasks. Items come in sets of about
``ITEM_BYTES`` of text, each of which takes a pass of its own: their words and the frequencies of those (at most one a
word) are all that the driver holds.

Cases: null and texts without terms match nothing and don't count in N; documents without id come last among equal
scores; repeated documents are ranked each; repeated rows of an item count once, an item id with several texts is
searched for each; items without terms, and an empty table on either side, give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import map_batches, materialize

#: Terms of the items of one tree, documents of one tree and of a leaf, cells of a level's centroids, bytes of items' text
#: for one pass, bytes of text split at once. No result depends on them.
TERMS, CHUNK, LEAF, CELLS, ITEM_BYTES, CUT = 128, 20_000, 32, 1 << 22, 4 << 20, 4 << 20
#: What widens radii and bounds: far above the rounding of sums of a million doubles.
SLACK = 1e-9
#: Digits, letters in lower case and all bytes above 127 belong to terms.
TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
FOUND = "item int, doc_id long, score long"


def terms(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a text in order, some megabytes at a time."""
    raw, at = (text or "").encode("utf-8", "surrogatepass").translate(TERM), 0
    while at < len(raw):
        end = raw.find(b" ", at + CUT)
        yield raw[at : end if end >= 0 else len(raw)].split()
        at = end if end >= 0 else len(raw)


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document: number of terms, and of those in the vocabulary numbers and counts."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, ids, counts = [], [], []
        for text in batch.column(1).to_pylist():
            n, own = 0, Counter()
            for words in terms(text):
                n += len(words)
                own.update(map(vocabulary.get, words))
            own.pop(None, None)
            sizes.append(n)
            ids.append(list(own))
            counts.append(list(own.values()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "n", "ids", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, n long, ids array<int>, counts array<int>")


class Rows:
    """Sparse rows: ``terms`` and ``values`` (integers) of row i from ``edges[i]`` to ``edges[i + 1]``; no row is empty."""

    def __init__(self, edges: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.edges, self.terms, self.values = edges, terms, values

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.edges[rows + 1] - self.edges[rows]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(edges[-1]) + np.repeat(self.edges[rows] - edges[:-1], sizes)
        return Rows(edges, self.terms[at], self.values[at])

    def dot(self, dense: np.ndarray, a: int, b: int) -> np.ndarray:
        """Inner products of rows a to b - 1 with a dense vector, in its number type."""
        lo, hi = self.edges[a], self.edges[b]
        return np.add.reduceat(dense[self.terms[lo:hi]] * self.values[lo:hi], self.edges[a:b] - lo)


class Tree:
    """A balanced tree over rows, one level after the other: node i of a level has the nodes 2 i and 2 i + 1 below it.

    ``bounds`` of item j at a node is at least the score of each row below it. All nodes of a level are made at once.
    """

    def __init__(self, rows: Rows, items: np.ndarray, leaf: int = LEAF):
        n_terms, n = items.shape[0], len(rows.edges) - 1
        norms = np.add.reduceat(rows.values.astype(float) ** 2, rows.edges[:-1])
        self.depth = int(math.log2(n / leaf)) if n > leaf else 0
        while self.depth and n_terms << self.depth > CELLS:
            self.depth -= 1
        lengths = np.sqrt((items**2).sum(0)) * (1 + SLACK)
        self.order, edges, self.bounds = np.arange(n), np.array([0, n]), []
        for level in range(self.depth + 1):
            own, norm, sizes = rows.take(self.order), norms[self.order], np.diff(edges)
            node = np.repeat(np.arange(len(sizes)), sizes)
            cell = np.repeat(node, np.diff(own.edges)) * n_terms + own.terms
            centroids = np.bincount(cell, own.values, len(sizes) * n_terms).reshape(-1, n_terms) / sizes[:, None]
            squares = self._distances(own, norm, cell, node, centroids.ravel(), (centroids**2).sum(1))
            radii = np.sqrt(np.maximum(np.maximum.reduceat(squares, edges[:-1]), 0) + SLACK * np.maximum.reduceat(norm, edges[:-1])) * (1 + SLACK)
            self.bounds.append((centroids @ items + radii[:, None] * lengths) * (1 + SLACK) + 1)
            if level < self.depth:
                away = squares
                for _ in range(2):
                    pivots = self._largest(away, node, edges)
                    dense, rim = np.zeros(centroids.size), own.take(pivots)
                    dense[np.repeat(np.arange(len(sizes)), np.diff(rim.edges)) * n_terms + rim.terms] = rim.values
                    before, away = away, self._distances(own, norm, cell, node, dense, norm[pivots])
                self.order = self.order[np.lexsort((away - before, node))]
                edges = np.sort(np.concatenate([edges, edges[:-1] + sizes // 2]))
        self.edges, self.rows = edges, rows.take(self.order)

    @staticmethod
    def _distances(own: Rows, norm: np.ndarray, cell: np.ndarray, node: np.ndarray, dense: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """Squared distances of rows to the points of their nodes."""
        return norm - 2 * np.add.reduceat(dense[cell] * own.values, own.edges[:-1]) + squares[node]

    @staticmethod
    def _largest(values: np.ndarray, node: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """The first row of each node that has its largest value."""
        at = np.flatnonzero(values == np.maximum.reduceat(values, edges[:-1])[node])
        return at[np.searchsorted(node[at], np.arange(len(edges) - 1))]

    def search(self, j: int, item: np.ndarray, ids: np.ndarray, k: int, best: list[tuple[int, int]]) -> int:
        """Put the best rows for item j into the heap ``best`` of (score, - id); the number of rows that were scored."""
        scored, waiting = 0, [(-self.bounds[0][0, j], 0, 0)]
        while waiting:
            bound, level, node = heapq.heappop(waiting)
            least = best[0][0] if len(best) == k else 1
            if -bound < least:
                break
            if level < self.depth:
                for child in (2 * node, 2 * node + 1):
                    if (limit := self.bounds[level + 1][child, j]) >= least:
                        heapq.heappush(waiting, (-limit, level + 1, child))
                continue
            a, b = int(self.edges[node]), int(self.edges[node + 1])
            scored += b - a
            scores = self.rows.dot(item, a, b)
            good = np.flatnonzero(scores >= least)
            for score, i in zip(scores[good].tolist(), ids[self.order[a + good]].tolist(), strict=True):
                if len(best) < k:
                    heapq.heappush(best, (score, -i))
                elif (score, -i) > best[0]:
                    heapq.heapreplace(best, (score, -i))
        return scored


def item_sets(queries: list[dict[int, int]], limit: int) -> Iterator[range]:
    """Runs of items with at most ``limit`` terms in all, one item at least."""
    begin, held = 0, 0
    for i, query in enumerate(queries):
        if i > begin and held + len(query) > limit:
            yield range(begin, i)
            begin, held = i, 0
        held += len(query)
    if begin < len(queries):
        yield range(begin, len(queries))


def search_chunk(ids: np.ndarray, rows: Rows, queries: list[dict[int, int]], best: list[list[tuple[int, int]]], k: int, limit: int = TERMS) -> int:
    """Search a chunk of documents (ids; rows of w * x by term) for all items; the number of pairs that were scored."""
    owner, scored = np.repeat(np.arange(len(ids)), np.diff(rows.edges)), 0
    n_all = int(rows.terms.max(initial=-1)) + 1
    for some in item_sets(queries, limit):
        known = np.array(sorted({t for i in some for t in queries[i] if t < n_all}), np.int64)
        number = np.full(n_all, -1)
        number[known] = np.arange(len(known))
        own = number[rows.terms] >= 0
        if not own.any():
            continue
        held, sizes = np.unique(owner[own], return_counts=True)
        items = np.zeros((len(known), len(some)), np.int64)
        for j, i in enumerate(some):
            for term, count in queries[i].items():
                if term < n_all:
                    items[number[term], j] = count
        tree = Tree(Rows(np.concatenate([[0], np.cumsum(sizes)]), number[rows.terms[own]], rows.values[own]), items)
        scored += sum(tree.search(j, items[:, j], ids[held], k, best[i]) for j, i in enumerate(some))
    return scored


#: Stands for a missing id: behind all others among equal scores.
NO_ID = (1 << 63) - 1


def search_vectors(vectors: DataFrame, queries: list[dict[int, int]], weights: np.ndarray, n_docs: int, n_all: int, k: int, chunk: int = CHUNK) -> DataFrame:
    """The best k documents of each task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in queries]
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                sizes = part.column(2).value_lengths().to_numpy()
                terms, counts = (part.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                # Python's integers: terms times documents may pass 64 bits.
                m = np.array([75 + 25 * n * n_docs // n_all for n in part.column(1).to_pylist()], np.int64)
                values = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 12 * np.repeat(m, sizes)))
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                search_chunk(ids, Rows(np.concatenate([[0], np.cumsum(sizes)]), terms, values), queries, best, k)
        rows = [(i, -minus, score) for i, heap in enumerate(best) for score, minus in heap]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        names, docs, scores = (pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True))
        yield pa.RecordBatch.from_arrays([names, docs, scores], names=["item", "doc_id", "score"])

    return vectors.where(F.size("ids") > 0).mapInArrow(run, FOUND)


def _search_set(docs: DataFrame, items: list[tuple[int, str]], k: int) -> DataFrame:
    """One pass for a bounded set of items."""
    spark = docs.sparkSession
    wanted = [Counter(w for part in terms(text) for w in part) for _, text in items]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for c in wanted for w in c))}
    vectors = materialize(term_counts(docs, vocabulary), "term-counts")
    sums = vectors.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    found = vectors.select(F.explode("ids").alias("id")).groupBy("id").count().collect()  # at most one row a word of the items
    frequency = np.zeros(len(vocabulary), np.int64)
    for r in found:
        frequency[r["id"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * sums["docs"] + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
    queries = [{vocabulary[w]: n for w, n in c.items()} for c in wanted]
    hits = search_vectors(vectors, queries, weights, sums["docs"], sums["terms"] or 1, k)
    names = F.broadcast(spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = hits.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of each item (item_id, text): ``item_id, rank, doc_id, score``."""
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    size = asked.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    n_sets = size // item_bytes + 1
    cut = asked.withColumn("set", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_sets)))
    sets = ([(r["item_id"], r["text"]) for r in cut.where(F.col("set") == s).orderBy("item_id", "text").collect()] for s in range(n_sets))
    found = [_search_set(docs, s, k) for s in sets if s]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
