"""The search against all pairs, and the tree's bounds against all rows below a node."""

import collections
import math
import random
import re

import numpy as np

from drivegauge.llm import ball_tree

SCHEMA = "doc_id long, text string, n long, score long, item int, ids array<int>"


def rows(seed=4):
    rng, out = random.Random(seed), []
    vocab = [f"w{i}" for i in range(300)] + ["The", "THE", "of", "été", "ÉTÉ", "x1y"]
    for i in range(400):
        out.append((i * 3, rng.choice([" ", "-", "\x00", "\x7f", "..."]).join(vocab[min(int(rng.expovariate(0.02)), 305)] for _ in range(rng.choice([1, 5, 40, 150])))))
    out += [(5000 + i, out[7][1]) for i in range(60)] + [(9000, None), (9001, ""), (9002, " .-"), (None, out[3][1]), (None, None), out[11], out[11], (9003, "w1 " * 60_000)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 8, 30])))) for i in range(25)]
    return out, items + [(100, None), (101, ""), (102, "nowhere"), (103, out[7][1]), (104, "w1 w1 w1 été"), (104, "of"), items[2]]


def brute(docs, items, k):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    counts = [(i, collections.Counter(find(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_all = len(counts), sum(sum(c.values()) for _, c in counts)
    frequency = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in counts:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_all
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in find(text) if t in c)
            scored += [(-score, (1, 0) if i is None else (0, i))] * (score > 0)
        out += [(item, r, None if i[0] else i[1], -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return collections.Counter(out)


def test_search(spark, monkeypatch):
    docs, items = rows()
    frame = spark.createDataFrame([(i, t, 1, 1, 1, [1]) for i, t in docs], SCHEMA).repartition(3)
    asked = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, set int")
    monkeypatch.setattr(ball_tree.Tree.__init__, "__defaults__", (4,))
    for k in (20, 3):
        assert collections.Counter(map(tuple, ball_tree.ranked_search(frame, asked, k).collect())) == brute(docs, items, k)
    small = ball_tree.ranked_search(frame, asked, 4, item_bytes=1500)
    assert collections.Counter(map(tuple, small.collect())) == brute(docs, items, 4)
    assert ball_tree.ranked_search(frame.limit(0), asked).count() == ball_tree.ranked_search(frame, asked.limit(0)).count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 12, 3000)
    terms = np.concatenate([np.sort(rng.choice(60, s, replace=False)) for s in sizes])
    rows = ball_tree.Rows(np.r_[0, np.cumsum(sizes)], terms, rng.integers(0, 10**10, len(terms)))
    items = np.zeros((60, 20), np.int64)
    for j in range(20):
        items[rng.choice(60, 4, replace=False), j] = rng.integers(1, 3, 4)
    tree, less = ball_tree.Tree(rows, items, 8), 0
    assert sorted(tree.order.tolist()) == list(range(3000)) and tree.depth == 8
    for j in range(20):
        exact = tree.rows.dot(items[:, j], 0, 3000)
        for level, bounds in enumerate(tree.bounds):
            wide = 1 << tree.depth - level
            assert all(bounds[i, j] >= exact[tree.edges[i * wide] : tree.edges[(i + 1) * wide]].max() for i in range(1 << level))
        best = []
        less += tree.search(j, items[:, j], np.arange(3000), 5, best) < 3000
        want = sorted(((int(s), -int(i)) for s, i in zip(exact, tree.order, strict=True) if s > 0), reverse=True)[:5]
        assert sorted(best, reverse=True) == want
    assert less > 15


def test_terms_across_cuts(monkeypatch):
    monkeypatch.setattr(ball_tree, "CUT", 7)
    text = "Alpha, beta-gamma  " * 5 + "x" * 40 + " end"
    assert [w for part in ball_tree.terms(text) for w in part] == re.findall(rb"[a-z]+", text.lower().encode())
