"""The automaton against a model of dictionaries, and its probabilities against one."""

import collections
import math
import random
import re
import zlib

import numpy as np

from drivegauge.llm import ngram_lm

SCHEMA = "doc_id long, text string, block long, score double, words string, held boolean, n_tokens int"


def rows(seed=2):
    rng, out = random.Random(seed), []
    vocab = ["The", "the", "a", "of", "é", "Σx", "zz"] + [f"w{i}" for i in range(60)]
    for i in range(120):
        out.append((i, rng.choice([" ", "\n", "\x0b\x0c", "  "]).join(rng.choice(vocab[: 8 + i % 60]) for _ in range(rng.choice([1, 2, 30, 80])))))
    return out + [(200, ""), (201, None), (202, " \t "), (None, "the a"), (203, "word " + "the " * 3000), (204, "q" * 5000), out[3], (205, "the " + "unseen" * 60)]


def brute(docs):
    lower = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    one, two = collections.Counter(), collections.Counter()
    for i, t in docs:
        if not held(i):
            w = ["<s>", *lower(t), "</s>"]
            one.update(w[1:])
            two.update(zip(w, w[1:], strict=False))
    n, v = sum(one.values()), len(one)
    rate = lambda c: ngram_lm.discount(sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values()))
    d1, d2 = rate(one), rate(two)
    behind, kinds = collections.Counter(), collections.Counter()
    for (a, _), c in two.items():
        behind[a] += c
        kinds[a] += 1
    single = lambda w: (max(one[w] - d1, 0) + d1 * v / (v + 1)) / n

    def p(w, before):
        if not behind[before]:
            return single(w)
        return max(two[before, w] - d2, 0) / behind[before] + d2 * kinds[before] / behind[before] * single(w)

    out = []
    for i, t in docs:
        w = ["<s>", *lower(t), "</s>"]
        out.append((i, held(i), len(w) - 1, sum(one[x] > 0 for x in w[1:]), n, sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w[1:]), sum(math.log10(p(b, a)) for a, b in zip(w, w[1:], strict=False))))
    return out, p, one


def test_scores(spark):
    docs = rows()
    frame = spark.createDataFrame([(i, t, 1, 0.5, "x", True, 1) for i, t in docs], SCHEMA).repartition(3)
    want, _, _ = brute(docs)
    for sizes in ({}, {"block": 3000, "piece": 200, "bucket": 400}):
        got = [tuple(r) for r in ngram_lm.score_texts(frame, **sizes).collect()]
        key = lambda r: (str(r[0]), r[2], r[5])
        assert len(got) == len(want)
        for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
            assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9), (a, b)
    assert ngram_lm.score_texts(frame.limit(0)).count() == 0


def test_probabilities_sum_to_one():
    _, p, one = brute(rows())
    for before in ("<s>", "the", "zz", "never seen"):
        assert abs(sum(p(w, before) for w in one) + p("an unknown word", before) - 1) < 1e-9


def test_common_words_are_cut():
    first, second = ngram_lm.split_points(10, [(5 << 40, 500)], 1000)
    assert list(zip(first.tolist(), second.tolist(), strict=True)) == sorted(zip(first.tolist(), second.tolist(), strict=True))
    assert sum(first == 5 << 40) == 6


def test_pieces():
    text = " A bc\n" + "d" * 30 + "  ef gh  "
    for limit in range(1, 40):
        parts = list(ngram_lm.pieces(text, limit))
        assert [p[1] for p in parts] == [True] + [False] * (len(parts) - 1) and [p[2] for p in parts] == [False] * (len(parts) - 1) + [True]
        words = [w for raw, first, _ in parts for w in raw.split()[0 if first else 1 :]]
        assert words == text.lower().encode().split()
