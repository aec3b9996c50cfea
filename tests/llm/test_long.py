"""Line features and scores against plain Python, wherever the bytes are cut, and on texts of many megabytes."""

import itertools
import math
import random
import resource

import numpy as np
import pytest

from drivegauge.llm import line_crf

GROUPS = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\r\n", ".,;:'", "!?"]


def klass(byte: int) -> int:
    if byte >= 128:
        return 7
    return next((k for k, g in enumerate(GROUPS) if chr(byte) in g), 8 if byte == ord("|") else 6)


def features_of(line: bytes, times: int) -> list[float]:
    kinds = [klass(b) for b in line]
    size = max(len(line), 1)
    words = bytes(32 if k == 3 else b for b, k in zip(line, kinds, strict=True)).split()
    pairs = sum(a == b for a, b in itertools.pairwise(words))
    capitals = sum(65 <= w[0] <= 90 for w in words)
    changes = sum(a != b for a, b in itertools.pairwise([*kinds, 3]))
    return [*[kinds.count(k) / size for k in range(9)], math.log1p(len(line)), len(line) / (kinds.count(3) + 1), changes / size, min(times, 9), pairs / max(len(words), 1), capitals / max(len(words), 1)]


def random_rows(rng: random.Random) -> list[bytes]:
    pick = lambda: "".join(rng.choice(["Ab", "ab", " ", " ", "\n", "7", "|", "!", ".", "\t", "é", "ab ab", "$"]) for _ in range(rng.randrange(40)))
    return [pick().encode() for _ in range(rng.randrange(1, 6))]


@pytest.mark.parametrize("chunk", [1, 2, 5, 64, 1 << 19])
def test_features_against_plain_python(chunk, monkeypatch):
    monkeypatch.setattr(line_crf, "CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(60):
        rows = random_rows(rng)
        got, sizes, counts = line_crf.line_features(rows)
        lines = [r.split(b"\n") for r in rows]
        assert counts.tolist() == [len(x) for x in lines]
        assert sizes.tolist() == [len(x) for y in lines for x in y]
        want = [features_of(x, y.count(x)) for y in lines for x in y]
        assert np.allclose(got, np.array(want, np.float32), atol=1e-6)


def by_paths(field: line_crf.Field, rows: list[bytes]) -> list[float]:
    """Scores from the sum over all labellings of a text's lines."""
    out = []
    for row in rows:
        features, sizes, _ = line_crf.line_features([row])
        n = len(features)
        bins = [[int(sum(e <= float(f) for e in edges)) for f, edges in zip(line, field.edges, strict=True)] for line in features]
        width, none = len(bins[0]), [line_crf.BINS] * len(bins[0])
        odds = []
        for i in range(n):
            near = [bins[i], bins[i - 1] if i else none, bins[i + 1] if i + 1 < n else none]
            odds.append(field.bias + sum(field.weights[b + (line_crf.BINS + 1) * (j + width * k)] for k, side in enumerate(near) for j, b in enumerate(side)))
        good, total = np.zeros(n), 0.0
        for path in itertools.product((0, 1), repeat=n):
            p = math.exp(sum(o for o, y in zip(odds, path, strict=True) if y) + sum(field.stay[a, b] for a, b in itertools.pairwise(path)))
            total += p
            good += p * np.array(path)
        mean = float((good / total * (sizes + 1)).sum() / (sizes + 1).sum())
        out.append(1 / (1 + math.exp(-(math.log(mean / (1 - mean)) - field.shift))))
    return out


@pytest.mark.parametrize("run", [1, 3, 1 << 15])
def test_scores_against_all_labellings(run, monkeypatch):
    monkeypatch.setattr(line_crf, "RUN", run)
    rng = np.random.default_rng(5)
    edges = np.sort(rng.uniform(0, 1, (line_crf.N_FEATURES, line_crf.BINS - 1)), axis=1)
    weights = rng.normal(0, 0.2, (line_crf.BINS + 1) * line_crf.N_FEATURES * 3)
    field = line_crf.Field(edges, weights, 0.3, np.array([[0.7, 0.0], [0.0, -0.2]]), 0.4)
    rows = [r for seed in range(12) for r in random_rows(random.Random(seed)) if r.count(b"\n") < 8]
    assert np.allclose(line_crf.scores_of([r.decode() for r in rows], field), by_paths(field, rows))


def test_memory_of_long_texts():
    rng = np.random.default_rng(1)
    edges = np.sort(rng.uniform(0, 1, (line_crf.N_FEATURES, line_crf.BINS - 1)), axis=1)
    field = line_crf.Field(edges, rng.normal(0, 0.1, (line_crf.BINS + 1) * line_crf.N_FEATURES * 3), 0.0, np.eye(2), 0.0)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for text in ("a plain Line of words, forty bytes long.\n" * 500_000, "word " * 4_000_000, "x" * 20_000_000):
        assert 0 <= line_crf.scores_of([text], field)[0] <= 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # kB, for 20 MB of text
