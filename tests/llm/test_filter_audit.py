"""The audit against every order applied to every row."""

import itertools
import random
import re

from drivegauge.llm import filter_audit

SCHEMA = "doc_id long, text string, source string, mask int, part string, n long, rank long, digest string"


def rows(seed=3):
    rng, out = random.Random(seed), []
    for i in range(150):
        words = ["".join(rng.choice("abcABC#é") for _ in range(rng.randint(1, 3 if i % 2 else 6))) for _ in range(rng.choice([0, 3, 49, 50, 51, 80]))]
        out.append((i, rng.choice([" ", "\n", "\x0b", " "]).join(words), rng.choice(["a", "b", "", None])))
    out += [(200 + i, out[i][1], "a") for i in range(0, 60, 3)] + [(None, out[5][1], "b"), (None, None, None), (5, out[5][1], "b"), out[7], (-1, out[9][1], "a"), (300, "x " * 40_000, "b")]
    return out


def brute(docs, labels):
    quality, toxic = {}, {}
    for i, q, t in labels:
        quality[i], toxic[i] = quality.get(i, False) or q == 1, toxic.get(i, False) or t == 1
    texts = [t or "" for _, t, _ in docs]
    masks = []
    for (i, _, _), t in zip(docs, texts, strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t))}
        fails["E"] = i is not None and any(o == t and j is not None and j < i for (j, _, _), o in zip(docs, texts, strict=True))
        masks.append({f for f, v in fails.items() if v})
    out = {}
    for part in {s or "" for _, _, s in docs}:
        own = [(m, i) for m, (i, _, s) in zip(masks, docs, strict=True) if (s or "") == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            alive = own
            for step, f in enumerate(order, 1):
                gone, before = [x for x in alive if f in x[0]], len(alive)
                alive = [x for x in alive if f not in x[0]]
                share[f] += before - len(alive)
                out[part, "".join(order), step] = [len(alive), len(gone), sum(f in m for m, _ in own) - len(gone), sum(m == {f} for m, _ in own), sum(quality.get(i, False) for _, i in gone if i is not None), sum(toxic.get(i, False) for _, i in gone if i is not None)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(share[order[step - 1]])
    return out


def test_filter_audit(spark):
    docs = rows()
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 260, 2)] + [(4, 1, None), (None, 1, 1), (5, 1, 1)]
    table = spark.createDataFrame([(i, t, s, 1, "p", 1, 1, "d") for i, t, s in docs], SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(table, known).collect()
    want = brute(docs, labels)
    assert len(got) == len(want) == 600 * 3
    for r in got:
        assert [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] == want[r["part"], r["filter_order"], r["step"]], r
    assert filter_audit.filter_audit(table.limit(0), known).count() == 0


def test_intervals():
    k = 4
    orders = list(itertools.permutations(range(k)))
    assert [filter_audit.lehmer_rank(p, k) for p in orders] == list(range(24))
    cells = {(m, s, r) for m, s, a, b in filter_audit.removal_intervals(k) for r in range(a, b)}
    assert cells == {(m, next(s for s, f in enumerate(o, 1) if m >> f & 1), r) for m in range(1, 1 << k) for r, o in enumerate(orders)}
