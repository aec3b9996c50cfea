"""The operators against brute force, the libraries, and the cases their docstrings define."""

import base64
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from drivegauge.llm import base, byte_bpe, components, flac, html_text, jaccard_join, line_crf, packing, simhash, suffix_dedup, token_counts, warc

SCHEMA = "doc_id long, text string, digest string, token long, block long, n int, fingerprint long, size int"


def words(rng, n, pool=400):
    return " ".join(rng.choice("bcdfg") + rng.choice("aeiou") + str(rng.randrange(pool)) for _ in range(n))


def sample(seed=5):
    """Texts with copies, near copies, shared passages, short, empty, null and repeated rows."""
    rng = random.Random(seed)
    passage, out = words(rng, 60), []
    for _ in range(30):
        out.append(words(rng, rng.randrange(20, 200)))
    for k in range(12):
        w = out[0].split(" ")
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "zz" + str(rng.randrange(99))
        out.append(" ".join(w))
    for k in range(10):
        out.append(f"{words(rng, 15 + k)} {passage}\n{words(rng, 10)}")
    out += [out[3], out[3].upper(), "", None, "one", "one two", "ONE two", "é Σ 世界 <|endoftext|> x", " \n\t ", "a" * 3000, passage * 3]
    rows = list(enumerate(out, 100))
    return rows + [rows[5]]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, 5) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, sample())


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, sample()).limit(0)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


TEXTS = {i: t or "" for i, t in sample()}


def test_byte_bpe(docs, none):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.byte_bpe(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert got.count() == len(sample())
    for i, r in by_id(got).items():
        ids = np.array(own.encode_ordinary(TEXTS[i]), "<u4").tobytes()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(TEXTS[i].encode()).hexdigest())
    assert byte_bpe.byte_bpe(none, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0


ODD = ["a", "é", "ß", " ", "  ", "\n", "\x1c", "\x85", "\xa0", chr(0x1680), "1", "²", "!", "'s", "'", "<|endoftext|>", "<|STARTOFTEXT|>", "世", chr(0x93C), chr(0x200B), ".", "A", "É", "Σ", "ΑΣ", "e" + chr(0x301), "İ", "the", "B.", ",", "Y", "W", chr(0x30A), chr(0xFB4B), chr(0xFB49), chr(0xFB2B), chr(0x1100), chr(0x1161), chr(0x2028), "ǅ", chr(0x1C89), chr(0x3000), "#", "ü", "œ"]


def test_tokenizers_on_odd_characters():
    import tiktoken

    rng = random.Random(1)
    rows = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    counter, coder = token_counts.LibraryCounter(P.path("byte_bpe_50k.json")), packing.WordTokenizer(P.path("word_bpe_49k.json"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pairs = byte_bpe.RankEncoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).encode(rows)
    for t, n, ids, pair in zip(rows, counter.counts(rows), coder.encode(rows), pairs, strict=True):
        assert n == len(counter.tokenizer.encode(t, add_special_tokens=False))
        assert np.frombuffer(ids, "<u4").tolist() == coder.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(pair, "<u4").tolist() == own.encode_ordinary(t)


def test_packing_ids_of_all_planes():
    """Strings of random code points of every plane, and each letter before a stop and a ring, as the library gives them."""
    rng = random.Random(7)
    coder = packing.WordTokenizer(P.path("word_bpe_49k.json"))
    assert coder.coder is not None
    code = lambda: chr(rng.choice([rng.randrange(0x250), rng.randrange(0xD800), rng.randrange(0xE000, 0x30000)]))
    rows = ["".join(code() for _ in range(rng.randint(1, 12))) for _ in range(6000)]
    rows += [c + tail for c in ("Y", "W", chr(0xFB4B), chr(0xFB49), chr(0xFB2B)) for tail in (chr(0x30A), ",", "." + chr(0x30A))]
    rows += [chr(c) + "a, " + chr(c) + "." for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for t, ids in zip(rows, coder.encode(rows), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == coder.tokenizer.encode(t, add_special_tokens=False).ids, ascii(t)


def test_token_cache(spark, docs, none):
    path, tokenizer = base.scratch_dir(spark, "cache"), P.path("byte_bpe_50k.json")
    got = token_counts.token_counts(docs, tokenizer, path, 40)
    stored = spark.read.parquet(path).count()
    assert got.count() == len(sample()) and stored == len(set(TEXTS.values()))
    counter = token_counts.LibraryCounter(tokenizer)
    for i, r in by_id(got).items():
        n = len(counter.tokenizer.encode(TEXTS[i], add_special_tokens=False))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(TEXTS[i].encode()), n > 40)
    more = docs.unionByName(frame(spark, [(999, "something new")]))
    assert token_counts.token_counts(more, tokenizer, path).count() == len(sample()) + 1
    assert spark.read.parquet(path).count() == stored + 1
    assert token_counts.token_counts(none, tokenizer, base.scratch_dir(spark, "cache")).count() == 0


def test_packing(docs, none):
    got = packing.pack(docs, P.path("word_bpe_49k.json"), 256, keep_ids=True).collect()
    coder = packing.WordTokenizer(P.path("word_bpe_49k.json"))
    whole, used = collections.defaultdict(dict), collections.defaultdict(list)
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] and r["start"] == 256 * r["piece"]
        whole[r["doc_id"]][r["piece"]] = bytes(r["ids"])
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, pieces in whole.items():
        ids = coder.tokenizer.encode(TEXTS[i], add_special_tokens=False).ids + [1]
        assert np.frombuffer(b"".join(pieces[k] for k in sorted(pieces)), "<u4").tolist() == ids
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(used) <= -(-sum(r["length"] for r in got) // 256) + 4  # few short pieces are left to fill with
    assert packing.pack(none, P.path("word_bpe_49k.json")).count() == 0


def test_packing_finds_exact_complements():
    patterns = packing.plan_patterns({70: 3, 30: 3, 50: 1, 20: 1, 25: 1, 5: 1}, 100)
    assert sum(t for _, t in patterns) == 4 and all(sum(p) == 100 for p, _ in patterns)


def test_packing_finds_short_triples():
    """An exact triple behind 300 longer lengths, and triples of random lengths against enumeration."""
    index = packing.LengthIndex(dict.fromkeys(range(700, 1000), 1) | {333: 2, 334: 1}, 4096)
    assert sorted(index.exact(1000, {})) == [333, 333, 334]
    rng = random.Random(4)
    for _ in range(300):
        counts = {rng.randrange(1, 60): rng.randrange(1, 3) for _ in range(6)}
        gap, pool = rng.randrange(1, 120), [k for k, n in counts.items() for _ in range(n)]
        some = any(sum(c) == gap for r in (1, 2, 3) for c in itertools.combinations(pool, r))
        found = packing.LengthIndex(counts, 128).exact(gap, {})
        assert bool(found) == some and (not found or sum(found) == gap and not collections.Counter(found) - collections.Counter(pool))


def sets():
    tr = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = {}
    for i, t in TEXTS.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(tr))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def test_near_duplicates(docs, none):
    s = sets()
    parent = {i: i for i in s}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in s:
        for j in s:
            if i < j and s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    got = jaccard_join.near_duplicates(docs)
    assert got.count() == len(sample())
    for i, r in by_id(got).items():
        assert (r["n_shingles"], r["component_id"]) == (len(s[i]), find(i)), i
    assert jaccard_join.near_duplicates(none).count() == 0


def test_one_of_each(spark):
    """Repeated ids and rows, null ids, texts without words, clashing columns, an empty table."""
    rng = random.Random(12)
    a, b, c = words(rng, 60), words(rng, 60), words(rng, 60)
    near = lambda t, w: " ".join(t.split(" ")[:-1] + [w])
    rows = [
        (1, a, "r1", 1), (2, near(a, "x"), "r2", 1), (2, b, "r3", 1), (3, b, "r4", 1), (4, c, "r5", 1), (4, near(c, "y"), "r6", 1), (5, c, "r7", 1), (6, c[::-1], "r8", 1), (6, c[::-1], "r8", 2),
        (None, a, "r9", 1), (None, None, "r10", 1), (7, None, "r11", 1), (7, "", "r12", 1), (8, " ", "r13", 1), (8, " ", "r13", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_md5 string, n long")
    before = {k: spark.conf.get(k, None) for k in jaccard_join.PRUNING}
    kept = jaccard_join.one_of_each(df)
    assert kept.schema == df.schema and before == {k: spark.conf.get(k, None) for k in jaccard_join.PRUNING}
    got = collections.Counter(r["text_md5"] for r in kept.collect())
    least = "r5" if hashlib.md5(c.encode()).digest() < hashlib.md5(near(c, "y").encode()).digest() else "r6"
    assert got == collections.Counter(["r1", "r3", least, "r8", "r9", "r10", "r11", "r12", "r13", "r13"])
    assert jaccard_join.one_of_each(df.limit(0)).count() == 0


def test_near_duplicates_without_ids(spark):
    rng = random.Random(8)
    a, b, c = words(rng, 60), words(rng, 60), words(rng, 60)
    near = " ".join(a.split(" ")[:-1] + ["other"])
    rows = [(4, a), (7, near), (None, a), (None, a), (None, near), (None, b), (None, b), (9, c), (None, None)]
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(frame(spark, rows)).collect())
    assert got == collections.Counter([(4, 56, 4), (7, 56, 4), (9, 56, 9)] + [(None, 56, 4)] * 3 + [(None, 56, None)] * 2 + [(None, 0, None)])
    alone = frame(spark, [(None, a), (None, near)])
    assert [r["component_id"] for r in jaccard_join.near_duplicates(alone).collect()] == [None, None]


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    linked = {x for e in edges if e[0] != e[1] for x in e}
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}


@pytest.mark.parametrize("small", [0, 64])
def test_suffix_dedup(docs, none, monkeypatch, small):
    monkeypatch.setattr(suffix_dedup, "SMALL", small)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 8000)
    seen, want = set(), {}
    for i in sorted(TEXTS):
        raw, new = TEXTS[i].encode(), []
        mark = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49):
            mark[k : k + 50] |= raw[k : k + 50] in seen
            new.append(raw[k : k + 50])
        seen.update(new)
        spans = int((np.diff(np.r_[0, mark.astype(int)]) == 1).sum())
        want[i] = (len(raw), int(mark.sum()), spans, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~mark])).hexdigest())
    got = suffix_dedup.dedup_suffixes(docs)
    assert got.count() == len(sample())
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in by_id(got).items()} == want
    assert sum(w[1] for w in want.values()) > 1000
    assert suffix_dedup.dedup_suffixes(none).count() == 0


def test_suffix_dedup_of_ids_with_two_texts(spark):
    import corpus_pipeline

    rng = random.Random(9)
    a, b = words(rng, 40), words(rng, 40)
    df = spark.createDataFrame([(1, a, 0), (2, a, 0), (2, b, 0), (3, b, 0)], "doc_id long, text string, n_chars int")
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.dedup_suffixes(df).collect())
    assert got == sorted([(1, len(a), 0), (2, len(a), len(a)), (2, len(b), 0), (3, len(b), len(b))])
    assert sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.repeated_passages(spark, df, "").collect()) == [(1, a), (2, b)]


def test_shortened_rows(spark):
    """Repeated ids of different texts, null and empty texts, null ids, clashing columns, cut characters, an empty table."""
    rng = random.Random(10)
    a, b, tail = words(rng, 40), words(rng, 40), words(rng, 12)
    rows = [
        (1, a, 5, "p", 0.5, "r1"), (7, a + " " + tail, 9, "q", None, "r2"), (7, b, 9, None, 1.5, "r3"), (7, b, 9, "again", 1.5, "r3"), (8, b, 1, "copy", 0.0, "r4"),
        (9, None, None, "null", 0.0, "r5"), (10, "", 0, "empty", 0.0, "r6"), (None, a, 4, "no id", 0.0, "r7"), (11, "ä" * 60, 60, "x", 0.0, "r8"), (12, "ö" + "ä" * 60 + "ö", 62, "y", 0.0, "r9"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, block string, kept double, `row.x` string")
    got = suffix_dedup.shortened(df, length_col="n_chars")
    assert got.schema == df.schema
    want = [r for r in rows if r[5] not in ("r2", "r4", "r9")] + [(7, " " + tail, len(tail) + 1, "q", None, "r2"), (12, "ö", 1, "y", 0.0, "r9")]  # the last one shares its first byte
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    assert suffix_dedup.shortened(df.limit(0)).count() == 0


def test_simhash(spark, docs, none):
    got = by_id(simhash.edited_fingerprints(docs, partitions=3))
    order = sorted(sample(), key=lambda r: (r[0], r[1] or ""))
    for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        t, u = t or "", u or ""
        n = len(t)
        if sum(1 for k, _ in order if k == i) == 1:
            edited = (t[: n - n // 4] + u[: n // 4]).encode()
            a, b, c = simhash.fingerprints([t.encode(), edited, u.encode()])
            near = simhash.likeness(a, np.array([b, c]))
            assert (got[i]["n_chars"], got[i]["edited_sha256"], got[i]["fingerprint"]) == (n, hashlib.sha256(edited).hexdigest(), f"{a:016x}")
            assert (got[i]["near_edited"], got[i]["near_next"]) == tuple(near)
    assert simhash.edited_fingerprints(none).count() == 0


def test_hamming_search(spark):
    rng = random.Random(4)
    base_ = [rng.getrandbits(63) for _ in range(60)]
    prints = base_ + [b ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for b in base_[:20]] + [b ^ 0b1111 for b in base_[20:30]]
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    got = {(r["a"], r["b"], r["distance"]) for r in simhash.near_fingerprints(df).collect()}
    assert got == {(a, b, (a ^ b).bit_count()) for a in set(prints) for b in set(prints) if a < b and (a ^ b).bit_count() <= 3}
    some = df.limit(10)
    queries = {r["fingerprint"] for r in some.collect()}
    found = {(r["a"], r["b"]) for r in simhash.near_fingerprints(df, queries=some).collect()}
    assert found == {(a, b) for a in queries for b in set(prints) if a != b and (a ^ b).bit_count() <= 3}


def test_count_near(spark):
    """Against all pairs, with repeated fingerprints, null ids and the highest bit; an empty table."""
    rng = random.Random(6)
    some = [rng.getrandbits(64) for _ in range(20)] + [(1 << 64) - 1, 0]
    prints = [b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in some for _ in range(5)] + some
    rows = [(k if k % 7 else None, f"{p:016x}", "x") for k, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string, n string")
    got = collections.Counter(map(tuple, simhash.count_near(df, every=5).collect()))
    near = lambda p: sum((int(p, 16) ^ q).bit_count() <= 3 for q in prints)
    assert got == collections.Counter((i, p, n, near(p) if i is not None and i % 5 == 0 else None) for i, p, n in rows)
    assert simhash.count_near(df.limit(0)).count() == 0


@pytest.mark.parametrize("small", [0, 64])
def test_suffix_dedup_with_colliding_names(spark, docs, monkeypatch, small):
    """Windows that share their 64-bit name only are kept."""
    want = sorted(map(tuple, suffix_dedup.dedup_suffixes(docs).collect()), key=str)
    plain = suffix_dedup.window_names
    if small:
        monkeypatch.setattr(suffix_dedup, "SMALL", small)
    else:
        monkeypatch.setattr(suffix_dedup, "SMALL", 0)
        monkeypatch.setattr(suffix_dedup, "window_names", lambda grams, at: plain(grams, at) & np.uint64(0xFFFF))
    assert sorted(map(tuple, suffix_dedup.dedup_suffixes(docs).collect()), key=str) == want


def test_flac(docs, none):
    got = by_id(flac.media_features(docs))
    for i, t in TEXTS.items():
        p = flac.payload(t)
        assert (got[i]["payload_sha256"], got[i]["tail_crc32"], got[i]["payload_bytes"]) == (hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(p))
    assert flac.media_features(none).count() == 0
    stored = flac.store(docs)
    whole = collections.defaultdict(dict)
    for r in flac.pcm_blocks(stored.dropDuplicates(["doc_id"])).collect():
        whole[r["doc_id"]][r["first_sample"]] = bytes(r["pcm"])
    for i, parts in whole.items():
        assert b"".join(parts[k] for k in sorted(parts)) == flac.payload(TEXTS[i])


def test_flac_reads_stored_streams(spark, docs, monkeypatch):
    written = []

    def watched(df, label):
        written.append(base.materialize(df, label))
        return written[-1]

    monkeypatch.setattr(flac, "materialize", watched, raising=False)
    got = collections.Counter((r["doc_id"], r["media_sha256"], r["n_blocks"]) for r in flac.media_features(docs).collect())
    assert len(written) == 1 and written[0].count() == len(sample()) and written[0].inputFiles()
    stored = [(r["doc_id"], bytes(r["media"])) for r in written[0].collect()]
    assert got == collections.Counter((i, hashlib.sha256(m).hexdigest(), len(flac.decode([m])[0])) for i, m in stored)
    assert all(b"".join(b for _, _, b in flac.decode([m])[0]) == flac.payload(TEXTS[i]) for i, m in stored)


def test_flac_streams():
    rng = np.random.default_rng(1)
    t = np.arange(9000)
    tone = (128 + 90 * np.sin(t / 9) + rng.normal(0, 2, 9000)).astype(np.uint8).tobytes()
    inputs = [tone, bytes(64), rng.integers(0, 256, 4096, np.uint8).tobytes(), bytes([0, 255] * 700), bytes(range(256)) * 9]
    streams = flac.encode(inputs)
    assert len(streams[0]) < 0.7 * len(tone) and len(streams[1]) < 100
    bare = [s[:4] + b"\x80" + s[5:42] + s[flac.Stream(s).first :] for s in streams]  # without the seek table
    for some in (streams, bare):
        assert [b"".join(b for _, _, b in own) for own in flac.decode(some)] == inputs
    spoilt = bytearray(streams[0])
    spoilt[-100] ^= 4
    with pytest.raises(ValueError, match="checksum"):
        flac.decode([bytes(spoilt)])


def test_warc(spark):
    trap = "x" * 1200 + "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "u", "a" * 2000), (2, "u", "a" * 2000), (3, None, trap), (4, "u\r\nv", None), (5, "u", "short"), (6, "u", "short"), (7, "u", "é" * 700), (9, "u", "a" * 2000), (9, "u", "a" * 2000), (None, "u", "null")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["page_id"]].append((r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]))
    for i, _, h in rows:
        raw = (h or "").encode()
        kind = ("revisit", 9) if i in (1, 2) else ("response", None)
        assert set(by[i]) == {(*kind, len(raw), hashlib.sha1(raw).hexdigest())}


def test_warc_chain():
    starts = np.array([0, 40, 55, 100, 130])
    assert warc.reachable(starts, np.array([100, 70, 130, 130, 200])).tolist() == [True, False, False, True, True]


def test_html(spark):
    page = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home, home</a></li></ul></nav>
    <div id=content><div class="post"><h1>A &amp; B</h1><p>First, long, text here.<p><b>Second&nbsp;one<br> goes on.</p><form>Write, to, us</form></div>
    <div class="comments"><p>A reader, says, this.</p></div></div><aside>Side</aside><script>var a = "<p>no</p>";</script><footer>&copy; x</footer>"""
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "plain &lt;text&gt;"), (5, "u", "<p>open <div class='ad'>buy")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1][0] == "A & B\nFirst, long, text here.\nSecond one goes on."
    assert got[2] == got[3] == ("", 0) and got[4] == ("plain <text>", 12) and got[5] == ("open", 4)


def test_html_of_broken_pages(spark):
    import time

    prose = "A first sentence, with a comma, and a good many words behind it. Another one follows, as long as that."
    took = time.perf_counter()
    deep = "<article>" + "<div>" * 5000 + f"<p>{prose}" + "</div>" * 5000 + "</article>"
    assert html_text.main_text(deep) == prose
    assert html_text.main_text("<p>" + prose + "</p>" + "<a " * 100_000) == prose
    for broken in ('<a "' * 20_000, '<a x="' * 20_000, "<a x='>" * 20_000, "<!--" * 20_000, "<" * 100_000, "</div>" * 50_000, "<div>" * 50_000, "<title>" * 20_000, "<svg>" * 20_000, "<a x=" * 20_000 + "'"):
        html_text.main_text(broken)
    assert time.perf_counter() - took < 10
    for page in (f"<form><select><option>one<option>two</select></form><p>{prose}</p>", f"<div><option>one<p>{prose}</div>", f"<div><button>press<p>{prose}</p></div>", f'<div class="post social-science"><p>{prose}</p></div>',
                 f'<div class="related-research article"><p>{prose}</p></div>', f'<div class="sidebar-layout"><p>{prose} {prose} {prose}</p></div><p>', f"<title>t<p>{prose}</p>", f"<noscript><p>{prose}</p>", f'<p title="a > b">{prose}</p>', f"<p>{prose}<p class=x'>"):
        assert prose in html_text.main_text(page).replace(f"{prose} {prose} {prose}", prose).split("\n"), page
    assert html_text.main_text('<div class="ad">buy</div><div class="comments"><p>' + prose * 9 + "</p></div>") == ""
    assert html_text.main_text(f"<p>1 < 2 & 3 &lt; 4</p><p>{prose}") == f"1 < 2 & 3 < 4\n{prose}"
    assert html_text.main_text("<article><p>Text <button>share</button> goes on.</p></article>") == "Text goes on."
    rows = [(1, "u", f"<p>{prose}", "t", 1), (1, "u", f"<p>{prose}", "t", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_text.extract(df).collect()) == [(0, "", 0)] + [(1, prose, len(prose))] * 2
    assert html_text.extract(df.limit(0)).count() == 0


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(3)
    unary, stay = rng.normal(size=9), rng.normal(size=(2, 2))
    counts = np.array([4, 1, 4])
    good, pairs = line_crf.marginals(unary, stay, counts)
    for begin, n in ((0, 4), (4, 1), (5, 4)):
        weights = np.zeros(2**n)
        for s in range(2**n):
            y = [(s >> k) & 1 for k in range(n)]
            weights[s] = np.exp(sum(unary[begin + k] * y[k] for k in range(n)) + sum(stay[y[k], y[k + 1]] for k in range(n - 1)))
        weights /= weights.sum()
        for k in range(n):
            assert np.isclose(good[begin + k], sum(w for s, w in enumerate(weights) if s >> k & 1))
            if k + 1 < n:
                assert np.isclose(pairs[begin + k, 1, 1], sum(w for s, w in enumerate(weights) if s >> k & 3 == 3))


def test_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = line_crf.classify(spark.read.parquet(f"{d}/documents.parquet"), labels)
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert got.count() == 1000 and sum(r["predicted"] == r["quality"] for r in rows) > 0.95 * len(rows)


def test_classifier_cases(spark, docs, none):
    labels = spark.createDataFrame([(100, 1, 0), (None, 0, 0), (101, None, 0)], "doc_id long, quality int, toxic int")
    got = line_crf.classify(docs, labels).collect()
    assert len(got) == len(sample()) and all(r["score"] == 0.5 and r["predicted"] == 1 for r in got)
    some = labels.limit(0).union(spark.createDataFrame([(i, i % 2, 0) for i in range(100, 160)], labels.schema))
    scores = [r["score"] for r in line_crf.classify(docs, some).collect()]
    assert len(scores) == len(sample()) and all(0 <= s <= 1 for s in scores)
    assert line_crf.classify(none, some).count() == 0


def test_pipeline_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = base.materialize(pipeline.quality(spark, docs, d), "t")
    scores = {r["doc_id"]: r["score"] for r in line_crf.classify(docs, spark.read.parquet(f"{d}/labels.parquet")).collect()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, s in scores.items() if s >= 0.5}
    one = base.materialize(pipeline.near_duplicates(spark, kept, d), "t")
    groups = by_id(jaccard_join.near_duplicates(kept))
    assert {r["doc_id"] for r in one.select("doc_id").collect()} == {r["component_id"] for r in groups.values()}
    cut = base.materialize(pipeline.repeated_passages(spark, one, d), "t")
    spans = by_id(suffix_dedup.dedup_suffixes(one))
    texts = by_id(one)
    for i, r in by_id(cut).items():
        assert r["text"] == texts[i]["text"] if not spans[i]["n_removed"] else len(r["text"].encode()) <= spans[i]["n_bytes"] - spans[i]["n_removed"]
        assert r["n_chars"] == len(r["text"])
    assert cut.columns == docs.columns
    out = pipeline.best_fit(spark, cut, d)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {r["doc_id"] for r in cut.select("doc_id").collect()}


def test_pipeline_quality_rows(spark, tmp_path):
    """Null, empty, repeated and clashing rows go by their own text; two texts of one id are judged apart."""
    import corpus_pipeline as pipeline

    d = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    some = given.join(labels, "doc_id")
    good, bad = (some.filter(f"quality = {q}").orderBy("doc_id").first()["text"] for q in (1, 0))
    extra = spark.createDataFrame([(5, good, "r1"), (5, bad, "r2"), (5, good, "r1"), (None, bad, "r3"), (None, good, "r4"), (6, None, "r5"), (7, "", "r6")], "doc_id long, text string, row string")
    docs = given.select("doc_id", "text", F.lit("given").alias("row")).unionByName(extra)
    kept = pipeline.quality(spark, docs, d)
    assert kept.schema == docs.schema
    empty = line_crf.classify(docs, labels).filter("doc_id = 6").first()["predicted"]
    got = collections.Counter(r["row"] for r in kept.filter("row != 'given'").collect())
    assert got == collections.Counter({"r1": 2, "r4": 1} | ({"r5": 1, "r6": 1} if empty else {}))
    assert pipeline.quality(spark, docs.limit(0), d).count() == 0
