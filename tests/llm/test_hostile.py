"""Hostile archives and pages, and columns named like the operators' own."""

import hashlib
import html.parser
import random
import time

import pytest
from pyspark.sql import functions as F

from drivegauge.llm import html_text, warc

PROSE = "A first sentence, with a comma, and a good many words behind it. Another one follows, as long as that."


def test_warc_with_false_headers(spark):
    fake = lambda length, page: f"\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\nContent-Length: {length}\r\n\r\n"
    pages = ["x" + fake("9" * 20, 1), fake(5, "1" * 25) * 40, fake(0, 3), "WARC/1.1\r\n" * 50, fake("", 4), "\r\n\r\n", "a" * 70_000, "b" * 200_000, "", None]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").withColumn("url", F.lit("http://x/WARC/1.1"))
    for sizes in ({}, {"archive": 100_000, "page": 1000}):
        path = warc.scratch_dir(spark, "warc")
        warc.write_archives(df, path, **sizes)
        got = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
        assert len(got) == len(pages) and len({r["archive"] for r in got.values()}) > 1
        for i, text in enumerate(pages):
            raw = (text or "").encode()
            assert (got[i]["record_type"], got[i]["payload_bytes"], got[i]["payload_digest"]) == ("response", len(raw), hashlib.sha1(raw).hexdigest())
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_takes_time_by_bytes():
    inner = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 50_000
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    whole = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: %d\r\n\r\n" % (len(http) + len(inner)) + http + inner + b"\r\n\r\n"
    took = time.perf_counter()
    found = warc.records_in("a", whole)
    assert time.perf_counter() - took < 2
    assert found.num_rows == 1 and found["payload_bytes"][0].as_py() == len(inner) and found["page_id"][0].as_py() == 7
    with pytest.raises(ValueError, match="breaks"):
        warc.records_in("a", whole[:-1])


def test_html_comments_and_names():
    for comment in ("<!-->", "<!--->", "<!-- a --!>", "<!-- a -- > b -->", "<!---->", "<!-- a <p>no</p> -->"):
        assert html_text.main_text(f"<p>{PROSE}</p>{comment}<p>{PROSE}</p>") == f"{PROSE}\n{PROSE}", comment
    assert html_text.main_text(f"<p>{PROSE}</p><!-- open <p>{PROSE}</p>") == PROSE
    for page in (f'<div id="promo"><p>{PROSE}</p></div>', f"<fieldset><p>{PROSE}</p></fieldset>", f'<form action=x><div id="ads">{PROSE}</div></form>', f'<div class="notice">{PROSE}</div><nav>Home</nav>'):
        assert html_text.main_text(page) == PROSE, page
    # where there is an article, noise stays out, however little there is of the one and much of the other
    for noise in ('<div class="advert"><p>{}</p></div>', "<form><p>{}</p></form>", '<div class="cookie-notice cookies">{}</div>', '<div class="sidebar">{}</div>', '<div class="comments">{}</div>'):
        assert html_text.main_text(f"<article><p>{PROSE}</p></article>" + noise.format(f"{PROSE} {PROSE}")) == PROSE, noise


class Dom(html.parser.HTMLParser):
    """A tree of lists: [tag, state of its own, children], children being nodes or (text, in link)."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.root, self.link = ["html", 0, []], False
        self.stack = [self.root]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.link = True
            return
        node = [tag, html_text.state_of(tag, " ".join(f'{k}="{v}"' for k, v in attrs)), []]
        self.stack[-1][2].append(node)
        self.stack.append(node)

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = False
        else:
            self.stack.pop()

    def handle_data(self, data):
        self.stack[-1][2].append((data, self.link))


def brute(page):
    """Every node by itself, its score summed over all blocks of text below it."""
    nodes, texts = [], []

    def walk(node, above, state):
        state = max(state, node[1])
        me = (node[0], state, above)
        nodes.append(me)
        own = []

        def flush():
            text = " ".join("".join(t for t, _ in own).split())
            if text:
                texts.append((me, text, min(len(text), len(" ".join(" ".join(t for t, k in own if k).split())))))
            own.clear()

        for child in node[2]:
            if isinstance(child, list):
                flush()
                walk(child, [*above, me], state)
            else:
                own.append(child)
        flush()

    walk(Dom(page).root, [], 0)
    path = lambda n: [*n[2], n]
    under = lambda n, t: any(x is n for x in path(t[0]))
    prose = lambda t: len(t[1]) > 80 and t[2] * 4 < len(t[1]) or not t[2] and t[1][-1] in ".!?"

    def score(n):
        points = 0
        for t in texts:
            holder, up = t[0], path(t[0])
            if holder[0] in html_text.PARAGRAPH and len(up) > 1:
                up = up[:-1]
            distance = [i for i, x in enumerate(reversed(up[-3:]), 1) if x is n]
            if distance and n[1] == holder[1] != html_text.OUT and (holder[1] != html_text.NOISY or prose(t)):
                points += (1 + t[1].count(",") + min(len(t[1]) // 100, 3)) * (1 - t[2] / len(t[1])) / distance[0]
        below = [t for t in texts if under(n, t)]
        return points, points * (1 - sum(t[2] for t in below) / max(1, sum(len(t[1]) for t in below)))

    scores = [score(n) for n in nodes]
    usable = [i for i, s in enumerate(scores) if s[0] > 0]
    if not usable:
        return ""
    at = max(usable, key=lambda i: scores[i][1] * html_text.WEIGHT[nodes[i][1]])
    best, limit = nodes[at], nodes[at][1]
    for x in reversed(path(nodes[at])):
        if x[0] in ("article", "main"):
            best = x
    best_value = next(s[1] for n, s in zip(nodes, scores, strict=True) if n is best)
    kept = []
    for n, s in zip(nodes, scores, strict=True):
        sibling = bool(n[2]) and bool(best[2]) and n[2][-1] is best[2][-1]
        last = [t for t in texts if t[0] is n]
        good = sibling and (n[0] == "p" and last and prose(last[-1]) or s[0] > 0 and s[1] >= best_value / 5)
        if n is best or n[1] <= limit and (good or n[2] and any(k is n[2][-1] for k in kept)):
            kept.append(n)
    return "\n".join(t[1] for t in texts if t[0][1] <= limit and any(k is t[0] for k in kept))


def random_page(rng):
    words = lambda n: " ".join(rng.choice(["alpha", "beta,", "gamma", "delta.", "x"]) for _ in range(n))
    names = ["", "", "", ' class="post"', ' class="sidebar"', ' id="promo"', ' class="comments"', ' class="ad"', ' role="search"']

    def node(depth):
        if depth == 0 or rng.random() < 0.35:
            text = words(rng.choice([1, 4, 30]))
            return f"<p>{f'<a>{text}</a>' if rng.random() < 0.25 else text} {words(rng.randrange(3))}</p>"
        return f"<{(tag := rng.choice(['div', 'section', 'article', 'nav', 'form', 'ul']))}{rng.choice(names)}>" + "".join(node(depth - 1) for _ in range(rng.randint(1, 4))) + f"</{tag}>"

    return "".join(node(3) for _ in range(rng.randint(1, 4)))


def test_html_scores_against_a_parsed_tree():
    rng = random.Random(8)
    for _ in range(400):
        page = random_page(rng)
        assert html_text.main_text(page) == brute(page), page


def test_stages_keep_columns_of_any_name(spark):
    """Each stage but the last gives every column back as it came, those called like its own included."""
    import corpus_pipeline as pipeline

    d, names = "/root/testdata/sf0.01", ["_near_id", "_near_md5", "row", "kept", "given", "block", "node", "text_md5", "n_removed", "n_shingles", "component_id", "digest", "a.b", "score", "prefix"]
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    good = [r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").join(spark.read.parquet(f"{d}/labels.parquet").filter("quality = 1"), "doc_id").orderBy("doc_id").limit(12).collect()]
    rows = [(i, t) for i, t in enumerate(good)] + [(50, good[0]), (51, good[1] + " " + word()), (52, f"{word()} {good[2][:120]} {word()}"), (None, good[3]), (60, None)]
    given = spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text")
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(given).select("*", F.lit(7).alias("n_chars"), *[F.concat_ws("-", F.lit(k), "doc_id").alias(k) for k in names])
    docs = docs.withColumn("_near_id", F.lit(77).cast("long"))
    for stage in (pipeline.quality, pipeline.near_duplicates, pipeline.repeated_passages):
        kept = stage(spark, docs, d)
        assert kept.dtypes == docs.dtypes, stage
        own = kept.filter("doc_id < 1000 or doc_id is null").collect()
        assert len(own) > 5
        for r in own:
            assert r["_near_id"] == 77 and all(r[k] == "-".join([k, *([str(r["doc_id"])] if r["doc_id"] is not None else [])]) for k in names[1:]), (stage, r)
