"""The operators' queries over the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ball_tree, byte_bpe, filter_audit, flac, html_text, jaccard_join, line_crf, ngram_lm, packing, simhash, suffix_dedup, token_counts, warc
from .base import materialize, scratch_dir, table


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents through a cache that is new for this run."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.json"), scratch_dir(spark, "token-cache"))


def op3_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.media_features(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives tell of each page; the operator also gives archive and offset, which SQL cannot know."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.byte_bpe(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_suffixes(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents; ``n_near`` for every document whose id is divisible by 50, searched among all."""
    return simhash.count_near(materialize(simhash.edited_fingerprints(table(spark, sf_dir, "documents")), "fingerprints"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizers.path("word_bpe_49k.json"))


def op11_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_texts(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_crf, op2_token_counts, op3_flac, op4_warc, op5_byte_bpe, op6_suffix_dedup, op7_simhash, op8_jaccard_join, op9_html_text, op10_packing, op11_ngram_lm, op12_filter_audit, op13_ball_tree)}


#: Equal payloads by themselves instead of by digest.
WARC_SQL = """WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, coalesce(html, '') AS payload FROM pages),
f AS (SELECT page_id, payload_bytes, sha1(encode(payload)) AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS last_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to FROM f"""

#: All windows of fifty bytes as hexadecimal text, cut from pieces of 200 starts; the first document of each; their union as runs.
SUFFIX_SQL = """WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT doc_id, o, substr(h, 2 * o + 1, 498) AS c FROM (SELECT doc_id, h, unnest(range(0, n - 49, 200)) AS o FROM d)),
w AS (SELECT doc_id, o + q AS p, substr(c, 2 * q + 1, 100) AS s FROM (SELECT doc_id, o, c, unnest(range(0, least(200, len(c) // 2 - 49))) AS q FROM k)),
f AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s HAVING count(*) > 1),
t AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS fresh FROM w JOIN f USING (s) WHERE first_id < doc_id),
r AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM t) GROUP BY doc_id, k),
g AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM r),
x AS (SELECT doc_id, sum(b - a) AS cut, count(*) AS spans, max(b) AS tail, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS head FROM g JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(cut, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN x USING (doc_id)"""

#: All pairs that share a shingle, counted; the least id within reach by recursion.
JACCARD_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, least(len(words), 1) + 1))) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY 1),
l AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * both_have >= 80 * (p.size + q.size - both_have)),
r AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT d.doc_id, CAST(coalesce(max(n.size), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY 1"""


#: The masks of each part against all orders, as a cross product; the step of the first filter that a mask fails.
AUDIT_SQL = r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
x AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, doc_id > min(doc_id) OVER (PARTITION BY t) AS fe FROM d),
m AS (SELECT part, len(ws) < 50 AS fa, 100 * len(list_distinct(ws)) < 65 * len(ws) AS fb, 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(t) AS fc, regexp_matches(t, '[#$%&*|]') AS fd, fe, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad FROM x LEFT JOIN labels USING (doc_id)),
g AS (SELECT part, fa, fb, fc, fd, fe, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad, CAST(fa AS INT) + CAST(fb AS INT) + CAST(fc AS INT) + CAST(fd AS INT) + CAST(fe AS INT) AS k FROM m GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
p AS (SELECT a.f || b.f || c.f || e.f || h.f AS filter_order FROM l a, l b, l c, l e, l h WHERE len(list_distinct([a.f, b.f, c.f, e.f, h.f])) = 5),
s AS (SELECT g.*, filter_order, least(CASE WHEN fa THEN instr(filter_order, 'A') ELSE 9 END, CASE WHEN fb THEN instr(filter_order, 'B') ELSE 9 END, CASE WHEN fc THEN instr(filter_order, 'C') ELSE 9 END, CASE WHEN fd THEN instr(filter_order, 'D') ELSE 9 END, CASE WHEN fe THEN instr(filter_order, 'E') ELSE 9 END) AS gone FROM g, p),
t AS (SELECT s.*, step, substr(filter_order, step, 1) AS f, CASE substr(filter_order, step, 1) WHEN 'A' THEN fa WHEN 'B' THEN fb WHEN 'C' THEN fc WHEN 'D' THEN fd ELSE fe END AS fails FROM s, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, f, sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed, sum(CASE WHEN fails AND gone < step THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND k = 1 THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = step THEN bad ELSE 0 END) AS toxic_lost FROM t GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""


#: All pairs of an item and a document that share a term.
SEARCH_SQL = r"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
s AS (SELECT count(*) AS big_n, CAST(sum(len(ws)) AS BIGINT) AS big_l FROM d WHERE len(ws) > 0),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term),
x AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)) AS x FROM t, s WHERE term IN (SELECT term FROM q)),
r AS (SELECT item_id, doc_id, CAST(sum(times * w * x) AS BIGINT) AS score FROM q JOIN f USING (term) JOIN x USING (term) GROUP BY ALL HAVING sum(times * w * x) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM r QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators without a trained model, a codec, a tokenizer or hashes of their own."""
    return {"op4_warc": WARC_SQL, "op6_suffix_dedup": SUFFIX_SQL, "op8_jaccard_join": JACCARD_SQL, "op12_filter_audit": AUDIT_SQL, "op13_ball_tree": SEARCH_SQL}
