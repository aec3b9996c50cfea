"""Token counts through a digest cache.

Content is normalised (null becomes the empty text) and named by its SHA-256; the tokenizer's version is the SHA-256
of its file. Counts already stored under both digests are joined; of the others each distinct content is encoded
once, and its count is appended to the cache. Where most content is known, only digests are shuffled; otherwise each
text goes through one exchange, by the id and digest of its row, so that copies of one text never meet in a task.

Cases: null text counts as empty (0 bytes, 0 tokens); empty table gives an empty result; repeated rows each get a row;
equal texts have equal counts; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import claim, map_batches, materialize, texts
from .chunks import SPLIT, Memo

_STATE: dict = {}


class LibraryCounter:
    """Counts as the ``tokenizers`` library gives them, each distinct chunk being encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = Memo(self._library)

    def _library(self, pieces: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def counts(self, rows: list[str]) -> list[int]:
        split = [SPLIT.findall(t) if not any(s in t for s in self.special) else None for t in rows]
        self.memo.prepare(set().union(*(c for c in split if c)))
        get = self.memo.__getitem__
        return [sum(map(get, c)) if c is not None else len(self.tokenizer.encode(t, add_special_tokens=False)) for t, c in zip(rows, split, strict=True)]


def version(path: str) -> str:
    """The tokenizer's version digest."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, n_bytes`` of each row."""
    return docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))


def token_counts(df: DataFrame, tokenizer_path: str, cache_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row; appends what the cache at ``cache_path`` lacks."""
    spark = df.sparkSession
    tag = version(tokenizer_path)
    docs = texts(df, id_col, text_col)
    keys = materialize(digests(docs), "token-keys")
    schema = "tokenizer string, digest binary, n_tokens long"
    spark.createDataFrame([], schema).write.mode("append").parquet(cache_path)  # so that an empty cache can be read
    stored = spark.read.schema(schema).parquet(cache_path).filter(F.col("tokenizer") == tag)
    misses = keys.join(stored.select("digest"), "digest", "left_anti")
    chosen = materialize(misses.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "token-misses")
    side = chosen.hint("merge")  # grows with the input, so it is never broadcast: the same plan at every size
    keyed = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    on = keyed["doc_id"].eqNullSafe(side["doc_id"]) & (keyed["digest"] == side["digest"])
    todo = keyed.join(side, on, "left_semi")

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        claim("token_counts", _STATE.clear)
        counter = _STATE.get(tokenizer_path) or _STATE.setdefault(tokenizer_path, LibraryCounter(tokenizer_path))
        counts = counter.counts(batch.column(1).to_pylist())
        return pa.record_batch([pa.array([tag] * len(counts), pa.string()), batch.column(0).cast(pa.binary()), pa.array(counts, pa.int64())], ["tokenizer", "digest", "n_tokens"])

    found = map_batches(todo.select("digest", "text"), encode, schema).groupBy("tokenizer", "digest").agg(F.max("n_tokens").alias("n_tokens"))  # rows repeated as a whole
    found.write.mode("append").parquet(cache_path)
    counts = spark.read.schema(schema).parquet(cache_path).filter(F.col("tokenizer") == tag).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return keys.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
