"""A training corpus in four stages: quality, near duplicates, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from drivegauge.llm import jaccard_join, line_crf, packing, suffix_dedup
from drivegauge.llm.base import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field calls good; the others go. Each row is judged by its own text, whatever its id."""
    return line_crf.good_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the least id stays; rows without id stay."""
    return jaccard_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier document holds in a run of fifty; what is left of a cut character goes.

    ``n_chars`` is counted again; documents of which nothing is left go.
    """
    return suffix_dedup.shortened(docs, length_col="n_chars")


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest as pieces of at most 4096 tokens, placed in sequences."""
    return packing.pack(docs, tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("best_fit", best_fit)]
#: SQL can express neither the trained field nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
