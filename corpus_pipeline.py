"""The corpus pipeline: each stage calls one operator on all that the stage before has kept.

Quality rules, near duplicates, repeated spans, mixing, tokens. All stages but the last return the columns of documents; each result is
written as Parquet to the folder the cluster shares and read again.
"""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from lumenframe.llm import bpe, jaccard, mixing, quality, spans
from lumenframe.llm.queries import encoded
from lumenframe.sources.package import ship
from lumenframe.sources.scratch import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality rules keep; trusted are those that the labels call good."""
    trusted = quality.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, trusted).filter("kept").select(*COLUMNS)


def duplicate_stage(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    return jaccard.keep_one(docs).select(*COLUMNS)


def span_stage(spark, docs, sf_dir):
    """Texts without the words of spans that start earlier elsewhere; documents that lose every word go."""
    kept = spans.dedup(docs).filter("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumns({"text": text, "n_chars": chars}).select(*COLUMNS)


def mixing_stage(spark, docs, sf_dir):
    """A row for each time the mix takes a document."""
    return mixing.mixed_rows(mixing.mix(docs)).select(*COLUMNS)


def token_stage(spark, docs, sf_dir):
    """Counts and digests of each row's tokens and of the text they decode to."""
    return bpe.digest(encoded(docs))


def shipped(stage):
    @functools.wraps(stage)
    def run_stage(spark, docs, sf_dir):
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", shipped(quality_stage)),
    ("n-gram Jaccard join", shipped(duplicate_stage)),
    ("substring dedup", shipped(span_stage)),
    ("mixing", shipped(mixing_stage)),
    ("BPE encoding and decoding", shipped(token_stage)),
]

#: Hashed n-grams, MinHash candidates and the tokenizer have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, "pipeline")
    return docs
