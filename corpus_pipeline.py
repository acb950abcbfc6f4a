"""From raw documents to packed training sequences, by five operators in a row.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and its result
is written and read again before the next one.  All but the last give documents in the columns
they came in.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from paddockflow import scratch
from paddockflow.llm import langid, lines, overlap, packing, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, and documents that are short, repetitive or lose too much."""
    return quality.cleaned(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language can't be told; trained on the labelled ones among them."""
    return langid.kept(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of 50 words or more go, and documents that are nothing else."""
    return lines.without_repeats(docs, min_words=50)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose five-word shingles are alike by 0.8 or more."""
    return overlap.keep_one(docs, words=5, least=0.8)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens; Python workers outlive the stage, so they remember fewer words."""
    return packing.packed(docs, tokenizers.path("word_bpe_49k.json"), 4096, 1, remembered=100_000, slice_bytes=1 << 20)


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("best-fit packing", best_fit_packing),
]

#: SQL has no neural network, no minima of XXH64 orders and no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that pass every stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        after = scratch.saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        if before is not None:
            scratch.remove_saved(before)
        docs = before = after
    return docs
