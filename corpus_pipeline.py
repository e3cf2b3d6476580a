"""Corpus cleaning pipeline over ``documents``.

STAGES run in order; each works on all its predecessor kept, which is
written as Parquet and read again in between.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from custlens.llm import decontam, jaccard_join, langid, packing, toxicity
from custlens.llm.common import Scratch, read
from custlens.llm.queries import tokenizer_path


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar calls toxic go."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def language_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or of which no language makes up half, go."""
    return langid.reject(docs, langid.fit(docs))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies stays."""
    return jaccard_join.one_per_component(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark segment go."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as power-of-two sequences (ids as little-endian uint32)."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxic_out),
    ("language_id", language_out),
    ("ngram_jaccard_join", near_duplicates_out),
    ("benchmark_decontamination", benchmark_out),
    ("packing", packed),
]

#: Learned models and iterated components: not expressible in SQL; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the whole of ``documents``; a stage's table is deleted
    when the next one is written, only the last stage's input stays."""
    docs, scratch = read(spark, sf_dir, "documents"), Scratch(spark, "corpus-pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
