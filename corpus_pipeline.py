"""A training-data pipeline: documents that a quality classifier keeps, without repeated line chunks, near-duplicates and benchmark passages, as token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textloom.llm import bpe, common, decontaminate, jaccard, linededup, quality


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or above; it learns from the labels outside the held-out fold."""
    model = quality.learn(docs, common.table(spark, sf_dir, "labels"), common.fold(4) != 2)
    return quality.score(docs, model).where("predicted = 1").select(*[f"`{c}`" for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, all but the first; documents of which nothing is left go too."""
    return linededup.dedup_lines(docs, drop_emptied=True)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.without(docs, common.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every whole text, beside its columns."""
    return bpe.stage(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", dedup_lines),
    ("n-gram jaccard join", dedup_documents),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", encode),
]

#: Learned scores, hashes of lines and vocabularies are beyond SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.shared_folder(spark)
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = common.written(stage(spark, docs, sf_dir), f"{folder}/stage{i}")
    return docs
