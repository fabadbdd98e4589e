"""A training corpus from documents: five stages, each over all rows that the one before kept.

quality (op 5) drops documents that the classifier, learned from labels that are not held out, scores
below 0.5; near_dup (op 3) keeps one document of each group of near copies (five-word shingles, similarity
0.8); decontaminate (op 7) drops documents that hold a benchmark window; mix (op 9) repeats or leaves whole
documents so that sources come to their target sizes; tokens (op 6) writes the token files and reads them
back. Every stage but the last returns the columns of documents. A stage's result is written as Parquet and
read again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.llm import decontaminate, mixing, near_dup, quality, token_files
from prismcube.llm.common import Scratch, read


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more."""
    return quality.good_documents(docs, quality.train_on(docs, read(spark, sf_dir, "labels")))


def stage_near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.deduplicate(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window; each row is judged by its own text, whatever its id."""
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"), carry=True).filter("size(spans) = 0")
    return found.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def stage_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files say of each document."""
    return token_files.tokenise(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", stage_quality), ("near_dup", stage_near_dup), ("decontaminate", stage_decontaminate), ("mix", stage_mix), ("tokens", stage_tokens)]

#: Training, MinHash and tokenising are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    scratch, docs, before = Scratch(spark), read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
