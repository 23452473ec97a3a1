"""The corpus pipeline: quality rules, near duplicates, decontamination, source mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again as the next stage's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import contamination, mixing, near, quality, tokens
from tablewright.llm.common import stored
from tablewright.registry.common import load


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.kept_only(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return contamination.clean_only(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with raked shares of sources, languages and topics."""
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' documents, read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID output", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name.replace(' ', '_')}")
    return docs


#: Tokenizing has no counterpart in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None
