"""Corpus pipeline: quality rules, line dedup, near-dedup, benchmark decontamination and SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs.
Line dedup edits texts and keeps every row; the others but the last keep or drop whole rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from convolake.llm.common import table, written
from convolake.llm.decontaminate import decontaminated
from convolake.llm.line_dups import without_duplicate_lines
from convolake.llm.near_dups import without_near_duplicates
from convolake.llm.pieces import piece_digests
from convolake.llm.quality import quality_filter


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_duplicate_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentence_pieces", sentence_pieces),
]

#: SQL expresses neither merge dropout nor the banded alignment.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
