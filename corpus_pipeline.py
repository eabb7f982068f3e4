"""Corpus pipeline: quality classifier, line dedup, near-duplicate join, benchmark decontamination and
tokenising, each over everything its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result
as Parquet into the shared folder and rereads it as the next one's documents.  All stages but the last return
the columns of ``documents``; n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm import decontaminate, jaccard_join, line_chunks, piece_bpe, resample
from shelfscope.llm.common import materialise
from shelfscope.llm.queries import good_labels, piece_model_file, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampler rejects go."""
    return resample.resample(docs.select(*COLUMNS), good_labels(spark, sf_dir)).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines are cut out; documents that consist of repeats alone go."""
    return _recounted(line_chunks.dedup_lines(docs.select(*COLUMNS), drop_emptied=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return jaccard_join.keep_one(docs.select(*COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that benchmark windows cover are cut out of the texts."""
    return _recounted(decontaminate.find_overlaps(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), cut=True))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids and their digests of every remaining text."""
    return piece_bpe.digests(piece_bpe.encode_decode(docs.select("doc_id", "text"), piece_model_file()))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("tokens", tokens),
]

#: The stages' models and merges cannot be written in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
