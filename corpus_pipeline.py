"""The corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator of ``marginalia.llm`` on everything its
predecessor kept; :func:`run` writes each stage's documents to the shared
folder and rereads them, so a lost executor never costs a finished stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marginalia.llm import decontamination, packing, quality, simhash_dedup, suffix_dedup  # noqa: E402
from marginalia.llm.common import clear_steps, crc_part, ship_package, steps_written, table, write_shared  # noqa: E402


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; null texts are judged as empty ones, other columns are kept as they are."""
    ship_package(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.keep_good(docs, labels, crc_part("doc_id", 5) != 0, threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays; null and empty texts are one group, an empty table stays empty."""
    ship_package(spark)
    return simhash_dedup.keep_one(docs, width=3, max_bits=3)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 or more that occur again are cut out; every document stays, a null text stays null."""
    ship_package(spark)
    return suffix_dedup.without_repeats(docs, length=200)


def benchmark_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go; those without words are clean."""
    ship_package(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), size=13, min_share=0.05)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of at most 1024 tokens; a null or empty text is its closing id."""
    ship_package(spark)
    return packing.pack(docs, capacity=1024, end_id=0).drop("class")


STAGES = [
    ("quality", quality_filter),
    ("simhash_near_dedup", near_dedup),
    ("suffix_dedup", repeat_removal),
    ("decontamination", benchmark_removal),
    ("packing", pack_sequences),
]

#: Fitted classifiers, tokenizers and suffix indexes have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents; the result is the packing's pieces."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        mark = steps_written()
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_shared(docs, f"stage-{name}")
            clear_steps(spark, mark, keep=docs)  # the stage's own steps have been read
    return docs
