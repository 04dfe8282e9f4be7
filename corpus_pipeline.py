"""The corpus pipeline: five stages, each written as Parquet and reread by the next.

The classifier and the near-duplicate search can't be put as SQL, so there is no
``ORACLE_SQL``; the tests compare ``run`` with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.llm import bpe, decontaminate, lines, neardup, quality
from siftloom.llm.common import expire, remove, scratch, table

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that more than 50 of them share, which only
    the one with the smallest id keeps. A document that loses all its lines goes."""
    clean = lines.line_dedup(docs, with_count=True)
    cut = F.col("lines_dropped") > 0
    left = clean.where(~cut | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    return left.withColumn("n_chars", F.when(cut, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.near_dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether these decode to the text."""
    return bpe.encode(docs, bpe.codec_for(docs))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage wrote goes when the next one has
    read it; the last one's result goes when the session ends."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        expire(spark, path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
