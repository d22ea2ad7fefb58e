"""A training-text pipeline over the table `documents`, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on everything that the stage before has kept. All
but the last return the columns of `documents`; the last returns packed pieces.

Edge cases: a null text, or one without a letter, has no language and goes in the first stage; a null
id is an id like others, and counts as one document; null languages, sources and sizes pass through;
long texts are worked on whole; of repeated rows, which share an id, line dedup and near dedup keep or
cut all alike; an empty table gives no rows; columns beside those of `documents`, whatever their
names, pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import decontamination, language_id, line_dedup, near_dedup, packing
from lectern.llm._store import free, in_training, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told, or that look like none of the languages, go."""
    return language_id.keep_identified(docs, docs.where(in_training(F.col("doc_id"))))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; documents left without a word go."""
    lines, gone = free("n_lines", docs.columns), free("n_dropped", docs.columns)
    cut = line_dedup.dedup_lines(docs, lines_col=lines, dropped_col=gone)
    touched = F.col(gone) > 0
    size = F.when(touched, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    left = cut.where(~touched | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", size).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the least id stays."""
    return near_dedup.keep_first(docs, threshold=(80, 100))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 4096 from all documents that are left."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_near),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: SQL can't express sketches and packing; tests/llm/test_pipeline.py holds every stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage_{k}_{name.replace(' ', '_')}")
    return docs
