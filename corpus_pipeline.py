"""A training corpus from raw documents, in stages that are written one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and works on what the stage before
has kept. All but the last return the columns of ``docs``; the last returns the
blocks of the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import decontam, exact, mixture, neardup, quality
from farelake.llm.queries import PASS
from farelake.llm.scratch import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier passes; without labels all of them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit_from_labels(docs, labels)
    score = "score"
    while score.lower() in {c.lower() for c in docs.columns}:
        score += "_"
    scored = quality.score_quality(docs, model, score=score)
    return scored.where(F.col(score) >= PASS).drop(score)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_exact_duplicates(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, 80 %."""
    return neardup.drop_near_duplicates(docs, neardup.Similarity(words=5, percent=80))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.drop_contaminated(docs, items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The blocks of the mix, with the documents in each."""
    return mixture.mixed_blocks(mixture.mix_sources(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("exact dedup", keep_first_copies),
    ("near dedup", keep_one_of_each_group),
    ("decontamination", keep_uncontaminated),
    ("mixing sources", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


#: No SQL expresses the classifier; the tests hold the stages against brute force.
ORACLE_SQL = None
