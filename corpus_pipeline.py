"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and returns the documents it kept
with the columns of ``documents``; the last returns the packing plan.  A
caller may write each stage's rows and read them again for the next one;
:func:`run` does so in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, lines, near_dedup, packing, quality
from ledgerlens.llm._tables import materialize

#: Not expressible as one SQL statement (automaton spans, components, boundaries).
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_quality(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later occurrences of three-line windows."""
    return lines.replace_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8."""
    return near_dedup.keep_one(docs, k=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of test items; mostly contaminated ones go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near-dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{i}")
    return docs
