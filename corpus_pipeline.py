"""From raw documents to packed training sequences.

Every stage works on all rows its predecessor kept and takes effect. All but the last return the
columns of ``documents``; the last returns the packed pieces. Stages are joined by Parquet tables in
the shared folder, so a lost executor costs no more than the tasks of the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hardwood.llm import exact_dedup, mixing, near_dedup, packing, quality
from hardwood.llm.common import prepared, table
from hardwood.session import remove_path, work_path, work_scope


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles and a similarity of 0.8 or more, the smallest id stays."""
    return near_dedup.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight takes it."""
    return mixing.mixture(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, and their places in sequences of 1024 tokens."""
    return packing.packed(packing.tokenised(docs)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Rules, shingles and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a stage made for itself is deleted when its table is written, its input, too."""
    docs, earlier = table(prepared(spark), sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name)
        with work_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if earlier:
            remove_path(spark, earlier)
        docs, earlier = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
