"""The corpus pipeline: quality, exact dedup, near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as
Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``. Defined for nulls, blanks, repeated rows, clashing
names and empty tables as the operators say; ids and texts of a stage that
filters are left as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import session
from eventmart.llm import exact_dedup, line_dedup, minhash_dedup, packing, quality
from eventmart.llm.common import free_name, table, text_or_empty


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    labels = quality.teaching_labels(table(spark, sf_dir, "labels"))
    model = quality.train(docs, labels)
    return docs.where(quality.scorer(model)(text_or_empty()) >= quality.ACCEPT)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five words, 0.8), one document of each group."""
    return minhash_dedup.keep_one_each(docs, percent=80, shingle=5)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    name = free_name(docs, "repeats")
    cut = line_dedup.drop_repeats(docs, result=name)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.char_length("text").cast(kind)
        is_cut = F.col(name)["n_cut"] + F.col(name)["n_passages"] > 0
        cut = cut.withColumn("n_chars", F.when(is_cut, length).otherwise(F.col("n_chars")))
    return cut.drop(name)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in full windows."""
    return packing.pack_documents(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

# Scores, signatures and tokens are not SQL's; tests/llm/test_pipeline_rows.py holds the
# rows of each stage against brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = session.work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
