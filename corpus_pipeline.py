"""The corpus pipeline: quality rules, line dedup, near-dedup, packing; each stage one operator of ``llm``.

A stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again
as the next one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import linedup, neardup, packing, quality
from llm.tables import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep."""
    return quality.keep_good(docs).select(COLUMNS)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of 50 words; those of which no word is left go."""
    done = linedup.without_repeats(docs)
    left = (F.size("gone") == 0) | F.col("text").rlike(linedup.WORD)
    chars = F.when(F.size("gone") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return done.where(left).withColumn("n_chars", chars).select(COLUMNS)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return neardup.one_of_each(docs).select(COLUMNS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 1024 tokens."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", unrepeated_lines),
    ("near_dedup", distinct_documents),
    ("best_fit_packing", packed_sequences),
]
#: Expectation-maximisation, sketches and the tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
