"""A corpus pipeline: each stage works on all that the stage before it kept.

A stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is written as
Parquet and read again as the next one's documents. All stages but the last return the columns of
documents. Rows without text or ID, repeated rows and further columns are handled as the operators'
modules say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import decontaminate, language_id, packing, pii_crf, simhash
from riskloom.llm.queries import remainder_of_id, ship, table, tokenizer_path
from riskloom.session import fresh_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents without a letter or of no learned language."""
    ship(spark)
    models = language_id.fit(docs, remainder_of_id() != 0)
    return language_id.accepted(docs, models)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    ship(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that hold a window of the benchmark."""
    return decontaminate.remove(docs, table(spark, folder, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Puts its kind in place of each span of personal data."""
    ship(spark)
    return pii_crf.redacted(docs, pii_crf.fitted())


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of the documents with their sequence and place."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack),
]

#: No SQL: trained models and a tokenizer are not expressible in it.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Applies the stages to documents, each written to the shared folder."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, folder)
