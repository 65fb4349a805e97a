from __future__ import annotations

import llm_brute as brute
import pytest
from pyspark.sql import functions as F

#: Names that the operators use inside.
CLASHING = (
    "fp text_key root node a b mask bits block shard data ids trains train score words tokens language "
    "decontamination hits counted lined votes quality n p set rule size host path blocked token length "
    "piece sequence_id offset doc label riskloom_text_key"
).split()


@pytest.fixture(scope="session")
def edge(spark):
    """The awkward documents, with further columns whose names clash."""
    return brute.edge_rows(), clashing(spark.createDataFrame(brute.edge_rows(), "doc_id long, text string").repartition(3))


@pytest.fixture(scope="session")
def no_docs(spark):
    return clashing(spark.createDataFrame([], "doc_id long, text string"))


def clashing(df):
    return df.select(F.lit("en").alias("lang"), "*", *[F.lit(7).alias(c) for c in CLASHING if c not in df.columns])
