"""A corpus cleaned and packed in five stages, each one of the operators in `shelfsense.llm`.

`run(spark, sf_dir)` applies the stages to `documents`; what a stage returns is written as Parquet
and read back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfsense.llm import queries
from shelfsense.llm.common import new_path
from shelfsense.sources.tables import table

STAGES = queries.STAGES
#: Scores of a fitted classifier and tokenizer ids have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents` of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
