"""Review files: CSV and TSV scans with a fixed schema, and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsense.operators.relational import MERGED_ROWS, concat_sources, drop_incomplete, first_rows

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_title", T.StringType()),
        T.StructField("review_body", T.StringType()),
        T.StructField("star_rating", T.DoubleType()),
        T.StructField("product_category", T.StringType()),
    ]
)
REQUIRED = ("product_id", "review_body", "customer_id")


def read_reviews(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Reviews from CSV with a header; rows that lack an id or a text are dropped."""
    raw = spark.read.csv(paths, schema=REVIEW_SCHEMA, header=True, multiLine=True, quote='"', escape='"')
    return drop_incomplete(raw, REQUIRED)


def read_vendor_tsv(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
    """Chosen columns of a wide tab-separated file; rows that do not fit the schema are skipped."""
    reader = spark.read.option("sep", "\t").option("mode", "DROPMALFORMED").option("header", "true")
    # The parser checks a row against the columns it reads, so all are read before the choice.
    return reader.option("quote", "").option("columnPruning", "false").schema(schema).csv(path).select(*columns)


def prepare_corpus(
    sources: Sequence[DataFrame], rows_per_source: int | None, order: Sequence[Column], merged_rows: int = MERGED_ROWS
) -> DataFrame:
    """Several sources as one complete corpus, optionally the first rows of each."""
    if rows_per_source is not None:
        sources = [first_rows(source, rows_per_source, order, merged_rows) for source in sources]
    return drop_incomplete(concat_sources(*sources))


def write_csv(df: DataFrame, path: str) -> None:
    writer = df.write.mode("overwrite").option("quote", '"').option("escape", '"').option("header", "true")
    # By default the writer trims values; texts must come back as they were.
    writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def with_text_ids(reviews: DataFrame) -> DataFrame:
    """An order key for files that have none: a hash of the row, the same on every read."""
    return reviews.withColumn("ord1", F.xxhash64(*reviews.columns)).withColumn("ord2", F.lit(0))
