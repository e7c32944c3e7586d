"""Star-schema tables and the review view on top of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A scan task with more rows than this is worth splitting.
COARSE_ROWS = 1000
TASKS_PER_CORE = 3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table with much text per row, dealt by its key where its files are split too coarsely.

    A row group is one task, however large. Where fewer tasks than cores have rows, these are dealt before the
    work on their text. Who reads such files may also name a number of partitions in
    `spark.shelfsense.scan.partitions`.
    """
    rows = table(spark, folder, name)
    wanted = spark.conf.get("spark.shelfsense.scan.partitions", None)
    if wanted:
        return rows.repartition(int(wanted), key)
    return rows.repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, key) if _coarse(rows, key) else rows


def _coarse(rows: DataFrame, key: str) -> bool:
    """Whether few scan tasks hold many rows each; only the key column is read."""
    tasks = rows.select(key).withColumn("_task", F.spark_partition_id()).groupBy("_task").agg(F.count("*").alias("n"))
    found = tasks.agg(F.count("*").alias("tasks"), F.max("n").alias("largest")).first()
    return found["tasks"] < rows.sparkSession.sparkContext.defaultParallelism and (found["largest"] or 0) > COARSE_ROWS


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews without their text: who rated which product, for graph and rating work."""
    lineitem = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    part = table(spark, folder, "part")
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("p_partkey") == F.col("l_partkey"))
        .select(
            F.col("l_partkey").alias("product_id"),
            F.col("o_custkey").alias("customer_id"),
            F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("product_title"),
            F.ceil(F.col("l_quantity") / 10).cast("double").alias("star_rating"),
            F.col("p_type").alias("product_category"),
            F.col("l_orderkey").alias("ord1"),
            F.col("l_linenumber").alias("ord2"),
        )
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Review texts: (text_id, text)."""
    return text_table(spark, folder, "documents", "doc_id").select(F.col("doc_id").alias("text_id"), "text")


def reviews_by_text(spark: SparkSession, folder: str) -> DataFrame:
    """One review per order line, its text named by `text_id`; the line's key chooses it."""
    n_texts = table(spark, folder, "documents").agg(F.count("*")).scalar()
    return interactions(spark, folder).withColumn("text_id", (F.col("ord1") * 7 + F.col("ord2")) % n_texts)


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The same reviews with their text in `review_body`."""
    return with_bodies(reviews_by_text(spark, folder), texts(spark, folder))


def with_bodies(reviews: DataFrame, texts: DataFrame) -> DataFrame:
    """Attach the texts."""
    return reviews.join(texts.withColumnRenamed("text", "review_body"), "text_id").drop("text_id")
