from pyspark.sql import functions as F

from shelfsense.sources import tables


def task_sizes(df):
    sizes = df.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count("*").alias("n"))
    return [r["n"] for r in sizes.collect()]


def test_a_large_row_group_is_dealt_over_tasks(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    rows = rows.withColumn("doc_id", F.when(F.col("doc_id") % 50 > 0, F.floor(F.col("doc_id") / 2)))  # null and repeated keys
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    read = tables.text_table(spark, str(tmp_path), "documents", "doc_id")
    assert max(task_sizes(read)) < 2500
    assert sorted(map(str, read.collect())) == sorted(map(str, rows.collect()))


def test_few_rows_are_read_as_they_are(spark, tmp_path):
    spark.range(500).select(F.col("id").alias("doc_id")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert task_sizes(tables.text_table(spark, str(tmp_path), "documents", "doc_id")) == [500]
