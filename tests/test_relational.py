import pytest
from pyspark.sql import functions as F

from shelfsense.operators import relational


@pytest.mark.parametrize("n", [0, 1, 7, 50, 99, 100, 250])
def test_first_rows_by_ranges_are_those_of_a_sort(spark, n):
    rows = [(i * 37 % 101, None if i % 9 == 0 else i % 4, f"t{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "id long, part int, text string")
    order = [F.col("part").desc(), F.col("id").asc()]
    wanted = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:n]
    for merged in (10_000, 0):
        got = relational.first_rows(df, n, order, merged_rows=merged)
        assert got.columns == df.columns and sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))


def test_equal_keys_in_one_range(spark):
    df = spark.range(200).select((F.col("id") > 150).cast("int").alias("key"), "id")
    got = relational.first_rows(df, 120, [F.col("key"), F.col("id")], merged_rows=0)
    assert sorted(r.id for r in got.collect()) == list(range(120))
    assert relational.first_rows(df.limit(0), 5, [F.col("id")], merged_rows=0).count() == 0
