"""Small relational building blocks shared by the domain operators."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.session import cut_lineage, shuffle_partitions

# So many rows of every task may be merged in one place.
MERGED_ROWS = 10_000
# A table with at most this many rows of a few plain columns is small enough to broadcast.
BROADCAST_ROWS = 100_000


def broadcast_if_bounded(df: DataFrame, rows: int | None) -> DataFrame:
    """Hint a broadcast only where the caller knows a row bound and the bound is small.

    Without a bound the choice stays with the optimiser, which compares real sizes at run time.
    """
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in the given columns, or in any column."""
    return df.dropna("any", subset=list(columns) if columns else None)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    The filter on the row number lets Spark cut each key to one row per map task before the
    shuffle, so a key with very many rows does not end up in one task.
    """
    return top_k_per_group(df, keys, order, 1, "_row").drop("_row")


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first `k` rows of every group with their rank, cut to `k` per map task first."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def first_rows(df: DataFrame, n: int, order: Sequence[Column], merged_rows: int = MERGED_ROWS) -> DataFrame:
    """The first `n` rows in an explicit order, which must name every row apart.

    Up to `merged_rows` rows, every task keeps its first n and one task merges these. More rows are
    selected by ranges: rows are dealt by sampled splitters of the order, whole ranges are kept as long
    as their sizes add up to n, and only the range where the n-th row lies is numbered and cut.
    """
    if n <= merged_rows:
        return df.orderBy(*order).limit(n)
    ranges = shuffle_partitions(df.sparkSession)
    dealt = cut_lineage(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size"))  # a row for each range
    before = F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    left = sizes.withColumn("_left", F.lit(n) - F.coalesce(before, F.lit(0))).filter("_left > 0")
    kept = dealt.join(left, "_range")
    whole = kept.filter("_size <= _left")
    cut = kept.filter("_size > _left").withColumn("_row", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return whole.select(*df.columns).unionByName(cut.filter("_row <= _left").select(*df.columns))


def without_keys(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` whose keys do not occur in `seen`."""
    return df.join(seen.select(*keys), list(keys), "left_anti")


def concat_sources(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column that a source lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def value_counts(df: DataFrame, column: str, count: str = "documents") -> DataFrame:
    """Rows per value of a column, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(count))
    return counts.orderBy(F.desc(count), F.asc(column))


def chart_order(counts: DataFrame, count: str = "documents") -> DataFrame:
    """Counts in ascending order, as a bar chart lists them from below."""
    return counts.orderBy(count)


def position_in_group(
    df: DataFrame, group: str, id_col: str, seed: int = 42, rows_per_bucket: int = 50_000
) -> DataFrame:
    """Add `position` (1, 2, …) of every row within its group, in the order of a hash of its id.

    A plain row number would sort a whole group in one task. Here the range of the 63-bit hash is
    cut into buckets of about `rows_per_bucket` rows: rows are numbered inside (group, bucket), and the
    sizes of the earlier buckets of the group are added. Hash values spread evenly, so the buckets of
    a hot group are small, and they depend on the id only, so a recomputed task gives the same numbers.
    """
    bits = max(1, math.ceil(math.log2(df.select(id_col).count() / rows_per_bucket + 1)))
    hashed = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 1)
    bucketed = df.withColumn("_key", hashed).withColumn("_bucket", F.shiftright("_key", 63 - bits))
    sizes = bucketed.groupBy(group, "_bucket").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(group).alias("_group"),
        F.col("_bucket").alias("_offset_bucket"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy(group)).alias("group_size"),
    )
    inside = Window.partitionBy(group, "_bucket").orderBy("_key", id_col)
    return (
        bucketed.withColumn("_row", F.row_number().over(inside))
        .join(
            offsets,
            F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_offset_bucket")),
        )
        .withColumn("position", F.col("_row") + F.col("_offset"))
        .drop("_key", "_bucket", "_row", "_offset", "_group", "_offset_bucket")
    )
