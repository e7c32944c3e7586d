"""Metrics of ranked retrieval, computed for all runs and queries in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.functions.scores import discount, f1, ideal_dcg, ratio

METRICS = ("precision", "recall", "f1", "p_at_k", "r_at_k", "f1_at_k", "mrr", "map", "ndcg_at_k")


def judged_runs(runs: DataFrame, qrels: DataFrame) -> DataFrame:
    """Runs with a relevance flag, and the number of hits down to every rank."""
    relevant = qrels.select("query_id", "doc_id").distinct().withColumn("relevant", F.lit(1))
    along = Window.partitionBy("run", "query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return (
        runs.select("run", "query_id", "rank", "doc_id")
        .join(relevant, ["query_id", "doc_id"], "left")
        .withColumn("relevant", F.coalesce("relevant", F.lit(0)))
        .withColumn("hits", F.sum("relevant").over(along))
    )


def _per_query(runs: DataFrame, qrels: DataFrame, k: int, evaluated: DataFrame | None, depth: int | None):
    """Raw counts per (run, query); `evaluated` adds pairs that retrieved nothing."""
    if k < 1:
        raise ValueError("k must be at least 1")
    hit = F.col("relevant") == 1
    top = F.col("rank") <= k
    counted = F.lit(True) if depth is None else F.col("rank") <= depth
    counts = (
        judged_runs(runs, qrels)
        .groupBy("run", "query_id")
        .agg(
            F.count("*").alias("retrieved"),
            F.sum("relevant").alias("hits"),
            F.countDistinct(F.when(hit, F.col("doc_id"))).alias("found"),
            F.sum(F.when(top, F.col("relevant")).otherwise(0)).alias("hits_at_k"),
            F.countDistinct(F.when(hit & top, F.col("doc_id"))).alias("found_at_k"),
            F.min(F.when(hit, F.col("rank"))).alias("first_hit"),
            F.sum(F.when(hit & counted, F.col("hits") / F.col("rank")).otherwise(0.0)).alias("precision_sum"),
            F.sum(F.when(hit & top, discount(F.col("rank"))).otherwise(0.0)).alias("dcg"),
        )
    )
    if evaluated is not None:
        counts = evaluated.select("run", "query_id").join(counts, ["run", "query_id"], "left").fillna(0)
    totals = qrels.groupBy("query_id").agg(F.countDistinct("doc_id").alias("n_relevant"))
    return counts.join(totals, "query_id", "left").fillna(0, ["n_relevant"])


def evaluate_queries(
    runs: DataFrame, qrels: DataFrame, k: int = 5, evaluated: DataFrame | None = None, digits: int | None = 4
) -> DataFrame:
    """Nine metrics per run and query, rounded to `digits`."""
    counts = _per_query(runs, qrels, k, evaluated, None)
    wide = counts.select(
        "run",
        "query_id",
        ratio(F.col("hits"), F.col("retrieved")).alias("precision"),
        ratio(F.col("found"), F.col("n_relevant")).alias("recall"),
        (F.col("hits_at_k") / F.lit(float(k))).alias("p_at_k"),
        ratio(F.col("hits_at_k"), F.col("n_relevant")).alias("r_at_k"),
        # fillna(0) turns a missing first hit into 0, which the guarded division maps to 0.
        ratio(F.lit(1.0), F.col("first_hit")).alias("mrr"),
        ratio(F.col("precision_sum"), F.col("n_relevant")).alias("map"),
        ratio(F.col("dcg"), ideal_dcg(F.col("n_relevant"), k)).alias("ndcg_at_k"),
    ).withColumns(
        {"f1": f1(F.col("precision"), F.col("recall")), "f1_at_k": f1(F.col("p_at_k"), F.col("r_at_k"))}
    )
    final = [F.round(name, digits).alias(name) if digits is not None else F.col(name) for name in METRICS]
    return wide.select("run", "query_id", *final)


def mean_metrics(per_query: DataFrame) -> DataFrame:
    """Mean of every metric over the queries of a run; no queries give no rows."""
    return per_query.groupBy("run").agg(*[F.avg(name).alias(name) for name in METRICS])


def metrics_as_rows(mean: DataFrame) -> DataFrame:
    """Wide metric columns as (run, metric, score) rows."""
    return mean.unpivot(["run"], list(METRICS), "metric", "score")


def set_based_metrics(runs: DataFrame, qrels: DataFrame, k: int = 10, evaluated: DataFrame | None = None) -> DataFrame:
    """The second metric family: distinct hits in the top k, and average precision at k.

    Average precision looks at the first k ranks only and divides by min(relevant, k).
    """
    counts = _per_query(runs, qrels, k, evaluated, k)
    return counts.select(
        "run",
        "query_id",
        (F.col("found_at_k") / F.lit(float(k))).alias("precision_at_k"),
        ratio(F.col("found_at_k"), F.col("n_relevant")).alias("recall_at_k"),
        ratio(F.lit(1.0), F.col("first_hit")).alias("reciprocal_rank"),
        ratio(F.col("precision_sum"), F.least(F.col("n_relevant"), F.lit(k))).alias("average_precision"),
        ratio(F.col("dcg"), ideal_dcg(F.col("n_relevant"), k)).alias("ndcg_at_k"),
    ).withColumn("f1_at_k", f1(F.col("precision_at_k"), F.col("recall_at_k")))


def as_run(hits: DataFrame, label: str, id_col: str = "product_id") -> DataFrame:
    """A ranking in the run layout (run, query_id, rank, doc_id)."""
    return hits.select(F.lit(label).alias("run"), "query_id", "rank", F.col(id_col).alias("doc_id"))


def query_run_pairs(queries: DataFrame, labels: list[str]) -> DataFrame:
    """All (run, query_id) pairs that an evaluation has to report."""
    return queries.select(F.explode(F.array(*[F.lit(label) for label in labels])).alias("run"), "query_id")
