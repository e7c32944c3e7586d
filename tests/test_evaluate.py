import math

import pytest
from pyspark.mllib.evaluation import RankingMetrics

from shelfsense.operators import evaluate

RUNS = "run string, query_id int, rank int, doc_id string"


def frames(spark, retrieved, relevant):
    runs = [("r", q, i + 1, d) for q, docs in retrieved.items() for i, d in enumerate(docs)]
    qrels = [(q, d) for q, docs in relevant.items() for d in docs]
    pairs = [("r", q) for q in retrieved]
    return (
        spark.createDataFrame(runs, RUNS),
        spark.createDataFrame(qrels, "query_id int, doc_id string"),
        spark.createDataFrame(pairs, "run string, query_id int"),
    )


RETRIEVED = {0: ["a", "n", "b", "m", "o"], 1: [], 2: ["a", "b"], 3: ["a", "a", "x"], 4: ["q"]}
RELEVANT = {0: ["a", "b", "c"], 1: ["a"], 2: [], 3: ["a", "y"], 4: ["z"]}


def test_metrics_by_hand(spark):
    runs, qrels, pairs = frames(spark, RETRIEVED, RELEVANT)
    rows = {r["query_id"]: r for r in evaluate.evaluate_queries(runs, qrels, 5, pairs, digits=None).collect()}
    first = rows[0]
    idcg = sum(1 / math.log2(i + 1) for i in (1, 2, 3))
    assert first["precision"] == pytest.approx(0.4) and first["recall"] == pytest.approx(2 / 3)
    assert first["p_at_k"] == pytest.approx(0.4) and first["mrr"] == 1.0
    assert first["map"] == pytest.approx((1 + 2 / 3) / 3)
    assert first["ndcg_at_k"] == pytest.approx((1 + 1 / math.log2(4)) / idcg)
    for query in (1, 2, 4):
        assert [rows[query][name] for name in evaluate.METRICS] == [0.0] * 9
    twice = rows[3]
    assert twice["precision"] == pytest.approx(2 / 3) and twice["recall"] == pytest.approx(0.5)
    assert twice["p_at_k"] == pytest.approx(0.4) and twice["r_at_k"] == pytest.approx(1.0)


def test_set_metrics_count_a_document_once_and_divide_by_min(spark):
    runs, qrels, pairs = frames(spark, RETRIEVED, RELEVANT)
    rows = {r["query_id"]: r for r in evaluate.set_based_metrics(runs, qrels, 2, pairs).collect()}
    assert rows[3]["precision_at_k"] == pytest.approx(0.5) and rows[3]["recall_at_k"] == pytest.approx(0.5)
    assert rows[0]["average_precision"] == pytest.approx(1 / 2)


def test_agrees_with_mllib(spark):
    retrieved = {q: d for q, d in RETRIEVED.items() if q != 3}
    runs, qrels, pairs = frames(spark, retrieved, RELEVANT)
    rows = evaluate.set_based_metrics(runs, qrels, 3, pairs).collect()
    reference = RankingMetrics(spark.sparkContext.parallelize([(retrieved[q], RELEVANT[q]) for q in retrieved]))
    mean = lambda name: sum(r[name] for r in rows) / len(rows)
    assert mean("average_precision") == pytest.approx(reference.meanAveragePrecisionAt(3))
    assert mean("ndcg_at_k") == pytest.approx(reference.ndcgAt(3))
    assert mean("precision_at_k") == pytest.approx(reference.precisionAt(3))


def test_mean_and_long_form(spark):
    runs, qrels, pairs = frames(spark, RETRIEVED, RELEVANT)
    detail = evaluate.evaluate_queries(runs, qrels, 5, pairs)
    mean = evaluate.mean_metrics(detail)
    assert mean.count() == 1 and evaluate.metrics_as_rows(mean).count() == 9
    assert evaluate.mean_metrics(detail.limit(0)).collect() == []


def test_k_must_be_positive(spark):
    runs, qrels, pairs = frames(spark, RETRIEVED, RELEVANT)
    with pytest.raises(ValueError):
        evaluate.evaluate_queries(runs, qrels, 0)
