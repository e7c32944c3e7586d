import pytest

import __spark_entry__ as contract
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "csv_round_trip", "first_per_key", "preprocess", "top_bigrams", "tfidf_features", "bm25_batch",
    "pagerank_hot_customers", "fused_search", "eval_set_metrics", "content_recs_all_reviews", "page_text", "crawl_errors",
]


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    assert difference(spark, connect(FOLDER), FOLDER, name) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 30
