import math

import pytest
from pyspark.sql import functions as F

from shelfsense.operators import index, search

REVIEW = "product_id long, customer_id long, product_title string, review_body string, star_rating double, product_category string, ord1 long, ord2 int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, "a a b"), (2, "b c"), (3, "c")], "doc_id long, text string")


def queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id int, query string")


def test_bm25_by_hand(spark, docs):
    built = index.build_index(docs, "doc_id", "text", with_title=False)
    hits = {(r["query_id"], r["doc_id"]): r["bm25"] for r in search.bm25_search(built, queries(spark, "a", "a a", "zzz", "")).collect()}
    idf = math.log((3 - 1 + 0.5) / 1.5 + 1)
    score = idf * 2 * 2.5 / (2 + 1.5 * (0.25 + 0.75 * 3 / 2))
    assert hits == {(0, 1): pytest.approx(score), (1, 1): pytest.approx(2 * score)}


def test_stored_index_gives_the_same_hits(spark, docs, tmp_path):
    built = index.build_index(docs, "doc_id", "text", with_title=False)
    index.write_index(built, str(tmp_path / "index"), buckets=4)
    stored = index.read_index(spark, str(tmp_path / "index"))
    rows = lambda i: sorted(map(tuple, search.bm25_search(i, queries(spark, "a b", "c")).collect()))
    assert rows(stored) == rows(built)


def reviews(spark):
    rows = [
        (1, 7, "Red Lens", "good lens", 5.0, "camera", 1, 1),
        (1, 8, None, "bad", 2.0, None, 0, 1),
        (2, 7, "Blue Bag", "good lens", None, "bag", 2, 1),
        (3, 9, None, None, 1.0, "bag", 3, 1),
    ]
    return spark.createDataFrame(rows, REVIEW)


def test_product_documents_take_the_first_known_values(spark):
    rows = {r["product_id"]: tuple(r)[1:] for r in index.product_documents(reviews(spark)).collect()}
    assert rows == {1: ("Red Lens", 3.5, "camera"), 2: ("Blue Bag", None, "bag"), 3: (None, 1.0, "bag")}


def test_shared_texts_give_the_same_index(spark):
    full = reviews(spark)
    texts = spark.createDataFrame([(0, "good lens"), (1, "bad"), (2, None)], "text_id int, text string")
    keyed = full.withColumn("text_id", F.when(F.col("review_body") == "bad", 1).when(F.col("review_body").isNull(), 2).otherwise(0))
    left, right = index.build_index(full), index.build_index_of_shared_texts(keyed, texts)
    for name in ("postings", "doc_stats"):
        assert sorted(map(tuple, getattr(left, name).collect())) == sorted(map(tuple, getattr(right, name).collect()))
    assert {r["product_id"]: r["doc_len"] for r in left.doc_stats.collect()} == {1: 5, 2: 4, 3: 0}


def test_fusion_uses_best_of_hits_and_of_graph(spark):
    hits = spark.createDataFrame([(0, 1, 4.0, 1), (0, 2, 3.0, 2), (0, 3, 1.0, 3)], "query_id int, product_id long, bm25 double, rank int")
    ranks = spark.createDataFrame([(2, 0.2), (9, 0.4)], "id long, rank double")
    rows = search.fuse_with_ranks(hits, ranks, alpha=0.5, top_k=2).orderBy("rank").collect()
    assert [(r["product_id"], round(r["combined"], 6)) for r in rows] == [(2, 0.625), (1, 0.5)]
    none = search.fuse_with_ranks(hits, ranks.limit(0), alpha=0.5, top_k=2).orderBy("rank").collect()
    assert [(r["product_id"], r["combined"]) for r in none] == [(1, 0.5), (2, 0.375)]


def test_pseudo_relevance_equals_the_plain_comparison(spark):
    titles = [(1, "Red Ring"), (2, "herring cred"), (3, None), (4, "ring"), (5, "ri")]
    texts = ["red ring", "ring", "of", "", "ringer"]
    frame = spark.createDataFrame(titles, "product_id long, product_title string")
    got = {tuple(r) for r in search.pseudo_relevance(queries(spark, *texts), frame).collect()}
    words = [[w for w in t.split() if len(w) > 2] for t in texts]
    assert got == {
        (q, p) for q, ws in enumerate(words) for p, t in titles if all(w in (t or "").lower() for w in ws)
    }


def test_semi_join_on_query_terms_reaches_below_the_postings_aggregation(spark, docs):
    built = index.build_index(docs, "doc_id", "text", with_title=False)
    # A table of known small size, as a stored query table is too.
    terms = search.query_terms(search.queries_from_lines(spark, "a")).select("term").distinct()
    plan = built.postings.join(terms, "term", "left_semi")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
