from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.operators import fields, index, packed, recommend, search, segments, state
from shelfsense.sources.store import Store

REVIEW = "product_id long, customer_id long, product_title string, text_id long, ord1 int, ord2 int"


@pytest.fixture(scope="module")
def shared(spark):
    texts = [(0, "a b a c"), (1, "b d"), (2, None), (3, "e e a"), (4, "never used"), (None, "a")]
    rows = [(p, 1, f"title {p}" if p % 2 else None, (p * 3 + i) % 4, i, 1) for p in range(1, 9) for i in range(p)]
    rows += [(None, 1, "a title", 0, 0, 1), (3, 1, "title 3", None, 9, 1)]
    return index.build_index_of_shared_texts(
        spark.createDataFrame(rows, REVIEW), spark.createDataFrame(texts, "text_id long, text string")
    )


def rows(df):
    return sorted(map(str, df.collect()))


def test_lists_come_back_from_their_packed_form():
    numbers, counts = np.array([0, 3, 4, 1 << 40]), np.array([1, 2, 1 << 35, 7])
    again = packed.unpack(packed.pack(numbers, counts))
    assert [column.tolist() for column in again] == [numbers.tolist(), counts.tolist()]


def test_term_statistics_of_shared_texts_need_no_posting_rows(shared):
    plain = index.term_stats(replace(shared, shared=None))
    broken = shared.postings.withColumn("tf", F.raise_error(F.lit("a row for each term and product")).cast("long"))
    assert rows(index.term_stats(replace(shared, postings=broken))) == rows(plain)


@pytest.mark.parametrize("part_texts", [1, 2, 100])
def test_documents_in_parts_have_the_words_of_whole_ones(spark, shared, part_texts, monkeypatch):
    monkeypatch.setattr(packed, "PART_TEXTS", part_texts)
    numbers, _ = shared.shared.packed()
    in_text = shared.shared.texts.filter("text_id is not null").groupBy("text_id", "term").agg(F.sum("n").alias("n"))
    own = shared.shared.own.groupBy("product_id", "term").agg(F.sum("n").alias("n"))
    docs = packed.documents(
        packed.lists(in_text, numbers, "text_id"), shared.shared.uses, "product_id", "text_id",
        packed.lists(own, numbers, "product_id"), part_texts,
    )
    names = {r["number"]: r["term"] for r in numbers.collect()}
    got = [(names[n], r["product_id"], c) for r in docs.collect() for n, c in zip(*map(np.ndarray.tolist, packed.unpack(r["words"])))]
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in shared.postings.collect())


@pytest.mark.parametrize("block", [1, 256])
def test_a_batch_search_of_shared_texts_needs_no_posting_rows(spark, shared, block, monkeypatch):
    monkeypatch.setattr(packed, "QUERIES_AT_ONCE", block)
    monkeypatch.setattr(packed, "DOCS_AT_ONCE", 2)
    monkeypatch.setattr(packed, "PAIRS_HELD", 3)
    texts = ["a b", "title", "e a e", "no such words here", "", None]
    queries = spark.createDataFrame(list(enumerate(texts)) + [(None, "d 3")], "query_id long, query string")
    plain = search.bm25_search(replace(shared, shared=None), queries, top_k=3).withColumn("bm25", F.round("bm25", 9))
    monkeypatch.setattr(search, "FEW_TERMS", 0, raising=False)
    broken = shared.postings.withColumn("tf", F.raise_error(F.lit("a row for each term and product")).cast("long"))
    batch = search.bm25_search(replace(shared, postings=broken), queries, top_k=3).withColumn("bm25", F.round("bm25", 9))
    assert rows(batch) == rows(plain)


def product_reviews(spark):
    titles = {1: "Lens cap", 2: "lens", 3: None, 4: "Blue bag", 5: "bag strap", 6: "lens cap"}
    rows = [(p, 1, titles[p], (p * 2 + i) % 5, i, 1) for p in titles for i in range(p % 3 + 1)] + [(7, 1, "lens", 99, 0, 1)]
    texts = [(0, "good lens cap"), (1, "strap and bag"), (2, None), (3, "blue blue lens"), (4, "cap"), (0, "good lens cap"), (None, "lens")]
    return spark.createDataFrame(rows, REVIEW), spark.createDataFrame(texts, "text_id long, text string")


def vectors_as_rows(packed_vectors):
    long = packed_vectors.rows().join(packed_vectors.terms, "number").select("product_id", "term", F.round("weight", 9).alias("weight"))
    return rows(long)


def test_packed_vectors_are_those_of_whole_texts(spark):
    reviews, texts = product_reviews(spark)
    bodies = reviews.join(texts.withColumnRenamed("text", "review_body"), "text_id")
    first = recommend.first_reviews(reviews)
    whole = recommend.first_review_vectors(first.join(texts.withColumnRenamed("text", "review_body"), "text_id"), 4)
    assert vectors_as_rows(recommend.first_shared_text_vectors(first, texts, 4)) == rows(whole.select("product_id", "term", F.round("weight", 9).alias("weight")))
    known = reviews.join(texts.select("text_id").distinct(), "text_id", "left_semi")
    whole = recommend.all_review_vectors(bodies, 3)
    assert vectors_as_rows(recommend.all_shared_text_vectors(known, texts, 3)) == rows(whole.select("product_id", "term", F.round("weight", 9).alias("weight")))


def test_packed_vectors_give_the_same_recommendations(spark):
    reviews, texts = product_reviews(spark)
    first = recommend.first_reviews(reviews)
    titles, targets = index.first_titles(reviews), spark.createDataFrame([(1,), (4,), (7,), (50,)], "product_id long")
    whole = recommend.first_review_vectors(first.join(texts.withColumnRenamed("text", "review_body"), "text_id"))
    lists = [rows(recommend.content_recommendations(v, titles, targets, 3)) for v in (whole, recommend.first_shared_text_vectors(first, texts))]
    assert lists[0] == lists[1]


def test_a_published_index_serves_many_terms_from_whole_documents(spark, shared, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "state"))
    state.publish(store, shared, buckets=2)
    served = state.Snapshot(store).index()
    assert rows(served.postings.select("term", "product_id", "tf")) == rows(shared.postings)
    queries = spark.createDataFrame([(1, "a b title"), (2, "e")], "query_id long, query string")
    plain = search.bm25_search(replace(served, shared=None), queries, top_k=3).withColumn("bm25", F.round("bm25", 9))
    monkeypatch.setattr(search, "FEW_TERMS", 0, raising=False)
    broken = served.postings.withColumn("tf", F.raise_error(F.lit("postings are read")).cast("long"))
    batch = search.bm25_search(replace(served, postings=broken), queries, top_k=3).withColumn("bm25", F.round("bm25", 9))
    assert rows(batch) == rows(plain)


def few_texts_of_many_products(spark, first=0):
    """60 products with the same two texts of 40 words, so rows by term and product are many more than words of texts."""
    texts = [(0, " ".join(f"w{i}" for i in range(40))), (1, " ".join(f"w{i}" for i in range(20, 60))), (2, None)]
    rows = [(first + p, 1, f"title {p}" if p % 2 else None, t, t, 1) for p in range(60) for t in (0, 1, p % 3)]
    return index.build_index_of_shared_texts(
        spark.createDataFrame(rows, REVIEW), spark.createDataFrame(texts, "text_id long, text string")
    )


def stored_rows(store):
    version = store.latest()
    return sum(store.spark.read.parquet(f"{store.path}/{folder}").count() for folders in version.tables.values() for folder in folders)


def test_a_published_index_of_shared_texts_stores_no_row_for_each_term_and_product(spark, tmp_path):
    built = few_texts_of_many_products(spark)
    store = Store(spark, str(tmp_path / "state"))
    state.publish(store, built, buckets=2)
    served = state.Snapshot(store).index()
    assert rows(served.postings.select("term", "product_id", "tf")) == rows(built.postings)
    assert stored_rows(store) < built.postings.count() / 5
    without_titles = replace(built, shared=replace(built.shared, own=built.shared.own.limit(0)))
    state.publish(store, without_titles, buckets=2)
    assert rows(state.Snapshot(store).index().shared.terms()) == rows(spark.createDataFrame([(f"w{i}",) for i in range(60)], "term string"))


def test_segments_of_shared_texts_store_no_row_for_each_term_and_product(spark, tmp_path):
    kept = segments.SegmentedIndex(Store(spark, str(tmp_path / "store")), buckets=2, fanout=2)
    one, two = few_texts_of_many_products(spark), few_texts_of_many_products(spark, first=50)
    kept.append(one)
    assert stored_rows(kept.store) < one.postings.count() / 5
    kept.append(two)  # replaces ten products, and the two segments are merged
    kept.remove(spark.createDataFrame([("0",), ("70",)], "product_id string"))
    live = one.postings.filter("product_id < 50 and product_id > 0").unionByName(two.postings.filter("product_id <> 70"))
    expected = live.select("term", F.col("product_id").cast("string").alias("product_id"), "tf")
    assert len(kept.segments(kept.store.latest())) == 1
    assert rows(kept.read().postings.select("term", "product_id", "tf")) == rows(expected)


def test_the_terms_of_a_collection_are_counted_without_posting_rows(spark, shared):
    broken = shared.postings.withColumn("term", F.raise_error(F.lit("a row for each term and product")).cast("string"))
    reviews, edges = spark.range(7), spark.range(3)
    plain = index.index_summary(replace(shared, shared=None), reviews, edges)
    assert rows(index.index_summary(replace(shared, postings=broken), reviews, edges)) == rows(plain)


def test_a_search_over_fields_spreads_words_of_the_query_only(spark, shared):
    reviews = spark.createDataFrame([(p, 1, f"title {p}", (p * 3 + i) % 4, i, 1) for p in range(1, 9) for i in range(p)], REVIEW)
    texts = spark.createDataFrame([(0, "a b a c"), (1, "b d"), (2, None), (3, "e e a")], "text_id long, text string")
    built = fields.product_fields(reviews, texts)
    queries = spark.createDataFrame([(1, "a d title"), (2, "e")], "query_id long, query string")
    settings = {"title": fields.Field(3.0, 0.3), "body": fields.Field()}
    hits = lambda i: rows(fields.fielded_search(i, queries, settings).withColumn("score", F.round("score", 9)))
    broken = replace(built, postings=built.postings.withColumn("tf", F.raise_error(F.lit("all words are spread")).cast("long")))
    assert hits(broken) == hits(replace(built, of_terms=None)) and hits(broken)


def test_a_fused_search_and_an_evaluation_search_once(spark, monkeypatch, tmp_path):
    from shelfsense.plans import queries as plans

    # Of a hit that is made anew for each reader, the readers would see different scores.
    hits = spark.createDataFrame([(1, 7, 1), (1, 8, 2)], "query_id int, product_id long, rank int").withColumn("bm25", F.rand() + 1)
    monkeypatch.setattr(search, "bm25_search", lambda *a, **k: hits)
    ranks = spark.createDataFrame([(7, 0.5)], "id long, rank double")
    documents = spark.createDataFrame([(7, "t", 1.0, "c"), (8, None, None, None)], "product_id long, product_title string, star_rating double, product_category string")
    found = search.fused_search(index.TextIndex(hits, hits, hits), None, ranks, documents, alpha=1.0)
    assert rows(found.select("product_id", "bm25", "combined")) == rows(found.select("product_id", "bm25", "combined"))
    assert max(r["combined"] for r in found.collect()) == 1.0
    monkeypatch.setattr(plans, "interactions", lambda *a: spark.createDataFrame([(7, 1, "small ring", 1.0, "c", 1, 1)], "product_id long, customer_id long, product_title string, star_rating double, product_category string, ord1 int, ord2 int"))
    monkeypatch.setattr(plans, "_product_index", lambda *a: None)
    monkeypatch.setattr(plans.graph, "pagerank", lambda *a: ranks)
    runs, qrels, _ = plans._rankings(spark, "")
    assert rows(runs) == rows(runs) and rows(qrels.select("doc_id").distinct()) == ["Row(doc_id=7)"]
    assert not any("rand" in line for line in runs._jdf.queryExecution().optimizedPlan().toString().splitlines())


def test_documents_of_many_uses_are_made_slice_by_slice(spark, shared, monkeypatch):
    whole, plain = rows(shared.shared.packed()[1]), rows(index.term_stats(replace(shared, shared=None)))
    reviews, texts = product_reviews(spark)
    vectors = vectors_as_rows(recommend.all_shared_text_vectors(reviews, texts, 3))
    monkeypatch.setattr(packed, "SLICE_USES", 5)
    released = []
    monkeypatch.setattr(packed, "release_shuffles", lambda session: released.append("documents"))
    monkeypatch.setattr(index, "release_shuffles", lambda session: released.append("counts"))
    docs = shared.shared.packed()[1]
    assert len(rows(docs)) == len(whole) and len(released) > 1
    assert rows(index.term_stats(shared)) == plain and released.count("counts") > 1
    assert vectors_as_rows(recommend.all_shared_text_vectors(reviews, texts, 3)) == vectors


def test_packed_vectors_are_published_and_served(spark, tmp_path):
    reviews, texts = product_reviews(spark)
    vectors = recommend.first_shared_text_vectors(recommend.first_reviews(reviews), texts)
    titles, targets = index.first_titles(reviews), spark.createDataFrame([(1,), (4,), (50,)], "product_id long")
    store = Store(spark, str(tmp_path / "state"))
    state.publish(store, vectors=spark.createDataFrame([(1, "lens", 1.0)], "product_id long, term string, weight double"), titles=titles)
    assert state.Snapshot(store).vectors().count() == 1
    state.publish(store, vectors=vectors)
    served = state.Snapshot(store)
    lists = [rows(recommend.content_recommendations(v, served.table("titles"), targets, 3)) for v in (vectors, served.vectors())]
    assert lists[0] == lists[1] and "vectors" not in served.version.tables
