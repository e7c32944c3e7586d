"""Registered queries: every operator over the whole star-schema tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.functions import html
from shelfsense.functions import text as tx
from shelfsense.operators import classify, evaluate, factors, graph, index, recommend, relational, search
from shelfsense.operators import textmining as mining
from shelfsense.session import checkpoint_dir, cut_lineage
from shelfsense.sources import files, pages
from shelfsense.sources.tables import interactions, reviews, reviews_by_text, table, texts, text_table

SEARCH_QUERIES = "small ring\nred widget\nblue bolt"
EVAL_QUERIES = "small ring\n\nwidget\n  blue bolt \nno such product"
LABELS = ["BM25", "BM25 + PageRank"]


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return text_table(spark, folder, "documents", "doc_id")


# Sources and relational operators


def reviews_profile(spark: SparkSession, folder: str) -> DataFrame:
    return reviews(spark, folder).groupBy("product_category").agg(
        F.count("*").alias("reviews"),
        F.countDistinct("product_id").alias("products"),
        F.countDistinct("customer_id").alias("customers"),
        F.sum("star_rating").alias("stars"),
        F.sum(F.length("review_body")).alias("chars"),
    )


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    layout = documents.select(
        F.col("doc_id").alias("product_id"),
        F.col("source").alias("customer_id"),
        F.concat_ws(", ", "lang", "source").alias("product_title"),
        F.col("text").alias("review_body"),
        (F.col("n_chars") % 5 + 1).cast("double").alias("star_rating"),
        F.col("lang").alias("product_category"),
    )
    path = f"{checkpoint_dir(spark)}/shelfsense-csv-{uuid.uuid4().hex}"
    files.write_csv(layout, path)
    return files.read_reviews(spark, path).select(
        "product_id", "customer_id", "product_title", F.md5("review_body").alias("body_hash"), "star_rating", "product_category"
    )


def _sources(spark: SparkSession, folder: str) -> list[DataFrame]:
    def layout(name: str, id_col: str) -> DataFrame:
        rows = table(spark, folder, name)
        return rows.select(F.lit(name).alias("source"), F.col(id_col).alias("id"), F.md5("text").alias("text_hash"))

    return [layout("documents", "doc_id"), layout("benchmark", "item_id")]


def first_rows_per_source(spark: SparkSession, folder: str) -> DataFrame:
    return files.prepare_corpus(_sources(spark, folder), 100, [F.col("id").asc()])


def last_half_per_source(spark: SparkSession, folder: str) -> DataFrame:
    """The half of each source with the larger ids, selected by ranges of the order."""
    n = table(spark, folder, "documents").count() // 2
    return files.prepare_corpus(_sources(spark, folder), n, [F.col("id").desc()], merged_rows=0)


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return _documents(spark, folder).select("doc_id", "lang").join(labels, "doc_id", "left")


def drop_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return relational.drop_incomplete(_labelled(spark, folder))


def fill_nulls(spark: SparkSession, folder: str) -> DataFrame:
    filled = _labelled(spark, folder).fillna(0, ["quality", "toxic"])
    return filled.groupBy("lang").agg(
        F.sum("quality").alias("quality"), F.sum("toxic").alias("toxic"), F.count("*").alias("documents")
    )


def unlabelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder).select("doc_id", "lang")
    return relational.without_keys(documents, table(spark, folder, "labels"), ["doc_id"])


def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return relational.value_counts(interactions(spark, folder), "product_category")


def first_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.first_reviews(interactions(spark, folder)).select("product_id", "customer_id", "ord1", "ord2")


def product_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(index.product_documents(interactions(spark, folder)), "star_rating")


# Text mining


def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return _documents(spark, folder).select(
        "doc_id",
        F.size(tx.tokens(text)).alias("tokens"),
        F.md5(F.array_join(tx.tokens(text), " ")).alias("token_hash"),
        F.size(tx.vector_tokens(text)).alias("vector_tokens"),
        F.size(tx.relevance_tokens(text)).alias("relevance_tokens"),
    )


def preprocess(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return _documents(spark, folder).select(
        "doc_id",
        F.md5(tx.preprocess(text, lemmatize=False)).alias("plain_hash"),
        F.md5(tx.preprocess(text)).alias("lemma_hash"),
    )


def known_lemmas(spark: SparkSession, folder: str) -> DataFrame:
    return mining.known_lemmas(_documents(spark, folder), "text")


def preprocess_known(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned texts with the lemmas that the collection itself knows."""
    documents = _documents(spark, folder)
    lemmas = cut_lineage(mining.known_lemmas(documents, "text"))
    cleaned = mining.preprocess_documents(documents, "doc_id", "text", lemmas=lemmas)
    return cleaned.select("doc_id", F.md5("text").alias("text_hash"))


def doc_profile(spark: SparkSession, folder: str) -> DataFrame:
    return mining.document_profile(_documents(spark, folder), "text").select("doc_id", "word_count", "char_count")


def profile_means(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(mining.profile_means(_documents(spark, folder), "text", "lang"), "mean_words", "mean_chars")


def _processed(spark: SparkSession, folder: str) -> DataFrame:
    return mining.preprocess_documents(_documents(spark, folder), "doc_id", "text")


def top_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    return mining.top_ngrams(_processed(spark, folder), "text", n=2, top_k=15)


def top_trigrams_raw(spark: SparkSession, folder: str) -> DataFrame:
    return mining.top_ngrams(_documents(spark, folder), "text", n=3, top_k=25)


def tfidf_features(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(mining.tfidf_features(_processed(spark, folder), "doc_id", F.col("text"), 20), "mean_tfidf")


def term_weights(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(mining.term_weights(_documents(spark, folder), "text", 200), "weight")


def preprocess_compare(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(mining.compare_preprocessing(_documents(spark, folder), "text"), "mean_tokens")


def feature_compare(spark: SparkSession, folder: str) -> DataFrame:
    return mining.compare_features(_processed(spark, folder), "doc_id", F.col("text"), 1000)


def classify_languages(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(classify.classify_documents(_documents(spark, folder), "doc_id", "text", "lang"), "accuracy")


# Index and search


def _product_index(spark: SparkSession, folder: str) -> index.TextIndex:
    return index.build_index_of_shared_texts(reviews_by_text(spark, folder), texts(spark, folder))


def _document_index(spark: SparkSession, folder: str) -> index.TextIndex:
    return index.build_index(_documents(spark, folder), "doc_id", "text", with_title=False)


def _queries(spark: SparkSession) -> DataFrame:
    return search.queries_from_lines(spark, SEARCH_QUERIES)


def _benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def postings(spark: SparkSession, folder: str) -> DataFrame:
    return _document_index(spark, folder).postings


def doc_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _product_index(spark, folder).doc_stats


def term_stats(spark: SparkSession, folder: str) -> DataFrame:
    return index.term_stats(_product_index(spark, folder))


def bm25_search(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(search.bm25_search(_product_index(spark, folder), _queries(spark)), "bm25")


def bm25_batch(spark: SparkSession, folder: str) -> DataFrame:
    hits = search.bm25_search(_product_index(spark, folder), _benchmark_queries(spark, folder), top_k=10)
    return _rounded(hits, "bm25")


def review_level_bm25(spark: SparkSession, folder: str) -> DataFrame:
    hits = search.bm25_search(_document_index(spark, folder), _benchmark_queries(spark, folder), top_k=10)
    return _rounded(hits, "bm25")


def index_stats(spark: SparkSession, folder: str) -> DataFrame:
    rated = interactions(spark, folder)
    edges = graph.co_review_edges(graph.co_review_graph(rated))
    return index.index_summary(_product_index(spark, folder), rated, edges)


# Graph


def _graph(spark: SparkSession, folder: str) -> graph.CoReviewGraph:
    return graph.co_review_graph(interactions(spark, folder))


def co_review_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The edge list per source product, as numbers that fix the set of its neighbours."""
    return graph.co_review_edges(_graph(spark, folder)).groupBy("src").agg(
        F.count("*").alias("neighbours"),
        F.min("dst").alias("smallest"),
        F.max("dst").alias("largest"),
        F.sum("dst").alias("id_sum"),
        F.sum(F.col("dst") * F.col("dst")).alias("id_square_sum"),
    )


def graph_stats(spark: SparkSession, folder: str) -> DataFrame:
    return graph.graph_stats(_graph(spark, folder))


def pagerank(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(graph.pagerank(_graph(spark, folder)), "rank", digits=8)


def pagerank_hot_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of a sparse graph with a hot key: orders as customers, and one customer for all parts of one brand and type."""
    rated = interactions(spark, folder)
    by_order = rated.select(F.col("ord1").alias("customer_id"), "product_id")
    hot = rated.filter(F.col("product_category") == F.lit("ECONOMY")).select(F.lit(-1).cast("long"), "product_id")
    return _rounded(graph.pagerank(graph.co_review_graph(by_order.unionAll(hot), tile_products=50)), "rank", digits=8)


def hits(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(graph.hits(_graph(spark, folder)), "hub", "authority", digits=7)


# Fusion and evaluation


def fused_search(spark: SparkSession, folder: str) -> DataFrame:
    rated = interactions(spark, folder)
    ranks = graph.pagerank(graph.co_review_graph(rated))
    return search.fused_search(
        _product_index(spark, folder), _queries(spark), ranks, index.product_documents(rated), alpha=0.7, top_k=10
    )


def pseudo_relevance(spark: SparkSession, folder: str) -> DataFrame:
    queries = search.queries_from_lines(spark, EVAL_QUERIES)
    return search.pseudo_relevance(queries, interactions(spark, folder))


def _rankings(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs of both rankings, relevance judgements, and the pairs to report."""
    rated = interactions(spark, folder)
    queries = search.queries_from_lines(spark, EVAL_QUERIES)
    # Both runs read the pool, the second one twice; it has few rows, and judgements few more.
    pool = cut_lineage(search.bm25_search(_product_index(spark, folder), queries, top_k=15))
    ranks = graph.pagerank(graph.co_review_graph(rated))
    fused = search.fuse_with_ranks(pool, ranks, alpha=0.7, top_k=None, round_before_sort=False)
    runs = evaluate.as_run(pool, LABELS[0]).unionByName(evaluate.as_run(fused, LABELS[1]))
    qrels = cut_lineage(search.pseudo_relevance(queries, rated).withColumnRenamed("product_id", "doc_id"))
    return runs, qrels, evaluate.query_run_pairs(queries, LABELS)


def eval_per_query(spark: SparkSession, folder: str) -> DataFrame:
    runs, qrels, pairs = _rankings(spark, folder)
    return evaluate.evaluate_queries(runs, qrels, k=5, evaluated=pairs)


def eval_mean(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(evaluate.mean_metrics(eval_per_query(spark, folder)), *evaluate.METRICS)


def eval_compare(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.metrics_as_rows(eval_mean(spark, folder))


def eval_set_metrics(spark: SparkSession, folder: str) -> DataFrame:
    runs, qrels, pairs = _rankings(spark, folder)
    metrics = evaluate.set_based_metrics(runs, qrels, k=10, evaluated=pairs)
    return _rounded(metrics, *[name for name in metrics.columns if name not in ("run", "query_id")])


# Recommendation


def _targets(reviews: DataFrame) -> DataFrame:
    """The most reviewed product of every category, with its busiest customer."""
    def busiest(column: str) -> DataFrame:
        counts = reviews.groupBy("product_category", column).agg(F.count("*").alias("n"))
        return counts.groupBy("product_category").agg(F.max_by(column, F.struct("n", column)).alias(column))

    return busiest("product_id").join(busiest("customer_id"), "product_category")


def content_recs(spark: SparkSession, folder: str) -> DataFrame:
    rated = reviews_by_text(spark, folder)
    vectors = recommend.first_shared_text_vectors(recommend.first_reviews(rated), texts(spark, folder))
    return recommend.content_recommendations(vectors, index.first_titles(rated), _targets(rated))


def _content_all(spark: SparkSession, folder: str, top_k: int) -> DataFrame:
    rated = reviews_by_text(spark, folder)
    vectors = recommend.all_shared_text_vectors(rated, texts(spark, folder))
    return recommend.content_recommendations(vectors, index.first_titles(rated), _targets(rated), top_k)


def content_recs_all_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return _content_all(spark, folder, 5)


def user_item_mean(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(factors.user_item_ratings(interactions(spark, folder)), "rating")


def user_means(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(factors.user_means(factors.user_item_ratings(interactions(spark, folder))), "mean")


def _collaborative(spark: SparkSession, folder: str, k: int, demean: bool, top_k: int) -> DataFrame:
    rated = interactions(spark, folder)
    ratings = factors.user_item_ratings(rated)
    sizes = ratings.agg(
        F.countDistinct("customer_id").alias("users"), F.countDistinct("product_id").alias("items")
    ).first()
    limit = min(sizes["users"], sizes["items"]) if demean else sizes["items"]
    fitted = factors.item_factors(ratings, min(k, limit - 1), demean)
    seen = rated.select("customer_id", "product_id") if demean else None
    found = factors.collaborative_recommendations(fitted, _targets(rated), top_k, zero_is_unrated=not demean, seen=seen)
    return recommend.with_titles(found, index.first_titles(rated), required=not demean)


def svd_recs(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_collaborative(spark, folder, 10, True, 5), "score", digits=4)


def svd_recs_plain(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_collaborative(spark, folder, 20, False, 5), "score", digits=4)


def hybrid_recs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _targets(interactions(spark, folder))
    content = _content_all(spark, folder, 10).join(pairs.select("product_category", F.col("product_id").alias("target")), "target")
    liked = _collaborative(spark, folder, 20, False, 10).join(pairs.select("product_category", "customer_id"), "customer_id")
    return _rounded(recommend.blend(_request(content), _request(liked)), "hybrid_score")


def _request(candidates: DataFrame) -> DataFrame:
    return candidates.select(
        F.col("product_category").alias("request"), "product_id", "product_title", F.round("score", 4).alias("score")
    )


def hybrid_blend(spark: SparkSession, folder: str) -> DataFrame:
    """The blend alone: per category the best rated and the most reviewed products."""
    rated = interactions(spark, folder)
    stats = rated.groupBy("product_category", "product_id", "product_title").agg(
        F.avg("star_rating").alias("mean"), F.count("*").cast("double").alias("n")
    )

    def side(score: str) -> DataFrame:
        order = [F.round(score, 4).desc(), F.col("product_id").asc()]
        best = relational.top_k_per_group(stats, ["product_category"], order, 10)
        return _request(best.withColumn("score", F.col(score)))

    return _rounded(recommend.blend(side("mean"), side("n")), "hybrid_score")


# Pages


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return text_table(spark, folder, "pages", "page_id")


def canonical_url(spark: SparkSession, folder: str) -> DataFrame:
    canonical = html.canonical_url(F.col("url"))
    return _pages(spark, folder).select("page_id", canonical.alias("canonical"), html.url_host(canonical).alias("host"))


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    content = _pages(spark, folder).select(
        "page_id", html.visible_text(F.col("html")).alias("content"), html.page_title(F.col("html"), F.col("url")).alias("title")
    )
    return content.select("page_id", F.md5("content").alias("content_hash"), F.length("content").alias("content_length"), "title")


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    return pages.out_links(pages.snapshot(_pages(spark, folder)).select("url", "html"))


HOSTILE = (
    """<!-- <title>no</title><a href="/no">no</a> --><template><a href="/no">no</a></template>"""
    """<p title="a>b">it&apos;s &#9999999; caf&eacute bar &#128;&bogus;</p><a title="1>0" href="/q?x=1">link</a>"""
)


def page_hostile(spark: SparkSession, folder: str) -> DataFrame:
    """Every page with markup at its end that a careless reader gets wrong, and a title in a comment before it."""
    before = "<!-- <title>no</title><a href=/no>no</a> -->"
    markup = F.concat(F.lit(before), "html", F.lit(HOSTILE))
    links = html.page_links(markup)
    return _pages(spark, folder).select(
        "page_id",
        F.md5(html.visible_text(markup)).alias("content_hash"),
        html.page_title(markup, F.col("url")).alias("title"),
        F.size(links).cast("long").alias("n_links"),
        html.unquote_link(F.element_at(links, -1)).alias("last_link"),
    )


def page_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pages.duplicate_pages(_pages(spark, folder)).select("page_id", "copies")


def _crawl(spark: SparkSession, folder: str) -> pages.Crawl:
    stored = _pages(spark, folder)
    seeds = stored.select(F.col("page_id").alias("position"), "url")
    return pages.crawl(stored, seeds, max_depth=1, max_pages=None)


def crawl_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.crawl_summary(_crawl(spark, folder))


def crawl_errors(spark: SparkSession, folder: str) -> DataFrame:
    return _crawl(spark, folder).errors


def page_append(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of the collection after the pages were added to the reviews."""
    merged = pages.add_pages(reviews(spark, folder), _crawl(spark, folder))
    kind = F.when(F.col("customer_id").startswith("crawl:"), "page").otherwise("review")
    return merged.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("rows"),
        F.countDistinct("product_id").alias("products"),
        F.count("star_rating").alias("rated"),
        F.sum(F.length("review_body")).alias("chars"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        reviews_profile, csv_round_trip, first_rows_per_source, last_half_per_source, drop_nulls, fill_nulls, unlabelled_documents,
        category_counts, first_per_key, product_documents,
        tokenize, preprocess, known_lemmas, preprocess_known, doc_profile, profile_means, top_bigrams, top_trigrams_raw, tfidf_features,
        term_weights, preprocess_compare, feature_compare, classify_languages,
        postings, doc_stats, term_stats, bm25_search, bm25_batch, review_level_bm25, index_stats,
        co_review_neighbours, graph_stats, pagerank, pagerank_hot_customers, hits,
        fused_search, pseudo_relevance, eval_per_query, eval_mean, eval_compare, eval_set_metrics,
        content_recs, content_recs_all_reviews, user_item_mean, user_means,
        svd_recs, svd_recs_plain, hybrid_recs, hybrid_blend,
        canonical_url, page_text, page_links, page_hostile, page_dedup, crawl_pages, crawl_errors, page_append,
    )
}
