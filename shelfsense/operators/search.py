"""BM25 search for a table of queries, and its blend with graph scores."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.functions.scores import TIE_DIGITS, bm25_idf, bm25_weight, ratio
from shelfsense.functions.text import lines, relevance_tokens, tokens
from shelfsense.operators import packed
from shelfsense.operators.index import TextIndex, corpus_stats
from shelfsense.operators.relational import top_k_per_group
from shelfsense.session import cut_lineage

TRIGRAM = 3
FEW_TERMS = 64  # of these, shared texts are spread as rows


def queries_from_lines(spark: SparkSession, text: str) -> DataFrame:
    """Query table (query_id, query) from a multi-line text; blank lines are skipped."""
    row = spark.range(1).select(F.posexplode(lines(F.lit(text))).alias("query_id", "query"))
    return row.select("query_id", "query")


def query_terms(queries: DataFrame) -> DataFrame:
    """Terms of every query; a repeated token counts as often as it occurs."""
    return (
        queries.select("query_id", F.explode(tokens(F.col("query"))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("query_tf"))
    )


def bm25_scores(index: TextIndex, queries: DataFrame, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """BM25 score of every document that holds at least one query token.

    The semi-join on the query terms moves below the aggregation that builds the postings, so on
    a fresh index only query terms are shuffled, and on a stored one it prunes the scan. Words of shared texts
    are filtered before they are spread over the documents.
    """
    doc = index.id_col
    terms = query_terms(queries)
    wanted = terms.select("term").distinct()
    postings = index.postings
    if "bucket" in postings.columns:
        buckets = index.corpus_stats.select("buckets").scalar()
        wanted = wanted.select(F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), "term")
    if index.shared is not None:
        postings = index.shared.postings(wanted).drop("bucket")
    else:
        postings = postings.join(wanted, wanted.columns, "left_semi").drop("bucket")
    corpus = index.corpus_stats.select(F.struct("n_docs", "avg_doc_len")).scalar()
    # Counting tf keeps this branch equal to the one below, so Spark shuffles the postings once.
    frequencies = postings.groupBy("term").agg(F.count("tf").alias("doc_freq"))
    weighted_terms = terms.join(frequencies, "term").select(
        "query_id", "term", (F.col("query_tf") * bm25_idf(corpus["n_docs"], F.col("doc_freq"))).alias("idf")
    )
    weight = bm25_weight(F.col("tf"), F.col("doc_len"), corpus["avg_doc_len"], k1, b)
    return (
        postings.join(weighted_terms, "term")
        .join(index.doc_stats, doc)
        .groupBy("query_id", doc)
        .agg(F.sum(F.col("idf") * weight).alias("bm25"))
    )


def _packed_scores(
    index: TextIndex, terms: DataFrame, k1: float, b: float, top_k: int
) -> DataFrame:
    """`bm25_scores` of packed documents for many terms (query_id, term, query_tf), the best of each task."""
    doc = index.id_col
    numbers, docs = index.shared.packed(terms.select("term").distinct())
    corpus = index.corpus_stats.first()
    docs = cut_lineage(docs.join(index.doc_stats, doc, "left"))
    idf = bm25_idf(F.lit(corpus["n_docs"]), F.col("doc_freq"))
    weights = terms.join(numbers, "term").join(packed.term_counts(docs), "number")
    weights = cut_lineage(weights.select("query_id", "number", (F.col("query_tf") * idf).alias("weight")))
    mean = corpus["avg_doc_len"]

    def weigh(_, tf, doc_len):
        return tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * doc_len / mean))

    found = packed.products(docs.filter(F.col("doc_len").isNotNull()), doc, weights, weigh, "doc_len", top_k)
    return found.withColumnRenamed("score", "bm25")


def bm25_search(
    index: TextIndex, queries: DataFrame, k1: float = 1.5, b: float = 0.75, top_k: int = 20
) -> DataFrame:
    """The `top_k` documents of every query: query_id, document id, bm25, rank."""
    order = [F.round("bm25", TIE_DIGITS).desc(), F.col(index.id_col).asc()]
    if index.shared is not None:
        if "bucket" not in index.postings.columns:
            # Of an index that is not stored, lengths and their mean come from one pass over the texts.
            lengths = cut_lineage(index.doc_stats)
            index = replace(index, doc_stats=lengths, corpus_stats=corpus_stats(lengths))
        terms = cut_lineage(query_terms(queries))
        if terms.select("term").distinct().count() > FEW_TERMS:
            return top_k_per_group(_packed_scores(index, terms, k1, b, top_k), ["query_id"], order, top_k)
    return top_k_per_group(bm25_scores(index, queries, k1, b), ["query_id"], order, top_k)


def fuse_with_ranks(
    hits: DataFrame, ranks: DataFrame, alpha: float = 0.7, top_k: int | None = 10,
    round_before_sort: bool = True, id_col: str = "product_id",
) -> DataFrame:
    """Re-rank hits by alpha · bm25 / best bm25 + (1 − alpha) · rank / best rank.

    The best bm25 is the maximum over the hits of a query, the best rank the maximum over the
    whole graph. A document outside the graph has rank 0. `top_k=None` keeps all hits.
    """
    best = hits.groupBy("query_id").agg(F.max("bm25").alias("best_bm25"))
    best_rank = ranks.agg(F.coalesce(F.max("rank"), F.lit(1.0))).scalar()
    scored = (
        hits.drop("rank")
        .join(best, "query_id")
        .join(ranks.select(F.col("id").alias(id_col), F.col("rank").alias("pagerank")), id_col, "left")
        .withColumn("pagerank", F.coalesce("pagerank", F.lit(0.0)))
        .withColumn(
            "combined",
            alpha * ratio(F.col("bm25"), F.col("best_bm25"))
            + (1.0 - alpha) * ratio(F.col("pagerank"), best_rank),
        )
    )
    digits = 4 if round_before_sort else TIE_DIGITS
    order = [
        F.round("combined", digits).desc(),
        F.round("bm25", TIE_DIGITS).desc(),
        F.col(id_col).asc(),
    ]
    # A query has at most as many rows here as its candidate pool, so `None` needs no other path.
    k = top_k if top_k is not None else 2**31 - 1
    return top_k_per_group(scored.drop("best_bm25"), ["query_id"], order, k)


def fused_search(
    index: TextIndex, queries: DataFrame, ranks: DataFrame, documents: DataFrame,
    alpha: float = 0.7, top_k: int = 10, k1: float = 1.5, b: float = 0.75,
) -> DataFrame:
    """Result table of a search: a BM25 pool of 2 · top_k, re-ranked with graph scores.

    Pool and hits are stored, at most 2 · top_k rows of a query: the re-ranking reads the pool twice.
    """
    doc = index.id_col
    pool = cut_lineage(bm25_search(index, queries, k1, b, top_k=2 * top_k))
    ranked = cut_lineage(fuse_with_ranks(pool, ranks, alpha, top_k, round_before_sort=True, id_col=doc))
    # Stored hits are few, so their ids go to the rows that the documents are made of.
    documents = documents.join(ranked.select(doc).distinct(), doc, "left_semi")
    return ranked.join(documents, doc).select(
        "query_id",
        doc,
        "product_title",
        F.round(F.coalesce("star_rating", F.lit(0.0)), 2).alias("star_rating"),
        "product_category",
        F.round("combined", 4).alias("combined"),
        F.round("bm25", 4).alias("bm25"),
        F.round("pagerank", 6).alias("pagerank"),
        "rank",
    )


def pseudo_relevance(queries: DataFrame, titles: DataFrame, id_col: str = "product_id") -> DataFrame:
    """Products whose title holds every query token as a substring: query_id, product id.

    Tokens have at least three characters, so a title that holds a token also holds the token's
    first trigram. Joining on that trigram replaces a comparison of all queries with all titles;
    the full test then runs on the joined rows only. A query without a usable token matches every
    title, which the empty key expresses.
    """
    probes = queries.select("query_id", relevance_tokens(F.col("query")).alias("words")).select(
        "query_id",
        "words",
        F.when(F.size("words") > 0, F.substring(F.element_at("words", 1), 1, TRIGRAM)).otherwise("").alias("key"),
    )
    lowered = F.lower(F.coalesce("product_title", F.lit("")))
    trigrams = F.when(
        F.length("title") >= TRIGRAM,
        F.transform(
            F.sequence(F.lit(1), F.length("title") - (TRIGRAM - 1)), lambda i: F.substring("title", i, TRIGRAM)
        ),
    ).otherwise(F.array().cast("array<string>"))
    keyed = (
        titles.select(id_col, lowered.alias("title"))
        .distinct()
        .select(id_col, "title", F.explode(F.array_distinct(F.array_append(trigrams, ""))).alias("key"))
    )
    return (
        keyed.join(probes, "key")
        .filter(F.forall("words", lambda word: F.col("title").contains(word)))
        .select("query_id", id_col)
        .distinct()
    )
