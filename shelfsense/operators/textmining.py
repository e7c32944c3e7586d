"""Corpus statistics: profiles, n-grams, TF-IDF, comparisons of preprocessing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.functions.scores import smooth_idf
from shelfsense.functions.text import (
    char_count,
    content_words,
    is_content_word,
    lemma,
    ngrams,
    preprocess,
    tokens,
    vector_tokens,
    without_stop_words,
    word_count,
)
from shelfsense.functions.wordlists import LEMMA_MIN_LENGTH, NOUN_ENDINGS, STOP_WORDS
from shelfsense.operators.relational import broadcast_if_bounded


def document_profile(df: DataFrame, text_col: str = "review_body") -> DataFrame:
    """Add word and character counts."""
    text = F.col(text_col)
    return df.withColumns({"word_count": word_count(text), "char_count": char_count(text)})


def profile_means(df: DataFrame, text_col: str, category_col: str) -> DataFrame:
    """Mean words and characters per document and the number of categories."""
    return document_profile(df, text_col).agg(
        F.avg("word_count").alias("mean_words"),
        F.avg("char_count").alias("mean_chars"),
        F.countDistinct(category_col).alias("categories"),
    )


def preprocess_documents(
    df: DataFrame, id_col: str, text_col: str, lemmatize: bool = True,
    lemmas: DataFrame | None = None, stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Cleaned text per document: (id, text).

    `lemmas` (token, lemma) replaces the suffix rules; a token it lacks stays as it is. That path
    regroups the tokens of a document, the default path needs no shuffle.
    """
    if not lemmatize or lemmas is None:
        return df.select(id_col, preprocess(F.col(text_col), lemmatize, stop_words).alias("text"))
    words = df.select(
        id_col, F.posexplode_outer(content_words(F.col(text_col), False, stop_words)).alias("position", "token")
    )
    looked_up = words.join(lemmas.select("token", "lemma"), "token", "left").select(
        id_col, F.when(F.col("token").isNotNull(), F.struct("position", F.coalesce("lemma", "token").alias("word"))).alias("at")
    )
    ordered = F.array_sort(F.collect_list("at"))
    return looked_up.groupBy(id_col).agg(F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("text"))


def known_lemmas(
    df: DataFrame, text_col: str, known: DataFrame | None = None, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Lemmas (token, lemma) of the collection's tokens whose stem is itself a known word.

    `known` (token) are the words that count as known, by default the tokens of the collection. Stems
    are proposed once for each distinct token, and one join keeps the known ones, so `lens` becomes
    `len` only where `len` is a word.
    """
    used = df.select(F.explode(content_words(F.col(text_col), False, stop_words)).alias("token")).distinct()
    token = F.col("token")

    def stem(ending: str, instead: str) -> Column:
        rest = F.substring(token, F.lit(1), F.length(token) - len(ending))
        long_enough = F.length(token) >= LEMMA_MIN_LENGTH + len(ending) - len(instead)
        return F.when(token.endswith(ending) & long_enough, F.concat(rest, F.lit(instead)))

    stems = used.select("token", F.posexplode(F.array(*(stem(*rule) for rule in NOUN_ENDINGS))).alias("rank", "stem"))
    words = (used if known is None else known).select(F.col("token").alias("stem")).distinct()
    found = stems.dropna().join(words, "stem")
    return found.groupBy("token").agg(F.min_by("stem", "rank").alias("lemma"))


def top_ngrams(
    df: DataFrame, text_col: str, n: int = 2, top_k: int = 15, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """The most frequent n-grams; they are formed after the stop words are gone."""
    words = without_stop_words(vector_tokens(F.col(text_col)), stop_words)
    return (
        df.select(words.alias("words"))
        .select(F.explode(ngrams(F.col("words"), n)).alias("ngram"))
        .groupBy("ngram")
        .agg(F.count("*").alias("frequency"))
        .orderBy(F.desc("frequency"), "ngram")
        .limit(top_k)
    )


def vector_terms(df: DataFrame, id_col: str, text: Column, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(id, term, n): a row per vectoriser token that is no stop word."""
    terms = df.select(F.col(id_col), F.explode(vector_tokens(text)).alias("term"))
    return terms.filter(~F.col("term").isin(list(stop_words))).withColumn("n", F.lit(1))


def vocabulary(terms: DataFrame, max_features: int) -> DataFrame:
    """The `max_features` most frequent terms: (term, term_count)."""
    counts = terms.groupBy("term").agg(F.sum("n").alias("term_count"))
    return counts.orderBy(F.desc("term_count"), "term").limit(max_features)


def in_vocabulary(terms: DataFrame, top: DataFrame, max_features: int) -> DataFrame:
    """The rows whose term belongs to a vocabulary of at most `max_features` terms."""
    return terms.join(broadcast_if_bounded(top.select("term"), max_features), "term", "left_semi")


def tfidf_weights(terms: DataFrame, n_docs: Column, id_col: str, max_features: int) -> DataFrame:
    """Unit-length TF-IDF vectors in long form (id, term, weight) from rows (id, term, n).

    The rows hold at most `max_features` terms. So does a document after the count, and the norm
    is a window over a bounded group.
    """
    counts = terms.groupBy(id_col, "term").agg(F.sum("n").alias("tf"))
    frequencies = counts.groupBy("term").agg(F.count("tf").alias("doc_freq"))
    weighted = counts.join(broadcast_if_bounded(frequencies, max_features), "term").select(
        id_col, "term", (F.col("tf") * smooth_idf(n_docs, F.col("doc_freq"))).alias("raw")
    )
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return weighted.select(id_col, "term", (F.col("raw") / norm).alias("weight"))


def tfidf_vectors(terms: DataFrame, n_docs: Column, id_col: str, max_features: int) -> DataFrame:
    """TF-IDF vectors over the most frequent terms; the others go before the wide shuffle."""
    kept = in_vocabulary(terms, vocabulary(terms, max_features), max_features)
    return tfidf_weights(kept, n_docs, id_col, max_features)


def document_vectors(
    df: DataFrame, id_col: str, text: Column, max_features: int, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """TF-IDF vectors of a table with one or more text rows per document."""
    n_docs = df.agg(F.countDistinct(id_col)).scalar()
    return tfidf_vectors(vector_terms(df, id_col, text, stop_words), n_docs, id_col, max_features)


def tfidf_features(
    df: DataFrame, id_col: str, text: Column, max_features: int = 20, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Mean TF-IDF weight of the most frequent terms over all documents, zeros included."""
    n_docs = df.agg(F.countDistinct(id_col)).scalar()
    vectors = tfidf_vectors(vector_terms(df, id_col, text, stop_words), n_docs, id_col, max_features)
    return (
        vectors.groupBy(F.col("term").alias("feature"))
        .agg((F.sum("weight") / n_docs).alias("mean_tfidf"))
        .orderBy(F.desc("mean_tfidf"), "feature")
    )


def term_weights(
    df: DataFrame, text_col: str, top_k: int = 200, lemmatize: bool = True, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """The most frequent content words with their count relative to the top one."""
    words = df.select(F.explode(content_words(F.col(text_col), lemmatize, stop_words)).alias("term"))
    top = (
        words.groupBy("term").agg(F.count("*").alias("term_count"))
        .orderBy(F.desc("term_count"), "term").limit(top_k)
    )
    return top.withColumn("weight", F.col("term_count") / top.agg(F.max("term_count")).scalar())


def compare_preprocessing(
    df: DataFrame, text_col: str, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Mean tokens per document and distinct terms, without and with lemmas.

    The text is tokenised once; every token then goes into both strategies.
    """
    n_docs = df.agg(F.count("*")).scalar()
    words = df.select(F.explode(tokens(F.col(text_col))).alias("token")).filter(
        is_content_word(F.col("token"), stop_words)
    )
    counts = words.groupBy("token").agg(F.count("*").alias("n"))
    strategies = F.array(
        F.struct(F.lit("without_lemmas").alias("strategy"), F.col("token").alias("term")),
        F.struct(F.lit("with_lemmas").alias("strategy"), lemma(F.col("token")).alias("term")),
    )
    return (
        counts.select("n", F.inline(strategies))
        .groupBy("strategy", "term")
        .agg(F.sum("n").alias("n"))
        .groupBy("strategy")
        .agg((F.sum("n") / n_docs).alias("mean_tokens"), F.count("*").alias("unique_terms"))
    )


def compare_features(
    df: DataFrame, id_col: str, text: Column, max_features: int = 1000, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Feature count and non-zero cells of bag-of-words and TF-IDF vectors.

    TF-IDF only rescales the cells of the bag of words, so one pass serves both rows.
    """
    terms = vector_terms(df, id_col, text, stop_words)
    kept = in_vocabulary(terms, vocabulary(terms, max_features), max_features)
    cells = kept.groupBy(id_col, "term").agg(F.sum("n").alias("tf"))
    per_term = cells.groupBy("term").agg(F.count("*").alias("cells"))
    totals = per_term.agg(
        F.count("*").alias("feature_count"), F.coalesce(F.sum("cells"), F.lit(0)).alias("nonzero_values")
    )
    return totals.select(
        F.explode(F.array(F.lit("Bag-of-Words"), F.lit("TF-IDF"))).alias("feature_strategy"),
        "feature_count",
        "nonzero_values",
    )
