"""Inverted index over reviews: one document per product, or one per row."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.functions.text import tokens
from shelfsense.operators import packed
from shelfsense.session import cut_lineage, release_shuffles

REVIEW_ORDER = ("ord1", "ord2")


@dataclass(frozen=True)
class SharedWords:
    """What an index of shared texts is made from: words of texts, words of documents, and who holds which text.

    Stored words have a column `bucket` besides, by term.
    """

    texts: DataFrame  # text id, term, n
    own: DataFrame  # id, term, n
    uses: DataFrame  # id, text id, uses
    id_col: str
    text_id: str

    def postings(self, wanted: DataFrame | None = None) -> DataFrame:
        """Postings (term, id, tf) of the documents, with the buckets of stored words, or those of the `wanted` keys.

        Words go before they are joined with uses: the optimiser does not move a filter on terms below that join.
        """
        keys = [name for name in ("bucket", "term") if name in self.texts.columns]
        texts, own = self.texts, self.own
        if wanted is not None:
            texts, own = (rows.join(wanted, wanted.columns, "left_semi") for rows in (texts, own))
        if keys == ["term"]:
            texts = counted_words(texts, self.text_id)
        times = (F.col("n") * F.col("uses")).alias("n")
        bodies = texts.join(self.uses, self.text_id).select(*keys, self.id_col, times)
        rows = bodies.unionByName(own.select(*keys, self.id_col, "n"))
        return rows.groupBy(*keys, self.id_col).agg(F.sum("n").alias("tf"))

    def terms(self) -> DataFrame:
        """Distinct terms of the documents; a text that no document holds has none."""
        held = self.texts.join(self.uses.select(self.text_id).distinct(), self.text_id, "left_semi")
        return held.select("term").unionAll(self.own.select("term")).distinct()

    def packed(self, wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """Numbers (term, number) and documents (id, words) of all terms, or of the `wanted` ones (term)."""
        numbers, parts = self.parts(wanted)
        return numbers, packed.documents(**parts)

    def packed_slices(self) -> tuple[DataFrame, Iterator[DataFrame]]:
        """Numbers, and documents of all terms in tables that are made one after the other."""
        numbers, parts = self.parts()
        return numbers, packed.document_slices(**parts)

    def parts(self, wanted: DataFrame | None = None) -> tuple[DataFrame, dict]:
        """Numbers of terms, and what documents are made from."""

        def counted(rows: DataFrame, key: str) -> DataFrame:
            kept = rows if wanted is None else rows.join(wanted, "term", "left_semi")
            return cut_lineage(kept.groupBy(key, "term").agg(F.sum("n").alias("n")))

        in_text, own = counted(self.texts.filter(F.col(self.text_id).isNotNull()), self.text_id), counted(self.own, self.id_col)
        numbers = packed.numbered(in_text.select("term").unionAll(own.select("term")))
        lists = packed.lists(in_text, numbers, self.text_id)
        mine = packed.lists(own, numbers, self.id_col)
        return numbers, {"texts": lists, "uses": self.uses, "id_col": self.id_col, "text_id": self.text_id, "own": mine}


@dataclass(frozen=True)
class TextIndex:
    """Lazy tables of an index; `write_index` stores them so that searches need no text scan."""

    postings: DataFrame  # term, product_id, tf
    doc_stats: DataFrame  # product_id, doc_len
    corpus_stats: DataFrame  # n_docs, avg_doc_len; one row
    id_col: str = "product_id"
    shared: SharedWords | None = None  # of shared texts, for work on many terms and for storing


def product_documents(
    reviews: DataFrame, id_col: str = "product_id", order: Sequence[str] = REVIEW_ORDER
) -> DataFrame:
    """One row per product: first known title and category, mean rating.

    The review texts are not glued together: counts and lengths add up over the reviews, and a
    product with very many reviews would otherwise become one giant row.
    """

    def first_known(column: str) -> Column:
        return F.min_by(column, F.when(F.col(column).isNotNull(), F.struct(*order))).alias(column)

    return reviews.groupBy(id_col).agg(
        first_known("product_title"),
        F.avg("star_rating").alias("star_rating"),
        first_known("product_category"),
    )


def first_titles(reviews: DataFrame, id_col: str = "product_id", order: Sequence[str] = REVIEW_ORDER) -> DataFrame:
    """First known title per product: (id, product_title)."""
    position = F.when(F.col("product_title").isNotNull(), F.struct(*order))
    return reviews.groupBy(id_col).agg(F.min_by("product_title", position).alias("product_title"))


def token_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, n): a row per search token.

    Tokens are exploded where they are made. As a column of their own they would be computed again
    by every filter that the optimiser pushes through it.
    """
    return df.select(id_col, F.explode(tokens(F.col(text_col))).alias("term")).withColumn("n", F.lit(1))


def spread_over_reviews(text_rows: DataFrame, reviews: DataFrame, id_col: str, text_id: str) -> DataFrame:
    """Turn rows (text id, term, n) of shared texts into rows (id, term, n) of the documents.

    Every text is counted once, however many reviews carry it; repeats of a text within one
    document become a factor before the join.
    """
    return spread_over_uses(text_rows, reviews.groupBy(id_col, text_id).agg(F.count("*").alias("uses")), id_col, text_id)


def spread_over_uses(text_rows: DataFrame, uses: DataFrame, id_col: str, text_id: str) -> DataFrame:
    """The same for reviews that are counted already: (id, text id, uses)."""
    counted = text_rows.groupBy(text_id, "term").agg(F.sum("n").alias("in_text"))
    return counted.join(uses, text_id).select(id_col, "term", (F.col("in_text") * F.col("uses")).alias("n"))


def _index(words: list[DataFrame], lengths: list[DataFrame], id_col: str) -> TextIndex:
    """Index from rows (id, term, n) and (id, length).

    The wide shuffle is on (term, document) after a map-side sum, so neither a product with very
    many reviews nor a very frequent word becomes a large group.
    """
    postings = reduce(DataFrame.unionByName, words).groupBy("term", id_col).agg(F.sum("n").alias("tf"))
    doc_stats = reduce(DataFrame.unionByName, lengths).groupBy(id_col).agg(F.sum("length").alias("doc_len"))
    return TextIndex(postings, doc_stats, corpus_stats(doc_stats), id_col)


def _lengths(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(id_col, F.size(tokens(F.col(text_col))).alias("length"))


def build_index(
    reviews: DataFrame,
    id_col: str = "product_id",
    text_col: str = "review_body",
    with_title: bool = True,
    order: Sequence[str] = REVIEW_ORDER,
) -> TextIndex:
    """Index of reviews that hold their text: all bodies of a product and, once, its title."""
    words, lengths = [token_rows(reviews, id_col, text_col)], [_lengths(reviews, id_col, text_col)]
    if with_title:
        titles = first_titles(reviews, id_col, order)
        words.append(token_rows(titles, id_col, "product_title"))
        lengths.append(_lengths(titles, id_col, "product_title"))
    return _index(words, lengths, id_col)


def build_index_of_shared_texts(
    reviews: DataFrame,
    texts: DataFrame,
    id_col: str = "product_id",
    text_id: str = "text_id",
    order: Sequence[str] = REVIEW_ORDER,
) -> TextIndex:
    """The same index for reviews that name their text by `text_id` in a table (text_id, text).

    It pays where texts repeat: a text is tokenised once and only its counts are multiplied. Titles and uses
    are stored, as lengths and postings read both.
    """
    titles = cut_lineage(first_titles(reviews, id_col, order))
    words, own = token_rows(texts, text_id, "text"), token_rows(titles, id_col, "product_title")
    used = cut_lineage(reviews.groupBy(id_col, text_id).agg(F.count("*").alias("uses")))
    bodies = spread_over_uses(words, used, id_col, text_id)
    body_lengths = _lengths(texts, text_id, "text").join(used, text_id)
    built = _index(
        [bodies, own],
        [
            body_lengths.select(id_col, (F.col("length") * F.col("uses")).alias("length")),
            _lengths(titles, id_col, "product_title"),
        ],
        id_col,
    )
    return replace(built, shared=SharedWords(words, own, used, id_col, text_id))


def corpus_stats(doc_stats: DataFrame) -> DataFrame:
    """Document count and mean length, empty documents included."""
    return doc_stats.agg(F.count("*").alias("n_docs"), F.avg("doc_len").alias("avg_doc_len"))


def term_stats(index: TextIndex) -> DataFrame:
    """Document frequency and total count of every term; those of shared texts come from packed documents."""
    if index.shared is not None:
        numbers, slices = index.shared.packed_slices()
        counts = []
        for docs in slices:
            # Only the counts of a slice stay.
            counts.append(cut_lineage(packed.term_counts(docs)))
            release_shuffles(docs.sparkSession)
        added = reduce(DataFrame.unionByName, counts).groupBy("number").agg(F.sum("doc_freq").alias("doc_freq"), F.sum("term_count").alias("term_count"))
        return added.join(numbers.select("term", "number"), "number").select("term", "doc_freq", "term_count")
    return index.postings.groupBy("term").agg(
        F.count("*").alias("doc_freq"), F.sum("tf").alias("term_count")
    )


def whole_postings(index: TextIndex) -> DataFrame:
    """All postings (term, id, tf), to be stored; those of shared texts come from packed documents."""
    if index.shared is None:
        return index.postings.select("term", index.id_col, "tf")
    numbers, parts = index.shared.parts()
    return packed.postings(packed.stored_documents(**parts), numbers, index.id_col)


def counted_words(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, term, n) added up, a row for each term of a key."""
    return rows.groupBy(key, "term").agg(F.sum("n").alias("n"))


def by_bucket(rows: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """Rows (term, id, …) in term buckets, sorted by term, as they are stored.

    The id is a key as well, so the list of a very frequent term is spread over files.
    """
    keys = ("bucket", "term", id_col)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_index(index: TextIndex, path: str, buckets: int = 64) -> None:
    """Store an index as Parquet, postings in term buckets sorted by term.

    A search touches few buckets and, inside a file, few row groups.
    """
    by_bucket(whole_postings(index), index.id_col, buckets).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    index.doc_stats.write.mode("overwrite").parquet(f"{path}/doc_stats")
    stored = index.doc_stats.sparkSession.read.parquet(f"{path}/doc_stats")
    layout = corpus_stats(stored).select("*", F.lit(buckets).alias("buckets"), F.lit(index.id_col).alias("id_col"))
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}/corpus_stats")


def read_index(spark: SparkSession, path: str) -> TextIndex:
    stats = spark.read.parquet(f"{path}/corpus_stats")
    return TextIndex(
        spark.read.parquet(f"{path}/postings"),
        spark.read.parquet(f"{path}/doc_stats"),
        stats,
        stats.first()["id_col"],
    )


def index_summary(index: TextIndex, reviews: DataFrame, edges: DataFrame) -> DataFrame:
    """Figures of a collection: records, products, terms, mean length, co-review edges.

    Terms of shared texts are counted over the texts in use, without a row for each term and product. Edges are
    counted first and by themselves, so their shuffle files do not lie beside those of the words.
    """
    n_edges = edges.count()
    release_shuffles(edges.sparkSession)
    terms = index.postings.select("term").distinct() if index.shared is None else index.shared.terms()
    return index.corpus_stats.select(
        reviews.agg(F.count("*")).scalar().alias("records"),
        F.col("n_docs").alias("products"),
        terms.agg(F.count("*")).scalar().alias("terms"),
        F.round("avg_doc_len", 6).alias("avg_doc_len"),
        F.lit(n_edges).cast("long").alias("edges"),
    )
