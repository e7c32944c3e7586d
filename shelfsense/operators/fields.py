"""Search over documents with fields: a field has a weight, and a length normalisation of its own.

Counts of a word are divided by the relative length of their field, weighted and added up over the
fields of a document before they saturate, so a word in the title and in the body counts as one word
of that document, not as two.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.scores import TIE_DIGITS, bm25_idf, ratio
from shelfsense.functions.text import tokens
from shelfsense.operators.index import _lengths, first_titles, spread_over_uses, token_rows
from shelfsense.operators.relational import top_k_per_group
from shelfsense.operators.search import query_terms
from shelfsense.session import cut_lineage


@dataclass(frozen=True)
class FieldIndex:
    postings: DataFrame  # field, term, id, tf
    lengths: DataFrame  # field, id, length
    id_col: str
    of_terms: Callable[[DataFrame], DataFrame] | None = None  # postings of some terms (term), where that is less work

    def wanted(self, terms: DataFrame) -> DataFrame:
        return self.postings.join(terms, "term", "left_semi") if self.of_terms is None else self.of_terms(terms)


@dataclass(frozen=True)
class Field:
    weight: float = 1.0
    b: float = 0.75


def build_fields(words: Mapping[str, DataFrame], lengths: Mapping[str, DataFrame], id_col: str) -> FieldIndex:
    """Index from rows (id, term, n) and (id, length) of each field; (term, id) is the shuffle key, so no word is hot."""
    sizes = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("field"), id_col, "length") for name, df in lengths.items()])
    return FieldIndex(_postings(words, id_col), sizes.groupBy("field", id_col).agg(F.sum("length").alias("length")), id_col)


def _postings(words: Mapping[str, DataFrame], id_col: str) -> DataFrame:
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("field"), id_col, "term", "n") for name, df in words.items()])
    return rows.groupBy("field", "term", id_col).agg(F.sum("n").alias("tf"))


def product_fields(reviews: DataFrame, texts: DataFrame, id_col: str = "product_id", text_id: str = "text_id") -> FieldIndex:
    """Title and body of products whose reviews name their text by `text_id` in a table (text_id, text)."""
    # Words and lengths read both.
    titles = cut_lineage(first_titles(reviews, id_col))
    uses = cut_lineage(reviews.groupBy(id_col, text_id).agg(F.count("*").alias("uses")))
    body = _lengths(texts, text_id, "text").join(uses, text_id).select(id_col, (F.col("length") * F.col("uses")).alias("length"))

    def words(wanted: DataFrame | None = None) -> dict[str, DataFrame]:
        """Rows of the fields. Words go before they are spread: the optimiser does not move a filter on terms below that join."""
        rows = (token_rows(titles, id_col, "product_title"), token_rows(texts, text_id, "text"))
        title, body = rows if wanted is None else (df.join(wanted, "term", "left_semi") for df in rows)
        return {"title": title, "body": spread_over_uses(body, uses, id_col, text_id)}

    built = build_fields(
        words(),
        {"title": titles.select(id_col, F.size(tokens(F.col("product_title"))).alias("length")), "body": body},
        id_col,
    )
    return replace(built, of_terms=lambda wanted: _postings(words(wanted), id_col))


def fielded_search(index: FieldIndex, queries: DataFrame, fields: Mapping[str, Field], k1: float = 1.5, top_k: int = 20) -> DataFrame:
    """The `top_k` documents of every query: query_id, id, score, rank. Fields that are not named take no part.

    A field's mean length is over the documents that have it, an empty one included. The document
    frequency counts documents with the word in any field named; a repeated query word counts as often.
    """
    doc = index.id_col
    names = list(fields)
    settings = F.create_map(*[part for name, f in fields.items() for part in (F.lit(name), F.struct(F.lit(f.weight).alias("weight"), F.lit(f.b).alias("b")))])
    terms = query_terms(queries)
    # Means, the number of documents and the counts of a field all read the lengths.
    lengths = cut_lineage(index.lengths.filter(F.col("field").isin(names)))
    means = lengths.groupBy("field").agg(F.avg("length").alias("mean"))  # a row for each field
    own = F.try_element_at(settings, F.col("field"))
    norm = F.lit(1.0) - own["b"] + own["b"] * ratio(F.col("length"), F.col("mean"))
    # Query words first: the filter goes below the sum that builds the postings.
    wanted = index.wanted(terms.select("term").distinct()).filter(F.col("field").isin(names))
    weighted = wanted.join(lengths, ["field", doc]).join(means, "field").select("term", doc, (own["weight"] * F.col("tf") / norm).alias("part"))
    counts = cut_lineage(weighted.groupBy("term", doc).agg(F.sum("part").alias("tf")))
    n_docs = lengths.agg(F.countDistinct(doc)).scalar()
    frequencies = counts.groupBy("term").agg(F.count("tf").alias("doc_freq"))
    idf = terms.join(frequencies, "term").select("query_id", "term", (F.col("query_tf") * bm25_idf(n_docs, F.col("doc_freq"))).alias("idf"))
    scores = counts.join(idf, "term").groupBy("query_id", doc).agg(F.sum(F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1)).alias("score"))
    return top_k_per_group(scores, ["query_id"], [F.round("score", TIE_DIGITS).desc(), F.col(doc)], top_k)
