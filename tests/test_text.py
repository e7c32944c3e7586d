import re

import pytest
from pyspark.sql import functions as F

from shelfsense.functions import text as tx
from shelfsense.operators import textmining as mining


def one(spark, value, expression):
    frame = spark.createDataFrame([(value,)], "t string")
    return frame.select(expression(F.col("t")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Été—naïve, x_y 3² don't ß!", ["éténaïve", "x_y", "3²", "dont", "ß"]),
        (None, []),
        ("?!—…", []),
        ("a b c\td\n e", ["a", "b", "c", "d", "e"]),
    ],
)
def test_search_tokens(spark, text, expected):
    assert one(spark, text, tx.tokens) == expected


def test_vector_and_relevance_tokens(spark):
    assert one(spark, "Don't a bc É3!", tx.vector_tokens) == ["don", "bc", "é3"]
    assert one(spark, "Don't a bcd", tx.relevance_tokens) == ["don", "bcd"]


def test_tokens_agree_with_python_on_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "text", tx.tokens(F.col("text")).alias("tokens"), tx.word_count(F.col("text")).alias("words")
    )
    for row in rows.collect():
        assert row["tokens"] == re.sub(r"[^\w\s]", "", row["text"].lower()).split()
        assert row["words"] == len(row["text"].split())


def test_preprocess_and_lemmas(spark):
    text = "The cameras, boxes and BATTERIES of my glass men are on"
    assert one(spark, text, tx.preprocess) == "camera box battery glass man"
    assert one(spark, text, lambda t: tx.preprocess(t, lemmatize=False)) == "cameras boxes batteries glass men"
    docs = spark.createDataFrame([(1, "geese saw mice geese"), (2, "of"), (3, None)], "id int, text string")
    table = spark.createDataFrame([("geese", "goose"), ("mice", "mouse")], "token string, lemma string")
    made = {r["id"]: r["text"] for r in mining.preprocess_documents(docs, "id", "text", lemmas=table).collect()}
    assert made == {1: "goose saw mouse goose", 2: "", 3: ""}


def test_ngrams_need_enough_words(spark):
    assert one(spark, "a b c", lambda t: tx.ngrams(F.split(t, " "), 2)) == ["a b", "b c"]
    assert one(spark, "a", lambda t: tx.ngrams(F.split(t, " "), 2)) == []


def test_top_ngrams_are_formed_after_stop_words(spark):
    docs = spark.createDataFrame([("red the lens",), ("red lens bag",)], "text string")
    rows = mining.top_ngrams(docs, "text", 2, 5).collect()
    assert [tuple(r) for r in rows] == [("red lens", 2), ("lens bag", 1)]


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, "aa aa bb"), (2, "bb"), (3, "")], "id int, text string")
    got = {
        (r["id"], r["term"]): r["weight"]
        for r in mining.document_vectors(docs, "id", F.col("text"), 10).collect()
    }
    import math

    a, b = 2 * (math.log(4 / 2) + 1), math.log(4 / 3) + 1
    norm = math.hypot(a, b)
    assert got == {
        (1, "aa"): pytest.approx(a / norm), (1, "bb"): pytest.approx(b / norm), (2, "bb"): pytest.approx(1.0)
    }


def test_empty_vocabulary_gives_no_features(spark):
    docs = spark.createDataFrame([(1, "the of")], "id int, text string")
    assert mining.tfidf_features(docs, "id", F.col("text"), 5).collect() == []


def test_lines(spark):
    assert one(spark, " a \n\n b\r\nc", tx.lines) == ["a", "b", "c"]


def test_lemmas_are_known_words(spark):
    from shelfsense.operators import textmining

    text = "lens lenses cases case movies movie series women woman wolves wolf boxes box houses house canvas"
    rows = textmining.known_lemmas(spark.createDataFrame([(text,)], "t string"), "t").collect()
    assert {r["token"]: r["lemma"] for r in rows} == {
        "lenses": "lens", "cases": "case", "movies": "movie", "women": "woman", "wolves": "wolf", "boxes": "box", "houses": "house",
    }
