import math

import pytest

from shelfsense.operators import fields, index, search, state
from shelfsense.sources.store import Store


def docs(spark, *rows):
    return index.build_index(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", with_title=False)


def queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id int, query string")


def test_a_snapshot_is_one_version(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"))
    first = docs(spark, (1, "a b"), (2, "b c c"))
    state.publish(store, first, ranks=spark.createDataFrame([(1, 0.5)], "id long, rank double"))
    held = state.Snapshot(store)
    state.publish(store, docs(spark, (3, "a a")), buckets=2)
    now = state.Snapshot(store)
    asked = queries(spark, "a c")
    ids = lambda i: [(r.doc_id, round(r.bm25, 9)) for r in search.bm25_search(i, asked).orderBy("rank").collect()]
    assert ids(held.index()) == ids(first) and [d for d, _ in ids(now.index())] == [3]
    assert now.table("ranks").first()["rank"] == 0.5  # parts that were not given stay
    with pytest.raises(LookupError):
        now.table("vectors")
    with pytest.raises(ValueError):
        state.publish(store, other=asked)
    assert store.clean(keep=1) == 2 and [d for d, _ in ids(now.index())] == [3] and now.table("ranks").count() == 1


def test_fields_by_hand(spark):
    words = {"title": [(1, "red", 1), (2, "blue", 2)], "body": [(1, "red", 2), (1, "old", 1), (2, "red", 4), (3, "old", 1)]}
    sizes = {"title": [(1, 1), (2, 2), (3, 0)], "body": [(1, 3), (2, 4), (3, 1)]}
    built = fields.build_fields(
        {f: spark.createDataFrame(rows, "id long, term string, n long") for f, rows in words.items()},
        {f: spark.createDataFrame(rows, "id long, length long") for f, rows in sizes.items()}, "id",
    )
    idf = math.log((3 - 2 + 0.5) / 2.5 + 1)

    def score(*parts):
        tf = sum(parts)
        return idf * tf * 2.5 / (tf + 1.5)

    norm = lambda n, mean, b: 1 - b + b * n / mean
    mean_title, mean_body = 1, 8 / 3
    got = lambda **f: {r.id: r.score for r in fields.fielded_search(built, queries(spark, "red"), f).collect()}
    one = fields.Field()
    assert got(title=one, body=one) == pytest.approx({1: score(1 / norm(1, mean_title, 0.75), 2 / norm(3, mean_body, 0.75)), 2: score(4 / norm(4, mean_body, 0.75))})
    heavy = got(title=fields.Field(3.0, 0.3), body=fields.Field(1.0, 0.0))
    assert heavy == pytest.approx({1: score(3 / norm(1, mean_title, 0.3), 2), 2: score(4)})
    only = got(title=one)
    idf = math.log((3 - 1 + 0.5) / 1.5 + 1)
    assert only == pytest.approx({1: score(1 / norm(1, mean_title, 0.75))})
    assert fields.fielded_search(built, queries(spark, "", "none"), {"title": one}).count() == 0
