import random

import pytest
from pyspark.sql import functions as F

from shelfsense.operators import index, search, segments
from shelfsense.sources.store import Conflict, Store

WORDS = [f"w{i}" for i in range(30)]


def docs_frame(spark, docs):
    return spark.createDataFrame(sorted(docs.items()), "doc_id string, text string")


def built(spark, docs):
    return index.build_index(docs_frame(spark, docs), "doc_id", "text", with_title=False)


def hits(text_index, queries):
    return sorted((r.query_id, r.rank, r.doc_id, round(r.bm25, 9)) for r in search.bm25_search(text_index, queries).collect())


def test_any_history_gives_the_hits_of_a_rebuilt_index(spark, tmp_path):
    rng = random.Random(4)
    queries = spark.createDataFrame([(0, "w1 w2 w2"), (1, "w5"), (2, "none"), (3, "w7 w9 w11 w0")], "query_id int, query string")
    kept = segments.SegmentedIndex(Store(spark, str(tmp_path / "store")), "doc_id", buckets=3, fanout=2)
    live = {}
    for step in range(6):
        batch = {f"d{rng.randrange(40)}": " ".join(rng.choices(WORDS, k=rng.randrange(12))) for _ in range(rng.choice([1, 3, 12]))}
        kept.append(built(spark, batch))
        live |= batch
        if step % 2:
            gone = rng.sample(sorted(live), 3)
            kept.remove(spark.createDataFrame([(d,) for d in [*gone, "unknown"]], "doc_id string"))
            for d in gone:
                del live[d]
    assert hits(kept.read(), queries) == hits(built(spark, live), queries)
    stats = kept.read().corpus_stats.first()
    assert stats["n_docs"] == len(live)
    names = [s["number"] for s in kept.segments(kept.store.latest())]
    levels = [kept.level(s) for s in kept.segments(kept.store.latest())]
    assert len(levels) == len(set(levels)) and len(names) < 6  # equal levels were merged


def test_empty_parts(spark, tmp_path):
    kept = segments.SegmentedIndex(Store(spark, str(tmp_path / "store")), "doc_id", buckets=2)
    with pytest.raises(LookupError):
        kept.read()
    kept.append(index.build_index(docs_frame(spark, {"a": "x"}).limit(0), "doc_id", "text", with_title=False))
    kept.append(built(spark, {"a": "", "b": "x y"}))
    kept.remove(spark.createDataFrame([], "doc_id string"))
    assert kept.read().corpus_stats.first()["n_docs"] == 2
    assert [r.doc_id for r in search.bm25_search(kept.read(), spark.createDataFrame([(1, "x")], "query_id int, query string")).collect()] == ["b"]


def test_appending_reads_no_earlier_text_or_postings(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    kept = segments.SegmentedIndex(store, "doc_id", buckets=2)
    docs_frame(spark, {f"d{i}": "old words" for i in range(50)}).write.parquet(str(tmp_path / "old"))
    docs_frame(spark, {"n1": "new words", "d3": "newer"}).write.parquet(str(tmp_path / "new"))
    kept.append(index.build_index(spark.read.parquet(str(tmp_path / "old")), "doc_id", "text", with_title=False))
    before = store.latest()
    seen = []
    write = Store.write
    store.write = lambda df, *a: (seen.append(df.inputFiles()), write(store, df, *a))[1]
    kept.append(index.build_index(spark.read.parquet(str(tmp_path / "new")), "doc_id", "text", with_title=False))
    files = [f for fs in seen for f in fs]
    assert any("/new/" in f for f in files)
    assert not any("/old/" in f or "/postings/" in f for f in files)
    # A reader that holds the earlier version goes on seeing it.
    assert kept.read(before).doc_stats.count() == 50 and kept.read().doc_stats.count() == 51


def test_versions_are_whole_and_cleaned(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    one = store.write(spark.range(3), "a")
    first = store.publish(store.latest(), {"a": [one]}, {"x": 1})
    unpublished = store.write(spark.range(1), "a")
    second = store.publish(first, {"a": [store.write(spark.range(5), "a")], "b": [one]})
    with pytest.raises(Conflict):
        store.publish(first, {"a": [unpublished]})
    assert store.latest() == second and second.facts == {"x": 1}
    third = store.publish(second, {"b": []}, {"x": 2})
    assert sorted(third.tables) == ["a"] and store.numbers() == [1, 2, 3]
    assert store.clean(keep=1) == 1 and store.numbers() == [3]
    assert store.read(third, "a").count() == 5
    assert store.scan([unpublished]).count() == 1  # its writer may still publish it
    assert store.read(store.latest(), "a").agg(F.sum("id")).first()[0] == 10
