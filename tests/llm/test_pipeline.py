"""Each stage of the pipeline against brute force on its own input."""

import corpus_pipeline
import pytest
from conftest import table
from test_copies import brute_components, brute_lines

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


@pytest.fixture(scope="module")
def steps(spark):
    """Input of every stage, and the last one's result."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        seen.append(docs)
    return seen


def test_stages_keep_the_columns(steps):
    for df in steps[:-1]:
        assert df.columns == steps[0].columns and df.count() > 0


def test_quality_keeps_clean_documents(steps):
    labels, kept = table("sf0.001", "labels"), set(rows(steps[1]))
    clean = labels[(labels.toxic == 0) & (labels.quality == 1)].doc_id
    toxic = labels[labels.toxic == 1].doc_id
    assert clean.isin(kept).mean() > 0.95 and toxic.isin(kept).mean() < 0.2


def test_lines(steps):
    before = sorted(rows(steps[1]).items())
    assert rows(steps[2]) == {i: text for i, text, _, _ in brute_lines(before)}
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_near_copies(steps):
    before = sorted(rows(steps[2]).items())
    assert set(rows(steps[3])) == {i for i, _, component in brute_components(before) if i == component}


def test_decontamination(steps):
    items = table("sf0.001", "benchmark").text
    holds = {i for i, text in rows(steps[3]).items() if any(item in text for item in items)}
    left = set(rows(steps[4]))
    assert not holds & left and len(left) >= len(rows(steps[3])) - len(holds) - 1


def test_packing_covers_what_is_left(steps):
    pieces = steps[5].toPandas()
    lengths = pieces.groupby("doc_id")["length"].sum()
    assert set(lengths.index) == set(rows(steps[4]))
    assert (pieces.groupby("doc_id")["doc_tokens"].first() == lengths).all()


def test_stages_of_hostile_documents(spark, docs, no_docs):
    for df in (docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, FOLDER)
            assert df.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, df, FOLDER).count()
