import pytest

# Null values, empty and blank texts, repeats, ties, a long text, and columns named like results.
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "the quick brown fox jumps over the lazy dog near the old river bank today"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one two"),
    (7, "one two"),
    (7, "one two"),
    (8, "a\nb\nc\nd\ne"),
    (9, "x\nb\nc\nd\ny\nb\nc\nd\nz"),
    (10, "word " * 30_000),
    (11, "ÀÉ ß 日本 語　テスト  two  spaces \n tail "),
    (None, "no id at all"),
]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, text, "en", "src", None if text is None else len(text), 0, 0.5) for i, text in DOCS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_removed int, tail_2 double"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


def table(folder, name):
    import pyarrow.dataset

    return pyarrow.dataset.dataset(f"/root/testdata/{folder}/{name}.parquet").to_table().to_pandas()
