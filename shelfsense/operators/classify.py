"""Category classifier: TF-IDF features and logistic regression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer, StringIndexer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.text import vector_tokens, without_stop_words
from shelfsense.functions.wordlists import STOP_WORDS
from shelfsense.operators.relational import position_in_group
from shelfsense.operators.textmining import vocabulary

MIN_ROWS = 20
RESULT = "accuracy double, classes long"


def stratified_split(
    df: DataFrame, label: str, id_col: str, test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; of every class the rounded share goes to the test set.

    The choice depends on a hash of the id only, so a recomputed task makes the same one.
    """
    placed = position_in_group(df, label, id_col, seed)
    is_test = F.col("position") <= F.round(F.col("group_size") * test_share)
    columns = df.columns
    return placed.filter(~is_test).select(*columns), placed.filter(is_test).select(*columns)


def fit_classifier(
    train: DataFrame, text: str, label: str, max_features: int = 3000, max_iter: int = 300,
    stop_words: Sequence[str] = STOP_WORDS,
):
    """Fitted pipeline on a table with a `words` array column."""
    terms = train.select(F.explode("words").alias("term"), F.lit(1).alias("n"))
    # The vocabulary is cut to max_features, so this list has a fixed bound.
    words = [row["term"] for row in vocabulary(terms, max_features).collect()]
    counter = CountVectorizerModel.from_vocabulary(words, inputCol="words", outputCol="counts")
    idf = IDF(inputCol="counts", outputCol="unused").fit(counter.transform(train)).idf
    smooth = ElementwiseProduct(
        scalingVec=Vectors.dense(idf.toArray() + 1.0), inputCol="counts", outputCol="tfidf"
    )
    n_rows = train.count()
    stages = [
        counter,
        smooth,
        Normalizer(p=2.0, inputCol="tfidf", outputCol="features"),
        StringIndexer(inputCol=label, outputCol="target", stringOrderType="alphabetAsc"),
        LogisticRegression(
            featuresCol="features", labelCol="target", maxIter=max_iter, tol=1e-6,
            # Inverse regularisation strength 1 over summed losses, expressed for mean losses.
            regParam=1.0 / n_rows, standardization=False,
        ),
    ]
    return Pipeline(stages=stages).fit(train)


def classify_documents(
    df: DataFrame, id_col: str, text: str, label: str, max_features: int = 3000, max_iter: int = 300,
    seed: int = 42, stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Accuracy on a held-out stratified fifth, and the number of classes; one row.

    With fewer than two classes or twenty usable rows the accuracy is 0.
    """
    usable = df.select(id_col, text, label).dropna(subset=[text, label])
    counts = usable.agg(F.count("*").alias("n"), F.countDistinct(label).alias("classes")).first()
    spark = df.sparkSession
    if counts["classes"] < 2 or counts["n"] < MIN_ROWS:
        return spark.createDataFrame([(0.0, counts["classes"])], RESULT)
    words = usable.select(
        id_col, label, without_stop_words(vector_tokens(F.col(text)), stop_words).alias("words")
    )
    train, test = stratified_split(words, label, id_col, seed=seed)
    # The split is read by the vocabulary, the IDF, and every pass of the optimiser.
    train = train.persist()
    try:
        model = fit_classifier(train, text, label, max_features, max_iter, stop_words)
    finally:
        train.unpersist()
    right = (F.col("prediction") == F.col("target")).cast("double")
    scored = model.transform(test).agg(F.avg(right).alias("accuracy"))
    return scored.select("accuracy", F.lit(counts["classes"]).cast("long").alias("classes"))
