import numpy as np
import pytest

from shelfsense.operators import classify, factors, recommend, relational
from shelfsense.session import NotConverged

RATING = "customer_id string, product_id string, star_rating double"


def ratings(spark, rows):
    return factors.user_item_ratings(spark.createDataFrame(rows, RATING))


def dense(rows):
    users, items = sorted({u for u, _, _ in rows}), sorted({i for _, i, _ in rows})
    matrix = np.zeros((len(users), len(items)))
    for user, item, stars in rows:
        matrix[users.index(user), items.index(item)] = stars
    return users, items, matrix


def small():
    rng = np.random.default_rng(3)
    rows = [(f"u{u}", f"i{i:02d}", float(rng.integers(1, 6))) for u in range(14) for i in range(11) if rng.random() < 0.4]
    return rows + [("all", f"i{i:02d}", 3.0) for i in range(11)] + [("one", "i04", 5.0)]


@pytest.mark.parametrize("demean, k", [(True, 4), (False, 5)])
def test_svd_scores_equal_a_dense_decomposition(spark, demean, k):
    rows = small()
    users, items, matrix = dense(rows)
    means = matrix.mean(axis=1, keepdims=True) if demean else 0.0
    u, s, v = np.linalg.svd(matrix - means, full_matrices=False)
    predicted = (u[:, :k] * s[:k]) @ v[:k] + means
    table = ratings(spark, rows)
    fitted = factors.item_factors(table, k, demean)
    # Small blocks and chunks, so that several of each are in play.
    found = factors.collaborative_recommendations(
        fitted, table, 3, zero_is_unrated=not demean, users_per_block=5, items_per_chunk=4
    ).collect()
    got = {}
    for row in found:
        got.setdefault(row["customer_id"], []).append((row["rank"], row["product_id"], row["score"]))
    assert "all" not in got
    for a, user in enumerate(users):
        order = sorted((i for i in range(len(items)) if matrix[a, i] == 0), key=lambda i: -predicted[a, i])[:3]
        mine = sorted(got.get(user, []))
        assert [score for _, _, score in mine] == pytest.approx([predicted[a, i] for i in order], abs=1e-8)
        assert [item for _, item, _ in mine] == [items[i] for i in order]


def test_no_factors_and_unknown_customers(spark):
    table = ratings(spark, [("u", "a", 1.0), ("u", "b", 2.0)])
    nothing = factors.item_factors(table, 0)
    assert factors.collaborative_recommendations(nothing, table, 3).collect() == []
    fitted = factors.item_factors(ratings(spark, small()), 3)
    stranger = spark.createDataFrame([("nobody",)], "customer_id string")
    assert factors.collaborative_recommendations(fitted, stranger, 3).collect() == []


def test_content_lists_are_filled_with_unrelated_products(spark):
    vectors = spark.createDataFrame(
        [(1, "x", 1.0), (2, "x", 0.6), (2, "y", 0.8), (3, "y", 1.0), (5, "z", 1.0)], "product_id long, term string, weight double"
    )
    products = spark.createDataFrame([(i, f"t{i}") for i in range(1, 7)], "product_id long, product_title string")
    targets = spark.createDataFrame([(1,), (6,), (99,)], "product_id long")
    rows = recommend.content_recommendations(vectors, products, targets, 3).collect()
    got = sorted((r["target"], r["rank"], r["product_id"], r["score"]) for r in rows)
    assert got == [
        (1, 1, 2, 0.6), (1, 2, 3, 0.0), (1, 3, 4, 0.0), (6, 1, 1, 0.0), (6, 2, 2, 0.0), (6, 3, 3, 0.0)
    ]


SIDE = "request string, product_id long, product_title string, score double"


def test_blend(spark):
    content = spark.createDataFrame([("q", 1, "a", 0.9), ("q", 2, None, 0.5), ("q", 3, "c", 0.1), ("only", 4, "d", 0.3)], SIDE)
    rated = spark.createDataFrame([("q", 2, None, 4.0), ("q", 7, "g", 2.0)], SIDE)
    rows = recommend.blend(content, rated, top_k=3, alpha=0.5).collect()
    got = {(r["request"], r["rank"]): (r["product_id"], round(r["hybrid_score"], 4)) for r in rows}
    assert got == {("q", 1): (2, 0.75), ("q", 2): (1, 0.5), ("q", 3): (3, 0.0), ("only", 1): (4, 0.3)}


def test_titles_default_or_required(spark):
    found = spark.createDataFrame([(1, 0.5), (2, 0.4)], "product_id long, score double")
    titles = spark.createDataFrame([(1, "t")], "product_id long, product_title string")
    named = {r["product_id"]: r["product_title"] for r in recommend.with_titles(found, titles).collect()}
    assert named == {1: "t", 2: recommend.UNKNOWN_TITLE}
    assert recommend.with_titles(found, titles, required=True).count() == 1


def test_split_is_stratified_and_positions_are_complete(spark):
    rows = [(i, "hot" if i % 3 else "cold") for i in range(500)] + [(900, "single")]
    frame = spark.createDataFrame(rows, "id long, label string")
    placed = relational.position_in_group(frame, "label", "id").collect()
    for label in ("hot", "cold", "single"):
        positions = sorted(r["position"] for r in placed if r["label"] == label)
        assert positions == list(range(1, len(positions) + 1))
    train, test = classify.stratified_split(frame, "label", "id")
    counts = {r["label"]: r["count"] for r in test.groupBy("label").count().collect()}
    assert counts == {"hot": round(0.2 * 333), "cold": round(0.2 * 167)}
    assert train.count() + test.count() == 501


def test_classifier_gates(spark):
    schema = "id long, body string, label string"
    one_class = spark.createDataFrame([(i, "text here", "a") for i in range(30)], schema)
    few = spark.createDataFrame([(i, "text here", "ab"[i % 2]) for i in range(10)], schema)
    assert tuple(classify.classify_documents(one_class, "id", "body", "label").first()) == (0.0, 1)
    assert tuple(classify.classify_documents(few, "id", "body", "label").first()) == (0.0, 2)


def test_classifier_separates_clear_classes(spark):
    rows = [(i, f"lens camera photo {i}" if i % 2 else f"bag strap leather {i}", "ab"[i % 2]) for i in range(60)]
    frame = spark.createDataFrame(rows, "id long, body string, label string")
    assert tuple(classify.classify_documents(frame, "id", "body", "label", max_iter=20).first()) == (1.0, 2)


def test_products_with_a_null_rating_are_not_recommended(spark):
    rows = [*small(), ("nullrater", "a", 5.0), ("nullrater", "b", None)]
    reviews = spark.createDataFrame(rows, RATING)
    fitted = factors.item_factors(factors.user_item_ratings(reviews), 2)
    customer = spark.createDataFrame([("nullrater",)], "customer_id string")
    found = factors.collaborative_recommendations(fitted, customer, 50, seen=reviews.select("customer_id", "product_id")).collect()
    assert found and {"a", "b"}.isdisjoint(r["product_id"] for r in found)


def test_too_few_steps_are_reported(spark):
    with pytest.raises(NotConverged):
        factors.item_factors(ratings(spark, small()), 2, max_steps=0)


def test_chart_order(spark):
    counts = relational.value_counts(spark.createDataFrame([("x",), ("x",), ("y",)], "c string"), "c")
    assert [r["c"] for r in relational.chart_order(counts).collect()] == ["y", "x"]


@pytest.mark.parametrize("demean", [True, False])
def test_steps_leave_no_old_tables_and_broadcast_no_customers(spark, monkeypatch, demean):
    from pathlib import Path
    from shelfsense.session import checkpoint_dir

    monkeypatch.setattr(factors, "BLOCK_USERS", 4)  # several blocks
    monkeypatch.setattr(factors, "PRODUCTS_AT_ONCE", 3)
    folder = Path(checkpoint_dir(spark))
    before = set(folder.iterdir())
    rng = np.random.default_rng(4)
    rows = [(f"u{u}", f"i{i:03d}", float(rng.integers(1, 6))) for u in range(90) for i in range(80) if rng.random() < 0.3]
    table = ratings(spark, rows)
    fitted = factors.item_factors(table, 3, demean, max_basis=70)
    steps = [d for d in set(folder.iterdir()) - before if not list(d.glob("*.parquet"))]
    assert sum(bool(list(d.glob("[0-9]*"))) for d in steps) == 1
    assert all(len(list(d.glob("[0-9]*"))) == 1 for d in steps)  # rounds before the last one are gone
    users, items, matrix = dense(rows)
    matrix = matrix - matrix.mean(axis=1, keepdims=True) * demean
    values = np.linalg.svd(matrix)[1]
    found = np.array([r.factor for r in fitted.items.orderBy("product_id").collect()])
    assert found.shape == (len(items), 3) and np.linalg.norm(matrix @ found, axis=0) == pytest.approx(values[:3], rel=1e-8)
    means = factors.user_means(table)
    plan = spark._jvm.PythonSQLUtils.explainString(factors._RatingMatrix(table, means, demean).times(
        fitted.items.withColumnRenamed("factor", "v"), 3)._jdf.queryExecution(), "simple")
    assert "BroadcastExchange" not in plan


@pytest.mark.parametrize("demean", [True, False])
def test_no_step_sends_the_vectors_of_all_products_through_the_driver(spark, demean):
    from pyspark.sql import functions as F

    table = ratings(spark, small())
    matrix = factors._RatingMatrix(table, factors.user_means(table), demean)
    # The first state is a few columns of a small file, as an estimate sees it.
    state = matrix.items.select("product_id", *(F.array(F.lit(0.5), F.lit(0.5)).alias(name) for name in ("q", "v", "e")))
    plan = spark._jvm.PythonSQLUtils.explainString(factors._step(state, matrix, 2)._jdf.queryExecution(), "simple")
    assert "BroadcastExchange" not in plan
