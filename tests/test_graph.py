import numpy as np
import pytest

from shelfsense.operators import graph


def reviews(spark, pairs):
    return spark.createDataFrame(pairs, "customer_id string, product_id string")


PATH = [("c1", "x"), ("c1", "y"), ("c2", "y"), ("c2", "z"), ("c3", "alone"), ("c1", "x")]


def dense_pagerank(edges, damping=0.85, tol=1e-6):
    nodes = sorted({a for a, _ in edges})
    at = {node: i for i, node in enumerate(nodes)}
    matrix = np.zeros((len(nodes), len(nodes)))
    for a, b in edges:
        matrix[at[b], at[a]] = 1.0
    matrix /= matrix.sum(axis=0)
    rank = np.full(len(nodes), 1 / len(nodes))
    for _ in range(100):
        new = damping * matrix @ rank + (1 - damping) / len(nodes)
        done = np.abs(new - rank).sum() < len(nodes) * tol
        rank = new
        if done:
            break
    return dict(zip(nodes, rank))


def random_pairs(seed=5):
    rng = np.random.default_rng(seed)
    pairs = [(f"c{c}", f"p{p:02d}") for c in range(12) for p in rng.choice(30, size=rng.integers(1, 5), replace=False)]
    hot = [(f"h{h}", f"p{p:02d}") for h in range(3) for p in rng.choice(30, size=14, replace=False)]
    return pairs + hot


def brute_edges(pairs):
    by_customer = {}
    for customer, product in pairs:
        by_customer.setdefault(customer, set()).add(product)
    return {(a, b) for products in by_customer.values() for a in products for b in products if a != b}


def test_single_product_customers_give_no_node(spark):
    built = graph.co_review_graph(reviews(spark, PATH))
    assert {tuple(r) for r in graph.co_review_edges(built).collect()} == {("x", "y"), ("y", "x"), ("y", "z"), ("z", "y")}
    assert tuple(graph.graph_stats(built).first()) == (3, 4)


def test_pagerank_on_a_path(spark):
    ranks = {r["id"]: r["rank"] for r in graph.pagerank(graph.co_review_graph(reviews(spark, PATH))).collect()}
    assert sum(ranks.values()) == pytest.approx(1.0)
    assert ranks == pytest.approx(dense_pagerank(brute_edges(PATH)), abs=1e-9)


@pytest.mark.parametrize("tile_products", [1, 3, 10, 1000])
def test_tiles_change_no_result(spark, tile_products):
    pairs = random_pairs()
    built = graph.co_review_graph(reviews(spark, pairs), tile_products)
    edges = [tuple(r) for r in graph.co_review_edges(built).collect()]
    assert len(edges) == len(set(edges)) and set(edges) == brute_edges(pairs)
    assert tuple(graph.graph_stats(built).first()) == (len({a for a, _ in edges}), len(edges))
    ranks = {r["id"]: r["rank"] for r in graph.pagerank(built).collect()}
    assert ranks == pytest.approx(dense_pagerank(brute_edges(pairs)), abs=1e-9)


def test_hits_on_a_triangle_with_a_pendant(spark):
    pairs = [("t", "x"), ("t", "y"), ("t", "z"), ("p", "z"), ("p", "w")]
    rows = graph.hits(graph.co_review_graph(reviews(spark, pairs))).collect()
    edges = brute_edges(pairs)
    nodes = sorted({a for a, _ in edges})
    matrix = np.array([[float((a, b) in edges) for b in nodes] for a in nodes])
    vector = np.abs(np.linalg.eigh(matrix @ matrix)[1][:, -1])
    expected = dict(zip(nodes, vector / vector.sum()))
    assert {r["id"]: r["hub"] for r in rows} == pytest.approx(expected, abs=1e-6)
    assert {r["id"]: r["authority"] for r in rows} == pytest.approx(expected, abs=1e-6)


def test_empty_graph_gives_empty_scores(spark):
    built = graph.co_review_graph(reviews(spark, [("c", "p")]))
    assert graph.pagerank(built).collect() == [] and graph.hits(built).collect() == []


def test_too_few_rounds_are_reported(spark):
    built = graph.co_review_graph(reviews(spark, random_pairs()))
    with pytest.raises(graph.NotConverged):
        graph.pagerank(built, max_iter=1, tol=1e-12)
    with pytest.raises(graph.NotConverged):
        graph.hits(built, max_iter=1, tol=1e-12)


def test_a_large_customer_is_stored_without_its_pairs(spark):
    products = [("hot", f"p{p:04d}") for p in range(400)]
    others = [(f"c{p}", f"p{q:04d}") for p in range(0, 400, 40) for q in (p, p + 1)] + [("alone", "p0005"), ("new", "p0007"), ("new", "q")]
    built = graph.co_review_graph(reviews(spark, products + others), tile_products=50)
    layout = graph._laid_out(built)
    assert layout.repeats.count() < 1000 and layout.class_links.count() == 1
    assert tuple(graph.graph_stats(built).first()) == (401, 400 * 399 + 2)


@pytest.mark.parametrize("tile_products", [2, 1000])
def test_hubs_dealt_over_rows_change_no_edge(spark, monkeypatch, tile_products):
    monkeypatch.setattr(graph, "GATHERED_IDS", 5)
    pairs = random_pairs(seed=8)
    built = graph.co_review_graph(reviews(spark, pairs), tile_products)
    edges = [tuple(r) for r in graph.co_review_edges(built).collect()]
    assert len(edges) == len(set(edges)) and set(edges) == brute_edges(pairs)
    assert tuple(graph.graph_stats(built).first()) == (len({a for a, _ in edges}), len(edges))
