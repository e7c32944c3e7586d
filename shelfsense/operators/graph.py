"""Co-review graph, PageRank and HITS.

Two products are neighbours when one customer reviewed both. The graph is kept as the lists of its customers,
which grow with the reviews, while edges grow with the square of a list. A sum over the neighbours of a product
is the sum over the lists that hold it, less what is counted more than once: the product itself, and products
it meets in several lists. Only these repeats are stored by pair.

A customer with more than `TILE_PRODUCTS` products is large. Products of the same large customers are one class,
as they meet the same products there, and sums run over pairs of classes. Where edges are listed, the
products of a large customer are cut into tiles, and a pair of tiles is the unit of work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.session import NotConverged, Rounds, cut_lineage, cut_lineage_keeping_layout, shuffle_partitions

TILE_PRODUCTS = 200
# The rows of a product lie in so many parts, and its value is sent to each: a hub is split in every round.
HUB_PARTS = 4
# So many list entries of a product, at most, are gathered in one row.
GATHERED_IDS = 1_000_000


@dataclass(frozen=True)
class CoReviewGraph:
    lists: DataFrame  # customer_id, ids; customers of at most tile_products products
    large: DataFrame | None  # customer_id, product_id; the others, if there are any
    tile_products: int


@dataclass(frozen=True)
class _Layout:
    """What every round joins on, stored once."""

    by_product: DataFrame  # src, part, customer_id
    by_customer: DataFrame  # customer_id, dst
    repeats: DataFrame  # src, part, dst, n: counted n times too often
    classes: DataFrame | None  # id, class
    class_links: DataFrame | None  # src, dst; classes that share a large customer, each with itself too


def _memberships(reviews: DataFrame) -> DataFrame:
    return reviews.select("customer_id", "product_id").dropna().distinct()


def co_review_graph(reviews: DataFrame, tile_products: int = TILE_PRODUCTS) -> CoReviewGraph:
    """Graph of products reviewed by the same customers, for tiles of any size.

    The memberships are stored, as both the sizes and the lists read them; so are the lists.
    """
    memberships = cut_lineage(_memberships(reviews))
    sizes = memberships.groupBy("customer_id").agg(F.count("*").alias("n"))
    large_ids = cut_lineage(sizes.filter(F.col("n") > tile_products).select("customer_id"))
    large = None
    if not large_ids.isEmpty():
        large = cut_lineage(memberships.join(large_ids, "customer_id", "left_semi"))
        memberships = memberships.join(large_ids, "customer_id", "left_anti")
    lists = memberships.groupBy("customer_id").agg(F.collect_list("product_id").alias("ids"))
    return CoReviewGraph(cut_lineage(lists), large, tile_products)


def _tile_lists(members: DataFrame, id_col: str, tile_products: int) -> DataFrame:
    """(src, ids) of large customers: every id of a customer with each of the customer's tiles."""
    tiles = members.groupBy("customer_id").agg(F.ceil(F.count("*") / tile_products).cast("int").alias("tiles"))
    lists = (
        members.join(tiles, "customer_id")
        .withColumn("tile", F.pmod(F.xxhash64(id_col), F.col("tiles")).cast("int"))
        .groupBy("customer_id", "tiles", "tile")
        .agg(F.collect_list(id_col).alias("ids"))
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    spread = lists.select("customer_id", "tile", "ids", other)
    left = spread.select("customer_id", F.col("tile").alias("a"), F.col("other").alias("b"), F.col("ids").alias("srcs"))
    right = spread.select("customer_id", F.col("other").alias("a"), F.col("tile").alias("b"), "ids")
    return left.join(right, ["customer_id", "a", "b"]).select(F.explode("srcs").alias("src"), "ids")


def _gathered(sent: DataFrame) -> DataFrame:
    """(src, ids) with all ids sent to a product; those of a hub are dealt over several rows."""
    reach = sent.groupBy("src").agg(F.sum(F.size("ids")).alias("n")).filter(F.col("n") > GATHERED_IDS)
    hubs = cut_lineage(reach.select("src", F.ceil(F.col("n") / GATHERED_IDS).cast("int").alias("parts")))
    keys = ["src"]
    if not hubs.isEmpty():
        keys.append("part")
        part = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
        dealt = sent.join(hubs, "src", "left").select("src", "ids", "parts", part)
        own = F.filter("ids", lambda i: F.pmod(F.xxhash64(i), F.col("parts")) == F.col("part"))
        sent = dealt.select("src", F.when(F.col("parts").isNull(), F.col("ids")).otherwise(own).alias("ids"), "part")
    # Dealt before it is grouped, so no task sorts lists that it only passes on.
    grouped = sent.filter(F.size("ids") > 0).repartition(*keys).groupBy(*keys)
    return grouped.agg(F.flatten(F.collect_list("ids")).alias("ids")).select("src", "ids")


def _sent(lists: DataFrame) -> DataFrame:
    return lists.select(F.explode("ids").alias("src"), "ids")


def co_review_edges(graph: CoReviewGraph) -> DataFrame:
    """The full edge list (src, dst) in both directions, each edge once."""
    sent = _sent(graph.lists)
    if graph.large is not None:
        sent = sent.unionByName(_tile_lists(graph.large, "product_id", graph.tile_products))
    edges = _gathered(sent).select("src", F.explode(F.array_distinct("ids")).alias("dst"))
    return edges.filter(F.col("src") != F.col("dst"))


def _both_ways(pairs: DataFrame) -> DataFrame:
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return pairs.select(F.inline(ways))


def _repeats(lists: DataFrame) -> DataFrame:
    """(src, dst): a row for each list beyond the first that holds both, in both directions."""
    later = F.filter("ids", lambda i: i > F.col("src"))
    gathered = _gathered(_sent(lists).select("src", later.alias("ids")))
    in_order = F.sort_array("ids")
    following = F.slice(in_order, 2, F.greatest(F.size("ids") - 1, F.lit(0)))
    again = F.array_compact(F.zip_with(in_order, following, lambda a, b: F.when(a == b, a)))
    return _both_ways(gathered.select("src", F.explode(again).alias("dst")))


def _classes(graph: CoReviewGraph) -> tuple[DataFrame, DataFrame]:
    """(id, class) of the products of large customers, and the pairs of classes that share one."""
    signed = cut_lineage(
        graph.large.groupBy(F.col("product_id").alias("id")).agg(F.sort_array(F.collect_list("customer_id")).alias("signature"))
    )
    named = signed.groupBy("signature").agg(F.min("id").alias("class"))
    classes = cut_lineage(signed.join(named, "signature").select("id", "class"))
    members = cut_lineage(named.select(F.explode("signature").alias("customer_id"), "class"))
    links = _gathered(_tile_lists(members, "class", graph.tile_products))
    return classes, cut_lineage(links.select("src", F.explode(F.array_distinct("ids")).alias("dst")))


def _met_in_both(lists: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """(src, dst) of products that meet in a list and at a large customer as well, in both directions."""
    members = lists.select("customer_id", F.explode("ids").alias("id")).join(classes, "id")
    own = members.groupBy("customer_id").agg(F.collect_list(F.struct("id", "class")).alias("ids"))
    later = F.filter("ids", lambda i: i["id"] > F.col("src.id"))
    pairs = _sent(own).select("src", F.explode(later).alias("dst")).distinct()
    linked = links.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    met = pairs.join(linked, (F.col("src.class") == F.col("a")) & (F.col("dst.class") == F.col("b")), "left_semi")
    return _both_ways(met.select(F.col("src.id").alias("src"), F.col("dst.id").alias("dst")))


def _part(column: str):
    return F.pmod(F.xxhash64(column), F.lit(HUB_PARTS)).cast("int").alias("part")


def _laid_out(graph: CoReviewGraph) -> _Layout:
    """Lists and repeats stored once in the layout that every round joins on."""
    spark = graph.lists.sparkSession
    parts = shuffle_partitions(spark)

    def stored(df: DataFrame, *keys: str) -> DataFrame:
        return cut_lineage_keeping_layout(df.repartition(parts, *keys).sortWithinPartitions(*keys))

    members = graph.lists.select("customer_id", F.explode("ids").alias("src"))
    own = members.groupBy("src").agg(F.count("*").alias("n"))
    repeats = _repeats(graph.lists).withColumn("n", F.lit(1).cast("long"))
    repeats = repeats.unionByName(own.select("src", F.col("src").alias("dst"), "n"))
    classes = links = None
    if graph.large is not None:
        classes, links = _classes(graph)
        both = _met_in_both(graph.lists, classes, links)
        both = both.unionByName(classes.select(F.col("id").alias("src"), F.col("id").alias("dst")))
        repeats = repeats.unionByName(both.withColumn("n", F.lit(1).cast("long")))
    return _Layout(
        stored(members.select("src", _part("customer_id"), "customer_id"), "src", "part"),
        stored(members.select("customer_id", F.col("src").alias("dst")), "customer_id"),
        stored(repeats.select("src", _part("dst"), "dst", "n"), "src", "part"),
        classes,
        links,
    )


def neighbour_sums(layout: _Layout, values: DataFrame) -> DataFrame:
    """For every product the sum of `value` over its neighbours: (id, value) → (id, total)."""
    spread = values.select(
        F.col("id").alias("src"), "value", F.explode(F.array(*map(F.lit, range(HUB_PARTS)))).alias("part")
    )
    of_list = layout.by_product.join(spread, ["src", "part"]).groupBy("customer_id").agg(F.sum("value").alias("value"))
    counted = layout.by_customer.join(of_list, "customer_id").select(F.col("dst").alias("id"), "value")
    surplus = layout.repeats.join(spread, ["src", "part"]).select(F.col("dst").alias("id"), (-F.col("n") * F.col("value")).alias("value"))
    summed = counted.unionByName(surplus)
    if layout.classes is not None:
        of_class = values.join(layout.classes, "id").groupBy(F.col("class").alias("src")).agg(F.sum("value").alias("value"))
        met = layout.class_links.join(of_class, "src").groupBy(F.col("dst").alias("class")).agg(F.sum("value").alias("value"))
        summed = summed.unionByName(layout.classes.join(met, "class").select("id", "value"))
    return summed.groupBy("id").agg(F.sum("value").alias("total"))


def _degrees(graph: CoReviewGraph, layout: _Layout) -> DataFrame:
    """A sum of ones over the neighbours; whole numbers are exact."""
    products = graph.lists.select(F.explode("ids").alias("id"))
    if graph.large is not None:
        products = products.unionByName(graph.large.select(F.col("product_id").alias("id")))
    ones = products.distinct().withColumn("value", F.lit(1.0))
    return neighbour_sums(layout, ones).filter(F.col("total") > 0).select("id", F.col("total").cast("long").alias("degree"))


def degrees(graph: CoReviewGraph) -> DataFrame:
    """Number of neighbours of every product that has one."""
    return _degrees(graph, _laid_out(graph))


def graph_stats(graph: CoReviewGraph) -> DataFrame:
    """Number of nodes and of directed edges."""
    return degrees(graph).agg(
        F.count("*").alias("nodes"), F.coalesce(F.sum("degree"), F.lit(0)).alias("edges")
    )


def pagerank(
    graph: CoReviewGraph, damping: float = 0.85, max_iter: int = 100, tol: float = 1e-6
) -> DataFrame:
    """PageRank (id, rank) from a uniform start, until the L1 change is below nodes · tol.

    Edges run both ways, so every node has one and no rank is lost at a dead end. A round sends each
    rank to the lists of its product and their sums back; only the L1 change comes back to the driver. An empty graph gives an empty result; `NotConverged` is raised if
    `max_iter` rounds do not reach the tolerance.
    """
    layout = _laid_out(graph)
    rounds = Rounds(graph.lists.sparkSession)
    nodes = cut_lineage(_degrees(graph, layout))
    n = nodes.count()
    if not n:
        return nodes.select("id", F.lit(0.0).alias("rank"))
    current = nodes.select("id", "degree", F.lit(1.0 / n).alias("rank"))
    for _ in range(max_iter):
        shares = current.select("id", (F.col("rank") / F.col("degree")).alias("value"))
        rank = (1.0 - damping) / n + damping * F.coalesce("total", F.lit(0.0))
        updated = (
            current.select("id", "degree", F.col("rank").alias("previous"))
            .join(neighbour_sums(layout, shares), "id", "left")
            .select("id", "degree", rank.alias("rank"), F.abs(rank - F.col("previous")).alias("change"))
        )
        current = rounds.store(updated)
        if current.agg(F.sum("change")).first()[0] < n * tol:
            return current.select("id", "rank")
    raise NotConverged(f"PageRank did not converge in {max_iter} rounds")


def hits(graph: CoReviewGraph, max_iter: int = 100, tol: float = 1e-8) -> DataFrame:
    """Hub and authority scores (id, hub, authority), each summing to 1.

    Both half steps of a round sum over neighbours, as every edge has its reverse. `NotConverged` is
    raised if `max_iter` rounds do not reach the tolerance.
    """
    layout = _laid_out(graph)
    rounds = Rounds(graph.lists.sparkSession)
    nodes = cut_lineage(_degrees(graph, layout).select("id"))
    n = nodes.count()
    current = nodes.select("id", F.lit(1.0 / max(n, 1)).alias("hub"), F.lit(1.0 / max(n, 1)).alias("authority"))
    if not n:
        return current
    for _ in range(max_iter):
        authority = neighbour_sums(layout, current.select("id", F.col("hub").alias("value"))).withColumnRenamed("total", "authority")
        hub = neighbour_sums(layout, authority.select("id", F.col("authority").alias("value")))
        # One table for the round; scores are divided by their sums when they are read.
        raw = rounds.store(
            current.select("id", F.col("hub").alias("previous")).join(authority, "id").join(hub.withColumnRenamed("total", "hub"), "id")
        )
        sums = raw.agg(F.sum("authority").alias("authority"), F.sum("hub").alias("hub")).first()
        current = raw.select(
            "id", "previous", (F.col("hub") / sums["hub"]).alias("hub"), (F.col("authority") / sums["authority"]).alias("authority")
        )
        if current.agg(F.sum(F.abs(F.col("hub") - F.col("previous")))).first()[0] < tol:
            return current.select("id", "hub", "authority")
    raise NotConverged(f"HITS did not converge in {max_iter} rounds")
