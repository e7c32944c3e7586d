"""Near-duplicate texts by one-permutation minimum hashing and banded keys; column functions only.

1. A text is the set of hashes of its runs of three tokens. Equal sets are one class.
2. One hash order serves all bins: a shingle falls in a bin by its top bits, and a bin keeps its
   smallest hash. An empty bin borrows the value of a bin that a hash of its number and of the attempt
   names, so equal sets borrow alike (densification).
3. Bins are cut into bands. Classes with an equal band are candidates. Each is compared with the
   smallest class of its band first, and what that links is one component; then classes of different
   components in one band are compared. Classes of a band with very many of them are dealt over
   salts on one side and copied to all salts on the other, so no key is one task's work.
4. Candidates are compared on their whole sets.

Two texts of similarity 0.8 share no band with a probability of (1 - 0.8 ** `ROWS`) ** (`BINS` / `ROWS`),
about 5e-8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.html import bind
from shelfsense.functions.text import ngrams, tokens
from shelfsense.session import Rounds, cut_lineage

SHINGLE = 3
BINS = 128
ROWS = 4
ATTEMPTS = 12
SALTED = 500


def shingle_hashes(text: Column) -> Column:
    """Distinct hashes of the runs of three tokens, ascending; a shorter text is one run, an empty one none."""

    def hashes(words: Column) -> Column:
        short = F.when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
        runs = F.when(F.size(words) >= SHINGLE, ngrams(words, SHINGLE)).otherwise(short)
        return F.array_sort(F.array_distinct(F.transform(runs, lambda run: F.xxhash64(run))))

    return bind(tokens(text), hashes)  # else the text is cut anew for every run


def band_keys(classes: DataFrame) -> DataFrame:
    """(class_id, key): a row for each band of the densified signature of a class (class_id, hashes)."""
    width = (BINS - 1).bit_length()
    hashes = classes.select("class_id", F.explode("hashes").alias("hash"))
    bins = hashes.groupBy("class_id", F.shiftrightunsigned("hash", 64 - width).cast("int").alias("bin")).agg(F.min("hash").alias("least"))
    filled = bins.groupBy("class_id").agg(F.map_from_entries(F.collect_list(F.struct("bin", "least"))).alias("least"), F.min("least").alias("any"))

    def value(number: Column) -> Column:
        borrowed = [F.try_element_at("least", F.pmod(F.xxhash64(number, F.lit(attempt)), F.lit(BINS)).cast("int")) for attempt in range(ATTEMPTS)]
        return F.coalesce(F.try_element_at("least", number), *borrowed, F.col("any"))

    signature = filled.select("class_id", F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value).alias("signature"))
    bands = F.transform(F.sequence(F.lit(0), F.lit(BINS // ROWS - 1)), lambda b: F.xxhash64(b, F.slice("signature", b * ROWS + 1, ROWS)))
    return signature.select("class_id", F.explode(bands).alias("key"))


def _verified(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose sets have a similarity of `least` or more."""
    one = classes.select(F.col("class_id").alias("a"), F.col("hashes").alias("left"))
    two = classes.select(F.col("class_id").alias("b"), F.col("hashes").alias("right"))
    both = pairs.join(one, "a").join(two, "b")
    small, large = F.least(F.size("left"), F.size("right")), F.greatest(F.size("left"), F.size("right"))
    both = both.filter(small >= least * large)
    shared = F.size(F.array_intersect("left", "right"))
    return both.filter(shared >= least * (F.size("left") + F.size("right") - shared)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """Smallest id reachable over links (a, b): (class_id, group_id).

    Each round takes the least label of the neighbours and then the label of that label.
    """
    both = cut_lineage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    near, far = Rounds(links.sparkSession), Rounds(links.sparkSession)
    labels = far.store(both.groupBy(F.col("a").alias("class_id")).agg(F.least(F.min("a"), F.min("b")).alias("group_id")))
    while True:
        offered = both.join(labels, both["b"] == labels["class_id"]).groupBy(F.col("a").alias("class_id")).agg(F.min("group_id").alias("offered"))
        nearer = near.store(labels.join(offered, "class_id").select("class_id", F.col("group_id").alias("before"), F.least("group_id", "offered").alias("group_id")))
        roots = nearer.select(F.col("class_id").alias("group_id"), F.col("group_id").alias("root"))
        jumped = nearer.join(roots, "group_id").select("class_id", F.least("group_id", "root").alias("group_id"), "before")
        labels = far.store(jumped.select("class_id", "group_id", (F.col("group_id") < F.col("before")).alias("changed")))
        if labels.filter("changed").isEmpty():
            return labels.select("class_id", "group_id")


def _across(keys: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes of different groups in one band."""
    rows = keys.join(found, "class_id", "left").select("key", "class_id", F.coalesce("group_id", "class_id").alias("group_id"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("group_id").alias("low"), F.max("group_id").alias("high")).filter("low <> high")
    salts = F.ceil(F.col("size") / SALTED).cast("int")
    mixed = cut_lineage(rows.join(sizes.select("key", salts.alias("salts")), "key"))
    left = mixed.select("key", F.pmod(F.xxhash64("class_id"), "salts").cast("int").alias("salt"), F.col("class_id").alias("a"), F.col("group_id").alias("one"))
    right = mixed.select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("class_id").alias("b"), F.col("group_id").alias("two"))
    return left.join(right, ["key", "salt"]).filter("a < b and one <> two").select("a", "b").distinct()


def near_duplicates(texts: DataFrame, id_col: str, text_col: str, least: float = 0.8) -> DataFrame:
    """Groups of near-duplicate texts: (id, class_id, group_id), a row for each text.

    `class_id` is the smallest id with an equal set of shingles, `group_id` the smallest class reachable
    over pairs of classes with a similarity of `least` or more. Texts without tokens, or null, are
    alone. Ids are unique.
    """
    sets = cut_lineage(texts.select(F.col(id_col).alias("id"), shingle_hashes(F.col(text_col)).alias("hashes")))
    sets = sets.withColumn("digest", F.struct(F.xxhash64("hashes"), F.xxhash64(F.lit(1), "hashes"), F.size("hashes")))
    some = sets.filter(F.size("hashes") > 0)
    members = cut_lineage(some.join(some.groupBy("digest").agg(F.min("id").alias("class_id")), "digest").select("id", "class_id"))
    classes = cut_lineage(sets.join(members.select(F.col("class_id").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("class_id"), "hashes"))
    keys = cut_lineage(band_keys(classes))
    shared = keys.groupBy("key").agg(F.min("class_id").alias("a"), F.count("*").alias("size")).filter("size > 1")
    stars = keys.join(shared.select("key", "a"), "key").filter("class_id > a").select("a", F.col("class_id").alias("b")).distinct()
    links = cut_lineage(_verified(stars, classes, least))
    rest = cut_lineage(_verified(_across(keys, components(links)), classes, least))
    groups = components(links.unionByName(rest))
    return (
        sets.select("id")
        .join(members, "id", "left")
        .join(groups, "class_id", "left")
        .select(
            F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("group_id", "class_id", "id").alias("group_id")
        )
    )
