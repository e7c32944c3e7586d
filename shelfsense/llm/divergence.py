"""Audit of how the words of a source differ from those of other sources of its language.

Words are cut by one `bytes.translate`, which lowers A-Z and turns every other ASCII character into a
blank, and `bytes.split`. A counter for each document gives the occurrences of its words and that it
holds them. A task adds these up by language and source before anything is shuffled, and only words
that occur travel: a group's count of 0 is never a row.

Sums over all words of a language compare every two of its sources. They are taken in blocks of
words: a block has the shares of its words in every source of the language, and gives a partial sum
for each two sources. Blocks have a bounded number of cells, so neither a language with very many
words nor one with very many sources meets in one task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.llm.common import blobs, partitions, stored

LEAST_DOCUMENTS = 3
LARGEST_RANK = 200
SCALE = 1_000_000_000
BLOCK_CELLS = 1 << 20
HELD_ENTRIES = 300_000
#: Letters as they are or lowered, bytes of other characters as they are, the rest blank.
LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


COUNTED = "lang string, source string, term string, n long, documents long"


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents), summed within tasks; a group without words has a row with a null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
        entries = 0

        def close() -> pa.RecordBatch:
            columns: list[list] = [[] for _ in range(5)]
            for (lang, source), terms in held.items():
                texts = [term.decode() for term in terms] or [None]
                pairs = list(terms.values()) or [[0, 0]]
                for column, values in zip(columns, ([lang] * len(texts), [source] * len(texts), texts, [p[0] for p in pairs], [p[1] for p in pairs])):
                    column += values
            kinds = [pa.string()] * 3 + [pa.int64()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "source", "term", "n", "documents"])

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), blobs(batch.column("text"))):
                group = held[lang, source]
                before = len(group)
                for term, n in Counter(words(text)).items():
                    pair = group.get(term)
                    if pair is None:
                        group[term] = [n, 1]
                    else:
                        pair[0] += n
                        pair[1] += 1
                entries += len(group) - before
                if entries > HELD_ENTRIES:
                    yield close()
                    held.clear()
                    entries = 0
        if held:
            yield close()

    return docs.mapInArrow(run, COUNTED)


def _share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kinds)); decimals hold the product at any count."""
    exact = lambda c: c.cast("decimal(20,0)")
    top, below = F.lit(SCALE).cast("decimal(10,0)") * exact(count + 1), exact(total + kinds)
    return F.when(total + kinds > 0, F.lit(1) + F.call_function("div", top, below)).cast("long")


def _difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, from blocks of its words.

    `shares` has (lang, block, source, place, p): words of a block in order; `groups` has (lang, block,
    source, width, p): every source of the language, the words of the block, and the share of a word
    that the source does not have.
    """

    def block(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        kind, place, p = (table.column(name).to_numpy() for name in ("kind", "place", "p"))
        names = table.column("source").to_pylist()
        rows = np.flatnonzero(kind == 0)
        width = int(place[rows[0]])
        own = {names[i]: at for at, i in enumerate(rows.tolist())}
        dense = np.repeat(p[rows][:, None], width, 1)
        inside = np.flatnonzero(kind == 1)
        dense[[own[names[i]] for i in inside.tolist()], place[inside]] = p[inside]
        lang = table.column("lang")[0].as_py()
        sources = pa.array(own, pa.string())
        for at, source in enumerate(own):
            apart = dense[at] - dense
            value = (apart * apart // dense).sum(1)
            others = np.flatnonzero(np.arange(len(own)) != at)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(others), pa.string()), pa.array([source] * len(others), pa.string()), sources.take(pa.array(others)), pa.array(value[others])],
                ["lang", "source", "item", "value"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, number = batch.column("lang").to_pylist(), batch.column("block").to_numpy()
            keys = list(zip(lang, number.tolist()))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for begin, end in zip(cuts, cuts[1:]):
                if held and keys[begin] != last:
                    yield from block(held)
                    held = []
                last = keys[begin]
                held.append(batch.slice(begin, end - begin))
        if held:
            yield from block(held)

    rows = groups.select("lang", "block", F.lit(0).alias("kind"), "source", F.col("width").alias("place"), "p")
    rows = rows.unionByName(shares.select("lang", "block", F.lit(1).alias("kind"), "source", "place", "p"))
    dealt = rows.repartition(partitions(rows.sparkSession), "lang", "block").sortWithinPartitions("lang", "block", "kind", "source")
    partial = dealt.mapInArrow(run, "lang string, source string, item string, value long")
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _placed(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, term, block, place): kept words dealt into the blocks of their language by hash, and numbered there."""
    dealt = kept.join(sizes.select("lang", "blocks"), "lang").select("lang", "term", F.pmod(F.xxhash64("term"), "blocks").alias("block"))
    return dealt.withColumn("place", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1)


def divergence(docs: DataFrame) -> DataFrame:
    """How every source differs from the others of its language: (lang, source, part, item, value, rank).

    Words are runs of letters A-Z and of characters beyond ASCII, with only A-Z in lower case. A
    language keeps the words that at least three of its documents hold; V is their number. A source's
    share of a kept word is p = 1 + floor(10^9 (count + 1) / (N + V)), N being its occurrences of kept
    words; a language has shares likewise. Two shares differ by floor((p - q)^2 / q).

    Part `pair` has every other source of the language with the sum over all kept words, 0 if there
    are none; part `term` the 200 kept words of the source with the largest difference to the
    language, of those that it uses more often. Ranks count from 1 in each part of a source, by
    descending value and ascending item.

    Null texts, languages and sources are empty strings. Rows count as often as they occur. An empty
    table gives no rows. Other columns are ignored.
    """
    columns = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")]
    counts = _counted(docs.select(*columns)).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    counts = stored(counts)
    groups = counts.select("lang", "source").distinct()
    by_term = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("documents").alias("documents"))
    kept = stored(by_term.filter(F.col("documents") >= LEAST_DOCUMENTS).select("lang", "term", "in_lang"))
    used = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang"))

    langs = kept.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("in_lang").alias("lang_total"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(langs, "lang", "left").fillna(0, ["kinds", "lang_total"])
    sizes = stored(sizes.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("kinds") * F.col("sources") / BLOCK_CELLS))))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").fillna(0, ["total"]).join(sizes, "lang")
    groups = stored(groups)

    shares = used.join(groups.drop("sources"), ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("kinds")))
    shares = stored(shares.select("lang", "source", "term", "p", _share(F.col("in_lang"), F.col("lang_total"), F.col("kinds")).alias("q")))

    placed = stored(_placed(kept, sizes))
    widths = placed.groupBy("lang", "block").agg(F.count("*").alias("width"))
    every = groups.select("lang", "source", _share(F.lit(0), F.col("total"), F.col("kinds")).alias("p"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    every = every.join(widths, ["lang", "block"], "left").select("lang", "block", "source", F.coalesce("width", F.lit(0)).cast("int").alias("width"), F.coalesce("p", F.lit(1)).alias("p"))
    inside = shares.join(placed, ["lang", "term"]).select("lang", "block", "source", F.col("place").cast("int").alias("place"), "p")
    pairs = _pair_values(inside, every).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _difference(F.col("p"), F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    largest = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= LARGEST_RANK)
    return ranked.unionByName(largest)


_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, row_number() OVER () AS row_id FROM documents),
w AS (SELECT lang, source, row_id, unnest(regexp_extract_all({_LOWER.format('text')}, '{_TERM}')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT row_id) >= 3),
kinds AS (SELECT lang, count(term)::HUGEINT AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 1)) // (total + v) AS p
  FROM totals JOIN kinds USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
lang_shares AS (
  SELECT lang, term, 1 + (1000000000 * (sum(n) + 1)) // (any_value(whole) + any_value(v)) AS q
  FROM counts JOIN kinds USING (lang) JOIN (SELECT lang, sum(total)::HUGEINT AS whole FROM totals GROUP BY lang) USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS one, y.source AS two, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.one = a.source AND s.two = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200"""
