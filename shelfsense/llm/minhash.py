"""Near copies by an inverted join on the coordinates of minimum-hash signatures.

1. Every set of word shingles gets `COORDINATES` minima. Equal sets become one node.
2. A node is posted under each coordinate and value. Values that no other node has match nothing, so a
   node of which fewer than `MATCHES` values are shared is done.
3. Two signatures with `MATCHES` equal coordinates have one in common among the `COORDINATES - MATCHES + 1`
   rarest of each (prefix lists). Only these lists are merged; the longer ones are skipped, and their
   coordinates are counted on the two signatures.
4. Collisions in the prefix lists are counted first against one node of each list, the likeliest of
   another component: that links most copies. Then lists that still hold several components are merged,
   first for the best partner of each node, and in the end in full. Pairs above the match threshold that
   a bitmap of the shingles does not rule out are confirmed on the whole sets. In the end a cell of lists
   gets the sets of its nodes that have such pairs, and gives a spanning forest of its components, not all links.

Two sets of similarity 0.85 or more have fewer than `MATCHES` equal coordinates with a probability of at
most 2.4e-6 (the binomial tail at 0.85); no other step can lose a link between components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import blobs, mix, partitions, slices, stored, worker_state
from shelfsense.llm.components import connected_components

WORDS = 5
PERCENT = 85
COORDINATES = 64
MATCHES = 40
TILE = 512
SLICE_BYTES = 1 << 20
PART_BYTES = 1 << 26
CACHED_WORDS = 150_000
LONGEST_CACHED = 40
SEEDS = mix(np.arange(1, COORDINATES + WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class _Words(dict):
    """Hashes of words, computed on first use; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


def shingles(text: bytes, words: dict) -> np.ndarray:
    """Distinct 64-bit hashes of the five-word shingles, ascending; fewer words are one shingle, none give none."""
    found = text.lower().split()  # bytes fold A-Z only and part at ASCII white space only
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    width = min(WORDS, len(hashes))
    if not width:
        return hashes
    count = len(hashes) - width + 1
    total = np.full(count, width, np.uint64)
    for i in range(width):
        total += hashes[i : i + count] * SEEDS[COORDINATES + i]
    return np.unique(mix(total))


def signature(tokens: np.ndarray) -> np.ndarray:
    """The smallest 32-bit value of the set in each of the hash orders."""
    seeds = SEEDS[:COORDINATES, None]
    least = np.full(COORDINATES, ~np.uint64(0))
    for start in range(0, len(tokens), 2048):
        least = np.minimum(least, ((tokens[start : start + 2048] ^ seeds) * seeds).min(1))
    return (least >> np.uint64(32)).astype("<u4")


def fold(tokens: np.ndarray) -> bytes:
    """A bitmap of the set with four to eight bits a shingle; its length is a power of two."""
    bits = 1 << max(6, int(4 * len(tokens) - 1).bit_length())
    flags = np.zeros(bits, bool)
    flags[(tokens >> np.uint64(20)) & np.uint64(bits - 1)] = True
    return np.packbits(flags).tobytes()


def linked(both, a, b):
    """Whether an intersection of `both` links sets of sizes a and b."""
    return 100 * both >= PERCENT * (a + b - both)


def _read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    words = worker_state("minhash").setdefault("words", _Words())
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            yield batch, [shingles(text, words) for text in blobs(batch.column("text"))]


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, n, digest, signature) of every row; the last two are null for a set without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _read_sets(batches):
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            signatures = [signature(s).tobytes() if len(s) else None for s in sets]
            columns = [batch.column("doc_id"), pa.array(map(len, sets), pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "signature"])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, signature binary")


def _keys(nodes: DataFrame) -> DataFrame:
    """(key, node): a row for each coordinate and value of a signature."""
    lead = np.arange(COORDINATES, dtype=np.int64) << 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4").reshape(-1, COORDINATES)
                keys = (values.astype(np.int64) | lead).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(batch.column("node").to_numpy(), COORDINATES))], ["key", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "key long, node long")


def _prefix_lists(nodes: DataFrame) -> DataFrame:
    """Postings (key, node) under the rarest values of nodes that share at least `MATCHES` of theirs.

    Of a node's prefix, values that no other node has need no list. They are the rarest, so of s
    shared values s - MATCHES + 1 are in the prefix.
    """
    keys = _keys(nodes)
    shared = keys.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1")
    own = keys.join(shared, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("times", "key"))).alias("all"))
    prefix = own.filter(F.size("all") >= MATCHES).select("node", F.slice("all", 1, F.size("all") - (MATCHES - 1)).alias("prefix"))
    return prefix.select("node", F.explode("prefix.key").alias("key")).select("key", "node")


def _node_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, signature, prefix, bitmap, tokens) of wanted nodes, read from one of their documents again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _read_sets(batches):
            digests = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())
            rows = [pa.array([f(s) for s in sets], pa.binary()) for f in (lambda s: s.tobytes(), lambda s: fold(s) if len(s) else b"")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), digests, *rows], ["doc_id", "digest", "tokens", "bitmap"])

    texts = docs.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text")
    found = texts.mapInArrow(run, "doc_id long, digest binary, tokens binary, bitmap binary").dropDuplicates(["doc_id", "digest"])
    return found.join(wanted, ["doc_id", "digest"]).select("node", "n", "signature", "prefix", "bitmap", "tokens")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that are linked, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
                keep.append(bool(linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    two = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _with_components(postings: DataFrame, components: DataFrame) -> DataFrame:
    """(key, node, component, size); a node without links is its own component. Lists of one component go."""
    rows = postings.join(components, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    lists = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    return rows.join(lists.filter("low <> high").select("key", "size"), "key").select("key", "node", "component", "size")


def _likeliest_pairs(rows: DataFrame) -> DataFrame:
    """One pair (a, b) for each node: with the first or last node of its lists that it collides with most often.

    A list offers its nodes of the least and of the greatest component, so the work is linear in the
    lists however long they are.
    """
    ends = rows.groupBy("key").agg(F.min(F.struct("component", "node")).alias("low"), F.max(F.struct("component", "node")).alias("high"))
    other = F.when(F.col("low.component") != F.col("component"), F.col("low.node")).otherwise(F.col("high.node"))
    counted = rows.join(ends, "key").select("node", other.alias("other")).groupBy("node", "other").agg(F.count("*").alias("collisions"))
    best = counted.groupBy("node").agg(F.max(F.struct("collisions", (-F.col("other")).alias("nearest"))).alias("best"))
    other = -F.col("best.nearest")
    return best.select(F.least("node", other).alias("a"), F.greatest("node", other).alias("b")).distinct()


def _short(rows: DataFrame) -> DataFrame:
    """Lists that are no longer than a tile, each one cell: (key, cell, side, node, component)."""
    return rows.filter(F.col("size") <= TILE).select("key", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("side"), "node", "component")


def _cells(rows: DataFrame) -> DataFrame:
    """Cut lists into cells (key, cell, side, node, component); a longer list has one for each two of its tiles.

    In a cell of two tiles `side` is 1 or 2, since pairs of one tile meet in a cell of their own; otherwise 0.

    A component with more than a tile's nodes has tiles of its own; a pair of such tiles of one
    component is left out. Smaller components share tiles. So a list of m nodes, most of them in one
    component, has about m / TILE cells, and no task sees more than two tiles of a list at once.
    """
    short, rows = _short(rows), rows.filter(F.col("size") > TILE).drop("size")
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("size"))
    small = F.col("size") <= TILE
    lists = sizes.groupBy("key").agg(F.sum(F.when(small, F.col("size")).otherwise(0)).alias("rest"))
    own = sizes.filter(~small)
    parts = F.ceil(F.col("rest") / TILE)
    shared_tile = F.pmod(F.xxhash64("component"), F.greatest(parts, F.lit(1)))
    own_tile = F.pmod(F.xxhash64("node", F.lit(7)), F.ceil(F.col("size") / TILE))
    placed = rows.join(own, ["key", "component"], "left").join(lists, "key").select(
        "key", "node", "component",
        F.when(F.col("size").isNull(), F.lit(None)).otherwise(F.col("component")).alias("family"),
        F.when(F.col("size").isNull(), shared_tile).otherwise(own_tile).cast("long").alias("tile"),
    )
    placed = placed.withColumn("tile", F.struct(F.coalesce("family", F.lit(-1)).alias("family"), "tile"))
    tiles = placed.groupBy("key", "tile").agg(F.count("*").alias("size"))
    split = tiles.groupBy("key").agg(F.count("*").alias("n_tiles"))
    one = placed.join(split.filter("n_tiles = 1").select("key"), "key", "left_semi").select("key", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("side"), "node", "component")
    many = tiles.join(split.filter("n_tiles > 1").select("key"), "key", "left_semi").select("key", "tile")
    left, right = many.withColumnRenamed("tile", "one"), many.withColumnRenamed("tile", "two")
    met = left.join(right, "key").filter((F.col("one") <= F.col("two")) & ((F.col("one.family") != F.col("two.family")) | (F.col("one.family") == -1)))
    met = met.withColumn("cell", F.xxhash64("one", "two"))
    pair = F.array(*[F.struct(F.lit(i).cast("long").alias("side"), F.col(tile).alias("tile")) for i, tile in ((1, "one"), (2, "two"))])
    own = F.array(F.struct(F.lit(0).cast("long").alias("side"), F.col("one").alias("tile")))
    sides = met.select("key", "cell", F.inline(F.when(F.col("one") == F.col("two"), own).otherwise(pair)))
    return short.unionByName(one).unionByName(placed.join(sides, ["key", "tile"]).select("key", "cell", "side", "node", "component"))


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of each run of equal values of `keys` in a sorted partition."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(key).to_numpy() for key in keys], 1)
        cuts = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(1), True])
        for begin, end in zip(cuts[:-1], cuts[1:]):
            here = tuple(values[begin])
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            last = here
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


class _Cell:
    """Nodes of a cell in ascending order of their set sizes.

    A pair that shares several prefix lists is met in the list of the least coordinate only.
    """

    def __init__(self, table: pa.Table):
        self.nodes, self.component, self.n, self.side, prefix = (table.column(name).to_numpy() for name in ("node", "component", "n", "side", "prefix"))
        self.component = self.component.copy()
        self.coordinate = int(table.column("key")[0].as_py()) >> 32
        self.marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u4").reshape(-1, COORDINATES)
        self.prefix = (prefix[:, None] >> np.arange(COORDINATES)) & 1 == 1

    def __len__(self) -> int:
        return len(self.nodes)

    def larger(self, i: int) -> list[int]:
        """Places after i of another component, above the match threshold, that meet i here."""
        last = np.searchsorted(self.n, 100 * self.n[i] // PERCENT, "right")
        meet = (self.component[i + 1 : last] != self.component[i]) & ((self.side[i + 1 : last] != self.side[i]) | (self.side[i] == 0))
        near = i + 1 + np.flatnonzero(meet)
        equal = self.marks[near] == self.marks[i]
        enough = equal.sum(1) >= MATCHES
        near, equal = near[enough], equal[enough]
        return near[(equal & self.prefix[near] & self.prefix[i]).argmax(1) == self.coordinate].tolist()


def _possible(own: bytes, other: bytes, n: int, larger: int) -> int:
    """The largest intersection of sets of these sizes that their bitmaps allow, or 0 if it links nothing."""
    small, large = (own, other) if len(own) <= len(other) else (other, own)
    a, b = np.frombuffer(small, np.uint8), np.frombuffer(large, np.uint8)
    if len(a) < len(b):  # bits beyond the shorter map fold onto it
        b = np.bitwise_or.reduce(b.reshape(-1, len(a)), axis=0)
    # A shared shingle has a bit in common; of shingles on one bit all but the first may be shared too.
    spare = min(n - np.bitwise_count(a).sum(dtype=np.int64), larger - np.bitwise_count(b).sum(dtype=np.int64))
    most = min(np.bitwise_count(a & b).sum(dtype=np.int64) + max(spare, 0), n)
    return most if linked(most, n, larger) else 0


def _dealt(cells: DataFrame, sets: DataFrame, keys: list[str], *payload: str) -> DataFrame:
    rows = cells.join(sets.select("node", "n", "signature", "prefix", *payload), "node").select(*keys, "side", "node", "component", "n", "signature", "prefix", *payload)
    return rows.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, "n", "node")


def _best_pairs(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """At most one pair (a, b) for each node, of another component, by the greatest similarity that the bitmaps allow."""

    def best(table: pa.Table) -> list[tuple[float, int, int]]:
        cell, maps = _Cell(table), table.column("bitmap").to_pylist()
        nodes, n = cell.nodes, cell.n
        found: list[tuple[float, int, int]] = []
        for i in range(len(cell) - 1):
            for j in cell.larger(i):
                if most := _possible(maps[i], maps[j], n[i], n[j]):
                    found.append((most / (n[i] + n[j] - most), min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
        met: set[int] = set()
        chosen = []
        for pair in sorted(found, reverse=True):
            if not met.issuperset(pair[1:]):
                chosen.append(pair)
                met.update(pair[1:])
        return chosen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[float, int, int]] = []

        def given() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.float64(), pa.int64(), pa.int64()))], ["alike", "a", "b"])

        for table in _runs(batches, ["key", "cell"]):
            out.extend(best(table))
            if len(out) > 10_000:
                yield given()
        yield given()

    pairs = _dealt(cells, sets, ["key", "cell"], "bitmap").mapInArrow(run, "alike double, a long, b long")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"), F.struct("alike", "a", "b").alias("pair"))
    return ends.groupBy("node").agg(F.max("pair").alias("pair")).select("pair.a", "pair.b").distinct()


def _open_nodes(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Nodes of a cell with a partner there that the bitmaps allow: (key, cell, part, side, node, component).

    A cell whose sets pass `PART_BYTES` is cut into tiles by size, and gets a part for each two tiles that
    may hold linked sets; every other cell is one part.
    """

    def near(table: pa.Table) -> np.ndarray:
        cell, maps = _Cell(table), table.column("bitmap").to_pylist()
        met = np.zeros(len(cell), bool)
        for i in range(len(cell) - 1):
            for j in cell.larger(i):
                if not (met[i] and met[j]) and _possible(maps[i], maps[j], cell.n[i], cell.n[j]):
                    met[i] = met[j] = True
        return np.flatnonzero(met)

    def parts(n: np.ndarray) -> list[np.ndarray]:
        tile = (np.cumsum(8 * n) - 8 * n) // (PART_BYTES // 2)
        tiles = [np.flatnonzero(tile == t) for t in np.unique(tile)]
        if len(tiles) < 3:
            return [np.arange(len(n))]
        reach = [(a, b) for a in range(len(tiles)) for b in range(a + 1, len(tiles)) if linked(n[tiles[a][-1]], n[tiles[a][-1]], n[tiles[b][0]])]
        alone = set(range(len(tiles))).difference(*reach)
        return [np.r_[tiles[a], tiles[b]] for a, b in reach] + [tiles[a] for a in alone]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["key", "cell"]):
            places = near(table)
            for number, part in enumerate(parts(table.column("n").to_numpy()[places])) if len(places) else ():
                rows = table.select(["key", "cell", "side", "node", "component"]).take(places[part])
                columns = [pa.array(rows.column(name).to_numpy()) for name in rows.column_names]
                columns.insert(2, pa.array(np.full(len(part), number, np.int64)))
                yield pa.RecordBatch.from_arrays(columns, ["key", "cell", "part", "side", "node", "component"])

    return _dealt(cells, sets, ["key", "cell"], "bitmap").mapInArrow(run, "key long, cell long, part long, side long, node long, component long")


def _cell_links(parts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b), confirmed on whole sets, that join the components of a part as all its links do.

    Components that a link has joined are one from then on, so a part of m components has fewer than m links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["key", "cell", "part"]):
            cell = _Cell(table)
            tokens = [np.frombuffer(value.as_buffer(), np.uint64) for value in table.column("tokens")]
            maps, n, component = [fold(t) for t in tokens], cell.n, cell.component
            found = []
            for i in range(len(cell) - 1):
                for j in cell.larger(i):
                    if component[i] == component[j] or not _possible(maps[i], maps[j], n[i], n[j]):
                        continue
                    if linked(len(np.intersect1d(tokens[i], tokens[j], assume_unique=True)), n[i], n[j]):
                        found.append((min(cell.nodes[i], cell.nodes[j]), max(cell.nodes[i], cell.nodes[j])))
                        component[component == component[j]] = component[i]
            columns = list(zip(*found)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return _dealt(parts, sets, ["key", "cell", "part"], "tokens").mapInArrow(run, "a long, b long").distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """Near copies of documents: (doc_id, n_shingles, component_id, kept), a row for each document.

    Words are runs of non-blank characters with A-Z in lower case; a set holds the distinct five-word
    shingles, or the whole sequence where there are fewer words. Two documents link where 100 times
    the intersection is at least 85 times the union; `component_id` is the smallest doc_id reachable
    and `kept` is true for the document that has it. A document without words, or null, has size 0
    and is a component of its own. Rows with the same doc_id are one node; their rows stay. A row with
    a null doc_id links with nothing, has a null component and is kept. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(_signed(docs))
    named = signed.filter("doc_id is not null and n > 0")
    nodes = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("signature").alias("signature"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()))  # fixed once stored
    postings = stored(_prefix_lists(nodes))
    coordinate = F.expr("shiftleft(1L, cast(shiftright(key, 32) as int))")
    wanted = nodes.join(postings.groupBy("node").agg(F.bit_or(coordinate).alias("prefix")), "node")
    sets = stored(_node_sets(docs, wanted))

    # Rows of one doc_id are one document, whatever their texts.
    members = named.select("doc_id", "digest").join(nodes.select("digest", "node"), "digest").select("doc_id", "node").distinct()
    members = stored(members)
    several = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z")
    links = stored(members.join(several, "doc_id").filter("node <> a").select("a", F.col("node").alias("b")))
    components = docs.sparkSession.createDataFrame([], "node long, component long")
    # What is linked before the last step only spares that step work.
    for step, rounds in ((_likeliest_pairs, 2), (lambda rows: _best_pairs(_short(rows), sets), None)):
        pairs = stored(step(stored(_with_components(postings, components))))
        links = links.unionAll(stored(_confirmed(pairs, sets)))
        components = connected_components(links, rounds)
    left = stored(_open_nodes(_cells(stored(_with_components(postings, components))), sets))
    components = connected_components(links.unionAll(stored(_cell_links(left, sets))))
    placed = members.join(components, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = placed.join(smallest, "component").select("doc_id", "component_id").distinct()
    return signed.join(found, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("component_id", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
    )
