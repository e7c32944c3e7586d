"""Exact Jaccard join of documents on word shingles, with signature trees inside candidate groups.

1. Shingles are counted over all documents. A shingle that no other document has lies in no
   intersection, so a document of which less than the threshold is shared links with nothing. This
   leaves near copies only, whatever passages the other documents share.
2. Equal sets become one representative.
3. Representatives that meet under a minimum hash are compared with a few neighbours in that order.
   This finds most links; the components they form spare the next step most of its work.
4. Linked sets share one of their rarest shingles (prefix filter). Groups by such a shingle that hold
   more than one component get a signature tree: nodes with the OR of their members' bitmaps and
   their range of sizes. A dual traversal drops node pairs whose overlap cannot reach the threshold,
   and pairs within one component. What is left is verified on the whole sets.

No link between different components is lost, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import blobs, mix, partitions, stored, worker_state
from shelfsense.llm.components import connected_components
from shelfsense.session import release_shuffles

WORDS = 5
PERCENT = 75
SEEDS = 3
LEADERS = 8
FANOUT = 8
CACHED_WORDS = 150_000
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 40:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


def shingle_set(text: bytes, words: dict) -> np.ndarray:
    """Distinct 64-bit shingle hashes of a text in ascending order."""
    found = text.lower().split()  # of bytes: only A-Z fold, and only ASCII white space parts
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = len(hashes)
    if not n:
        return hashes
    if n < WORDS:
        total = np.array([n], np.uint64)
        for i in range(n):
            total = mix(hashes[i : i + 1] + total * FACTORS[0])
        return total
    total = np.zeros(n - WORDS + 1, np.uint64)
    for i in range(WORDS):
        total += hashes[i : n - WORDS + 1 + i] * FACTORS[i]
    return np.unique(mix(total))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def least_overlap(a, b, percent: int = PERCENT):
    """Smallest intersection of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray]]:
    words = worker_state("shingles").setdefault("words", _WordHashes())
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), blobs(batch.column("text"))):
            yield doc_id, shingle_set(text, words)


REQUEST = "bucket int, source long, ids binary, sizes binary, counts binary, tokens binary"
ANSWER = "source long, ids binary, sizes binary, counts binary, tokens binary, frequencies binary"


def _requests(sets: Iterator[tuple[object, np.ndarray]], buckets: int, wide: bool) -> Iterator[pa.RecordBatch]:
    """Rows that ask the bucket of each token how frequent it is, a row for each bucket and some documents.

    `source` numbers these documents by the place of their rows; `counts` are their tokens in the bucket.
    """
    from pyspark import TaskContext

    names = [part.split()[0] for part in REQUEST.split(", ")]
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 4
    source = TaskContext.get().partitionId() << 32
    held: list[tuple[object, np.ndarray]] = []

    def close() -> pa.RecordBatch:
        lengths = np.array([len(s) for _, s in held], np.int64)
        ids = np.array([i for i, _ in held], np.int64)
        tokens = np.concatenate([s for _, s in held])
        owner = np.repeat(np.arange(len(held)), lengths)
        bucket = ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")  # documents stay in order inside a bucket
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = []
        for b in range(buckets):
            inside = order[cuts[b] : cuts[b + 1]]
            if len(inside):
                docs, counts = np.unique(owner[inside], return_counts=True)
                part = tokens[inside] if wide else tokens[inside].astype(np.uint32)
                rows.append((b, source, ids[docs].tobytes(), lengths[docs].astype("<u4").tobytes(), counts.astype("<u4").tobytes(), part.tobytes()))
        columns = list(zip(*rows)) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    total = 0
    for doc_id, tokens in sets:
        if len(tokens) and doc_id is not None:
            held.append((doc_id, tokens))
            total += len(tokens)
        if total > 1_000_000:
            yield close()
            held, total, source = [], 0, source + 1
    if held:
        yield close()


def _answers(batches: Iterator[pa.RecordBatch], wide: bool) -> Iterator[pa.RecordBatch]:
    """How many tokens of each document in a request are shared; if `wide`, these tokens and their frequencies."""
    kind = np.uint64 if wide else np.uint32
    names = [part.split()[0] for part in ANSWER.split(", ")]
    held: list[dict] = []

    def close() -> Iterator[pa.RecordBatch]:
        tokens = [np.frombuffer(row["tokens"], kind) for row in held]
        found, times = np.unique(np.concatenate(tokens), return_counts=True)
        for row, own in zip(held, tokens):
            frequency = times[np.searchsorted(found, own)]
            counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
            shared = np.add.reduceat((frequency > 1).astype(np.int64), np.cumsum(counts) - counts)
            keep = frequency > 1
            extra = (own[keep].tobytes(), frequency[keep].astype("<u4").tobytes()) if wide else (b"", b"")
            values = (row["source"], row["ids"], row["sizes"], shared.astype("<u4").tobytes(), *extra)
            arrays = [pa.array([v], pa.binary() if i else pa.int64()) for i, v in enumerate(values)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    bucket = None
    for batch in batches:
        for row in batch.to_pylist():
            if bucket is not None and row["bucket"] != bucket:
                yield from close()
                held = []
            bucket = row["bucket"]
            held.append(row)
    if held:
        yield from close()


def _ask(rows: DataFrame, sets, wide: bool) -> DataFrame:
    """The answers to all requests of one source in one row: (source, parts)."""
    buckets = partitions(rows.sparkSession)
    asked = rows.mapInArrow(lambda batches: _requests(sets(batches), buckets, wide), REQUEST)
    dealt = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    answers = dealt.mapInArrow(lambda batches: _answers(batches, wide), ANSWER)
    columns = ["ids", "sizes", "counts", *(["tokens", "frequencies"] if wide else [])]
    return answers.groupBy("source").agg(F.collect_list(F.struct(*columns)).alias("parts"))


def _together(parts: list[dict], name: str, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(part[name], kind) for part in parts])


def _near(answers: DataFrame) -> DataFrame:
    """Ids of documents of which enough is shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in batch.column("parts").to_pylist():
                ids, first, place = np.unique(_together(parts, "ids", "<i8"), return_index=True, return_inverse=True)
                sizes = _together(parts, "sizes", "<u4")[first].astype(np.int64)
                shared = np.bincount(place, _together(parts, "counts", "<u4")).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[100 * shared >= PERCENT * sizes])], ["doc_id"])

    return answers.mapInArrow(run, "doc_id long").distinct()


def _stored_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray]]:
    for batch in batches:
        for doc_id, tokens in zip(batch.column("doc_id").to_pylist(), batch.column("tokens").to_pylist()):
            yield doc_id, np.frombuffer(tokens, np.uint64)


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    words = np.zeros(bits // 64, np.uint64)
    slot = tokens & np.uint64(bits - 1)
    np.bitwise_or.at(words, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
    return words


BITS = 2048


class SignatureTree:
    """A hierarchy over sets: every node has the OR of its members' bitmaps, their sizes and component.

    `size` is the range of set sizes below a node, `spare` the most tokens that a member has beyond
    its bitmap's bits (tokens that fell on one bit), and `component` is -1 where members differ.
    """

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, components: np.ndarray):
        self.order = np.lexsort((*maps.T[:2], components, sizes))
        maps, sizes, components = maps[self.order], sizes[self.order], components[self.order]
        spare = sizes - np.bitwise_count(maps).sum(1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, spare, components)]
        while len(self.levels[-1][0]) > FANOUT:
            maps, low, high, spare, components = self.levels[-1]
            first = np.arange(0, len(maps), FANOUT)
            same = np.minimum.reduceat(components, first) == np.maximum.reduceat(components, first)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first),
                    np.maximum.reduceat(spare, first), np.where(same, components[first], -1),
                )
            )

    def pairs(self, percent: int = PERCENT) -> np.ndarray:
        """Member pairs of different components that may be linked, by dual traversal from the root.

        Rows (member, member, largest possible overlap).
        """
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        left, right = np.triu_indices(n)
        found = []
        # Pairs wait on a stack in pieces of bounded size, so memory does not grow with the pairs seen.
        stack = [(top, left, right)]
        while stack:
            level, left, right = stack.pop()
            if len(left) > 1 << 16:
                half = len(left) // 2
                stack += [(level, left[:half], right[:half]), (level, left[half:], right[half:])]
                continue
            maps, low, high, spare, components = self.levels[level]
            keep = (components[left] != components[right]) | (components[left] < 0)
            keep &= (100 * high[left] >= percent * low[right]) & (100 * high[right] >= percent * low[left])
            left, right = left[keep], right[keep]
            common = np.bitwise_count(maps[left] & maps[right]).sum(1).astype(np.int64)
            most = common + np.minimum(spare[left], spare[right])
            keep = most >= least_overlap(low[left], low[right], percent)
            left, right, most = left[keep], right[keep], most[keep]
            if level == 0:
                if len(left):
                    found.append(np.c_[self.order[left], self.order[right], most])
                continue
            below = len(self.levels[level - 1][0])
            step = np.arange(FANOUT)
            a = (left[:, None, None] * FANOUT + step[None, :, None]) + np.zeros((1, 1, FANOUT), np.int64)
            b = (right[:, None, None] * FANOUT + step[None, None, :]) + np.zeros((1, FANOUT, 1), np.int64)
            same = np.broadcast_to((left == right)[:, None, None], a.shape)
            real = (a < below) & (b < below) & (~same | (a < b if level == 1 else a <= b))
            if real.any():
                stack.append((level - 1, a[real], b[real]))
        return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def _neighbour_links(sets: DataFrame, seed: int) -> DataFrame:
    """Verified links (a, b) of sets that follow each other in the order of their smallest hashes.

    Rows are dealt by range over two hashes, so a hot minimum is spread over tasks. Within a run of
    one minimum a row is compared with the last few rows that began a family of their own; families that
    a row has linked count as one from then on, so the links of a run do not exceed its rows and families.
    """
    salt = np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % (1 << 64))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for tokens in batch.column("tokens").to_pylist():
                hashes = mix(np.frombuffer(tokens, np.uint64) ^ salt)
                two = np.partition(hashes, 1)[:2] if len(hashes) > 1 else np.repeat(hashes, 2)
                keys.append(two.astype(np.int64))
            keys = np.array(keys, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tokens"), pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["doc_id", "tokens", "k1", "k2"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaders = None, []
        for batch in batches:
            links = []
            for row in zip(*(batch.column(name).to_pylist() for name in ("k1", "doc_id", "tokens"))):
                if row[0] != key:
                    key, leaders = row[0], []
                tokens = np.frombuffer(row[2], np.uint64)
                # One link for each group of leaders that links connect already; it makes them one group.
                alike: dict[int, int] = {}
                for other, theirs, group in leaders:
                    if group not in alike and similar(tokens, theirs):
                        alike[group] = other
                links += [(row[1], other) for other in alike.values()]
                if len(alike) > 1:
                    first = next(iter(alike))
                    leaders = [(other, theirs, first if group in alike else group) for other, theirs, group in leaders]
                if not alike:
                    leaders = [(row[1], tokens, row[1]), *leaders[: LEADERS - 1]]
            columns = list(zip(*links)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    rows = sets.select("doc_id", "tokens").mapInArrow(keyed, "doc_id long, tokens binary, k1 long, k2 long")
    dealt = rows.repartitionByRange(partitions(sets.sparkSession), "k1", "k2").sortWithinPartitions("k1", "k2", "doc_id")
    return dealt.mapInArrow(compare, "a long, b long")


def _prefixes(answers: DataFrame) -> DataFrame:
    """Prefix tokens (token, doc_id, n, band) from the shared tokens of each representative.

    A linked set has at least `least` tokens in common, all of them shared ones, so it must have one
    of the `s - least + 1` rarest. A row goes to the band of its size and to the next one, since a
    linked set is at most a band larger.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in batch.column("parts").to_pylist():
                docs, sizes = _together(parts, "ids", "<i8"), _together(parts, "sizes", "<u4").astype(np.int64)
                row = np.repeat(np.arange(len(docs)), _together(parts, "counts", "<u4"))
                tokens, times = _together(parts, "tokens", "<u8"), _together(parts, "frequencies", "<u4")
                order = np.lexsort((tokens, times, docs[row]))
                doc, token, n = docs[row][order], tokens[order].astype(np.int64), sizes[row][order]
                if not len(doc):
                    continue
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                length = np.diff(np.r_[first, len(doc)])
                rank = np.arange(len(doc)) - np.repeat(first, length)
                inside = rank < np.repeat(length, length) - -(-PERCENT * n // 100) + 1
                doc, token, n = doc[inside], token[inside], n[inside]
                band = (np.log(n) / np.log(100 / PERCENT)).astype(np.int64)
                columns = [np.r_[token, token], np.r_[doc, doc], np.r_[n, n], np.r_[band, band + 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "doc_id", "n", "band"])

    return answers.mapInArrow(run, "token long, doc_id long, n long, band long")


def _group_pairs(rows: DataFrame, best_only: bool) -> DataFrame:
    """Candidate pairs (a, b) from rows (token, band, doc_id, n, component, bitmap), grouped by token and band.

    `best_only` gives the likeliest pair for each two components of a group.
    """

    def traverse(held: list[tuple]) -> np.ndarray:
        ids, component = np.array([r[2] for r in held], np.int64), np.array([r[4] for r in held], np.int64)
        tree = SignatureTree(np.array([np.frombuffer(r[5], np.uint64) for r in held]), np.array([r[3] for r in held], np.int64), component)
        pairs = tree.pairs()
        if best_only and len(pairs):
            ends = np.sort(component[pairs[:, :2]], axis=1)
            order = np.lexsort((-pairs[:, 2], ends[:, 1], ends[:, 0]))
            ends = ends[order]
            pairs = pairs[order[np.r_[True, (ends[1:] != ends[:-1]).any(1)]]]
        return np.sort(ids[pairs[:, :2]], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out, size = None, [], [], 0
        names = ["token", "band", "doc_id", "n", "component", "bitmap"]

        def flush() -> pa.RecordBatch:
            pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in pairs.T.copy()], ["a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in names)):
                if row[:2] != key:
                    if len(held) > 1:
                        out.append(traverse(held))
                        size += len(out[-1])
                    key, held = row[:2], []
                    if size > 500_000:
                        yield flush()
                        out, size = [], 0
                held.append(row)
        if len(held) > 1:
            out.append(traverse(held))
        yield flush()

    dealt = rows.repartition(partitions(rows.sparkSession), "token", "band").sortWithinPartitions("token", "band", "doc_id")
    return dealt.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(name).to_pylist() for name in ("left", "right"))
            keep = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("left"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("right"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Components of near copies: (doc_id, n_shingles, component_id), a row for each document.

    Words are runs of non-blank characters with A-Z in lower case; a set holds the distinct five-word
    shingles, or the whole sequence where there are fewer words. Two documents link where 100 times
    the intersection is at least 75 times the union. A document without words, or null, has size 0
    and is a component of its own. Rows with the same doc_id are one node; their rows stay. A row
    with a null doc_id links with nothing and has a null component. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    near = stored(_near(_ask(docs, _set_rows, wide=False)))
    release_shuffles(spark)  # all shingles of all documents; no later step reads them

    def as_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            rows = list(_set_rows(iter([batch])))
            tokens = [s.tobytes() for _, s in rows]
            maps = [bitmap(s, BITS).tobytes() for _, s in rows]
            digests = [hashlib.blake2b(t, digest_size=16).digest() for t in tokens]
            columns = [pa.array([i for i, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, pa.binary()) for c in (digests, tokens, maps))], ["doc_id", "n", "digest", "tokens", "bitmap"])

    near_sets = docs.join(near, "doc_id", "left_semi").mapInArrow(as_rows, "doc_id long, n long, digest binary, tokens binary, bitmap binary")
    near_sets = stored(near_sets.filter("n > 0"))
    members = stored(near_sets.groupBy("digest").agg(F.min("doc_id").alias("rep")).join(near_sets.select("digest", "doc_id").distinct(), "digest"))
    chosen = members.select(F.col("rep").alias("doc_id"), "digest").distinct()
    sets = stored(near_sets.join(chosen, ["doc_id", "digest"], "left_semi"))
    node_links = members.filter("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))

    links = spark.createDataFrame([], "a long, b long")
    for seed in range(SEEDS):
        links = links.unionAll(_neighbour_links(sets, seed))
    links = stored(links)
    release_shuffles(spark)
    prefixes = stored(_prefixes(_ask(sets.select("doc_id", "tokens"), _stored_sets, wide=True)))
    release_shuffles(spark)
    maps = sets.select("doc_id", "bitmap").dropDuplicates(["doc_id"])
    # The likeliest pairs first: what they link need not be compared again. Then all the others.
    for best_only in (True, False):
        found = connected_components(links)
        labelled = prefixes.join(found, prefixes["doc_id"] == found["node"], "left").select(
            "token", "band", "doc_id", "n", F.coalesce("component", "doc_id").alias("component")
        )
        mixed = labelled.groupBy("token", "band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
        rows = labelled.join(mixed.select("token", "band"), ["token", "band"], "left_semi")
        pairs = stored(_group_pairs(rows.join(maps, "doc_id"), best_only).distinct())
        links = links.unionAll(stored(_verified(pairs, sets)))
        release_shuffles(spark)
    components = connected_components(node_links.unionAll(links))
    ids = components.select(F.col("node").alias("doc_id"), F.col("component"))

    sizes = docs.mapInArrow(_sizes, "doc_id long, n_shingles long")
    return sizes.join(ids, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(_set_rows(iter([batch])))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for _, s in rows], pa.int64())], ["doc_id", "n_shingles"])
