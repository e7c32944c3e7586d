"""How the tokens of two tokenizers align, and how often each pair of their ids is linked in the corpus.

1. Both tokenizers read the same bytes. Where a token of each ends at the same byte, a group ends;
   tokens whose bytes overlap are linked. Tasks count the id pairs of their links.
2. Distinct pairs are dealt into segments by hash, and every segment gets a minimal perfect hash: bit
   arrays of falling size, in which a pair owns the first bit that no other pair of the level has.
   The rank of that bit is the pair's place in a dense vector. The vectors of counts are added up in
   two levels of a tree.
3. A second pass aligns the documents again and looks every pair up. A place holds its pair as well, so
   a pair that is not in the table is seen.

A word with the space before it is a unit of both tokenizers, so a worker aligns a distinct word once
and adds up what it knows of the words of a text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from shelfsense.llm.common import mix, partitions, stored, worker_state
from shelfsense.llm.tokens import BYTE_SHOWN, cutting_rule

SEGMENT_BITS = 8
SALTS = 8
SLACK = 2  # bits of a level for each pair that is left
SLICE_BYTES = 64 << 20
CACHED_CHUNKS = 450_000
CACHED_TOKENS = 4_000_000
LONGEST_CACHED = 60
TEXTS = 200  # read at a time
JOINED = 200  # chunks that A reads as one text
#: A space behind anything but white space, or a mark but the apostrophe behind a letter: no token of A covers both.
CUT = re.compile(r"(?<=\S)(?= )|(?<=[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f])(?=[!-&(-/:-@\[-`{-~])")
LETTER_AND_MARK = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f][!-&(-/:-@\[-`{-~]")


def segment_of(pairs: np.ndarray) -> np.ndarray:
    return (mix(pairs) >> np.uint64(64 - SEGMENT_BITS)).astype(np.int64)


def _slot(pairs: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mix(pairs ^ seed) % np.asarray(size).astype(np.uint64)).astype(np.int64)


def build_hash(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A minimal perfect hash of distinct pairs: (bits of each level, all bits in 64-bit words)."""
    sizes, words, level = [], [], 0
    while len(pairs):
        size = -(-SLACK * len(pairs) // 64) * 64
        slot = _slot(pairs, level, size)
        alone = np.bincount(slot, minlength=size) == 1
        sizes.append(size)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        pairs, level = pairs[~alone[slot]], level + 1
    return np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, "<u8")


class PairTable:
    """Perfect hashes of some segments side by side, with what is stored at their places.

    Places of a segment follow each other, in the order of the segments given.
    """

    def __init__(self, segments: list[int], sizes: list[np.ndarray], words: list[np.ndarray]):
        levels = max(map(len, sizes), default=0)
        self.sizes = np.zeros((1 << SEGMENT_BITS, levels), np.int64)
        self.begins = np.zeros((1 << SEGMENT_BITS, levels), np.int64)
        at = 0
        for segment, own in zip(segments, sizes):
            self.sizes[segment, : len(own)] = own
            self.begins[segment, : len(own)] = at + np.cumsum(own) - own
            at += int(own.sum())
        self.words = np.concatenate(words).astype(np.uint64) if words else np.zeros(0, np.uint64)
        filled = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = np.cumsum(filled) - filled

    def places(self, pairs: np.ndarray) -> np.ndarray:
        """The place of each pair, -1 where no level holds it. Other pairs than those hashed may get a place."""
        place, left, segment = np.full(len(pairs), -1, np.int64), np.arange(len(pairs)), segment_of(pairs)
        for level in range(self.sizes.shape[1]):
            size = self.sizes[segment[left], level]
            left = left[size > 0]
            if not len(left):
                break
            slot = self.begins[segment[left], level] + _slot(pairs[left], level, size[size > 0])
            word, bit = self.words[slot >> 6], np.uint64(1) << (slot & 63).astype(np.uint64)
            owned = (word & bit) != 0
            below = np.bitwise_count(word & (bit - np.uint64(1))).astype(np.int64)
            place[left[owned]] = (self.ranks[slot >> 6] + below)[owned]
            left = left[~owned]
        return place


class _Known(dict):
    """Numbers of chunks; a new chunk gets the next number and waits to be aligned."""

    def __init__(self, aligner: Aligner):
        super().__init__()
        self.aligner = aligner

    def __missing__(self, chunk: str) -> int:
        number = self.aligner.number(chunk)
        if len(chunk) <= LONGEST_CACHED:
            self[chunk] = number
        return number


class Aligner:
    """Aligns texts, and remembers the chunks that it has met: a space and a word, or the marks behind a word.

    What is known of chunk i: `sizes[i]` (n_a, n_b, n_groups, n_links), its linked pairs (those of all
    chunks follow each other in `pairs`), and, if wanted, its groups as text.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = {c: i for i, c in enumerate(BYTE_SHOWN)}
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            self.bytes_a[number] = bytes(shown[c] for c in entry) if all(c in shown for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lengths_a, self.lengths_b = (np.array(list(map(len, entries)), np.int64) for entries in (self.bytes_a, self.bytes_b))
        self.n_b = len(pieces)
        # Pieces hold the space only at their front, and no mark behind a letter, so no merge goes over a cut.
        texts = [p for i, p in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))]
        apart = all("▁" not in p.lstrip("▁") and not LETTER_AND_MARK.search(p) for p in texts)
        kept = self.b.decode(self.b.encode(" a  b ")) == " a  b " and len(self.b.encode("a")) == 1
        self.cuttable = apart and kept and cutting_rule(path_a) == "keep"
        self.clear(False)

    def clear(self, with_groups: bool) -> None:
        self.with_groups = with_groups
        self.known = _Known(self)
        self.waiting: list[str] = []
        self.uses = np.zeros(0, np.int64)
        self.pairs: list[np.ndarray] = []
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)
        self.unequal: set[int] = set()  # chunks whose tokens are not the bytes of the text
        self.tokens = 0

    @property
    def full(self) -> bool:
        return len(self.sizes) > CACHED_CHUNKS or self.tokens > CACHED_TOKENS

    def begin(self, with_groups: bool) -> None:
        """Begin a task with what earlier tasks of this worker have left."""
        if self.with_groups != with_groups:
            self.clear(with_groups)
        elif self.full:
            self.trim()

    def trim(self) -> None:
        """Keep the chunks that were met most often, at most half of the bound; the others go and numbers change."""
        least = 2
        while (self.uses >= least).sum() > CACHED_CHUNKS // 2:
            least *= 2
        keep = self.uses >= least
        places = (np.cumsum(keep) - 1).tolist()
        known = _Known(self)
        known.update((chunk, places[i]) for chunk, i in self.known.items() if keep[i])
        self.known = known
        self.unequal = {places[i] for i in self.unequal if keep[i]}
        self.pairs = [np.concatenate([np.zeros(0, np.uint64), *self.pairs])[np.repeat(keep, self.sizes[:, 3])]]
        self.groups = [text for text, kept in zip(self.groups, keep.tolist()) if kept]
        self.sizes, self.uses = self.sizes[keep], self.uses[keep]
        self.tokens = int(self.sizes[:, :2].sum())
        if self.full:
            self.clear(self.with_groups)

    def number(self, chunk: str) -> int:
        self.waiting.append(chunk)
        return len(self.sizes) + len(self.waiting) - 1

    def _read_a(self, chunks: list[str], whole: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all ids of A, ids of each chunk, whether the tokens are the bytes of the chunk).

        Chunks that follow each other are read as one text; one that ends in white space ends a text.
        """
        texts: list[list[str]] = [[]]
        for chunk in chunks:
            if len(texts[-1]) == JOINED or (texts[-1] and (texts[-1][-1][-1].isspace() or not self.cuttable)):
                texts.append([])
            texts[-1].append(chunk)
        encoded = [e.ids for e in self.a.encode_batch_fast(["".join(text) for text in texts], add_special_tokens=False)]
        ids = np.fromiter((i for own in encoded for i in own), np.int64, sum(map(len, encoded)))
        ends, own_ends = np.cumsum(self.lengths_a[ids]), np.cumsum(np.fromiter(map(len, whole), np.int64, len(whole)))
        counts = np.diff(np.searchsorted(ends, own_ends, "right"), prepend=0)
        exact = len(ends) and np.isin(own_ends, ends).all() and b"".join([self.bytes_a[i] for i in ids.tolist()]) == b"".join(whole)
        return (ids, counts, np.ones(len(chunks), bool)) if exact else self._each([e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)], self.bytes_a, whole)

    def _each(self, encoded: list[list[int]], entries: list[bytes], whole: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same from the ids of each chunk."""
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids = np.fromiter((i for own in encoded for i in own), np.int64, int(counts.sum()))
        equal = np.array([b"".join([entries[i] for i in own]) == chunk for own, chunk in zip(encoded, whole)], bool)
        return ids, counts, equal

    def align_waiting(self) -> None:
        """Align the chunks that wait, all at once: the end of a chunk is the end of a token of each."""
        chunks, self.waiting = self.waiting, []
        if not chunks:
            return
        whole = [chunk.encode() for chunk in chunks]
        ids_a, n_a, equal_a = self._read_a(chunks, whole)
        # The model adds the space; marks are read behind a letter, whose one token goes.
        encoded_b = self.b.encode([c[1:] if c[0] == " " else "a" + c for c in chunks], num_threads=1)
        encoded_b = [ids if c[0] == " " else ids[1:] for c, ids in zip(chunks, encoded_b)]
        ids_b, n_b, equal_b = self._each(encoded_b, self.bytes_b, whole)
        equal = equal_a & equal_b
        if not equal.all():
            self.unequal.update((len(self.sizes) + np.flatnonzero(~equal)).tolist())
            ids_a, ids_b = ids_a[np.repeat(equal, n_a)], ids_b[np.repeat(equal, n_b)]
            n_a, n_b = n_a * equal, n_b * equal
        ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
        ends = np.union1d(ends_a, ends_b)  # from one end to the next there is one token of each
        pairs = ids_a[np.searchsorted(ends_a, ends)] * self.n_b + ids_b[np.searchsorted(ends_b, ends)]
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last = np.r_[0, ends_a][np.cumsum(n_a)]  # where each chunk ends
        n_links, n_groups = (np.diff(np.searchsorted(x, last, "right"), prepend=0) for x in (ends, cuts))
        self.pairs.append(pairs.astype(np.uint64))
        self.sizes = np.concatenate([self.sizes, np.c_[n_a, n_b, n_groups, n_links]])
        self.tokens += len(ids_a) + len(ids_b)
        if self.with_groups:
            text_a, text_b, begin_a, begin_b, texts = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist())), 0, 0, []
            for end_a, end_b in zip((np.searchsorted(ends_a, cuts) + 1).tolist(), (np.searchsorted(ends_b, cuts) + 1).tolist()):
                texts.append(",".join(text_a[begin_a:end_a]) + "|" + ",".join(text_b[begin_b:end_b]))
                begin_a, begin_b = end_a, end_b
            bounds = np.r_[0, np.cumsum(n_groups)].tolist()
            self.groups += [";".join(texts[i:j]) for i, j in zip(bounds, bounds[1:])]

    def read(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
        """Numbers of the chunks of each text, none if it has no tokens; and how often each chunk was met in them."""
        get = self.known.__getitem__
        numbers = []
        for text in texts:
            if not text:
                numbers.append([])
            elif self.cuttable:
                numbers.append(list(map(get, CUT.split(" " + text))))
            else:
                numbers.append([self.number(" " + text)])
        self.align_waiting()
        if self.unequal:
            again = [i for i, own in enumerate(numbers) if not self.unequal.isdisjoint(own)]
            for i in again:  # the whole text decides
                numbers[i] = [self.number(" " + texts[i])] if len(numbers[i]) > 1 else numbers[i]
            self.align_waiting()
            for i in again:
                if not self.unequal.isdisjoint(numbers[i]):
                    numbers[i] = []
        numbers = [np.array(own, np.int64) for own in numbers]
        met = np.bincount(np.concatenate([np.zeros(0, np.int64), *numbers]), minlength=len(self.sizes))
        self.uses = np.r_[self.uses, np.zeros(len(met) - len(self.uses), np.int64)] + met
        return numbers, met


def _aligner(path_a: str, path_b: str) -> Aligner:
    state = worker_state(f"alignment {path_a} {path_b}")
    if "aligner" not in state:
        state["aligner"] = Aligner(path_a, path_b)
    return state["aligner"]


PARTIAL = "segment int, salt int, pairs binary, counts binary"


def _counted(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Distinct linked pairs with their counts, a row for each task and segment; `salt` spreads the rows of a segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, salt = _aligner(path_a, path_b), TaskContext.get().partitionId() % SALTS
        aligner.begin(False)
        times = np.zeros(len(aligner.sizes), np.int64)

        def close() -> pa.RecordBatch:
            pairs = np.concatenate([np.zeros(0, np.uint64), *aligner.pairs])
            weights = np.repeat(times, aligner.sizes[:, 3])
            pairs, weights = pairs[weights > 0], weights[weights > 0]
            order = np.argsort(pairs, kind="stable")
            pairs, weights = pairs[order], weights[order]
            first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, np.int64)
            pairs, counts = pairs[first], np.add.reduceat(weights, first) if len(first) else weights
            segment = segment_of(pairs)
            rows = [(s, pairs[segment == s].tobytes(), counts[segment == s].tobytes()) for s in np.unique(segment).tolist()]
            columns = list(zip(*rows)) or [[], [], []]
            arrays = [pa.array(columns[0], pa.int32()), pa.array([salt] * len(rows), pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, ["segment", "salt", "pairs", "counts"])

        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                _, met = aligner.read(whole.column("text").slice(start, TEXTS).to_pylist())
                met[: len(times)] += times
                times = met
                if aligner.full:
                    yield close()
                    aligner.trim()
                    times = np.zeros(len(aligner.sizes), np.int64)
        yield close()

    return docs.select("text").mapInArrow(run, PARTIAL)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Runs of rows with equal keys in sorted batches, one row in memory at a time."""
    import itertools

    rows = (row for batch in batches for row in batch.to_pylist())
    return itertools.groupby(rows, lambda row: tuple(row[k] for k in keys))


HASHES = "segment int, sizes binary, words binary, pairs binary"


def _hashes(partial: DataFrame) -> DataFrame:
    """The perfect hash of every segment, and its pairs by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (segment,), rows in _grouped(batches, ["segment"]):
            pairs, waiting, size = np.zeros(0, np.uint64), [], 0
            for row in rows:
                waiting.append(np.frombuffer(row["pairs"], np.uint64))
                size += len(waiting[-1])
                if size > len(pairs) + 100_000:
                    pairs, waiting, size = np.unique(np.concatenate([pairs, *waiting])), [], 0
            pairs = np.unique(np.concatenate([pairs, *waiting]))
            sizes, words = build_hash(pairs)
            by_place = np.empty(len(pairs), np.uint64)
            by_place[PairTable([segment], [sizes], [words]).places(pairs)] = pairs
            values = [pa.array([x.tobytes()], pa.binary()) for x in (sizes, words, by_place)]
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), *values], ["segment", "sizes", "words", "pairs"])

    dealt = partial.select("segment", "pairs").repartition(partitions(partial.sparkSession), "segment").sortWithinPartitions("segment")
    return dealt.mapInArrow(run, HASHES)


def _summed(partial: DataFrame, hashes: DataFrame) -> DataFrame:
    """(segment, counts): the dense vectors of all tasks, added up by salt and then by segment."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (segment, salt), rows in _grouped(batches, ["segment", "salt"]):
            known = next(rows)
            table = PairTable([segment], [np.frombuffer(known["sizes"], np.int64)], [np.frombuffer(known["words"], "<u8")])
            total = np.zeros(len(known["pairs"]) // 8, np.int64)
            for row in rows:
                total[table.places(np.frombuffer(row["pairs"], np.uint64))] += np.frombuffer(row["counts"], np.int64)
            if total.any():
                yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["segment", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (segment,), rows in _grouped(batches, ["segment"]):
            total = np.frombuffer(next(rows)["counts"], np.int64).copy()
            for row in rows:
                total += np.frombuffer(row["counts"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["segment", "counts"])

    n, empty = partitions(partial.sparkSession), F.lit(None).cast("binary")
    heads = hashes.select("segment", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("kind"), "sizes", "words", "pairs", empty.alias("counts"))
    rows = heads.unionByName(partial.select("segment", "salt", F.lit(1).alias("kind"), empty.alias("sizes"), empty.alias("words"), "pairs", "counts"))
    dealt = rows.repartition(n, "segment", "salt").sortWithinPartitions("segment", "salt", "kind")
    level = dealt.mapInArrow(vectors, "segment int, counts binary")
    return level.repartition(n, "segment").sortWithinPartitions("segment").mapInArrow(add, "segment int, counts binary")


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Links of every pair of ids: (segment, sizes, words, pairs, counts).

    A row is a segment: its perfect hash, and by place its pairs (id of A times the number of B ids,
    plus id of B) and their counts, as 64-bit integers. There are at most 2 ** `SEGMENT_BITS` rows; the
    vocabularies bound their length.
    """
    partial = stored(_counted(docs, path_a, path_b))
    hashes = stored(_hashes(partial))
    return stored(hashes.join(_summed(partial, hashes), "segment"))


def _highest(table: DataFrame, n_b: int) -> dict[int, int]:
    """The highest count of each B id; at most as many as the vocabulary of B has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = np.zeros(n_b, np.int64)
            for row in batch.to_pylist():
                np.maximum.at(most, (np.frombuffer(row["pairs"], np.uint64) % np.uint64(n_b)).astype(np.int64), np.frombuffer(row["counts"], np.int64))
            found = np.flatnonzero(most)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(most[found])], ["b", "most"])

    rows = table.select("pairs", "counts").mapInArrow(run, "b long, most long").groupBy("b").agg(F.max("most").alias("most"))
    return {row["b"]: row["most"] for row in rows.collect()}


class _Lookup:
    """Counts of a slice of the table, and what a worker's chunks sum up to."""

    def __init__(self, rows: list[Row], highest: np.ndarray):
        read = lambda name, kind: [np.frombuffer(row[name], kind) for row in rows]
        self.table = PairTable([row["segment"] for row in rows], read("sizes", np.int64), read("words", "<u8"))
        self.pairs = np.concatenate([np.zeros(0, np.uint64), *read("pairs", np.uint64)])
        self.counts = np.concatenate([np.zeros(0, np.int64), *read("counts", np.int64)])
        self.highest = highest

    def sums(self, aligner: Aligner, chunks: int, pieces: int) -> np.ndarray:
        """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum) of chunks from number `chunks` on.

        Their pairs are in `aligner.pairs` from list `pieces` on.
        """
        pairs = np.concatenate([np.zeros(0, np.uint64), *aligner.pairs[pieces:]])
        place = self.table.places(pairs)
        there = place >= 0
        there[there] = self.pairs[place[there]] == pairs[there]  # verified
        counts = np.where(there, self.counts[np.where(there, place, 0)], 0) if len(self.counts) else np.zeros(len(pairs), np.int64)
        best = there & (counts == self.highest[(pairs % np.uint64(aligner.n_b)).astype(np.int64)])
        own = aligner.sizes[chunks:]
        ends = np.cumsum(own[:, 3])
        totals = [np.r_[0, np.cumsum(x.astype(np.int64))] for x in (best, counts)]
        return np.c_[own, *(t[ends] - t[ends - own[:, 3]] for t in totals)]


LOOKED_UP = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _looked_up(rows: DataFrame, path_a: str, path_b: str, part: list[Row], highest: np.ndarray, last: bool) -> DataFrame:
    """Add the counts of one slice of the table to rows (doc_id, text, best, total); the last slice gives the result."""
    shared = rows.sparkSession.sparkContext.broadcast([row.asDict() for row in part])
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, lookup = _aligner(path_a, path_b), _Lookup(shared.value, highest)
        aligner.begin(last)
        table, pieces = lookup.sums(aligner, 0, 0), len(aligner.pairs)
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(start, TEXTS)
                read, _ = aligner.read(batch.column("text").to_pylist())
                table = np.concatenate([table, lookup.sums(aligner, len(table), pieces)])
                pieces = len(aligner.pairs)
                sums = np.array([table[numbers].sum(0) for numbers in read], np.int64).reshape(-1, 6)
                sums[:, 4] += batch.column("best").to_numpy()
                sums[:, 5] += batch.column("total").to_numpy()
                if last:
                    digests = [hashlib.sha256(";".join(map(aligner.groups.__getitem__, n.tolist())).encode()).hexdigest() if len(n) else "" for n in read]
                    columns = [batch.column("doc_id"), *(pa.array(c.copy()) for c in sums.T), pa.array(digests, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(c.split()[0] for c in LOOKED_UP.split(", "))])
                else:
                    columns = [batch.column("doc_id"), batch.column("text"), pa.array(sums[:, 4].copy()), pa.array(sums[:, 5].copy())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "best", "total"])
                if aligner.full:
                    aligner.trim()
                    table, pieces = lookup.sums(aligner, 0, 0), len(aligner.pairs)

    return rows.mapInArrow(run, f"doc_id {kind}, " + (LOOKED_UP if last else "text string, best long, total long"))


def _slices(table: DataFrame, limit: int) -> list[list[int]]:
    """Segments in slices of at most `limit` bytes, or of one segment."""
    size = sum((F.octet_length(c) for c in ("sizes", "words", "pairs", "counts")), F.lit(0))
    out, total = [[]], 0
    for segment, bytes_ in sorted(tuple(row) for row in table.select("segment", size).collect()):
        if out[-1] and total + bytes_ > limit:
            out.append([])
            total = 0
        out[-1].append(segment)
        total += bytes_
    return out


def align(docs: DataFrame, path_a: str, path_b: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """How the tokens of each document align: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A reads a space and the text, B the text, to which it adds that space; neither adds special tokens,
    and strings of special tokens in a text are plain text. Bytes where a token of A and one of B both
    end cut the tokens into groups. Tokens with overlapping bytes are linked, and the count of an id
    pair is the number of links in all documents that hold it. `n_best` are the links of which no other
    A id has more with the same B id, `count_sum` is the sum of the counts over the links, and
    `groups_sha256` the digest of the ids as `a1,a2|b1;a3|b2,b3`.

    A text that is null, empty, or whose tokens are not its bytes has no tokens: zeros and an empty
    digest. Every row counts, repeated ids and null ids too; other columns are ignored. The table of
    counts is looked up in slices of bounded size, and documents are aligned again for each; a table
    of up to `slice_bytes` is one slice.
    """
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    table = pair_counts(docs, path_a, path_b)
    highest = np.zeros(n_b, np.int64)
    for number, most in _highest(table, n_b).items():
        highest[number] = most
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.lit(0).cast("long").alias("best"), F.lit(0).cast("long").alias("total"))
    slices = _slices(table, slice_bytes)
    for at, segments in enumerate(slices):
        part = table.filter(F.col("segment").isin(segments)).collect()
        rows = _looked_up(rows, path_a, path_b, part, highest, at == len(slices) - 1)
    return rows
