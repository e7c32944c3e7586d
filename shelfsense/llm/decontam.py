"""Benchmark passages in documents, also with a few edits: q-gram counts in diagonal bands, then alignment.

A text that holds an item of m bytes with at most e edits shares at least m - q + 1 - q·e q-grams with
it, all on diagonals that differ by at most e (the q-gram lemma). Shared q-grams are therefore counted
in overlapping bands of diagonals, and only bands with enough of them are aligned. The lemma holds for
any choice of an item's positions: of c chosen ones at least c - q·e are shared. Positions whose q-gram
is frequent among the items, such as rules of dashes, are left out, and the bound is lowered with them.

Both sides are compared as UTF-8 bytes, with A-Z as a-z and any run of white space as one space.
Items under `SHORT_BYTES` bytes, or under 2q when folded, are found exactly, between word borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import digest, flat_bytes, slices, worker_state

Q = 8
EDIT_SHARE = 0.08
SHORT_BYTES = 24
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
PIECE = 1 << 20  # positions, or shared q-grams, looked at in one step
ALIGNED_TOGETHER = 256
RARE = 16  # a q-gram met at most so often in a block of items is always counted
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[9:14] = 32
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
HASH = np.uint64(0x9E3779B97F4A7C15)
BIG = 1 << 20


def qgrams(flat: np.ndarray) -> np.ndarray:
    """The q-gram at every position of folded bytes as a 64-bit integer; q is 8."""
    if len(flat) < Q:
        return np.zeros(0, np.uint64)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, Q)).view(np.uint64).ravel()


def budget(length: int, share: float) -> int:
    """Edits allowed for an item; no more than leave at least one q-gram untouched."""
    return max(0, min(int(length * share), (length - Q) // Q))


def fold(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of texts that begin at `begins`, and the places of the bytes left out."""
    flat = FOLD[flat]
    blank = flat == 32
    left_out = np.zeros(len(flat), bool)
    left_out[1:] = blank[1:] & blank[:-1]
    left_out[begins[begins < len(flat)]] = False
    if not left_out.any():
        return flat, np.zeros(0, np.int64)
    return flat[~left_out], np.flatnonzero(left_out)


class Folded:
    """Folded texts of a batch: `flat` holds text i from `offsets[i]` to `offsets[i + 1]`."""

    def __init__(self, column: pa.Array):
        flat, self.source_offsets = flat_bytes(column)
        self.flat, left_out = fold(flat, self.source_offsets[:-1])
        self.offsets = self.source_offsets - np.searchsorted(left_out, self.source_offsets)
        self.gaps = left_out - np.arange(len(left_out))  # folded place that follows each byte left out

    def text_at(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets[:-1], places, "right") - 1

    def source_end(self, text: int, end: int) -> int:
        """Bytes of the source text up to the folded place `end`, which follows a byte kept."""
        last = end - 1
        return int(last + np.searchsorted(self.gaps, last, "right") + 1 - self.source_offsets[text]) if end else 0


class Items:
    """A block of benchmark items with an index of their q-grams."""

    def __init__(self, texts: list[bytes], share: float):
        self.folded = []
        for text in texts:
            flat, _ = fold(np.frombuffer(text, np.uint8), np.zeros(1, np.int64))
            self.folded.append(np.frombuffer(flat.tobytes().strip(b" "), np.uint8))
        self.lengths = np.array([len(item) for item in self.folded], np.int64)
        sizes = np.array([len(text) for text in texts], np.int64)
        is_long = (sizes >= SHORT_BYTES) & (self.lengths >= 2 * Q)
        self.long, self.short_items = np.flatnonzero(is_long), np.flatnonzero(~is_long & (self.lengths > 0))
        self.edits = np.where(is_long, [budget(int(m), share) for m in self.lengths], 0).astype(np.int64)
        self.width = int(self.edits.max(initial=0)) + 1  # a band has twice this many diagonals
        self._index_long()
        self._index_short()

    def _index_long(self) -> None:
        grams = [qgrams(self.folded[i]) for i in self.long]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        _, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
        often = counts[inverse]
        self.least = np.ones(len(self.folded), np.int64)
        chosen, item, begin = [], [], 0
        for i, own in zip(self.long, grams):
            times, lost = often[begin : begin + len(own)], Q * int(self.edits[i])
            begin += len(own)
            enough = lost + 1 + (len(own) - lost - 1) // 2
            rarest = np.argsort(times, kind="stable")
            places = np.sort(rarest[: max(enough, int((times <= RARE).sum()))])
            self.least[i] = max(1, len(places) - lost)
            chosen.append(places)
            item.append(np.full(len(places), i))
        places = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
        owner = np.concatenate(item) if item else np.zeros(0, np.int64)
        kept = np.concatenate([own[p] for own, p in zip(grams, chosen)]) if chosen else np.zeros(0, np.uint64)
        order = np.argsort(kept, kind="stable")
        self.item, self.offset = owner[order], places[order]
        self.grams, self.first, self.count = np.unique(kept[order], return_index=True, return_counts=True)
        self.bits = min(25, max(16, (8 * len(self.grams)).bit_length()))
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[self._slot(self.grams)] = True

    def _index_short(self) -> None:
        """For each length its items, sorted by their first bytes as an integer."""
        self.short: list[tuple[int, np.ndarray, np.ndarray]] = []
        for length in np.unique(self.lengths[self.short_items]):
            items = self.short_items[self.lengths[self.short_items] == length]
            heads = np.array([int.from_bytes(self.folded[i][:Q].tobytes(), "little") for i in items], np.uint64)
            order = np.argsort(heads, kind="stable")
            self.short.append((int(length), items[order], heads[order]))

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * HASH) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _shared(self, texts: Folded) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the texts and entries of the index with one q-gram, in pieces of bounded size."""
        for start in range(0, len(texts.flat) if len(self.grams) else 0, PIECE):
            grams = qgrams(texts.flat[start : start + PIECE + Q - 1])
            at = np.flatnonzero(self.filter[self._slot(grams)])
            place = np.searchsorted(self.grams, grams[at])
            true = self.grams[np.minimum(place, len(self.grams) - 1)] == grams[at]
            at, place = at[true] + start, place[true]
            total = np.cumsum(self.count[place])
            cuts = np.searchsorted(total, np.arange(PIECE, int(total[-1]) if len(total) else 0, PIECE))
            for some, found in zip(np.split(at, cuts), np.split(place, cuts)):
                times = self.count[found]
                entry = np.repeat(self.first[found] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
                yield np.repeat(some, times), entry

    def candidates(self, texts: Folded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, first diagonal of the band) of every band with enough shared q-grams.

        A diagonal is the place in the folded bytes less the offset in the item. Bands begin at every
        multiple of the width, so any stretch of e + 1 diagonals lies whole in one of them.
        """
        n, longest = max(1, len(self.folded)), int(self.lengths.max(initial=0))
        # Texts are told apart by their number: neighbours in `flat` share diagonals.
        n_bands = (len(texts.flat) + longest) // self.width + 4
        shift = longest // self.width + 2
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at, entry in self._shared(texts):
            band = (at - self.offset[entry]) // self.width
            key = (texts.text_at(at) * n + self.item[entry]) * n_bands + band + shift
            new, some = np.unique(np.concatenate([key, key - 1]), return_counts=True)
            keys, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, some]), len(keys)).astype(np.int64)
        pair = keys // n_bands
        enough = counts >= self.least[pair % n]
        keys, pair = keys[enough], pair[enough]
        return pair // n, pair % n, (keys % n_bands - shift) * self.width

    def short_hits(self, texts: Folded) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, item, end) of short items: the first place in a text where one stands between word borders."""
        flat, ends = texts.flat, texts.offsets[1:]
        for length, items, heads in self.short:
            mask = np.uint64((1 << 8 * min(length, Q)) - 1)
            for start in range(0, len(flat), PIECE):
                grams = qgrams(np.concatenate([flat[start : start + PIECE + Q - 1], np.zeros(Q, np.uint8)])) & mask
                at = np.flatnonzero(np.isin(grams[: len(flat) - start][:PIECE], heads))
                first = np.searchsorted(heads, grams[at])
                times = np.searchsorted(heads, grams[at], "right") - first
                entry = np.repeat(first - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
                at = np.repeat(at + start, times)
                text = texts.text_at(at)
                begin, end = texts.offsets[text], at + length
                inside = end <= ends[text]
                at, text, begin, end, item = at[inside], text[inside], begin[inside], end[inside], items[entry[inside]]
                good = ((at == begin) | ~WORD[flat[at - 1]] | ~WORD[flat[at]])
                good &= (end == ends[text]) | ~WORD[flat[np.minimum(end, len(flat) - 1)]] | ~WORD[flat[end - 1]]
                if length > Q:
                    bodies = np.stack([self.folded[i] for i in items])
                    for offset in range(Q, length):
                        good &= flat[at + offset] == bodies[entry[inside], offset]
                _, one = np.unique(text[good] * len(self.folded) + item[good], return_index=True)
                yield text[good][one], item[good][one], end[good][one]


def align(items: list[np.ndarray], regions: list[np.ndarray], lows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits between each item and a stretch of its region, and where the stretch ends.

    Banded alignment: only cells on `width` diagonals from an item's `low` are computed, a byte of all
    items at a time. The stretch may begin on any of these diagonals and end anywhere in the band.
    """
    lengths = np.array([len(item) for item in items], np.int64)
    longest, n = int(lengths.max(initial=0)), len(items)
    wanted = np.full((n, longest), -2, np.int16)
    given = np.full((n, longest + width + 1), -1, np.int16)  # region bytes, the one at `low` first
    for k, (item, region, low) in enumerate(zip(items, regions, lows.tolist())):
        wanted[k, : len(item)] = item
        some = region[max(0, low) : max(0, low + given.shape[1])]
        given[k, max(0, -low) : max(0, -low) + len(some)] = some
    consumed = lows[:, None] + np.arange(longest + width + 1)
    outside = (consumed < 0) | (consumed > np.array([len(region) for region in regions])[:, None])
    steps = np.arange(width, dtype=np.int32)
    cost = np.where(outside[:, :width], BIG, 0).astype(np.int32)
    edits, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(longest + 1):
        done = np.flatnonzero(lengths == i)
        if len(done):
            last = cost[done].argmin(1)
            edits[done], ends[done] = cost[done, last], lows[done] + i + last
        if i == longest:
            break
        best = cost + (given[:, i : i + width] != wanted[:, i : i + 1])
        np.minimum(best[:, :-1], cost[:, 1:] + 1, out=best[:, :-1])  # the item's byte has no counterpart
        best[outside[:, i + 1 : i + 1 + width]] = BIG
        cost = np.minimum.accumulate(best - steps, axis=1) + steps  # region bytes without a counterpart
    return edits, ends


def passages_of(texts: Folded, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, edits, end in the folded bytes) of the items found in a batch of texts."""
    for text, item, end in items.short_hits(texts):
        yield from zip(text.tolist(), item.tolist(), [0] * len(text), end.tolist())
    exact, open_ = set(), []
    for t, i, low in zip(*(values.tolist() for values in items.candidates(texts))):
        body, limit = items.folded[i], int(items.edits[i])
        start = max(int(texts.offsets[t]), low - limit)
        region = texts.flat[start : min(int(texts.offsets[t + 1]), low + 2 * items.width + len(body) + limit)]
        at = region.tobytes().find(body.tobytes())
        if at >= 0:
            exact.add((t, i))
            yield t, i, 0, start + at + len(body)
        elif limit:
            open_.append((len(body), t, i, low - limit, start, region))
    todo = sorted((c for c in open_ if c[1:3] not in exact), key=lambda c: c[:4])
    for first in range(0, len(todo), ALIGNED_TOGETHER):
        some = todo[first : first + ALIGNED_TOGETHER]
        limits = np.array([items.edits[i] for _, _, i, *_ in some])
        lows = np.array([low - start for *_, low, start, _ in some])
        edits, ends = align([items.folded[c[2]] for c in some], [c[5] for c in some], lows, 2 * items.width + 2 * int(limits.max()) + 1)
        for k in np.flatnonzero(edits <= limits).tolist():
            _, t, i, _, start, _ = some[k]
            yield t, i, int(edits[k]), start + int(ends[k])


def find_passages(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Items found in documents: (doc_id, item_id, edits, ends_at), a row for each pair.

    `edits` is the smallest number found, `ends_at` the byte offset where that stretch ends. Items that
    are null, empty or blank are no passage. The distinct texts of the benchmark are read in blocks of
    bounded size, each held against all documents, so it may be of any length. Null texts hold
    nothing; repeated documents and items give one row for each pair of ids.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, a long, b long, edits int, ends_at long"
    found = docs.sparkSession.createDataFrame([], schema)
    passages = benchmark.select("item_id", digest("text").alias("key"), F.col("text").cast("binary").alias("text"))
    passages = passages.filter(F.octet_length("text") > 0)
    block: list = []
    size = 0
    for row in passages.groupBy("key").agg(F.min("text").alias("text")).toLocalIterator():
        block.append(row)
        size += len(row.text)
        if size >= block_bytes:
            found, block, size = found.unionAll(_find_block(docs, block, share, schema)), [], 0
    if block:
        found = found.unionAll(_find_block(docs, block, share, schema))
    best = F.min(F.struct("edits", "ends_at")).alias("best")
    found = found.groupBy("doc_id", "a", "b").agg(best)
    ids = passages.select("item_id", "key.*").distinct()
    pairs = found.join(ids, ["a", "b"]).groupBy("doc_id", "item_id").agg(F.min("best").alias("best"))
    return pairs.select("doc_id", "item_id", "best.*")


def _find_block(docs: DataFrame, block: list, share: float, schema: str) -> DataFrame:
    keys, texts = [(row.key.a, row.key.b) for row in block], [bytes(row.text) for row in block]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("passages")  # an earlier operator's caches go
        items = Items(texts, share)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                folded = Folded(batch.column("text"))
                hits = [(t, *keys[i], edits, folded.source_end(t, end)) for t, i, edits, end in passages_of(folded, items)]
                if hits:
                    text, a, b, edits, ends = zip(*hits)
                    own = batch.column("doc_id").take(pa.array(text, pa.int64()))
                    columns = [own, pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(edits, pa.int32()), pa.array(ends, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a", "b", "edits", "ends_at"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no benchmark passage was found.

    A row goes by its own text: another one with its doc_id, or without one like it, does not count.
    """
    key = digest("doc_id", "text")
    leaked = find_passages(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("_leaked")).distinct()
    keyed = docs.withColumn("_key", key)
    return keyed.join(leaked, keyed["_key"] == leaked["_leaked"], "left_anti").drop("_key")
