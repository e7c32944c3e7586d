"""Packing of token sequences into windows of equal length by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import stored
from shelfsense.llm.tokens import tokenize

WINDOW = 2048
BATCH_PIECES = 2048
FILLER_EVERY, FILLER = 8, 256
LOT = 64


def cut_pieces(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Cut each document's ids into pieces of at most `window`: (doc_id, start, length, doc_tokens, ids).

    One document in `FILLER_EVERY`, chosen by a digest of its ids, has its last part cut into pieces
    of `FILLER`. These small pieces even out the windows, which saves about half of the padding.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "doc_tokens", "ids"]
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                n = len(ids) // 4
                cuts = [*range(0, n, window), n]
                if zlib.crc32(ids) % FILLER_EVERY == 0:
                    cuts[-1:] = [*range(cuts[-2] + FILLER, n, FILLER), n]
                rows += [(doc_id, s, e - s, n, ids[4 * s : 4 * e]) for s, e in zip(cuts, cuts[1:])]
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [batch.column("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    id_type = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.mapInArrow(run, f"doc_id {id_type}, start long, length long, doc_tokens long, ids binary")


def difference(lengths: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Split `lengths` into `k` windows of nearly equal sums: the window of each piece, and the largest sum.

    Karmarkar-Karp: every piece starts as a partial partition of its own. The two partitions with
    the largest spread are merged, the fullest windows of one with the emptiest of the other, until
    one is left. A partition keeps only its windows in use, in descending order; `tree` records
    which windows were joined, so that no list of pieces is copied.
    """
    n = len(lengths)
    tree = np.full((2 * n, 2), -1, np.int64)  # nodes from n on join two earlier nodes
    nodes = n
    heap = [(-int(length), i, np.array([length]), np.array([i])) for i, length in enumerate(lengths)]
    heapq.heapify(heap)
    if k == 1:
        return np.zeros(n, np.int64), int(lengths.sum())
    order = n
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heapq.heappop(heap)
        shared = max(0, len(a) + len(b) - k)  # windows that get a part of either side
        b, b_nodes = b[::-1], b_nodes[::-1]
        rest = len(a) - shared
        joined = np.arange(nodes, nodes + shared)
        tree[joined, 0], tree[joined, 1] = a_nodes[rest:], b_nodes[:shared]
        nodes += shared
        sums = np.concatenate([a[:rest], a[rest:] + b[:shared], b[shared:]])
        ids = np.concatenate([a_nodes[:rest], joined, b_nodes[shared:]])
        by_size = np.argsort(-sums, kind="stable")
        sums, ids = sums[by_size], ids[by_size]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, order, sums, ids))
        order += 1
    _, _, sums, ids = heap[0]
    window = np.full(2 * n, -1, np.int64)
    window[ids] = np.arange(len(ids))
    for node in range(nodes - 1, n - 1, -1):
        window[tree[node]] = window[node]
    return window[:n], int(sums[0])


def pack_lengths(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each piece so that no window holds more than `capacity`.

    The number of windows starts at the least possible and rises whenever a window is too full;
    the next number leaves room for the excess seen. Full pieces are windows by themselves.
    """
    windows = np.empty(len(lengths), np.int64)
    full = lengths >= capacity
    windows[full] = np.arange(full.sum())
    part, total = lengths[~full], int(lengths[~full].sum())
    k = -(-total // capacity)
    while len(part):
        inside, largest = difference(part, k)
        if largest <= capacity:
            windows[~full] = inside + full.sum()
            break
        k = max(k + 1, min(len(part), -(-total // max(1, 2 * capacity - largest))))
    return windows


def pack(pieces: DataFrame, capacity: int = WINDOW, batch_pieces: int = BATCH_PIECES) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces with `doc_id`, `start`, `length`; other columns stay.

    Pieces are dealt into batches by a hash of the whole row, about `batch_pieces` to each; a batch
    is packed in one task. Equal rows are counted and dealt in lots of `LOT`. So neither a long
    document nor a hot id, a null one or a repeated row makes a large batch. The batches depend on
    the rows alone, so a repeated task gives the same windows. An empty table gives an empty result;
    pieces of length 0 are dropped.
    """
    pieces = pieces.filter("length > 0")
    batches = max(1, round(pieces.count() / batch_pieces))
    columns = pieces.columns
    hashed = [f.name for f in pieces.schema if "map<" not in f.dataType.simpleString()]
    lots = F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(LOT).cast("long"))
    counted = pieces.groupBy(*columns).agg(F.count("*").alias("_copies")).withColumn("_lot", F.explode(lots))
    counted = counted.withColumn("_copies", F.least(F.lit(LOT).cast("long"), F.col("_copies") - F.col("_lot")))
    keyed = counted.withColumn("_batch", F.pmod(F.xxhash64(*hashed, "_lot"), F.lit(batches)))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.loc[part.index.repeat(part["_copies"])]
        part = part.sort_values(["length", "doc_id", "start"], ascending=False, kind="stable")
        window = pack_lengths(part["length"].to_numpy(), capacity)
        order = np.argsort(window, kind="stable")
        part, window = part.iloc[order], window[order]
        length = part["length"].to_numpy()
        before = np.cumsum(length) - length
        first = np.r_[True, window[1:] != window[:-1]] if len(window) else np.zeros(0, bool)
        return part[columns].assign(
            sequence_id=(part["_batch"].to_numpy() << 32) + window, offset=before - np.maximum.accumulate(before * first)
        )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return keyed.groupBy("_batch").applyInPandas(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = WINDOW) -> DataFrame:
    """Where every piece of every document lies: its digest and place, without the ids themselves.

    `pack(cut_pieces(tokenize(…)))` gives the same with the ids.
    """
    pieces = cut_pieces(tokenize(docs, tokenizer_path, end_id), capacity)
    narrow = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(stored(narrow), capacity)
