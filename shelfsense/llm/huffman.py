"""Token files: ids coded with a canonical Huffman code of bounded length, in blocks decoded apart.

A folder holds two tables. `code` has the code length of every id that occurs; the codes follow from
the lengths. `blocks` has rows in ascending document order within each `part`, and parts ascend too:

* `part`, `block`: place of the block; blocks ascend within a part but are not numbered one by one,
* `doc_ids`, `n_tokens`: its documents and their lengths,
* `checkpoints`: unsigned 32-bit bit offsets of every `CHECKPOINT`-th token,
* `payload`: the code words, most significant bit first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from shelfsense.llm.common import partitions, stored
from shelfsense.llm.tokens import worker_encoder

MAX_BITS = 20
CHECKPOINT = 256
BLOCK_TOKENS = 1 << 18
COUNTED_AT_ONCE = 500


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Code length of each symbol, the best with at most `max_bits` bits, by package-merge.

    Package-merge keeps, for every bit level, the cheapest items (symbols or pairs of the level
    below); a symbol's length is the number of levels where it is among the chosen ones.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols do not fit in codes of {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    levels, items = [], weights
    is_symbol = np.ones(n, bool)
    for _ in range(max_bits - 1):
        levels.append(is_symbol)
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        place = np.argsort(both, kind="stable")
        items, is_symbol = both[place], place < n
    levels.append(is_symbol)
    lengths, chosen = np.zeros(n, np.int64), 2 * n - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:chosen].sum())
        lengths[:symbols] += 1
        chosen = 2 * (chosen - symbols)
    result = np.empty(n, np.int64)
    result[order] = lengths
    return result


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, symbol), each the one before plus one, shifted to its length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    top = int(lengths.max(initial=1))
    steps = np.left_shift(1, top - lengths[order])
    codes = np.empty(len(lengths), np.int64)
    codes[order] = (np.cumsum(steps) - steps) >> (top - lengths[order])
    return codes


class Coder:
    """Encoder and table-driven decoder of one code; `symbols` ascend."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.symbols, self.lengths = symbols, lengths.astype(np.int64)
        self.codes = canonical_codes(self.lengths)
        self.bits = int(lengths.max(initial=1))
        self.code_of, self.length_of = np.zeros((2, int(symbols.max(initial=0)) + 1), np.int64)
        self.code_of[symbols], self.length_of[symbols] = self.codes, self.lengths
        order = np.lexsort((np.arange(len(lengths)), self.lengths))
        self.table = np.zeros(1 << self.bits, np.int64)  # symbol and length for every run of `bits` bits
        filled = np.repeat(self.symbols[order] << 5 | self.lengths[order], np.left_shift(1, self.bits - self.lengths[order]))
        self.table[: len(filled)] = filled

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Payload and the bit offset of every `CHECKPOINT`-th id."""
        lengths = self.length_of[ids]
        ends = np.cumsum(lengths)
        begins = ends - lengths
        word, free = begins >> 5, 64 - (begins & 31) - lengths
        shifted = self.code_of[ids] << free  # at most 52 bits from the top: fits in two 32-bit words
        total = int(ends[-1]) if len(ends) else 0
        words = np.zeros((total >> 5) + 3, np.uint32)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
        if len(first):
            high = np.add.reduceat(shifted >> 32 & 0xFFFFFFFF, first)
            low = np.add.reduceat(shifted & 0xFFFFFFFF, first)
            words[word[first]] += high.astype(np.uint32)
            words[word[first] + 1] += low.astype(np.uint32)
        return words.astype(">u4").tobytes()[: -(-total // 8)], begins[::CHECKPOINT].astype("<u4")

    def decode(self, payload: bytes, checkpoints: np.ndarray, count: int) -> np.ndarray:
        """All ids of a block. The stretches between checkpoints are decoded side by side."""
        words = np.frombuffer(payload + bytes(12 - len(payload) % 4), ">u4").astype(np.uint64)
        joined = words[:-1] << np.uint64(32) | words[1:]
        at = checkpoints.astype(np.int64)
        out = np.zeros((CHECKPOINT, len(at)), np.int64)
        last = count - (len(at) - 1) * CHECKPOINT
        for step in range(CHECKPOINT if len(at) > 1 else max(last, 0)):
            live = len(at) if step < last else len(at) - 1
            position = at[:live]
            window = joined[position >> 5] >> (64 - self.bits - (position & 31)).astype(np.uint64)
            entry = self.table[(window & np.uint64((1 << self.bits) - 1)).astype(np.int64)]
            out[step, :live] = entry >> 5
            at[:live] += entry & 31
        return out.T.reshape(-1)[:count].astype("<u4")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, parts: int | None = None) -> None:
    """Tokenise documents, code their ids with one code for all, and write them in doc_id order.

    Rows with equal doc_id are ordered by their ids. The parts are ranges of doc_id with about equal
    numbers of rows. Tokens are stored in this order before they are coded, since the code needs the
    counts of all. An empty table gives empty files.
    """
    spark = docs.sparkSession
    parts = parts or partitions(spark)
    shares = [i / parts for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0] if shares else None
    bounds = np.array(bounds or [], np.int64)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                keys = part.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
                ids = [encode(text) + end if text else end for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.searchsorted(bounds, keys), pa.int32()), part.column("doc_id"), pa.array(narrow(ids), pa.binary())],
                    ["part", "doc_id", "ids"],
                )

    def narrow(rows: list[bytes]) -> list[bytes]:
        """Two bytes for each id where all fit; a leading byte tells the width."""
        values = np.frombuffer(b"".join(rows), "<u4")
        if values.max(initial=0) >= 1 << 16:
            return [b"\4" + ids if np.frombuffer(ids, "<u4").max() >= 1 << 16 else b"\2" + np.frombuffer(ids, "<u4").astype("<u2").tobytes() for ids in rows]
        small = values.astype("<u2").tobytes()
        ends = np.cumsum([len(ids) // 2 for ids in rows]).tolist()
        return [b"\2" + small[begin:end] for begin, end in zip([0, *ends], ends)]

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenise, "part int, doc_id long, ids binary")
    # A part is whole in one task only here. Files are read back in splits, so each row keeps its place.
    ordered = rows.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "ids")
    ordered = stored(ordered.withColumn("place", F.monotonically_increasing_id()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(0, np.int64)
        for batch in batches:
            # A histogram is as long as the vocabulary, so it is made for many documents at once.
            for start in range(0, batch.num_rows, COUNTED_AT_ONCE):
                part = batch.column("ids").slice(start, COUNTED_AT_ONCE).to_pylist()
                some = np.bincount(np.concatenate([widen(ids) for ids in part]))
                if len(some) > len(totals):
                    some, totals = totals, some
                totals[: len(some)] += some
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["id", "n"])

    counts = ordered.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = counts.sort_values("id")  # at most one row for each id of the vocabulary
    symbols, lengths = counts["id"].to_numpy(np.int64), code_lengths(counts["n"].to_numpy(np.int64))
    code = pa.table({"id": symbols, "length": lengths})
    spark.createDataFrame(code).coalesce(1).write.parquet(f"{path}/code")

    def encode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(symbols, lengths)
        held: list[tuple] = []
        part, block, size = None, 0, 0

        def close() -> pa.RecordBatch:
            arrays = [widen(ids) for _, ids in held]
            payload, checkpoints = coder.encode(np.concatenate(arrays))
            columns = [[part], [block], [[d for d, _ in held]], [[len(a) for a in arrays]], [checkpoints.tobytes()], [payload]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, BLOCK_KINDS)], BLOCK_NAMES)

        for batch in batches:
            for own, place, doc_id, ids in zip(*(batch.column(name).to_pylist() for name in ("part", "place", "doc_id", "ids"))):
                n = (len(ids) - 1) // ids[0]
                if held and (own != part or place != block + len(held) or size + n > BLOCK_TOKENS):
                    yield close()
                    held, size = [], 0
                if not held:
                    part, block = own, place
                held.append((doc_id, ids))
                size += n
        if held:
            yield close()

    ordered.mapInArrow(encode_blocks, BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def widen(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, f"<u{ids[0]}", offset=1)


BLOCK_SCHEMA = (
    "part int, block long, doc_ids array<long>, n_tokens array<long>, checkpoints binary, payload binary"
)
BLOCK_NAMES = ["part", "block", "doc_ids", "n_tokens", "checkpoints", "payload"]
BLOCK_KINDS = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a token folder: (doc_id, start, ids binary), `start` counting the tokens before it.

    A block is decoded by itself. Totals of blocks are summed up in order within their part, and
    those of parts over all.
    """
    code = spark.read.parquet(f"{path}/code").toPandas().sort_values("id")
    symbols, lengths = code["id"].to_numpy(np.int64), code["length"].to_numpy(np.int64)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    inside = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda total, n: total + n)
    sizes = blocks.select("part", "block", inside.alias("tokens"))
    totals = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens"))

    def earlier(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("tokens").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    begins = totals.select("part", earlier(Window.orderBy("part")).alias("offset"))
    inner = sizes.select("part", "block", earlier(Window.partitionBy("part").orderBy("block")).alias("before"))
    offsets = inner.join(begins, "part").select("part", "block", (F.col("offset") + F.col("before")).alias("offset"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(symbols, lengths)
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.cumsum(row["n_tokens"])
                checkpoints = np.frombuffer(row["checkpoints"], "<u4")
                ids = coder.decode(row["payload"], checkpoints, int(ends[-1]))
                begins = ends - row["n_tokens"]
                texts = [ids[b:e].tobytes() for b, e in zip(begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["offset"]), pa.array(texts, pa.binary())],
                    ["doc_id", "start", "ids"],
                )

    return blocks.join(offsets, ["part", "block"]).mapInArrow(decode, "doc_id long, start long, ids binary")
