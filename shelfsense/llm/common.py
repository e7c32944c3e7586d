"""Helpers shared by the operators: worker state, stored tables, and Arrow batches as numpy."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.session import checkpoint_dir


def worker_state(owner: str) -> dict:
    """What a Python worker keeps for an operator between tasks, such as a loaded tokenizer.

    One operator at a time: a worker that goes on to another one forgets what the last one kept, so
    a pipeline needs no more memory than its largest stage.
    """
    state = vars(sys.modules.setdefault("shelfsense_worker_state", types.ModuleType("shelfsense_worker_state")))
    if state.get("_owner") != owner:
        state.clear()
        state["_owner"] = owner
        release_memory()
    return state


def release_memory() -> None:
    """Give memory that is free by now back to the system; a worker would keep its peak otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def stored(df: DataFrame) -> DataFrame:
    """Write `df` as a compressed table to the shared folder and go on from there.

    Work done so far is not repeated when an executor is lost, and a plan that reads the table
    twice does not compute it twice.
    """
    path = new_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/shelfsense-llm-{uuid.uuid4().hex}"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blobs(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """The values of a string or binary column as bytes; null gives empty bytes."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column in one array, and where each value begins and ends.

    Nulls are empty. The bytes are a view on the batch, not a copy.
    """
    column = column.cast(pa.binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch where a text column passes `limit` bytes, so that work arrays stay bounded.

    A single value longer than the limit makes a slice of its own.
    """
    sizes = np.diff(flat_bytes(batch.column(column))[1])
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def digest(*columns: str) -> F.Column:
    """A 128-bit key for the values of some columns: two 64-bit hashes with different seeds."""
    return F.struct(F.xxhash64(F.lit(1), *columns).alias("a"), F.xxhash64(F.lit(2), *columns).alias("b"))
