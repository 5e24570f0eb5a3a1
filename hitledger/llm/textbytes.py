"""Words of Arrow text batches as numpy arrays, without a Python object per word.

Texts are UTF-8 bytes. All the word classes used here are told by ASCII bytes
alone, and no byte of a longer character is ASCII, so working on bytes gives
the same words as working on characters.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# An odd multiplier and its inverse modulo 2**64, and mixing constants.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB

#: Bytes of rows that Spark hands a Python worker at once (a longer row alone).
BATCH_BYTES = 8 << 20

#: Where a worker keeps hash powers while a task runs.
KEPT_POWERS = "_hitledger_powers"

Rows = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(spark: SparkSession, rows: Rows) -> Rows:
    """``rows`` for ``mapInArrow``, with little memory held on both sides.

    The session's Arrow batches are brought down to BATCH_BYTES where they are
    larger, and a worker that is through with a task gives freed memory back, as
    it lives on beside the tasks of other stages.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(setting).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(setting, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        sys.modules.pop(KEPT_POWERS, None)  # quickly made again
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return run


#: Texts are worked on in pieces of about so many bytes (a longer text alone).
PIECE_BYTES = 1 << 20


def byte_table(space: bytes, lower: bool = True) -> np.ndarray:
    """A lookup that sends the bytes in ``space`` to a blank and A-Z to a-z."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[list(space)] = 32
    return table


WHITE = bytes([32, *range(9, 14)])
#: Everything ASCII that is no digit and no letter once A-Z are lower-cased.
NOT_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and the n + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """A batch in row ranges of about ``limit`` bytes of text each."""
    data, offsets = utf8_column(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        own = offsets[first : last + 1]
        yield batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of blank-separated bytes, and each row's first word (n + 1 values)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = data != 32
    edge = np.zeros(len(data) + 1, bool)  # a row's first byte begins a word of its own
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse, modulo 2**64; they are kept outside of what tasks are pickled with."""
    kept = sys.modules.setdefault(KEPT_POWERS, types.ModuleType(KEPT_POWERS))
    if len(getattr(kept, "up", ())) < n:
        size = max(n, 2 * len(getattr(kept, "up", ())))
        kept.up, kept.down = (
            np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
            for base in (BASE, BASE_INVERSE)
        )
    return kept.up[:n], kept.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the spans [start, end) of ``values``, the same wherever a span lies."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(span_sums(data, starts, ends) + (ends - starts).astype(np.uint64) * np.uint64(MIX_2))


def window_hashes(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all runs of ``length`` words that stay within their row."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    within = np.ones(len(words) + 1, bool)
    for k in range(1, length):  # a window may not begin so near the end of its row
        ends = first[1:]
        before = np.maximum(ends - k, 0)
        within[before[ends - k >= first[:-1]]] = False
    at = np.flatnonzero(within[:n])
    return at, mix(span_sums(words, at, at + length) + np.uint64(length))
