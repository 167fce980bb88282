"""Arrow and numpy helpers the corpus operators share.

Hashes are 64-bit: prefix sums of a polynomial modulo 2**64, then a mixing step, so the hash of any
byte range costs one subtraction and one product.
"""

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and where each row starts (one more at the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    array = pc.fill_null(column.cast(pa.large_string()), "")
    if len(array) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    held = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return held, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``limit`` text bytes; a longer row is a piece of its own."""
    _, offsets = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(length: int, base: int = _BASE) -> np.ndarray:
    """``base`` to the powers from 0 on, at least ``length`` of them; the longest made is kept until a task ends (see ``tidy``)."""
    held = _POWERS.get(base, ())
    if len(held) < max(1 << 16, length):
        held = np.full(1 << max(16, int(length).bit_length()), base, np.uint64)
        held[0] = 1
        held = _POWERS[base] = np.multiply.accumulate(held)
    return held


def give_back() -> None:
    """Return to the system what this process no longer uses; allocators keep it otherwise."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for the batches of a task, with ``give_back`` after it.

    Workers are reused, and those of an executor stand beside its heap: what one step has held must not stay through the next.
    """
    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return tidied


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``range_hash`` takes the hash of any byte range."""
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(len(data) + 1)[:len(data)]
    np.cumsum(terms, out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges from ``start`` up to ``end``, the same wherever the bytes stand."""
    inverse = powers(len(sums), _BASE_INVERSE)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word and how many words come before each row: words are runs of bytes
    other than ASCII white space, and never cross rows."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    gap = _SPACE[data]
    begin = ~gap
    begin[1:] &= gap[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    begin[inner] = ~gap[inner]
    starts = np.flatnonzero(begin)
    finish = np.append(gap, True)[1:] & ~gap
    edge = inner[inner > 0] - 1
    finish[edge] = ~gap[edge]
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def window_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbouring 64-bit values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out *= np.uint64(_BASE)
        out += values[i:i + n]
    return mix(out)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total) + shift


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows start a new group, by any of the keys."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def bucket_count(spark: SparkSession) -> int:
    """Buckets for work dealt by hash: eight for each shuffle partition, so they grow with that setting
    and one bucket, which a task holds in memory, is an eighth of a partition."""
    return 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def any_bucket(ids: np.ndarray, buckets: int) -> int:
    """A bucket for a row of packed columns that only passes through, told by its first id.

    Counting from zero in each task would send the rows of all tasks to the same few buckets.
    """
    return int((mix(ids[:1]) >> np.uint64(32))[0] % np.uint64(buckets)) if len(ids) else 0


class Scatter:
    """Collects rows in a task and hands them out as one row of packed columns for each bucket.

    Rows of a few bytes would cost more in headers than in content; packed, a shuffle moves the
    content only. ``flush`` is called whenever ``full`` says so, which bounds what a task holds.
    """

    def __init__(self, buckets: int, columns: dict[str, type], limit: int = 1 << 20):
        self.buckets, self.columns, self.limit = buckets, columns, limit
        self.parts: list[tuple[np.ndarray, list[np.ndarray]]] = []
        self.held = 0

    @staticmethod
    def schema(columns: dict[str, type]) -> str:
        return "bucket int, " + ", ".join(f"{c} binary" for c in columns)

    def add(self, hashes: np.ndarray, *arrays: np.ndarray) -> None:
        bucket = (hashes >> np.uint64(32)) % np.uint64(self.buckets)
        self.parts.append((bucket.astype(np.int32), [a.astype(t, copy=False) for a, t in zip(arrays, self.columns.values())]))
        self.held += len(hashes)

    @property
    def full(self) -> bool:
        return self.held >= self.limit

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        bucket = np.concatenate([p[0] for p in self.parts])
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        cuts = np.append(group_starts(bucket), len(bucket))
        packed = [pa.array(bucket[cuts[:-1]], pa.int32())]
        for i in range(len(self.columns)):
            values = np.concatenate([p[1][i] for p in self.parts])[order]
            packed.append(pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()))
        self.parts, self.held = [], 0
        yield pa.RecordBatch.from_arrays(packed, ["bucket", *self.columns])


def gathered(table: pa.Table, columns: dict[str, type]) -> list[np.ndarray]:
    """The packed columns of a bucket's rows, unpacked and joined."""
    return [np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in columns.items()]


def small_batches(spark: SparkSession) -> None:
    """Hand Python at most 500 rows at a time, so that tasks of 1 GB hold several batches of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def narrowed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (and ``more``) of documents, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)
