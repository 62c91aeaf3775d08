"""Shared ground of the corpus operators: written tables, Arrow text buffers and hashed words.

Text operators that need Python read the UTF-8 buffer of an Arrow column directly and
work on it with NumPy, a few megabytes at a time, so that the memory of a task depends
neither on the number of rows nor on Spark's batch size, only on the longest document.
"""

from __future__ import annotations

import atexit
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of text that one NumPy pass holds (its temporaries then fit a core's cache); a longer document is a pass of its own.
SLICE_BYTES = 1 << 18

#: Ids in a broadcast filter (beyond it the filter is a shuffled join).
FILTER_IDS = 1 << 20

_written: list[tuple[SparkSession, str]] = []
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where the setting is missing and one machine does all (tests, a notebook) a folder of
    that machine takes its place; a cluster without the setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="shared-")
        found = _own[context.applicationId]
    return found.rstrip("/")


#: With this setting Spark removes a statement's shuffle files when the statement ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Bytes of a batch that a Python function in a written table's plan gets at a time (one row may have more).
ARROW_BYTES = 1 << 24


def materialise(df: DataFrame, name: str, batch: int = 2000) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    This cuts the lineage in a way that survives the loss of any executor, and the shuffle
    files behind the table, which nothing reads again, are removed once it is written. Python
    functions in the plan get ``batch`` rows or ``ARROW_BYTES`` at a time. The folder is removed
    when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    own = {_CLEANUP: "true", _BATCH: str(batch), _BATCH_BYTES: str(ARROW_BYTES)}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _remove_written() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session may be gone; the folder is the cluster's to clear
            return


def give_back() -> None:
    """Return freed memory to the machine: Spark keeps a Python worker for later tasks, which would hold it for them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function over batches; its task ends by giving memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from scan(batches)
        finally:
            give_back()

    return run


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = "_" + name
    return name


def plus(schema: T.StructType, **new: str) -> T.StructType:
    """The schema with more columns behind, by their types in DDL."""
    more = T._parse_datatype_string(", ".join(f"`{name}` {kind}" for name, kind in new.items()))
    return T.StructType([*schema.fields, *more.fields])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    elif pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        width = np.int32
    else:
        column, width = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("" if "string" in str(column.type) else b"")
    n = len(column)
    _, offsets, values = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    ends = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold up to ``most`` bytes, or one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words that end at ASCII white space only.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words made of ASCII digits, letters and whatever is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to n."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        out = []
        for base in (_BASE, _INVERSE):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _powers = tuple(out)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly over all bits (in place)."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


class Words:
    """The words of consecutive documents: place, 64-bit hash and document of each.

    Hashes are differences of one running polynomial sum over the bytes, so a word costs
    the same whatever its length, and equal words have equal hashes anywhere.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.text = _LOWER[data]
        n = len(data)
        inside = kind[self.text]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[cut[:n]] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty(n, bool)
        after[n - 1 :] = False
        after[:-1] = inside[1:]
        after[cut[1:]] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        power, self._inverse = _table(n + 1)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum((self.text.astype(np.uint64) + np.uint64(1)) * power[:n], out=self._sum[1:])
        #: First word of each document, and the number of words behind the last.
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self.spans(self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from start to end."""
        return mix((self._sum[end] - self._sum[start]) * self._inverse[start])

    def doc(self) -> np.ndarray:
        """The document of each word, as a row number."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n consecutive hashes; runs may cross documents."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out *= np.uint64(_BASE)
        out += h[k : len(h) - n + 1 + k]
    return mix(out)


def grams_at(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """As ``grams(h, n)[at]``, for a few places only."""
    out = h[at].copy()
    for k in range(1, n):
        out *= np.uint64(_BASE)
        out += h[at + k]
    return mix(out)


def within(first: np.ndarray, count: int, n: int) -> np.ndarray:
    """Which runs of n words, by first word, stay inside their document."""
    size = max(0, count - n + 1)
    ok = np.ones(size, bool)
    for k in range(1, n):  # a run may not hold the first word of another document past its own first
        starts = first[1:-1] - k
        ok[starts[(starts >= 0) & (starts < size)]] = False
    return ok
