"""Benchmark decontamination by winnowing.

Words are hashed, every run of ``K`` words gets a hash, and of each ``SPAN - K + 1`` runs in
a row the least hash is a fingerprint. A span of ``SPAN`` words holds exactly so many runs,
so any span that a document shares with the benchmark has a fingerprint at the same place
in both: joining the two sets of fingerprints misses nothing. Each joined hit is extended to
all the ``SPAN``-word windows around it, and those are looked up in the benchmark's windows.
An item of fewer than ``SPAN`` words is one window and its own fingerprint.

The benchmark's index has a checked size: it is cut into blocks of at most ``BLOCK``
windows, each broadcast on its own, and the documents pass through one map-side step for
each block. Documents are never shuffled, whatever the size of the benchmark.

Defined cases: null and word-less texts have no words and no hits; items without words
have no window; items with equal texts count each; a null item_id never counts as an item
though its windows hit; repeated rows give repeated results; empty tables are allowed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, Words, fresh, grams, grams_at, materialise, slices, utf8

SPAN, K = 10, 5
#: Windows in one broadcast block: about 20 MB, so that a driver holds a few of them.
BLOCK = 1 << 20


def _least(g: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w consecutive values."""
    out = g[: max(0, len(g) - w + 1)].copy()
    for k in range(1, w):
        np.minimum(out, g[k : k + len(out)], out=out)
    return out


def _chosen(g: np.ndarray, w: int) -> np.ndarray:
    """Which values are the least of some w in a row (ties included)."""
    low = _least(g, w)
    out = np.zeros(len(g), bool)
    for k in range(w):
        out[k : k + len(low)] |= g[k : k + len(low)] == low
    return out


class _Set:
    """Sorted hashes with a bit table in front, so that most look-ups end after one read."""

    def __init__(self, values: np.ndarray):
        self.values = values
        bits = max(16, min(26, int(len(values) * 16).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(values >> self.shift).astype(np.int64)] = True

    def find(self, x: np.ndarray) -> np.ndarray:
        """Indices in x of the members."""
        at = np.flatnonzero(self.table[(x >> self.shift).astype(np.int64)])
        if not len(at) or not len(self.values):
            return at[:0]
        i = np.minimum(np.searchsorted(self.values, x[at]), len(self.values) - 1)
        return at[self.values[i] == x[at]]


def _windows(texts: pa.Array) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(row, window hash, words, fingerprints) of each window of each text."""
    data, offsets = utf8(texts)
    for lo, hi in slices(offsets):
        words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ALNUM)
        for row in range(hi - lo):
            h = words.hash[words.first[row] : words.first[row + 1]]
            n = len(h)
            if 0 < n < SPAN:
                yield lo + row, int(grams(h, n)[0]), n, np.zeros(0, np.uint64)
            elif n:
                g = grams(h, K)
                for x, low in zip(grams(h, SPAN), _least(g, SPAN - K + 1), strict=True):
                    yield lo + row, int(x), SPAN, np.array([low])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words, window, print): the hash of every window and its winnowed fingerprint, once an item."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(x, n, r, p) for r, x, n, p in _windows(batch.column(1))]
            signed = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([r for _, _, r, _ in found], pa.int64())), pa.array([n for _, n, _, _ in found], pa.int32()), signed([x for x, *_ in found]), signed([p[0] if len(p) else x for x, _, _, p in found])],
                names=["item", "words", "window", "print"],
            )

    return benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).mapInArrow(windows, "item string, words int, window long, print long").distinct()


class _Block:
    """The index of one block of benchmark windows, as arrays that ship as they are."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("words", "ascending"), ("window", "ascending")])
        self.lengths = {}
        words = rows["words"].to_numpy()
        for n in np.unique(words):
            part = rows.filter(pa.array(words == n))
            window = part["window"].to_numpy().view(np.uint64)
            names = np.array([x if x is not None else "" for x in part["item"].to_pylist()], object)
            known = np.array([x is not None for x in part["item"].to_pylist()], bool)
            order = np.argsort(window, kind="stable")
            window, names, known = window[order], names[order], known[order]
            distinct, begin = np.unique(window, return_index=True)
            self.lengths[int(n)] = (distinct, np.append(begin, len(window)), names, known, np.unique(part["print"].to_numpy().view(np.uint64)))

    def ready(self) -> _Block:
        self.sets = {n: (_Set(x[0]), _Set(x[4])) for n, x in self.lengths.items()}
        return self

    def hits(self, words: Words) -> Iterator[tuple[int, np.ndarray]]:
        """(n, first words) of all places where a window of n words occurs."""
        count = len(words)
        for n, (windows, prints) in self.sets.items():
            if count < n:
                continue
            if n < SPAN:
                g = grams(words.hash, n)
                at = windows.find(g)
            else:
                g = grams(words.hash, K)
                own = np.flatnonzero(_chosen(g, SPAN - K + 1))  # the document's fingerprints
                known = own[prints.find(g[own])]
                if not len(known):
                    continue
                around = (known[:, None] - np.arange(SPAN - K + 1)).ravel()
                around = np.unique(around[(around >= 0) & (around <= count - SPAN)])
                low = np.minimum.reduce([g[around + k] for k in range(SPAN - K + 1)])
                around = around[np.isin(low, g[known])]  # the hit has to be the fingerprint of the window
                if not len(around):
                    continue
                at = around[windows.find(grams_at(words.hash, around, n))]
            inside = np.searchsorted(words.first, at, "right") == np.searchsorted(words.first, at + n - 1, "right")
            at = at[inside]
            if len(at):
                yield n, at

    def items(self, words: Words, n: int, at: np.ndarray) -> Iterator[tuple[int, str]]:
        """(document, item) of each place, once."""
        distinct, begin, names, known, _ = self.lengths[n]
        which = np.searchsorted(distinct, grams_at(words.hash, at, n))
        doc = np.searchsorted(words.first, at, "right") - 1
        for d, i in np.unique(np.stack([doc, which], 1), axis=0):
            for j in range(begin[i], begin[i + 1]):
                if known[j]:
                    yield int(d), names[j]


def _blocks(windows: DataFrame) -> Iterator[pa.Table]:
    """The benchmark's windows in blocks of at most about BLOCK, cut by hash; the driver holds one at a time."""
    kept = materialise(windows, "benchmark-windows")
    parts = max(1, -(-kept.count() // BLOCK))
    for i in range(parts):
        yield kept.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == i).toArrow()


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` with n_words, n_hit, spans (first and last hit words) and items.

    Columns ``n_words``, ``n_hit``, ``spans`` and ``items`` of the input are replaced.
    """
    spark = docs.sparkSession
    new = ("n_words", "n_hit", "spans", "items")
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    kept = out.columns
    runs, names, words_col = (fresh(docs, x) for x in ("runs", "names", "words"))
    at = kept.index(text_col)
    out = out.withColumns({runs: F.array().cast("array<bigint>"), names: F.array().cast("array<string>"), words_col: F.lit(0).cast("bigint")})
    for rows in _blocks(benchmark_windows(benchmark, item_col, item_text)):
        shipped = spark.sparkContext.broadcast(_Block(rows))
        width = len(kept)

        def scan(batches: Iterator[pa.RecordBatch], shipped=shipped, width=width) -> Iterator[pa.RecordBatch]:
            index = shipped.value.ready()
            for batch in batches:
                data, offsets = utf8(batch.column(at))
                spans, items, counts = batch.column(width).to_pylist(), batch.column(width + 1).to_pylist(), np.zeros(batch.num_rows, np.int64)
                for lo, hi in slices(offsets):
                    words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ALNUM)
                    counts[lo:hi] = np.diff(words.first)
                    mark, touched = None, set()
                    for n, places in index.hits(words):
                        if mark is None:
                            mark = np.zeros(len(words) + 1, np.int64)
                        np.add.at(mark, places, 1)
                        np.add.at(mark, places + n, -1)
                        for d, item in index.items(words, n, places):
                            touched.add(d)
                            items[lo + d].append(item)
                        touched.update((np.searchsorted(words.first, places, "right") - 1).tolist())
                    hit = np.cumsum(mark) > 0 if mark is not None else None
                    for d in touched:
                        a, b = words.first[d], words.first[d + 1]
                        edge = np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]]))
                        own = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1], 1).ravel().tolist()
                        spans[lo + d] = _merged(spans[lo + d], own)
                        items[lo + d] = sorted(set(items[lo + d]))
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())), pa.array(counts)], names=batch.schema.names)

        out = out.mapInArrow(scan, out.schema)
    pairs = F.transform(F.sequence(F.lit(0), (F.size(runs) / 2).cast("int") - 1), lambda i: F.struct(F.get(runs, i * 2).alias("first"), F.get(runs, i * 2 + 1).alias("last")))
    spans = F.when(F.size(runs) > 0, pairs).otherwise(F.array().cast("array<struct<first:bigint,last:bigint>>"))
    done = out.select(*[F.col(f"`{c}`") for c in kept], F.col(words_col).alias("n_words"), spans.alias("spans"), F.col(names).alias("items"))
    return done.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["last"] - s["first"] + 1))


def _merged(a: list[int], b: list[int]) -> list[int]:
    """Two lists of first and last hit words as one."""
    if not a:
        return b
    out: list[int] = []
    for first, last in sorted([*zip(a[::2], a[1::2], strict=True), *zip(b[::2], b[1::2], strict=True)]):
        if out and first <= out[-1] + 1:
            out[-1] = max(out[-1], last)
        else:
            out += [first, last]
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark."""
    found = find_contamination(docs, benchmark, text_col)
    return found.where(F.col("n_hit") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def items_digest(items: Column | str) -> Column:
    """SHA-256 in hex of the sorted item ids, comma-joined."""
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)


