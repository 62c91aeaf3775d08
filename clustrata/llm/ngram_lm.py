"""Language-model scoring with sharded Elias-Fano n-gram tries.

The model is an interpolated bigram model with absolute discounting over the add-0.5 unigram
base; a context's first word may be the text's start, and each text ends with an end token:

    P(w | v) = max(c(vw) - D, 0) / c(v) + mass(v) / c(v) * P1(w),   P(w | v) = P1(w) if c(v) = 0

with discounts D by count (1, 2, 3 and more) from the counts of counts, and mass(v) the sum of
what was discounted, so that the probabilities of each context sum to 1.

1. Texts become *slices*: up to a few megabytes of documents as token numbers and a table of
   their distinct words' hashes. The slices are written once; texts aren't read again.
2. Words go to shards by hash: each slice sends its distinct words with their counts in the
   training rows, and gets back the counts over all training rows.
3. Bigrams go to shards by ranges of ``context << 32 | successor``, cut at quantiles of a
   bounded sample. Frequent contexts are so split over as many shards as their share needs.
   A first pass adds the counts of counts over all shards, which gives one set of discounts.
   Then a shard adds the counts up, builds a trie of quantised discounted counts and answers each
   slice: the codes of its bigrams, and its part of each context's total and mass, which the
   slice adds over the shards of a split context.
4. Each slice joins its answers and scores its documents.

Totals, masses and discounted counts are whole numbers of a small unit, so a score doesn't depend
on how texts are partitioned or contexts are split. What moves is one entry per distinct word
and bigram of a slice, packed by byte planes; a shard holds a bounded number of entries, however large the corpus. Hashes of contexts and
successors have 32 bits within the pair: contexts that share one share their counts.

Defined cases: null and empty texts consist of the end token; with no training row every
probability is that of the base (0.5 / 0.5 for the only type); a null id is not in a
training fold unless the caller's condition says so; repeated rows count each; other columns
take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACED, Words, materialise, plus, slices, utf8
from .elias_fano import U64, Trie

#: Bytes of text in a slice, tokens for each shard, and the bounded sample that places the cuts.
SLICE, SHARD_TOKENS, SAMPLED_SLICES, SAMPLED_KEYS = 1 << 21, 1 << 20, 64, 4096
#: Slices in one Arrow batch.
ROWS = 2
# Hashes that stand for the start and the end of a text.
START, END = U64(0x5A17C0DE00000001), U64(0xE4D0C0DE00000002)
LOW32 = U64(0xFFFFFFFF)


def _planes(x: np.ndarray) -> bytes:
    """Integers byte by byte, the lowest bytes of all first: sorted or small ones compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _slices(docs: DataFrame) -> DataFrame:
    """(slice, ids, train, lengths, words, tokens) from (id, text, train)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32  # the same when a task runs again
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            train = np.asarray(batch.column(2).fill_null(False).to_numpy(zero_copy_only=False), bool)
            for lo, hi in slices(offsets, SLICE):
                words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], SPACED)
                lengths = np.diff(words.first) + 1
                tokens = np.insert(words.hash, words.first[1:], END)
                names, which, counts = np.unique(tokens, return_inverse=True, return_counts=True)
                order = np.argsort(-counts, kind="stable")
                rank = np.empty(len(order), np.uint32)
                rank[order] = np.arange(len(order))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(0).slice(lo, hi - lo)),
                        pa.array([np.packbits(train[lo:hi]).tobytes()], pa.binary()),
                        pa.array([_planes(lengths.astype("<u4"))], pa.binary()),
                        pa.array([names[order].tobytes()], pa.binary()),
                        pa.array([_planes(rank[which])], pa.binary()),
                    ],
                    names=["slice", "ids", "train", "lengths", "words", "tokens"],
                )
                number += 1

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(scan, f"slice bigint, ids array<{kind}>, train binary, lengths binary, words binary, tokens binary")


class _Slice:
    """One slice's arrays."""

    def __init__(self, row: dict):
        self.lengths = _unplanes(row["lengths"], "<u4").astype(np.int64)
        self.words = np.frombuffer(row["words"], "<u8")
        self.tokens = _unplanes(row["tokens"], "<u4").astype(np.int64)
        train = np.unpackbits(np.frombuffer(row["train"], np.uint8))[: len(self.lengths)].astype(bool)
        self.train = np.repeat(train, self.lengths)
        self.first = np.r_[0, np.cumsum(self.lengths)[:-1]].astype(np.int64)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.words))

    def bigrams(self) -> np.ndarray:
        """Each token's key: the word before it (high bits) and itself."""
        h = self.words[self.tokens]
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[self.first] = START
        return ((before >> U64(32)) << U64(32)) | (h & LOW32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}


def _asked_contexts(keys: np.ndarray, cuts: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard that a slice needs: (shard, places of its keys, its contexts).

    keys: a slice's distinct bigrams in order. A context is asked for in every shard that its
    range of keys touches, whether or not the slice has a bigram there.
    """
    contexts = np.unique(keys >> U64(32)) << U64(32)
    low, high = np.searchsorted(cuts, contexts, "right"), np.searchsorted(cuts, contexts | LOW32, "right")
    repeat = high - low + 1
    shard = np.repeat(low, repeat) + np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    asked = np.repeat(contexts >> U64(32), repeat)
    order = np.argsort(shard, kind="stable")
    shard, asked = shard[order], asked[order]
    of_key = np.searchsorted(cuts, keys, "right")
    names = np.unique(shard)
    a, b = np.searchsorted(shard, names), np.searchsorted(shard, names, "right")
    c, d = np.searchsorted(of_key, names), np.searchsorted(of_key, names, "right")
    return [(int(s), np.arange(c[i], d[i]), asked[a[i] : b[i]]) for i, s in enumerate(names)]


def discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken off counts 1, 2, and 3 or more, from the counts of counts."""
    return discounts_of(counts_of_counts(counts))


def counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4)]


def discounts_of(seen: list[int]) -> np.ndarray:
    n1, n2, n3, n4 = seen
    if not n1 or not n2:
        return np.array([0.75, 0.9, 0.9])
    y = n1 / (n1 + 2 * n2)
    out = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9])
    return np.clip(out, 0.1, [0.98, 1.9, 2.8])


def build_trie(keys: np.ndarray, counts: np.ndarray, taken: np.ndarray | None = None) -> Trie:
    """The trie of sorted distinct bigrams with positive counts; without ``taken``, their own discounts."""
    d = (discounts(counts) if taken is None else taken)[np.minimum(counts, 3) - 1] if len(counts) else np.zeros(0)
    context = keys >> U64(32)
    first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(keys) else np.zeros(0, np.int64)
    totals = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
    kept = Trie.units(Trie.quantised(counts - d))  # what the quantised values leave is the mass, so that sums stay 1
    masses = totals * Trie.UNIT - np.add.reduceat(kept, first) if len(first) else np.zeros(0, np.int64)
    return Trie.build(keys, counts - d, totals, np.maximum(masses, 0))


def _word_answers(cut: DataFrame, shards: int) -> DataFrame:
    """(slice, shard, counts): over all training rows; and one row per shard with slice null and its sums."""
    step = U64(64 - (shards - 1).bit_length()) if shards > 1 else None

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = _Slice(row)
            order = np.argsort(own.words)
            words, counts = own.words[order], own.word_counts()[order]
            shard = (words >> step).astype(np.int64) if step is not None else np.zeros(len(words), np.int64)
            names, a = np.unique(shard, return_index=True)
            b = np.r_[a[1:], len(words)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["slice"]] * len(names), pa.int64()), pa.array(names, pa.int32()), pa.array([_planes(words[i:j]) for i, j in zip(a, b, strict=True)], pa.binary()), pa.array([_planes(counts[i:j].astype("<u4")) for i, j in zip(a, b, strict=True)], pa.binary())],
                names=["slice", "shard", "words", "counts"],
            )

    def answer(group: pa.Table) -> pa.Table:
        words = [_unplanes(x, "<u8") for x in group["words"].to_pylist()]
        counts = [_unplanes(x, "<u4") for x in group["counts"].to_pylist()]
        names, which = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(which, np.concatenate(counts), minlength=len(names)).astype("<u8")
        ends = np.cumsum([0, *map(len, words)])
        out = [_planes(total[which[i:j]]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
        sums = np.array([total.sum(), np.count_nonzero(total)], "<u8")
        return pa.table({"slice": pa.array([*group["slice"].to_pylist(), None], pa.int64()), "shard": pa.array([*group["shard"].to_pylist(), group["shard"][0].as_py()], pa.int32()), "counts": pa.array([*out, sums.tobytes()], pa.binary())})

    asked = cut.select("slice", "train", "lengths", "words", "tokens").mapInArrow(ask, "slice bigint, shard int, words binary, counts binary")
    return asked.groupBy("shard").applyInArrow(answer, "slice bigint, shard int, counts binary")


def _cuts(cut: DataFrame, shards: int) -> np.ndarray:
    """Keys at which the bigrams are cut into shards, from a bounded sample of slices."""
    some = cut.orderBy(F.xxhash64("slice")).limit(SAMPLED_SLICES).select("slice")
    some = cut.select("slice", "train", "lengths", "words", "tokens").join(F.broadcast(some), "slice", "left_semi")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys = np.unique(_Slice(row).bigrams())
            at = np.unique(np.linspace(0, len(keys) - 1, SAMPLED_KEYS).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([keys[at].tobytes()], pa.binary())], names=["keys"])

    rows = some.mapInArrow(sample, "keys binary").collect()
    keys = np.sort(np.concatenate([np.frombuffer(r["keys"], "<u8") for r in rows])) if rows else np.zeros(0, U64)
    return np.unique(keys[np.linspace(0, len(keys) - 1, shards + 1).astype(np.int64)[1:-1]]) if shards > 1 and len(keys) else np.zeros(0, U64)


def _seen(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, their summed counts) of those with positive counts."""
    every, n = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    trained = n > 0
    every, n = every[trained], n[trained]
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(n, first) if len(first) else n


def _discounts(cut: DataFrame, cuts: np.ndarray) -> np.ndarray:
    """The discounts of the whole training set: each bigram is in one shard, which gives four numbers."""
    shipped = cut.sparkSession.sparkContext.broadcast(cuts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = _Slice(row)
            keys, counts = np.unique(own.bigrams()[own.train], return_counts=True)
            names, a = np.unique(np.searchsorted(shipped.value, keys, "right"), return_index=True)
            b = np.r_[a, len(keys)][1:].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([_planes(keys[i:j]) for i, j in zip(a, b, strict=True)], pa.binary()), pa.array([_planes(counts[i:j].astype("<u4")) for i, j in zip(a, b, strict=True)], pa.binary())], names=["shard", "keys", "counts"])

    def count(group: pa.Table) -> pa.Table:
        _, counts = _seen([_unplanes(x, "<u8") for x in group["keys"].to_pylist()], [_unplanes(x, "<u4") for x in group["counts"].to_pylist()])
        return pa.table({f"n{k}": pa.array([n], pa.int64()) for k, n in enumerate(counts_of_counts(counts), 1)})

    asked = cut.select("slice", "train", "lengths", "words", "tokens").mapInArrow(ask, "shard int, keys binary, counts binary")
    parts = materialise(asked.groupBy("shard").applyInArrow(count, "n1 bigint, n2 bigint, n3 bigint, n4 bigint"), "lm-discounts")
    return discounts_of([n or 0 for n in parts.agg(*[F.sum(f"n{k}") for k in (1, 2, 3, 4)]).first()])


def _bigram_answers(cut: DataFrame, cuts: np.ndarray, taken: np.ndarray) -> DataFrame:
    """(slice, shard, codes, totals, masses) for each slice's bigrams and contexts in each shard."""
    shipped = cut.sparkSession.sparkContext.broadcast(cuts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = _Slice(row)
            keys, which = np.unique(own.bigrams(), return_inverse=True)
            counts = np.bincount(which[own.train], minlength=len(keys)).astype("<u4")
            parts = _asked_contexts(keys, shipped.value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["slice"]] * len(parts), pa.int64()),
                    pa.array([s for s, _, _ in parts], pa.int32()),
                    pa.array([_planes(keys[at]) for _, at, _ in parts], pa.binary()),
                    pa.array([_planes(counts[at]) for _, at, _ in parts], pa.binary()),
                    # contexts follow from the keys but for those without one in this shard
                    pa.array([_planes(np.setdiff1d(c, keys[at] >> U64(32)).astype("<u4")) for _, at, c in parts], pa.binary()),
                ],
                names=["slice", "shard", "keys", "counts", "more"],
            )

    def answer(group: pa.Table) -> pa.Table:
        asked = [_unplanes(x, "<u8") for x in group["keys"].to_pylist()]
        trie = build_trie(*_seen(asked, [_unplanes(x, "<u4") for x in group["counts"].to_pylist()]), taken).mapped()
        codes, totals, masses = [], [], []
        for own, more in zip(asked, group["more"].to_pylist(), strict=True):
            contexts = np.union1d(own >> U64(32), _unplanes(more, "<u4").astype(U64))
            place = trie.context(contexts)
            known = place >= 0
            got = np.zeros((2, len(contexts)), "<i8")
            got[0, known], got[1, known] = trie.totals[place[known]], trie.masses[place[known]]
            codes.append(_planes(trie.lookup(place[np.searchsorted(contexts, own >> U64(32))], own & LOW32)))
            totals.append(_planes(got[0]))
            masses.append(_planes(got[1]))
        return pa.table({"slice": group["slice"], "shard": group["shard"], "codes": pa.array(codes, pa.binary()), "totals": pa.array(totals, pa.binary()), "masses": pa.array(masses, pa.binary())})

    asked = cut.select("slice", "train", "lengths", "words", "tokens").mapInArrow(ask, "slice bigint, shard int, keys binary, counts binary, more binary")
    return asked.groupBy("shard").applyInArrow(answer, "slice bigint, shard int, codes binary, totals binary, masses binary")


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, trained (bool), n_tokens, n_known, train_tokens, base_score and score.

    The model learns from the rows that fulfil ``train``; all rows are scored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    cut = materialise(_slices(rows), "lm-slices")
    tokens = cut.agg(F.sum(F.octet_length("tokens") / 4)).first()[0] or 0
    shards = max(1, 1 << int(tokens // SHARD_TOKENS).bit_length() - 1 if tokens >= SHARD_TOKENS else 1)
    words = materialise(_word_answers(cut, max(1, shards // 4)), "lm-words", ROWS)
    sums = [np.frombuffer(r["counts"], "<u8") for r in words.where(F.col("slice").isNull()).select("counts").toLocalIterator()]
    n_all, n_types = int(sum(s[0] for s in sums)), int(sum(s[1] for s in sums))
    cuts = _cuts(cut, shards)
    pairs = materialise(_bigram_answers(cut, cuts, _discounts(cut, cuts)), "lm-pairs", ROWS)
    shipped = docs.sparkSession.sparkContext.broadcast(cuts)
    steps = max(1, shards // 4)
    step = U64(64 - (steps - 1).bit_length()) if steps > 1 else None

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("train", "lengths", "words", "tokens", "w", "p")}
                own = _Slice(row)
                order = np.argsort(own.words)
                count = np.zeros(len(own.words))
                shard = (own.words[order] >> step).astype(np.int64) if step is not None else np.zeros(len(order), np.int64)
                got = {x["shard"]: _unplanes(x["counts"], "<u8") for x in row["w"]}
                count[order] = np.concatenate([got[s] for s in np.unique(shard).tolist()])
                base = (count + 0.5) / (n_all + 0.5 * (n_types + 1))
                keys, which = np.unique(own.bigrams(), return_inverse=True)
                contexts = np.unique(keys >> U64(32))
                code, total, mass = np.zeros(len(keys), "<u2"), np.zeros(len(contexts)), np.zeros(len(contexts))
                got = {x["shard"]: x for x in row["p"]}
                for s, at, asked in _asked_contexts(keys, shipped.value):
                    code[at] = _unplanes(got[s]["codes"], "<u2")
                    place = np.searchsorted(contexts, asked)
                    total[place] += _unplanes(got[s]["totals"], "<i8")
                    mass[place] += _unplanes(got[s]["masses"], "<i8") / Trie.UNIT
                of_key = np.searchsorted(contexts, keys >> U64(32))
                seen = np.maximum(total, 1)[of_key]
                kept, left = (Trie.value(code) / seen)[which], np.where(total[of_key] > 0, mass[of_key] / seen, 1.0)[which]
                p1 = base[own.tokens]
                logs = np.log10(np.minimum(kept + left * p1, 1.0))
                sums = lambda x: np.add.reduceat(x, own.first) if len(own.first) else x[:0]
                n = len(own.lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values,
                        pa.array(own.train[own.first]),
                        pa.array(own.lengths),
                        pa.array(sums((count[own.tokens] > 0).astype(np.int64))),
                        pa.array(np.full(n, n_all), pa.int64()),
                        pa.array(sums(np.log10(p1))),
                        pa.array(sums(logs)),
                    ],
                    names=["id", "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    per_slice = words.where(F.col("slice").isNotNull()).groupBy("slice").agg(F.collect_list(F.struct("shard", "counts")).alias("w"))
    per_pair = pairs.groupBy("slice").agg(F.collect_list(F.struct("shard", "codes", "totals", "masses")).alias("p"))
    ready = cut.join(per_slice, "slice").join(per_pair, "slice").select("ids", "train", "lengths", "words", "tokens", "w", "p")
    schema = plus(rows.select("id").schema, trained="boolean", n_tokens="bigint", n_known="bigint", train_tokens="bigint", base_score="double", score="double")
    return materialise(ready.mapInArrow(finish, schema).withColumnRenamed("id", id_col), "lm-scores", ROWS)


