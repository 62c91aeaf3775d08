"""Toxicity: a convolutional text classifier in NumPy.

Words (lower-cased ASCII letters, digits and all non-ASCII bytes) are embedded as the sum of
hashed rows, one for the word and one for each of its prefixes of 3 to 8 bytes, so that
inflected forms share what they begin with. Filters of widths 1, 2 and 3 run over the word
vectors; each filter's maximum over the document feeds a logistic output. The model is fitted
by AdaGrad with gradients through the maxima. The first embedding coordinate starts from the
document frequencies in the training rows, which lets a few hundred rows suffice.

Fitting uses every labelled row. Document frequencies are one aggregate over all of them. Rows
are dealt by hash to parts of about ``PART_ROWS``; in each of ``ROUNDS`` rounds a task for each
part goes on from the same weights, and the weights of the parts that moved a value are
averaged (iterative parameter mixing), so work grows with the rows and no task holds more than
its part. A fifth of the rows, by hash, is set aside to choose a threshold for each language,
from counts of all their scores. Scoring is map-side, over whole texts.

Defined cases: null and empty texts get the score of no evidence (the bias), no error; rows
with null labels are not learned from; with no labelled row of a class the score is the share
of the other (0 or 1, or 0 without any label); of repeated labels of one id the highest holds;
an unknown or null language uses the overall threshold; other columns are handed on, and
columns named ``toxicity`` are replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, FILTER_IDS, Words, fresh, give_back, materialise, plus, slices, tidy, utf8

#: Labelled rows of a part; rows from which on a fifth calibrates; steps of a score in the thresholds' counts.
PART_ROWS, LEAST_HELD, STEPS = 2048, 200, 10_000
BUCKETS, DIMS, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
PREFIXES = (3, 4, 5, 6, 7, 8)
ROUNDS, EPOCHS, BATCH, RATE, SEED = 3, 2, 32, 0.05, 7


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the embedding table for each distinct word, distinct word of each word)."""
    _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
    start, end = words.start[first], words.end[first]
    rows = [words.hash[first], *[words.spans(start, np.minimum(end, start + k)) + np.uint64(k) for k in PREFIXES]]
    return np.stack([(r % np.uint64(BUCKETS)).astype(np.int64) for r in rows], 1), which


@dataclass
class Model:
    """Weights of the network, and a threshold for each language (``None``: for all others)."""

    table: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, DIMS, FILTERS)
    shift: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    thresholds: dict[str | None, float] = field(default_factory=lambda: {None: 0.5})

    def _conv(self, vectors: np.ndarray, which: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
        """Filter values at every word; words beyond the document's end count as zero vectors."""
        a = self.shift[width] + (vectors @ self.filters[width][0])[which]
        for j in range(1, width):
            shifted = (vectors @ self.filters[width][j])[which[j:]]
            ends = first[1:]
            for k in range(1, j + 1):  # places whose j-th follower belongs to another document
                at = ends - k
                at = at[(at >= 0) & (at < len(shifted))]
                shifted[at] = 0
            a[: len(shifted)] += shifted
        return a

    def pooled(self, rows: np.ndarray, which: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(documents, filters): each filter's maximum, at least 0."""
        docs = len(first) - 1
        out = np.zeros((docs, len(WIDTHS) * FILTERS), np.float32)
        some = np.flatnonzero(np.diff(first) > 0)
        if len(some):
            vectors = self.table[rows].sum(1)
            for i, width in enumerate(WIDTHS):
                a = self._conv(vectors, which, first, width)
                out[some, i * FILTERS : (i + 1) * FILTERS] = np.maximum.reduceat(a, first[some], axis=0)
        return np.maximum(out, 0)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of toxicity of the documents in a buffer."""
        out = np.empty(len(offsets) - 1)
        for lo, hi in slices(offsets):
            words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ALNUM)
            rows, which = features(words) if len(words) else (np.zeros((0, 1 + len(PREFIXES)), np.int64), np.zeros(0, np.int64))
            z = self.pooled(rows, which, words.first).astype(np.float64) @ self.out + self.bias
            out[lo:hi] = _sigmoid(z)
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def start(share: float, frequency: np.ndarray | None = None, seed: int = SEED) -> Model:
    """The model before it is fitted, for rows of which so large a share has label 1."""
    rng = np.random.default_rng(seed)
    scale = np.float32(0.05)
    model = Model(
        (rng.standard_normal((BUCKETS, DIMS)) * 0.01).astype(np.float32),
        {w: (rng.standard_normal((w, DIMS, FILTERS)) * scale).astype(np.float32) for w in WIDTHS},
        {w: np.full(FILTERS, -0.1, np.float32) for w in WIDTHS},
        (np.abs(rng.standard_normal(len(WIDTHS) * FILTERS)) * 0.1),
        0.0,
    )
    if not 0 < share < 1:
        model.bias, model.out = 40.0 if share else -40.0, np.zeros(len(WIDTHS) * FILTERS)
        return model
    model.bias = float(np.log(share / (1 - share)))
    if frequency is not None:
        model.table[:, 0] += frequency
    for w in WIDTHS:
        model.filters[w][0][0] = np.abs(model.filters[w][0][0]) + 0.3
    return model


def _unseen(model: Model) -> dict:
    """AdaGrad's sums before the first step."""
    seen = {"table": np.full(BUCKETS, 1e-3, np.float32), "out": np.full(len(model.out), 1e-3), "bias": np.full(1, 1e-3)}
    return seen | {w: np.full(model.filters[w].shape, 1e-3, np.float32) for w in WIDTHS} | {-w: np.full(FILTERS, 1e-3, np.float32) for w in WIDTHS}


def _flat(model: Model, seen: dict) -> np.ndarray:
    """All weights but the table's, and AdaGrad's sums of them, as one vector."""
    parts = [model.out, [model.bias], *(x for w in WIDTHS for x in (model.filters[w], model.shift[w]))]
    parts += [seen["out"], seen["bias"], *(x for w in WIDTHS for x in (seen[w], seen[-w]))]
    return np.concatenate([np.asarray(x, np.float64).ravel() for x in parts])


def _unflat(model: Model, seen: dict, flat: np.ndarray) -> None:
    """Set what ``_flat`` gives."""
    at = 0

    def take(like: np.ndarray) -> np.ndarray:
        nonlocal at
        at += like.size
        return flat[at - like.size : at].reshape(like.shape).astype(like.dtype)

    model.out, model.bias = take(model.out), float(take(np.zeros(1))[0])
    for w in WIDTHS:
        model.filters[w], model.shift[w] = take(model.filters[w]), take(model.shift[w])
    seen["out"], seen["bias"] = take(seen["out"]), take(seen["bias"])
    for w in WIDTHS:
        seen[w], seen[-w] = take(seen[w]), take(seen[-w])


def _numbered(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table rows of each distinct word, the distinct word of each word, first word of each text), a slice at a time."""
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    names, rows, which, counts, total = [], [], [], [], 0
    for lo, hi in slices(offsets):
        words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ALNUM)
        counts.append(np.diff(words.first))
        if len(words):
            r, w = features(words)
            names.append(np.unique(words.hash))
            rows.append(r.astype(np.int32))
            which.append(w.astype(np.int32) + total)
            total += len(r)
    if not names:
        return np.zeros((0, 1 + len(PREFIXES)), np.int64), np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    _, first, again = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
    return np.concatenate(rows)[first].astype(np.int64), again.astype(np.int32)[np.concatenate(which)], np.r_[0, np.cumsum(np.concatenate(counts))]


def _frequency_start(bucket: np.ndarray, counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How surely a bucket's presence goes with label 1: a z-score of shares of documents, scaled.

    counts: (label, bucket) documents that have the bucket; n: documents of each label.
    """
    out = np.zeros(BUCKETS, np.float32)
    if not n.all():
        return out
    share = counts.sum(0) / n.sum()
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n[0] + 1 / n[1]))
    z = (counts[1] / n[1] - counts[0] / n[0]) / spread
    strong = np.sign(z) * np.maximum(np.abs(z) - 3, 0)
    out[bucket] = np.clip(strong / 10, -0.5, 1)
    return out


def _descend(model: Model, seen: dict, rows: np.ndarray, which: np.ndarray, first: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """AdaGrad on minibatches; only the places of the maxima get a gradient. Returns the buckets of the table that moved."""
    moved = np.zeros(BUCKETS, bool)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), BATCH):
            part = order[lo : lo + BATCH]
            own = [which[first[d] : first[d + 1]] for d in part]
            starts = np.concatenate([[0], np.cumsum([len(x) for x in own])])
            words, local = np.unique(np.concatenate(own), return_inverse=True)
            vectors = model.table[rows[words]].sum(1)
            pooled = np.zeros((len(part), len(model.out)), np.float32)
            best = np.full((len(part), len(model.out)), -1)
            for i, w in enumerate(WIDTHS):
                a = model._conv(vectors, local, starts, w)
                at = slice(i * FILTERS, (i + 1) * FILTERS)
                for k in range(len(part)):
                    if starts[k + 1] > starts[k]:
                        b = a[starts[k] : starts[k + 1]]
                        m = b.argmax(0)
                        best[k, at], pooled[k, at] = m + starts[k], b[m, np.arange(FILTERS)]
            active = (pooled > 0) & (best >= 0)
            pooled = np.maximum(pooled, 0)
            p = _sigmoid(pooled.astype(np.float64) @ model.out + model.bias)
            g = (p - y[part]) / len(part)
            grad_a = (g[:, None] * model.out) * active
            grad_out = pooled.T.astype(np.float64) @ g
            into = np.zeros_like(vectors)
            for i, w in enumerate(WIDTHS):
                at = slice(i * FILTERS, (i + 1) * FILTERS)
                ga, bi = grad_a[:, at], best[:, at]
                k, f = np.nonzero(ga)
                grad_f, value = np.zeros_like(model.filters[w]), ga[k, f].astype(np.float32)
                for j in range(w):
                    place = bi[k, f] + j
                    ok = place < starts[k + 1]
                    word = local[place[ok]]
                    np.add.at(grad_f[j].T, f[ok], value[ok, None] * vectors[word])
                    np.add.at(into, word, value[ok, None] * model.filters[w][j].T[f[ok]])
                seen[w] += grad_f**2
                model.filters[w] -= RATE * grad_f / np.sqrt(seen[w])
                grad_b = ga.sum(0).astype(np.float32)
                seen[-w] += grad_b**2
                model.shift[w] -= RATE * grad_b / np.sqrt(seen[-w])
            seen["out"] += grad_out**2
            model.out -= RATE * grad_out / np.sqrt(seen["out"])
            grad_bias = float(g.sum())
            seen["bias"] += grad_bias**2
            model.bias -= float(RATE * grad_bias / np.sqrt(seen["bias"][0]))
            touched = np.flatnonzero(np.abs(into).sum(1))
            r = np.sort(rows[words[touched]], 1)
            word, at = np.nonzero(np.c_[np.ones(len(r), bool), r[:, 1:] != r[:, :-1]])  # a word's bucket counts once
            r = r[word, at]
            np.add.at(seen["table"], r, (into[touched] ** 2).mean(1)[word])
            np.add.at(model.table, r, -(0.3 * RATE * into[touched][word]) / np.sqrt(seen["table"][r])[:, None])
            moved[r] = True
    return np.flatnonzero(moved)


def _frequencies(learn: DataFrame, n: np.ndarray) -> np.ndarray:
    """``_frequency_start`` from all rows (id, text, y)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            label = batch.column(1).to_numpy()
            for lo, hi in slices(offsets):
                words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ALNUM)
                if not len(words):
                    continue
                rows, which = features(words)
                for d in range(hi - lo):
                    own = which[words.first[d] : words.first[d + 1]]
                    if len(own):
                        counts[label[lo + d]][np.unique(rows[np.unique(own)])] += 1
        some = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])], names=["bucket", "c0", "c1"])

    found = learn.select("text", "y").mapInArrow(tidy(scan), "bucket bigint, c0 bigint, c1 bigint")
    # the driver gets a row for each bucket of the table, as many for any input
    sums = found.groupBy("bucket").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).toArrow()
    return _frequency_start(sums["bucket"].to_numpy(), np.stack([sums["c0"].to_numpy(), sums["c1"].to_numpy()]), n)


def _round(learn: DataFrame, model: Model, seen: dict, number: int) -> None:
    """Each part of the rows (part, id, text, y) goes on from the model; then the model is their average, weighted by rows."""
    shipped = learn.sparkSession.sparkContext.broadcast((model, seen))

    def fitted(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        own, sums = pickle.loads(pickle.dumps(shipped.value))
        rows, which, first = _numbered([t or "" for t in group["text"].to_pylist()])
        y = np.array(group["y"].to_pylist(), np.float64)
        moved = _descend(own, sums, rows, which, first, y, np.random.default_rng([SEED, number, group["part"][0].as_py()]))
        flat = _flat(own, sums)
        flat = np.concatenate([flat, np.zeros(-len(flat) % DIMS)]).reshape(-1, DIMS)
        values = np.concatenate([own.table[moved].astype(np.float64), flat]) * len(y)
        squares = np.concatenate([sums["table"][moved].astype(np.float64), np.zeros(len(flat))]) * len(y)
        place = np.concatenate([moved, BUCKETS + np.arange(len(flat))])
        out = pa.table({"place": pa.array(place), **{f"v{k}": pa.array(values[:, k]) for k in range(DIMS)}, "s": pa.array(squares), "n": pa.array(np.full(len(place), len(y)))})
        give_back()
        return out

    columns = [f"v{k}" for k in range(DIMS)] + ["s"]
    kinds = "place bigint, " + ", ".join(f"{c} double" for c in columns) + ", n bigint"
    steps = materialise(learn.select("part", "id", "text", "y").groupBy("part").applyInArrow(fitted, kinds), "toxicity-steps")
    # sums in whole steps of 2**-20, so that their order doesn't matter
    total = lambda c: F.sum(F.round(F.col(c) * 1048576.0).cast("bigint")) / 1048576.0
    mean = steps.groupBy("place").agg(*[(total(c) / F.sum("n")).alias(c) for c in columns]).toArrow().sort_by("place")
    place, values = mean["place"].to_numpy(), np.stack([mean[f"v{k}"].to_numpy() for k in range(DIMS)], 1)
    split = int(np.searchsorted(place, BUCKETS))
    model.table[place[:split]] = values[:split]
    seen["table"][place[:split]] = mean["s"].to_numpy()[:split]
    _unflat(model, seen, values[split:].ravel())
    shipped.destroy()


def _thresholds(held: DataFrame, model: Model) -> dict[str | None, float]:
    """For each language, and for all (``None``), the threshold with the best F1 on rows (text, lang, y) not learned from."""
    cut = F.round(F.col("toxicity") * STEPS).cast("int")
    counts = score(held.select("lang", "text", "y"), model).groupBy("lang", cut.alias("cut")).agg(F.sum("y").alias("hit"), F.count("*").alias("n"))
    counts = materialise(counts, "toxicity-scores")
    every = counts.groupBy("cut").agg(F.sum("hit").alias("hit"), F.sum("n").alias("n")).select(F.lit(True).alias("every"), F.lit("").alias("lang"), "cut", "hit", "n")
    counts = every.unionByName(counts.where(F.length("lang") > 0).select(F.lit(False).alias("every"), "lang", "cut", "hit", "n"))
    down = Window.partitionBy("every", "lang").orderBy(F.desc("cut"))
    whole = Window.partitionBy("every", "lang")
    f1 = 2 * F.sum("hit").over(down) / (F.sum("n").over(down) + F.sum("hit").over(whole))
    found = counts.withColumns({"f1": f1, "below": F.coalesce(F.lead("cut").over(down), F.lit(0)), "hits": F.sum("hit").over(whole), "rows": F.sum("n").over(whole)})
    found = found.where((F.col("hits") > 0) & (F.col("hits") < F.col("rows")) & (F.col("every") | (F.col("hits") >= 5)))
    best = found.groupBy("every", "lang").agg(F.max(F.struct("f1", "cut", "below")).alias("b"))
    out: dict[str | None, float] = {None: 0.5}
    for r in best.orderBy("every", "lang").collect():
        out[None if r["every"] else r["lang"]] = float(np.clip((r["b"]["cut"] + r["b"]["below"]) / 2 / STEPS, 0.2, 0.8))
    return out


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit to all labelled rows whose id fulfils ``usable``."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        known = known.where(usable)
    known = materialise(known.groupBy(F.col(id_col).alias("id")).agg((F.max("toxic") > 0).cast("int").alias("y")), "toxicity-labels")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), (F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")).alias("lang"))
    labelled = rows.join(F.broadcast(known) if known.count() <= FILTER_IDS else known, "id").groupBy("id").agg(F.min(F.struct("text", "lang")).alias("t"), F.first("y").alias("y"))
    held = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(5)) == 0
    labelled = materialise(labelled.select("id", "t.text", "t.lang", "y", held.alias("held")), "toxicity-rows")
    sizes = {(r["held"], r["y"]): r["c"] for r in labelled.groupBy("held", "y").agg(F.count("*").alias("c")).collect()}
    total = sum(sizes.values())
    share = sum(c for (_, y), c in sizes.items() if y) / total if total else 0.0
    if not 0 < share < 1:
        return start(share)
    apart = total >= LEAST_HELD
    learn = labelled.where(~F.col("held")) if apart else labelled
    n = np.array([sum(c for (h, y), c in sizes.items() if y == k and not (h and apart)) for k in (0, 1)], np.float64)
    model = start(share, _frequencies(learn, n))
    seen = _unseen(model)
    learn = learn.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(max(1, round(n.sum() / PART_ROWS)))))
    for number in range(ROUNDS if n.any() else 0):
        _round(learn, model, seen, number)
    if apart:
        model.thresholds = _thresholds(labelled.where("held"), model)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``toxicity``, 0 to 1."""
    kept = [c for c in docs.columns if c.lower() != "toxicity"]
    at = kept.index(text_col)
    plain = docs.select(*[F.col(f"`{c}`") for c in kept])
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shipped.value.score(*utf8(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*kept, "toxicity"])

    return plain.mapInArrow(tidy(scan), plus(plain.schema, toxicity="double"))


def threshold_of(model: Model, lang: Column) -> Column:
    """The threshold that holds for a row's language."""
    out = F.lit(model.thresholds[None])
    for name, value in model.thresholds.items():
        if name is not None:
            out = F.when(lang == name, F.lit(value)).otherwise(out)
    return out


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` below their language's threshold, with all their columns, one named ``toxicity`` too."""
    aside = fresh(docs, "kept")
    own = next((c for c in docs.columns if c.lower() == "toxicity"), None)
    scored = score(docs.withColumnRenamed(own, aside) if own else docs, model, text_col)
    kept = scored.where(F.col("toxicity") < threshold_of(model, F.col(lang_col)))
    return kept.select(*[F.col(aside).alias(c) if c == own else F.col(f"`{c}`") for c in docs.columns])
