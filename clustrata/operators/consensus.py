"""Consensus over resamples, its diagnostics and the choice of k."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import blocks
from .resample import draw_size


#: Draws in one word of bits, bits of a label, and samples of a block where pairs aren't handed on.
WORD, PLANES, BLOCK = 64, 8, 4096


def packed_labels(labels: DataFrame, by: Sequence[str], planes: int = PLANES) -> DataFrame:
    """(by.., sample, word, mask, p0..): in which of 64 draws a sample was, and the bits of its labels there, as numbers.

    Every sample has a row for the first word, whether drawn or not; one that no draw holds is named by a row without a draw. Labels are below 2 to the power of ``planes``.
    """
    label = F.when(F.col("label").between(0, 2**planes - 1), F.col("label")).otherwise(F.raise_error(F.lit(f"a label is negative or beyond {2**planes - 1}")).cast("int"))
    bit = F.expr(f"shiftleft(1L, cast(b % {WORD} as int))")
    own = F.struct(F.floor(F.col("b") / WORD).cast("int").alias("word"), bit.alias("bit"), label.alias("label"))
    none = F.struct(F.lit(0).alias("word"), F.lit(0).cast("bigint").alias("bit"), F.lit(0).alias("label"))
    rows = labels.select(*by, "sample", F.inline(F.when(F.col("b").isNull(), F.array(none)).otherwise(F.array(own, none))))
    plane = lambda p: F.bit_or(F.when(F.col("label").bitwiseAND(1 << p) > 0, F.col("bit")).otherwise(F.lit(0).cast("bigint"))).alias(f"p{p}")
    return rows.groupBy(*by, "sample", "word").agg(F.bit_or("bit").alias("mask"), *[plane(p) for p in range(planes)])


class Drawn:
    """Labels of all draws, packed by blocks of samples: what pairs, their distribution and sums over clusters are made from.

    ``draws``: numbers of draws are below it (else the highest is looked up); ``most``: no label is
    above; ``samples``: about how many there are (else they are counted), which sets the number of
    blocks only. A task takes two blocks; pairs are counted by bits, strip by strip.
    """

    def __init__(self, labels: DataFrame, keys: Sequence[str] = (), draws: int | None = None, most: int = 2**PLANES - 1, samples: int | None = None):
        self.by, self.planes = [*keys, "k"], max(1, min(PLANES, int(most).bit_length()))
        if samples is None:
            samples = labels.select("sample").distinct().count()
        if draws is None:
            draws = 1 + (labels.agg(F.max("b")).first()[0] or 0)
        self.draws, self.samples = draws, samples
        self.kinds = dict(labels.dtypes)
        self.rows = packed_labels(labels, self.by, self.planes)

    def _blocks(self, rows: DataFrame, block: int, extra: Sequence[str] = (), by_place: bool = False) -> tuple[DataFrame, int]:
        bits = F.struct("word", F.array("mask", *[f"p{p}" for p in range(self.planes)]).alias("bits"))
        whole = rows.groupBy(*self.by, "sample", *extra).agg(F.array_sort(F.collect_list(bits)).alias("w"))
        parts = blocks.number_of_blocks(self.samples, block)
        part = F.least(F.floor(F.col("sample").cast("bigint") * parts / max(1, self.samples)), F.lit(parts - 1)).cast("int") if by_place else None
        return blocks.packed_blocks(whole, self.by, [F.col("w.word").alias("word"), F.flatten("w.bits").alias("bits"), *extra], parts, part), parts

    def _typed(self, *columns: str) -> str:
        return ", ".join([*[f"{c} {self.kinds[c]}" for c in self.by], *columns])

    def _head(self) -> Callable[[tuple, int], list[pa.Array]]:
        """What makes the key columns of n rows; it holds nothing of the session."""
        types = [{"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}.get(self.kinds[c]) for c in self.by]
        return lambda key, n: [pa.array([v] * n, t) for v, t in zip(key, types, strict=True)]

    def pairs(self) -> DataFrame:
        """(keys.., k, i, j, m, n_co, consensus) for i < j."""
        packed, parts = self._blocks(self.rows, blocks.BLOCK)
        name, words, planes, head = self.kinds["sample"], -(-self.draws // WORD), self.planes, self._head()
        names = [*self.by, "i", "j", "m", "n_co", "consensus"]

        def kernel(key: tuple, left: pa.StructArray, right: pa.StructArray, same: bool) -> Iterator[pa.RecordBatch]:
            x, y = (_words(b, words, planes) for b in (left, right))
            for rows, kept, i, j in blocks.pairs_of(left.field("sample"), right.field("sample"), same):
                m, n = (c.ravel()[kept].astype(np.int64) for c in _together(x, y, rows))
                yield pa.RecordBatch.from_arrays([*head(key, len(m)), i, j, pa.array(m), pa.array(n), pa.array(m / np.maximum(n, 1))], names=names)

        return blocks.met(packed, self.by, parts, kernel, self._typed(f"i {name}", f"j {name}", "m bigint", "n_co bigint", "consensus double"))

    def cells(self) -> DataFrame:
        """(keys.., k, row, col, consensus): both cells of each pair, where samples are places from 0 to ``samples``; cells stand row by row within a block.

        A block is a run of places, so a row's number stays and its columns ascend: written, they take little beside the consensus.
        """
        packed, parts = self._blocks(self.rows, blocks.BLOCK, by_place=True)
        name, words, planes, head = self.kinds["sample"], -(-self.draws // WORD), self.planes, self._head()
        names = [*self.by, "row", "col", "consensus"]

        def kernel(key: tuple, left: pa.StructArray, right: pa.StructArray, same: bool) -> Iterator[pa.RecordBatch]:
            x, y = (_words(b, words, planes) for b in (left, right))
            a, b = (s.field("sample").to_numpy() for s in (left, right))
            for lo, hi in blocks.strips(len(a), len(b)):
                m, n = _together(x, y, slice(lo, hi))
                share = m / np.maximum(n, 1)
                for rows, columns, value in [(a[lo:hi], b, share)] + ([] if same else [(b, a[lo:hi], share.T)]):
                    row, column = np.repeat(rows, len(columns)), np.tile(columns, len(rows))
                    out = pa.RecordBatch.from_arrays([*head(key, len(row)), pa.array(row), pa.array(column), pa.array(value.ravel())], names=names)
                    yield out.filter(pa.array(row != column)) if same else out

        return blocks.met(packed, self.by, parts, kernel, self._typed(f"row {name}", f"col {name}", "consensus double"))

    def pairs_from(self, asked: DataFrame) -> DataFrame:
        """As ``pairs``, for the few i of ``asked`` (k, sample) only: these meet every block, and no other pair is made."""
        packed, _ = self._blocks(self.rows, blocks.BLOCK)
        few, _ = self._blocks(self.rows.join(F.broadcast(asked.select("k", "sample").distinct()), ["k", "sample"], "left_semi"), self.samples + 1)
        name, words, planes, head = self.kinds["sample"], -(-self.draws // WORD), self.planes, self._head()
        names, by = [*self.by, "i", "j", "m", "n_co", "consensus"], self.by

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    key = tuple(batch.column(c)[r].as_py() for c in by)
                    left, right = (batch.column(c).slice(r, 1).flatten() for c in ("few", "rows"))
                    x, y = (_words(b, words, planes) for b in (left, right))
                    for rows, kept, i, j in blocks.pairs_of(left.field("sample"), right.field("sample"), False):
                        m, n = (c.ravel()[kept].astype(np.int64) for c in _together(x, y, rows))
                        out = pa.RecordBatch.from_arrays([*head(key, len(m)), i, j, pa.array(m), pa.array(n), pa.array(m / np.maximum(n, 1))], names=names)
                        own = left.field("sample").take(pa.array(np.repeat(np.arange(rows.start, rows.stop), len(right))))
                        yield out.filter(pc.and_(pc.equal(i, own), pc.not_equal(i, j)))

        met = packed.join(few.select(*by, F.col("rows").alias("few")), by).select(*by, "few", "rows")
        return met.mapInArrow(run, self._typed(f"i {name}", f"j {name}", "m bigint", "n_co bigint", "consensus double"))

    def squares(self, run: Callable[[int, np.ndarray, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
        """What ``run(k, names, square matrix of one less consensus)`` makes of each k in one task, which counts the pairs from its labels: none is moved."""
        packed, _ = self._blocks(self.rows, self.samples + 1)
        words, planes = -(-self.draws // WORD), self.planes

        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for r in range(batch.num_rows):
                    block = batch.column("rows").slice(r, 1).flatten()
                    x, d = _words(block, words, planes), np.empty((len(block), len(block)))
                    for lo, hi in blocks.strips(len(block), len(block)):
                        m, n = _together(x, x, slice(lo, hi))
                        d[lo:hi] = np.maximum(1 - m / np.maximum(n, 1), 0)
                    np.fill_diagonal(d, 0)
                    out = run(batch.column("k")[r].as_py(), np.array(block.field("sample").to_pylist()), d)
                    yield from pa.Table.from_pandas(out, schema=kind, preserve_index=False).to_batches(1024)

        kind = to_arrow_schema(StructType.fromDDL(schema))
        return packed.select("k", "rows").mapInArrow(made, schema)

    def distribution(self) -> DataFrame:
        """(keys.., k, m, n_co, consensus, c): how many pairs have each two counts; as long as the square of the draws, whatever the pairs."""
        packed, parts = self._blocks(self.rows, BLOCK)
        words, planes, wide, head = -(-self.draws // WORD), self.planes, self.draws + 1, self._head()
        names = [*self.by, "m", "n_co", "c"]

        def kernel(key: tuple, left: pa.StructArray, right: pa.StructArray, same: bool) -> Iterator[pa.RecordBatch]:
            x, y = (_words(b, words, planes) for b in (left, right))
            total = np.zeros(wide * wide, np.int64)
            for lo, hi in blocks.strips(len(left), len(right)):
                m, n = _together(x, y, slice(lo, hi))
                code = n.astype(np.intp) * wide + m
                total += np.bincount(code[np.arange(len(right)) > np.arange(lo, hi)[:, None]] if same else code.ravel(), minlength=wide * wide)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([*head(key, len(at)), pa.array(at % wide), pa.array(at // wide), pa.array(total[at])], names=names)

        counted = blocks.met(packed, self.by, parts, kernel, self._typed("m bigint", "n_co bigint", "c bigint")).groupBy(*self.by, "m", "n_co").agg(F.sum("c").alias("c"))
        return counted.withColumn("consensus", F.when(F.col("n_co") > 0, F.col("m") / F.col("n_co")).otherwise(0.0))

    def cluster_sums(self, partition: DataFrame) -> DataFrame:
        """(keys.., k, sample, cluster, theirs, s, n): the sum of a sample's consensus with the n others of each cluster.

        partition: (k, sample, cluster int). A task hands on a row for each of its samples and clusters.
        """
        own = self.rows.join(partition.select("k", "sample", F.col("cluster").cast("int").alias("cluster")), ["k", "sample"])
        packed, parts = self._blocks(own, BLOCK, ["cluster"])
        name, words, planes, head = self.kinds["sample"], -(-self.draws // WORD), self.planes, self._head()
        names = [*self.by, "sample", "cluster", "theirs", "s", "n"]

        def kernel(key: tuple, left: pa.StructArray, right: pa.StructArray, same: bool) -> Iterator[pa.RecordBatch]:
            x, y = (_words(b, words, planes) for b in (left, right))
            mine, theirs = left.field("cluster").to_numpy(), right.field("cluster").to_numpy()
            a, b = np.unique(mine), np.unique(theirs)
            at, to = (mine[:, None] == a).astype(float), (theirs[:, None] == b).astype(float)
            rows, columns = np.zeros((len(left), len(b))), np.zeros((len(right), len(a)))
            for lo, hi in blocks.strips(len(left), len(right)):
                m, n = _together(x, y, slice(lo, hi))
                share = m / np.maximum(n, 1)
                if same:
                    share[np.arange(hi - lo), np.arange(lo, hi)] = 0
                else:
                    columns += share.T @ at[lo:hi]
                rows[lo:hi] = share @ to
            sides = [(left, mine, b, rows, to.sum(0) - (to if same else 0))]
            if not same:
                sides.append((right, theirs, a, columns, at.sum(0) + np.zeros_like(columns)))
            for side, cluster, others, sums, sizes in sides:
                size = np.broadcast_to(sizes, sums.shape).ravel().astype(np.int64)
                some = np.flatnonzero(size)
                who = side.field("sample").take(pa.array(some // len(others)))
                yield pa.RecordBatch.from_arrays([*head(key, len(some)), who, pa.array(cluster[some // len(others)]), pa.array(others[some % len(others)]), pa.array(sums.ravel()[some]), pa.array(size[some])], names=names)

        made = blocks.met(packed, self.by, parts, kernel, self._typed(f"sample {name}", "cluster int", "theirs int", "s double", "n bigint"))
        return made.groupBy(*self.by, "sample", "cluster", "theirs").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def _words(block: pa.StructArray, words: int, planes: int) -> np.ndarray:
    """(words, 1 + planes, samples) of a block, as narrow as its bits allow; words that a sample doesn't have are 0."""
    found = block.field("word")
    sizes = np.diff(found.offsets.to_numpy())
    out = np.zeros((words, 1 + planes, len(block)), np.uint64)
    bits = block.field("bits").flatten().to_numpy().view(np.uint64).reshape(-1, 1 + planes)
    out[found.flatten().to_numpy(), :, np.repeat(np.arange(len(block)), sizes)] = bits
    return out.astype(np.uint32) if words == 1 and out.max(initial=0) < 1 << 32 else out


def _together(x: np.ndarray, y: np.ndarray, rows: slice) -> tuple[np.ndarray, np.ndarray]:
    """(m, n_co) of rows of one block and all of another, by bits."""
    m = n = None
    for one, two in zip(x, y, strict=True):
        one = one.astype(two.dtype, copy=False)[:, rows, None]
        same = one[0] & two[0]
        drawn = np.bitwise_count(same)
        for p in range(1, len(two)):
            if one[p].any() or two[p].any():
                same &= ~(one[p] ^ two[p])
        put = np.bitwise_count(same)
        m, n = (put, drawn) if m is None else (m.astype(np.int32) + put, n.astype(np.int32) + drawn)
    return m, n


def consensus_pairs(labels: DataFrame, keys: Sequence[str] = (), draws: int | None = None, most: int = 2**PLANES - 1, samples: int | None = None) -> DataFrame:
    """(keys.., k, i, j, m, n_co, consensus) for i < j, from (keys.., b, k, sample, label).

    n_co: draws that hold both; m: draws that also put them together; pairs never drawn
    together have consensus 0. See ``Drawn``, from which diagnostics are made without the pairs.
    """
    return Drawn(labels, keys, draws, most, samples).pairs()


def _many(pairs: DataFrame) -> Column:
    """How many pairs rows stand for: ``c`` of a distribution, else one."""
    return F.col("c") if "c" in pairs.columns else F.lit(1).cast("bigint")


def distance(pairs: DataFrame) -> DataFrame:
    """The pairs with ``distance``: one less consensus, within 0 and 1."""
    return pairs.withColumn("distance", F.greatest(F.least(1 - F.col("consensus"), F.lit(1.0)), F.lit(0.0)))


def consensus_cdf(pairs: DataFrame, n_points: int = 100) -> DataFrame:
    """(k, x, cdf): the share of pairs up to each grid point.

    Pairs are first counted by the grid step they fall under, so the running sum goes over
    ``n_points`` rows for each k, whatever the number of pairs.
    """
    spark = pairs.sparkSession
    last = n_points - 1
    step = F.ceil(F.round(F.col("consensus") * last, 9)).cast("int")
    counted = pairs.groupBy("k", step.alias("g")).agg(F.sum(_many(pairs)).alias("c"))
    grid = pairs.select("k").distinct().crossJoin(spark.range(n_points).select(F.col("id").cast("int").alias("g")))
    by = Window.partitionBy("k").orderBy("g")
    full = grid.join(counted, ["k", "g"], "left").withColumn("c", F.coalesce("c", F.lit(0)))
    return full.select("k", (F.col("g") / last).alias("x"), (F.sum("c").over(by) / F.sum("c").over(Window.partitionBy("k"))).alias("cdf"))


def cdf_area(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., k, auc): the area under the empirical distribution, summed over its distinct values."""
    group = [*keys, "k"]
    counted = pairs.groupBy(*group, "consensus").agg(F.sum(_many(pairs)).alias("c"))
    by = Window.partitionBy(*group).orderBy("consensus")
    step = F.col("consensus") - F.lag("consensus").over(by)
    part = counted.withColumn("a", step * F.sum("c").over(by) / F.sum("c").over(Window.partitionBy(*group)))
    return part.groupBy(*group).agg(F.coalesce(F.sum("a"), F.lit(0.0)).alias("auc"))


def delta_k(areas: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., k, auc, delta): the area for the first k, then its relative gain; null after a non-positive area."""
    before = F.lag("auc").over(Window.partitionBy(*keys).orderBy("k"))
    gain = F.when(before > 0, (F.col("auc") - before) / F.when(before > 0, before))
    return areas.withColumn("delta", F.when(before.isNull(), F.col("auc")).otherwise(gain))


def pac(pairs: DataFrame, low: float = 0.1, high: float = 0.9, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., k, pac): the share of ambiguous pairs, strictly between the bounds."""
    between = (F.col("consensus") > low) & (F.col("consensus") < high)
    return pairs.groupBy(*keys, "k").agg((F.sum(F.when(between, _many(pairs)).otherwise(0)) / F.sum(_many(pairs))).alias("pac"))


def ambiguity(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., k, pac, auc, delta)."""
    return pac(pairs, keys=keys).join(delta_k(cdf_area(pairs, keys), keys), [*keys, "k"])


def cluster_sums(pairs: DataFrame, partition: DataFrame) -> DataFrame:
    """As ``Drawn.cluster_sums``, from pairs that are made already."""
    one = pairs.select("k", F.col("i").alias("sample"), F.col("j").alias("other"), "consensus")
    both = one.unionByName(pairs.select("k", F.col("j").alias("sample"), F.col("i").alias("other"), "consensus"))
    own = partition.select("k", "sample", "cluster")
    met = both.join(own, ["k", "sample"]).join(own.select("k", F.col("sample").alias("other"), F.col("cluster").alias("theirs")), ["k", "other"])
    return met.groupBy("k", "sample", "cluster", "theirs").agg(F.sum("consensus").alias("s"), F.count("*").alias("n"))


def _sums(source: DataFrame | Drawn, partition: DataFrame) -> DataFrame:
    """The sums of pairs, of packed draws, or such sums themselves."""
    if isinstance(source, Drawn):
        return source.cluster_sums(partition)
    return source if "theirs" in source.columns else cluster_sums(source, partition)


def item_consensus(pairs: DataFrame | Drawn, partition: DataFrame) -> DataFrame:
    """(k, sample, cluster, item_consensus): mean consensus with the own cluster's others; null alone."""
    mean = _sums(pairs, partition).where(F.col("cluster") == F.col("theirs")).select("k", "sample", (F.col("s") / F.col("n")).alias("item_consensus"))
    return partition.select("k", "sample", "cluster").join(mean, ["k", "sample"], "left")


def cluster_consensus(pairs: DataFrame | Drawn, partition: DataFrame) -> DataFrame:
    """(k, cluster, n, cluster_consensus): mean over the pairs within; null for one member."""
    within = _sums(pairs, partition).where(F.col("cluster") == F.col("theirs"))
    mean = within.groupBy("k", "cluster").agg((F.sum("s") / F.sum("n")).alias("cluster_consensus"))
    return partition.groupBy("k", "cluster").agg(F.count("*").alias("n")).join(mean, ["k", "cluster"], "left")


def silhouette(pairs: DataFrame | Drawn, partition: DataFrame) -> DataFrame:
    """(k, sample, cluster, silhouette) on the consensus distance: 0 alone, null with one or only single clusters."""
    to = _sums(pairs, partition).withColumn("d", F.greatest(F.least(1 - F.col("s") / F.col("n"), F.lit(1.0)), F.lit(0.0)))
    ab = to.groupBy("k", "sample", "cluster").agg(F.min(F.when(F.col("theirs") == F.col("cluster"), F.col("d"))).alias("a"), F.min(F.when(F.col("theirs") != F.col("cluster"), F.col("d"))).alias("b"))
    sizes = partition.groupBy("k").agg(F.count_distinct("cluster").alias("n_clusters"), F.count("*").alias("n"))
    full = partition.select("k", "sample", "cluster").join(ab, ["k", "sample", "cluster"], "left").join(F.broadcast(sizes), "k")
    top = F.greatest("a", "b")
    value = F.when((F.col("n_clusters") < 2) | (F.col("n_clusters") == F.col("n")), F.lit(None)).when(F.col("a").isNull(), 0.0).when(top > 0, (F.col("b") - F.col("a")) / F.when(top > 0, top)).otherwise(0.0)
    return full.select("k", "sample", "cluster", value.alias("silhouette"))


def k_summary(pairs: DataFrame | Drawn, partition: DataFrame, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """(k, pac, auc, delta, silhouette, min_cluster_size, mean_cluster_consensus)."""
    seen = pairs.distribution() if isinstance(pairs, Drawn) else pairs
    sums = _sums(pairs, partition)
    sil = silhouette(sums, partition).groupBy("k").agg(F.avg("silhouette").alias("silhouette"))
    clusters = cluster_consensus(sums, partition).groupBy("k").agg(F.min("n").alias("min_cluster_size"), F.avg("cluster_consensus").alias("mean_cluster_consensus"))
    out = pac(seen, low, high).join(delta_k(cdf_area(seen)), "k").join(sil, "k").join(clusters, "k")
    return out.select("k", "pac", "auc", "delta", "silhouette", "min_cluster_size", "mean_cluster_consensus")


def by_pac(summary: DataFrame) -> DataFrame:
    """A summary's rows with ``place``, 1 for the k of least PAC; a row for each k is all that one task orders."""
    return summary.withColumn("place", F.row_number().over(Window.orderBy("pac", "k")))


def suggest_k(summary: DataFrame, method: str = "both", min_cluster_size: int = 10, pac_tol: float = 0.01, min_delta: float = 0.05) -> DataFrame:
    """One row, k: the suggestion of a summary with a row for each k.

    ``pac``: least PAC. ``deltak``: the greatest k that still gains ``min_delta``, else the one
    that gains most. ``both``: of the k whose least cluster is large enough (all, if none is)
    and whose PAC is within ``pac_tol`` of the best, the greatest that still gains
    ``min_delta``, else the one with least PAC.
    """
    gains = F.max(F.when(F.col("delta") >= min_delta, F.col("k")))
    least_pac = F.min_by("k", F.struct("pac", "k"))
    if method == "pac":
        return summary.agg(least_pac.alias("k"))
    if method == "deltak":
        most = F.min_by("k", F.struct((-F.coalesce("delta", F.lit(float("-inf")))).alias("d"), "k"))
        return summary.agg(F.coalesce(gains, most).alias("k"))
    if method != "both":
        raise ValueError(f"unknown criterion {method!r}")
    whole = Window.partitionBy()
    large = F.col("min_cluster_size") >= min_cluster_size
    usable = summary.withColumn("_any", F.max(large).over(whole)).where(~F.col("_any") | large)
    near = usable.withColumn("_best", F.min("pac").over(whole))
    close = F.col("pac") <= F.col("_best") + pac_tol
    return near.agg(F.coalesce(F.max(F.when(close & (F.col("delta") >= min_delta), F.col("k"))), least_pac).alias("k"))


def drawn_labels(x: np.ndarray, b: int, seed: list[int], props: tuple[float, float], modes: tuple[str, str], label: Callable[[np.ndarray, np.random.Generator], dict[int, np.ndarray]]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """(row numbers, labels for each k) of one draw of rows and columns of ``x``."""
    rng = np.random.default_rng([*seed, b])
    rows = np.unique(rng.choice(len(x), draw_size(len(x), props[0]), replace=modes[0] == "bootstrap"))
    genes = rng.choice(x.shape[1], draw_size(x.shape[1], props[1]), replace=modes[1] == "bootstrap")
    return rows, label(x[np.ix_(rows, genes)], rng)


def draw_counts(x: np.ndarray, k_values: list[int], draws: Iterable[int], seed: list[int], props: tuple[float, float], modes: tuple[str, str], label: Callable[[np.ndarray, np.random.Generator], dict[int, np.ndarray]]) -> Iterator[pd.DataFrame]:
    """(k, i, j, m, n_co) for each k, added up over draws of rows and columns of ``x``; i and j are row numbers."""
    n, index = len(x), np.triu_indices(len(x), 1)
    together, drawn = {k: np.zeros((n, n), np.int64) for k in k_values}, np.zeros((n, n), np.int64)
    for b in draws:
        rows, found = drawn_labels(x, int(b), seed, props, modes, label)
        drawn[np.ix_(rows, rows)] += 1
        for k, l in found.items():
            hot = (l[:, None] == np.unique(l)).astype(np.int64)
            together[k][np.ix_(rows, rows)] += hot @ hot.T
    for k in k_values:
        yield pd.DataFrame({"k": k, "i": index[0], "j": index[1], "m": together[k][index], "n_co": drawn[index]})


def consensus_clustering(df: DataFrame, k_values: list[int], n_resamples: int = 1000, prop_samples: float = 0.8, prop_genes: float = 0.8, sample_mode: str = "subsample", gene_mode: str = "subsample", base: str = "hierarchical", metric: str = "pearson", linkage: str = "average", seed: int = 0, partitions: int = 32) -> DataFrame:
    """(k, i, j, m, n_co, consensus) by resampling and clustering on every task's share of the draws.

    The matrix is broadcast once (samples x genes of a cohort, checked by ``MOST_CELLS``). A task
    hands on the labels of its draws; pairs are counted from them in blocks (``Drawn``), so no
    task holds a matrix of all pairs of samples beyond what its clustering needs.
    """
    from .kernels.cluster import draw_labels
    from .kernels.linear import dense

    names, _, x = dense(df)
    spark = df.sparkSession
    shipped = spark.sparkContext.broadcast((names, x))
    options = {"base": base, "metric": metric, "linkage": linkage}

    def run(batches):
        for pdf in batches:
            for b in pdf["id"]:
                names, x = shipped.value
                if b == 0:  # all samples are named, also those that no draw holds
                    yield from (pd.DataFrame({"b": pd.array([None] * len(x), "Int32"), "k": k, "sample": names, "label": 0}) for k in k_values)
                rows, found = drawn_labels(x, int(b), [seed], (prop_samples, prop_genes), (sample_mode, gene_mode), lambda part, rng: draw_labels(part, k_values, rng, **options))
                yield from (pd.DataFrame({"b": pd.array([b] * len(rows), "Int32"), "k": k, "sample": names[rows], "label": l}) for k, l in found.items())

    kind = df.schema["sample"].dataType.simpleString()
    labels = spark.range(0, n_resamples, 1, min(partitions, n_resamples)).mapInPandas(run, f"b int, k int, sample {kind}, label int")
    return Drawn(labels, draws=n_resamples, most=max(k_values), samples=len(names)).pairs()


def each_k(source: DataFrame | Drawn, run: Callable[[int, np.ndarray, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
    """As ``Drawn.squares``, from packed draws or from pairs that are made already."""
    from .kernels.linear import square

    if isinstance(source, Drawn):
        return source.squares(run, schema)
    return source.groupBy("k").applyInPandas(lambda pdf: run(int(pdf["k"].iloc[0]), *square(pdf["i"], pdf["j"], 1 - pdf["consensus"].to_numpy())), schema)


def name_kind(source: DataFrame | Drawn) -> str:
    return source.kinds["sample"] if isinstance(source, Drawn) else source.schema["i"].dataType.simpleString()


def final_partition(pairs: DataFrame | Drawn, linkage: str = "average") -> DataFrame:
    """(k, sample, cluster, leaf_pos): the tree of each k's consensus distance, cut at k."""
    from .kernels.cluster import cut_tree, leaf_order, linkage_tree

    def run(k: int, names: np.ndarray, d: np.ndarray) -> pd.DataFrame:
        tree = linkage_tree(d, linkage)
        place = np.empty(len(names), int)
        place[leaf_order(tree, len(names))] = np.arange(len(names))
        return pd.DataFrame({"k": k, "sample": names, "cluster": cut_tree(tree, len(names), k), "leaf_pos": place})

    return each_k(pairs, run, f"k int, sample {name_kind(pairs)}, cluster int, leaf_pos int")


def tree_links(pairs: DataFrame, linkage: str = "average") -> DataFrame:
    """(k, branch_id, size, height, left, right, left_height, right_height, place): the merges of each k's consensus tree as they are drawn.

    Leaves stand at 5, 15, 25 and so on in leaf order and a merge in the middle of its sides; ids are those of
    branches, ``place`` is the order of drawing: from the root, the left side before the right.
    """
    from .kernels.cluster import leaf_order, linkage_tree
    from .kernels.linear import square

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names, d = square(pdf["i"], pdf["j"], 1 - pdf["consensus"].to_numpy())
        n, tree = len(names), linkage_tree(d, linkage)
        x, height, size = np.zeros(n + len(tree)), np.zeros(n + len(tree)), np.ones(n + len(tree), int)
        x[leaf_order(tree, n)] = 5 + 10 * np.arange(n)
        sides = np.zeros((len(tree), 2), int)
        for step, (a, b, h, m) in enumerate(tree):
            sides[step] = sorted((int(a), int(b)), key=lambda node: x[node])
            x[n + step], height[n + step], size[n + step] = x[sides[step]].mean(), h, m
        turn, todo = {}, [n + len(tree) - 1] if len(tree) else []
        while todo:
            node = todo.pop()
            turn[node] = len(turn)
            todo += [s for s in sides[node - n][::-1] if s >= n]
        rows = [(int(pdf["k"].iloc[0]), n + i, size[n + i], height[n + i], x[a], x[b], height[a], height[b], turn[n + i]) for i, (a, b) in enumerate(sides)]
        return pd.DataFrame(rows, columns=["k", "branch_id", "size", "height", "left", "right", "left_height", "right_height", "place"])

    return pairs.groupBy("k").applyInPandas(run, "k int, branch_id int, size int, height double, left double, right double, left_height double, right_height double, place int")
