"""N-gram Jaccard join with a forest of count-vector R-trees.

Documents become sets of hashed word n-grams; equal sets are one node. Two sets link when
``100 * common >= percent * union``. N-grams are hashed into groups, about ``PER_GROUP`` to a
group; a set's counts by group are a point, and the sum of coordinate-wise minima bounds the
common n-grams of two points, or of a point and a box. (The number of groups is a power of
two, so the point of a larger set folds to that of a smaller one.)

1. Pages. One tree over all points can't prune, as unrelated points lie too close for boxes
   of so many coordinates; and it would be one object. So points are dealt to pages by a rule
   that no link escapes: linked sets of sizes up to m differ in at most T n-grams, so when
   n-grams are dealt to ``P > T`` bands by hash, linked sets agree on at least ``P - T`` whole
   bands. A page is all sets of a size class that agree on a band. (A band that is empty in
   both says nothing; ``P`` leaves room for as many as nearly every set has, and the few sets
   with more of them also enter the pages of their empty bands, where they meet each other.)
2. Leaf pages of up to ``LEAF`` sets: their pairs, each once, are bounded by their points.
3. Larger pages: each of their sets goes to one R-tree, that of the most popular page within
   reach. Trees are packed: sets are halved along the widest coordinate down to leaves, with
   boxes above boxes. Each set is searched for those of other components that the bound
   admits; these are verified there and then against the whole sets, and joined. A group of
   g near copies so costs about g verifications, and no pair leaves the task. Where a home
   has several trees, a further tree of few sets of each component joins most of them.
4. What the trees have left apart: sets that share a larger page but neither tree nor
   component. Of a page that is one part, only the sets go on that some other may link with:
   a group whose counts differ in parity holds an n-gram that one of two sets lacks, so the
   parities, a bit each, bound the difference of the sets. Then trees of one part of the page
   are searched with the sets of another, the best pairs for two components first, more of
   them until none is left untested.
5. Components of the verified links.

Trees and parts of pages have a bounded size; larger ones are cut by hash, so no task holds
a whole group. Links, components and sets stay in tables.

Defined cases: null and word-less texts have an empty set and link with nothing; a text of
fewer than n words is one n-gram; repeated rows and equal sets are in one class; a null id
takes part with its text and is never a class id unless all ids of the class are null;
other columns are ignored by ``jaccard_components`` and handed on by ``drop_near_copies``.
Hashes have 64 bits: two different sets or n-grams agree by accident with probability 2**-64.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ARROW_BYTES, FILTER_IDS, SPACED, Words, fresh, grams, materialise, mix, plus, slices, tidy, utf8
from .components import components

PER_GROUP, LEAST_GROUPS, MOST_GROUPS = 1, 256, 1024
#: Sets of a leaf, boxes of a box, sets of a page or tree that are searched without boxes.
LEAF, FANOUT, SMALL = 8, 8, 48
#: Bounds of a tree: sets, and n-grams of all of them.
TILE, TILE_GRAMS = 2048, 1 << 21
#: Sets that speak for a component where trees of one home are joined.
SPEAKERS = 3
#: Pairs of two components in two parts that are verified first.
FIRST = 16
#: Sets of a part of a page, of which only the points are held.
PART = 2048
#: Pairs found in two parts that are held before the best of each two components are sorted out.
FOUND = 1 << 18
#: Bytes of a page's name that are sent beside the bits that name its shard.
NAME_BYTES = 6
#: Sets of one task that share a page which is then known to be large; bytes of text to a shard of page names.
OFTEN, BYTES_A_SHARD = 16, 1 << 25
U64 = np.uint64


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each document in a buffer."""
    for lo, hi in slices(offsets):
        words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], SPACED)
        runs = grams(words.hash, n)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if b - a >= n:
                g = np.sort(runs[a : b - n + 1])
                keep = np.empty(len(g), bool)
                keep[0] = True
                np.not_equal(g[1:], g[:-1], out=keep[1:])
                yield g[keep]
            elif b > a:
                yield grams(words.hash[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def node_of(g: np.ndarray) -> int:
    """A set's 64-bit name."""
    return int.from_bytes(hashlib.blake2b(g.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_common(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The fewest common n-grams of linked sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


# Pages


@lru_cache(maxsize=None)
def _edges(percent: int) -> list[int]:
    """The least size of each class: a set links only within its class and the two beside it."""
    edges, x = [1], 1
    while x < 1 << 40:
        x = max(x + 1, math.ceil(x * (100 / percent) ** 2))
        edges.append(x)
    return edges


@lru_cache(maxsize=None)
def bands_of(level: int, percent: int) -> tuple[int, int]:
    """(bands, spare ones) for links whose larger set is of this class; (0, 0) if only equal sets link.

    Linked sets agree on ``bands - T`` bands at least, one more than the spare ones. Spare: as
    many empty bands as nearly all sets have, or else as makes those with more the fewest.
    """
    edges = _edges(percent)
    largest, smallest = edges[level + 1] - 1, -(-edges[level] * percent // 100)
    t = 2 * largest * (100 - percent) // (100 + percent)
    if t == 0:
        return 0, 0
    best = (2.0, 0)
    for spare in range(t + 65):
        p = t + 1 + spare
        mean = p * (1 - 1 / p) ** smallest if p > 1 else 0.0
        term = below = math.exp(-mean)
        for k in range(1, spare + 1):
            term *= mean / k
            below += term
        best = min(best, (round(1 - below, 9), spare))
        if 1 - below < 1e-4:
            return p, spare
        if spare > 8 and mean > 4 * spare:
            break
    return t + 1 + best[1], best[1]


def page_names(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(pages, sets): the 64-bit names of the pages of each set, and its place in the list."""
    edges = _edges(percent)
    whose, levels = [], []
    for i, g in enumerate(sets):
        level = int(np.searchsorted(edges, len(g), "right")) - 1
        for k in (level, level + 1):
            if (k == level or len(g) * 100 >= percent * edges[k]) and bands_of(k, percent)[0]:
                whose.append(i)
                levels.append(k)
    if not whose:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    number = np.array([bands_of(k, percent)[0] for k in levels], np.uint64)
    spare = np.array([bands_of(k, percent)[1] for k in levels])
    level, owner = np.array(levels, np.uint64), np.array(whose, np.int64)
    size = np.array([len(sets[i]) for i in whose])
    g = np.concatenate([sets[i] for i in whose])
    turn = np.repeat(np.arange(len(whose)), size)
    band = (g >> U64(32)) * number[turn] >> U64(32)  # sets are sorted, so bands are runs
    begin = np.flatnonzero(np.r_[True, (band[1:] != band[:-1]) | (turn[1:] != turn[:-1])])
    held = mix(np.add.reduceat(mix(g.copy()), begin))
    band, turn = band[begin], turn[begin]
    empty = number.astype(np.int64) - np.bincount(turn, minlength=len(whose))
    odd = np.flatnonzero(empty > spare)
    if len(odd):
        more = []
        for i in odd.tolist():
            gone = np.setdiff1d(np.arange(int(number[i]), dtype=np.uint64), band[turn == i])
            more.append((gone, np.full(len(gone), i)))
        band = np.concatenate([band, *[x for x, _ in more]])
        turn = np.concatenate([turn, *[x for _, x in more]])
        held = np.concatenate([held, np.zeros(len(band) - len(held), np.uint64)])
    name = mix(held + mix(band + (level[turn] << U64(40)) + U64(1)))
    return name, owner[turn]


# Points and trees


def groups_of(n: int) -> int:
    """The number of groups for sets of size n."""
    return max(LEAST_GROUPS, min(MOST_GROUPS, 1 << int(n // PER_GROUP).bit_length()))


def counts_of(g: np.ndarray) -> np.ndarray:
    """A set's counts by group."""
    groups = groups_of(len(g))
    return np.bincount((g >> U64(8)).astype(np.int64) & (groups - 1), minlength=groups).astype(np.int32)


def packed(counts: np.ndarray) -> bytes:
    """The width of a count in bytes, 1 or 4, and the counts, coded by how often each occurs: vectors are sent often."""
    width, kind = (1, np.uint8) if counts.max(initial=0) < 256 else (4, "<u4")
    coder = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_HUFFMAN_ONLY)
    return bytes([width]) + coder.compress(counts.astype(kind).tobytes()) + coder.flush()


def unpacked(vector: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(memoryview(vector)[1:], -15), np.uint8 if vector[0] == 1 else "<u4").astype(np.int32)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """Counts in fewer groups; the last axis is that of the groups."""
    return counts if counts.shape[-1] == groups else counts.reshape(*counts.shape[:-1], -1, groups).sum(-2)


def points_of(counts: list[np.ndarray]) -> np.ndarray:
    """Points of all sets in as many groups as all have."""
    groups = min(len(c) for c in counts)
    points = np.stack([folded(c, groups) for c in counts])
    return points.astype(np.int16) if points.max() < 1 << 15 else points


def parities(vector: bytes) -> bytes:
    """The parity of each count, a bit each."""
    return np.packbits((unpacked(vector) & 1).astype(np.uint8)).tobytes()


def near_others(bits: list[bytes], sizes: np.ndarray, roots: np.ndarray, trees: np.ndarray, percent: int) -> np.ndarray:
    """Which sets the parities let link with a set of another root and tree."""
    width = min(map(len, bits))
    words = np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, width), 0) for x in bits]).view("<u8").T
    out = np.zeros(len(bits), bool)
    for lo in range(0, len(bits), 256):
        own = slice(lo, lo + 256)
        n, m = sizes[own, None], sizes[None]
        ok = (n * percent <= m * 100) & (m * percent <= n * 100) & (roots[own, None] != roots[None]) & (trees[own, None] != trees[None])
        apart = np.zeros(ok.shape, np.int32)
        for word in words:
            apart += np.bitwise_count(word[own, None] ^ word[None])
        out[own] = (ok & (apart <= n + m - 2 * least_common(n, m, percent))).any(1)
    return out


class RTree:
    """A packed R-tree of count vectors: points are halved along the widest coordinate down to leaves; boxes above boxes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.arange(len(sizes))
        self._halve(points, 0, len(sizes))
        self.points, self.sizes = points[self.order], sizes[self.order].astype(np.int64)
        low = high = self.points
        least = most = self.sizes
        #: From the leaves' boxes up: (low corners, high corners, least sizes, most sizes, children of a box).
        self.levels = []
        fan = LEAF
        while len(least) > 1 and (not self.levels or len(least) > FANOUT):
            at = np.arange(0, len(least), fan)
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append((low, high, least, most, fan))
            fan = FANOUT

    def _halve(self, points: np.ndarray, lo: int, hi: int) -> None:
        todo = [(lo, hi)]
        while todo:
            lo, hi = todo.pop()
            if hi - lo <= LEAF:
                continue
            part = self.order[lo:hi]
            own = points[part]
            axis = int((own.max(0) - own.min(0)).argmax())
            half = LEAF * -(-(hi - lo) // (2 * LEAF))
            self.order[lo:hi] = part[np.argpartition(own[:, axis], half - 1)] if half < hi - lo else part
            todo += [(lo, lo + half), (lo + half, hi)]

    def search(self, q: np.ndarray, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, bounds): the points that the bound lets link with a set of these counts."""
        at = np.arange(len(self.levels[-1][2]) if self.levels else len(self.sizes))
        for depth in range(len(self.levels) - 1, -1, -1):
            low, high, least, most, fan = self.levels[depth]
            fits = at[(least[at] * percent <= size * 100) & (size * percent <= most[at] * 100)]
            bound = np.minimum(np.minimum(high[fits], q).sum(1, np.int64), most[fits] - np.maximum(low[fits] - q, 0).sum(1, np.int64))
            fits = fits[bound >= least_common(size, least[fits], percent)]
            below = len(self.levels[depth - 1][2]) if depth else len(self.sizes)
            at = (fits[:, None] * fan + np.arange(fan)).ravel()
            at = at[at < below]
            if not len(at):
                return at, at
        bound = np.minimum(self.points[at], q).sum(1, np.int64)
        n = self.sizes[at]
        ok = (bound >= least_common(size, n, percent)) & (n * percent <= size * 100) & (size * percent <= n * 100)
        return self.order[at[ok]], bound[ok]


def joined(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The least place in the component of each set: an R-tree names candidates, whole sets decide."""
    sizes = np.array([len(g) for g in sets], np.int64)
    points = points_of([counts_of(g) for g in sets])
    root = np.arange(len(sets))
    tree = RTree(points, sizes)
    turn = np.argsort(np.abs(points - np.median(points, axis=0)).sum(1), kind="stable")  # what all resemble comes first
    place = np.empty(len(sets), np.int64)
    place[turn] = np.arange(len(sets))
    for i in turn.tolist():
        if (root == root[0]).all():
            break
        found, bound = tree.search(points[i], int(sizes[i]), percent)
        open_ = (root[found] != root[i]) & (place[found] > place[i])  # the others have searched for this one
        if not open_.any():
            continue
        found, bound = found[open_], bound[open_]
        for j in found[np.argsort(-bound, kind="stable")].tolist():
            if root[j] != root[i] and common(sets[i], sets[j]) >= least_common(int(sizes[i]), int(sizes[j]), percent):
                lo, hi = sorted((root[i], root[j]))
                root[root == hi] = lo
    return root


def candidates(left: tuple, right: tuple, percent: int, most: int) -> list[tuple[int, int, bool]]:
    """Sets of the two parts that the bound lets link, ``most`` for two roots: pairs of places, and whether their roots have more.

    A part is (counts, sizes, roots, trees): pairs of one root, and of one tree, which has seen them, don't count.
    """
    same = left is right
    if len(left[1]) < len(right[1]):
        return [(j, i, more) for i, j, more in candidates(right, left, percent, most)]
    (lc, ls, lr, lt), (rc, rs, rr, rt) = left, right
    if not len(rs):
        return []
    points = points_of([*lc, *rc])
    tree, found = RTree(points[: len(ls)], ls), []
    names, times = np.unique(lr, return_counts=True)
    main = names[times.argmax()]

    def best(parts: list[np.ndarray], number: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``number`` pairs of two roots with the highest bounds, and how many their roots have in parts."""
        i, j, spare = np.concatenate(parts, axis=1)
        a, b = np.minimum(lr[i], rr[j]), np.maximum(lr[i], rr[j])
        order = np.lexsort((-spare, b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        many = np.diff(np.r_[first, len(a)])
        keep = np.arange(len(a)) - np.repeat(first, many) < number
        return np.stack([i, j, spare])[:, order[keep]], np.repeat(many, many)[keep]

    waiting, limit = 0, FOUND
    for k in np.flatnonzero(rr != main if same or len(names) == 1 else np.ones(len(rs), bool)).tolist():
        at, bound = tree.search(points[len(ls) + k], int(rs[k]), percent)
        ok = (lr[at] != rr[k]) & (lt[at] != rt[k])
        if same:  # a part with itself: sets of the main component are found, not searched for
            ok &= (at < k) | (lr[at] == main)
        if ok.any():
            at, bound = at[ok], bound[ok]
            found.append(np.stack([at, np.full(len(at), k), bound * 1_000_000 // least_common(int(rs[k]), ls[at], percent)]).astype(np.int32))
            waiting += len(at)
            if waiting >= limit:  # one more than the most is kept, so that the roots still show that they have more
                found = [best(found, most + 1)[0]]
                waiting = found[0].shape[1]
                limit = max(FOUND, 2 * waiting)
    if not found:
        return []
    (i, j, _), many = best(found, most)
    return list(zip(i.tolist(), j.tolist(), (many > most).tolist(), strict=True))


# Tables


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


def _nodes(docs: DataFrame, n: int) -> DataFrame:
    """(id, size, node, vector) of each row; node and vector are null for an empty set."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, vectors = [], [], []
            for g in gram_sets(*utf8(batch.column(1)), n):
                sizes.append(len(g))
                nodes.append(node_of(g) if len(g) else None)
                vectors.append(packed(counts_of(g)) if len(g) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(vectors, pa.binary())], names=["id", "size", "node", "vector"])

    plain = docs.select("id")
    return docs.select("id", "text").mapInArrow(tidy(scan), plus(plain.schema, size="bigint", node="bigint", vector="binary"))


def _pages(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(page, a, b, size): the pairs (a, b) of leaf pages, where page is null, and each set a of the larger pages.

    Tasks send page names to shards by their leading bits, with the sets of a shard once for
    all names. A shard keeps what two sets share. What a task itself sees in ``OFTEN`` sets is
    large: it goes to any shard, and only two of its sets to the proper one, marked, so a
    page of many sets doesn't gather in one task.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(32, max(2, int(total // BYTES_A_SHARD).bit_length()))
    top, rest = U64(64 - bits), U64(64 - bits - 8 * NAME_BYTES) if bits + 8 * NAME_BYTES < 64 else U64(0)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        sets, nodes, sizes, seen = [], [], [], set()
        waiting, rng = 0, np.random.default_rng(1)

        def take() -> int:
            name, owner = page_names(sets, percent)
            held.append((name, owner + len(nodes) - len(sets)))
            sets.clear()
            return len(name)

        def flush() -> pa.RecordBatch:
            if sets:
                take()
            name, owner = (np.concatenate(x) for x in zip(*held, strict=True))
            node, size = np.array(nodes, np.int64), np.array(sizes, "<u4")
            order = np.lexsort((owner, name))
            name, owner = name[order], owner[order]
            first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]]) if len(name) else np.zeros(0, np.int64)
            many = np.diff(np.r_[first, len(name)])
            often = np.repeat(many >= OFTEN, many)
            place = np.arange(len(name)) - np.repeat(first, many)
            out = []
            for sure, at in ((False, np.flatnonzero(~often | (place < 2))), (True, np.flatnonzero(often))):
                to = rng.integers(0, 1 << bits, len(at)) if sure else (name[at] >> top).astype(np.int64)
                at = at[np.lexsort((owner[at], to))]
                to = np.sort(to)
                shards, begin = np.unique(to, return_index=True)
                for shard, i, j in zip(shards.tolist(), begin.tolist(), [*begin[1:].tolist(), len(to)][: len(shards)], strict=True):
                    part = at[i:j]
                    own, times = np.unique(owner[part], return_counts=True)
                    marks = np.packbits(often[part]).tobytes() if not sure else b""
                    out.append((shard, sure, np.ascontiguousarray((name[part] >> rest).view(np.uint8).reshape(-1, 8).T[:NAME_BYTES]).tobytes() + (name[part] >> top).astype("<u4").tobytes() * sure, marks, node[own].tobytes(), size[own].tobytes(), times.astype("<u4").tobytes()))
            kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            columns = list(zip(*out, strict=True)) or [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["shard", "sure", "name", "marks", "node", "size", "times"])

        for batch in batches:
            for g in gram_sets(*utf8(batch.column(0)), n):
                if not len(g):
                    continue
                node = node_of(g)
                if node in seen:
                    continue
                if len(seen) < 100_000:
                    seen.add(node)
                sets.append(g)
                nodes.append(node)
                sizes.append(len(g))
                waiting += len(g)
                if waiting >= 1 << 17:
                    waiting = 0
                    take()
                    if sum(len(x) for x, _ in held) >= 1 << 20:
                        yield flush()
                        held.clear(), nodes.clear(), sizes.clear()
        if nodes:
            yield flush()

    def answer(group: pa.Table) -> pa.Table:
        sure = np.array(group["sure"].to_pylist(), bool)
        parts = {True: [], False: []}
        for k in range(group.num_rows):
            raw = {c: group[c][k].as_buffer() for c in ("name", "marks", "node", "size", "times")}
            times = np.frombuffer(raw["times"], "<u4")
            planes = np.zeros((8, int(times.sum())), np.uint8)
            planes[:NAME_BYTES] = np.frombuffer(raw["name"], np.uint8, NAME_BYTES * planes.shape[1]).reshape(NAME_BYTES, -1)
            name = np.ascontiguousarray(planes.T).view("<u8").ravel()
            shard = np.frombuffer(raw["name"], "<u4", offset=planes[:NAME_BYTES].size).astype(np.uint64) if sure[k] else U64(group["shard"][k].as_py())
            name = (name & U64((1 << 8 * NAME_BYTES) - 1)) | shard << U64(8 * NAME_BYTES)  # a name is these bits wherever it was sent
            node, size = np.repeat(np.frombuffer(raw["node"], "<i8"), times), np.repeat(np.frombuffer(raw["size"], "<u4"), times)
            mark = np.unpackbits(np.frombuffer(raw["marks"], np.uint8), count=len(name)).astype(bool) if not sure[k] else np.zeros(len(name), bool)
            parts[bool(sure[k])].append((name, node, size, mark))
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, bool))
        large = [x[:3] for x in parts[True]] or [empty[:3]]
        name, node, size, mark = (np.concatenate(x) for x in zip(*(parts[False] or [empty]), strict=True))
        order = np.argsort(name, kind="stable")
        name = name[order]
        twice = np.zeros(len(name), bool)
        twice[1:] = name[1:] == name[:-1]
        twice[:-1] |= twice[1:]
        order, name = order[twice], name[twice]
        node, size, mark = node[order], size[order], mark[order]
        order = np.lexsort((~mark, node, name))
        name, node, size, mark = name[order], node[order], size[order], mark[order]
        new = np.r_[True, (name[1:] != name[:-1]) | (node[1:] != node[:-1])][: len(name)]
        name, node, size, mark = name[new], node[new], size[new], mark[new]
        first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]][: len(name)])
        many = np.diff(np.r_[first, len(name)])
        wide = (np.logical_or.reduceat(mark, first) if len(first) else np.zeros(0, bool)) | (many > LEAF)
        inside = np.repeat(wide, many) & ~mark  # marked ones are among the sure ones already
        large.append((name[inside], node[inside], size[inside]))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for m in range(2, LEAF + 1):  # leaf pages of m sets
            at = first[(many == m) & ~wide][:, None] + np.arange(m)
            i, j = np.triu_indices(m, 1)
            x, y = at[:, i].ravel(), at[:, j].ravel()
            near = (size[x] * np.int64(100) >= size[y] * np.int64(percent)) & (size[y] * np.int64(100) >= size[x] * np.int64(percent))
            a.append(node[x[near]])
            b.append(node[y[near]])
        a, b = np.concatenate(a), np.concatenate(b)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
        name, node, size = (np.concatenate(x) for x in zip(*large, strict=True))
        none = pa.nulls(pairs.shape[1], pa.int64())
        return pa.table(
            {
                "page": pa.concat_arrays([none, _signed(name)]),
                "a": pa.concat_arrays([pa.array(pairs[0]), pa.array(node)]),
                "b": pa.concat_arrays([pa.array(pairs[1]), pa.nulls(len(node), pa.int64())]),
                "size": pa.concat_arrays([pa.nulls(pairs.shape[1], pa.int64()), pa.array(size.astype(np.int64))]),
            }
        )

    asked = docs.select("text").mapInArrow(tidy(ask), "shard int, sure boolean, name binary, marks binary, node binary, size binary, times binary")
    return asked.groupBy("shard").applyInArrow(answer, "page bigint, a bigint, b bigint, size bigint")


def _homes(large: DataFrame) -> DataFrame:
    """(node, size, home, tile, tiles): the tree of each set of the larger pages.

    A page's weight is its number of sets; a set turns to its heaviest page, and then to the
    heaviest that any set of its pages turns to. Trees beyond the bounds are cut by hash.
    """
    score = large.groupBy("page").agg(F.struct(F.count("*").alias("c"), F.col("page").alias("p")).alias("s")).select("page", "s")
    own = large.join(score, "page").groupBy("node").agg(F.max("s").alias("s"))
    reach = large.join(own, "node").groupBy("page").agg(F.max("s").alias("s"))
    homes = large.join(reach, "page").groupBy("node").agg(F.max("s").getField("p").alias("home"), F.max("size").alias("size"))
    homes = materialise(homes, "homes")
    weight = homes.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("size") / TILE_GRAMS)).cast("int").alias("tiles"))
    return homes.join(weight, "home").select("node", "size", "home", F.pmod(F.xxhash64("node"), "tiles").cast("int").alias("tile"), "tiles")


def _sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The wanted nodes with (size, grams), from the text of the least id of each; repeated if that id is."""
    wanted = materialise(wanted, "wanted")
    holders = materialise(rows.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.min("id").alias("id")).select("id").distinct(), "holders")
    small = holders.count() <= FILTER_IDS
    ids = holders.select(F.col("id").alias("holder"))
    texts = docs.select("id", "text").join(F.broadcast(ids) if small else ids, docs["id"].eqNullSafe(F.col("holder")), "left_semi")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["node", "size", "grams"])

        for batch in batches:
            out, held = [], 0
            for g in gram_sets(*utf8(batch.column(0)), n):
                if len(g):
                    out.append((node_of(g), len(g), g.tobytes()))
                    held += g.nbytes
                if held >= ARROW_BYTES:
                    yield rows_of(out)
                    out, held = [], 0
            yield rows_of(out)

    found = texts.select("text").mapInArrow(tidy(scan), "node bigint, size bigint, grams binary")
    return found.join(F.broadcast(wanted) if small else wanted, "node")


def _grown(homed: DataFrame, percent: int) -> DataFrame:
    """(node, size, root, tree, home, speaks): each tree's components, root being one of their nodes.

    speaks, where a home has several trees: the ``SPEAKERS`` sets nearest to the middle of a component.
    """
    dealt = homed.select("home", "tile", "node", "size", "grams", "tiles").repartition("home", "tile").sortWithinPartitions("home", "tile", "node")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def grow() -> pa.RecordBatch:
            nodes, speaks = [x[2] for x in held], [False] * len(held)
            sets = [np.frombuffer(x[4], "<u8") for x in held]
            root = joined(sets, percent) if len(held) > 1 else np.zeros(1, np.int64)
            if held[0][5] > 1:
                points = points_of([counts_of(g) for g in sets])
                for r in np.unique(root).tolist():
                    own = np.flatnonzero(root == r)
                    far = np.abs(points[own] - np.median(points[own], axis=0)).sum(1)
                    for i in own[np.argsort(far, kind="stable")[:SPEAKERS]].tolist():
                        speaks[i] = True
            tree = mix(mix(np.array([held[0][0]], np.int64).view(np.uint64)) + U64(held[0][1])).view(np.int64)
            columns = (nodes, [x[3] for x in held], [nodes[r] for r in root], np.repeat(tree, len(held)), [x[0] for x in held])
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(speaks, pa.bool_())], names=["node", "size", "root", "tree", "home", "speaks"])

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                if held and held[0][:2] != row[:2]:
                    yield grow()
                    held = []
                if not held or held[-1][2] != row[2]:
                    held.append(row)
        if held:
            yield grow()

    return dealt.mapInArrow(tidy(scan), "node bigint, size bigint, root bigint, tree bigint, home bigint, speaks boolean")


def _spoken(docs: DataFrame, rows: DataFrame, trees: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): links between components of the trees of one home, found by a tree of their speakers.

    Their n-grams come from the texts again: kept with the trees they would be as long as the texts, or longer.
    """
    speakers = trees.where("speaks").select("home", "node", "size")
    weight = speakers.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("size") / TILE_GRAMS)).cast("int").alias("n"))
    homed = speakers.join(weight, "home").select("node", "home", F.pmod(F.xxhash64("node", F.lit(1)), "n").cast("int").alias("tile"), F.lit(1).alias("tiles"))
    return _grown(_sets(docs, rows, homed, n), percent).where(F.col("node") != F.col("root")).select(F.col("node").alias("a"), F.col("root").alias("b"))


def _bounded(pairs: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """The pairs that the count vectors can't rule out."""
    one = vectors.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("vector").alias("va"))
    two = vectors.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("vector").alias("vb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "va", "vb")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            least = least_common(batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent)
            for i in range(batch.num_rows):
                va, vb = unpacked(batch.column(4)[i].as_buffer()), unpacked(batch.column(5)[i].as_buffer())
                groups = min(len(va), len(vb))
                keep[i] = np.minimum(folded(va, groups), folded(vb, groups)).sum() >= least[i]
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return both.mapInArrow(tidy(scan), "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets really link."""
    one = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    two = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "ga", "gb")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(k)[i].as_buffer(), "<u8") for k in (2, 3))
                keep[i] = common(a, b) >= least_common(len(a), len(b), percent)
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return both.mapInArrow(tidy(scan), "a bigint, b bigint")


def _near(held: DataFrame, vectors: DataFrame, percent: int) -> DataFrame:
    """The rows (page, node, size, root, tree) of sets that the parities let link with another of their page."""
    columns = ["page", "node", "size", "root", "tree"]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([parities(x.as_buffer()) for x in batch.column(1)], pa.binary())], names=["node", "bits"])

    bits = vectors.select("node", "vector").mapInArrow(tidy(short), "node bigint, bits binary")
    # a hash of the page: a plain repartition by page is optimised out where rows were joined on it, and that join may then be broadcast
    dealt = held.select(*columns).join(bits, "node").select(*columns, "bits").repartition(F.xxhash64("page")).sortWithinPartitions("page")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        kept: list[np.ndarray] = []

        def search() -> None:
            rows = np.stack([np.concatenate([x.column(k).to_numpy() for x in waiting]) for k in range(5)])
            bits = [b for x in waiting for b in x.column(5).to_pylist()]
            kept.append(rows[:, near_others(bits, rows[2], rows[3], rows[4], percent)])

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate([np.zeros((5, 0), np.int64), *kept], axis=1)], names=columns)

        for batch in batches:
            page = batch.column(0).to_numpy()
            first = np.flatnonzero(np.r_[True, page[1:] != page[:-1]][: len(page)]).tolist()
            for lo, hi in zip(first, [*first[1:], len(page)], strict=False):
                if waiting and waiting[0].column(0)[0].as_py() != page[lo]:
                    search()
                    waiting.clear()
                waiting.append(batch.slice(lo, hi - lo))
            if sum(x.shape[1] for x in kept) > 50_000:
                yield out()
                kept.clear()
        if waiting:
            search()
        yield out()

    return dealt.mapInArrow(tidy(scan), "page bigint, node bigint, size bigint, root bigint, tree bigint")


def _crossing(large: DataFrame, trees: DataFrame, vectors: DataFrame, percent: int, most: int) -> DataFrame:
    """(page, a, b, more): pairs within a larger page, of different trees and components, that the trees of its parts can't rule out.

    Up to ``most`` for two components in two parts; more says that their components have others.
    """
    held = large.select("page", "node").join(trees.select("node", "size", "root", "tree"), "node")
    by_root = held.groupBy("page", "root").agg(F.min("tree").alias("t"), F.max("tree").alias("u"), F.count("*").alias("c"))
    open_ = by_root.groupBy("page").agg(F.count("*").alias("roots"), F.min("t").alias("t"), F.max("u").alias("u"), F.sum("c").alias("c"), F.max(F.struct("c", "root")).alias("most"))
    # the component with most sets of the page is a part of its own, which needn't meet itself
    open_ = open_.where((F.col("roots") > 1) & (F.col("t") != F.col("u")))
    own = F.when(F.col("c") > PART, F.ceil(F.col("most.c") / PART)).otherwise(0)
    open_ = open_.select("page", F.col("most.root").alias("first"), own.cast("int").alias("own"), F.ceil((F.col("c") - F.col("most.c")) / PART).cast("int").alias("others"))
    # a page of one part is as bounded as a part: what can't link there goes no further
    near = materialise(_near(held.join(open_.where((F.col("own") == 0) & (F.col("others") == 1)), "page"), vectors, percent), "near")
    near = near.withColumns({"first": F.lit(0).cast("bigint"), "own": F.lit(0), "others": F.lit(1)})
    parted = held.join(open_.where((F.col("own") > 0) | (F.col("others") > 1)), "page")
    cut = near.unionByName(parted).withColumn("main", (F.col("root") == F.col("first")) & (F.col("own") > 0))
    cut = cut.withColumn("part", F.when(F.col("main"), -1 - F.pmod(F.xxhash64("node"), "own")).otherwise(F.pmod(F.xxhash64("node"), "others")).cast("int"))
    # parts of others, 0 and on, meet those from their own on and all of the main component's, -1 and down
    meets = F.when(F.col("main"), F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda o: F.struct(F.col("part").alias("one"), o.cast("int").alias("two"), F.lit(0).alias("side"))))
    meets = meets.otherwise(F.transform(F.sequence(-F.col("own"), F.col("others") - 1), lambda o: F.struct(F.least("part", o).cast("int").alias("one"), F.greatest("part", o).cast("int").alias("two"), (F.col("part") > o).cast("int").alias("side"))))
    dealt = cut.withColumn("meet", F.explode(meets)).join(vectors.select("node", "vector"), "node")
    dealt = dealt.select("page", F.concat_ws(",", "meet.one", "meet.two").alias("pair"), "meet.side", "node", "size", "root", "tree", "vector").repartition("page", "pair").sortWithinPartitions("page", "pair", "side", "node")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        found: set = set()

        def search() -> None:
            page = rows[0][0]
            sides = []
            for side in (0, 1):
                own = [x for x in rows if x[2] == side]
                sides.append((own, ([unpacked(x[7]) for x in own], np.array([x[4] for x in own], np.int64), np.array([x[5] for x in own], np.int64), np.array([x[6] for x in own], np.int64))))
            (lo, left), (hi, right) = sides
            if not hi:
                hi, right = lo, left
            found.update((page, max(lo[i][3], hi[j][3]), min(lo[i][3], hi[j][3]), more) for i, j, more in candidates(left, right, percent, most))

        def out() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["page", "a", "b", "more"])

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(8)], strict=True):
                if rows and rows[0][:2] != row[:2]:
                    search()
                    rows = []
                rows.append(row)
            if len(found) > 200_000:
                yield out()
                found.clear()
        if rows:
            search()
        yield out()

    return dealt.mapInArrow(tidy(scan), "page bigint, a bigint, b bigint, more boolean")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def _linked(docs: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, root) of all nodes that link with another."""
    pages = materialise(_pages(docs, n, percent), "pages")
    large = pages.where(F.col("page").isNotNull()).select("page", F.col("a").alias("node"), "size").dropDuplicates(["page", "node"])
    large = materialise(large, "large-pages")
    leaves = pages.where(F.col("page").isNull()).select("a", "b").distinct()
    homes = materialise(_homes(large), "trees")
    members = _ends(leaves).unionByName(homes.select("node")).distinct()
    vectors = materialise(rows.select("node", "size", "vector").join(members, "node", "left_semi").dropDuplicates(["node"]), "vectors")
    trees = materialise(_grown(_sets(docs, rows, homes.select("node", "home", "tile", "tiles"), n), percent), "grown")
    spoken = materialise(_spoken(docs, rows, trees, n, percent), "spoken")
    # the links of a tree: each node with its root there
    links = trees.where(F.col("node") != F.col("root")).select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(spoken)
    roots = trees.select("node", "root") if spoken.isEmpty() else materialise(components(links), "tree-roots")

    def apart(pairs: DataFrame) -> DataFrame:
        """The pairs whose ends have different roots."""
        one, two = roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        return pairs.join(one, "a", "left").join(two, "b", "left").where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).drop("ra", "rb")

    def crossing(pages: DataFrame, most: int) -> DataFrame:
        now = trees.drop("root", "speaks").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        return materialise(_crossing(pages, now, vectors, percent, most), "crossing")

    bounded = materialise(_bounded(apart(leaves), vectors, percent), "leaf-pairs")
    found, most, tested = crossing(large, FIRST), FIRST, None
    new = materialise(bounded.unionByName(found.select("a", "b")).distinct(), "untested")
    while True:
        linked = False
        if not new.isEmpty():
            sets = materialise(_sets(docs, rows, _ends(new), n).dropDuplicates(["node"]), "sets")
            more = materialise(_verified(new, sets, percent), "links")
            linked = not more.isEmpty()
            links = links.unionByName(more)
        if linked or tested is None:
            roots = materialise(components(links), "roots")
        tested = new if tested is None else tested.unionByName(new)
        rest = apart(found.where("more")).select("page").distinct()  # other components that had more are linked by now
        if rest.isEmpty():
            return roots
        most *= 64
        found = crossing(large.join(materialise(rest, "open-pages"), "page", "left_semi"), most)
        new = materialise(apart(found.select("a", "b").distinct()).join(tested, ["a", "b"], "left_anti"), "untested")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, node (the set's name) and component_id, the least id of its class."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = materialise(_nodes(plain, n), "nodes")
    full = rows.where(F.col("node").isNotNull())
    roots = _linked(plain, full, n, percent)
    least = full.groupBy("node").agg(F.min("id").alias("least"))
    by_root = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = by_root.join(by_root.groupBy("root").agg(F.min("least").alias("component")), "root").select("node", "component")
    named = full.join(materialise(classes, "classes"), "node").select("id", "size", "node", "component")
    lone = rows.where(F.col("node").isNull()).select("id", "size", "node", F.col("id").alias("component"))
    return named.unionByName(lone).select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "node", F.col("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which one stays in each class: the least id, then the least node name.

    Rows without words all stay.
    """
    node = fresh(docs, "node")
    classes = materialise(jaccard_components(docs, n, percent, id_col, text_col).select(F.col(id_col).alias("id"), "node", F.col("component_id").alias("c")), "near-classes")
    words = classes.where(F.col("node").isNotNull())
    holds = F.col("id").eqNullSafe(F.col("c"))
    stays = words.where(holds).groupBy("c").agg(F.min("node").alias("keep")).select(F.col("c").alias("class"), "keep")
    lost = words.join(stays, F.col("c").eqNullSafe(F.col("class")), "left").where(~(holds & (F.col("node") == F.col("keep"))))
    lost_id, lost_node = fresh(docs, "lost_id"), fresh(docs, "lost_node")
    named = [F.col("id").alias(lost_id), F.col("node").alias(lost_node)]
    lost = materialise(lost.select(*named).distinct(), "near-lost")
    repeated = materialise(words.groupBy("id", "node").count().where(F.col("count") > 1).select(*named), "near-repeated")
    at = docs.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [node_of(g) if len(g) else None for g in gram_sets(*utf8(batch.column(at)), n)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], names=[*batch.schema.names, node])

    rows = docs.mapInArrow(tidy(scan), plus(docs.schema, **{node: "bigint"}))
    on = F.col(f"`{id_col}`").eqNullSafe(F.col(lost_id)) & (F.col(node) == F.col(lost_node))
    kept = rows.join(F.broadcast(lost) if lost.count() <= FILTER_IDS else lost, on, "left_anti")
    if not repeated.isEmpty():
        twice = kept.join(repeated, on, "left_semi").dropDuplicates([id_col, node])
        kept = kept.join(repeated, on, "left_anti").unionByName(twice)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
