"""Substring dedup with a distributed difference-cover suffix array.

Every byte covered by a ``WIDTH``-byte string that also starts in a document with a smaller
id is removed. Sorting all suffixes of all texts would move each text dozens of times, so
lossless steps first find the few places whose order matters:

1. Chunks. Texts are cut where a hash of the following bytes says so; a chunk carries the
   ``WIDTH - 1`` bytes behind it, so it holds all strings that start in it. Equal chunks are
   one chunk, whose strings are removed from all documents but that with the least id.
2. Fingerprints. Each string of ``WIDTH`` bytes selects the least of its ``GRAM``-byte hashes
   (the leftmost if several are), so equal strings select equal hashes at equal places. A
   hash that different chunks select marks the places that may hold a string of both; the
   rest can't. Per task only sorted, packed hashes move.
3. Suffix array. The marked places of distinct chunks, with the bytes of all strings that
   select them, go to shards by hash, so equal strings meet in one shard. A shard sorts the
   suffixes of its distinct excerpts by the difference-cover algorithm (``suffix_array``:
   sorted sampled triples, recursion on names, merged remaining suffixes) and compares the
   ``WIDTH``-byte prefixes of neighbours; strings in a run of equal prefixes get the least id.
4. Runs of strings with a smaller id go back to the chunk's first document; every document
   removes what its chunks and those runs cover.

Nothing is capped: a frequent passage is one chunk, or one excerpt per distinct surrounding.

Defined cases: null counts as empty; shorter texts than ``WIDTH`` bytes are kept whole; rows
with a null id are neither changed nor compared; rows with equal ids don't remove each
other's strings; repeated rows repeat their result; other columns are handed on by
``remove_repeats``, where ``kept_bytes``, ``n_bytes``, ``n_removed``, ``n_spans`` are replaced.
Names of chunks are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, mix, plus, slices, utf8
from .common import _table as powers
from .suffix_array import suffix_array

WIDTH, GRAM = 50, 24
#: A chunk has about this many bytes (a power of two); place bits in a packed hash.
CHUNK, PLACE_BITS = 256, 24
#: Bytes of a NumPy pass, and of the excerpts that are sorted together: what a pass holds then stays in a core's cache.
SLICE, SEGMENT, EXCERPTS = 1 << 17, 1 << 22, 1 << 13
FINGERPRINTS_A_SHARD, EXCERPT_BYTES_A_SHARD = 1 << 20, 1 << 18
U64 = np.uint64
_PLACES = U64((1 << PLACE_BITS) - 1)


class _Text:
    """Hashes, chunks and selected places of the documents in one buffer."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        power, self._inverse = powers(n + 1)
        self._sum = np.zeros(n + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * power[:n], out=self._sum[1:])
        at = np.arange(max(0, n - GRAM + 1))
        self.gram = mix((self._sum[GRAM:] - self._sum[: len(at)]) * self._inverse[: len(at)]) if len(at) else np.zeros(0, U64)
        ends = offsets[1:-1]
        for k in range(1, GRAM):  # hashes across two documents
            bad = ends - k
            self.gram[bad[(bad >= 0) & (bad < len(self.gram))]] = U64(0xFFFFFFFFFFFFFFFF)
        cut = (self.gram & U64(CHUNK - 1)) == 0
        cut[offsets[:-1][offsets[:-1] < len(cut)]] = True
        starts = np.union1d(np.flatnonzero(cut), offsets[:-1][np.diff(offsets) >= WIDTH])
        self.doc_of = np.searchsorted(offsets, starts, "right") - 1
        doc_end = offsets[self.doc_of + 1]
        after = np.r_[starts[1:], n] if len(starts) else starts
        windows_end = np.minimum(np.minimum(after, doc_end), doc_end - WIDTH + 1)  # strings start before this
        keep = windows_end > starts
        self.start, self.doc_of, self.windows_end = starts[keep], self.doc_of[keep], windows_end[keep]
        end = self.windows_end + WIDTH - 1
        self.name = self.spans(self.start, end) ^ (end - self.start).astype(U64)
        follows = np.r_[self.doc_of[1:] == self.doc_of[:-1], False] & np.r_[self.start[1:] == self.windows_end[:-1], False] if len(self.start) else np.zeros(0, bool)
        nxt = np.r_[self.name[1:], U64(0)] if len(self.start) else self.name
        self.pair = np.where(follows, mix(self.name * U64(3) + mix(nxt.copy())), self.name)
        self.next = np.where(follows, nxt, self.name)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from start to end."""
        return mix((self._sum[end] - self._sum[start]) * self._inverse[start])

    def selected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, first string, end of strings) of each run of strings that select one place, within one document."""
        w = WIDTH - GRAM + 1
        g = self.gram
        count = len(self.data) - WIDTH + 1
        if count <= 0:
            return (np.zeros(0, np.int64),) * 3
        places = np.empty(count, np.int64)
        for lo in range(0, count, SEGMENT):
            hi = min(count, lo + SEGMENT)
            m = (g[lo : hi + w - 1] & ~_PLACES) | np.arange(hi + w - 1 - lo, dtype=np.int64).astype(U64)
            step, done = 1, 1
            while done < w:  # the minimum of w values by doubling
                step = min(done, w - done)
                m = np.minimum(m[: len(m) - step], m[step:])
                done += step
            places[lo:hi] = (m & _PLACES).astype(np.int64) + lo
        inside = np.zeros(count + 1, np.int64)
        ok = self.offsets[1:] - WIDTH + 1 > self.offsets[:-1]
        np.add.at(inside, self.offsets[:-1][ok], 1)
        np.add.at(inside, self.offsets[1:][ok] - WIDTH + 1, -1)
        valid = np.cumsum(inside)[:count] > 0
        edge = np.r_[True, (places[1:] != places[:-1]) | (valid[1:] != valid[:-1])]
        first = np.flatnonzero(edge)
        end = np.r_[first[1:], count]
        good = valid[first]
        return places[first[good]], first[good], end[good]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, U64).view(np.int64))


def _pack(x: np.ndarray, size: int) -> bytes:
    """The low bytes of 64-bit values, plane by plane."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _unpack(raw: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.view("<u8").ravel()


def _key(id_col: str, text_col: str) -> Column:
    """A name of a row's id and text."""
    return F.xxhash64(F.col(id_col), F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256))


#: A slice has at most SLICE / WIDTH documents, whose numbers fit above the bits of a hash.
_F_BITS, _O_BYTES, _ODD = 48, 5, U64(0xD6E8FEB86659FD93)
_O_MASK = U64((1 << (8 * _O_BYTES)) - 2)


def _fingerprint(g: np.ndarray) -> np.ndarray:
    """The high bits of a selected hash, spread one to one: the least of many is small, and shards go by the first bits."""
    return ((g >> U64(64 - _F_BITS)) * _ODD) & U64((1 << _F_BITS) - 1)


def _chunks(rows: DataFrame) -> DataFrame:
    """(key, id, start, windows, chunk, pair, next) of each chunk of each text; next: the chunk that follows, or itself."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for lo, hi in slices(offsets, SLICE):
                text = _Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                at = pa.array(text.doc_of + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(text.start - text.offsets[text.doc_of]), pa.array((text.windows_end - text.start).astype(np.int64)), _signed(text.name), _signed(text.pair), _signed(text.next)],
                    names=["key", "id", "start", "windows", "chunk", "pair", "next"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("key", "id", "text").mapInArrow(scan, f"key bigint, id {kind}, start bigint, windows bigint, chunk bigint, pair bigint, next bigint")


def _owners(text: _Text, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, owner): who selects a place: the chunk its strings start in, or each pair of neighbours they start in."""
    a = np.searchsorted(text.start, first, "right") - 1
    b = np.searchsorted(text.start, end - 1, "right") - 1
    many = np.maximum(b - a, 1)
    run = np.repeat(np.arange(len(a)), many)
    chunk = np.repeat(a, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return run, np.where((a == b)[run], text.name[chunk], text.pair[chunk]) & _O_MASK


def _shared_fingerprints(rows: DataFrame, shards: int) -> DataFrame:
    """(owner, print): the hashes that different owners select, or one owner at several places."""
    bits = (shards - 1).bit_length()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            f, o, place = (np.concatenate(x) for x in zip(*held, strict=True))
            # equal chunks count once; places tell a repeat within an owner from a copy of it
            one = _first_of(f, o, place)
            f, o = f[one], o[one]
            again = np.r_[False, (f[1:] == f[:-1]) & (o[1:] == o[:-1])]
            once, twice = ~again, again & ~np.r_[False, again[:-1]]
            o = np.where(again, o | U64(1), o)  # a second place of one owner counts as another owner
            keep = once | twice
            f, o = f[keep], o[keep]
            shard = (f >> U64(_F_BITS - bits)).astype(np.int64) if bits else np.zeros(len(f), np.int64)
            names, a = np.unique(shard, return_index=True)
            b = np.r_[a[1:], len(f)]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array([_pack(f[i:j], _F_BITS // 8) for i, j in zip(a, b, strict=True)], pa.binary()), pa.array([_pack(o[i:j], _O_BYTES) for i, j in zip(a, b, strict=True)], pa.binary())],
                names=["shard", "f", "o"],
            )

        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for lo, hi in slices(offsets, SLICE):
                text = _Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                place, first, end = text.selected()
                if not len(place):
                    continue
                run, o = _owners(text, first, end)
                a = np.searchsorted(text.start, first, "right") - 1
                held.append((_fingerprint(text.gram[place])[run], o, (place - text.start[a])[run]))
                size += len(run)
                if size >= FINGERPRINTS_A_SHARD // 2:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def answer(group: pa.Table) -> pa.Table:
        f = np.concatenate([_unpack(x, _F_BITS // 8) for x in group["f"].to_pylist()])
        o = np.concatenate([_unpack(x, _O_BYTES) for x in group["o"].to_pylist()])
        order = np.argsort(f)
        f, o = f[order], o[order]
        first = np.flatnonzero(np.r_[True, f[1:] != f[:-1]])
        many = np.minimum.reduceat(o, first) != np.maximum.reduceat(o, first)
        keep = np.repeat(many, np.diff(np.r_[first, len(f)]))
        f, o = f[keep], o[keep] & _O_MASK
        one = _first_of(f, o, np.zeros(len(f), np.int64))
        return pa.table({"owner": _signed(o[one]), "print": _signed(f[one])})

    return rows.select("text").mapInArrow(ask, "shard int, f binary, o binary").groupBy("shard").applyInArrow(answer, "owner bigint, print bigint")


def _first_of(f: np.ndarray, o: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Indices of one of each equal (f, o, place), by f; equal (f, o) lie side by side."""
    key = (f << U64(64 - _F_BITS)) | ((o >> U64(1)) & U64((1 << (64 - _F_BITS)) - 1))
    order = np.argsort(key)
    tie = key[order[1:]] == key[order[:-1]]
    tied = np.flatnonzero(np.r_[tie, False] | np.r_[False, tie]) if len(f) else order
    some = order[tied]
    order[tied] = some[np.lexsort((place[some], o[some], key[some]))]
    a, b, c = f[order], o[order], place[order]
    return order[np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])]] if len(f) else order


def _with(docs: DataFrame, info: DataFrame, how: str) -> DataFrame:
    """docs joined with what single documents need: one shuffle of the texts at every size, and no sort of them."""
    return docs.join(info.hint("shuffle_hash"), "key", how)


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets of a column of lists, from 0, and all their values."""
    ends = column.offsets.to_numpy()
    return ends - ends[0], column.values.slice(ends[0], ends[-1] - ends[0])


def _excerpts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, id, chunk, at, start, n, mark, name) of the bytes of the strings that select a wanted hash.

    From a chunk's first document only; at: counted from the chunk's start; n: strings; name: a
    hash of the bytes and the mark.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            (p_ends, prints), (c_ends, chunks) = _lists(batch.column(3)), _lists(batch.column(4))
            prints, chunks = prints.to_numpy().view(U64), chunks.to_numpy().view(U64)
            for lo, hi in slices(offsets, SLICE):
                text = _Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                if not len(text.start):
                    continue
                # chunks and hashes are looked up together with their document
                docs = np.arange(hi - lo, dtype=np.int64).astype(U64)
                c_docs = np.repeat(docs, np.diff(c_ends[lo : hi + 1]))
                own, at = np.unique(mix(text.name + text.doc_of.astype(U64) * _ODD), return_index=True)  # of equal chunks of a text, the first
                wanted_chunk = np.zeros(len(text.name), bool)
                wanted_chunk[at[np.isin(own, mix(chunks[c_ends[lo] : c_ends[hi]] + c_docs * _ODD))]] = True
                p_docs = np.repeat(docs, np.diff(p_ends[lo : hi + 1]))
                asked = np.sort((p_docs << U64(_F_BITS)) | prints[p_ends[lo] : p_ends[hi]])
                place, first, end = text.selected()
                a = np.searchsorted(text.start, first, "right") - 1
                f = _fingerprint(text.gram[place])
                sought = (text.doc_of[a].astype(U64) << U64(_F_BITS)) | f
                hit = np.flatnonzero(asked[np.minimum(np.searchsorted(asked, sought), len(asked) - 1)] == sought)
                # strings that select one place may start in several chunks: one excerpt for each
                a = a[hit]
                many = np.searchsorted(text.start, end[hit] - 1, "right") - a
                run = np.repeat(hit, many)
                c = np.repeat(a, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                s, e = np.maximum(first[run], text.start[c]), np.minimum(end[run], text.windows_end[c])
                keep = np.flatnonzero(wanted_chunk[c] & (s < e))
                s, e, c, mark = s[keep], e[keep], c[keep], f[run[keep]]
                name = text.spans(s, e + WIDTH - 1) ^ mix(mark + (e - s).astype(U64))
                doc = text.doc_of[c]
                same = pa.array(doc + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(same), batch.column(1).take(same), _signed(text.name[c]), pa.array((s - text.start[c]).astype(np.int32)), pa.array(s - text.offsets[doc]), pa.array((e - s).astype(np.int32)), _signed(mark), _signed(name)],
                    names=["key", "id", "chunk", "at", "start", "n", "mark", "name"],
                )

    joined = _with(rows, wanted, "inner")
    kind = rows.schema["id"].dataType.simpleString()
    return joined.select("key", "id", "text", "prints", "chunks").mapInArrow(scan, f"key bigint, id {kind}, chunk bigint, at int, start bigint, n int, mark bigint, name bigint")


def _excerpt_texts(rows: DataFrame, places: DataFrame) -> DataFrame:
    """(name, mark, least, excerpt) of the excerpts at the given places."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            ends, values = _lists(batch.column(1))
            name, mark, start, n, least = values.flatten()
            begin = np.repeat(offsets[:-1], np.diff(ends)) + start.to_numpy()
            size = n.to_numpy().astype(np.int64) + WIDTH - 1
            for lo in range(0, len(begin), EXCERPTS):
                some = slice(lo, lo + EXCERPTS)
                after = np.r_[0, np.cumsum(size[some])]
                raw = data[np.arange(after[-1]) + np.repeat(begin[some] - after[:-1], size[some])]
                excerpt = pa.Array.from_buffers(pa.binary(), len(after) - 1, [None, pa.py_buffer(after.astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([*(x[some] for x in (name, mark, least)), excerpt], names=["name", "mark", "least", "excerpt"])

    per_text = places.groupBy("key").agg(F.collect_list(F.struct("name", "mark", "start", "n", "least")).alias("places"))
    joined = _with(rows, materialise(per_text, "repeat-places"), "inner")
    kind = rows.schema["id"].dataType.simpleString()
    return joined.select("text", "places").mapInArrow(scan, f"name bigint, mark bigint, least {kind}, excerpt binary")


def least_ids(joined: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(excerpt, first string, end, least id) of runs of strings that an excerpt of a lesser id also has.

    joined, offsets: the bytes of distinct excerpts; ids: comparable integers, one for each of them.
    """
    sizes = np.diff(offsets)
    begin = offsets[:-1] + np.arange(len(sizes))
    letters = np.ones(int((sizes + 1).sum()), np.int64)  # an excerpt ends with the least letter
    of = np.repeat(np.arange(len(sizes)), sizes + 1)
    inside = np.ones(len(letters), bool)
    inside[begin + sizes] = False
    letters[inside] = joined.astype(np.int64) + 2
    order = suffix_array(letters)
    stop = np.repeat(begin + sizes - WIDTH, sizes + 1)
    order = order[order <= stop[order]]  # suffixes that start a string
    if not len(order):
        return (np.zeros(0, np.int64),) * 4
    raw = np.zeros(len(letters) + 8, U64)
    raw[: len(letters)][inside] = joined
    words = raw[: len(letters)].copy()
    for k in range(1, 8):  # the eight bytes from each place
        words = (words << U64(8)) | raw[k : k + len(letters)]
    same = np.ones(len(order) - 1, bool)
    for k in (*range(0, WIDTH - 8, 8), WIDTH - 8):  # neighbours' prefixes
        w = words[order + k]
        same &= w[1:] == w[:-1]
    run = np.flatnonzero(np.r_[True, ~same])
    own = ids[of[order]]
    least = np.repeat(np.minimum.reduceat(own, run), np.diff(np.r_[run, len(order)]))
    lower = np.flatnonzero(least < own)
    by = lower[np.argsort(order[lower])]
    place, who, m = order[by], of[order[by]], least[by]
    cut = np.flatnonzero(np.r_[True, (place[1:] != place[:-1] + 1) | (who[1:] != who[:-1]) | (m[1:] != m[:-1])]) if len(by) else by
    last = np.r_[cut[1:], len(place)] - 1 if len(by) else by
    return who[cut], place[cut] - begin[who[cut]], place[last] - begin[who[cut]] + 1, m[cut]


def _lower_runs(rows: DataFrame, excerpts: DataFrame) -> DataFrame:
    """(chunk, first, end): strings of a chunk that also start in a document before the chunk's first."""
    one = [F.min_by(c, "id").alias(c) for c in ("key", "start")]  # of one row: they take the same of equal ids
    alike = [F.min(c).alias(c) for c in ("n", "mark")]
    names = materialise(excerpts.groupBy("name").agg(F.min("id").alias("id"), *one, *alike, F.max("id").alias("most")), "repeat-names")
    # an excerpt whose mark has no other text is settled by its least id
    several = names.groupBy("mark").agg(F.count("*").alias("c")).where(F.col("c") > 1).select("mark")
    places = names.join(several, "mark", "left_semi").select("name", "mark", "key", "start", "n", F.col("id").alias("least"))
    texts = _excerpt_texts(rows, places)
    size = names.agg(F.coalesce(F.sum(F.col("n") + WIDTH), F.lit(0))).first()[0]
    shards = max(1, int(size // EXCERPT_BYTES_A_SHARD) + 1)

    def sort(group: pa.Table) -> pa.Table:
        ids = group["least"].combine_chunks()
        rank = pc.rank(ids, tiebreaker="dense").to_numpy().astype(np.int64)
        row = np.zeros(int(rank.max(initial=0)) + 1, np.int64)  # a row that has the id of a rank
        row[rank] = np.arange(len(rank))
        who, a, b, least = least_ids(*utf8(group["excerpt"]), rank)
        return pa.table({"name": group["name"].take(pa.array(who)), "a": pa.array(a), "b": pa.array(b), "lower": group["least"].take(pa.array(row[least]))})

    kind = excerpts.schema["id"].dataType.simpleString()
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("mark"), F.lit(shards)).cast("int"))
    runs = materialise(dealt.groupBy("shard").applyInArrow(sort, f"name bigint, a bigint, b bigint, lower {kind}"), "repeat-runs")
    whole = names.where(F.col("most") > F.col("id")).select("name", F.lit(0).cast("bigint").alias("a"), F.col("n").cast("bigint").alias("b"), F.col("id").alias("lower"))
    held = excerpts.select("name", "chunk", "at", "id").join(whole.unionByName(runs), "name").where(F.col("lower") < F.col("id"))
    return held.select("chunk", (F.col("at") + F.col("a")).alias("first"), (F.col("at") + F.col("b")).alias("end"))


def _covered(rows: DataFrame) -> DataFrame:
    """(key, spans): packed starts and ends of the strings that a document loses."""
    chunks = materialise(_chunks(rows), "repeat-chunks")
    total = chunks.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0]
    firsts = materialise(chunks.groupBy("chunk").agg(F.min("id").alias("least"), F.min_by("key", "id").alias("key")), "repeat-firsts")
    shards = max(1, 1 << max(0, int(total * 0.085 / FINGERPRINTS_A_SHARD)).bit_length())
    shared = materialise(_shared_fingerprints(rows, shards), "repeat-prints")
    mask = F.lit(int(_O_MASK))
    # a pair's strings start in its first chunk or in the one that follows it
    pairs = chunks.where(F.col("pair") != F.col("chunk")).groupBy("pair").agg(F.min("chunk").alias("chunk"), F.min("next").alias("next"))
    names = firsts.select(F.col("chunk").bitwiseAND(mask).alias("owner"), "chunk").unionByName(pairs.select(F.col("pair").bitwiseAND(mask).alias("owner"), F.explode(F.array("chunk", "next")).alias("chunk")))
    marked = shared.join(names, "owner").select("chunk", "print").join(firsts.select("chunk", "key"), "chunk")
    wanted = materialise(marked.groupBy("key").agg(F.collect_set("print").alias("prints"), F.collect_set("chunk").alias("chunks")), "repeat-wanted")
    excerpts = materialise(_excerpts(rows, wanted), "repeat-excerpts")
    runs = _lower_runs(rows, excerpts)
    placed = chunks.select("chunk", "key", "id", "start", "windows").join(firsts.select("chunk", "least"), "chunk")
    runs = runs.withColumnRenamed("chunk", "of")
    lost = placed.join(runs, (F.col("chunk") == F.col("of")) & (F.col("least") == F.col("id")), "left").where((F.col("least") < F.col("id")) | F.col("of").isNotNull())
    own = F.col("of").isNotNull()
    lost = lost.select("key", F.when(own, F.col("start") + F.col("first")).otherwise(F.col("start")).alias("start"), (F.col("start") + F.when(own, F.col("end")).otherwise(F.col("windows"))).alias("stop"))
    spans = lost.repartition("key").distinct().groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return materialise(spans, "repeat-spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with n_bytes, n_removed, n_spans and kept_bytes (binary)."""
    new = ("n_bytes", "n_removed", "n_spans", "kept_bytes")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("key", _key("id", "text"))
    spans = _covered(rows.where(F.col("id").isNotNull() & (F.octet_length("text") >= WIDTH)))
    key, found = fresh(docs, "key"), fresh(docs, "spans")
    kept = [c for c in docs.columns if c.lower() not in new]
    plain = docs.select(*[F.col(f"`{c}`") for c in kept])
    keyed = plain.withColumn(key, F.when(F.col(id_col).isNotNull(), _key(id_col, text_col)))
    info = spans.select(F.col("key").alias(key), F.col("spans").alias(found))
    joined = keyed.join(info.hint("shuffle_hash"), key, "left").select(*[F.col(f"`{c}`") for c in kept], found)
    at, width = kept.index(text_col), len(kept)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for lo in range(0, max(1, batch.num_rows), 512):
                part = batch.slice(lo, 512)
                removed, runs, out = [], [], []
                for i in range(part.num_rows):
                    own = data[offsets[lo + i] : offsets[lo + i + 1]]
                    lost = part.column(width)[i]
                    if not lost.is_valid:
                        removed.append(0)
                        runs.append(0)
                        out.append(own.tobytes())
                        continue
                    fields = lost.values.flatten()
                    mark = np.zeros(len(own) + 1, np.int64)
                    np.add.at(mark, fields[0].to_numpy(), 1)
                    np.add.at(mark, fields[1].to_numpy() + WIDTH - 1, -1)
                    gone = np.cumsum(mark)[:-1] > 0
                    removed.append(int(gone.sum()))
                    runs.append(int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]])))
                    out.append(own[~gone].tobytes())
                sizes = np.diff(offsets[lo : lo + part.num_rows + 1])
                yield pa.RecordBatch.from_arrays([*part.columns[:width], pa.array(sizes), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(out, pa.binary())], names=[*kept, *new])

    return joined.mapInArrow(scan, plus(plain.schema, n_bytes="bigint", n_removed="bigint", n_spans="bigint", kept_bytes="binary"))
