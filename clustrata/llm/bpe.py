"""Byte-level BPE by overlapping chunks.

A text longer than ``CHUNK`` characters is cut into chunks that overlap by ``OVERLAP``
characters. The chunks of all documents are pre-tokenised in parallel, each from its own
first character. The pattern looks only to the right, so from a boundary that is right the
matches that follow are right too, but for those that the chunk's artificial end may have
changed. A chunk's matches are therefore trusted from the first boundary that the chunk
before it also found and trusts; where an overlap has no such boundary (one run of letters
longer than the overlap), the text from the last trusted boundary on is pre-tokenised again
up to where a later chunk agrees. The pieces are then encoded one by one; pieces are short
and repeat, so a bounded table keeps their ids. Decoding concatenates the bytes of the ids.

Memory: one chunk for pre-tokenising, one document for encoding.

Defined cases: null and empty texts have no tokens; ids of repeated rows are repeated; other
columns, whatever their names, are handed on by ``encode`` except ``ids``, which is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, plus

CHUNK, OVERLAP = 1 << 16, 1 << 9
#: Characters before a chunk's end within which a match may depend on what follows.
MARGIN = 2
#: Pieces whose ids a task keeps, and the longest such piece in characters.
TABLE, TABLE_CHARS = 1 << 17, 32


class Vocabulary:
    """Ranks of byte strings, the pattern that cuts a text into pieces, and both ways between."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.core = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for b, i in ranks.items():
            self.bytes[i] = b
        self.known: dict[str, bytes] = {}

    @staticmethod
    def parse(lines: bytes, pattern: str) -> Vocabulary:
        """From lines of base64 bytes and rank."""
        pairs = (line.split() for line in lines.splitlines() if line.strip())
        return Vocabulary({base64.b64decode(a): int(b) for a, b in pairs}, pattern)

    def cuts(self, text: str) -> np.ndarray:
        """The ends of the matches, from the first character."""
        return np.fromiter((m.end() for m in self.pattern.finditer(text)), np.int64)

    def encode_pieces(self, text: str, cuts: np.ndarray | None = None) -> np.ndarray:
        """The ids of all pieces in turn, as unsigned 32-bit integers."""
        known, out, last = self.known, [], 0
        pieces = self.pattern.findall(text) if cuts is None else []
        if cuts is not None:
            for end in cuts.tolist():
                pieces.append(text[last:end])
                last = end
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = np.array(self.core.encode_single_piece(piece.encode()), "<u4").tobytes()
                if len(piece) <= TABLE_CHARS:
                    if len(known) >= TABLE:
                        known.clear()
                    known[piece] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.bytes
        return b"".join([table[i] for i in ids.tolist()])


def stitch(vocabulary: Vocabulary, text: str, starts: list[int], cuts: list[np.ndarray], size: int) -> np.ndarray:
    """The true ends of all pieces of a text from those of its overlapping chunks.

    starts: each chunk's first character; cuts: its boundaries, counted from the text's start.
    """
    done: list[np.ndarray] = []
    at, n = 0, len(text)  # all boundaries up to `at` are settled
    for k, own in enumerate(cuts):
        end = min(n, starts[k] + size)
        sure = own if end == n else own[own <= end - MARGIN]
        if k == 0:
            fresh = sure
        else:
            if at < starts[k] or (at > starts[k] and not np.any(sure == at)):
                # no common boundary yet: go on from the settled one until this chunk agrees
                trusted, fresh = set(sure.tolist()), []
                step = 0
                for m in vocabulary.pattern.finditer(text, at):
                    step = m.end()
                    if end < n and step > end - MARGIN:
                        break
                    fresh.append(step)
                    if step in trusted:
                        break
                fresh = np.array(fresh, np.int64)
                if len(fresh):
                    fresh = np.concatenate([fresh, sure[sure > fresh[-1]]]) if int(fresh[-1]) in trusted else fresh
            else:
                fresh = sure[sure > at]
        if len(fresh):
            done.append(fresh)
            at = int(fresh[-1])
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def chunk_starts(n: int, size: int, overlap: int) -> list[int]:
    """First characters of the chunks of a text of n characters."""
    return [0] if n <= size else list(range(0, n - overlap, size - overlap))


class _Vocabularies:
    """One vocabulary for each worker process."""

    held: dict[tuple[str, str], Vocabulary] = {}

    @classmethod
    def get(cls, name: str, lines: bytes, pattern: str) -> Vocabulary:
        if (name, pattern) not in cls.held:
            cls.held[name, pattern] = Vocabulary.parse(lines, pattern)
        return cls.held[name, pattern]


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", digests: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The rows of ``docs`` with ``ids`` (array of int), or with n_tokens, ids_sha256, decoded_sha256.

    vocabulary_path: a file on the driver, which ships its bytes (a vocabulary is bounded by
    its format). Chunks of long texts are pre-tokenised by whichever task gets them; only
    their boundaries come back to the document's row.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, "rb") as f:
        lines = spark.sparkContext.broadcast(f.read())
    name = vocabulary_path
    new = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids"]
    kept = [c for c in docs.columns if c.lower() not in new]
    at = kept.index(text_col)
    plain = docs.select(*[F.col(f"`{c}`") for c in kept])
    kinds = {"n_tokens": "bigint", "ids": "array<int>"}
    schema = plus(plain.schema, **{c: kinds.get(c, "string") for c in new})

    def finish(batches: Iterator[pa.RecordBatch], cut_at: int | None) -> Iterator[pa.RecordBatch]:
        import hashlib

        vocabulary = _Vocabularies.get(name, lines.value, pattern)
        for batch in batches:
            texts, columns = batch.column(at).cast(pa.string()), batch.columns[: len(kept)]
            cuts = batch.column(cut_at) if cut_at is not None else None
            for lo in range(0, max(1, batch.num_rows), 256):
                out: list[list] = [[] for _ in new]
                part = texts.slice(lo, 256)
                for i, text in enumerate(part):
                    text = text.as_py() or ""
                    ends = None
                    if cuts is not None and cuts[lo + i].is_valid:
                        got = [np.frombuffer(x.as_py(), "<i8") for x in cuts[lo + i].values]
                        ends = stitch(vocabulary, text, chunk_starts(len(text), chunk, overlap), got, chunk)
                    ids = vocabulary.encode_pieces(text, ends)
                    if digests:
                        out[0].append(len(ids))
                        out[1].append(hashlib.sha256(ids.tobytes()).hexdigest())
                        out[2].append(hashlib.sha256(vocabulary.decode(ids)).hexdigest())
                    else:
                        out[0].append(ids.view("<i4"))
                types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, 256) for c in columns], *[pa.array(v, types.get(c, pa.string())) for c, v in zip(new, out, strict=True)]], names=[*kept, *new])

    long = F.coalesce(F.char_length(F.col(f"`{text_col}`").cast("string")), F.lit(0)) > chunk
    short = plain.where(~long).mapInArrow(lambda b: finish(b, None), schema)
    with_key = _with_cuts(plain.where(long), text_col, name, lines, pattern, chunk, overlap)
    return short.unionByName(with_key.mapInArrow(lambda b: finish(b, len(kept)), schema))


def _with_cuts(docs: DataFrame, text_col: str, name: str, lines: Broadcast, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """The long rows with the boundaries of each of their chunks, in order."""
    row = F.sha2(F.col(f"`{text_col}`").cast("binary"), 256).alias("r")
    text = F.col(f"`{text_col}`").cast("string")
    starts = F.sequence(F.lit(0), F.char_length("t") - overlap - 1, F.lit(chunk - overlap))
    chunks = docs.select(row, text.alias("t")).select("r", F.posexplode(starts).alias("k", "s"), "t")
    chunks = chunks.select("r", "k", "s", F.substring(F.col("t"), F.col("s") + 1, F.lit(chunk)).alias("c"))
    # equal long texts have equal chunks: one of each is enough, and the boundaries are per text
    chunks = chunks.dropDuplicates(["r", "k"])

    def pre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabularies.get(name, lines.value, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                start = batch.column(2)[i].as_py()
                cuts = (vocabulary.cuts(batch.column(3)[i].as_py()) + start).astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([cuts], pa.binary())], names=["r", "k", "cuts"])

    found = chunks.mapInArrow(pre, "r string, k int, cuts binary")
    per_text = found.groupBy("r").agg(F.array_sort(F.collect_list(F.struct("k", "cuts"))).alias("c"))
    cuts_col, key = fresh(docs, "cuts"), fresh(docs, "text_key")
    per_text = per_text.select(F.col("r").alias(key), F.transform("c", lambda x: x["cuts"]).alias(cuts_col))
    keyed = docs.withColumn(key, row)
    joined = keyed.join(per_text, key, "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], cuts_col)

