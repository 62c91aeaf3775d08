"""Merkle manifest of a dataset: a forest over groups of rows, a tree over its roots, and a proof for each row.

A row's leaf is the SHA-256 of its columns, each as byte count, colon and value, or a dash for
null. Within a group leaves ascend by id; every ``fanout`` consecutive nodes become the hash of
their digests until one is left, the group's subroot. Subroots, by group (null first, then
bytewise), give the root in the same way. A proof is the siblings on the way to the root.

1. Whole texts are read and hashed once; what moves from then on is narrow (``merkle-leaves``).
2. Row numbers come without one task holding a group: rows are dealt by range of (group, id)
   and sorted there; a row's number is its place in its range, plus the group's rows in
   earlier ranges. Those counts are one row for each range and group in it.
3. Going up, one DataFrame step a level: floor(number / fanout) groups at most ``fanout``
   nodes, whose digests, sorted by number, are hashed into the parent. A level is a table
   a third as long as the one before; so are the tasks.
4. Going down, one join a level hands each node its parent's proof with its own siblings in
   front. A proof is built once for each inner node and only then handed to its children, so
   that what moves is n long proofs in all, not n for every level; joining leaves with every
   level from below would move them as often as there are levels. No step joins on a group,
   so a group with a third of all rows is spread like any other.

Every level is a written table: a lost executor costs no more than the step it was in.

Defined cases: null columns hash as a dash; a null id comes first in its group; rows equal in
group and id are ordered by leaf, and equal rows have the same leaf; a group of one row is its
own subroot, a single subroot the root; an empty table gives an empty manifest; columns that
are not named take no part, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of counts (one a range and group in it) that are broadcast; beyond, they are joined by a shuffle.
MOST_COUNTS = 200_000


def field(value: Column) -> Column:
    """A value's part of a leaf: byte count, colon, value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def hexed(digests: Column) -> Column:
    """Digests as lowercase hex."""
    return F.lower(F.hex(digests))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """rows with ``idx``, the place in ``g`` by ``order`` (null first), and ``n``, the rows of ``g``.

    ``order`` begins with ``g``, which is never null.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    ranged = materialise(ranged, f"{name}-ranged").withColumn("part", F.shiftright("at", 33))
    counts = ranged.groupBy("part", "g").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = materialise(counts.select("part", "g", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("c").over(Window.partitionBy("g")).alias("n")), f"{name}-counts")
    if shift.count() <= MOST_COUNTS:
        shift = F.broadcast(shift)
    return ranged.join(shift, ["part", "g"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _levels(nodes: DataFrame, most: int, fanout: int, name: str) -> list[DataFrame]:
    """Tables of the levels above ``nodes``, lowest first: (g, idx, n, h, kids), kids being the children's digests in a row.

    A group is on a level as long as it had more than one node below.
    """
    out, below = [], nodes.select("g", "idx", "n", "h")
    while most > 1:
        kids = F.array_sort(F.collect_list(F.struct("idx", hexed(F.col("h")).alias("h"))))
        grouped = below.where("n > 1").groupBy("g", F.floor(F.col("idx") / fanout).alias("up"), F.ceil(F.col("n") / fanout).alias("m")).agg(kids.alias("k"))
        text = F.array_join("k.h", "")
        below = materialise(grouped.select("g", F.col("up").alias("idx"), F.col("m").alias("n"), F.unhex(_digest(text)).alias("h"), F.unhex(text).alias("kids")), f"{name}-level")
        out.append(below)
        most = -(-most // fanout)
    return out


_PATH = "array<struct<l:binary,r:binary>>"


def _handed_down(nodes: DataFrame, above: DataFrame, tops: DataFrame, fanout: int) -> DataFrame:
    """nodes with ``path``, their siblings up to the root, and what else their parents hand on.

    above: (g, up, kids, path, ..); tops: (g, path, ..) for groups whose only node is in ``nodes``.
    """
    size = 32
    own = F.pmod("idx", F.lit(fanout))
    step = F.struct(F.substring(F.col("kids"), F.lit(1), (own * size).cast("int")).alias("l"), F.substring(F.col("kids"), ((own + 1) * size + 1).cast("int"), F.lit(fanout * size)).alias("r"))
    inner = nodes.where("n > 1").withColumn("up", F.floor(F.col("idx") / fanout)).join(above, ["g", "up"])
    inner = inner.withColumn("path", F.concat(F.array(step), "path")).drop("up", "kids")
    single = nodes.where("n = 1").join(tops, "g")
    return inner.unionByName(single)


def _paths(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int, name: str) -> DataFrame:
    """nodes with their paths, from the highest level down."""
    carried = [c for c in tops.columns if c != "g"]
    above = None
    for i in range(len(levels), -1, -1):
        here = levels[i - 1].select("g", "idx", "n", F.col("kids").alias("own")) if i else nodes
        found = _handed_down(here, above, tops, fanout) if above is not None else here.join(tops, "g")
        if i == 0:
            return found
        above = materialise(found.select("g", F.col("idx").alias("up"), F.col("own").alias("kids"), *carried), f"{name}-paths")
    raise AssertionError


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "source", fanout: int = 3, claimed: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot and root (hex), path (siblings left and right of the way up, lowest first), claim (hex).

    ``claimed`` names columns whose values are to be checked against the manifest, as
    expressions over ``docs``; ``claim`` is the leaf that they give. A null expression, or none,
    claims the column's own value.
    """
    own = [F.col(f"`{c}`") for c in columns]
    told = [F.coalesce(claimed[c], F.col(f"`{c}`")) if c in (claimed or {}) else F.col(f"`{c}`") for c in columns]
    group = F.col(f"`{group_col}`").cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("g"),  # in the order of groups, null first
        F.col(f"`{id_col}`").alias("id"),
        leaf(own).alias("h"),
        (leaf(told) if claimed else F.lit(None).cast("binary")).alias("claim"),
    )
    rows = materialise(rows, "merkle-leaves")
    rows = materialise(_numbered(rows, ["g", "id", "h"], "merkle"), "merkle-numbered")
    most = rows.agg(F.max("n")).first()[0] or 0
    levels = _levels(rows, most, fanout, "merkle")
    tops = rows.where("n = 1").select("g", "h")
    for level in levels:
        tops = tops.unionByName(level.where("n = 1").select("g", "h"))
    # the subroots are one group of nodes, in the order of their own groups
    subroots = materialise(_numbered(tops.select(F.lit("").alias("g"), F.col("g").alias("id"), "h"), ["g", "id"], "merkle-roots"), "merkle-subroots")
    upper = _levels(subroots, subroots.agg(F.max("n")).first()[0] or 0, fanout, "merkle-roots")
    root = (upper[-1] if upper else subroots).select("g", F.col("h").alias("root"), F.array().cast(_PATH).alias("path"))
    above = _paths(subroots, upper, root, fanout, "merkle-roots")
    tops = materialise(above.select(F.col("id").alias("g"), F.col("h").alias("subroot"), "root", "path"), "merkle-tops")
    found = _paths(rows, levels, tops, fanout, "merkle")
    return found.select(F.col("id").alias(id_col), hexed(F.col("h")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"), "path", hexed(F.coalesce("claim", "h")).alias("claim"))


def siblings(path: Column) -> Column:
    """The digests of a path in a row, as hex."""
    return F.array_join(F.transform(path, lambda s: hexed(F.concat(s["l"], s["r"]))), "")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf (hex) leads to by a path."""
    return F.aggregate(path, start, lambda acc, s: _digest(F.concat(hexed(s["l"]), acc, hexed(s["r"]))))


def verify(found: DataFrame) -> DataFrame:
    """A manifest's rows with proof_sha256, folded_root and verified."""
    out = found.withColumns({"proof_sha256": _digest(siblings(F.col("path"))), "folded_root": folded(F.col("claim"), F.col("path"))})
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
