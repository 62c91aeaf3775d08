"""Exact dedup by a heavy-hitter split, in DataFrame functions only.

1. Every row becomes (id, length, SHA-256 of the normalised text); this narrow table is
   written once to the shared folder, so texts are read and hashed once.
2. A mergeable frequent-items summary of the Misra-Gries family (``approx_top_k``: counters
   that are decremented together when the table is full) runs over the digests' prefixes
   with map-side partial states. It names at most ``HOT_KEYS`` candidates.
3. The candidates are verified: an ordinary aggregate over their rows only, which combines
   map-side, yields true sizes and winners. At most ``HOT_KEYS`` rows are broadcast.
4. Rows of verified frequent digests are decided map-side; all others, whose groups are
   small by the summary's guarantee, meet in a window over the digest.

Defined cases: null text is the empty text; all empty texts are one group; a null id
sorts after every other id; of rows equal in length and id one stays; extra columns,
whatever their names, take no part (``exact_dedup``) or are handed on (``drop_copies``);
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialise

#: Bound of the broadcast winners, and of the counters in each partial summary.
HOT_KEYS, COUNTERS = 1024, 16384
#: A digest counts as frequent from so many rows on.
HOT_ROWS = 64

_SPACE = "\t\n\x0b\x0c\r "


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _SPACE, "")


def _winners(rows: DataFrame) -> DataFrame:
    """Verified frequent digests: digest, size and the row that stays. At most HOT_KEYS rows."""
    top = rows.agg(F.expr(f"approx_top_k(substr(h, 1, 8), {HOT_KEYS}, {COUNTERS})").alias("t"))
    named = top.select(F.explode("t").alias("t")).select(F.col("t.item").alias("p"), F.col("t.count").alias("c"))
    named = named.where(F.col("c") >= HOT_ROWS).select("p")
    found = rows.join(F.broadcast(named), F.substring("h", 1, 8) == F.col("p"), "left_semi")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("z"), F.col("id").alias("id")))
    sized = found.groupBy("h").agg(F.count("*").alias("size"), best.alias("b"))
    # one candidate prefix may hold several digests; the bound is kept by rank, not by luck
    ranked = sized.where(F.col("size") >= HOT_ROWS).orderBy(F.desc("size"), "h").limit(HOT_KEYS)
    return ranked.select("h", "size", F.col("b.id").alias("win"), (-F.col("b.n")).alias("win_n"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept and text_sha256.

    Of equal normalised texts the row with the most code points in the original stays,
    then the smallest id.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.char_length(text), F.lit(0)).alias("n"),
        F.sha2(normalised(text).cast("binary"), 256).alias("h"),
    )
    rows = materialise(rows, "exact-digests")
    marked = rows.join(F.broadcast(materialise(_winners(rows), "exact-winners")), "h", "left")
    hot = F.col("size").isNotNull()
    loses = hot & ~((F.col("n") == F.col("win_n")) & F.col("id").eqNullSafe(F.col("win")))
    lost = marked.where(loses).select("id", F.col("win").alias("keep_id"), F.col("size").alias("group_size"), F.lit(False).alias("kept"), "h")
    by = Window.partitionBy("h").orderBy(F.desc("n"), F.asc_nulls_last("id"))
    whole = Window.partitionBy("h")
    rest = marked.where(~loses).select(
        "id",
        F.coalesce("win", F.first("id").over(by)).alias("keep_id"),
        F.coalesce("size", F.count("*").over(whole)).alias("group_size"),
        (F.row_number().over(by) == 1).alias("kept"),
        "h",
    )
    return lost.unionByName(rest).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("h").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Losing rows of frequent texts are dropped map-side; whole rows of the others move once.
    """
    h, n, size, win, win_n, rank = (fresh(docs, x) for x in ("h", "n", "size", "win", "winn", "rank"))
    text = F.col(text_col).cast("string")
    rows = docs.withColumns({n: F.coalesce(F.char_length(text), F.lit(0)), h: F.sha2(normalised(text).cast("binary"), 256)})
    narrow = materialise(rows.select(F.col(id_col).alias("id"), F.col(n).alias("n"), F.col(h).alias("h")), "exact-digests")
    best = materialise(_winners(narrow), "exact-winners")
    best = best.select(F.col("h").alias(h), F.col("size").alias(size), F.col("win").alias(win), F.col("win_n").alias(win_n))
    marked = rows.join(F.broadcast(best), h, "left")
    left = marked.where(F.col(size).isNull() | ((F.col(n) == F.col(win_n)) & F.col(id_col).eqNullSafe(F.col(win))))
    order = Window.partitionBy(h).orderBy(F.desc(n), F.asc_nulls_last(id_col))
    return left.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
