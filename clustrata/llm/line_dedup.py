"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

A line's words (A-Z lower-cased, cut at ASCII white space) are compared. Two lines are alike
if their words are equal or, where both have ``LEAST_WORDS`` words or more, one insertion,
deletion or replacement of a word apart. A line goes if a line before it, by (id, place in
the text), is alike, whether or not that line stays.

1. Equal lines meet in an aggregate with partial states: one row per distinct line, with its
   first place. Frequent lines collapse in each task.
2. Of two lines one edit apart, the first or the last half (of one of two lengths) is equal.
   Lines that share no such half with another distinct line can't have a neighbour and are
   left out; only the others' words are read again.
3. Each remaining line emits all its variants with one word deleted, as hashed keys: the
   exclusive or of hashes of (word, position) over the words before and, one position earlier,
   behind the gap, from one running aggregate. A line without deletion has a key as well.
4. Equal keys are joined by aggregates that keep the earliest line only: lines with a word
   deleted at the same place (a replacement), or one with and one without deletion. So a
   group of near copies yields one witness for each line, never its pairs.
5. Each line's edit distance to its witness is verified on the words; the earliest stays.
   Copies of a frequent line join its one row of verdicts by a skewed join, which Spark
   splits; nothing else of them is ever gathered.

Defined cases: null text is one line without words; lines without words always stay; a null
id comes after all others; rows with equal ids don't remove lines at the same place from
each other; repeated rows repeat their result; other columns are handed on by ``dedup_lines``,
where ``n_lines``, ``n_dropped`` and ``kept_text`` are replaced. Keys have 64 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialise

LEAST_WORDS = 5
#: Rows up to which a side is broadcast; beyond it is a shuffled join.
#: Columns are names and places of fixed width, so a row takes under 100 bytes.
SEND_ROWS = 1 << 19


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = r"[\x20\x09-\x0D]+"


def plain_of(line: Column) -> Column:
    """A line's words, each followed by one space but the last; the costly pattern only where it is needed."""
    odd = F.contains(line, F.lit("  "))
    for c in "\t\x0b\f\r":
        odd = odd | F.contains(line, F.lit(c))
    plain = F.trim(F.when(odd, F.regexp_replace(line, _SPACES, " ")).otherwise(line))
    ascii_only = F.octet_length(plain) == F.char_length(plain)
    return F.when(ascii_only, F.lower(plain)).otherwise(F.translate(plain, _UPPER, _LOWER))


def words_of(line: Column) -> Column:
    """A line's words; an empty list if there is none."""
    plain = plain_of(line)
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _name(plain: Column) -> Column:
    return F.unhex(F.md5(plain.cast("binary")))


def _lines(docs: DataFrame) -> DataFrame:
    """(key, place, line) from (id, text): place orders all lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.xxhash64("id", text).alias("key"), "id", F.posexplode(F.split(text, "\n", -1)).alias("no", "line"))
    return rows.select("key", F.struct(F.col("id").isNull().alias("z"), F.col("id"), F.col("no")).alias("place"), "line")


def _halves(plain: Column, n: Column) -> Column:
    """Hashes of the first and last halves, of both lengths that a line one edit apart may share."""

    def half(cut: Column) -> list[Column]:
        return [F.xxhash64(F.lit(k), cut, F.call_function("substring_index", plain, F.lit(" "), cut * sign)) for k, sign in (("first", 1), ("last", -1))]

    a, b = (n / 2).cast("int"), ((n - 1) / 2).cast("int")
    return F.when(n >= LEAST_WORDS, F.when(a == b, F.array(*half(a))).otherwise(F.array(*half(a), *half(b)))).otherwise(F.array().cast("array<bigint>"))


def _named_lines(lines: DataFrame) -> DataFrame:
    """(key, place, h, halves) of every line; h is null without words.

    Nothing is filtered here: a filter would be pushed down and normalise each line twice.
    """
    known = lines.select("key", "place", plain_of(F.col("line")).alias("p"))
    n = F.octet_length("p") - F.octet_length(F.replace("p", F.lit(" "), F.lit(""))) + 1
    counted = known.withColumn("n", n)
    return counted.select("key", "place", F.when(F.col("p") != "", _name(F.col("p"))).alias("h"), _halves(F.col("p"), F.col("n")).alias("halves"))


def _sent(df: DataFrame) -> DataFrame:
    """df, marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= SEND_ROWS else df


def _line(first: Column, words: Column) -> Column:
    """A line's 64-bit name, for its place and its words."""
    return F.xxhash64(first, words)


def _candidates(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """(first, w) of the distinct lines that share a half with another."""
    halves = distinct.select("first", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).where(F.col("c") > 1).select("half")
    wanted = materialise(halves.join(shared, "half", "left_semi").select("first").distinct(), "line-candidates")
    rows = lines.join(_sent(wanted.select(F.col("first").alias("place"))), "place", "left_semi")
    return rows.select(F.col("place").alias("first"), words_of(F.col("line")).alias("w")).distinct()


def _variants(lines: DataFrame) -> DataFrame:
    """(u, key, left, gap): keys of each line as it is (gap null) and with each word deleted; u names the line.

    left: the number of words left. A key is the exclusive or of the hashes of (word, place); the
    words behind a gap stand one place earlier. With ``a`` and ``b`` the hashes of a word at its
    place and at the one before, the key without word i is that of all ``b``, of ``a[i]``, and
    of all ``a`` and ``b`` up to i: one running aggregate over rows that lie together already.
    """
    total = F.aggregate(F.transform("w", lambda x, i: F.xxhash64(x, i - 1)), F.lit(0).cast("bigint"), lambda x, y: x.bitwiseXOR(y))
    # the exchange keeps what is made once a line from being made again for each of its words
    named = lines.select(_line(F.col("first"), F.col("w")).alias("u"), total.alias("all_b"), F.size("w").alias("n"), "w").repartition("u")
    words = named.select("u", "all_b", "n", F.posexplode("w").alias("i", "word"))
    here, moved = F.xxhash64("word", F.col("i")), F.xxhash64("word", F.col("i") - 1)
    hashed = words.select("u", "all_b", "n", "i", here.alias("a"), here.bitwiseXOR(moved).alias("both"))
    upto = Window.partitionBy("u").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = hashed.select("u", "all_b", "n", "i", "a", F.bit_xor("both").over(upto).alias("up"))
    rest = F.col("all_b").bitwiseXOR(F.col("up"))
    cut = F.struct(rest.bitwiseXOR(F.col("a")).alias("key"), (F.col("n") - 1).alias("left"), F.col("i").alias("gap"))
    # behind the last word, all b and all of both leave all a: the key of the line as it is
    whole = F.struct(rest.alias("key"), F.col("n").alias("left"), F.lit(None).cast("int").alias("gap"))
    keys = F.when(F.col("i") == F.col("n") - 1, F.array(cut, whole)).otherwise(F.array(cut))
    return run.select("u", F.inline(keys))


def _witnesses(variants: DataFrame) -> DataFrame:
    """(first, line, earlier): the earliest line that shares a key in a way that means one edit."""
    key = ["key", "left"]
    whole, gap = F.col("gap").isNull(), F.col("gap").isNotNull()
    groups = variants.groupBy(key).agg(F.min(F.when(whole, F.col("first"))).alias("plain"), F.min(F.when(gap, F.col("first"))).alias("cut"), F.count("*").alias("c")).where(F.col("c") > 1)
    same_gap = variants.where(gap).groupBy(*key, "gap").agg(F.min("first").alias("replaced"), F.count("*").alias("c")).where(F.col("c") > 1).drop("c")
    one = variants.join(groups, key).select("first", "line", F.when(gap, F.col("plain")).otherwise(F.col("cut")).alias("earlier"))
    two = variants.where(gap).join(same_gap, [*key, "gap"]).select("first", "line", F.col("replaced").alias("earlier"))
    found = one.unionByName(two).where(F.col("earlier") < F.col("first"))
    return found.groupBy("first", "line").agg(F.min("earlier").alias("earlier"))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two lists of words are at most one insertion, deletion or replacement apart."""
    n, m = F.size(a), F.size(b)
    long, short = F.when(n >= m, a).otherwise(b), F.when(n >= m, b).otherwise(a)
    differs = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    replaced = F.size(F.filter(differs, lambda d: d)) <= 1
    k = F.least(n, m)
    first = F.array_position(F.zip_with(F.slice(long, F.lit(1), k), short, lambda x, y: x != y), True).cast("int")
    behind = F.when(first == 0, F.lit(True)).otherwise(F.slice(long, first + 1, k - first + 1) == F.slice(short, first, k - first + 1))
    return F.when(n == m, replaced).when(F.abs(n - m) == 1, behind).otherwise(False)


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(key, place) of the lines of (id, text) that go; key names a row."""
    lines = _lines(docs)
    named = materialise(_named_lines(lines), "line-names").where(F.col("h").isNotNull())
    distinct = materialise(named.groupBy("h").agg(F.min("place").alias("first"), F.first("halves").alias("halves")), "line-distinct")
    # equal ids may hold several lines at one place, short ones too; filtered once the words are written
    candidates = materialise(_candidates(lines, distinct), "line-words").where(F.size("w") >= LEAST_WORDS)
    variants = materialise(_variants(candidates), "line-variants")
    keys = variants.groupBy("key", "left").agg(F.count("*").alias("c")).where(F.col("c") > 1).drop("c")
    shared = variants.join(_sent(materialise(keys, "line-keys")), ["key", "left"], "left_semi")
    names = candidates.select("first", F.xxhash64("w").alias("line"), _line(F.col("first"), F.col("w")).alias("u"))
    shared = shared.join(names, "u").drop("u")
    found = materialise(_witnesses(materialise(shared, "line-shared")), "line-witnesses")
    words = candidates.select("first", F.xxhash64("w").alias("line"), "w")
    pairs = found.join(words, ["first", "line"]).join(words.select(F.col("first").alias("earlier"), F.col("w").alias("v")), "earlier")
    near = pairs.where(one_edit(F.col("w"), F.col("v"))).select(_name(F.array_join("w", " ")).alias("h")).distinct()
    near = materialise(near.withColumn("near", F.lit(True)), "line-near")
    decided = distinct.select("h", "first").join(_sent(near), "h", "left")
    return named.select("key", "place", "h").join(decided, "h").where((F.col("place") != F.col("first")) | F.col("near")).select("key", "place")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with n_lines, n_dropped and kept_text: the lines that stay, joined by line feeds."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    gone = dropped_lines(plain).groupBy("key").agg(F.collect_set("place.no").alias("gone"))
    gone = materialise(gone, "line-gone")
    new = ("n_lines", "n_dropped", "kept_text")
    key, lost = fresh(docs, "key"), fresh(docs, "gone")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col), text))
    # places of lost lines grow with the corpus: always a shuffled join
    joined = keyed.join(gone.select(F.col("key").alias(key), F.col("gone").alias(lost)), key, "left")
    lines = F.split(text, "\n", -1)
    stays = F.filter(lines, lambda _, i: ~F.array_contains(F.col(lost), i))
    count = F.size(lines).cast("bigint")
    none = F.col(lost).isNull()
    return joined.select(
        *kept,
        count.alias("n_lines"),
        F.when(none, F.lit(0)).otherwise(F.size(lost)).cast("bigint").alias("n_dropped"),
        F.when(none, text).otherwise(F.array_join(stays, "\n")).alias("kept_text"),
    )
