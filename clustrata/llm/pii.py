"""Personal data: generated candidate spans, boosted trees over format and context, calibrated thresholds. DataFrame functions only.

1. One pass over the texts (``pii-candidates``). For each kind a strict base rule and some
   looser generators mark their matches; generators overlap each other and the base on
   purpose: they find a card or telephone number that a greedy rule lost to the digits next
   to it, spelled-out addresses, other separators. A candidate keeps its place and a few
   characters around it; texts move no further.
2. Labels come from the rules: a valid base span that is not part of a longer word counts as
   personal data; whatever fails its kind's check (Luhn, octets, number of digits, top-level
   domain) or is glued to letters doesn't. A candidate of any other form is not learned from.
   A positive has a light twin that fails the check, for kinds that the corpus never contradicts.
3. Features are small whole numbers, so that all labelled candidates of the corpus fit into a
   table of distinct patterns with counts (``pii-patterns``). It is bounded by the features'
   ranges, not by the input, and misses nothing.
4. Gradient boosting on the patterns: two-level trees on the logistic loss, one for each kind
   and round. A level is one aggregate of gradients by (kind, node, feature, value); only such
   sums reach the driver. The fitted trees are a column expression.
5. Each kind's threshold is the lowest score from which held-out candidates (crc32 of the id,
   one in five) are right with ``PRECISION``. A kind without positive labels adds nothing.
6. Candidates above it that touch no base span are added; of overlapping ones the likeliest
   stays, then the more specific generator's. Base spans always stay.

Places are code points, end exclusive. Base patterns are written with possessive loops and
anchored starts, which match the same spans in linear time and without recursion.

Defined cases: null and empty texts have no spans; a null id is never held out; each row is
judged by itself, so repeated ids and texts give repeated rows; an empty table, or one
without any candidate, gives base spans only; other columns, whatever their names, take no
part (``find_pii``) or are handed on (``redact``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialise

KINDS = ("email", "ip", "card", "phone")
ROUNDS, RATE, RIDGE = 8, 0.6, 1.0
#: Share of right candidates above the threshold, and held-out positives without which all labelled ones calibrate.
PRECISION, LEAST_HELD = 0.98, 20
#: Characters kept before and behind a candidate.
BEFORE, BEHIND = 24, 8

#: Weight of a positive pattern's twin that fails the check, which makes a kind learnable where the corpus has no counterexample.
TWIN = 0.05

_MARK, _OTHER = "\x02", "\x03"
_LOCAL, _NAME = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_GAP = "[\\x20\\u00a0\\u2009./_-]"

#: Base rules by kind. A start inside a run of local characters or digits can only match where the run's start does.
BASE = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_NAME}++(?:\.{_NAME}++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text must hold for a generator to find anything, as quick tests: a pattern, or strings of which one is enough.
_PAIR, _RUN, _STOP, _OPEN = "[0-9][\x20-]?[0-9]", "[0-9]{3}", "[0-9]\\.[0-9]", ("(", "[", "{", "<")
BASE_NEEDS = (("@",), _STOP, _PAIR, ("+",))
_AT, _DOT = r"\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?", r"\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?"
#: Looser generators: (kind, need, pattern), the more specific first.
LOOSE = (
    (0, _OPEN, rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}{_AT}{_NAME}{{1,63}}(?:(?:{_DOT}|\.){_NAME}{{1,63}}){{1,4}}"),
    (0, (" dot ", " DOT "), rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}\x20(?:at|AT)\x20{_NAME}{{1,63}}(?:\x20(?:dot|DOT)\x20{_NAME}{{1,63}}){{1,4}}"),
    (1, _OPEN + (" dot ",), rf"(?<![0-9.]){_OCTET}(?:(?:\[\.\]|\(\.\)|\[dot\]|\x20dot\x20){_OCTET}){{3}}(?![0-9])"),
    (1, _STOP, rf"(?<![0-9])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9])"),
    (1, (":",), r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    (2, _RUN, rf"(?<![0-9])[0-9]{{4}}({_GAP})[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{4}}(?![0-9])"),
    (2, _RUN, rf"(?<![0-9])3[0-9]{{3}}({_GAP})[0-9]{{6}}\1[0-9]{{5}}(?![0-9])"),
    (2, _RUN, r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    (3, ("+",), r"\+1[\x20.-]?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])"),
    (3, ("+",), r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{1,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,4}(?![0-9])"),
    (3, _RUN, r"(?<![0-9+.(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    (3, ("00",), r"(?<![0-9+.-])00[1-9][0-9]{0,2}(?:[\x20-]?[0-9]{2,5}){2,4}(?![0-9])"),
)

#: Words before a candidate that speak for its kind, and those that speak against any.
CUES = (
    r"(?i)mail|contact|write|schreib|correo|courriel",
    r"(?i)\bip\b|host|server|addr|client|gateway",
    r"(?i)card|visa|amex|credit|karte|tarjeta|carte|payment",
    r"(?i)tel|phone|call|mobil|fax|cell|llam|appel|ruf",
)
AGAINST = r"(?i)version|release|token|password|secret|key|sha|md5|hash|uuid|serial|invoice|order|isbn|\bref\b|\bid\b"
FEATURES = ("valid", "digits", "groups", "gaps", "lead", "trail", "cue", "against", "head", "spread", "width")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once although it is used in loops."""
    return F.transform(F.array(value), body)[0]


def holds(text: Column, need: str | Sequence[str]) -> Column:
    """Whether a text has what a generator needs."""
    if isinstance(need, str):
        return text.rlike(need)
    out = F.lit(False)
    for part in need:
        out = out | F.contains(text, F.lit(part))
    return out


def matches(text: Column, pattern: str, need: Column) -> Column:
    """array<struct<start, s, pre, post>> of a pattern's matches; ``text`` doesn't hold the mark."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)
    add = lambda a, b: a + b
    block = 64  # starts are sums of whole blocks of pieces and of those before in the own block

    def rows(p: Column, lens: Column, sums: Column) -> Column:
        before = F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), add))

        def one(i: Column, before: Column) -> Column:
            at = F.floor(i / block).cast("int")
            start = before[at] + F.aggregate(F.slice(lens, at * block + 1, i % block), F.lit(0), add)
            pre = F.right(F.concat(F.when(i > 2, p[i - 2]).otherwise(""), p[i - 1]), F.lit(BEFORE))
            return F.struct(start.alias("start"), p[i].alias("s"), pre.alias("pre"), F.left(p[i + 1], F.lit(BEHIND)).alias("post"))

        return _let(before, lambda b: F.transform(F.sequence(F.lit(1), F.size(p) - 1, F.lit(2)), lambda i: one(i, b)))

    def found(p: Column) -> Column:
        def counted(lens: Column) -> Column:
            blocks = F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / block).cast("int"))
            return _let(F.transform(blocks, lambda b: F.aggregate(F.slice(lens, b * block + 1, F.lit(block)), F.lit(0), add)), lambda sums: rows(p, lens, sums))

        return F.when(F.size(p) > 1, _let(F.transform(p, F.char_length), counted))

    none = F.array().cast("array<struct<start:int,s:string,pre:string,post:string>>")
    return F.coalesce(F.when(need, _let(pieces, found)), none)


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def passes(kind: int, s: Column) -> Column:
    """Whether a match of a kind's base rule holds."""
    if kind == 0:
        return s.isNotNull()
    if kind == 1:
        return s.rlike(rf"^(?:0*{_OCTET}\.){{3}}0*{_OCTET}$")
    return _let(digits_of(s), lambda d: F.char_length(d).between(13, 19) & F.call_function("luhn_check", d) if kind == 2 else F.char_length(d).between(9, 15))


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, id, base, loose): each row's valid base spans and all candidates with what surrounds them."""
    whole = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    plain = F.when(F.contains(whole, F.lit(_MARK)), F.translate(whole, _MARK, _OTHER)).otherwise(whole)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"), plain.alias("t"))
    generators = [(k, 0, need, p) for k, (need, p) in enumerate(zip(BASE_NEEDS, BASE, strict=True))] + [(k, g, need, p) for g, (k, need, p) in enumerate(LOOSE, 1)]
    asked = list(dict.fromkeys(need for _, _, need, _ in generators))
    rows = rows.select("*", *[holds(F.col("t"), need).alias(f"has{i}") for i, need in enumerate(asked)])

    def tagged(kind: int, gen: int, need: str | Sequence[str], pattern: str) -> Column:
        ok = lambda m: passes(kind, m["s"]) if gen == 0 else F.lit(False)
        found = matches(F.col("t"), pattern, F.col(f"has{asked.index(need)}"))
        return F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), F.lit(gen).alias("gen"), m["start"].alias("start"), m["s"].alias("s"), m["pre"].alias("pre"), m["post"].alias("post"), ok(m).alias("ok")))

    rows = rows.select("rid", "id", F.concat(*[tagged(*g) for g in generators]).alias("found"))
    base = F.transform(F.filter("found", lambda m: m["ok"]), lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), (m["start"] + F.char_length(m["s"])).alias("end")))
    # written once: from here on a row's number is fixed
    return materialise(rows.select("rid", "id", F.array_sort(base).alias("base"), "found"), "pii-candidates")


def _side(c: Column) -> Column:
    """What a neighbouring character is: nothing or space, letter, digit, stop, sign of assignment or path, other."""
    return F.when((c == "") | c.rlike(r"^\s"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike("^[.,:;!?)(]"), 3).when(c.rlike("^[=/_\"'#+-]"), 4).otherwise(5)


def featured(found: DataFrame) -> DataFrame:
    """(rid, id, kind, gen, start, end, ok, features): the candidates of ``candidates``, one a row."""
    rows = found.select("rid", "id", F.inline("found")).withColumns({"end": F.col("start") + F.char_length("s"), "d": digits_of(F.col("s")), "rest": F.regexp_replace("s", "[A-Za-z0-9]", "")})
    plain = F.regexp_replace(F.regexp_replace("s", rf"{_AT}|\x20(?:at|AT)\x20", "@"), rf"{_DOT}|\x20(?:dot|DOT)\x20", ".")
    n = F.char_length("d")
    address = plain.rlike(rf"^(?:0*{_OCTET}\.){{3}}0*{_OCTET}$") | plain.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$")
    valid = F.when(F.col("kind") == 0, plain.rlike(rf"^{_LOCAL}{{1,64}}@(?:{_NAME}{{1,63}}\.){{1,8}}[A-Za-z]{{2,24}}$")).when(F.col("kind") == 1, address)
    valid = valid.when(F.col("kind") == 2, n.between(13, 19) & F.call_function("luhn_check", F.col("d"))).otherwise(n.between(9, 15))
    cue = F.when(F.col("kind") == 0, F.col("pre").rlike(CUES[0]))
    for k in (1, 2, 3):
        cue = cue.when(F.col("kind") == k, F.col("pre").rlike(CUES[k]))
    gaps = F.when(F.col("rest") == "", 0)
    for i, p in enumerate((r"^\s+$", "^-+$", r"^\.+$", r"^[@.-]+$", r"^[+\s()-]+$"), 1):
        gaps = gaps.when(F.col("rest").rlike(p), i)
    made = {
        "valid": F.coalesce(valid, F.lit(False)).cast("int"),
        "digits": F.least(n, F.lit(24)),
        "groups": F.least(F.regexp_count("s", F.lit("[0-9]+")), F.lit(9)),
        "gaps": gaps.otherwise(6),
        "lead": _side(F.right(F.col("pre"), F.lit(1))),
        "trail": _side(F.left(F.col("post"), F.lit(1))),
        "cue": F.coalesce(cue, F.lit(False)).cast("int"),
        "against": F.col("pre").rlike(AGAINST).cast("int"),
        "head": F.coalesce(F.left("d", F.lit(1)).try_cast("int"), F.lit(0)),
        "spread": F.size(F.array_distinct(F.split("d", ""))),
        "width": F.least(F.floor(F.char_length("s") / 4), F.lit(12)).cast("int"),
    }
    return rows.select("rid", "id", "kind", "gen", "start", "end", "ok", *[made[f].cast("int").alias(f) for f in FEATURES])


def patterns(rows: DataFrame) -> DataFrame:
    """(kind, features, held, y, w): distinct labelled candidates and how many there are."""
    glued = ((F.col("lead") == 1) | (F.col("trail") == 1)) & (F.col("kind") > 0)
    y = F.when((F.col("valid") == 0) | glued, 0).when((F.col("gen") == 0) & F.col("ok"), 1)
    held = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    counted = rows.withColumns({"y": y, "held": held}).where("y is not null").groupBy("kind", *FEATURES, "held", "y").agg(F.count("*").cast("double").alias("w"))
    twins = F.when(F.col("y") == 1, F.array(F.struct(F.col("valid"), F.col("y"), F.col("w")), F.struct(F.lit(0).alias("valid"), F.lit(0).alias("y"), (F.col("w") * TWIN).alias("w")))).otherwise(F.array(F.struct("valid", "y", "w")))
    return counted.select("kind", *[f for f in FEATURES if f != "valid"], "held", F.inline(twins))


Leaf = float
Tree = tuple  # (feature, cut, left, right), each side a tree or a number


def _column(tree: Tree | Leaf) -> Column:
    if isinstance(tree, tuple):
        feature, cut, left, right = tree
        return F.when(F.col(feature) <= cut, _column(left)).otherwise(_column(right))
    return F.lit(float(tree))


def score(trees: dict[int, list[Tree | Leaf]]) -> Column:
    """The probability of a candidate row."""
    margin = F.lit(0.0)
    for kind, own in trees.items():
        total = F.lit(0.0)
        for tree in own:
            total = total + _column(tree)
        margin = F.when(F.col("kind") == kind, total).otherwise(margin)
    return 1 / (1 + F.exp(-margin))


def _best(sums: list[tuple[str, int, float, float]]) -> tuple[str, int, tuple[float, float], tuple[float, float]] | None:
    """The feature and cut with the largest gain, and the sums of both sides."""
    by: dict[str, list] = {}
    for f, v, g, h in sums:
        by.setdefault(f, []).append((v, g, h))
    best = None
    for f in FEATURES:
        own = sorted(by.get(f, []))
        whole_g, whole_h, g, h = sum(x[1] for x in own), sum(x[2] for x in own), 0.0, 0.0
        for v, dg, dh in own[:-1]:
            g, h = g + dg, h + dh
            gain = g * g / (h + RIDGE) + (whole_g - g) ** 2 / (whole_h - h + RIDGE) - whole_g**2 / (whole_h + RIDGE)
            if round(gain, 6) > (best[0] if best else 1e-6):  # ties go to the earlier feature and cut
                best = (round(gain, 6), f, v, (g, h), (whole_g - g, whole_h - h))
    return best[1:] if best else None


def fit(table: DataFrame) -> dict[int, list[Tree | Leaf]]:
    """Boosted trees of each kind from the patterns that are not held out."""
    learn = table.where(~F.col("held"))
    trees: dict[int, list[Tree | Leaf]] = {}
    leaf = lambda s: round(-RATE * s[0] / (s[1] + RIDGE), 6)

    def sums(node: Column) -> dict[tuple[int, int], list]:
        p = score(trees)
        rows = learn.select("kind", node.alias("node"), (F.col("w") * (p - F.col("y"))).alias("g"), (F.col("w") * p * (1 - p)).alias("h"), F.inline(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in FEATURES])))
        out: dict[tuple[int, int], list] = {}
        # at most kinds x nodes x features x values rows
        for r in rows.groupBy("kind", "node", "f", "v").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            out.setdefault((r["kind"], r["node"]), []).append((r["f"], r["v"], r["g"], r["h"]))
        return out

    for _ in range(ROUNDS):
        roots = {kind: _best(rows) for (kind, _), rows in sums(F.lit(0)).items()}
        if not any(roots.values()):
            break
        side = F.lit(0)
        for kind, cut in roots.items():
            if cut:
                side = F.when(F.col("kind") == kind, (F.col(cut[0]) > cut[1]).cast("int")).otherwise(side)
        below = sums(side)
        for kind, cut in roots.items():
            if cut:
                halves = []
                for node in (0, 1):
                    deeper = _best(below.get((kind, node), []))
                    halves.append((deeper[0], deeper[1], leaf(deeper[2]), leaf(deeper[3])) if deeper else leaf(cut[2 + node]))
                trees.setdefault(kind, []).append((cut[0], cut[1], *halves))
    return trees


def calibrate(table: DataFrame, trees: dict[int, list[Tree | Leaf]]) -> dict[int, float]:
    """Each kind's lowest score from which candidates are right with PRECISION; no entry for kinds without positives."""
    bins = table.groupBy("kind", "held", F.floor(score(trees) * 200).cast("int").alias("bin")).agg(F.sum(F.col("w") * F.col("y")).alias("hit"), F.sum("w").alias("w")).collect()
    out = {}
    for kind in trees:
        own = [r for r in bins if r["kind"] == kind]
        held = [r for r in own if r["held"]]
        use = held if sum(r["hit"] for r in held) >= LEAST_HELD else own
        hit = total = 0.0
        for b in sorted({r["bin"] for r in use if r["bin"] >= 100}, reverse=True):
            hit, total = hit + sum(r["hit"] for r in use if r["bin"] == b), total + sum(r["w"] for r in use if r["bin"] == b)
            if hit and hit >= PRECISION * total:
                out[kind] = b / 200
    return out


def chosen(rows: DataFrame, base: DataFrame) -> DataFrame:
    """(rid, added): of the likely candidates those that touch no base span, without overlaps.

    rows: (rid, kind, gen, start, end, p); base: (rid, start, end) of the same rows.
    """
    span = ["rid", "start", "end"]
    both = rows.select(*span, "kind", "gen", "p", F.lit(False).alias("fixed")).unionByName(base.select(*span, F.lit(True).alias("fixed")), allowMissingColumns=True)
    order = Window.partitionBy("rid").orderBy("start", "end", "fixed", "gen", "kind")
    past, next_ = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    touched = both.withColumns({"b": F.max(F.when(F.col("fixed"), F.col("end"))).over(past), "a": F.min(F.when(F.col("fixed"), F.col("start"))).over(next_)})
    free = touched.where(~F.col("fixed") & (F.coalesce(F.col("b"), F.lit(0)) <= F.col("start")) & (F.col("a").isNull() | (F.col("a") >= F.col("end")))).drop("a", "b", "fixed")
    # runs of overlapping candidates; in a run the likeliest first, then the more specific generator's
    order = Window.partitionBy("rid").orderBy("start", "end", "gen", "kind")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    run = free.withColumn("b", F.max("end").over(past)).withColumn("new", (F.coalesce("b", F.lit(0)) <= F.col("start")).cast("int")).withColumn("run", F.sum("new").over(order))
    ranked = F.array_sort(F.collect_list(F.struct((-F.round("p", 2)).alias("p"), "gen", "start", "end", "kind")))
    runs = run.groupBy("rid", "run").agg(ranked.alias("r"))
    none = F.array().cast("array<struct<p:double,gen:int,start:int,end:int,kind:int>>")
    kept = F.aggregate("r", none, lambda acc, x: F.when(F.exists(acc, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])), acc).otherwise(F.concat(acc, F.array(x))))
    return runs.select("rid", F.inline(kept)).groupBy("rid").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): array<struct<kind, start, end>> by kind as in KINDS, then place."""
    found = candidates(docs, id_col, text_col)
    rows = materialise(featured(found), "pii-features")
    table = materialise(patterns(rows), "pii-patterns")
    trees = fit(table)
    cuts = calibrate(table, trees)
    least = F.lit(None).cast("double")
    for kind, cut in cuts.items():
        least = F.when(F.col("kind") == kind, cut).otherwise(least)
    likely = rows.where(F.col("gen") > 0).withColumn("p", score(trees)).where(F.col("p") >= least).select("rid", "kind", "gen", "start", "end", "p")
    likely = materialise(likely, "pii-likely")
    base = found.select("rid", F.inline("base")).join(likely.select("rid").distinct(), "rid", "left_semi")
    out = found.select("rid", "id", "base").join(chosen(likely, base), "rid", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>"))))
    named = lambda c: F.transform(c, lambda s: F.struct(F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select(F.col("id").alias(id_col), named(F.col("base")).alias("base"), named(spans).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each span of ``find_pii`` replaced by its kind in brackets; ids must be unique, rows of unknown ids stay as they are."""
    spans, key, chars = (fresh(docs, x) for x in ("spans", "key", "chars"))
    own = found.select(F.col(id_col).alias(key), F.col("spans").alias(spans))
    both = docs.join(own, F.col(f"`{id_col}`") == F.col(key), "left").withColumn(spans, F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))
    text = F.col(f"`{text_col}`")

    def cut(c: Column) -> Column:
        # spans of different kinds may overlap: each piece begins where the spans before have ended
        steps = F.aggregate(
            spans,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
            lambda acc, s: F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(F.array_join(F.slice(c, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), ""), F.when(s["end"] > acc["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(""))).alias("out")),
        )
        return _let(steps, lambda s: F.concat(F.array_join(s["out"], ""), F.array_join(F.slice(c, s["at"] + 1, F.size(c)), "")))

    new = F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, _let(F.split(text, ""), cut)).otherwise(text)
    return both.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
