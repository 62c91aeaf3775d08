"""URL filter: a weighted vocabulary counted by an Aho-Corasick automaton, below host rules.

A url is judged by the longest (host, path) rule that fits; where none fits, the automaton
finds vocabulary terms in the whole lower-cased url. A hit counts only between boundaries
(no ASCII letter or digit beside it). One strict term, or ``SOFT_LIMIT`` distinct soft terms,
block. Parsing and rules are DataFrame expressions; only the automaton runs in Arrow batches,
one url at a time, with memory bounded by the vocabulary.

Defined cases: null or a url without ``://`` has empty host and path and is allowed unless
its text holds the terms; an empty url is allowed; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import plus

# The vocabulary, one weight class each.
STRICT = """porn porno xxx hentai casino casinos viagra cialis escort escorts camgirl camgirls milf
sexcam pornhub malware phishing warez keygen gambling""".split()
SOFT = """adult ads advert adverts bet bets betting bingo bonus cheap clickbait coupon coupons crack
dating discount escrow free forex jackpot loan loans lottery meds nude offer offers payday pharmacy pill
pills poker popup promo prize replica sex sexy slots spam track tracker tracking win winner winning""".split()
SOFT_LIMIT = 2

#: (verdict, host, path)
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host/path``, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, where, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(where + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


class Vocabulary:
    """Counts the strict and the distinct soft terms of a text."""

    def __init__(self, strict: list[str] = STRICT, soft: list[str] = SOFT, soft_limit: int = SOFT_LIMIT):
        self.soft_limit = soft_limit
        self.found = ahocorasick.Automaton()
        weights = {t.lower(): 1 for t in soft} | {t.lower(): soft_limit for t in strict}
        for term, weight in weights.items():
            if term:
                self.found.add_word(term, (term, weight))
        self.empty = not len(self.found)
        if not self.empty:
            self.found.make_automaton()

    def weight(self, url: str | None) -> int:
        """Summed weight of the distinct terms that stand between boundaries."""
        text = (url or "").lower()
        if self.empty or not text:
            return 0
        seen = {}
        for end, (term, weight) in self.found.iter(text):
            a, b = end - len(term), end + 1
            if (a < 0 or not _joins(text[a])) and (b == len(text) or not _joins(text[b])):
                seen[term] = weight
        return sum(seen.values())

    def blocks(self, url: str | None) -> bool:
        return self.weight(url) >= self.soft_limit


def _joins(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def url_filter(pages: DataFrame, rules: list[Rule] = (), url_col: str = "url", strict: list[str] = STRICT, soft: list[str] = SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """The rows of ``pages`` with host, path, rule, url_weight and verdict (allow or block).

    Columns of these names in the input are replaced.
    """
    new = ("host", "path", "rule", "url_weight", "verdict")
    keep = [c for c in pages.columns if c.lower() not in new]
    url = F.col(f"`{url_col}`").cast("string")
    rule, verdict = rule_of(F.col("host"), F.col("path"), list(rules))
    named = pages.select(*[F.col(f"`{c}`") for c in keep], host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = named.withColumns({"rule": rule, "verdict": verdict})
    schema = plus(ruled.schema, url_weight="int")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(list(strict), list(soft), soft_limit)
        for batch in batches:
            weights = [words.weight(u) for u in batch.column(url_at).cast(pa.string()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights, pa.int32())], names=[*batch.schema.names, "url_weight"])

    url_at = ruled.columns.index(url_col)
    scanned = ruled.mapInArrow(scan, schema)
    own = F.when(F.col("url_weight") >= soft_limit, "block").otherwise("allow")
    return scanned.withColumn("verdict", F.coalesce("verdict", own))
