"""Personal data: base spans against plain regular expressions, added spans on planted cases, odd rows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from clustrata.llm import pii, queries

SCHEMA = "doc_id bigint, text string"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d: str) -> bool:
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def holds(kind: str, s: str) -> bool:
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in s.split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def base(text: str | None) -> list[tuple[str, int, int]]:
    return [(k, m.start(), m.end()) for k, p in RULES.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


def card(rng: random.Random) -> str:
    head = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(head + c for c in "0123456789" if luhn(head + c))


ODD = [
    None, "", "\x02\x02 a@b.co \x02", "a@b.c_d@e.f", "x@y", "é.a@b.de and +49 (30) 1234567.", "300.1.2.3.4 1.2.3.4.5.6.7.8.9 001.002.003.004 256.1.1.1", "4111 1111-1111 1111", "4111  1111 1111 1111",
    "+1 " + " " * 50 + "2 +12 +123 +1234567890123456", "𝒳𝒳 user@mail.example.com 𝒳", "a.b@" + "c." * 20_000 + "de", "9" * 40_000, "1 " * 30_000, "a" * 50_000 + "@x.y", "..@-.-", "7-" * 30_000,
    "u@v.w " * 3_000,
]


def test_base_spans(spark):
    rng = random.Random(3)
    alphabet = ["@", ".", "+", "-", " ", "(", ")", "a", "Z", "_", "%", "é", "𝒳", "\n", "\x02", *"0123456789", "255", "1.2.3.4", "+1 (", "4111111111111111"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 160))) for _ in range(400)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([*rows, (5, "again a@b.cd"), (None, "no id a@b.cd")], SCHEMA).withColumns({c: F.lit(1) for c in ("rid", "id", "found", "start", "base", "kind")})
    got = [(r["doc_id"], [tuple(s) for s in r["base"]], [tuple(s) for s in r["spans"]]) for r in pii.find_pii(df).collect()]
    want = sorted([*((i, base(t)) for i, t in rows), (5, base("again a@b.cd")), (None, base("no id a@b.cd"))], key=repr)
    assert sorted(((i, b) for i, b, _ in got), key=repr) == want
    for _, b, spans in got:  # base spans stay, added ones touch nothing
        added = [s for s in spans if s not in b]
        assert set(b) <= set(spans) and spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert not any(x is not y and x[1] < y[2] and y[1] < x[2] for x in added for y in spans)


@pytest.fixture(scope="module")
def planted():
    """Clean prose with personal data the base rules find, and some that they lose to what stands beside it."""
    rng = random.Random(9)
    words = "the of and a meeting was held near garden where version report people came early".split()
    prose = lambda: " ".join(rng.choice(words) for _ in range(12))
    rows, lost = [], {}
    for i in range(600):
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(10000):04d}"
        ip, c = ".".join(str(rng.randrange(1, 255)) for _ in range(4)), card(rng)
        if i % 30 == 7:
            text, at, kind = f"{prose()} {ip} ", c, "card"
        elif i % 30 == 8:
            text, at, kind = f"{prose()} ", phone, "phone"
        elif i % 30 == 9:
            text, at, kind = f"{prose()} pay by card ", ".".join(c[k : k + 4] for k in (0, 4, 8, 12)), "card"
        elif i % 30 == 10:
            text, at, kind = f"{prose()} ", f"user{i} (at) mail.example.com", "email"
        elif i % 30 == 11:
            text, at, kind = f"{prose()} ", f"user{i} at mail dot example dot com", "email"
        elif i % 30 == 12:
            text, at, kind = f"{prose()} ", ip.replace(".", "[.]"), "ip"
        else:
            one = [f"user.{i}@mail{i % 7}.example.com", ip, c, phone, "version 1.2.3", f"{rng.randrange(10**15, 10**16)}", 'token = "' + hashlib.sha1(str(i).encode()).hexdigest() + '"', "sent 2024-01-15 at 10.30"][i % 8]
            rows.append((i, f"{prose()} {one} {prose()}"))
            continue
        lost[i] = (kind, len(text), len(text) + len(at))
        rows.append((i, text + at + (f" {c}" if kind == "phone" else "") + f" {prose()}"))
    return rows, lost


def test_added_spans(spark, planted):
    rows, lost = planted
    got = {r["doc_id"]: ([tuple(s) for s in r["base"]], [tuple(s) for s in r["spans"]]) for r in pii.find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(b == base(t) for (_, t), (b, _) in zip(rows, (got[i] for i, _ in rows), strict=True))
    found = [i for i, s in lost.items() if s in got[i][1] and s not in got[i][0]]
    assert len(found) >= 0.9 * len(lost)
    wrong = [i for i, (b, spans) in got.items() if i not in lost and set(spans) - set(b)]
    assert len(wrong) <= 0.01 * len(rows)


def test_trees_decide(spark, planted):
    """The fitted column expression gives what the trees say, and separates held-out labels."""
    rows, _ = planted
    table = pii.patterns(pii.featured(pii.candidates(spark.createDataFrame(rows, SCHEMA), "doc_id", "text"))).cache()
    trees = pii.fit(table)
    assert trees and all(len(t) <= pii.ROUNDS for t in trees.values())

    def walk(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    import math

    right = total = 0.0
    for r in table.withColumn("p", pii.score(trees)).collect():
        assert r["p"] == pytest.approx(1 / (1 + math.exp(-sum(walk(t, r) for t in trees.get(r["kind"], [])))))
        if r["held"]:
            right, total = right + r["w"] * ((r["p"] >= 0.5) == (r["y"] == 1)), total + r["w"]
    assert set(trees) == {0, 1, 2, 3} and total and right >= 0.97 * total
    table.unpersist()


def test_redact(spark):
    rows = [(1, "mail a@b.cd or +1 (202) 555-0101!"), (2, None), (3, "nothing"), (4, "𝒳 1.2.3.4")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("spans", F.lit(7))
    out = {r["doc_id"]: (r["text"], r["spans"]) for r in pii.redact(docs, pii.find_pii(docs)).collect()}
    assert out == {1: ("mail [email] or [phone]!", 7), 2: (None, 7), 3: ("nothing", 7), 4: ("𝒳 [ip]", 7)}


def test_empty(spark):
    assert pii.find_pii(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r["spans"] for r in pii.find_pii(spark.createDataFrame([(1, "no data here")], SCHEMA)).collect()] == [[]]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, sf, "documents").collect()}
    got = queries.QUERIES["op12_pii"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        want = base(texts[r["doc_id"]])
        named = [f"{k}:{a}:{b}" for k, a, b in want]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r["spans"].split(",")) | {""} if named else True
