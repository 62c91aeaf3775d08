"""The Merkle manifest against a plain version, with odd rows."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from clustrata.llm import merkle, queries

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each node what stands left and right of it on every level."""
    places, ways = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, p in enumerate(places):
            lo = p // fanout * fanout
            ways[k].append(("".join(nodes[lo:p]), "".join(nodes[p + 1 : lo + fanout])))
        nodes = [H(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        places = [p // fanout for p in places]
    return nodes[0], ways


def plain(rows: list[tuple], fanout: int = 3) -> list[tuple]:
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, H(*map(field, r))))
        subs[s] = own, *tree([H(*map(field, r)) for r in own], fanout)
    root, ups = tree([subs[s][1] for s in names], fanout) if names else ("", [])
    out = []
    for s, up in zip(names, ups, strict=True):
        own, sub, ways = subs[s]
        for r, way in zip(own, ways, strict=True):
            told = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                told = (*r[:4], r[4].replace("\n", ""))
            at = H(*map(field, told))
            for left, right in [*way, *up]:
                at = H(left, at, right)
            out.append((r[0], H(*map(field, r)), sub, root, H("".join(x + y for x, y in [*way, *up])), at, at == root))
    return out


def run(df, **options):
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    found = merkle.verify(merkle.manifest(df, claimed={"text": F.when(even, F.translate("text", "\n", ""))}, **options))
    return [tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


ODD = [
    (1, "b", "en", 3, "a\nb"), (2, "b", "en", None, None), (3, None, None, None, None), (4, None, "de", 0, ""), (None, "b", "en", 1, "x"),
    (7, "é", "fr", 2, "\n"), (8, "Z", "en", 5, "tail\n"), (9, "", "en", 5, "same"), (9, "", "en", 5, "same"), (9, "", "en", 5, "other"), (11, "-", None, 1, "x"),
    *[(100 + i, "hot", "en", i, f"line {i}\nnext" * (i % 3)) for i in range(40)],
    (500, "long", "en", 1, "word \n" * 60_000),
]
key = lambda r: tuple(map(str, r))


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_against_plain(spark, fanout):
    df = spark.createDataFrame(ODD, SCHEMA).repartition(5)
    clash = df.withColumns({c: F.lit(1) for c in ("g", "id", "h", "idx", "n", "path", "part", "leaf", "root")})
    want = sorted(plain(ODD, fanout), key=key)
    assert sorted(run(clash, fanout=fanout), key=key) == want
    assert {r[-1] for r in want} == {True, False}


def test_few_rows(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    one = [(5, None, None, None, None)]
    assert run(spark.createDataFrame(one, SCHEMA)) == plain(one)
    assert run(spark.createDataFrame(one, SCHEMA))[0][4] == H("")


def test_counts_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "MOST_COUNTS", 0)
    assert sorted(run(spark.createDataFrame(ODD, SCHEMA)), key=key) == sorted(plain(ODD), key=key)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, queries.QUERIES["op11_merkle_manifest"](spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    assert got == sorted(con.sql(queries.SQL["op11_merkle_manifest"]).fetchall())
    rows = [tuple(r) for r in queries.table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert got == sorted(plain(rows))
