"""Plain versions of the corpus operators, one row at a time, that the tests hold the operators against."""

from __future__ import annotations

import re
from collections import defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def exact(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, bool]]:
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i))
    out = {}
    for members in groups.values():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep)
    return out


def repeats(rows: list[tuple[int, str | None]], width: int = 50) -> dict[int, bytes]:
    first: dict[bytes, int] = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for k in range(len(b) - width + 1):
            w = b[k : k + width]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, b in texts:
        gone = [False] * len(b)
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < i:
                gone[k : k + width] = [True] * width
        out[i] = bytes(c for c, g in zip(b, gone, strict=True) if not g)
    return out


def edits(a: list[str], b: list[str]) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def kept_lines(rows: list[tuple[int, str | None]], least: int = 5) -> dict[int, str]:
    seen: list[list[str]] = []
    out = {}
    for i, t in sorted(rows):
        keep = []
        for line in (t or "").split("\n"):
            w = WORD.findall(lower(line))
            if not w or not any(w == v or (min(len(w), len(v)) >= least and abs(len(w) - len(v)) < 2 and edits(w, v) <= 1) for v in seen):
                keep.append(line)
            if w:
                seen.append(w)
        out[i] = "\n".join(keep)
    return out


def shingles(text: str | None, n: int) -> frozenset:
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def classes(rows: list[tuple[int, str | None]], n: int, percent: int) -> dict[int, int]:
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def hits(text: str | None, items: list[tuple[int, str | None]], span: int = 10) -> tuple[int, int, list[str]]:
    w = ALNUM.findall(lower(text))
    mark, found = [0] * len(w), set()
    for i, t in items:
        v = ALNUM.findall(lower(t))
        n = min(span, len(v))
        windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k : k + n]) in windows:
                mark[k : k + n] = [1] * n
                found.add(str(i))
    return len(w), sum(mark), sorted(found)
