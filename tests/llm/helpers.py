"""Small tables and brute-force answers that the operators are held against."""

from __future__ import annotations

import os
from collections import Counter, defaultdict

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(table: str, columns: str, order: str) -> list[tuple]:
    return duckdb.sql(f"select {columns} from '{SF_DIR}/{table}.parquet' order by {order}").fetchall()


def shingles(text: str | None, length: int) -> set[tuple]:
    found = (text or "").encode().lower().split()
    if len(found) >= length:
        return {tuple(found[i : i + length]) for i in range(len(found) - length + 1)}
    return {tuple(found)} if found else set()


def components(documents: list[tuple[int, str | None]], length: int, percent: int = 80) -> dict[int, int]:
    """Smallest id reachable over all links, by comparing all pairs that share a shingle."""
    sets = {d: shingles(t, length) for d, t in documents}
    holders, parent = defaultdict(list), {d: d for d in sets}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for d in sorted(sets):
        shared = Counter(e for s in sets[d] for e in holders[s])
        for s in sets[d]:
            holders[s].append(d)
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: root(d) for d in sets}


def cut_repeats(documents: list[tuple[int, str | None]], window: int) -> dict[int, tuple[int, list[str]]]:
    """Per document: its number of words, and the words left."""
    seen, out = set(), {}
    for d, text in sorted(documents):
        found = [w.decode() for w in (text or "").encode().split()]
        covered = [False] * len(found)
        for i in range(len(found) - window + 1):
            key = tuple(found[i : i + window])
            if key in seen:
                covered[i : i + window] = [True] * window
            seen.add(key)
        out[d] = len(found), [w for w, c in zip(found, covered, strict=True) if not c]
    return out


def edit_distance_within(item: str, text: str) -> int:
    """Least edits between the item and any stretch of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (c != d)))
        row = now
    return min(row)
