"""Brute-force versions of operators, for tests on small tables."""

from __future__ import annotations

import re


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, size: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def near_duplicates(rows: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, tuple[int, int, bool]]:
    """doc_id -> (n_shingles, component_id, kept), over all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index: dict = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    ids = sorted(sets)
    for n, a in enumerate(ids):
        common: dict = {}
        for x in sets[a]:
            for b in index[x]:
                if b > a:
                    common[b] = common.get(b, 0) + 1
        for b, c in common.items():
            if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}
