"""Rows that no operator may stumble over, and brute-force versions to hold results against."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bits string, kept string, label string"
LONG = "word " * 3 + " ".join(f"w{i} end." for i in range(30_000))
BASE = " ".join(f"tok{i}" for i in range(120))


def rows() -> list[tuple]:
    texts = [None, "", " ", "\n", BASE, BASE, BASE + " tail", "one two", "One Two", "a" * 5000, LONG, "漢字 Ελλάδα 😀 é",
             "!!! *** $$$", "x\0y  z\t\x0b\r\n", BASE.replace("tok60", "changed")]
    out = [(i, t, "en" if i % 2 else None, "s", None if t is None else len(t), "b", "k", "l") for i, t in enumerate(texts)]
    return out + [out[4], out[4], (None, BASE, "en", None, 1, None, None, None), (None, None, None, None, None, None, None, None)]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text: str | None) -> frozenset:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or (frozenset({tuple(w)}) if w else frozenset())


def components(texts: dict[int, str | None]) -> dict[int, int]:
    """The smallest id reachable over links of likeness 0.75, by comparing all pairs that share a shingle."""
    sets = {k: shingles(t) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index: dict = {}
    for k in sorted(sets):
        for other in {o for s in sets[k] for o in index.get(s, ())}:
            both = len(sets[k] & sets[other])
            if 100 * both >= 75 * (len(sets[k]) + len(sets[other]) - both):
                a, b = sorted((find(k), find(other)))
                parent[b] = a
        for s in sets[k]:
            index.setdefault(s, []).append(k)
    return {k: find(k) for k in sets}
