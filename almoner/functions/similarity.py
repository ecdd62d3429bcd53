"""Similarity of names: Jaro-Winkler and a phonetic key, as Arrow functions over distinct values of a batch."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, WEIGHT, BOOST_FROM = 4, 0.1, 0.7


def jaro_winkler_of(a: str, b: str) -> float:
    """Jaro similarity, raised for up to four equal first characters where it exceeds 0.7; 0 if nothing matches."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, mine = [False] * len(b), []
    for i, c in enumerate(a):
        j = b.find(c, max(0, i - reach), i + reach + 1)
        while j >= 0 and used[j]:
            j = b.find(c, j + 1, i + reach + 1)
        if j >= 0:
            used[j] = True
            mine.append(c)
    if not mine:
        return 0.0
    theirs = [c for c, u in zip(b, used, strict=True) if u]
    swapped = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    m = len(mine)
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro <= BOOST_FROM:
        return jaro
    same = 0
    for x, y in zip(a[:PREFIX], b[:PREFIX], strict=False):
        if x != y:
            break
        same += 1
    return jaro + same * WEIGHT * (1 - jaro)


@F.arrow_udf(T.DoubleType())
def jaro_winkler(a: pa.Array, b: pa.Array) -> pa.Array:
    known: dict[tuple, float | None] = {}
    out = []
    for pair in zip(a.to_pylist(), b.to_pylist(), strict=True):
        if pair not in known:
            known[pair] = None if None in pair else jaro_winkler_of(*pair)
        out.append(known[pair])
    return pa.array(out, pa.float64())


VOWELS = set("AEIOU")


def metaphone_of(word: str) -> str:
    """The 1990 Metaphone key of a word in capitals."""
    w = "".join(c for i, c in enumerate(word) if c.isalpha() and (c == "C" or i == 0 or word[i - 1] != c))
    if w[:2] in ("AE", "GN", "KN", "PN", "WR"):
        w = w[1:]
    elif w[:1] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    out = []
    at = lambda i: w[i] if 0 <= i < len(w) else ""
    for i, c in enumerate(w):
        after, before, two = at(i + 1), at(i - 1), w[i : i + 2]
        front = after in ("E", "I", "Y") and after != ""
        if c in VOWELS:
            out.append(c if i == 0 else "")
        elif c == "B":
            out.append("" if before == "M" and i == len(w) - 1 else "B")
        elif c == "C":
            if before == "S" and front:
                out.append("")
            elif w[i : i + 3] == "CIA" or (two == "CH" and before != "S"):
                out.append("X")
            else:
                out.append("S" if front else "K")
        elif c == "D":
            out.append("J" if after == "G" and at(i + 2) in ("E", "I", "Y") and at(i + 2) else "T")
        elif c == "G":
            silent = (after == "H" and i + 2 < len(w) and at(i + 2) not in VOWELS) or w[i:] in ("GN", "GNED") or (before == "D" and front)
            out.append("" if silent else "J" if front and before != "G" else "K")
        elif c == "H":
            out.append("H" if after in VOWELS and before not in ("C", "S", "P", "T", "G") else "")
        elif c == "K":
            out.append("" if before == "C" else "K")
        elif c == "P":
            out.append("F" if after == "H" else "P")
        elif c == "Q":
            out.append("K")
        elif c == "S":
            out.append("X" if after == "H" or w[i : i + 3] in ("SIO", "SIA") else "S")
        elif c == "T":
            out.append("X" if w[i : i + 3] in ("TIA", "TIO") else "0" if after == "H" else "" if w[i : i + 3] == "TCH" else "T")
        elif c == "V":
            out.append("F")
        elif c in "WY":
            out.append(c if after in VOWELS else "")
        elif c == "X":
            out.append("KS")
        elif c == "Z":
            out.append("S")
        else:
            out.append(c)
    return "".join(out)


@F.arrow_udf(T.StringType())
def phonetic_key(name: pa.Array) -> pa.Array:
    """The keys of the first two tokens, joined; null where there are none."""
    keys = {x: "".join(map(metaphone_of, (x or "").split(" ")[:2])) or None for x in set(name.to_pylist())}
    return pa.array([keys[x] for x in name.to_pylist()], pa.string())


def best_similarity(name: Column, sort_name: Column, alias: Column, candidate: Column) -> Column:
    """The greatest of the similarities; missing forms count as 0."""
    zero = F.lit(0.0)
    return F.greatest(
        jaro_winkler(candidate, name), F.coalesce(jaro_winkler(sort_name, name), zero),
        F.coalesce(jaro_winkler(candidate, alias), zero)
    )
