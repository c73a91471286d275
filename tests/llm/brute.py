"""Plain Python versions that the operators are held against."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np

WORD = "[^\x20\x09-\x0d]+"

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+",
       "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                  "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}
            if ok[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def components(n: int, links) -> list[int]:
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(out.values())
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > cap * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in open_}
        out |= {s: cap * sizes[s] for s in full}
        open_ -= full
    return out


def lcs(a, b) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def word_shingles(text: str | None) -> list[tuple]:
    w = (text or "").lower().split()
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def aligned(a: list, b: list) -> float:
    """Similarity of two shingle sequences; 1 for two empty ones."""
    if not a and not b:
        return 1.0
    if sum((Counter(a) & Counter(b)).values()) < 0.79 * max(len(a), len(b)):
        return 0.0
    m = lcs(a, b)
    return m / (len(a) + len(b) - m)


def jaccard(a: Counter, b: Counter) -> float:
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def word_pairs(text: str) -> Counter:
    w = re.findall(WORD, text)
    return Counter(zip([""] + w, w + [""])) if w else Counter()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def edits(a: str, b: str) -> int:
    """Optimal string alignment distance."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def lm_tokens(text: str | None) -> list[str]:
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(WORD, text or "")] + ["\0"]


def unit_links(rows, cosine=0.93):
    """Pairs (i, j) of rows (id, vector, label) that link."""
    def usable(v, label):
        return (label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)
                and any(v))
    out = []
    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            w, b = rows[j][1:]
            if usable(v, a) and usable(w, b) and a == b and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    out.append((j, i))
    return out
