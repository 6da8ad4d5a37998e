"""Plain one-row-at-a-time versions that the operators are checked against."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def rule_counts(text):
    text = text or ""
    w = words(text)
    wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = Counter(wins)
    covered = {j for i, x in enumerate(wins) if seen[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), n < 20 or 100 * len(covered) > 30 * n)


def water_fill(sizes, weights=(1, 2, 3), passes=3):
    """{source: size} -> {source: target}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        if not rest:
            return fixed
        share = {s: (total - sum(fixed.values())) * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > passes * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: passes * sizes[s] for s in over}
