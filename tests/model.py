"""Plain Python versions of the ranking operators, by their definitions."""

from __future__ import annotations

import math
from itertools import accumulate

from liftspark.operators.gain import GAIN_EDGES

def half_up(x: float, digits: int = 4) -> float:
    return math.floor(x * 10**digits + 0.5) / 10**digits


def ranked(rows):
    """(id, score, label) by score descending, then id."""
    return sorted(rows, key=lambda r: (-r[1], r[0]))


def gains(rows, edges=GAIN_EDGES):
    """Running counts of responders, read off at the rank of each edge."""
    order, n = ranked(rows), len(rows)
    running = [0, *accumulate(r[2] for r in order)]
    cuts = [0, *(math.ceil(e * n) for e in edges)]

    def columns(size, responders):
        gain = responders / running[-1]
        if not size:
            return [size, responders, None, half_up(gain), None]
        return [size, responders, half_up(responders / size), half_up(gain), half_up(gain * (n / size))]

    return [
        (e, *columns(to - start, running[to] - running[start]), *columns(to, running[to]))
        for e, start, to in zip(edges, cuts, cuts[1:])
    ]


def auc(rows):
    pos = [r[1] for r in rows if r[2] == 1]
    neg = [r[1] for r in rows if r[2] == 0]
    won = sum(2 if p > q else 1 if p == q else 0 for p in pos for q in neg)
    return won / (2 * len(pos) * len(neg))


def thresholds(rows):
    """(threshold, tp, fp, pos) by descending score."""
    out = []
    for t in sorted({r[1] for r in rows}, reverse=True):
        above = [r for r in rows if r[1] >= t]
        out.append((t, sum(r[2] for r in above), sum(1 - r[2] for r in above), sum(r[2] for r in above if r[1] == t)))
    return out


def quantile(values, p):
    s = sorted(values)
    place = p * (len(s) - 1)
    low = math.floor(place)
    high = min(low + 1, len(s) - 1)
    return s[low] + (s[high] - s[low]) * (place - low)
