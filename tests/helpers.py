"""Small helpers: frames from literals, rows as sorted tuples."""

from __future__ import annotations

import datetime as dt
import random


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(type(v)), v) for v in t))


def close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is b
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))


def skewed_series(n_hot=3000, n_other=400, seed=7, gaps=0.4):
    """Rows (key, date, value): one key holds most rows, one is empty of values, one has a single row,
    one is the NULL key. Values are NULL with probability ``gaps``, and for more than a year in a row."""
    rng = random.Random(seed)
    start = dt.date(1990, 1, 1)
    out = []
    for key, n in (("hot", n_hot), ("b", n_other), (None, n_other), ("one", 1)):
        at = start
        for i in range(n):
            at += dt.timedelta(days=rng.choice([1, 1, 1, 2, 5]))
            hole = key == "hot" and 500 < i < 900
            out.append((key, at, None if hole or rng.random() < gaps else round(rng.uniform(-50, 50), 2)))
    out += [("void", start + dt.timedelta(days=i), None) for i in range(5)]
    rng.shuffle(out)
    return out


SERIES = "key STRING, date DATE, value DOUBLE"
