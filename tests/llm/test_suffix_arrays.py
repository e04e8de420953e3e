"""Suffix-array dedup against plain sorting and plain windows."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import suffix_arrays as sa


def test_suffix_array_is_sorted(monkeypatch):
    rng = np.random.default_rng(1)
    for trial in range(300):
        monkeypatch.setattr(sa, "SMALL_ALPHABET", 512 if trial % 2 else 0)
        s = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(0, 60)), 0)
        assert sa.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    periodic = np.append(np.tile([2, 1, 2, 2], 500), 0)
    assert sa.suffix_array(periodic).tolist() == sorted(range(len(periodic)), key=lambda i: periodic[i:].tolist())


def test_permuted_prefixes():
    rng = np.random.default_rng(2)
    for most in (1, 8, 40):
        part = rng.integers(97, 99, 150).astype(np.uint8)
        data = np.concatenate([part, part, rng.integers(97, 123, 60).astype(np.uint8), [0]]).astype(np.uint8)
        order = sa.suffix_array(data.astype(np.int64))
        got = sa.permuted_prefixes(data, order, most)
        for before, at in zip(order, order[1:]):
            x, y = bytes(data[before:]), bytes(data[at:])
            same = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
            assert got[at] == min(same, most)


def plain(rows, window):
    """Per row: removed spans by comparing all windows; documents in order of (id, rank of the text)."""
    seen, removed = set(), {}
    for key, text in sorted({(k, t) for k, t in rows if k[0] is not None}):
        data = text.encode()
        for a in range(len(data) - window + 1):
            w = data[a:a + window]
            if w in seen:
                removed.setdefault(key, set()).update(range(a, a + window))
            seen.add(w)
    out = []
    for key, text in rows:
        data, gone = (text or "").encode(), removed.get(key, set())
        runs = sum(i in gone and i - 1 not in gone for i in range(len(data)))
        out.append((key[0], len(data), len(gone), runs, bytes(b for i, b in enumerate(data) if i not in gone)))
    return sorted(out, key=repr)


def compare(spark, docs, rows, window, **options):
    given = docs(rows).withColumns({c: F.lit("clash") for c in ("id", "mark", "key", "digest", "shard", "spans", "from", "to", "first", "windows", "kept")})
    marks = {t: m for t, m in spark.createDataFrame([(t,) for _, t in rows], "t string").select("t", F.xxhash64("t")).collect()}
    got = sa.remove_repeats(given, window=window, **options)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    want = plain([((i, marks[t]), t if t is not None else "") for i, t in rows], window)
    assert sorted(((*r[:4], bytes(r[4])) for r in got.collect()), key=repr) == want


def test_against_all_windows(spark, docs):
    rng = random.Random(6)
    words = ["ab", "é", "cd ", "xyz", "日", "\n", "q"]
    passage = "".join(rng.choice(words) for _ in range(60))
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) for _ in range(rng.randrange(80)))
        if i % 3 == 0:
            at = rng.randrange(len(passage))
            text += passage[at:at + rng.randrange(80)] + text[:20]
        rows.append((i, text))
    rows += [(3, rows[9][1]), (None, passage), (500, rows[0][1]), (500, rows[0][1]), (501, ""), (502, None), (503, "aaaa" * 50), (504, "a" * 90), (505, "ab" * 40), (506, "\x00" * 40)]
    rng.shuffle(rows)
    compare(spark, docs, rows, 20, anchor=8, shard_bytes=2000, hot_bytes=500)
    compare(spark, docs, rows, 20, anchor=5, shard_bytes=150, hot_bytes=40)  # nearly all anchors are hot and go window by window
    compare(spark, docs, rows, 9, anchor=32)


def test_long_texts_and_blocks(spark, docs):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(sa.BLOCK + 5000))
    middle = long[sa.BLOCK - 300:sa.BLOCK + 300]
    got = {r["doc_id"]: r for r in sa.remove_repeats(docs([(1, long), (2, "x" + middle + "y"), (3, "word " * 30_000), (4, middle)])).collect()}
    assert (got[1]["n_removed"], got[2]["n_removed"], bytes(got[2]["kept"])) == (0, 600, b"xy")
    assert (got[3]["n_removed"], got[3]["n_spans"]) == (150_000 - 5, 1) and got[4]["n_removed"] == 600


def test_empty(docs):
    assert sa.remove_repeats(docs([])).count() == 0
    assert [tuple(r) for r in sa.remove_repeats(docs([(1, None)])).collect()] == [(1, 0, 0, 0, bytearray())]


def test_a_shard_does_not_grow_with_a_passage(spark, docs):
    """A passage in many surroundings: its anchors have as many different segments as documents."""
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(130))
    rows = [(i, "".join(rng.choice("ijklmnop ") for _ in range(60)) + passage[rng.randrange(20):] + "".join(rng.choice("qrstuvw ") for _ in range(60))) for i in range(400)]
    compare(spark, docs, rows, 100, shard_bytes=4000, hot_bytes=1000)


def test_filters_follow_the_keys(spark, docs, monkeypatch):
    """With more keys than the smallest filter is for, lone segments are still left out: they would be written and sorted."""
    from tidemark.llm import common

    rng = random.Random(4)
    text = lambda: "".join(rng.choice("abcdefgh ") for _ in range(300))
    shared = [text() for _ in range(40)]
    rows = [(i, text() + shared[i % 40] + text()) for i in range(80)]
    written, stage = {}, sa.stage
    monkeypatch.setattr(sa, "stage", lambda df, name: written.setdefault(name, stage(df, name)))
    monkeypatch.setattr(common, "FILTER_BITS", 8)
    compare(spark, docs, rows, 50, anchor=16)
    lone = written["suffix-segments"].join(written["suffix-keys"], "key", "left_anti").count()
    assert lone < written["suffix-segments"].count() / 4
