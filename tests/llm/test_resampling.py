"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def grams(text, longest=3):
    words = WORD.findall(lowered(text))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def buckets(text, every, longest=3):
    return [zlib.crc32(g.encode()) % every for g in grams(text, longest)[1]]


TEXTS = [
    None, "", " \n\t", "One", "ÀÉ İıſ ß one TWO two3 x_y", "a\x00b \x7f c" + "d" * 200 + " e", "x" * 63 + " " + "y" * 64 + " " + "z" * 65, "日本語 テスト 日本語", "end", "start",
]


def test_features_of_a_batch():
    found = resampling.Features(500)
    words, doc, bucket = found(pa.array(TEXTS))
    assert words.tolist() == [grams(t)[0] for t in TEXTS]
    for i, t in enumerate(TEXTS):
        assert sorted(bucket[doc == i].tolist()) == sorted(buckets(t, 500))
    assert len(found(pa.array(TEXTS[:3]))[2]) == 0 and len(found(pa.array([], pa.string()))[0]) == 0
    many = resampling.Features(97, 1)
    assert sorted(many(pa.array(TEXTS))[2].tolist()) == sorted(b for t in TEXTS for b in buckets(t, 97, 1))


def plain(docs, target, share, least, seed, every):
    s, t = np.zeros(every, int), np.zeros(every, int)
    for _, text in docs:
        np.add.at(s, buckets(text, every), 1)
    for text in target:
        np.add.at(t, buckets(text, every), 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + every) / ((s[b] + 1) * (t.sum() + every)))) for b in range(every)]
    out = []
    for id_, text in docs:
        n, found = grams(text)
        weight = sum(gain[b] for b in buckets(text, every))
        h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        out.append((id_, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = able[:share * len(able) // 100]
    rows = [(*r, i + 1) for i, r in enumerate(drawn)]
    for r in drawn:
        out.remove(r)
    return sorted(rows + [(*r, None) for r in out], key=repr)


def test_against_plain(spark, docs):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "Gamma", "delta", "é"]) for _ in range(rng.randrange(40)))) for i in range(300)]
    rows += [(None, rows[7][1]), (5, rows[5][1]), (5, "another text of the same id"), (400, None), (401, ""), (402, "long " * 30_000)]
    target = ["alpha alpha beta", "gamma", None, ""]
    given = docs(rows).withColumns({c: F.lit("clash") for c in ("id", "row", "rank", "score", "weight", "bucket", "n", "n_words")})
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(given, wanted, share=20, least_words=10, seed=7, buckets=300)
    found = sorted((tuple(r) for r in got.select("row.doc_id", "n_words", "n_features", got["weight"], "score", "rank").collect()), key=repr)
    assert found == plain(rows, target, 20, 10, 7, 300)
    assert got.select("row.*").columns == [c for c in given.columns if c != "text"]


def test_empty(spark, docs):
    assert resampling.resample(docs([]), spark.createDataFrame([], "text string")).count() == 0
    got = resampling.resample(docs([(1, "word " * 30), (2, "few words")]), spark.createDataFrame([], "text string"), share=50).collect()
    assert [r["rank"] for r in got] == [None, None]
    got = resampling.resample(docs([(1, "word " * 30), (2, "few words")]), spark.createDataFrame([], "text string"), share=100).collect()
    assert {r["id"]: r["rank"] for r in got} == {1: 1, 2: None}


def test_ties_go_to_the_smaller_id(spark):
    scored = spark.createDataFrame([(i, 30, 5) for i in range(3000)], "id long, n_words long, score long")
    got = resampling.drawn(scored, share=5)
    assert sorted((r["rank"], r["id"]) for r in got.collect() if r["rank"]) == [(i + 1, i) for i in range(150)]
    assert got.count() == 3000
