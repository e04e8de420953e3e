"""Each operator against a brute-force version, and on nulls, empty texts, ties, repeated rows, empty tables and
columns whose names clash."""

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language, licenses, mixing, secrets, simhash, substrings, topk, toxicity, warc
from tidemark.llm.common import bits_of, bucket_of, filter_bits, key_filter, passes
from tidemark.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd(docs):
    """Rows every operator must survive, with columns that clash with its own names."""
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a lone text without an id"), (4, "x"), (4, "x"), (5, "long " * 30_000)]
    return docs(rows).withColumns({c: F.lit("clash") for c in ("id", "fp", "score", "size", "bit", "word", "label", "row", "mark", "value", "key", "kept")})


def test_bucket_and_filter(spark):
    got = spark.range(20).select("id", bucket_of(F.col("id"), 5).alias("b")).collect()
    assert all(r["b"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 500)
    bitmap = key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key")
    assert passes(bitmap, keys.view(np.uint64)).all()
    assert passes(bitmap, np.random.default_rng(2).integers(0, 2**63, 1000).astype(np.uint64)).sum() < 10


def test_filters_grow_with_their_keys(spark):
    assert [filter_bits(n) for n in (0, 1, 1 << 22, (1 << 22) + 1, 24_000_000, 1 << 40)] == [26, 26, 26, 27, 29, 29]
    keys = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 500)
    wide = key_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key", 28)
    assert bits_of(wide) == 28 and passes(wide, keys.view(np.uint64)).all()


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(1, 300)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_spend_no_round_on_blocks_and_stars(spark, monkeypatch):
    from tidemark.llm import components as module

    staged, stage = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: (staged.append(name), stage(df, name))[1])
    chain = spark.createDataFrame([(i, i + 1) for i in range(500)], "a long, b long").coalesce(1)
    assert {tuple(r) for r in components(chain).collect()} == {(i, 0) for i in range(501)}
    assert staged == ["links", "least"]
    a, b = module.forest(np.array([5, 3, 9, 9]), np.array([3, 1, 8, 8]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(3, 1), (5, 1), (9, 8)]


def test_components_make_stars_of_every_round(spark, monkeypatch):
    """A path in shuffled pieces: once a round's links lie in one block, they are stars, and no more rounds are written."""
    from tidemark.llm import components as module

    names = []
    monkeypatch.setattr(module, "stage", lambda df, name, stage=module.stage: names.append(name) or stage(df, name))
    edges = [(i, i + 1) for i in range(1500)]
    random.Random(3).shuffle(edges)
    pieces = spark.createDataFrame(edges, "a long, b long").repartition(8)
    assert {tuple(r) for r in components(pieces).collect()} == {(i, 0) for i in range(1501)}
    assert len(names) <= 6


# 1


def test_toxicity_learns_spellings(spark, docs):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(700):
        bad = i % 4 == 0
        words = [rng.choice(WORDS) for _ in range(rng.randrange(5, 200))]
        for _ in range(1 + len(words) // 40 if bad else 0):
            words.insert(rng.randrange(len(words)), "stupid" + rng.choice(["", "ly", "est", "o", "ish"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs(rows), known, usable=F.col("doc_id") % 5 != 0)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs(rows), model).collect()}
    held = [(got[i] >= 0.5) == bool(y) for i, y in labels if i % 5 == 0]
    assert sum(held) / len(held) > 0.95
    unseen = {r["doc_id"]: r["score"] for r in toxicity.score(docs([(1, text(rng, 20) + " stupidxx zstupidq"), (2, text(rng, 20)), (3, "w1 " * 500)]), model).collect()}
    assert unseen[1] > 0.5 > max(unseen[2], unseen[3])
    strange = {r["doc_id"]: r["score"] for r in toxicity.score(odd(docs), model).collect()}
    assert strange[1] == strange[2] == strange[3] and all(0 <= s <= 1 for s in strange.values())
    assert toxicity.score(docs([]), model).count() == 0
    none = toxicity.train(docs(rows[:3]), known.limit(0))
    assert 0 <= toxicity.score(docs(rows[:3]), none).first()["score"] <= 1


def test_toxicity_scores_match_a_loop():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=toxicity.BUCKETS).astype(np.float32)
    texts = ["Ein Übel, ein Übel! a b", "", "zz9 Zz9 " + "mot " * 70 + "été"]
    data, inside, starts, ends, doc = toxicity.lowered(pa.array(texts))
    from tidemark.llm.common import WordHasher

    got = toxicity.logits(toxicity.word_scores(data, inside, starts, ends, scores), WordHasher()(data, starts, ends), doc, 3, 0.25)

    def word_score(w):
        b, out = b"\0" + w.encode() + b"\0", []
        for n in toxicity.GRAMS:
            for i in range(len(b) - n + 1):
                h = n
                for c in b[i:i + n]:
                    h = (h * 0x01000193 & 0xFFFFFFFF) ^ c
                h ^= h >> 15
                h = h * 0x2C1B3C6D & 0xFFFFFFFF
                h ^= h >> 13
                out.append(scores[h % toxicity.BUCKETS])
        return np.mean(np.array(out, float))

    for i, t in enumerate(texts):
        words = re.findall(r"[^\W_]+", t.lower())
        parts = -(-len(words) // toxicity.PASSAGE)
        cut = [[w for k, w in enumerate(words) if k * parts // len(words) == p] for p in range(parts)]
        want = max((sum(map(word_score, set(c))) / toxicity.PASSAGE + 0.25 for c in cut), default=0.25)
        assert got[i] == pytest.approx(want, abs=1e-5)


# 2


def brute_removed(rows, window):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1 if d is not None else 0):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1 if d is not None else 0):
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("hot_docs", [2, 20_000])
def test_substrings(docs, hot_docs):
    rng = random.Random(11)
    passages = [text(rng, n) for n in (5, 8, 9, 30, 60)]
    rows = [(i, "  ".join([text(rng, rng.randrange(0, 30)), rng.choice(passages), text(rng, rng.randrange(0, 20)), rng.choice(passages)])) for i in range(80)]
    rows += [(100 + i, rows[i % 7][1].replace(" ", rng.choice([" ", "\n", "\t "]))) for i in range(20)]
    rows += [(200, "a b " * 40), (201, "b a " * 30), (202, "a b a b"), (5, rows[3][1]), (-7, rows[9][1]), (None, rows[0][1]), (300, None), (301, ""), (302, "  \x1c x")]
    got = substrings.remove_repeats(docs(rows), window=8, shard_words=300, hot_docs=hot_docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    assert sorted(map(tuple, got), key=key) == sorted(brute_removed(rows, 8), key=key)


def test_substrings_odd(docs):
    got = substrings.remove_repeats(odd(docs))
    assert {(r["doc_id"], r["n_words"], r["n_removed"]) for r in got.collect()} == {
        (1, 0, 0), (2, 0, 0), (3, 0, 0), (None, 6, 0), (4, 1, 0), (5, 30_000, 0)}
    assert got.count() == 7 and substrings.remove_repeats(docs([])).count() == 0


class Scanned:
    """Stands for a frame and keeps what is run over its batches."""

    def __init__(self):
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        return type("Shared", (), {"value": value})

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def test_substrings_scans_take_little_memory():
    rng = random.Random(4)
    texts = [text(rng, 300) for _ in range(200)] * 30
    batch = pa.record_batch({"id": pa.array(range(len(texts))), "mark": pa.array(range(len(texts))), "text": pa.array(texts)})
    assert batch.nbytes > 8e6
    full, none = np.full(1 << 20, ~np.uint64(0)), np.zeros(1 << 20, np.uint64)
    for scan in (
        substrings.keys_of(Scanned(), 13, 4), substrings.segments_of(Scanned(), full, none, 13, 4),
        substrings.segments_of(Scanned(), full, none, 13, 4, full), substrings.segments_of(Scanned(), full, full, 13, 4),
    ):
        tracemalloc.start()
        rows = sum(out.num_rows for out in scan(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows > 0 and peak < 110e6


def test_substrings_run_hashes():
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    tokens[30:50] = tokens[5:25]
    hashes = substrings.RunHasher(tokens, substrings.MULTIPLIER)
    runs = [(i, n) for n in range(1, 20) for i in range(60 - n)]
    at, words = np.array(runs).T
    names = {}
    for (i, n), h in zip(runs, hashes(at, words).tolist()):
        names.setdefault(h, set()).add(tuple(tokens[i:i + n].tolist()))
    assert all(len(x) == 1 for x in names.values()) and len(names) == len({tuple(tokens[i:i + n].tolist()) for i, n in runs})


def test_substrings_long_words(docs):
    # Words whose sums of bytes by powers agree modulo 2**64: only a hash of the whole word tells them apart.
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    other = one.translate(str.maketrans("ab", "ba"))
    rest = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join([one, *rest])), (2, " ".join([other, *rest])), (3, " \t ".join([one, *rest]))]
    got = substrings.remove_repeats(docs(rows)).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {1: 0, 2: 0, 3: 13}


def test_automaton_gives_smallest_document():
    rng = random.Random(2)
    sequences = [([rng.choice("abc") for _ in range(rng.randrange(3, 30))], rng.randrange(20)) for _ in range(30)]
    automaton = substrings.Automaton()
    for words, d in sequences:
        automaton.add(words, d)
    automaton.settle()
    for words in [s for s, _ in sequences] + [[rng.choice("abcd") for _ in range(25)] for _ in range(20)]:
        for window in (1, 3, 6):
            want = [min((d for s, d in sequences if any(s[j:j + window] == words[i:i + window] for j in range(len(s)))), default=None)
                    for i in range(len(words) - window + 1)]
            assert automaton.firsts(words, window) == want


# 3


def brute_fingerprint(t, shingle=4):
    words = (t or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs):
    rng = random.Random(9)
    base = [text(rng, rng.randrange(1, 120)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(100, 220):
        words = rng.choice(base).split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words).upper()))
    rows += [(300, base[2]), (300, base[2]), (-4, base[5]), (None, base[6]), (301, None), (302, "")]
    got = simhash.near_duplicates(docs(rows)).collect()
    marks = {(d, brute_fingerprint(t)) for d, t in rows}
    assert {(r["doc_id"], r["fp"] % 2**64) for r in got} == marks and len(got) == len(rows)
    prints = sorted({f for _, f in marks})
    group = {f: f for f in prints}

    def find(f):
        while group[f] != f:
            f = group[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 4:
                group[find(a)] = find(b)
    least = {}
    for d, f in marks:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    assert {(r["doc_id"], r["component"]) for r in got} == {(d, least.get(find(f))) for d, f in marks}


@pytest.mark.parametrize("distance", [2, 3, 4, 5])
def test_simhash_links(spark, distance):
    rng = random.Random(distance)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for f in list(prints):
        for _ in range(6):
            for b in rng.sample(range(64), rng.randrange(1, 8)):
                f ^= 1 << b
            prints.add(f)
    want = {(a, b) for a in map(simhash.signed, prints) for b in map(simhash.signed, prints) if a < b and ((a ^ b) % 2**64).bit_count() <= distance}
    got = simhash.links(spark.createDataFrame([(simhash.signed(f),) for f in prints], "fp long"), distance).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_simhash_signatures_are_not_broadcast(spark, tmp_path):
    """However small the fingerprints' file is: Spark does not count the rows that an explode makes."""
    rng = random.Random(6)
    prints = {rng.getrandbits(64) for _ in range(40)}
    prints |= {f ^ 1 << rng.randrange(64) for f in prints}
    spark.createDataFrame([(simhash.signed(f),) for f in prints], "fp long").write.parquet(f"{tmp_path}/marks")
    pairs = simhash.links(spark.read.parquet(f"{tmp_path}/marks"))
    planned = pairs._jdf.queryExecution().executedPlan().toString()
    assert len(pairs.collect()) >= 40
    for plan in (planned, pairs._jdf.queryExecution().executedPlan().toString()):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_simhash_writes_no_pairs(spark, docs, monkeypatch):
    """Links become stars in the tasks that find them: nothing is written between."""
    from tidemark.llm import components as module

    names = []
    for where in (module, simhash):
        monkeypatch.setattr(where, "stage", lambda df, name, stage=where.stage: names.append(name) or stage(df, name))
    rng = random.Random(4)
    base = [text(rng, 60) for _ in range(20)]
    given = docs([(i, base[i % 20] + " changed" * (i // 20 % 2)) for i in range(80)])
    groups = simhash.near_duplicates(given).select("component").distinct().count()
    assert names == ["simhash-fp", "simhash-distinct", "links", "least", "simhash-groups"]
    names.clear()
    assert simhash.deduplicated(given).count() == groups
    assert names == ["simhash-marks", "links", "least", "simhash-firsts"]


def test_simhash_odd(docs):
    got = {(r["doc_id"], r["component"]) for r in simhash.near_duplicates(odd(docs)).collect()}
    assert {(1, 1), (2, 1), (3, 1), (None, None), (4, 4)} <= got
    assert simhash.near_duplicates(docs([])).count() == 0


# 4


def test_forward_sums_all_segmentations():
    pieces = language.Pieces(["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab"])
    p = np.array([0.1, 0.2, 0.05, 0.1, 0.15, 0.1, 0.2, 0.1])
    model = language.Model(["x"], pieces, np.append(p, 0.0)[:, None])

    def brute(t):
        if not t:
            return 1.0
        known = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab"]
        return sum(q * brute(t[len(k):]) for k, q in zip(known, p) if t.startswith(k)) + (language.UNKNOWN * brute(t[1:]) if t[0] not in "▁ab" else 0)

    words = ["a", "ab", "abab", "babaab", "abz", "aaa"]
    assert np.allclose(np.exp(model.log_probabilities(words))[:, 0], [brute("▁" + w) for w in words], rtol=1e-9)
    uses = language.expectation(["ab"], np.array([2.0]), pieces, p)
    total = brute("▁ab")
    assert uses[7] == pytest.approx(2 * p[7] / total) and uses[1] == pytest.approx(2 * p[1] * p[3] / total)


def test_language(spark, docs):
    rng = random.Random(4)
    kinds = {"en": ["the", "house", "thing", "with", "water", "running"], "de": ["das", "haus", "dinge", "mit", "wasser", "laufend"], "fr": ["la", "maison", "chose", "avec", "l'eau", "été"]}
    rows = [(i, " ".join(rng.choice(kinds[k]) for _ in range(rng.randrange(3, 60))), k) for i, k in enumerate(list(kinds) * 60)]
    model = language.train(docs(rows), usable=bucket_of(F.col("doc_id"), 3) != 1)
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs(rows), model).collect()}
    assert sum(got[i] == k for i, _, k in rows) / len(rows) > 0.98
    odds = odd(docs).unionByName(odd(docs).limit(1).withColumn("text", F.lit("123 !? 4")).withColumn("doc_id", F.lit(9).cast("long")))
    strange = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(odds, model).collect()}
    assert strange[1] == strange[2] == strange[3] == strange[9] == ("und", 0.0)
    assert strange[5][0] in kinds and 0 <= strange[5][1] <= 1
    nothing = language.train(docs([(1, "text", None)]))
    assert language.predict(docs(rows[:1]), nothing).first()["lang_pred"] == "und"
    assert language.predict(docs([]), model).count() == 0


def test_language_sums_do_not_vanish():
    pieces = language.Pieces(["a", "b", "ab", "▁ab"])
    p = np.array([0.4, 0.3, 0.2, 0.1])
    model = language.Model(["x"], pieces, np.append(p, 0.0)[:, None])
    unknown = np.log(language.UNKNOWN)
    ab = np.log(0.1 + language.UNKNOWN * (0.2 + 0.4 * 0.3))
    words = ["─" * 40, "ຂ" * 200, "ab" + "─" * 60, "ab" + "─" * 60 + "ab"]
    want = [41 * unknown, 201 * unknown, ab + 60 * unknown, ab + 60 * unknown + np.log(0.2 + 0.4 * 0.3)]
    assert np.allclose(model.log_probabilities(words)[:, 0], want, rtol=1e-12)
    one, two = (language.expectation([w], np.array([3.0]), pieces, p) for w in ("ab", "ab" + "─" * 60))
    assert np.isfinite(two).all() and np.allclose(one, two, rtol=1e-9)
    # Far apart from both ends, the sums are those of the middle alone.
    middle = language.expectation(["─" * 50 + "ab" + "─" * 50], np.array([1.0]), pieces, p)
    assert np.allclose(middle, np.array([0.12, 0.12, 0.2, 0.0]) / 0.32, rtol=1e-9)


def test_language_unknown_characters(spark, docs):
    kinds = {"en": "the house with water ", "de": "das haus mit wasser "}
    strange = ["─" * 40, "—…😀" * 20, "ຂ" * 40, "አ" * 50]
    rows = [(i, kinds[k] * (1 + i % 5) + strange[i // 2 % 4], k) for i, k in enumerate(list(kinds) * 40)]
    model = language.train(docs(rows))
    assert np.isfinite(model.table).all() and (model.table[:-1] > 0).all()
    tests = [(100 + 2 * i, f"{kinds[k]}{s}\n{kinds[k]}", k) for i, (k, s) in enumerate(itertools.product(kinds, strange))]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs(tests), model).collect()}
    assert all(got[i][0] == k and 0.9 < got[i][1] <= 1 for i, _, k in tests)
    alone = [*enumerate(strange)] + [(10 + i, f"a{s}") for i, s in enumerate(strange)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs(alone), model).collect()}
    assert got[0] == got[1] == ("und", 0.0)
    assert all(got[i][0] in kinds and 0 < got[i][1] <= 1 for i in got if i > 1)


# 5


def sha32(payload):
    import base64

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PAGES = "page_id long, url string, html string, extra string, digest string"


@pytest.mark.parametrize("compress", [True, False])
def test_warc_round_trip(spark, compress):
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>\r\n\r\nWARC/1.1 inside" * (i % 5 + 1)) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (None, "u", "lone"), (102, "a b\nc", "é" * 50_000), (103, "u", "x"), (103, "u", "x")]
    pages = spark.createDataFrame([(*r, "e", "d") for r in rows], PAGES)
    read = warc.read_archives(spark, warc.write_archives(pages, compress=compress))
    assert read.filter("gap_reason IS NOT NULL").count() == 0
    got = sorted(((-1 if r["page_id"] is None else r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.records(read).collect()))
    most = {}
    for i, _, h in rows:
        b = (h or "").encode()
        most[b] = max(most.get(b, -1), i if i is not None else -1)
    want = sorted((i if i is not None else -1, len(b := (h or "").encode()), sha32(b), "response" if most[b] in (i, -1) else "revisit", None if most[b] in (i, -1) else most[b]) for i, _, h in rows)
    assert got == want


def test_warc_small_payloads_stay_whole(spark):
    pages = spark.createDataFrame([(1, "u", "ab", "", ""), (2, "u", "ab", "", ""), (3, "u", "abcdef", "", ""), (4, "u", "abcdef", "", "")], PAGES)
    got = {r["page_id"]: r["record_type"] for r in warc.records(warc.read_archives(spark, warc.write_archives(pages, min_bytes=3))).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.records(warc.read_archives(spark, warc.write_archives(pages.limit(0)))).count() == 0


@pytest.mark.parametrize("compress", [True, False])
def test_warc_salvage(compress):
    rng = random.Random(1)
    records = [warc.record_bytes(i, "http://u", (text(rng, 50) + " WARC/1.1\r\n\r\n").encode(), None, False) + b"\r\n\r\n" for i in range(12)]
    parts = [warc.gzip_member(r, 6) if compress else r for r in records]
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    raw = bytearray(b"".join(parts))
    assert [x[3]["warc-record-id"] for x in warc.salvage(bytes(raw))] == [warc.record_id(i) for i in range(12)]
    for i in (0, 4, 5):
        raw[starts[i] + len(parts[i]) // 2] ^= 0xFF
    raw = bytes(raw[:starts[8]]) + b"junk between" + bytes(raw[starts[8]:-9])
    found = list(warc.salvage(raw))
    assert [x[3]["warc-record-id"] for x in found if x[3]] == [warc.record_id(i) for i in (1, 2, 3, 6, 7, 8, 9, 10)]
    gaps = [(x[0], x[0] + x[1]) for x in found if x[2]]
    assert gaps == [(0, starts[1]), (starts[4], starts[6]), (starts[8], starts[8] + 12), (starts[11] + 12, len(raw))]
    assert sum(x[1] for x in found) == len(raw)


# 6


def brute_top(rows, every, k, scale=256):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors[i] = min(vectors.get(i, v), v)
    whole = {i: [int(np.floor(scale * float(x))) for x in v] for i, v in vectors.items()}
    out = []
    for q, a in whole.items():
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in whole.items() if c != q and len(a) == len(b))[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    rows = [(i, [float(x) for x in np.float32(centres[i % 6] + rng.normal(size=12) * 0.3)]) for i in range(900)]
    rows += [(900 + i, rows[i * 50][1]) for i in range(10)] + [rows[100], (7, [0.0] * 12), (None, [1.0] * 12), (2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 12)]
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, -1.0]), (3050, []), (3051, [])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    for shard_rows in (100, 5000):
        got = topk.top_k(table, F.col("vec_id") % 50 == 0, k=5, shard_rows=shard_rows)
        assert sorted(map(tuple, got.collect())) == brute_top(rows, 50, 5)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    huge = [(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [-1e308, 1e308]), (3, [1.0, 1.0]), (50, [1e300, 1e300])]
    got = topk.top_k(spark.createDataFrame(huge, "vec_id long, embedding array<double>"), F.col("vec_id") == 50, k=5)
    most = 2**63 - 1  # floors and scores stop there, and what ties goes by id
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == [(1, 0, most), (2, 1, most), (3, 3, most), (4, 2, -most)]
    large = [(0, [1e6, -3e5]), (1, [2e6, 1.0]), (50, [-1e6, 5e5])]
    got = topk.top_k(spark.createDataFrame(large, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, k=2)
    assert sorted(map(tuple, got.collect())) == brute_top(large, 50, 2)


def test_tree_boxes_and_pruning():
    rng = np.random.default_rng(0)
    points = rng.integers(-100, 100, (500, 4)).astype(float)
    order, starts, low, high = topk.build(points, 8)
    assert sorted(order) == list(range(500)) and np.diff(starts).max() <= 8
    leaves = len(low) // 2
    for i in range(len(starts) - 1):
        own = points[order[starts[i]:starts[i + 1]]]
        assert (own.min(0) == low[leaves + i]).all() and (own.max(0) == high[leaves + i]).all()


# 7


def test_licenses(spark, docs):
    rng = random.Random(8)
    mit, apache = licenses.TEMPLATES[3][1], licenses.TEMPLATES[4][1]
    rows = [(1, f"{text(rng, 60)}\n{apache}\n{text(rng, 9)}"), (2, mit.upper().replace(" ", "\n")), (3, mit.replace("granted", "given")), (4, text(rng, 300)),
            (5, f"Intro. {apache} Outro."), (6, "license licensed under permission notice software"), (None, apache), (7, apache), (7, apache), (8, f"{text(rng, 5)} {licenses.TEMPLATES[7][1]}")]
    found = {(r["doc_id"], r["license"]): r["dice"] for r in licenses.scan(docs(rows)).collect()}
    assert set(found) == {(1, "Apache-2.0"), (2, "MIT"), (3, "MIT"), (5, "Apache-2.0"), (None, "Apache-2.0"), (7, "Apache-2.0")} | {k for k in found if k[0] == 8}
    assert found[2, "MIT"] == 1.0 and 0.9 < found[3, "MIT"] < 1.0
    assert licenses.scan(odd(docs)).count() == 0 and licenses.scan(docs([])).count() == 0


def test_license_pruning_is_lossless(docs):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        words = rng.choice(licenses.TEMPLATES)[1].split()
        for _ in range(rng.randrange(0, 1 + len(words) // 3)):
            words[rng.randrange(len(words))] = rng.choice(["x", "", "this thing"])
        rows.append((i, " ".join(words)))
    got = {r["doc_id"] for r in licenses.scan(docs(rows)).collect()}
    split = lambda t: set(licenses.bigrams_of(t))

    def matches(t):
        units = {t, *re.split(r"(?<=[.!?])[ \t]+", t)}
        return any((a := split(u)) and 2 * len(a & (b := split(x))) / (len(a) + len(b)) >= 0.8 for u in units for _, x in licenses.TEMPLATES)

    assert got == {i for i, t in rows if matches(t)} and 30 < len(got) < 300


def test_licenses_standard_notices_and_whole_texts(docs):
    notice = ("This {0} is free software{1} you can redistribute it and/or modify\nit under the terms of the GNU {2} as published by\nthe Free Software "
              "Foundation{3} either version {4} of the License, or\n(at your option) any later version.")
    gnu = {"GPL-2.0": ("program", ";", "General Public License", ";", "2"), "GPL-3.0": ("program", ":", "General Public License", ",", "3"),
           "LGPL-2.1": ("library", ";", "Lesser General Public License", ";", "2.1"), "LGPL-3.0": ("library", ":", "Lesser General Public License", ",", "3"),
           "AGPL-3.0": ("program", ":", "Affero General Public License", ",", "3")}
    given = [(name, f"Copyright (C) someone\n\n{notice.format(*words)}\n\nint main;") for name, words in gnu.items()]
    given += [(name, t) for name, t in licenses.TEMPLATES if len(licenses.bigrams_of(t)) > 60]
    rows = [(i, t) for i, (_, t) in enumerate(given)]
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(docs(rows)).collect()}
    assert {i for i, _ in got} == set(range(len(rows)))
    assert all((i, name) in got for i, (name, _) in enumerate(given))
    assert all(x == name for i, x in got for name in [given[i][0]] if i < len(gnu))
    whole = dict(licenses.WHOLE_TEXTS)
    assert {"GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "Apache-2.0", "MPL-2.0"} <= set(whole)
    bodies = [(i, re.sub(r"\s+", " ", t)[:-900].replace("copy", "kopy") + " the end", name) for i, (name, t) in enumerate(whole.items())]
    best = {}
    for r in licenses.scan(docs([(i, t) for i, t, _ in bodies])).collect():
        best[r["doc_id"]] = max(best.get(r["doc_id"], (0, "")), (r["dice"] if r["template"] >= len(licenses.TEMPLATES) else 0, r["license"]))
    assert {i: x for i, (_, x) in best.items()} == {i: name for i, _, name in bodies} and all(d < 1 for d, _ in best.values())


# 8


def test_targets(spark):
    rng = random.Random(3)
    for n in (1, 2, 7, 40):
        sizes = {f"s{i:02}": rng.choice([0, 1, 50, 3000, rng.randrange(10**6)]) for i in range(n)}
        got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        weight = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes))}
        total, fixed = sum(sizes.values()), {}
        while True:
            rest = total - sum(fixed.values())
            free = [s for s in sizes if s not in fixed]
            want = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
            over = [s for s in free if want[s] >= 3 * sizes[s]]
            if not over:
                break
            fixed |= {s: 3 * sizes[s] for s in over}
        assert got == pytest.approx(fixed | want)


def test_mix(docs):
    rng = random.Random(1)
    rows = [(i, text(rng, rng.randrange(1, 60)), "en", rng.choices(["a", "b", "c", None], [60, 20, 10, 10])[0]) for i in range(3000)]
    rows += [(5000, None, "en", "a"), (5001, "", "en", "b"), (None, "some words", "en", "c"), (5002, "x y z", "en", "d"), (5003, "x", "en", "a"), (5003, "x", "en", "a")]
    for slice_rows in (50, 100_000):
        got = mixing.mix(docs(rows), slice_rows=slice_rows).collect()
        assert len(got) == len(rows)
        again = mixing.mix(docs(rows[::-1]).repartition(5), slice_rows=slice_rows).collect()
        assert sorted(map(str, got)) == sorted(map(str, again))
        if slice_rows == 50:
            first = sorted(map(str, got))
    assert first == sorted(map(str, got))
    by = {}
    for r in got:
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        by.setdefault(r["source"], []).append(r)
    for own in by.values():
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1e-6
        assert max(r["copies"] for r in own) - min(r["copies"] for r in own if r["size"]) <= 1
    assert mixing.mix(odd(docs)).count() == 7 and mixing.mix(docs([])).count() == 0


def test_mix_by_weight(docs):
    rows = [(i, "w " * 10, "en", "a" if i % 2 else "b") for i in range(4000)]
    table = docs(rows).withColumn("q", F.when(F.col("doc_id") % 4 < 2, 0.5).otherwise(1.5))
    got = mixing.mix(table, weight_col="q", share=0.5).join(table.select("doc_id", "q"), "doc_id").groupBy("source", "q").agg(F.avg("copies").alias("c"), F.first("target").alias("t")).collect()
    for r in got:
        assert r["c"] == pytest.approx(r["q"] * r["t"] / 20_000, rel=0.15)


# 9


def test_decontamination(spark, docs):
    rng = random.Random(7)
    items = [(i, text(rng, rng.choice([9, 15, 40, 60]))) for i in range(30)] + [(90, "too short item"), (91, None), (92, "")]
    items += [(93, items[0][1].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [], set()
    for i in range(200):
        words = text(rng, rng.randrange(20, 80)).split()
        if i % 4 == 0:
            item, passage = rng.randrange(30), None
            passage = items[item][1].split()
            if i % 8 == 0:
                for at in range(6, len(passage), 9):
                    passage[at] = "other"
            cut = rng.randrange(len(words))
            words[cut:cut] = [w.title() + rng.choice(["", ",", "!"]) for w in passage]
            if i % 8 or len(passage) >= 15:
                want.add((i, item))
        rows.append((i, " ".join(words)))
    got = decontamination.contaminated(docs(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} >= want
    assert {r["doc_id"] for r in got} <= {i for i in range(0, 200, 4)}
    assert {r["item_copies"] for r in got if r["item_id"] == 0} <= {2}
    for r in got:
        assert r["matched_tokens"] <= r["item_tokens"] and r["end_token"] > r["first_token"]
    both = docs([(None, items[3][1]), (8, items[3][1]), (8, items[3][1])])
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(both, bench).collect()} == {(None, 3), (8, 3)}
    assert decontamination.contaminated(odd(docs), bench).count() == 0
    assert decontamination.contaminated(docs([]), bench).count() == 0
    assert decontamination.contaminated(docs(rows[:9]), bench.limit(0)).count() == 0


def test_masks_fit_every_placement():
    for wide in range(1, 30):
        differ = wide - decontamination.needed(wide, decontamination.EQUAL)
        masks = decontamination.masks_of(wide, decontamination.EQUAL)
        if wide <= decontamination.OVERLAP:
            assert (wide, differ) in decontamination.FAMILIES or not differ
        for changed in itertools.combinations(range(wide), differ):
            assert any(
                all(take == "0" or at + j not in changed for j, take in enumerate(mask)) for mask in masks for at in range(wide - len(mask) + 1)
            ), (wide, changed)


def test_decontamination_finds_what_the_check_accepts(spark, docs):
    rng = random.Random(11)
    tokens = {n: [f"t{n}x{j}" for j in range(n)] for n in (*range(1, 14), 20)}
    rows = []
    for n, item in tokens.items():
        wide = min(n, decontamination.OVERLAP)
        differ = wide - decontamination.needed(wide, decontamination.EQUAL)
        for many in {differ, differ + 1}:
            for changed in itertools.combinations(range(wide), many):
                if many <= differ or rng.random() < 0.1:
                    passage = ["other" if j in changed else w for j, w in enumerate(item[:wide])]
                    rows.append((len(rows), " ".join([*text(rng, rng.randrange(3)).split(), *passage, *text(rng, rng.randrange(3)).split()])))
    # Short items that stand more than once, and across two texts.
    rows += [(len(rows), "t1x0 w1 t1x0 t2x0 t2x1 w2 t2x0 t2x1"), (len(rows) + 1, "t3x0 t3x1"), (len(rows) + 2, "t3x2")]
    bench = spark.createDataFrame([(n, " ".join(item)) for n, item in tokens.items()], "item_id long, text string")
    want = {}
    for i, words in rows:
        held = np.array(words.split())
        for n, item in tokens.items():
            found = [decontamination.aligned(held, np.array(item), shift, decontamination.OVERLAP, decontamination.EQUAL) for shift in range(-n, len(held))]
            if any(found):
                want[i, n] = max((x for x in found if x), key=lambda x: (x[0], -x[1], x[2]))
    got = decontamination.contaminated(docs(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]): (r["matched_tokens"], r["first_token"], r["end_token"]) for r in got} == want
    assert {n for _, n in want} == set(tokens)


# 10


def secret_rows(rng, n):
    rows = []
    for i in range(n):
        kind, noise = i % 5, lambda: text(rng, rng.randrange(1, 12))
        key = hashlib.sha1(str(i).encode()).hexdigest()
        body = {0: f'token = "{key}"', 1: f"api_key={key[:24].upper()}Zq", 2: f"commit {key}", 3: f"{rng.randrange(10**15, 10**16)}", 4: f"user{i}@mail{i}.example.com"}[kind]
        rows.append((i, f"{noise()} {body} {noise()}"))
    return rows


def test_secrets(docs):
    rng = random.Random(2)
    table = docs(secret_rows(rng, 300))
    got = {r["doc_id"] for r in secrets.scan(table).collect()}
    assert got == {i for i in range(300) if i % 5 < 2}
    clean = secrets.redact(table, secrets.scan(table))
    assert clean.columns == table.columns and clean.count() == 300
    for r in clean.collect():
        assert ("[SECRET]" in r["text"]) == (r["doc_id"] % 5 < 2)


def test_secret_dictionary_covers_all_documents(spark, docs):
    rare = "zeitgeber"
    # As many frequent words as the former dictionary held, and one that stands in few of very many documents.
    common = ["".join(p) for p in itertools.islice(itertools.product("abcdefgh", repeat=4), 300)]
    rows = [(i, " ".join(common)) for i in range(1500)] + [(2000 + i, f"{rare} xyzzy" if i < 1 else rare) for i in range(5)]
    words = {r["word"] for r in secrets.dictionary_of(docs(rows)).collect()}
    assert words == {*common, rare}
    values = spark.createDataFrame([("Zeitgeber9zeitgeber9",), ("xyzzy-0123456789",), ("aaaaab00000000000",), ("9xzeitgeberzeitx0",)], "value string")
    got = {r["value"]: r["covered"] for r in secrets.coverage(values, secrets.dictionary_of(docs(rows))).collect()}
    assert got == {"Zeitgeber9zeitgeber9": 18, "aaaaab00000000000": 6, "9xzeitgeberzeitx0": 9}


def test_parts_of_candidates_are_not_broadcast(spark, tmp_path):
    """A candidate has up to 22 parts for each letter, which Spark does not count: the dictionary's file is larger than theirs."""
    rng = random.Random(5)
    known = ["".join(rng.choices("abcdefghijklm", k=12)) for _ in range(4000)]
    spark.createDataFrame([(w,) for w in known], "word string").coalesce(1).write.parquet(f"{tmp_path}/words")
    spark.createDataFrame([(f"{known[i]}{known[i + 1]}-{i}",) for i in range(20)], "value string").coalesce(1).write.parquet(f"{tmp_path}/found")
    covered = secrets.coverage(spark.read.parquet(f"{tmp_path}/found"), spark.read.parquet(f"{tmp_path}/words"))
    planned = covered._jdf.queryExecution().executedPlan().toString()
    assert {r["covered"] for r in covered.collect()} == {24} and covered.count() == 20
    for plan in (planned, covered._jdf.queryExecution().executedPlan().toString()):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_assigned_values_of_any_length_and_characters(docs):
    kept = ["password: required for all", "Password = secret", "the token is here", "auth: https://somewhere.org/a", "pwd=$HOME_PASSWORD", "secret: 42", "token = none"]
    held = {'password = "Tr0ub4dor&3"': "Tr0ub4dor&3", "api_key = ABCDEFGHIJKLMNOPQRSTUVWX": "ABCDEFGHIJKLMNOPQRSTUVWX", "pwd: s3cr3t!Pass": "s3cr3t!Pass",
            'secret="p@ssw0rd#2024!longer$value"': "p@ssw0rd#2024!longer$value", "API-KEY => x9#k": "x9#k", "auth_token:'a1b2c3d4e5f6a7b8c9d0'": "a1b2c3d4e5f6a7b8c9d0"}
    table = docs([(i, f"some words {t} and more words") for i, t in enumerate([*kept, *held])])
    found = secrets.scan(table)
    assert {(r["doc_id"], r["value"]) for r in found.collect()} == {(len(kept) + i, v) for i, v in enumerate(held.values())}
    for r in secrets.redact(table, found).collect():
        assert ("[SECRET]" in r["text"]) == (r["doc_id"] >= len(kept)) and not any(v in r["text"] for v in held.values())
    mixed = docs(secret_rows(random.Random(3), 300) + [(1000 + i, f"x {t} y") for i, t in enumerate([*kept, *held])])
    assert {r["doc_id"] for r in secrets.scan(mixed).collect() if r["doc_id"] >= 1000} == {1000 + len(kept) + i for i in range(len(held))}


def test_secrets_odd(docs):
    assert secrets.scan(odd(docs)).count() == 0 and secrets.scan(docs([])).count() == 0
    two = docs([(1, 'token = "aaaabbbbcccc111122223333" x token = "aaaabbbbcccc111122223333"'), (1, 'password: "q1w2e3r4t5y6u7i8o9p0"'), (None, 'token="aaaabbbbcccc111122223333"')])
    got = {(r["doc_id"], r["value"]): r["occurrences"] for r in secrets.scan(two.withColumn("lead", F.lit(1))).collect()}
    assert got == {(1, "aaaabbbbcccc111122223333"): 2, (1, "q1w2e3r4t5y6u7i8o9p0"): 1, (None, "aaaabbbbcccc111122223333"): 1}
    assert secrets.redact(odd(docs), secrets.scan(odd(docs))).count() == 7
