"""The pipeline and the queries on the smallest tables."""

import hashlib
import math
import os
import random
import re

import pytest
import xxhash

import corpus_pipeline
from checks import compare, connect
from tidemark.llm.queries import QUERIES, SQL
from tidemark.session import stage

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert compare(df, connect(SF), SQL[name]) == ""
    else:
        # The smallest documents hold no secret.
        assert df.count() > 0 or name == "op10_secrets"


def test_stages(spark, docs):
    given = docs([
        (1, "the quick fox runs over the green hill and home again today", "en", "a"), (2, "the quick fox runs over the green hill and home again today", "en", "b"),
        (2, "the quick fox runs over the green hill and home again today", "en", "b"), (3, "123 456", "en", "a"), (4, None, None, "a"), (5, "", "en", None),
        (6, 'my token = "0123456789abcdef0123456789abcdef01234567" is here', "en", "b"), (None, "some other text without an id", "en", None),
    ]).selectExpr("*", "1 AS id", "2 AS score", "3 AS value")
    table, seen = given, []
    for name, function in corpus_pipeline.STAGES:
        before = table
        table = stage(function(spark, table, SF))
        seen.append(table.count())
        if name != "mixing":
            assert table.columns == before.columns
        if name == "secrets":
            held = {r["doc_id"]: r["text"] for r in table.collect()}
            assert held[6] == 'my token = "[SECRET]" is here'
    assert seen == [5, 3, 3, 3, 3]
    empty = given.limit(0)
    for _, function in corpus_pipeline.STAGES:
        empty = stage(function(spark, empty, SF))
        assert empty.count() == 0


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    runs = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_dedup(rows):
    """Indices of the rows kept, by all pairs of fingerprints."""
    marks = [plain_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(marks[i] ^ marks[j]).count("1") <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for i, r in enumerate(rows):
        rank = (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
        best[group[i]] = min(best.get(group[i], (rank, i)), (rank, i))
    return sorted((rows[i] for _, i in best.values()), key=repr)


def aligned(words, item):
    """Whether a passage of the item stands in the text, up to the substitutions the check allows: 11 of 13 words, or 80 % of a
    shorter item."""
    size = min(13, len(item))
    need = 11 if size == 13 else size if size <= 4 else math.ceil(0.8 * size)
    return any(
        sum(a == b for a, b in zip(words[i:i + size], item[j:j + size])) >= need
        for i in range(len(words) - size + 1) for j in range(len(item) - size + 1))


def test_pipeline_is_the_plain_one(spark, docs, tmp_path):
    """Planted cases for every stage, ids that repeat with other texts, and NULL ids, against plain loops."""
    rng = random.Random(12)
    known = [w for w in (spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").orderBy("doc_id").first()["text"]).lower().replace(".", "").replace(",", "").split()]
    fresh = lambda n: " ".join(rng.choice(known) + rng.choice(["", "", "s", "ed"]) for _ in range(n))
    items = [fresh(20).split() for _ in range(4)] + [fresh(6).split()]
    rows = [(i, fresh(40)) for i in range(30)]
    rows += [(50 + i, rows[i][1]) for i in range(4)] + [(50 + i, fresh(40)) for i in range(4)]  # copies and new texts under one id
    rows += [(None, fresh(40)), (None, rows[6][1]), (None, fresh(40)), (60, rows[5][1]), (60, rows[5][1])]
    rows += [(70, fresh(20) + " " + " ".join(items[0][2:17]) + " " + fresh(20)), (71, fresh(30)), (71, fresh(10) + " " + " ".join(items[1])), (None, " ".join(items[2]) + " " + fresh(9))]
    broken = list(items[3][:13])
    broken[4] = broken[9] = "changed"
    rows += [(72, fresh(15) + " " + " ".join(broken) + " " + fresh(15)), (73, "123 456"), (74, None), (75, "")]
    secret = "%040x" % rng.getrandbits(160)
    rows += [(80, fresh(30) + f' token = "{secret}" ' + fresh(5)), (None, fresh(30) + f' token = "{secret[::-1]}" ' + fresh(5))]
    rng.shuffle(rows)
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = docs([(*r, "en", f"s{i % 3}") for i, r in enumerate(rows)])
    stages = dict(corpus_pipeline.STAGES)
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)

    kept = stage(stages["language"](spark, given, str(tmp_path)))
    rows = sorted((r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])), key=repr)
    assert pairs(kept) == rows
    kept, rows = stage(stages["near_duplicates"](spark, kept, str(tmp_path))), plain_dedup(rows)
    assert pairs(kept) == rows and {50, 51, 52, 53} <= {r[0] for r in rows}
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    kept, rows = stage(stages["decontamination"](spark, kept, str(tmp_path))), [r for r in rows if not any(aligned(words(r[1]), i) for i in items)]
    assert pairs(kept) == rows and not {70, 72} & {r[0] for r in rows} and 71 in {r[0] for r in rows}
    kept = stage(stages["secrets"](spark, kept, str(tmp_path)))
    rows = sorted(((r[0], re.sub("[0-9a-f]{40}", "[SECRET]", r[1])) for r in rows), key=repr)
    assert pairs(kept) == rows and sum("[SECRET]" in r[1] for r in rows) == 2
    mixed = stages["mixing"](spark, kept, str(tmp_path))
    size = sum(len(r[1].split()) for r in rows)
    assert sorted((r["size"] for r in mixed.collect())) == sorted(len(r[1].split()) for r in rows)
    assert abs(sum(r["taken"] for r in mixed.collect()) - size) <= 3 * max(len(r[1].split()) for r in rows)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 100 and got.filter("taken > 3 * size").count() == 0
