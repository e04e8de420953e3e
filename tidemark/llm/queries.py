"""The registered queries of the operators, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversations, decontamination, language, licenses, mixing, resampling, secrets, simhash, substrings, suffix_arrays, topk, toxicity, warc
from tidemark.llm.common import bucket_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, third = table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id"), 3)
    model = language.train(docs, usable=third != 1)
    return language.predict(docs, model).select("doc_id", (third == 1).alias("held_out"), "lang_pred", "score")


BASE32 = """list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
    + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1))"""


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fifth = table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id"), 5)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=fifth != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (fifth == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_substrings", r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS pos, w FROM d WHERE len(w) >= 13),
g AS (SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 12], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS low FROM g GROUP BY h HAVING min(doc_id) < max(doc_id)),
r AS (SELECT g.doc_id, list(DISTINCT a) AS gone FROM (
    SELECT g.doc_id, unnest(generate_series(g.pos, g.pos + 12)) AS a FROM g JOIN f USING (h) WHERE f.low < g.doc_id) g GROUP BY g.doc_id),
k AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
    list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)) AS kept FROM d LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k""")
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


@query("op5_warc", f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, unhex(h)::BIT::VARCHAR AS bits, max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, array_to_string({BASE32}, '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM b""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one record per page, read the archives back, report what they hold."""
    folder = warc.write_archives(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc.records(warc.read_archives(spark, folder)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_topk", """
WITH v AS (SELECT vec_id, min(embedding) AS e FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) GROUP BY vec_id),
w AS (SELECT vec_id, list_transform(e, lambda x: floor(256 * x::DOUBLE)) AS e FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM w q JOIN w c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""")
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@query("op8_mixing", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, 1 + (place - 1) % 3 AS weight, (sum(source_size) OVER ())::BIGINT AS total FROM s),
f AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
    (sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest FROM w),
g AS (SELECT *, (total - before) / rest >= cap / weight AS stops FROM f),
o AS (SELECT before AS b0, rest AS r0 FROM g WHERE NOT stops ORDER BY cap / weight, place LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN stops THEN cap::DOUBLE ELSE ((total - b0) * weight)::DOUBLE / r0 END AS target
    FROM g LEFT JOIN o ON true),
r AS (SELECT d.doc_id, d.size, t.*, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, floor(rate)::BIGINT AS whole, rate - floor(rate) AS pr FROM r),
q AS (SELECT *, CASE WHEN pr > 0 AND size > 0 THEN (u / (1.0 - u)) / (pr / (1.0 - pr)) END AS odds FROM p),
x AS (SELECT *, sum(whole * size) OVER (PARTITION BY source) AS certain,
    sum(CASE WHEN odds IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM q)
SELECT doc_id, size, source_size, target, ((whole + CASE WHEN odds IS NOT NULL AND run - size / 2.0 < target - certain
    THEN 1 ELSE 0 END) * size)::BIGINT AS taken, source FROM x""")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_licenses", licenses.sql())
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets by digest: the values themselves stay out of the result."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.sha2("value", 256).alias("secret_sha256"), F.length("value").alias("length"), "occurrences", "probability")


@query("op11_resampling", resampling.sql())
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), share=5, seed=42)
    return ranked.select("row.doc_id", "n_features", "weight", "score", "rank")


@query("op12_conversations", conversations.sql())
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs damaged conversations; those that lost all rows have nothing to repair."""
    given = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(conversations.damage(given))
    key = conversations.key_of(F.col("conv_id")).alias("key")
    digests = conversations.digests(repaired.rows).select(key, "sha256")
    found = repaired.conversations.select(key, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    whole = given.select("conv_id").distinct().withColumn("key", key).join(found, "key", "left").join(digests, "key", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit("").cast("binary")
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(nothing, 256)).alias("repaired_sha256"))


@query("op13_suffix_arrays", suffix_arrays.SQL)
def op13_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_arrays.remove_repeats(table(spark, sf_dir, "documents"), window=100)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
