"""Importance resampling towards a target text distribution: hashed n-grams of whole batches, Gumbel top-k draw."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, text_bytes
from tidemark.operators.ordered import row_index
from tidemark.session import stage

BUCKETS = 10_000
#: Words of the longest feature.
LONGEST = 3
LEAST_WORDS = 20
SHARE = 5
SEED = 42
#: Bytes of text joined into one batch, about. A longer text is a batch of its own.
BATCH_BYTES = 1 << 22
#: Words turned into numbers at once, so that word objects do not pile up.
WORDS_AT_ONCE = 1 << 18
#: Words of at least this many bytes are appended to a checksum one by one; the others by table.
TABLE_BYTES = 64

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on lower-cased UTF-8: characters past ASCII consist of bytes past ASCII.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
SPACE = zlib.crc32(b" ")


def shift_tables() -> np.ndarray:
    """``t[n, k, b]``: what byte k of a CRC-32 becomes when n zero bytes follow. The checksum of two strings in a row is
    that of the first, shifted by the length of the second, XOR that of the second."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (step & np.uint32(1)))
    out = np.empty((TABLE_BYTES + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    for n in range(TABLE_BYTES):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ step[out[n] & np.uint32(255)]
    return out


class Features:
    """Buckets of all word n-grams of a batch of texts."""

    def __init__(self, buckets: int = BUCKETS, longest: int = LONGEST) -> None:
        self.buckets, self.longest, self.tables = buckets, longest, shift_tables()

    def words(self, joined: bytes) -> tuple[np.ndarray, ...]:
        """Start, length, checksum and checksum behind a space of every word: one regex pass over the joined texts."""
        found, parts = WORDS.finditer(joined), []
        while matches := list(islice(found, WORDS_AT_ONCE)):
            n, words = len(matches), [m.group() for m in matches]
            parts.append((
                np.fromiter((m.start() for m in matches), np.int64, n), np.fromiter(map(len, words), np.int64, n),
                np.fromiter(map(zlib.crc32, words), np.uint32, n), np.fromiter((zlib.crc32(w, SPACE) for w in words), np.uint32, n),
            ))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        return tuple(np.concatenate(p) for p in zip(*parts))

    def behind(self, before: np.ndarray, joined: bytes, start: np.ndarray, size: np.ndarray, spaced: np.ndarray) -> np.ndarray:
        """Checksums of ``before`` + space + word."""
        table, out = np.minimum(size + 1, TABLE_BYTES), spaced.copy()
        for k in range(4):
            out ^= self.tables[table, k, (before >> np.uint32(8 * k)) & np.uint32(255)]
        for i in np.flatnonzero(size >= TABLE_BYTES).tolist():
            out[i] = zlib.crc32(joined[start[i]:start[i] + size[i]], zlib.crc32(b" ", int(before[i])))
        return out

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; and by feature its text and its bucket. A line feed, which no word holds, parts the texts."""
        data, offsets = text_bytes(column)
        joined = data.tobytes().translate(LOWER)
        start, size, alone, spaced = self.words(joined)
        doc = np.searchsorted(offsets, start, "right") - 1
        docs, buckets, gram = [doc], [alone % np.uint32(self.buckets)], alone
        for n in range(1, self.longest):
            gram = self.behind(gram[:-1], joined, start[n:], size[n:], spaced[n:]) if len(gram) else gram
            inside = doc[:len(gram)] == doc[n:]  # all words of the run are of one text
            docs.append(doc[:len(gram)][inside])
            buckets.append(gram[inside] % np.uint32(self.buckets))
        return np.bincount(doc, minlength=len(column)), np.concatenate(docs), np.concatenate(buckets)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts by bucket. Each task sends one row per bucket it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts = Features(buckets, longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in batches_of(batch, "text", BATCH_BYTES):
                counts += np.bincount(features(part.column("text"))[2], minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.record_batch({"bucket": pa.array(met.astype(np.int32)), "n": pa.array(counts[met])})

    found = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    rows = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Thousandths of the log odds, rounded down, that a feature is of the target rather than of the source; one is
    added to every bucket."""
    every, whole, part = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (whole + every)) / float((s + 1) * (part + every))))
        for t, s in zip(target.tolist(), source.tolist())
    ], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """(row, n_words, n_features, weight): each row of ``docs`` as a struct, and the sum of gains over its features."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, worth = Features(buckets, longest), gain.astype(np.float64)
        for batch in batches:
            for part in batches_of(batch, "text", BATCH_BYTES):
                words, doc, bucket = features(part.column("text"))
                count = np.bincount(doc, minlength=part.num_rows)
                weight = np.bincount(doc, worth[bucket], part.num_rows)  # whole numbers below 2**53 are exact
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), *(pa.array(a.astype(np.int64)) for a in (words, count, weight))],
                    ["row", "n_words", "n_features", "weight"])

    kept = [c for c in docs.columns if c != text_col] or docs.columns
    given = docs.select(F.struct(*kept).alias("row"), F.col(text_col).cast("string").alias("text"))
    kind = given.schema["row"].dataType.simpleString()
    return given.mapInArrow(run, f"row {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a standard Gumbel variable, from a hash of seed and id; a NULL id counts as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def drawn(scored: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, id_col: str = "id") -> DataFrame:
    """Adds rank (from 1, NULL where not drawn): of the rows with ``least_words`` words or more the ``share`` percent with
    the highest scores, ties to the smaller id, NULL ids last. ``scored`` is read several times: stage it first.

    Only rows past a quantile just below the cut are sorted. Its rank error is a tenth of the room left for it, so they
    are never too few, and they are counted: where they are, all rows are sorted.
    """
    able = scored.filter(F.col("n_words") >= least_words)
    low = max(0.0, 1 - share / 100 - 0.001)
    total, floor = able.agg(F.count(F.lit(1)), F.percentile_approx("score", low, 10_000)).first()
    size = share * total // 100
    if not size:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = F.coalesce((F.col("n_words") >= least_words) & (F.col("score") >= floor), F.lit(False))
    if scored.filter(near).count() < size:
        near = F.col("n_words") >= least_words
    # Row numbers put NULLs first and the smallest first.
    order = scored.filter(near).withColumns({"__down": -F.col("score"), "__none": F.col(id_col).isNull()})
    ranked = row_index(order, ["__down", "__none", id_col], name="rank").drop("__down", "__none")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < size, F.col("rank") + 1))
    return ranked.unionByName(scored.filter(~near).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, *, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED,
    buckets: int = BUCKETS, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every document as the columns of ``docs`` without the text in a struct ``row``, with id, n_words, n_features,
    weight, score and rank: documents drawn without replacement with odds by how much likelier their words are in ``target``.

    Features are the runs of one to ``longest`` words of a text, hashed into ``buckets``. A batch's texts are joined
    into one string, one regex pass finds its words, and runs that reach over the end of a text are masked before they are
    counted. ``weight`` is the sum of ``gains``; ``score`` adds Gumbel noise, and the highest scores are drawn.

    NULL and empty texts have no words, weight 0 and are not drawn. Documents below ``least_words`` words are not drawn
    either. Rows that repeat an id have the same noise and are drawn each by its own weight; equal rows take neighbouring
    ranks. A very long text is a batch of its own, its words held as numbers (28 bytes a word). An empty table gives no
    rows; an empty target makes all features alike but for their counts in ``docs``. Other columns pass through.
    """
    gain = gains(bucket_counts(target, text_col, buckets, longest), bucket_counts(docs, text_col, buckets, longest))
    weighed = weigh(docs, gain, text_col, longest)
    scored = weighed.withColumn("id", F.col("row")[id_col]).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    return drawn(stage(scored, "resampling-scores"), share, least_words)


def sql() -> str:
    """The same for the tables ``documents`` and ``benchmark``, in DuckDB's SQL."""
    table = []  # CRC-32 by half bytes, low half first
    for i in range(16):
        c = i
        for _ in range(4):
            c = c >> 1 ^ 0xEDB88320 * (c & 1)
        table.append(c)
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH w AS (SELECT doc_id AS id, 0 AS side, row_number() OVER () AS r, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL SELECT item_id, 1, -row_number() OVER (), regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
g AS (SELECT r, side, unnest(flatten(list_transform([1, 2, 3], lambda n: CASE WHEN len(w) >= n THEN
    list_transform(generate_series(1, len(w) - n + 1), lambda i: array_to_string(w[i:i + n - 1], ' ')) ELSE [] END))) AS f FROM w),
k AS (SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    string_split(regexp_replace(hex(encode(f)), '(.)(.)', '\2\1', 'g'), ''), lambda d: (strpos('0123456789ABCDEF', d) - 1)::BIGINT)),
    lambda c, d: xor(c >> 4, ({table}::BIGINT[])[(xor(c, d) & 15) + 1]))) % {BUCKETS} AS b FROM (SELECT DISTINCT f FROM g)),
x AS (SELECT r, side, b FROM g JOIN k USING (f)),
n AS (SELECT b, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM x GROUP BY b),
a AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM n),
e AS (SELECT b, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + {BUCKETS})) / ((s + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS gain FROM n, a),
v AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM x JOIN e USING (b) WHERE side = 0 GROUP BY r),
d AS (SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{SEED}:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h FROM w LEFT JOIN v USING (r) WHERE w.side = 0),
z AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS able FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {LEAST_WORDS} AND place <= {SHARE} * able // 100 THEN place END AS rank FROM o"""
