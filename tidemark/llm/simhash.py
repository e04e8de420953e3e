"""SimHash near-duplicates: fingerprints of word shingles, linked through deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of
from tidemark.llm.components import components
from tidemark.session import stage

SHINGLE = 4
DISTANCE = 4
SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the XXH64 hashes of the text's shingles; no words: 0. Hashes are
    counted in blocks, so a long text needs no large array of bits."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    n = max(1, len(words) - shingle + 1)
    a, b = starts[:n].tolist(), (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    hash_ = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        digests = b"".join([hash_(joined[x:y], SEED) for x, y in zip(a[i:i + (1 << 15)], b[i:i + (1 << 15)])])
        counts += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None) -> DataFrame:
    """(id, fp): the 64-bit fingerprint of every whole text, as a signed long; with ``mark``, a string of each row, also
    that. NULL texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text"):
                marks = np.array([fingerprint((t.as_py() or "").encode(), shingle) for t in part.column("text")], np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(marks.view(np.int64))], [*part.schema.names[:-1], "fp"])

    told = [] if mark is None else [mark.alias("mark")]
    picked = docs.select(F.col(id_col).cast("long").alias("id"), *told, F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"id long, {'mark string, ' if told else ''}fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments such that among ``distance`` differing bits one segment has at most
    one: floor(distance / segments) <= 1."""
    count = distance // 2 + 1
    cuts = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(fp: Column, distance: int) -> Column:
    """All one-wildcard signatures of a fingerprint: each segment with each of its bits deleted, 64 in all. Two equal
    signatures mean segments that differ in that bit at most. With the deleted bit's number kept beside it, the
    signature is (bit, segment without the bit)."""
    out = []
    for first, bits in segments(distance):
        mask = ((1 << bits) - 1) << first
        for bit in range(first, first + bits):
            out.append(F.struct(F.lit(bit).alias("bit"), fp.bitwiseAND(F.lit(signed(mask & ~(1 << bit)))).alias("rest")))
    return F.array(*out)


def links(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b, a < b) of distinct fingerprints that differ in ``distance`` bits at most, each pair once.

    An equality join on the signatures finds the candidates and the distance is checked in the join itself. A pair
    that shares several signatures counts in one: that of its first close segment, and there in the bit that differs,
    or in the segment's first bit if none does. Spark sizes the signatures as if each fingerprint had one, a 64th of what
    they are, and would broadcast them from the driver; the hint keeps them in a shuffle at all sizes.
    """
    listed = marks.select("fp", F.explode(variants(F.col("fp"), distance)).alias("v")).select("fp", "v.bit", "v.rest")
    left, right = listed.select(F.col("fp").alias("a"), "bit", "rest"), listed.select(F.col("fp").alias("b"), "bit", "rest")
    differs = F.col("a").bitwiseXOR(F.col("b"))
    own = F.lit(False)
    earlier = F.lit(True)
    for first, bits in segments(distance):
        mask = F.lit(signed(((1 << bits) - 1) << first))
        count = F.bit_count(differs.bitwiseAND(mask))
        here = F.col("left.bit").between(first, first + bits - 1)
        own = own | (here & earlier & ((count == 1) | (F.col("left.bit") == first)))
        earlier = earlier & (count > 1)
    return left.hint("merge").alias("left").join(right.alias("right"), (F.col("left.bit") == F.col("right.bit")) & (F.col("left.rest") == F.col("right.rest"))
        & (F.col("a") < F.col("b")) & (F.bit_count(differs) <= distance) & own).select("a", "b")


def near_duplicates(
    docs: DataFrame, *, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, fp, component): fingerprint and smallest id reachable over links of ``distance`` bits or fewer.

    Texts are lower-cased (A-Z) and cut at ASCII white space; shingles are ``shingle`` words, repeats included; a
    shorter text is one shingle; NULL, empty and blank texts have fingerprint 0 and are linked like any other. Copies
    share a fingerprint and enter the join as one row, so a group of copies, however large, makes no pairs. Groups are found
    over the fingerprints and named by the smallest id of theirs. A NULL id gets the component of its fingerprint and is never
    a representative (NULL if its fingerprint has no other). Repeated rows are returned as often as given. Other
    columns are ignored. Empty input gives no rows.

    Signatures are 64 rows per distinct fingerprint; a signature of about 20 bits is shared by chance by one in 10^6
    fingerprints, so candidates that fail the check grow with the square of the distinct fingerprints over 10^4 or so.
    """
    marks = stage(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    distinct = stage(marks.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    stars = components(links(distinct.filter("first IS NOT NULL").select("fp"), distance))
    held = distinct.join(stars, distinct["fp"] == stars["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("own group"))
    groups = held.join(held.groupBy("own group").agg(F.min("first").alias("component")), "own group").select("fp", "component")
    return marks.join(stage(groups, "simhash-groups"), "fp").select(F.col("id").alias(id_col), "fp", "component")


def deduplicated(
    docs: DataFrame, *, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents, all columns, one row of each group of near duplicates: that with the smallest id, NULL ids last, and
    among rows of that id the one with the smallest text hash. Equal rows are kept once.

    Groups are those of ``near_duplicates``, but over fingerprints alone, so rows that repeat an id with another text stay
    apart, and rows without an id are deduplicated like any other. NULL, empty and blank texts are one group. Texts of any
    length count whole. Empty input gives no rows.
    """
    mark = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    marks = stage(fingerprints(docs, shingle, id_col, text_col, mark), "simhash-marks")
    stars = components(links(marks.select("fp").distinct(), distance))
    held = marks.join(stars, marks["fp"] == stars["node"], "left").withColumn("own group", F.coalesce("component", "fp"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark"))
    firsts = held.groupBy("own group").agg(first.alias("first")).select(F.col("first.id").alias("first id"), F.col("first.mark").alias("first mark"))
    firsts = stage(firsts, "simhash-firsts")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("first id")) & (F.col("own mark") == F.col("first mark"))
    return docs.withColumn("own mark", mark).join(firsts, same, "left_semi").dropDuplicates([id_col, "own mark"]).drop("own mark")
