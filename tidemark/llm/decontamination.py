"""Benchmark decontamination by spaced seeds: masks that skip token positions, then verified overlaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHasher, batches_of, filter_bits, is_no_word, key_filter, mixed, passes, text_bytes, word_spans
from tidemark.session import stage

#: Tokens of an aligned overlap, and how many of them must be equal. Shorter items must overlap as a whole.
OVERLAP = 13
EQUAL = 0.8
#: Masks by (tokens of an overlap, tokens of it that may differ). A 1 takes the token at that position, a 0 lets any
#: token pass. Wherever the differing tokens lie, one of the masks fits between them at some place of the overlap.
FAMILIES = {
    (5, 1): ("1111", "11101", "11011", "10111"),
    (6, 1): ("1111", "110011"),
    (7, 1): ("101111", "1111001", "1010111"),
    (8, 1): ("111111", "11110011", "11001111"),
    (9, 1): ("11011101", "1110111"),
    (10, 2): ("1110111", "11011011", "111100011", "110001111", "10111101"),
    (11, 2): ("1111011", "101001111", "1101100011", "110100111"),
    (12, 2): ("11101111", "1110010111", "10010111011", "10111100101"),
    (13, 2): ("111101111", "1110111011", "11010011111", "111110000111", "110011101011"),
}


def tokens_of(column: pa.Array, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the tokens of a column and the token offset of each text. A token is a run of letters and
    digits, lower-cased; punctuation does not count."""
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends = word_spans(data, is_no_word())
    return hasher(data, starts, ends), np.searchsorted(starts, offsets)


def needed(wide: int, equal: float) -> int:
    """Tokens that must be equal in an overlap of ``wide``."""
    return int(np.ceil(equal * wide))


def masks_of(wide: int, equal: float) -> tuple[str, ...]:
    """Masks of which one fits every overlap of ``wide`` tokens that the check accepts. Overlaps that must be equal as a
    whole have a mask of their own, written with ``=``. Without a family, it is the run that some gap between the
    differing tokens must have."""
    differ = wide - needed(wide, equal)
    if not differ:
        return ("=" * wide,)
    return FAMILIES.get((wide, differ)) or ("1" * max(1, -(-(wide - differ) // (differ + 1))),)


def seed_keys(tokens: np.ndarray, mask: str) -> np.ndarray:
    """A key for each place where the mask fits, over the whole array."""
    size = max(0, len(tokens) - len(mask) + 1)
    key = np.full(size, np.uint64(2 * int(mask.replace("=", "1"), 2) + ("=" in mask)))
    for j, take in enumerate(mask):
        if take != "0":
            key = key * np.uint64(0x9E3779B97F4A7C15) + tokens[j:j + size]
    return mixed(key)


def inside(offsets: np.ndarray, span: int, size: int) -> np.ndarray:
    """Whether the ``span`` tokens from each place lie in one text."""
    text = np.searchsorted(offsets, np.arange(size), "right")
    return np.arange(size) + span <= offsets[np.minimum(text, len(offsets) - 1)]


def benchmark_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, copies, tokens): items with equal tokens are one, under the smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for part in batches_of(batch, "text"):
                tokens, offsets = tokens_of(part.column("text"), hasher)
                held = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("id"), held], ["id", "tokens"])

    picked = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    return picked.mapInArrow(run, "id long, tokens array<long>").groupBy("tokens").agg(F.min("id").alias("item_id"), F.count("*").alias("copies"))


def item_seeds(items: DataFrame, masks: dict[int, tuple[str, ...]]) -> DataFrame:
    """(key, item_id, place) of every place in the items of the masks for their length; longer items have those of the
    longest."""
    longest = max(masks, default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("tokens")
            offsets = np.asarray(held.offsets.to_numpy(), np.int64) - held.offsets[0].as_py()
            tokens = held.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            ids = batch.column("item_id").to_numpy(zero_copy_only=False)
            size = np.minimum(np.diff(offsets), longest)
            for mask in sorted({m for family in masks.values() for m in family}):
                keys = seed_keys(tokens, mask)
                at = np.flatnonzero(inside(offsets, len(mask), len(keys)))
                own = np.searchsorted(offsets, at, "right") - 1
                fit = np.isin(size[own], [n for n, family in masks.items() if mask in family])
                at, own = at[fit], own[fit]
                yield pa.record_batch({"key": pa.array(keys[at].view(np.int64)), "item_id": pa.array(ids[own], pa.int64()),
                                       "place": pa.array((at - offsets[own]).astype(np.int32))})

    return items.select("item_id", "tokens").mapInArrow(run, "key long, item_id long, place int")


RUN = "id long, first int, tokens array<long>, seeds array<struct<place:int,key:long>>"


def candidate_runs(docs: DataFrame, filter_: np.ndarray, id_col: str, text_col: str, overlap: int, masks: list[str]) -> DataFrame:
    """Stretches of documents around seeds that the filter knows: the tokens with a margin, and the seeds in them. Of
    items that must be equal as a whole, the first place in a document is the best one, so the others are left out."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(filter_)
    widest = max([overlap, *map(len, masks)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = WordHasher(), shared.value
        for batch in batches:
            for part in batches_of(batch, "text"):
                tokens, offsets = tokens_of(part.column("text"), hasher)
                at, key = [], []
                for mask in masks:
                    keys = seed_keys(tokens, mask)
                    hit = np.flatnonzero(passes(known, keys))
                    text = np.searchsorted(offsets, hit, "right")
                    fit = hit + len(mask) <= offsets[np.minimum(text, len(offsets) - 1)]
                    hit, text = hit[fit], text[fit]
                    if "=" in mask and len(hit):
                        order = np.lexsort((hit, keys[hit], text))
                        new = np.append(True, (np.diff(text[order]) != 0) | (np.diff(keys[hit][order].view(np.int64)) != 0))
                        hit = hit[order[new]]
                    at.append(hit)
                    key.append(keys[hit])
                at, key = np.concatenate([np.zeros(0, np.int64), *at]), np.concatenate([np.zeros(0, np.uint64), *key])
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, key = at[order], key[order]
                doc = np.searchsorted(offsets, at, "right") - 1
                new = np.append(True, (np.diff(at) > widest) | (np.diff(doc) != 0))
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(at))
                own = doc[head]
                begin = np.maximum(at[head] - overlap, offsets[own])
                end = np.minimum(at[tail - 1] + widest + overlap, offsets[own + 1])
                size = end - begin
                flat = tokens[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
                seeds = pa.StructArray.from_arrays([pa.array((at - np.repeat(begin, tail - head)).astype(np.int32)), pa.array(key.view(np.int64))], ["place", "key"])
                yield pa.RecordBatch.from_arrays([
                    part.column("id").take(pa.array(own)), pa.array((begin - offsets[own]).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(flat.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.append(head, len(at)), pa.int32()), seeds),
                ], ["id", "first", "tokens", "seeds"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, RUN)


def aligned(run: np.ndarray, item: np.ndarray, shift: int, overlap: int, equal: float) -> tuple[int, int, int] | None:
    """Equal tokens of a run and an item whose first token lies at ``shift`` of the run, counted over all windows of
    ``overlap`` tokens (the whole item, if shorter) in which the share ``equal`` agrees, and the tokens from the first
    to the last such window; None if there is no such window."""
    a, b = max(0, shift), min(len(run), shift + len(item))
    wide = min(overlap, len(item))
    if b - a < wide:
        return None
    same = run[a:b] == item[a - shift:b - shift]
    sums = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(sums[wide:] - sums[:-wide] >= needed(wide, equal))
    if not len(good):
        return None
    covered = np.zeros(len(same), bool)
    for g in good:
        covered[g:g + wide] = True
    return int((same & covered).sum()), a + int(good[0]), a + int(good[-1]) + wide


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", overlap: int = OVERLAP, equal: float = EQUAL,
) -> DataFrame:
    """One row per document and benchmark item it holds a passage of: (id, item_id, item_copies, matched_tokens,
    item_tokens, first_token, end_token). Clean documents have no row.

    A passage counts if ``overlap`` consecutive tokens of the document (or a whole shorter item) lie against tokens of
    the item with at least the share ``equal`` of them the same, so single substitutions do not hide it. Places to
    look at come from spaced seeds: every mask at every token of both sides, joined by hash. The masks go by the
    length of the overlap and miss none that the check accepts; only lengths that occur among the items are looked
    for, so a benchmark of long items costs the documents five masks. A bitmap of up to
    64 MB lets the documents drop places without a partner before the join; past some hundred million
    benchmark seeds it fills up and the join does the whole work. The join sees small rows only; tokens of a stretch
    are read once for the check.

    Items of any length take part; those of up to four tokens must be in the document as they are. Items with equal
    tokens are reported once, under the smallest id, with their number. NULL or empty texts match nothing; NULL item ids take no part; a
    NULL document id is reported as NULL; rows that repeat an id are reported together, the best match of each item.
    Other columns are ignored. An empty table on either side gives no rows.
    """
    items = stage(benchmark_items(benchmark, item_col, item_text_col), "bench-items")
    sizes = [r["n"] for r in items.select(F.least(F.size("tokens"), F.lit(overlap)).alias("n")).distinct().collect()]
    masks = {n: masks_of(n, equal) for n in sizes if n > 0}
    seeds = stage(item_seeds(items, masks), "bench-seeds")
    runs = candidate_runs(docs, key_filter(seeds, "key", filter_bits(seeds.count())), id_col, text_col, overlap, sorted({m for family in masks.values() for m in family}))
    runs = stage(runs.withColumn("run", F.monotonically_increasing_id()), "bench-runs")
    hits = runs.select("run", F.explode("seeds").alias("s")).select("run", "s.place", "s.key")
    pairs = hits.withColumnRenamed("place", "at").join(seeds, "key").select("run", "item_id", (F.col("at") - F.col("place")).alias("shift")).distinct()
    sides = pairs.join(runs.select("run", "id", "first", F.col("tokens").alias("held")), "run").join(items, "item_id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.column(name) for name in batch.schema.names}
            held, items_ = at["held"], at["tokens"]
            found = []
            for i in range(batch.num_rows):
                got = aligned(held[i].values.to_numpy(), items_[i].values.to_numpy(), at["shift"][i].as_py(), overlap, equal)
                if got:
                    found.append((at["id"][i].as_py(), at["item_id"][i].as_py(), at["copies"][i].as_py(), got[0],
                                  len(items_[i]), at["first"][i].as_py() + got[1], at["first"][i].as_py() + got[2]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), [pa.int64()] * 7)], names)

    names = ["id", "item_id", "item_copies", "matched_tokens", "item_tokens", "first_token", "end_token"]
    found = sides.mapInArrow(verify, ", ".join(f"{n} long" for n in names))
    best = F.max(F.struct("matched_tokens", (-F.col("first_token")).alias("f"), "end_token", "item_copies", "item_tokens"))
    return found.groupBy("id", "item_id").agg(best.alias("b")).select(
        F.col("id").alias(id_col), "item_id", "b.item_copies", "b.matched_tokens", "b.item_tokens", (-F.col("b.f")).alias("first_token"), "b.end_token")
