"""Helpers shared by the operators: tables, word hashes over Arrow buffers, bounded key filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts name it: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

MULTIPLIER = 0x9E3779B97F4A7C15 | 1
BLOCK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket_of(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets``; NULL ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the finaliser of a public generator)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def is_space() -> np.ndarray:
    """Byte table: white space of the contracts."""
    out = np.zeros(256, bool)
    out[[9, 10, 11, 12, 13, 32]] = True
    return out


def is_no_word() -> np.ndarray:
    """Byte table: anything but ASCII letters, digits and bytes of other scripts."""
    out = np.ones(256, bool)
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        out[lo:hi] = False
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, a line feed after each, and the offsets where each begins.
    NULL counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    ended = pc.binary_join_element_wise(column, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    if isinstance(ended, pa.ChunkedArray):
        ended = ended.combine_chunks()
    if not len(ended):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = ended.buffers()
    at = np.frombuffer(offsets, np.int64)[ended.offset:ended.offset + len(ended) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def word_spans(data: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end. The array must end with a separator (or be empty)."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~separators[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


class WordHasher:
    """64-bit hashes of words in a byte array: polynomial prefix sums in blocks, so no word becomes an object."""

    def __init__(self) -> None:
        self.power = np.cumprod(np.full(BLOCK, MULTIPLIER, np.uint64))
        self.inverse = np.cumprod(np.full(BLOCK, pow(MULTIPLIER, -1, 1 << 64), np.uint64))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            lo = starts[i]
            j = int(np.searchsorted(ends, lo + BLOCK, "right"))
            if j <= i:  # one word longer than a block
                out[i] = xxhash.xxh64_intdigest(data[lo:ends[i]].tobytes(), 7)
                i += 1
                continue
            hi = ends[j - 1]
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * self.power[:hi - lo], out=sums[1:])
            a, b = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (sums[b] - sums[a]) * self.inverse[a]
            i = j
        return mixed(out)


def batches_of(batch: pa.RecordBatch, column: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``most`` bytes of text, so that arrays over the bytes stay small."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64)
    slot = np.cumsum(sizes + 1) // most
    cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


#: Bits of a key filter, as a power of two: the fewest (8 MB) and the most (64 MB).
FILTER_BITS = 26
MOST_FILTER_BITS = 29
#: Bits per key that a filter should have.
SPARSE = 16


def filter_bits(n_keys: int) -> int:
    """The size of a filter that about one of ``SPARSE`` other keys passes, within the bounds above. Past some 30 million
    keys it fills up; a full one lets everything pass."""
    return min(MOST_FILTER_BITS, max(FILTER_BITS, (n_keys * SPARSE - 1).bit_length()))


def key_filter(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of 2**bits bits with a bit set for each 64-bit key.
    Executors set the bits; the driver gets words of the finished bitmap (2**(bits-6) at most)."""
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = (
        keys.select((F.shiftright(slot, 6)).alias("word"), slot.bitwiseAND(F.lit(63)).alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("set"))
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    at = words.toArrow()
    out[at.column("word").to_numpy()] = at.column("set").to_numpy()
    return out.view(np.uint64)


def bits_of(filter_: np.ndarray) -> int:
    return (len(filter_) * 64).bit_length() - 1


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys >> np.uint64(64 - bits_of(filter_))
    return (filter_[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0
