"""Suffix-array dedup: byte strings that stand earlier, found in suffix arrays of shards built by induced sorting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, bits_of, filter_bits, key_filter, mixed, passes, text_bytes
from tidemark.session import stage

WINDOW = 100
#: Bytes of the runs whose hash anchors a window: the smallest hash among a window's runs.
ANCHOR = 32
#: Bytes of text in one suffix array, about.
SHARD_BYTES = 1 << 18
#: An anchor whose different segments have more bytes than this, too many for one task to sort, goes window by window.
HOT_BYTES = 1 << 22
#: Bytes whose anchors are found at once; places inside fit in the low bits that ``POSITION`` masks.
BLOCK = 1 << 16
POSITION = np.uint64((1 << 20) - 1)
#: No byte of UTF-8: parts the strings of a shard.
PARTING = 0xFF
#: Alphabets up to this size are sorted by whole buckets at once.
SMALL_ALPHABET = 512


# Suffix arrays


def _types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S); the last one is."""
    step = np.diff(s)
    differs = step != 0
    # Runs of one character take the type of what follows; s ends with its only smallest character.
    after = np.cumsum(differs) - differs
    return np.append((step[differs] > 0)[after], True)


def _induced(s: np.ndarray, small: np.ndarray, marked: np.ndarray, alphabet: int) -> np.ndarray:
    """Suffix order induced from the order of the leftmost-smaller (LMS) suffixes ``marked``: larger ones from left to
    right, smaller ones from right to left. A bucket's entries are taken all at once; those they add to it, next."""
    n = len(s)
    count = np.bincount(s, minlength=alphabet)
    end = np.cumsum(count)
    head, tail = end - count, end.copy()
    out = np.full(n, -1, np.int64)
    held = np.bincount(s[marked], minlength=alphabet)
    by = marked[np.argsort(s[marked], kind="stable")]
    first = end - held
    out[np.repeat(first - (np.cumsum(held) - held), held) + np.arange(len(by))] = by

    def put(entries: np.ndarray, smaller: bool) -> None:
        before = entries[entries > 0] - 1
        before = before[small[before] == smaller]
        c = s[before]
        order = np.argsort(c, kind="stable")
        c, before = c[order], before[order]
        new = np.flatnonzero(np.append(True, c[1:] != c[:-1])) if len(c) else np.zeros(0, np.int64)
        size = np.diff(np.append(new, len(c)))
        nth = np.arange(len(c)) - np.repeat(new, size)
        if smaller:
            out[tail[c] - 1 - nth] = before
            tail[c[new]] -= size
        else:
            out[head[c] + nth] = before
            head[c[new]] += size

    present = np.flatnonzero(count)
    for c in present.tolist():
        at = end[c] - count[c]
        while at < head[c]:
            at, to = head[c], slice(at, head[c])
            put(out[to], False)
        if held[c]:
            put(out[end[c] - held[c]:end[c]], False)
    for c in present[::-1].tolist():
        at = end[c]
        while at > tail[c]:
            at, to = tail[c], slice(tail[c], at)
            put(out[to][::-1], True)
        larger = slice(end[c] - count[c], head[c])
        put(out[larger][::-1], True)
    out[0] = n - 1
    return out


def _induced_by_one(s: np.ndarray, small: np.ndarray, marked: np.ndarray, alphabet: int) -> np.ndarray:
    """The same entry by entry, for the large alphabets of names. Place n stands for an entry not known yet."""
    n = len(s)
    end = np.cumsum(np.bincount(s, minlength=alphabet))
    held = np.bincount(s[marked], minlength=alphabet)
    out = np.full(n, n, np.int64)
    out[np.repeat(end - held - (np.cumsum(held) - held), held) + np.arange(len(marked))] = marked[np.argsort(s[marked], kind="stable")]
    # By place: the character of the place before it, if that is larger (smaller) than its next one.
    before, smaller = np.append(s[-1:], s), np.append(True, small)
    larger = np.where(smaller, -1, before).tolist()
    smaller = np.where(smaller, before, -1).tolist()
    smaller[0] = smaller[n] = larger[n] = -1
    head, tail, out = (end - np.bincount(s, minlength=alphabet)).tolist(), end.tolist(), out.tolist()
    for i in out:  # reads what it has put in before
        c = larger[i]
        if c >= 0:
            at = head[c]
            out[at] = i - 1
            head[c] = at + 1
    for i in reversed(out):
        c = smaller[i]
        if c >= 0:
            at = tail[c] - 1
            out[at] = i - 1
            tail[c] = at
    out[0] = n - 1
    return np.array(out, np.int64)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of all suffixes of ``s`` in sorted order; ``s`` ends with its smallest value, which stands nowhere else.

    Suffixes are classified as smaller or larger than the next one. The leftmost of each run of smaller ones are sorted
    by what they spell up to the next, the order induced from their first characters; equal spellings get equal names, and
    where names repeat, the string of names is sorted the same way. All other suffixes are induced from them.
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    alphabet, small = int(s.max()) + 1, _types(s)
    marked = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induced = _induced if alphabet <= SMALL_ALPHABET else _induced_by_one
    induce = lambda order: induced(s, small, order, alphabet)
    place = np.full(n, -1, np.int64)
    place[marked] = np.arange(len(marked))
    rough = induce(marked)
    rough = rough[place[rough] >= 0]
    size = np.append(np.diff(marked) + 1, 1)[place[rough]]
    differs = np.append(True, size[1:] != size[:-1])
    alike = np.flatnonzero(~differs)
    total = size[alike]
    edge = np.cumsum(total) - total
    inside = np.arange(total.sum()) - np.repeat(edge, total)
    other = s[np.repeat(rough[alike - 1], total) + inside] != s[np.repeat(rough[alike], total) + inside]
    if len(alike):
        differs[alike] = np.add.reduceat(other, edge, dtype=np.int64) > 0
    name = np.cumsum(differs) - 1
    named = np.empty(len(marked), np.int64)
    named[place[rough]] = name
    order = suffix_array(named) if name[-1] + 1 < len(marked) else np.argsort(named)
    return induce(marked[order])


def permuted_prefixes(data: np.ndarray, order: np.ndarray, most: int, sample: int = 16) -> np.ndarray:
    """For each place of ``data`` the length, up to ``most``, of what its suffix shares with the one sorted before it, in
    order of the text. There the length falls by one a step at most, so a sampled place that shares enough settles
    those behind it, and only the rest is compared."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.append(data, np.arange(most + sample + 16, dtype=np.uint64).astype(np.uint8))
    words = np.ndarray((len(padded) - 7,), "<u8", padded.tobytes(), strides=(1,))

    def compared(at: np.ndarray, limit: int) -> np.ndarray:
        out, alive = np.zeros(len(at), np.int64), np.flatnonzero(before[at] >= 0)
        for k in range(0, limit, 8):
            a, b = at[alive] + k, before[at[alive]] + k
            inside = n - np.maximum(a, b)
            differing = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
            same = differing == 0
            other = differing[~same]
            # The lowest bit that differs tells the first byte that does.
            low = np.log2((other & (~other + np.uint64(1))).astype(np.float64)).astype(np.int64) >> 3
            out[alive[~same]] += np.clip(np.minimum(low, inside[~same]), 0, 8)
            out[alive[same]] += np.clip(inside[same], 0, 8)
            alive = alive[same & (inside > 8)]
            if not len(alive):
                break
        return np.minimum(out, limit)

    sampled = compared(np.arange(0, n, sample), most + sample)
    out = np.repeat(sampled, sample)[:n] - np.tile(np.arange(sample), len(sampled))[:n]
    rest = np.flatnonzero((out < most) & (np.arange(n) % sample != 0))
    out[rest] = compared(rest, most)
    return np.clip(out, 0, most)


# Segments


class Cutter:
    """Cuts texts into segments: maximal runs of windows with the same anchor, the leftmost smallest hash of the runs of ``anchor``
    bytes in a window. Equal windows have equal anchors, so all copies of a window lie in segments of one key, and no
    segment holds a window twice."""

    def __init__(self, window: int, anchor: int) -> None:
        self.window, self.anchor = window, min(anchor, window)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """By segment: text, first byte of ``data``, number of windows, key."""
        wide = self.window - self.anchor + 1
        for lo in range(0, max(0, len(data) - self.window + 1), BLOCK):
            part = data[lo:lo + BLOCK + self.window - 1]
            grams = len(part) - self.anchor + 1
            key = self.hashes(part, grams)
            best = (key & ~POSITION) | np.arange(grams, dtype=np.uint64)
            span, spare = 1, key.copy()
            while span < wide:  # the smallest of ``span`` runs, then of twice as many
                step = min(span, wide - span)
                best, spare = np.minimum(best[:-step], best[step:], out=spare[:len(best) - step]), best
                span += step
            texts = np.arange(np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, lo + len(best), "left"))
            inside = np.clip(np.append(offsets[texts], lo + len(best)) - lo, 0, len(best))
            doc = np.repeat(texts, np.diff(inside))
            # Windows that end in their own text; the byte after a text parts it from the next.
            at = np.flatnonzero(np.arange(lo + self.window, lo + self.window + len(best)) < np.repeat(offsets[texts + 1], np.diff(inside)))
            doc, place = doc[at], (best[at] & POSITION).astype(np.int64)
            if len(at):
                first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)))
                # Smallest hashes are small: mixed again, they spread over the filters.
                yield doc[first], at[first] + lo, np.diff(np.append(first, len(at))), mixed(~key[place[first]])

    def hashes(self, part: np.ndarray, grams: int) -> np.ndarray:
        key = np.full(grams, np.uint64(self.window))
        if self.anchor < 8:
            columns = [part[j:j + grams] for j in range(self.anchor)]
        else:  # eight bytes at once, the last eight where they end
            words = np.ndarray((len(part) - 7,), "<u8", part.tobytes(), strides=(1,))
            columns = [words[j:j + grams] for j in sorted({*range(0, self.anchor - 7, 8), self.anchor - 8})]
        for column in columns:
            key *= np.uint64(0x9E3779B97F4A7C15)
            key += column
        key ^= key >> np.uint64(32)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        return key


def key_counts(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(key, n): anchors and how often they stand, by slice of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Cutter(window, anchor)
        for batch in batches:
            for part in batches_of(batch, "text"):
                for _, _, _, key in cut(*text_bytes(part.column("text"))):
                    key, n = np.unique(key, return_counts=True)
                    yield pa.record_batch({"key": pa.array(key.view(np.int64)), "n": pa.array(n)})

    return docs.select("text").mapInArrow(run, "key long, n long")


def held(part: pa.RecordBatch, cut: Cutter, known: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """By segment whose key the filter ``known`` has: row, first byte in the text, windows, key, digest, and where it lies in the
    bytes of all texts, which come first."""
    data, offsets = text_bytes(part.column("text"))
    flat = memoryview(data)
    for doc, first, windows, key in cut(data, offsets):
        kept = passes(known, key)
        doc, first, windows, key = doc[kept], first[kept], windows[kept], key[kept]
        ends = first + windows + cut.window - 1
        digest = np.fromiter((xxhash.xxh64_intdigest(flat[a:b], 5) for a, b in zip(first.tolist(), ends.tolist())), np.uint64, len(key))
        if len(key):
            yield flat, doc, first - offsets[doc], windows, key, digest, first, ends


def segments_of(docs: DataFrame, known: np.ndarray, window: int, anchor: int) -> DataFrame:
    """(key, digest, id, mark, first, windows) of the segments whose key the filter ``known`` has."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, known = Cutter(window, anchor), shared.value
        for batch in batches:
            for part in batches_of(batch, "text"):
                for _, doc, first, windows, key, digest, _, _ in held(part, cut, known):
                    rows = pa.array(doc)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), part.column("id").take(rows), part.column("mark").take(rows),
                        pa.array(first), pa.array(windows.astype(np.int32))], ["key", "digest", "id", "mark", "first", "windows"])

    return docs.select("id", "mark", "text").mapInArrow(run, "key long, digest long, id long, mark long, first long, windows int")


def texts_of(docs: DataFrame, known: np.ndarray, hot: np.ndarray, wanted: np.ndarray, shards: int, window: int, anchor: int) -> DataFrame:
    """(shard, id, mark, first, body) of the segments whose key ``known`` and whose place ``wanted`` has; shard -1 for those with a key
    that ``hot`` has. What else gets through a filter stands where it stands and changes nothing."""
    shared = docs.sparkSession.sparkContext.broadcast((known, hot, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, (known, hot, wanted) = Cutter(window, anchor), shared.value
        for batch in batches:
            for part in batches_of(batch, "text"):
                ids = part.column("id").to_numpy(zero_copy_only=False)
                for flat, doc, first, _, key, digest, a, b in held(part, cut, known):
                    at = ids[doc].astype(np.uint64) ^ (first.astype(np.uint64) << np.uint64(7))  # as ``place`` has it
                    there = passes(wanted, digest ^ (at << np.uint64(64 - bits_of(wanted))))
                    body = [bytes(flat[x:y]) for x, y in zip(a[there].tolist(), b[there].tolist())]
                    shard = np.where(passes(hot, key[there]), -1, (key[there] % np.uint64(shards)).astype(np.int64))
                    rows = pa.array(doc[there])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard), part.column("id").take(rows), part.column("mark").take(rows), pa.array(first[there]), pa.array(body, pa.binary())],
                        ["shard", "id", "mark", "first", "body"])

    return docs.select("id", "mark", "text").mapInArrow(run, "shard long, id long, mark long, first long, body binary")


def place(bits: int) -> Column:
    """A number for a segment and where it stands, to be looked up in a filter of ``bits``."""
    return F.col("digest").bitwiseXOR(F.shiftleft(F.col("id").bitwiseXOR(F.shiftleft("first", 7)), 64 - bits))


def parted(segments: DataFrame, name: str, window: int) -> tuple[DataFrame, DataFrame]:
    """The first holder of each different segment (key, digest, id, mark, first, windows), and as spans (id, mark, from, to) what all later
    holders lose: every window of a segment that stands earlier does too.

    A filter of the first holders tells most later ones as they are read, and their touching spans are joined there; only
    what it cannot tell is compared with the first holders themselves.
    """
    first = F.min(F.struct("id", "mark", "first", "windows")).alias("place")
    firsts = stage(segments.groupBy("key", "digest").agg(first).select("key", "digest", "place.*"), f"{name}-firsts")
    bits = filter_bits(firsts.count())
    shared = segments.sparkSession.sparkContext.broadcast(key_filter(firsts.select(place(bits).alias("place")), "place", bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = shared.value
        for batch in batches:
            id_, mark, lo, hi, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "mark", "from", "to", "place"))
            open_ = passes(filter_, at.view(np.uint64))
            new = open_ | np.append(True, open_[:-1] | (np.diff(id_) != 0) | (np.diff(mark) != 0) | (lo[1:] > hi[:-1]) | (lo[1:] < lo[:-1]))[:len(lo)]
            heads = np.flatnonzero(new)
            ends = hi[np.append(heads[1:], len(lo)) - 1] if len(lo) else hi
            yield pa.record_batch({"id": pa.array(id_[heads]), "mark": pa.array(mark[heads]), "from": pa.array(lo[heads]), "to": pa.array(ends), "open": pa.array(open_[heads])})

    slim = segments.select("id", "mark", F.col("first").alias("from"), (F.col("first") + F.col("windows") + window - 1).alias("to"), place(bits).alias("place"))
    spans = stage(slim.mapInArrow(run, "id long, mark long, `from` long, `to` long, open boolean"), f"{name}-spans")
    told = spans.filter("open").drop("open").join(firsts.select("id", "mark", F.col("first").alias("from")), ["id", "mark", "from"], "left_anti")
    return firsts, spans.filter("NOT open").drop("open").unionByName(told)


def repeated(bodies: list[bytes], rank: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``bodies`` that stand earlier: the number of the body and the place in it. Body i lies in document ``rank[i]``
    from byte ``first[i]`` on; earlier is a smaller document or, in one document, a smaller place."""
    size = np.array([len(b) + 1 for b in bodies], np.int64)
    start = np.cumsum(size) - size
    data = np.frombuffer(bytes([PARTING]).join(bodies) + bytes([PARTING]), np.uint8)
    order = suffix_array(np.append(data.astype(np.int16) + np.int16(1), np.int16(0)))
    shares = permuted_prefixes(np.append(data, np.uint8(0)), order, window)
    body = np.repeat(np.arange(len(bodies)), size)
    inside = np.arange(len(data)) - start[body]
    order = order[1:]
    order = order[inside[order] + window < size[body[order]]]  # whole windows; two equal ones have only such between them
    group = np.cumsum(np.append(True, shares[order[1:]] < window)) - 1 if len(order) else np.zeros(0, np.int64)
    place = (rank[body[order]] << np.int64(32)) + first[body[order]] + inside[order]
    heads = np.flatnonzero(np.append(True, np.diff(group) != 0)) if len(order) else np.zeros(0, np.int64)
    earliest = np.minimum.reduceat(place, heads) if len(order) else place
    late = order[place > earliest[group]]
    return body[late], inside[late]


def spans_of_shards(texts: DataFrame, window: int) -> DataFrame:
    """(id, mark, from, to): bytes of the windows of each shard's segments that stand earlier."""

    def run(shard: pa.Table) -> pa.Table:
        id_, mark, first = (shard.column(c).to_numpy() for c in ("id", "mark", "first"))
        docs = np.rec.fromarrays([id_, mark])
        _, rank = np.unique(docs, return_inverse=True)
        body, inside = repeated(shard.column("body").to_pylist(), rank.reshape(-1).astype(np.int64), first, window)
        order = np.lexsort((inside, body))
        body, inside = body[order], inside[order]
        heads = np.flatnonzero(np.append(True, (np.diff(body) != 0) | (np.diff(inside) != 1))) if len(body) else np.zeros(0, np.int64)
        tails = np.append(heads[1:], len(body)) - 1
        own = body[heads]
        return pa.table({"id": pa.array(id_[own]), "mark": pa.array(mark[own]), "from": pa.array(first[own] + inside[heads]),
                         "to": pa.array(first[own] + inside[tails] + window if len(heads) else first[own])})

    return texts.groupBy("shard").applyInArrow(run, "id long, mark long, `from` long, `to` long")


def windows_of(texts: DataFrame, window: int) -> DataFrame:
    """Segments of one window each, by the hash of its bytes: (key, digest, id, mark, first, windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, mark, first, body in zip(*(batch.column(c).to_pylist() for c in ("id", "mark", "first", "body"))):
                n, flat = len(body) - window + 1, memoryview(body)
                key, digest = (np.fromiter((xxhash.xxh64_intdigest(flat[i:i + window], seed) for i in range(n)), np.uint64, n) for seed in (5, 6))
                yield pa.RecordBatch.from_arrays([
                    pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(np.full(n, id_, np.int64)), pa.array(np.full(n, mark, np.int64)),
                    pa.array(first + np.arange(n)), pa.array(np.ones(n, np.int32))], ["key", "digest", "id", "mark", "first", "windows"])

    return texts.mapInArrow(run, "key long, digest long, id long, mark long, first long, windows int")


def repeats(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Spans (id, mark, from, to) of bytes of documents (id, mark, text) that lie in a window of ``window`` bytes which also starts
    earlier. Documents go by id, then by mark. Spans of one document may overlap.

    1. Every window has an anchor, the run of ``anchor`` bytes in it with the smallest hash; runs of windows with one
       anchor are segments. Anchors that stand once are left out by a bitmap that grows with the others up to 64 MB (a full one
       lets them pass: they cost time then, and change nothing).
    2. Equal segments are reduced to the first holder, map side first. Later holders lose all their windows.
    3. Where an anchor has several different segments, these go to a shard by their key, about ``shard_bytes`` in each. The
       shard's suffix array and permuted common prefixes bring equal windows together; all but the earliest go.
    4. An anchor with over ``hot_bytes`` of different segments (a passage in very many surroundings) is cut into single
       windows instead, which are reduced as in step 2: no shard grows with it.
    """
    docs = docs.filter("id IS NOT NULL AND text IS NOT NULL")
    keys = key_counts(docs, window, anchor).groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    keys = stage(keys, "suffix-keys")
    segments = stage(segments_of(docs, key_filter(keys, "key", filter_bits(keys.count())), window, anchor), "suffix-segments")
    firsts, spans = parted(segments, "suffix", window)
    size = F.sum(F.col("windows").cast("long") + window)
    groups = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).filter("n > 1")
    groups = stage(groups.withColumn("hot", F.col("bytes") > hot_bytes), "suffix-groups")
    total, n_keys, n_places = groups.agg(F.sum(F.when(~F.col("hot"), F.col("bytes"))), F.count(F.lit(1)), F.sum("n")).first()
    bits = filter_bits(n_places or 0)
    wanted = firsts.join(groups.select("key"), "key", "left_semi").select(place(bits).alias("place"))
    filters = key_filter(groups, "key", filter_bits(n_keys)), key_filter(groups.filter("hot"), "key"), key_filter(wanted, "place", bits)
    texts = stage(texts_of(docs, *filters, max(1, -(-(total or 0) // shard_bytes)), window, anchor), "suffix-texts")
    sorted_ = spans_of_shards(texts.filter("shard >= 0"), window)
    singles = stage(windows_of(texts.filter("shard < 0"), window), "suffix-windows")
    return spans.unionByName(sorted_).unionByName(parted(singles, "suffix-singles", window)[1])


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): each document's UTF-8 bytes without those in a string of ``window`` bytes that also
    starts earlier, in a document with a smaller id or before it in the same one; ``n_spans`` counts the maximal removed runs.
    Strings are judged on the input, overlaps count, and ``kept`` is binary, as a cut may fall into a character.

    NULL and empty texts have no bytes. A document without an id is returned whole and is nobody's reference. Rows that
    repeat an id are documents of their own, in the order of a hash of their texts; rows equal in id and text are one
    document, and each gets its result. Texts shorter than a window stay whole. Very long texts are cut in blocks. Other columns
    are ignored. An empty table gives no rows.
    """
    own = F.col(id_col).cast("long")
    repeated_ids = docs.groupBy(own.alias("id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND id IS NOT NULL")
    # Only where ids repeat are the texts' hashes carried along to tell rows apart.
    mark = F.lit(0).cast("long") if repeated_ids.isEmpty() else F.xxhash64(text_col)
    marked = docs.select(own.alias("id"), mark.alias("mark"), F.col(text_col).cast("string").alias("text"))
    listed = repeats(marked, window=window, **options).groupBy("id", "mark").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans"))
    listed = stage(listed, "suffix-removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text"):
                out = []
                for text, spans in zip(part.column("text"), part.column("spans")):
                    data = (text.as_py() or "").encode()
                    kept, end, runs = [], 0, 0
                    if spans.is_valid:
                        lo, hi = (spans.values.field(c).to_numpy() for c in ("from", "to"))
                        reach = np.maximum.accumulate(hi)
                        new = np.append(True, lo[1:] > reach[:-1])  # touching spans are one run
                        for a, b in zip(lo[new].tolist(), reach[np.append(new[1:], True)].tolist()):
                            kept.append(data[end:a])
                            end, runs = b, runs + 1
                    kept = b"".join([*kept, data[end:]])
                    out.append((len(data), len(data) - len(kept), runs, kept))
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary())))],
                                                 ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = marked.join(listed, ["id", "mark"], "left").select("id", "text", "spans")
    return joined.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("id", id_col)


#: The same for the table ``documents`` in DuckDB's SQL.
SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, x, unnest(generate_series(0, len(x) // 2 - {WINDOW})) AS a FROM d),
g AS (SELECT doc_id, a, md5(substr(x, 2 * a + 1, {2 * WINDOW})) AS h FROM p),
o AS (SELECT doc_id, a FROM g QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, a) > 1),
n AS (SELECT *, coalesce(a - lag(a) OVER (PARTITION BY doc_id ORDER BY a) > {WINDOW}, true) AS new FROM o),
r AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY a) AS run FROM n),
s AS (SELECT doc_id, min(a) AS lo, max(a) + {WINDOW} AS hi FROM r GROUP BY doc_id, run),
e AS (SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans FROM s GROUP BY doc_id),
c AS (SELECT doc_id, lo, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS after FROM s
    UNION ALL SELECT doc_id, len(x) // 2, coalesce((SELECT max(hi) FROM s WHERE s.doc_id = d.doc_id), 0) FROM d),
k AS (SELECT doc_id, string_agg(substr(x, 2 * after + 1, 2 * (lo - after)), '' ORDER BY lo, after) AS kept FROM c JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN e USING (doc_id) LEFT JOIN k USING (doc_id)"""
