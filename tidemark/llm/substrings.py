"""Substring dedup: windows of words that an earlier document holds, found by suffix automata of reference shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import MULTIPLIER, WordHasher, batches_of, bits_of, filter_bits, is_space, key_filter, mixed, passes, text_bytes, word_spans
from tidemark.session import stage

WINDOW = 13
#: Words whose hash anchors a window: the smallest hash among a window's runs of this many words.
ANCHOR = 4
#: Words of reference text in one automaton, about.
SHARD_WORDS = 100_000
#: Anchors in more documents than this are split by window.
HOT_DOCS = 20_000
#: Bytes of text that a scan works on at once, and rows that it gives at once.
SLICE = 1 << 21
ROWS = 50_000
#: Longer words are hashed one by one.
LONG_WORD = 1024
#: Of the hash that names a hot anchor's window; its digest has another.
WINDOW_MULTIPLIER = 0xD6E8FEB86659FD93


class Cutter:
    """Cuts texts into segments: maximal runs of windows with the same anchor. Equal windows have equal anchors, so all
    copies of a window lie in segments of one key, wherever they stand."""

    def __init__(self, window: int, anchor: int) -> None:
        self.window, self.anchor, self.hasher, self.separators = window, min(anchor, window), WordHasher(), is_space()

    def __call__(self, column: pa.Array):
        """Bytes, word spans, word hashes, first word of each document; and by segment: document, first word, windows, key."""
        data, offsets = text_bytes(column)
        starts, ends = word_spans(data, self.separators)
        tokens = self.hasher(data, starts, ends)
        for i in np.flatnonzero(ends - starts > LONG_WORD):
            tokens[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]], 7)
        heads = np.searchsorted(starts, offsets)
        grams = max(0, len(tokens) - self.anchor + 1)
        wide = self.window - self.anchor + 1
        if grams < wide:
            empty = np.zeros(0, np.int64)
            return data, starts, ends, tokens, heads, empty, empty, empty, np.zeros(0, np.uint64)
        key = np.full(grams, np.uint64(self.window))
        for j in range(self.anchor):
            key = key * np.uint64(MULTIPLIER) + tokens[j:j + grams]
        best, place, span = mixed(key), np.arange(grams), 1
        while span < wide:  # the leftmost smallest of ever longer runs
            step = min(span, wide - span)
            less = best[step:] < best[:-step]
            best, place = np.where(less, best[step:], best[:-step]), np.where(less, place[step:], place[:-step])
            span += step
        doc = np.repeat(np.arange(len(heads) - 1), np.diff(heads))[:len(best)]
        at = np.flatnonzero(np.arange(self.window, len(best) + self.window) <= heads[doc + 1])
        doc, best, place = doc[at], best[at], place[at]
        new = np.append(True, (np.diff(place) != 0) | (np.diff(doc) != 0)) if len(at) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        return data, starts, ends, tokens, heads, doc[first], at[first], np.diff(np.append(first, len(at))), best[first]


class RunHasher:
    """64-bit hashes of runs of words, by prefix sums over the words' hashes."""

    def __init__(self, tokens: np.ndarray, multiplier: int) -> None:
        self.inverse = np.cumprod(np.append(np.uint64(1), np.full(len(tokens), pow(multiplier, -1, 1 << 64), np.uint64)))
        self.sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(tokens * np.cumprod(np.full(len(tokens), multiplier, np.uint64)), out=self.sums[1:])

    def __call__(self, first: np.ndarray, words: np.ndarray) -> np.ndarray:
        return mixed((self.sums[first + words] - self.sums[first]) * self.inverse[first] + words.astype(np.uint64))


def keys_of(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(key, low, high, docs): smallest and largest id per anchor and the documents that hold it, by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Cutter(window, anchor)
        for batch in batches:
            for part in batches_of(batch, "text", SLICE):
                *_, doc, _, _, key = cut(part.column("text"))
                if len(key):
                    ids = part.column("id").to_numpy(zero_copy_only=False)[doc]
                    order = np.lexsort((ids, key))
                    key, ids = key[order], ids[order]
                    other = np.append(True, key[1:] != key[:-1])
                    head = np.flatnonzero(other)
                    other[1:] |= ids[1:] != ids[:-1]
                    yield pa.record_batch({"key": pa.array(key[head].view(np.int64)), "low": pa.array(ids[head]),
                                           "high": pa.array(ids[np.append(head[1:], len(key)) - 1]),
                                           "docs": pa.array(np.add.reduceat(other.astype(np.int64), head))})

    return docs.select("id", "text").mapInArrow(run, "key long, low long, high long, docs long")


def segments_of(docs: DataFrame, known: np.ndarray, hot: np.ndarray, window: int, anchor: int, wanted: np.ndarray | None = None) -> DataFrame:
    """Segments whose anchor the filter ``known`` has: (id, mark, first, key, digest, hot). Those of a ``hot`` anchor
    are given window by window, and the hash of a window's words is its key. With ``wanted`` the texts instead, for places in
    that filter only: (key, digest, segment)."""
    shared = docs.sparkSession.sparkContext.broadcast((known, hot, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Cutter(window, anchor)
        known, hot, wanted = shared.value
        for batch in batches:
            for part in batches_of(batch, "text", SLICE):
                data, starts, ends, tokens, heads, doc, first, windows, key = cut(part.column("text"))
                kept = passes(known, key)
                if not kept.any():
                    continue
                doc, first, windows, key = doc[kept], first[kept], windows[kept], key[kept]
                alone = passes(hot, key)
                parts = np.where(alone, windows, 1)
                ids, bytes_ = part.column("id").to_numpy(zero_copy_only=False), None if wanted is None else data.tobytes()
                digest_of, key_of = RunHasher(tokens, MULTIPLIER), RunHasher(tokens, WINDOW_MULTIPLIER) if alone.any() else None
                whole = np.cumsum(parts)
                for low in range(0, int(whole[-1]), ROWS):
                    # The rows ``low`` and on, of segments in one piece or of a hot one's windows.
                    row = np.arange(low, min(low + ROWS, int(whole[-1])))
                    of = np.searchsorted(whole, row, "right")
                    single, at = alone[of], first[of] + row - (whole[of] - parts[of])
                    words = np.where(single, 1, windows[of]) + window - 1
                    digest, named, rows = digest_of(at, words), key[of], doc[of]
                    if key_of is not None:
                        named = np.where(single, key_of(at, words), named)
                    if wanted is None:
                        take = pa.array(rows)
                        yield pa.RecordBatch.from_arrays([
                            part.column("id").take(take), part.column("mark").take(take), pa.array((at - heads[rows]).astype(np.int32)),
                            pa.array(named.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(single),
                        ], ["id", "mark", "first", "key", "digest", "hot"])
                    else:
                        # As ``place`` has it.
                        there = np.flatnonzero(passes(wanted, digest ^ (ids[rows].astype(np.uint64) << np.uint64(64 - bits_of(wanted)))))
                        at, words, named, digest = at[there], words[there], named[there].view(np.int64), digest[there].view(np.int64)
                        a, b = starts[at], ends[at + words - 1]
                        slot = np.cumsum(b - a) // SLICE
                        for one in np.split(np.arange(len(there)), np.flatnonzero(np.diff(slot)) + 1):
                            text = [bytes_[x:y] for x, y in zip(a[one].tolist(), b[one].tolist())]
                            yield pa.RecordBatch.from_arrays([pa.array(named[one]), pa.array(digest[one]), pa.array(text, pa.binary())], ["key", "digest", "segment"])

    slim = "id long, mark long, first int, key long, digest long, hot boolean"
    return docs.mapInArrow(run, slim if wanted is None else "key long, digest long, segment binary")


class Automaton:
    """Suffix automaton of word sequences, with the smallest document in which each class of substrings ends."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.size, self.least = [-1], [0], [1 << 63]

    def add(self, words: list, document: int) -> None:
        """One more sequence; matches never run across sequences."""
        next_, link, size, least, last = self.next, self.link, self.size, self.least, 0
        for w in words:
            q = next_[last].get(w)
            if q is not None:
                if size[q] == size[last] + 1:
                    last = q
                else:
                    last = self.split(last, w, q)
                if document < least[last]:
                    least[last] = document
                continue
            cur = len(next_)
            next_.append({})
            size.append(size[last] + 1)
            least.append(document)
            link.append(0)
            p = last
            while p >= 0 and w not in next_[p]:
                next_[p][w] = cur
                p = link[p]
            if p >= 0:
                q = next_[p][w]
                link[cur] = q if size[q] == size[p] + 1 else self.split(p, w, q)
            last = cur

    def split(self, p: int, w, q: int) -> int:
        next_, link, size = self.next, self.link, self.size
        clone = len(next_)
        next_.append(next_[q].copy())
        size.append(size[p] + 1)
        link.append(link[q])
        self.least.append(self.least[q])
        link[q] = clone
        while p >= 0 and next_[p].get(w) == q:
            next_[p][w] = clone
            p = link[p]
        return clone

    def settle(self) -> None:
        """Hand the smallest documents on to shorter substrings."""
        link, least = self.link, self.least
        for v in sorted(range(1, len(link)), key=self.size.__getitem__, reverse=True):
            if least[v] < least[link[v]]:
                least[link[v]] = least[v]

    def firsts(self, words: list, window: int) -> list[int | None]:
        """Matching statistics of a text, cut off at ``window``: for each window the smallest document that holds it,
        None where no document does."""
        next_, link, size, least = self.next, self.link, self.size, self.least
        out, v, run = [], 0, 0
        for i, w in enumerate(words):
            while v and w not in next_[v]:
                v = link[v]
                run = size[v]
            if w in next_[v]:
                v = next_[v][w]
                run += 1
            while v and size[link[v]] >= window:
                v = link[v]
            run = min(run, size[v])
            if i >= window - 1:
                out.append(least[v] if run >= window else None)
        return out


def judged(references: DataFrame, contents: DataFrame, window: int, shards: int) -> DataFrame:
    """(key, digest, firsts) of references (key, digest, low, high) and their texts: the sequences of a shard build one
    automaton, and each sequence is then streamed through it. ``firsts`` has the smallest document by window. Sequences
    none of whose holders comes after such a document are left out."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = list(zip(left.column("key").to_pylist(), left.column("digest").to_pylist()))
        held: dict = dict.fromkeys(names)
        for key, digest, segment in zip(*(right.column(c).to_pylist() for c in ("key", "digest", "segment"))):
            if held.get((key, digest), b"") is None:
                held[key, digest] = segment.split()
        automaton = Automaton()
        for name, low in zip(names, left.column("low").to_pylist()):
            automaton.add(held[name], low)
        automaton.settle()
        out = []
        for name, high in zip(names, left.column("high").to_pylist()):
            firsts = automaton.firsts(held[name], window)
            if min(firsts) < high:
                out.append((*name, firsts))
        keys, digests, firsts = zip(*out) if out else ((), (), ())
        return pa.table({"key": pa.array(keys, pa.int64()), "digest": pa.array(digests, pa.int64()), "firsts": pa.array(firsts, pa.list_(pa.int64()))})

    dealt = [t.withColumn("shard", F.pmod("key", F.lit(shards))).groupBy("shard") for t in (references, contents)]
    return dealt[0].cogroup(dealt[1]).applyInArrow(run, "key long, digest long, firsts array<long>")


def repeats(
    docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS, hot_docs: int = HOT_DOCS,
) -> DataFrame:
    """(id, mark, at): first words of the windows of each document (id, mark, text) that a document with a smaller id
    holds too.

    1. Every window has an anchor, the run of ``anchor`` words in it with the smallest hash. Anchors of one document
       only are left out (smallest and largest id, reduced before the shuffle).
    2. The other segments are reduced to different ones with their smallest and largest id, by digest. They are the
       reference, cut by anchor into shards of about ``shard_words`` words: all copies of a window meet in one shard,
       and only there. Only the first holder of a segment sends its text.
    3. A suffix automaton of each shard knows the smallest document of every substring. The shard's sequences are
       streamed through it for matching statistics up to ``window``; copies take the result by join.

    An anchor in over ``hot_docs`` documents (a passage that many documents hold in different places) is split by
    window, so no shard grows with it. Bitmaps of up to 64 MB let the scans drop lone anchors and later holders early;
    exact joins drop the rest, so a full bitmap costs time only.
    """
    docs = docs.filter("id IS NOT NULL")
    lone = keys_of(docs, window, anchor).groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("docs").alias("docs"))
    shared = stage(lone.filter("low < high").select("key", "docs"), "substring-keys")
    known, hot = key_filter(shared, "key", filter_bits(shared.count())), key_filter(shared.filter(F.col("docs") > hot_docs), "key")
    found = stage(segments_of(docs, known, hot, window, anchor), "substring-segments")
    distinct = found.groupBy("key", "digest", "hot").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    distinct = distinct.filter("hot").unionByName(distinct.filter("NOT hot").join(shared, "key", "left_semi")).drop("hot")
    reference = stage(distinct, "substring-reference")
    n_segments = reference.count()
    shards = max(1, -(-n_segments * (window + 4) // shard_words))
    bits = filter_bits(n_segments)
    place = F.col("digest").bitwiseXOR(F.shiftleft("low", 64 - bits))
    wanted = key_filter(reference.select(place.alias("place")), "place", bits)
    contents = segments_of(docs, known, hot, window, anchor, wanted)
    verdicts = stage(judged(reference, contents, window, shards), "substring-verdicts")
    joined = found.select("id", "mark", "first", "key", "digest").join(verdicts, ["key", "digest"]).filter(F.array_min("firsts") < F.col("id"))
    at = F.transform("firsts", lambda x, i: F.when(x < F.col("id"), F.col("first") + i))
    return joined.select("id", "mark", F.explode(F.array_compact(at)).alias("at"))


def remove_repeats(
    docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **options,
) -> DataFrame:
    """(id, n_words, n_removed, kept): each document without the words that stand in a window of ``window`` words which
    a document with a smaller id holds too, the kept words joined by one space. Words are cut at ASCII white space
    and compared as they are; windows are judged on the input.

    NULL and empty texts have no words. A document without an id is returned whole and is nobody's reference. Rows that
    repeat an id are not repeats of each other; each row is returned. Documents shorter than a window stay whole. Other
    columns are ignored. Empty input gives no rows.
    """
    marked = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    listed = repeats(marked, window=window, **options).groupBy("id", "mark").agg(F.sort_array(F.collect_set("at")).alias("at"))
    listed = stage(listed, "substring-removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text"):
                out = []
                for text, at in zip(part.column("text"), part.column("at")):
                    words = (text.as_py() or "").encode().split()
                    total = len(words)
                    if at.is_valid:
                        step = np.zeros(total + 1, np.int64)
                        first = at.values.to_numpy()
                        step[first] += 1
                        np.subtract.at(step, first + window, 1)
                        stays = np.cumsum(step)[:-1] == 0
                        words = [w for w, s in zip(words, stays.tolist()) if s]
                    out.append((total, total - len(words), b" ".join(words).decode()))
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string())))],
                                                 ["id", "n_words", "n_removed", "kept"])

    joined = marked.join(listed, ["id", "mark"], "left").select("id", "text", "at")
    return joined.mapInArrow(run, "id long, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
