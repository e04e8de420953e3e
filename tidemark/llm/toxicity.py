"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHasher, batches_of, is_no_word, text_bytes, word_spans

#: Lengths of the character n-grams in bytes, a word's ends included.
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
WIDTH = 8
#: Words averaged into one bag.
PASSAGE = 32
#: Labelled documents that are learnt from at most, by class.
MOST = {1: 1800, 0: 3000}
EPOCHS = 12


@dataclass
class Model:
    """Score of each n-gram bucket (its embedding times the difference of the two classes' weights) and the bias."""

    gram_scores: np.ndarray
    bias: float


def gram_buckets(data: np.ndarray, inside: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the n-gram that begins at each byte, and whether it counts: all bytes but the first and the last
    must lie in a word; those two may be the word's border, which reads as zero."""
    size = max(0, len(data) - n + 1)
    h = np.full(size, n, np.uint32)
    for j in range(n):
        h = h * np.uint32(0x01000193) ^ data[j:j + size]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    valid = inside[1:1 + size].copy()
    for j in range(2, n - 1):
        valid &= inside[j:j + size]
    return h & np.uint32(BUCKETS - 1), valid


def lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with word borders as zero and one border in front, which bytes are in words, word spans, and the words'
    documents."""
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    data = np.concatenate([np.zeros(1, np.uint8), data])
    outside = is_no_word()
    outside[0] = True
    starts, ends = word_spans(data, outside)
    inside = ~outside[data]
    return np.where(inside, data, np.uint8(0)), inside, starts, ends, np.searchsorted(offsets + 1, starts, "right") - 1


def word_scores(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray, gram_scores: np.ndarray) -> np.ndarray:
    """The mean score of each word's n-grams, from running sums over the bytes."""
    total, count = np.zeros(len(starts)), np.zeros(len(starts))
    for n in GRAMS:
        buckets, valid = gram_buckets(data, inside, n)
        sums = np.zeros(len(data) + 1)
        np.cumsum(np.where(valid, gram_scores[buckets], 0), out=sums[1:len(buckets) + 1])
        sums[len(buckets) + 1:] = sums[len(buckets)]
        many = np.zeros(len(data) + 1, np.int64)
        np.cumsum(valid, out=many[1:len(buckets) + 1])
        many[len(buckets) + 1:] = many[len(buckets)]
        total += sums[ends - 1] - sums[starts - 1]
        count += many[ends - 1] - many[starts - 1]
    return total / np.maximum(count, 1)


def passages(doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The passage of each word and the document of each passage. A text is cut into ceil(words / PASSAGE) even parts."""
    words = np.bincount(doc, minlength=docs)
    parts = -(-words // PASSAGE)
    nth = np.arange(len(doc)) - (np.cumsum(words) - words)[doc]
    return (np.cumsum(parts) - parts)[doc] + nth * parts[doc] // words[doc], np.repeat(np.arange(docs), parts)


def once(passage: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Places of the first occurrence of each word in each passage, in order of passages. ``word``: any equal mark for
    equal words."""
    by = np.lexsort((word, passage))
    new = np.ones(len(by), bool)
    new[1:] = (passage[by][1:] != passage[by][:-1]) | (word[by][1:] != word[by][:-1])
    return by[new]


def logits(scores: np.ndarray, word: np.ndarray, doc: np.ndarray, docs: int, bias: float) -> np.ndarray:
    """A document's logit is that of its worst passage; without words it is the bias. A passage is a bag of PASSAGE
    places: a repeated word fills one, and places left over are zero vectors."""
    out = np.full(docs, -np.inf)
    if len(scores):
        passage, own = passages(doc, docs)
        first = once(passage, word)
        np.maximum.at(out, own, np.bincount(passage[first], scores[first], len(own)) / PASSAGE + bias)
    out[np.isneginf(out)] = bias
    return out


def fit(texts: pa.Array, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 1, rate: float = 0.3) -> Model:
    """Train n-gram embeddings and the softmax together by Adagrad on the cross entropy.

    The bag of a document is the mean of the vectors of one passage's distinct words, a word vector the mean of its
    n-gram vectors. In each epoch a document is represented by the passage that scores highest so far, so a long text is
    judged by its worst part instead of being diluted. Words are reduced to distinct ones first.
    """
    rng = np.random.default_rng(seed)
    data, _, starts, ends, doc = lowered(texts)
    hashes = WordHasher()(data, starts, ends)
    _, at, word = np.unique(hashes, return_index=True, return_inverse=True)
    size = ends[at] - starts[at]
    begin = np.cumsum(size + 1) - size
    flat = np.zeros(int((size + 1).sum()) + 1, np.uint8)
    take = np.repeat(starts[at] - begin, size) + (places := np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size))
    flat[places] = data[take]
    inside = flat != 0
    rows, cols = [], []
    for n in GRAMS:
        buckets, valid = gram_buckets(flat, inside, n)
        p = np.flatnonzero(valid)
        rows.append((np.searchsorted(begin, p + 1, "right") - 1).astype(np.int32))
        cols.append(buckets[p].astype(np.int32))
    del data, starts, ends, flat, inside, places, take, buckets, valid, p
    rows, cols = np.concatenate(rows or [np.zeros(0, np.int32)]), np.concatenate(cols or [np.zeros(0, np.int32)])
    order = np.argsort(rows, kind="stable")
    cols, count = cols[order], np.bincount(rows, minlength=len(at))
    del rows, order
    first = np.cumsum(count) - count

    embeddings = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weights = rng.normal(0, 0.5, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_e, seen_w, seen_b = np.full(BUCKETS, 1e-6, np.float32), np.full_like(weights, 1e-6), np.full(2, 1e-6, np.float32)
    if not len(hashes) or len(np.unique(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))))
    passage, own = passages(doc, len(labels))
    places = once(passage, word)
    word, passage = word[places], passage[places]
    many = np.bincount(passage, minlength=len(own))
    cut = np.cumsum(many) - many
    for _ in range(epochs):
        gram = embeddings @ (weights[:, 1] - weights[:, 0])
        per_word = np.add.reduceat(gram[cols], np.minimum(first, len(cols) - 1)) / np.maximum(count, 1)
        worth = np.bincount(passage, per_word[word], len(own))
        by = np.lexsort((rng.random(len(worth)), worth, own))
        chosen = by[np.append(np.flatnonzero(np.diff(own[by])), len(by) - 1)]
        rng.shuffle(chosen)
        for lot in np.array_split(chosen, max(1, len(chosen) // 64)):
            words = many[lot]
            flat_words = word[np.repeat(cut[lot] - (np.cumsum(words) - words), words) + np.arange(words.sum())]
            grams = count[flat_words]
            flat_grams = cols[np.repeat(first[flat_words] - (np.cumsum(grams) - grams), grams) + np.arange(grams.sum())]
            bag = np.repeat(np.arange(len(lot)), words)
            weight = np.repeat(1.0 / (PASSAGE * grams), grams).astype(np.float32)
            bag = np.repeat(bag, grams)
            mean = np.zeros((len(lot), WIDTH), np.float32)
            for d in range(WIDTH):
                mean[:, d] = np.bincount(bag, weight * embeddings[flat_grams, d], len(lot))
            z = mean @ weights + bias
            z = np.exp(z - z.max(1, keepdims=True))
            error = z / z.sum(1, keepdims=True)
            error[np.arange(len(lot)), labels[own[lot]]] -= 1
            step_w, step_b, back = mean.T @ error / len(lot), error.mean(0), error @ weights.T / len(lot)
            touched, inverse = np.unique(flat_grams, return_inverse=True)
            step_e = np.stack([np.bincount(inverse, weight * back[bag, d], len(touched)) for d in range(WIDTH)], 1).astype(np.float32)
            seen_e[touched] += (step_e**2).mean(1)
            embeddings[touched] -= rate * step_e / np.sqrt(seen_e[touched])[:, None]
            seen_w += step_w**2
            weights -= rate * step_w / np.sqrt(seen_w)
            seen_b += step_b**2
            bias -= rate * 0.3 * step_b / np.sqrt(seen_b)
    return Model((embeddings @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(
    docs: DataFrame, labels: DataFrame, *, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", most: dict[int, int] | None = None,
) -> Model:
    """Fit on a bounded sample of labelled rows: of each class at most ``most`` documents, those whose ids have the
    smallest hash, so reruns agree. ``usable`` is a condition on the id. Rows with a NULL label or id are not learnt
    from. Only ids are compared over the whole table; texts of the sample reach the driver."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if usable is not None:
        known = known.filter(usable)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    picked = None
    for label, rows in (most or MOST).items():
        own = known.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(rows)
        picked = own if picked is None else picked.unionByName(own)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    sample = texts.select("id", "text", "label").toArrow().sort_by([("id", "ascending"), ("text", "ascending")])
    text = sample.column("text").cast(pa.large_string()).combine_chunks()
    return fit(text, sample.column("label").to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): probability of the toxic class of each whole text, 0 to 1. NULL, empty and wordless texts get the
    score of the bias alone. Each row is scored by itself from its text only; repeated rows get equal scores; other
    columns are ignored. Empty input gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for part in batches_of(batch, "text", 1 << 22):
                data, inside, starts, ends, doc = lowered(part.column("text"))
                scores = word_scores(data, inside, starts, ends, model.gram_scores)
                z = logits(scores, hasher(data, starts, ends), doc, part.num_rows, model.bias)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))], ["id", "score"])

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)
