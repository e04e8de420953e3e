"""Language identification by unigram pieces, summed over all segmentations of a fixed public vocabulary."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHasher, batches_of, mixed, text_bytes, word_spans

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Mark of a word's begin in the vocabulary.
BEGIN = "▁"
#: Documents learnt from by language, about.
SAMPLE = 1500
ROUNDS = 4
#: Longer words are cut into parts of this many characters, each summed by itself.
LONGEST = 40
SMOOTH = 0.05
UNKNOWN = 1e-9
#: Probabilities under 2**-SHIFT are kept as multiples of it, so products over many characters do not vanish.
SHIFT = 200
PRIME = np.uint64(0x100000001B3)


def read_pieces(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces of letters, lower-cased."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in plain if p.replace(BEGIN, "", 1).isalpha())


def span_hash(codes: np.ndarray) -> np.ndarray:
    """Running hashes of rows of code points; ``of(i, j)`` of two columns is hash[j] - hash[i] * PRIME**(j-i)."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * PRIME + codes[:, j] + np.uint64(1)
    return out


class Pieces:
    """Numbers of pieces by hash: one direct table, and a second one for pieces that fall on a taken slot."""

    SLOTS = 20

    def __init__(self, pieces: list[str]) -> None:
        self.longest = max(map(len, pieces), default=1)
        self.size = len(pieces)
        self.keys = np.zeros(self.size + 1, np.uint64)
        for i, p in enumerate(pieces):
            self.keys[i] = span_hash(np.array([[ord(c) for c in p]], np.uint64))[0, -1]
        self.tables = []
        left = np.arange(self.size)
        for turn in (1, 2, 3):
            slots = self.slots(self.keys[left], turn)
            _, first = np.unique(slots, return_index=True)
            table = np.full(1 << self.SLOTS, self.size, np.int32)
            table[slots[first]] = left[first]
            self.tables.append(table)
            left = np.delete(left, first)
            if not len(left):
                break
        assert not len(left)

    def slots(self, keys: np.ndarray, turn: int) -> np.ndarray:
        return mixed(keys * np.uint64(2 * turn + 1)) >> np.uint64(64 - self.SLOTS)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each hash, or ``size`` where there is none."""
        out = self.tables[0][self.slots(keys, 1)]
        out = np.where(self.keys[out] == keys, out, self.size)
        for turn, table in enumerate(self.tables[1:], 2):
            lost = np.flatnonzero(out == self.size)
            again = table[self.slots(keys[lost], turn)]
            out[lost] = np.where(self.keys[again] == keys[lost], again, self.size)
        return out


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of equal length as (their numbers, a matrix of code points with the begin mark in front)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(sizes):
        own = np.flatnonzero(sizes == n)
        for part in np.array_split(own, max(1, len(own) // 20000)):
            flat = np.frombuffer("".join([words[i] for i in part]).encode("utf-32-le"), np.uint32).reshape(-1, n)
            yield part, np.hstack([np.full((len(part), 1), ord(BEGIN), np.uint64), flat.astype(np.uint64)])


def edges(codes: np.ndarray, pieces: Pieces) -> dict[tuple[int, int], np.ndarray]:
    """For each span of the words that any word has as a piece: the piece's number by word. A span without the begin
    mark never takes a piece with it, as the mark is a character."""
    hashes, n, out = span_hash(codes), codes.shape[1], {}
    for j in range(1, n + 1):
        for i in range(max(0, j - pieces.longest), j):
            found = pieces.find(hashes[:, j] - hashes[:, i] * (PRIME ** np.uint64(j - i)))
            if j - i == 1 or (found < pieces.size).any():
                out[i, j] = found
    return out


def raised(p: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities p * 2**-shift with p not too small. Unless something is, the same arrays."""
    low = p < 2.0 ** -SHIFT
    return (np.ldexp(p, SHIFT * low), shift + SHIFT * low) if low.any() else (p, shift)


def under(p: np.ndarray, shift: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Probabilities p * 2**-shift as multiples of 2**-now."""
    return p if shift is now else np.ldexp(p, now - shift)


def weight(found: np.ndarray, table: np.ndarray, length: int) -> np.ndarray:
    """Probabilities of a span's pieces; a character that is no piece counts ``UNKNOWN``."""
    return np.maximum(table[found], UNKNOWN) if length == 1 else table[found]


def forward(codes: np.ndarray, spans: dict[tuple[int, int], np.ndarray], table: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Probability of each prefix, summed over its segmentations, by word and language, as (p, shift) for p * 2**-shift.
    ``table`` has a row of probabilities for each piece and one of zeros."""
    shape = len(codes), table.shape[1]
    alpha = [(np.ones(shape), np.zeros(shape, np.int32))]
    for j in range(1, codes.shape[1] + 1):
        total, now = np.zeros(shape), alpha[-1][1]
        for i in range(j):
            if (i, j) in spans:
                total += under(*alpha[i], now) * weight(spans[i, j], table, j - i)
        alpha.append(raised(total, now))
    return alpha


def backward(codes: np.ndarray, spans: dict[tuple[int, int], np.ndarray], table: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same of each suffix."""
    shape, n = (len(codes), table.shape[1]), codes.shape[1]
    beta = {n: (np.ones(shape), np.zeros(shape, np.int32))}
    for i in range(n - 1, -1, -1):
        total, now = np.zeros(shape), beta[i + 1][1]
        for j in range(i + 1, n + 1):
            if (i, j) in spans:
                total += under(*beta[j], now) * weight(spans[i, j], table, j - i)
        beta[i] = raised(total, now)
    return [beta[i] for i in range(n + 1)]


@dataclass
class Model:
    languages: list[str]
    pieces: Pieces
    table: np.ndarray  # probabilities by piece and language, and a row of zeros

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.languages)))
        for own, codes in by_length(words):
            p, shift = forward(codes, edges(codes, self.pieces), self.table)[-1]
            out[own] = np.log(p) - shift * np.log(2)
        return out


def expectation(words: list[str], counts: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words, by forward and backward sums."""
    uses, table = np.zeros(pieces.size + 1), np.append(p, 0.0)[:, None]
    for own, codes in by_length(words):
        spans = edges(codes, pieces)
        alpha, beta = forward(codes, spans, table), backward(codes, spans, table)
        total, whole = alpha[-1]
        for (i, j), found in spans.items():
            (before, a), (behind, b) = alpha[i], beta[j]
            share = np.ldexp(before * weight(found, table, j - i) * behind / total, whole - a - b)
            uses += np.bincount(found, share[:, 0] * counts[own], pieces.size + 1)
    return uses[:-1]


def fit(counts: dict[str, tuple[list[str], np.ndarray]], pieces: Pieces, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language from its word counts by expectation maximisation."""
    languages = sorted(counts)
    table = np.zeros((pieces.size + 1, len(languages)))
    for k, name in enumerate(languages):
        words, many = counts[name]
        p = np.full(pieces.size, 1.0 / max(1, pieces.size))
        for _ in range(rounds):
            uses = expectation(words, many, pieces, p) + SMOOTH
            p = uses / uses.sum()
        table[:-1, k] = p
    return Model(languages, pieces, table)


def distinct_words(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct lower-cased words of a column, and for each word in order its number and its document. Words are
    runs of letters; every byte of a non-ASCII character counts as one, but runs without any letter (rulers, dashes,
    emoji) are no words. Long words are cut."""
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    other = np.ones(256, bool)
    other[97:123] = other[128:256] = False
    starts, ends = word_spans(data, other)
    doc = np.searchsorted(offsets, starts, "right") - 1
    _, at, number = np.unique(WordHasher()(data, starts, ends), return_index=True, return_inverse=True)
    whole = data.tobytes()
    words = [whole[a:b].decode("utf-8", "replace") for a, b in zip(starts[at].tolist(), ends[at].tolist())]
    lettered = np.fromiter((w.isascii() or any(map(str.isalpha, w)) for w in words), bool, len(words))
    if not lettered.all():
        words = [w for w, keep in zip(words, lettered) if keep]
        doc, number = doc[lettered[number]], (np.cumsum(lettered) - 1)[number[lettered[number]]]
    parts = np.fromiter((-(-len(w) // LONGEST) for w in words), np.int64, len(words))
    if (parts > 1).any():
        first = np.cumsum(parts) - parts
        words = [w[i:i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
        many = parts[number]
        number = np.repeat(first[number] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        doc = np.repeat(doc, many)
    return words, number, doc


def train(
    docs: DataFrame, *, usable: Column | None = None, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    sample: int = SAMPLE, vocabulary: str = VOCABULARY,
) -> Model:
    """Learn from about ``sample`` documents of each language, taken by a hash of the id in proportion to the
    language's count (the counts, one row per language, reach the driver). Words are counted by executors; the driver gets the distinct words of the sample and runs the
    maximisation. Rows with a NULL language or text are not learnt from."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    if usable is not None:
        known = known.filter(F.expr("true") & usable) if id_col == "id" else known.withColumn(id_col, F.col("id")).filter(usable).drop(id_col)
    # One row per language; the texts are not moved for it.
    share = {r["lang"]: min(1.0, sample / r["count"]) for r in known.groupBy("lang").count().collect()}
    chance = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("lang")), F.lit(1 << 30)) / float(1 << 30)
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]), F.col("lang")) if share else F.lit(0.0)
    picked = known.filter(chance < wanted).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text"):
                words, number, doc = distinct_words(part.column("text"))
                langs, code = np.unique(np.array(part.column("lang").to_pylist()), return_inverse=True)
                pair, many = np.unique(code[doc] * max(1, len(words)) + number, return_counts=True)
                yield pa.record_batch({"lang": pa.array([str(langs[x]) for x in pair // max(1, len(words))], pa.string()),
                                       "word": pa.array([words[x] for x in pair % max(1, len(words))], pa.string()), "n": pa.array(many, pa.int64())})

    counted = picked.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    counted = counted.sort_by([("lang", "ascending"), ("word", "ascending")])
    counts = {}
    for name in pc.unique(counted.column("lang")).to_pylist():
        own = counted.filter(pc.equal(counted.column("lang"), name))
        counts[name] = (own.column("word").to_pylist(), own.column("n").to_numpy().astype(float))
    return fit(counts, Pieces(read_pieces(vocabulary)))


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): the language under which the whole text is likeliest, all equally likely before, and its
    posterior probability. ``id_col`` may be of any type, a struct of the whole row included. ``und`` with score 0 where the text is NULL, empty or without a letter, or nothing was
    learnt; equal likelihoods go to the first language by name. Repeated rows get equal results; other columns are
    ignored. Empty input gives no rows. A batch scores each distinct word once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text"):
                words, number, doc = distinct_words(part.column("text"))
                many = max(1, len(model.languages))
                total = np.zeros((part.num_rows, many))
                if words and model.languages:
                    per_word = model.log_probabilities(words)
                    for k in range(many):
                        total[:, k] = np.bincount(doc, per_word[number, k], part.num_rows)
                best = total.argmax(1)
                score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                lettered = pc.fill_null(pc.match_substring_regex(part.column("text"), r"\p{L}"), False).to_numpy(zero_copy_only=False)
                known = lettered & bool(model.languages)
                names = [model.languages[b] if k else "und" for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))], ["id", "lang_pred", "score"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = picked.select("id").schema.add("lang_pred", "string").add("score", "double")
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
