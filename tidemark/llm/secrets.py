"""Secret scans: candidates by pattern, false positives removed by a random forest. DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

LEAST = 16
#: A candidate: a run of at least LEAST characters that credentials are made of, with a digit in it.
CHARS = r"A-Za-z0-9_+/.\-"
CANDIDATE = rf"(?<![{CHARS}])(?=[{CHARS}]*[0-9])[{CHARS}]{{{LEAST},}}={{0,2}}"
SPACES = r"[\x20\x09-\x0D]+"
CREDENTIAL = r"(?i)(token|secret|passw|passphrase|pwd|api.?key|access.?key|private.?key|auth|credential|bearer|client.?id)"
#: Also a candidate, whatever its length and characters: the value that a credential's name is given. Group 1 is the name and what
#: stands before the value, group 2 the value.
ASSIGNED = (
    r"(?i)((?:token|secret|passw(?:or)?d|passphrase|pwd|api.?key|access.?key|private.?key|auth|credential)[A-Za-z0-9_\-]{0,20}[\"'`]?"
    r"[\x20\t]{0,3}(?::=|=>|=|:)[\x20\t]{0,3}[\"'`]?)([^\x20\x09-\x0D\"'`,;<>(){}\[\]]{4,})"
)
#: A value that is an ordinary word, a short number, a variable or a link, and none of a machine's.
WORD_LIKE = r"^([A-Z]?[a-z]+|[A-Z]{1,15})[.!?:]*$|^[0-9]{1,5}[.!?:]*$|^\$[A-Za-z_]+$|^https?://"
HARMLESS = r"(?i)(sha\d*|md5|commit|checksum|digest|hash|uuid|guid|version|http|www|mail|example|sample|dummy|phone|tel|card|isbn|doi)"
DRILL = r"(?i)(test|example|sample|fixture|mock|vendor|third.?party|lock|docs?/)"
#: Findings learnt from at most, by class.
MOST = 2000
#: Plain words of so many letters count as known if they stand so often in the table, and make up such a share of its words.
LETTERS = (3, 24)
LEAST_COUNT = 5
LEAST_SHARE = 1e-6

FEATURES = [
    "length", "digits", "upper", "other", "distinct", "class_changes", "vowel_changes", "longest_run", "coverage", "harmless_path",
    "credential_word", "harmless_word", "assigned", "quoted", "dotted", "at_sign",
]


def findings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(id, path, value, lead, before, after, trail): every candidate with the part of its word in front of it, the two words
    before and the word after. Only texts that hold a candidate are cut into words. Values given to a credential's name that
    are no such run of characters come with that name in ``lead``."""
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), F.col(text_col).alias("text"))
    words = picked.filter(F.rlike("text", F.lit(CANDIDATE))).select("id", "path", F.split("text", SPACES).alias("w"))
    at = lambda i: F.coalesce(F.get("w", i), F.lit(""))
    near = F.transform("w", lambda x, i: F.struct(x.alias("word"), F.concat_ws(" ", at(i - 2), at(i - 1)).alias("before"), at(i + 1).alias("after")))
    each = words.select("id", "path", F.explode(F.filter(near, lambda s: F.length(s["word"]) >= LEAST)).alias("s")).filter(F.rlike("s.word", F.lit(CANDIDATE)))
    each = each.select("id", "path", "s.*", F.explode(F.regexp_extract_all("s.word", F.lit(CANDIDATE), F.lit(0))).alias("value"))
    runs = each.select("id", "path", "value", F.expr("substring_index(word, value, 1)").alias("lead"), "before", "after",
                       F.expr("substring(word, length(substring_index(word, value, 1)) + length(value) + 1)").alias("trail"))
    given = picked.filter(F.rlike("text", F.lit(ASSIGNED))).select("id", "path", F.arrays_zip(
        F.regexp_extract_all("text", F.lit(ASSIGNED), F.lit(1)).alias("lead"), F.regexp_extract_all("text", F.lit(ASSIGNED), F.lit(2)).alias("value")).alias("found"))
    given = given.select("id", "path", F.explode("found").alias("s")).select("id", "path", "s.value", "s.lead")
    nothing = F.lit("")
    others = given.filter(~F.rlike("value", F.lit(rf"^{CANDIDATE}$")))
    return runs.unionByName(others.select("id", "path", "value", "lead", nothing.alias("before"), nothing.alias("after"), nothing.alias("trail")))


def coverage(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(value, covered): letters of each different candidate that lie in a word of the dictionary (word), upper case or
    lower. The n-grams of the candidates' runs of letters meet the words in an equality join. Spark does not count the rows
    of the explodes, up to 22 for each letter, and would broadcast them; the hint keeps them in a shuffle at all sizes."""
    low, high = LETTERS
    runs = found.select("value").distinct().select("value", F.posexplode(F.regexp_extract_all(F.lower("value"), F.lit(f"[a-z]{{{low},}}"), F.lit(0))).alias("run", "letters"))
    starts = runs.select("*", F.explode(F.sequence(F.lit(1), F.length("letters") - low + 1)).alias("first"))
    spans = starts.select("value", "run", "first", "letters", F.explode(F.sequence(F.lit(low), F.least(F.lit(high), F.length("letters") - F.col("first") + 1))).alias("n"))
    grams = spans.select("value", "run", "first", "n", F.expr("substring(letters, first, n)").alias("word"))
    places = grams.hint("merge").join(dictionary.select("word"), "word").select("value", "run", F.explode(F.expr("sequence(first, first + n - 1)")).alias("place"))
    return places.distinct().groupBy("value").agg(F.count("*").alias("covered"))


def features(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The findings with one column per feature: length, what the characters and the steps between them are like, how
    much of the candidate known words cover, what the path and the words beside it say."""
    value, n = F.col("value"), F.length("value")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    steps = F.greatest(n - 1, F.lit(1))
    classes = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
    vowels = r"(?<=[aeiouAEIOU])(?=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])|(?<=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])(?=[aeiouAEIOU])"
    runs = F.transform(F.regexp_extract_all(value, F.lit("[A-Za-z]+"), F.lit(0)), F.length)
    beside = F.concat_ws(" ", "before", "lead")
    flag = lambda c, pattern: F.rlike(c, F.lit(pattern)).cast("double")
    columns = {
        "length": n.cast("double"), "digits": share("[0-9]"), "upper": share("[A-Z]"), "other": share("[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n, "class_changes": F.regexp_count(value, F.lit(classes)) / steps,
        "vowel_changes": F.regexp_count(value, F.lit(vowels)) / steps, "longest_run": F.coalesce(F.array_max(runs), F.lit(0)) / n,
        "coverage": F.coalesce(F.col("covered"), F.lit(0)) / n, "harmless_path": flag(F.col("path"), DRILL), "credential_word": flag(beside, CREDENTIAL),
        "harmless_word": flag(F.concat_ws(" ", beside, F.col("after")), HARMLESS), "assigned": flag(beside, "[=:]"),
        "quoted": flag(F.col("lead"), "[\"'`]$"), "dotted": share(r"\."), "at_sign": flag(F.concat("lead", "trail"), "@"),
    }
    assert list(columns) == FEATURES
    return found.join(coverage(found, dictionary), "value", "left").select(*found.columns, F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns.values()]).alias("features"))


def rule_labels() -> Column:
    """Labels for findings nobody has judged: 1 where a credential's name is assigned a value, 0 where the value is an ordinary
    word, a number, an address or a dotted name, or stands beside a word for checksums and the like; else NULL."""
    beside = F.concat_ws(" ", "before", "lead")
    number = F.rlike("value", F.lit(r"^[0-9+/.\-_=]+$"))
    address = F.rlike("value", F.lit(r"^[\w\-]+(\.[\w\-]+)+$")) | F.contains(F.concat("lead", "trail"), F.lit("@"))
    harmless = F.rlike(beside, F.lit(HARMLESS)) & ~F.rlike(beside, F.lit(CREDENTIAL))
    named = F.rlike(beside, F.lit(CREDENTIAL)) & F.rlike(beside, F.lit("[=:]"))
    return F.when(number | address | harmless | F.rlike("value", F.lit(WORD_LIKE)), 0).when(named, 1)


@dataclass
class Model:
    forest: RandomForestClassificationModel | None
    dictionary: DataFrame


def dictionary_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word): the plain words of all documents that are frequent enough, staged counts behind them."""
    low, high = LETTERS
    each = docs.select(F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+")).alias("word")).filter(F.length("word").between(low, high))
    counts = stage(each.groupBy("word").agg(F.count("*").alias("n")), "secret-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter(F.col("n") >= max(LEAST_COUNT, LEAST_SHARE * total)).select("word")


def train(labelled: DataFrame, dictionary: DataFrame, *, most: int = MOST, trees: int = 20, depth: int = 5, seed: int = 7) -> Model:
    """Fit the forest on labelled findings (the columns of ``findings`` and ``label`` 0 / 1). Of each class at most
    ``most`` rows are learnt from, those with the smallest hash, in one sorted partition, so reruns give the same
    forest. Without rows of both classes there is no forest, and ``scan`` goes by ``rule_labels``."""
    mark = F.xxhash64("value", "before", "lead", "id")
    picked = None
    for label in (0, 1):
        own = labelled.filter(F.col("label") == label).withColumn("mark", mark).orderBy("mark", "value", "id").limit(most)
        picked = own if picked is None else picked.unionByName(own)
    table = stage(features(picked, dictionary).coalesce(1).sortWithinPartitions("mark", "value", "id").select("features", F.col("label").cast("double").alias("label")), "secret-train")
    if table.select("label").distinct().count() < 2:
        return Model(None, dictionary)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="vector", labelCol="label")
    return Model(forest.fit(table.coalesce(1).select(array_to_vector("features").alias("vector"), "label")), dictionary)


def train_from(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> tuple[Model, DataFrame]:
    """A model from the documents' own findings under ``rule_labels``, and the staged findings."""
    found = stage(findings(docs, id_col=id_col, text_col=text_col, path_col=path_col), "secret-findings")
    labelled = found.withColumn("label", rule_labels()).filter("label IS NOT NULL")
    return train(labelled, dictionary_of(docs, text_col)), found


def judge(found: DataFrame, model: Model) -> DataFrame:
    """The findings with ``probability`` of being a secret."""
    if model.forest is None:
        return found.withColumn("probability", F.coalesce(rule_labels(), F.lit(0)).cast("double"))
    scored = model.forest.transform(features(found, model.dictionary).withColumn("vector", array_to_vector("features")))
    return scored.select(*found.columns, vector_to_array("probability")[1].alias("probability"))


def scan(
    docs: DataFrame, model: Model | None = None, *, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
) -> DataFrame:
    """(id, value, occurrences, probability): the candidates of each document that the forest keeps.

    A candidate is a run of 16 or more characters of keys with a digit, or four or more characters of any kind that a credential's name is
    given (``password = ...``); the forest sees its length, characters, their
    transitions, dictionary coverage, the path and the words beside it, and removes numbers, addresses, names and
    checksums. The dictionary are the words of all documents that stand often enough. Without a ``model`` one is trained on the table's own findings under ``rule_labels``.

    NULL and empty texts hold nothing; a NULL path is empty; a NULL id is reported as NULL; rows that repeat an id are
    reported together, with all occurrences and the largest probability. Other columns are ignored. Empty input gives
    no rows.
    """
    if model is None:
        model, found = train_from(docs, id_col=id_col, text_col=text_col, path_col=path_col)
    else:
        found = stage(findings(docs, id_col=id_col, text_col=text_col, path_col=path_col), "secret-findings")
    kept = judge(found, model).filter(F.col("probability") >= threshold)
    return kept.groupBy("id", "value").agg(F.count("*").alias("occurrences"), F.max("probability").alias("probability")).withColumnRenamed("id", id_col)


def redact(docs: DataFrame, secrets: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", by: str = "[SECRET]") -> DataFrame:
    """The documents with every secret of theirs replaced, all columns kept. Only texts that hold a candidate are
    joined to the secrets; the others pass without a shuffle. A NULL id has no secrets."""
    held = F.coalesce(F.rlike(F.col(text_col), F.lit(CANDIDATE)) | F.rlike(F.col(text_col), F.lit(ASSIGNED)), F.lit(False))
    # The longest first, so that a secret inside another does not break it.
    listed = secrets.groupBy(F.col(id_col).alias("own id")).agg(F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), asc=False).alias("own secrets"))
    joined = docs.filter(held).join(listed, F.col(id_col) == F.col("own id"), "left")
    cleaned = F.aggregate(F.coalesce("own secrets", F.array().cast("array<struct<n:int,value:string>>")), F.col(text_col), lambda t, s: F.replace(t, s["value"], F.lit(by)))
    return docs.filter(~held).unionByName(joined.withColumn(text_col, cleaned).select(*docs.columns))
