"""The corpus pipeline: language ID, SimHash near-dedup, benchmark decontamination, secret scans, source mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language, mixing, secrets, simhash
from tidemark.llm.common import bucket_of, table
from tidemark.session import stage

#: A document is rejected if no language is this likely.
LEAST_POSTERIOR = 0.5
#: A column that stands for a document inside a stage.
KEY = "pipeline key"


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language: texts that are NULL, empty or without letters go, and those for which no
    language reaches ``LEAST_POSTERIOR``. The documents themselves stay as they are. Learns as query op4 does; where no
    row has a language, nothing can be judged and only texts without letters go."""
    model = language.train(docs, usable=bucket_of(F.col("doc_id"), 3) != 1)
    if not model.languages:
        return docs.filter(F.rlike("text", F.lit(r"\p{L}")))
    judged = language.predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), model, id_col="row")
    return judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_POSTERIOR)).select("row.*")


def keyed(docs: DataFrame) -> DataFrame:
    """The documents with a number for each id and text: rows that share an id, or have none, can be told apart."""
    return docs.withColumn(KEY, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one with the smallest id, documents without an id last.
    A row that repeats an id with another text is a document of its own."""
    return simhash.deduplicated(docs, shingle=4, distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark, whether they have an id or share one or not."""
    marked = keyed(docs)
    hits = decontamination.contaminated(marked.select(F.col(KEY).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaks = stage(hits.select(F.col("doc_id").alias(KEY)).distinct(), "pipeline-leaks")
    return marked.join(leaks, KEY, "left_anti").select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark; ``n_chars`` follows. All documents stay."""
    marked = keyed(docs)
    found = stage(secrets.scan(marked, id_col=KEY), "pipeline-secrets")
    cleaned = secrets.redact(marked, found, id_col=KEY)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.when(F.contains("text", F.lit("[SECRET]")), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document goes into the mix, as query op8 has it."""
    return mixing.mix(docs)


STAGES = [
    ("language", identify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
]

#: Fingerprints, piece models and forests are beyond SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
