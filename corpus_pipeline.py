"""Corpus cleaning: five stages over the documents table, each one's result written and read again by the next.

Rows are never dropped for having a null id, and rows that share an id are kept or dropped together. A row without id
is decided by its text: it is a document of its own, behind all that have an id, and its exact copies without id are one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kithline.llm import decontamination, language_id, secrets, sentencepiece_fst
from kithline.llm.common import table
from kithline.llm.ngram_join import jaccard_components
from kithline.llm.queries import PIECE_MODEL
from kithline.plans.staging import Staging, released

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


KEY = "_row_key"
_NO_ID = 2**62


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of rows: the id, or for rows without one a hash of the text, above the usual range of ids."""
    hashed = F.xxhash64("text").bitwiseAND(F.lit(_NO_ID - 1)) + F.lit(_NO_ID)
    return docs.withColumn(KEY, F.coalesce(F.col("doc_id").cast("long"), hashed))


def _texts(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col(KEY).alias("doc_id"), "text")


def _without(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """``keyed`` whose key is not among ``keys(doc_id)``."""
    return keyed.join(keys.select(F.col("doc_id").alias(KEY)).distinct(), KEY, "left_anti").select(*COLUMNS)


def _once(docs: DataFrame, staging: Staging) -> DataFrame:
    """``docs`` with one row (the one with the smallest other columns) of exact copies that have words and no id."""
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    nameless = F.col("doc_id").isNull() & worded
    more = [c for c in COLUMNS if c not in ("doc_id", "text")]
    once = docs.where(nameless).groupBy("text").agg(F.min(F.struct(*more)).alias("row")).select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", "row.*")
    return docs.where(~nameless).select(*COLUMNS).unionByName(staging.put(once.select(*COLUMNS), "nameless").df)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what is in no language: null texts and texts without a letter; fills a missing ``lang`` with the language found.
    Any lettered text is nearest to some language, whatever its phrase rate, so the parse itself drops nothing."""
    model = language_id.fit(docs, F.lit(True))
    if model is None:  # nothing labelled to learn from: only the letters decide
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    return language_id.keep_known(docs.select(*COLUMNS), model, fill="lang")


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of near duplicates, one without id only if none has an id,
    and every document without a word."""
    staging = Staging(spark)
    keyed = _keyed(_once(docs, staging))
    return _without(keyed, jaccard_components(_texts(keyed), staging).where("doc_id <> component_id").select("doc_id"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    keyed = _keyed(docs)
    return _without(keyed, decontamination.contaminated(_texts(keyed), table(spark, sf_dir, "benchmark"), Staging(spark)).select("doc_id"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in texts; every document stays, ``n_chars`` follows the text."""
    return secrets.redact(docs.select(*COLUMNS), Staging(spark)).withColumn(
        "n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text."""
    return sentencepiece_fst.encode(docs, sentencepiece_fst.PieceTable.load(PIECE_MODEL))


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_per_group),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("sentencepiece", encoded),
]
#: Language models and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``. What a stage staged is deleted when its result is written, and that when the
    next one's is."""
    docs, staging = table(spark, sf_dir, "documents"), Staging(spark)
    for name, stage in STAGES:
        last, staging = staging, Staging(spark)
        with released():
            docs = staging.put(stage(spark, docs, sf_dir), name).df
        last.release()
    return docs
