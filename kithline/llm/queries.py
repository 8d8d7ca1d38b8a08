"""The registered queries of this subpackage: thin wrappers that apply an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kithline.llm import (
    best_fit_packing, collocations, decontamination, fingerprints, hard_negatives, html_text, language_id, quality, secrets,
    sentencepiece_fst, toxicity)
from kithline.llm.common import crc_fold, met, table
from kithline.llm.ngram_join import jaccard_components
from kithline.llm.substring_dedup import remove_repeated_passages
from kithline.plans.staging import Staging

#: The public piece table that the registered query encodes with.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The public vocabulary that documents are packed with.
WORD_MODEL = "/opt/tokenizers/word_bpe_49k.json"
Query = Callable[[SparkSession, str], DataFrame]


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), Staging(spark))
    return found.select(
        "doc_id", *[secrets.count_of("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.as_text("base"), 256).alias("base_sha256"), secrets.as_text("found").alias("spans"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.encode(table(spark, sf_dir, "documents"), sentencepiece_fst.PieceTable.load(PIECE_MODEL))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), Staging(spark)).select(
        "doc_id", "n_shingles", "component_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Staging(spark))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, fold = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"))
    model = toxicity.fit(toxicity.labelled(docs, labels, "toxic", fold != 0, Staging(spark)))
    return toxicity.score(docs, model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, fold = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"))
    wanted = labels.select("doc_id", F.col("quality").alias("label")).where("label is not null").distinct()
    staging = Staging(spark)
    wanted = met(staging.put(wanted, "labels"))
    pages = docs.where(fold != 0).select("doc_id", "text", *quality.PAGE_COLUMNS)
    known = staging.put(pages.join(wanted, "doc_id"), "labelled").df  # read for counts and draws
    model = quality.fit(known, pages.join(wanted, "doc_id", "left_anti"))
    return quality.score(docs, model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents"), Staging(spark))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = crc_fold(F.col("doc_id"))
    return language_id.identify(docs, language_id.fit(docs, fold != 0)).select(
        "doc_id", (fold == 0).alias("held_out"), "lang_pred", "score", "rate")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), Staging(spark))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), Staging(spark))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(table(spark, sf_dir, "documents"), WORD_MODEL, Staging(spark)).drop("ids")


def queries() -> dict[str, Query]:
    return {
        "op1_html_extraction": lambda spark, sf_dir: html_text.extract(table(spark, sf_dir, "pages")),
        "op2_secret_scan": op2_secret_scan,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
        "op9_language_id": op9_language_id,
        "op5_decontamination": op5_decontamination,
        "op10_fingerprints": lambda spark, sf_dir: fingerprints.fingerprint_with_edits(
            table(spark, sf_dir, "documents"), Staging(spark)),
        "op6_toxicity": op6_toxicity,
        "op8_quality": op8_quality,
        "op7_substring_dedup": op7_substring_dedup,
        "op11_collocations": op11_collocations,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_best_fit_packing": op13_best_fit_packing,
    }
