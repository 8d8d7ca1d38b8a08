"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact shingle containment.

An item is short and a document may be long, so their Jaccard similarity says little; what counts is the share of the
item's shingles that the document has. The sketch of an item is its bottom-k MinHash: the k smallest of its shingle
hashes. Items are partitioned by size, and k is set per partition so that a document which contains the item to the
threshold must have one of the k (it can lack fewer than k): the search loses nothing, for any document length.
A document is probed with its whole shingle set, as containment in the longer side needs, but only with the hashes that
some partition's sketches reach up to. Candidates are verified shingle by shingle. Only SQL functions are used.

Words are runs of letters and digits, A-Z lower-cased, so that punctuation glued to a passage does not hide it.

Defined results: an item without words is found nowhere; one of fewer words than a shingle is one shingle, found in
documents that consist of just these words; null texts have no words; equal item ids with different texts are
different items; repeated documents each count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kithline.llm.common import only_ids
from kithline.plans.staging import Staging


@dataclass(frozen=True)
class ContainmentSearch:
    width: int = 5
    percent: int = 75
    #: Sketch rows that may be broadcast (24 bytes each); beyond, both sides meet by hash.
    broadcast_rows: int = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, r"[^\p{L}\p{N}]+"), "")


def _shingled(df: DataFrame, cfg: ContainmentSearch) -> DataFrame:
    """One row per shingle of ``df(..., words)``: its first word's place ``i`` and its ``hash``."""
    last = F.greatest(F.size("words") - cfg.width, F.lit(0))
    rows = df.where(F.size("words") > 0).withColumn("i", F.explode(F.sequence(F.lit(0), last)))
    return rows.withColumn("hash", F.xxhash64(*[F.get("words", F.col("i") + k) for k in range(cfg.width)]))


def sketches(items: DataFrame, cfg: ContainmentSearch) -> DataFrame:
    """(item_key, n, hash): the bottom-k hashes of each item, k by its size partition."""
    shingles = _shingled(items, cfg).select("item_key", "hash").distinct()
    per_item = Window.partitionBy("item_key")
    sized = shingles.withColumn("n", F.count(F.lit(1)).over(per_item))
    partition = F.floor(F.log2(F.col("n")))
    most = F.pow(F.lit(2.0), partition + 1) - 1
    k = F.floor(most * (100 - cfg.percent) / 100) + 1
    return sized.withColumn("k", k).withColumn("place", F.row_number().over(per_item.orderBy("hash"))).where("place <= k").select(
        "item_key", "n", "hash")


def contaminated(docs: DataFrame, benchmark: DataFrame, staging: Staging, cfg: ContainmentSearch = ContainmentSearch()) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every row of ``docs(doc_id, text)`` and item of
    ``benchmark(item_id, text)`` whose containment reaches the threshold."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    items = staging.put(items.withColumn("item_key", F.xxhash64("item_id", "words")), "items").df
    index = staging.put(sketches(items, cfg), "sketches")
    bound = index.df.agg(F.max("hash")).first()[0]
    if bound is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_shingles long, n_shared long, containment double")
    small = index.rows <= cfg.broadcast_rows

    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    probes = _shingled(texts.select("doc_id", words(F.col("text")).alias("words")), cfg).where(F.col("hash") <= bound)
    probes = probes.select("doc_id", F.size("words").alias("size"), "hash")
    met = probes.join(F.broadcast(index.df) if small else index.df, "hash").where(
        (F.col("size") - cfg.width + 1) * 100 >= F.when(F.col("n") > 1, F.col("n") * cfg.percent).otherwise(F.lit(-(10**9))))
    candidates = staging.put(met.select("doc_id", "item_key").distinct(), "candidates").df
    ids = staging.put(candidates.select(F.col("doc_id").alias("id")).distinct(), "ids")

    spelled = F.when(F.size("words") >= cfg.width, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - (cfg.width - 1), F.lit(1))),
        lambda i: F.array_join(F.slice("words", i, cfg.width), " "))).otherwise(F.array(F.array_join("words", " ")))
    listed = items.select("item_key", "item_id", F.array_distinct(spelled).alias("shingles"), (F.size("words") < cfg.width).alias("whole"))
    listed = staging.put(listed, "listed")
    found = only_ids(texts, ids, "doc_id").withColumn(
        "words", words(F.col("text"))).select("doc_id", F.xxhash64("text").alias("tag"), F.concat(
            F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("spaced")).join(candidates, "doc_id").join(
        F.broadcast(listed.df) if listed.rows <= cfg.broadcast_rows // 20 else listed.df, "item_key")
    shared = F.when(F.col("whole"), (F.col("spaced") == F.concat(F.lit(" "), F.col("shingles")[0], F.lit(" "))).cast("int")).otherwise(
        F.size(F.filter("shingles", lambda s: F.contains("spaced", F.concat(F.lit(" "), s, F.lit(" "))))))
    counted = found.select(F.nullif("doc_id", F.lit(-(2**63))).alias("doc_id"), "item_id",
                           F.size("shingles").cast("long").alias("n_shingles"), shared.cast("long").alias("n_shared"))
    return counted.where(F.col("n_shared") * 100 >= F.col("n_shingles") * cfg.percent).withColumn(
        "containment", F.col("n_shared") / F.col("n_shingles"))
