"""Crosswalk and review queue."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.config import DETERMINISTIC, NEW_CUSTOMER, PENDING, PROBABILISTIC_AUTO, REVIEW_QUEUE
from kithline.operators.deterministic import pair_endpoints


def method_attribution(det: DataFrame, auto: DataFrame) -> DataFrame:
    """(node, match_method, confidence) from two frames of (node, confidence); either may list a node repeatedly.

    The smallest method name wins, which puts deterministic before probabilistic.
    """
    methods = sorted((DETERMINISTIC, PROBABILISTIC_AUTO))
    rows = det.select("node", "confidence", F.lit(methods.index(DETERMINISTIC)).alias("method")).unionByName(
        auto.select("node", "confidence", F.lit(methods.index(PROBABILISTIC_AUTO)).alias("method")))
    best = rows.groupBy("node").agg(F.min("method").alias("method"), F.max("confidence").alias("confidence"))
    return best.select("node", F.get(F.array(*[F.lit(m) for m in methods]), F.col("method")).alias("match_method"), "confidence")


def attribution_of_pairs(deterministic_pairs: DataFrame, auto_pairs: DataFrame) -> DataFrame:
    """``method_attribution`` from pair tables."""
    return method_attribution(pair_endpoints(deterministic_pairs, "confidence"), pair_endpoints(auto_pairs, "confidence"))


def build_crosswalk(components: DataFrame, attribution: DataFrame, run_ts: datetime) -> DataFrame:
    """One row per record: its customer, how it got there and how surely. Both sides name records by ``node``."""
    return components.join(attribution, "node", "left").select(
        "source_system", "source_id", "mal_customer_id",
        F.coalesce("match_method", F.lit(NEW_CUSTOMER)).alias("match_method"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.lit(run_ts).alias("resolved_at"),
    )


def build_review_queue(review: DataFrame, run_ts: datetime) -> DataFrame:
    """Pairs between the two thresholds, waiting for a decision."""
    return review.select(
        "left_source", "left_id", "right_source", "right_id", "confidence",
        F.lit(run_ts).alias("queued_at"), F.lit(PENDING).alias("status"),
    )


def held_back(crosswalk: DataFrame, waiting: DataFrame) -> DataFrame:
    """``crosswalk`` without records that wait for review and have no other link; ``waiting`` holds record columns."""
    keys = ["source_system", "source_id"]
    held = waiting.select(*keys).distinct().withColumn("match_method", F.lit(NEW_CUSTOMER))
    return crosswalk.join(held, [*keys, "match_method"], "left_anti")


def review_records(review_queue: DataFrame) -> DataFrame:
    return pair_endpoints(review_queue).select("node.*").distinct()


def stats_by_method(crosswalk: DataFrame) -> DataFrame:
    """(match_method, n) of the crosswalk."""
    return crosswalk.groupBy("match_method").agg(F.count(F.lit(1)).alias("n"))


def pending_count(review_queue: DataFrame) -> DataFrame:
    """One row: the size of the review queue."""
    return review_queue.agg(F.count_if(F.col("status") == PENDING).alias("n"))


def run_stats(crosswalk: DataFrame, pending: DataFrame) -> DataFrame:
    """One row of counters and their sum; ``pending`` is one row (n) with the size of the review queue."""
    counts = stats_by_method(crosswalk).unionByName(pending.select(F.lit(REVIEW_QUEUE).alias("match_method"), "n"))
    names = (DETERMINISTIC, PROBABILISTIC_AUTO, REVIEW_QUEUE, NEW_CUSTOMER)
    return counts.agg(
        *[F.coalesce(F.sum(F.when(F.col("match_method") == m, F.col("n"))), F.lit(0)).alias(m) for m in names],
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
