"""Golden records from mergeable states, so that a refresh reads the new records and the touched customers only.

A state holds, per customer, every pick of survivorship together with what it was picked by. The state of two sets of
records is the merge of their states, so states are kept between runs: new records become states, states of customers that
were joined move to their new id, and only customers that any of it touches are merged and written again. Picks are
minima and maxima, so this serves records that are added; where a record was changed or taken back, its customers' states
are made anew from their records.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithline.config import DEFAULT, SEGMENT_TIERS, LinkageConfig
from kithline.operators.survivorship import GROUP, LINKED, recency, segment_rank


def _picks() -> dict[str, tuple[str | Column, Column]]:
    """State column: (value, which records count)."""
    def of(system: str) -> Column:
        return F.col("source_system") == system

    picks = {c: (c, of(LINKED[0]) & F.col(c).isNotNull()) for c in ("emirates_id", "name_arabic", "kyc_status", "risk_rating")}
    for k, system in enumerate(LINKED):
        picks[f"name_{k}"] = ("name_english", of(system) & F.col("name_english").isNotNull())
    picks["name_other"] = ("name_english", ~F.col("source_system").isin(*LINKED) & F.col("name_english").isNotNull())
    picks |= {c: (c, F.col(c).isNotNull()) for c in ("email", "phone_e164")}
    picks["contact"] = (F.struct("email", "phone_e164"), F.col("email").isNotNull() | F.col("phone_e164").isNotNull())
    return picks


def golden_states(linked: DataFrame) -> DataFrame:
    """One state per customer of ``linked`` records (normalized columns and the customer id)."""
    picked = [F.min(F.when(condition, F.struct(recency().alias("by"), (F.col(value) if isinstance(value, str) else value).alias("value")))).alias(name)
              for name, (value, condition) in _picks().items()]
    return linked.groupBy(GROUP).agg(
        *picked, F.max("dob").alias("dob"), F.min("created_at").alias("first_seen_at"), F.min(segment_rank()).alias("segment_rank"),
        F.array_sort(F.collect_set("source_system")).alias("systems"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all records behind several frames of states."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(GROUP).agg(
        *[F.min(name).alias(name) for name in _picks()], F.max("dob").alias("dob"), F.min("first_seen_at").alias("first_seen_at"),
        F.min("segment_rank").alias("segment_rank"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("systems")))).alias("systems"))


def refresh_states(kept: DataFrame, added: DataFrame, moved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(states of touched customers, ids that are gone): what a run changes in the ``kept`` states.

    ``added`` are the states of the new records, ``moved(old_id, new_id)`` the customers whose id changed, because components
    were joined. All other states stay as they are, and are not read beyond their ids."""
    moves = moved.where("old_id <> new_id").select(F.col("old_id").alias(GROUP), "new_id")
    touched = added.select(GROUP).unionByName(moves.select(F.col("new_id").alias(GROUP))).distinct()
    left = kept.join(moves, GROUP, "left")
    rekeyed = left.where("new_id is not null").withColumn(GROUP, F.col("new_id")).drop("new_id")
    own = left.where("new_id is null").drop("new_id").join(touched, GROUP, "left_semi")
    return merge_states(own, rekeyed, added), moves.select(GROUP)


def golden_records(states: DataFrame, run_ts: datetime, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """The golden rows of states, as ``survivorship`` gives them for the records behind."""
    email, phone = ("contact.value.email", "contact.value.phone_e164") if cfg.contact_mode == "row" else ("email.value", "phone_e164.value")
    names = [F.col(f"{c}.value") for c in (*[f"name_{k}" for k in range(len(LINKED))], "name_other")]
    value = {c: F.col(f"{c}.value") for c in ("emirates_id", "name_arabic", "kyc_status", "risk_rating")}
    return states.select(
        GROUP, value["emirates_id"].alias("emirates_id"), F.coalesce(*names).alias("name_english"), value["name_arabic"].alias("name_arabic"), "dob",
        F.col(email).alias("email"), F.col(phone).alias("phone_e164"), value["kyc_status"].alias("kyc_status"),
        value["risk_rating"].alias("risk_rating"), F.get(F.array(*[F.lit(t) for t in SEGMENT_TIERS]), F.col("segment_rank") - 1).alias("segment"),
        "first_seen_at", F.array_join("systems", ",").alias("source_systems"), F.lit(run_ts).alias("last_refreshed_at"))
