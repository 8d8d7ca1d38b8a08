"""Golden records: one aggregate over the linked records of each customer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kithline.config import DEFAULT, SEGMENT_TIERS, LinkageConfig
from kithline.operators.numbering import NUMBER

GROUP = "mal_customer_id"
LINKED = ("t24", "sfdc")  # fixed values: the authority for regulatory fields, and the next one for the English name


def recency() -> Column:
    """Sorts the newest record first; no time counts as oldest, ties go to the smallest record key."""
    age = F.coalesce(-F.unix_micros("updated_at"), F.lit(2**63 - 1))
    return F.struct(age.alias("age"), "source_system", "source_id")


def _newest(value: str | Column, condition: Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.min_by(value, F.when(condition, recency()))


def authoritative(column: str, system: str = LINKED[0]) -> Column:
    """The newest non-null value of one system."""
    return _newest(column, (F.col("source_system") == system) & F.col(column).isNotNull())


def segment_rank() -> Column:
    rank = F.lit(len(SEGMENT_TIERS) + 1)
    for place, tier in enumerate(SEGMENT_TIERS, 1):
        rank = F.when(F.col("segment") == tier, place).otherwise(rank)
    return rank


def top_segment() -> Column:
    """The highest tier present, NULL when there is none."""
    return F.get(F.array(*[F.lit(t) for t in SEGMENT_TIERS]), F.min(segment_rank()) - 1)


def english_name() -> Column:
    others = _newest("name_english", ~F.col("source_system").isin(*LINKED) & F.col("name_english").isNotNull())
    return F.coalesce(*[authoritative("name_english", s) for s in LINKED], others)


def contact_row() -> Column:
    """(email, phone_e164) of the newest record that has either."""
    either = F.col("email").isNotNull() | F.col("phone_e164").isNotNull()
    return _newest(F.struct("email", "phone_e164"), either)


def contact_attribute(column: str) -> Column:
    """The newest non-null value of any system."""
    return _newest(column, F.col(column).isNotNull())


def source_list() -> Column:
    return F.array_join(F.array_sort(F.collect_set("source_system")), ",")


def linked_records(normalized: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Normalized records with their customer id; only columns that are used travel."""
    return normalized.drop(NUMBER).join(crosswalk.select("source_system", "source_id", GROUP), ["source_system", "source_id"])


def t24_pick(linked: DataFrame) -> DataFrame:
    columns = ("emirates_id", "kyc_status", "risk_rating", "name_english", "name_arabic")
    return linked.where(F.col("source_system") == LINKED[0]).groupBy(GROUP).agg(
        *[authoritative(c).alias(c) for c in columns])


def latest_contact_row(linked: DataFrame) -> DataFrame:
    rows = linked.groupBy(GROUP).agg(contact_row().alias("contact")).where(F.col("contact").isNotNull())
    return rows.select(GROUP, "contact.*")


def first_value_contact(linked: DataFrame) -> DataFrame:
    """``latest_contact_row`` as a window over whole customers; meant for SQL users, a run takes the aggregate."""
    newest = Window.partitionBy(GROUP).orderBy(F.desc_nulls_last("updated_at"), "source_system", "source_id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    rows = linked.where("email IS NOT NULL OR phone_e164 IS NOT NULL")
    return rows.select(GROUP, *[F.first(c).over(newest).alias(c) for c in ("email", "phone_e164")]).distinct()


def latest_contact_attributes(linked: DataFrame) -> DataFrame:
    return linked.groupBy(GROUP).agg(*[contact_attribute(c).alias(c) for c in ("email", "phone_e164")])


def segment_pick(linked: DataFrame) -> DataFrame:
    return linked.groupBy(GROUP).agg(top_segment().alias("segment"))


def lifetime(linked: DataFrame) -> DataFrame:
    return linked.groupBy(GROUP).agg(
        F.min("created_at").alias("first_seen_at"), F.max("dob").alias("dob"), source_list().alias("source_systems"))


def survivorship(normalized: DataFrame, crosswalk: DataFrame, run_ts: datetime,
                 cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """One golden row per customer.

    All picks are partial aggregates of one ``groupBy``: each task reduces its own records first, so even a customer
    with very many records is never gathered in one place.
    """
    row = contact_row()
    email, phone = (row["email"], row["phone_e164"]) if cfg.contact_mode == "row" else (
        contact_attribute("email"), contact_attribute("phone_e164"))
    golden = linked_records(normalized, crosswalk).groupBy(GROUP).agg(
        authoritative("emirates_id").alias("emirates_id"),
        english_name().alias("name_english"),
        authoritative("name_arabic").alias("name_arabic"),
        F.max("dob").alias("dob"),
        email.alias("email"),
        phone.alias("phone_e164"),
        authoritative("kyc_status").alias("kyc_status"),
        authoritative("risk_rating").alias("risk_rating"),
        top_segment().alias("segment"),
        F.min("created_at").alias("first_seen_at"),
        source_list().alias("source_systems"),
    )
    return golden.withColumn("last_refreshed_at", F.lit(run_ts))
