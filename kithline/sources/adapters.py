"""How each source system maps to the unified record. A new system is one more entry, nothing else changes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithline.sources.schemas import NORMALIZED


@dataclass(frozen=True)
class Adapter:
    """``columns`` maps a unified column to a source column name, or to several that are joined with spaces.

    Unified columns that are not named become typed NULLs. ``keep`` is a SQL predicate over ``keep_column``; it is
    applied only to tables that have the column.
    """

    system: str
    record_id: str
    columns: Mapping[str, str | tuple[str, ...]] = field(default_factory=dict)
    keep_column: str | None = None
    keep: str | None = None

    def supplied(self) -> frozenset[str]:
        return frozenset(self.columns)

    def active_rows(self, df: DataFrame) -> DataFrame:
        return df.where(self.keep) if self.keep and self.keep_column in df.columns else df

    def select(self, df: DataFrame) -> DataFrame:
        def column(name: str, kind: str) -> Column:
            source = self.columns.get(name)
            if source is None:
                return F.lit(None).cast(kind).alias(name)
            value = F.col(source) if isinstance(source, str) else F.concat_ws(" ", *source)
            return value.try_cast(kind).alias(name)

        key = F.col(self.record_id).cast("string")
        missing = F.raise_error(F.lit(f"{self.system}: a record without {self.record_id}")).cast("string")
        return df.select(
            F.lit(self.system).alias("source_system"),
            F.coalesce(key, missing).alias("source_id"),
            *[column(f.name, f.dataType.simpleString()) for f in NORMALIZED.fields[2:]],
        )


ADAPTERS: dict[str, Adapter] = {
    "t24": Adapter(
        "t24", "customer_id",
        {
            "emirates_id": "emirates_id", "dob": "dob", "name_english": "name_english", "name_arabic": "name_arabic",
            "phone_e164": "mobile", "email": "email", "risk_rating": "risk_rating", "segment": "segment",
            "kyc_status": "kyc_status", "created_at": "created_at", "updated_at": "updated_at",
        },
        "record_status", "record_status = 'ACTIVE'",
    ),
    "sfdc": Adapter(
        "sfdc", "contact_id",
        {
            "dob": "dob", "name_english": ("first_name", "last_name"), "phone_e164": "phone", "email": "email",
            "created_at": "created_date", "updated_at": "last_modified_date",
        },
        "is_deleted", "is_deleted = false",
    ),
    "amplitude": Adapter(
        "amplitude", "user_id",
        {"email": "email", "created_at": "first_seen_at", "updated_at": "last_seen_at"},
        "email", "email IS NOT NULL",
    ),
}
