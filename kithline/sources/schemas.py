"""Schemas of the source tables and of the unified record."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DataType, DateType, StringType, StructField, StructType, TimestampType


def _schema(kinds: dict[str, DataType], columns: str) -> StructType:
    """A schema of strings, but for the columns in ``kinds``."""
    return StructType([StructField(c, kinds.get(c, StringType())) for c in columns.split()])


_TIMES = dict.fromkeys(
    "created_at updated_at created_date last_modified_date first_seen_at last_seen_at".split(), TimestampType())
_KINDS: dict[str, DataType] = {"dob": DateType(), "is_deleted": BooleanType(), **_TIMES}

SOURCES = {
    "t24": _schema(_KINDS, "customer_id emirates_id dob name_english name_arabic mobile email risk_rating segment "
                           "kyc_status created_at updated_at record_status"),
    "sfdc": _schema(_KINDS, "contact_id first_name last_name dob phone email created_date last_modified_date is_deleted"),
    "amplitude": _schema(_KINDS, "user_id email first_seen_at last_seen_at"),
}

NORMALIZED = _schema(_KINDS, "source_system source_id emirates_id dob name_english name_arabic phone_e164 email "
                             "risk_rating segment kyc_status created_at updated_at")
