"""Record keys, national ids and customer ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# National id shapes, with optional and with mandatory hyphens, and the id prefix.
EID_SHAPE = r"\A784-?[0-9]{4}-?[0-9]{7}-?[0-9]\z"
EID_SHAPE_HYPHENS = r"\A784-[0-9]{4}-[0-9]{7}-[0-9]\z"
CUSTOMER_ID_PREFIX = "MAL-"


def record_node(system: str | Column = "source_system", record_id: str | Column = "source_id") -> Column:
    """The record key as one orderable value: a struct, so it compares as a tuple."""
    system = F.col(system) if isinstance(system, str) else system
    record_id = F.col(record_id) if isinstance(record_id, str) else record_id
    return F.struct(system.alias("source_system"), record_id.alias("source_id"))


def node_text(node: Column) -> Column:
    """``system:id``, the text a customer id is hashed from."""
    return F.concat_ws(":", node["source_system"], node["source_id"])


def customer_id(root: Column) -> Column:
    """Customer id of a component, from the component's smallest record."""
    return F.concat(F.lit(CUSTOMER_ID_PREFIX), F.substring(F.md5(node_text(root)), 1, 12))


def eid_checksum_ok(eid: Column) -> Column:
    """Luhn over all 15 digits, the last one being the check digit."""
    return F.call_function("luhn_check", F.replace(eid, F.lit("-"), F.lit("")))


def raw_text(value: Column) -> Column:
    """The text as it came, without outer blanks; NULL when nothing is left. For audit columns beside cleaned ones."""
    return F.nullif(F.trim(value), F.lit(""))


def validate_emirates_id(eid: Column, strict_hyphens: bool = False) -> Column:
    """The 15 digits when shape and checksum hold, else NULL."""
    digits = F.replace(eid, F.lit("-"), F.lit(""))
    shape = EID_SHAPE_HYPHENS if strict_hyphens else EID_SHAPE
    return F.when(eid.rlike(shape) & F.call_function("luhn_check", digits), digits)
