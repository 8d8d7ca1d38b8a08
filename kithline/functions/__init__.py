"""Column expressions: cleaning, keys and similarity."""

from kithline.functions.contact import email_domain, normalize_email, normalize_phone
from kithline.functions.ids import customer_id, node_text, raw_text, record_node, validate_emirates_id
from kithline.functions.names import block_key, normalize_name
from kithline.functions.similarity import (
    confidence,
    dob_score,
    domain_score,
    jaro_winkler,
    phone_score,
)
from kithline.functions.sql import register_functions

__all__ = [
    "block_key", "confidence", "customer_id", "dob_score", "domain_score", "email_domain", "jaro_winkler",
    "node_text", "normalize_email", "normalize_name", "normalize_phone", "phone_score", "raw_text", "record_node",
    "register_functions", "validate_emirates_id",
]
