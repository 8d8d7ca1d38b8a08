"""The two functions SQL text can call by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

from kithline.functions.ids import EID_SHAPE
from kithline.functions.similarity import jaro_winkler_batch


def register_functions(spark: SparkSession) -> None:
    """Register ``fn_validate_eid_checksum(text)`` and ``fn_jaro_winkler(text, text)`` in the session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION fn_validate_eid_checksum(eid STRING) RETURNS BOOLEAN "
        f"RETURN coalesce(eid RLIKE r'{EID_SHAPE}' AND luhn_check(replace(eid, '-', '')), false)"
    )
    spark.udf.register("fn_jaro_winkler", jaro_winkler_batch)
