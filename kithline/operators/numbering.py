"""Record numbers: a dense ``long`` per (system, id), in the order of (system, id).

Links, components and attribution compare and group records all the time. A pair of texts cannot be the running minimum of
a hash aggregate, and shuffles at its full width; a number that sorts like it does both in eight bytes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kithline.plans.staging import Staging

KEYS = ["source_system", "source_id"]
NUMBER = "record_no"
_PART_BITS = 33  # rows of a partition in Spark's increasing ids


def number_records(rows: DataFrame, staging: Staging) -> DataFrame:
    """``rows`` with ``record_no``. Rows of one record share a number; it is the place of the record's first row.

    The rows are range partitioned and sorted by record, and written with their place in the partition. The sizes of
    the partitions, one row each, give the offsets. Frames that have numbers stay as they are.
    """
    if NUMBER in rows.columns:
        return rows
    placed = rows.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS).withColumn("_place", F.monotonically_increasing_id())
    # A record's rows lie next to each other in one partition, so this needs neither another shuffle nor a sort.
    first = placed.withColumn("_first", F.min("_place").over(Window.partitionBy(*KEYS)))
    staged = staging.put(first, "numbered").df
    part = F.shiftright("_place", _PART_BITS)
    sizes = staged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    offsets = staging.put(offsets, "offsets").df  # as many rows as there are partitions
    inside = F.col("_first").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return staged.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(NUMBER, F.col("_offset") + inside).drop(
        "_part", "_place", "_first", "_offset")


def record_names(numbered: DataFrame) -> DataFrame:
    """The dictionary (record_no, source_system, source_id), a row per record."""
    return numbered.select(NUMBER, *KEYS).distinct()


def with_names(rows: DataFrame, names: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with columns of record numbers replaced by system and id, named as ``columns`` says."""
    for number, (system, record_id) in columns.items():
        table = names.select(F.col(NUMBER).alias(number), F.col(KEYS[0]).alias(system), F.col(KEYS[1]).alias(record_id))
        rows = rows.join(table, number).drop(number)
    return rows


def with_numbers(rows: DataFrame, names: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The inverse: system and id columns replaced by numbers. Rows that name an unknown record go."""
    for number, (system, record_id) in columns.items():
        table = names.select(F.col(NUMBER).alias(number), F.col(KEYS[0]).alias(system), F.col(KEYS[1]).alias(record_id))
        rows = rows.join(table, [system, record_id]).drop(system, record_id)
    return rows
