"""Dropping keys that occur once, before anything else of their rows is shuffled.

Most keys of an exact rule belong to one record. A counting sketch tells: all keys are counted by a hash of few bits, and
only rows whose hash was seen twice go on. It lets some single keys through, and never drops a shared one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.plans.staging import Staging


@dataclass(frozen=True)
class Sieve:
    #: Slots per key, and the bounds of the number of slots (powers of two).
    per_key: int = 8
    least_slots: int = 1 << 10
    most_slots: int = 1 << 26
    #: Words of 64 slots that are sent to the tasks; a longer table is not worth sending, and nothing is sieved.
    most_words: int = 200_000


def seen_twice(rows: DataFrame, keys: Sequence[str], count: int, staging: Staging, sieve: Sieve = Sieve()) -> DataFrame:
    """``rows`` without most of those whose ``keys`` no other row has; ``count`` is their number, or about.

    Counting shuffles a hash per key, map-side combined. What travels back is one bit per slot, in words of 64 that hold
    any, and is sent only after the words were counted.
    """
    slots = sieve.least_slots
    while slots < min(sieve.per_key * count, sieve.most_slots):
        slots *= 2
    slot = F.xxhash64(*keys).bitwiseAND(F.lit(slots - 1))
    twice = rows.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    words = staging.put(twice.groupBy(F.shiftright("slot", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("_bits")), "seen-twice")
    if words.rows > sieve.most_words:
        return rows
    bit = F.expr("shiftright(_bits, cast(_slot & 63 as int)) & 1")
    return rows.withColumn("_slot", slot).withColumn("_word", F.shiftright("_slot", 6)).join(
        F.broadcast(words.df), "_word").where(bit == 1).drop("_slot", "_word", "_bits")
