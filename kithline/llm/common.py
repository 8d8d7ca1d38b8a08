"""Small helpers that several operators share: staged tables, id-limited text lookups, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kithline.plans.staging import Staged, Staging

#: Rows of numbers that may be broadcast: as a hash table on the executors they take some 50 to 100 bytes each, so 20 MB
#: at most. With more of them, a shuffle join is used.
BROADCAST_IDS = 200_000
#: Bytes of a batch that goes to a Python worker while an operator handles many long texts at once.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 marks a held-out row (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def only_ids(rows: DataFrame, ids: Staged, column: str) -> DataFrame:
    """``rows`` whose ``column`` is among ``ids(id)``. The ids travel to the rows if there are few enough, else both meet."""
    wanted = ids.df.withColumnRenamed("id", column)
    return rows.join(F.broadcast(wanted) if ids.rows <= BROADCAST_IDS else wanted, column, "left_semi")


def met(table_: Staged) -> DataFrame:
    """A counted table for an equi join: it travels to the other side if it is short enough, else both meet."""
    return F.broadcast(table_.df) if table_.rows <= BROADCAST_IDS else table_.df


def few(df: DataFrame, rows: int, each: int = 10_000) -> DataFrame:
    """``df``, of some ``rows`` at most, in no more tasks and files than these need."""
    return df.coalesce(max(-(-rows // each), 1))


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """Within it, batches for Python workers hold ``most`` bytes at most, or one row."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


_HELD: dict[str, object] = {}


def held(key: str, make: Callable[[], object]):
    """``make()``, kept between the tasks of a worker process until one of them holds something else or lets go."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Frees what this worker process keeps. Spark runs one stage's tasks in the worker processes of the stages before, so
    operators that need memory of their own begin their tasks with it. Arrow holds on to freed buffers, too."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()


def bitmap(rows: DataFrame, hashed: Column, bits: int) -> np.ndarray:
    """A table of ``bits`` bits (a power of two), 64 to a word, with one set per hash that occurs. The words are put
    together by Spark, so at most ``bits / 64`` rows reach the driver, whatever the input."""
    slot = rows.select(hashed.bitwiseAND(F.lit(bits - 1)).alias("slot"))
    words = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("set")).toArrow()
    table = np.zeros(max(bits // 64, 1), dtype=np.uint64)
    table[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
    return table


def connected_components(edges: DataFrame, staging: Staging, max_rounds: int = 60) -> DataFrame:
    """(id, root) of every node of ``edges(a, b)`` that is not its component's smallest.

    Alternating large-star and small-star steps (Kiveris et al., 2014): a node's smallest neighbour is a map-side
    combined minimum, moving links is one equi join. A round's links are written out, so a lost executor costs a round.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    staged = staging.put(links, "links")
    if staged.rows <= BROADCAST_IDS:
        staged = staging.put(few(staged.df, staged.rows), "few-links")
    most = staged.rows  # no step adds links
    for _ in range(max_rounds):
        # Large star: the larger neighbours of a node move to its smallest neighbour.
        both = staged.df.unionByName(staged.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        large = staged.df.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u").select(
            F.col("w").alias("u"), F.least("low", "u").alias("v"))
        large = staging.put(few(few(large, most).distinct(), most), "large-star").df
        # Small star: the smaller neighbours of a node, and itself, move to the smallest one.
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v"))
        staged = staging.put(few(few(small, most).distinct(), most), "small-star")
        roles = staged.df.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
            staged.df.select("v", F.lit(0), F.lit(1)))
        if roles.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
                "up > 1 or (up > 0 and down > 0)").isEmpty():
            return staged.df.select(F.col("u").alias("id"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
