"""A many-to-many join that keeps its balance whatever the keys hold.

Joins to a table with one row per key need nothing of the kind: adaptive execution splits their large partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.config import LinkageConfig
from kithline.plans.staging import Staging


def tile_size(pairs: float, cfg: LinkageConfig) -> float:
    """How many pairs a tile stands for, when the keys that are cut stand for so many ``pairs``."""
    return max(cfg.tile_pairs, pairs / cfg.most_tiles)


def tiled_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_left: str,
    spread_right: str,
    cfg: LinkageConfig,
    staging: Staging,
    tasks: int = 0,
) -> DataFrame:
    """All (left, right) rows with equal keys, both sides many-to-many, no other column name in common.

    The pairs of every key above ``tile_pairs`` are cut into a grid: a left row belongs to one of its key's left slices
    and is copied to every right slice, and the other way round, so that a tile stands for about ``tile_pairs`` pairs at
    most. A tile stands for no less than its share of all those pairs among ``most_tiles``: smaller ones would not balance
    better, but copy every row once more for every few rows that it meets. Slices are taken from a hash of the ``spread``
    columns, which is stable when a task is retried. Keys are counted on both sides, map-side combined, and only those to
    be cut are listed. The join has ``tasks`` partitions, where that is known: Spark sees the bytes of the rows, not how many pairs come of them.
    """
    keys = list(keys)

    def dealt(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        return rows.repartition(tasks, *by) if tasks else rows

    counts = [side.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)) for side, name in ((left, "_l"), (right, "_r"))]
    pairs = F.col("_l").cast("double") * F.col("_r")
    grid = staging.put(counts[0].join(counts[1], keys).where(pairs > cfg.tile_pairs), "tiles")
    if not grid.rows:
        return dealt(left, keys).join(dealt(right, keys), keys)
    tile = tile_size(grid.df.agg(F.sum(pairs)).first()[0], cfg)
    rows = max(1, int(tile ** 0.5))
    table = grid.df.where(pairs > tile).select(
        *keys, F.ceil(F.col("_l") / rows).cast("int").alias("_slices_l"), F.ceil(F.col("_r") / rows).cast("int").alias("_slices_r"))
    if grid.rows <= cfg.broadcast_keys:
        table = F.broadcast(table)

    def slices(side: DataFrame, own: str, other: str, spread: str) -> DataFrame:
        return (
            side.join(table, keys, "left")
            .withColumn(f"_tile{own}", F.pmod(F.xxhash64(spread), F.coalesce(f"_slices{own}", F.lit(1))).cast("int"))
            .withColumn(f"_tile{other}", F.explode(F.sequence(F.lit(0), F.coalesce(f"_slices{other}", F.lit(1)) - 1)))
            .drop("_slices_l", "_slices_r")
        )

    tiles = [*keys, "_tile_l", "_tile_r"]
    return (
        dealt(slices(left, "_l", "_r", spread_left), tiles)
        .join(dealt(slices(right, "_r", "_l", spread_right), tiles), tiles)
        .drop("_tile_l", "_tile_r")
    )
