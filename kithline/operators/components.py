"""Connected components on edge tables, and the customer ids made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.config import DEFAULT, LinkageConfig
from kithline.functions.ids import customer_id
from kithline.operators.numbering import KEYS, NUMBER, number_records, record_names, with_numbers
from kithline.plans.staging import Staged, Staging


def _is_forest_of_stars(links: DataFrame) -> bool:
    """True when every node hangs on one root and no root hangs on anything."""
    roles = links.select("node", F.lit(1).alias("parents"), F.lit(0).alias("is_root")).unionAll(
        links.select("root", F.lit(0), F.lit(1)))
    wrong = roles.groupBy("node").agg(F.sum("parents").alias("parents"), F.max("is_root").alias("is_root")).where(
        (F.col("parents") > 1) | ((F.col("parents") > 0) & (F.col("is_root") > 0)))
    return wrong.isEmpty()


def _round(links: DataFrame, staging: Staging) -> DataFrame:
    """One large-star and one small-star step (Kiveris et al., 2014) over links that point to smaller nodes.

    Each step is a map-side combined minimum and one equi join, whose large partitions adaptive execution splits.
    """
    # Large star: a link to a node that itself hangs on something moves to that node's smallest parent.
    parent = links.groupBy("node").agg(F.min("root").alias("next")).withColumnRenamed("node", "root")
    large = staging.put(links.join(parent, "root", "left").select(
        "node", F.coalesce("next", "root").alias("root")), "large-star").df
    # Small star: all parents of a node move to the smallest one.
    low = large.groupBy("node").agg(F.min("root").alias("low"))
    return large.join(low, "node").select(
        F.when(F.col("root") == F.col("low"), F.col("node")).otherwise(F.col("root")).alias("node"),
        F.col("low").alias("root"),
    ).distinct()


def connected_components(edges: DataFrame, staging: Staging, cfg: LinkageConfig = DEFAULT) -> Staged:
    """(node, root) for every node of ``edges(node, root)``, record numbers, that is not its component's smallest.

    Each round is written out, so a lost executor costs one round at most. Reaching ``max_rounds`` raises; partial
    labels are never returned.
    """
    links = edges.select(
        F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root")
    ).where(F.col("node") != F.col("root")).distinct()
    staged = staging.put(links, "links")
    for _ in range(cfg.max_rounds):
        if _is_forest_of_stars(staged.df):
            return staged
        staged = staging.put(_round(staged.df, staging), "links")
    raise RuntimeError(f"components did not settle in {cfg.max_rounds} rounds")


def component_map(names: DataFrame, links: DataFrame) -> DataFrame:
    """(node, source_system, source_id, root, mal_customer_id) for all records of ``names``; one without a link is its
    own component. Only linked records look up the name of their smallest one."""
    own = names.withColumnRenamed(NUMBER, "node")
    roots = links.join(own.select(F.col("node").alias("root"), F.struct(*KEYS).alias("root_key")), "root")
    rooted = own.join(roots, "node", "left")
    return rooted.select("node", *KEYS, F.coalesce("root", "node").alias("root"),
                         customer_id(F.coalesce("root_key", F.struct(*KEYS))).alias("mal_customer_id"))


def assign_ids(normalized: DataFrame, pairs: DataFrame, staging: Staging, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """(source_system, source_id, mal_customer_id) for every record, linked by a pair table.

    Pairs that name a record outside ``normalized`` are ignored.
    """
    names = record_names(number_records(normalized, staging))
    edges = with_numbers(pairs, names, {"node": ("left_source", "left_id"), "root": ("right_source", "right_id")})
    links = connected_components(edges.select("node", "root"), staging, cfg)
    return component_map(names, links.df).select(*KEYS, "mal_customer_id")
