"""The exact pass: records that agree on all columns of a rule.

Inside a run a group of k equal records is k links to its smallest record, found with one shuffle for all rules
at once. The pair table, k(k-1)/2 rows by definition, is a separate operator that the run does not need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithline.config import DEFAULT, LinkageConfig, Rule
from kithline.functions.ids import record_node
from kithline.operators.numbering import NUMBER, number_records, record_names, with_names
from kithline.operators.sieve import seen_twice
from kithline.operators.skew import tiled_join
from kithline.plans.staging import Staged, Staging

KEY = ("rule", "link_key")
#: The record columns of a pair table, by the number columns they stand for.
PAIR = {"l": ("left_source", "left_id"), "r": ("right_source", "right_id")}
PAIR_COLUMNS = [c for pair in PAIR.values() for c in pair]


def _entry(place: int, rule: Rule) -> Column:
    present = F.lit(True)
    for column in rule.columns:
        present = present & F.col(column).isNotNull()
    texts = [F.col(c).cast("string") for c in rule.columns]
    # The lengths in front keep different column values from reading as the same text.
    key = texts[0] if len(texts) == 1 else F.concat_ws(" ", *[F.length(t) for t in texts], *texts)
    return F.when(present, F.struct(F.lit(place).alias("rule"), key.alias("link_key")))


def rule_keys(numbered: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(node, system, rule, link_key): one row per record and rule whose columns are all present; ``rule`` is its place
    among the sorted ids, ``system`` a hash."""
    entries = F.array_compact(F.array(*[_entry(k, r) for k, r in enumerate(by_id(rules))]))
    return numbered.select(F.col(NUMBER).alias("node"), F.xxhash64("source_system").alias("system"), F.explode(entries).alias("e")).select(
        "node", "system", "e.*")


def by_id(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: r.rule_id)


def rule_names(place: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule_id, confidence) of the rule at a place."""
    ordered = by_id(rules)
    ids, confidences = F.array(*[F.lit(r.rule_id) for r in ordered]), F.array(*[F.lit(float(r.confidence)) for r in ordered])
    return F.get(ids, place), F.get(confidences, place)


def shared_keys(keys: Staged, staging: Staging, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """The ``keys`` that at least two records share, each row with the group's smallest record as ``root``.

    Keys that occur once, most of all, are sieved out before the rows are shuffled."""
    rows = seen_twice(keys.df, KEY, keys.rows, staging, cfg.sieve)
    # The smallest and the largest record differ when there are two records, and the smallest and the largest system
    # when there are two systems.
    what = "system" if cfg.cross_source_only else "node"
    groups = rows.groupBy(*KEY).agg(F.min("node").alias("root"), F.min(what).alias("low"), F.max(what).alias("high"))
    return rows.join(groups.where("low < high").drop("low", "high"), list(KEY))


def _staged_keys(numbered: DataFrame, staging: Staging, cfg: LinkageConfig) -> Staged:
    return staging.put(rule_keys(numbered, cfg.rules), "rule-keys")


def deterministic_links(numbered: DataFrame, staging: Staging, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """(node, root, rule_id, confidence): every matched record with its group's smallest record, per rule, as numbers.

    The smallest record itself is listed too, so the frame names all matched records.
    """
    linked = shared_keys(_staged_keys(numbered, staging, cfg), staging, cfg)
    rule_id, confidence = rule_names(F.col("rule"), cfg.rules)
    return linked.select("node", "root", rule_id.alias("rule_id"), confidence.alias("confidence"))


def deterministic_match(normalized: DataFrame, staging: Staging, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """All matching pairs, smaller record left, each once with its strongest rule.

    Only keys that two records share reach the pair join, and heavy ones are cut into tiles; the result itself grows
    with the square of a group.
    """
    numbered = number_records(normalized, staging)
    shared = shared_keys(_staged_keys(numbered, staging, cfg), staging, cfg)
    shared = staging.put(shared.drop("root").distinct(), "shared-keys")
    left = shared.df.select(*KEY, F.col("system").alias("system_l"), F.col("node").alias("l"))
    right = shared.df.select(*KEY, F.col("system").alias("system_r"), F.col("node").alias("r"))
    ordered = F.col("l") < F.col("r")
    if cfg.cross_source_only:
        ordered = ordered & (F.col("system_l") != F.col("system_r"))
    confidence = rule_names(F.col("rule"), cfg.rules)[1]
    best = tiled_join(left, right, KEY, "l", "r", cfg, staging).where(ordered).groupBy("l", "r").agg(
        F.min("rule").alias("rule"), F.max(confidence).alias("confidence"))
    named = with_names(best, record_names(numbered), PAIR)
    return named.select(*PAIR_COLUMNS, rule_names(F.col("rule"), cfg.rules)[0].alias("rule_id"), "confidence")


def pair_endpoints(pairs: DataFrame, *extra: str) -> DataFrame:
    """Both sides of a pair table as records, in one pass over it."""
    left, right = record_node("left_source", "left_id"), record_node("right_source", "right_id")
    return pairs.select(F.explode(F.array(left, right)).alias("node"), *extra)


def unmatched_records(numbered: DataFrame, matched: DataFrame) -> DataFrame:
    """Records that are not among the ``matched`` nodes."""
    return numbered.join(matched.select(F.col("node").alias(NUMBER)), NUMBER, "left_anti")
