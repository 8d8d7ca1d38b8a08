"""The fuzzy pass over unmatched records.

The rule set compares all records of different systems within a name block. Almost none of those pairs can reach
the review threshold, and which ones can is known from the weights: the name alone is worth less than the threshold,
so another signal must agree as well. Candidates therefore meet on a block together with a phone tail, a birth-date
bucket, or an e-mail domain, and no pair at or above ``min_confidence`` is missed.

Records with equal attributes score alike, so the pass works on profiles (distinct attribute rows) and pairs of
profiles; copies of a record cost nothing. Pairs of records are made only where a pair table is the result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithline.config import DEFAULT, LinkageConfig
from kithline.functions.contact import email_domain
from kithline.functions.names import block_key
from kithline.functions.similarity import (
    confidence, dob_score, domain_score, jaro_winkler, jaro_winkler_bound, letter_counts, near_dates, other_signals, phone_score,
    phone_tail, shared_letters,
)
from kithline.operators.deterministic import PAIR, PAIR_COLUMNS, pair_endpoints, unmatched_records
from kithline.operators.numbering import KEYS, NUMBER, number_records, record_names, with_numbers
from kithline.operators.skew import tiled_join
from kithline.plans.staging import Staged, Staging

ATTRIBUTES = ("source_system", "name", "dob", "phone", "domain", "block")
SCORES = ("jw_name", "dob_score", "phone_score", "email_domain_score", "confidence")
SEPARATOR = "\u0001"  # cannot occur in a clean name, phone or date


def block_records(unmatched: DataFrame, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """(node, source_id, attributes, profile): the numbered records that take part in the fuzzy pass."""
    rows = unmatched.select(
        F.col(NUMBER).alias("node"), "source_system", "source_id", F.col("name_english").alias("name"), "dob",
        F.col("phone_e164").alias("phone"), email_domain(F.col("email")).alias("domain"),
        block_key(F.col("name_english"), cfg.block_null_names).alias("block"),
    ).where(F.col("block").isNotNull())
    return rows.withColumn("profile", _profile_text(*[F.col(c) for c in ATTRIBUTES[:-1]]))


def _profile_text(*attributes: Column) -> Column:
    return F.concat_ws(SEPARATOR, *[F.coalesce(a.cast("string"), F.lit("")) for a in attributes])


def profiles(records: DataFrame) -> DataFrame:
    """One row per distinct attribute row, with a number of its own; ``rep`` is its smallest record, ``rep_id`` the id of that
    one, and ``n`` the number of its records."""
    rows = records.select("node", "source_id", *ATTRIBUTES).distinct()
    groups = rows.groupBy(*ATTRIBUTES).agg(
        F.min("node").alias("rep"), F.min_by("source_id", "node").alias("rep_id"), F.count(F.lit(1)).alias("n"))
    return groups.withColumn("profile", F.monotonically_increasing_id())


def block_sizes(unmatched: DataFrame, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """(block_key, records, candidate_pairs): how many cross-system pairs a block stands for, without making them."""
    rows = unmatched if NUMBER in unmatched.columns else unmatched.withColumn(NUMBER, F.struct(*KEYS))
    per_system = block_records(rows, cfg).groupBy("block", "source_system").agg(F.countDistinct("node").alias("n"))
    squares = F.sum(F.col("n") * F.col("n"))
    return per_system.groupBy("block").agg(
        F.sum("n").alias("records"),
        F.floor((F.sum("n") * F.sum("n") - squares) / 2).cast("long").alias("candidate_pairs"),
    ).withColumnRenamed("block", "block_key")


@dataclass(frozen=True)
class _Keys:
    """Which key kinds are needed so that no pair of at least ``min_confidence`` is missed."""

    min_confidence: float
    cfg: LinkageConfig

    @property
    def _floor(self) -> float:
        """The lowest unrounded score that still rounds to ``min_confidence``, with room for float error."""
        return self.min_confidence - 0.5 * 10.0 ** -self.cfg.confidence_scale - 1e-9

    @property
    def whole_block(self) -> bool:
        """The name alone can reach the threshold: nothing narrows the block."""
        return self._floor <= self.cfg.weight_name

    @property
    def domain(self) -> bool:
        """Name and e-mail domain together can reach the threshold."""
        return self._floor <= self.cfg.weight_name + self.cfg.weight_email_domain

    @property
    def equal_dob(self) -> bool:
        """A near birth date, a name and an e-mail domain cannot reach the threshold: without a phone tail, dates must be equal."""
        near = max(0.0, self.cfg.weight_dob) * self.cfg.near_dob_score
        return not self.domain and self._floor > self.cfg.weight_name + near + max(0.0, self.cfg.weight_email_domain)

    @property
    def equal_name_length(self) -> int:
        """Names shorter than this must be equal for a pair that agrees on name and domain only.

        Two different names of at most L characters stay at least 0.2 / L below a Jaro-Winkler of 1. With the
        allowed gap d, different names need L > 0.2 / d, and the shorter one at least (1 - 5 d) L characters.
        """
        if self.cfg.weight_name <= 0:
            return 0
        gap = 1.0 - (self._floor - self.cfg.weight_email_domain) / self.cfg.weight_name
        return max(0, math.floor((1.0 - 5.0 * gap) * 0.2 / gap)) if 0 < gap < 0.2 else 0

    @property
    def alike(self) -> Column:
        """Rows that meet others of an equal name and domain."""
        return self.alike_text(F.col("name"), F.col("domain"))

    def alike_text(self, name: Column, domain: Column) -> Column:
        return domain.isNotNull() & name.isNotNull() & (F.length(name) < (self.equal_name_length if self.domain else 0))

    def of(self, rows: DataFrame, both_neighbours: bool) -> DataFrame:
        """``rows`` once per candidate key but those of ``alike``, in column ``link_key``."""
        block, cfg = F.col("block"), self.cfg

        def key(kind: str, *parts: Column) -> Column:
            return F.concat_ws(SEPARATOR, F.lit(kind), *parts)

        keys = [F.when(F.col("phone").isNotNull(), key("p", block, phone_tail(F.col("phone"))))]
        width = 1 if self.equal_dob else max(1, cfg.dob_tolerance_days)
        bucket = F.floor(F.unix_date("dob") / width)
        near = [bucket + step for step in ((-1, 0, 1) if both_neighbours and not self.equal_dob else (0,))]
        keys += [F.when(F.col("dob").isNotNull(), key("d", block, b.cast("string"))) for b in near]
        if self.domain:
            known = F.col("domain").isNotNull() & F.col("name").isNotNull()
            # A nameless record scores no name at all: it meets others on a domain that suffices alone.
            nameless = F.col("domain").isNotNull() & F.lit(self.cfg.block_null_names and self._floor <= self.cfg.weight_email_domain)
            keys.append(F.when((known & ~self.alike) | nameless, key("e", block, F.col("domain"))))
        return rows.withColumn("link_key", F.explode(F.array_compact(F.array(*keys))))

    def first_shared(self, near_dob: Column, same_tail: Column) -> Column:
        """True on one of the keys two rows share, so that a pair comes out once."""
        kind = F.left("link_key", F.lit(1))
        return (kind == "p") | ((kind == "d") & near_dob & ~same_tail) | ((kind == "e") & ~near_dob & ~same_tail)


ENDS = [f"{c}_{s}" for s in "lr" for c in ("profile", "rep", "n", "system", "id")]


def _sides(table: DataFrame, systems: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The profiles as left and right sides of pairs. A row looks for partners in the systems that sort after its own, one
    copy per system."""
    later = F.filter(F.array(*[F.lit(s) for s in sorted(systems)]), lambda s: s > F.col("source_system"))
    return table.withColumn("partner", F.explode(later)), table.withColumn("partner", F.col("source_system"))


def _suffixed(side: DataFrame, s: str, *kept: str) -> DataFrame:
    columns = {"profile": "profile", "rep": "rep", "n": "n", "source_system": "system", "rep_id": "id", **{c: c for c in ATTRIBUTES[1:]}}
    return side.select("partner", *kept, *[F.col(c).alias(f"{a}_{s}") for c, a in columns.items()])


def _signals(pairs: DataFrame, cfg: LinkageConfig) -> DataFrame:
    l, r = (lambda c: F.col(f"{c}_l")), (lambda c: F.col(f"{c}_r"))
    return pairs.withColumns({
        "dob_score": dob_score(l("dob"), r("dob"), cfg),
        "phone_score": phone_score(l("phone"), r("phone"), cfg),
        "email_domain_score": domain_score(l("domain"), r("domain")),
    })


def _agreement(cfg: LinkageConfig) -> tuple[Column, Column]:
    """(birth dates are near, phone tails are equal) of a pair."""
    tails = F.coalesce(phone_tail(F.col("phone_l")) == phone_tail(F.col("phone_r")), F.lit(False))
    return near_dates(F.col("dob_l"), F.col("dob_r"), cfg.dob_tolerance_days), tails


def _name_score(cfg: LinkageConfig) -> Column:
    return F.col("jw_name") if cfg.name_scale is None else F.round("jw_name", cfg.name_scale).alias("jw_name")


def _total(pairs: DataFrame, floor: float, cfg: LinkageConfig, *more: str) -> DataFrame:
    total = confidence(*[F.col(c) for c in SCORES[:-1]], cfg)
    kept = pairs.withColumn("confidence", total).where(F.col("confidence") >= floor)
    return kept.select(*ENDS, _name_score(cfg), *SCORES[1:], *more)


def _confidences(cfg: LinkageConfig) -> tuple[Column, Column]:
    """(all confidences that a ``jw_name`` can have a part in, the place among them of a pair with the other signals).

    A signal but the name has two or three values. Rounding is by far the dearest step of a pair, and is done once per pair of names."""
    values = {"dob_score": (0.0, cfg.near_dob_score, 1.0), "phone_score": (0.0, cfg.phone_tail_score, 1.0), "email_domain_score": (0.0, 1.0)}
    made = [confidence(F.col("jw_name"), *map(F.lit, signals), cfg) for signals in itertools.product(*values.values())]
    place = F.lit(0)
    for name, own in values.items():
        rank = F.lit(0)
        for k, value in list(enumerate(own))[1:]:
            rank = F.when(F.col(name) == value, F.lit(k)).otherwise(rank)
        place = place * len(own) + rank
    return F.array(*made), place


def _close_pairs(table: DataFrame, systems: Sequence[str], staging: Staging, cfg: LinkageConfig, floor: float,
                 *more: str) -> DataFrame:
    """The scored pairs that share a phone tail, a near birth date, or the domain of a name too long to be compared as a whole."""
    keys = _Keys(floor, cfg)
    rows = table.withColumn("letters", letter_counts(F.col("name")))
    left, right = _sides(rows, systems)
    left, right = [
        _suffixed(keys.of(side, s == "r").withColumn(f"letters_{s}", F.col("letters")), s, "link_key", f"letters_{s}")
        for side, s in ((left, "l"), (right, "r"))]
    both = tiled_join(left, right, ["partner", "link_key"], "profile_l", "profile_r", cfg, staging)
    pairs = both.where((F.col("block_l") == F.col("block_r")) & keys.first_shared(*_agreement(cfg)))
    scored = _signals(pairs, cfg)
    # The best the name could add decides who goes on to the Jaro-Winkler batches.
    cheap = other_signals(F.col("dob_score"), F.col("phone_score"), F.col("email_domain_score"), cfg)
    names = F.col("name_l"), F.col("name_r")
    bound = jaro_winkler_bound(*names, shared_letters(F.col("letters_l"), F.col("letters_r")))
    reachable = cheap + bound * cfg.weight_name >= keys._floor
    return _total(scored.where(reachable).select(
        *ENDS, *more, jaro_winkler(*names).alias("jw_name"), "dob_score", "phone_score", "email_domain_score"), floor, cfg, *more)


def _alike_pairs(table: DataFrame, systems: Sequence[str], staging: Staging, cfg: LinkageConfig, floor: float) -> DataFrame:
    """The scored pairs of equal names and domains that agree on nothing else; no name has to be compared for them.

    Their score is the same for all, so it is made once. They are most of all pairs: rows hold no more than the pairs need."""
    rows = table.where(_Keys(floor, cfg).alike).withColumn("tail", phone_tail(F.col("phone")))
    kept = {"profile": "profile", "rep": "rep", "n": "n", "source_system": "system", "rep_id": "id", "dob": "dob", "tail": "tail"}
    left, right = [
        side.select("partner", F.col("name").alias("link_name"), F.col("domain").alias("link_domain"), *[
            F.col(c).alias(f"{a}_{s}") for c, a in kept.items()])
        for side, s in zip(_sides(rows, systems), "lr")]
    both = tiled_join(left, right, ["partner", "link_name", "link_domain"], "profile_l", "profile_r", cfg, staging)
    dobs = F.col("dob_l"), F.col("dob_r")
    same_tail = F.coalesce(F.col("tail_l") == F.col("tail_r"), F.lit(False))
    # With a negative tolerance, not even equal dates are near.
    dob = F.lit(0.0) if cfg.dob_tolerance_days >= 0 else dob_score(*dobs, cfg)
    signals = F.lit(1.0), dob, F.lit(0.0), F.lit(1.0)
    total = confidence(*signals, cfg)
    pairs = both.where(~near_dates(*dobs, cfg.dob_tolerance_days) & ~same_tail).where(total >= floor)
    return pairs.select(*ENDS, *[score.alias(name) for name, score in zip(SCORES, (*signals, total))])


def _block_pairs(table: DataFrame, systems: Sequence[str], staging: Staging, cfg: LinkageConfig, floor: float) -> DataFrame:
    """The scored pairs of whole blocks. Names are compared once per pair of different names, not once per pair of profiles."""
    rows = table.withColumn("key_name", F.coalesce("name", F.lit("")))
    left, right = _sides(rows, systems)
    names = [side.select("partner", "block", F.col("key_name").alias(f"name_{s}")).distinct() for side, s in ((left, "l"), (right, "r"))]
    compared = tiled_join(*names, ["partner", "block"], "name_l", "name_r", cfg, staging)
    compared = staging.put(compared.withColumn("jw_name", jaro_winkler(F.col("name_l"), F.col("name_r"))), "name-pairs").df
    made, place = _confidences(cfg)
    compared = compared.select("partner", F.col("block").alias("key_block"), F.col("name_l").alias("key_name_l"),
                               F.col("name_r").alias("key_name_r"), _name_score(cfg), made.alias("confidences"))
    sizes = [side.groupBy("partner", "block").agg(F.count(F.lit(1)).cast("double").alias(s)) for side, s in ((left, "l"), (right, "r"))]
    pairs = sizes[0].join(sizes[1], ["partner", "block"]).agg(F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0.0))).first()[0]
    tasks = min(math.ceil(pairs / cfg.task_pairs), cfg.most_tiles)
    left, right = [
        _suffixed(side.withColumns({"key_block": F.col("block"), f"key_name_{s}": F.col("key_name")}), s, "key_block", f"key_name_{s}")
        for side, s in ((left, "l"), (right, "r"))]
    named = tiled_join(left, compared, ["partner", "key_block", "key_name_l"], "profile_l", "key_name_r", cfg, staging).drop("key_name_l")
    # With few pairs, Spark's own number of tasks does.
    both = tiled_join(named, right, ["partner", "key_block", "key_name_r"], "profile_l", "profile_r", cfg, staging, tasks if tasks > 8 else 0)
    scored = _signals(both, cfg).withColumn("confidence", F.get("confidences", place))
    return scored.where(F.col("confidence") >= floor).select(*ENDS, *SCORES)


def score_profiles(
    table: DataFrame,
    systems: Sequence[str],
    staging: Staging,
    cfg: LinkageConfig = DEFAULT,
    min_confidence: float | None = None,
) -> DataFrame:
    """Both profiles (``ENDS``) and the scores of all profile pairs of two systems that reach ``min_confidence``."""
    floor = cfg.review_threshold if min_confidence is None else min_confidence
    keys = _Keys(floor, cfg)
    if keys.whole_block:
        return _block_pairs(table, systems, staging, cfg, floor)
    close = _close_pairs(table, systems, staging, cfg, floor)
    return close.unionByName(_alike_pairs(table, systems, staging, cfg, floor)) if keys.domain else close


def count_review_pairs(table: DataFrame, systems: Sequence[str], staging: Staging, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """One row (n): the number of record pairs in review.

    Pairs that agree on name and domain alone, which are most of them and grow with the square of the table, all have one
    score. They are counted from the sizes of their groups, less those pairs of a group that agree on more."""
    floor, cfg = cfg.review_threshold, replace(cfg, name_scale=None)
    keys, pairs = _Keys(floor, cfg), F.col("n_l") * F.col("n_r")
    if keys.whole_block:
        return review_pairs(score_profiles(table, systems, staging, cfg), cfg).agg(F.coalesce(F.sum(pairs), F.lit(0)).alias("n"))
    band = (F.col("confidence") >= cfg.review_threshold) & (F.col("confidence") < cfg.auto_threshold)
    close = _close_pairs(table, systems, staging, cfg, floor, "name_l", "domain_l")
    if not keys.domain:
        return close.agg(F.coalesce(F.sum(F.when(band, pairs)), F.lit(0)).alias("n"))
    same_name = (F.col("jw_name") == 1.0) & (F.col("email_domain_score") == 1.0)
    short = keys.alike_text(F.col("name_l"), F.col("domain_l"))
    counted = close.agg(F.sum(F.when(band, pairs)).alias("close"), F.sum(F.when(same_name & short, pairs)).alias("more"))
    groups = table.where(keys.alike & F.col("source_system").isin(*systems)).groupBy("name", "domain", "source_system").agg(F.sum("n").alias("n"))
    groups = groups.groupBy("name", "domain").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    total = groups.agg(F.sum(((F.col("n") * F.col("n") - F.col("squares")) / 2).cast("long")).alias("alike"))
    alone = total.crossJoin(counted).withColumn(
        "confidence", confidence(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(1.0), cfg))
    zero = F.lit(0)
    rest = F.when(band, F.coalesce("alike", zero) - F.coalesce("more", zero)).otherwise(zero)
    return alone.select((F.coalesce("close", zero) + rest).alias("n"))


def best_records(profile_pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(node, rep, confidence): the records of both sides of profile pairs, with their profile's best score."""
    sides = [F.struct(*[F.col(f"{c}_{s}").alias(c) for c in ("profile", "rep", "n")]) for s in "lr"]
    ends = profile_pairs.select(F.explode(F.array(*sides)).alias("end"), "confidence").select("end.*", "confidence")
    best = ends.groupBy("profile", "rep", "n").agg(F.max("confidence").alias("confidence"))
    several = best.where("n > 1").join(members.select("profile", "node"), "profile")
    return best.where("n = 1").select(F.col("rep").alias("node"), "rep", "confidence").unionByName(
        several.select("node", "rep", "confidence"))


def profile_members(records: Staged, table: Staged, staging: Staging) -> Staged:
    """(node, source_id, profile): the records of the profiles that have several."""
    several = table.df.where("n > 1").select(F.col("profile").alias("number"), _profile_text(*[F.col(c) for c in ATTRIBUTES[:-1]]).alias("profile"))
    rows = records.df.select("node", "source_id", "profile").join(several, "profile")
    return staging.put(rows.select("node", "source_id", F.col("number").alias("profile")).distinct(), "members")


def record_pairs(profile_pairs: DataFrame, members: Staged, staging: Staging, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    """The pair table behind profile pairs: every record of one profile with every record of the other.

    Most profiles are one record, whose id the pair holds already; only the others meet their members."""
    pairs = profile_pairs
    if members.rows:
        for side, other in (("l", "r"), ("r", "l")):
            ids = members.df.select(F.col("profile").alias(f"profile_{side}"), F.col("node").alias("node"), F.col("source_id").alias("member_id"))
            several = tiled_join(pairs.where(F.col(f"n_{side}") > 1), ids, [f"profile_{side}"], f"profile_{other}", "node", cfg, staging)
            several = several.withColumn(f"id_{side}", F.col("member_id")).select(*pairs.columns)
            pairs = staging.put(pairs.where(F.col(f"n_{side}") == 1).unionByName(several), "half-pairs").df
    ends = [F.col(f"{c}_{s}").alias(name) for s, names in PAIR.items() for c, name in zip(("system", "id"), names)]
    return pairs.select(*ends, *SCORES)


def fuzzy_profiles(normalized: DataFrame, matched: DataFrame, staging: Staging, cfg: LinkageConfig = DEFAULT) -> tuple[Staged, Staged]:
    """The numbered records that are not ``matched`` and take part, and their profiles."""
    records = staging.put(block_records(unmatched_records(normalized, matched), cfg), "fuzzy-records")
    return records, staging.put(profiles(records.df), "profiles")


def scored_records(
    table: Staged,
    members: Staged,
    systems: Sequence[str],
    staging: Staging,
    cfg: LinkageConfig = DEFAULT,
    min_confidence: float | None = None,
    band: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
) -> DataFrame:
    """The pair table of the fuzzy pass. Pairs of profiles are written only where they are read again, to meet members."""
    pairs = band(score_profiles(table.df, systems, staging, cfg, min_confidence))
    return record_pairs(staging.put(pairs, "review-scored").df if members.rows else pairs, members, staging, cfg)


def probabilistic_match(
    normalized: DataFrame,
    deterministic_pairs: DataFrame,
    systems: Sequence[str],
    staging: Staging,
    cfg: LinkageConfig = DEFAULT,
    min_confidence: float | None = None,
) -> DataFrame:
    """Scored pairs of records without a deterministic pair, all that reach ``min_confidence``.

    The default is the review threshold, below which no later step looks. 0 asks for every pair of every block.
    """
    numbered = number_records(normalized, staging)
    names = record_names(numbered)
    ends = pair_endpoints(deterministic_pairs).select("node.*")
    matched = with_numbers(ends, names, {"node": tuple(KEYS)})
    records, table = fuzzy_profiles(numbered, matched, staging, cfg)
    members = profile_members(records, table, staging)
    return scored_records(table, members, systems, staging, cfg, min_confidence)


def auto_pairs(scored: DataFrame, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    return scored.where(F.col("confidence") >= cfg.auto_threshold)


def review_pairs(scored: DataFrame, cfg: LinkageConfig = DEFAULT) -> DataFrame:
    return scored.where((F.col("confidence") >= cfg.review_threshold) & (F.col("confidence") < cfg.auto_threshold))
