"""Every number and switch of a linkage run, in one frozen value."""

from __future__ import annotations

from dataclasses import dataclass

from kithline.operators.sieve import Sieve


@dataclass(frozen=True)
class Rule:
    """An exact rule: records that agree on all ``columns`` (none NULL) are the same person."""

    rule_id: str
    columns: tuple[str, ...]
    confidence: float


# Exact rules with their confidences, strongest first (rule ids sort by strength).
RULES = (
    Rule("D1", ("emirates_id",), 1.00),
    Rule("D2", ("phone_e164", "dob"), 0.95),
    Rule("D3", ("email", "dob"), 0.90),
)

# Customer segments from the highest tier to the lowest.
SEGMENT_TIERS = ("private", "priority", "affluent", "mass")

# How a record got its customer id, the name of the queue counter, and the state of a queued pair.
DETERMINISTIC = "deterministic"
PROBABILISTIC_AUTO = "probabilistic_auto"
NEW_CUSTOMER = "new_customer"
REVIEW_QUEUE = "review_queue"
PENDING = "pending"


@dataclass(frozen=True)
class LinkageConfig:
    """Rules, weights, thresholds and options. Change with ``dataclasses.replace``."""

    rules: tuple[Rule, ...] = RULES
    cross_source_only: bool = False

    # Fuzzy score: weights of the four signals and the two cut points.
    weight_name: float = 0.40
    weight_dob: float = 0.30
    weight_phone: float = 0.20
    weight_email_domain: float = 0.10
    auto_threshold: float = 0.70
    review_threshold: float = 0.50
    # Scores of a near birth date and of a phone that agrees on its last six digits only.
    near_dob_score: float = 0.6
    phone_tail_score: float = 0.7
    dob_tolerance_days: int = 180
    # Scores are rounded to this many places before any comparison; 3 gives NUMERIC(4,3).
    confidence_scale: int = 6
    # Places to which the name scores of a pair table are rounded after the confidence was made of them; None leaves them.
    name_scale: int | None = None
    # True puts all nameless records into one block; False leaves them out of the fuzzy pass.
    block_null_names: bool = False

    # Cleaning.
    apply_filters: bool = True
    strict_phone: bool = False
    strict_hyphens: bool = False

    # Golden record: 'attribute' takes the newest e-mail and the newest phone, 'row' both from one row.
    contact_mode: str = "attribute"
    # True keeps records that wait in the review queue out of the golden table.
    hold_review: bool = False

    # Scale. A key that stands for more pairs than this is cut into tiles of at most so many in a pair join.
    tile_pairs: int = 4_000_000
    # Tiles that the pairs of all cut keys make, about; with more pairs the tiles are larger, so that copies of rows are bounded.
    most_tiles: int = 4_096
    # Pairs that a task of a whole block's join makes, about.
    task_pairs: int = 1_000_000
    # The table of cut keys is broadcast up to this many rows; a longer one meets its rows by a shuffle.
    broadcast_keys: int = 100_000
    # Sizes of the sketch that sieves out exact keys of a single record.
    sieve: Sieve = Sieve()
    # Component rounds grow with the logarithm of the longest chain; more than this is a fault.
    max_rounds: int = 60

    def __post_init__(self) -> None:
        if self.contact_mode not in ("attribute", "row"):
            raise ValueError(f"contact_mode must be 'attribute' or 'row', not {self.contact_mode!r}")
        if not 0 < self.review_threshold <= self.auto_threshold:
            raise ValueError("thresholds must satisfy 0 < review <= auto")


DEFAULT = LinkageConfig()
