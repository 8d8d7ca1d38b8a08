"""The whole run, and each of its steps under one object."""

from __future__ import annotations

from collections.abc import Mapping
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kithline.config import DEFAULT, LinkageConfig
from kithline.operators import crosswalk as xw
from kithline.operators import deterministic as det
from kithline.operators import probabilistic as prob
from kithline.operators.components import assign_ids, component_map, connected_components
from kithline.operators.normalize import normalize
from kithline.operators.numbering import KEYS, number_records, record_names, with_names
from kithline.operators.survivorship import survivorship
from kithline.plans.staging import Staging, inputs_key
from kithline.sources.adapters import ADAPTERS, Adapter


@dataclass(frozen=True)
class Resolution:
    """Outcome of a run. The four results come first; the rest are the staged steps behind them."""

    dim_customer: DataFrame
    crosswalk: DataFrame
    normalized: DataFrame
    names: DataFrame
    det_links: DataFrame
    components: DataFrame
    attribution: DataFrame
    scored: DataFrame
    members: DataFrame
    make_review_queue: Callable[[], DataFrame]
    make_stats: Callable[[], DataFrame]
    staging: Staging

    @cached_property
    def stats(self) -> DataFrame:
        """One row of counters; made when they are first asked for, as only they need the size of the queue."""
        return self.make_stats()

    @cached_property
    def review_queue(self) -> DataFrame:
        """Borderline pairs; made when they are first asked for, as no other result needs the pairs."""
        return self.make_review_queue()

    def release(self) -> None:
        """Deletes the run's staged tables; results that were not written elsewhere are gone with them."""
        self.staging.release()

    def results(self) -> dict[str, DataFrame]:
        return {"dim_customer": self.dim_customer, "crosswalk": self.crosswalk,
                "review_queue": self.review_queue, "stats": self.stats}

    def create_views(self, prefix: str = "") -> None:
        """Temp views of all results and steps, for SQL over a finished run."""
        steps = {name: df for name, df in vars(self).items() if isinstance(df, DataFrame)}
        for name, df in {**steps, "review_queue": self.review_queue, "stats": self.stats}.items():
            df.createOrReplaceTempView(prefix + name)


class Resolver:
    """Two-pass record linkage. ``run`` is the production path; the other methods are its steps on their own."""

    def __init__(self, spark: SparkSession, cfg: LinkageConfig = DEFAULT, adapters: Mapping[str, Adapter] = ADAPTERS,
                 folder: str | None = None):
        self.spark, self.cfg, self.adapters, self._folder = spark, cfg, adapters, folder

    def staging(self, key: str | None = None) -> Staging:
        return Staging(self.spark, self._folder, key)

    def normalize(self, sources: Mapping[str, DataFrame]) -> DataFrame:
        return normalize(sources, self.cfg, self.adapters)

    def deterministic_match(self, normalized: DataFrame) -> DataFrame:
        return det.deterministic_match(normalized, self.staging(), self.cfg)

    def probabilistic_match(self, normalized: DataFrame, deterministic_pairs: DataFrame,
                            min_confidence: float | None = None) -> DataFrame:
        return prob.probabilistic_match(
            normalized, deterministic_pairs, tuple(self.adapters), self.staging(), self.cfg, min_confidence)

    def assign_ids(self, normalized: DataFrame, linked_pairs: DataFrame) -> DataFrame:
        return assign_ids(normalized, linked_pairs, self.staging(), self.cfg)

    def survivorship(self, normalized: DataFrame, crosswalk: DataFrame, run_ts: datetime | None = None) -> DataFrame:
        return survivorship(normalized, crosswalk, run_ts or _now(), self.cfg)

    def run(self, sources: Mapping[str, DataFrame], run_ts: datetime | None = None, resume: bool = False) -> Resolution:
        """Link all sources. Steps that are read more than once are staged; nothing passes through the driver.

        With ``resume`` a run whose driver was lost goes on where it ended: finished tables of a run over the same files with
        the same settings and ``run_ts`` are taken up. That needs a fixed ``run_ts`` and a folder that outlives the driver."""
        if resume and run_ts is None:
            raise ValueError("a run that may be resumed needs its run_ts")
        cfg, run_ts = self.cfg, run_ts or _now()
        staging = self.staging(inputs_key(sources, cfg, sorted(self.adapters.items()), run_ts) if resume else None)
        normalized = number_records(staging.put(self.normalize(sources), "normalized").df, staging)
        names = staging.put(record_names(normalized), "names").df
        links = staging.put(det.deterministic_links(normalized, staging, cfg), "det-links")

        records, table = prob.fuzzy_profiles(normalized, links.df, staging, cfg)
        # Pairs for review grow with the square of a name's records; only the queue itself makes them.
        auto = staging.put(prob.score_profiles(table.df, tuple(sources), staging, cfg, cfg.auto_threshold), "scored").df
        members = prob.profile_members(records, table, staging)

        linked = staging.put(prob.best_records(auto, members.df), "auto-linked").df
        edges = (
            links.df.select("node", "root")
            .unionByName(linked.select("node", F.col("rep").alias("root")))
            .unionByName(auto.select(F.col("rep_l").alias("node"), F.col("rep_r").alias("root")))
        )
        roots = connected_components(edges, staging, cfg)
        components = component_map(names, roots.df)
        attribution = xw.method_attribution(links.df, linked)
        crosswalk = staging.put(xw.build_crosswalk(components, attribution, run_ts), "crosswalk")

        def review_queue() -> DataFrame:
            scored = prob.scored_records(table, members, tuple(sources), staging.part("review-queue"), cfg,
                                         band=lambda pairs: prob.review_pairs(pairs, cfg))
            return xw.build_review_queue(scored, run_ts)

        def stats() -> DataFrame:
            return xw.run_stats(crosswalk.df, prob.count_review_pairs(table.df, tuple(sources), staging.part("stats"), cfg))

        gold_rows = crosswalk.df
        if cfg.hold_review:
            review = prob.review_pairs(prob.score_profiles(table.df, tuple(sources), staging, cfg), cfg)
            waiting = staging.put(prob.best_records(review, members.df), "waiting").df
            gold_rows = xw.held_back(gold_rows, with_names(waiting.select("node"), names, {"node": tuple(KEYS)}))
        return Resolution(
            dim_customer=survivorship(normalized, gold_rows, run_ts, cfg),
            crosswalk=crosswalk.df,
            make_stats=stats,
            normalized=normalized,
            names=names,
            det_links=links.df,
            components=components,
            attribution=attribution,
            scored=auto,
            members=members.df,
            make_review_queue=review_queue,
            staging=staging,
        )


def _now() -> datetime:
    return datetime.now(timezone.utc)
