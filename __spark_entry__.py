
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from kithline import LinkageConfig, Resolution, Resolver  # noqa: E402
from kithline import functions as fn  # noqa: E402
from kithline.config import DEFAULT  # noqa: E402
from kithline.operators import crosswalk as xw  # noqa: E402
from kithline.operators import deterministic as det  # noqa: E402
from kithline.operators import golden_state as states  # noqa: E402
from kithline.operators import probabilistic as prob  # noqa: E402
from kithline.operators import survivorship as gold  # noqa: E402
from kithline.operators.normalize import normalize, normalize_source  # noqa: E402
from kithline.operators.numbering import KEYS, number_records, record_names, with_names  # noqa: E402
from kithline.plans.staging import Staging  # noqa: E402
from kithline.sources.derived import derived_sources, name_forms, phone_forms  # noqa: E402
from kithline.sources.readers import (  # noqa: E402
    SILVER_TABLES, empty_source, read_parquet, read_sectioned_json, read_sectioned_lines, read_tables)
from kithline.sources.sinks import GOLD_TABLES, publish, published, write_files, write_sectioned, write_tables  # noqa: E402
from oracle_queries import oracle_sql as _oracle_sql  # noqa: E402

try:  # the subpackage for training text, with the pipeline on top of it, may be absent
    from corpus_pipeline import ORACLE_SQL as _PIPELINE_SQL
    from corpus_pipeline import run as _pipeline
    from kithline.llm.oracle import oracle_sql as _llm_sql
    from kithline.llm.queries import queries as _llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "kithline.llm"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = _llm_queries() | {"pipeline": _pipeline}
    LLM_SQL = _llm_sql() | ({"pipeline": _PIPELINE_SQL} if _PIPELINE_SQL else {})

RUN_TS = datetime(2025, 1, 1, tzinfo=timezone.utc)
Query = Callable[[SparkSession, str], DataFrame]
#: Every key with more than four pairs is cut, and the list of cut keys is shuffled.
HOT = replace(DEFAULT, tile_pairs=4, broadcast_keys=0)


def _utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(derived_sources(spark, sf_dir))


def _run(spark: SparkSession, sf_dir: str, cfg: LinkageConfig = DEFAULT) -> Resolution:
    return Resolver(spark, cfg).run(derived_sources(spark, sf_dir), RUN_TS)


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    return gold.linked_records(run.normalized, run.crosswalk)


def _scored(spark: SparkSession, sf_dir: str, band: Callable[[DataFrame], DataFrame] = lambda df: df,
            cfg: LinkageConfig = DEFAULT, floor: float | None = None) -> DataFrame:
    """Record pairs of the fuzzy pass, rounded for comparison."""
    sources, staging = derived_sources(spark, sf_dir), Staging(spark)
    normalized = number_records(staging.put(normalize(sources), "normalized").df, staging)
    links = staging.put(det.deterministic_links(normalized, staging, DEFAULT), "det-links")
    records, table = prob.fuzzy_profiles(normalized, links.df, staging, cfg)
    members = prob.profile_members(records, table, staging)
    return prob.scored_records(table, members, tuple(sources), staging, replace(cfg, name_scale=6), floor, band)


def _links(spark: SparkSession, sf_dir: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """(numbered records, their exact links); with ``columns`` no others are staged."""
    normalized, staging = _normalized(spark, sf_dir), Staging(spark)
    staged = staging.put(normalized.select(*columns) if columns else normalized, "normalized")
    numbered = number_records(staged.df, staging)
    return numbered, det.deterministic_links(numbered, staging)


ROOT = ("root_source", "root_id")
LINK_COLUMNS = ("source_system", "source_id", *sorted({c for r in DEFAULT.rules for c in r.columns}))


def _unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    normalized, links = _links(spark, sf_dir)
    return det.unmatched_records(normalized, links).drop("record_no")


def _rule(rule_id: str) -> Query:
    cfg = replace(DEFAULT, rules=tuple(r for r in DEFAULT.rules if r.rule_id == rule_id))
    return lambda spark, sf_dir: det.deterministic_match(_normalized(spark, sf_dir), Staging(spark), cfg)


def _source(name: str) -> Query:
    return lambda spark, sf_dir: normalize_source(name, derived_sources(spark, sf_dir)[name])


def _raw_columns(column: str, **raw: tuple[str, str]) -> Query:
    """(source_system, source_id, column) of the raw tables; ``raw`` gives id column and raw column per system."""
    def query(spark: SparkSession, sf_dir: str, clean: Callable) -> DataFrame:
        sources, parts = derived_sources(spark, sf_dir), []
        for system, (record_id, name) in raw.items():
            parts.append(sources[system].select(
                F.lit(system).alias("source_system"), F.col(record_id).alias("source_id"),
                clean(F.col(name)).alias(column)))
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result
    return query


PHONES = _raw_columns("phone_e164", t24=("customer_id", "mobile"), sfdc=("contact_id", "phone"))
EMAILS = _raw_columns("email", t24=("customer_id", "email"), sfdc=("contact_id", "email"), amplitude=("user_id", "email"))


def _eids(spark: SparkSession, sf_dir: str, clean: Callable, column: str = "emirates_id") -> DataFrame:
    t24 = derived_sources(spark, sf_dir)["t24"]
    return t24.select(F.col("customer_id").alias("source_id"), clean(F.col("emirates_id")).alias(column))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = derived_sources(spark, sf_dir)
    names = sources["t24"].select(F.lit("t24").alias("source_system"), F.col("customer_id").alias("source_id"), "name_english").unionByName(
        sources["sfdc"].select(F.lit("sfdc").alias("source_system"), F.col("contact_id").alias("source_id"),
                               F.concat_ws(" ", "first_name", "last_name").alias("name_english")))
    return names.withColumn("name_english", fn.normalize_name(F.col("name_english"))).withColumn("block_key", fn.block_key(F.col("name_english")))


def _neighbours(spark: SparkSession, sf_dir: str, **columns) -> DataFrame:
    """Signals of linear pairings that every record enters: records of a customer number with each other (contacts,
    duplicates, app users), and records with those 25 numbers further on."""
    rows = _normalized(spark, sf_dir).withColumn("number", F.regexp_extract("source_id", "[0-9]+", 0).cast("long"))

    def side(suffix: str, step: int) -> DataFrame:
        kept = ("source_system", "source_id", "emirates_id", "name_english", "dob", "phone_e164", "email")
        return rows.selectExpr(f"number + {step} AS pairing", *[f"{c} AS {c}_{suffix}" for c in kept])

    order = F.struct("source_system_l", "source_id_l") < F.struct("source_system_r", "source_id_r")
    pairs = side("l", 0).join(side("r", 0), "pairing").where(order).unionByName(side("l", 25).join(side("r", 0), "pairing"))
    return pairs.select(
        F.col("source_system_l").alias("left_source"), F.col("source_id_l").alias("left_id"),
        F.col("source_system_r").alias("right_source"), F.col("source_id_r").alias("right_id"),
        *[expression.alias(name) for name, expression in columns.items()])


def _signals() -> dict[str, Column]:
    name, dob, phone, email = ((F.col(f"{c}_l"), F.col(f"{c}_r")) for c in ("name_english", "dob", "phone_e164", "email"))
    return {
        "jw_name": fn.jaro_winkler(*name), "dob_score": fn.dob_score(*dob), "phone_score": fn.phone_score(*phone),
        "email_domain_score": fn.domain_score(fn.email_domain(email[0]), fn.email_domain(email[1])),
    }


def _signal(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _neighbours(spark, sf_dir, **{name: F.round(_signals()[name], 6)})
    return query


def _confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _neighbours(spark, sf_dir, confidence=fn.confidence(*_signals().values()))


def _sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both SQL functions over all raw core-banking rows; account numbers stand in for ids of another shape."""
    fn.register_functions(spark)
    return derived_sources(spark, sf_dir)["t24"].selectExpr(
        "customer_id AS source_id",
        "round(fn_jaro_winkler(lower(name_english), split_part(email, '@', 1)), 6) AS jw",
        "fn_validate_eid_checksum(emirates_id) AS eid_ok",
        "fn_validate_eid_checksum(replace(emirates_id, '784', '')) AS short_ok",
    )


def _staged_sinks(kind: str, result: str) -> Query:
    """A result of a whole run, written by the sink and read back."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        run = _run(spark, sf_dir)
        frame = run.review_queue if result == "review_queue" else getattr(run, result)
        folder = f"{run.staging.folder}/export"
        write_files({result: frame}, folder, kind)
        return spark.read.schema(frame.schema).format(kind).load(f"{folder}/{result}")
    return query


def _sectioned_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derived sources as sectioned JSON documents, one per hundred customer numbers, read back and unified."""
    staging = Staging(spark)
    sources = derived_sources(spark, sf_dir)
    ids = {"t24": "customer_id", "sfdc": "contact_id", "amplitude": "user_id"}
    parts = []
    for name, df in sources.items():
        number = F.regexp_extract(ids[name], "[0-9]+", 0).cast("long")
        rows = df.groupBy(F.floor(number / 100).alias("part")).agg(F.collect_list(F.struct("*")).alias(name))
        parts.append(rows)
    documents = parts[0]
    for part in parts[1:]:
        documents = documents.join(part, "part", "full")
    path = f"{staging.folder}/sections"
    documents.drop("part").write.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(path)
    return normalize(read_sectioned_json(spark, path, lines=True))


def _dim_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden records from states: of two thirds of the records first, kept, and refreshed by the rest."""
    run = _run(spark, sf_dir)
    linked = gold.linked_records(run.normalized, run.crosswalk)
    late = F.pmod(F.xxhash64("source_system", "source_id"), F.lit(3)) == 0
    kept = run.staging.put(states.golden_states(linked.where(~late)), "states").df
    moved = spark.createDataFrame([], "old_id string, new_id string")
    fresh, gone = states.refresh_states(kept, states.golden_states(linked.where(late)), moved)
    fresh = run.staging.put(fresh, "refreshed").df
    untouched = kept.join(fresh.select(gold.GROUP).unionByName(gone), gold.GROUP, "left_anti")
    return states.golden_records(untouched.unionByName(fresh), RUN_TS)


def _catalog(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A run from catalog tables to catalog tables, in a database below the staging folder."""
    folder = Staging(spark).folder
    database = "kithline_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    for system, df in derived_sources(spark, sf_dir).items():
        df.write.saveAsTable(f"{database}.{system}")
    run = Resolver(spark).run(read_tables(spark, {s: f"{database}.{s}" for s in SILVER_TABLES}), RUN_TS)
    write_tables(run.results(), {r: f"{database}.gold_{r}" for r in GOLD_TABLES})
    return spark.table(f"{database}.gold_{name}")


def _export_texts(results: dict[str, DataFrame]) -> DataFrame:
    """(section, a, b, c, d, e): columns of all four results as text, for one comparison."""
    day = F.date_format(F.lit(RUN_TS), "yyyy-MM-dd")
    picked = {
        "crosswalk": ("source_system", "source_id", "mal_customer_id", "match_method", F.date_format("resolved_at", "yyyy-MM-dd")),
        "review_queue": ("left_source", "left_id", "right_source", "right_id", F.date_format("queued_at", "yyyy-MM-dd")),
        "dim_customer": ("mal_customer_id", "name_english", "name_arabic", "email", F.date_format("dob", "yyyy-MM-dd")),
        "stats": ("deterministic", "probabilistic_auto", "review_queue", "new_customer", "total"),
    }
    parts = [results[name].select(F.lit(name).alias("section"), *[
        (F.col(c) if isinstance(c, str) else c).cast("string").alias(a) for a, c in zip("abcde", columns)]) for name, columns in picked.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _exported(write_and_read: Callable[[SparkSession, Resolution], dict[str, DataFrame]]) -> Query:
    """All four results of a run, written by a sink and read back."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        run = _run(spark, sf_dir)
        return _export_texts(write_and_read(spark, run))
    return query


def _json_folders(spark: SparkSession, run: Resolution) -> dict[str, DataFrame]:
    folder, results = f"{run.staging.folder}/json", run.results()
    write_files(results, folder, "json")
    return {name: spark.read.schema(df.schema).json(f"{folder}/{name}") for name, df in results.items()}


def _published(spark: SparkSession, run: Resolution) -> dict[str, DataFrame]:
    publish(spark, run.results(), f"{run.staging.folder}/gold")
    return published(spark, f"{run.staging.folder}/gold")


def _sectioned_export(spark: SparkSession, run: Resolution) -> dict[str, DataFrame]:
    folder, results = f"{run.staging.folder}/document", run.results()
    write_sectioned(results, folder, run.staging)
    return read_sectioned_lines(spark, folder, {name: df.schema for name, df in results.items()})


def _sectioned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derived sources as one JSON document, read back in byte ranges and unified."""
    staging = Staging(spark)
    write_sectioned(derived_sources(spark, sf_dir), f"{staging.folder}/document", staging)
    return normalize(read_sectioned_lines(spark, f"{staging.folder}/document"))


def _empty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's input in which one source has no rows."""
    return normalize({**derived_sources(spark, sf_dir), "amplitude": empty_source(spark, "amplitude")})


def _parquet_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Staging(spark).folder
    write_files(derived_sources(spark, sf_dir), folder)
    return normalize(read_parquet(spark, {name: f"{folder}/{name}" for name in derived_sources(spark, sf_dir)}))


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered, links = _links(spark, sf_dir, *LINK_COLUMNS)
    return with_names(links.select("node").distinct(), record_names(numbered), {"node": tuple(KEYS)})


def _det_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered, links = _links(spark, sf_dir, *LINK_COLUMNS)
    return with_names(links.select("node", "root", "rule_id"), record_names(numbered), {"node": tuple(KEYS), "root": ROOT})


def _components(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    return with_names(run.components.select(*KEYS, "root"), run.names, {"root": ROOT})


def _attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    return with_names(run.attribution, run.names, {"node": tuple(KEYS)}).select(*KEYS, "match_method", "confidence")


def _fallback_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).groupBy(gold.GROUP).agg(gold.english_name().alias("name_english"))


def entry(spark: SparkSession) -> DataFrame:
    """Golden customer records of the smallest data set."""
    _utc(spark)
    return _run(spark, "/root/testdata/sf0.001").dim_customer


def queries() -> dict[str, Query]:
    """One entry per operator; SURVEY ids in comments."""
    table: dict[str, Query] = {
        "normalize_t24": _source("t24"),                                                    # PRJ1 FLT1 SC1-SC5
        "normalize_sfdc": _source("sfdc"),                                                  # PRJ2 FLT2 SC15
        "normalize_amplitude": _source("amplitude"),                                        # PRJ3 FLT3
        "union_sources": _normalized,                                                       # PRJ4 UN1
        "eid_raw": lambda s, d: _eids(s, d, fn.raw_text, "emirates_id_raw"),  # PRJ5
        "phone_clean": lambda s, d: PHONES(s, d, fn.normalize_phone),                       # SC1
        "phone_strict": lambda s, d: PHONES(s, d, lambda c: fn.normalize_phone(c, True)),   # SC2
        "email_clean": lambda s, d: EMAILS(s, d, fn.normalize_email),                       # SC3
        "name_clean": _names,                                                               # SC4 SC12
        "eid_valid": lambda s, d: _eids(s, d, fn.validate_emirates_id),                     # SC5
        "eid_strict": lambda s, d: _eids(s, d, lambda c: fn.validate_emirates_id(c, True)),  # SC6
        "jw_scores": _signal("jw_name"),                                                    # SC7
        "dob_score": _signal("dob_score"),                                                  # SC8
        "phone_score": _signal("phone_score"),                                              # SC9
        "domain_score": _signal("email_domain_score"),                                      # SC10
        "weighted_confidence": _confidence,                                                 # SC11
        "sql_functions": _sql_functions,                                                    # UD2
        "det_d1": _rule("D1"), "det_d2": _rule("D2"), "det_d3": _rule("D3"),                # JN1 JN2 JN3 FLT5
        "det_best": lambda s, d: det.deterministic_match(_normalized(s, d), Staging(s)),                # CO1 UN2 AG1
        "det_links": _det_links,                                                            # linear form of CO1
        "matched": _matched,                                                                # AG2 UN3
        "unmatched": _unmatched,                                                            # JN4
        "block_candidates": lambda s, d: prob.block_sizes(_unmatched(s, d)),                # JN5 as counts
        "prob_scored": _scored,                                                             # CO2 JN5 FLT6 SC7-SC11
        "prob_auto": lambda s, d: _scored(s, d, prob.auto_pairs),                           # FLT7
        "prob_review": lambda s, d: _scored(s, d, prob.review_pairs),                       # FLT8 FLT9
        "components": _components,                                                          # GR1 AG3 AG12 UN4
        "customer_ids": lambda s, d: _run(s, d).components.select(*KEYS, "mal_customer_id"),  # GR2 SC13 SC14
        "method_attribution": _attribution,  # AG4
        "crosswalk": lambda s, d: _run(s, d).crosswalk,                                     # CO4 JN6 JN10
        "review_queue": lambda s, d: _run(s, d).review_queue,                               # CO5
        "linked_rows": _linked,                                                             # JN11
        "t24_pick": lambda s, d: gold.t24_pick(_linked(s, d)),                              # AG5 FLT11
        "fallback_name": _fallback_name,                                                    # AG6
        "latest_contact_row": lambda s, d: gold.latest_contact_row(_linked(s, d)),          # WN1 TK1 FLT10
        "first_value_contact": lambda s, d: gold.first_value_contact(_linked(s, d)),        # WN2
        "latest_contact_attr": lambda s, d: gold.latest_contact_attributes(_linked(s, d)),  # WN3
        "segment_tier": lambda s, d: gold.segment_pick(_linked(s, d)),                      # AG7
        "lifetime": lambda s, d: gold.lifetime(_linked(s, d)),                              # AG8 SO2
        "dim_customer": lambda s, d: _run(s, d).dim_customer,                               # CO6 CO7
        "dim_customer_row_contact": lambda s, d: _run(s, d, replace(DEFAULT, contact_mode="row")).dim_customer,
        "dim_customer_hold_review": lambda s, d: _run(s, d, replace(DEFAULT, hold_review=True)).dim_customer,
        "dim_customer_merged": _dim_merged,                                                 # CO6 by kept states
        "stats_by_method": lambda s, d: xw.stats_by_method(_run(s, d).crosswalk).orderBy("match_method"),  # AG9 SO1
        "pending_count": lambda s, d: xw.pending_count(_run(s, d).review_queue),            # AG10
        "golden_count": lambda s, d: _run(s, d).dim_customer.agg(
            F.count(F.lit(1)).alias("golden_customer_count")),                              # AG11
        "run_stats": lambda s, d: _run(s, d).stats,                                         # CO8
        "parquet_sources": _parquet_sources,                                                # SRC1
        "sectioned_json": _sectioned_json,                                                  # SRC2
        "empty_source": _empty_source,                                                      # SRC3
        "sink_crosswalk": _staged_sinks("parquet", "crosswalk"),                            # SNK1
        "sink_review_queue": _staged_sinks("parquet", "review_queue"),                      # SNK2
        "sink_dim_customer": _staged_sinks("parquet", "dim_customer"),                      # SNK3
        "json_export": _staged_sinks("json", "dim_customer"),                               # SNK4, one result in full
        "json_export_all": _exported(_json_folders),                                        # SNK4
        "published_results": _exported(_published),                                         # SNK1-SNK3 as a unit
        "sectioned_export": _exported(_sectioned_export),                                   # SNK4, one document in parts
        "sectioned_lines": _sectioned_lines,                                                # SRC2 by byte ranges
        "catalog_crosswalk": lambda s, d: _catalog(s, d, "crosswalk"),                      # SRC1 SNK1
        "catalog_dim_customer": lambda s, d: _catalog(s, d, "dim_customer"),                # SRC1 SNK3
        "name_forms": lambda s, d: name_forms(s, d).withColumn("name_english", fn.normalize_name(F.col("raw"))).drop("raw"),  # SC4
        "phone_forms": lambda s, d: phone_forms(s, d).withColumn("phone_e164", fn.normalize_phone(F.col("raw"))).drop("raw"),  # SC1
        # The same results with tiny bounds, so that hot keys are cut and moved in the ways large tables need.
        "det_best_tiled": lambda s, d: det.deterministic_match(_normalized(s, d), Staging(s), HOT),
        "prob_scored_tiled": lambda s, d: _scored(s, d, cfg=HOT),
        "review_queue_tiled": lambda s, d: _run(s, d, HOT).review_queue,
        "dim_customer_tiled": lambda s, d: _run(s, d, HOT).dim_customer,
        # A lower floor than any later step looks at: the whole block is compared.
        "prob_scored_all": lambda s, d: _scored(s, d, floor=0.3),
        "prob_scored_every": lambda s, d: _scored(s, d, floor=0.0),
    }

    table |= LLM_QUERIES

    def in_utc(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _utc(spark)
            return query(spark, sf_dir)
        return run

    return {name: in_utc(query) for name, query in table.items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query that SQL can express."""
    return _oracle_sql() | LLM_SQL
