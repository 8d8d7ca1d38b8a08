"""Operators against brute force, on small record sets with many collisions and with one hot third."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date

import brute
import pytest
from fixtures import normalized, random_records
from pyspark.sql import Row
from pyspark.sql import functions as F

from kithline.config import DEFAULT
from kithline.functions.similarity import jaro_winkler_bound, letter_counts, shared_letters
from kithline.operators.components import assign_ids, connected_components
from kithline.operators.deterministic import deterministic_links, deterministic_match
from kithline.operators.probabilistic import _alike_pairs, block_records, block_sizes, probabilistic_match, profiles, score_profiles
from kithline.operators.numbering import number_records, record_names
from kithline.operators.sieve import Sieve, seen_twice
from kithline.operators.skew import tile_size, tiled_join
from kithline.plans.staging import Staging

SYSTEMS = ("t24", "sfdc", "amplitude")
# Every key with more than four pairs is cut into tiles; with no broadcast, the list of cut keys is shuffled too.
TINY = replace(DEFAULT, tile_pairs=4)
SHUFFLED = replace(TINY, broadcast_keys=0)
CASES = [(1, True, DEFAULT), (1, True, TINY), (2, True, TINY), (3, False, TINY)]


@pytest.fixture(autouse=True)
def one_job_per_query(spark):
    """Many tiny queries run faster without a job per stage; the query tests keep adaptive execution on."""
    spark.conf.set("spark.sql.adaptive.enabled", False)
    yield
    spark.conf.set("spark.sql.adaptive.enabled", True)


def pair_map(df, *columns):
    return {((r.left_source, r.left_id), (r.right_source, r.right_id)): tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("seed, hot, cfg, cross", [*[(*case, False) for case in CASES], (1, True, TINY, True)])
def test_deterministic_pairs_and_links(spark, seed, hot, cfg, cross):
    cfg = replace(cfg, cross_source_only=cross)
    records = random_records(seed, 120, hot)
    records.append(dict(records[0]))  # the same record twice makes no pair
    df = normalized(spark, records)
    expected = brute.deterministic(records, cfg.rules, cross)
    rows = deterministic_match(df, Staging(spark), cfg).collect()
    assert len(rows) == len(expected)
    assert {((r.left_source, r.left_id), (r.right_source, r.right_id)): (r.rule_id, r.confidence) for r in rows} == expected

    numbered, staging = number_records(df, Staging(spark)), Staging(spark)
    names = {r.record_no: (r.source_system, r.source_id) for r in record_names(numbered).collect()}
    assert [names[k] for k in sorted(names)] == sorted(set(names.values())) == sorted({brute.key(r) for r in records})
    links = [Row(node=names[r.node], root=names[r.root], confidence=r.confidence) for r in deterministic_links(numbered, staging, cfg).collect()]
    assert {tuple(r.node) for r in links} == {n for pair in expected for n in pair}
    nodes = {brute.key(r) for r in records}
    assert brute.components(nodes, [(tuple(r.node), tuple(r.root)) for r in links]) == brute.components(nodes, expected)
    best = {}
    for pair, (_, confidence) in expected.items():
        for node in pair:
            best[node] = max(best.get(node, 0), confidence)
    got = {}
    for r in links:
        got[tuple(r.node)] = max(got.get(tuple(r.node), 0), r.confidence)
    assert got == best


@pytest.mark.parametrize("seed, hot, cfg, floor", [
    *[(*case, None) for case in CASES], (2, True, TINY, 0.45), (3, False, TINY, 0.3), (2, True, TINY, 0.0)])
def test_probabilistic_pairs(spark, seed, hot, cfg, floor):
    records = random_records(seed, 120, hot)
    df, staging = normalized(spark, records), Staging(spark)
    det = brute.deterministic(records, cfg.rules)
    expected = brute.probabilistic(records, {n for p in det for n in p}, cfg, cfg.review_threshold if floor is None else floor)
    pairs = probabilistic_match(df, deterministic_match(df, staging, cfg), SYSTEMS, staging, cfg, floor)
    rows = pairs.collect()
    got = {((r.left_source, r.left_id), (r.right_source, r.right_id)): r.confidence for r in rows}
    assert len(rows) == len(got)
    assert got == pytest.approx(expected) and got.keys() == expected.keys()


def test_pairs_that_agree_on_name_and_domain_alone_are_scored_once(spark):
    """No confidence is rounded, and no name or phone compared, for each of those pairs."""
    rows = [{"source_system": s, "source_id": f"{s}{k}", "name_english": "ann lee", "email": f"{s}{k}@x.y", "dob": None if k == 3 else dob,
             "phone_e164": phone} for s, dob in (("t24", date(1970, 1, 1)), ("sfdc", date(1970, 1, 1 + 30)), ("amplitude", date(1990, 1, 1)))
            for k, phone in enumerate(("+971501234567", "+971521234567", "+971509999999", None))]
    numbered = normalized(spark, rows).withColumn("record_no", F.monotonically_increasing_id())
    table = profiles(block_records(numbered))
    pairs = _alike_pairs(table, SYSTEMS, Staging(spark), DEFAULT, DEFAULT.review_threshold)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan and "phone_score" in plan
    got = {(r.id_l, r.id_r) for r in pairs.collect()}
    near = lambda a, b: a and b and abs((a - b).days) <= DEFAULT.dob_tolerance_days
    tail = lambda a, b: a and b and a[-6:] == b[-6:]
    want = {(a["source_id"], b["source_id"]) for a in rows for b in rows if a["source_system"] < b["source_system"]
            and not near(a["dob"], b["dob"]) and not tail(a["phone_e164"], b["phone_e164"])}
    assert got == want and want
    assert {tuple(r[c] for c in ("jw_name", "dob_score", "phone_score", "email_domain_score", "confidence")) for r in pairs.collect()} == {(1.0, 0.0, 0.0, 1.0, 0.5)}


def test_pairs_of_whole_blocks_are_dealt_over_tasks(spark):
    """Small tables make many pairs: tasks follow from the pairs, and name scores are rounded behind the confidence."""
    staging, cfg = Staging(spark), replace(TINY, tile_pairs=1_000_000)
    table = profiles(block_records(number_records(normalized(spark, random_records(3, 120)), staging), cfg))
    table = staging.put(table, "profiles").df
    whole = score_profiles(table, SYSTEMS, staging, cfg, 0.0)
    dealt = score_profiles(table, SYSTEMS, staging, replace(cfg, task_pairs=20, name_scale=2), 0.0)
    n = whole.count()
    assert n > 400 and dealt.rdd.getNumPartitions() >= n / 20 > whole.rdd.getNumPartitions()
    kept = [c for c in whole.columns if c != "jw_name"]
    assert sorted(map(tuple, dealt.select(*kept, "jw_name").collect())) == sorted(
        map(tuple, whole.select(*kept, F.round("jw_name", 2)).collect()))


@pytest.mark.parametrize("options", [
    {"block_null_names": True}, {"confidence_scale": 3, "dob_tolerance_days": 7},
    {"weight_name": 0.2, "weight_dob": 0.5, "dob_tolerance_days": 0}, {"weight_email_domain": 0.3, "weight_dob": 0.1},
    {"block_null_names": True, "weight_name": 0.2, "weight_dob": 0.1, "weight_phone": 0.1, "weight_email_domain": 0.6},
    {"block_null_names": True, "weight_name": 0.3, "weight_dob": 0.1, "weight_phone": 0.1, "weight_email_domain": 0.5,
     "review_threshold": 0.55},
    {"block_null_names": True, "weight_name": 0.1, "weight_dob": 0.6, "weight_phone": 0.2, "weight_email_domain": 0.1},
], ids=str)
def test_probabilistic_options(spark, options):
    cfg = replace(TINY, **options)
    records = random_records(4, 150)
    df, staging = normalized(spark, records), Staging(spark)
    det = brute.deterministic(records, cfg.rules)
    expected = brute.probabilistic(records, {n for p in det for n in p}, cfg, cfg.review_threshold)
    got = pair_map(probabilistic_match(df, deterministic_match(df, staging, cfg), SYSTEMS, staging, cfg), "confidence")
    assert {p: c for p, (c,) in got.items()} == pytest.approx(expected) and expected


def test_block_sizes_count_the_pairs_they_stand_for(spark):
    records = random_records(6, 100)
    sizes = block_sizes(normalized(spark, records)).agg(F.sum("candidate_pairs")).first()[0]
    assert sizes == len(brute.probabilistic(records, set(), DEFAULT, -1.0))


@pytest.mark.parametrize("shape, cfg", [("chain", DEFAULT), ("mixed", DEFAULT), ("none", DEFAULT), ("ring", TINY),
                                        ("star", TINY), ("two", TINY), ("mixed", TINY)])
def test_components(spark, shape, cfg):
    n = 40
    edges = {
        "chain": [(i, i + 1) for i in range(n)], "ring": [(i, (i + 1) % n) for i in range(n)],
        "star": [(n, i) for i in range(n)], "two": [(i, i + 2) for i in range(n)],
        "mixed": [(i * 7 % 41, i * 11 % 41) for i in range(n)] + [(50, 51), (51, 52), (60, 60)], "none": [],
    }[shape]
    nodes = sorted({x for e in edges for x in e} | {99})
    key = lambda i: ("s", f"{i * 37 % 101:03d}")
    number = {key(i): i * 37 % 101 for i in range(n + 100)}
    back = {v: k for k, v in number.items()}
    df = spark.createDataFrame([(number[key(a)], number[key(b)]) for a, b in edges], "node long, root long")
    rows = connected_components(df, Staging(spark), cfg).df.collect()
    got = {back[r.node]: back[r.root] for r in rows}
    expected = brute.components([key(i) for i in nodes], [(key(a), key(b)) for a, b in edges])
    assert got == {n: r for n, r in expected.items() if n != r} and len(rows) == len(got)


def test_component_rounds_are_bounded_by_an_error(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(30)], "node long, root long")
    with pytest.raises(RuntimeError, match="did not settle"):
        connected_components(df, Staging(spark), replace(DEFAULT, max_rounds=1))


def test_assign_ids_ignores_unknown_records(spark):
    records = random_records(7, 5)
    a, b = brute.key(records[0]), brute.key(records[1])
    pairs = spark.createDataFrame([(*a, *b), (*a, "t24", "ghost"), ("t24", "ghost", *brute.key(records[2]))],
                                  "left_source string, left_id string, right_source string, right_id string")
    rows = assign_ids(normalized(spark, records), pairs, Staging(spark)).collect()
    expected = brute.components([brute.key(r) for r in records], [(a, b)])
    assert {(r.source_system, r.source_id): r.mal_customer_id for r in rows} == {
        n: brute.customer_id(root) for n, root in expected.items()}


@pytest.mark.parametrize("sieve", [Sieve(), Sieve(per_key=1, least_slots=64, most_slots=64), Sieve(most_words=0)])
def test_the_sieve_keeps_every_shared_key(spark, sieve):
    rows = spark.range(2000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % 1500) END AS k", "id AS x")
    kept = {r.x for r in seen_twice(rows, ["k"], 2000, Staging(spark), sieve).collect()}
    shared = {r.x for r in rows.join(rows.groupBy("k").count().where("count > 1"), "k").collect()}
    assert shared <= kept
    if sieve == Sieve():
        assert len(kept) < len(shared) + 400


def test_numbers_keep_the_order_whatever_the_partitions(spark):
    rows = spark.range(3000).selectExpr("concat('s', id % 3) AS source_system", "CAST(id % 1700 * 7919 % 1700 AS STRING) AS source_id", "id AS x")
    for parts in (1, 7, 200):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = number_records(rows.repartition(5), Staging(spark)).collect()
        keys = sorted((r.source_system, r.source_id) for r in got)
        assert len(got) == 3000 and all(r.record_no == keys.index((r.source_system, r.source_id)) for r in got[:200])
        assert [k for _, k in sorted({(r.record_no, (r.source_system, r.source_id)) for r in got})] == sorted(set(keys))
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("cfg", [DEFAULT, TINY, SHUFFLED])
def test_tiled_join_equals_a_plain_join(spark, cfg):
    rows = spark.range(200).selectExpr("CASE WHEN id % 3 = 0 THEN 0 WHEN id % 10 = 1 THEN NULL ELSE id % 17 END AS k", "id AS x")
    other = rows.selectExpr("k", "x AS z").where("z % 2 = 0")
    got = sorted(map(tuple, tiled_join(rows, other, ["k"], "x", "z", cfg, Staging(spark)).select("k", "x", "z").collect()))
    assert got == sorted(map(tuple, rows.join(other, "k").select("k", "x", "z").collect()))


@pytest.mark.parametrize("broadcast_keys", [0, 1000])
def test_copies_of_tiles_do_not_grow_with_the_pairs(spark, broadcast_keys):
    cfg = replace(TINY, most_tiles=16, broadcast_keys=broadcast_keys)
    rows = spark.range(1200).selectExpr("id % 3 AS k", "id AS x")
    other = spark.range(600).selectExpr("id % 3 AS k", "id AS z")
    joined = tiled_join(rows, other, ["k"], "x", "z", cfg, Staging(spark))
    assert joined.count() == 3 * 400 * 200
    # 16 tiles over three keys: a row is copied to a few of them, not to one for every two rows that it meets.
    copies = 1200 * -(-200 // int(tile_size(3 * 400 * 200, cfg) ** 0.5))
    assert tile_size(60, TINY) == 4 and copies < 4 * 1200
    assert joined.select("x", "z").distinct().count() == 3 * 400 * 200


def test_letter_counts_bound_the_matches(spark):
    rng = random.Random(13)
    letters = "aaabcdeeenorstzé漢 _09"
    names = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 24))) for _ in range(160)] + ["aaaaaaaa", "aaaaaaaaaaaa", "é" * 9]
    names += [n[::-1] for n in names[:40]] + [n[1:] + n[0] for n in names[40:80]]
    frame = spark.createDataFrame([(a, b) for a in names for b in rng.sample(names, 30)], "a string, b string")
    a, b = F.col("a"), F.col("b")
    plain, sharp = jaro_winkler_bound(a, b), jaro_winkler_bound(a, b, shared_letters(letter_counts(a), letter_counts(b)))
    rows = frame.select("a", "b", plain.alias("plain"), sharp.alias("sharp")).collect()
    for r in rows:
        assert brute.jaro_winkler(r.a, r.b) <= r.sharp + 1e-9 and r.sharp <= r.plain + 1e-9
    # What is left to the exact score at 0.8: far fewer than by lengths and prefix.
    assert 2 * sum(r.sharp >= 0.8 for r in rows) < sum(r.plain >= 0.8 for r in rows)
