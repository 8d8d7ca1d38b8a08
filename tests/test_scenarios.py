"""The documented scenarios, end to end or by operator."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timezone

import brute
import pytest
from fixtures import frame, random_records
from pyspark.sql import functions as F

from kithline import LinkageConfig, Resolver
from kithline.config import DEFAULT
from kithline.operators import crosswalk as xw
from kithline.operators import golden_state as states
from kithline.operators import survivorship as gold
from kithline.operators.deterministic import deterministic_match
from kithline.operators.normalize import normalize, normalize_source
from kithline.operators.probabilistic import auto_pairs, probabilistic_match, review_pairs
from kithline.plans.staging import Staging
from kithline.sources.derived import derived_sources
from kithline.sources.readers import read_parquet
from kithline.sources.adapters import ADAPTERS, Adapter
from kithline.sources.schemas import NORMALIZED

RUN_TS = datetime(2025, 1, 1, tzinfo=timezone.utc)
EID = "784-1979-3344556-7"


def t24(**values):
    return {"record_status": "ACTIVE", "kyc_status": "APPROVED", "created_at": datetime(2020, 1, 1),
            "updated_at": datetime(2024, 1, 1), **values}


def sfdc(first, last, **values):
    return {"first_name": first, "last_name": last, "is_deleted": False, "created_date": datetime(2021, 1, 1),
            "last_modified_date": datetime(2024, 6, 1), **values}


BORN = date(1990, 1, 1)
# One person (or pair of people) per scenario; names differ enough that no scenario meets another.
T24 = [
    t24(customer_id="D1a", emirates_id=EID, dob=BORN, name_english="Xavier One", mobile="0501111111"),
    t24(customer_id="D1b", emirates_id=EID.replace("-", ""), name_english="Quentin One"),
    t24(customer_id="D2", dob=date(1977, 11, 3), name_english="Greta Moreau", mobile="0529081726"),
    t24(customer_id="D3", dob=date(1969, 9, 30), name_english="Chiara Gallo", email="chiara@gallo.example"),
    t24(customer_id="NEAR", dob=date(1984, 12, 1), name_english="Dmitri van Quist", mobile="0543121212", email="dv@near.example"),
    t24(customer_id="TAIL", name_english="Odette Hruska", mobile="0567654321", email="odette@tail.example"),
    t24(customer_id="AUTO", name_english="Wilhelm Gott", mobile="0521212121", email="w@auto.com"),
    t24(customer_id="NONE", dob=date(1970, 1, 1), name_english="Hakan Ilves", mobile="0521357924", email="y@none.com"),
    t24(customer_id="WINS", dob=date(1973, 7, 7), name_english="Selma Tanaka", name_arabic="سلمى تاناكا", mobile="0558642097",
        email="selma@t24.example.com", risk_rating="HIGH", segment="priority", updated_at=datetime(2023, 1, 1)),
    t24(customer_id="SEGa", dob=date(1980, 1, 1), name_english="Keiko Renner", mobile="0541029384", segment="mass"),
    t24(customer_id="SEGb", dob=date(1980, 1, 1), name_english="Keiko Renner", mobile="0541029384", segment="priority"),
    t24(customer_id="NULL", kyc_status=None),
    t24(customer_id="ARAB", dob=date(1971, 1, 1), name_english="Ravi Sandoval", name_arabic="بافل بن يانسن"),
    t24(customer_id="CHa", emirates_id="784200176543211", dob=date(1981, 1, 1), name_english="Igor Chain"),
    t24(customer_id="CHb", emirates_id="784200176543211", dob=date(1982, 2, 2), name_english="Igor Chain", email="c@chain.com"),
    t24(customer_id="BLANK", dob=date(1983, 3, 3), name_english="Pavel Janssen", mobile="0562718281", email="k.old@blank.com"),
    t24(customer_id="GONE", emirates_id=EID, name_english="Xavier One", record_status="CLOSED"),
    t24(customer_id="GONE2", emirates_id=EID, name_english="Xavier One", record_status=None),
]
SFDC = [
    sfdc("Greta", "Moreau", contact_id="D2", dob=date(1977, 11, 3), phone="00971529081726"),
    sfdc("Chiara", "Gallo", contact_id="D3", dob=date(1969, 9, 30), email="CHIARA@Gallo.example"),
    sfdc("Dmitri", "van Quist", contact_id="NEAR", phone="+971549991212", email="dv@near.example"),
    sfdc("Odette", "Hruska", contact_id="TAIL", phone="+971569654321", email="odette.other@tail.example"),
    sfdc("Wilhelm", "Gott", contact_id="AUTO", phone="+971 52 121 2121", email="other@auto.com"),
    sfdc("Mirela", "Okafor", contact_id="NONE", dob=date(1991, 3, 9), phone="+971566420864", email="a@none.com"),
    sfdc("Zelma", "Tanaka", contact_id="WINS", dob=date(1973, 7, 7), phone="+971558642097", email="selma@sfdc.example.com"),
    sfdc("Igor", "Chain", contact_id="CH", dob=date(1982, 2, 2), email="C@chain.com"),
    sfdc("Pavel", "Janssen", contact_id="BLANK", dob=date(1983, 3, 3), phone="+971562718281", last_modified_date=datetime(2023, 1, 1)),
    sfdc("Pavel", "Janssen", contact_id="BLANK2", dob=date(1983, 3, 3), email="k.old@blank.com",
         last_modified_date=datetime(2025, 1, 1)),
    sfdc("Xavier", "One", contact_id="GONE", dob=BORN, phone="0501111111", is_deleted=True),
    sfdc("Xavier", "One", contact_id="GONE2", dob=BORN, phone="0501111111", is_deleted=None),
]
AMPLITUDE = [
    {"user_id": "A1", "email": "dv@near.example", "first_seen_at": datetime(2024, 6, 1), "last_seen_at": datetime(2025, 1, 10)},
    {"user_id": "A2", "email": None, "first_seen_at": datetime(2024, 6, 1)},
]


@pytest.fixture(scope="module")
def sources(spark):
    return {"t24": frame(spark, "t24", T24), "sfdc": frame(spark, "sfdc", SFDC), "amplitude": frame(spark, "amplitude", AMPLITUDE)}


@pytest.fixture(scope="module")
def run(spark, sources):
    return Resolver(spark).run(sources, RUN_TS)


@pytest.fixture(scope="module")
def crosswalk(run):
    rows = run.crosswalk.collect()
    found = {(r.source_system, r.source_id): r for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def golden(run):
    rows = run.dim_customer.collect()
    found = {r.mal_customer_id: r for r in rows}
    assert len(found) == len(rows)
    return found


def outcome(crosswalk, *keys):
    rows = [crosswalk[k] for k in keys]
    return len({r.mal_customer_id for r in rows}) == 1, [(r.match_method, r.confidence) for r in rows]


@pytest.mark.parametrize("keys, same, methods", [
    ([("t24", "D1a"), ("t24", "D1b")], True, [("deterministic", 1.0)] * 2),
    ([("t24", "D2"), ("sfdc", "D2")], True, [("deterministic", 0.95)] * 2),
    ([("t24", "D3"), ("sfdc", "D3")], True, [("deterministic", 0.90)] * 2),
    ([("t24", "NEAR"), ("sfdc", "NEAR")], False, [("new_customer", 0.0)] * 2),
    ([("t24", "TAIL"), ("sfdc", "TAIL")], False, [("new_customer", 0.0)] * 2),
    ([("t24", "AUTO"), ("sfdc", "AUTO")], True, [("probabilistic_auto", 0.7)] * 2),
    ([("t24", "NONE"), ("sfdc", "NONE")], False, [("new_customer", 0.0)] * 2),
    ([("t24", "CHa"), ("t24", "CHb"), ("sfdc", "CH")], True, [("deterministic", 1.0)] * 2 + [("deterministic", 0.9)]),
    ([("t24", "BLANK"), ("sfdc", "BLANK"), ("sfdc", "BLANK2")], True,
     [("deterministic", 0.95), ("deterministic", 0.95), ("deterministic", 0.9)]),
    ([("t24", "NULL")], True, [("new_customer", 0.0)]),
    ([("amplitude", "A1")], True, [("new_customer", 0.0)]),
], ids=lambda v: v[0][1] if isinstance(v, list) and len(v[0]) == 2 and v[0][0] in ADAPTERS else "")
def test_links(crosswalk, keys, same, methods):
    assert outcome(crosswalk, *keys) == (same, methods)


def test_every_active_record_once(crosswalk):
    gone = {("t24", "GONE"), ("t24", "GONE2"), ("sfdc", "GONE"), ("sfdc", "GONE2"), ("amplitude", "A2")}
    everyone = {("t24", r["customer_id"]) for r in T24} | {("sfdc", r["contact_id"]) for r in SFDC} | {
        ("amplitude", r["user_id"]) for r in AMPLITUDE}
    assert set(crosswalk) == everyone - gone


def test_customer_id_is_the_hash_of_the_smallest_record(crosswalk):
    assert crosswalk["t24", "D2"].mal_customer_id == brute.customer_id(("sfdc", "D2"))
    assert crosswalk["t24", "CHb"].mal_customer_id == brute.customer_id(("sfdc", "CH"))


def test_review_queue(run):
    rows = {(r.left_id, r.right_id): r for r in run.review_queue.collect()}
    assert {k: r.confidence for k, r in rows.items()} == {("NEAR", "NEAR"): 0.5, ("TAIL", "TAIL"): 0.64}
    assert all((r.left_source, r.right_source, r.status) == ("sfdc", "t24", "pending") for r in rows.values())


def test_golden_records(crosswalk, golden):
    wins = golden[crosswalk["t24", "WINS"].mal_customer_id]
    assert (wins.risk_rating, wins.kyc_status, wins.name_arabic) == ("HIGH", "APPROVED", "سلمى تاناكا")
    assert (wins.name_english, wins.email) == ("selma tanaka", "selma@sfdc.example.com")
    assert (wins.source_systems, wins.first_seen_at) == ("sfdc,t24", datetime(2020, 1, 1))
    assert golden[crosswalk["t24", "SEGa"].mal_customer_id].segment == "priority"
    assert golden[crosswalk["t24", "ARAB"].mal_customer_id].name_arabic == "بافل بن يانسن"
    empty = golden[crosswalk["t24", "NULL"].mal_customer_id]
    assert (empty.segment, empty.email, empty.name_english, empty.source_systems) == (None, None, None, "t24")
    blank = golden[crosswalk["t24", "BLANK"].mal_customer_id]
    assert (blank.email, blank.phone_e164) == ("k.old@blank.com", "+971562718281")
    assert set(golden) == {r.mal_customer_id for r in crosswalk.values()}


def test_stats(run, crosswalk):
    stats = run.stats.first().asDict()
    methods = [r.match_method for r in crosswalk.values()]
    expected = {m: methods.count(m) for m in ("deterministic", "probabilistic_auto", "new_customer")} | {"review_queue": 2}
    assert stats == {**expected, "total": sum(expected.values())}
    assert stats["total"] == len(crosswalk) + 2
    assert xw.run_stats(run.crosswalk, xw.pending_count(run.review_queue)).first().asDict() == stats


def test_contact_row_mode_blanks_the_phone(spark, sources, crosswalk):
    run = Resolver(spark, LinkageConfig(contact_mode="row")).run(sources, RUN_TS)
    row = run.dim_customer.where(F.col("mal_customer_id") == crosswalk["t24", "BLANK"].mal_customer_id).first()
    assert (row.email, row.phone_e164) == ("k.old@blank.com", None)


def test_hold_review_keeps_waiting_records_out(spark, sources, crosswalk, golden):
    run = Resolver(spark, LinkageConfig(hold_review=True)).run(sources, RUN_TS)
    held = {crosswalk[s, k].mal_customer_id for s in ("t24", "sfdc") for k in ("NEAR", "TAIL")}
    assert {r.mal_customer_id for r in run.dim_customer.collect()} == set(golden) - held
    assert run.crosswalk.count() == len(crosswalk)
    waiting = xw.review_records(run.review_queue)
    assert xw.held_back(run.crosswalk, waiting).count() == len(crosswalk) - 4


def test_row_filters_are_optional(spark, sources):
    assert normalize(sources, LinkageConfig(apply_filters=False)).count() == len(T24) + len(SFDC) + len(AMPLITUDE)
    no_flag = sources["sfdc"].drop("is_deleted")
    assert normalize_source("sfdc", no_flag).count() == len(SFDC)


def test_unknown_source_is_an_error(spark, sources):
    with pytest.raises(ValueError, match="unknown source system: crm"):
        normalize({"crm": sources["sfdc"]})
    with pytest.raises(ValueError):
        normalize({})


def test_record_without_id_is_an_error(spark):
    with pytest.raises(Exception, match="a record without customer_id"):
        normalize_source("t24", frame(spark, "t24", [t24(name_english="x")])).collect()


def test_fourth_system_needs_only_an_adapter(spark, sources):
    cards = spark.createDataFrame([(7, "Wilhelm Gott", "0521212121", "c@auto.com")], "card_no int, holder string, tel string, mail string")
    adapters = {**ADAPTERS, "cards": Adapter("cards", "card_no", {"name_english": "holder", "phone_e164": "tel", "email": "mail"})}
    run = Resolver(spark, adapters=adapters).run({**sources, "cards": cards}, RUN_TS)
    same = run.crosswalk.where("source_id IN ('7', 'AUTO')").select("mal_customer_id", "match_method").distinct().collect()
    assert [r.match_method for r in same] == ["probabilistic_auto"]
    assert same[0].mal_customer_id == brute.customer_id(("cards", "7"))


def test_steps_alone_give_the_run(spark, sources, run):
    """The pair tables lead to the same crosswalk as the linear path inside a run."""
    resolver = Resolver(spark)
    normalized = resolver.normalize(sources).cache()
    det = resolver.deterministic_match(normalized).cache()
    scored = resolver.probabilistic_match(normalized, det).cache()
    auto = auto_pairs(scored)
    keys = ["left_source", "left_id", "right_source", "right_id"]
    ids = resolver.assign_ids(normalized, det.select(keys).unionByName(auto.select(keys)))
    nodes = ids.withColumn("node", F.struct("source_system", "source_id"))
    walk = xw.build_crosswalk(nodes, xw.attribution_of_pairs(det, auto), RUN_TS)
    assert walk.exceptAll(run.crosswalk).isEmpty() and run.crosswalk.exceptAll(walk).isEmpty()
    queue = xw.build_review_queue(review_pairs(scored), RUN_TS)
    assert sorted(map(tuple, queue.collect())) == sorted(map(tuple, run.review_queue.collect()))
    dim = resolver.survivorship(normalized, walk, RUN_TS)
    assert dim.exceptAll(run.dim_customer).isEmpty()


def test_golden_aggregate_equals_the_join_chain(spark, run):
    """The one aggregate against a spine with left joins, one per attribute group."""
    linked = gold.linked_records(run.normalized, run.crosswalk).cache()
    t24_part = gold.t24_pick(linked).withColumnRenamed("name_english", "t24_name")
    sfdc_name = linked.where("source_system = 'sfdc'").groupBy(gold.GROUP).agg(
        gold.authoritative("name_english", "sfdc").alias("sfdc_name"))
    chain = gold.lifetime(linked)
    for part in (t24_part, sfdc_name, gold.latest_contact_attributes(linked), gold.segment_pick(linked)):
        chain = chain.join(part, gold.GROUP, "left")
    columns = [c for c in run.dim_customer.columns if c != "last_refreshed_at"]
    chain = chain.withColumn("name_english", F.coalesce("t24_name", "sfdc_name")).select(columns)
    dim = run.dim_customer.select(columns)
    assert chain.exceptAll(dim).isEmpty() and dim.exceptAll(chain).isEmpty()


def test_ties_go_to_the_smallest_record_and_missing_times_come_last(spark):
    rows = [
        ("t24", "b", "b@x.y", datetime(2024, 1, 1)), ("t24", "a", "a@x.y", datetime(2024, 1, 1)),
        ("amplitude", "z", "z@x.y", datetime(2024, 1, 1)), ("sfdc", "0", "0@x.y", None),
    ]
    df = spark.createDataFrame(rows, "source_system string, source_id string, email string, updated_at timestamp")
    df = df.withColumns({"mal_customer_id": F.lit("m"), "phone_e164": F.lit(None).cast("string")})
    assert gold.latest_contact_attributes(df).first().email == "z@x.y"
    assert gold.latest_contact_row(df).first().email == "z@x.y"
    assert gold.latest_contact_attributes(df.where("source_system = 'sfdc'")).first().email == "0@x.y"


def test_result_does_not_depend_on_order_or_partitions(spark):
    """Shuffled rows, other partitions and routes for hot keys give the same ids."""
    records = random_records(9, 150, hot=True)
    adapters = {s: Adapter(s, "source_id", {f.name: f.name for f in NORMALIZED.fields[2:]}) for s in ("t24", "sfdc", "amplitude")}
    tiny = replace(DEFAULT, tile_pairs=4, broadcast_keys=0)

    def results(order, cfg):
        tables = {}
        for system in adapters:
            rows = [tuple(r.get(f.name) for f in NORMALIZED) for r in order if r["source_system"] == system]
            tables[system] = spark.createDataFrame(rows, NORMALIZED).repartition(1 + len(rows) % 3)
        run = Resolver(spark, cfg, adapters).run(tables, RUN_TS)
        return {name: sorted(map(str, df.collect())) for name, df in run.results().items()}, run.normalized

    first, clean = results(records, DEFAULT)
    shuffled = random.Random(1).sample(records, len(records))
    assert results(shuffled, tiny)[0] == first
    records = [r.asDict() for r in clean.collect()]
    nodes = [brute.key(r) for r in records]
    det = brute.deterministic(records, DEFAULT.rules)
    fuzzy = brute.probabilistic(records, {n for p in det for n in p}, DEFAULT, DEFAULT.auto_threshold)
    roots = brute.components(nodes, [*det, *fuzzy])
    assert len(first["dim_customer"]) == len(set(roots.values()))


def test_empty_sources(spark):
    run = Resolver(spark).run({"t24": frame(spark, "t24", [])}, RUN_TS)
    assert [df.count() for df in run.results().values()] == [0, 0, 0, 1]
    assert run.stats.first().total == 0


def test_a_lost_run_goes_on(spark, tmp_path, monkeypatch):
    """A run ends after the scores were staged; the next one reads what is there, and gives the same results."""
    files = {}
    for name, df in derived_sources(spark, "/root/testdata/sf0.001").items():
        df.write.parquet(str(tmp_path / name))
        files[name] = str(tmp_path / name)
    whole = Resolver(spark, folder=str(tmp_path / "a")).run(read_parquet(spark, files), RUN_TS)
    put = Staging.put

    def lost(self, df, name):
        if name == "members":
            raise RuntimeError("driver lost")
        return put(self, df, name)
    monkeypatch.setattr(Staging, "put", lost)
    resolver = Resolver(spark, folder=str(tmp_path / "b"))
    with pytest.raises(RuntimeError, match="driver lost"):
        resolver.run(read_parquet(spark, files), RUN_TS, resume=True)
    monkeypatch.undo()
    run = resolver.run(read_parquet(spark, files), RUN_TS, resume=True)
    assert {"normalized", "numbered", "det-links", "scored"} <= set(run.staging.reused) and "members" not in run.staging.reused
    assert sorted(map(tuple, run.crosswalk.collect())) == sorted(map(tuple, whole.crosswalk.collect()))
    assert sorted(map(str, run.dim_customer.collect())) == sorted(map(str, whole.dim_customer.collect()))
    # Other settings, or other files, are another run.
    assert not Resolver(spark, replace(DEFAULT, auto_threshold=0.8), folder=str(tmp_path / "b")).run(
        read_parquet(spark, files), RUN_TS, resume=True).staging.reused
    with pytest.raises(ValueError, match="run_ts"):
        resolver.run(read_parquet(spark, files), resume=True)


@pytest.mark.parametrize("mode", ["attribute", "row"])
def test_states_of_parts_give_the_golden_records(spark, mode):
    """Ties, missing times and moved customers included."""
    cfg, rng = replace(DEFAULT, contact_mode=mode), random.Random(15)
    rows = []
    for k in range(400):
        rows.append((f"c{rng.randint(0, 40)}", rng.choice(["t24", "sfdc", "amplitude", "web"]), f"r{k}", rng.choice([None, "784"]),
                     rng.choice([None, date(1980, 1, 1 + k % 28)]), rng.choice([None, f"n{k}"]), rng.choice([None, f"a{k}"]), rng.choice([None, f"p{k}"]),
                     rng.choice([None, f"e{k}"]), rng.choice([None, "LOW", "HIGH"]), rng.choice([None, "mass", "private", "x"]), rng.choice([None, "OK"]),
                     rng.choice([None, datetime(2020, 1, 1 + k % 3)]), rng.choice([None, datetime(2021, 1, 1 + k % 3)])))
    columns = [gold.GROUP, *NORMALIZED.names]
    linked = spark.createDataFrame(rows, ", ".join(
        f"{n} {'string' if n == gold.GROUP else NORMALIZED[n].dataType.simpleString()}" for n in columns))
    # Customers c30 and up were joined with those 30 below, after the first part was kept.
    number = F.substring(gold.GROUP, 2, 9).cast("int")
    joined = linked.withColumn(gold.GROUP, F.when(number >= 30, F.concat(F.lit("c"), number - 30)).otherwise(F.col(gold.GROUP)))
    late = F.pmod(F.xxhash64("source_id"), F.lit(4)) == 0
    moved = linked.select(F.col(gold.GROUP).alias("old_id"), F.when(
        number >= 30, F.concat(F.lit("c"), number - 30)).otherwise(F.col(gold.GROUP)).alias("new_id")).distinct()
    kept = states.golden_states(linked.where(~late))
    fresh, gone = states.refresh_states(kept, states.golden_states(joined.where(late)), moved)
    left = kept.join(fresh.select(gold.GROUP).unionByName(gone), gold.GROUP, "left_anti")
    got = states.golden_records(left.unionByName(fresh), RUN_TS, cfg)
    keys = joined.select("source_system", "source_id", gold.GROUP)
    expected = gold.survivorship(joined.drop(gold.GROUP), keys, RUN_TS, cfg)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert states.golden_states(linked.limit(0)).count() == 0


def test_a_run_makes_no_pairs_for_review(spark, monkeypatch):
    """30 x 30 records agree on name and domain alone: the run and its counters write none of their pairs, the queue has all.

    Copies, near dates, equal tails and scores above the band are counted as the queue has them."""
    core = [t24(customer_id=f"{i}", name_english="Dmitri Moreau", email=f"a{i}@d.example", mobile=f"050{1000000 + i}") for i in range(30)]
    core += [t24(customer_id=f"N{i}", name_english="Dmitri Moreau", email="n@d.example", dob=date(1990, 1, 1 + i)) for i in range(3)]
    core += [t24(customer_id=f"C{i}", name_english="Dmitri Moreau", email="c@d.example") for i in range(2)]
    crm = [sfdc("Dmitri", "Moreau", contact_id=f"{i}", email=f"b{i}@d.example", phone=f"055{2000000 + i}") for i in range(30)]
    crm += [sfdc("Dmitri", "Moreau", contact_id="N", email="m@d.example", dob=date(1990, 3, 1), phone="0559000001"),
            sfdc("Dmitri", "Moreau", contact_id="E", email="e@d.example", dob=date(1990, 1, 2)),
            sfdc("Dmitri", "Moreau", contact_id="T", email="t@d.example", phone="0521000005")]
    written, put = {}, Staging.put

    def counted(self, df, name):
        staged = put(self, df, name)
        written[name] = max(written.get(name, 0), staged.rows)
        return staged
    monkeypatch.setattr(Staging, "put", counted)
    run = Resolver(spark).run({"t24": frame(spark, "t24", core), "sfdc": frame(spark, "sfdc", crm)}, RUN_TS)
    stats = run.stats.first()
    assert max(written.values()) < 200
    queue = run.review_queue.collect()
    assert stats.review_queue == len(queue) == len({tuple(r[:4]) for r in queue}) > 900
