"""Scalar rules, table by table."""

from __future__ import annotations

import random
import unicodedata
from datetime import date

import pytest
from brute import jaro_winkler as slow_jaro_winkler
from pyspark.sql import functions as F

from kithline import functions as fn
from kithline.functions.similarity import jaro_winkler_bound


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)],
                               f"i int, a {kind}" + (f", b {kind}" if isinstance(values[0], tuple) else ""))
    columns = [F.col(c) for c in df.columns[1:]]
    return [r[0] for r in df.orderBy("i").select(function(*columns)).collect()]


PHONES = {
    "0529876543": "+971529876543", "00971529876543": "+971529876543", "+971 (0) 52-987 6543": "+971529876543",
    "971529876543": "+971529876543", "529876543": "+971529876543", "+9710529876543": "+971529876543",
    " 00971 52 9876543": "+971529876543", "(+971) 52 9876543": "+971529876543",
    "Tel: 052 987 6543 ext. 12": "+971529876543", "04 123 4567": "+97141234567",
    "٠٥٢٩٨٧٦٥٤٣": "+971529876543", "+44 20 7946 0958": "+442079460958", "0044 20 7946 0958": "+442079460958",
    "unknown": None, "": None, "   ": None, None: None, "+971 12": None, "+99999999": None, "+971529876543\n": "+971529876543", "052-987-6543 or 8": None, "12345": None,
}
STRICT = {
    "+971529876543": "+971529876543", "00971529876543": "+971529876543", "0529876543": "+971529876543",
    "+971529876543\n": None, "0529876543\r\n": None,
    "971529876543": "+971529876543", "529876543": None, "+971 52 9876543": None, "+971 (0) 52 246 8013": None, None: None,
}
EMAILS = {
    "  Some.Body@Mail.EXAMPLE  ": "some.body@mail.example", "\ta@b.c\n": "a@b.c", " x@y.z": "x@y.z", "no address": None,
    "a@b": None, "a b@c.d": None, "a@@b.c": None, "": None, None: None, "ÄÖ@exämple.de": "äö@exämple.de",
}
NAMES = {
    "Zoë Brontë": "zoe bronte", "  Van    Der   Quist  ": "van der quist", "O'Neil-Smith 3rd_x": "o neil smith 3rd_x",
    "مُحَمَّد": "محمد", "أحمد": "احمد", "ﬁn": "fin", "--": None, "   ": None, "": None, None: None,
}
EIDS = {
    "784-1979-3344556-7": "784197933445567", "784197933445567": "784197933445567", "784-1979-3344556-0": None,
    "987-654": None, "784-1979-3344556-77": None, " 784-1979-3344556-7": None, None: None,
    "784-2001-7654321-2": None, "784-2001-7654321-1": "784200176543211",
}
SOUNDEX = {"robert": "R163", "rupert": "R163", "b b": "B100", "catherine": "C365", None: None}


@pytest.mark.parametrize("function, cases", [
    (fn.normalize_phone, PHONES),
    (lambda c: fn.normalize_phone(c, True), STRICT),
    (fn.normalize_email, EMAILS),
    (fn.normalize_name, NAMES),
    (fn.validate_emirates_id, EIDS),
    (fn.block_key, SOUNDEX),
], ids=["phone", "phone-strict", "email", "name", "eid", "soundex"])
def test_cleaning(spark, function, cases):
    assert apply(spark, function, list(cases)) == list(cases.values())


def test_strict_hyphens_and_null_blocks(spark):
    values = ["784-1979-3344556-7", "784197933445567"]
    assert apply(spark, lambda c: fn.validate_emirates_id(c, True), values) == ["784197933445567", None]
    assert apply(spark, lambda c: fn.block_key(c, True), ["ann", None]) == ["A500", ""]


def test_names_match_plain_unicode_folding(spark):
    rng = random.Random(5)
    alphabet = [chr(c) for c in (*range(32, 127), *range(0xC0, 0x180), *range(0x600, 0x660), 0x1F600, 0x3B1, 0x3A3)]
    names = ["".join(rng.choices(alphabet, k=rng.randrange(1, 12))) for _ in range(500)]

    def fold(name):
        base = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).lower()
        words = "".join(c if c.isalnum() or c == "_" else " " for c in base).split()
        return " ".join(words) or None

    assert apply(spark, fn.normalize_name, names) == [fold(n) for n in names]


def test_jaro_winkler(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcé", k=rng.randrange(0, 14))) for _ in range(60)] + ["x" * 300, "x" * 299 + "y"]
    pairs = [(a, b) for a in words for b in rng.sample(words, 12)] + [(None, "a"), ("a", None)]
    pairs += [("catherine", "katherine"), ("martha", "marhta"), ("dixon", "dicksonx"), ("ab", "ab")]
    got = apply(spark, fn.jaro_winkler, pairs)
    assert got == pytest.approx([slow_jaro_winkler(a, b) for a, b in pairs], abs=1e-12)
    bounds = apply(spark, jaro_winkler_bound, pairs)
    assert all(g <= u + 1e-12 for g, u in zip(got, bounds))
    assert fn and got[-4] > 0.9 and got[-3] == pytest.approx(0.961111, abs=1e-6)


def test_jaro_winkler_of_empty_input(spark):
    assert spark.createDataFrame([], "a string, b string").select(fn.jaro_winkler(F.col("a"), F.col("b"))).collect() == []


def test_dob_score(spark):
    d = date(1982, 9, 3)
    cases = {(d, d): 1.0, (d, date(1982, 10, 1)): 0.6, (d, date(1983, 3, 2)): 0.6, (d, date(1983, 3, 3)): 0.0,
             (d, date(1975, 9, 3)): 0.0, (d, None): 0.0, (None, None): 0.0}
    assert apply(spark, fn.dob_score, list(cases), "date") == list(cases.values())


def test_phone_and_domain_score(spark):
    phones = {("+971529876543", "+971529876543"): 1.0, ("+971529876543", "+971509876543"): 0.7,
              ("+971503030303", "+971509930303"): 0.0, (None, "+971529876543"): 0.0, (None, None): 0.0}
    assert apply(spark, fn.phone_score, list(phones)) == list(phones.values())
    domains = {("a.b", "a.b"): 1.0, ("a.b", "a.c"): 0.0, (None, None): 0.0}
    assert apply(spark, fn.domain_score, list(domains)) == list(domains.values())


def test_confidence_compares_as_written(spark):
    row = spark.range(1).select(
        fn.confidence(F.lit(1.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("a"),
        fn.confidence(F.lit(0.0), F.lit(1.0), F.lit(0.7), F.lit(1.0)).alias("b")).first()
    assert (row.a, row.b) == (0.7, 0.54)


def test_functions_from_sql(spark):
    fn.register_functions(spark)
    row = spark.sql("""SELECT fn_validate_eid_checksum('784-1979-3344556-7') AS good,
        fn_validate_eid_checksum('784-1979-3344556-0') AS bad, fn_validate_eid_checksum(NULL) AS missing,
        fn_validate_eid_checksum('0') OR fn_validate_eid_checksum('4111111111111111') AS other,
        fn_jaro_winkler('catherine', 'catherin') AS jw, fn_jaro_winkler(NULL, 'x') AS none""").first()
    assert (row.good, row.bad, row.missing, row.other, row.none) == (True, False, False, False, 0.0)
    assert row.jw == pytest.approx(0.977778, abs=1e-6)
