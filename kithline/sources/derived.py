"""Customer sources derived from the TPC-H-like tables by formula.

Those tables hold no phone, birth date, e-mail or person name, so the three source systems are computed from
``customer``, ``orders`` and ``events``: every row comes from a table row, and the formulas use integers only, so any
SQL engine gives the same values. The cases behind ``k % 3 = 0`` reach every rule and both thresholds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names that customer numbers are turned into.
FIRST_NAMES = (
    "Adeline Bruno Chiara Dmitri Elena Farouk Greta Hakan Imani Jonas "
    "Keiko Lorenzo Mirela Nuri Odette Pavel Qiana Ravi Selma Tomas"
).split()
LAST_NAMES = (
    "Abalos Berghoff Castell Dunmore Eriksen Fontaine Gallo Hruska Ilves Janssen "
    "Kowal Lindqvist Moreau Novotny Okafor Pereira Quist Renner Sandoval Tanaka"
).split()


def _pick(names: list[str], place: str) -> str:
    return "element_at(array(" + ", ".join(f"'{n}'" for n in names) + f"), cast({place} as int) + 1)"


def _luhn_digit(body: str) -> str:
    """SQL for the check digit of a 14-digit number text."""
    digit = f"cast(substr({body}, 14 - i, 1) as int)"
    doubled = f"if({digit} > 4, 2 * {digit} - 9, 2 * {digit})"
    return f"((10 - aggregate(sequence(0, 13), 0, (s, i) -> s + if(i % 2 = 1, {digit}, {doubled})) % 10) % 10)"


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: the derived attributes that both customer systems draw from."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_custkey AS k", "c_acctbal", "c_mktsegment")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(F.col("o_custkey").alias("k")).agg(
        F.min("o_orderdate").cast("timestamp").alias("first_order"),
        F.max("o_orderdate").cast("timestamp").alias("last_order"),
    )
    return customer.join(orders, "k", "left").selectExpr(
        "*",
        f"{_pick(FIRST_NAMES, 'k % 20')} AS first_name",
        f"{_pick(LAST_NAMES, '(k div 20) % 20')} AS last_name",
        "date_add(date'1950-01-01', cast(k * 7919 % 18000 as int)) AS dob",
        "concat('50', lpad(k * 104729 % 10000000, 7, '0')) AS m9",
        "lpad(k % 10000000, 7, '0') AS k7",
        "concat('u', k, '@d', k % 7, '.example') AS email",
    )


def t24(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core banking: every customer once, every fiftieth a second time under another id, phone and e-mail."""
    people = _people(spark, sf_dir).selectExpr(
        "*", "concat('784', 1950 + k % 50, k7) AS body",
    ).selectExpr("*", f"(({_luhn_digit('body')}) + if(k % 25 = 1, 1, 0)) % 10 AS check_digit")
    rows = people.selectExpr(
        "*",
        "explode(if(k % 50 = 3, array(false, true), array(false))) AS copy",
    )
    return rows.selectExpr(
        "if(copy, concat('D', k), cast(k as string)) AS customer_id",
        "if(k % 7 = 0, NULL, concat_ws(if(k % 9 = 4, '', '-'), '784', 1950 + k % 50, k7, check_digit)) AS emirates_id",
        "dob",
        "concat(first_name, if(k % 31 = 2, char(9), ' '), last_name, if(k % 41 = 5, char(10), '')) AS name_english",
        "if(k % 2 = 0, concat('عميل ', k), NULL) AS name_arabic",
        "if(copy, concat('+97154', k7), concat(element_at(array('0', '00971', '971', '+971'), cast(k % 4 as int) + 1), m9,"
        " if(k % 47 = 7, char(10), ''))) AS mobile",
        "CASE WHEN copy THEN concat('dup', k, '@dup.example') WHEN k % 53 = 8 THEN concat('no address ', k)"
        " WHEN k % 43 = 6 THEN concat(char(9), email, ' ', char(10)) ELSE email END AS email",
        "CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 5000 THEN 'MED' ELSE 'LOW' END AS risk_rating",
        "CASE WHEN copy THEN 'mass' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'mass'"
        " WHEN c_mktsegment = 'FURNITURE' THEN 'affluent' WHEN c_mktsegment = 'MACHINERY' THEN 'priority'"
        " WHEN c_mktsegment = 'BUILDING' THEN 'private' END AS segment",
        "if(copy, 'PENDING', 'APPROVED') AS kyc_status",
        "first_order AS created_at",
        "CASE WHEN NOT copy THEN last_order WHEN k % 100 = 3 THEN last_order + interval 20 days END AS updated_at",
        "if(k % 29 = 0 AND NOT copy, 'CLOSED', 'ACTIVE') AS record_status",
    )


def sfdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM: every third customer in one of five shapes (c), and some deleted contacts that must not be read."""
    people = _people(spark, sf_dir).where("k % 3 = 0 OR k % 37 = 1").selectExpr(
        "*", "if(k % 3 = 0, (k div 3) % 5, 0) AS c", "concat('s', k, '@d', k % 7, '.example') AS same_domain")
    return people.selectExpr(
        "concat(if(k % 3 = 0, 'S', 'X'), k) AS contact_id",
        "if(c = 4, 'Walter', first_name) AS first_name",
        "if(c = 4, 'Nobody', last_name) AS last_name",
        "CASE WHEN c IN (0, 1) THEN dob WHEN c = 4 THEN date_add(dob, 1000) END AS dob",
        "CASE c WHEN 0 THEN concat('+971 (0) 50 ', substr(m9, 3, 3), ' ', substr(m9, 6, 4))"
        " WHEN 1 THEN concat('+97155', k7) WHEN 2 THEN concat('+971', m9)"
        " WHEN 3 THEN concat('+97152', (cast(substr(m9, 3, 1) as int) + 1) % 10, right(m9, 6))"
        " ELSE concat('+97156', k7) END AS phone",
        "CASE c WHEN 0 THEN concat('n', k, '@other.example') WHEN 1 THEN upper(email)"
        " WHEN 4 THEN concat('z', k, '@z.example') ELSE same_domain END AS email",
        "first_order + interval 30 days AS created_date",
        "last_order + if(k % 2 = 0, interval 10 days, interval -10 days) AS last_modified_date",
        "if(k % 3 = 0, false, if(k % 2 = 0, true, NULL)) AS is_deleted",
    )


def amplitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mobile: one row per user of the event stream; some never logged in and have no e-mail."""
    users = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(F.col("user_id").alias("u")).agg(
        F.min("ts").cast("timestamp").alias("first_seen_at"), F.max("ts").cast("timestamp").alias("last_seen_at"))
    return users.selectExpr(
        "cast(u as string) AS user_id",
        "if(u % 10 = 9, NULL, concat('u', u, '@d', u % 7, '.example')) AS email",
        "first_seen_at", "last_seen_at",
    )


def derived_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"t24": t24(spark, sf_dir), "sfdc": sfdc(spark, sf_dir), "amplitude": amplitude(spark, sf_dir)}


# -- Free forms of names and phones ---------------------------------------------------------------------------------------

FULL_WIDTH = "".join(chr(0xFEE0 + ord(c)) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"


def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, raw): every customer's name as people write it. Cleaning must give the plain name, or for one form in
    eight the bare Arabic letters: accents as one or two code points, full-width letters, no-break blanks, hyphens and
    quotes, other cases, ligatures, and vowel marks."""
    return _people(spark, sf_dir).selectExpr("cast(k as string) AS source_id", f"""CASE k % 8
        WHEN 0 THEN concat(translate(first_name, 'aeoniuAEO', 'áèöñîüÀÉÓ'), ' ', translate(last_name, 'acso', 'ăčšô'))
        WHEN 1 THEN concat(regexp_replace(first_name, '([aeiou])', '$1\u0301'), ' ', regexp_replace(last_name, '([aeiou])', '$1\u0308\u0323'))
        WHEN 2 THEN translate(concat(first_name, ' ', last_name), 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', '{FULL_WIDTH}')
        WHEN 3 THEN concat('\u00a0', upper(first_name), '\u2003-\u00a0', last_name, '\u2019')
        WHEN 4 THEN concat('\u201c', first_name, '\u201d  (', lower(last_name), ')')
        WHEN 5 THEN concat(first_name, 'ﬁ', char(9), last_name, 'ß²')
        WHEN 6 THEN concat('مُحَمَّد ', 'أَحْمَد ', k)
        ELSE concat(first_name, '_', k, '. ', last_name, ',') END AS raw""")


def phone_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, raw): every customer's number as people write it: separators, words, extensions, other digits, landlines,
    foreign numbers, and numbers that are none."""
    return _people(spark, sf_dir).selectExpr("cast(k as string) AS source_id", f"""CASE k % 12
        WHEN 0 THEN concat('Tel: +971 (0) ', left(m9, 2), ' ', substr(m9, 3, 3), '-', substr(m9, 6), ' ext. ', k % 90 + 10)
        WHEN 1 THEN translate(concat('0', m9), '0123456789', '{ARABIC_DIGITS}')
        WHEN 2 THEN concat('＋971 ', translate(m9, '0123456789', '０１２３４５６７８９'))
        WHEN 3 THEN concat('04-2', right(m9, 3), '.', right(k7, 3))
        WHEN 4 THEN concat('+44 20 7946 ', lpad(cast(k % 10000 as string), 4, '0'))
        WHEN 5 THEN concat('0049 (0) 30/', right(k7, 6))
        WHEN 6 THEN concat('+999', k7)
        WHEN 7 THEN concat('12', right(k7, 3))
        WHEN 8 THEN concat('+1 (212) 555-', lpad(cast(k % 10000 as string), 4, '0'), ' x', k % 9)
        WHEN 9 THEN concat('800 ', right(k7, 4))
        WHEN 10 THEN concat('call ', m9, ' or ', m9)
        ELSE concat('mobile 00971 ', m9, ', #', k % 100) END AS raw""")
