"""Plain SQL for every registered query, written from the rules alone: self-joins, windows and a recursive CTE."""

from __future__ import annotations

from kithline.sources.derived import FIRST_NAMES, LAST_NAMES

RUN_TS = "TIMESTAMP '2025-01-01 00:00:00'"


def _list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def _luhn(body: str) -> str:
    """Check digit of a 14-digit text."""
    digit = f"CAST(substr({body}, 14 - i, 1) AS INT)"
    term = f"CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END"
    return f"CAST((10 - list_sum([{term} FOR i IN range(14)]) % 10) % 10 AS INT)"


def _soundex(name: str) -> str:
    codes = f"translate(substr({name}, 1, 1) || regexp_replace(substr({name}, 2), '[hw]', '', 'g'), " \
            "'bfpvcgjkqsxzdtlmnraeiouy hw', '111122222222334556000000000')"
    for digit in "123456":
        codes = f"regexp_replace({codes}, '{digit}+', '{digit}', 'g')"
    return f"substr(upper(substr({name}, 1, 1)) || replace(substr({codes}, 2), '0', '') || '000', 1, 4)"


def _strict_phone(raw: str) -> str:
    return f"""CASE WHEN regexp_matches({raw}, '^\\+971[0-9]{{9}}$') THEN {raw}
        WHEN regexp_matches({raw}, '^00971[0-9]{{9}}$') THEN '+971' || substr({raw}, 6)
        WHEN regexp_matches({raw}, '^0[0-9]{{9}}$') THEN '+971' || substr({raw}, 2)
        WHEN regexp_matches({raw}, '^971[0-9]{{9}}$') THEN '+' || {raw} END"""


def _phone(raw: str) -> str:
    return _strict_phone(_bare(raw))


def _bare(raw: str) -> str:
    return f"regexp_replace(replace({raw}, '(0)', ''), '\\s+', '', 'g')"


def _eid(raw: str) -> str:
    digits = f"replace({raw}, '-', '')"
    return f"""CASE WHEN regexp_matches({raw}, '^784-?[0-9]{{4}}-?[0-9]{{7}}-?[0-9]$')
        AND {_luhn(f'substr({digits}, 1, 14)')} = CAST(substr({digits}, 15, 1) AS INT) THEN {digits} END"""


def _email(raw: str) -> str:
    bare = f"regexp_replace({raw}, '^\\s+|\\s+$', '', 'g')"
    return f"CASE WHEN regexp_matches({bare}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') THEN lower({bare}) END"


def _name(raw: str) -> str:
    return f"nullif(trim(regexp_replace(lower({raw}), '[^a-z0-9_]+', ' ', 'g')), '')"


DOB_SCORE = ("CASE WHEN l.dob IS NULL OR r.dob IS NULL THEN 0.0 WHEN l.dob = r.dob THEN 1.0 "
             "WHEN abs(date_diff('day', l.dob, r.dob)) <= 180 THEN 0.6 ELSE 0.0 END")
PHONE_SCORE = ("CASE WHEN l.phone_e164 IS NULL OR r.phone_e164 IS NULL THEN 0.0 "
               "WHEN l.phone_e164 = r.phone_e164 THEN 1.0 "
               "WHEN right(l.phone_e164, 6) = right(r.phone_e164, 6) THEN 0.7 ELSE 0.0 END")
DOMAIN_SCORE = ("CASE WHEN l.email IS NULL OR r.email IS NULL THEN 0.0 "
                "WHEN split_part(l.email, '@', 2) = split_part(r.email, '@', 2) THEN 1.0 ELSE 0.0 END")
JW = ("CASE WHEN l.name_english IS NULL OR r.name_english IS NULL THEN 0.0 "
      "ELSE jaro_winkler_similarity(l.name_english, r.name_english) END")
NEWEST = "ORDER BY updated_at DESC NULLS LAST, source_system, source_id"
KEY_ORDER = "(l.source_system, l.source_id) < (r.source_system, r.source_id)"
LINK = ("l.source_system AS left_source, l.source_id AS left_id, "
        "r.source_system AS right_source, r.source_id AS right_id")


def _det(rule: str, confidence: str, columns: tuple[str, ...]) -> str:
    on = " AND ".join(f"l.{c} = r.{c}" for c in columns)
    return (f"SELECT {LINK}, '{rule}' AS rule_id, CAST({confidence} AS DOUBLE) AS confidence "
            f"FROM normalized l JOIN normalized r ON {on} AND {KEY_ORDER}")


def _pick(column: str, where: str) -> str:
    return f"first({column} {NEWEST}) FILTER (WHERE {where} AND {column} IS NOT NULL)"


D1, D2, D3 = (_det("D1", "1.00", ("emirates_id",)), _det("D2", "0.95", ("phone_e164", "dob")),
              _det("D3", "0.90", ("email", "dob")))

SEGMENT = """CASE min(CASE segment WHEN 'private' THEN 1 WHEN 'priority' THEN 2 WHEN 'affluent' THEN 3
    WHEN 'mass' THEN 4 ELSE 5 END) WHEN 1 THEN 'private' WHEN 2 THEN 'priority' WHEN 3 THEN 'affluent'
    WHEN 4 THEN 'mass' END"""

SOURCES = f"""
people AS (
    SELECT c_custkey AS k, c_acctbal, c_mktsegment, first_order, last_order,
        {_list(FIRST_NAMES)}[k % 20 + 1] AS first_name, {_list(LAST_NAMES)}[k // 20 % 20 + 1] AS last_name,
        DATE '1950-01-01' + CAST(k * 7919 % 18000 AS INT) AS dob,
        '50' || lpad(CAST(k * 104729 % 10000000 AS VARCHAR), 7, '0') AS m9,
        lpad(CAST(k % 10000000 AS VARCHAR), 7, '0') AS k7, 'u' || k || '@d' || k % 7 || '.example' AS mail
    FROM customer LEFT JOIN (
        SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY 1
    ) ON o_custkey = c_custkey
),
t24_base AS (
    SELECT *, CASE WHEN k % 7 <> 0 THEN replace('784-' || 1950 + k % 50 || '-' || k7 || '-'
        || ({_luhn("('784' || 1950 + k % 50 || k7)")} + CASE WHEN k % 25 = 1 THEN 1 ELSE 0 END) % 10,
            CASE WHEN k % 9 = 4 THEN '-' ELSE chr(10) END, '') END AS eid,
        first_name || CASE WHEN k % 31 = 2 THEN chr(9) ELSE ' ' END || last_name
            || CASE WHEN k % 41 = 5 THEN chr(10) ELSE '' END AS full_name
    FROM people
),
t24 AS (
    SELECT CAST(k AS VARCHAR) AS customer_id, eid AS emirates_id, dob, full_name AS name_english,
        CASE WHEN k % 2 = 0 THEN 'عميل ' || k END AS name_arabic,
        ['0', '00971', '971', '+971'][k % 4 + 1] || m9 || CASE WHEN k % 47 = 7 THEN chr(10) ELSE '' END AS mobile,
        CASE WHEN k % 53 = 8 THEN 'no address ' || k WHEN k % 43 = 6 THEN chr(9) || mail || ' ' || chr(10) ELSE mail END AS email,
        CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 5000 THEN 'MED' ELSE 'LOW' END AS risk_rating,
        CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'mass' WHEN 'FURNITURE' THEN 'affluent' WHEN 'MACHINERY'
            THEN 'priority' WHEN 'BUILDING' THEN 'private' END AS segment, 'APPROVED' AS kyc_status,
        first_order AS created_at, last_order AS updated_at,
        CASE WHEN k % 29 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS record_status
    FROM t24_base
    UNION ALL
    SELECT 'D' || k, eid, dob, full_name, CASE WHEN k % 2 = 0 THEN 'عميل ' || k END,
        '+97154' || k7, 'dup' || k || '@dup.example',
        CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 5000 THEN 'MED' ELSE 'LOW' END, 'mass', 'PENDING',
        first_order, CASE WHEN k % 100 = 3 THEN last_order + INTERVAL 20 DAY END, 'ACTIVE'
    FROM t24_base WHERE k % 50 = 3
),
sfdc_base AS (SELECT *, CASE WHEN k % 3 = 0 THEN k // 3 % 5 ELSE 0 END AS c FROM people WHERE k % 3 = 0 OR k % 37 = 1),
sfdc AS (
    SELECT CASE WHEN k % 3 = 0 THEN 'S' ELSE 'X' END || k AS contact_id,
        CASE WHEN c = 4 THEN 'Walter' ELSE first_name END AS first_name,
        CASE WHEN c = 4 THEN 'Nobody' ELSE last_name END AS last_name,
        CASE WHEN c < 2 THEN dob WHEN c = 4 THEN dob + 1000 END AS dob,
        CASE c WHEN 0 THEN '+971 (0) 50 ' || substr(m9, 3, 3) || ' ' || substr(m9, 6) WHEN 1 THEN '+97155' || k7
            WHEN 2 THEN '+971' || m9 WHEN 3 THEN '+97152' || (CAST(substr(m9, 3, 1) AS INT) + 1) % 10 || right(m9, 6)
            ELSE '+97156' || k7 END AS phone,
        CASE c WHEN 0 THEN 'n' || k || '@other.example' WHEN 1 THEN upper(mail) WHEN 4 THEN 'z' || k || '@z.example'
            ELSE 's' || k || '@d' || k % 7 || '.example' END AS email,
        first_order + INTERVAL 30 DAY AS created_date,
        last_order + CASE WHEN k % 2 = 0 THEN INTERVAL 10 DAY ELSE INTERVAL (-10) DAY END AS last_modified_date,
        CASE WHEN k % 3 = 0 THEN false WHEN k % 2 = 0 THEN true END AS is_deleted
    FROM sfdc_base
),
amplitude AS (
    SELECT CAST(user_id AS VARCHAR) AS user_id,
        CASE WHEN user_id % 10 <> 9 THEN 'u' || user_id || '@d' || user_id % 7 || '.example' END AS email,
        min(ts) AS first_seen_at, max(ts) AS last_seen_at
    FROM events GROUP BY events.user_id
),
n_t24 AS (
    SELECT 't24' AS source_system, customer_id AS source_id, {_eid('emirates_id')} AS emirates_id, dob,
        {_name('name_english')} AS name_english, name_arabic, {_phone('mobile')} AS phone_e164,
        {_email('email')} AS email, risk_rating, segment, kyc_status, created_at, updated_at
    FROM t24 WHERE record_status = 'ACTIVE'
),
n_sfdc AS (
    SELECT 'sfdc' AS source_system, contact_id AS source_id, CAST(NULL AS VARCHAR) AS emirates_id, dob,
        {_name("concat_ws(' ', first_name, last_name)")} AS name_english, CAST(NULL AS VARCHAR) AS name_arabic,
        {_phone('phone')} AS phone_e164, {_email('email')} AS email, CAST(NULL AS VARCHAR) AS risk_rating,
        CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS VARCHAR) AS kyc_status, created_date AS created_at,
        last_modified_date AS updated_at
    FROM sfdc WHERE NOT is_deleted
),
n_amplitude AS (
    SELECT 'amplitude' AS source_system, user_id AS source_id, CAST(NULL AS VARCHAR) AS emirates_id,
        CAST(NULL AS DATE) AS dob, CAST(NULL AS VARCHAR) AS name_english, CAST(NULL AS VARCHAR) AS name_arabic,
        CAST(NULL AS VARCHAR) AS phone_e164, {_email('email')} AS email, CAST(NULL AS VARCHAR) AS risk_rating,
        CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS VARCHAR) AS kyc_status, first_seen_at AS created_at,
        last_seen_at AS updated_at
    FROM amplitude WHERE email IS NOT NULL
),
normalized AS (SELECT * FROM n_t24 UNION ALL SELECT * FROM n_sfdc UNION ALL SELECT * FROM n_amplitude)"""

LINKS = f"""
det_all AS ({D1} UNION ALL {D2} UNION ALL {D3}),
det AS (
    SELECT left_source, left_id, right_source, right_id, min(rule_id) AS rule_id, max(confidence) AS confidence
    FROM det_all GROUP BY ALL
),
matched AS (SELECT left_source AS source_system, left_id AS source_id FROM det
    UNION SELECT right_source, right_id FROM det),
unmatched AS (SELECT n.*, {_soundex('name_english')} AS block_key FROM normalized n
    ANTI JOIN matched USING (source_system, source_id)),
signals AS (
    SELECT {LINK}, {JW} AS jw_name, {DOB_SCORE} AS dob_score, {PHONE_SCORE} AS phone_score,
        {DOMAIN_SCORE} AS email_domain_score
    FROM unmatched l JOIN unmatched r
        ON l.block_key = r.block_key AND l.source_system <> r.source_system AND {KEY_ORDER}
),
candidates AS (
    SELECT * REPLACE (round(jw_name, 6) AS jw_name, CAST(dob_score AS DOUBLE) AS dob_score,
            CAST(phone_score AS DOUBLE) AS phone_score, CAST(email_domain_score AS DOUBLE) AS email_domain_score),
        round(CAST(0.4 AS DOUBLE) * jw_name + CAST(0.3 AS DOUBLE) * dob_score + CAST(0.2 AS DOUBLE) * phone_score
            + CAST(0.1 AS DOUBLE) * email_domain_score, 6) AS confidence
    FROM signals
),
scored AS (SELECT * FROM candidates WHERE confidence >= 0.5),
auto AS (SELECT * FROM scored WHERE confidence >= 0.7),
review AS (SELECT * FROM scored WHERE confidence < 0.7)"""

GOLD = f"""
pairs AS (SELECT left_source || ':' || left_id AS a, right_source || ':' || right_id AS b FROM det
    UNION SELECT left_source || ':' || left_id, right_source || ':' || right_id FROM auto),
hops AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (
    SELECT DISTINCT a, a AS b FROM hops
    UNION
    SELECT reach.a, hops.b FROM reach JOIN hops ON reach.b = hops.a
),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
components AS (
    SELECT source_system, source_id, coalesce(root, source_system || ':' || source_id) AS root,
        'MAL-' || substr(md5(coalesce(root, source_system || ':' || source_id)), 1, 12) AS mal_customer_id
    FROM (SELECT DISTINCT source_system, source_id FROM normalized)
    LEFT JOIN roots ON a = source_system || ':' || source_id
),
ends AS (
    SELECT left_source AS source_system, left_id AS source_id, 'deterministic' AS match_method, confidence FROM det
    UNION ALL SELECT right_source, right_id, 'deterministic', confidence FROM det
    UNION ALL SELECT left_source, left_id, 'probabilistic_auto', confidence FROM auto
    UNION ALL SELECT right_source, right_id, 'probabilistic_auto', confidence FROM auto
),
attribution AS (
    SELECT source_system, source_id, min(match_method) AS match_method, max(confidence) AS confidence
    FROM ends GROUP BY ALL
),
crosswalk AS (
    SELECT source_system, source_id, mal_customer_id, coalesce(match_method, 'new_customer') AS match_method,
        coalesce(confidence, 0.0) AS confidence, {RUN_TS} AS resolved_at
    FROM components LEFT JOIN attribution USING (source_system, source_id)
),
linked AS (SELECT n.*, mal_customer_id FROM normalized n JOIN crosswalk USING (source_system, source_id)),
first_contact AS (
    SELECT DISTINCT mal_customer_id,
        first_value(email) OVER w AS email, first_value(phone_e164) OVER w AS phone_e164
    FROM linked WHERE email IS NOT NULL OR phone_e164 IS NOT NULL
    WINDOW w AS (PARTITION BY mal_customer_id {NEWEST} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
waiting AS (
    SELECT left_source AS source_system, left_id AS source_id FROM review UNION SELECT right_source, right_id FROM review
),
names AS (
    SELECT mal_customer_id, coalesce({_pick('name_english', "source_system = 't24'")},
        {_pick('name_english', "source_system = 'sfdc'")},
        {_pick('name_english', "source_system NOT IN ('t24', 'sfdc')")}) AS name_english
    FROM linked GROUP BY ALL
),
dim AS (
    SELECT mal_customer_id, {_pick('emirates_id', "source_system = 't24'")} AS emirates_id,
        any_value(names.name_english) AS name_english,
        {_pick('name_arabic', "source_system = 't24'")} AS name_arabic, max(dob) AS dob,
        {_pick('email', 'true')} AS email, {_pick('phone_e164', 'true')} AS phone_e164,
        {_pick('kyc_status', "source_system = 't24'")} AS kyc_status,
        {_pick('risk_rating', "source_system = 't24'")} AS risk_rating, {SEGMENT} AS segment,
        min(created_at) AS first_seen_at, string_agg(DISTINCT source_system, ',' ORDER BY source_system) AS source_systems,
        {RUN_TS} AS last_refreshed_at
    FROM linked JOIN names USING (mal_customer_id) GROUP BY mal_customer_id
)"""


def _sources(query: str) -> str:
    return f"WITH {SOURCES} {query}"


def _links(query: str) -> str:
    return f"WITH {SOURCES}, {LINKS} {query}"


def _gold(query: str) -> str:
    return f"WITH RECURSIVE {SOURCES}, {LINKS}, {GOLD} {query}"


def _neighbours(columns: str) -> str:
    """Signals of linear pairings: records of one customer number, and records with those 25 numbers further on."""
    return _sources(f""", numbered AS (SELECT *, CAST(regexp_extract(source_id, '[0-9]+') AS BIGINT) AS k FROM normalized)
        SELECT {LINK}, {columns} FROM numbered l JOIN numbered r ON r.k = l.k AND {KEY_ORDER}
        UNION ALL SELECT {LINK}, {columns} FROM numbered l JOIN numbered r ON r.k = l.k + 25""")


FULL_NAME = "concat_ws(' ', first_name, last_name)"


def _star(rule: str, columns: str, present: str) -> str:
    return f"""SELECT source_system, source_id, first(source_system) OVER w AS root_source,
        first(source_id) OVER w AS root_id, '{rule}' AS rule_id FROM normalized WHERE {present}
        WINDOW w AS (PARTITION BY {columns} ORDER BY source_system, source_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
        QUALIFY count(*) OVER (PARTITION BY {columns}) > 1"""


SCORES = "jw_name, dob_score, phone_score, email_domain_score, confidence"
PAIR = "left_source, left_id, right_source, right_id"


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query name. Reading, writing and other bounds change nothing, so such queries share their SQL."""
    table = _plain_queries()
    return table | {name: table[like] for name, like in SAME_RESULT.items()}


SAME_RESULT = {
    "parquet_sources": "union_sources", "sectioned_json": "union_sources", "sink_crosswalk": "crosswalk",
    "sink_review_queue": "review_queue", "sink_dim_customer": "dim_customer", "json_export": "dim_customer",
    "det_best_tiled": "det_best", "prob_scored_tiled": "prob_scored", "review_queue_tiled": "review_queue",
    "dim_customer_tiled": "dim_customer", "sectioned_lines": "union_sources", "catalog_crosswalk": "crosswalk",
    "catalog_dim_customer": "dim_customer", "dim_customer_merged": "dim_customer", "published_results": "json_export_all", "sectioned_export": "json_export_all",
}


def _plain_queries() -> dict[str, str]:
    return {
        "normalize_t24": _sources("SELECT * FROM n_t24"),
        "normalize_sfdc": _sources("SELECT * FROM n_sfdc"),
        "normalize_amplitude": _sources("SELECT * FROM n_amplitude"),
        "union_sources": _sources("SELECT * FROM normalized"),
        "eid_raw": _sources("SELECT customer_id AS source_id, nullif(trim(emirates_id), '') AS emirates_id_raw FROM t24"),
        "phone_clean": _sources(
            f"SELECT 't24' AS source_system, customer_id AS source_id, {_phone('mobile')} AS phone_e164 FROM t24 "
            f"UNION ALL SELECT 'sfdc', contact_id, {_phone('phone')} FROM sfdc"),
        "phone_strict": _sources(
            f"SELECT 't24' AS source_system, customer_id AS source_id, {_strict_phone('mobile')} AS phone_e164 FROM t24 "
            f"UNION ALL SELECT 'sfdc', contact_id, {_strict_phone('phone')} FROM sfdc"),
        "email_clean": _sources(
            f"SELECT 't24' AS source_system, customer_id AS source_id, {_email('email')} AS email FROM t24 "
            f"UNION ALL SELECT 'sfdc', contact_id, {_email('email')} FROM sfdc "
            f"UNION ALL SELECT 'amplitude', user_id, {_email('email')} FROM amplitude"),
        "name_clean": _sources(
            f"SELECT 't24' AS source_system, customer_id AS source_id, {_name('name_english')} AS name_english, "
            f"{_soundex(_name('name_english'))} AS block_key FROM t24 UNION ALL "
            f"SELECT 'sfdc', contact_id, {_name(FULL_NAME)}, {_soundex(_name(FULL_NAME))} FROM sfdc"),
        "eid_valid": _sources(
            f"SELECT customer_id AS source_id, {_eid('emirates_id')} AS emirates_id FROM t24"),
        "eid_strict": _sources(
            f"""SELECT customer_id AS source_id, CASE WHEN regexp_matches(emirates_id, '^784-[0-9]{{4}}-[0-9]{{7}}-[0-9]$')
            THEN {_eid('emirates_id')} END AS emirates_id FROM t24"""),
        "jw_scores": _neighbours(f"round({JW}, 6) AS jw_name"),
        "dob_score": _neighbours(f"CAST({DOB_SCORE} AS DOUBLE) AS dob_score"),
        "phone_score": _neighbours(f"CAST({PHONE_SCORE} AS DOUBLE) AS phone_score"),
        "domain_score": _neighbours(f"CAST({DOMAIN_SCORE} AS DOUBLE) AS email_domain_score"),
        "weighted_confidence": _neighbours(
            f"round(CAST(0.4 AS DOUBLE) * ({JW}) + CAST(0.3 AS DOUBLE) * ({DOB_SCORE}) + CAST(0.2 AS DOUBLE) * "
            f"({PHONE_SCORE}) + CAST(0.1 AS DOUBLE) * ({DOMAIN_SCORE}), 6) AS confidence"),
        "sql_functions": _sources(
            f"""SELECT customer_id AS source_id,
                CASE WHEN email IS NULL THEN 0.0
                    ELSE round(jaro_winkler_similarity(lower(name_english), split_part(email, '@', 1)), 6) END AS jw,
                ({_eid('emirates_id')}) IS NOT NULL AS eid_ok, false AS short_ok FROM t24"""),
        "det_d1": _sources(D1), "det_d2": _sources(D2), "det_d3": _sources(D3),
        "det_best": _links("SELECT * FROM det"),
        "det_links": _sources(" UNION ALL ".join(f"SELECT * FROM ({_star(*a)})" for a in (
            ("D1", "emirates_id", "emirates_id IS NOT NULL"),
            ("D2", "phone_e164, dob", "phone_e164 IS NOT NULL AND dob IS NOT NULL"),
            ("D3", "email, dob", "email IS NOT NULL AND dob IS NOT NULL")))),
        "matched": _links("SELECT * FROM matched"),
        "unmatched": _links("SELECT * EXCLUDE (block_key) FROM unmatched"),
        "block_candidates": _links("""SELECT block_key, sum(n)::BIGINT AS records,
            ((sum(n) * sum(n) - sum(n * n)) // 2)::BIGINT AS candidate_pairs
            FROM (SELECT block_key, source_system, count(*) AS n FROM unmatched WHERE block_key IS NOT NULL GROUP BY ALL)
            GROUP BY block_key"""),
        "prob_scored": _links(f"SELECT {PAIR}, {SCORES} FROM scored"),
        "prob_scored_all": _links(f"SELECT {PAIR}, {SCORES} FROM candidates WHERE confidence >= 0.3"),
        "prob_scored_every": _links(f"SELECT {PAIR}, {SCORES} FROM candidates WHERE confidence >= 0"),
        "json_export_all": _gold("""SELECT 'crosswalk' AS section, source_system AS a, source_id AS b, mal_customer_id AS c, match_method AS d,
                '2025-01-01' AS e FROM crosswalk
            UNION ALL SELECT 'review_queue', left_source, left_id, right_source, right_id, '2025-01-01' FROM review
            UNION ALL SELECT 'dim_customer', mal_customer_id, name_english, name_arabic, email, strftime(dob, '%Y-%m-%d') FROM dim
            UNION ALL SELECT 'stats', d::VARCHAR, p::VARCHAR, r::VARCHAR, n::VARCHAR, (d + p + r + n)::VARCHAR FROM (
                SELECT count(*) FILTER (WHERE match_method = 'deterministic') AS d, count(*) FILTER (WHERE match_method = 'probabilistic_auto') AS p,
                    (SELECT count(*) FROM review) AS r, count(*) FILTER (WHERE match_method = 'new_customer') AS n FROM crosswalk)"""),
        # The raw forms are decorations of the plain name, which cleaning must bring back.
        "name_forms": _sources("""SELECT k::VARCHAR AS source_id, CASE k % 8
            WHEN 5 THEN lower(first_name) || 'fi ' || lower(last_name) || 'ß2' WHEN 6 THEN 'محمد احمد ' || k
            WHEN 7 THEN lower(first_name) || '_' || k || ' ' || lower(last_name)
            ELSE lower(first_name) || ' ' || lower(last_name) END AS name_english FROM people"""),
        "phone_forms": _sources("""SELECT k::VARCHAR AS source_id, CASE k % 12
            WHEN 3 THEN '+97142' || right(m9, 3) || right(k7, 3) WHEN 4 THEN '+44207946' || lpad((k % 10000)::VARCHAR, 4, '0')
            WHEN 5 THEN '+4930' || right(k7, 6) WHEN 8 THEN '+1212555' || lpad((k % 10000)::VARCHAR, 4, '0')
            WHEN 9 THEN '+971800' || right(k7, 4) WHEN 0 THEN '+971' || m9 WHEN 1 THEN '+971' || m9 WHEN 2 THEN '+971' || m9
            WHEN 11 THEN '+971' || m9 END AS phone_e164 FROM people"""),
        "empty_source": _sources("SELECT * FROM n_t24 UNION ALL SELECT * FROM n_sfdc"),
        "prob_auto": _links(f"SELECT {PAIR}, {SCORES} FROM auto"),
        "prob_review": _links(f"SELECT {PAIR}, {SCORES} FROM review"),
        "components": _gold("SELECT source_system, source_id, split_part(root, ':', 1) AS root_source, "
                            "split_part(root, ':', 2) AS root_id FROM components"),
        "customer_ids": _gold("SELECT source_system, source_id, mal_customer_id FROM components"),
        "method_attribution": _gold("SELECT * FROM attribution"),
        "crosswalk": _gold("SELECT * FROM crosswalk"),
        "review_queue": _links(f"SELECT {PAIR}, confidence, {RUN_TS} AS queued_at, 'pending' AS status FROM review"),
        "linked_rows": _gold("SELECT * FROM linked"),
        "t24_pick": _gold("SELECT mal_customer_id, " + ", ".join(
            f"first({c} {NEWEST}) FILTER (WHERE {c} IS NOT NULL) AS {c}"
            for c in ("emirates_id", "kyc_status", "risk_rating", "name_english", "name_arabic"))
            + " FROM linked WHERE source_system = 't24' GROUP BY ALL"),
        "fallback_name": _gold("SELECT * FROM names"),
        "latest_contact_row": _gold(f"""SELECT mal_customer_id, email, phone_e164 FROM (
            SELECT *, row_number() OVER (PARTITION BY mal_customer_id {NEWEST}) AS rn FROM linked
            WHERE email IS NOT NULL OR phone_e164 IS NOT NULL) WHERE rn = 1"""),
        "first_value_contact": _gold("SELECT * FROM first_contact"),
        "latest_contact_attr": _gold(
            f"SELECT mal_customer_id, {_pick('email', 'true')} AS email, {_pick('phone_e164', 'true')} AS phone_e164 "
            "FROM linked GROUP BY ALL"),
        "segment_tier": _gold(f"SELECT mal_customer_id, {SEGMENT} AS segment FROM linked GROUP BY mal_customer_id"),
        "lifetime": _gold("""SELECT mal_customer_id, min(created_at) AS first_seen_at, max(dob) AS dob,
            string_agg(DISTINCT source_system, ',' ORDER BY source_system) AS source_systems
            FROM linked GROUP BY mal_customer_id"""),
        "dim_customer": _gold("SELECT * FROM dim"),
        "dim_customer_row_contact": _gold("""SELECT dim.* REPLACE (f.email AS email, f.phone_e164 AS phone_e164)
            FROM dim LEFT JOIN first_contact f USING (mal_customer_id)"""),
        "dim_customer_hold_review": _gold("""SELECT dim.* FROM dim WHERE mal_customer_id IN (
            SELECT mal_customer_id FROM crosswalk LEFT JOIN (SELECT *, true AS held FROM waiting)
            USING (source_system, source_id) WHERE held IS NULL OR match_method <> 'new_customer')"""),
        "stats_by_method": _gold("SELECT match_method, count(*) AS n FROM crosswalk GROUP BY 1 ORDER BY 1"),
        "pending_count": _links("SELECT count(*) AS n FROM review"),
        "golden_count": _gold("SELECT count(*) AS golden_customer_count FROM dim"),
        "run_stats": _gold("""SELECT deterministic, probabilistic_auto, review_queue, new_customer,
            deterministic + probabilistic_auto + review_queue + new_customer AS total FROM (
            SELECT count(*) FILTER (WHERE match_method = 'deterministic') AS deterministic,
                count(*) FILTER (WHERE match_method = 'probabilistic_auto') AS probabilistic_auto,
                (SELECT count(*) FROM review) AS review_queue,
                count(*) FILTER (WHERE match_method = 'new_customer') AS new_customer FROM crosswalk)"""),
    }
