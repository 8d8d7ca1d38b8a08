"""The rules once more in plain Python over small lists, as the yardstick for the Spark operators."""

from __future__ import annotations

import hashlib
from itertools import combinations


def jaro_winkler(a, b):
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = [True] * len(b)
    from_a = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == ch:
                free[j] = False
                from_a.append(ch)
                break
    m = len(from_a)
    if m == 0:
        return 0.0
    from_b = [ch for ch, f in zip(b, free) if not f]
    swaps = sum(x != y for x, y in zip(from_a, from_b)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def key(record):
    return record["source_system"], record["source_id"]


def deterministic(records, rules, cross_source_only=False):
    """{(left, right): (rule_id, confidence)}"""
    pairs = {}
    for a, b in combinations(sorted(records, key=key), 2):
        if key(a) == key(b) or (cross_source_only and a["source_system"] == b["source_system"]):
            continue
        hits = [r for r in rules if all(a[c] is not None and a[c] == b[c] for c in r.columns)]
        if hits:
            old = pairs.get((key(a), key(b)))
            found = (min(r.rule_id for r in hits), max(r.confidence for r in hits))
            pairs[key(a), key(b)] = found if old is None else (min(old[0], found[0]), max(old[1], found[1]))
    return pairs


def soundex(name):
    codes = {c: d for d, cs in {"1": "bfpv", "2": "cgjkqsxz", "3": "dt", "4": "l", "5": "mn", "6": "r"}.items() for c in cs}
    out, last = name[0].upper(), codes.get(name[0], "0")
    for ch in name[1:]:
        if ch in "hw":
            continue
        code = codes.get(ch, "0")
        if code not in ("0", last):
            out += code
        last = code
    return (out + "000")[:4]


def score(a, b, cfg):
    name = jaro_winkler(a["name_english"], b["name_english"])
    days = None if a["dob"] is None or b["dob"] is None else abs((a["dob"] - b["dob"]).days)
    dob = 0.0 if days is None else 1.0 if days == 0 else cfg.near_dob_score if days <= cfg.dob_tolerance_days else 0.0
    p, q = a["phone_e164"], b["phone_e164"]
    phone = 0.0 if not p or not q else 1.0 if p == q else cfg.phone_tail_score if p[-6:] == q[-6:] else 0.0
    d, e = (r["email"] and r["email"].split("@")[1] for r in (a, b))
    domain = 1.0 if d and d == e else 0.0
    total = (cfg.weight_name * name + cfg.weight_dob * dob + cfg.weight_phone * phone
             + cfg.weight_email_domain * domain)
    return round(total + 1e-12, cfg.confidence_scale)


def probabilistic(records, matched, cfg, floor):
    """{(left, right): confidence} of all cross-system pairs of a block that reach ``floor``."""
    free = [r for r in sorted(records, key=key) if key(r) not in matched]
    pairs = {}
    for a, b in combinations(free, 2):
        if a["source_system"] == b["source_system"]:
            continue
        names = a["name_english"], b["name_english"]
        if cfg.block_null_names:
            same = (soundex(names[0]) if names[0] else "") == (soundex(names[1]) if names[1] else "")
        else:
            same = all(names) and soundex(names[0]) == soundex(names[1])
        if same and (c := score(a, b, cfg)) >= floor:
            pairs[key(a), key(b)] = c
    return pairs


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a in parent and b in parent:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {n: find(n) for n in nodes}


def customer_id(root):
    return "MAL-" + hashlib.md5(":".join(root).encode()).hexdigest()[:12]
