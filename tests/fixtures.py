"""Small record sets for tests."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from kithline.sources.schemas import NORMALIZED, SOURCES


def frame(spark, name, rows):
    """A typed source table from dicts; columns that are not given are NULL."""
    schema = SOURCES[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def normalized(spark, records):
    return spark.createDataFrame([tuple(r.get(f.name) for f in NORMALIZED) for r in records], NORMALIZED)


def random_records(seed, n, hot=False):
    """Records with many collisions. ``hot`` gives a third of them one id, or one phone tail, block and domain."""
    rng = random.Random(seed)
    names = ["lorenzo pereira", "lorenzo perera", "laurenzo pereyra", "selma tanaka", "selma tanaca", "dmitri moro", "dmitry moro", None]
    records = []
    for i in range(n):
        system = rng.choice(["t24", "sfdc", "amplitude"])
        record = {
            "source_system": system, "source_id": f"{rng.choice('abc')}{i:04d}",
            "emirates_id": rng.choice([None] * 9 + [f"7841990000000{rng.randrange(20):02d}"]),
            "dob": rng.choice([None, date(1990, 1, 1) + timedelta(days=rng.randrange(0, 2000))]),
            "name_english": rng.choice(names),
            "name_arabic": None,
            "phone_e164": rng.choice([None, f"+97150{rng.randrange(3)}{rng.randrange(40):06d}"]),
            "email": rng.choice([None, f"u{rng.randrange(40)}@d{rng.randrange(3)}.example"]),
            "risk_rating": rng.choice([None, "LOW", "MED", "HIGH"]) if system == "t24" else None,
            "segment": rng.choice([None, "mass", "priority", "other"]) if system == "t24" else None,
            "kyc_status": "APPROVED" if system == "t24" else None,
            "created_at": datetime(2020, 1, 1) + timedelta(days=rng.randrange(300)),
            "updated_at": rng.choice([None, datetime(2024, 1, 1) + timedelta(days=rng.randrange(5))]),
        }
        if hot and i % 3 == 0:
            if seed % 2:
                record |= {"emirates_id": "784197933445567"}
            else:
                record |= {"emirates_id": None, "dob": None, "phone_e164": f"+97150{i % 9}000000",
                           "name_english": rng.choice(names[:3]), "email": f"h{i}@hot.example"}
        records.append(record)
    return records
