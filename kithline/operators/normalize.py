"""Source tables to one table of clean records."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.config import DEFAULT, LinkageConfig
from kithline.functions.contact import normalize_email, normalize_phone
from kithline.functions.ids import validate_emirates_id
from kithline.functions.names import normalize_name
from kithline.sources.adapters import ADAPTERS, Adapter
from kithline.sources.schemas import NORMALIZED


def normalize_source(name: str, df: DataFrame, cfg: LinkageConfig = DEFAULT,
                     adapters: Mapping[str, Adapter] = ADAPTERS) -> DataFrame:
    """One source table in the unified schema. Only columns the source really has are cleaned."""
    if name not in adapters:
        raise ValueError(f"unknown source system: {name}")
    adapter = adapters[name]
    rows = adapter.active_rows(df) if cfg.apply_filters else df
    supplied = adapter.supplied()
    cleaners = {
        "phone_e164": lambda c: normalize_phone(c, cfg.strict_phone),
        "email": normalize_email,
        "name_english": normalize_name,
        "emirates_id": lambda c: validate_emirates_id(c, cfg.strict_hyphens),
    }
    unified = adapter.select(rows)
    cleaned = unified.withColumns({c: f(F.col(c)) for c, f in cleaners.items() if c in supplied})
    return cleaned.to(NORMALIZED)


def normalize(sources: Mapping[str, DataFrame], cfg: LinkageConfig = DEFAULT,
              adapters: Mapping[str, Adapter] = ADAPTERS) -> DataFrame:
    """Union of all sources, one row per source record."""
    if not sources:
        raise ValueError("no source tables given")
    frames = [normalize_source(name, df, cfg, adapters) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
