"""Name cleaning and the blocking key."""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: a name that only needs lower case.
CLEAN = r"\A[a-z0-9_]+(?: [a-z0-9_]+)*\z"

# The batch function travels with its helpers, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _fold(name: str) -> str | None:
    """NFKD, marks dropped, lower case, everything but word characters to single spaces."""
    base = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return re.sub(r"[\W]+", " ", base.lower()).strip() or None


@F.pandas_udf(StringType())
def _fold_batch(names: pd.Series) -> pd.Series:
    distinct = names.dropna().unique()
    if not len(distinct):
        return names
    return names.map(dict(zip(distinct, map(_fold, distinct)))).astype(object)


def normalize_name(name: Column) -> Column:
    """Lower-case, diacritic-free name with single spaces, NULL when nothing is left.

    ASCII names stay in the JVM. Spark has no Unicode decomposition, so other names pass through one
    Arrow-batched function; ASCII rows reach it as NULLs.
    """
    lower = F.lower(name)
    ascii_only = name.rlike(r"\A\p{ASCII}*\z")
    words = F.nullif(F.trim(F.regexp_replace(lower, r"[^a-z0-9_]+", " ")), F.lit(""))
    return (
        F.when(lower.rlike(CLEAN), lower)
        .when(ascii_only, words)
        .otherwise(_fold_batch(F.when(~ascii_only, name)))
    )


def block_key(name: Column, block_null_names: bool = False) -> Column:
    """Soundex of the clean name. Nameless records have no key, unless they are to share the empty one."""
    return F.soundex(F.coalesce(name, F.lit(""))) if block_null_names else F.soundex(name)
