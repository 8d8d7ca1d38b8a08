"""The four similarity signals of the fuzzy pass and their weighted sum."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from kithline.config import DEFAULT, LinkageConfig

# The batch function travels with its helpers, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _codes(texts: np.ndarray, width: int) -> np.ndarray:
    return texts.astype(f"<U{width}").view(np.uint32).reshape(len(texts), width)


def _jaro_winkler_matrix(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray) -> np.ndarray:
    """Jaro-Winkler of n text pairs at once: one pass over the characters of ``a``, all pairs side by side."""
    n = len(a)
    left, right = _codes(a, int(len_a.max())), _codes(b, int(len_b.max()))
    width_a, width_b = left.shape[1], right.shape[1]
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)[:, None]
    position = np.arange(width_b)[None, :]
    free = position < len_b[:, None]
    hit_a = np.zeros((n, width_a), bool)
    row = np.arange(n)
    for i in range(width_a):
        options = free & (right == left[:, i : i + 1]) & (np.abs(position - i) <= reach) & (i < len_a)[:, None]
        first = options.argmax(axis=1)
        found = options[row, first]
        hit_a[:, i] = found
        free[row[found], first[found]] = False
    hit_b = ~free & (position < len_b[:, None])
    m = hit_a.sum(axis=1)
    # The matched characters of both sides, packed to the front in reading order.
    seq_a = np.take_along_axis(left, np.argsort(~hit_a, axis=1, kind="stable"), axis=1)
    seq_b = np.take_along_axis(right, np.argsort(~hit_b, axis=1, kind="stable"), axis=1)
    common = min(width_a, width_b)
    seen = np.arange(common)[None, :] < m[:, None]
    swaps = ((seq_a[:, :common] != seq_b[:, :common]) & seen).sum(axis=1) // 2
    safe = np.maximum(m, 1)
    jaro = np.where(m == 0, 0.0, (m / len_a + m / len_b + (m - swaps) / safe) / 3.0)
    head = min(4, common)
    same = (left[:, :head] == right[:, :head]) & (np.arange(head)[None, :] < np.minimum(len_a, len_b)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1.0 - jaro), jaro)


def _jaro_winkler_series(a: pd.Series, b: pd.Series) -> pd.Series:
    """0.0 where either text is missing or empty. Distinct pairs only, in classes of similar length."""
    result = np.zeros(len(a))
    left = a.fillna("").to_numpy(dtype=object)
    right = b.fillna("").to_numpy(dtype=object)
    codes, pairs = pd.factorize(pd.MultiIndex.from_arrays([left, right]))
    left = pairs.get_level_values(0).to_numpy(dtype=object)
    right = pairs.get_level_values(1).to_numpy(dtype=object)
    len_a = np.fromiter(map(len, left), np.int64, len(left))
    len_b = np.fromiter(map(len, right), np.int64, len(right))
    scores = np.zeros(len(left))
    longest = np.maximum(len_a, len_b)
    live = np.flatnonzero((len_a > 0) & (len_b > 0))
    size_class = np.ceil(np.log2(np.maximum(longest, 8))).astype(int)
    for cls in np.unique(size_class[live]):
        chosen = live[size_class[live] == cls]
        step = max(1, (1 << 20) >> int(cls))
        for start in range(0, len(chosen), step):
            part = chosen[start : start + step]
            scores[part] = _jaro_winkler_matrix(left[part], right[part], len_a[part], len_b[part])
    result[:] = scores[codes]
    return pd.Series(result)


jaro_winkler_batch = F.pandas_udf(_jaro_winkler_series, DoubleType())
# Declared nondeterministic so that a filter on the score is not pushed below it, which would run the batches twice.
_jaro_winkler_once = F.pandas_udf(_jaro_winkler_series, DoubleType()).asNondeterministic()


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler in [0, 1]; 0.0 when a side is NULL or empty. Equal names never leave the JVM."""
    equal = (a == b) & (F.length(a) > 0)
    return F.when(equal, F.lit(1.0)).otherwise(_jaro_winkler_once(F.when(~equal, a), F.when(~equal, b)))


#: Letters with a place in the packed counts, in two halves, and how many of each are told apart.
LETTERS = ("abcdefghijklm", "nopqrstuvwxyz")
LETTER_COUNT = 4


def letter_counts(name: Column) -> Column:
    """(low, high, rest): how often each letter stands in a name, packed so that what two names share is a bit count.

    A letter's count is a run of that many set bits, four at most; ``rest`` is the number of all other characters."""
    def count(letter: str) -> Column:
        return F.least(F.length(name) - F.length(F.replace(name, F.lit(letter), F.lit(""))), F.lit(LETTER_COUNT))

    def packed(letters: str) -> Column:
        runs = [F.element_at(F.array(*[F.lit(((1 << n) - 1) << (LETTER_COUNT * k)).cast("long") for n in range(LETTER_COUNT + 1)]), count(c) + 1)
                for k, c in enumerate(letters)]
        return _or_all(runs)
    told = _add_all([count(c) for letters in LETTERS for c in letters])
    return F.struct(packed(LETTERS[0]).alias("low"), packed(LETTERS[1]).alias("high"), (F.length(name) - told).alias("rest"))


def _or_all(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else _or_all(columns[:len(columns) // 2]).bitwiseOR(_or_all(columns[len(columns) // 2:]))


def _add_all(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else _add_all(columns[:len(columns) // 2]) + _add_all(columns[len(columns) // 2:])


def shared_letters(a: Column, b: Column) -> Column:
    """At least as many as the characters that two names' packed counts can match."""
    return F.bit_count(a["low"].bitwiseAND(b["low"])) + F.bit_count(a["high"].bitwiseAND(b["high"])) + F.least(a["rest"], b["rest"])


def jaro_winkler_bound(a: Column, b: Column, matches: Column | None = None) -> Column:
    """A value Jaro-Winkler cannot exceed, from the lengths, the common prefix, and the most ``matches``, if they are known."""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    most = short if matches is None else F.least(short, matches)
    jaro = (F.lit(1.0) + most / F.greatest(short, F.lit(1)) + most / F.greatest(long, F.lit(1))) / F.lit(3.0)
    prefix = F.lit(0)
    for n in (1, 2, 3, 4):
        prefix = F.when((F.left(a, F.lit(n)) == F.left(b, F.lit(n))) & (short >= n), F.lit(n)).otherwise(prefix)
    return F.when(a.isNull() | b.isNull() | (most == 0), F.lit(0.0)).otherwise(
        jaro + prefix * F.lit(0.1) * (F.lit(1.0) - jaro))


def near_dates(a: Column, b: Column, tolerance_days: int) -> Column:
    return F.coalesce(F.abs(F.datediff(a, b)) <= tolerance_days, F.lit(False))


def dob_score(a: Column, b: Column, cfg: LinkageConfig = DEFAULT) -> Column:
    """1.0 equal, 0.6 within the tolerance (inclusive), else 0.0; NULL counts as no signal."""
    return (
        F.when(F.coalesce(a == b, F.lit(False)), F.lit(1.0))
        .when(near_dates(a, b, cfg.dob_tolerance_days), F.lit(cfg.near_dob_score))
        .otherwise(F.lit(0.0))
    )


def phone_tail(phone: Column) -> Column:
    return F.right(phone, F.lit(6))


def phone_score(a: Column, b: Column, cfg: LinkageConfig = DEFAULT) -> Column:
    """1.0 equal, 0.7 when the last six digits agree, else 0.0."""
    return (
        F.when(F.coalesce(a == b, F.lit(False)), F.lit(1.0))
        .when(F.coalesce(phone_tail(a) == phone_tail(b), F.lit(False)), F.lit(cfg.phone_tail_score))
        .otherwise(F.lit(0.0))
    )


def domain_score(a: Column, b: Column) -> Column:
    """1.0 for equal e-mail domains, else 0.0."""
    return F.when(F.coalesce(a == b, F.lit(False)), F.lit(1.0)).otherwise(F.lit(0.0))


def other_signals(dob: Column, phone: Column, domain: Column, cfg: LinkageConfig = DEFAULT) -> Column:
    """The weighted score without the name."""
    return dob * cfg.weight_dob + phone * cfg.weight_phone + domain * cfg.weight_email_domain


def confidence(name: Column, dob: Column, phone: Column, domain: Column, cfg: LinkageConfig = DEFAULT) -> Column:
    """The weighted score, rounded so that sums such as .4 + .2 + .1 compare as written."""
    total = name * cfg.weight_name + other_signals(dob, phone, domain, cfg)
    return F.round(total, cfg.confidence_scale)
