"""Threshold-scaled document fingerprints: every shingle hash below a fixed fraction of the hash range is retained.

Which hashes are retained depends on the hash alone, not on the text it comes from. So a fingerprint grows with its
text, the fingerprint of several texts together is the union of theirs (``merge``), and the share of one fingerprint
found in another estimates how much of the one text is contained in the other, however unequal both are.
Only SQL functions are used.

Defined results: a null text is empty and has the empty fingerprint; a text of fewer words than a shingle is one shingle;
a text none of whose hashes is below the threshold keeps its smallest one, so that only wordless texts have nothing (a
merge drops such a stand-in when there are regular hashes). Equal texts have equal fingerprints; two empty fingerprints
have likeness 1, an empty and another one 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kithline.llm.common import met
from kithline.plans.staging import Staged, Staging

_LOWEST = -(2**63)
_SPACES = r"[ \t\n\x0B\f\r]+"


@dataclass(frozen=True)
class ScaledSketch:
    width: int = 5
    #: One hash in ``scale`` is retained.
    scale: int = 8
    #: Documents per bucket when neighbours are looked up; more of them from so many buckets on.
    bucket_rows: int = 1_000
    most_buckets: int = 1 << 17

    @property
    def threshold(self) -> int:
        return _LOWEST + 2**64 // self.scale


def _bound(value: Column, use) -> Column:
    """``use(v)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(text: Column, width: int) -> Column:
    """Hashes of all word shingles, in order."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACES), "")

    def shingles(h: Column) -> Column:
        many = F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(0))),
                           lambda first, i: F.xxhash64(first, *[F.get(h, i + k) for k in range(1, width)]))
        return F.when(F.size(h) >= width, many).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(
            F.array().cast("array<bigint>"))
    return _bound(F.transform(words, lambda w: F.xxhash64(w)), shingles)


def fingerprint(text: Column, cfg: ScaledSketch = ScaledSketch()) -> Column:
    """Sorted distinct hashes below the threshold, or the smallest hash."""
    def retain(all_: Column) -> Column:
        low = F.filter(all_, lambda x: x < cfg.threshold)
        return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))).when(
            F.size(all_) > 0, F.array(F.array_min(all_))).otherwise(all_)
    return _bound(shingle_hashes(text, cfg.width), retain)


def merge(a: Column, b: Column, cfg: ScaledSketch = ScaledSketch()) -> Column:
    """Fingerprint of two texts together, from theirs."""
    both = F.array_sort(F.array_union(a, b))
    regular = F.filter(both, lambda x: x < cfg.threshold)
    return F.when(F.size(regular) > 0, regular).otherwise(F.slice(both, 1, 1))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).when(F.size(b) > 0, F.lit(0.0)).otherwise(F.lit(1.0))


def likeness(a: Column, b: Column) -> Column:
    """Containment of the smaller fingerprint in the larger one."""
    both = F.least(F.size(a), F.size(b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).when(
        F.greatest(F.size(a), F.size(b)) > 0, F.lit(0.0)).otherwise(F.lit(1.0))


def as_hex(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def _bucket(heads: Column, steps: int, order: Column, tie: Column) -> Column:
    """The last of the descending ``heads(order, tie)`` that is not below a key, by ``steps`` halvings."""
    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"] + 1) / 2).cast("int")
        head = F.get(heads, middle)
        behind = (head["order"] > order) | ((head["order"] == order) & (head["tie"] >= tie))
        return F.struct(F.when(behind, middle).otherwise(span["low"]).alias("low"),
                        F.when(behind, span["high"]).otherwise(F.greatest(span["low"], middle - 1)).alias("high"))
    start = F.struct(F.lit(0).alias("low"), (F.size(heads) - 1).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["low"]


def with_next(docs: DataFrame, derived: dict[str, Column], carried: list[str], staging: Staging,
              cfg: ScaledSketch = ScaledSketch()) -> DataFrame:
    """Distinct rows of ``docs(doc_id, text)`` with their number ``n_rows``, ``derived`` columns, and ``next_<c>`` for every carried column
    of the row that follows by descending id, the last one's being the first. Rows without id come last; rows with one id go by
    the descending hash of their texts. A row that is there several times follows itself but for the last time.

    The keys alone are ranked, sorted by ranges with the partitions' sizes as offsets, and every so many of them begin a
    bucket of equal size. Texts are shuffled once, to their bucket, and a bucket's first row to the one before it, too."""
    order, tie = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)), F.xxhash64("text")
    docs = docs.withColumns({"_order": order, "_tie": tie})
    key = ["_order", "_tie"]
    by = [F.desc(c) for c in key]
    keys = docs.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).repartitionByRange(*by).sortWithinPartitions(*by)
    placed = staging.put(keys.withColumn("_place", F.monotonically_increasing_id()), "keys")
    part = F.shiftright("_place", 33)
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = placed.df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")).select("_part", before.alias("_offset"))
    offsets = staging.put(offsets, "offsets").df  # one row per partition
    rank = F.col("_offset") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    size = max(cfg.bucket_rows, -(-placed.rows // cfg.most_buckets))
    heads = staging.put(placed.df.withColumn("_part", part).join(F.broadcast(offsets), "_part").where(rank % size == 0).select(
        *key, F.floor(rank / size).cast("int").alias("_bucket")), "heads")
    listed = heads.df.agg(F.array_sort(F.collect_list(F.struct("_bucket", F.col("_order").alias("order"), F.col("_tie").alias("tie")))))
    bucket = _bucket(F.col("_heads"), max(heads.rows, 1).bit_length() + 1, F.col("_order"), F.col("_tie"))
    # Equal rows have one key; one of them stands for all.
    several = staging.put(placed.df.where("n_rows > 1").select(*key, "n_rows"), "several")
    single = docs.join(met(Staged(several.df.select(*key), several.rows)), key, "left_anti").withColumn("n_rows", F.lit(1).cast("long"))
    copied = docs.join(met(several), key).dropDuplicates(key)
    rows = single.unionByName(copied).withColumns(derived).withColumn("_heads", listed.scalar()).withColumn("_bucket", bucket).drop("_heads")
    ghosts = rows.drop("_bucket").join(met(heads), key).withColumn(
        "_bucket", F.when(F.col("_bucket") > 0, F.col("_bucket") - 1).otherwise(F.lit(heads.rows - 1)))
    both = rows.withColumn("_ghost", F.lit(False)).unionByName(ghosts.withColumn("_ghost", F.lit(True)))
    following = Window.partitionBy("_bucket").orderBy("_ghost", *by)
    return both.select("*", *[F.lead(c).over(following).alias(f"next_{c}") for c in carried]).where("not _ghost").drop(*key, "_bucket", "_ghost")


def fingerprint_with_edits(docs: DataFrame, staging: Staging, cfg: ScaledSketch = ScaledSketch()) -> DataFrame:
    """Per row of ``docs(doc_id, text)`` its fingerprint, that of the text whose second half is replaced by the beginning of the
    next document, and the likeness to both."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pairs = with_next(own, {"n_chars": F.length("text").cast("long"), "own": fingerprint(F.col("text"), cfg)}, ["text", "own"], staging, cfg)
    # All but one of equal rows are followed by themselves.
    copies = F.array(F.struct("next_text", "next_own", F.lit(1).cast("long").alias("rows")), F.struct(
        F.col("text").alias("next_text"), F.col("own").alias("next_own"), (F.col("n_rows") - 1).alias("rows")))
    pairs = pairs.withColumn("following", F.explode(F.filter(copies, lambda c: c["rows"] > 0))).select("doc_id", "text", "n_chars", "own", "following.*")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = pairs.withColumn("edited", F.concat(
        F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half)))
    edited = edited.select("doc_id", "n_chars", "own", "next_own", "rows", F.sha2("edited", 256).alias("edited_sha256"),
                           fingerprint(F.col("edited"), cfg).alias("other"))
    result = edited.select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("own")).alias("fingerprint"), as_hex(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"), "rows")
    return result.withColumn("rows", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).drop("rows")
