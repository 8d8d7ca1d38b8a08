"""Exact self-join of documents on the Jaccard similarity of their word shingles, with several global token orders.

A set of n shingles and one that overlaps it enough must share one of the first ``n - ceil(t n) + 1`` shingles of *any*
global order. One order makes the candidates. All orders put frequent shingles last (by a fixed-size count table over
all documents), so that passages which many documents share are in hardly any prefix.

Filters meet before any text travels: a candidate pair must share a prefix shingle under every further order, which the
sets' prefix signatures (32 bits a shingle) tell, and the parities of the shingles per slot, which tell in how many
shingles two sets differ at least, must leave room for the overlap. Texts are fetched for the pairs that are left, and compared.

Equal sets are one class before anything else: tasks emit a set once, and Spark's partial aggregation does the rest, so a
copy group of any size is one set. Candidates are met in an order that spares most of them, and loses no link: every
member of a prefix bucket first meets one member of it, in a crowded bucket several ones, and the links found give components;
then the bucket members of *different* components meet, in tiles of bounded size. A group of k near copies so costs some k
comparisons, not k*k. Where buckets of several components are still crowded, their members first meet some more members, as
long as that finds links.
Where in its prefix a shingle stands bounds the overlap of two sets whose first common shingle it is, which spares more.

Defined results: a null or wordless text has no shingle and no link; a text of fewer words than a shingle is one shingle;
rows with the same id are one node; a row without id gets its set size and no component; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.config import DEFAULT
from kithline.llm import words as W
from kithline.llm.common import BROADCAST_IDS, bitmap, connected_components, few, let_go, met, small_batches
from kithline.operators.skew import tiled_join
from kithline.plans.staging import Staged, Staging


@dataclass(frozen=True)
class JaccardJoin:
    width: int = 5
    percent: int = 75
    #: Further orders under which a candidate pair must share a prefix shingle.
    more_orders: int = 2
    #: Entries of the count table, and bits of the table of shared prefix shingles (their sizes do not depend on the input).
    count_slots: int = 1 << 17
    shared_bits: int = 1 << 26
    #: Pairs (later: of different components) from which on a bucket is crowded: its join looks at parities, before a pair comes to be.
    dense_pairs: int = 2_000
    #: How often the members of crowded buckets meet some members, at most, and how many of them, about; a further round that
    #: finds fewer links than ``least_linked``, or than one for ``members_linked`` members, is the last.
    more_stars: int = 6
    centres: int = 8
    least_linked: int = 100
    members_linked: int = 100
    #: Pairs whose texts are compared without further filters, and pairs of a task.
    few_pairs: int = 10_000
    task_pairs: int = 1_000
    #: First shingles of a set that are looked through for an earlier meeting of two sets in a crowded bucket.
    earlier: int = 32
    #: Bytes of a batch for a Python worker: the JVM's side holds on to buffers of twice that, several a task.
    batch_bytes: int = 2 << 20
    #: Sets that a task remembers, so as to emit each once.
    task_sets: int = 200_000


def _sets(texts: pa.Array, cfg: JaccardJoin) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, distinct shingle hashes per row) of runs of rows."""
    for row, _, data, borders in W.chunks(texts):
        words = W.split(data, borders)
        hashed, first = W.runs(W.hashes(words, lower=True), words.first, cfg.width, whole_if_short=True)
        yield row, [np.unique(hashed[i:j]) for i, j in zip(first[:-1], first[1:])]


def _parities(tokens: np.ndarray, most: int = 8192, slots: int = 64) -> bytes:
    """Parity of the number of shingles in each of about 2n slots: two sets differ in at least as many shingles as slots."""
    while slots < min(2 * len(tokens), most):
        slots *= 2
    hit = np.bincount((W.mix(tokens, 55) & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(hit.astype(np.uint8)).tobytes()


def _overlap_bound(bits_a: bytes, bits_b: bytes, n_a: int, n_b: int) -> int:
    """The most shingles two sets can have in common, as their parities tell."""
    a, b = np.frombuffer(bits_a, dtype=np.uint8), np.frombuffer(bits_b, dtype=np.uint8)
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return (n_a + n_b - int(np.bitwise_count(a ^ b).sum())) // 2


def _bounded(cfg: JaccardJoin):
    """Keeps the pairs whose parities allow enough overlap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for k, (bits_a, bits_b, n_a, n_b) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("bits_a", "bits_b", "n_a", "n_b")])):
                common = _overlap_bound(bits_a, bits_b, n_a, n_b)
                if 100 * common >= cfg.percent * (n_a + n_b - common):
                    kept.append(k)
            yield batch.select(["a", "b"]).take(pa.array(kept, type=pa.int64()))
    return run


def _in_all_orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs that share a prefix shingle under every further order."""
    for batch in batches:
        kept = [k for k, (a, b) in enumerate(zip(batch.column("orders_a").to_pylist(), batch.column("orders_b").to_pylist())) if all(
            len(np.intersect1d(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), True)) for x, y in zip(a, b))]
        yield batch.select(["a", "b"]).take(pa.array(kept, type=pa.int64()))


def _keys(tokens: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """One 64-bit key per set, of its shingles in any order."""
    sums = np.zeros(len(tokens) + 1, dtype=np.uint64)
    np.cumsum(W.mix(tokens, seed), out=sums[1:])
    border = np.concatenate(([0], np.cumsum(sizes)))
    return W.mix(sums[border[1:]] - sums[border[:-1]], seed).view(np.int64)


def _describe(cfg: JaccardJoin):
    """Rows (kind 0, doc_id, tag, set size, set, key) per document, then (kind 1, slot, .., count) for the count table."""
    names = ["kind", "id", "tag", "n", "set", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        counts = np.zeros(cfg.count_slots, dtype=np.int64)
        for batch in batches:
            ids, tags = batch.column("doc_id"), batch.column("tag")
            for row, sets in _sets(batch.column("text"), cfg):
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                tokens = np.concatenate(sets)
                np.add.at(counts, (tokens % np.uint64(cfg.count_slots)).astype(np.int64), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(sets), dtype=np.int32)), ids.slice(row, len(sets)), tags.slice(row, len(sets)), pa.array(sizes),
                     pa.array(_keys(tokens, sizes, 101)), pa.array(_keys(tokens, sizes, 102))], names=names)
        slots = np.flatnonzero(counts)
        zero = pa.array(np.zeros(len(slots), dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(slots), dtype=np.int32)), pa.array(slots), zero, pa.array(counts[slots]), zero, zero], names=names)
    return run


def _levels(counts: DataFrame, cfg: JaccardJoin) -> np.ndarray:
    """How far each slot's count stands out, as a small number; at most ``count_slots`` rows reach the driver."""
    total = np.zeros(cfg.count_slots, dtype=np.float64)
    summed = counts.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    total[summed.column("id").to_numpy()] = summed.column("n").to_numpy()
    mean = total.mean()
    return np.floor(np.log2(np.maximum((total - mean) / (2 * np.sqrt(mean + 1)), 0.5)) + 1).astype(np.uint64)


def _prefix(tokens: np.ndarray, order: int, levels: np.ndarray, cfg: JaccardJoin) -> np.ndarray:
    """The first shingles of a set in one global order, in that order: rare ones first, then by a hash of the order's own."""
    n = len(tokens)
    keep = n - (cfg.percent * n + 99) // 100 + 1
    rank = (levels[(tokens % np.uint64(len(levels))).astype(np.int64)] << np.uint64(58)) | (W.mix(tokens, order) >> np.uint64(6))
    first = np.argpartition(rank, keep - 1)[:keep] if keep < n else np.arange(n)
    return tokens[first[np.argsort(rank[first])]]


def _new_sets(batches: Iterator[pa.RecordBatch], cfg: JaccardJoin) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(sets, their keys) of the texts, each set that is not empty mostly once."""
    let_go()
    seen: set[int] = set()
    for batch in batches:
        for _, sets in _sets(batch.column("text"), cfg):
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            keys = _keys(np.concatenate(sets), sizes, 101)
            fresh = []
            for k, key in enumerate(keys.tolist()):
                if sizes[k] and key not in seen:
                    seen.add(key)
                    fresh.append(k)
            if len(seen) > cfg.task_sets:
                seen = set()
            if fresh:
                yield [sets[k] for k in fresh], keys[fresh]


def _prefix_tokens(levels, cfg: JaccardJoin):
    """(token, set) of every set's prefix in the first order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets, keys in _new_sets(batches, cfg):
            parts = [_prefix(s, 1, levels.value, cfg) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.repeat(keys, [len(p) for p in parts]))], names=["token", "set"])
    return run


_SKETCH = "token long, set long, n long, place int, nth int, bits binary, orders array<binary>, short array<bigint>, begin array<bigint>"


def _sketches(levels, shared, cfg: JaccardJoin):
    """(token, set, n, place, nth) of prefix shingles that may be shared, then (set, n, bits, orders, short, begin) of their
    sets. ``nth`` counts the shingles of the prefix that may be shared, ``begin`` holds the first of them."""
    names = [c.split()[0] for c in _SKETCH.split(", ")]
    mask = np.uint64(cfg.shared_bits - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets, keys in _new_sets(batches, cfg):
            tokens, owner, places, nth, rows = [], [], [], [], []
            for k, s in enumerate(sets):
                prefix = _prefix(s, 1, levels.value, cfg)
                slot = prefix & mask
                hit = np.flatnonzero((shared.value[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
                if len(hit):
                    tokens.append(prefix[hit])
                    owner.append(np.full(len(hit), k))
                    places.append(hit)
                    nth.append(np.arange(len(hit)))
                    orders = [np.unique((_prefix(s, order, levels.value, cfg) >> np.uint64(32)).astype(np.uint32)).tobytes()
                              for order in range(2, 2 + cfg.more_orders)]
                    rows.append((k, len(s), _parities(s), orders, np.frombuffer(_parities(s, 512, 512), dtype=np.int64),
                                 prefix[hit[:cfg.earlier]].view(np.int64)))
            if not rows:
                continue
            owner, n = np.concatenate(owner), len(np.concatenate(tokens))
            size = np.array([len(s) for s in sets], dtype=np.int64)
            none = [pa.nulls(n, t) for t in (pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(keys[owner]), pa.array(size[owner]),
                 pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(nth).astype(np.int32)), *none], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(rows), pa.int64()), pa.array(keys[[r[0] for r in rows]]), pa.array([r[1] for r in rows], pa.int64()),
                 pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.int32()), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.list_(pa.binary())),
                 pa.array([r[4] for r in rows], pa.list_(pa.int64())), pa.array([r[5] for r in rows], pa.list_(pa.int64()))], names=names)
    return run


def _compare(cfg: JaccardJoin):
    """Keeps the pairs whose sets are similar enough. A run of equal sets on the right is read once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right, kept = batch.column("b").to_numpy(), []
            for row, sets in _sets(batch.column("text_a"), cfg):
                at = np.arange(row, row + len(sets))
                change = at[np.concatenate(([True], right[at[1:]] != right[at[:-1]]))]
                others = (s for _, some in _sets(batch.column("text_b").take(pa.array(change)), cfg) for s in some)
                starts, b = set(change.tolist()), None
                for k, a in zip(at.tolist(), sets):
                    if k in starts:
                        b = next(others)
                    common = len(np.intersect1d(a, b, True))
                    if common and 100 * common >= cfg.percent * (len(a) + len(b) - common):
                        kept.append(k)
            yield batch.select(["a", "b"]).take(pa.array(kept, type=pa.int64()))
    return run


def _fits(cfg: JaccardJoin):
    """Two sets that can be similar enough, as their sizes and the places of a first common shingle have it."""
    least = (F.col("n_a") + F.col("n_b")) * cfg.percent
    left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    return (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * cfg.percent) & (left * (100 + cfg.percent) >= least)


def jaccard_components(docs: DataFrame, staging: Staging, cfg: JaccardJoin = JaccardJoin()) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of every row of ``docs(doc_id, text)``.

    ``class_id`` is the smallest document with the same set, ``component_id`` the smallest one that links reach."""
    with small_batches(docs.sparkSession, cfg.batch_bytes):
        return _components(docs, staging, cfg)


def _components(docs: DataFrame, staging: Staging, cfg: JaccardJoin) -> DataFrame:
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    described = staging.put(docs.mapInArrow(_describe(cfg), "kind int, id long, tag long, n long, set long, key long"), "sets").df
    levels = context.broadcast(_levels(described.where("kind = 1"), cfg))
    rows = described.where("kind = 0")
    # Equal sets are one class; its smallest id, and there its smallest tag, say where its text is.
    classes = rows.where("n > 0 and id is not null").groupBy("set", "key", "n").agg(F.min("id").alias("class_id"))
    classes = staging.put(rows.join(classes, ["set", "key", "n"]).where("id = class_id").groupBy("set", "key", "n", "class_id").agg(
        F.min("tag").alias("tag")), "classes")
    named = docs.where("doc_id is not null")

    tokens = named.mapInArrow(_prefix_tokens(levels, cfg), "token long, set long").groupBy("token").agg(
        F.min("set").alias("low"), F.max("set").alias("high")).where("low < high").select("token")
    tokens = staging.put(tokens, "shared-tokens").df
    shared = context.broadcast(bitmap(tokens, F.col("token"), cfg.shared_bits))
    sketched = staging.put(named.mapInArrow(_sketches(levels, shared, cfg), _SKETCH), "sketches").df
    postings = sketched.where("token is not null").select("token", "set", "n", "place", "nth").join(tokens, "token").groupBy("token", "set", "n").agg(
        F.min("place").alias("place"), F.min("nth").alias("nth"))
    sketches = staging.put(sketched.where("token is null").select("set", "n", "bits", "orders", "short", "begin").dropDuplicates(["set"]), "set-sketches").df

    def ends(pairs: Staged) -> DataFrame:
        """(set) of pairs, for a semi join."""
        sets = pairs.df.select(F.col("a").alias("set")).unionByName(pairs.df.select(F.col("b").alias("set")))
        return F.broadcast(sets.distinct()) if 2 * pairs.rows <= BROADCAST_IDS else sets.distinct()

    def verified(staged: Staged) -> Staged:
        """The pairs ``(a, b)`` of sets that link. Filters first; texts travel only for what they leave."""
        pairs = staged.df
        # The small sketches first: hardly a pair that does not link is left for the larger ones.
        for name, columns, keep in (("bounded", ("n", "bits"), _bounded(cfg)), ("pairs", ("orders",), _in_all_orders)):
            if staged.rows <= cfg.few_pairs:
                break
            # Only the sketches of sets in these pairs are shuffled.
            some = sketches.select("set", *columns).join(ends(staged), "set", "left_semi")
            for side in "ab":
                pairs = pairs.join(some.select(F.col("set").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
            staged = staging.put(few(pairs, staged.rows, cfg.task_pairs).mapInArrow(keep, "a long, b long"), name)
            pairs = staged.df
        sets = classes.df.join(ends(staged), "set", "left_semi")
        places = staging.put(few(sets.select("set", F.col("class_id").alias("doc_id"), "tag"), 2 * staged.rows), "places")
        texts = named.join(met(places), ["doc_id", "tag"]).select("set", "text").dropDuplicates(["set"])
        texts = staging.put(few(texts, places.rows, cfg.task_pairs), "texts").df
        both = pairs.join(texts.select(F.col("set").alias("a"), F.col("text").alias("text_a")), "a").join(
            texts.select(F.col("set").alias("b"), F.col("text").alias("text_b")), "b")
        return staging.put(few(both, staged.rows, cfg.task_pairs).mapInArrow(_compare(cfg), "a long, b long"), "set-links")

    def mixed(members: DataFrame, name: str) -> DataFrame:
        """The members of buckets that hold more than one component."""
        several = members.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        return staging.put(few(members.join(several.select("token"), "token"), buckets.rows), name).df

    differ = F.aggregate(F.zip_with("short_a", "short_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    common = (F.col("n_a") + F.col("n_b") - differ) / 2
    enough = common * (100 + cfg.percent) >= (F.col("n_a") + F.col("n_b")) * cfg.percent

    def side(rows: DataFrame, s: str, *more: str) -> DataFrame:
        return rows.select("token", F.col("set").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "place", *more)])

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def crowd(rows: DataFrame, dense: Staged, *more: str) -> Staged:
        """The members of crowded buckets, with what their sketches tell."""
        return staging.put(few(rows.join(met(dense), "token").join(sketches.select("set", *more), "set"), buckets.rows), "crowded")

    def centred(crowded: DataFrame, turn: int, where, *more: str) -> DataFrame:
        """The pairs of members of crowded buckets with some of the ``k`` members that may be centres, drawn alike in all buckets."""
        draw = F.xxhash64("set", F.lit(turn)).cast("double") / 2.0 ** 64 + 0.5
        drawn = crowded.where(F.col("centre") & (draw * F.col("k") < cfg.centres))
        return side(crowded, "a", "short", *more).join(side(drawn, "b", "short", *more), "token").where(where & _fits(cfg) & enough).select("a", "b")

    # Every member of a bucket meets one of its members, in a crowded bucket some.
    buckets = staging.put(postings, "buckets")
    members = few(buckets.df, buckets.rows)
    drawn = members.withColumn("draw", F.xxhash64("set"))
    chosen = drawn.groupBy("token").agg(*[F.min_by(c, "draw").alias(f"{c}_b") for c in ("n", "place")], F.min_by("set", "draw").alias("b"))
    other = F.col("a") != F.col("b")
    stars = side(members, "a").join(chosen, "token").where(other & _fits(cfg)).select("a", "b")
    sizes = members.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.lit(True).alias("centre"))
    dense = staging.put(few(sizes.where(F.col("k") * (F.col("k") - 1) / 2 > cfg.dense_pairs), buckets.rows), "crowded-tokens")
    if dense.rows:
        stars = stars.unionByName(centred(crowd(members, dense, "short").df, 0, other))
    first = staging.put(few(ordered(stars), buckets.rows), "stars")
    stars, found = first.df, verified(first).df

    apart = F.col("label_a") != F.col("label_b")

    def unlinked(members: DataFrame) -> tuple[DataFrame, Staged]:
        """The members of buckets of several components, and the buckets that stand for many pairs with their largest component."""
        roots = staging.put(connected_components(found, staging).withColumnRenamed("id", "set"), "labels")
        rest = mixed(members.join(met(roots), "set", "left").withColumn("label", F.coalesce("root", "set")).drop("root"), "mixed")
        per_token = rest.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(
            ((F.pow(F.sum("k"), F.lit(2)) - F.sum(F.col("k") * F.col("k"))) / 2).alias("pairs"), F.max(F.struct("k", "label")).alias("top"))
        return rest, staging.put(few(per_token.where(F.col("pairs") > cfg.dense_pairs).select(
            "token", "top.k", F.col("top.label").alias("largest")), buckets.rows), "crowded-tokens")

    rest, dense = unlinked(members)
    # What was not linked meets members of the largest component of its crowded buckets.
    for turn in range(1, cfg.more_stars):
        if not dense.rows:
            break
        crowded = crowd(rest, dense, "short")
        near = ordered(centred(crowded.df.withColumn("centre", F.col("label") == F.col("largest")), turn, apart, "label"))
        near = staging.put(few(near.join(stars, ["a", "b"], "left_anti"), cfg.centres * crowded.rows), "more-stars")
        linked = verified(near)
        stars, found = stars.unionByName(near.df), found.unionByName(linked.df)
        # Without a few last links no more than some pairs meet in vain.
        if linked.rows >= cfg.least_linked:
            rest, dense = unlinked(rest.drop("label"))
        if linked.rows < cfg.least_linked or linked.rows * cfg.members_linked < crowded.rows:
            break

    # Then the members of different components meet; those of crowded buckets only where their parities allow, and
    # where they share no earlier shingle, so that a pair comes once and not for every shingle that it shares.
    apart = (F.col("a") > F.col("b")) & apart & _fits(cfg)
    sparse = rest.join(met(dense), "token", "left_anti")
    pairs = side(sparse, "a", "label").join(side(sparse, "b", "label"), "token").where(apart).select("a", "b")
    if dense.rows:
        crowded = crowd(rest, dense, "short", "begin").df.withColumn("earlier", F.slice("begin", F.lit(1), F.col("nth")))
        met_before = F.coalesce(F.arrays_overlap("earlier_a", "earlier_b"), F.lit(False))
        pairs = pairs.unionByName(tiled_join(*[side(crowded, s, "label", "short", "earlier") for s in "ab"], ["token"], "a", "b", DEFAULT, staging).where(
            apart & enough & ~met_before).select("a", "b"))
    more = verified(staging.put(pairs.distinct().join(stars, ["a", "b"], "left_anti"), "across"))

    # Links between sets, and from every document to its set's smallest one.
    smallest = classes.df.select("set", "class_id")
    links = found.unionByName(more.df)
    for side in "ab":
        links = links.join(smallest.withColumnRenamed("set", side), side).drop(side).withColumnRenamed("class_id", f"doc_{side}")
    members_of = staging.put(rows.join(classes.df.select("set", "key", "n", "class_id"), ["set", "key", "n"], "left").select(
        F.col("id").alias("doc_id"), "n", F.coalesce("class_id", "id").alias("class_id")), "members").df
    same = members_of.where("n > 0 and doc_id != class_id").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    final = connected_components(links.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).unionByName(same), staging)
    return members_of.join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))
