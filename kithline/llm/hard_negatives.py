"""Hard negatives of anchor vectors, read from Hilbert-ordered blocks that zone maps select.

*Blocks.* Components become ``floor(scale * x)``. The vectors are sorted along a Hilbert curve through their ``axes`` most
spread components and written as blocks of ``block_rows`` neighbours. Next to each block lies its zone map: the least
and greatest value of every component, and the labels it holds.

*Bounds.* Interval arithmetic over a zone map bounds the inner products of an anchor with all vectors of a block. An
anchor's own block gives it first results, hence a least score that counts; only blocks whose interval reaches it, and
holds a wanted label, are read for that anchor. So first the nearest vectors of the same label (positives) are found, then
per positive the best vectors of other labels within its window of scores. No vector that counts is left out.

Anchors meet zone maps, and chosen blocks, in packed rows of many anchors each, so that one meeting is one matrix product.
Nothing is collected: thresholds travel in the packed rows, and best lists are cut in the task before they are merged.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; vectors meet only
those of their length (empty ones have product 0); scaled components are held within +-2**28; rows with the same id, or
equal in all columns, are rows of their own, of which each is an anchor, a positive or a negative; a row without id is
never an anchor and comes last among equal scores; an anchor without positives, or a window without vectors, gives no row;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kithline.llm.common import met
from kithline.plans.staging import Staged, Staging

#: Stands in for a missing id while ids are compared; scores below any other.
_NO_ID = 2**63 - 1
_NO_SCORE = -(2**63)
_LIMIT = 2.0**28


@dataclass(frozen=True)
class HardNegatives:
    scale: int = 256
    #: Rows whose id this divides are anchors.
    every: int = 100
    positives: int = 5
    negatives: int = 10
    #: A negative's score, in percent of its positive's.
    low: int = 30
    high: int = 90
    axes: int = 8
    bits: int = 7
    block_rows: int = 1024
    #: Blocks that are written together, and anchors that are packed together.
    zone_blocks: int = 64
    chunk_anchors: int = 512


def _numbers(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _array(data: bytes, dtype=np.int64) -> np.ndarray:
    return np.frombuffer(data, dtype=dtype)


def _prepare(cfg: HardNegatives):
    """(vec_id, label, dim, vector) of the rows that take part; ``vector`` holds the scaled components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.values.slice(lists.offsets[0].as_py(), int(sizes.sum()))
            values = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
            bad = ~np.isfinite(values)
            first = np.concatenate(([0], np.cumsum(sizes)))
            wrong = np.concatenate(([0], np.cumsum(bad)))[first]
            good = (np.diff(wrong) == 0) & np.asarray(lists.is_valid()) & np.asarray(batch.column("label").is_valid())
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.clip(np.floor(values * cfg.scale), -_LIMIT, _LIMIT)
            scaled = np.where(bad, 0, scaled).astype(np.int32)
            kept = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(kept)), batch.column("label").take(pa.array(kept)),
                 pa.array(sizes[kept].astype(np.int32)),
                 pa.array([_numbers(scaled[first[k]:first[k + 1]]) for k in kept], type=pa.binary())],
                names=["vec_id", "label", "dim", "vector"])
    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, axis, n, total, squares, low, high) of a task's vectors."""
    sums: dict[int, list] = {}
    for batch in batches:
        dims, vectors = batch.column("dim").to_numpy(), batch.column("vector")
        for dim in np.unique(dims[dims > 0]):
            rows = vectors.take(pa.array(np.flatnonzero(dims == dim)))
            x = _array(b"".join(rows.to_pylist()), np.int32).reshape(-1, dim).astype(np.float64)
            part = [float(len(x)), x.sum(0), (x * x).sum(0), x.min(0), x.max(0)]
            have = sums.get(int(dim))
            sums[int(dim)] = part if have is None else [
                have[0] + part[0], have[1] + part[1], have[2] + part[2], np.minimum(have[3], part[3]), np.maximum(have[4], part[4])]
    for dim, (n, total, squares, low, high) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(dim, dim, dtype=np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, n)),
             pa.array(total), pa.array(squares), pa.array(low), pa.array(high)],
            names=["dim", "axis", "n", "total", "squares", "low", "high"])


def hilbert_key(places: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits``-bit coordinates (rows of ``places``), after Skilling (2004)."""
    x = places.astype(np.int64).T.copy()
    n = len(x)
    if n == 0:
        return np.zeros(places.shape[0], dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess turns of all finer cubes
        low = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _curve(cfg: HardNegatives):
    """Adds the place on the curve of the vector's length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vectors, ranges = batch.column("dim").to_numpy(), batch.column("vector"), batch.column("ranges")
            key = np.zeros(batch.num_rows, dtype=np.int64)
            for dim in np.unique(dims[dims > 0]):
                rows = np.flatnonzero(dims == dim)
                x = _array(b"".join(vectors.take(pa.array(rows)).to_pylist()), np.int32).reshape(-1, dim)
                axes = ranges[int(rows[0])].as_py()
                places = np.zeros((len(rows), len(axes)), dtype=np.int64)
                for k, r in enumerate(axes):
                    share = (x[:, r["axis"]] - r["low"]) / max(r["high"] - r["low"] + 1, 1)
                    places[:, k] = np.floor(share * (1 << cfg.bits))
                key[rows] = hilbert_key(places, cfg.bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "vec_id", "label", "dim", "vector")] + [pa.array(key)],
                names=["row", "vec_id", "label", "dim", "vector", "place"])
    return run


_BLOCK = ("zone int, block long, dim int, rows binary, ids binary, labels binary, vectors binary, "
          "low binary, high binary, present binary")


def _pack_blocks(cfg: HardNegatives):
    """Blocks of neighbours, each with its zone map; a block's rows are in order of their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zone, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            row, labels = batch.column("row").to_numpy(), batch.column("label").to_numpy()
            ids, vectors = batch.column("vec_id").to_numpy(), batch.column("vector")
            cuts = np.flatnonzero(np.concatenate((dims[1:] != dims[:-1], [True]))) + 1 if len(dims) else []
            begin, out = 0, []
            for end in cuts:
                for at in range(begin, end, cfg.block_rows):
                    to, dim = min(at + cfg.block_rows, end), int(dims[at])
                    order = at + np.lexsort((row[at:to], ids[at:to]))
                    x = _array(b"".join(vectors.take(pa.array(order)).to_pylist()), np.int32).reshape(len(order), dim)
                    out.append((zone, (zone << 32) + made, dim, _numbers(row[order]), _numbers(ids[order]),
                                _numbers(labels[order].astype(np.int64)), _numbers(x), _numbers(x.min(0)), _numbers(x.max(0)),
                                _numbers(np.unique(labels[order]).astype(np.int64))))
                    made += 1
                begin = end
            types = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 7
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], type=t) for k, t in enumerate(types)],
                                             names=[c.split()[0] for c in _BLOCK.split(", ")])
    return run


def write_blocks(vectors: DataFrame, staging: Staging, cfg: HardNegatives) -> Staged:
    """The blocks and zone maps of all vectors that take part."""
    schema = "vec_id long, label long, dim int, vector binary"
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
    # A number per row, fixed by writing it: equal rows stay apart, and are dealt to different tasks.
    rows = staging.put(clean.mapInArrow(_prepare(cfg), schema).select(
        F.monotonically_increasing_id().alias("row"), F.coalesce("vec_id", F.lit(_NO_ID)).alias("vec_id"),
        "label", "dim", "vector"), "vectors")
    spread = rows.df.select("dim", "vector").mapInArrow(
        _spread, "dim int, axis int, n double, total double, squares double, low double, high double")
    spread = spread.groupBy("dim", "axis").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")], F.min("low").alias("low"),
                                               F.max("high").alias("high"))
    variance = F.col("squares") / F.col("n") - (F.col("total") / F.col("n")) * (F.col("total") / F.col("n"))
    widest = Window.partitionBy("dim").orderBy(variance.desc(), "axis")
    axes = staging.put(spread.withColumn("k", F.row_number().over(widest)).where(F.col("k") <= cfg.axes).groupBy("dim").agg(
        F.array_sort(F.collect_list(F.struct("k", "axis", "low", "high"))).alias("ranges")), "axes")
    placed = rows.df.join(met(axes), "dim", "left").mapInArrow(
        _curve(cfg), "row long, vec_id long, label long, dim int, vector binary, place long")
    order = ["dim", "place", "vec_id", "row"]
    zones = max(1, -(-rows.rows // (cfg.block_rows * cfg.zone_blocks)), min(8, -(-rows.rows // cfg.block_rows)))
    sorted_ = placed.repartitionByRange(zones, *order).sortWithinPartitions(*order)
    return staging.put(sorted_.mapInArrow(_pack_blocks(cfg), _BLOCK), "blocks")


def _anchors(cfg: HardNegatives):
    """(row, vec_id, label, dim, vector, block) of the anchors in a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, dim, rows, ids, labels, vectors in zip(*[batch.column(c).to_pylist() for c in (
                    "block", "dim", "rows", "ids", "labels", "vectors")]):
                ids, x = _array(ids), _array(vectors, np.int32)
                hit = np.flatnonzero((ids % cfg.every == 0) & (ids != _NO_ID))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_array(rows)[hit]), pa.array(ids[hit]), pa.array(_array(labels)[hit]),
                     pa.array(np.full(len(hit), dim, dtype=np.int32)),
                     pa.array([_numbers(x[k * dim:(k + 1) * dim]) for k in hit], type=pa.binary()),
                     pa.array(np.full(len(hit), block, dtype=np.int64))],
                    names=["row", "vec_id", "label", "dim", "vector", "block"])
    return run


_CHUNK = "chunk long, dim int, rows binary, labels binary, vectors binary, own binary, least binary, scores binary"


def _pack_anchors(cfg: HardNegatives):
    """Packed anchors. ``least`` and ``scores`` are lists of one length per anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out = []
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), cfg.chunk_anchors):
                    some = batch.take(pa.array(rows[at:at + cfg.chunk_anchors]))
                    lists = [np.array(some.column(c).to_pylist(), dtype=np.int64) for c in ("row", "label", "block", "least", "scores")]
                    out.append(((part << 32) + made, int(dim), _numbers(lists[0]), _numbers(lists[1]),
                                b"".join(some.column("vector").to_pylist()), *[_numbers(v) for v in lists[2:]]))
                    made += 1
            types = [pa.int64(), pa.int32()] + [pa.binary()] * 6
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], type=t) for k, t in enumerate(types)],
                                             names=[c.split()[0] for c in _CHUNK.split(", ")])
    return run


def _own_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, block, who) of the blocks that a chunk's anchors come from."""
    for batch in batches:
        out = []
        for chunk, own in zip(batch.column("chunk").to_pylist(), batch.column("own").to_pylist()):
            own = _array(own)
            out += [(chunk, int(block), _numbers(np.flatnonzero(own == block).astype(np.int32))) for block in np.unique(own)]
        yield _visits(out)


def _visits(out: list) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], type=t) for k, t in enumerate(types)], names=["chunk", "block", "who"])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows of ``a`` with rows of ``b``: as floating point numbers where these hold them."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval arithmetic: least and greatest product of each anchor with any vector between ``low`` and ``high``."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _product(up, low) + _product(down, high), _product(up, high) + _product(down, low)


def _windows(scores: np.ndarray, least: np.ndarray, cfg: HardNegatives) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each window; a missing positive's window holds nothing. Exact without wide products."""
    there = scores != _NO_SCORE
    whole, rest = np.divmod(np.where(there, scores, 0), 100)
    bottom = np.maximum(whole * cfg.low - (-rest * cfg.low) // 100, least)
    return np.where(there, bottom, 1), np.where(there, whole * cfg.high + rest * cfg.high // 100, 0)


def _select(cfg: HardNegatives, windows: bool):
    """(chunk, block, who): the blocks that an anchor has to read, from zone maps alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                dim, blocks = row["dim"], row["maps"]
                labels, n = _array(row["labels"]), len(row["labels"]) // 8
                a = _array(row["vectors"], np.int32).reshape(n, dim)
                low = _array(b"".join(m["low"] for m in blocks), np.int32).reshape(len(blocks), dim)
                high = _array(b"".join(m["high"] for m in blocks), np.int32).reshape(len(blocks), dim)
                least_score, most_score = bounds(a, low, high)
                least = _array(row["least"]).reshape(n, -1)
                if windows:
                    bottom, top = _windows(_array(row["scores"]).reshape(n, -1), least, cfg)
                    reach = np.zeros(most_score.shape, dtype=bool)
                    for slot in np.flatnonzero((bottom <= top).any(0)):
                        reach |= ((most_score >= bottom[:, slot, None]) & (least_score <= top[:, slot, None])
                                  & (bottom <= top)[:, slot, None])
                else:
                    reach = most_score >= least
                for k, block in enumerate(blocks):
                    present = _array(block["present"])
                    if windows:
                        may = ~np.isin(labels, present) if len(present) == 1 else np.ones(n, dtype=bool)
                    else:
                        may = np.isin(labels, present)
                    who = np.flatnonzero(reach[:, k] & may)
                    if len(who):
                        out.append((row["chunk"], block["block"], _numbers(who.astype(np.int32))))
            yield _visits(out)
    return run


_FOUND = "anchor long, slot int, score long, id long, row long"


def _read(cfg: HardNegatives, windows: bool):
    """(anchor, slot, score, id, row): the best rows of a block for each anchor that reads it, and for each of its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                dim = one["dim"]
                who = _array(one["who"], np.int32)
                n = len(one["a_rows"]) // 8
                a = _array(one["a_vectors"], np.int32).reshape(n, dim)[who]
                rows, ids = _array(one["rows"]), _array(one["ids"])
                x = _array(one["vectors"], np.int32).reshape(len(rows), dim)
                score = _product(a, x)
                alike = _array(one["a_labels"])[who][:, None] == _array(one["labels"])[None, :]
                me = _array(one["a_rows"])[who]
                least = _array(one["least"]).reshape(n, -1)[who]
                out: list[tuple] = []
                if windows:
                    bottom, top = _windows(_array(one["scores"]).reshape(n, -1)[who], least, cfg)
                    for i in range(len(who)):
                        others = np.flatnonzero(~alike[i] & (score[i] >= bottom[i].min()) & (score[i] <= top[i].max()))
                        order = others[np.argsort(-score[i, others], kind="stable")]
                        begin = np.searchsorted(-score[i, order], -top[i])
                        end = np.searchsorted(-score[i, order], -bottom[i], side="right")
                        for slot in range(bottom.shape[1]):
                            out += [(i, slot, j) for j in order[begin[slot]:min(end[slot], begin[slot] + cfg.negatives)]]
                else:
                    for i in range(len(who)):
                        same = np.flatnonzero(alike[i] & (rows != me[i]) & (score[i] >= least[i, 0]))
                        out += [(i, 0, j) for j in same[np.argsort(-score[i, same], kind="stable")][:cfg.positives]]
                i, slot, j = np.array(out, dtype=np.int64).reshape(-1, 3).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(me[i]), pa.array(slot.astype(np.int32)), pa.array(score[i, j]), pa.array(ids[j]), pa.array(rows[j])],
                    names=["anchor", "slot", "score", "id", "row"])
    return run


def mine(vectors: DataFrame, staging: Staging, cfg: HardNegatives = HardNegatives()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors(vec_id, embedding, label)``."""
    blocks = write_blocks(vectors, staging, cfg).df
    zones = staging.put(blocks.groupBy("zone", "dim").agg(
        F.collect_list(F.struct("block", "low", "high", "present")).alias("maps")), "zone-maps").df
    last_zone = zones.agg(F.coalesce(F.max("zone"), F.lit(0))).first()[0]
    anchors = staging.put(blocks.select("block", "dim", "rows", "ids", "labels", "vectors").mapInArrow(
        _anchors(cfg), "row long, vec_id long, label long, dim int, vector binary, block long"), "anchors").df

    def packed(least: DataFrame | None, scores: DataFrame | None) -> Staged:
        """The anchors in packed rows, with the scores that rows must reach and those of the positives."""
        rows = anchors
        for name, lists, width in (("least", least, 1 if scores is None else cfg.positives), ("scores", scores, cfg.positives)):
            nothing = F.array_repeat(F.lit(_NO_SCORE), width)
            rows = rows.withColumn(name, nothing) if lists is None else rows.join(
                lists.withColumnRenamed("anchor", "row"), "row", "left").withColumn(name, F.coalesce(name, nothing))
        return staging.put(rows.mapInArrow(_pack_anchors(cfg), _CHUNK), "anchor-chunks")

    def lists(rows: DataFrame, column: str, name: str) -> DataFrame:
        """Per anchor the values by slot, as a list of one length."""
        slots = [F.coalesce(F.max(F.when(F.col("slot") == k, F.col(column))), F.lit(_NO_SCORE)) for k in range(cfg.positives)]
        return rows.groupBy("anchor").agg(F.array(*slots).alias(name))

    def own(chunks: Staged) -> DataFrame:
        return chunks.df.mapInArrow(_own_blocks, "chunk long, block long, who binary")

    def selected(chunks: Staged, windows: bool) -> DataFrame:
        # Every packed row of anchors meets every zone: the stated queries against all rows, in blocks.
        dealt = chunks.df.withColumn("zone", F.explode(F.sequence(F.lit(0), F.lit(last_zone))))
        return dealt.join(zones, ["zone", "dim"]).select("chunk", "dim", "labels", "vectors", "least", "scores", "maps").mapInArrow(
            _select(cfg, windows), "chunk long, block long, who binary")

    def read(chunks: Staged, visits: DataFrame, windows: bool) -> DataFrame:
        """The best rows, over all blocks that are read, of each anchor and window."""
        packs = chunks.df.select("chunk", *[F.col(c).alias(f"a_{c}") for c in ("rows", "labels", "vectors")], "least", "scores")
        who = staging.put(visits, "visits").df.join(packs, "chunk")
        both = blocks.select("block", "dim", "rows", "ids", "labels", "vectors").join(who, "block")
        best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
        return both.mapInArrow(_read(cfg, windows), _FOUND).withColumn("rank", F.row_number().over(best)).where(
            F.col("rank") <= (cfg.negatives if windows else cfg.positives))

    # First results come from each anchor's own block; the last of them is the score that any other row has to reach.
    chunks = packed(None, None)
    least = read(chunks, own(chunks), False).where(F.col("rank") == cfg.positives).select("anchor", F.array("score").alias("least"))
    chunks = packed(least, None)
    positives = staging.put(read(chunks, selected(chunks, False), False).select(
        "anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive"), F.col("score").alias("p")), "positives").df
    scores = lists(positives, "p", "scores")
    chunks = packed(None, scores)
    least = lists(read(chunks, own(chunks), True).where(F.col("rank") == cfg.negatives), "score", "least")
    chunks = packed(least, scores)
    negatives = read(chunks, selected(chunks, True), True)
    id_ = {c: F.nullif(F.col(c), F.lit(_NO_ID)) for c in ("positive", "id")}
    return negatives.join(positives, ["anchor", "slot"]).join(
        anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor_id", id_["positive"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), id_["id"].alias("negative_id"),
        F.col("p").alias("positive_score"), F.col("score").alias("negative_score"))
