"""Removal of passages that occur more than once, by a relative Lempel-Ziv parse over indexed blocks of all texts.

*Reference blocks.* Every window of ``window`` words picks its smallest ``anchor``-word hash; the windows that pick the
same anchor form a block (about twelve windows, all words they cover). Equal windows pick equal anchors, so every
repeated window lies in two blocks with the same anchor. The index holds each block's words once (as a hash), with the
first of its places as the reference.

*Factors.* A text is factored from left to right: a block that the index knows from another place starts a factor,
which goes on, as one copy, while the text's next block is the next one of the same reference text, too. What the
index knows from nowhere else stays literal.

*Boundaries.* Where a block's anchor is known, but with other words around it, a factor begins or ends inside the block. The
windows there, of one place per block, are compared with those of all other blocks of that anchor. The result is exact: a
word goes if and only if it is covered by a window whose words start at another place too, in the same text or another.

Nothing is gathered by passage: index entries are map-side combined minima, joined back, so copies cost rows, never
pairs. Equal texts are parsed once: whatever a window of theirs holds is found in the other one.

Defined results: a null text has no words and keeps the empty string; texts shorter than a window keep all; equal rows
are two places each, whatever their ids; rows without id keep none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.llm import words as W
from kithline.llm.common import met, small_batches
from kithline.plans.staging import Staged, Staging

_PLACE_BITS = np.uint64(28)
_PLACE_MASK = np.uint64((1 << 28) - 1)


@dataclass(frozen=True)
class SubstringDedup:
    window: int = 35
    anchor: int = 12
    #: Texts that a task remembers, so as to parse each once.
    task_texts: int = 200_000


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have, power = values, 1
    while power * 2 <= width:
        have = np.minimum(have[:-power], have[power:])
        power *= 2
    rest = width - power
    return np.minimum(have[:len(have) - rest], have[rest:]) if rest else have


def _blocks(hashed: np.ndarray, first: np.ndarray, cfg: SubstringDedup):
    """(owner text, first window, windows, anchor hash, block hash) of all texts' blocks, windows as word indexes."""
    counts = np.maximum(np.diff(first) - cfg.window + 1, 0)
    total = int(counts.sum())
    if total == 0:
        return None
    texts = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(total) + np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    grams, _ = W.rolling(hashed, np.array([0, len(hashed)]), cfg.anchor)
    ranked = (grams >> _PLACE_BITS << _PLACE_BITS) | (np.arange(len(grams), dtype=np.uint64) & _PLACE_MASK)
    low = _smallest(ranked, cfg.window - cfg.anchor + 1)[at]
    place = (low & _PLACE_MASK).astype(np.int64)
    begin = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (texts[1:] != texts[:-1]))))
    size = np.diff(np.concatenate((begin, [total])))
    start = at[begin]
    with np.errstate(over="ignore"):
        # The first and the last window hold all words of a block.
        shape = (place[begin] - start).astype(np.uint64) * np.uint64(1_000_003) + size.astype(np.uint64)
        wide = W.windows(hashed, cfg.window)
        block = W.mix(W.mix(wide[start] + W.mix(shape, 7), 8) + wide[start + size - 1], 8)
    return texts[begin], start - first[texts[begin]], size, grams[place[begin]], block


def _places(keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One number per place of a text."""
    return W.mix(keys.view(np.uint64) ^ W.mix(starts.astype(np.uint64), 21), 22).view(np.int64)


_BLOCK = "anchor long, block long, key long, chars long, start int, size int, place long"


def _index(cfg: SubstringDedup):
    """The blocks of every text, mostly once for equal texts."""
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            fresh = []
            for k, row in enumerate(zip(batch.column("key").to_pylist(), batch.column("chars").to_pylist())):
                if row not in seen:
                    seen.add(row)
                    fresh.append(k)
            if len(seen) > cfg.task_texts:
                seen = set()
            some = batch.take(pa.array(fresh, pa.int64()))
            keys, chars = some.column("key").to_numpy(), some.column("chars").to_numpy()
            for row, _, data, borders in W.chunks(some.column("text")):
                words = W.split(data, borders)
                found = _blocks(W.hashes(words), words.first, cfg)
                if found is not None:
                    text, start, size, anchor, block = found
                    key = keys[row + text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(block.view(np.int64)), pa.array(key), pa.array(chars[row + text]),
                         pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(_places(key, start))], names=names)
    return run


def _edge_windows(cfg: SubstringDedup):
    """(window hash, key, chars, start, place) of the windows of the listed blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, chars = batch.column("key").to_numpy(), batch.column("chars").to_numpy()
            ranges = batch.column("ranges")
            for row, to, data, borders in W.chunks(batch.column("text")):
                words = W.split(data, borders)
                wide = W.windows(W.hashes(words), cfg.window)
                listed = ranges.slice(row, to - row)
                start, size = (listed.flatten().field(c).to_numpy().astype(np.int64) for c in ("start", "size"))
                blocks = np.repeat(np.arange(to - row), np.diff(listed.offsets.to_numpy()))
                owner = np.repeat(blocks, size)
                local = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                key = keys[row + owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wide[local + words.first[owner]].view(np.int64)), pa.array(key), pa.array(chars[row + owner]),
                     pa.array(local.astype(np.int32)), pa.array(_places(key, local))], names=["window", "key", "chars", "start", "place"])
    return run


def factors(found: list[dict], window: int) -> list[tuple[int, int, int | None, int | None]]:
    """The greedy parse of a text: (first word, words, reference text, first word there) of each factor.

    ``found`` lists its known blocks and windows (start, size in windows, ref, ref_start). A factor takes in what follows at
    once in the text and in the reference; windows that were found at a boundary continue whatever they touch."""
    out: list[list] = []
    end = None  # first window behind the last factor
    for one in sorted(found, key=lambda f: (f["start"], f["size"])):
        start, size, ref, at = one["start"], one["size"], one["ref"], one["ref_start"]
        last = out[-1] if out else None
        if last is not None and start == end and (ref is None or (last[2] == ref and last[3] - last[0] == at - start)):
            last[1] = start + size - last[0] + window - 1
        else:
            out.append([start, size + window - 1, ref, at])
        end = start + size if end is None else max(end, start + size)
    return [tuple(f) for f in out if f[1] >= window]


def _kept(data: np.ndarray, words: W.Words, borders: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """Per text its kept words, joined by one blank."""
    starts, ends = words.starts[keep], words.ends[keep]
    limit = np.repeat(borders[1:], words.counts)[keep]
    change = np.zeros(len(data) + 2, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(ends + 1, limit), -1)  # with the one space behind the word, if there is one
    taken = np.cumsum(change)[:len(data)] > 0
    spaced = np.where(np.isin(data, W.SPACES), np.uint8(32), data)[taken].tobytes()
    border = np.concatenate(([0], np.cumsum(taken)))[borders]
    return [spaced[i:j].rstrip(b" ") for i, j in zip(border[:-1], border[1:])]


_RANGE = "array<struct<start:int,size:int,ref:long,ref_start:int>>"


def _rewrite(cfg: SubstringDedup, with_text: bool):
    """(doc_id, n_words, n_removed, kept_sha256[, kept, factors]) from texts, their known blocks and windows, and if they have copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            named = "ranges" in batch.schema.names
            for row, to, data, borders in W.chunks(batch.column("text")):
                words = W.split(data, borders)
                cover = np.zeros(len(words.starts) + 1, dtype=np.int64)
                parses: list[list] = []
                for k in range(row, to):
                    first, n = words.first[k - row], int(words.counts[k - row])
                    if named and batch.column("copied")[k].as_py():
                        parse = [(0, n, batch.column("key")[k].as_py(), 0)] if n >= cfg.window else []
                    else:
                        parse = factors(batch.column("ranges")[k].as_py() or [], cfg.window) if named else []
                    for start, size, *_ in parse:
                        cover[first + start] += 1
                        cover[first + start + size] -= 1
                    parses.append(parse)
                gone = np.cumsum(cover)[:-1] > 0
                kept = _kept(data, words, borders, ~gone)
                removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[words.first])
                columns = [ids.slice(row, to - row), pa.array(words.counts), pa.array(removed),
                           pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                if with_text:
                    columns.append(pa.array([k.decode("utf-8") for k in kept]))
                    shape = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref", pa.int64()), ("ref_start", pa.int32())]))
                    columns.append(pa.array([[dict(zip(("start", "words", "ref", "ref_start"), f)) for f in p] for p in parses], shape))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "factors"][:len(columns)])
    return run


def remove_repeated_passages(docs: DataFrame, staging: Staging, cfg: SubstringDedup = SubstringDedup(),
                             with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs(doc_id, text)``.

    With ``with_text`` also ``kept``, the text that is left, and ``factors(start, words, ref, ref_start)``, the parse; ``ref`` is the
    xxhash64 of the reference text, null where a factor was found at a boundary only."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"),
                       F.length(text).cast("long").alias("chars"), text.alias("text"))
    row = ["key", "chars"]
    with small_batches(docs.sparkSession):
        copied = docs.groupBy(*row).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*row, F.lit(True).alias("copied"))
        blocks = docs.mapInArrow(_index(cfg), _BLOCK)
        index = blocks.groupBy("anchor", "block").agg(
            F.min("place").alias("place"), F.max("place").alias("other"), F.min_by("key", "place").alias("ref"),
            F.min_by("start", "place").alias("ref_start"))
        index = staging.put(index, "index").df
        anchors = index.groupBy("anchor").agg(F.count(F.lit(1)).alias("blocks")).where("blocks > 1").select("anchor", F.lit(True).alias("edge"))
        known = index.join(anchors, "anchor", "left").where("edge or place < other").select(
            "block", (F.col("place") < F.col("other")).alias("repeats"), F.coalesce("edge", F.lit(False)).alias("edge"),
            F.col("place").alias("reference"), "ref", "ref_start")
        # Whole blocks become factors; where an anchor has several blocks, the windows of one place of each are compared.
        parsed = staging.put(blocks.join(known, "block").select(
            *row, "start", "size", "repeats", "ref", "ref_start", (F.col("edge") & (F.col("place") == F.col("reference"))).alias("check")),
            "known-blocks").df
        edges = parsed.where("check").groupBy(*row).agg(F.collect_set(F.struct("start", "size")).alias("ranges"))
        edges = staging.put(edges, "edges")
        once = docs.join(met(edges), row).dropDuplicates(row).select(*row, "text", "ranges")
        windows = staging.put(once.mapInArrow(
            _edge_windows(cfg), "window long, key long, chars long, start int, place long"), "windows").df
        twice = windows.groupBy("window").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a < b").select("window")
        found = parsed.where("repeats").select(*row, "start", "size", "ref", "ref_start").unionByName(windows.join(twice, "window").select(
            *row, "start", F.lit(1).alias("size"), F.lit(None).cast("long").alias("ref"), F.lit(None).cast("int").alias("ref_start")))
        ranges = found.groupBy(*row).agg(F.collect_set(F.struct("start", "size", "ref", "ref_start")).alias("ranges"))
        changed = staging.put(ranges.join(copied, row, "full").select(
            *row, F.col("ranges").cast(_RANGE).alias("ranges"), F.coalesce("copied", F.lit(False)).alias("copied")), "factors")

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (
        ", kept string, factors array<struct<start:int,words:int,ref:long,ref_start:int>>" if with_text else "")
    keys = Staged(changed.df.select(*row), changed.rows)
    wanted = docs.join(met(keys), row, "left_semi")
    rewritten = wanted.join(changed.df, row).mapInArrow(_rewrite(cfg, with_text), schema)
    rest = docs.join(met(keys), row, "left_anti").mapInArrow(_rewrite(cfg, with_text), schema)
    return rewritten.unionByName(rest)
