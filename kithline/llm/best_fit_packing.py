"""Best-fit packing of tokenized documents into sequences, with certified numbers of sequences.

*Pieces.* A document's token ids and one closing id are cut at the sequence length; only longer documents have several
pieces, of which the last may be short.

*Packing.* Every input partition packs its own pieces best-fit decreasing, without a shuffle. Dual-feasible functions give a
lower bound of the sequences that its lengths need. Where the bound is met, the partition's number is certified and only
its emptiest sequence is opened again; where a gap is left, every sequence that is not full is. Opened sequences are
exchanged (whole ones, so a partition knows what it must not exceed), and packed again best-fit decreasing together with
those of other partitions. This goes on until the number of all sequences meets the bound of all lengths, or nothing is saved.

Memory of a task is that of its partition's pieces, as numbers; sequences never travel to the driver. The histogram of
lengths, from which the bounds come, has as many entries as a sequence has tokens.

Defined results: a null or empty text is one piece that holds the closing id only; equal rows, and rows that share an id or
have none, are documents of their own; an empty table has no pieces; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.plans.staging import Staging


@dataclass(frozen=True)
class Packing:
    capacity: int = 2048
    #: Id after each document.
    closing: int = 0
    most_rounds: int = 8
    #: Opened pieces that one task packs again.
    pieces_per_task: int = 50_000
    #: Words whose ids a task remembers, at most twice as many.
    memory_words: int = 150_000
    #: Texts are encoded word by word; a longer word is encoded without being remembered.
    longest_word: int = 64


#: Texts of these characters only (ASCII and Latin letters that no normal form changes) are split as the model splits them.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-įı-ſ]*")
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\t-\r 0-9a-zß-öø-ſ]+")


#: The printable character that stands for each byte in a byte-level vocabulary: itself, or one of those from 256 on.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: b for b in _OWN} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_OWN)))}


class WordIds:
    """Token ids of texts, word by word; known words are remembered in two generations, of which the older one is dropped.

    Plain texts are split by the model's own pattern, and a new word goes to its merges alone. Other texts are cut at blanks,
    tabs and line feeds only, which its pattern never crosses and its normaliser composes with nothing, so a part's
    ids do not depend on its neighbours; new parts go through the whole tokenizer."""

    def __init__(self, model: str, cfg: Packing):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(model)
        self._encode, self._merge = tokenizer.encode, tokenizer.model.tokenize
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._cfg = cfg

    @staticmethod
    def _parts(text: str) -> tuple[list[str], bool]:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return _SPLIT.findall(text.lower()), True
        return text.replace("\n", " ").replace("\t", " ").split(" "), False

    def _learn(self, part: str, plain: bool) -> bytes:
        if not plain:
            return array("I", self._encode(part, add_special_tokens=False).ids).tobytes()
        if not part.isascii():
            part = part.encode("utf-8").decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [token.id for token in self._merge(part)]).tobytes()

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        (parts, plain), known, older = self._parts(text), self._known, self._older
        long = []
        for part in set(parts).difference(known):
            known[part] = older[part] if part in older else self._learn(part, plain)
            if len(part) > self._cfg.longest_word:
                long.append(part)
        found = b"".join([known[part] for part in parts])
        for part in long:
            del known[part]
        if len(known) > self._cfg.memory_words:
            self._known, self._older = {}, known
        return found


# -- Bounds -------------------------------------------------------------------------------------------------------------

def lower_bound(histogram: np.ndarray, most_k: int = 100) -> int:
    """Sequences that pieces of these lengths need at least. ``histogram[x]`` counts the pieces of length x, up to the capacity.

    Three families of dual-feasible functions (Fekete and Schepers, 2001) in whole numbers: rounded multiples, lengths with
    small ones left out and large ones filled up, and rounding by a unit."""
    capacity = len(histogram) - 1
    x = np.flatnonzero(histogram)
    if len(x) == 0:
        return 0
    count = histogram[x].astype(object)

    def needed(values: np.ndarray, full: int) -> int:
        return -(-int((values.astype(object) * count).sum()) // full)

    best = needed(x, capacity)
    for k in range(1, min(most_k, capacity) + 1):
        whole = ((k + 1) * x) % capacity == 0
        best = max(best, needed(np.where(whole, x * k, (k + 1) * x // capacity * capacity), k * capacity))
    # Thresholds matter only where a length, or what it leaves, lies.
    units = np.unique(np.concatenate((x, capacity - x, capacity - x + 1, [1])))
    for unit in units[(units > 0) & (2 * units <= capacity)]:
        best = max(best, needed(np.where(x > capacity - unit, capacity, np.where(x < unit, 0, x)), capacity))
        most = capacity // unit
        large = 2 * (most - (capacity - x) // unit)
        best = max(best, needed(np.where(2 * x > capacity, large, np.where(2 * x == capacity, most, 2 * (x // unit))), 2 * most))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length, longest first into the fullest bin that has room, and the room left in each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by their room
    rooms, room_left = 0, []  # bit r: some bin has room r
    for k, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = waiting[room].pop()
            if not waiting[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(room_left)
            room_left.append(capacity)
        bins[k], offsets[k] = at, capacity - room
        room -= length
        room_left[at] = room
        if room:
            waiting[room].append(at)
            rooms |= 1 << room
    return bins, offsets, np.array(room_left, dtype=np.int64)


# -- Pieces and sequences -----------------------------------------------------------------------------------------------

_PIECE = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long, open boolean"


def _cut(batch: pa.RecordBatch, encoder: WordIds, cfg: Packing, with_ids: bool) -> pa.RecordBatch:
    """The pieces of a batch of documents."""
    closing = np.array([cfg.closing], dtype="<u4").tobytes()
    width = 4 * cfg.capacity
    columns: list[list] = [[] for _ in _PIECE]
    for k, text in enumerate(batch.column("text")):
        ids = encoder.ids(text.as_py() or "") + closing
        for piece, at in enumerate(range(0, len(ids), width)):
            part = ids[at:at + width]
            for column, value in zip(columns, (k, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None)):
                column.append(value)
    owner = pa.array(columns[0], pa.int64())
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(owner)] + [pa.array(c, t) for c, t in zip(columns[1:], types)], names=_PIECE)


def _placed(pieces: pa.Table, round_: int, held: np.ndarray | None, cfg: Packing) -> pa.Table:
    """The pieces with their places. Packed anew unless that takes more sequences than the pieces came in."""
    lengths = pieces.column("length").to_numpy()
    bins, offsets, room = best_fit(lengths, cfg.capacity)
    if held is not None:
        before, where = np.unique(held, return_inverse=True)
        if len(before) < len(room):
            bins, offsets = where, pieces.column("offset").to_numpy()
            room = cfg.capacity - np.bincount(bins, weights=lengths, minlength=len(before)).astype(np.int64)
    bound = lower_bound(np.bincount(lengths, minlength=cfg.capacity + 1))
    # Certified: at most one sequence goes on. With a gap, all that are not full do.
    again = room > 0
    if len(room) == bound and again.any():
        again = np.arange(len(room)) == np.argmax(room)
    sequence = bins + ((round_ << 56) | (TaskContext.get().partitionId() << 32) if TaskContext.get() else 0)
    plain = pieces.select(_PIECE)
    for name, values in (("sequence_id", sequence), ("offset", offsets), ("open", again[bins])):
        plain = plain.append_column(name, pa.array(values))
    return plain


def _first(model: str, cfg: Packing, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, found = None, []
        for batch in batches:
            encoder = encoder or WordIds(model, cfg)
            found.append(_cut(batch, encoder, cfg, with_ids))
        if found:
            yield from _placed(pa.Table.from_batches(found), 0, None, cfg).to_batches(max_chunksize=10_000)
    return run


def _again(round_: int, cfg: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if found:
            pieces = pa.Table.from_batches(found)
            yield from _placed(pieces, round_, pieces.column("sequence_id").to_numpy(), cfg).to_batches(max_chunksize=10_000)
    return run


def certificate(placed: DataFrame, cfg: Packing = Packing()) -> tuple[int, int]:
    """(sequences, lower bound) of packed pieces; the histogram that reaches the driver has ``capacity`` rows."""
    sequences = placed.where("offset = 0").count()
    histogram = np.zeros(cfg.capacity + 1, dtype=np.int64)
    for length, n in placed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        histogram[length] = n
    return sequences, lower_bound(histogram)


def pack(docs: DataFrame, model: str, staging: Staging, cfg: Packing = Packing(), with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset) of every piece of ``docs(doc_id, text)``.

    ``model`` is a file of the ``tokenizers`` library that every executor has; ``ids`` is null unless ``with_ids``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    state = staging.put(docs.mapInArrow(_first(model, cfg, with_ids), _PLACED), "packed").df
    settled = [state.where("not open")]
    sequences, bound = certificate(state, cfg)
    for round_ in range(1, cfg.most_rounds + 1):
        left = state.where("open")
        size = left.agg(F.count(F.lit(1)), F.count(F.when(F.col("offset") == 0, 1))).first()
        if sequences == bound or size[1] < 2:
            break
        # Whole sequences are dealt, other ones to each other in every round.
        tasks = -(-size[0] // cfg.pieces_per_task)
        dealt = left.repartition(tasks, F.xxhash64("sequence_id", F.lit(round_))).coalesce(tasks)
        state = staging.put(dealt.mapInArrow(_again(round_, cfg), _PLACED), "packed-again").df
        settled.append(state.where("not open"))
        saved = size[1] - state.where("offset = 0").count()
        sequences -= saved
        if saved == 0 and round_ > 2:
            break
    settled.append(state.where("open"))
    placed = settled[0]
    for part in settled[1:]:
        placed = placed.unionByName(part)
    return placed.drop("open")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, docs, ids) of every packed sequence, from pieces with ids; a sequence has ``capacity`` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])).alias("docs"),
        F.expr("aggregate(parts, cast('' as binary), (b, p) -> b || p.ids)").alias("ids"))
