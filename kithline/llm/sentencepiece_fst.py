"""SentencePiece encoding and decoding as shortest paths in a weighted finite-state transducer.

Three transducers are compiled once per worker from a model's piece table: the *normaliser* (a blank becomes the mark
U+2581, one mark is put in front and runs of blanks become one if the model says so), the *pieces* (a trie whose accepting paths emit a piece id), and the *byte fallback*
(a character that is no piece emits its UTF-8 bytes' pieces). Composed with an input they give a lattice over positions,
and the result is its shortest path in the tropical semiring (weights add along a path, the least sum wins).

* ``kind="unigram"``: an arc weighs minus the piece's score; states are positions.
* ``kind="bpe"``: merge tables are not sums of weights, but they are a regular relation on neighbours: a sequence is what
  merging gives if and only if every two neighbouring pieces are what merging gives for their own text. So a state is
  (position, last piece), an arc to a neighbour that merging would not leave weighs infinity, all others nothing, and
  exactly one path stays finite. Which neighbours are allowed is compiled on demand and kept.

A lattice falls apart between two characters that stand next to each other in no piece, as before most blanks and around
punctuation. Each such part is composed once and its path kept (a bounded memo per worker): results do not depend on it.

Defined results: a null or empty text has no ids, and null ids decode to the empty text; ids decode to the text again, with U+2581
itself read as a blank, and with blanks as the normaliser leaves them; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.llm.common import held

MARK = "▁"
#: A part is a run of marks and what follows up to the next mark.
_PART = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_INFINITY = float("inf")
_BLANKS = re.compile(" +")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message in the protocol buffers' wire format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value
    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at:at + size]
        at += size


def _settings(model: bytes) -> tuple[dict, dict]:
    """The last value of each field of a model's trainer (2) and normaliser (3) settings."""
    found: dict[int, dict] = {2: {}, 3: {}}
    for number, value in _fields(model):
        if number in found:
            found[number].update(_fields(value))
    return found[2], found[3]


@dataclass(frozen=True)
class PieceTable:
    """What is needed of a model: pieces with scores by id, and the ids of the 256 bytes."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    kind: str = "bpe"
    #: The model's normaliser: a mark in front, and runs of blanks as one, with none at the ends.
    mark_in_front: bool = True
    one_blank: bool = False

    @staticmethod
    def load(model_file: str | bytes) -> PieceTable:
        """Reads a model, a file or its bytes, on the driver; the table travels with the tasks.

        Kind and normaliser are the model's own. A model that asks for more than this module does, such as a table of
        character replacements, is refused."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(**{"model_proto" if isinstance(model_file, bytes) else "model_file": model_file})
        trainer, normaliser = _settings(model.serialized_model_proto())
        kind = {1: "unigram", 2: "bpe"}.get(trainer.get(3, 1))
        refused = [what for what, wrong in (
            ("a kind other than unigram and bpe", kind is None), ("a table of character replacements", bool(normaliser.get(2))),
            ("blanks that are not escaped", not normaliser.get(5, 1)), ("marks as endings", bool(trainer.get(24, 0))),
            ("no byte fallback", not trainer.get(35, 0))) if wrong]
        if refused:
            raise ValueError(f"not supported in a model: {', '.join(refused)}")
        pieces, byte_ids = {}, {}
        for i in range(model.vocab_size()):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i)] = (i, model.get_score(i))
        return PieceTable(pieces, tuple(byte_ids[b] for b in range(256)), kind, bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)))


class _Memo(dict):
    """Values of at most ``most`` keys in two generations: the older one goes when the younger one is half of it, so what
    is asked for again and again stays."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most, {}

    def recall(self, key):
        """The value of a key that is not in the younger generation; None if it is in neither."""
        value = self.older.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if 2 * (len(self) + 1) > self.most:
            self.older = self.copy()
            self.clear()
        self[key] = value


@dataclass
class Transducer:
    table: PieceTable
    memo_parts: int = 200_000
    memo_atoms: int = 400_000
    memo_pairs: int = 400_000
    _trie: dict = field(default_factory=dict)

    def __post_init__(self):
        self._paths, self._atoms, self._pairs = _Memo(self.memo_parts), _Memo(self.memo_atoms), _Memo(self.memo_pairs)
        for piece, (number, score) in self.table.pieces.items():
            node = self._trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = (piece, number, score)
        # An unknown character costs ten more than the least likely piece, as the library has it.
        self._unknown = 10.0 - min((score for _, score in self.table.pieces.values()), default=0.0)
        self._inner = {piece[k:k + 2] for piece in self.table.pieces for k in range(len(piece) - 1)}
        self._text = {number: piece.replace(MARK, " ").encode("utf-8") for piece, (number, _) in self.table.pieces.items()}
        self._text |= {number: bytes([b]) for b, number in enumerate(self.table.byte_ids)}

    def normalise(self, text: str) -> str:
        if self.table.one_blank:
            text = _BLANKS.sub(" ", text).strip(" ")
        return (MARK if self.table.mark_in_front else "") + text.replace(" ", MARK) if text else ""

    def _merged(self, text: str) -> list[str]:
        """What merging gives: of all neighbours that form a piece, the best-scored pair joins first, leftmost on ties."""
        parts = list(text)
        while True:
            best, at = -_INFINITY, -1
            for k in range(len(parts) - 1):
                found = self.table.pieces.get(parts[k] + parts[k + 1])
                if found is not None and found[1] > best:
                    best, at = found[1], k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _neighbours(self, left: str, right: str) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            known = self._pairs.recall((left, right))
        if known is None:
            known = left + right not in self.table.pieces and self._merged(left + right) == [left, right]
            self._pairs.keep((left, right), known)
        return known

    def _arcs(self, part: str, at: int) -> list[tuple[int, str, float, tuple[int, ...]]]:
        """(next position, piece, weight, ids) of the composed arcs that leave a position."""
        arcs, node, to = [], self._trie, at
        while to < len(part) and (node := node.get(part[to])) is not None:
            to += 1
            if "" in node:
                piece, number, score = node[""]
                arcs.append((to, piece, -score, (number,)))
        if not arcs or arcs[0][0] > at + 1:  # the character itself is no piece
            spelled = tuple(self.table.byte_ids[b] for b in part[at].encode("utf-8", "surrogatepass"))
            arcs.append((at + 1, part[at], self._unknown, spelled))
        return arcs

    def _least_sum(self, part: str) -> tuple[int, ...]:
        """Shortest path with scores as weights; states are positions."""
        chart: list[tuple[float, int, tuple[int, ...]]] = [(_INFINITY, -1, ())] * (len(part) + 1)
        chart[0] = (0.0, -1, ())
        for at in range(len(part)):
            for to, _, weight, ids in self._arcs(part, at):
                if chart[at][0] + weight < chart[to][0]:
                    chart[to] = (chart[at][0] + weight, at, ids)
        path, at = [], len(part)
        while at > 0:
            _, at, ids = chart[at]
            path.append(ids)
        return tuple(i for ids in reversed(path) for i in ids)

    def _only_finite(self, part: str) -> tuple[int, ...]:
        """Shortest path under merging: a position has at most one state whose weight is finite."""
        size, pairs, trie = len(part), self._pairs, self._trie
        state: list[str | None] = [None] * (size + 1)
        state[0] = ""
        back: list[tuple[int, object]] = [(0, 0)] * (size + 1)
        for at in range(size):
            last = state[at]
            if last is None:
                continue
            node, to, alone = trie, at, True
            while to < size and (node := node.get(part[to])) is not None:
                to += 1
                hit = node.get("")
                if hit is not None:
                    alone = alone and to > at + 1
                    piece = hit[0]
                    if at == 0 or (pairs[last, piece] if (last, piece) in pairs else self._neighbours(last, piece)):
                        state[to] = piece
                        back[to] = (at, hit[1])
            if alone and (at == 0 or self._neighbours(last, part[at])):  # the character itself is no piece
                state[at + 1] = part[at]
                back[at + 1] = (at, tuple(self.table.byte_ids[b] for b in part[at].encode("utf-8", "surrogatepass")))
        path, at = [], size
        while at > 0:
            at, ids = back[at]
            path.append(ids)
        return tuple(i for ids in reversed(path) for i in (ids if isinstance(ids, tuple) else (ids,)))

    def shortest_path(self, part: str) -> bytes:
        """Ids along the shortest path of one part's lattice, found between the places that no piece spans."""
        out, begin, inner = [], 0, self._inner
        for at in range(1, len(part) + 1):
            if at == len(part) or part[at - 1:at + 1] not in inner:
                atom = part[begin:at]
                ids = self._atoms.get(atom)
                if ids is None:
                    ids = self._atoms.recall(atom)
                if ids is None:
                    path = self._only_finite(atom) if self.table.kind == "bpe" else self._least_sum(atom)
                    ids = np.array(path, dtype="<i4").tobytes()
                    if len(atom) <= 64:
                        self._atoms.keep(atom, ids)
                out.append(ids)
                begin = at
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        out = []
        for part in _PART.findall(self.normalise(text or "")):
            ids = self._paths.get(part)
            if ids is None:
                ids = self._paths.recall(part)
            if ids is None:
                ids = self.shortest_path(part)
                if len(part) <= 64:
                    self._paths.keep(part, ids)
            out.append(ids)
        return b"".join(out)

    def decode(self, ids) -> str:
        """The inverse transducer: ids to text; the mark put in front is taken off."""
        spelled = b"".join(map(self._text.__getitem__, ids))
        text = spelled.decode("utf-8", "replace")
        return text.removeprefix(" ") if self.table.mark_in_front else text


def _compiled(shared) -> Transducer:
    """The transducer of a broadcast table, compiled once per worker process as long as that runs no other operator."""
    return held(shared.id, lambda: Transducer(shared.value))


@dataclass
class _Shared:
    id: str
    broadcast: object

    @property
    def value(self) -> PieceTable:
        return self.broadcast.value


def _encode(shared: _Shared):
    names = ["doc_id", "n_tokens", "token_ids", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _compiled(shared)
        for batch in batches:
            row = 0
            texts = batch.column("text")
            while row < batch.num_rows:
                start, encoded, same, size = row, [], [], 0
                while row < batch.num_rows and size < 2_000_000:
                    text = texts[row].as_py()
                    ids = machine.encode(text)
                    encoded.append(ids)
                    same.append(machine.decode(np.frombuffer(ids, dtype="<i4").tolist()) == (text or "").replace(MARK, " "))
                    size += len(ids)
                    row += 1
                borders = np.concatenate(([0], np.cumsum([len(e) // 4 for e in encoded])))
                flat = pa.array(np.frombuffer(b"".join(encoded), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, row - start), pa.array(np.diff(borders)), lists, pa.array(same)], names=names)
    return run


def encode(docs: DataFrame, table: PieceTable) -> DataFrame:
    """(doc_id, n_tokens, token_ids, round_trip) per row of ``docs(doc_id, text)``; ``round_trip``: decoding gives the text."""
    import uuid

    shared = _Shared(uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(table))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encode(shared), "doc_id long, n_tokens long, token_ids array<int>, round_trip boolean")


def _decode(shared: _Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _compiled(shared)
        for batch in batches:
            texts = [machine.decode(ids or ()) for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return run


def decode(encoded: DataFrame, table: PieceTable) -> DataFrame:
    """(doc_id, text) of rows ``(doc_id, token_ids)``."""
    import uuid

    shared = _Shared(uuid.uuid4().hex, encoded.sparkSession.sparkContext.broadcast(table))
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "token_ids").mapInArrow(
        _decode(shared), "doc_id long, text string")
