"""Language identification by cross-parsing entropy against suffix automata of labelled text.

For each language an automaton of all substrings of a reference text is built. A text is parsed greedily against it:
a phrase is the longest match from the present character on; the next phrase begins at the character that broke it.
Few phrases per character mean that the text is made of what the language is made of (Ziv and Merhav, 1993). The language
with the fewest phrases, divided by the phrases that its own labelled text needs, wins.

Characters are lower-cased letters; whatever is no letter counts as a blank, and several blanks as one.

Reference texts are a bounded sample: of the distinct labelled texts that may be learnt from, those first in hash order are
taken until ``reference_chars`` letters per language are there. Every letter is a symbol of its own, in any script; the
automata's transitions stand in one hash table, so its size follows from the references and not from the alphabet.
All texts are parsed in lockstep, whole, in lines of ``line`` characters whose ends also end a phrase.

Defined results: a text that is null or has no letter is ``und`` with score 0; equal phrase rates go to the first
language in alphabetical order; a null label is not learnt from; with no labels at all every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithline.llm.common import let_go

UNKNOWN = "und"
#: Rows of a batch that are turned into texts at once.
PART_ROWS = 1_000


@dataclass(frozen=True)
class CrossParsing:
    #: Reference characters per language.
    reference_chars: int = 40_000
    #: Characters per language, of other labelled rows, that give the usual phrase rate of the language.
    calibration_chars: int = 20_000
    #: Labelled rows per language that reach the driver, twice as many at most.
    sample_rows: int = 100
    #: Texts longer than this are drawn (a few, and whole as all are) only for a language that has no shorter one.
    longest_drawn: int = 5_000
    long_rows: int = 4
    #: More labels than this are taken for a fault of the column.
    most_languages: int = 2_000
    #: Columns of a dense transition table, for callers that bring one; ``fit`` has no limit on letters.
    alphabet: int = 47
    line: int = 1024
    #: Steepness of the score: the share of the winner when phrase rates are turned into likelihoods.
    sharpness: float = 25.0


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _states(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions per state of the suffix automaton of a text; state 1 is the root, 0 means no transition."""
    rows: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in symbols.tolist():
        rows.append({})
        link.append(0)
        length.append(length[last] + 1)
        new = len(rows) - 1
        p = last
        while p and c not in rows[p]:
            rows[p][c] = new
            p = link[p]
        if p == 0:
            link[new] = 1
        else:
            q = rows[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                rows.append(dict(rows[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                clone = len(rows) - 1
                while p and rows[p].get(c) == q:
                    rows[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return rows


def _automaton(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """The automaton as a dense table (states x alphabet)."""
    rows = _states(symbols)
    goto = np.zeros((len(rows), alphabet), dtype=np.int32)
    for state, row in enumerate(rows):
        for c, target in row.items():
            goto[state, c] = target
    return goto


class Transitions:
    """(state, symbol) -> state, as a hash table with open addressing; at most half of it is in use."""

    def __init__(self, states: np.ndarray, symbols: np.ndarray, targets: np.ndarray):
        keys = states.astype(np.int64) << 21 | symbols.astype(np.int64)
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.targets = np.zeros(1 << bits, dtype=np.int32)
        at, targets = self._home(keys), targets.astype(np.int32)
        while len(keys):
            slots, first = np.unique(at, return_index=True)
            first = first[self.keys[slots] < 0]
            self.keys[at[first]], self.targets[at[first]] = keys[first], targets[first]
            left = np.ones(len(keys), dtype=bool)
            left[first] = False
            keys, targets, at = keys[left], targets[left], (at[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def follow(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next states; 0 where there is no transition."""
        keys = (states << 21 | symbols).reshape(-1)
        at = self._home(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.targets[at], 0)
        rest = np.flatnonzero((there != keys) & (there >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & self.mask
            there = self.keys[at[rest]]
            hit = there == keys[rest]
            out[rest[hit]] = self.targets[at[rest[hit]]]
            rest = rest[~hit & (there >= 0)]
        return out.reshape(states.shape).astype(np.int64)


@dataclass
class Model:
    """Automata of all languages one behind the other in one table, and what is needed to read text."""

    languages: list[str]
    symbol: np.ndarray
    table: Transitions | np.ndarray
    roots: np.ndarray
    usual: np.ndarray
    config: CrossParsing

    def __post_init__(self):
        if isinstance(self.table, np.ndarray):
            states, symbols = np.nonzero(self.table)
            self.table = Transitions(states, symbols, self.table[states, symbols])

    def read(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the characters, and the texts' lengths in symbols."""
        symbols = self.symbol[codes]
        solid = symbols != 0
        solid[1:] |= symbols[:-1] != 0
        kept = np.concatenate(([0], np.cumsum(solid)))
        borders = np.concatenate(([0], np.cumsum(lengths)))
        return symbols[solid].astype(np.int64), np.diff(kept[borders])

    def phrases(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases per text and language of texts whose characters stand one behind the other."""
        cfg = self.config
        symbols, lengths = self.read(codes, lengths)
        parts = (lengths + cfg.line - 1) // cfg.line
        owner = np.repeat(np.arange(len(lengths)), parts)
        ordinal = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = (np.cumsum(lengths) - lengths)[owner] + ordinal * cfg.line
        size = np.minimum(lengths[owner] - ordinal * cfg.line, cfg.line)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        alive = len(size) - np.searchsorted(size[::-1], np.arange(1, cfg.line + 1))
        counts = np.zeros((len(self.languages), len(size)), dtype=np.int64)
        state = np.zeros(counts.shape, dtype=np.int64)  # state 0 has no transition: the next character begins a phrase
        for step in range(int(size.max(initial=0))):
            n = alive[step]
            c = symbols[begin[:n] + step]
            following = self.table.follow(state[:, :n], c)
            broken = following == 0
            counts[:, :n] += broken
            which, place = np.nonzero(broken)
            following[which, place] = self.table.follow(self.roots[which], c[place])
            state[:, :n] = following
        total = np.zeros((len(lengths), len(self.languages)))
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(owner, counts[k], minlength=len(lengths))
        return total

    def rates(self, texts: list[str]) -> np.ndarray:
        codes = [_codes(t) for t in texts]
        lengths = np.array([len(c) for c in codes], dtype=np.int64)
        joined = np.concatenate(codes) if codes else np.zeros(0, dtype=np.uint32)
        return self.phrases(joined, lengths) / np.maximum(self.read(joined, lengths)[1], 1)[:, None]


def _mixed(texts: list[str], chars: int) -> str:
    """Whole texts, until there are so many characters."""
    sizes = np.cumsum([len(t) for t in texts])
    return "\n".join(texts[:int(np.searchsorted(sizes, chars)) + 1])


def fit(docs: DataFrame, may_learn: Column, cfg: CrossParsing = CrossParsing()) -> Model | None:
    """Model from the rows of ``docs(text, lang)`` for which ``may_learn`` holds; None without any labelled text."""
    spark = docs.sparkSession
    labelled = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rank = F.xxhash64("text")
    drawn = labelled.select("lang", rank.alias("rank"), (F.length("text") > cfg.longest_drawn).alias("long"), "text")
    # The hash-first rows per language, by a bounded range of hashes: the sample does not grow with the input.
    sizes = drawn.select("lang", "long", "rank").distinct().groupBy("lang").agg(
        F.count_if(~F.col("long")).alias("short"), F.count(F.lit(1)).alias("n")).limit(cfg.most_languages + 1).collect()
    if not sizes:
        return None
    if len(sizes) > cfg.most_languages:
        raise ValueError(f"more than {cfg.most_languages} different languages: is this the language column?")
    share = spark.createDataFrame(
        [(r["lang"], not r["short"], min(1.0, (2.0 * cfg.sample_rows / r["short"]) if r["short"] else (2.0 * cfg.long_rows / r["n"]))) for r in sizes],
        "lang string, long boolean, share double")
    span = F.pmod(F.col("rank"), F.lit(1 << 40)) < F.col("share") * (1 << 40)
    # Copies have one hash and are in the share together, so they are one row each after it.
    rows = drawn.join(F.broadcast(share), ["lang", "long"]).where(span).select("lang", "rank", "text").distinct().collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"], r["text"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    languages = sorted(texts)
    if missing := {r["lang"] for r in sizes}.difference(languages):
        raise RuntimeError(f"no reference text was drawn for the labelled languages {sorted(missing)}")
    # Odd rows are the reference, even ones tell the usual phrase rate; a single row serves as both.
    own = {k: (texts[k][1::2] or texts[k], texts[k][0::2]) for k in languages}
    references = {k: _codes(_mixed(own[k][0], cfg.reference_chars)) for k in languages}
    # Everything that is no letter reads as one blank (symbol 0), a letter as itself.
    symbol = np.where([chr(v).isalpha() for v in range(0x110000)], np.arange(0x110000), 0).astype(np.int32)
    arcs, roots, at = [], [], 0
    for k in languages:
        plain = symbol[references[k]]
        states = _states(plain[(plain != 0) | np.concatenate(([True], plain[1:] != plain[:-1]))])
        roots.append(at + 1)
        own_arcs = np.array([(state, c, target) for state, row in enumerate(states) for c, target in row.items()], dtype=np.int64)
        arcs.append(own_arcs.reshape(-1, 3) + np.array([at, 0, at]))
        at += len(states)
    model = Model(languages, symbol, Transitions(*np.concatenate(arcs).T), np.array(roots), np.ones(len(languages)), cfg)
    for k, name in enumerate(languages):
        model.usual[k] = max(model.rates([_mixed(own[name][1], cfg.calibration_chars)])[0, k], 1e-6)
    return model


def _predict(model):
    names = ["doc_id", "lang_pred", "score", "rate"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        m: Model = model.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            row = 0
            while row < len(texts):
                to, chars = row, 0
                while to < len(texts) and (to == row or chars + len(texts[to] or "") <= 1_000_000):
                    chars += len(texts[to] or "")
                    to += 1
                some = [t or "" for t in texts[row:to]]
                lettered = np.array([any(map(str.isalpha, t)) for t in some])
                rates = m.rates(some) / m.usual
                best = rates.argmin(axis=1)
                low = rates[np.arange(len(some)), best]
                shares = np.exp(-m.config.sharpness * (rates - low[:, None]))
                score = np.where(lettered, 1 / shares.sum(axis=1), 0.0)
                tags = [m.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, to - row), pa.array(tags), pa.array(score), pa.array(np.where(lettered, low, 0.0))],
                    names=names)
                row = to
    return run


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, rate) per row of ``docs(doc_id, text)``; ``rate`` is the winner's phrase rate against
    its usual one (1: as in its labelled text; junk that is of no learnt language has more)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("rate"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double, rate double")


def _known(model, columns: list[str], fill: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _predict(model)
        # A batch may hold some 10,000 texts: only a part of it is held a second and third time, as Python texts and as a result.
        for batch in (whole.slice(row, PART_ROWS) for whole in batches for row in range(0, whole.num_rows, PART_ROWS)):
            tags = [t for part in predict(iter([batch])) for t in part.column("lang_pred").to_pylist()]
            arrays = [batch.column(c) if c != fill else pa.array(
                [t if own is None else own for own, t in zip(batch.column(c).to_pylist(), tags)], pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array([t != UNKNOWN for t in tags], pa.bool_()))
    return run


def keep_known(docs: DataFrame, model: Model, fill: str | None = None) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` whose text is in some language; a null in the column ``fill`` becomes the language
    that was found."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(_known(shared, docs.columns, fill), schema)
