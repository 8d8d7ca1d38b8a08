"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-cased words and the first letters of longer words, hashed into a fixed table; a term weighs
1 + log(count), and a text's vector has length one. The machine scores ``bias + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``:
the factors let two terms that are harmless alone, such as an insult and the mention of a group, count together.

Which terms enter is decided by counts over *all* rows that may be learnt from (a table of fixed size): the
``terms`` slots whose presence differs most between the labels. The machine is then fitted on a bounded sample of
the distinct texts, the first ``sample_rows`` per label in hash order, with AdaGrad; scores are calibrated on a part of the sample
that was not fitted. Scoring reads every whole text.

Defined results: a text without known terms gets the bias' score; without labelled rows of both kinds every score is the
share of label 1 (0 without labels); equal texts get equal scores; rows are never dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithline.llm import words as W
from kithline.llm.common import met
from kithline.plans.staging import Staging

_LETTER = np.zeros(256, dtype=bool)
_LETTER[128:] = True
_LETTER[65:91] = True
_LETTER[97:123] = True


@dataclass(frozen=True)
class FactorizationMachine:
    slots: int = 1 << 18
    terms: int = 6_000
    factors: int = 8
    sample_rows: int = 6_000
    #: Texts longer than this are not drawn for the sample; those drawn are read whole.
    longest_drawn: int = 200_000
    epochs: int = 12
    rate: float = 0.15
    penalty: float = 1e-5
    #: Word beginnings, in bytes, that are terms besides the word.
    stems: tuple[int, ...] = (5, 7)


def term_slots(data: np.ndarray, borders: np.ndarray, cfg: FactorizationMachine) -> tuple[np.ndarray, np.ndarray]:
    """(owner text, slot) of every occurrence of a term."""
    plain = np.where(_LETTER[data], data, np.uint8(32))
    words = W.split(plain, borders)
    owner = np.repeat(np.arange(len(borders) - 1), words.counts)
    found = [(owner, W.mix(W.hashes(words, lower=True), 1))]
    for k, stem in enumerate(cfg.stems):
        long = words.ends - words.starts > stem
        part = W.Words(plain, words.starts[long], words.starts[long] + stem, words.first)
        found.append((owner[long], W.mix(W.hashes(part, lower=True), 2 + k)))
    return np.concatenate([o for o, _ in found]), (np.concatenate([h for _, h in found]) % np.uint64(cfg.slots)).astype(np.int64)


def _vectors(owner: np.ndarray, slot: np.ndarray, column: np.ndarray, texts: int):
    """(owner, column, value) sorted by owner: 1 + log(count) of known terms, vectors of length one."""
    known = column[slot]
    keep = known >= 0
    key, count = np.unique(owner[keep] * np.int64(1 << 32) + known[keep], return_counts=True)
    owner, known = key >> 32, key & 0xFFFFFFFF
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(owner, value * value, minlength=texts))
    return owner, known, value / norm[owner]


def _count(cfg: FactorizationMachine):
    """(label, slot, rows): in how many rows of a label a slot occurs; slot -1 counts the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, cfg.slots), dtype=np.int64)
        rows = np.zeros(2, dtype=np.int64)
        for batch in batches:
            labels = batch.column("label").to_numpy().astype(np.int64)
            for row, to, data, borders in W.chunks(batch.column("text")):
                own = labels[row:to]
                rows += np.bincount(own, minlength=2)
                owner, slot = term_slots(data, borders, cfg)
                key = np.unique(owner * np.int64(cfg.slots) + slot)
                np.add.at(seen, (own[key // cfg.slots], key % cfg.slots), 1)
        for label in (0, 1):
            slots = np.flatnonzero(seen[label])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slots) + 1, label, dtype=np.int32)), pa.array(np.append(slots, -1)),
                 pa.array(np.append(seen[label][slots], rows[label]))], names=["label", "slot", "rows"])
    return run


@dataclass
class Model:
    column: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    slope: float
    shift: float
    config: FactorizationMachine

    def margins(self, owner: np.ndarray, column: np.ndarray, value: np.ndarray, texts: int) -> np.ndarray:
        linear = np.bincount(owner, self.weights[column] * value, minlength=texts)
        pairs = np.zeros(texts)
        for f in range(self.factors.shape[1]):
            x = self.factors[column, f] * value
            pairs += np.bincount(owner, x, minlength=texts) ** 2 - np.bincount(owner, x * x, minlength=texts)
        return self.bias + linear + pairs / 2

    def scores(self, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
        texts = len(borders) - 1
        vectors = _vectors(*term_slots(data, borders, self.config), self.column, texts)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(*vectors, texts) + self.shift, -30, 30)))


def _fit_machine(model: Model, texts: list[str], labels: np.ndarray) -> None:
    """AdaGrad on logistic loss, both labels weighing the same."""
    cfg, rng = model.config, np.random.default_rng(7)
    owner, column, value = [], [], []
    for row, to, data, borders in W.chunks(pa.array(texts)):
        o, c, v = _vectors(*term_slots(data, borders, cfg), model.column, to - row)
        owner.append(o + row)
        column.append(c)
        value.append(v)
    owner, column, value = map(np.concatenate, (owner, column, value))
    begin = np.searchsorted(owner, np.arange(len(texts) + 1))
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    squares = [np.full(model.weights.shape, 1e-3), np.full(model.factors.shape, 1e-3)]
    bias_square = 1e-3
    for _ in range(cfg.epochs):
        order = rng.permutation(len(texts))
        for part in np.array_split(order, max(1, len(texts) // 64)):
            at = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in part])
            who = np.repeat(np.arange(len(part)), begin[part + 1] - begin[part])
            c, x = column[at], value[at]
            margin = model.margins(who, c, x, len(part))
            slope = weight[part] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[part]) / len(part)
            vx = model.factors[c] * x[:, None]
            sums = np.stack([np.bincount(who, vx[:, f], minlength=len(part)) for f in range(vx.shape[1])], axis=1)
            touched, where = np.unique(c, return_inverse=True)
            g_w = np.bincount(where, slope[who] * x, minlength=len(touched)) + cfg.penalty * model.weights[touched]
            g_v = (slope[who] * x)[:, None] * (sums[who] - vx)
            g_v = np.stack([np.bincount(where, g_v[:, f], minlength=len(touched)) for f in range(vx.shape[1])], axis=1)
            g_v += cfg.penalty * model.factors[touched]
            squares[0][touched] += g_w * g_w
            squares[1][touched] += g_v * g_v
            model.weights[touched] -= cfg.rate * g_w / np.sqrt(squares[0][touched])
            model.factors[touched] -= cfg.rate / 3 * g_v / np.sqrt(squares[1][touched])
            g_b = slope.sum()
            bias_square += g_b * g_b
            model.bias -= cfg.rate * g_b / np.sqrt(bias_square)


def _calibrate(model: Model, texts: list[str], labels: np.ndarray) -> None:
    """Slope and shift of the margins by Newton steps on logistic loss, weighing both labels the same."""
    margins = np.concatenate([model.margins(*_vectors(*term_slots(d, b, model.config), model.column, to - row), to - row)
                              for row, to, d, b in W.chunks(pa.array(texts))])
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    target = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    beta = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta + np.linalg.solve(hessian, x.T @ (weight * (target - p)) - 1e-3 * (beta - np.array([1.0, 0.0])))
    if beta[0] > 0 and np.isfinite(beta).all():
        model.slope, model.shift = float(beta[0]), float(beta[1])


def fit(labelled: DataFrame, cfg: FactorizationMachine = FactorizationMachine()) -> Model | float:
    """Model from ``labelled(text, label)``, or the share of label 1 where one label is missing."""
    rows = labelled.where("label in (0, 1)").select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label"))
    counts = rows.mapInArrow(_count(cfg), "label int, slot long, rows long").groupBy("label", "slot").agg(F.sum("rows").alias("rows"))
    seen, total = np.zeros((2, cfg.slots)), np.zeros(2)
    for label, slot, n in counts.collect():  # at most 2 * slots + 2 rows
        if slot < 0:
            total[label] = n
        else:
            seen[label, slot] = n
    if total.min() == 0:
        return float(total[1] / max(total.sum(), 1))
    share = (seen + 0.5) / (total[:, None] + 1)
    mean = seen.sum(axis=0) / total.sum()
    gain = np.abs(share[1] - share[0]) / np.sqrt(mean * (1 - mean) + 1e-4)
    best = np.argsort(-gain, kind="stable")[:cfg.terms]
    column = np.full(cfg.slots, -1, dtype=np.int64)
    column[best] = np.arange(len(best))

    draw = F.xxhash64("text").alias("draw")
    # Copies have one hash, so shares are of distinct texts, and copies are one row each after the draw.
    distinct = {r["label"]: r["count"] for r in rows.where(F.length("text") <= cfg.longest_drawn).select("label", draw).distinct().groupBy(
        "label").count().collect()}
    share_of = F.when(F.col("label") == 1, F.lit(min(1.0, 1.5 * cfg.sample_rows / distinct.get(1, 1)))).otherwise(
        F.lit(min(1.0, 1.5 * cfg.sample_rows / distinct.get(0, 1))))
    sample = rows.where(F.length("text") <= cfg.longest_drawn).select("label", draw, "text").where(F.pmod(F.col("draw"), F.lit(1 << 20)) < share_of * (1 << 20))
    picked = [sample.where(F.col("label") == k).distinct().orderBy(
        F.pmod(F.col("draw"), F.lit(1 << 20)), "draw").limit(cfg.sample_rows).collect() for k in (0, 1)]
    if not all(picked):
        return float(total[1] / total.sum())
    texts = [r["text"] for part in picked for r in part]
    labels = np.array([r["label"] for part in picked for r in part], dtype=np.float64)
    rng = np.random.default_rng(5)
    model = Model(column, 0.0, np.zeros(cfg.terms), rng.normal(0, 0.05, (cfg.terms, cfg.factors)), 1.0, 0.0, cfg)
    kept_back = np.arange(len(texts)) % 6 == 0
    _fit_machine(model, [t for t, k in zip(texts, kept_back) if not k], labels[~kept_back])
    if 0 < labels[kept_back].sum() < kept_back.sum():
        _calibrate(model, [t for t, k in zip(texts, kept_back) if k], labels[kept_back])
    return model


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, borders in W.chunks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, to - row), pa.array(model.value.scores(data, borders))], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """(doc_id, score) per row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if isinstance(model, float):
        return docs.select("doc_id", F.lit(model).alias("score"))
    return docs.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")


def labelled(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, staging: Staging) -> DataFrame:
    """(text, label) of the labelled rows that may be learnt from; an id with both labels counts for each once."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isNotNull() & may_learn).distinct()
    wanted = met(staging.put(wanted, "labels"))
    rows = docs.where(may_learn).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id").select("text", "label")
    return staging.put(rows, "labelled").df  # read for counts, shares and draws
