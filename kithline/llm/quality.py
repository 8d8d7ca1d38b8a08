"""Quality classifier by co-training of two views.

The *content* view sees hashed words and word endings of the text. The *page* view sees what is known about the page and
how it is laid out: source, language, size, line lengths, shares of capitals, digits, symbols and repeated words, in
steps. Each view has a logistic regression of its own. Over several rounds both score a pool of rows without label; what
one view is surest of, as many per label as the labelled rows have, becomes training data of the *other* view. At the end
each view is calibrated on labelled rows that were not fitted, and a document's score combines both calibrated views.

Models are fitted on bounded samples, the first ``sample_rows`` per label and ``pool_rows`` without label in hash order.
Scoring reads every whole text.

Defined results: nulls are empty texts or unknown metadata; without labelled rows of both kinds every score is the share
of label 1 (0 without labels); rows are never dropped; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.llm import words as W

PAGE_COLUMNS = ("source", "lang")


@dataclass(frozen=True)
class CoTraining:
    slots: int = 1 << 16
    sample_rows: int = 2_500
    pool_rows: int = 4_000
    #: Texts longer than this are not drawn for the samples; those drawn are read whole.
    longest_drawn: int = 200_000
    rounds: int = 3
    #: Share of the pool that each view hands over per round.
    share: float = 0.05
    epochs: int = 8
    rate: float = 0.3


def _content(data: np.ndarray, borders: np.ndarray, cfg: CoTraining):
    """(owner, slot, value) of the words and word endings of texts, vectors of length one."""
    words = W.split(data, borders)
    owner = np.repeat(np.arange(len(borders) - 1), words.counts)
    ending = W.Words(data, np.maximum(words.ends - 3, words.starts), words.ends, words.first)
    slot = np.concatenate([W.mix(W.hashes(words, lower=True), 1), W.mix(W.hashes(ending, lower=True), 2)]) % np.uint64(cfg.slots)
    key, count = np.unique(np.concatenate([owner, owner]) * np.int64(cfg.slots) + slot.astype(np.int64), return_counts=True)
    owner, slot, value = key // cfg.slots, key % cfg.slots, 1 + np.log(count)
    norm = np.sqrt(np.bincount(owner, value * value, minlength=len(borders) - 1))
    return owner, slot, value / norm[owner]


def _per_text(flags: np.ndarray, borders: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[borders])


def _page(data: np.ndarray, borders: np.ndarray, meta: list[tuple], cfg: CoTraining):
    """(owner, slot, value) of the page features, each one of a few steps."""
    size = np.maximum(np.diff(borders), 1)
    words = W.split(data, borders)
    n_words = np.maximum(words.counts, 1)
    hashed = W.hashes(words, lower=True)
    owner = np.repeat(np.arange(len(size)), words.counts)
    kinds = np.diff(np.searchsorted(np.unique(owner * np.int64(1 << 40) + (hashed >> np.uint64(24)).astype(np.int64)) >> 40,
                                    np.arange(len(size) + 1)))
    lines = _per_text(data == 10, borders) + 1
    upper = _per_text((data >= 65) & (data <= 90), borders)
    digits = _per_text((data >= 48) & (data <= 57), borders)
    symbols = _per_text(((data > 32) & (data < 48)) | ((data > 57) & (data < 65)) | ((data > 90) & (data < 97)) | ((data > 122) & (data < 127)), borders)
    again = np.zeros(len(hashed), dtype=bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
    stutter = np.bincount(owner, again, minlength=len(size))
    # Sizes of short texts are one step, and shares are of 128 bytes at least: little text is little evidence.
    steps = [np.log2(np.maximum(size, 128)), np.log2(np.maximum(n_words, 16)), np.log2(lines), np.log2(np.maximum(size, 128) / lines) * 2,
             np.minimum(size / n_words, 12), *[np.sqrt(x / np.maximum(size, 128)) * 20 for x in (upper, digits, symbols)],
             kinds / n_words * 10, np.sqrt(stutter / n_words) * 20]
    slots = [(np.floor(s).astype(np.int64) * 31 + k) for k, s in enumerate(steps)]
    for k, column in enumerate(zip(*meta)) if meta else ():
        slots.append(np.array([zlib.crc32(f"{k}={v}".encode()) for v in column], dtype=np.int64))
    features = np.stack([W.mix(s.astype(np.uint64), 50 + k) % np.uint64(cfg.slots) for k, s in enumerate(slots)], axis=1).astype(np.int64)
    return np.repeat(np.arange(len(size)), features.shape[1]), features.ravel(), np.full(features.size, 1 / np.sqrt(features.shape[1]))


class View:
    """Logistic regression on sparse rows, with a calibration of its margins."""

    def __init__(self, cfg: CoTraining):
        self.cfg, self.weights, self.bias, self.slope, self.shift = cfg, np.zeros(cfg.slots), 0.0, 1.0, 0.0

    def margins(self, rows, n: int) -> np.ndarray:
        owner, slot, value = rows
        return self.bias + np.bincount(owner, self.weights[slot] * value, minlength=n)

    def logits(self, rows, n: int) -> np.ndarray:
        return np.clip(self.slope * self.margins(rows, n) + self.shift, -12, 12)

    def fit(self, rows, labels: np.ndarray) -> None:
        owner, slot, value = rows
        begin, rng = np.searchsorted(owner, np.arange(len(labels) + 1)), np.random.default_rng(3)
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        self.weights, self.bias, squares, bias_square = np.zeros(self.cfg.slots), 0.0, np.full(self.cfg.slots, 1e-3), 1e-3
        for _ in range(self.cfg.epochs):
            for part in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // 64)):
                at = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in part])
                who = np.repeat(np.arange(len(part)), begin[part + 1] - begin[part])
                margin = self.margins((who, slot[at], value[at]), len(part))
                slope = weight[part] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[part]) / len(part)
                touched, where = np.unique(slot[at], return_inverse=True)
                g = np.bincount(where, slope[who] * value[at], minlength=len(touched)) + 1e-5 * self.weights[touched]
                squares[touched] += g * g
                self.weights[touched] -= self.cfg.rate * g / np.sqrt(squares[touched])
                bias_square += slope.sum() ** 2
                self.bias -= self.cfg.rate * slope.sum() / np.sqrt(bias_square)

    def calibrate(self, rows, labels: np.ndarray) -> None:
        x = np.stack([self.margins(rows, len(labels)), np.ones(len(labels))], axis=1)
        target = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
        start = beta = np.array([1.0, 0.0])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
            beta = beta + np.linalg.solve(hessian, x.T @ (target - p) - 0.05 * (beta - start))
        if beta[0] > 0 and np.isfinite(beta).all():
            self.slope, self.shift = float(beta[0]), float(beta[1])


@dataclass
class Model:
    content: View
    page: View

    def scores(self, data: np.ndarray, borders: np.ndarray, meta: list[tuple]) -> np.ndarray:
        n, cfg = len(borders) - 1, self.content.cfg
        both = self.content.logits(_content(data, borders, cfg), n) + self.page.logits(_page(data, borders, meta, cfg), n)
        return 1 / (1 + np.exp(-both / 2))


def _read(rows: list, cfg: CoTraining):
    """Sparse rows of both views for collected rows."""
    views = ([], [])
    meta = [tuple(r[c] for c in PAGE_COLUMNS) for r in rows]
    for row, to, data, borders in W.chunks(pa.array([r["text"] for r in rows], pa.string())):
        for out, (o, s, v) in zip(views, (_content(data, borders, cfg), _page(data, borders, meta[row:to], cfg))):
            out.append((o + row, s, v))
    return [tuple(map(np.concatenate, zip(*v))) if v else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) for v in views]


def _pick(view, rows: np.ndarray):
    """The sparse rows of the listed texts, renumbered."""
    owner, slot, value = view
    begin = np.searchsorted(owner, rows)
    size = np.searchsorted(owner, rows, side="right") - begin
    at = np.concatenate([np.arange(b, b + s) for b, s in zip(begin, size)]) if len(rows) else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(rows)), size), slot[at], value[at]


def _sample(rows: DataFrame, most: int, total: int, cfg: CoTraining) -> list:
    """The first ``most`` of ``total`` distinct texts in the order of their hashes, each with its smallest page metadata."""
    draw = F.pmod("hash", F.lit(1 << 20))
    near = rows.where(F.length("text") <= cfg.longest_drawn).withColumn("hash", F.xxhash64("text")).where(draw < min(1.0, 1.5 * most / max(total, 1)) * (1 << 20))
    once = near.groupBy("hash").agg(F.min(F.struct("text", *PAGE_COLUMNS)).alias("row"))
    return once.orderBy(draw, "hash").limit(most).select("row.*").collect()


def fit(labelled: DataFrame, unlabelled: DataFrame, cfg: CoTraining = CoTraining()) -> Model | float:
    """Model from ``labelled(text, source, lang, label)`` and ``unlabelled(text, source, lang)``."""
    filled = labelled.where("label in (0, 1)").withColumn("text", F.coalesce("text", F.lit("")))
    tag = F.xxhash64("text").alias("hash")
    totals = {int(r["label"]): r["count"] for r in filled.select("label", tag).distinct().groupBy("label").count().collect()}
    if len(totals) < 2:
        return 1.0 if 1 in totals else 0.0
    known = [(r, k) for k in (0, 1) for r in _sample(filled.where(F.col("label") == k), cfg.sample_rows, totals[k], cfg)]
    pool_of = unlabelled.withColumn("text", F.coalesce("text", F.lit("")))
    pool = _sample(pool_of, cfg.pool_rows, pool_of.select(tag).distinct().count(), cfg)
    labels = np.array([k for _, k in known], dtype=np.float64)
    views, others = _read([r for r, _ in known], cfg), _read(pool, cfg)
    back = np.arange(len(labels)) % 6 == 0
    models = [View(cfg), View(cfg)]
    given: list[dict[int, int]] = [{}, {}]  # pool row -> pseudo label, per view that learns it
    for turn in range(cfg.rounds + 1):
        for k, model in enumerate(models):
            rows = np.flatnonzero(~back)
            extra = np.array(sorted(given[k]), dtype=np.int64)
            own, more = _pick(views[k], rows), _pick(others[k], extra)
            joined = tuple(np.concatenate([a, b]) for a, b in zip(own, (more[0] + len(rows), more[1], more[2])))
            model.fit(joined, np.concatenate([labels[rows], np.array([given[k][i] for i in extra], dtype=np.float64)]))
        if turn == cfg.rounds or not pool:
            break
        for k, model in enumerate(models):
            margin = model.margins(others[k], len(pool))
            free = np.array([i for i in range(len(pool)) if i not in given[1 - k]], dtype=np.int64)
            order = free[np.argsort(margin[free], kind="stable")]
            n = int(cfg.share * len(pool))
            bad, good = int(round(n * (1 - labels.mean()))), int(round(n * labels.mean()))
            given[1 - k] |= {int(i): 0 for i in order[:bad] if margin[i] < 0} | {int(i): 1 for i in order[len(order) - good:] if margin[i] > 0}
    if 0 < labels[back].sum() < back.sum():
        for view, model in zip(views, models):
            model.calibrate(_pick(view, np.flatnonzero(back)), labels[back])
    return Model(*models)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            meta = list(zip(*[batch.column(c).to_pylist() for c in PAGE_COLUMNS]))
            for row, to, data, borders in W.chunks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, to - row), pa.array(model.value.scores(data, borders, meta[row:to]))],
                    names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """(doc_id, score) per row of ``docs(doc_id, text, source, lang)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *PAGE_COLUMNS)
    if isinstance(model, float):
        return docs.select("doc_id", F.lit(model).alias("score"))
    return docs.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")
