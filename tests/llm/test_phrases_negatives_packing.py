"""Collocations, hard negatives and packing against brute force, with ragged input and hot groups."""

from __future__ import annotations

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kithline.llm import best_fit_packing, collocations, hard_negatives, queries
from kithline.llm import words as W
from kithline.llm.best_fit_packing import Packing
from kithline.llm.collocations import Collocations, Trie
from kithline.llm.hard_negatives import HardNegatives
from kithline.plans.staging import Staging

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (None, "no id at all"), (8, "é ü 漢字 \U0001F600 x"), (8, "other text")]


# --- words

def test_thue_morse_words_differ():
    a, b = "a", "b"
    for _ in range(13):
        a, b = a + b, b + a
    texts = pa.array([a, b, a[:1024], b[:1024], a.upper()])
    hashed = np.concatenate([W.hashes(W.split(data, borders)) for _, _, data, borders in W.chunks(texts)])
    assert len(set(hashed.tolist())) == 5
    folded = np.concatenate([W.hashes(W.split(data, borders), lower=True) for _, _, data, borders in W.chunks(texts)])
    assert folded[0] == folded[4] != folded[1]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    rng = random.Random(1)
    words = ["".join(rng.choice("abé\U0001F600") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    seen = {}
    for _ in range(3):
        rng.shuffle(words)
        for _, _, data, borders in W.chunks(pa.array([" ".join(words), "x"])):
            found = W.split(data, borders)
            for h, i, j in zip(W.hashes(found).tolist(), found.starts, found.ends):
                word = data[i:j].tobytes()
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_windows_tell_sequences_apart():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 3, 4000).astype(np.uint64)
    for width in (1, 2, 5, 12, 35, 64):
        got = W.windows(values, width)
        groups = collections.defaultdict(set)
        for k, h in enumerate(got.tolist()):
            groups[values[k:k + width].tobytes()].add(h)
        assert len(got) == len(values) - width + 1 and all(len(g) == 1 for g in groups.values())
        assert len(set(got.tolist())) == len(groups)
    assert len(W.windows(values[:3], 5)) == 0


# --- op11

def brute_phrases(rows, cfg):
    """rows of (lang, text)."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang or "und"] += len(w)
            f.update((lang or "und", w[i:i + k]) for k in range(1, cfg.longest + 1) for i in range(len(w) - k + 1))
    wanted = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= cfg.least}
    result = collections.defaultdict(list)
    for (lang, g), a in wanted.items():
        if any(o[0] == lang and len(o[1]) > len(g) and b >= a and any(o[1][i:i + len(g)] == g for i in range(len(o[1]) - len(g) + 1))
               for o, b in wanted.items()):
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
        result[lang].append((-score, -a, " ".join(g).encode(), l, r))
    return {(lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in result.items()
            for k, (s, a, p, l, r) in enumerate(sorted(found)[:cfg.top])}


def phrase_texts():
    rng = random.Random(3)
    vocabulary = ["Of", "the", "a", "x-y", "é", "漢字", "\U0001F600", "to", "w" * 30, "ﬁ", "I'm"]
    rows = [("en", " of the"), ("en", "a a a a a a a a"), (None, "of the. of the"), ("und", "of the\x0bof the\tof  the"), ("fr", None), ("fr", ""), ("xx", " ,;")]
    for _ in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            words += ["big", "Red", "dog", "ran", "far", "off"][:rng.randint(2, 6)]
        rows.append((rng.choice(["en", "fr", None]), "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for w in words)))
    return rows + [("hot", "the same old text, the same old text")] * 300


@pytest.mark.parametrize("cfg", [Collocations(least=9, slots=1 << 16), Collocations(least=9, slots=256, most_slots=256, bits=256, shard=100, row_words=16, task_words=7),
                                 Collocations(least=300, top=7, longest=3, slots=64, most_slots=64, bits=64, shard=50)])
def test_phrases_equal_brute_force(spark, cfg):
    rows = phrase_texts()
    docs = spark.createDataFrame([(k, lang, t, 1, "w", "h") for k, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, n int, word string, hash string")
    got = collocations.mine(docs.repartition(5), Staging(spark), cfg).collect()
    assert {tuple(r) for r in got} == brute_phrases(rows, cfg) and len(got) == len({tuple(r) for r in got})


def test_a_task_leaves_out_phrases_that_are_known():
    class Value:
        def __init__(self, value):
            self.value = value

    rng = np.random.default_rng(5)
    words = rng.integers(1, 40, 5000).astype(np.uint64)
    batch = pa.RecordBatch.from_arrays([pa.array([words.view(np.int64)], pa.list_(pa.int64()))], names=["words"])
    every = Value(np.full(64, 2**64 - 1, dtype=np.uint64))

    def named(known):
        found = collocations._candidates(2, every, every, known, 100, Collocations())(iter([batch]))
        return np.concatenate([b.column("phrase").flatten().to_numpy().view(np.uint64).reshape(-1, 2) for b in found])

    phrases = named(None)
    hashes = np.sort(np.array([collocations._phrase(p, 2)[0][0] for p in phrases]))
    assert len(phrases) > 1000 and len(named(Value(hashes))) == 0
    assert len(named(Value(hashes[::2]))) == len(hashes) - len(hashes[::2]) and len(named(Value(hashes[:0]))) == len(hashes)


def test_runs_are_narrowed_to_the_words_of_candidates():
    """Every longer phrase of candidates is counted as before, in rows whose last words begin the next row, too."""
    class Value:
        def __init__(self, value):
            self.value = value

    cfg, rng = Collocations(row_words=50, longest=4), np.random.default_rng(6)
    words = rng.choice([0] * 3 + [1] * 4 + list(range(2, 30)), 3000).astype(np.uint64)
    rows = [words[k:k + 53] for k in range(0, 3000, 50)]
    batch = pa.RecordBatch.from_arrays([pa.array([r.view(np.int64).tolist() for r in rows], pa.list_(pa.int64()))], names=["words"])
    frequent = Value(np.full(64, 2**64 - 1, dtype=np.uint64))
    # A candidate holds no word above 12.
    pairs = np.array([(a, b) for a in range(1, 13) for b in range(1, 13)], dtype=np.uint64)
    heavy = np.zeros(1 << 14, dtype=np.uint64)
    _, hashed = collocations._places(np.append(pairs, np.zeros((len(pairs), 1), np.uint64), 1).ravel(), 2, frequent.value, None, 10**6)
    slot = hashed & np.uint64(64 * len(heavy) - 1)
    np.bitwise_or.at(heavy, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
    narrow = list(collocations._narrowed(2, frequent, Value(heavy), cfg)(iter([batch])))
    assert sum(len(b.column("words").flatten()) for b in narrow) < 0.75 * sum(map(len, rows))

    def phrases(batches):
        n = collections.Counter()
        for row, own in collocations._runs(iter(batches), cfg):
            for k in (2, 3, 4):
                n.update(tuple(row[i:i + k].tolist()) for i in range(min(own, len(row) - k + 1)) if all(0 < w < 13 for w in row[i:i + k]))
        return n
    assert phrases(narrow) == phrases([batch]) and max(map(len, phrases([batch]))) == 4
    again = list(collocations._narrowed(2, frequent, Value(heavy), cfg)(iter(narrow)))
    assert phrases(again) == phrases([batch])


def test_a_task_passes_on_blocks_of_counts():
    phrases = np.array([(a, b) for a in range(1, 61) for b in range(1, 61)], dtype=np.uint64)
    trie = type("Broadcast", (), {"value": (collocations.Trie.build(phrases), np.arange(len(phrases)) * 3)})
    batch = pa.RecordBatch.from_arrays([pa.array([phrases.ravel().view(np.int64).tolist()])], names=["words"])
    tasks = [pa.Table.from_batches(collocations._count(trie, 2, Collocations())(iter([batch]))).to_batches() for _ in range(2)]
    assert all(sum(b.num_rows for b in task) == 4 for task in tasks)
    words, n = phrases.ravel().tolist(), collections.Counter()
    for pair in zip(words, words[1:]):
        n[pair] += 2
    got = pa.Table.from_batches(collocations._counted(trie, Collocations(least=3))(itertools.chain(*tasks)))
    assert dict(zip(got.column("cid").to_pylist(), got.column("a").to_pylist())) == {
        3 * k: n[tuple(p)] for k, p in enumerate(phrases.tolist()) if n[tuple(p)] >= 3}


def test_phrases_of_odd_tables(spark):
    docs = spark.createDataFrame([(i, "en", t) for i, t in ODD], "doc_id long, lang string, text string")
    assert collocations.mine(docs, Staging(spark)).count() == 0
    assert collocations.mine(docs.limit(0), Staging(spark)).count() == 0
    # One phrase on a third of all rows, and products beyond 64 bits.
    hot = spark.range(40_000).select(F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 0, "a very common phrase here").otherwise(
        F.concat(F.lit("w"), F.col("id"))).alias("text"))
    rows = collocations.mine(hot, Staging(spark)).collect()
    n = 13334 * 5 + 26666
    assert [tuple(r) for r in rows] == [("en", 1, "a very common phrase here", 13334, 13334, 13334, n, 1000 * n // 13334)]


def test_a_trie_knows_its_phrases_only():
    rng = np.random.default_rng(4)
    for k in (1, 2, 3, 5):
        phrases = np.unique(rng.integers(1, 30, (400, k)).astype(np.uint64) * np.uint64(2**58 + 12345), axis=0)
        rng.shuffle(phrases)
        trie = Trie.build(phrases)
        assert len(set(trie.states.tolist())) == len(phrases)
        text = np.concatenate((phrases.ravel(), rng.integers(1, 40, 3000).astype(np.uint64) * np.uint64(2**58 + 12345), np.zeros(3, dtype=np.uint64)))
        arrived = np.bincount(trie.walk(text, k, len(text)), minlength=len(trie.check))
        count = collections.Counter(text[i:i + k].tobytes() for i in range(len(text) - k + 1))
        assert arrived[trie.states].tolist() == [count[p.tobytes()] for p in phrases]
        assert arrived.sum() == sum(count[p.tobytes()] for p in phrases)


# --- op12

def brute_negatives(rows, cfg):
    kept = [(i, lab, np.array([int(np.floor(float(x) * cfg.scale)) for x in v], dtype=object), k) for k, (i, v, lab) in enumerate(rows)
            if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    result = collections.Counter()
    big = 2**63
    for i, lab, q, k in kept:
        if i is None or i % cfg.every:
            continue
        s = sorted((-int((q * p).sum() if len(q) else 0), big if j is None else j, m, other) for j, other, p, m in kept if m != k and len(p) == len(q))
        for s_p, j, m, _ in [x for x in s if x[3] == lab][:cfg.positives]:
            window = [x for x in s if x[3] != lab and cfg.low * -s_p <= 100 * -x[0] <= cfg.high * -s_p][:cfg.negatives]
            result.update((i, None if j == big else j, r + 1, None if x[1] == big else x[1], -s_p, -x[0]) for r, x in enumerate(window))
    return result


def vector_rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(k, (centres[k % 6] + 0.7 * rng.normal(size=8)).tolist(), int(k % 6 if k % 5 else rng.integers(0, 6))) for k in range(400)]
    rows += [(10, rows[3][1], 2), (10, rows[3][1], 2), (None, rows[3][1], 1), (None, rows[3][1], 2), (20, None, 1), (30, rows[0][1], None),
             (40, [1.0, None, 1.0] + [0.0] * 5, 1), (50, [float("nan")] + [0.0] * 7, 1), (60, [float("inf")] + [0.0] * 7, 1),
             (70, [], 1), (80, [], 1), (90, [], 2), (100, [0.5, -0.5], 1), (101, [0.5, -0.4], 1), (102, [0.25, -0.3], 2), (110, [0.0] * 8, 3), (-10, rows[8][1], 4)]
    return rows + [(1000 + k, rows[7][1], 1 + k % 2) for k in range(300)]  # one vector on a third of all rows


@pytest.mark.parametrize("cfg", [HardNegatives(every=10), HardNegatives(every=10, block_rows=16, chunk_anchors=7, zone_blocks=2, axes=3, bits=4),
                                 HardNegatives(every=30, block_rows=50, positives=2, negatives=3, low=-20, high=100)])
def test_negatives_equal_brute_force(spark, cfg):
    rows = vector_rows()
    frame = spark.createDataFrame([(i, v, lab, 1, 2, 3, "x") for i, v, lab in rows],
                                  "vec_id long, embedding array<float>, label int, row int, dim int, block int, zone string").repartition(3)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    got = hard_negatives.mine(frame, Staging(spark), cfg).collect()
    assert collections.Counter(map(tuple, got)) == brute_negatives(exact, cfg)


def test_negatives_of_odd_tables(spark):
    frame = spark.createDataFrame(vector_rows(), "vec_id long, embedding array<double>, label int")
    for odd in (frame.limit(0), frame.where("label is null"), frame.where("vec_id = 70"), frame.where("vec_id is null")):
        assert hard_negatives.mine(odd, Staging(spark)).count() == 0
    huge = spark.createDataFrame([(k, [1e300 * (-1) ** k, 1.0], k % 2) for k in range(4)], "vec_id long, embedding array<double>, label int")
    hard_negatives.mine(huge, Staging(spark), HardNegatives(every=1)).collect()


def test_bounds_hold_and_blocks_are_spared():
    rng = np.random.default_rng(6)
    anchors = rng.integers(-99, 99, (5, 4)).astype(np.int32)
    block = rng.integers(-99, 99, (50, 4)).astype(np.int32)
    low, high = hard_negatives.bounds(anchors, block.min(0)[None], block.max(0)[None])
    product = anchors.astype(np.int64) @ block.astype(np.int64).T
    assert (low[:, 0] <= product.min(1)).all() and (high[:, 0] >= product.max(1)).all()
    low, high = hard_negatives.bounds(anchors, block, block)
    assert (low == product).all() and (high == product).all()


def test_hilbert_curve_goes_through_every_cell_in_steps_of_one():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        key = hard_negatives.hilbert_key(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1)
        assert (steps == 1).all()


# --- op13

def test_bounds_never_exceed_the_best_packing():
    rng = random.Random(7)

    def best(sizes, capacity):
        """Fewest bins, by trying."""
        most = len(best_fit_packing.best_fit(np.array(sizes), capacity)[2])
        sizes = sorted(sizes, reverse=True)

        def place(k, rooms):
            nonlocal most
            if len(rooms) >= most:
                return
            if k == len(sizes):
                most = len(rooms)
                return
            for i in sorted({rooms.index(r) for r in rooms if r >= sizes[k]}):
                place(k + 1, rooms[:i] + [rooms[i] - sizes[k]] + rooms[i + 1:])
            place(k + 1, rooms + [capacity - sizes[k]])
        place(0, [])
        return most
    tight = 0
    for _ in range(400):
        capacity = rng.choice([6, 10, 17, 30])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        least = best(sizes, capacity) if sizes else 0
        bound = best_fit_packing.lower_bound(np.bincount(np.array(sizes, dtype=int), minlength=capacity + 1))
        assert bound <= least
        tight += bound == least
    assert tight > 350
    # Lengths above a half: their sum alone would say 51.
    assert best_fit_packing.lower_bound(np.bincount([1030] * 100, minlength=2049)) == 100


def brute_pieces(rows, cfg):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(queries.WORD_MODEL).encode
    result = collections.Counter()
    for i, t in rows:
        ids = encode(t or "", add_special_tokens=False).ids + [cfg.closing]
        for k in range(0, len(ids), cfg.capacity):
            part = np.array(ids[k:k + cfg.capacity], dtype="<u4")
            result[i, k // cfg.capacity, k, len(part), zlib.crc32(part.tobytes())] += 1
    return result


def packing_rows(spark):
    rng = random.Random(8)
    alphabet = "ab zé́  漢\U0001F600\t\n\r\x0b\x1c\x85\xa0  ΣσςİıǅÅ.,'s's't0123<|endoftext|>Aﬁ"
    rows = ODD + [(9, "x<|endoftext|>y <|startoftext|> z"), (10, "ab" * 300), (11, "a" + "́" * 5 + " ́b"), (12, "word " * 5000)]
    rows += [(100 + k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80)))) for k in range(300)]
    return rows + [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("cfg", [Packing(), Packing(capacity=64, pieces_per_task=40, memory_words=50, longest_word=3)])
def test_packing_is_whole_and_gapless(spark, cfg):
    rows = packing_rows(spark) + [(5, "copies of one text")] * 200
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, start int, length int, ids string").repartition(7)
    placed = best_fit_packing.pack(docs, queries.WORD_MODEL, Staging(spark), cfg, with_ids=True)
    got = placed.collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute_pieces(rows, cfg)
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= cfg.capacity
    count, bound = best_fit_packing.certificate(placed, cfg)
    assert count == len(by_sequence) and bound <= count <= 1.01 * bound + 1
    whole = {r.sequence_id: r for r in best_fit_packing.sequences(placed).collect()}
    for r in got:
        assert bytes(whole[r.sequence_id].ids[4 * r.offset:4 * (r.offset + r.length)]) == bytes(r.ids)
    assert all(len(w.ids) == 4 * w.length for w in whole.values())


def test_partitions_exchange_until_the_bound_is_met(spark):
    # 60 partitions that each leave a gap: together their documents fill whole sequences.
    docs = spark.range(60 * 5, numPartitions=60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a "), 400).alias("text"))
    placed = best_fit_packing.pack(docs, queries.WORD_MODEL, Staging(spark), Packing(capacity=1203))
    assert best_fit_packing.certificate(placed, Packing(capacity=1203)) == (100, 100)
    assert best_fit_packing.pack(docs.limit(0), queries.WORD_MODEL, Staging(spark)).count() == 0
