"""The pipeline's stages on a small fixture, decision by decision."""

from __future__ import annotations

import corpus_pipeline as P
from kithline.plans import staging as plans
from kithline.plans.staging import Staging

WORDS = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
ITEM = " ".join(f"item{chr(97 + k)}" for k in range(20))
BASE = " ".join(WORDS)
ROWS = [
    (1, BASE, "xx"), (2, BASE, "xx"), (3, " ".join(WORDS[:119] + ["other"]), "xx"), (4, None, "xx"), (5, "12 34 !!", None), (6, "", "xx"),
    (7, f"some text before {ITEM} and some after", "yy"), (8, "here is password = hunter2hunter2 and more text", "yy"),
    (9, "a clean text that stays as it is", None), (None, "no id but clean", "yy"), (10, "ein", "yy"),
]


def test_stages(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    kept = []
    staging = Staging(spark)
    for name, stage in P.STAGES:
        docs = staging.put(stage(spark, docs, str(tmp_path)), name).df
        kept.append({r.doc_id: r for r in docs.collect()})
        assert name == P.STAGES[-1][0] or tuple(docs.columns) == P.COLUMNS
    assert set(kept[0]) == {1, 2, 3, 7, 8, 9, None, 10}
    assert kept[0][9].lang in ("xx", "yy") and all(kept[0][i].lang == lang for i, _, lang in ROWS if i in kept[0] and i != 9)
    assert set(kept[1]) == {1, 7, 8, 9, None, 10}
    assert set(kept[2]) == {1, 8, 9, None, 10}
    assert kept[3][8].text == "here is [secret] and more text" and kept[3][8].n_chars == len(kept[3][8].text)
    assert {i: r.text for i, r in kept[3].items() if i != 8} == {i: t for i, t, _ in ROWS if i in (1, 9, None, 10)}
    assert set(kept[4]) == set(kept[3]) and all(r.round_trip for r in kept[4].values())


def test_a_run_leaves_only_its_result(spark, tmp_path, monkeypatch):
    folder = tmp_path / "shared"
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in ROWS], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(plans, "shared_folder", lambda spark: str(folder))
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} == {1, 8, 9, None, 10}
    assert [p.name for run in folder.iterdir() for p in run.iterdir()] == ["001-sentencepiece"]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_rows_without_id_are_decided(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    other = " ".join(reversed(WORDS))
    rows = [(1, BASE, "a"), (None, BASE, "a"), (None, " ".join(WORDS[:119] + ["other"]), "a"), (None, other, "b"), (None, other, "a"),
            (None, other, "a"), (None, "a text of its own", "a"), (None, f"before {ITEM} after", "a"), (None, "", "a"), (None, "", "a"), (None, None, "a")]
    docs = spark.createDataFrame([(i, t, "xx", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    once = P.one_per_group(spark, docs, str(tmp_path))
    assert tuple(once.columns) == P.COLUMNS and once.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    left = [rows[0], rows[4], *rows[6:]]
    assert sorted(((r.doc_id, r.text, r.source) for r in once.collect()), key=str) == sorted(left, key=str)
    clean = P.without_benchmark(spark, once, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text, r.source) for r in clean), key=str) == sorted([r for r in left if ITEM not in (r[1] or "")], key=str)
