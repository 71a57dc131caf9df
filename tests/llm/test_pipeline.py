from __future__ import annotations

import corpus_pipeline as C
import pytest
from helpers import DOCS, exact_brute, is_held_out, near_groups_brute

from revlens.llm import language_id as L
from revlens.llm import quality as Q
from revlens.llm.common import stored


@pytest.fixture(scope="module")
def stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs)
    for _, stage in C.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir)))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_filters_follow_their_operators(spark, stages):
    docs, after_language, after_quality = stages[:3]
    model = L.learn(docs.where(~L.held_out(L.F.col("doc_id"))))
    want = {r.doc_id for r in L.language_id(docs, model).collect() if r.lang_pred != "und" and r.score >= C.MIN_LANGUAGE_SHARE}
    assert set(texts(after_language)) == want
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    scores = Q.quality_scores(after_language, Q.learn(after_language, labels)).collect()
    assert set(texts(after_quality)) == {r.doc_id for r in scores if r.score >= Q.THRESHOLD}


def test_dedup_stages_against_brute_force(stages):
    before, exact, near = texts(stages[2]), texts(stages[3]), texts(stages[4])
    assert set(exact) == set(exact_brute(before.items()).values())
    assert set(near) == {c for _, c in near_groups_brute(exact.items(), 5, 80).values()}


def test_columns_and_pieces(spark, stages):
    assert all(df.columns == stages[0].columns for df in stages[:5])
    assert {r.doc_id for r in stages[5].collect()} == set(texts(stages[4]))
    assert sorted(C.run(spark, "/root/testdata/sf0.001").collect()) == sorted(stages[5].collect())


def test_edges(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, "plain words", "en", "s", 11), (4, "plain words", None, None, None), (4, "plain words", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS score", "'y' AS row", "'z' AS gone")
    for df in (docs, docs.limit(0)):
        for _, stage in C.STAGES:
            df = stored(stage(spark, df, "/root/testdata/sf0.001"))
        assert "length" in df.columns


def test_no_language_to_learn_from(spark):
    """Null everywhere, or only in the documents that are not held out: what has letters stays."""
    held = next(k for k in range(100) if is_held_out(k))
    free = [k for k in range(100) if not is_held_out(k)]
    rows = [(free[0], "plain words", None, "s", 11), (free[1], "12 34 %", None, "s", 7), (free[2], None, None, "s", 0), (None, "слово", None, "s", 5), (held, "mots", None, "s", 4)]
    for lang in (None, "fr"):
        docs = spark.createDataFrame([(*r[:2], lang if r[0] == held else None, *r[3:]) for r in rows], DOCS)
        kept = C.by_language(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} == {free[0], None, held}


def test_dedup_stages_judge_rows_not_ids(spark):
    words = " ".join(f"w{k}" for k in range(60))
    near, other = words + " more", " ".join(f"x{k}" for k in range(60))
    rows = [(4, words, "en", "s", 1), (4, words, "en", "s", 1), (4, other, "en", "s", 1), (None, near, "en", "s", 1), (9, near, "en", "s", 1), (None, "alone here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS body", "'y' AS hot_sha", "'z' AS rid")
    exact = C.one_of_equal(spark, docs, "")
    assert sorted(((r.doc_id, r.text) for r in exact.collect()), key=str) == sorted([(4, words), (4, other), (9, near), (None, "alone here")], key=str)
    left = C.one_of_near(spark, stored(docs), "")
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(4, words), (4, other), (None, "alone here")], key=str)
