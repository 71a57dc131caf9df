from __future__ import annotations

import itertools

import numpy as np
import pytest
from helpers import documents, is_held_out

from revlens.llm import language_id as L
from revlens.llm import quality as Q

EDGES = [None, "", "123 — 456", "x" * 400_000, "the " * 100_000, "Ω" * 5, "中文文字", "the 中文", "\n\n"]


@pytest.fixture(scope="module")
def languages(spark):
    if spark.sparkContext.master is None:
        pytest.skip("no session")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, L.learn(docs.where(~L.held_out(L.F.col("doc_id"))))


def test_language_accuracy_on_held_out(spark, languages):
    docs, model = languages
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = {r.doc_id: r.lang_pred for r in L.language_id(docs, model).collect()}
    held = [d for d in truth if is_held_out(d)]
    assert np.mean([got[d] == truth[d] for d in held]) > 0.97


def test_language_edges(spark, languages):
    _, model = languages
    got = {r.doc_id: r for r in L.language_id(documents(spark, EDGES, extra=True), model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 9)] == ["und"] * 4 and all(got[k].score == 0 for k in (1, 2, 3, 9))
    assert got[5].lang_pred == "en" and got[6].lang_pred == model["langs"][0] and got[6].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    assert L.language_id(documents(spark, []), model).count() == 0
    none = {r.lang_pred for r in L.language_id(documents(spark, ["text"]), None).collect()}
    assert none == {"und"} and L.learn(documents(spark, [])) is None


def test_language_spans_of_mixed_text(spark, languages):
    docs, model = languages
    one = {r.lang: r.text for r in docs.where("n_chars between 400 and 900 and lang in ('en', 'fr')").collect()}
    text = one["en"] + " " + one["fr"]
    r = L.language_id(documents(spark, [text]), model).first()
    assert [s.lang for s in r.spans][0] == "en" and [s.lang for s in r.spans][-1] == "fr"
    assert abs(r.spans[-1].start - len(one["en"])) < 60 or len(r.spans) > 2


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(4)
    lengths = np.array([0, 1, 5, 7, 3, 0])
    scores = rng.normal(size=(lengths.sum(), 3)).astype(np.float32)
    path, at = L.viterbi(scores, lengths, 1.0), 0
    for n in lengths:
        own = scores[at : at + n]

        def total(p, own=own):
            return sum(own[k, x] for k, x in enumerate(p)) - sum(a != b for a, b in itertools.pairwise(p))

        best = max((total(p) for p in itertools.product(range(3), repeat=int(n))), default=0)
        assert total(path[at : at + n]) == pytest.approx(best, abs=1e-4)
        at += n


def test_script_narrows_candidates(spark):
    rows = [(k, "абв где жзи " * 9, "ru") for k in range(12)] + [(k, "abc def ghi " * 9, "en") for k in range(12, 24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = L.language_id(documents(spark, ["щщщ", "zzz", "щщщ zzz щщщ юю"]), L.learn(docs)).collect()
    assert [r.lang_pred for r in sorted(got)] == ["ru", "en", "ru"]


def test_machine_is_the_sum_over_pairs():
    rng = np.random.default_rng(6)
    p = {"w0": np.float64(0.3), "w": rng.normal(size=9), "v": rng.normal(size=(9, 4))}
    x = rng.normal(size=(5, 9))
    pairs = [sum((p["v"][i] @ p["v"][j]) * r[i] * r[j] for i in range(9) for j in range(i + 1, 9)) for r in x]
    assert Q.raw_score(p, x[:, :6], x[:, 6:]) == pytest.approx(0.3 + x @ p["w"] + pairs)


def test_quality_accuracy_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r.score for r in Q.quality_scores(docs, Q.learn(docs, labels)).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect() if is_held_out(r.doc_id)}
    assert len(got) == docs.count() and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[d] >= Q.THRESHOLD) == y for d, y in truth.items()]) > 0.95


def test_quality_edges(spark):
    docs = documents(spark, ["good clean text here"] * 30 + ["JUNK!! JUNK!!"] * 30 + EDGES, extra=True)
    labels = spark.createDataFrame([(k, int(k <= 30)) for k in range(1, 61)] + [(61, None), (None, 1), (62, 7)], "doc_id bigint, quality int")
    got = {r.doc_id: r.score for r in Q.quality_scores(docs, Q.learn(docs, labels)).collect()}
    assert len(got) == 60 + len(EDGES) and all(0 <= s <= 1 for s in got.values())
    assert got[1] > 0.7 > got[31]
    only = Q.learn(docs, labels.where("quality = 1"))
    assert {r.score for r in Q.quality_scores(docs, only).collect()} == {1.0}
    assert Q.learn(docs, labels.limit(0)) is None
    assert {r.score for r in Q.quality_scores(docs, None).collect()} == {0.5}
    assert Q.quality_scores(docs.limit(0), only).count() == 0
