from __future__ import annotations

import random
import time

import numpy as np
import pytest
from helpers import Groups, documents, near_groups_brute, shingles
from pyspark.sql import functions as F

from revlens.llm import components as C
from revlens.llm import embedding_dedup as E
from revlens.llm import minhash_dedup as M


@pytest.mark.parametrize("at_once", [1_000_000, 60])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, at_once):
    monkeypatch.setattr(C, "EDGES_PER_TASK", at_once)  # with 60, contraction rounds come first
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 100)] + [(1000, k) for k in range(1001, 1200)] + [(7000, 7000), (None, 3), (2, None)]
    edges += [(rng.randrange(2000, 2600), rng.randrange(2000, 2600)) for _ in range(250)]
    rng.shuffle(edges)
    want = Groups()
    for u, v in edges:
        if u is not None and v is not None and u != v:
            want.link(u, v)
    got = {r.node: r.component for r in C.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {k: want.find(k) for k in want.parent}
    assert C.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def variants(rng, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_groups_against_brute_force(spark, words, percent):
    rng = random.Random(words)
    texts = []
    for size in (12, 60, 300):
        for edits in (1, 3, 8):  # many pairs lie around the threshold, so groups hang together by chains
            texts += variants(rng, [f"v{rng.randrange(500)}" for _ in range(size)], 25, edits)
    texts += ["one", "One", "one two", "ONE\ttwo", "a b c d e", None, "", " \n", "é É", "É É"] + texts[:5] + [" ".join(["la"] * 30_000)] * 2
    docs = list(enumerate(texts, 1))
    got = {r.doc_id: r for r in M.near_groups(documents(spark, texts, extra=True), words, percent).collect()}
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == near_groups_brute(docs, words, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_groups_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (9, "a b c d"), (None, "p q r s"), (None, "p q r s")], "doc_id bigint, text string")
    found = M.near_groups(df, 3, 85).collect()
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in found), key=str)
    assert got == [(4, 4, True), (4, 4, True), (9, 4, False), (None, 4, False), (None, None, True), (None, None, True)]
    assert sorted(str(r.doc_id) for r in found if r.stays) == ["4", "None"]
    assert M.near_groups(df.limit(0)).count() == 0


def test_rows_that_share_an_id_keep_their_own_links(spark):
    words = [f"w{k}" for k in range(80)], [f"x{k}" for k in range(80)]
    a, b = (" ".join(w) for w in words)
    near_a, near_b = a + " more", b + " more"
    rows = [(5, a), (5, b), (7, near_a), (9, near_b)]
    for order in (rows, rows[::-1], [rows[1], rows[0], rows[3], rows[2]]):
        got = M.near_groups(spark.createDataFrame(order, "doc_id bigint, text string"), 3, 85).collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (7, 5), (9, 5)]
        assert sorted(r.doc_id for r in got if r.stays) == [5, 5]


def test_large_sets_and_open_buckets_in_pieces(spark, monkeypatch):
    """Slices of a few shingles and blocks of a few members give what whole sets and buckets give."""
    monkeypatch.setattr(M, "SLICE", 16)
    monkeypatch.setattr(M, "BLOCK", 3)
    monkeypatch.setattr(M, "ROWS", 1)  # every bucket holds many that are not linked
    rng = random.Random(9)
    base = [f"v{rng.randrange(400)}" for _ in range(120)]
    texts = [t for edits in (2, 6, 9, 14) for t in variants(rng, base, 12, edits)]
    texts += [t for edits in (1, 4) for t in variants(rng, base[:40], 12, edits)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.near_groups(documents(spark, texts), 3, 70).collect()}
    assert got == near_groups_brute(list(enumerate(texts, 1)), 3, 70)


def test_open_buckets_of_thousands_are_compared_in_seconds(spark):
    """Millions of pairs that are not linked; the two that may be come back once, though both buckets hold them."""
    rng, n = np.random.default_rng(6), 7000
    odd, whole, bands = (rng.integers(-(1 << 63), 1 << 63, (n, k)) for k in (M.SKETCH_BITS // 64, M.SET_BITS // 64, M.BANDS))
    bands[:, 3], bands[:, 5] = 77, 78
    group = np.where(np.arange(n) < 500, 0, np.arange(n))
    for x, y in [(3, 4), (7, 6000), (600, 5000)]:  # in the main group, across it, outside it
        odd[x], whole[x] = odd[y], whole[y]
    rest = [(n, k, int(group[k]), 0, 190, odd[k].tolist(), whole[k].tolist(), bands[k].tolist()) for k in range(n)]
    kinds = "size bigint, a bigint, group bigint, main bigint, a_n bigint, a_odd array<bigint>, a_whole array<bigint>, a_bands array<bigint>"
    frame = spark.createDataFrame(rest, kinds).localCheckpoint()
    frame = frame.withColumn("bucket", F.explode(F.array(F.lit(77).cast("bigint"), F.lit(78).cast("bigint"))))
    began = time.monotonic()
    got = sorted((min(r.a, r.b), max(r.a, r.b)) for r in M._across(frame, 85).collect())
    assert got == [(7, 6000), (600, 5000)]
    assert time.monotonic() - began < 40


def test_sketch_bounds():
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 10**6, 400)]
    a, b = " ".join(base), " ".join(base[:380] + [f"x{k}" for k in range(20)])
    sets = M.shingle_sets([a, b], 3)
    assert [len(s) for s in sets] == [len(shingles(a, 3)), len(shingles(b, 3))]
    bits = [M._parity(np.zeros(len(s), np.int64), s % np.uint64(M.SET_BITS), 1, M.SET_BITS) for s in sets]
    differ = sum(int(x).bit_count() for x in (bits[0] ^ bits[1]).view(np.uint64).ravel())
    assert differ <= len(set(sets[0]) ^ set(sets[1]))


def vectors_brute(rows, threshold):
    groups, links = Groups(), {}
    ok = [(i, np.array(v, float), lab) for i, v, lab in rows if v is not None and lab is not None and None not in v]
    ok = [x for x in ok if np.isfinite(x[1]).all() and (x[1] != 0).any()]
    for i, _, _ in rows:
        groups.find(i)
        links[i] = 0
    for p, (i, x, a) in enumerate(ok):
        for j, y, b in ok[p + 1 :]:
            if a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                groups.link(i, j)
                links[i], links[j] = links[i] + 1, links[j] + 1
    return {i: (links[i], groups.find(i)) for i, _, _ in rows}


@pytest.mark.parametrize("block", [1500, 20])
def test_embedding_groups_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)  # with 20, buckets are cut into blocks
    rng = np.random.default_rng(2)
    rows = []
    for label in (0, 1):
        centres = rng.normal(size=(4, 16))
        for c in centres:
            rows += [(c + rng.normal(scale=s, size=16) * np.sqrt((c * c).sum() / 16), label) for s in (0.02, 0.1, 0.14) for _ in range(25)]
    rows += [(rows[0][0], 0), (rows[0][0], 0), (rows[0][0] * 3, 0), (rows[0][0], 1), (rows[0][0], None), (None, 0), (np.zeros(16), 0)]
    rows += [([None] * 16, 0), ([float("nan")] * 16, 0), ([float("inf")] * 16, 0), ([], 0), ([1.0, 2.0], 0), ([2.0, 4.0], 0)]
    data = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab, "clash") for k, (v, lab) in enumerate(rows)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int, weight string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.embedding_groups(df).collect()}
    assert got == vectors_brute([d[:3] for d in data], E.THRESHOLD)


def test_vectors_that_share_an_id_keep_their_own_links(spark):
    rows = [(5, [1.0, 0.0, 0.0], 1), (5, [0.0, 1.0, 0.0], 1), (7, [1.0, 0.01, 0.0], 1), (9, [0.0, 1.0, 0.01], 1), (8, [0.0, 0.0, 1.0], 1), (6, [0.0, 0.01, 1.0], 1)]
    for order in (rows, rows[::-1], [rows[k] for k in (3, 5, 0, 4, 2, 1)]):
        got = E.embedding_groups(spark.createDataFrame(order, "vec_id bigint, embedding array<float>, label int")).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(5, 1, 5), (5, 1, 5), (6, 1, 6), (7, 1, 5), (8, 1, 6), (9, 1, 5)]
        assert [r.vec_id for r in got if r.kept].count(5) == 2


def test_embedding_groups_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1)], "vec_id bigint, embedding array<float>, label int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.embedding_groups(df).collect()), key=str)
    assert got == [(3, 1, 3, True), (3, 1, 3, True), (None, 0, None, True)]
    assert E.embedding_groups(df.limit(0)).count() == 0
