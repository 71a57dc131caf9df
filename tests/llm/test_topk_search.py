from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import topk_search as T


def brute(rows, asks, k):
    """Sorted (query_id, rank, vec_id, score), every pair in unbounded integers."""
    whole = []
    for at, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((at, i, [math.floor(256 * x) for x in v]))
    out = []
    for at, i, v in whole:
        if i is not None and asks(i):
            found = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j) for o, j, w in whole if o != at and len(w) == len(v)]
            out += [(i, r, j, -s) for r, (s, _, _, j) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, rank string, part int")


@pytest.mark.parametrize(("block", "digit"), [(4096, 12), (16, 7)])
def test_against_brute_force(spark, monkeypatch, block, digit):
    monkeypatch.setattr(T, "BLOCK_ROWS", block)
    monkeypatch.setattr(T, "DIGIT", digit)
    rng = np.random.default_rng(4)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=6)]) for k in range(120)]
    rows += [(200 + k, rows[0][1]) for k in range(60)]  # ties: a third of the rows are copies
    rows += [(10, rows[3][1]), (10, rows[3][1]), (None, rows[0][1]), (None, rows[0][1])]
    rows += [(300, None), (310, [None] * 6), (320, [float("nan")] * 6), (330, [float("inf")] + [0.0] * 5), (340, [0.0] * 6)]
    rows += [(400, [1.0, 2.0]), (410, [2.0, -1.0]), (420, [1.0, 1.0]), (500, [3.0]), (600, []), (610, [])]
    got = T.nearest(frame(spark, rows), F.col("vec_id") % 10 == 0, k=5)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, lambda i: i % 10 == 0, 5)


def test_long_products_and_negative_scores(spark):
    rows = [(k, [float((-1) ** k * 2.0**17 * k), 2.0**20 + k / 256, -float(k)]) for k in range(40)]
    got = T.nearest(frame(spark, rows, "double"), F.col("vec_id") % 7 == 0, k=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, lambda i: i % 7 == 0, 3)


def test_components_beyond_64_bits_hold_the_score(spark):
    rows = [(0, [1e38, 1.0]), (1, [1e38, 0.0]), (2, [-1e38, 0.0]), (3, [0.0, 1.0])]
    got = [tuple(r) for r in T.nearest(frame(spark, rows), F.col("vec_id") == 0, k=3).orderBy("rank").collect()]
    assert got == [(0, 1, 1, T.LONG_MAX), (0, 2, 3, 256 * 256), (0, 3, 2, -T.LONG_MAX)]


def test_empty_table_and_no_queries(spark):
    df = frame(spark, [(1, [1.0]), (2, [2.0])])
    assert T.nearest(df.limit(0), F.lit(True), k=5).count() == 0
    assert T.nearest(df, F.col("vec_id") > 9, k=5).count() == 0
    assert [r.score for r in T.nearest(df.where("vec_id = 1"), F.lit(True), k=5).collect()] == []


def test_sql(spark, small_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{small_dir}/embeddings.parquet')")
    assert sorted(con.sql(T.OP13_SQL).fetchall()) == sorted(tuple(r) for r in T.op13_topk_search(spark, small_dir).collect())
