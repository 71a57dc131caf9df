from __future__ import annotations

import hashlib

import duckdb
from helpers import SPACES, documents, exact_brute

from revlens.llm.exact_dedup import OP7_SQL, exact_dedup, op7_exact_dedup


def test_edges_and_hot_groups(spark):
    texts = ["a b", "ab", " a b ", None, "", " \n", "x" * 300_000, "x" * 300_000 + " ", "Ab", "é\u00a0", "é"] + ["same text"] * 60
    df = documents(spark, texts, extra=True)
    want = exact_brute(enumerate(texts, 1))
    for limit in (1000, 7):  # with 7, the group of 60 is hot: pre-aggregated and dealt over slices
        got = {r.doc_id: r for r in exact_dedup(df, group_rows=limit).collect()}
        assert {d: r.keep_id for d, r in got.items()} == want
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got.values())
        assert got[12].group_size == 60 and got[1].group_size == 3
        assert sorted(d for d, r in got.items() if r.stays) == sorted(set(want.values()))
        assert got[2].text_sha256 == hashlib.sha256(SPACES.sub("", "ab").encode()).hexdigest()


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "t"), (5, "t"), (5, "t"), (None, "only")], "doc_id bigint, text string")
    for limit in (1000, 1, 2):  # with 1, rows that repeat an id are in slices of a hot group
        found = exact_dedup(df, group_rows=limit, carry=True).collect()
        got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found), key=str)
        assert got == [(5, 5, 3, True), (5, 5, 3, True), (None, 5, 3, False), (None, None, 1, True)]
        assert sorted(((r.row.doc_id, r.row.text) for r in found if r.stays), key=str) == [(5, "t"), (None, "only")]
    assert exact_dedup(df.limit(0)).count() == 0


def test_plan_is_native_with_one_text_shuffle(spark, small_dir):
    plan = op7_exact_dedup(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange rangepartitioning") == 1


def test_sql(spark, small_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small_dir}/documents.parquet')")
    assert sorted(con.sql(OP7_SQL).fetchall()) == sorted(tuple(r) for r in op7_exact_dedup(spark, small_dir).collect())
