from __future__ import annotations

import random

import duckdb
import pytest
from helpers import documents

from pyspark.sql import functions as F

from revlens.llm import line_dedup as L
from revlens.llm.line_dedup import OP10_SQL, line_dedup, op10_line_dedup

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    k = line.strip(SPACE).encode().lower().decode()
    return k if len(k) >= 10 else None


def brute(docs):
    first = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if key(line) is not None:
                first[key(line)] = min(d, first.get(key(line), d))
    return {d: "\n".join(x for x in (t or "").split("\n") if key(x) is None or first[key(x)] == d) for d, t in docs}


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_against_brute_force(spark, batches):
    rng = random.Random(batches)
    pool = ["a common line of text", "  A Common line of TEXT\t", "short", "", "ÉÉÉÉÉÉÉÉÉÉ", "éééééééééé", "ten chars.", "nine char", "x" * 50_000]
    texts = ["\n".join(rng.choices(pool + [f"line number {rng.randrange(40)}"], k=rng.randrange(9))) for _ in range(80)]
    texts += [None, "", "a common line of text\na common line of text"]
    got = {r.doc_id: r for r in line_dedup(documents(spark, texts, extra=True), batches=batches).collect()}
    want = brute(list(enumerate(texts, 1)))
    assert {d: r.text for d, r in got.items()} == want
    for d, t in enumerate(texts, 1):
        assert got[d].n_lines == len((t or "").split("\n"))
        assert got[d].n_lines - got[d].n_dropped == (len(want[d].split("\n")) if want[d] or got[d].n_dropped < got[d].n_lines else 0)


def test_null_ids_repeats_and_empty(spark):
    rows = [(2, "shared line one"), (2, "shared line one"), (None, "shared line one"), (None, "only without id"), (None, "only without id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.text, r.n_dropped) for r in line_dedup(df).collect()), key=str)
    assert got == sorted(
        [(2, "shared line one", 0)] * 2 + [(None, "", 1)] + [(None, "only without id", 0)] * 2, key=str
    )
    assert line_dedup(df.limit(0)).count() == 0


def test_many_rows_share_an_id_or_have_none(spark):
    """Each row loses the lines that it has itself; its list doesn't grow with the rows that share its id."""
    rows = [(1, "a line that is first")] + [(i, f"a line that is first\nown line number {k}") for k in range(30) for i in (7, None)]
    got = line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sum(r.n_dropped for r in got if r.doc_id == 7) == 30
    assert sorted(r.text for r in got if r.doc_id == 7) == sorted(f"own line number {k}" for k in range(30))
    assert all(r.text == "" and r.n_dropped == 2 for r in got if r.doc_id is None)


def test_runs_are_neither_shuffled_nor_sorted_for_a_merge(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keys = spark.range(500).select(F.xxhash64("id").alias("h1"), F.xxhash64("id", "id").alias("h2"), F.col("id").alias("first"))
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        runs = [L.write_run(keys.where(f"first % 3 = {k}"), buckets)[0] for k in (0, 1)]
        new = keys.groupBy("h1", "h2").agg(F.min("first").alias("first"))
        left = L.not_in_run(L.not_in_run(new, runs[0]), runs[1])
        plan = left._jdf.queryExecution().executedPlan().toString()
        # one exchange and one sort, of the batch's own keys
        assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange") == 1 and plan.count("Sort [") == 1, plan
        assert sorted(r.first for r in left.select("first").collect()) == [k for k in range(500) if k % 3 == 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_sql(spark, small_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small_dir}/documents.parquet')")
    assert sorted(con.sql(OP10_SQL).fetchall()) == sorted(tuple(r) for r in op10_line_dedup(spark, small_dir).collect())
