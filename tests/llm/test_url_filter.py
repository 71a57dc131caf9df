from __future__ import annotations

import duckdb
import pytest

from revlens.llm import url_filter as U

SCHEMA = "page_id bigint, url string, html string, host string, verdict string"


def judge(spark, urls):
    df = spark.createDataFrame([(k, u, None, "clash", "clash") for k, u in enumerate(urls)], SCHEMA)
    return {r.page_id: r for r in U.url_filter(df).collect()}


def test_rules_host_and_path(spark):
    urls = [
        "https://a.example.org/en/1570?page=2",
        "http://EXAMPLE.org/es/1",
        "http://example.org/fr/1",
        "http://notexample.org/es/",
        "http://x.com/fr/9#top",
        "http://x.com/de/",
        "http://x.com/es/",
        "http://org",
        "nothing",
        None,
        "",
        "http://org/?a",
        "a://b://c/d",
    ]
    got = judge(spark, urls)
    assert [(got[k].host, got[k].path, got[k].rule, got[k].verdict) for k in range(len(urls))] == [
        ("a.example.org", "/en/1570", "example.org/en/1", "block"),
        ("example.org", "/es/1", "example.org/es/", "block"),
        ("example.org", "/fr/1", "org/", "allow"),
        ("notexample.org", "/es/", "org/", "allow"),
        ("x.com", "/fr/9", "com/fr/", "allow"),
        ("x.com", "/de/", "com/de/", "block"),
        ("x.com", "/es/", None, "allow"),
        ("org", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("org", "/", "org/", "allow"),
        ("b:", "//c/d", None, "allow"),
    ]


@pytest.mark.parametrize(
    ("url", "verdict"),
    [
        ("https://adult-x.example.net/", "block"),  # one strict term
        ("https://adulthood.example.net/", "allow"),  # no boundary after the term
        ("https://cheap-pills.example.net/", "block"),  # two soft terms
        ("https://cheap-cheap.example.net/", "allow"),  # one soft term twice
        ("https://x.net/FREE?b=Bets", "block"),
        ("https://x.net/free.html", "allow"),
        ("https://x.net/" + "free-" * 20000 + "win", "block"),
    ],
)
def test_vocabulary(spark, url, verdict):
    assert judge(spark, [url])[0].verdict == verdict


def test_weights(spark):
    words = [("Casino", "strict", 1.0), ("casino", "soft", 9.0), ("free", "soft", 0.5), ("bonus", "soft", 0.5), ("win", "soft", 1.5), ("a.b", "soft", 0.5)]
    urls = ["x://casino/", "x://free-bonus/", "x://free-win/", "x://free/bonus/a.b/free", "x://win-win", "x://free-bonus-win"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = [(r.strict_hits, r.soft_hits, r.soft_weight, r.verdict) for r in U.url_filter(df, (), words).orderBy("page_id").collect()]
    assert got == [
        (1, 0, 0.0, "block"),  # strict wins over soft
        (0, 2, 1.0, "allow"),  # several, but too light
        (0, 2, 2.0, "block"),
        (0, 3, 1.5, "allow"),
        (0, 1, 1.5, "allow"),
        (0, 3, 2.5, "block"),
    ]
    assert {r.verdict for r in U.url_filter(df, (), ()).collect()} == {"allow"}
    for bad in (("", "soft", 1.0), ("x", "hard", 1.0), ("x", "soft", -1.0)):
        with pytest.raises(ValueError, match="strict or soft"):
            U.url_filter(df, (), [bad])


def test_a_vocabulary_is_a_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "words")
    spark.createDataFrame([("apuestas", "strict", None), ("gratis", "soft", 2.0)], "term string, class string, weight double").write.parquet(path)
    words = U.read_vocabulary(spark, path)
    assert sorted(words) == [("apuestas", "strict", 1.0), ("gratis", "soft", 2.0)]
    df = spark.createDataFrame([(1, "x://apuestas.es/"), (2, "x://gratis.es/")], "page_id bigint, url string")
    assert [r.verdict for r in U.url_filter(df, (), words).orderBy("page_id").collect()] == ["block", "allow"]
    monkeypatch.setattr(U, "MAX_TERMS", 1)
    with pytest.raises(ValueError, match="more than"):
        U.read_vocabulary(spark, path)


def test_any_two_built_in_soft_terms_weigh_enough():
    assert min(w for _, kind, w in U.VOCABULARY if kind == "soft") * U.SOFT_MIN >= U.SOFT_WEIGHT
    assert not set(U.STRICT) & set(U.SOFT) and set(U.HEAVY) <= set(U.SOFT)


def test_empty_and_repeated(spark):
    assert judge(spark, []) == {}
    df = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (None, "x")], "page_id bigint, url string")
    assert U.url_filter(df).count() == 3


def test_sql(spark, small_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{small_dir}/pages.parquet')")
    want = sorted(con.sql(U.op6_sql()).fetchall(), key=str)
    got = sorted((tuple(r) for r in U.op6_url_filter(spark, small_dir).collect()), key=str)
    assert got == want
