from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.llm import license_scan as L

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
SCHEMA = "doc_id bigint, path string, text string, dir string, how string"
FILES = [
    ("repo/LICENSE", f"{MIT}\nCopyright by someone"),
    ("repo/a.c", "int main;"),
    ("repo/src/b.c", "x"),
    ("repo/src/deep/er/c.c", None),
    ("repo/src/gpl/COPYING.txt", GPL),
    ("repo/src/gpl/d/e.c", ""),
    ("repo/src/gpl/d/f.c", f"code\n{MIT}\nmore code " + "long " * 50_000),
    ("other/LICENSE", "no notice here"),
    ("other/g.c", "text about a license of no kind"),
    ("repository/h.c", "not below repo"),
    ("top.c", "no directory"),
    (None, MIT),
    (None, "text"),
    ("ties/LICENSE", MIT),
    ("ties/COPYING", GPL),
    ("ties/z.c", ""),
]


def brute(files):
    """Own licences from the matcher, inheritance by walking up the directories."""
    total, seen = len(files), Counter()
    for _, t in files:
        seen.update(set(L.words(t or "")))
    matcher = L.Matcher(L.TEMPLATES, seen, total)
    own, covered = [], {}
    for path, text in files:
        found = [(-s, n) for s, n in map(matcher.best, L.candidates(text or "")) if n]
        s, n = min(found, default=(0, None))
        whole = matcher.best(text or "") if n else (0, None)
        is_file = whole[0] >= L.WHOLE or bool(n and path and L.LICENCE_NAME.search(path) and -s >= L.HEADER)
        if whole[0] >= L.WHOLE:
            s, n = -whole[0], whole[1]
        own.append(n if -s >= L.HEADER else None)
        if is_file and path and own[-1]:
            d = path.rpartition("/")[0]
            covered[d] = min(covered.get(d, (0, "~")), (s, n))
    out = []
    for (path, _), name in zip(files, own, strict=True):
        d = path.rpartition("/")[0] if path else None
        while name is None and d is not None:
            name = covered[d][1] if d in covered else None
            d = d.rpartition("/")[0] if d else None
        out.append(name)
    return out


def test_headers_files_and_inheritance(spark):
    df = spark.createDataFrame([(k, p, t, "clash", "clash") for k, (p, t) in enumerate(FILES)], SCHEMA)
    got = {r.doc_id: r for r in L.license_scan(df).collect()}
    assert [got[k].license for k in range(len(FILES))] == brute(FILES)
    by_path = {p: got[k] for k, (p, _) in enumerate(FILES) if p}
    assert (by_path["repo/a.c"].license, by_path["repo/a.c"].how) == ("MIT", "inherited")
    assert by_path["repo/src/deep/er/c.c"].license == "MIT"
    assert (by_path["repo/src/gpl/d/e.c"].license, by_path["repo/src/gpl/COPYING.txt"].how) == ("GPL-3.0", "file")
    assert (by_path["repo/src/gpl/d/f.c"].license, by_path["repo/src/gpl/d/f.c"].how) == ("MIT", "header")
    assert by_path["other/g.c"].license is None and by_path["repository/h.c"].how == "none"
    assert got[11].license == "MIT" and got[12].license is None


@pytest.mark.parametrize("hot_files", [0, 2, 1000])
def test_hot_directories_get_the_same_answers(spark, monkeypatch, hot_files):
    """At 0 all directories of more than a 200th of the files are broadcast, at 1000 none is."""
    monkeypatch.setattr(L, "HOT_FILES", hot_files)
    files = FILES + [("repo/src/hot/%d.c" % k, None) for k in range(40)] + [("no/where/%d.c" % k, "") for k in range(40)]
    df = spark.createDataFrame([(k, p, t) for k, (p, t) in enumerate(files)], "doc_id bigint, path string, text string")
    got = L.license_scan(df)
    assert [r.license for r in got.orderBy("doc_id").collect()] == brute(files)
    assert got.columns == ["doc_id", "path", "license", "how", "score"]


def test_files_that_ask_for_nothing_are_spread(spark):
    """No part of the join on directories gets a large share of the files, whatever a directory holds."""
    own = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("d/f").alias("path"), F.lit(None).cast("string").alias("own"),
        F.lit(0.0).alias("own_score"), F.lit(False).alias("is_file"), F.lit("d").alias("dir"),
    )
    answers = spark.createDataFrame([("d", 4000, None, None)], "dir string, n bigint, inherited string, inherited_score double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = L.with_answers(own, answers, 1000)
        keys = [r["n"] for r in met.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(keys) == 4000 and (len(keys) == 1 or max(keys) < 2000)


def test_every_template_finds_its_licence():
    matcher = L.Matcher(L.TEMPLATES, {}, 100)
    for name, text in L.TEMPLATES:
        score, found = matcher.best(f"{text}")
        assert found == name and math.isclose(score, 1.0)
    assert matcher.best("words of nothing like it")[0] < L.HEADER


def test_empty_repeated_and_null(spark):
    df = spark.createDataFrame([(1, "a/b", MIT), (1, "a/b", MIT), (None, "a/c", None)], "doc_id bigint, path string, text string")
    got = [(r.doc_id, r.license) for r in L.license_scan(df).collect()]
    assert sorted(got, key=str) == [(1, "MIT"), (1, "MIT"), (None, "MIT")]
    assert L.license_scan(df.limit(0)).count() == 0


def test_full_texts_cover_their_directory(spark):
    """Documents of the real table, with full licence texts put among them under plain names."""
    full = dict(L.FULL_TEXTS)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    files = [(f"{r.source}/{r.lang}/{r.doc_id}.txt", r.text) for r in docs]
    one, other = sorted({p.rpartition("/")[0] for p, _ in files})[:2]
    planted = {f"{one}/x.txt": "Apache-2.0", f"{other}/y.txt": "GPL-3.0", f"{other}/deep/z.txt": "MIT"}
    files += [(p, f"Copyright (c) 2019 Jane Doe\n\n{full[name]}") for p, name in planted.items()]
    files += [(f"{other}/deep/er/a.txt", "words"), (f"{one}/deep/er/b.txt", None), (f"{one}er/c.txt", "words")]
    df = spark.createDataFrame([(k, p, t) for k, (p, t) in enumerate(files)], "doc_id bigint, path string, text string")
    got = {r.path: r for r in L.license_scan(df).collect()}
    assert all((got[p].license, got[p].how) == (name, "file") for p, name in planted.items())
    covered = {p.rpartition("/")[0]: name for p, name in planted.items()}
    headers = {p for p, r in got.items() if r.how == "header"}
    for p, _ in files:
        if p not in headers and p not in planted:
            above = [d for d in covered if p.startswith(f"{d}/")]
            want = covered[max(above, key=len)] if above else None
            assert (got[p].license, got[p].how) == (want, "inherited" if want else "none")
    assert sum(r.how == "inherited" for r in got.values()) > 2
    assert (got[f"{other}/deep/er/a.txt"].license, got[f"{one}/deep/er/b.txt"].license) == ("MIT", "Apache-2.0")


def test_full_texts_are_told_apart():
    matcher = L.Matcher(L.FULL_TEXTS, {}, 100)
    assert {name for name, _ in L.FULL_TEXTS} >= {"Apache-2.0", "MIT", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "BSD-3-Clause", "MPL-2.0"}
    for name, text in L.FULL_TEXTS:
        score, found = matcher.best(f"Copyright 2019 Jane Doe. All rights reserved.\n{text}")
        assert found == name and score > L.FULL
    assert matcher.best("The licence of this text is the one of the book that it was taken from, and the author has it.")[0] < L.FULL


LONG = "words that say nothing of it and go on for a while, " * 40
HIDDEN = [
    ("// Copyright (c) 2019 Jane Doe. Released under the MIT License.", "MIT"),
    ("foolib v1.2 - Released under the MIT License.", "MIT"),
    ("Copyright 2018 Google LLC. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Licensed under CC BY-NC 4.0. All rights belong to their owners.", "CC-BY-NC-4.0"),
    ("/*! foolib v3.4.1 | (c) Foo Foundation and others | Released under the MIT License. */!function(a,b){return a+b}(window,document);", "MIT"),
    (f"{LONG}This work is licensed under the GNU General Public License, version 3, {LONG}", "GPL-3.0"),
    ("# foolib is free. This work is licensed under\n# the GNU General Public License,\n# version 2, by its many authors", "GPL-2.0"),
    (f"<html><body><nav>{LONG}</nav><p>Licensed under CC BY-SA 4.0.</p><footer>{LONG}</footer>", "CC-BY-SA-4.0"),
    (f"{LONG}and a license of no kind at all, under the license of nobody{LONG}", None),
    ("no permission to see the copyright office", None),
]


def test_notices_with_other_words_on_their_line(spark):
    rows = [(k, f"a/{k}.js", t) for k, (t, _) in enumerate(HIDDEN)]
    docs = [(100 + r.doc_id, "b/c", r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame(rows + docs, "doc_id bigint, path string, text string")
    got = {r.doc_id: r for r in L.license_scan(df).where("path LIKE 'a/%'").collect()}
    assert [(got[k].license, got[k].how) for k in range(len(HIDDEN))] == [(name, "header" if name else "none") for _, name in HIDDEN]


def test_spans_against_every_window():
    matcher = L.Matcher(L.TEMPLATES, {"the": 90, "license": 40, "under": 50, "a": 95, "of": 90, "version": 3}, 100)

    def vector(words):
        return {w: n * matcher.weight.get(w, matcher.other) for w, n in Counter(words).items()}

    def cosine(a, b):
        return sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    for text in [t[-400:] for t, _ in HIDDEN] + ["license " * 60 + "the the the license of the version", "", MIT]:
        found = list(L.WORD.finditer(text.lower()))
        words, cues = [m.group() for m in found], [m.start() for m in L.CUES.finditer(text)]
        holds = [any(m.start() <= c < m.end() for c in cues) for m in found]
        best = 0.0
        for _, template in L.TEMPLATES:
            n = min(len(L.words(template)), len(words))
            windows = [words[k : k + n] for k in range(len(words) - n + 1) if any(holds[k : k + n])]
            best = max([best, *(cosine(vector(w), vector(L.words(template))) for w in windows)])
        assert matcher.best_span(text)[0] == pytest.approx(best)
        assert matcher.best_span(text, 0.7)[0] == pytest.approx(best if best >= 0.7 else 0.0)
    for length in (4085, 4090, 4096, 10_000):
        assert matcher.best_span("x license " * length + f"{MIT} and" + " y" * length) == (pytest.approx(1.0), "MIT")
