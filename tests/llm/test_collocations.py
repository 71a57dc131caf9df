from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from revlens.llm import collocations as C

PIECES = re.compile(r"[.,;:!?\x0A-\x0D]")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, rank string, ids bigint"


def brute(docs, least, top, most=5):
    """Rows of (lang, rank, phrase, a, l, r, n, score) from (text, lang) pairs, by counting every phrase."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in PIECES.split((text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    gone = set()
    for p, a in candidates.items():
        for k in range(2, len(p) - 1):
            gone |= {(p[0], *p[i : i + k]) for i in range(1, len(p) - k + 1) if a >= f[(p[0], *p[i : i + k])]}
    rows = []
    for p, a in candidates.items():
        if p not in gone:
            cuts = [(f[p[:k]], f[(p[0], *p[k:])]) for k in range(2, len(p))]
            score, _, l, r = min((1000 * a * n[p[0]] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            rows.append((p[0], -score, -a, " ".join(p[1:]).encode(), l, r))
    out = []
    for lang in n:
        for rank, (_, s, a, p, l, r) in enumerate(sorted(x for x in rows if x[0] == lang)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus(seed, size=300):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)] + ["é", "É", "ß", "a b", "-"]
    phrases = [" ".join(rng.choices(vocabulary, k=rng.randrange(2, 7))) for _ in range(12)]
    docs = []
    for _ in range(size):
        parts = [rng.choice(phrases) if rng.random() < 0.6 else rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for p in parts)
        docs.append((text.upper() if rng.random() < 0.1 else text, rng.choice(["en", "de", None, "und", ""])))
    return docs + [(None, "en"), ("", "en"), (" .\t", None), ("the " * 5000, "en"), ("Only, once.", "fr")] + docs[:9]


def frame(spark, docs):
    return spark.createDataFrame([(None, t, lang, "x", 1) for t, lang in docs], DOCS)


@pytest.mark.parametrize(("held", "burst", "partition"), [(C.HELD, C.BURST, C.PARTITION_WORDS), (60, 3, 400)])
def test_against_brute_force(spark, monkeypatch, held, burst, partition):
    monkeypatch.setattr(C, "PARTITION_WORDS", partition)  # with 400: many prefix partitions, spills and bursts
    docs = corpus(1)
    df = frame(spark, docs).repartition(5)
    for least, top in ((20, 2000), (4, 25)):
        got = C.collocations(df, least, top, held=held, burst=burst)
        assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string")] + [(c, "bigint") for c in ("a", "l", "r", "n", "score")]
        assert sorted(map(tuple, got.collect())) == brute(docs, least, top)


def test_trie_bursts_spills_whole_subtrees_and_keeps_counts():
    rng = random.Random(2)
    trie, want, spilled = C.PhraseTrie(3), Counter(), Counter()
    for _ in range(4000):
        phrase = np.array(rng.choices(range(9), k=rng.randrange(2, 6)), dtype=np.uint64).tobytes()
        trie.add(phrase, 2)
        want[phrase] += 2
        if trie.held > 500:
            run = list(trie.spill(250))
            heads = {p[:8] for p, _ in run}
            assert trie.held <= 250 and not heads & set(trie.root)
            spilled.update(dict(run))
    assert any(type(below) is C.PhraseTrie.Node for below in trie.root.values())
    spilled.update(dict(trie.spill(-1)))
    assert spilled == want and trie.held == 0


def test_runs_name_frequent_words_by_codes_and_lose_no_other():
    rng = np.random.default_rng(3)
    ids = np.unique(rng.integers(1, 2**64, 400, dtype=np.uint64))
    rare = ids[::7]
    book = np.setdiff1d(ids, rare)
    phrases = {tuple(rng.choice(ids, n)): int(rng.choice([1, 300, 70_000, 2**40])) for n in (2, 3, 5) for _ in range(2000)}
    spilled = [(np.array(p, dtype=np.uint64).tobytes(), count) for p, count in phrases.items()]

    def sizes(book):
        found, size = {}, 0
        for batch in C._runs(iter(spilled), 4, book):
            for row in batch.to_pylist():
                size += len(row["ids"])
                merged = list(C._merged((row["part"], row["n"]), [(row["m"], row["ids"], row["counts"])], 1, book))
                for got in merged[0].to_pylist():
                    found[tuple(np.array(got["ids"], dtype=np.int64).view(np.uint64))] = got["a"]
        assert found == phrases
        return size

    plain = sum(len(p) for p, _ in spilled)
    assert sizes(book) < plain / 2
    assert sizes(ids) == plain / 4
    assert sizes(book[:0]) == plain * 5 / 4


def test_codebook_takes_the_most_frequent_words_that_fit(spark):
    words = spark.createDataFrame([(-i, 2**i) for i in range(1, 9)] + [(100 + i, 100) for i in range(5)], "id bigint, a bigint")
    assert C.codebook(words, 2).view(np.int64).tolist() == [-8, -7]
    assert C.codebook(words, 6).view(np.int64).tolist() == [-8, -7]  # the five words at 100 don't fit
    assert C.codebook(words, 7).view(np.int64).tolist() == [100, 101, 102, 103, 104, -8, -7]
    assert len(C.codebook(words, 1)) == 1 and len(C.codebook(words.where("a = 100"), 4)) == 0


def test_shared_ids_are_counted_again_with_another_seed(spark, monkeypatch):
    plain = C.words_of

    def colliding(texts, lang, seed):
        raw, starts, ends, ids, follows = plain(texts, lang, seed)
        return raw, starts, ends, (ids % np.uint64(3) if seed == 0 else ids), follows

    docs = [("a b c d", "en")] * 30
    df = frame(spark, docs)
    monkeypatch.setattr(C, "words_of", colliding)
    assert sorted(map(tuple, C.collocations(df, 10).collect())) == brute(docs, 10, 2000)


def test_empty_rare_and_filter(spark):
    df = frame(spark, [("a b", "en"), (None, None)])
    assert C.collocations(df.limit(0)).count() == 0
    assert C.collocations(df, least=2).count() == 0
    ids = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    may = C.filter_of(spark.createDataFrame([(int(x),) for x in ids[:2500]], "h bigint"))
    assert may(ids[:2500].view(np.uint64)).all() and may(ids[2500:].view(np.uint64)).mean() < 0.01


def test_sql(spark, small_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small_dir}/documents.parquet')")
    want = sorted(con.sql(C.OP12_SQL).fetchall())
    assert want and want == sorted(tuple(r) for r in C.op12_collocations(spark, small_dir).collect())
