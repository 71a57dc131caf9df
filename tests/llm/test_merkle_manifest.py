from __future__ import annotations

import random
import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from revlens.llm import merkle_manifest as M

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    told = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h(*told)


def climb(nodes, at):
    """The last digest, and the siblings (digest, whether it is left) of the node ``at`` level by level."""
    siblings = []
    while len(nodes) > 1:
        other = at ^ 1
        siblings.append((nodes[other], other < at) if other < len(nodes) else None)
        nodes, at = [h(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)], at // 2
    return nodes[0], siblings


def brute(rows):
    """Rows of op11 from (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda x: x[:3])
    subroots = [climb([x[2] for x in groups[g]], 0)[0] for g in langs]
    out = []
    for at, g in enumerate(langs):
        for k, (_, _, leaf, r) in enumerate(groups[g]):
            path = climb([x[2] for x in groups[g]], k)[1] + climb(subroots, at)[1]
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                node = leaf_of(*r[:4], None if r[4] is None else r[4] + 1)
            for s in path:
                node = h(node) if s is None else h(s[0], node) if s[1] else h(node, s[0])
            root = climb(subroots, 0)[0]
            out.append((r[0], leaf, subroots[at], root, h(*[s[0] for s in path if s]), node, node == root))
    return sorted(out, key=str)


def run(spark, monkeypatch, rows, tmp_path, bits=M.SLOT_BITS, fan=M.FAN_BITS):
    monkeypatch.setattr(M, "FAN_BITS", fan)
    plain = M.manifest
    monkeypatch.setattr(M, "manifest", lambda leaves: plain(leaves, bits))
    df = spark.createDataFrame(rows, DOCS)
    for name in ("grp", "pos", "n", "path", "leaf", "key", "rid", "root"):
        df = df.withColumn(name, F.lit("clash"))
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op11_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize(("bits", "fan"), [(M.SLOT_BITS, M.FAN_BITS), (2, 20)])
def test_against_brute_force(spark, monkeypatch, tmp_path, bits, fan):
    rng = random.Random(bits)
    ids = rng.sample(range(3000), 150) + [-5, -(1 << 63), (1 << 63) - 1, 1 << 40, 64, 63] + [7] * 40 + [None] * 30 + [8, 8]
    rows = [(i, rng.choice(["é" * 9, "", None, f"t{k}", "x" * 10_000]), rng.choice(["en", "de", "é", "", None]), rng.choice(["s", None]), rng.choice([None, k])) for k, i in enumerate(dict.fromkeys(ids))]
    rows += [(i, rng.choice(["a", "b"]), "en", "s", 1) for i in ids[len(rows) :]]
    rows += [(5000, "only", "fr", "s", 1), (5001, "a", "it", "s", 2), (5002, "b", "it", "s", 2), (5003, "c", "it", "s", 2)]
    assert run(spark, monkeypatch, rows, tmp_path, bits, fan) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(7, "a", "en", "s", 1)], [(7, "a", "en", "s", 1), (8, "b", None, "s", 1)], [(k, "a", None, "s", 1) for k in range(5)]])
def test_small_tables(spark, monkeypatch, tmp_path, rows):
    assert run(spark, monkeypatch, rows, tmp_path) == brute(rows)


def test_sql(spark, small_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small_dir}/documents.parquet')")
    assert sorted(con.sql(M.OP11_SQL).fetchall()) == sorted(tuple(r) for r in M.op11_merkle_manifest(spark, small_dir).collect())
