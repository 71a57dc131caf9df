"""Frames and brute-force versions for the tests of the corpus operators."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACES = re.compile(r"[\x20\x09-\x0D]+")
WORDS = re.compile(rb"[^\x20\x09-\x0d]+")


def documents(spark, texts, extra=False):
    """Documents with ids 1, 2, ... ; with ``extra``, columns whose names clash with those of the operators."""
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts, 1)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("score", "kept", "row", "h1", "a", "n", "gone", "sha", "length", "rule", "host", "label", "bucket"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def shingles(text, words):
    found = WORDS.findall((text or "").encode().lower())
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[k : k + words]) for k in range(len(found) - words + 1))


class Groups:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def link(self, x, y):
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def near_groups_brute(docs, words, percent):
    """{doc_id: (set size, component)} from (doc_id, text) pairs, every pair that shares a shingle compared in full."""
    sets = {d: shingles(t, words) for d, t in docs}
    holders, groups = defaultdict(list), Groups()
    for d in sorted(sets):
        common = Counter(e for s in sets[d] for e in holders[s])
        for e, k in common.items():
            if 100 * k >= percent * (len(sets[d]) + len(sets[e]) - k):
                groups.link(d, e)
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(s), groups.find(d)) for d, s in sets.items()}


def exact_brute(docs):
    """{doc_id: keep_id} from (doc_id, text) pairs."""
    same = defaultdict(list)
    for d, t in docs:
        same[SPACES.sub("", t or "")].append((-len(t or ""), d))
    return {d: min(g)[1] for g in same.values() for _, d in g}
