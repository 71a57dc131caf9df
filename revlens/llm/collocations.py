"""Phrases of several words that occur together more often than their parts suggest.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words ``[^\\x20\\x09]+``. A word's
id is a 64-bit hash of its language and its bytes. Phrases are counted in tries of word ids (HAT-tries):

1. ``PhraseTrie``: a shallow trie of word ids whose leaves are hash containers from the remaining ids of a phrase to its
   count. A container of more than ``BURST`` phrases bursts into one container for each next word. A task that holds
   more than ``HELD`` phrases spills its largest subtrees whole, as sorted runs, until half are left.
2. A run is cut by prefix partition, which a hash of a phrase's first two words decides. The runs of a prefix
   partition are merged in one place and the counts of equal phrases added. There are as many prefix partitions as
   the number of words asks for, so each one holds a bounded number of phrases, and hot first words are dealt by
   their second. A run names the most frequent words by codes of 2 bytes (``codebook``) and others by their ids.
3. No phrase is more frequent than its parts, so three passes count words, then pairs of frequent words, then phrases
   of 3 words and more whose pairs are all frequent. What is frequent is told to the tasks by a Bloom filter of
   ``FILTER_BITS`` bits, whatever the size of the input: a false positive costs a count that the merge drops,
   and nothing frequent is ever missed.

The first pass also proves that ids are unique, by the words themselves and inside a block by a second 64-bit hash: if a
frequent word shares its id with any other word, all is counted again with the next seed. Scores are computed in 38-digit decimals.

Defined results: a null or empty text has no words; a null language is ``und``, and shares its counts with documents
that say so; a repeated row counts again; ids are not read, so they may be null or repeated; texts may be of any length;
a language or table without frequent phrases gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import blocks, mix, stored, text_batches, word_hashes

MAX_WORDS = 5
HELD = 400_000  # phrases in a task's trie
BURST = 512  # phrases in a container
FILTER_BITS = 1 << 25
CODES = (1 << 16) - 1  # words with a code of 2 bytes; the code after the last stands for any other word
PARTITION_WORDS = 1 << 18  # words of the corpus for each prefix partition
UND = "und"

_CLASS = np.zeros(256, dtype=np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_CLASS[[0x20, 0x09]] = 1
_CLASS[list(b".,;:!?\n\x0b\x0c\r")] = 2
_U = np.uint64
_OTHER = np.uint8(0xA5)  # other byte keys, for a second hash
_LINK = _U(0x9E3779B97F4A7C15)


def _seed(lang: str, seed: int) -> np.uint64:
    return _U(int.from_bytes(hashlib.blake2b(f"{seed}:{lang}".encode(), digest_size=8).digest(), "little"))


def words_of(texts: list[str], lang: str, seed: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes, starts, ends and ids of the words, and whether each one follows its predecessor in a piece."""
    raw = "\n".join(texts).encode("utf-8", "surrogatepass").lower() + b"\n"
    data = np.frombuffer(raw, dtype=np.uint8)
    kind = _CLASS[data]
    inside = kind == 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    with np.errstate(over="ignore"):
        ids = mix(word_hashes(data ^ np.uint8(seed), starts, ends) ^ _seed(lang, seed))
    cuts = np.flatnonzero(kind == 2)
    piece = np.searchsorted(cuts, starts)
    follows = np.zeros(len(starts), dtype=bool)
    follows[1:] = piece[1:] == piece[:-1]
    return raw, starts, ends, ids, follows


def _blocks_by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    """Texts of one language, a few megabytes at a time."""
    by_lang: dict[str, list[str]] = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        by_lang[lang].append(text)
    for lang, texts in by_lang.items():
        for a, b in blocks(texts):
            yield lang, texts[a:b]


def _slots(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids & _U(FILTER_BITS - 1), (ids >> _U(32)) & _U(FILTER_BITS - 1)


def _link(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two word ids in this order."""
    with np.errstate(over="ignore"):
        return mix(left * _LINK + right)


class Filter:
    """A Bloom filter of fixed size, as words of 64 bits."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        found = np.ones(len(ids), dtype=bool)
        for slot in _slots(ids):
            found &= (self.bits[slot >> _U(6)] >> (slot & _U(63))) & _U(1) == 1
        return found


def filter_of(hashes: DataFrame) -> Filter:
    """The filter of ``hashes`` (column h); its bits are set by an aggregate, and FILTER_BITS / 64 words come back at most."""
    mask = F.lit(FILTER_BITS - 1)
    slots = F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask))
    bit = hashes.select(F.explode(slots).alias("s")).groupBy(F.shiftright("s", 6).alias("at"))
    words = bit.agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("word")).toPandas()
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    bits[words["at"].to_numpy(np.int64)] = words["word"].to_numpy(np.int64)
    return Filter(bits.view(np.uint64))


def codebook(words: DataFrame, codes: int = CODES) -> np.ndarray:
    """The ids of the most frequent words (columns id, a), ascending: as many eighths of an octave as hold ``codes`` at most.

    A word's code is its place. The size is fixed, whatever the size of the input, as the filter's is.
    """
    step = F.floor(F.log2("a") * 8)
    least, room = None, codes
    for row in words.groupBy(step.alias("step")).count().orderBy(F.col("step").desc()).collect():  # 505 rows at most
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, dtype=np.uint64)
    return np.sort(words.where(step >= least).select("id").toPandas()["id"].to_numpy(np.int64).view(np.uint64))


def _codes(ids: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The codes of ``ids``; CODES where a word has none."""
    if not len(book):
        return np.full(ids.shape, CODES, dtype=np.uint16)
    at = np.minimum(np.searchsorted(book, ids), len(book) - 1)
    return np.where(book[at] == ids, at, CODES).astype(np.uint16)


def _packed(ids: np.ndarray, codes: np.ndarray) -> bytes:
    """Codes column by column, then the ids of the words without one in the same order."""
    codes = codes.T.ravel()
    return codes.tobytes() + ids.T.ravel()[codes == CODES].tobytes()


def _unpacked(packed: bytes, m: int, n: int, book: np.ndarray) -> np.ndarray:
    """The ids of ``m`` phrases of ``n`` words, a row for each place."""
    codes = np.frombuffer(packed, np.uint16, m * n)
    ids = np.empty(m * n, dtype=np.uint64)
    coded = codes != CODES
    ids[coded] = book[codes[coded]]
    ids[~coded] = np.frombuffer(packed[codes.nbytes :], np.uint64)
    return ids.reshape(n, m)


class PhraseTrie:
    """Counts of phrases: nodes by word id, with hash containers below that burst when they grow.

    A container maps the rest of a phrase (its ids as bytes) to its count; a node maps a word id to a node or a
    container. The root is a node; ``held`` counts phrases.
    """

    class Node(dict):
        pass

    def __init__(self, burst: int) -> None:
        self.root, self.held, self.burst = PhraseTrie.Node(), 0, burst

    def add(self, phrase: bytes, count: int) -> None:
        node, at = self.root, 0
        while True:
            word = phrase[at : at + 8]
            at += 8
            below = node.get(word)
            if type(below) is PhraseTrie.Node and at < len(phrase):
                node = below
                continue
            break
        if type(below) is PhraseTrie.Node:  # the phrase ends where its container has burst
            below = below.setdefault(b"", {})
        elif below is None:
            below = node[word] = {}
        rest = phrase[at:]
        if rest in below:
            below[rest] += count
            return
        below[rest] = count
        self.held += 1
        if len(below) > self.burst and len(rest) > 8:  # a container of last words has nothing to burst into
            node[word] = self._burst(below)

    def _burst(self, container: dict[bytes, int]) -> PhraseTrie.Node:
        node = PhraseTrie.Node()
        for rest, count in container.items():
            node.setdefault(rest[:8], {})[rest[8:]] = count
        return node

    def _walk(self, below: dict, path: bytes) -> Iterator[tuple[bytes, int]]:
        if type(below) is PhraseTrie.Node:
            for word, deeper in below.items():
                yield from self._walk(deeper, path + word)
        else:
            for rest, count in below.items():
                yield path + rest, count

    def spill(self, upto: int) -> Iterator[tuple[bytes, int]]:
        """Phrases and counts of the largest subtrees, which are cut off, until at most ``upto`` phrases are held."""
        sizes = {word: sum(1 for _ in self._walk(below, b"")) for word, below in self.root.items()}
        for word in sorted(sizes, key=sizes.get, reverse=True):
            if self.held <= upto:
                return
            yield from self._walk(self.root.pop(word), word)
            self.held -= sizes[word]


_RUNS = "part int, n int, m int, ids binary, counts binary"


def _runs(spilled: Iterator[tuple[bytes, int]], parts: int, book: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Spilled phrases as sorted runs: by length, cut by prefix partition; words packed, counts as narrow as they allow."""
    by_length: dict[int, tuple[list[bytes], list[int]]] = {}
    for phrase, count in spilled:
        phrases, counts = by_length.setdefault(len(phrase) // 8, ([], []))
        phrases.append(phrase)
        counts.append(count)
    for n, (phrases, counts) in sorted(by_length.items()):
        ids = np.frombuffer(b"".join(phrases), dtype=np.uint64).reshape(-1, n)
        part = (_link(ids[:, 0], ids[:, 1]) >> _U(40)).astype(np.int64) & (parts - 1)
        order = np.lexsort((*ids.T[::-1], part))
        ids, part, counts = ids[order], part[order], np.array(counts, dtype=np.int64)[order]
        cut = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]))
        codes = _codes(ids, book)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part[cut[:-1]], pa.int32()),
                pa.array(np.full(len(cut) - 1, n), pa.int32()),
                pa.array(np.diff(cut), pa.int32()),
                pa.array([_packed(ids[a:b], codes[a:b]) for a, b in zip(cut, cut[1:])], pa.binary()),
                pa.array([counts[a:b].astype(np.min_scalar_type(counts[a:b].max())).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
            ],
            ["part", "n", "m", "ids", "counts"],
        )


def _distinct(ids: np.ndarray, own: np.ndarray, at: np.ndarray, n: int) -> tuple[list[bytes], list[int]]:
    """The distinct phrases of ``n`` words at the places ``at`` of a block, as bytes, and how often each one occurs.

    ``own`` numbers the block's distinct words from 0, so that three of them are one sortable 64-bit key.
    """
    key = own[at]
    for k in range(1, n):
        if k > 2:
            key = np.unique(key, return_inverse=True)[1]
        key = (key << 21) | own[at + k]
    first, count = np.unique(key, return_index=True, return_counts=True)[1:]
    keys = ids[at[first][:, None] + np.arange(n)].tobytes()
    return [keys[k : k + 8 * n] for k in range(0, len(keys), 8 * n)], count.tolist()


def _phrases(ids: np.ndarray, follows: np.ndarray, lengths: range, may: Filter) -> Iterator[tuple[int, np.ndarray]]:
    """For each length where its phrases begin whose parts may all be frequent: words for pairs, else pairs."""
    if lengths.start == 2:
        good = may(ids)
        linked = follows[1:] & good[1:] & good[:-1]
    else:
        linked = follows[1:].copy()
        at = np.flatnonzero(linked)
        linked[at] = may(_link(ids[at], ids[at + 1]))
    run = linked  # run[i]: the words i .. i + n - 1 hang together
    for n in range(2, lengths.stop):
        if n > 2:
            run = run[: len(linked) - n + 2] & linked[n - 2 :] if len(linked) >= n - 1 else run[:0]
        if n in lengths:
            at = np.flatnonzero(run)
            if len(at):
                yield n, at


def _count_phrases(
    docs: DataFrame, seed: int, lengths: range, may: Filter, book: np.ndarray, parts: int, least: int, held: int, burst: int
) -> DataFrame:
    """n, ids, a: the phrases of these lengths that occur at least ``least`` times."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PhraseTrie(burst)
        for batch in batches:
            for lang, texts in _blocks_by_lang(batch):
                _, _, _, ids, follows = words_of(texts, lang, seed)
                own = np.unique(ids, return_inverse=True)[1]
                for n, at in _phrases(ids, follows, lengths, may):
                    for phrase, count in zip(*_distinct(ids, own, at, n), strict=True):
                        trie.add(phrase, count)
                    if trie.held > held:
                        yield from _runs(trie.spill(held // 2), parts, book)
        yield from _runs(trie.spill(-1), parts, book)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs of one prefix partition and length at a time; they arrive sorted by both."""
        now, runs = None, []
        for batch in batches:
            for part, n, m, ids, counts in zip(*(batch.column(k) for k in range(5)), strict=True):
                key = (part.as_py(), n.as_py())
                if key != now:
                    yield from _merged(now, runs, least, book)
                    now, runs = key, []
                runs.append((m.as_py(), ids.as_py(), counts.as_py()))
        yield from _merged(now, runs, least, book)

    runs = docs.mapInArrow(gather, _RUNS).repartition("part").sortWithinPartitions("part", "n")
    return stored(runs.mapInArrow(merge, "n int, ids array<bigint>, a bigint"))


def _merged(key: tuple[int, int] | None, runs: list[tuple[int, bytes, bytes]], least: int, book: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not runs:
        return
    n = key[1]
    ids = np.concatenate([_unpacked(i, m, n, book) for m, i, _ in runs], axis=1)
    counts = np.concatenate([np.frombuffer(c, f"u{len(c) // m}").astype(np.int64) for m, _, c in runs])
    order = np.lexsort(ids[::-1])
    ids, counts = ids[:, order], counts[order]
    new = np.ones(ids.shape[1], dtype=bool)
    new[1:] = (ids[:, 1:] != ids[:, :-1]).any(axis=0)
    at = np.flatnonzero(new)
    sums = np.add.reduceat(counts, at)
    often = sums >= least
    rows = np.ascontiguousarray(ids[:, at[often]].T).view(np.int64)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(rows), n), pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, n), pa.int32()), pa.array(rows.ravel())),
            pa.array(sums[often]),
        ],
        ["n", "ids", "a"],
    )


def _count_words(docs: DataFrame, seed: int, held: int) -> DataFrame:
    """id, lang, word, a of every distinct word a task has met, and a row without a word for the words of a language."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict[int, list]] = defaultdict(dict)
        totals: dict[str, int] = defaultdict(int)

        def rows(lang: str, run: list[tuple]) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(run), 50_000):
                some = run[k : k + 50_000]
                ids = pa.array(np.array([i for i, _ in some], dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([lang] * len(some)), pa.array([w for _, (w, _) in some], pa.binary()), pa.array([c for _, (_, c) in some], pa.int64())],
                    ["id", "lang", "word", "a"],
                )

        def spill() -> Iterator[pa.RecordBatch]:
            for lang, words in found.items():
                yield from rows(lang, sorted(words.items()))
            found.clear()

        for batch in batches:
            for lang, texts in _blocks_by_lang(batch):
                raw, starts, ends, ids, _ = words_of(texts, lang, seed)
                totals[lang] += len(ids)
                own = found[lang]
                each, first, same, count = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
                proof = word_hashes(np.frombuffer(raw, np.uint8) ^ _OTHER, starts, ends)
                strays = [(i, raw[starts[k] : ends[k]]) for k in np.flatnonzero(proof != proof[first][same]) for i in (int(ids[k]),)]
                for i, a, b, c in zip(each.tolist(), starts[first].tolist(), ends[first].tolist(), count.tolist(), strict=True):
                    known = own.get(i)
                    if known is None:
                        own[i] = [raw[a:b], c]
                    else:
                        known[1] += c
                        if known[0] != raw[a:b]:
                            strays.append((i, raw[a:b]))
                if strays:  # two words, one id: the merge sees both
                    yield from rows(lang, [(i, (w, 0)) for i, w in set(strays)])
                if sum(map(len, found.values())) > held:
                    yield from spill()
        yield from spill()
        for lang, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(_seed(lang, seed).view(np.int64))]), pa.array([lang]), pa.array([None], pa.binary()), pa.array([total], pa.int64())],
                ["id", "lang", "word", "a"],
            )

    runs = docs.mapInArrow(gather, "id bigint, lang string, word binary, a bigint").repartition("id")
    words = runs.groupBy("id", "lang", "word").agg(F.sum("a").alias("a"))
    top = F.max(F.struct("a", "lang", "word"))  # beside a frequent word, an id may stand for nothing else
    return words.groupBy("id", F.col("word").isNull().alias("total")).agg(F.count(F.lit(1)).alias("kinds"), top.alias("top"))


def collocations(
    docs: DataFrame,
    least: int = 100,
    top: int = 2000,
    max_words: int = MAX_WORDS,
    lang_col: str = "lang",
    text_col: str = "text",
    held: int = HELD,
    burst: int = BURST,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``max_words`` words by score."""
    base = text_batches(docs).where(F.length(text_col) > 0).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UND)).alias("lang"), F.col(text_col).alias("text")
    )
    seed = 0
    while True:
        frequent = _count_words(base, seed, held).where(F.col("total") | (F.col("top.a") >= least))
        known = stored(frequent.select("id", "total", "kinds", "top.lang", "top.word", "top.a"))
        if known.where(F.col("kinds") > 1).isEmpty():
            break
        seed += 1
    words = known.where(~F.col("total")).select("id", "lang", F.col("word").cast("string").alias("word"), "a")
    totals = known.where("total").select("lang", F.col("a").alias("n"))
    size = totals.agg(F.sum("n")).first()[0] or 0  # one number
    parts = 1 << max(0, math.ceil(math.log2(max(1, size / PARTITION_WORDS))))

    may, book = filter_of(words.select(F.col("id").alias("h"))), codebook(words)
    pairs = _count_phrases(base, seed, range(2, 3), may, book, parts, least, held, burst)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy().view(np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(_link(ids[:, 0], ids[:, 1]).view(np.int64))], ["h"])

    phrases = pairs
    if max_words > 2:
        may = filter_of(pairs.select("ids").mapInArrow(linked, "h bigint"))
        phrases = pairs.unionAll(_count_phrases(base, seed, range(3, max_words + 1), may, book, parts, least, held, burst))
    return _ranked(phrases, words, totals, top)


def _ranked(phrases: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """Scores at the weakest cut, without phrases that only occur inside longer ones, ranked by language."""
    spoken = phrases.join(words.select(F.col("id").alias("first"), "lang"), F.col("ids")[0] == F.col("first")).drop("first")
    # a phrase is as frequent as one that holds it only if it is as frequent as every phrase between, so one word more is enough
    longer = phrases.where(F.col("n") > 2).select(
        F.explode(F.array(F.expr("slice(ids, 1, n - 1)"), F.expr("slice(ids, 2, n - 1)"))).alias("ids"), F.col("a").alias("inside")
    )
    covered = longer.groupBy("ids").agg(F.max("inside").alias("inside"))
    own = spoken.join(covered, "ids", "left").where(F.col("inside").isNull() | (F.col("inside") < F.col("a"))).drop("inside")

    known = words.select(F.array("id").alias("part"), F.col("a").alias("f")).unionAll(phrases.select(F.col("ids").alias("part"), F.col("a").alias("f")))
    cuts = own.select("ids", "lang", "n", "a", F.explode(F.expr("sequence(1, n - 1)")).alias("k"))
    cuts = cuts.join(known.withColumnRenamed("f", "l"), F.expr("slice(ids, 1, k)") == F.col("part")).drop("part")
    cuts = cuts.join(known.withColumnRenamed("f", "r"), F.expr("slice(ids, k + 1, n - k)") == F.col("part")).drop("part", "n")
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(cast(a as decimal(17,0)) * cast(n as decimal(17,0)) as decimal(34,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = cuts.join(totals, "lang").withColumn("score", score)
    weakest = F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")
    scored = scored.groupBy("lang", "ids", "a").agg(weakest).select("lang", "ids", "a", "cut.l", "cut.r", "cut.n", "cut.score")

    def order(*then):
        return Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), *then)

    near = stored(scored.withColumn("at", F.rank().over(order())).where(F.col("at") <= top).drop("at"))  # ties stay until they have words
    spelt = near.select("ids", F.posexplode("ids").alias("k", "id")).join(words.select("id", "word"), "id")
    spelt = spelt.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("k", "word"))).alias("w"))
    spelt = spelt.select("ids", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    ranked = near.join(spelt, "ids").withColumn("rank", F.row_number().over(order(F.col("phrase"))).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
q AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
t AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM q GROUP BY lang),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM q),
g AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS a
  FROM s, range(1, 6) AS lengths(k) WHERE i + k - 1 <= len(w)
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (
  SELECT * FROM g WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM g AS m WHERE m.lang = g.lang AND m.k > g.k AND 100 * m.a >= 100 * g.a
      AND contains(' ' || m.phrase || ' ', ' ' || g.phrase || ' '))),
d AS (
  SELECT c.*, j, array_to_string(string_split(phrase, ' ')[1 : j], ' ') AS x, array_to_string(string_split(phrase, ' ')[j + 1 :], ' ') AS y
  FROM c, range(1, 5) AS cuts(j) WHERE j < k),
e AS (
  SELECT d.lang, d.phrase, d.a, j, l.a AS l, r.a AS r, t.n::BIGINT AS n, ((1000 * d.a::HUGEINT * t.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM d JOIN g AS l ON l.lang = d.lang AND l.phrase = d.x JOIN g AS r ON r.lang = d.lang AND r.phrase = d.y JOIN t ON t.lang = d.lang),
f AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS pick FROM e),
h AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM f WHERE pick = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM h WHERE rank <= 2000"""
