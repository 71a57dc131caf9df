"""Hierarchical multi-length packing of tokenised documents into training windows.

A document is its token ids and an end id. Whole windows of the longest tier are cut off first. What is left is a
piece, routed to the smallest tier (context size) that holds it. From the longest tier down, each piece opens a
window of its tier; the gap is filled with the largest pieces of the shorter tiers that fit, and last with a cut of
one piece, so that windows end up full. Windows of one tier are dealt into step groups of equal token counts.

Everything happens inside the task that read the documents: a pool of about ``POOL_TOKENS`` tokens is packed at a
time, and what doesn't fill a window waits for the next pool. The last tokens of a partition, less than one window,
are cut at powers of two, which need no padding. There is no shuffle, memory is a pool and an Arrow batch, and a
lost task repeats the same windows; the rows must come from stored files, so that a repeated task reads them in
the same order. Sequence ids are unique over all partitions, not consecutive.

Tokens of a word are memoised per worker (``cache_words`` in each of two generations; with ``hold_words=False``
only within a task, for jobs whose workers do other work too); no pre-token of the
tokenizer spans a space or a line end, so texts are cut there.

Defined results: a null or empty text is its end id alone; repeated rows are packed each; null ids are kept; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from string import punctuation

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import blocks, column, text_batches

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16_384
POOL_TOKENS = 1 << 20
CACHE_WORDS = 800_000
JOINED = 256  # words that one call of the tokenizer gets
BLOCK_CHARS = 1 << 18


class WordTokenizer:
    """Little-endian unsigned 32-bit ids of texts, with a memo of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # For lower-case words that the first one would neither change nor split: the same merges, without that work.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Empty the memo."""
        self.tails: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    @staticmethod
    def _stem(word: str) -> tuple[str, str]:
        """The lower-case Latin-1 word before closing ASCII marks, and the marks; two empty strings for any other word.

        The tokenizer's pattern takes the letters and the marks as one pre-token each.
        """
        stem = word.rstrip(punctuation)
        return (stem.lower(), word[len(stem) :]) if stem.isalpha() and max(stem) < "\u0100" else ("", "")

    def _learn(self, words: list[str]) -> None:
        words_of, stems = [], set()
        for word in words:
            stem, tail = self._stem(word)
            words_of.append((word, stem, tail))
            if tail not in self.tails:
                if len(self.tails) > CACHE_WORDS:
                    self.tails = {"": b""}
                self.tails[tail] = self._whole(tail)
            if stem and stem not in self.words:
                stems.add(stem)
        ordered = list(stems)
        for k in range(0, len(ordered), JOINED):
            group = ordered[k : k + JOINED]
            ids = np.array(self.plain.encode(" ".join(group), add_special_tokens=False).ids, dtype="<u4")
            raw, at = ids.tobytes(), 0
            for stem, upto in zip(group, (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist(), strict=True):
                self.words[stem] = raw[at:upto]
                at = upto
        others = [word for word, stem, _ in words_of if not stem]
        for k in range(0, len(others), JOINED):
            group = others[k : k + JOINED]
            e = self.tokenizer.encode(" ".join(group), add_special_tokens=False)
            raw, at = np.array(e.ids, dtype="<u4").tobytes(), 0
            begins = np.array([a for a, _ in e.offsets], dtype=np.int64)
            ends = np.cumsum([len(w) + 1 for w in group])  # of each word in the joined text
            for word, upto in zip(group, (4 * np.searchsorted(begins, ends)).tolist(), strict=True):
                self.words[word] = raw[at:upto]
                at = upto
        for word, stem, tail in words_of:
            if stem:
                self.words[word] = self.words[stem] + (self.tails[tail] if tail in self.tails else self._whole(tail))

    def encode(self, texts: list[str], cache_words: int | None = None) -> list[bytes]:
        if len(self.words) > (CACHE_WORDS if cache_words is None else cache_words):
            self.old, self.words = self.words, {"": b""}
        get, old = self.words.get, self.old.get
        found, gaps, unseen = [], [], set()
        for text in texts:
            parts = text.replace("\n", " ").split(" ")
            ids = list(map(get, parts))
            found.append(ids)
            at = -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                word = parts[at]
                if (known := old(word)) is not None:
                    ids[at] = self.words[word] = known
                else:
                    gaps.append((ids, at, word))
                    unseen.add(word)
        self._learn(list(unseen))
        for ids, at, word in gaps:
            ids[at] = self.words[word]
        return list(map(b"".join, found))


@functools.cache
def load(path: str) -> WordTokenizer:
    """One tokenizer and memo per worker and vocabulary."""
    return WordTokenizer(path)


class Packer:
    """Windows of pieces. A piece is (length, row, start): tokens ``start`` to ``start + length`` of one document."""

    def __init__(self, tiers=TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = sorted(tiers), step_tokens
        self.waiting: dict[int, list[tuple[int, int, int]]] = {t: [] for t in self.tiers}  # by tier, shortest first
        self.made = 0
        self.of_size: dict[int, int] = {}

    def route(self, piece: tuple[int, int, int]) -> None:
        insort(self.waiting[next(t for t in self.tiers if t >= piece[0])], piece)

    def add(self, row: int, tokens: int) -> Iterator[tuple]:
        """Whole windows of the longest tier at once; the rest waits."""
        longest = self.tiers[-1]
        whole = tokens // longest * longest
        for start in range(0, whole, longest):
            yield self.window([(longest, row, start)], longest)
        if tokens > whole:
            self.route((tokens - whole, row, whole))

    def window(self, pieces: list, size: int) -> tuple[int, int, int, list]:
        """(sequence, step group, size, pieces)"""
        k = self.of_size[size] = self.of_size.get(size, -1) + 1
        self.made += 1
        return self.made - 1, k // max(1, self.step_tokens // size), size, pieces

    def fill(self, size: int, tier: int) -> list:
        """Up to ``size`` tokens, as large pieces first as fit, from the tier or shorter ones; then one piece is cut."""
        out = []
        for t in reversed([t for t in self.tiers if t <= tier]):
            pieces = self.waiting[t]
            while size and (k := bisect_right(pieces, size, key=lambda p: p[0])):
                out.append(pieces.pop(k - 1))
                size -= out[-1][0]
        if size and (left := next((self.waiting[t] for t in self.tiers if self.waiting[t]), None)):
            length, row, start = left.pop()  # longer than the gap: all that fit are gone
            out.append((size, row, start))
            self.route((length - size, row, start + size))
        return out

    def pack(self) -> Iterator[tuple]:
        """Full windows from all that waits, longest tier first, while there are tokens enough."""
        total = sum(p[0] for t in self.tiers for p in self.waiting[t])
        for tier in reversed(self.tiers):
            while self.waiting[tier] and total >= tier:
                first = self.waiting[tier].pop()
                shorter = self.tiers[max(0, self.tiers.index(tier) - 1)]
                pieces = [first, *self.fill(tier - first[0], shorter)]
                if (gap := tier - sum(p[0] for p in pieces)) > 0:  # the shorter tiers are empty
                    pieces += self.fill(gap, self.tiers[-1])
                total -= tier
                yield self.window(pieces, tier)

    def rest(self) -> Iterator[tuple]:
        """What fills no window, cut at powers of two."""
        yield from self.pack()
        total = sum(p[0] for t in self.tiers for p in self.waiting[t])
        for k in reversed(range(total.bit_length())):
            if total >> k & 1:
                yield self.window(self.fill(1 << k, self.tiers[-1]), 1 << k)


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    cache_words: int | None = None,
    hold_words: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window (size), step_id
    and, if asked for, the piece's ids."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    base = text_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_id")
    end = int(END_ID).to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = load(path), Packer(tiers, step_tokens)
        part = TaskContext.get().partitionId() << 36
        held: dict[int, tuple] = {}  # rows of which tokens wait: id, ids, tokens not yet given out
        row, pooled = 0, 0

        def emitted(windows) -> pa.RecordBatch:
            ids, cols, tokens = [], [[] for _ in names], []
            for sequence, step, size, pieces in windows:
                offset = 0
                for length, r, start in pieces:
                    doc_id, data, left = held[r]
                    own = data[4 * start : 4 * (start + length)]
                    ids.append(doc_id)
                    values = (start, length, zlib.crc32(own), len(data) // 4, part + sequence, offset, size, part + (size << 24) + step)
                    for out, v in zip(cols, values, strict=True):
                        out.append(v)
                    if with_ids:
                        tokens.append(np.frombuffer(own, "<u4").astype(np.int32))
                    offset += length
                    if left == length:
                        del held[r]
                    else:
                        held[r] = doc_id, data, left - length
            out = [pa.array(ids, kind), *(pa.array(c, pa.int64()) for c in cols)]
            if with_ids:
                out.append(pa.array(tokens, pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(out, ["doc_id", *names, *(["ids"] if with_ids else [])])

        kind, windows = pa.int64(), []
        for batch in batches:
            kind = batch.schema.field(0).type
            doc_ids, texts = column(batch, "doc_id"), [t or "" for t in column(batch, "text")]
            for a, b in blocks(texts, BLOCK_CHARS):
                for doc_id, data in zip(doc_ids[a:b], tokenizer.encode(texts[a:b], cache_words), strict=True):
                    data += end
                    held[row] = doc_id, data, len(data) // 4
                    windows += packer.add(row, len(data) // 4)
                    row, pooled = row + 1, pooled + len(data) // 4
                    if pooled >= POOL_TOKENS:
                        windows += packer.pack()
                        yield emitted(windows)
                        windows, pooled = [], 0
        if not hold_words:
            tokenizer.forget()
        windows += packer.rest()
        if windows:
            yield emitted(windows)

    kind = base.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names) + (", ids array<int>" if with_ids else "")
    return base.mapInArrow(pack, schema)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
