"""Byte-level BPE encoding and decoding with the merge ranks of a public vocabulary.

Each match of the split pattern is encoded by itself. Its bytes are mapped to Latin-1 characters, so that an
Aho-Corasick automaton over the tokens gives the longest token that starts at a position. The encoder walks forward with the longest token and backtracks to shorter ones until each token is compatible with the
one before it. Two adjacent tokens are compatible if merging their joined bytes gives exactly these two; that holds
or not for the pair alone, so it is memoised, and a sequence whose neighbours are all compatible is the one that
applying the merges in rank order gives. A position that was given up is never tried again: linear time.

Results of whole words are memoised per worker (in generations of ``CACHE_WORDS``). Texts are cut at
single spaces, before which no match of the pattern can continue, and texts with other runs of white space are split
by the pattern as a whole.

Defined results: a null text is an empty one (no ids, the digest of nothing); every byte sequence round-trips;
repeated rows and null ids are rows like any other. The vocabulary file must be readable on the executors, or be
sent with ``SparkContext.addFile``; its path is a parameter.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import column, text_batches

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE_WORDS = 400_000


class _Odd(Exception):
    """The text can't be cut at this space."""


class _Memo(dict):
    """word -> ids, computed when first asked for. Two generations: words still in use outlive a full memo."""

    def __init__(self, make, share: int = 1):
        super().__init__()
        self.make, self.share, self.old = make, share, {}

    def __missing__(self, word):
        if len(self) * self.share >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word)
        self[word] = ids
        return ids


class ByteBPE:
    """Encoder and decoder for one vocabulary of merge ranks (token bytes -> id, ids being merge ranks)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.sizes = {i: len(t) for t, i in ranks.items()}
        self.numbers = {i: str(i) for i in ranks.values()}
        self.split = regex.compile(pattern).findall
        self.machine = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.machine.add_word(token.decode("latin-1"), i)
        self.machine.make_automaton()
        self.shorter = {}  # id -> id of the longest token that is a proper prefix
        for token, i in ranks.items():
            self.shorter[i] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), None)
        self.fits: dict[tuple[int, int], bool] = {}
        self.after_space = _Memo(self._after_space)
        self.literal = _Memo(self._pieces, 20)  # first words of texts
        self.piece = _Memo(self._encode_piece, 2)

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())}, pattern)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens in rank order ends in exactly these two."""
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= CACHE_WORDS:
                self.fits.clear()
            a, b = self.tokens[left], self.tokens[right]
            known = self.fits[left, right] = self.merged(a + b) == [a, b]
        return known

    def merged(self, data: bytes) -> list[bytes]:
        """The definition: join the neighbours of lowest rank, leftmost first, until none can be joined."""
        parts, ranks = [data[i : i + 1] for i in range(len(data))], self.ranks
        while len(parts) > 1:
            best, at = None, 0
            for k in range(len(parts) - 1):
                rank = ranks.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        return self.encode_bytes(piece.encode())

    def encode_bytes(self, data: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        text, end = data.decode("latin-1"), len(data)
        longest = self.machine.iter_long  # every byte is a token, so the first match starts where the search does
        sizes, shorter, fits, compatible = self.sizes, self.shorter, self.fits, self._compatible
        given_up: set[int] = set()
        out: list[int] = []
        at, before, token = 0, None, next(longest(text))[1]
        while True:
            if token is None:  # nothing fits here: give the position up and shorten the token before it
                given_up.add(at)
                token = out.pop()
                before = out[-1] if out else None
                at -= sizes[token]
                token = shorter[token]
                continue
            to = at + sizes[token]
            if to not in given_up and (before is None or fits.get((before, token)) or compatible(before, token)):
                out.append(token)
                if to == end:
                    return tuple(out)
                at, before, token = to, token, next(longest(text, to))[1]
            else:
                token = shorter[token]

    def _pieces(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.piece.__getitem__, self.split(text))))

    def _after_space(self, word: str) -> tuple[int, ...]:
        if word[:1] == "\n":
            word_ok = len(word) > 1 and not word[1].isspace()
        else:
            word, word_ok = " " + word, word != "" and not word[0].isspace()
        if not word_ok:
            raise _Odd
        return self._pieces(word)

    def encode(self, text: str) -> list[int]:
        if len(text) < 2:
            return list(self._pieces(text))
        first, *words = text.replace("\n", " \n").split(" ")
        if first:
            try:
                return list(chain(self.literal[first], chain.from_iterable(map(self.after_space.__getitem__, words))))
            except _Odd:
                pass
        return list(chain.from_iterable(map(self.piece.__getitem__, self.split(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.cache
def load(path: str, pattern: str) -> ByteBPE:
    """One encoder and memo per worker and vocabulary."""
    return ByteBPE.load(path, pattern)


def byte_bpe(
    docs: DataFrame,
    vocabulary: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """doc_id, n_tokens, ids (if ``with_ids``), ids_sha256 and decoded_sha256 for every row of ``docs``."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    base = text_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            counts, all_ids, ids_sha, decoded_sha = [], [], [], []
            for text in column(batch, "text"):
                ids = bpe.encode(text or "")
                counts.append(len(ids))
                if with_ids:
                    all_ids.append(ids)
                ids_sha.append(hashlib.sha256(" ".join(map(bpe.numbers.__getitem__, ids)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            out = {"doc_id": batch.column(0), "n_tokens": pa.array(counts, pa.int64())}
            if with_ids:
                out["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            out |= {"ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(decoded_sha, pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    kind = base.schema["doc_id"].dataType.simpleString()
    ids = "ids array<int>, " if with_ids else ""
    return base.mapInArrow(encode, f"doc_id {kind}, n_tokens bigint, {ids}ids_sha256 string, decoded_sha256 string")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
