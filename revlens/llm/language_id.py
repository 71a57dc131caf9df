"""Language identification: script ranges narrow the candidates, Viterbi over per-word scores labels spans.

A word is a run of letters (with their marks) of one script range. Its score for a language is the sum of centred
log probabilities of its hashed character trigrams. Languages that do not use the word's script are no candidates
for it. Over the words of a text, Viterbi finds the best labelling where each change of language costs
``switch_penalty``; runs of one label are the text's spans. The text's language is the one with the most letters
in its spans, and the score is that share of all letters (0 to 1); words that repeat one of the ``ECHO`` words before
them are left out of both, so that a repeated phrase does not outweigh the text around it.

The model is counted from a sample bounded by ``TRAIN_ROWS`` documents per language (``bounded_sample``); no row
that is held out is read for it, and lang, source and id are never inputs of a prediction.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and no spans; a text in scripts that
no learned language uses gets the most frequent learned language with score 0; ties go to the more frequent
language; nothing to learn from gives ``und`` everywhere; repeated rows and null ids are rows like any other.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import blocks, bounded_sample, carried, carried_texts, column, held_out, result_schema, text_batches

TRAIN_ROWS = 600  # per language
SWITCH_PENALTY = 12.0
ECHO = 8
OUT_OF_SCRIPT = 25.0  # log units against a language that does not use the word's script
SCRIPT_SHARE = 0.002  # a language uses a script if this share of its letters is in it
BINS = 1 << 16
BLOCK_CHARS = 1 << 19
VITERBI_CHARS, VITERBI_ROWS = 4 << 20, 4096

# Unicode code point ranges of the main scripts (public Unicode block boundaries).
SCRIPT_RANGES = (
    ("latin", 0x0041, 0x024F), ("latin_ext", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("arabic_sup", 0x0750, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F),
    ("thai", 0x0E00, 0x0E7F), ("lao", 0x0E80, 0x0EFF), ("georgian", 0x10A0, 0x10FF), ("ethiopic", 0x1200, 0x137F),
    ("khmer", 0x1780, 0x17FF), ("hiragana", 0x3040, 0x309F), ("katakana", 0x30A0, 0x30FF), ("han", 0x4E00, 0x9FFF),
    ("han_ext", 0x3400, 0x4DBF), ("hangul", 0xAC00, 0xD7AF),
)
OTHER_SCRIPT = len(SCRIPT_RANGES) + 1
N_SCRIPTS = OTHER_SCRIPT + 1


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its simple lower case, its script (0: not part of a word), whether it is a letter."""
    lower = np.arange(0x110000, dtype=np.uint32)
    script = np.zeros(0x110000, dtype=np.uint8)
    letter = np.zeros(0x110000, dtype=bool)
    for c in range(0x20000 + 0xB000):  # letters beyond are the ideographs of the range below
        ch = chr(c)
        if ch.isalpha():
            letter[c], script[c] = True, OTHER_SCRIPT
            if len(low := ch.lower()) == 1:
                lower[c] = ord(low)
        elif unicodedata.category(ch) in ("Mn", "Mc"):
            script[c] = OTHER_SCRIPT
    letter[0x2B000:0x33480], script[0x2B000:0x33480] = True, OTHER_SCRIPT
    for k, (_, first, last) in enumerate(SCRIPT_RANGES, 1):
        part = script[first : last + 1]
        part[part > 0] = k
    return lower, script, letter


def word_features(texts: list[str]) -> tuple[np.ndarray, ...]:
    """For the words of all texts in order: char bins, first char of each word (in the bins), script, chars, and
    position in its text; and the words and letters of each text."""
    lower, script, letter = _tables()
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sc = script[points]
    low = lower[points] * (sc > 0)
    before = np.concatenate(([np.uint32(0)], low[:-1]))
    after = np.concatenate((low[1:], [np.uint32(0)]))
    h = before * np.uint32(0x9E3779B1) + low * np.uint32(0x85EBCA77) + after * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    inside = np.flatnonzero(sc)
    bins = (h[inside] >> np.uint32(16)).astype(np.int32)
    starts_at = np.flatnonzero((sc > 0) & (sc != np.concatenate(([np.uint8(0)], sc[:-1]))))
    first = np.searchsorted(inside, starts_at)
    ends = np.cumsum([len(t) + 1 for t in texts])
    words_upto = np.searchsorted(starts_at, ends)
    letters_upto = np.concatenate(([0], np.cumsum(letter[points])))[ends]
    begins = np.concatenate(([0], ends[:-1]))
    n_words = np.diff(words_upto, prepend=0)
    position = starts_at - np.repeat(begins, n_words)
    chars = np.diff(first, append=len(inside))
    return bins, first, sc[starts_at], chars, position, n_words, np.diff(letters_upto, prepend=0)


def learn(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> dict | None:
    """Trigram and script counts by language of at most about ``train_rows`` documents each: a small dict of arrays."""
    usable = text_batches(docs).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sample = bounded_sample(usable, "doc_id", "lang", train_rows).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = column(batch, "lang"), column(batch, "text")
            for lang in set(langs):
                # each word once a text, so that a text of one repeated line weighs no more than its line
                own = [" ".join(dict.fromkeys(t.lower().split())) for t, x in zip(texts, langs, strict=True) if x == lang]
                for a, b in blocks(own, BLOCK_CHARS):
                    bins, _, scripts, chars, *_ = word_features(own[a:b])
                    n = np.concatenate((np.bincount(bins, minlength=BINS), np.bincount(scripts, weights=chars, minlength=N_SCRIPTS)))
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at].astype(np.int64))], ["lang", "bin", "n"]
                    )

    counts = sample.mapInArrow(count, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    if counts.empty:
        return None
    weight = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    langs = sorted(set(counts["lang"]), key=lambda x: (-weight[x], x))  # ties go to the more frequent one
    table = np.zeros((BINS + N_SCRIPTS, len(langs)))
    table[counts["bin"], counts["lang"].map(langs.index)] = counts["n"]
    grams, scripts = table[:BINS], table[BINS:]
    logs = np.log(grams + 0.3) - np.log(grams.sum(0) + 0.3 * BINS)
    uses = scripts / np.maximum(scripts.sum(0), 1) >= SCRIPT_SHARE
    narrowed = np.where(uses.any(1, keepdims=True) & ~uses, -OUT_OF_SCRIPT, 0.0)
    return {
        "langs": langs,
        "scores": (logs - logs.mean(1, keepdims=True)).astype(np.float32),
        "scripts": narrowed.astype(np.float32),
        "known": uses.any(1),
    }


def viterbi(scores: np.ndarray, n_words: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word; ``scores`` holds the words of all texts one after the other.

    All texts of a block advance together, word by word; texts are ordered by length so that those still running are
    a prefix.
    """
    order = np.argsort(-n_words, kind="stable")
    lengths = n_words[order]
    offsets = (np.cumsum(n_words) - n_words)[order]
    running = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
    back = np.zeros(scores.shape, dtype=np.uint8)
    own = np.arange(scores.shape[1], dtype=np.uint8)
    value = np.zeros((len(lengths), scores.shape[1]), dtype=np.float32)
    for t, m in enumerate(running):
        at = offsets[:m] + t
        v = value[:m]
        if t:
            top = v.argmax(1)
            move = v[np.arange(m), top] - np.float32(penalty)
            stay = v >= move[:, None]
            back[at] = np.where(stay, own, top[:, None].astype(np.uint8))
            v = np.where(stay, v, move[:, None])
        value[:m] = v + scores[at]
    path = np.zeros(len(scores), dtype=np.uint8)
    label = value.argmax(1).astype(np.uint8)
    for t in range(len(running) - 1, -1, -1):
        at = offsets[: running[t]] + t
        path[at] = label[: running[t]]
        label[: running[t]] = back[at, label[: running[t]]]
    return path


def label_texts(texts: list[str | None], model: dict, penalty: float) -> list[tuple[str, float, list]]:
    """(language, score, spans) of each text; a span is (first code point, one past its last word's start, language)."""
    some = [t or "" for t in texts]
    scores, scripts, chars, position, words, letters, prints = [], [], [], [], [], [], []
    for a, b in blocks(some, BLOCK_CHARS):
        bins, first, sc, n, pos, per_text, per_letters = word_features(some[a:b])
        if len(first):
            prints.append(np.add.reduceat(bins.astype(np.int64) * (bins + 977), first))
            scores.append(np.add.reduceat(model["scores"][bins], first, axis=0) * model["known"][sc][:, None] + model["scripts"][sc])
        for out, x in zip((scripts, chars, position, words, letters), (sc, n, pos, per_text, per_letters), strict=True):
            out.append(x)
    langs, n_langs = model["langs"], len(model["langs"])
    n_words, letters = np.concatenate(words), np.concatenate(letters)
    chars, position, known = np.concatenate(chars), np.concatenate(position), model["known"][np.concatenate(scripts)]
    path = viterbi(np.concatenate(scores) if scores else np.zeros((0, n_langs), np.float32), n_words, penalty)
    text_of = np.repeat(np.arange(len(some)), n_words)
    prints = np.concatenate(prints) if prints else np.zeros(0, np.int64)
    echo = np.zeros(len(path), dtype=bool)
    for lag in range(1, min(ECHO, len(path) - 1) + 1):
        echo[lag:] |= (prints[lag:] == prints[:-lag]) & (text_of[lag:] == text_of[:-lag])
    chars_once = chars * ~echo
    share = np.bincount(text_of * n_langs + path, weights=chars_once * known, minlength=len(some) * n_langs).reshape(-1, n_langs)
    total = np.maximum(np.bincount(text_of, weights=chars_once, minlength=len(some)), 1)
    best = share.argmax(1)
    new = np.ones(len(path), dtype=bool)
    new[1:] = (path[1:] != path[:-1]) | (text_of[1:] != text_of[:-1])
    at = np.flatnonzero(new)
    last = np.concatenate((at[1:], [len(path)])) - 1 if len(at) else at
    spans: list[list] = [[] for _ in some]
    for i, a, b in zip(text_of[at].tolist(), at.tolist(), last.tolist(), strict=True):
        spans[i].append({"start": int(position[a]), "end": int(position[b] + chars[b]), "lang": langs[path[a]]})
    return [
        (langs[best[i]], float(share[i, best[i]] / total[i]), spans[i]) if letters[i] else ("und", 0.0, [])
        for i in range(len(some))
    ]


def language_id(
    docs: DataFrame,
    model: dict | None,
    penalty: float = SWITCH_PENALTY,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """doc_id, lang_pred, score, spans for every row of ``docs``; with ``carry``, the whole row too, as struct ``row``."""
    base = carried(docs, id_col, text_col, carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, texts = batch.column(0), carried_texts(batch, text_col)
            for a, b in blocks(texts, VITERBI_CHARS, VITERBI_ROWS):
                rows = label_texts(texts[a:b], known, penalty) if known else [("und", 0.0, [])] * (b - a)
                out = {
                    "doc_id": ids.slice(a, b - a),
                    "lang_pred": pa.array([r[0] for r in rows], pa.string()),
                    "score": pa.array([r[1] for r in rows], pa.float64()),
                    "spans": pa.array([r[2] for r in rows], span),
                }
                if carry:
                    out["row"] = batch.column(1).slice(a, b - a)
                yield pa.RecordBatch.from_pydict(out)

    return base.mapInArrow(
        predict, result_schema(base, "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    return language_id(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
