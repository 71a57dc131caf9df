"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The features of a text are its hashed lower-cased words (log counts, scaled to unit length), eleven statistics of its
structure, and its length as metadata. The machine scores ``w0 + sum w_i x_i`` plus all pairwise interactions through
vectors of ``RANK`` numbers, in linear time: ``(sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2) / 2``.

It is fitted by minibatch gradient steps (Adam) on a sample bounded by ``TRAIN_ROWS`` documents of each label, drawn
by a hash of the id from rows that are not held out, and weighted back to the labels' frequencies. Scoring is one pass with no
shuffle. Labels, lang, source and id are never inputs of a score.

Defined results: a null or empty text is scored on its statistics alone; labels other than 0 and 1, and rows
without a label, are not learned from; with only one label to learn from every score is that label; repeated rows
and null ids are rows like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import blocks, bounded_sample, carried, carried_texts, column, held_out, result_schema, word_hashes, word_spans

TRAIN_ROWS = 2000  # per label
BINS = 1 << 13
RANK = 4
EPOCHS = 12
BATCH = 64
THRESHOLD = 0.7
BLOCK_CHARS, BLOCK_TEXTS = 1 << 20, 256  # a text takes BINS counts
STATISTICS = 12


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word bins (texts x BINS, rows of unit length) and structure statistics (texts x STATISTICS)."""
    raw = [(t or "").encode() for t in texts]
    data, starts, ends, per_text = word_spans([r.lower() for r in raw])
    h = word_hashes(data, starts, ends)
    text_of = np.repeat(np.arange(len(raw)), per_text)
    bins = (h >> np.uint64(64 - 13)).astype(np.int64)
    counts = np.bincount(text_of * BINS + bins, minlength=len(raw) * BINS).reshape(len(raw), BINS)
    words = np.log1p(counts, dtype=np.float32)
    words /= np.maximum(np.sqrt((words * words).sum(1, keepdims=True)), 1e-6)

    original = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    sizes = np.array([len(r) + 1 for r in raw])
    begins = np.cumsum(sizes) - sizes

    def share(of: np.ndarray) -> np.ndarray:
        return np.add.reduceat(of.astype(np.int64), begins) / sizes

    upper = (original >= 65) & (original <= 90)
    lower = (original >= 97) & (original <= 122)
    digit = (original >= 48) & (original <= 57)
    wide = original >= 128
    space = (original == 32) | ((original >= 9) & (original <= 13))
    n = np.maximum(per_text, 1)
    first = np.cumsum(per_text) - per_text
    same = np.zeros(len(h), dtype=bool)
    for lag in (1, 2, 3):
        same[lag:] |= (h[lag:] == h[:-lag]) & (text_of[lag:] == text_of[:-lag])
    lengths = (ends - starts).astype(np.float64)
    lines = [t.split(b"\n") for t in raw]

    def mean(of: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0.0], np.cumsum(of)))
        return (upto[first + per_text] - upto[first]) / n

    stats = np.stack(
        [
            share(upper) * 4,
            share(lower),
            share(digit) * 8,
            share(wide) * 4,
            share(~(upper | lower | digit | wide | space)) * 4,
            share((original == 124) | (original == 42) | (original == 35) | (original == 36) | (original == 37) | (original == 38)) * 8,
            mean(lengths) / 8,
            mean(same),
            (counts > 0).sum(1) / n,
            np.array([1 - len(set(x)) / len(x) for x in lines]),
            np.array([len(x) for x in lines]) / n,
            np.log1p(sizes) / 10,  # metadata: the text's length
        ],
        axis=1,
    ).astype(np.float32)
    return words, stats


def raw_score(model: dict, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """The machine's output before the logistic function, by the sum-of-squares identity."""
    x = np.concatenate((words, stats), axis=1)
    pairs = ((x @ model["v"]) ** 2).sum(1) - (x * x) @ (model["v"] ** 2).sum(1)
    return model["w0"] + x @ model["w"] + pairs / 2


def fit(words: np.ndarray, stats: np.ndarray, labels: np.ndarray, frequency: dict[int, int], seed: int = 11) -> dict:
    """Adam on the logistic loss; ``frequency`` holds the rows of each label that the sample stands for."""
    rng = np.random.default_rng(seed)
    x, y = np.concatenate((words, stats), axis=1), labels.astype(np.float32)
    share = frequency[1] / (frequency[0] + frequency[1])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())).astype(np.float32)
    p = {"w0": np.zeros(1, np.float32), "w": np.zeros(x.shape[1], np.float32), "v": rng.normal(0, 0.05, (x.shape[1], RANK)).astype(np.float32)}
    m, s, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            xb, step = x[rows], step + 1
            sums = xb @ p["v"]
            z = p["w0"] + xb @ p["w"] + ((sums * sums).sum(1) - (xb * xb) @ (p["v"] ** 2).sum(1)) / 2
            g = weight[rows] * (1 / (1 + np.exp(-z)) - y[rows]) / len(rows)
            grads = {
                "w0": g.sum(keepdims=True),
                "w": xb.T @ g + 1e-5 * p["w"],
                "v": xb.T @ (g[:, None] * sums) - p["v"] * ((xb * xb).T @ g)[:, None] + 1e-4 * p["v"],
            }
            for k, d in grads.items():
                m[k] += 0.1 * (d - m[k])
                s[k] += 0.001 * (d * d - s[k])
                p[k] -= 0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return p


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> dict | None:
    """A model from at most about ``train_rows`` documents of each label; None without a label to learn from."""
    usable = labels.select(F.col("doc_id").alias("id"), F.col("quality")).where(F.col("quality").isin(0, 1)).dropDuplicates(["id"])
    usable = usable.where(~held_out(F.col("id")))
    sample = bounded_sample(usable, "id", "quality", train_rows)
    texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    joined = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("doc_id", "text", "quality")  # train_rows bounds it

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, y = column(batch, "doc_id"), column(batch, "text"), column(batch, "quality")
            for a, b in blocks(rows, BLOCK_CHARS, BLOCK_TEXTS):
                words, stats = features(rows[a:b])
                packed = [(np.flatnonzero(r).astype("<u2").tobytes(), r[r > 0].astype("<f4").tobytes()) for r in words]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b], pa.int64()), pa.array(y[a:b], pa.int32()), pa.array([p[0] for p in packed], pa.binary()), pa.array([p[1] for p in packed], pa.binary()), pa.array([r.tobytes() for r in stats], pa.binary())],
                    ["doc_id", "y", "bins", "weights", "stats"],
                )

    kind = "doc_id bigint, y int, bins binary, weights binary, stats binary"
    got = joined.mapInArrow(digest, kind).toPandas().sort_values(["doc_id", "stats"])  # in one order whatever the partitions
    if got.empty:
        return None
    words = np.zeros((len(got), BINS), np.float32)
    for k, (bins, weights) in enumerate(zip(got["bins"], got["weights"], strict=True)):
        words[k, np.frombuffer(bins, "<u2")] = np.frombuffer(weights, "<f4")
    stats = np.stack([np.frombuffer(b, "<f4") for b in got["stats"]])
    y = got["y"].to_numpy()
    if len(set(y)) == 1:
        return {"only": int(y[0])}
    return fit(words, stats, y, {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()})


def quality_scores(
    docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """doc_id and score (0 to 1) for every row of ``docs``, 0.5 without a model; with ``carry``, the whole row too, as
    struct ``row``."""
    base = carried(docs, id_col, text_col, carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts, out = carried_texts(batch, text_col), []
            for a, b in blocks(texts, BLOCK_CHARS, BLOCK_TEXTS):
                if known is None or "only" in known:
                    out.append(np.full(b - a, 0.5 if known is None else known["only"]))
                else:
                    z = np.clip(raw_score(known, *features(texts[a:b])).astype(np.float64), -60, 60)
                    out.append(1 / (1 + np.exp(-z)))
            found = {"doc_id": batch.column(0), "score": pa.array(np.concatenate(out) if out else [], pa.float64())}
            yield pa.RecordBatch.from_pydict(found | ({"row": batch.column(1)} if carry else {}))

    return base.mapInArrow(score, result_schema(base, "score double"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    return quality_scores(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
