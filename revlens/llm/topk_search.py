"""Exact top-k search by integer inner product, with distributed histogram selection.

Each component x becomes floor(``scale`` * x), so every score is a whole number. Queries are a stated subset of the
rows; each is compared with every other row of its dimension.

1. Rows are packed, by a hash of a row number, into blocks of about ``BLOCK_CELLS`` components (``BLOCK_ROWS`` rows at
   most), the queries once more into blocks of their own. Every pair of a query block and a row block is one joined
   row, so work is dealt by pairs of bounded size, whatever the values are.
2. Score everything, and count each query's scores in bins of their leading bits. A block's histogram is sent down to
   the bin in which it alone holds k rows: no lower bin can hold the global k-th. The summed histograms locate the
   bin of each query's k-th score; the next round counts the following ``DIGIT`` bits inside that bin. After
   ceil(bits / ``DIGIT``) rounds the k-th score is known exactly. The bits are those of the largest possible score.
3. A last pass keeps every row above the k-th score, and of the rows that equal it the smallest ids, as many as are
   still missing: a block sends no more ties than that.

Products are summed in double precision where the bound on the sum is below 2^53, else in unbounded integers; both
are exact. Scores beyond 64 bits are held at the ends of the range.

Defined results: a vector that is null, or holds a null or non-finite component, takes no part; vectors of different
lengths are not compared; an empty vector scores 0. A null id is never a query; as a match it comes after all ids.
Rows that repeat an id are rows of their own: each one asks and answers, and only the query's own row is left out.
An empty table, or one without queries, gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import stored, text_batches

BLOCK_CELLS = 1 << 19  # components in a block
BLOCK_ROWS = 4096
SCORE_CELLS = 1 << 20  # scores held at once inside a task
DIGIT = 12  # bits of a score that a round settles
EXACT = 1 << 53
LONG_MAX = (1 << 63) - 1
WIDEST = float(1 << 63)  # components beyond are held here

_BLOCK = "dim int, part bigint, rows int, kind string, peak double, rids binary, ids binary, named binary, asks binary, cells binary"


def usable(vec: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~bad


def _matrix(column: pa.Array, rows: int, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(rows, dim)


def _packer(scale: float):
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        """One block from the rows of a group; components in the smallest type that holds them."""
        dim, part = key[0].as_py(), key[1].as_py()
        table = table.combine_chunks()
        cells = np.clip(np.floor(_matrix(table["vec"].combine_chunks(), len(table), dim) * scale), -WIDEST, WIDEST)
        peak = float(np.abs(cells).max(initial=0))
        kind = "i2" if peak < 1 << 15 else "i4" if peak < 1 << 31 else "f8"
        ids = table["vec_id"].combine_chunks()
        row = {
            "dim": [dim], "part": [part], "rows": [len(table)], "kind": [kind], "peak": [peak],
            "rids": [table["rid"].to_numpy().tobytes()],
            "ids": [ids.fill_null(0).to_numpy().tobytes()],
            "named": [ids.is_valid().to_numpy(zero_copy_only=False).tobytes()],
            "asks": [table["asks"].to_numpy().tobytes()],
            "cells": [cells.astype(kind).tobytes()],
        }
        schema = pa.schema([
            ("dim", pa.int32()), ("part", pa.int64()), ("rows", pa.int32()), ("kind", pa.string()), ("peak", pa.float64()),
            ("rids", pa.binary()), ("ids", pa.binary()), ("named", pa.binary()), ("asks", pa.binary()), ("cells", pa.binary()),
        ])
        return pa.table(row, schema=schema)

    return pack


def _asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries of row blocks, a row each; their components are already whole."""
    for batch in batches:
        for k in range(batch.num_rows):
            b = _Block(batch, k)
            at = np.flatnonzero(b.asks)
            if len(at):
                vec = pa.FixedSizeListArray.from_arrays(pa.array(b.cells[at].ravel()), b.dim).cast(pa.list_(pa.float64())) if b.dim else pa.array([[]] * len(at), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), b.dim, np.int32)), pa.array(b.rids[at]), pa.array(b.ids[at]), pa.array(b.asks[at].astype(np.int8)), vec],
                    ["dim", "rid", "vec_id", "asks", "vec"],
                )


class _Block:
    """The arrays of one packed block, from row ``k`` of a batch; ``prefix`` tells the sides of a pair apart."""

    def __init__(self, batch: pa.RecordBatch, k: int, prefix: str = "") -> None:
        def cell(name: str):
            return batch.column(batch.schema.get_field_index(prefix + name))[k]

        self.dim = batch.column(batch.schema.get_field_index("dim"))[k].as_py()
        rows = cell("rows").as_py()
        self.peak = cell("peak").as_py()
        self.rids = np.frombuffer(cell("rids").as_buffer(), np.int64)
        self.ids = np.frombuffer(cell("ids").as_buffer(), np.int64)
        self.named = np.frombuffer(cell("named").as_buffer(), bool)
        self.asks = np.frombuffer(cell("asks").as_buffer(), np.int8)
        self.cells = np.frombuffer(cell("cells").as_buffer(), cell("kind").as_py()).astype(np.float64).reshape(rows, self.dim)


def _scores(queries: _Block, rows: _Block, a: int, b: int) -> np.ndarray:
    """Inner products of queries a..b with all rows, as longs."""
    if queries.dim * queries.peak * rows.peak < EXACT:
        return (queries.cells[a:b] @ rows.cells.T).astype(np.int64)
    left = [[int(x) for x in v] for v in queries.cells[a:b]]
    right = [[int(x) for x in v] for v in rows.cells]
    held = [[max(-LONG_MAX, min(LONG_MAX, sum(x * y for x, y in zip(u, v, strict=True)))) for v in right] for u in left]
    return np.array(held, dtype=np.int64)


def _each(batch: pa.RecordBatch, top: int) -> Iterator[tuple]:
    """For each pair of blocks and each slice of its queries: the pair, the slice, its raised scores and the mask of comparable rows.

    Scores are raised by ``top`` into unsigned 64 bits, so that their leading bits order them.
    """
    for k in range(batch.num_rows):
        queries, rows = _Block(batch, k, "q_"), _Block(batch, k)
        step = max(1, SCORE_CELLS // max(1, len(rows.rids)))
        for a in range(0, len(queries.rids), step):
            b = min(a + step, len(queries.rids))
            raised = _scores(queries, rows, a, b).astype(np.uint64) + np.uint64(top)  # wraps as two's complement does
            yield k, queries, rows, a, b, raised, queries.rids[a:b, None] != rows.rids[None, :]


def _state(batch: pa.RecordBatch, k: int, queries: _Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """known, found and missing of the pair's queries, in their order."""
    state = batch.column(batch.schema.get_field_index("state"))[k].values
    rids = state.field("rid").to_numpy()
    at = np.argsort(rids)[np.searchsorted(np.sort(rids), queries.rids)]
    return (
        state.field("known").to_numpy(zero_copy_only=False)[at],
        state.field("found").to_numpy()[at].view(np.uint64),
        state.field("missing").to_numpy()[at],
    )


def _counter(top: int, shift: int, width: int, first: bool, k: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(rid, bin, rows) of one round, from the top down to the bin in which the block alone reaches what is missing."""
        for batch in batches:
            at_k, state = -1, None
            for pair, queries, _, a, b, raised, other in _each(batch, top):
                if not first and pair != at_k:
                    at_k, state = pair, _state(batch, pair, queries)
                missing = np.full(b - a, k) if first else state[2][a:b]
                if not first:  # rows inside the bin that the earlier rounds settled
                    other &= state[0][a:b, None] & ((raised >> np.uint64(shift + width)) == state[1][a:b, None])
                digit = ((raised >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
                flat = (np.arange(b - a)[:, None] << width) + digit
                bins = np.bincount(flat[other], minlength=(b - a) << width).reshape(b - a, 1 << width)
                above = np.cumsum(bins[:, ::-1], axis=1)[:, ::-1] - bins
                row, bin_ = np.nonzero((bins > 0) & (above < missing[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.rids[a:b][row]), pa.array(bin_), pa.array(bins[row, bin_])], ["rid", "bin", "rows"]
                )

    return count


def _taker(top: int):
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Matches above each query's k-th score, and the smallest ids among those that equal it."""
        for batch in batches:
            at_k, state = -1, None
            for pair, queries, rows, a, b, raised, other in _each(batch, top):
                if pair != at_k:
                    at_k, state = pair, _state(batch, pair, queries)
                known, found, missing = (s[a:b] for s in state)
                chosen = other & (~known[:, None] | (raised > found[:, None]))
                ties = other & known[:, None] & (raised == found[:, None])
                order = np.lexsort((rows.ids, ~rows.named))
                kept = ties[:, order]
                kept &= np.cumsum(kept, axis=1) <= missing[:, None]
                chosen[:, order] |= kept
                row, col = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(queries.rids[a:b][row]),
                        pa.array(queries.ids[a:b][row]),
                        pa.array(rows.ids[col], mask=~rows.named[col]),
                        pa.array((raised[row, col] - np.uint64(top)).view(np.int64)),
                    ],
                    ["rid", "query_id", "vec_id", "score"],
                )

    return take


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` with the part of their dimension that a hash of the row number puts them in."""
    room = F.greatest(F.lit(16), F.least(F.lit(BLOCK_ROWS), (F.lit(BLOCK_CELLS) / F.greatest("dim", F.lit(1))).cast("int")))
    parts = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select("dim", F.ceil(F.col("n") / room).alias("parts"))
    return rows.join(parts, "dim").withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts"))).drop("parts")


def _packed(dealt: DataFrame, scale: float) -> DataFrame:
    """Blocks from rows (dim, rid, vec_id, asks, vec, part)."""
    return stored(dealt.groupBy("dim", "part").applyInArrow(_packer(scale), _BLOCK))


def nearest(
    vectors: DataFrame, queries: Column, k: int, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best matches of every row for which ``queries`` is true."""
    rows = text_batches(vectors).where(usable(F.col(vec_col))).select(
        F.size(vec_col).alias("dim"),
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.coalesce(queries & F.col(id_col).isNotNull(), F.lit(False)).cast("tinyint").alias("asks"),
        F.col(vec_col).cast("array<double>").alias("vec"),
    )
    all_rows = _packed(_dealt(stored(rows)), scale)
    asking = stored(_dealt(all_rows.mapInArrow(_asking, "dim int, rid bigint, vec_id bigint, asks tinyint, vec array<double>")))
    all_queries = _packed(asking, 1.0)

    # every row block meets every query block of its dimension
    last_query, last_row = (side.groupBy("dim").agg(F.max("part").alias("last")) for side in (all_queries, all_rows))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last")))
    row_side = all_rows.join(last_query, "dim").select("*", parts.alias("q_part")).drop("last")
    query_side = all_queries.select("dim", *[F.col(c).alias(f"q_{c}") for c in all_queries.columns if c != "dim"])
    query_side = query_side.join(last_row, "dim")

    def pairs(state: DataFrame | None) -> DataFrame:
        told = query_side
        if state is not None:
            each = F.struct("rid", "known", "found", "missing")
            told = told.join(state.groupBy("dim", "q_part").agg(F.collect_list(each).alias("state")), ["dim", "q_part"])
        return row_side.join(told.select("*", parts.alias("part")).drop("last"), ["dim", "part", "q_part"])

    largest = all_rows.agg(F.max(F.col("dim") * F.col("peak") * F.col("peak"))).first()[0] or 0.0  # one number
    top = min(LONG_MAX, int(largest) + 1)  # no score lies further from zero
    bits = (2 * top).bit_length()
    state = None  # of each query: whether its k-th score exists, the leading bits found, the rows still missing below them
    shift = bits
    while shift > 0:
        width = min(DIGIT, shift)
        shift -= width
        counts = pairs(state).mapInArrow(_counter(top, shift, width, state is None, k), "rid bigint, bin bigint, rows bigint")
        bins = counts.groupBy("rid", "bin").agg(F.sum("rows").alias("rows"))
        down = Window.partitionBy("rid").orderBy(F.col("bin").desc())
        reached = bins.withColumn("upto", F.sum("rows").over(down))
        before = state if state is not None else asking.select(
            "dim", F.col("part").alias("q_part"), "rid", F.lit(True).alias("known"), F.lit(0).cast("bigint").alias("found"), F.lit(k).cast("bigint").alias("missing")
        )
        hit = reached.join(before, "rid").where((F.col("upto") >= F.col("missing")) & (F.col("upto") - F.col("rows") < F.col("missing")))
        hit = hit.select("rid", F.expr(f"shiftleft(found, {width}) | bin").alias("now"), (F.col("missing") - F.col("upto") + F.col("rows")).alias("left_over"))
        state = stored(
            before.join(hit, "rid", "left").select(
                "dim",
                "q_part",
                "rid",
                (F.col("known") & F.col("now").isNotNull()).alias("known"),  # fewer than k rows: there is no k-th score
                F.coalesce("now", F.lit(0)).cast("bigint").alias("found"),
                F.coalesce("left_over", F.lit(k)).cast("bigint").alias("missing"),
            )
        )
    found = pairs(state).mapInArrow(_taker(top), "rid bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("rid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


OP13_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.rid <> c.rid AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""
