"""Near-duplicate vectors by random-hyperplane signs in several tables, exact cosines, and connected components.

Only vectors of one label and length are compared. Equal vectors are one class (a number of its own, smallest id, number
of rows). Each
table's bucket is the signs of ``bits`` random hyperplanes; there are as many tables as bring the chance that a pair
at the threshold shares no bucket under ``MISS``, and as many bits as keep buckets at about ``PER_BUCKET`` unrelated
classes, so the work per vector grows with the logarithm of their number.

A bucket is compared inside one task as one matrix product. A bucket of more than ``BLOCK`` classes is cut into
blocks, and each pair of blocks is a task group of its own, so no task sees more than two blocks. A pair that shares
several buckets counts in the first one only, which each task decides from the signs. Tasks send back one row for each
vector with links: how many, and the first class it hangs together with there. Pairs never leave the task. Classes, not ids, are
the nodes; a component takes the smallest id of its classes at the end.

Defined results: a vector that is null, zero, or holds null or non-finite numbers, or has no label, links with
nothing and is its own component; a null id links with nothing, has a null component and is kept; rows that repeat an
id are vectors of their own with that id, each with its own links; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import stored
from revlens.llm.components import components

THRESHOLD = 0.98
MISS = 1e-5
PER_BUCKET = 16
BLOCK = 1500
SEED = 41


def tables_for(classes: int, threshold: float) -> tuple[int, int]:
    """Bits of a bucket and number of tables."""
    bits = min(48, max(8, math.ceil(math.log2(max(classes, 1) / PER_BUCKET))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - same))


@functools.cache
def _planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(SEED + dim)).normal(size=(tables * bits, dim))


def signs(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Bucket number of each vector in each of the first ``tables`` tables, by planes that the vectors' length fixes."""
    above = (vectors @ _planes(vectors.shape[1], bits, tables).T > 0).reshape(len(vectors), tables, bits)
    return above @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _matrix(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    """The vectors of some rows, which all have one length."""
    lists = column.take(pa.array(rows))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)


def bucketed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """a, label, dim, table, bucket: a row for each class and table."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(2))
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                found = signs(_matrix(batch.column(3), rows), bits, tables)
                at = pa.array(np.repeat(rows, tables))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in range(3)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(rows))), pa.array(found.ravel())],
                    ["a", "label", "dim", "table", "bucket"],
                )

    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("a", "label", "dim", "embedding").mapInArrow(
        sign, f"a bigint, label {kind}, dim int, table int, bucket bigint"
    )


def _linked(x: np.ndarray, n: np.ndarray, table: int, left: int, threshold: float, bits: int):
    """Pairs of rows of one group that link and share no earlier table; ``left`` rows of one block face the rest, or
    all rows face each other if it is 0."""
    if left:
        cosine = (x[:left] @ x[left:].T) / np.outer(n[:left], n[left:])
        i, j = np.nonzero(cosine >= threshold)
        j += left
    else:
        i, j = np.nonzero(np.triu((x @ x.T) / np.outer(n, n) >= threshold, 1))
    if table and len(i):
        s = signs(x, bits, table)
        first = np.ones(len(i), dtype=bool)
        for t in range(table):
            first &= s[i, t] != s[j, t]
        i, j = i[first], j[first]
    return i, j


def _smallest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each row the smallest id that it hangs together with by the pairs."""
    root = ids.copy()
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if np.array_equal(new, root):
            return root
        root = new


def links_in_buckets(rows: DataFrame, threshold: float, bits: int) -> DataFrame:
    """node, root, links from rows (label, dim, table, bucket, facing, side, a, weight, embedding) sorted by group."""
    keys = ("label", "dim", "table", "bucket", "facing")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def judged(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            t = {c: table.column(c).to_numpy() for c in ("dim", "table", "side", "a", "weight")}
            starts = np.flatnonzero(_changes(table))
            ends = np.append(starts[1:], len(table))
            out: list[list[np.ndarray]] = [[], [], []]
            vectors = table.column("embedding").combine_chunks()
            vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                if b - a < 2:
                    continue
                x = _matrix(vectors, np.arange(a, b))
                n = np.sqrt((x * x).sum(1))
                left = int((t["side"][a:b] == 1).sum())  # 1: first block, 2: second block, 0: one block by itself
                if left == b - a:
                    continue
                i, j = _linked(x, n, int(t["table"][a]), left, threshold, bits)
                if len(i):
                    ids, weight = t["a"][a:b], t["weight"][a:b].astype(np.float64)
                    counts = np.bincount(i, weights=weight[j], minlength=b - a) + np.bincount(j, weights=weight[i], minlength=b - a)
                    some = np.flatnonzero(counts)
                    for o, v in zip(out, (ids[some], _smallest(ids, i, j)[some], counts[some].astype(np.int64)), strict=True):
                        o.append(v)
            cols = [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["node", "root", "links"])

        def _changes(table: pa.Table) -> np.ndarray:
            new = np.zeros(len(table), dtype=bool)
            new[:1] = True
            for c in keys:
                v = table.column(c).to_numpy()
                new[1:] |= v[1:] != v[:-1]
            return new

        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([kept, now]) if kept is not None else now
            last = int(np.flatnonzero(_changes(now))[-1])  # the last group may go on in the next batch
            if last:
                yield judged(now.slice(0, last))
            kept = now.slice(last)
        if kept is not None:
            yield judged(kept)

    return rows.mapInArrow(compare, "node bigint, root bigint, links bigint")


def embedding_groups(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``."""
    base = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("label")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = F.coalesce(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    usable = base.where(fit)
    classes = stored(
        usable.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("smallest"), F.count(F.lit(1)).alias("weight"))
        .withColumn("dim", F.size("embedding"))
        .withColumn("a", F.monotonically_increasing_id())
    )
    bits, tables = tables_for(classes.count(), threshold)
    group = ["label", "dim", "table", "bucket"]
    members = stored(bucketed(classes, bits, tables))
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    members = members.join(sizes, group).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    members = members.withColumn("block", F.pmod(F.xxhash64("a", "table"), F.col("blocks")).cast("int"))
    # a row goes to every pair of blocks that its own is part of; most buckets are one block
    faced = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    faced = faced.select(
        *group,
        "a",
        (low * F.col("blocks") + high).cast("bigint").alias("facing"),
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"),
    )
    rows = faced.join(classes.select("a", "weight", "embedding"), "a")
    rows = rows.repartition(*group, "facing").sortWithinPartitions(*group, "facing", "side")
    found = stored(links_in_buckets(rows, threshold, bits))
    links = found.groupBy(F.col("node").alias("a")).agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "a")
    firsts = classes.select("a", "smallest").join(groups, "a").groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = classes.join(links, "a", "left").join(groups.join(firsts, "component"), "a", "left")
    named = named.select(
        "label",
        "embedding",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "smallest").alias("component_id"),
    )
    linked = usable.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = base.where(~fit).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
