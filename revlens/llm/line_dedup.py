"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased. A line with a key of
at least ``min_chars`` code points is dropped where a smaller id holds the same key; all other lines stay, in order.

Documents are taken in ``batches`` ascending id ranges. The seen keys lie in runs: tables of distinct 128-bit key
hashes with the smallest id that holds them, bucketed and sorted by hash, a file for each bucket, all in the same number
of buckets. A new batch reduces its keys to one row each (map-side combine), which one exchange brings into the same
buckets, and merge-anti-joins them with the runs, which are neither shuffled nor sorted again; what is new is added as a run of level 0.
``fan_in`` runs of one level are merged into one run of the next level. A line of the batch is dropped if its key is not
new, or if a smaller id of the batch holds it. Runs stay on shared storage; a hot line is one row per task and batch
before it is shuffled, and the join that finds its copies reads the new run without its buckets, so that it can be split anywhere.

What a row loses is gathered by its id and a hash of its text, so rows that share an id, or have none, don't share a list.

Defined results: a null or empty text is one empty line; a null id counts as larger than all others, and rows
without an id don't drop each other's lines; rows that repeat an id are one document, so they keep their lines;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import ASCII_SPACE, shared_folder, stored, text_batches

MIN_CHARS = 10
BATCHES = 4
FAN_IN = 2


def _key(line: bytes, min_chars: int) -> bytes | None:
    """The line's key, or None if it is too short to count."""
    key = line.strip(ASCII_SPACE).lower()  # on bytes, only A-Z change
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def _raw(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, mark, and the two halves of the hash of each distinct key of a row with doc_id, text, mark."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, digests = [], []
            for i, text in enumerate(_raw(batch, "text")):
                found = {_key(line, min_chars) for line in (text or b"").split(b"\n")} - {None}
                rows += [i] * len(found)
                digests += map(xxhash.xxh3_128_digest, found)
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            ids, marks = batch.column(0).take(at), batch.column(batch.schema.get_field_index("mark")).take(at)
            yield pa.RecordBatch.from_arrays([ids, marks, pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["doc_id", "mark", "h1", "h2"])

    return docs.mapInArrow(keys, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, mark int, h1 bigint, h2 bigint")


def write_run(keys: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """Rows with h1 and h2 as a run, and its folder: bucketed by the hash, each bucket one sorted file.

    The planner knows buckets and order, so a merge join neither shuffles nor sorts the run. Spark takes both from a
    table only; its entry in the catalog goes once the run is opened, the files stay.
    """
    spark = keys.sparkSession
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    name = f"revlens_run_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    dealt = keys.repartition(buckets, "h1", "h2").sortWithinPartitions("h1", "h2")
    dealt.write.bucketBy(buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(name)
    run = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return run, path


def not_in_run(keys: DataFrame, run: DataFrame) -> DataFrame:
    """The keys that a run doesn't hold."""
    return keys.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")


def copied_keys(lines: DataFrame, splits: list, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, mark, h1, h2 of the lines that a smaller id holds; ``splits`` are the upper ends of the id ranges but the last."""
    batch = F.lit(len(splits))
    for i, end in reversed(list(enumerate(splits))):
        batch = F.when(F.col("doc_id") <= F.lit(end), F.lit(i)).otherwise(batch)
    lines = stored(lines.withColumn("batch", batch))
    spark = lines.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs: list[tuple[int, DataFrame]] = []
    copies = []
    for b in range(len(splits) + 1):
        own = lines.where(F.col("batch") == b).drop("batch")
        new = own.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
        for _, run in runs:
            new = not_in_run(new, run)
        run, path = write_run(new, buckets)
        plain = spark.read.schema(run.schema).parquet(path).withColumn("is_new", F.lit(True))
        held = own.join(plain.hint("merge"), ["h1", "h2"], "left")
        earlier = F.col("is_new").isNull() | F.coalesce(F.col("first") < F.col("doc_id"), F.col("first").isNotNull() & F.col("doc_id").isNull())
        copies.append(held.where(earlier).select("doc_id", "mark", "h1", "h2"))
        runs.append((0, run))
        while sum(level == runs[-1][0] for level, _ in runs) >= fan_in and b < len(splits):
            top = runs[-1][0]
            merged = [r for level, r in runs if level == top]
            runs = [x for x in runs if x[0] != top]
            out = merged[0]
            for r in merged[1:]:
                out = out.unionAll(r)
            runs.append((top + 1, write_run(out, buckets)[0]))
    out = copies[0]
    for c in copies[1:]:
        out = out.unionAll(c)
    return out


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """doc_id, text (the lines that stay), n_lines (before), n_dropped for every row of ``docs``."""
    base = text_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    base = base.withColumn("mark", F.hash("text"))
    ends = [k / batches for k in range(1, batches)]
    splits = sorted(set(base.approxQuantile("doc_id", ends, 0.01))) if ends else []
    copies = copied_keys(line_keys(base, min_chars), splits, fan_in)
    per_row = copies.groupBy(F.col("doc_id").alias("of"), F.col("mark").alias("marked")).agg(
        F.collect_set(F.struct("h1", "h2")).alias("gone")  # the lines of one text, however many rows repeat it
    )
    same = (F.col("mark") == F.col("marked")) & F.col("doc_id").eqNullSafe(F.col("of"))
    joined = base.join(per_row, same, "left").select("doc_id", "text", "gone.h1", "gone.h2")

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts, totals, dropped = [], [], []
            for text, h1, h2 in zip(_raw(batch, "text"), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                totals.append(len(lines))
                if h1:
                    packed = np.array([h1, h2], dtype="<i8").T.tobytes()
                    gone = {packed[i : i + 16] for i in range(0, len(packed), 16)}
                    lines = [x for x in lines if (k := _key(x, min_chars)) is None or xxhash.xxh3_128_digest(k) not in gone]
                dropped.append(totals[-1] - len(lines))
                texts.append(b"\n".join(lines))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())],
                ["doc_id", "text", "n_lines", "n_dropped"],
            )

    kind = base.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(apply, f"doc_id {kind}, text string, n_lines bigint, n_dropped bigint")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id"""
