"""Helpers shared by the corpus operators: column picking, learn/hold-out split, byte-level word hashing."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, as the contracts spell it: [\x20\x09-\x0D]
ASCII_SPACE = b" \t\n\x0b\x0c\r"
# Texts are handled a few megabytes at a time inside a task, whatever the Arrow batch size is.
BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 512
ARROW_BATCH = "8m"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in spark.checkpoint.dir; set one only where none is set."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.checkpoint.dir", None) is None and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="revlens-ckpt-"))


def stored(df: DataFrame) -> DataFrame:
    """The rows on shared storage, with no lineage behind them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder for written tables that all executors share."""
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir() or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return folder.rstrip("/")


def stored_table(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table on shared storage: no lineage behind them, and a reader takes the columns it needs."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(id_col: Column) -> Column:
    """True for the quarter of ids that no model may learn from; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def bounded_sample(df: DataFrame, id_col: str, group_col: str, rows: int, seed: int = 7) -> DataFrame:
    """About ``rows`` rows of each value of ``group_col`` (all where there are fewer), picked by a hash of the id.

    The values of ``group_col`` are few (class labels); the counts read two columns only.
    """
    counts = {r[0]: r[1] for r in df.groupBy(group_col).count().collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(group_col) == F.lit(value), F.lit(min(1.0, rows / n))).otherwise(share)
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    return df.where(u < share)


def text_batches(docs: DataFrame) -> DataFrame:
    """The same rows, in a session whose Arrow batches are ``ARROW_BATCH`` at most.

    Each task holds several batches in several forms, so their size decides a Python worker's memory. The setting
    only bounds batches; results don't depend on it.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    return docs


def carried(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """doc_id and text, or with ``carry`` doc_id and all columns of the row as a struct, safe from clashing names."""
    other = F.struct(*docs.columns).alias("row") if carry else F.col(text_col).alias("text")
    return text_batches(docs).select(F.col(id_col).alias("doc_id"), other)


def carried_texts(batch: pa.RecordBatch, text_col: str) -> list[str | None]:
    """The texts of a batch of ``carried`` rows."""
    values = batch.column(1)
    return (values.field(text_col) if pa.types.is_struct(values.type) else values).to_pylist()


def result_schema(base: DataFrame, found: str) -> str:
    """The schema of an operator that returns the id, what it found, and the carried row if there is one."""
    row = f", row {base.schema['row'].dataType.simpleString()}" if "row" in base.columns else ""
    return f"doc_id {base.schema['doc_id'].dataType.simpleString()}, {found}{row}"


def blocks(
    texts: Sequence[str | None], max_bytes: int = BLOCK_BYTES, max_rows: int = BLOCK_ROWS
) -> Iterator[tuple[int, int]]:
    """Row ranges of roughly ``max_bytes`` characters and at most ``max_rows`` rows; a longer text is a block of its own."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and (size + n > max_bytes or i - start >= max_rows):
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(texts):
        yield start, len(texts)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(ASCII_SPACE)] = True
_BYTE_KEYS = np.random.Generator(np.random.PCG64(20240131)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_STEP_INV = pow(_STEP, -1, 1 << 64)
_KEPT_POWERS = 1 << 20


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


@functools.cache
def _power_table(base: int) -> np.ndarray:
    return _powers(_KEPT_POWERS, base)


def _first_powers(n: int, base: int) -> np.ndarray:
    """The first ``n`` powers, from a table that a worker makes once; of a longer text they are made anew."""
    return _power_table(base)[:n] if n <= _KEPT_POWERS else _powers(n, base)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes joined by a space, word starts, word ends, and the words per text. A word is a run of non-space bytes."""
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.cumsum([len(r) + 1 for r in raw])
    upto = np.searchsorted(starts, bounds)
    return data, starts, ends, np.diff(upto, prepend=0)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial over keyed bytes from prefix sums, mixed with the length."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.multiply(_BYTE_KEYS[data], _first_powers(len(data), _STEP), out=prefix[1:])
        np.cumsum(prefix, out=prefix)
        h = (prefix[ends] - prefix[starts]) * _first_powers(len(data), _STEP_INV)[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(_STEP))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
