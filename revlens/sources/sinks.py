"""Materialising layers: the Spark equivalent of CREATE OR REPLACE TABLE.

A written table is a lineage barrier that survives the loss of any executor,
which a cache does not. Tables go to a shared folder: ``spark.checkpoint.dir``
when the cluster names one; only a local session without it gets a private
scratch folder (tests).
"""

from __future__ import annotations

import json
import re
import tempfile
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate tables."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"set {CHECKPOINT_CONF} to a folder every executor can reach before writing layers"
        )
    folder = tempfile.mkdtemp(prefix="revlens-shared-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def write_table(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), fmt: str = "parquet"
) -> None:
    """Overwrite ``path`` with ``df`` (CREATE OR REPLACE TABLE ... AS). Parquet is packed by zstd."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def bucketed(spark: SparkSession, schema: StructType, path: str, key: str, buckets: int, rows: DataFrame | None = None) -> DataFrame:
    """The table in ``path``, whose files are dealt by a hash of ``key``: joins and aggregates by it read it without a shuffle.

    ``rows`` are written there first; they should come out of an exchange by ``key``, else each task writes a file per
    bucket. Spark keeps the layout of files in its catalog only, so the table is named there for that moment; dropping
    the name leaves the files and the DataFrame.
    """
    name = f"revlens_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    layout = f"OPTIONS (compression 'zstd') CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {layout}")
    try:
        if rows is not None:
            rows.write.insertInto(name)
            spark.catalog.refreshTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def is_bucketed(spark: SparkSession, path: str) -> bool:
    """Whether each data file in ``path`` names its bucket: a file that someone added later need not."""
    fs, p = _hadoop(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return all(re.fullmatch(r".*_\d+(\..*)?", n) for n in names if not n.startswith(("_", ".")))


def content_columns(columns: list[str]) -> list[Column]:
    """``linhas`` and ``conteudo``: the row count and an order-independent hash of the rows, repeats included.

    The hash is the sum of two 64-bit hashes of each row, NULLs told apart by place. Sums merge, so partitions, files
    or deltas can be hashed on their own and added.
    """
    cells = [F.col(f"`{c}`") for c in columns]
    nulls = [c.isNull() for c in cells]
    parts = [F.sum(F.xxhash64(F.lit(seed), *cells, *nulls).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("linhas"), F.coalesce(F.concat_ws(":", *parts), F.lit("")).alias("conteudo")]


def content(df: DataFrame) -> DataFrame:
    """One row (linhas, conteudo) for the rows of ``df``: one scan, partial sums per partition."""
    return df.agg(*content_columns(df.columns))


@dataclass(frozen=True)
class Gate:
    """Row rules (name -> SQL condition of a violation) that the writing job checks.

    quarantine  a violating row is kept aside with the rules it broke, and not served
    refuse      one violation, and the version is not committed
    report      violations are counted only
    """

    quarantine: dict[str, str]
    refuse: dict[str, str]
    report: dict[str, str]

    def rules(self) -> list[tuple[str, str, str]]:
        """(action, rule, condition) of every rule."""
        each = (("quarentena", self.quarantine), ("recusa", self.refuse), ("aviso", self.report))
        return [(action, name, sql) for action, named in each for name, sql in named.items()]


class QualityError(ValueError):
    """A version was not committed because its rows broke a rule."""


# Folder and column that part served from quarantined rows of a gated version.
ASIDE, REASONS = "quarentena", "motivos"


def materialize(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    sort_within: tuple[str, ...] = (),
    gate: Gate | None = None,
    buckets: tuple[str, int] | None = None,
) -> tuple[DataFrame, dict]:
    """Write ``df``; return a DataFrame that reads it back (lineage cut) and what the writing job observed.

    The read-back is a plain path read with the known schema (no footer is
    opened). ``sort_within`` sorts each file's rows (no shuffle) so that
    Parquet row-group min/max statistics let pushed-down filters on those
    columns skip row groups. ``partition_by`` makes a folder per value; a
    rebalance gathers each value's rows first and splits the large ones.
    ``buckets`` (key, number) deals the files by a key instead (see ``bucketed``).

    The content hash and the violations of ``gate`` are metrics of the same
    job: the rows are neither scanned nor computed again. With a gate, rows
    that break a quarantine rule go to a folder of their own in the same write.
    """
    source, observed = df, Observation()
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    metrics = content_columns(source.columns)
    if gate is not None:
        broken = {name: F.coalesce(F.expr(sql), F.lit(False)) for _, name, sql in gate.rules()}
        reasons = F.array_compact(F.array(*[F.when(broken[name], F.lit(name)) for name in gate.quarantine])) if gate.quarantine else F.array().cast("array<string>")
        metrics += [F.count_if(cond).alias(name) for name, cond in broken.items()]
        metrics.append(F.count_if(F.size(reasons) > 0).alias(ASIDE))
        df = df.observe(observed, *metrics).withColumn(REASONS, reasons).withColumn(ASIDE, F.size(REASONS) > 0)
        partition_by = (ASIDE, *partition_by)
    else:
        df = df.observe(observed, *metrics)
    if buckets is not None:
        out = bucketed(source.sparkSession, source.schema, path, *buckets, rows=df)
        return out.select(*source.columns), dict(observed.get) | {"buckets": buckets[1]}
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    write_table(df, path, partition_by)
    found = observed.get
    spark = source.sparkSession
    if gate is not None:
        refused = {name: found[name] for name in gate.refuse if found[name]}
        if refused:
            drop_folder(spark, path)
            raise QualityError(f"{path}: not committed, rows break {refused}")
        if found["linhas"] == found[ASIDE]:  # no row is served, so there is no folder to read
            return spark.createDataFrame([], source.schema), found
        path = f"{path}/{ASIDE}=false"
    out = spark.read.schema(source.schema).parquet(path)
    # partition columns come back last; restore the contract's column order
    return out.select(*source.columns), found


def quarantined(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows a gated version kept aside, with the rules each one broke (None: there are none)."""
    folder = f"{path}/{ASIDE}=true"
    return spark.read.parquet(folder) if _exists(spark, folder) else None


class Manifest:
    """Which version of each layer under ``target`` is served, and what it was built from.

    A layer is written to a folder of its own; then one small JSON record is
    added here by Spark's own committer. Readers take the complete record with
    the highest number, so a failed write changes nothing, and a replaced
    version stays readable for those who already read it, until ``vacuum``.
    """

    def __init__(self, spark: SparkSession, target: str) -> None:
        self.spark, self.path = spark, f"{target}/_manifest"

    def records(self) -> dict[str, list[dict]]:
        """Complete records by layer, oldest first."""
        if not _exists(self.spark, self.path):
            return {}
        rows = self.spark.read.option("recursiveFileLookup", "true").text(self.path).collect()  # one row per layer version
        out: dict[str, list[dict]] = {}
        for record in sorted((json.loads(r["value"]) for r in rows), key=lambda x: (x["number"], x["at"])):
            out.setdefault(record["layer"], []).append(record)
        return out

    def served(self, layer: str, built_from: str | None = None) -> dict | None:
        """The record of the layer's newest version, if that was built from ``built_from``."""
        newest = self.records().get(layer, [None])[-1]
        if newest is None or (built_from is not None and newest["built_from"] != built_from):
            return None
        return newest

    def add(self, layer: str, path: str, built_from: str | None, observed: dict | None = None) -> None:
        """Commit a version. Its number is one above the layer's last; the clock only parts two writers of one number."""
        last = self.records().get(layer, [{"number": 0}])[-1]["number"]
        record = {"layer": layer, "path": path, "built_from": built_from, "number": last + 1, "at": time.time_ns(), "observed": observed or {}}
        line = self.spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1)
        line.write.text(f"{self.path}/{layer}-{uuid.uuid4().hex}")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the files of all but each layer's newest ``keep`` versions; their records go first. Returns the folders."""
        if keep < 1:
            raise ValueError("the served version must be kept")
        gone = [r["path"] for records in self.records().values() for r in records[:-keep]]
        rows = self.spark.read.option("recursiveFileLookup", "true").text(self.path).select("value", F.input_file_name().alias("file")) if gone else None
        for row in rows.collect() if rows is not None else []:  # one row per layer version
            if json.loads(row["value"])["path"] in gone:
                drop_folder(self.spark, row["file"].rpartition("/")[0])
        for path in gone:
            drop_folder(self.spark, path)
        return gone


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def file_identity(spark: SparkSession, folders: list[str]) -> list[tuple[str, int, int]]:
    """Path, length and modification time of the files in ``folders``, from one listing each."""
    out = []
    for folder in sorted(set(folders)):
        fs, p = _hadoop(spark, folder)
        for status in fs.listStatus(p):
            out.append((status.getPath().toUri().toString().replace("file:///", "file:/"), status.getLen(), status.getModificationTime()))
    return sorted(out)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)
