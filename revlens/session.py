"""Session settings the library relies on, and a local session for tests.

``tune_session`` only sets runtime SQL options that the results or the
plans depend on; cluster sizing (executors, memory, shuffle partitions)
stays with whoever launches the job.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Options every query expects.
REQUIRED_CONF = {
    # DATE(), EXTRACT() and FORMAT_DATE() are evaluated in UTC, as in the warehouse.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, switch to a
    # broadcast join when a side turns out small, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the operator after the join
    # (an aggregate on the same key) then needs its own shuffle: a hot user
    # or product costs one extra exchange instead of one straggler task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A partitioned write keeps a file per folder open instead of sorting a task's rows by folder first
    # (a task that meets more folders than this sorts the rest).
    "spark.sql.maxConcurrentOutputFileWriters": "256",
}


def tune_session(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ship_library(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once per Spark application.

    Not needed where it is installed on them or was passed with ``--py-files``.
    """
    if not any(f.endswith("/revlens-library.zip") for f in spark.sparkContext.listFiles):
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="revlens-ship-")) / "revlens-library.zip"
        with zipfile.ZipFile(target, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
    return spark


def local_session(
    cores: int | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "revlens",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A ``local[cores]`` session for tests and the local benchmark (UI off)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("REVLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
        # the catalog's default database folder: a scratch folder, not the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="revlens-catalog-"))
    )
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
