"""Exact dedup by content sort, in built-in expressions only.

Texts are equal when they are identical after removing every character of ``[\\x20\\x09-\\x0D]``. The normalised texts are
range-partitioned by sampled splitters and sorted outside memory inside each partition, so equal ones are neighbours. Each
row's whole normalised text is compared with its predecessor's; a run ends where they differ. Of a run the row with the
most code points in its original text stays, then the smallest id.

Splitters compare the first ``LEAD`` code points, and beyond them the SHA-256 of the text, so that the sample that Spark
draws is of bounded size however long the texts are; the sort goes on with the whole text.

Hot groups. A first pass counts rows by SHA-256 with a map-side combine, so a hot text costs one row per task. The
groups of more than max(``group_rows``, rows / ``HOT_KEYS``) rows are at most ``HOT_KEYS``, a proven bound for the
broadcast of their digest, winner and size. Their rows are dealt over slices of at most that many rows each, and every slice
gets a copy of the winner's text, which sorts before them: by the same comparison of neighbours each row is proven equal to
the winner in full. If two texts ever shared a digest, the job would fail instead of merging them.

Defined results: a null text counts as empty; a null id comes last among ties and is an id like any other; rows
that repeat an id get the answer of that id, and exactly one row of a group ``stays``; texts may be of any length; an
empty table gives an empty result; other columns are not read, or with ``carry`` come back as the struct ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GROUP_ROWS = 1000
HOT_KEYS = 100_000
LEAD = 64  # code points that the splitters compare before the digest


def _normalised(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS, carry: bool = False
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, stays (and row) for every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.char_length(text).alias("chars"),
        _normalised(text).alias("body"),
        *([F.struct(*docs.columns).alias("row")] if carry else []),
    ).withColumn("sha", F.coalesce(F.sha2(F.col("body"), 256), F.lit("")))  # never null: no null filter on the join key

    limit = max(group_rows, -(-docs.count() // HOT_KEYS))
    first = F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("id"))
    hot = (
        rows.groupBy("sha")
        .agg(F.count(F.lit(1)).alias("hot_size"), F.min(first).alias("first"))
        .where(F.col("hot_size") > limit)
        .select("sha", "hot_size", F.col("first.id").alias("hot_keep"), F.ceil(F.col("hot_size") / limit).alias("slices"))
    )
    # the winners' texts: found by id, so that only their rows are normalised again
    named = hot.select(F.col("sha").alias("hot_sha"), "hot_size", "hot_keep", "slices")
    plain = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    winners = plain.join(F.broadcast(named), F.col("doc_id").eqNullSafe(F.col("hot_keep")))
    winners = winners.withColumn("body", _normalised(F.col("text"))).where(F.sha2("body", 256) == F.col("hot_sha"))
    winners = winners.select(F.col("hot_sha").alias("sha"), "body", "hot_size", "hot_keep", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    winners = winners.dropDuplicates(["sha", "slice"])

    of_slice = F.when(F.col("hot_size").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id", "chars"), F.col("slices")))
    dealt = rows.join(F.broadcast(hot), "sha", "left").withColumn("slice", of_slice).drop("slices").withColumn("winner", F.lit(False))
    dealt = dealt.unionByName(winners.withColumn("winner", F.lit(True)), allowMissingColumns=True)
    dealt = dealt.withColumn("lead", F.substring("body", 1, LEAD)).repartitionByRange("lead", "sha", "slice")

    order = (F.col("chars").desc(), F.col("doc_id").asc_nulls_last())
    place = Window.partitionBy("lead", "sha", "slice").orderBy("body", F.col("winner").desc(), *order)
    differs = ~F.col("body").eqNullSafe(F.lag("body").over(place))
    runs = dealt.withColumn("new", differs.cast("int")).withColumn("run", F.sum("new").over(place)).drop("body", "new")
    run = Window.partitionBy("lead", "sha", "slice", "run")
    ordered = run.orderBy(F.col("winner").desc(), *order)
    is_hot = F.col("hot_size").isNotNull()
    marked = runs.select(
        "*",
        F.first("doc_id").over(ordered).alias("run_keep"),
        F.count(F.lit(1)).over(run).alias("run_size"),
        F.row_number().over(ordered).alias("at"),
        F.max("winner").over(run).alias("proven"),
    ).where(~F.col("winner"))
    unproven = F.raise_error(F.lit("two texts share a SHA-256 digest"))
    keep = F.when(is_hot, F.when(F.col("proven"), F.col("hot_keep")).otherwise(unproven.cast(docs.schema[id_col].dataType))).otherwise(F.col("run_keep"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return marked.withColumn("keep_id", keep).select(
        "doc_id",
        "keep_id",
        F.when(is_hot, F.col("hot_size")).otherwise(F.col("run_size")).alias("group_size"),
        kept.alias("kept"),
        F.col("sha").alias("text_sha256"),
        # of a hot group the winner is the first row behind its copy; rows that repeat it lie in the same slice
        F.when(is_hot, kept & (F.col("at") == 2)).otherwise(F.col("at") == 1).alias("stays"),
        *(["row"] if carry else []),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("stays")


OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
w AS (
  SELECT doc_id, body, count(*) OVER (PARTITION BY body) AS group_size,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM w"""
