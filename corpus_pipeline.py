"""Corpus pipeline: language ID, quality classifier, exact dedup, MinHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs``, and but for the last returns rows of ``docs``
with all their columns, whatever their names. The dedup stages judge rows, not ids: of each group exactly one row
stays, also where ids are null or repeat, and a text of its own stays under an id that others share. Null and empty texts have
no letter, so the first stage drops them; texts may be of any length; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import held_out, stored, stored_table
from revlens.llm.exact_dedup import exact_dedup
from revlens.llm.language_id import language_id
from revlens.llm.language_id import learn as learn_languages
from revlens.llm.minhash_dedup import near_groups
from revlens.llm.packing import pack_documents
from revlens.llm.quality import THRESHOLD, quality_scores
from revlens.llm.quality import learn as learn_quality

# A text in which no language holds this share of the letters is rejected, and so is one without letters.
MIN_LANGUAGE_SHARE = 0.3


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; all with a letter where no document has a language to learn from."""
    model = learn_languages(docs.where(~held_out(F.col("doc_id"))))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id(docs, model, carry=True)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SHARE)).select("row.*")


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; all of them where there are no labels to learn from."""
    model = learn_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs if model is None else quality_scores(docs, model, carry=True).where(F.col("score") >= THRESHOLD).select("row.*")


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs, carry=True).where("stays").select("row.*")


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    number = "_".join(["row", *docs.columns])  # a name that no column has
    rows = stored_table(docs.withColumn(number, F.monotonically_increasing_id()))
    judged = near_groups(rows, words=5, percent=80, row_col=number)
    gone = judged.where(~F.col("stays")).select(F.col("rid").alias(number))
    return rows.join(gone, number, "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of training windows."""
    return pack_documents(docs, cache_words=300_000, hold_words=False)  # its workers run the other stages too


STAGES = [
    ("language_id", by_language),
    ("quality", by_quality),
    ("exact_dedup", one_of_equal),
    ("minhash_dedup", one_of_near),
    ("packing", packed),
]

# No SQL: the models and the tokenizer can't be expressed; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; what a stage keeps is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
