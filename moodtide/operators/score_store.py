"""Scores kept by distinct text, so that a model sees each text once, in this run and in later ones.

A store is a Parquet folder with one row per text: ``digest`` (SHA-256 of the text), ``score`` and the
``run`` that added it. It belongs to one model; another model, or another version, needs another folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.operators.scoring import Scorer

# Texts cross to a Python model in batches of so many rows, which bounds the buffers on both sides.
BATCH_ROWS = 1000

_SCHEMA = "digest binary, score double, run string"


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def stored(spark: SparkSession, path: str) -> DataFrame:
    """(digest, score, run), one row per text; empty where there is no store yet.

    Runs that overlapped may both have added a text; the row of the smallest run counts.
    """
    try:
        rows = spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)
    first = F.min(F.struct("run", "score")).alias("first")
    return rows.groupBy("digest").agg(first).select("digest", "first.score", "first.run")


def fill(texts: DataFrame, scorer: Scorer, path: str, run: str, *, text_col: str = "review_text") -> None:
    """Add the scores of texts that the store at ``path`` does not hold; runs a job.

    Only their distinct texts reach the scorer, copies having been dropped before the shuffle. A run that
    fails adds nothing; repeated, it adds what is missing. NULL texts are left out; a text for which the
    model has no number is stored with NULL and not tried again.
    """
    spark = texts.sparkSession
    named = texts.select(F.col(text_col)).filter(F.col(text_col).isNotNull()).withColumn("digest", _digest(F.col(text_col)))
    distinct = named.groupBy("digest").agg(F.first(text_col).alias(text_col))
    new = distinct.join(stored(spark, path).select("digest"), "digest", "left_anti")
    scored = scorer(new, "score").select("digest", "score", F.lit(run).alias("run"))
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS)
    try:
        scored.write.mode("append").parquet(path)
    finally:
        spark.conf.set(rows, before)


def stored_scorer(path: str, *, text_col: str = "review_text") -> Scorer:
    """Scores of a filled store by text; NULL for NULL texts and for texts that it does not hold."""

    def score(df: DataFrame, out: str) -> DataFrame:
        scores = stored(df.sparkSession, path).select(F.col("digest").alias("__digest"), F.col("score").alias(out))
        named = df.drop(out).withColumn("__digest", _digest(F.col(text_col)))
        return named.join(scores, "__digest", "left").drop("__digest")

    return score


def filling_scorer(scorer: Scorer, path: str, run: str, *, text_col: str = "review_text") -> Scorer:
    """``scorer`` by way of a store: fills it with new texts, then looks all texts up."""

    def score(df: DataFrame, out: str) -> DataFrame:
        fill(df, scorer, path, run, text_col=text_col)
        return stored_scorer(path, text_col=text_col)(df, out)

    return score
