"""Reviews, scores and returns derived from the given tables.

Text panel: documents as reviews, events as returns. Long panel: order lines as scored reviews,
orders as returns. Both are plain projections and aggregates, so their size follows the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.functions.text import tokens
from moodtide.operators import panel as P
from moodtide.operators import reviews as R
from moodtide.operators.scoring import Scorer, disagreement, lexicon_scorer, score_reviews

ENTITIES = ("click", "error", "purchase", "signup", "view")

# word -> weight for scorer A, scorer B
POLARITY = {
    "that": (0.5, 0.2),
    "with": (0.3, -0.5),
    "for": (-0.4, 0.1),
    "was": (-0.6, -0.8),
    "que": (0.4, 0.7),
    "les": (-0.3, 0.1),
    "und": (0.2, -0.4),
    "der": (-0.2, 0.3),
}
MODIFIERS = {"from": ("negation", -0.5), "is": ("intensifier", 1.3)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexicon(spark: SparkSession, which: int) -> DataFrame:
    rows = [(w, "polarity", ws[which]) for w, ws in POLARITY.items()]
    rows += [(w, kind, weight) for w, (kind, weight) in MODIFIERS.items()]
    # literals, as a list of rows would go through a Python worker of every core
    fields = ("word", "kind", "weight")
    literals = [F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*literals)))


def derived_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first token of every document, with a weight from the id: thousands of words and weights."""
    first = F.get(tokens(F.col("text")), F.lit(0))
    words = table(spark, sf_dir, "documents").select(first.alias("word"), "doc_id").where("word IS NOT NULL")
    weight = (F.min("doc_id") % 1999) / F.lit(1000.0) - F.lit(1.0)
    return words.groupBy("word").agg(weight.alias("weight")).withColumn("kind", F.lit("polarity"))


# -- text panel -------------------------------------------------------------------------


def text_reviews(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    slot = F.expr("cast((doc_id div 30) % 5 as int) + 1")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("review_id"),
        F.date_add(F.to_date(F.lit("2024-01-01")), F.expr("cast(doc_id % 30 as int)")).alias("date"),
        F.element_at(F.array(*[F.lit(e) for e in ENTITIES]), slot).alias("ticker"),
        F.col("text").alias("review_text"),
        *more,
    )


def text_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("ticker"))
        .agg((F.avg("value") / 50 - 1).alias("ret"))
    )


def text_scorer(spark: SparkSession, which: int) -> Scorer:
    """Lexicon scorer, rounded so that ties do not hang on the order of summation."""
    score = lexicon_scorer(lexicon(spark, which))

    def rounded(df: DataFrame, out: str) -> DataFrame:
        return score(df, out).withColumn(out, F.round(out, 12))

    return rounded


def text_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_reviews(
        text_reviews(spark, sf_dir), text_scorer(spark, 0), text_scorer(spark, 1)
    )


def text_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score table of the text panel, persisted: every text is read and scored once."""
    return R.score_table(text_scored(spark, sf_dir), with_digest=False).persist()


def text_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression rows of the text panel, persisted: small, and used by several branches."""
    daily = P.daily_means(text_scores(spark, sf_dir))
    merged = P.join_market(daily, text_market(spark, sf_dir))
    return P.regression_rows(P.add_lag(merged)).persist()


# -- long panel -------------------------------------------------------------------------


def long_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_discount", "l_tax"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("o_orderpriority").alias("ticker"),
        (F.col("l_discount") * 20 - 1).alias("score_a"),
        (F.col("l_tax") * 25 - 1).alias("score_b"),
    )


def long_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("ticker"))
        .agg((F.avg("o_totalprice") / 250000 - 1).alias("ret"))
    )


def long_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day and entity, persisted: small, and read by several branches of a query."""
    daily = P.daily_means(long_scored(spark, sf_dir), with_disagreement=True)
    return P.add_lag(P.join_market(daily, long_market(spark, sf_dir))).persist()


def long_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.regression_rows(long_panel(spark, sf_dir))


def long_disagreement(spark: SparkSession, sf_dir: str, by=("ticker",)) -> DataFrame:
    gap = F.avg(disagreement()).alias("mean_abs_disagreement")
    return long_scored(spark, sf_dir).groupBy(*by).agg(gap)
