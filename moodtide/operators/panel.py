"""From scored reviews to the daily panel joined with returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.operators.scoring import disagreement

KEYS = ("date", "ticker")


def daily_means(scored: DataFrame, *, with_disagreement: bool = False) -> DataFrame:
    """One row per (date, ticker): mean of both scores and the review count.

    ``with_disagreement`` also carries the sum and count of score gaps, so that review-level
    disagreement can be rolled up later without reading the reviews again.
    """
    aggs = [
        F.avg("score_a").alias("avg_a"),
        F.avg("score_b").alias("avg_b"),
        F.count("review_text" if "review_text" in scored.columns else F.lit(1)).alias("review_count"),
    ]
    if with_disagreement:
        aggs += [
            F.sum(disagreement()).alias("gap_sum"),
            F.count(disagreement()).alias("gap_count"),
        ]
    return scored.na.drop(subset=list(KEYS)).groupBy(*KEYS).agg(*aggs)


def assert_unique_market(market: DataFrame) -> DataFrame:
    """Opt-in check: more than one return per (date, ticker) is an error."""
    repeated = market.groupBy(*KEYS).count().where("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"market has several rows for: {[(str(r.date), r.ticker) for r in repeated]}")
    return market


def join_market(daily: DataFrame, market: DataFrame, *, unique: bool = False) -> DataFrame:
    """Inner join on (date, ticker). Repeated market keys fan out unless ``unique`` is set."""
    if unique:
        assert_unique_market(market)
    return daily.join(market.select("date", "ticker", "ret"), list(KEYS), "inner")


def require_overlap(panel: DataFrame) -> DataFrame:
    """Raise when reviews and market share no (date, ticker)."""
    if panel.isEmpty():
        raise ValueError("no common date and ticker between the daily review panel and the market data")
    return panel


def add_lag(
    panel: DataFrame,
    columns: Sequence[str] = ("avg_a", "avg_b"),
    *,
    calendar: bool = False,
) -> DataFrame:
    """Add ``<column>_lag1``: the value of the ticker's previous row.

    The previous row may be several days earlier. ``calendar=True`` keeps the value only
    when the previous row is exactly the day before. One ticker's rows are bounded by its days.
    """
    w = Window.partitionBy("ticker").orderBy("date", "ret")
    adjacent = F.date_sub("date", 1) == F.lag("date").over(w)
    out = {}
    for c in columns:
        prev = F.lag(c, 1).over(w)
        out[f"{c}_lag1"] = F.when(adjacent, prev) if calendar else prev
    return panel.withColumns(out)


def regression_rows(panel: DataFrame) -> DataFrame:
    """Rows that have a lagged first score."""
    return panel.where(F.col("avg_a_lag1").isNotNull())


def first_entity(panel: DataFrame) -> DataFrame:
    """Only the alphabetically first ticker."""
    return panel.where(F.col("ticker") == panel.agg(F.min("ticker")).scalar())


# -- per-entity summaries ---------------------------------------------------------------


def _first_by(order: Column, *fields: str) -> Column:
    return F.min_by(F.struct(*[F.col(f) for f in fields]), order)


def worst_day(reg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lowest return; the earliest (ticker, date) wins ties."""
    row = _first_by(F.struct("ret", "ticker", "date"), "date", "ticker", "ret").alias("d")
    return (
        reg.where(F.col("ret").isNotNull())
        .groupBy(*by)
        .agg(row)
        .select("d.date", "d.ticker", "d.ret")
        .where(F.col("date").isNotNull())
    )


def best_day(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Highest return over all joined days, with or without a lag; earliest wins ties."""
    row = _first_by(
        F.struct((-F.col("ret")).alias("r"), "ticker", "date"), "date", "ticker", "ret"
    ).alias("d")
    return (
        panel.where(F.col("ret").isNotNull())
        .groupBy(*by)
        .agg(row)
        .select("d.date", "d.ticker", "d.ret")
        .where(F.col("date").isNotNull())
    )


def overlap(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Joined rows, distinct days, and the date range."""
    return panel.groupBy(*by).agg(
        F.count(F.lit(1)).alias("overlap_rows"),
        F.count_distinct("date").alias("overlap_dates"),
        F.min("date").alias("overlap_first"),
        F.max("date").alias("overlap_last"),
    )


def review_volume(reviews: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of reviews and their date span."""
    return reviews.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def mean_disagreement(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute score gap; NULL when the second scorer is off."""
    return scored.groupBy(*by).agg(F.avg(disagreement()).alias("mean_abs_disagreement"))


def series_summary(panel: DataFrame, by: Sequence[str] = ("ticker",)) -> DataFrame:
    """Mean, sample sd, first, last, min and max of both daily series."""
    return panel.groupBy(*by).agg(*series_summary_columns())


def series_summary_columns() -> list[Column]:
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_days")]
    for c, name in (("avg_a", "a"), ("avg_b", "b")):
        v = F.col(c)
        order = F.when(v.isNotNull(), F.struct("date", "ret"))
        aggs += [
            F.avg(v).alias(f"{name}_mean"),
            F.stddev_samp(v).alias(f"{name}_sd"),
            F.min_by(v, order).alias(f"{name}_first"),
            F.max_by(v, order).alias(f"{name}_last"),
            F.min(v).alias(f"{name}_min"),
            F.max(v).alias(f"{name}_max"),
        ]
    return aggs
