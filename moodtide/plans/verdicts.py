"""Rule-based verdicts as columns: one row per entity, every label a CASE over its statistics.

They describe association in past data, never cause or forecast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.operators import panel as P
from moodtide.operators import stats as S

# Rows with a lag that stability paths and the holdout need before they are looked at.
MIN_SERIES = 15


# The thresholds and labels of the rules below.

# -- single rules -----------------------------------------------------------------------


def direction(first: Column, last: Column) -> Column:
    change = last - first
    return F.when(change > 0.02, "rose").when(change < -0.02, "fell").otherwise("flat")


def volatility(sd: Column) -> Column:
    return (
        F.when(sd.isNull(), "unknown").when(sd > 0.12, "high").when(sd > 0.06, "moderate").otherwise("low")
    )


def strength(r: Column) -> Column:
    a = F.abs(r)
    return (
        F.when(r.isNull(), "unavailable")
        .when(a < 0.08, "negligible")
        .when(a < 0.2, "weak")
        .when(a < 0.35, "modest")
        .otherwise("notable")
    )


def strength_plain(r: Column) -> Column:
    a = F.abs(r)
    return (
        F.when(r.isNull(), F.lit(None))
        .when(a < 0.12, "very weak")
        .when(a < 0.28, "weak")
        .when(a < 0.45, "moderate")
        .otherwise("noticeable")
    )


def holdout_verdict(c: Column, r: Column) -> Column:
    """Holdout correlation ``c`` against the full-sample correlation ``r``."""
    ac, ar = F.abs(c), F.abs(r)
    same = (c > 0) == (r > 0)
    return (
        F.when(c.isNull(), "unavailable")
        .when(r.isNull(), "inconclusive")
        .when((ac < 0.08) & (ar < 0.12), "inconclusive")
        .when(same & (ac >= 0.12) & (ar >= 0.08), "confirms")
        .when(same & ((ac >= 0.05) | (ar >= 0.05)), "partly_confirms")
        .when(~same & (ac > 0.05) & (ar > 0.08), "weakens")
        .otherwise("inconclusive")
    )


def holdout_class(c: Column) -> Column:
    return (
        F.when(c.isNull(), "not_scored")
        .when(c < -0.05, "disagreed")
        .when(F.abs(c) < 0.15, "flat")
        .when(c < 0.35, "weak")
        .otherwise("positive")
    )


def stability_regime(n_points: Column, end_gap: Column, rolling_sd: Column) -> Column:
    return (
        F.when(n_points.isNull() | (n_points < 3), "unavailable")
        .when((end_gap > 0.18) | (rolling_sd > 0.14), "recent_noisy")
        .when((end_gap < 0.12) & (rolling_sd.isNull() | (rolling_sd < 0.11)), "stable")
        .otherwise("inconclusive")
    )


def significance(p: Column) -> Column:
    return F.when(p.isNull(), "undefined").when(p >= 0.05, "not_significant").otherwise("significant")


def disagreement_level(gap: Column) -> Column:
    return F.when(gap.isNull(), F.lit(None)).when(gap > 0.45, "high").when(gap > 0.25, "moderate").otherwise("low")


def sample_depth(n: Column) -> Column:
    return F.when(n < 20, "exploratory").when(n < 60, "pilot").otherwise("credible")


def overview_depth(n: Column) -> Column:
    return F.when(n < 20, "thin_overlap").when(n < 45, "moderate_depth")


def headline(r: Column) -> Column:
    return F.when(r.isNull(), F.lit(None)).when(F.abs(r) >= 0.08, "worth_monitoring").otherwise("weak")


def sign_word(r: Column) -> Column:
    return F.when(r.isNull(), F.lit(None)).when(r > 0, "positive").otherwise("negative")


def link_summary(r: Column, drift: Column, strength_word: Column) -> Column:
    faint = strength_word.isin("negligible", "weak")
    return (
        F.when(r.isNull(), "no_summary")
        .when((drift == "rose") & faint, "rose_without_link")
        .when((drift == "fell") & faint, "fell_without_link")
        .when(drift.isin("rose", "fell"), "moved_with_link")
        .otherwise("strength_only")
    )


def _listed(*codes: Column, most: int) -> Column:
    return F.slice(F.array_compact(F.array(*codes)), 1, most)


# -- the facts table --------------------------------------------------------------------


def entity_statistics(
    panel: DataFrame,
    disagreement: DataFrame | None = None,
    *,
    by: Sequence[str] = ("ticker",),
    min_train: int = 25,
    min_holdout: int = 8,
    window: int = 20,
) -> DataFrame:
    """All numbers behind the verdicts, one row per entity.

    ``panel`` is the lagged daily panel. Every part is grouped by the same keys, so the joins
    between them need no further shuffle. ``disagreement`` has ``mean_abs_disagreement``.
    """
    by = list(by)
    reg = P.regression_rows(panel)
    long_enough = _long_series(reg, by)
    stability = S.stability_frame(long_enough, by=by, window=window)

    base = panel.groupBy(*by).agg(
        *P.series_summary_columns(),
        F.min("date").alias("overlap_first"),
        F.max("date").alias("overlap_last"),
    )
    out = base.join(S.correlations(reg, by), by, "left")
    spread = stability.groupBy(*by).agg(
        *S.stability_spread_columns(), F.count(F.lit(1)).alias("n_stability")
    )
    out = out.join(spread, by, "left")
    last = S.stability_endpoints(stability, by).select(
        *by, *(F.col(f"{kind}_{s}").alias(f"last_{kind}_{s}") for s in "ab" for kind in ("expanding", "rolling"))
    )
    out = out.join(last, by, "left")
    for s in ("a", "b"):
        held = S.holdout_eval(
            long_enough, f"avg_{s}_lag1", by=by, min_train=min_train, min_holdout=min_holdout
        ).select(
            *by,
            F.col("corr_pred_actual").alias(f"holdout_r_{s}"),
            F.col("p_value").alias(f"holdout_p_{s}"),
            F.col("n_train").alias(f"n_train_{s}"),
            F.col("n_holdout").alias(f"n_holdout_{s}"),
        )
        out = out.join(held, by, "left")
    out = out.join(S.early_late_gap(panel, by), by, "left")
    if disagreement is None:
        return out.withColumn("mean_abs_disagreement", F.lit(None).cast("double"))
    return out.join(disagreement.select(*by, "mean_abs_disagreement"), by, "left")


def _long_series(reg: DataFrame, by: Sequence[str]) -> DataFrame:
    from pyspark.sql import Window

    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    return reg.withColumn("__n", n).where(F.col("__n") >= MIN_SERIES).drop("__n")


def add_verdicts(stats: DataFrame) -> DataFrame:
    """Add every label to a table with the columns of :func:`entity_statistics`."""
    c = F.col
    both = c("r_a").isNotNull() & c("r_b").isNotNull()
    gap_note = c("mean_abs_disagreement")
    labels = stats.withColumns(
        {
            "both_scorers": both,
            "r_gap": F.when(both, F.abs(c("r_a") - c("r_b"))),
            "drift": F.coalesce(direction(c("a_first"), c("a_last")), F.lit("flat")),
            "drift_size": c("a_last") - c("a_first"),
            "volatility": volatility(c("a_sd")),
            "strength_a": strength(c("r_a")),
            "strength_b": strength(c("r_b")),
            "strength_plain_a": strength_plain(c("r_a")),
            "headline": headline(c("r_a")),
            "r_sign": sign_word(c("r_a")),
            "stability_available": F.coalesce(c("n_stability"), F.lit(0)) > 0,
            "regime": stability_regime(c("n_points"), c("end_gap"), c("rolling_sd")),
            "holdout_available_a": c("n_holdout_a").isNotNull(),
            "holdout_available_b": c("n_holdout_b").isNotNull(),
            "holdout_verdict_a": holdout_verdict(c("holdout_r_a"), c("r_a")),
            "holdout_verdict_b": holdout_verdict(c("holdout_r_b"), c("r_b")),
            "significance_a": F.when(c("n_holdout_a").isNotNull(), significance(c("holdout_p_a"))),
            "significance_b": F.when(c("n_holdout_b").isNotNull(), significance(c("holdout_p_b"))),
            "holdout_class_a": F.when(c("n_holdout_a").isNotNull(), holdout_class(c("holdout_r_a"))),
            "disagreement_level": disagreement_level(gap_note),
            "disagreement_warning": F.coalesce(gap_note > 0.28, F.lit(False)),
            "sample_depth": sample_depth(c("n_days")),
            "overview_depth": overview_depth(c("n_days")),
            "second_scorer": F.when(c("b_mean").isNotNull(), "on").otherwise("off"),
        }
    )
    labels = labels.withColumns(
        {
            "scorers_divergent": F.coalesce(c("r_gap") > 0.25, F.lit(False)),
            "link_summary": link_summary(c("r_a"), c("drift"), c("strength_a")),
            "section_scorers": F.when(c("r_gap") > 0.12, "differ").when(c("r_gap").isNotNull(), "agree"),
            "section_gap": F.when(gap_note > 0.35, "high"),
            "section_volatility": F.when(c("volatility").isin("high", "moderate"), c("volatility")),
            "section_second_scorer": F.when(c("second_scorer") == "off", "off")
            .when(c("gap_change") == "widened", "widened")
            .when(c("gap_change") == "narrowed", "narrowed")
            .otherwise("on"),
        }
    )
    held = c("holdout_available_a")
    weakens = held & (c("holdout_verdict_a") == "weakens")
    noisy = c("regime") == "recent_noisy"
    r_gap_wide = F.coalesce(c("r_gap") > 0.15, F.lit(False))
    action = (
        F.when(weakens, "re_export_first")
        .when(noisy, "discuss_recent_weeks")
        .when(r_gap_wide, "read_queue_first")
        .when(c("disagreement_warning"), "triage_disagreement")
        .when(c("strength_a").isin("negligible", "weak"), "lean_on_themes")
        .when(held & c("holdout_verdict_a").isin("confirms", "partly_confirms"), "keep_cadence")
        .otherwise("steady_cadence")
    )
    tiny = F.coalesce(F.abs(c("r_a")) < 0.08, F.lit(False)) & (c("n_days") >= 25)
    flags = _listed(
        c("overview_depth"),
        F.when(weakens, "holdout_weakens"),
        F.when(noisy, "unstable_link"),
        F.when(c("disagreement_warning"), "high_disagreement"),
        F.when(tiny, "tiny_correlation"),
        most=5,
    )
    summary = _listed(
        F.when(c("n_days") > 0, "mood_path"),
        F.when(c("r_a").isNotNull(), "link_strength"),
        F.when(r_gap_wide, "scorers_differ").when(c("disagreement_warning"), "review_gaps"),
        F.when(noisy, "link_unstable").when(
            (c("regime") == "stable") & c("stability_available"), "link_steady"
        ),
        F.when(held & (c("holdout_verdict_a") == "confirms"), "holdout_confirms").when(
            weakens, "holdout_weakens"
        ),
        F.lit("link_summary"),
        F.lit("association_only"),
        F.lit("extend_window"),
        most=3,
    )
    return labels.withColumns(
        {"recommended_action": action, "risk_flags": flags, "executive_summary": summary}
    )


def entity_facts(
    panel: DataFrame,
    disagreement: DataFrame | None = None,
    *,
    by: Sequence[str] = ("ticker",),
    **options,
) -> DataFrame:
    """Statistics and verdicts of every entity, one row each."""
    return add_verdicts(entity_statistics(panel, disagreement, by=by, **options))
