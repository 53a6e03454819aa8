import pytest
from pyspark.sql import functions as F

from moodtide.plans import verdicts as V


def label(spark, fn, *values):
    schema = ", ".join(f"c{i} double" for i in range(len(values)))
    df = spark.createDataFrame([tuple(values)], schema)
    return df.select(fn(*[F.col(c) for c in df.columns])).first()[0]


@pytest.mark.parametrize(
    "fn, values, want",
    [
        (V.direction, (0.0, 0.02), "flat"), (V.direction, (0.0, 0.021), "rose"), (V.direction, (0.5, 0.4), "fell"),
        (V.volatility, (None,), "unknown"), (V.volatility, (0.13,), "high"), (V.volatility, (0.12,), "moderate"), (V.volatility, (0.06,), "low"),
        (V.strength, (None,), "unavailable"), (V.strength, (-0.07,), "negligible"), (V.strength, (0.08,), "weak"),
        (V.strength, (-0.2,), "modest"), (V.strength, (0.35,), "notable"),
        (V.strength_plain, (0.11,), "very weak"), (V.strength_plain, (-0.28,), "moderate"), (V.strength_plain, (0.45,), "noticeable"),
        (V.holdout_verdict, (None, 0.5), "unavailable"), (V.holdout_verdict, (0.5, None), "inconclusive"),
        (V.holdout_verdict, (0.07, -0.11), "inconclusive"), (V.holdout_verdict, (0.12, 0.08), "confirms"),
        (V.holdout_verdict, (0.04, 0.2), "partly_confirms"), (V.holdout_verdict, (-0.2, 0.2), "weakens"),
        (V.holdout_verdict, (-0.2, 0.08), "inconclusive"),
        (V.holdout_class, (-0.06,), "disagreed"), (V.holdout_class, (-0.05,), "flat"), (V.holdout_class, (0.15,), "weak"), (V.holdout_class, (0.35,), "positive"),
        (V.stability_regime, (2.0, 0.0, 0.0), "unavailable"), (V.stability_regime, (3.0, 0.19, 0.0), "recent_noisy"),
        (V.stability_regime, (3.0, 0.1, 0.15), "recent_noisy"), (V.stability_regime, (3.0, 0.11, 0.1), "stable"),
        (V.stability_regime, (3.0, 0.11, None), "stable"), (V.stability_regime, (3.0, 0.15, 0.1), "inconclusive"),
        (V.significance, (None,), "undefined"), (V.significance, (0.05,), "not_significant"), (V.significance, (0.049,), "significant"),
        (V.disagreement_level, (0.46,), "high"), (V.disagreement_level, (0.26,), "moderate"), (V.disagreement_level, (0.25,), "low"),
        (V.sample_depth, (19.0,), "exploratory"), (V.sample_depth, (59.0,), "pilot"), (V.sample_depth, (60.0,), "credible"),
        (V.overview_depth, (44.0,), "moderate_depth"), (V.overview_depth, (45.0,), None),
        (V.headline, (-0.08,), "worth_monitoring"), (V.headline, (0.07,), "weak"), (V.sign_word, (0.0,), "negative"),
    ],
)
def test_rules(spark, fn, values, want):
    assert label(spark, fn, *values) == want


STATS = {
    "n_days": 50, "a_first": 0.0, "a_last": 0.5, "a_sd": 0.01, "b_mean": 0.1, "r_a": 0.1, "r_b": 0.12,
    "n_stability": 30, "n_points": 30, "end_gap": 0.01, "rolling_sd": 0.01, "holdout_r_a": 0.2, "holdout_r_b": None,
    "holdout_p_a": 0.01, "holdout_p_b": None,
    "n_holdout_a": 10, "n_holdout_b": None, "gap_change": "widened", "mean_abs_disagreement": 0.1,
}
SCHEMA = ", ".join(
    f"{c} {'string' if c == 'gap_change' else 'long' if c.startswith('n_') else 'double'}" for c in STATS
)


@pytest.mark.parametrize(
    "change, action, flags, summary",
    [
        ({}, "lean_on_themes", [], ["mood_path", "link_strength", "link_steady"]),
        ({"holdout_r_a": -0.2}, "re_export_first", ["holdout_weakens"], ["mood_path", "link_strength", "link_steady"]),
        ({"end_gap": 0.3}, "discuss_recent_weeks", ["unstable_link"], ["mood_path", "link_strength", "link_unstable"]),
        ({"r_b": 0.3}, "read_queue_first", [], ["mood_path", "link_strength", "scorers_differ"]),
        ({"mean_abs_disagreement": 0.3}, "triage_disagreement", ["high_disagreement"], ["mood_path", "link_strength", "review_gaps"]),
        ({"r_a": 0.3, "r_b": 0.3}, "keep_cadence", [], ["mood_path", "link_strength", "link_steady"]),
        ({"r_a": 0.3, "r_b": 0.3, "n_holdout_a": None, "holdout_r_a": None}, "steady_cadence", [], ["mood_path", "link_strength", "link_steady"]),
        ({"r_a": 0.01, "r_b": None, "n_days": 25, "n_points": 0, "n_holdout_a": None}, "lean_on_themes", ["moderate_depth", "tiny_correlation"], ["mood_path", "link_strength", "link_summary"]),
        ({"r_a": None, "r_b": None, "n_days": 5, "n_points": None, "n_stability": None, "n_holdout_a": None}, "steady_cadence", ["thin_overlap"], ["mood_path", "link_summary", "association_only"]),
    ],
)
def test_bundle(spark, change, action, flags, summary):
    row = {**STATS, **change}
    out = V.add_verdicts(spark.createDataFrame([tuple(row.values())], SCHEMA)).first()
    assert (out.recommended_action, out.risk_flags, out.executive_summary) == (action, flags, summary)


def test_link_summary(spark):
    cases = [((None, "rose", "weak"), "no_summary"), ((0.1, "rose", "weak"), "rose_without_link"), ((0.1, "fell", "negligible"), "fell_without_link"),
             ((0.3, "fell", "modest"), "moved_with_link"), ((0.3, "flat", "modest"), "strength_only")]
    df = spark.createDataFrame([c for c, _ in cases], "r double, d string, s string")
    got = [r[0] for r in df.select(V.link_summary(F.col("r"), F.col("d"), F.col("s"))).collect()]
    assert got == [w for _, w in cases]
