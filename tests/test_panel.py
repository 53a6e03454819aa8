from datetime import date

import pytest

from moodtide.operators import panel as P

D = [date(2024, 1, i) for i in range(1, 10)]
SCORED = "date date, ticker string, review_text string, score_a double, score_b double"
MARKET = "date date, ticker string, ret double"


def test_daily_means_skip_missing(spark):
    df = spark.createDataFrame(
        [(D[0], "T", "x", 0.2, None), (D[0], "T", None, 0.4, 0.5), (D[0], None, "x", 1.0, 1.0)], SCORED
    )
    (r,) = P.daily_means(df, with_disagreement=True).collect()
    assert (r.avg_a, r.avg_b, r.review_count) == (pytest.approx(0.3), 0.5, 1)
    assert (r.gap_sum, r.gap_count) == (pytest.approx(0.1), 1)


def test_lag_steps_over_gap_days(spark):
    daily = spark.createDataFrame(
        [(D[0], "T", 0.1, 0.9, 1), (D[2], "T", 0.3, 0.7, 1), (D[3], "T", 0.4, 0.6, 1)],
        "date date, ticker string, avg_a double, avg_b double, review_count long",
    )
    market = spark.createDataFrame([(d, "T", 0.01) for d in D], MARKET)
    panel = P.add_lag(P.join_market(daily, market)).orderBy("date").collect()
    assert [r.avg_a_lag1 for r in panel] == [None, 0.1, 0.3]
    strict = P.add_lag(P.join_market(daily, market), calendar=True).orderBy("date").collect()
    assert [r.avg_a_lag1 for r in strict] == [None, None, 0.3]


def test_fan_out_and_unique_check(spark):
    daily = spark.createDataFrame([(D[0], "T", 0.1, 0.2, 1)], "date date, ticker string, avg_a double, avg_b double, review_count long")
    market = spark.createDataFrame([(D[0], "T", 0.1), (D[0], "T", 0.2)], MARKET)
    assert P.join_market(daily, market).count() == 2
    with pytest.raises(ValueError, match="several rows"):
        P.join_market(daily, market, unique=True)
    with pytest.raises(ValueError, match="no common date"):
        P.require_overlap(P.join_market(daily, market.where("ticker = 'U'")))


def test_worst_and_best_day(spark):
    rows = [
        (D[0], "B", -0.5, None), (D[1], "B", -0.2, 0.1), (D[2], "A", -0.2, 0.1),
        (D[3], "A", 0.3, None), (D[4], "B", 0.3, 0.2),
    ]
    panel = spark.createDataFrame(rows, "date date, ticker string, ret double, avg_a_lag1 double")
    reg = P.regression_rows(panel)
    # The unlagged -0.5 does not count for the worst day; ties go to the first (ticker, date).
    assert tuple(P.worst_day(reg).first()) == (D[2], "A", -0.2)
    assert tuple(P.best_day(panel).first()) == (D[3], "A", 0.3)
    assert {tuple(r) for r in P.best_day(panel, ["ticker"]).collect()} == {(D[3], "A", 0.3), (D[4], "B", 0.3)}
    assert P.worst_day(reg.where("false")).isEmpty()
    assert {r.ticker for r in P.first_entity(panel).collect()} == {"A"}


def test_series_summary_ignores_missing_ends(spark):
    rows = [(D[0], "T", 0.0, None, 0.5), (D[1], "T", 0.0, 0.2, 0.4), (D[2], "T", 0.0, 0.6, None)]
    panel = spark.createDataFrame(rows, "date date, ticker string, ret double, avg_a double, avg_b double")
    r = P.series_summary(panel).first()
    assert (r.n_days, r.a_first, r.a_last, r.b_first, r.b_last) == (3, 0.2, 0.6, 0.5, 0.4)
    assert r.a_sd == pytest.approx(0.2828427, abs=1e-6)
