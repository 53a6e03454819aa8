import math

import numpy as np
import pandas as pd
import pytest

from moodtide.operators import stats as S


def sandwich(x, y):
    """HC3 by the general matrix formula."""
    X = np.column_stack([np.ones_like(x), x])
    inv = np.linalg.inv(X.T @ X)
    beta = inv @ X.T @ y
    e = y - X @ beta
    h = np.einsum("ij,jk,ik->i", X, inv, X)
    cov = inv @ (X.T * (e / (1 - h)) ** 2) @ X @ inv
    return beta, np.sqrt(cov[1, 1]), 1 - (e @ e) / ((y - y.mean()) @ (y - y.mean()))


def series(n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    return x, 0.3 * x + rng.normal(size=n) * (1 + np.abs(x))


@pytest.mark.parametrize("by", [["ticker"], []])
def test_ols_matches_matrix_formula(panel_of, by):
    x, y = series(60)
    r = S.ols_hc3(panel_of(x.tolist(), y), by=by).first()
    beta, se, r2 = sandwich(x, y)
    assert (r.coef, r.intercept, r.std_err, r.r2) == tuple(map(pytest.approx, (beta[1], beta[0], se, r2)))
    assert r.p_value == pytest.approx(math.erfc(abs(beta[1] / se) / math.sqrt(2)))
    assert r.ci_high - r.ci_low == pytest.approx(2 * 1.959963984540054 * se)


@pytest.mark.parametrize("by", [["ticker"], []])
def test_ols_left_out_when_not_usable(panel_of, by):
    x, y = series(7)
    assert S.ols_hc3(panel_of(x.tolist(), y), by=by).isEmpty()
    assert S.ols_hc3(panel_of([0.5] * 40, np.arange(40)), by=by).isEmpty()
    assert S.ols_hc3(panel_of(np.arange(40.0).tolist(), [1.0] * 40), by=by).isEmpty()
    # One point alone fixes the slope: its leverage is 1.
    assert S.ols_hc3(panel_of([0.0] * 9 + [1.0], list(range(10))), by=by).isEmpty()


def test_entities_are_independent(panel_of):
    a, b = series(30, 1), series(30, 2)
    both = panel_of(a[0].tolist(), a[1]).unionByName(panel_of(b[0].tolist(), b[1], ticker="U"))
    got = {r.ticker: r.coef for r in S.ols_hc3(both.repartition(3)).collect()}
    assert got == {"T": pytest.approx(sandwich(*a)[0][1]), "U": pytest.approx(sandwich(*b)[0][1])}


def test_holdout_matches_numpy(panel_of):
    x, y = series(50, 3)
    r = S.holdout_eval(panel_of(x.tolist(), y).repartition(4)).first()
    h = 10
    beta, se, r2 = sandwich(x[:-h], y[:-h])
    pred = beta[0] + beta[1] * x[-h:]
    assert (r.n_train, r.n_holdout, str(r.holdout_last_date)) == (40, 10, "2024-02-19")
    assert (r.coef, r.std_err, r.r2_train) == tuple(map(pytest.approx, (beta[1], se, r2)))
    assert r.rmse_holdout == pytest.approx(np.sqrt(((pred - y[-h:]) ** 2).mean()))
    assert r.corr_pred_actual == pytest.approx(np.corrcoef(pred, y[-h:])[0, 1])


@pytest.mark.parametrize("n, sizes", [(32, None), (33, (25, 8)), (34, (26, 8)), (41, (32, 9))])
def test_holdout_sizes(panel_of, n, sizes):
    x, y = series(n, n)
    rows = S.holdout_eval(panel_of(x.tolist(), y)).collect()
    assert [(r.n_train, r.n_holdout) for r in rows] == ([sizes] if sizes else [])


def test_holdout_without_test_variation(panel_of):
    x, y = series(40, 5)
    r = S.holdout_eval(panel_of(x[:32].tolist() + [0.5] * 8, y)).first()
    assert r.corr_pred_actual is None and r.rmse_holdout > 0


@pytest.mark.parametrize("n, known", [(2, False), (3, True)])
def test_pearson_needs_three(panel_of, n, known):
    x, y = series(n)
    r = S.correlations(panel_of(x.tolist(), y)).first()
    assert (r.r_a is not None) == known and r.r_b is None
    if known:
        assert r.r_a == pytest.approx(np.corrcoef(x, y)[0, 1])


def test_pearson_constant_side_is_null(panel_of):
    assert S.correlations(panel_of([0.1] * 20, range(20))).first().r_a is None
    assert S.correlations(panel_of(list(map(float, range(20))), [0.1] * 20)).first().r_a is None


def test_paths_match_pandas(panel_of):
    x, y = series(45, 7)
    z = [None if i % 3 == 0 else float(v) for i, v in enumerate(series(45, 8)[0])]
    frame = S.stability_frame(panel_of(x.tolist(), y, z).repartition(3)).orderBy("date").toPandas()
    px, py, pz = pd.Series(x), pd.Series(y), pd.Series(z, dtype=float)
    want = {
        "expanding_a": px.expanding(15).corr(py),
        "rolling_a": px.rolling(20, min_periods=15).corr(py),
        "expanding_b": pz.expanding(15).corr(py).where(pz.notna()),
        "rolling_b": pz.rolling(20, min_periods=15).corr(py).where(pz.notna()),
    }
    for name, series_ in want.items():
        np.testing.assert_allclose(frame[name].astype(float), series_, atol=1e-9, err_msg=name)
    assert frame["expanding_a"].notna().sum() == 31
    last = S.correlations(panel_of(x.tolist(), y)).first().r_a
    assert frame["expanding_a"].iloc[-1] == pytest.approx(last)


def test_single_paths_drop_missing_rows_first(panel_of):
    x, y = series(40, 9)
    gaps = [None if i % 4 == 0 else float(v) for i, v in enumerate(x)]
    rolled = S.rolling_corr(panel_of(gaps, y)).orderBy("date").toPandas()
    px = pd.Series(gaps, dtype=float)
    keep = px.notna()
    want = px[keep].reset_index(drop=True).rolling(20, min_periods=15).corr(pd.Series(y)[keep].reset_index(drop=True))
    np.testing.assert_allclose(rolled["rolling_r"].astype(float), want, atol=1e-9)
    assert S.expanding_corr(panel_of(gaps, y)).count() == keep.sum()


def test_constant_window_gives_null_not_error(panel_of):
    r = S.stability_frame(panel_of([0.2] * 30, range(30))).collect()
    assert all(x.expanding_a is None and x.rolling_a is None for x in r)


def test_splits_and_halves_need_an_entity(panel_of):
    rows = panel_of([0.1], [1])
    with pytest.raises(ValueError):
        S.time_split(rows, by=[])
    with pytest.raises(ValueError):
        S.early_late_gap(rows.withColumns({"avg_a": rows.ret, "avg_b": rows.ret}), by=[])


def _summary_panel(spark, a, b):
    from datetime import date, timedelta

    rows = [(date(2024, 1, 1) + timedelta(days=i), "T", 0.0, x, z) for i, (x, z) in enumerate(zip(a, b))]
    return spark.createDataFrame(rows, "date date, ticker string, ret double, avg_a double, avg_b double")


@pytest.mark.parametrize(
    "gaps, change",
    [([0.1] * 3 + [0.3] * 3 + [0.2] * 3, "widened"), ([0.2] * 6 + [0.1] * 3, "narrowed"), ([0.1] * 9, "neither")],
)
def test_gap_change(spark, gaps, change):
    panel = _summary_panel(spark, gaps, [0.0] * 9)
    assert S.early_late_gap(panel).first().gap_change == change
    assert S.early_late_gap(panel.limit(8)).isEmpty()


def test_events(spark):
    panel = _summary_panel(spark, [0.5, 0.3, 0.32, 0.12, 0.4], [0.5, 0.3, 0.0, 0.1, 0.0])
    assert str(S.biggest_drop(panel).first().date) == "2024-01-02"
    assert str(S.biggest_gap(panel).first().date) == "2024-01-05"
    calm = _summary_panel(spark, [0.5, 0.48, 0.49], [0.5, 0.48, 0.5])
    assert S.biggest_drop(calm).isEmpty() and S.biggest_gap(calm).isEmpty()


def test_trend_line(panel_of):
    x = [0.0, 1.0, 3.0]
    rows = S.trend_line(panel_of(x, [1.0, 3.0, 7.0]), points=4).orderBy("point").collect()
    assert [(r.x, r.y) for r in rows] == [pytest.approx((v, 1 + 2 * v)) for v in (0, 1, 2, 3)]
    assert S.trend_line(panel_of([0.0, 1.0], [1.0, 2.0])).isEmpty()
