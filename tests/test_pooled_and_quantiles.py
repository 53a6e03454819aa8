"""Pooled series over chunks, quantiles by repeated bracketing, counts of distinct values."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodtide.operators import mining as M
from moodtide.operators import reviews as R
from moodtide.operators import stats as S
from moodtide.sources import detect as D


def brute_r(pairs, min_rows):
    pairs = [(x, y) for x, y in pairs if x is not None and y is not None]
    if len(pairs) < min_rows:
        return None
    x, y = np.array(pairs).T
    return None if x.std(ddof=1) < 1e-9 or y.std(ddof=1) < 1e-9 else float(np.corrcoef(x, y)[0, 1])


@pytest.fixture(scope="module")
def pool():
    rng = random.Random(2)
    rows = []
    for n in range(700):
        day = date(2024, 1, 1) + timedelta(days=n % 7 if n % 3 else n // 20)  # a few days hold most rows
        a = None if rng.random() < 0.05 else rng.choice([0.5, rng.gauss(1e3, 1)])
        b = None if rng.random() < 0.3 else rng.gauss(0, 1)
        rows.append((day, f"T{n}", None if rng.random() < 0.05 else rng.gauss(0, 0.01), a, b))
    return rows


SCHEMA = "date date, ticker string, ret double, avg_a_lag1 double, avg_b_lag1 double"


@pytest.mark.parametrize("chunk", [30, 4096])
def test_pooled_paths_equal_one_ordered_series(spark, pool, chunk):
    reg = spark.createDataFrame(pool, SCHEMA).repartition(4)
    base = sorted((r for r in pool if r[2] is not None and r[3] is not None), key=lambda r: (r[0], r[2], r[1]))
    kinds = {f"{k}_{s}": (f"avg_{s}_lag1", k) for s in "ab" for k in ("expanding", "rolling")}
    rows = reg.where("avg_a_lag1 IS NOT NULL AND ret IS NOT NULL")
    got = {r.ticker: r for r in S._pooled_paths(rows, kinds, "ret", 12, 9, chunk).collect()}
    assert len(got) == len(base)
    for i, row in enumerate(base):
        for s, col in (("a", 3), ("b", 4)):
            for kind, first in (("expanding", 0), ("rolling", max(0, i - 11))):
                want = brute_r([(r[col], r[2]) for r in base[first : i + 1]], 9)
                mine = got[row[1]][f"{kind}_{s}"]
                assert (mine is None) == (want is None) and (want is None or abs(mine - want) < 1e-9)


def test_pooled_frames_and_paths_agree(spark, pool):
    reg = spark.createDataFrame(pool, SCHEMA)
    frame = S.stability_frame(reg, by=[]).orderBy("date", "ret", "ticker").collect()
    assert frame[0].__fields__ == ["date", "ticker", "ret", "avg_a_lag1", "expanding_a", "rolling_a", "expanding_b", "rolling_b"]
    path = [r.expanding_r for r in S.expanding_corr(reg, by=[]).collect()]
    assert len(path) == len(frame) and max(r.rolling_a or -1 for r in frame) <= 1
    whole = brute_r([(r[3], r[2]) for r in pool], 15)
    assert abs(frame[-1].expanding_a - whole) < 1e-9
    assert S.rolling_corr(reg.limit(0), by=[]).count() == 0 and S.stability_frame(reg.limit(0), by=[]).count() == 0
    one = spark.createDataFrame([(date(2024, 1, 1), "T", 0.1, 7.0, None)] * 40, SCHEMA)
    assert {r.expanding_r for r in S.expanding_corr(one, by=[]).collect()} == {None}


def column(kind, n):
    rng = np.random.default_rng(5)
    return {
        "skewed": np.exp(rng.normal(0, 4, n)),
        "ties": np.where(rng.random(n) < 0.6, 3.0, rng.integers(0, 40, n) / 8),
        "constant": np.full(n, 2.5),
        "even": rng.permutation(n) / 4.0,
    }[kind]


@pytest.mark.parametrize("kind", ["skewed", "ties", "constant", "even"])
def test_quantiles_by_repeated_bracketing(spark, kind):
    n, probabilities = 30_000, [0.0, 0.1, 0.37, 0.5, 0.9, 1.0]
    values = {"x": column(kind, n), "y": -column("skewed", 301), "z": np.array([4.0])}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("x", None), ("w", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = R.exact_quantiles(df, "v", probabilities, by=["g"], accuracy=400, whole_below=500).collect()
    assert {(r.g, r.q): r.value for r in got} == {
        (g, q): pytest.approx(np.quantile(vs, p), rel=1e-12) for g, vs in values.items() for q, p in enumerate(probabilities)
    }
    assert all(r.n == len(values[r.g]) for r in got)
    pooled = R.exact_quantiles(df, "v", probabilities, accuracy=400, whole_below=500).collect()
    every = np.concatenate(list(values.values()))
    assert {r.q: r.value for r in pooled} == {q: pytest.approx(np.quantile(every, p), rel=1e-12) for q, p in enumerate(probabilities)}


def test_one_task_ranks_a_small_part_of_a_bracket(spark):
    df = spark.createDataFrame([(float(v),) for v in column("skewed", 60_000)], "v double")
    _, counts = R._counted_parts(df, "v", [0.5], [], 100, 500)
    inside = counts.where("part BETWEEN 0 AND 255").groupBy("part").count().collect()
    assert sum(r["count"] for r in inside) > 3000 and max(r["count"] for r in inside) < 120


def test_distinct_values_are_exact_where_they_decide(spark):
    df = spark.range(40_000).select((F.col("id") % 50).cast("string").alias("few"), (F.col("id") % 51).alias("more"), F.lit(None).cast("string").alias("none"), F.col("id").alias("id"))
    got = df.agg(*[D._distinct_values(F.col(c).cast("string")).alias(c) for c in df.columns]).first()
    assert (got.few, got.more, got.none or 0) == (50, 51, 0) and abs(got.id / 40_000 - 1) < 0.2


def test_texts_of_one_id_have_norms_of_their_own(spark):
    texts = [(1, "alpha beta beta"), (1, "gamma delta"), (2, "alpha gamma"), (3, "delta"), (3, "delta"), (4, None), (4, "")]
    df = spark.createDataFrame(texts, "review_id long, review_text string")
    weights = M.term_weights(df, max_df=1.0).collect()
    squares = {}
    for r in weights:
        squares[r.review_id] = squares.get(r.review_id, 0) + r.weight**2
    assert squares == {1: pytest.approx(2), 2: pytest.approx(1), 3: pytest.approx(2)}
    assert sorted((r.term, r.tf) for r in weights if r.review_id == 1) == [("alpha", 1), ("beta", 2), ("delta", 1), ("gamma", 1)]
