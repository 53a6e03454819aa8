from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodtide.functions import text
from moodtide.operators import reviews as R

D = [date(2024, 1, i) for i in range(1, 20)]
SCORED = "review_id long, date date, ticker string, review_text string, score_a double, score_b double"


@pytest.fixture
def scored(spark):
    rows = [
        (1, D[0], "T", "Great App", 0.9, -0.1),
        (2, D[1], "T", "great   app", 0.9, -0.1),
        (3, D[2], "T", "ｇｒｅａｔ app​", 0.9, -0.1),  # full width, no-break, zero width
        (4, D[3], "U", "slow", 0.1, -0.5),
        (5, D[4], "U", "   ", 1.0, -1.0),
        (6, D[5], "U", "unscored", 0.1, None),
        (7, D[6], "U", "x" * 600, 0.0, 0.2),
    ]
    return spark.createDataFrame(rows, SCORED)


@pytest.mark.parametrize("parts", [1, 5])
def test_queue_has_distinct_texts(scored, parts):
    q = R.disagreement_queue(scored.repartition(parts), 10).collect()
    assert [r.review_id for r in q] == [1, 4, 7]
    assert len(q[2].text) == 600 and q[0].disagreement == pytest.approx(1.0)
    assert [r.review_id for r in R.disagreement_queue(scored, 2).collect()] == [1, 4]


def test_queue_is_empty_without_second_scorer(scored):
    off = scored.withColumn("score_b", F.lit(None).cast("double"))
    assert R.disagreement_queue(off).isEmpty() and R.top_disagreement(off, 5).isEmpty()


def test_queue_with_repeated_ids(scored):
    assert [r.review_id for r in R.disagreement_queue(scored.union(scored), 10).collect()] == [1, 4, 7]


def test_texts_that_differ_after_many_characters_are_two(spark):
    rows = [(1, D[0], "T", "x" * 600 + "a", 0.9, 0.0), (2, D[0], "T", "x" * 600 + "b", 0.8, 0.0)]
    df = spark.createDataFrame(rows, SCORED)
    assert [r.review_id for r in R.disagreement_queue(df, 5).collect()] == [1, 2]
    assert R.dedupe_queue(df.withColumnRenamed("review_text", "text").withColumn("disagreement", F.lit(1.0))).count() == 2


def test_an_id_that_repeats_across_entities_keeps_its_own_text(spark):
    rows = [(1, D[0], "A", "alpha", 0.1, 0.0), (1, D[0], "B", "beta", 0.9, 0.0), (2, D[1], "B", "copy", 0.5, 0.0), (2, D[1], "B", "copy", 0.5, 0.0)]
    df = spark.createDataFrame(rows, SCORED)
    table = R.score_table(df)
    assert [r.text for r in R.disagreement_queue(table, 1, texts=df).collect()] == ["beta"]
    direct = R.top_disagreement(df, 3).select("review_id", "ticker", "review_text", "disagreement")
    joined = R.top_disagreement(table, 3, texts=df).select("review_id", "ticker", "review_text", "disagreement")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, direct.collect()))


def test_dedupe_and_top(scored):
    top = R.top_disagreement(scored, 4)
    assert [r.review_id for r in top.collect()] == [5, 1, 2, 3]
    queue = top.withColumnRenamed("review_text", "text")
    assert [r.review_id for r in R.dedupe_queue(queue).collect()] == [1]


def test_text_key_steps(spark):
    df = spark.createDataFrame([("  A B\t c ",), ("Ⅷ ﬁne",), ("",)], "t string")
    assert [r[0] for r in df.select(text.text_key(F.col("t"))).collect()] == ["a b c", "viii fine", ""]


def test_day_excerpts_fall_back_one_day(spark):
    rows = [(i, D[2], "T", f"day before {i}", 0.0, 0.0) for i in range(4)]
    rows += [(9, D[5], "T", "y" * 300, 0.0, 0.0), (10, D[4], "T", "not used", 0.0, 0.0), (11, D[3], "U", "other", 0.0, 0.0)]
    reviews = spark.createDataFrame(rows, SCORED)
    targets = spark.createDataFrame([(D[3], "T"), (D[5], "T"), (D[9], "T")], "date date, ticker string")
    out = R.day_excerpts(reviews, targets).orderBy("target_date", "rank").collect()
    assert [(r.target_date, r.review_id) for r in out] == [(D[3], 0), (D[3], 1), (D[3], 2), (D[5], 9)]
    assert out[-1].excerpt == "y" * 240 + "…"
    pooled = R.day_excerpts(reviews, targets.where("date = '2024-01-04'"), by=[]).collect()
    assert [r.review_id for r in pooled] == [11]


@pytest.mark.parametrize("whole_below", [100_000, 100])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_quantiles(spark, whole_below, by):
    rng = np.random.default_rng(1)
    # A third of all rows share one value.
    v = np.where(rng.random(20_000) < 0.33, 0.25, rng.normal(size=20_000))
    g = np.where(rng.random(20_000) < 0.6, "a", "b")
    df = spark.createDataFrame(list(zip(g.tolist(), v.tolist())), "g string, v double").repartition(5)
    ps = [0.0, 0.1, 0.5, 0.6, 0.9, 1.0]
    got = R.exact_quantiles(df, "v", ps, by=by, accuracy=1000, whole_below=whole_below).collect()
    assert len(got) == len(ps) * (2 if by else 1)
    for r in got:
        rows = v[g == r.g] if by else v
        assert r.value == pytest.approx(np.quantile(rows, r.p), abs=1e-12), r


def test_tails_include_ties(spark):
    rets = [-0.5, -0.5, -0.5, 0.0, 0.01, 0.02, 0.03, 0.4, 0.4, 0.4, 0.4]
    reg = spark.createDataFrame([(D[i], "T", r) for i, r in enumerate(rets)], "date date, ticker string, ret double")
    days = {r.date for r in R.tail_days(reg).collect()}
    assert days == {D[0], D[1], D[2], D[7], D[8], D[9], D[10]}


def test_sample_is_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "review_id")
    one = {r.review_id for r in R.fixed_sample(df, 400).collect()}
    two = {r.review_id for r in R.fixed_sample(df.repartition(7), 400).collect()}
    assert one == two and len(one) == 400
    assert R.fixed_sample(df.limit(10), 400).count() == 10


def test_corpus_prefers_the_disagreement_row(spark):
    rows = [(1, D[0], "T", "same text", 0.9, 0.0), (2, D[0], "T", "same text", 0.8, 0.0), (3, D[1], "T", "calm", 0.1, 0.1)]
    reviews = spark.createDataFrame(rows, SCORED)
    reg = spark.createDataFrame([(D[0], "T", -0.3), (D[1], "T", 0.2), (D[2], "T", 0.0)], "date date, ticker string, ret double")
    got = {r.review_id: r.slice for r in R.flagged_corpus(reviews, reg, top_n=1).collect()}
    assert got == {1: "disagreement", 3: "tail"}
    p = R.corpus_provenance(R.corpus_slices(reviews, reg, top_n=1)).first()
    assert (p.n_disagreement, p.n_tail, p.kept_disagreement, p.kept_tail) == (1, 3, 1, 1)
    assert p.source == "top 1 by score gap plus reviews on 10% / 90% return tails"
    off = reviews.withColumn("score_b", F.lit(None).cast("double"))
    assert "second scorer off" in R.corpus_provenance(R.corpus_slices(off, reg)).first().source
