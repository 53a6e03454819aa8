import json
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodtide.operators import scoring as N
from moodtide.plans import report
from moodtide.sources import files


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(4)
    words = ["good", "bad", "slow", "support", "price", "crash", "menu", "fine", "update", "lesson"]
    reviews, market = [], []
    for t in ("AAA", "BBB"):
        for i in range(45):
            day = date(2024, 1, 1) + timedelta(days=i)
            market.append((str(day), t, str(float(rng.normal() / 50))))
            for j in range(3):
                text = " ".join(rng.choice(words, 8))
                reviews.append((f"{day} 1{j}:00:00", int(rng.integers(1, 6)), text, t))
    return (
        spark.createDataFrame(reviews, "posted string, stars int, body string, symbol string"),
        spark.createDataFrame(market, "Date string, Ticker string, Ret string"),
    )


@pytest.fixture(scope="module")
def result(spark, raw):
    lexicon = spark.createDataFrame([("good", "polarity", 0.8), ("bad", "polarity", -0.8)], "word string, kind string, weight double")
    options = report.Options(company="Acme", review_date_col="posted", review_text_col="body", review_ticker_col="symbol")
    out = report.run(*raw, N.lexicon_scorer(lexicon), N.column_scorer(F.col("stars") / 2.5 - 1.2), options)
    yield out
    out.release()


def test_run_tables(result):
    assert result.panel.count() == 90 and result.reg.count() == 88
    assert result.volume.first().n_reviews == 270
    assert result.overlap.first().overlap_dates == 45
    assert {r.ticker for r in result.ols_a.collect()} == {"AAA", "BBB"}
    assert {r.n_train for r in result.holdout_b.collect()} == {35}
    assert result.queue.count() == 10
    facts = {r.ticker: r for r in result.facts.collect()}
    assert facts["AAA"].n_days == 45 and facts["AAA"].regime != "unavailable"
    gap = result.scored.agg(F.avg(F.abs(F.col("score_a") - F.col("score_b")))).first()[0]
    assert result.disagreement_mean.first()[0] == pytest.approx(gap)


def test_run_text_steps(result):
    assert result.bigrams().count() == 15
    assert {r.theme for r in result.themes().collect()} >= {"support"}
    with pytest.warns(UserWarning, match="did not settle in 5 sweeps"):
        assert result.topics(max_iter=5).count() == 5
    bundle = result.mining(with_topics=False).first()
    assert bundle.n_docs == result.corpus.count() and len(bundle.bigrams) == 15 and bundle.source.startswith("top ")
    assert result.biggest_drop.count() <= 2 and result.early_late_rolling.count() <= 2
    assert result.worst_day_excerpts().count() == 3 and result.best_day_excerpts().count() == 4


def test_snapshots(spark, result, tmp_path):
    rows = result.entity_snapshots().collect()
    for r in rows:
        payload = json.loads(r.snapshot)
        assert list(payload) == sorted(payload) and payload["ticker"] == r.ticker
        assert payload["regression"]["n"] == 44 and len(r.fingerprint) == 32
    again = {r.ticker: r.fingerprint for r in result.entity_snapshots().collect()}
    assert again == {r.ticker: r.fingerprint for r in rows}
    whole = json.loads(report.run_snapshot(result).first().snapshot)
    assert whole["company"] == "Acme" and whole["first_entity"] == "AAA"
    assert len(whole["queue"]) == 10 and len(whole["bigrams"]) == 15
    assert whole["regression_a"]["n"] == 44 and whole["overlap"]["overlap_rows"] == 90
    files.write_json(result.entity_snapshots(), str(tmp_path / "snap"))
    assert spark.read.json(str(tmp_path / "snap")).count() == 2


def test_run_without_overlap_raises(spark, raw):
    reviews, market = raw
    lexicon = spark.createDataFrame([("good", "polarity", 0.8)], "word string, kind string, weight double")
    options = report.Options(review_date_col="posted", review_text_col="body", review_ticker_col="symbol")
    with pytest.raises(ValueError, match="no common date"):
        report.run(reviews, market.withColumn("Ticker", F.lit("ZZZ")), N.lexicon_scorer(lexicon), None, options)
