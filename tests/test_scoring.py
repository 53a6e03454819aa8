import pytest
from pyspark.sql import functions as F

from moodtide.operators import score_store
from moodtide.operators import scoring as N

LEXICON = [
    ("good", "polarity", 0.5), ("bad", "polarity", -0.7), ("superb", "polarity", 0.9),
    ("not", "negation", None), ("very", "intensifier", 1.3),
]
CASES = [
    ("good", 0.5),
    ("GOOD, bad!", (0.5 - 0.7) / 2),
    ("not good", -0.25),
    ("not x good", -0.25),  # one-letter words are no tokens
    ("not so good", 0.5),
    ("very superb", 1.0),  # clipped
    ("very not good", -0.25),
    ("nothing here", 0.0),
    ("", 0.0),
    ("gut good2 good", 0.5),  # good2 is one run with a digit
]


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "review_id long, review_text string")


@pytest.fixture
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "word string, kind string, weight double")


def test_lexicon_rule(reviews, lexicon):
    scored = N.score_reviews(reviews, N.lexicon_scorer(lexicon))
    got = {r.review_id: r.score_a for r in scored.collect()}
    assert got == {i: pytest.approx(v) for i, (_, v) in enumerate(CASES)}
    assert scored.columns == ["review_id", "review_text", "score_a", "score_b"]


def test_word_of_two_kinds(spark):
    lex = spark.createDataFrame(
        [("pretty", "polarity", 0.3), ("pretty", "intensifier", 2.0), ("good", "polarity", 0.4)],
        "word string, kind string, weight double",
    )
    df = spark.createDataFrame([(1, "pretty good"), (2, "pretty plain good")], "review_id long, review_text string")
    out = N.score_reviews(df, N.lexicon_scorer(lex))
    got = {r.review_id: r.score_a for r in out.collect()}
    assert got == {1: pytest.approx((0.3 + 0.8) / 2), 2: pytest.approx((0.3 + 0.4) / 2)}


def test_lexicon_is_normalised_once(spark):
    schema = "word string, kind string, weight double"
    rows = [("good", "polarity", 0.1), ("good", "polarity", 0.5), ("odd", "polarity", None), ("very", "intensifier", None),
            ("not", "negation", None), (None, "polarity", 1.0)]
    df = spark.createDataFrame([(1, "good"), (1, "odd"), (2, "very good"), (3, "not good"), (4, None)], "review_id long, review_text string")
    out = N.score_reviews(df, N.lexicon_scorer(spark.createDataFrame(rows, schema))).collect()
    assert sorted((r.review_id, r.score_a) for r in out if r.review_text) == [(1, 0.0), (1, 0.5), (2, 0.5), (3, -0.25)]
    with pytest.raises(ValueError, match="unknown kinds"):
        N.lexicon_scorer(spark.createDataFrame([("x", "loud", 1.0)], schema))
    many = [(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "polarity", i / 4000 - 0.5) for i in range(4000)]
    text = spark.createDataFrame([(1, f"{many[7][0]} {many[3999][0]} zzz")], "review_id long, review_text string")
    got = N.score_reviews(text, N.lexicon_scorer(spark.createDataFrame(many, schema))).first().score_a
    assert got == pytest.approx((many[7][2] + many[3999][2]) / 2)


def test_second_scorer_absent_is_null(reviews, lexicon):
    out = N.score_reviews(reviews, N.lexicon_scorer(lexicon))
    assert dict(out.dtypes)["score_b"] == "double"
    assert out.where("score_b is not null").isEmpty()


def test_expected_score(spark):
    df = spark.createDataFrame([([0.7, 0.2, 0.1],), ([2.0, 0.0, 0.0],)], "p array<double>")
    labels = F.array(F.lit("LABEL_NEG"), F.lit("neutral"), F.lit("Positive"))
    got = [r[0] for r in df.select(N.expected_score(F.col("p"), labels)).collect()]
    assert got == [pytest.approx(-0.6), -1.0]


def test_model_hook_batches_and_raises(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(40)], "review_id long, review_text string").coalesce(1)

    def factory():
        def model(texts):
            assert len(texts) <= 16
            return [len(t) / 20 for t in texts]

        return model

    got = N.model_scorer(factory)(df, "s").orderBy("review_id").collect()
    assert [r.s for r in got] == [pytest.approx(min(1.0, i / 20)) for i in range(40)]

    holes = spark.createDataFrame([(1, None), (2, "x" * 4)], "review_id long, review_text string")
    assert [r.s for r in N.model_scorer(factory)(holes, "s").orderBy("review_id").collect()] == [None, pytest.approx(0.2)]

    def broken():
        raise RuntimeError("no weights here")

    with pytest.raises(Exception, match="no weights here"):
        N.model_scorer(broken)(df, "s").collect()


def test_store_of_scores_calls_the_model_for_new_texts_only(spark, tmp_path):
    path = str(tmp_path / "scores")
    seen = tmp_path / "seen"
    seen.mkdir()

    def factory():
        import uuid

        def model(texts):
            (seen / uuid.uuid4().hex).write_text("\n".join(texts))
            return [float("nan") if t == "odd" else len(t) / 20 for t in texts]

        return model

    def called():
        texts = sorted(t for f in seen.iterdir() for t in f.read_text().split("\n"))
        for f in seen.iterdir():
            f.write_text("")
        return [t for t in texts if t]

    def table(texts):
        return spark.createDataFrame(list(enumerate(texts)), "review_id long, review_text string")

    model = N.model_scorer(factory)
    first = ["a", "bb", "a", None, "odd"] + ["bb"] * 50
    got = N.score_reviews(table(first), N.column_scorer(F.lit(0.0)), score_store.filling_scorer(model, path, "1"))
    want = {"a": 0.05, "bb": 0.1, "ccc": 0.15, "": 0.0}
    assert [r.score_b for r in got.orderBy("review_id").collect()] == [want.get(t) for t in first]
    assert called() == ["a", "bb", "odd"]

    grown = first + ["ccc", "a", "", "ccc"]
    got = score_store.filling_scorer(model, path, "2")(table(grown), "s").orderBy("review_id").collect()
    assert [r.s for r in got] == [want.get(t) for t in grown]
    assert called() == ["ccc"]
    runs = {(r.run, r["count"]) for r in score_store.stored(spark, path).groupBy("run").count().collect()}
    assert runs == {("1", 3), ("2", 2)}

    # a run that overlapped with another adds rows twice; a text keeps one
    spark.read.parquet(path).withColumn("run", F.lit("3")).write.mode("append").parquet(path)
    assert score_store.stored_scorer(path)(table(grown), "s").count() == len(grown)
    assert score_store.stored(spark, path).count() == 5

    def broken():
        raise RuntimeError("no weights here")

    with pytest.raises(Exception, match="no weights here"):
        score_store.fill(table(["new"]), N.model_scorer(broken), path, "4")
    assert score_store.stored(spark, path).count() == 5
    empty = score_store.stored_scorer(str(tmp_path / "none"))(table(["a"]), "s")
    assert [r.s for r in empty.collect()] == [None]
