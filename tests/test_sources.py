from datetime import date

import pytest
from pyspark.sql import functions as F

from moodtide.functions.dates import parse_day
from moodtide.sources import detect, files, prepare


def test_csv_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    texts = ['says "hi", twice', "two\nlines", "  padded  ", "plain"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, review_text string")
    files.write_csv(df, str(tmp_path / "x"))
    back = files.read_csv(spark, str(tmp_path / "x"))
    assert {r.id: r.review_text for r in back.collect()} == {str(i): t for i, t in enumerate(texts)}


def test_na_words_become_null_unless_switched_off(spark, tmp_path):
    (tmp_path / "m.csv").write_text("ticker,ret\nNA,0.1\nAAA,n/a\nBBB,NaN\n")
    path = str(tmp_path / "m.csv")
    assert [r.ticker for r in files.read_csv(spark, path).collect()] == [None, "AAA", "BBB"]
    assert [r.ret for r in files.read_csv(spark, path).collect()] == ["0.1", None, None]
    assert files.read_csv(spark, path, na_values=()).first().ticker == "NA"


def test_demo_pair(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_demo(spark, str(tmp_path))
    (tmp_path / files.REVIEWS_FILE).write_text("date,review_text,ticker\n2024-01-02,fine,T\n")
    (tmp_path / files.MARKET_FILE).write_text("date,ticker,ret\n2024-01-02,T,0.01\n")
    reviews, market = files.load_demo(spark, str(tmp_path))
    assert reviews.count() == market.count() == 1


@pytest.mark.parametrize(
    "written, day",
    [
        ("2024-01-02 10:00:00", date(2024, 1, 2)),
        ("2024-01-02T10:00:00.5", date(2024, 1, 2)),
        ("01/02/2024", date(2024, 1, 2)),
        ("13/02/2024", date(2024, 2, 13)),
        ("1/2/2024 9:05 PM", date(2024, 1, 2)),
        ("Jan 2, 2024", date(2024, 1, 2)),
        ("2 January 2024", date(2024, 1, 2)),
        ("20240102", date(2024, 1, 2)),
        ("5", None),
        ("12:30", None),
        ("2024-02-30", None),
        ("soon", None),
        (None, None),
    ],
)
def test_parse_day(spark, written, day):
    df = spark.createDataFrame([(written,)], "s string")
    assert df.select(parse_day(F.col("s"))).first()[0] == day


def test_infer_messy_headers(spark):
    rows = [
        (f"2024-01-{i + 1:02d}", i % 5 + 1, "a longer body of text, number %d, for the reader" % i, "ACME")
        for i in range(10)
    ]
    df = spark.createDataFrame(rows, "`When Posted` string, Stars int, Body string, Symbol string")
    guess = detect.infer_review_columns(df)
    assert (guess.date_col, guess.text_col, guess.ticker_col) == ("When Posted", "Body", "Symbol")
    assert not guess.uncertain
    scores = {r["name"]: r for r in detect.column_scores(df).collect()}
    assert scores["Stars"]["date_score"] == 0.0  # no number that preparation reads as a day
    assert scores["Stars"]["text_score"] == 0.0
    assert scores["Body"]["text_score"] == pytest.approx(3 + len(rows[0][2]) / 30)
    assert guess.confidence == pytest.approx(min(1, (3 + scores["Body"]["text_score"] + 7) / 18))
    assert detect.infer_review_columns(df, text_col="Symbol").text_col == "Symbol"


def test_infer_resolves_collisions(spark):
    # One string column is the best text and the best ticker.
    df = spark.createDataFrame([("2024-01-02", "aa", 1.0), ("2024-01-03", "bb", 2.0)], "date string, symbol string, n double")
    guess = detect.infer_review_columns(df)
    assert guess.date_col == "date" and len({guess.date_col, guess.text_col, guess.ticker_col}) == 3


def test_infer_market_returns_original_names(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "T", "0.01", "100"), ("2024-01-03", "T", "-0.02", "101")],
        "`Trade Date` string, SYM string, `Daily Return` string, Close string",
    )
    guess = detect.infer_market_columns(df)
    assert (guess.date_col, guess.ticker_col, guess.ret_col) == ("Trade Date", "SYM", "Daily Return")


def test_sparse_column_is_looked_up_past_its_nulls(spark):
    rows = [(i, None if i < 300 else "word " * 30) for i in range(310)]
    df = spark.createDataFrame(rows, "id int, body string").coalesce(1)
    scores = {r["name"]: r["text_score"] for r in detect.column_scores(df).collect()}
    assert scores["body"] == pytest.approx(7.0)


def test_whole_numbers_are_dates_only_where_preparation_reads_them(spark):
    df = spark.createDataFrame([(i, 20240101 + i, f"text number {i} " * 4, "ABC") for i in range(9)], "no int, day int, body string, sym string")
    scores = {r["name"]: r["date_score"] for r in detect.column_scores(df).collect()}
    assert scores["no"] == 0 and scores["day"] == 3
    c = detect.infer_review_columns(df)
    assert (c.date_col, c.text_col, c.ticker_col) == ("day", "body", "sym")
    assert prepare.prepare_reviews(df, c.date_col, c.text_col, c.ticker_col).count() == 9


def test_headers_that_differ_in_case(spark):
    df = spark.createDataFrame([("2024-01-02", "x", "T", "one"), (None, "2024-01-03", "T", "two")], "posted string, Date string, sym string, body string")
    out = prepare.prepare_reviews(df, "posted", "body", "sym").collect()
    assert sorted((r.date.isoformat(), r.review_text) for r in out) == [("2024-01-02", "one"), ("2024-01-03", "two")]


def test_days_do_not_move_with_the_session_zone(spark):
    from moodtide.functions.dates import parse_day

    texts = ["2024-01-02T23:30:00Z", "2024-01-02 00:30:00+09:00", "2024-01-02T01:02:03.456-0800", "2024-01-02"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert {r[0].isoformat() for r in df.select(parse_day(F.col("t"))).collect()} == {"2024-01-02"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_merge_collisions(spark):
    df = spark.createDataFrame(
        [(1, "short", "a much longer text", "x", None), (2, None, "  ", None, "y"), (3, "left", "nan", None, None)],
        "id int, a string, b string, c string, d string",
    ).toDF("id", "review_text", "review_text", "src", "src")
    out = {r.id: (r.review_text, r.src) for r in prepare.merge_collisions(df).collect()}
    assert out == {1: ("a much longer text", "x"), 2: (None, "y"), 3: ("left", None)}


def test_prepare_reviews_renames_into_an_existing_column(spark):
    df = spark.createDataFrame(
        [("2024-01-02 09:00", "", "T", "the real text"), ("bad", "x", "T", "y"), ("2024-01-03", "nan", None, "z")],
        "posted string, review_text string, sym string, body string",
    )
    out = prepare.prepare_reviews(df, "posted", "body", "sym").collect()
    assert [(r.date, r.review_text, r.ticker) for r in out] == [(date(2024, 1, 2), "the real text", "T")]
    assert len(out[0].review_id) == 64


def test_prepare_market(spark):
    df = spark.createDataFrame(
        [("01/02/2024", "T", "0.5"), ("2024-01-03", "T", "n/a"), ("2024-01-04", None, "1"), ("2024-01-05", "T", "inf")],
        "` Date ` string, TICKER string, Ret string",
    )
    assert [(r.date, r.ret) for r in prepare.prepare_market(df).collect()] == [(date(2024, 1, 2), 0.5)]
    with pytest.raises(ValueError, match="lacks columns"):
        prepare.prepare_market(df, ret_col="gain")


CELLS = [
    "plain", "", "two\nlines", '"', '""', 'says "hi", twice', "\n", "\n\n,\n", ',"\n"', "a,b", "  padded  ", "x\r\ny",
    "long " + "word\n" * 40, "é\nü", '"\n"\n"', "1,\n\"2\",3",
]


@pytest.mark.parametrize("block", ["7b", "64b", "1000b", "128m"])
def test_split_csv_finds_every_record(spark, tmp_path, block):
    import csv
    import random
    from collections import Counter

    shuffled = random.Random(5)
    rows = {}
    for name, end in (("a", "\n"), ("b", "\r\n")):
        rows[name] = [(str(i), shuffled.choice(CELLS), shuffled.choice(CELLS)) for i in range(60)]
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator=end)
            out.writerow(["id", "first col", "x.y"])
            for i, row in enumerate(rows[name]):
                out.writerow(row)
                if i % 20 == 9:
                    f.write(end)
    settings = {"spark.sql.files.maxPartitionBytes": block, "spark.sql.files.openCostInBytes": "0"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for names in ("ab", "a", "b"):
            paths = [str(tmp_path / f"{n}.csv") for n in names]
            split = files.read_csv(spark, paths, split=True)
            assert split.columns == ["id", "first col", "x.y"]
            want = Counter(tuple(c or None for c in r) for n in names for r in rows[n])
            assert Counter(map(tuple, split.collect())) == want
            if names == "a":
                assert Counter(map(tuple, files.read_csv(spark, paths).collect())) == want
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_split_csv_refuses_what_it_cannot_split(spark, tmp_path):
    bare, unclosed, only = tmp_path / "bare.csv", tmp_path / "unclosed.csv", tmp_path / "only.csv"
    bare.write_text('id,t\n1,5" screen and 6" screen\n')
    unclosed.write_text('id,t\n1,"never\nclosed\n')
    only.write_text("id,t\n")
    with pytest.raises(Exception, match="unquoted field"):
        files.read_csv(spark, str(bare), split=True).collect()
    with pytest.raises(Exception, match="never closed"):
        files.read_csv(spark, str(unclosed), split=True).collect()
    assert files.read_csv(spark, str(only), split=True).collect() == []
