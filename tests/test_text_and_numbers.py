from datetime import date

import pytest
from pyspark.sql import functions as F

from moodtide.functions import dates, numeric, text


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "raw, plain",
    [
        ("“It’s” – β² ×3…", '"It\'s" - beta2 x3...'),
        ("naïve\tok", "na ve ok"),
        ("日本", " "),
        ("", " "),
        ("a" * 401, "a" * 401),
        ("keep\nbreaks ", "keep\nbreaks"),
    ],
)
def test_latin_safe(spark, raw, plain):
    assert one(spark, raw, text.latin_safe) == plain


def test_strip_markdown(spark):
    assert one(spark, "## Head\ntext **bold** # no\n#also", text.strip_markdown) == "Head\ntext bold # no\nalso"


@pytest.mark.parametrize("v, shown", [(0.25, "0.2500"), (1234.56789, "1234.5679"), (-0.5, "-0.5000"), (float("nan"), "n/a"), (float("inf"), "n/a"), (None, "n/a")])
def test_fixed(spark, v, shown):
    assert one(spark, v, numeric.fixed, "double") == shown


def test_percent(spark):
    assert one(spark, 0.012, numeric.percent, "double") == "1.200%"
    assert one(spark, None, numeric.percent, "double") == "n/a"


@pytest.mark.parametrize(
    "a, b, shown",
    [
        (date(2024, 6, 3), date(2024, 10, 4), "Jun 3, 2024 to Oct 4, 2024"),
        (date(2024, 6, 3), date(2024, 6, 3), "Jun 3, 2024"),
        (None, date(2024, 6, 3), "—"),
    ],
)
def test_day_span(spark, a, b, shown):
    df = spark.createDataFrame([(a, b)], "a date, b date")
    assert df.select(dates.day_span(F.col("a"), F.col("b"))).first()[0] == shown


def test_normal_p_equals_erfc_of_the_math_library(spark):
    import math

    zs = [0.0, 1e-9, 0.5, 1.0, 1.1932, 1.1933, 1.5, 1.7677, 1.7678, 1.96, -2.5, 4.04, 4.0407, 8.0, 20.0, 37.0, 39.5, 45.0, math.inf]
    df = spark.createDataFrame([(z,) for z in [*zs, math.nan, None]], "z double")
    got = [r[0] for r in df.select(numeric.two_sided_normal_p(F.col("z"))).collect()]
    assert got[len(zs) :] == [None, None]
    for z, p in zip(zs, got):
        assert math.isclose(p, math.erfc(abs(z) / math.sqrt(2)), rel_tol=1e-12, abs_tol=1e-320)


def test_keys_of_a_batch_of_texts_are_made_piece_by_piece(spark):
    import pyarrow as pa

    texts = [None if i % 7 == 0 else f"ﬁne Ⅷ {i} e\u0301" for i in range(1000)]
    pieces = list(text._nfkc(iter([pa.array(texts, pa.string()), pa.array([], pa.string())])))
    assert max(map(len, pieces)) < 200
    want = [None if t is None else t.replace("ﬁ", "fi").replace("Ⅷ", "VIII").replace("e\u0301", "é") for t in texts]
    assert [v for p in pieces for v in p.to_pylist()] == want
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    keys = df.select("i", text.text_key(F.col("t")).alias("k")).orderBy("i").collect()
    assert [r.k for r in keys] == [None if w is None else w.lower() for w in want]
