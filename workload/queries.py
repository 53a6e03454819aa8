"""One query per operator, each over whole given tables. Doubles are rounded to nine decimals."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.functions import dates, numeric, text
from moodtide.operators import mining as M
from moodtide.operators import panel as P
from moodtide.operators import reviews as R
from moodtide.operators import score_store
from moodtide.operators import scoring as N
from moodtide.operators import stats as S
from moodtide.operators.topics import nmf_topics
from moodtide.plans import report, verdicts
from moodtide.session import checkpoint_dir
from moodtide.sources import detect, files, prepare
from workload import fixtures as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        cols = [
            (F.round(F.col(c), 9) + 0.0).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
        return df.select(*cols)

    rounded.__name__ = fn.__name__
    QUERIES[fn.__name__] = rounded
    return fn


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# -- sources and sinks ------------------------------------------------------------------


@query
def reviews_csv(spark, d):
    """Reviews written as CSV, read back as text and prepared."""
    path = _scratch(spark, "reviews")
    files.write_csv(X.text_reviews(spark, d), path)
    back = prepare.prepare_reviews(files.read_reviews(spark, path))
    return back.select(
        F.col("review_id").cast("long").alias("review_id"),
        "date",
        "ticker",
        F.md5("review_text").alias("text_md5"),
    )


@query
def reviews_csv_split(spark, d):
    """The same by the reader that splits files at any line, within quotes or not."""
    path = _scratch(spark, "reviews")
    files.write_csv(X.text_reviews(spark, d), path)
    back = prepare.prepare_reviews(files.read_reviews(spark, path, split=True))
    return back.select(
        F.col("review_id").cast("long").alias("review_id"),
        "date",
        "ticker",
        F.md5("review_text").alias("text_md5"),
    )


@query
def market_csv(spark, d):
    path = _scratch(spark, "market")
    files.write_csv(X.text_market(spark, d), path)
    return prepare.prepare_market(files.read_market(spark, path))


@query
def demo_pair(spark, d):
    """The pair of files in one folder, loaded, prepared and joined by day and entity."""
    folder = _scratch(spark, "demo")
    files.write_csv(X.text_reviews(spark, d), f"{folder}/{files.REVIEWS_FILE}")
    files.write_csv(X.text_market(spark, d), f"{folder}/{files.MARKET_FILE}")
    reviews, market = files.load_demo(spark, folder)
    daily = prepare.prepare_reviews(reviews).groupBy("date", "ticker").agg(F.count(F.lit(1)).alias("n_reviews"))
    return daily.join(prepare.prepare_market(market), ["date", "ticker"])


@query
def queue_csv(spark, d):
    """Export of the disagreement queue, read back."""
    path = _scratch(spark, "queue")
    files.write_csv(R.disagreement_queue(X.text_scored(spark, d)), path)
    return files.read_csv(spark, path).select(
        F.col("review_id").cast("long").alias("review_id"),
        F.to_date("date").alias("date"),
        "ticker",
        F.col("disagreement").cast("double").alias("disagreement"),
    )


# -- column detection and preparation ---------------------------------------------------


def _export(spark, d):
    """Documents as a user's export: odd headers, dates as text."""
    return X.text_reviews(spark, d).select(
        F.col("review_id").alias("row no"),
        F.date_format("date", "MM/dd/yyyy").alias("When Posted"),
        F.col("review_text").alias("Body"),
        F.col("ticker").alias("Symbol"),
        F.length("review_text").alias("Size"),
    )


def _returns_export(spark, d):
    return X.table(spark, d, "events").select(
        F.col("event_id").alias("No"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Created At"),
        F.col("event_type").alias("Sym"),
        (F.col("value") / 1000).alias("Daily Return"),
    )


@query
def column_scores(spark, d):
    reviews = detect.column_scores(_export(spark, d)).withColumn("side", F.lit("reviews"))
    market = detect.column_scores(_returns_export(spark, d)).withColumn("side", F.lit("market"))
    return reviews.unionByName(market)


@query
def infer_scores(spark, d):
    """Columns picked for each role, with confidence and the low-confidence flag."""
    r = detect.infer_review_columns(_export(spark, d))
    m = detect.infer_market_columns(_returns_export(spark, d))
    rows = [
        ("reviews", r.date_col, r.text_col, r.ticker_col, None, r.confidence, r.uncertain),
        ("market", m.date_col, None, m.ticker_col, m.ret_col, m.confidence, m.uncertain),
    ]
    return spark.createDataFrame(
        rows,
        "side string, date_col string, text_col string, ticker_col string, ret_col string, "
        "confidence double, uncertain boolean",
    )


@query
def infer_and_prepare(spark, d):
    """The picked columns, put to use: every review of the export is kept."""
    raw = _export(spark, d)
    c = detect.infer_review_columns(raw)
    out = prepare.prepare_reviews(raw, c.date_col, c.text_col, c.ticker_col, id_col="row no")
    return out.select("review_id", "date", "ticker", F.md5("review_text").alias("text_md5"))


@query
def coalesce_columns(spark, d):
    """Two columns of the same name for text and for source, merged."""
    docs = X.table(spark, d, "documents")
    english = F.col("lang") == "en"
    twice = docs.select(
        "doc_id",
        F.when(english, F.col("text")).otherwise("nan").alias("a"),
        F.when(~english, F.col("text")).otherwise(" ").alias("b"),
        F.when(english, F.col("source")).alias("c"),
        F.col("lang").alias("e"),
    ).toDF("doc_id", "review_text", "review_text", "source", "source")
    merged = prepare.merge_collisions(twice)
    return merged.select("doc_id", F.md5("review_text").alias("text_md5"), "source")


def _mixed_date(day):
    """A date as text, written differently per language."""
    return (
        F.when(F.col("lang") == "en", F.date_format(day, "MM/dd/yyyy"))
        .when(F.col("lang") == "de", F.concat(F.date_format(day, "MMM d, yyyy"), F.lit(" 10:30")))
        .when(F.col("lang") == "fr", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 23:59:59")))
        .otherwise(F.lit("no date"))
    )


@query
def prep_reviews(spark, d):
    raw = X.text_reviews(spark, d, "lang").select(
        "review_id",
        _mixed_date(F.col("date")).alias("posted"),
        F.when(F.col("ticker") != "view", F.col("ticker")).alias("sym"),
        F.col("review_text").alias("body"),
        "lang",
    )
    out = prepare.prepare_reviews(raw, "posted", "body", "sym")
    return out.select("review_id", "date", "ticker", "lang", F.md5("review_text").alias("text_md5"))


@query
def prep_market(spark, d):
    raw = X.table(spark, d, "events").select(
        F.col("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias(" Date "),
        F.col("event_type").alias("Ticker"),
        F.when(F.col("event_type") == "error", "n/a")
        .when(F.col("event_type") == "view", "NaN")
        .otherwise(F.col("value").cast("string"))
        .alias("RET"),
    )
    return prepare.prepare_market(raw).select("event_id", "date", "ticker", "ret")


@query
def parse_dates(spark, d):
    """Order dates written in six formats and parsed back; some are no dates."""
    o = X.table(spark, d, "orders")
    day = F.col("o_orderdate")
    written = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(day, "M/d/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(day, "d MMMM yyyy"))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyyMMdd"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy/MM/dd HH:mm"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    return o.select("o_orderkey", dates.parse_day(written).alias("day"))


# -- scoring ----------------------------------------------------------------------------


@query
def lexicon_score(spark, d):
    return X.text_scored(spark, d).select("review_id", "date", "ticker", "score_a", "score_b")


@query
def lexicon_score_derived(spark, d):
    """Scores by a lexicon of thousands of words with as many weights, derived from the documents."""
    scored = N.score_reviews(
        X.text_reviews(spark, d),
        N.lexicon_scorer(X.derived_lexicon(spark, d)),
    )
    return scored.select("review_id", "score_a")


@query
def expected_score(spark, d):
    p_pos, p_neg = F.col("l_discount") * 5, F.col("l_tax") * 6.25
    probabilities = F.array(p_neg, 1 - p_pos - p_neg, p_pos)
    labels = F.array(F.lit("Negative"), F.lit("neutral"), F.lit("POSITIVE"))
    return X.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", N.expected_score(probabilities, labels).alias("score")
    )


def _toy_model():
    """A model for the hook: share of exclamation marks, scaled to [-1, 1]."""

    def score(texts):
        return [min(1.0, 20.0 * t.count("!") / max(1, len(t))) * 2 - 1 for t in texts]

    return score


@query
def model_score(spark, d):
    scored = N.score_reviews(
        X.text_reviews(spark, d), N.lexicon_scorer(X.lexicon(spark, 0)), N.model_scorer(_toy_model)
    )
    return scored.select("review_id", "score_a", "score_b")


@query
def model_score_stored(spark, d):
    """The same by a store of scores, so that the model sees each text once."""
    model = score_store.filling_scorer(N.model_scorer(_toy_model), _scratch(spark, "scores"), "first")
    scored = N.score_reviews(X.text_reviews(spark, d), N.lexicon_scorer(X.lexicon(spark, 0)), model)
    return scored.select("review_id", "score_a", "score_b")


@query
def score_store_runs(spark, d):
    """Texts that each of two runs scores: documents, then documents and turns of conversations."""
    path = _scratch(spark, "scores")
    model = N.model_scorer(_toy_model)
    documents = X.text_reviews(spark, d).select("review_text")
    turns = X.table(spark, d, "conversations").select(F.col("text").alias("review_text"))
    score_store.fill(documents, model, path, "1 documents")
    score_store.fill(documents.unionByName(turns), model, path, "2 with turns")
    return score_store.stored(spark, path).groupBy("run").agg(
        F.count(F.lit(1)).alias("n_texts"), F.round(F.avg("score"), 9).alias("mean_score")
    )


@query
def second_scorer_off(spark, d):
    """One scorer only: the second column exists and is NULL, the queue is empty."""
    scored = N.score_reviews(X.text_reviews(spark, d), N.lexicon_scorer(X.lexicon(spark, 0)))
    return scored.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.count("score_b").alias("n_b"), F.avg("score_a").alias("mean_a")
    )


# -- panel ------------------------------------------------------------------------------


@query
def daily_panel(spark, d):
    return P.daily_means(X.text_scored(spark, d))


@query
def daily_panel_long(spark, d):
    return P.daily_means(X.long_scored(spark, d))


@query
def panel_join(spark, d):
    return P.join_market(P.daily_means(X.long_scored(spark, d)), X.long_market(spark, d))


@query
def lag_panel(spark, d):
    return X.long_panel(spark, d).select("date", "ticker", "ret", "avg_a", "avg_b", "avg_a_lag1", "avg_b_lag1")


@query
def lag_panel_calendar(spark, d):
    """Lag that only counts when the previous row is the day before."""
    merged = P.join_market(P.daily_means(X.long_scored(spark, d)), X.long_market(spark, d))
    return P.add_lag(merged, calendar=True).select("date", "ticker", "avg_a_lag1", "avg_b_lag1")


@query
def first_entity(spark, d):
    return P.first_entity(X.long_reg(spark, d)).select("date", "ticker", "ret", "avg_a_lag1")


@query
def worst_day(spark, d):
    return P.worst_day(X.long_reg(spark, d))


@query
def worst_day_by_entity(spark, d):
    return P.worst_day(X.long_reg(spark, d), ["ticker"])


@query
def best_day(spark, d):
    return P.best_day(X.long_panel(spark, d))


@query
def best_day_by_entity(spark, d):
    return P.best_day(X.long_panel(spark, d), ["ticker"])


@query
def overlap(spark, d):
    return P.overlap(X.long_panel(spark, d))


@query
def review_volume(spark, d):
    return P.review_volume(X.text_reviews(spark, d))


@query
def series_summary(spark, d):
    return P.series_summary(X.long_panel(spark, d))


@query
def disagreement_mean(spark, d):
    return P.mean_disagreement(X.long_scored(spark, d), ["ticker"])


@query
def disagreement_mean_pooled(spark, d):
    """From the sums carried by the daily table."""
    daily = P.daily_means(X.long_scored(spark, d), with_disagreement=True)
    return report.daily_disagreement(daily)


# -- statistics -------------------------------------------------------------------------


@query
def pearson_by_entity(spark, d):
    return S.correlations(X.long_reg(spark, d), ["ticker"])


@query
def pearson_pooled(spark, d):
    return S.correlations(X.long_reg(spark, d))


@query
def ols_hc3(spark, d):
    return S.ols_hc3(X.long_reg(spark, d))


@query
def ols_hc3_pooled(spark, d):
    return S.ols_hc3(X.long_reg(spark, d), "avg_b_lag1", by=[])


@query
def holdout_eval(spark, d):
    return S.holdout_eval(X.long_reg(spark, d))


@query
def holdout_eval_text(spark, d):
    return S.holdout_eval(X.text_reg(spark, d), "avg_b_lag1", min_train=15)


@query
def time_split(spark, d):
    return S.time_split(X.long_reg(spark, d)).select("date", "ticker", "pos", "n_rows", "is_train")


@query
def trend_line(spark, d):
    return S.trend_line(X.long_reg(spark, d))


@query
def expanding_corr(spark, d):
    return S.expanding_corr(X.long_reg(spark, d))


@query
def rolling_corr(spark, d):
    return S.rolling_corr(X.long_reg(spark, d), "avg_b_lag1")


@query
def stability_frame(spark, d):
    return S.stability_frame(X.long_reg(spark, d))


@query
def expanding_corr_pooled(spark, d):
    """All entities as one series, without an ordered window over all rows."""
    return S.expanding_corr(X.long_reg(spark, d), by=[])


@query
def rolling_corr_pooled(spark, d):
    return S.rolling_corr(X.long_reg(spark, d), "avg_b_lag1", by=[])


@query
def stability_frame_pooled(spark, d):
    return S.stability_frame(X.long_reg(spark, d), by=[])


@query
def stability_endpoints(spark, d):
    return S.stability_endpoints(S.stability_frame(X.long_reg(spark, d)))


@query
def stability_spread(spark, d):
    return S.stability_spread(S.stability_frame(X.long_reg(spark, d)))


@query
def early_late_gap(spark, d):
    return S.early_late_gap(X.long_panel(spark, d))


@query
def early_late_rolling(spark, d):
    return S.early_late_rolling(S.stability_frame(X.long_reg(spark, d)))


@query
def biggest_drop(spark, d):
    return S.biggest_drop(X.long_panel(spark, d))


@query
def biggest_gap(spark, d):
    return S.biggest_gap(X.long_panel(spark, d))


@query
def sharpest_shift(spark, d):
    return S.sharpest_shift(S.stability_frame(X.long_reg(spark, d)))


# -- review selections ------------------------------------------------------------------


@query
def return_tails(spark, d):
    return R.return_tails(X.long_reg(spark, d))


@query
def order_value_quantiles(spark, d):
    """Exact quantiles of every order's value: the large single group."""
    orders = X.table(spark, d, "orders")
    return R.exact_quantiles(
        orders, "o_totalprice", [0.0, 0.1, 0.5, 0.9, 1.0], whole_below=10_000
    ).drop("q")


@query
def return_quantiles_by_entity(spark, d):
    return R.exact_quantiles(X.long_reg(spark, d), "ret", [0.1, 0.25, 0.9], by=["ticker"]).drop("q")


@query
def tail_days(spark, d):
    return R.tail_days(X.long_reg(spark, d))


@query
def tail_reviews(spark, d):
    """All reviews of tail days, scored after the selection."""
    rows = R.tail_reviews(X.text_reviews(spark, d), X.text_reg(spark, d), max_reviews=None)
    rows = N.score_reviews(rows, X.text_scorer(spark, 0), X.text_scorer(spark, 1))
    return rows.select("review_id", "date", "ticker", "score_a", "score_b")


@query
def tail_reviews_sampled(spark, d):
    """Fixed-size repeatable sample of the tail-day order lines."""
    rows = R.tail_reviews(X.long_scored(spark, d), X.long_reg(spark, d), max_reviews=400)
    return rows.select("review_id", "date", "ticker")


@query
def disagreement_queue(spark, d):
    q = R.disagreement_queue(X.text_scored(spark, d), 25)
    return q.withColumn("text", F.md5("text"))


@query
def top_disagreement(spark, d):
    return R.top_disagreement(X.text_scored(spark, d), 80).select(
        "review_id", "date", "ticker", "disagreement"
    )


@query
def dedupe_queue(spark, d):
    """First row per text key of a queue that holds every scored review."""
    scored = X.text_scored(spark, d).withColumn("disagreement", N.disagreement())
    out = R.dedupe_queue(scored.select("review_id", F.col("review_text").alias("text"), "disagreement"))
    return out.select("review_id", "disagreement")


@query
def dedupe_reviews(spark, d):
    """First review per text and language."""
    docs = X.table(spark, d, "documents").select("doc_id", "text", "lang")
    return R.first_per_key(docs, ["text", "lang"], [F.col("doc_id")]).select("doc_id", "lang")


@query
def worst_day_excerpts(spark, d):
    return R.day_excerpts(X.text_reviews(spark, d), P.worst_day(X.text_reg(spark, d)), by=[])


@query
def best_day_excerpts(spark, d):
    daily = P.daily_means(X.text_scores(spark, d))
    panel = P.join_market(daily, X.text_market(spark, d))
    return R.day_excerpts(X.text_reviews(spark, d), P.best_day(panel), by=[], k=4)


@query
def day_excerpts(spark, d):
    """Worst market day per entity; reviews exist only every other day, so some fall back."""
    spread = F.date_add(F.to_date(F.lit("2024-01-01")), F.expr("cast(review_id % 15 as int)") * 2)
    reviews = X.text_reviews(spark, d).withColumn("date", spread)
    market = X.text_market(spark, d)
    both = P.worst_day(market, ["ticker"]).union(P.best_day(market, ["ticker"]))
    return R.day_excerpts(reviews, both)


@query
def flagged_corpus(spark, d):
    out = R.flagged_corpus(
        X.text_scores(spark, d), X.text_reg(spark, d), texts=X.text_reviews(spark, d)
    )
    return out.select("review_id", "date", "ticker", "slice", "disagreement")


@query
def corpus_provenance(spark, d):
    return R.corpus_provenance(
        R.corpus_slices(
            X.text_scores(spark, d), X.text_reg(spark, d), texts=X.text_reviews(spark, d)
        )
    )


# -- text mining ------------------------------------------------------------------------


def _corpus(spark, d):
    """Persisted: at most a few hundred reviews, and read twice by some queries."""
    flagged = R.flagged_corpus(
        X.text_scores(spark, d), X.text_reg(spark, d), texts=X.text_reviews(spark, d)
    )
    return M.substantial(flagged).persist()


@query
def token_counts(spark, d):
    """Token and content-token count of every document, with a digest of the sequence."""
    words = text.tokens(F.col("text"))
    content = text.content_tokens(F.col("text"), M.default_stop_words())
    return X.table(spark, d, "documents").select(
        "doc_id",
        F.size(words).cast("long").alias("n_tokens"),
        F.size(content).cast("long").alias("n_content"),
        F.md5(F.array_join(content, " ")).alias("content_md5"),
    )


@query
def bigrams(spark, d):
    return M.top_bigrams(_corpus(spark, d))


@query
def bigrams_all(spark, d):
    """Most frequent pairs over all documents that occur in at least two of them."""
    docs = X.text_reviews(spark, d)
    return M.top_bigrams(docs, 100, min_df=2)


@query
def tfidf(spark, d):
    return M.term_weights(_corpus(spark, d))


@query
def tfidf_all(spark, d):
    return M.term_weights(X.text_reviews(spark, d))


@query
def theme_clusters(spark, d):
    return M.theme_clusters(M.top_bigrams(_corpus(spark, d)))


@query
def theme_clusters_pages(spark, d):
    """Themes in all pairs of the raw pages and conversations."""
    pages = X.table(spark, d, "pages").select(F.col("html").alias("review_text"))
    talk = X.table(spark, d, "conversations").select(F.col("text").alias("review_text"))
    return M.themes_of_texts(pages.union(talk))


@query
def theme_clusters_documents(spark, d):
    return M.themes_of_texts(X.text_reviews(spark, d))


@query
def nmf_topics_corpus(spark, d):
    return nmf_topics(_corpus(spark, d), max_terms=2000)


# -- scalar functions -------------------------------------------------------------------


@query
def text_key(spark, d):
    key = text.text_key(F.col("text"))
    return X.table(spark, d, "documents").select(
        "doc_id", F.md5(key).alias("key_md5"), F.length(key).cast("long").alias("key_chars")
    )


@query
def text_excerpts(spark, d):
    return X.table(spark, d, "conversations").select(
        "conv_id", "turn", text.excerpt(F.col("text"), 60).alias("excerpt"),
        text.has_substance(F.col("text")).alias("substantial"),
    )


@query
def ascii_safe(spark, d):
    return X.table(spark, d, "documents").select("doc_id", text.latin_safe(F.col("text")).alias("plain"))


@query
def strip_markdown(spark, d):
    marked = F.concat(F.lit("## "), F.col("lang"), F.lit("\n# **"), F.col("source"), F.lit("** of\n"), F.col("text"))
    return X.table(spark, d, "documents").select(
        "doc_id", F.md5(text.strip_markdown(marked)).alias("plain_md5")
    )


@query
def number_text(spark, d):
    o = X.table(spark, d, "orders")
    missing = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return o.select(
        "o_orderkey",
        numeric.fixed(missing, 2).alias("price_text"),
        numeric.percent(F.col("o_totalprice") / 1e7 - 0.02).alias("pct_text"),
    )


@query
def date_span(spark, d):
    spans = X.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b")
    )
    return spans.select("o_custkey", dates.day_span(F.col("a"), F.col("b")).alias("span"))


# -- verdicts and reports ---------------------------------------------------------------

_LISTS = ("risk_flags", "executive_summary")


def _flat(df: DataFrame) -> DataFrame:
    for c in _LISTS:
        if c in df.columns:
            df = df.withColumn(c, F.array_join(c, ","))
    return df


@query
def verdict_facts(spark, d):
    """All statistics and labels of every entity of the long panel."""
    return _flat(verdicts.entity_facts(X.long_panel(spark, d), X.long_disagreement(spark, d)))


@query
def verdict_facts_text(spark, d):
    """The same on the text panel, through the end-to-end job."""
    result = report.run(
        X.text_reviews(spark, d),
        X.text_market(spark, d),
        X.text_scorer(spark, 0),
        X.text_scorer(spark, 1),
        report.Options(min_train=15),
    )
    return _flat(result.facts)


def _window_statistics(spark, d):
    """Statistics of every customer from its orders, as inputs that reach all rule branches."""
    o = X.table(spark, d, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("k"), (F.col("o_totalprice") / 499979).alias("v")
    )
    n = F.count(F.lit(1))
    by_key = F.struct("k")
    s = o.groupBy("o_custkey").agg(
        n.alias("n"), F.min_by("v", by_key).alias("f"), F.max_by("v", by_key).alias("l"),
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("m"),
    )
    c = F.col
    return s.select(
        "o_custkey",
        (c("n") * 3).alias("n_days"),
        c("f").alias("a_first"), c("l").alias("a_last"),
        F.when(c("n") > 2, (c("hi") - c("lo")) / 4).alias("a_sd"),
        F.when(c("l") > 0.3, c("m")).alias("b_mean"),
        F.when(c("n") > 4, c("f") - c("m")).alias("r_a"),
        F.when(c("n") > 6, c("l") - c("m")).alias("r_b"),
        c("n").alias("n_stability"),
        F.when(c("n") > 5, c("n")).alias("n_points"),
        F.when(c("n") > 5, F.abs(c("f") - c("l"))).alias("end_gap"),
        F.when(c("n") > 8, (c("hi") - c("m")) / 3).alias("rolling_sd"),
        F.when(c("n") > 7, c("m") - c("hi") / 2).alias("holdout_r_a"),
        F.when(c("n") > 6, c("n")).alias("n_holdout_a"),
        F.when(c("n") > 7, F.abs(c("f") - c("l"))).alias("holdout_p_a"),
        F.when(c("n") > 9, (c("hi") - c("lo")) / 8).alias("holdout_p_b"),
        F.when(c("n") > 9, c("lo") - c("m") / 2).alias("holdout_r_b"),
        F.when(c("n") > 8, c("n")).alias("n_holdout_b"),
        F.when(c("f") > 0.5, "widened").when(c("f") > 0.3, "narrowed").alias("gap_change"),
        F.when(c("n") > 3, c("hi") - c("lo")).alias("mean_abs_disagreement"),
    )


@query
def verdict_rules(spark, d):
    """Every rule over one row per customer: thousands of different inputs."""
    out = verdicts.add_verdicts(_window_statistics(spark, d))
    return _flat(out)


@query
def risk_flags(spark, d):
    facts = verdicts.entity_facts(X.long_panel(spark, d), X.long_disagreement(spark, d))
    return facts.select("ticker", F.posexplode("risk_flags").alias("position", "flag"))


@query
def snapshot_json(spark, d):
    """Run snapshots per entity of the text panel."""
    result = report.run(
        X.text_reviews(spark, d),
        X.text_market(spark, d),
        X.text_scorer(spark, 0),
        X.text_scorer(spark, 1),
        report.Options(min_train=15),
    )
    return result.entity_snapshots()


@query
def snapshot_facts(spark, d):
    """The run's snapshots, parsed back into columns."""
    result = report.run(
        X.text_reviews(spark, d),
        X.text_market(spark, d),
        X.text_scorer(spark, 0),
        X.text_scorer(spark, 1),
        report.Options(min_train=15),
    )
    fields = (
        "n_days long, r_a double, r_b double, a_mean double, b_sd double, mean_abs_disagreement double, holdout_r_a double, "
        "last_rolling_a double, overlap_first date, overlap_last date, drift string, regime string, recommended_action string, "
        "both_scorers boolean"
    )
    parsed = F.from_json("snapshot", fields)
    return result.entity_snapshots().select("ticker", parsed.alias("s")).select("ticker", "s.*")


@query
def mining_bundle(spark, d):
    """Number of mined texts, their source and their phrases, of the run on the text panel."""
    result = report.run(
        X.text_reviews(spark, d),
        X.text_market(spark, d),
        X.text_scorer(spark, 0),
        X.text_scorer(spark, 1),
        report.Options(top_disagreement=16),
    )
    listed = F.transform("bigrams", lambda b: F.concat_ws(":", b["phrase"], b["count"]))
    return result.mining(with_topics=False).select("n_docs", "source", F.array_join(listed, ",").alias("phrases"))


@query
def run_fingerprint(spark, d):
    """Fingerprint of a small snapshot per entity, from whole-number fields."""
    panel = X.long_panel(spark, d)
    s = panel.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("review_count").alias("reviews"),
        F.min("date").alias("a"),
        F.max("date").alias("b"),
        F.max(F.when(F.col("date") < F.to_date(F.lit("1900-01-01")), F.lit(1))).alias("none"),
    )
    snap = report.json_in_name_order(
        {
            "overlap_rows": F.col("n"),
            "n_reviews": F.col("reviews"),
            "date_min": dates.iso_text(F.col("a")),
            "date_max": dates.iso_text(F.col("b")),
            "before_floor": F.col("none"),
            "company": F.col("ticker"),
        }
    )
    return s.select("ticker", snap.alias("snapshot")).withColumn(
        "fingerprint", report.fingerprint(F.col("snapshot"))
    )
