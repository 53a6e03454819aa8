"""The end-to-end job: raw tables in, a set of lazy result tables out; snapshots and fingerprints."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.operators import mining as M
from moodtide.operators import panel as P
from moodtide.operators import reviews as R
from moodtide.operators import stats as S
from moodtide.operators.scoring import Scorer, score_reviews
from moodtide.operators.topics import nmf_topics
from moodtide.plans.verdicts import entity_facts
from moodtide.sources.prepare import prepare_market, prepare_reviews


@dataclass(frozen=True)
class Options:
    """Settings of one run; defaults suit daily review exports."""

    company: str = ""
    review_date_col: str = "date"
    review_text_col: str = "review_text"
    review_ticker_col: str = "ticker"
    market_date_col: str = "date"
    market_ticker_col: str = "ticker"
    market_ret_col: str = "ret"
    top_disagreement: int = 10
    by: Sequence[str] = ("ticker",)
    window: int = 20
    min_rows: int = 15
    min_train: int = 25
    min_holdout: int = 8
    tail_quantile: float = 0.1
    max_tail_reviews: int | None = None
    bigram_top_n: int = 15
    n_topics: int = 5
    unique_market: bool = False
    keep_scores: bool = True
    stop_words: Sequence[str] | None = None


@dataclass
class Run:
    """Tables of one run. Each is built when first asked for and computed when acted on.

    ``topics()`` iterates, so it runs jobs when called.
    """

    options: Options
    reviews: DataFrame
    scored: DataFrame
    scores: DataFrame
    daily: DataFrame
    panel: DataFrame
    _persisted: list[DataFrame] = field(default_factory=list, repr=False)

    # -- statistics, all from the daily table --

    @cached_property
    def reg(self) -> DataFrame:
        return P.regression_rows(self.panel)

    @cached_property
    def correlations(self) -> DataFrame:
        return S.correlations(self.reg, self.options.by)

    @cached_property
    def correlations_pooled(self) -> DataFrame:
        return S.correlations(self.reg)

    @cached_property
    def volume(self) -> DataFrame:
        return self.daily.agg(
            F.sum("review_count").alias("n_reviews"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )

    @cached_property
    def overlap(self) -> DataFrame:
        return P.overlap(self.panel)

    @cached_property
    def disagreement_mean(self) -> DataFrame:
        return daily_disagreement(self.daily)

    @cached_property
    def worst_day(self) -> DataFrame:
        return P.worst_day(self.reg)

    @cached_property
    def best_day(self) -> DataFrame:
        return P.best_day(self.panel)

    @cached_property
    def stability(self) -> DataFrame:
        o = self.options
        return S.stability_frame(self.reg, by=o.by, window=o.window, min_rows=o.min_rows)

    @cached_property
    def biggest_drop(self) -> DataFrame:
        return S.biggest_drop(self.panel, self.options.by)

    @cached_property
    def biggest_gap(self) -> DataFrame:
        return S.biggest_gap(self.panel, self.options.by)

    @cached_property
    def sharpest_shift(self) -> DataFrame:
        return S.sharpest_shift(self.stability, self.options.by)

    @cached_property
    def early_late_rolling(self) -> DataFrame:
        return S.early_late_rolling(self.stability, self.options.by)

    @cached_property
    def ols_a(self) -> DataFrame:
        return S.ols_hc3(self.reg, "avg_a_lag1", by=self.options.by)

    @cached_property
    def ols_b(self) -> DataFrame:
        return S.ols_hc3(self.reg, "avg_b_lag1", by=self.options.by)

    @cached_property
    def holdout_a(self) -> DataFrame:
        return self._holdout("avg_a_lag1")

    @cached_property
    def holdout_b(self) -> DataFrame:
        return self._holdout("avg_b_lag1")

    def _holdout(self, x: str) -> DataFrame:
        o = self.options
        return S.holdout_eval(self.reg, x, by=o.by, min_train=o.min_train, min_holdout=o.min_holdout)

    @cached_property
    def facts(self) -> DataFrame:
        o = self.options
        return entity_facts(
            self.panel,
            daily_disagreement(self.daily, o.by),
            by=o.by,
            min_train=o.min_train,
            min_holdout=o.min_holdout,
            window=o.window,
        )

    # -- texts --

    @cached_property
    def queue(self) -> DataFrame:
        return R.disagreement_queue(self.scores, self.options.top_disagreement, texts=self.reviews)

    @cached_property
    def corpus(self) -> DataFrame:
        """Flagged reviews long enough to mine; few, and persisted for the steps that follow."""
        flagged = R.flagged_corpus(self.scores, self.reg, **self._corpus_options())
        kept = M.substantial(flagged).persist(StorageLevel.MEMORY_AND_DISK)
        self._persisted.append(kept)
        return kept

    def corpus_source(self) -> DataFrame:
        slices = R.corpus_slices(self.scores, self.reg, **self._corpus_options())
        return R.corpus_provenance(slices, quantile=self.options.tail_quantile)

    def _corpus_options(self) -> dict:
        return {
            "texts": self.reviews,
            "top_n": max(self.options.top_disagreement * 5, 60),
            "quantile": self.options.tail_quantile,
            "max_tail_reviews": self.options.max_tail_reviews,
        }

    def bigrams(self) -> DataFrame:
        return M.top_bigrams(
            self.corpus, self.options.bigram_top_n, stop_words=self.options.stop_words
        )

    def topics(self, **settings) -> DataFrame:
        return nmf_topics(
            self.corpus, self.options.n_topics, stop_words=self.options.stop_words, **settings
        )

    def themes(self) -> DataFrame:
        return M.theme_clusters(self.bigrams())

    def mining(self, *, with_topics: bool = True, min_scored: int = 5) -> DataFrame:
        """What mining the flagged corpus gave, as one row: texts mined, their source, phrases, topics.

        Phrases and topics are empty for fewer than three texts. No row where the corpus is empty or
        fewer than ``min_scored`` reviews were scored. Topics run jobs when called.
        """
        source = self.corpus_source()
        ranked = self.bigrams().select((-F.col("count")).alias("rank_key"), "phrase", "count")
        phrases = F.array_sort(F.collect_list(F.struct("rank_key", "phrase", "count")))
        columns = {
            "n_docs": self.corpus.agg(F.count(F.lit(1))).scalar(),
            "source": F.col("source"),
            "bigrams": ranked.agg(F.transform(phrases, lambda p: F.struct(p["phrase"].alias("phrase"), p["count"].alias("count")))).scalar(),
        }
        if with_topics:
            topics = self.topics().agg(F.array_sort(F.collect_list(F.struct("id", "top_words"))))
            columns["topics"] = topics.scalar()
        n_scored = self.scores.agg(F.count(F.lit(1))).scalar()
        some = (F.col("n_disagreement") + F.col("n_tail") > 0) & (n_scored >= min_scored)
        return source.where(some).select(*[c.alias(n) for n, c in columns.items()])

    def worst_day_excerpts(self, k: int = 3) -> DataFrame:
        return R.day_excerpts(self.reviews, self.worst_day, by=[], k=k)

    def best_day_excerpts(self, k: int = 4) -> DataFrame:
        return R.day_excerpts(self.reviews, self.best_day, by=[], k=k)

    def entity_snapshots(self) -> DataFrame:
        return entity_snapshots(self.facts, self.ols_a, self.holdout_a, by=self.options.by)

    def release(self) -> None:
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()


def run(
    reviews: DataFrame,
    market: DataFrame,
    scorer_a: Scorer,
    scorer_b: Scorer | None = None,
    options: Options | None = None,
) -> Run:
    """Prepare, score, roll up, join, lag, and derive every table of a run.

    Texts are read and scored once, into a score table without texts that is persisted unless
    ``keep_scores`` is off. The daily table made from it is small and persisted too; all series
    statistics come from that, and the text steps fetch only the few texts they select.
    """
    o = options or Options()
    prepared = prepare_reviews(reviews, o.review_date_col, o.review_text_col, o.review_ticker_col)
    returns = prepare_market(market, o.market_date_col, o.market_ticker_col, o.market_ret_col)
    scored = score_reviews(prepared, scorer_a, scorer_b)
    persisted = []
    scores = R.score_table(scored)
    if o.keep_scores:
        scores = scores.persist(StorageLevel.MEMORY_AND_DISK)
        persisted.append(scores)
    daily = P.daily_means(scores, with_disagreement=True).persist(StorageLevel.MEMORY_AND_DISK)
    panel = P.add_lag(P.join_market(daily, returns, unique=o.unique_market))
    panel = panel.persist(StorageLevel.MEMORY_AND_DISK)
    persisted += [daily, panel]
    return Run(o, prepared, scored, scores, daily, P.require_overlap(panel), persisted)


def daily_disagreement(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Review-level mean score gap from the sums carried by the daily table."""
    mean = F.try_divide(F.sum("gap_sum"), F.sum("gap_count"))
    return daily.groupBy(*by).agg(mean.alias("mean_abs_disagreement"))


# -- snapshots --------------------------------------------------------------------------


def json_in_name_order(columns: dict[str, Column]) -> Column:
    """JSON text with keys in alphabetical order and missing values spelled out."""
    fields = [columns[name].alias(name) for name in sorted(columns)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def settled(df: DataFrame) -> DataFrame:
    """Doubles rounded to nine decimals.

    Sums depend in their last bits on the order in which tasks finish; without rounding, the same
    data would give a new fingerprint on every run.
    """
    return df.withColumns({c: F.round(c, 9) + 0.0 for c, t in df.dtypes if t == "double"})


def fingerprint(text: Column) -> Column:
    """First 32 hex digits of the SHA-256 of a snapshot."""
    return F.substring(F.sha2(text, 256), 1, 32)


def entity_snapshots(
    facts: DataFrame,
    ols: DataFrame | None = None,
    holdout: DataFrame | None = None,
    *,
    by: Sequence[str] = ("ticker",),
) -> DataFrame:
    """One JSON snapshot with fingerprint per entity."""
    out = settled(facts)
    for name, part in (("regression", ols), ("holdout", holdout)):
        if part is not None:
            fields = sorted(c for c in part.columns if c not in by)
            out = out.join(settled(part).select(*by, F.struct(*fields).alias(name)), list(by), "left")
    text = json_in_name_order({c: F.col(c) for c in out.columns})
    return out.select(*by, text.alias("snapshot")).withColumn("fingerprint", fingerprint(F.col("snapshot")))


def run_snapshot(result: Run, *, quotes: int = 12, with_topics: bool = False) -> DataFrame:
    """One JSON snapshot of the whole run: pooled statistics, queue head, phrases, topics.

    Every list in it is bounded by a top-k setting.
    """
    first = P.first_entity(result.panel).select("ticker").limit(1).scalar()

    def one(df: DataFrame, drop: Sequence[str] = ("ticker",)) -> Column:
        df = settled(df)
        rows = df.where(F.col("ticker") == first) if "ticker" in drop and "ticker" in df.columns else df
        return rows.select(F.struct(*sorted(c for c in df.columns if c not in drop))).limit(1).scalar()

    def listed(df: DataFrame, order: Sequence[str]) -> Column:
        fields = [*order, *sorted(c for c in df.columns if c not in order)]
        df = settled(df)
        return df.agg(F.array_sort(F.collect_list(F.struct(*fields)))).scalar()

    o = result.options
    queue = result.queue.select((-F.col("disagreement")).alias("rank_key"), "*").limit(quotes)
    pooled, volume, lap = (
        one(x, ()) for x in (result.correlations_pooled, result.volume, result.overlap)
    )
    columns = {
        "company": F.lit(o.company),
        "correlations": pooled,
        "volume": volume,
        "overlap": lap,
        "mean_abs_disagreement": settled(result.disagreement_mean).scalar(),
        "worst_day": one(result.worst_day, ()),
        "best_day": one(result.best_day, ()),
        "first_entity": first,
        "regression_a": one(result.ols_a),
        "regression_b": one(result.ols_b),
        "holdout_a": one(result.holdout_a),
        "holdout_b": one(result.holdout_b),
        "facts": one(result.facts),
        "queue": listed(queue, ["rank_key", "review_id"]),
        "bigrams": listed(result.bigrams().select((-F.col("count")).alias("rank_key"), "*"), ["rank_key", "phrase"]),
        "corpus": one(result.corpus_source(), ()),
    }
    if with_topics:
        columns["topics"] = listed(result.topics(), ["id"])
    spark = result.scored.sparkSession
    text = json_in_name_order(columns)
    return spark.range(1).select(text.alias("snapshot")).withColumn(
        "fingerprint", fingerprint(F.col("snapshot"))
    )
