"""Phrases, weighted terms and theme clusters of a small flagged corpus or of any review table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.functions.text import bigrams, content_tokens, dash_words, has_substance

# Words that mark a theme in frequent phrases.
THEME_WORDS = {
    "support": (
        "support", "respond", "response", "took", "forever", "wait", "waiting", "slow", "hours",
        "days", "reply", "ticket", "contacted",
    ),
    "usability": (
        "clicked", "click", "finally", "figured", "intuitive", "confusing", "confused",
        "navigation", "interface", "button", "screen", "menu", "difficult", "hard", "easy",
        "simple",
    ),
    "value": (
        "worth", "price", "expensive", "cheap", "pay", "subscription", "premium", "free", "cost",
        "money", "refund", "cancel",
    ),
    "stability": (
        "crash", "bug", "freeze", "frozen", "error", "broken", "fix", "update", "glitch",
        "loading", "load", "stuck",
    ),
    "positive": (
        "love", "great", "amazing", "excellent", "perfect", "best", "fantastic", "wonderful",
        "recommend", "brilliant",
    ),
}


@cache
def default_stop_words() -> tuple[str, ...]:
    """Spark's English stop words."""
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def substantial(corpus: DataFrame, text_col: str = "review_text") -> DataFrame:
    """Corpus rows whose text is long enough to mine."""
    return corpus.where(has_substance(F.col(text_col)))


def _content(text_col: str, stop_words: Sequence[str] | None) -> Column:
    return content_tokens(F.col(text_col), default_stop_words() if stop_words is None else stop_words)


def top_bigrams(
    corpus: DataFrame,
    top_n: int | None = 15,
    *,
    text_col: str = "review_text",
    min_df: int = 1,
    min_docs: int = 3,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Most frequent word pairs after stop-word removal; empty for fewer than ``min_docs`` texts.

    ``top_n=None`` gives the counts of all pairs, unordered.
    """
    # words, then pairs: each in a projection of its own, so that no text is cut twice
    tokenised = corpus.select(_content(text_col, stop_words).alias("words"))
    grams = tokenised.select(bigrams(F.col("words")).alias("grams"))
    mention = [F.transform("grams", lambda g: F.struct(g.alias("phrase"), F.lit(1).alias("c"), F.lit(0).alias("d")))]
    if min_df > 1:
        # One extra mention per text and phrase counts the texts without a per-text shuffle.
        mention.append(
            F.transform(
                F.array_distinct("grams"),
                lambda g: F.struct(g.alias("phrase"), F.lit(0).alias("c"), F.lit(1).alias("d")),
            )
        )
    mentions = grams.select(F.inline(F.concat(*mention)))
    counts = (
        mentions.groupBy("phrase")
        .agg(F.sum("c").alias("count"), F.sum("d").alias("df"))
        .where(F.lit(min_df <= 1) | (F.col("df") >= min_df))
        .select("phrase", "count")
    )
    # whether there are enough texts shows in the first few
    n_docs = corpus.where(F.col(text_col).isNotNull()).limit(min_docs).agg(F.count(F.lit(1))).scalar()
    counts = counts.where(n_docs >= min_docs)
    return counts if top_n is None else counts.orderBy(F.desc("count"), "phrase").limit(top_n)


def term_weights(
    corpus: DataFrame,
    *,
    text_col: str = "review_text",
    id_col: str = "review_id",
    max_df: float = 0.95,
    max_terms: int | None = None,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """TF-IDF per text and term: ``tf * (ln((1+n)/(1+df)) + 1)``, scaled to unit length per text.

    Terms in more than ``max_df`` of the texts are dropped; ``max_terms`` keeps the most frequent of
    the others only. A text is a row: texts that share an id are weighed each by itself.
    """
    texts = corpus.select(
        F.col(id_col).alias("__id"),
        _content(text_col, stop_words).alias("words"),
        F.monotonically_increasing_id().alias("__row"),  # before the words part, which would number them
    )
    tf = _term_counts(texts, "__id", "__row")
    n = corpus.agg(F.count(F.lit(1))).scalar()
    vocab = (
        _term_counts(corpus.select(_content(text_col, stop_words).alias("words")))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
        .withColumn("n", n)
        .where(F.col("df") <= F.lit(float(max_df)) * F.col("n"))
    )
    if max_terms is not None:
        vocab = vocab.orderBy(F.desc("total"), "term").limit(max_terms)
    vocab = vocab.select("term", (F.ln((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"))
    # the vocabulary's part of a task is looked up in a hash table: the pairs are shuffled, but not sorted by term
    weighted = tf.join(vocab.hint("shuffle_hash"), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("__row")))
    return weighted.select(F.col("__id").alias(id_col), "term", "tf", (F.col("w") / norm).alias("weight"))


def _term_counts(texts: DataFrame, *keys: str) -> DataFrame:
    """One row per text and different word of ``words``, with its count ``tf``; counted in the row, by sorting its words."""
    # projections of their own, so that no text is sorted twice
    sorted_words = texts.select(*keys, F.sort_array("words").alias("words"))
    last_of_run = F.transform("words", lambda w, i: F.when(~w.eqNullSafe(F.get("words", i + 1)), i))
    ends = sorted_words.select(*keys, "words", F.array_compact(last_of_run).alias("ends"))
    terms = F.transform(
        "ends",
        lambda end, i: F.struct(
            F.get("words", end).alias("term"),
            (end - F.coalesce(F.get("ends", i - 1), F.lit(-1))).cast("long").alias("tf"),
        ),
    )
    # outer, as for the plain form a filter on the array is moved down, which would build the array twice
    rows = ends.select(*keys, terms.alias("terms")).select(*keys, F.inline_outer("terms"))
    return rows.where(F.col("term").isNotNull())


def theme_clusters(phrases: DataFrame, phrase_col: str = "phrase") -> DataFrame:
    """Themes whose words occur in the phrases; ``positive`` only when no other theme does."""
    words = phrases.select(F.explode(dash_words(F.col(phrase_col))).alias("word"))
    hits = words.agg(
        *[F.coalesce(F.bool_or(F.col("word").isin(list(ws))), F.lit(False)).alias(t) for t, ws in THEME_WORDS.items()]
    )
    return _named_themes(hits)


def themes_of_texts(
    corpus: DataFrame, text_col: str = "review_text", stop_words: Sequence[str] | None = None
) -> DataFrame:
    """:func:`theme_clusters` over all phrases of the texts, without counting phrases.

    Every content word of a text with two or more of them stands in a phrase.
    """
    words = corpus.select(_content(text_col, stop_words).alias("words")).where(F.size("words") >= 2)
    hits = words.agg(
        *[
            F.coalesce(F.bool_or(F.arrays_overlap("words", F.array(*map(F.lit, ws)))), F.lit(False)).alias(t)
            for t, ws in THEME_WORDS.items()
        ]
    )
    return _named_themes(hits)


def _named_themes(hits: DataFrame) -> DataFrame:
    problems = [t for t in THEME_WORDS if t != "positive"]
    any_problem = F.lit(False)
    for t in problems:
        any_problem = any_problem | F.col(t)
    named = [F.when(F.col(t), F.lit(t)) for t in problems]
    named.append(F.when(F.col("positive") & ~any_problem, F.lit("positive")))
    return hits.select(F.posexplode(F.array_compact(F.array(*named))).alias("position", "theme"))
