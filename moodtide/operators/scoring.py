"""Score texts in [-1, 1]: lexicon tables, class probabilities, or a batch model.

A scorer is a function ``(DataFrame, output column) -> DataFrame`` that adds one DOUBLE column.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtide.functions.numeric import finite_or_null
from moodtide.functions.text import tokens

Scorer = Callable[[DataFrame, str], DataFrame]
BatchModel = Callable[[Sequence[str]], Sequence[float]]

_TOKENS = "__tokens"


# -- lexicon table ----------------------------------------------------------------------


KINDS = ("polarity", "negation", "intensifier")
DEFAULT_NEGATION = -0.5

# Words of a lexicon travel inside the expression; a table of more words is no lexicon, but an error.
MAX_WORDS = 1_000_000

_SLOT = "array<map<string, struct<weight: double, factor: double>>>"


def normalised_lexicon(lexicon: DataFrame) -> dict[str, tuple[float | None, float | None]]:
    """word -> (polarity weight, factor on the next word), from ``word, kind, weight``.

    A word listed more than once for a kind has its largest weight there. A negation without weight
    has ``DEFAULT_NEGATION``; polarity words and intensifiers without weight, and rows without word,
    are left out. A word that is both negation and intensifier is a negation.
    """
    weight = F.when(F.col("kind") == "negation", F.coalesce("weight", F.lit(DEFAULT_NEGATION))).otherwise(F.col("weight"))
    rows = (
        lexicon.where(F.col("word").isNotNull())
        .groupBy("word", "kind")
        .agg(F.max(weight.cast("double")).alias("weight"))
        .limit(MAX_WORDS + 1)
        .collect()
    )
    if len(rows) > MAX_WORDS:
        raise ValueError(f"a lexicon has at most {MAX_WORDS} words")
    unknown = {r["kind"] for r in rows} - set(KINDS)
    if unknown:
        raise ValueError(f"unknown kinds of lexicon words: {sorted(map(str, unknown))}")
    by = {(r["word"], r["kind"]): r["weight"] for r in rows if r["weight"] is not None}
    return {
        w: (by.get((w, "polarity")), by.get((w, "negation"), by.get((w, "intensifier"))))
        for w in sorted({w for w, _ in by})
    }


class _Lookup:
    """Weights of a word in an expression: one constant array of small maps, addressed by a hash.

    A map literal is scanned from its start and a chain of conditions grows with the number of
    different weights; here a look-up reads one slot, however many words and weights there are.
    """

    def __init__(self, lexicon: Mapping[str, tuple[float | None, float | None]], spark: SparkSession):
        self.n = max(1, 2 * len(lexicon))
        words = list(lexicon)
        slots: list[dict] = [{} for _ in range(self.n)]
        for w, slot in zip(words, self._slots(words, spark)):
            weight, factor = lexicon[w]
            slots[slot][w] = {"weight": weight, "factor": factor}
        self.table = F.from_json(F.lit(json.dumps(slots)), _SLOT)

    def _slots(self, words: list[str], spark: SparkSession) -> list[int]:
        """The hash is Spark's own, so that both sides agree; the words get there without Python workers."""
        if not words:
            return []
        listed = F.from_json(F.lit(json.dumps(words)), "array<string>")
        slots = F.transform(listed, lambda w: F.pmod(F.xxhash64(w), F.lit(self.n)))
        return spark.range(1).select(slots.alias("slots")).first()["slots"]

    def of(self, word: Column) -> Column:
        return F.get(self.table, F.pmod(F.xxhash64(word), F.lit(self.n)).cast("int"))[word]


def _clip(x: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))


def _scan_tokens(words: Column, lexicon: _Lookup) -> Column:
    """Mean weight over a token array; the state holds the last modifier and its position.

    ``words`` occurs once in the result, so however the optimiser moves the expression, a text
    is never split more than once per score. The rest of the text is dropped in a first pass.
    """
    looked_up = F.transform(words, lambda w, i: F.struct(i.alias("at"), lexicon.of(w).alias("w")))
    hits = F.filter(looked_up, lambda h: h["w"].isNotNull())

    def step(acc: Column, hit: Column) -> Column:
        weight = hit["w"]["weight"]
        polar = weight.isNotNull()
        factor = F.when(acc["at"] == hit["at"] - 1, acc["factor"]).otherwise(1.0)
        return F.struct(
            F.when(polar, acc["total"] + _clip(weight * factor)).otherwise(acc["total"]).alias("total"),
            F.when(polar, acc["hits"] + 1).otherwise(acc["hits"]).alias("hits"),
            F.coalesce(hit["w"]["factor"], F.lit(1.0)).alias("factor"),
            hit["at"].alias("at"),
        )

    start = F.struct(
        F.lit(0.0).alias("total"),
        F.lit(0).alias("hits"),
        F.lit(1.0).alias("factor"),
        F.lit(-1).alias("at"),
    )
    return F.aggregate(
        hits,
        start,
        step,
        lambda acc: F.when(acc["hits"] > 0, acc["total"] / acc["hits"]).otherwise(F.lit(0.0)),
    )


def lexicon_scorer(lexicon: DataFrame, *, text_col: str = "review_text") -> Scorer:
    """Mean weight of the polarity words of a text, 0.0 when it has none.

    ``lexicon`` has ``word, kind (polarity | negation | intensifier), weight``; see
    :func:`normalised_lexicon`. A polarity word counts its weight times the previous token's factor,
    clipped to [-1, 1]. Texts stay where they are: no shuffle, no Python.
    """
    lookup = _Lookup(normalised_lexicon(lexicon), lexicon.sparkSession)

    def score(df: DataFrame, out: str) -> DataFrame:
        if _TOKENS not in df.columns:
            df = df.withColumn(_TOKENS, tokens(F.col(text_col)))
        return df.withColumn(out, _scan_tokens(F.col(_TOKENS), lookup))

    return score


# -- class probabilities ----------------------------------------------------------------


def label_value(label: Column) -> Column:
    """Class label to -1 / 0 / +1."""
    low = F.lower(label)
    return F.when(low.contains("neg"), -1.0).when(low.contains("pos"), 1.0).otherwise(0.0)


def expected_score(probabilities: Column, labels: Column) -> Column:
    """Sum of probability times class value, clipped to [-1, 1]."""
    terms = F.zip_with(probabilities, labels, lambda p, lab: p * label_value(lab))
    return _clip(F.aggregate(terms, F.lit(0.0), lambda a, t: a + F.coalesce(t, F.lit(0.0))))


def probability_scorer(probabilities_col: str, labels_col: str) -> Scorer:
    def score(df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, expected_score(F.col(probabilities_col), F.col(labels_col)))

    return score


def column_scorer(expression: Column) -> Scorer:
    """Use an existing numeric expression as the score."""

    def score(df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, finite_or_null(expression.cast("double")))

    return score


# -- batch model ------------------------------------------------------------------------


def model_scorer(
    factory: Callable[[], BatchModel], *, text_col: str = "review_text", batch_size: int = 16
) -> Scorer:
    """Score with a user model: ``factory`` runs once per task, the model gets text batches.

    Only the text crosses to Python. A NULL text has a NULL score. Errors of the model surface when
    the result is computed; they are not swallowed.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for texts in batches:
            there = texts.notna()
            some = texts[there].tolist()
            values: list[float] = []
            for i in range(0, len(some), batch_size):
                values.extend(float(v) for v in model(some[i : i + batch_size]))
            out = pd.Series(float("nan"), index=texts.index)
            out[there] = values
            yield out

    run_model = F.pandas_udf(run, T.DoubleType())

    def score(df: DataFrame, out: str) -> DataFrame:
        scored = df.withColumn(out, finite_or_null(run_model(F.col(text_col))))
        # least and greatest pass over NULL
        return scored.withColumn(out, F.when(F.col(out).isNotNull(), _clip(F.col(out))))

    return score


# -- both scorers -----------------------------------------------------------------------


def score_reviews(
    reviews: DataFrame, scorer_a: Scorer, scorer_b: Scorer | None = None
) -> DataFrame:
    """Add ``score_a`` and ``score_b``; the second is NULL throughout when it is off."""
    out = scorer_a(reviews, "score_a")
    out = scorer_b(out, "score_b") if scorer_b else out.withColumn("score_b", F.lit(None).cast("double"))
    return out.drop(_TOKENS)


def disagreement(a: str = "score_a", b: str = "score_b") -> Column:
    return F.abs(F.col(a) - F.col(b))
