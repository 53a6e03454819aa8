"""Review-level selections: disagreement queue, day excerpts, tail days, flagged corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.functions.text import excerpt, text_key
from moodtide.operators.scoring import disagreement

# Seed of the sample of the tail-day slice.
TAIL_SEED = 42


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key. Each task keeps its own first row before the shuffle.

    Text keys are compared by their digest, so that sorting does not move whole texts about.
    """
    kinds = dict(df.dtypes)
    parts = [_raw_digest(F.col(k)) if kinds[k] == "string" else F.col(k) for k in keys]
    w = Window.partitionBy(*parts).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def _raw_digest(text: Column) -> Column:
    """256 bits that stand for a text as it is; NULL for NULL."""
    return F.unhex(F.sha2(text, 256))


# -- scores without texts ---------------------------------------------------------------


def score_table(
    scored: DataFrame, *, with_digest: bool = True, compatibility_forms: bool = True
) -> DataFrame:
    """Scores of every review with digests in place of its text: about a hundred bytes a row.

    Persisted once, it serves the daily table, the queue and the flagged corpus, which then fetch
    only the few texts they show; texts are read and scored a single time. ``digest`` is that of
    the text key, NULL for an empty text; only the queue needs it. ``raw`` is that of the text itself:
    with id, day and ticker it names a review, as ids may repeat.
    """
    facts = ["review_id", "date", "ticker", "score_a", "score_b"]
    raw = _raw_digest(F.col("review_text")).alias("raw")
    if not with_digest:
        return scored.select(*facts, raw)
    key = text_key(F.col("review_text"), compatibility_forms=compatibility_forms)
    keyed = scored.select(*facts, raw, key.alias("key"))
    digest = F.when(F.col("key") != "", F.unhex(F.sha2("key", 256)))
    return keyed.select(*facts, "raw", digest.alias("digest"))


_IDENTITY = ("review_id", "date", "ticker", "raw")


def _with_texts(texts: DataFrame, few: DataFrame) -> DataFrame:
    """Texts of the ``few`` rows of a top-k, whose limit bounds the broadcast; rows that repeat stay.

    Rows meet by id, day and ticker; only the texts that are left are digested and compared.
    """
    others = [c for c in few.columns if c not in _IDENTITY]
    same = few.groupBy(*_IDENTITY, *others).agg(F.count(F.lit(1)).alias("__times"))
    named = same.select(*[F.col(c).alias(f"__{c}") for c in _IDENTITY], *others, "__times")
    match = F.lit(True)
    for c in _IDENTITY[:-1]:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    own = texts.select("review_id", "date", "ticker", "review_text")
    met = own.join(F.broadcast(named), match)
    # the digest in a branch of its own: in the condition of the join it would be worked out for all texts
    raw = F.when(F.col("__times") > 0, _raw_digest(F.col("review_text")))
    found = met.withColumn("raw", raw).where(F.col("raw").eqNullSafe(F.col("__raw"))).drop(*[f"__{c}" for c in _IDENTITY])
    once = first_per_key(found, [*_IDENTITY, *others], [F.lit(1)])
    again = F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))
    return once.withColumn("__n", again).drop("__n", "__times", "raw")


# -- queue of texts on which the scorers disagree ---------------------------------------


def disagreement_queue(
    scored: DataFrame,
    top_k: int = 10,
    *,
    texts: DataFrame | None = None,
    max_chars: int | None = None,
    compatibility_forms: bool = True,
) -> DataFrame:
    """Top-k reviews by score gap with distinct text; ``max_chars`` cuts the text shown.

    Copies combine before the shuffle, as each text is a digest with its best (gap, review);
    only the k winners then fetch their text. ``scored`` may be a :func:`score_table`, with the
    reviews as ``texts``.
    """
    table = scored
    if "digest" not in scored.columns:
        texts = scored
        table = score_table(scored, compatibility_forms=compatibility_forms)
    facts = ["date", "ticker", "score_a", "score_b", "raw"]
    rank = F.struct((-disagreement()).alias("g"), "review_id", *facts)
    # Unscored and empty texts get no rank. Filtering them first would score every text twice,
    # as the filter would be evaluated below the scoring.
    ranked = F.when(F.col("digest").isNotNull() & disagreement().isNotNull(), rank)
    winners = (
        table.select("digest", ranked.alias("rank"))
        .groupBy("digest")
        .agg(F.min("rank").alias("best"))
        .where(F.col("best").isNotNull())
        .orderBy("best")
        .limit(top_k)
        .select("best.*")
    )
    return (
        _with_texts(texts, winners)
        .select(
            "review_id",
            "date",
            "ticker",
            (F.col("review_text") if max_chars is None else F.left("review_text", F.lit(max_chars))).alias("text"),
            "score_a",
            "score_b",
            (-F.col("g")).alias("disagreement"),
        )
        .orderBy(F.desc("disagreement"), "review_id")
        .limit(top_k)
    )


def dedupe_queue(
    queue: DataFrame, text_col: str = "text", order: Sequence[Column] | None = None
) -> DataFrame:
    """Keep the first queue row per text key; rows with an empty key are dropped."""
    order = order or [F.desc("disagreement"), F.col("review_id")]
    keyed = queue.withColumn("__key", text_key(F.col(text_col)))
    # A flag beside the key: a filter on the key itself would sink below the window and work the
    # key out a second time.
    flagged = keyed.withColumn("__empty", F.col("__key") == "")
    kept = first_per_key(flagged, ["__key"], order).where(~F.col("__empty"))
    return kept.drop("__key", "__empty")


def top_disagreement(scored: DataFrame, n: int, *, texts: DataFrame | None = None) -> DataFrame:
    """The n reviews with the largest score gap, repeats included.

    ``scored`` may be a :func:`score_table`, with the reviews as ``texts``.
    """
    top = (
        scored.withColumn("disagreement", disagreement())
        .orderBy(F.desc_nulls_last("disagreement"), "review_id")
        .limit(n)
        .where(F.col("disagreement").isNotNull())
    )
    return top if texts is None else _with_texts(texts, top.drop("digest"))


# -- excerpts of single days ------------------------------------------------------------


def day_excerpts(
    reviews: DataFrame,
    targets: DataFrame,
    *,
    by: Sequence[str] = ("ticker",),
    k: int = 3,
    max_chars: int = 240,
) -> DataFrame:
    """Up to k excerpts of each target day; the day before if the day itself has no review.

    ``targets`` has ``date`` and the ``by`` columns. ``by=[]`` looks at all reviews of the day.
    """
    days = targets.select(*by, F.col("date").alias("target_date")).distinct()
    wanted = days.select(
        *by,
        "target_date",
        F.explode(F.array(F.col("target_date"), F.date_sub("target_date", 1))).alias("date"),
    )
    found = reviews.join(wanted, [*by, "date"], "inner").select(
        *by, "target_date", "date", "review_id", "review_text"
    )
    group = Window.partitionBy(*by, "target_date")
    ordered = group.orderBy(F.desc("date"), "review_id")
    top = found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
    # k rows per target are left, so looking at a whole group is cheap.
    return (
        top.withColumn("__day", F.max("date").over(group))
        .where(F.col("date") == F.col("__day"))
        .select(
            *by,
            "target_date",
            "rank",
            F.col("date").alias("review_date"),
            "review_id",
            excerpt(F.col("review_text"), max_chars).alias("excerpt"),
        )
    )


# -- tail days --------------------------------------------------------------------------


_COARSE, _FINE = 16, 16


def exact_quantiles(
    rows: DataFrame,
    value: str,
    probabilities: Sequence[float],
    *,
    by: Sequence[str] = (),
    accuracy: int = 10_000,
    whole_below: int = 100_000,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group and probability.

    The built-in exact ``percentile`` gathers every distinct value of a group in one task. Here the
    search narrows twice by sketches whose rank error is bounded by 1/accuracy, with exact counts for all
    that is left out. A sketch of all rows brackets each wanted rank. Values inside are counted, so ties
    are one row; a sketch of these distinct values cuts the bracket into 256 parts, the counts of
    which tell the part that holds the rank. Only that part is sorted in one task: about
    8/accuracy/256 of a group's distinct values. Groups of up to ``whole_below`` rows are ranked whole.
    """
    keys = [*by, "q"]
    parts, counts = _counted_parts(rows, value, probabilities, by, accuracy, whole_below)
    before = Window.partitionBy(*keys).orderBy("part")  # 258 parts at most
    cum = F.sum("c").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pos = (F.col("n") - 1) * F.col("p")
    placed = parts.withColumn("start", cum - F.col("c")).withColumns({"i": F.floor(pos), "j": F.ceil(pos)})

    def within(index: str, start: str, c: str) -> Column:
        return (F.col(start) <= F.col(index)) & (F.col(start) + F.col(c) > F.col(index))

    # A rank outside its bracket is an error of the sketch's bound, not a missing value.
    outside = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("int")
    part = F.when(F.col("part").between(0, _COARSE * _FINE), F.col("part")).otherwise(outside).alias("part")
    wanted = placed.where(within("i", "start", "c") | within("j", "start", "c"))
    wanted = wanted.select(*keys, part, "start", "n", "p", "i", "j")
    inside = counts.join(wanted, [*keys, "part"])
    upto = Window.partitionBy(*keys, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("at", F.col("start") + F.sum("c").over(upto) - F.col("c"))

    def at(index: str) -> Column:
        return F.max(F.when(within(index, "at", "c"), F.col("v")))

    frac = F.max(pos - F.floor(pos)).alias("frac")
    picked = ranked.groupBy(*keys, "p", "n").agg(at("i").alias("a"), at("j").alias("b"), frac)
    return picked.select(*by, "q", "p", "n", (F.col("a") + (F.col("b") - F.col("a")) * F.col("frac")).alias("value"))


def _counted_parts(
    rows: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str], accuracy: int, whole_below: int
) -> tuple[DataFrame, DataFrame]:
    """(rows of each part of each bracket as ``c``, distinct values with their counts and part).

    Parts are numbered from 0 inside the bracket; -1 lies below it, one more than the last above it.
    """
    v = F.col(value)
    slack = 4.0 / accuracy
    rows = rows.where(v.isNotNull()).select(*by, v.alias("v"))
    small = F.count(F.lit(1)) <= whole_below
    brackets = []
    for i, p in enumerate(probabilities):
        lo, hi = max(0.0, p - slack), min(1.0, p + slack)
        brackets.append(
            F.struct(
                F.lit(i).alias("q"),
                F.lit(float(p)).alias("p"),
                F.count(F.lit(1)).alias("n"),
                F.when(small | (lo == 0.0), F.min("v")).otherwise(F.percentile_approx("v", lo, accuracy)).alias("lo"),
                F.when(small | (hi == 1.0), F.max("v")).otherwise(F.percentile_approx("v", hi, accuracy)).alias("hi"),
            )
        )
    sketch = rows.groupBy(*by).agg(F.array(*brackets).alias("b"))
    if by:
        each = rows.join(sketch, list(by), "inner").select(*by, "v", F.inline("b"))
    else:
        each = rows.select("v", F.inline(sketch.scalar()))
    # Values outside the bracket collapse to one row per group and side.
    last = _COARSE * _FINE
    side = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), last + 1).otherwise(0)
    keys = [*by, "q"]
    counts = (
        each.withColumn("side", side)
        .withColumn("v", F.when(F.col("side") == 0, F.col("v")))
        .groupBy(*keys, "p", "n", "side", "v")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    # Bounds of the parts, as values, so that they mean the same wherever they are used.
    steps = [i / last for i in range(1, last)]
    large = F.when((F.col("side") == 0) & (F.col("n") > whole_below), F.col("v"))
    bounds = counts.groupBy(*keys).agg(F.percentile_approx(large, steps, accuracy).alias("bounds"))

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda b: b < F.col("v")))

    every = F.transform(F.sequence(F.lit(1), F.lit(_COARSE - 1)), lambda k: F.get(F.col("bounds"), k * _FINE - 1))
    located = counts.join(bounds, keys).withColumn("coarse", F.when(F.col("bounds").isNotNull(), below(every)))
    fine = below(F.slice("bounds", F.col("coarse") * _FINE + 1, F.lit(_FINE)))
    part = F.when((F.col("side") == 0) & F.col("bounds").isNotNull(), F.col("coarse") * _FINE + fine)
    located = located.withColumn("part", F.coalesce(part, F.col("side"))).drop("bounds", "coarse", "side")
    parts = located.groupBy(*keys, "p", "n", "part").agg(F.sum("c").alias("c"))
    return parts, located.where(F.col("v").isNotNull()).drop("p", "n")


def return_tails(reg: DataFrame, quantile: float = 0.1, by: Sequence[str] = ()) -> DataFrame:
    """Low and high return quantile of the regression rows."""
    q = exact_quantiles(reg, "ret", [quantile, 1.0 - quantile], by=by)
    return q.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.max(F.when(F.col("q") == 0, F.col("value"))).alias("q_low"),
        F.max(F.when(F.col("q") == 1, F.col("value"))).alias("q_high"),
    )


def tail_days(reg: DataFrame, quantile: float = 0.1, by: Sequence[str] = ()) -> DataFrame:
    """Distinct (date, ticker) whose return lies at or beyond either quantile."""
    tails = return_tails(reg, quantile, by)
    rows = reg.where(F.col("ret").isNotNull()).select("date", "ticker", "ret")
    if by:
        rows = rows.join(tails, list(by), "inner")
    else:
        one = tails.select(F.struct("q_low", "q_high")).scalar()
        rows = rows.select("*", F.inline(F.array(one)).alias("q_low", "q_high"))
    beyond = (F.col("ret") <= F.col("q_low")) | (F.col("ret") >= F.col("q_high"))
    return rows.where(beyond).select("date", "ticker").distinct()


def reviews_on_days(reviews: DataFrame, days: DataFrame) -> DataFrame:
    """Reviews whose (date, ticker) is among ``days``."""
    return reviews.join(days, ["date", "ticker"], "left_semi")


def fixed_sample(df: DataFrame, n: int, *, seed: int = TAIL_SEED, id_col: str = "review_id") -> DataFrame:
    """Repeatable sample of n rows: those with the smallest seeded hash of their id."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.orderBy(h, id_col).limit(n)


def tail_reviews(
    reviews: DataFrame,
    reg: DataFrame,
    *,
    quantile: float = 0.1,
    max_reviews: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Reviews of the tail days; ``max_reviews`` takes a fixed sample of them.

    With a costly scorer, pass unscored reviews and score the result.
    """
    rows = reviews_on_days(reviews, tail_days(reg, quantile, by))
    return rows if max_reviews is None else fixed_sample(rows, max_reviews)


# -- flagged corpus ---------------------------------------------------------------------

_CORPUS_KEYS = ("review_text", "date", "ticker")


def _corpus_order() -> list[Column]:
    return [
        F.when(F.col("slice") == "disagreement", 0).otherwise(1),
        F.desc_nulls_last("disagreement"),
        F.col("review_id"),
    ]


def corpus_slices(
    scored: DataFrame,
    reg: DataFrame,
    *,
    texts: DataFrame | None = None,
    top_n: int = 80,
    quantile: float = 0.1,
    max_tail_reviews: int | None = None,
) -> DataFrame:
    """High-disagreement reviews and tail-day reviews, marked by ``slice``; may overlap.

    Tail-day reviews carry no scores, so they need no scoring. ``scored`` may be a
    :func:`score_table`, with the reviews as ``texts``.
    """
    high = top_disagreement(scored, top_n, texts=texts).withColumn("slice", F.lit("disagreement"))
    plain = (scored if texts is None else texts).select("review_id", "date", "ticker", "review_text")
    tail = tail_reviews(plain, reg, quantile=quantile, max_reviews=max_tail_reviews)
    return high.unionByName(tail.withColumn("slice", F.lit("tail")), allowMissingColumns=True)


def flagged_corpus(
    scored: DataFrame,
    reg: DataFrame,
    *,
    texts: DataFrame | None = None,
    top_n: int = 80,
    quantile: float = 0.1,
    max_tail_reviews: int | None = None,
) -> DataFrame:
    """Both slices, one row per (text, date, ticker); the disagreement row wins."""
    both = corpus_slices(
        scored,
        reg,
        texts=texts,
        top_n=top_n,
        quantile=quantile,
        max_tail_reviews=max_tail_reviews,
    )
    return first_per_key(both, _CORPUS_KEYS, _corpus_order())


def corpus_provenance(slices: DataFrame, *, quantile: float = 0.1) -> DataFrame:
    """How many reviews each slice brought and how many stayed after removing repeats."""
    # The rows kept beside all rows: ranking every row would gather a much-copied text in one task.
    kept_rows = first_per_key(slices, _CORPUS_KEYS, _corpus_order())
    marked = slices.select("slice", F.lit(False).alias("kept")).union(
        kept_rows.select("slice", F.lit(True))
    )
    counts = marked.agg(
        F.count_if((F.col("slice") == "disagreement") & ~F.col("kept")).alias("n_disagreement"),
        F.count_if((F.col("slice") == "tail") & ~F.col("kept")).alias("n_tail"),
        F.count_if((F.col("slice") == "disagreement") & F.col("kept")).alias("kept_disagreement"),
        F.count_if((F.col("slice") == "tail") & F.col("kept")).alias("kept_tail"),
    )
    lo, hi = round(quantile * 100), round((1 - quantile) * 100)
    high_bit = F.when(
        F.col("n_disagreement") > 0, F.format_string("top %d by score gap", F.col("n_disagreement"))
    )
    tail_bit = F.when(F.col("n_tail") > 0, F.lit(f"reviews on {lo}% / {hi}% return tails"))
    only_tail = F.when(
        F.col("n_disagreement") == 0, F.lit(" (second scorer off: no disagreement slice)")
    ).otherwise(F.lit(""))
    source = F.when(high_bit.isNull() & tail_bit.isNull(), F.lit("no corpus")).otherwise(
        F.concat(F.concat_ws(" plus ", high_bit, tail_bit), only_tail)
    )
    return counts.withColumn("source", source)
