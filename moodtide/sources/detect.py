"""Guess which columns hold the date, the text, the ticker and the return."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.functions.dates import as_day
from moodtide.functions.numeric import to_number

# Column names that point to a role.
DATE_HINTS = ("date", "time", "created", "created_at", "timestamp", "review_date", "posted", "dt")
TEXT_HINTS = ("review_text", "text", "body", "content", "comment", "review", "message")
TICKER_HINTS = ("ticker", "symbol", "sym", "stock", "tick")
RETURN_HINTS = ("ret", "return", "daily_return", "log_ret", "pct_return")

# Parts of names that point to a role.
DATE_PARTS = ("date", "time", "created")
TEXT_PARTS = ("text", "body", "review", "comment")
TICKER_PARTS = ("symbol", "ticker")
RETURN_PARTS = ("return",)

LOW_CONFIDENCE = 0.42


@dataclass(frozen=True)
class ReviewColumns:
    date_col: str
    text_col: str
    ticker_col: str
    confidence: float

    @property
    def uncertain(self) -> bool:
        return self.confidence < LOW_CONFIDENCE


@dataclass(frozen=True)
class MarketColumns:
    date_col: str
    ticker_col: str
    ret_col: str
    confidence: float

    @property
    def uncertain(self) -> bool:
        return self.confidence < LOW_CONFIDENCE


def normalise_name(name: str) -> str:
    return str(name).strip().lower().replace(" ", "_")


def _hinted(name: str, exact: Sequence[str], parts: Sequence[str]) -> bool:
    n = normalise_name(name)
    return n in exact or any(p in n for p in parts)


def _middle_below(value: Column, limit: float, *, inclusive: bool) -> Column:
    """Whether the median of ``value`` lies below ``limit``, from counts and the values next to it."""
    low = value <= limit if inclusive else value < limit
    n, below = F.count(value), F.count_if(low)
    middle = (F.max(F.when(low, value)) + F.min(F.when(~low, value))) / 2
    halved = middle <= limit if inclusive else middle < limit
    return F.when(below * 2 > n, True).when((below * 2 == n) & (n > 0), F.coalesce(halved, F.lit(False))).otherwise(False)


# Distinct values up to which a column may still be a ticker, and the size of the set that counts them.
_FEW = 50
_SET_BITS = 9


def _distinct_values(text: Column) -> Column:
    """Number of distinct values, exact up to 512 and about right beyond.

    A theta sketch is the set of hashes itself until it is full: a bounded set that merges, so
    rows are not copied once for each column as by ``count(DISTINCT)``.
    """
    return F.round(F.theta_sketch_estimate(F.theta_sketch_agg(F.when(text.isNotNull(), F.xxhash64(text)), _SET_BITS))).cast("long")


def _statistics(column: str, data_type: str) -> Column:
    """What the whole column shows, as one struct of aggregates."""
    c = F.col(column)
    text = c.cast("string")
    number = to_number(c)
    length = F.length(text).cast("double")
    if data_type == "string":
        is_text = F.count(c) != F.count(F.when(c.isNotNull(), c.try_cast("double")))
    else:
        is_text = F.lit(False)
    # only days that preparation can read count as dates
    day = as_day(c, data_type)
    size = F.abs(number)
    return F.struct(
        F.coalesce(F.avg(day.isNotNull().cast("double")), F.lit(0.0)).alias("date_rate"),
        is_text.alias("is_text"),
        F.avg(length).alias("mean_len"),
        F.count(text).alias("filled"),
        _distinct_values(text).alias("n_values"),
        _middle_below(length, 6, inclusive=True).alias("short"),
        F.coalesce(F.avg(number.isNotNull().cast("double")), F.lit(0.0)).alias("num_rate"),
        _middle_below(size, 0.5, inclusive=False).alias("small"),
    )


def column_scores(df: DataFrame) -> DataFrame:
    """One row per column: how much it looks like a date, text, ticker and return column.

    One aggregation over the whole table; its one row is turned into a row per column.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    flat = df.toDF(*names)
    kinds = [t for _, t in flat.dtypes]
    all_stats = flat.agg(*[_statistics(n, t).alias(n) for n, t in zip(names, kinds)])

    def described(i: int) -> Column:
        name = df.columns[i]
        return F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("name"),
            F.col(names[i]).alias("s"),
            F.lit(_hinted(name, DATE_HINTS, DATE_PARTS)).alias("h_date"),
            F.lit(_hinted(name, TEXT_HINTS, TEXT_PARTS)).alias("h_text"),
            F.lit(_hinted(name, TICKER_HINTS, TICKER_PARTS)).alias("h_ticker"),
            F.lit(_hinted(name, RETURN_HINTS, RETURN_PARTS)).alias("h_ret"),
        )

    each = all_stats.select(F.inline(F.array(*[described(i) for i in range(len(names))])))

    def bonus(flag: Column, points: float) -> Column:
        return F.when(flag, points).otherwise(0.0)

    s = F.col("s")
    few = (s["n_values"] >= 1) & (s["n_values"] <= F.least(F.lit(_FEW), s["filled"]))
    date_score = s["date_rate"] * 3 + bonus(F.col("h_date"), 2.0)
    text_score = F.when(
        s["is_text"], F.least(s["mean_len"] / 30, F.lit(4.0)) + bonus(F.col("h_text"), 3.0)
    ).otherwise(0.0)
    ticker_score = F.when(
        s["filled"] > 0, 1.0 + bonus(few, 2.0) + bonus(s["short"], 1.0) + bonus(F.col("h_ticker"), 3.0)
    ).otherwise(0.0)
    ret_score = F.when(
        s["num_rate"] >= 0.5, s["num_rate"] * 2 + bonus(s["small"], 1.0) + bonus(F.col("h_ret"), 3.0)
    ).otherwise(0.0)
    return each.select(
        "position",
        "name",
        date_score.alias("date_score"),
        text_score.alias("text_score"),
        ticker_score.alias("ticker_score"),
        ret_score.alias("ret_score"),
    )


def _best(rows, score: str, exclude: Sequence[str] = ()) -> str | None:
    """Highest score; the leftmost column wins ties."""
    left = [r for r in rows if r["name"] not in exclude]
    return max(left, key=lambda r: r[score])["name"] if left else None


def infer_review_columns(
    df: DataFrame,
    *,
    date_col: str | None = None,
    text_col: str | None = None,
    ticker_col: str | None = None,
) -> ReviewColumns:
    """Date, text and ticker columns with a confidence in [0, 1]; named columns override."""
    if not df.columns:
        return ReviewColumns("date", "review_text", "ticker", 0.0)
    rows = column_scores(df).orderBy("position").collect()
    d, t, k = (_best(rows, s) for s in ("date_score", "text_score", "ticker_score"))
    if len({d, t, k}) < 3:
        t = _best(rows, "text_score", exclude=(d, k)) or t
        k = _best(rows, "ticker_score", exclude=(d, t)) or k
    by_name = {r["name"]: r for r in reversed(rows)}
    total = by_name[d]["date_score"] + by_name[t]["text_score"] + by_name[k]["ticker_score"]
    guess = ReviewColumns(d, t, k, min(1.0, total / 18.0))
    chosen = {"date_col": date_col, "text_col": text_col, "ticker_col": ticker_col}
    return replace(guess, **{n: v for n, v in chosen.items() if v})


def infer_market_columns(
    df: DataFrame,
    *,
    date_col: str | None = None,
    ticker_col: str | None = None,
    ret_col: str | None = None,
) -> MarketColumns:
    """Date, ticker and return columns with a confidence in [0, 1]; named columns override."""
    if not df.columns:
        return MarketColumns("date", "ticker", "ret", 0.0)
    rows = column_scores(df).orderBy("position").collect()
    d, k = _best(rows, "date_score"), _best(rows, "ticker_score")
    r = _best(rows, "ret_score", exclude=(d, k)) or _best(rows, "ret_score")
    by_name = {x["name"]: x for x in reversed(rows)}
    total = by_name[d]["date_score"] + by_name[k]["ticker_score"] + by_name[r]["ret_score"]
    guess = MarketColumns(d, k, r, min(1.0, total / 15.0))
    chosen = {"date_col": date_col, "ticker_col": ticker_col, "ret_col": ret_col}
    return replace(guess, **{n: v for n, v in chosen.items() if v})
