"""Bring raw review and market tables into canonical form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.functions.dates import as_day
from moodtide.functions.numeric import to_number


def _blank(c: Column) -> Column:
    t = F.trim(c.cast("string"))
    return c.isNull() | (t == "") | (F.lower(t) == "nan")


def _fullest_first(df: DataFrame, cols: Sequence[str]) -> Column:
    """Positions of ``cols``, most characters first; one aggregate over the table, used as a scalar."""
    # A missing cell counts as the three characters of "nan".
    sizes = [
        F.struct(
            (-F.sum(F.coalesce(F.length(F.col(c)), F.lit(3)))).alias("chars"),
            (-F.count(F.col(c))).alias("filled"),
            F.lit(i).alias("i"),
        )
        for i, c in enumerate(cols)
    ]
    return df.agg(F.transform(F.array_sort(F.array(*sizes)), lambda s: s["i"]).alias("o")).scalar()


def merge_collisions(df: DataFrame, *, text_name: str = "review_text") -> DataFrame:
    """Merge columns that share a name, left to right; names that differ in case only are the same.

    For the text column the column with the most characters comes first and blanks are filled
    from the others.
    """
    names = df.columns
    folded = [n.lower() for n in names]
    if len(set(folded)) == len(names):
        return df
    unique = [f"__{i}" for i in range(len(names))]
    flat = df.toDF(*unique)
    out = []
    for low in dict.fromkeys(folded):
        same = [u for u, n in zip(unique, folded) if n == low]
        # the spelling of the canonical name if one column has it, else that of the first
        spelled = [n for n in names if n.lower() == low]
        name = low if low in spelled else spelled[0]
        if len(same) == 1:
            out.append(F.col(same[0]).alias(name))
        elif name != text_name:
            out.append(F.coalesce(*same).alias(name))
        else:
            order = f"__order_{len(out)}"
            flat = flat.withColumn(order, _fullest_first(flat, same))
            values = F.transform(F.col(order), lambda i: F.get(F.array(*same), i))
            first = F.get(F.filter(values, lambda v: ~_blank(v)), F.lit(0))
            out.append(F.coalesce(first, F.element_at(values, -1)).alias(name))
    return flat.select(*out)


def _renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Positional rename, so a rename may collide with an existing column."""
    return df.toDF(*[mapping.get(c, c) for c in df.columns])


def prepare_reviews(
    df: DataFrame,
    date_col: str = "date",
    text_col: str = "review_text",
    ticker_col: str = "ticker",
    id_col: str | None = "review_id",
) -> DataFrame:
    """Canonical reviews: day, text and ticker present; other columns pass through.

    Ties later on are settled by ``review_id``. If the input has no such column, a digest of the
    row stands in for it, which does not change with the layout of the files; rows that agree in
    every column share it.
    """
    missing = [c for c in (date_col, text_col, ticker_col) if c not in df.columns]
    if missing:
        raise ValueError(f"reviews lack columns {missing}; found {df.columns}")
    mapping = {date_col: "date", text_col: "review_text", ticker_col: "ticker"}
    if id_col and id_col in df.columns:
        mapping[id_col] = "review_id"
    out = merge_collisions(_renamed(df, mapping))
    out = out.withColumns(
        {
            "date": as_day(F.col("date"), dict(out.dtypes)["date"]),
            "ticker": F.col("ticker").cast("string"),
        }
    ).na.drop(subset=["date", "review_text", "ticker"])
    if "review_id" not in out.columns:
        out = out.withColumn("review_id", F.sha2(F.to_json(F.struct(*out.columns)), 256))
    return out


def prepare_market(
    df: DataFrame, date_col: str = "date", ticker_col: str = "ticker", ret_col: str = "ret"
) -> DataFrame:
    """Canonical returns: lower-case names, day, numeric return; unusable rows dropped."""
    out = df.toDF(*[c.strip().lower() for c in df.columns])
    d, t, r = (c.strip().lower() for c in (date_col, ticker_col, ret_col))
    missing = [c for c in (d, t, r) if c not in out.columns]
    if missing:
        raise ValueError(f"market table lacks columns {missing}; found {out.columns}")
    out = merge_collisions(_renamed(out, {d: "date", t: "ticker", r: "ret"}))
    return out.withColumns(
        {
            "date": as_day(F.col("date"), dict(out.dtypes)["date"]),
            "ticker": F.col("ticker").cast("string"),
            "ret": to_number(F.col("ret")),
        }
    ).na.drop(subset=["date", "ticker", "ret"])
