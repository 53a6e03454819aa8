"""Correlation, robust regression, chronological holdout and stability paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from moodtide.functions.numeric import (
    MIN_SD,
    Z_95,
    finite_or_null,
    pearson,
    two_sided_normal_p,
)

# A point whose leverage is this close to 1 leaves no residual to scale.
MAX_LEVERAGE = 1 - 1e-12


def _need_entity(by: Sequence[str]) -> None:
    if not by:
        raise ValueError("an ordered series needs at least one entity column in `by`")


def _attach(df: DataFrame, per_group: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Put per-group values on every row: a join by key, or scalars when there is one group.

    The join carries no hint; Spark broadcasts the summary only if its measured size is small.
    """
    if by:
        return df.join(per_group.select(*by, *columns), list(by), "inner")
    # Inlined as one generator, the subquery appears once in the plan, not once per column.
    one = per_group.select(F.struct(*columns)).scalar()
    return df.select(*df.columns, F.inline(F.array(one)).alias(*columns))


# -- correlation ------------------------------------------------------------------------


def correlations(reg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lag-1 correlation of each score with the return, pooled or per entity."""
    return reg.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        pearson(F.col("avg_a_lag1"), F.col("ret")).alias("r_a"),
        pearson(F.col("avg_b_lag1"), F.col("ret")).alias("r_b"),
    )


# -- least squares ----------------------------------------------------------------------


def _moments(x: Column, y: Column) -> list[Column]:
    """Centred sums for a straight-line fit; rows with a NULL on either side must be NULL on both."""
    n = F.count(x + y)
    return [
        n.alias("n"),
        F.avg(x).alias("mx"),
        F.avg(y).alias("my"),
        (F.var_pop(x) * n).alias("sxx"),
        (F.var_pop(y) * n).alias("syy"),
        (F.covar_pop(x, y) * n).alias("sxy"),
        F.stddev_samp(x).alias("sd_x"),
        F.stddev_samp(y).alias("sd_y"),
    ]


_FIT = ("n", "mx", "my", "sxx", "syy", "sxy", "sd_x", "sd_y")


def _varies() -> Column:
    return (F.col("sd_x") >= MIN_SD) & (F.col("sd_y") >= MIN_SD)


def _slope() -> Column:
    return F.col("sxy") / F.col("sxx")


def _robust_parts(x: Column, y: Column, where: Column | None = None) -> list[Column]:
    """Second pass of the HC3 fit: sums of scaled squared residuals."""
    dx = x - F.col("mx")
    e = y - F.col("my") - _slope() * dx
    lev = F.lit(1.0) / F.col("n") + dx * dx / F.col("sxx")
    meat = F.when(lev < MAX_LEVERAGE, dx * dx * e * e / ((1 - lev) * (1 - lev)))
    sse = e * e
    if where is not None:
        lev, meat, sse = (F.when(where, c) for c in (lev, meat, sse))
    return [
        F.max(lev).alias("max_lev"),
        F.sum(meat).alias("meat"),
        F.sum(sse).alias("sse"),
    ]


def _std_err() -> Column:
    return F.when(F.col("max_lev") < MAX_LEVERAGE, F.sqrt(F.col("meat")) / F.col("sxx"))


def ols_hc3(
    reg: DataFrame,
    x: str = "avg_a_lag1",
    y: str = "ret",
    *,
    by: Sequence[str] = ("ticker",),
    min_obs: int = 8,
    p_value: bool = True,
) -> DataFrame:
    """Straight-line fit ``y ~ x`` with HC3 standard error, one row per entity.

    Two aggregation passes: centred moments, then leverage-scaled residuals. Entities with too
    few rows, a constant side or a non-finite result are left out.
    """
    rows = reg.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *by, F.col(x).alias("x"), F.col(y).alias("y")
    )
    fit = rows.groupBy(*by).agg(*_moments(F.col("x"), F.col("y")))
    usable = fit.where((F.col("n") >= min_obs) & _varies())
    passed = _attach(rows, usable, by, _FIT)
    second = passed.groupBy(*by, *_FIT).agg(*_robust_parts(F.col("x"), F.col("y")))
    if not by:
        second = second.where(F.col("n").isNotNull())
    out = second.select(
        *by,
        F.lit(x).alias("x_col"),
        "n",
        _slope().alias("coef"),
        (F.col("my") - _slope() * F.col("mx")).alias("intercept"),
        finite_or_null(_std_err()).alias("std_err"),
        (1 - F.col("sse") / F.col("syy")).alias("r2"),
    )
    out = out.select(
        *by,
        "x_col",
        "n",
        "coef",
        "intercept",
        "std_err",
        (F.col("coef") - Z_95 * F.col("std_err")).alias("ci_low"),
        (F.col("coef") + Z_95 * F.col("std_err")).alias("ci_high"),
        "r2",
    )
    finite = [finite_or_null(F.col(c)).isNotNull() for c in ("coef", "ci_low", "ci_high", "r2")]
    out = out.where(finite[0] & finite[1] & finite[2] & finite[3])
    if p_value:
        z = F.try_divide(F.col("coef"), F.col("std_err"))
        out = out.withColumn("p_value", two_sided_normal_p(z)).where(F.col("p_value").isNotNull())
    return out


def trend_line(
    reg: DataFrame,
    x: str = "avg_a_lag1",
    y: str = "ret",
    *,
    by: Sequence[str] = ("ticker",),
    points: int = 60,
    min_obs: int = 3,
) -> DataFrame:
    """Least-squares line sampled on an even grid between the smallest and largest x."""
    rows = reg.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    fit = rows.groupBy(*by).agg(
        *_moments(F.col(x), F.col(y)), F.min(x).alias("lo"), F.max(x).alias("hi")
    )
    usable = fit.where((F.col("n") >= min_obs) & (F.col("sd_x") >= MIN_SD))
    grid = usable.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    gx = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / F.lit(float(points - 1))
    return grid.select(
        *by,
        "point",
        gx.alias("x"),
        (F.col("my") + _slope() * (gx - F.col("mx"))).alias("y"),
    )


# -- chronological holdout --------------------------------------------------------------


def time_split(
    rows: DataFrame,
    *,
    by: Sequence[str] = ("ticker",),
    holdout_frac: float = 0.2,
    min_train: int = 25,
    min_holdout: int = 8,
) -> DataFrame:
    """Mark the last rows of every entity as holdout; entities that are too short are dropped."""
    _need_entity(by)
    order = Window.partitionBy(*by).orderBy("date", "ret")
    numbered = rows.withColumns(
        {
            "pos": F.row_number().over(order),
            "n_rows": F.count(F.lit(1)).over(Window.partitionBy(*by)),
        }
    ).where(F.col("n_rows") >= min_train + min_holdout)
    wanted = F.greatest(F.lit(min_holdout), F.ceil(F.col("n_rows") * F.lit(float(holdout_frac))))
    h = F.least(wanted, F.col("n_rows") - min_train)
    return numbered.withColumn("is_train", F.col("pos") <= F.col("n_rows") - h)


def holdout_eval(
    reg: DataFrame,
    x: str = "avg_a_lag1",
    y: str = "ret",
    *,
    by: Sequence[str] = ("ticker",),
    holdout_frac: float = 0.2,
    min_train: int = 25,
    min_holdout: int = 8,
    p_value: bool = True,
) -> DataFrame:
    """Fit on the early rows, test on the latest: error and predicted-vs-actual correlation."""
    rows = reg.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *by, "date", "ret", F.col(x).alias("x"), F.col(y).alias("y")
    )
    split = time_split(
        rows, by=by, holdout_frac=holdout_frac, min_train=min_train, min_holdout=min_holdout
    ).select(*by, "date", "x", "y", "is_train")
    train = F.col("is_train")
    fit = split.groupBy(*by).agg(*_moments(F.when(train, F.col("x")), F.when(train, F.col("y"))))
    passed = _attach(split, fit.where(_varies()), by, _FIT)

    held = ~train
    pred = F.when(held, F.col("my") + _slope() * (F.col("x") - F.col("mx")))
    actual = F.when(held, F.col("y"))
    second = passed.groupBy(*by, *_FIT).agg(
        *_robust_parts(F.col("x"), F.col("y"), where=train),
        F.count(actual).alias("n_holdout"),
        F.max(F.when(held, F.col("date"))).alias("holdout_last_date"),
        F.sqrt(F.avg((actual - pred) * (actual - pred))).alias("rmse_holdout"),
        F.stddev_pop(pred).alias("sd_pred"),
        F.stddev_pop(actual).alias("sd_actual"),
        F.covar_pop(pred, actual).alias("cov_pred"),
    )
    corr = F.when(
        (F.col("n_holdout") >= 3) & (F.col("sd_pred") > 1e-12) & (F.col("sd_actual") > 1e-12),
        finite_or_null(F.try_divide(F.col("cov_pred"), F.col("sd_pred") * F.col("sd_actual"))),
    )
    out = second.select(
        *by,
        F.lit(x).alias("x_col"),
        F.col("n").alias("n_train"),
        "n_holdout",
        "holdout_last_date",
        _slope().alias("coef"),
        finite_or_null(_std_err()).alias("std_err"),
        (1 - F.col("sse") / F.col("syy")).alias("r2_train"),
        corr.alias("corr_pred_actual"),
        "rmse_holdout",
    ).where(F.col("std_err").isNotNull() & finite_or_null(F.col("coef")).isNotNull())
    if p_value:
        z = F.try_divide(F.col("coef"), F.col("std_err"))
        out = out.withColumn("p_value", two_sided_normal_p(z)).where(F.col("p_value").isNotNull())
    return out


# -- stability paths --------------------------------------------------------------------


def _series(by: Sequence[str]) -> WindowSpec:
    _need_entity(by)
    return Window.partitionBy(*by).orderBy("date", "ret")


def _up_to_now(by: Sequence[str]) -> WindowSpec:
    return _series(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _last_rows(by: Sequence[str], window: int) -> WindowSpec:
    return _series(by).rowsBetween(-(window - 1), Window.currentRow)


def expanding_corr(
    reg: DataFrame,
    x: str = "avg_a_lag1",
    y: str = "ret",
    *,
    by: Sequence[str] = ("ticker",),
    min_rows: int = 15,
) -> DataFrame:
    """Correlation of everything up to each day; NULL before ``min_rows`` points.

    ``by=[]`` pools all entities in the order of day, return, entity and score.
    """
    rows = reg.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if not by:
        return _pooled_paths(rows, {"expanding_r": (x, "expanding")}, y, 0, min_rows).select("date", "expanding_r")
    r = pearson(F.col(x), F.col(y), min_pairs=min_rows, over=_up_to_now(by))
    return rows.withColumn("expanding_r", r).select(*by, "date", "expanding_r")


def rolling_corr(
    reg: DataFrame,
    x: str = "avg_a_lag1",
    y: str = "ret",
    *,
    by: Sequence[str] = ("ticker",),
    window: int = 20,
    min_rows: int = 15,
) -> DataFrame:
    """Correlation of the last ``window`` rows; NULL when fewer than ``min_rows`` points.

    ``by=[]`` pools all entities in the order of day, return, entity and score.
    """
    rows = reg.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if not by:
        return _pooled_paths(rows, {"rolling_r": (x, "rolling")}, y, window, min_rows).select("date", "rolling_r")
    r = pearson(F.col(x), F.col(y), min_pairs=min_rows, over=_last_rows(by, window))
    return rows.withColumn("rolling_r", r).select(*by, "date", "rolling_r")


# Rows of a pooled series that one task follows.
_CHUNK_ROWS = 4096


def _pooled_paths(
    rows: DataFrame, paths: Mapping[str, tuple[str, str]], y: str, window: int, min_rows: int, chunk: int = _CHUNK_ROWS
) -> DataFrame:
    """``rows`` with paths over all entities: name -> (score column, "expanding" or "rolling").

    One ordered window over everything would be one task. Expanding paths add prefix sums instead: moments
    around the overall means are summed up by day, the sums of all days before are carried to each day, and only
    the rows of a day are summed up in order. Rolling paths cut the series into chunks by position, each
    with a copy of the rows that its first windows reach back to. Rows of one day go by return, entity and scores.
    """
    xs = list(dict.fromkeys(x for x, _ in paths.values()))
    order = [y, "ticker", *xs]
    of_day = Window.partitionBy("date").orderBy(*order)
    up_to = of_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn("__k", F.lit(1).cast("long"))
    sums = ["__k"]
    expanding = [x for x, kind in paths.values() if kind == "expanding"]
    for i, x in enumerate(expanding):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        means = rows.agg(F.struct(F.avg(F.when(both, F.col(x))).alias("x"), F.avg(F.when(both, F.col(y))).alias("y")))
        centre = means.scalar()
        dx, dy = F.col(x) - centre["x"], F.col(y) - centre["y"]
        moments = {"n": F.lit(1.0), "x": dx, "y": dy, "xx": dx * dx, "yy": dy * dy, "xy": dx * dy}
        named = {f"__{m}{i}": F.coalesce(F.when(both, v), F.lit(0.0)) for m, v in moments.items()}
        numbered = numbered.withColumns(named)
        sums += list(named)
    days = numbered.groupBy("date").agg(*[F.sum(c).alias(c) for c in sums])
    past = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)  # one row a day
    carried = days.select("date", *[F.coalesce(F.sum(c).over(past), F.lit(0)).alias(f"{c}_before") for c in sums])
    out = numbered.join(carried, "date")
    out = out.withColumns({c: F.sum(c).over(up_to) + F.col(f"{c}_before") for c in sums})
    for name, (x, kind) in paths.items():
        if kind == "expanding":
            n, sx, sy, sxx, syy, sxy = (F.col(f"__{m}{expanding.index(x)}") for m in ("n", "x", "y", "xx", "yy", "xy"))
            free = F.nullif(F.greatest(n - 1, F.lit(0.0)), F.lit(0.0))
            # rounding may leave a constant side a little below zero
            vx, vy = (F.greatest((q - s * s / n) / free, F.lit(0.0)) for q, s in ((sxx, sx), (syy, sy)))
            sd = F.sqrt(vx) * F.sqrt(vy)
            usable = (n >= min_rows) & (F.sqrt(vx) >= MIN_SD) & (F.sqrt(vy) >= MIN_SD)
            out = out.withColumn(name, F.when(usable, finite_or_null(F.try_divide((sxy - sx * sy / n) / free, sd))))
    rolling = {name: x for name, (x, kind) in paths.items() if kind == "rolling"}
    if rolling:
        size = max(chunk, 2 * window)
        place = F.col("__k") - 1
        own = out.withColumns({"__chunk": F.floor(place / size), "__copy": F.lit(False)})
        reach = own.where(place % size > size - window)
        reach = reach.withColumns({"__chunk": F.col("__chunk") + 1, "__copy": F.lit(True)})
        last = Window.partitionBy("__chunk").orderBy("__k").rowsBetween(-(window - 1), Window.currentRow)
        both = own.unionByName(reach)
        out = both.withColumns({name: pearson(F.col(x), F.col(y), min_pairs=min_rows, over=last) for name, x in rolling.items()})
        out = out.where(~F.col("__copy"))
    return out


def stability_frame(
    reg: DataFrame,
    *,
    by: Sequence[str] = ("ticker",),
    window: int = 20,
    min_rows: int = 15,
) -> DataFrame:
    """Expanding and rolling correlation of both scores, one row per day of each entity.

    All four paths share one sort. Rows where the second score is missing keep their place
    with a NULL for it. ``by=[]`` pools all entities, day by day.
    """
    base = reg.where(F.col("avg_a_lag1").isNotNull() & F.col("ret").isNotNull())
    if not by:
        kinds = {f"{kind}_{s}": (f"avg_{s}_lag1", kind) for s in ("a", "b") for kind in ("expanding", "rolling")}
        out = _pooled_paths(base, kinds, "ret", window, min_rows)
        masked = [F.when(F.col(x).isNotNull(), F.col(p)).alias(p) for p, (x, _) in kinds.items()]
        return out.select("date", "ticker", "ret", "avg_a_lag1", *masked)
    wide, recent = _up_to_now(by), _last_rows(by, window)
    y = F.col("ret")
    paths = {}
    for s in ("a", "b"):
        x = F.col(f"avg_{s}_lag1")
        for name, frame in (("expanding", wide), ("rolling", recent)):
            r = pearson(x, y, min_pairs=min_rows, over=frame)
            paths[f"{name}_{s}"] = F.when(x.isNotNull(), r)
    return base.withColumns(paths).select(
        *dict.fromkeys([*by, "date", "ticker"]), "ret", "avg_a_lag1", *paths
    )


def stability_endpoints(stability: DataFrame, by: Sequence[str] = ("ticker",)) -> DataFrame:
    """Last day of each stability path with its four values."""
    cols = ("date", "expanding_a", "rolling_a", "expanding_b", "rolling_b")
    last = F.max_by(F.struct(*cols), F.struct("date", "ret")).alias("last")
    return stability.groupBy(*by).agg(last).select(
        *by, F.col("last.date").alias("last_date"), *[f"last.{c}" for c in cols[1:]]
    )


def stability_spread(stability: DataFrame, by: Sequence[str] = ("ticker",)) -> DataFrame:
    """End gap between rolling and expanding r, and the sd of rolling r; needs three points."""
    return stability.groupBy(*by).agg(*stability_spread_columns())


def stability_spread_columns() -> list[Column]:
    both = F.col("rolling_a").isNotNull() & F.col("expanding_a").isNotNull()
    gap = F.abs(F.col("rolling_a") - F.col("expanding_a"))
    n = F.count(F.when(both, F.lit(1)))
    return [
        n.alias("n_points"),
        F.when(n >= 3, F.max_by(gap, F.when(both, F.struct("date", "ret")))).alias("end_gap"),
        F.when(n >= 3, F.stddev_samp(F.when(both, F.col("rolling_a")))).alias("rolling_sd"),
    ]


# -- early against late -----------------------------------------------------------------


def _halves(
    rows: DataFrame, by: Sequence[str], value: Column, parts: int, min_rows: int
) -> DataFrame:
    """Mean of ``value`` over the first and the last n/parts rows (at least 3) of each entity."""
    _need_entity(by)
    per = Window.partitionBy(*by)
    numbered = rows.select(*by, "date", "ret", value.alias("v")).withColumns(
        {"pos": F.row_number().over(per.orderBy("date", "ret")), "n": F.count(F.lit(1)).over(per)}
    ).where(F.col("n") >= min_rows)
    k = F.greatest(F.lit(3), F.floor(F.col("n") / parts))
    return numbered.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg(F.when(F.col("pos") <= k, F.col("v"))).alias("early"),
        F.avg(F.when(F.col("pos") > F.col("n") - k, F.col("v"))).alias("late"),
    )


def early_late_gap(panel: DataFrame, by: Sequence[str] = ("ticker",)) -> DataFrame:
    """Mean scorer gap in the first and last third, and whether it widened or narrowed."""
    rows = panel.where(F.col("avg_a").isNotNull() & F.col("avg_b").isNotNull())
    gap = F.abs(F.col("avg_a") - F.col("avg_b"))
    out = _halves(rows, by, gap, parts=3, min_rows=9)
    change = (
        F.when(F.col("late") > F.col("early") + 0.04, "widened")
        .when(F.col("early") > F.col("late") + 0.04, "narrowed")
        .otherwise("neither")
    )
    return out.select(
        *by, F.col("early").alias("gap_early"), F.col("late").alias("gap_late"), change.alias("gap_change")
    )


def early_late_rolling(stability: DataFrame, by: Sequence[str] = ("ticker",)) -> DataFrame:
    """Mean rolling r in the first and last quarter, and whether it shifted."""
    rows = stability.where(F.col("rolling_a").isNotNull())
    out = _halves(rows, by, F.col("rolling_a"), parts=4, min_rows=8)
    return out.select(
        *by,
        "first_date",
        "last_date",
        F.col("early").alias("r_early"),
        F.col("late").alias("r_late"),
        (F.abs(F.col("late") - F.col("early")) > 0.12).alias("shifted"),
    )


# -- datable events ---------------------------------------------------------------------


def biggest_drop(panel: DataFrame, by: Sequence[str] = ("ticker",), floor: float = 0.04) -> DataFrame:
    """Largest one-row fall of the first score, when it exceeds ``floor`` in size."""
    change = F.col("avg_a") - F.lag("avg_a").over(_series(by))
    rows = panel.withColumn("change", change).where(F.col("change").isNotNull())
    best = F.min_by(F.struct("date", "change"), F.struct("change", "date")).alias("e")
    return (
        rows.groupBy(*by)
        .agg(best)
        .select(*by, "e.date", "e.change")
        .where(F.abs(F.col("change")) > floor)
    )


def biggest_gap(panel: DataFrame, by: Sequence[str] = ("ticker",), floor: float = 0.15) -> DataFrame:
    """Day on which the two daily scores differ most, when above ``floor``."""
    rows = panel.withColumn("gap", F.abs(F.col("avg_a") - F.col("avg_b"))).where(F.col("gap").isNotNull())
    best = F.min_by(F.struct("date", "gap"), F.struct((-F.col("gap")).alias("g"), "date")).alias("e")
    return rows.groupBy(*by).agg(best).select(*by, "e.date", "e.gap").where(F.col("gap") > floor)


def sharpest_shift(
    stability: DataFrame, by: Sequence[str] = ("ticker",), floor: float = 0.08
) -> DataFrame:
    """Day with the largest row-to-row move of rolling r, when above ``floor``."""
    shift = F.abs(F.col("rolling_a") - F.lag("rolling_a").over(_series(by)))
    rows = stability.withColumn("shift", shift).where(F.col("shift").isNotNull())
    best = F.min_by(F.struct("date", "shift"), F.struct((-F.col("shift")).alias("s"), "date")).alias("e")
    return rows.groupBy(*by).agg(best).select(*by, "e.date", "e.shift").where(F.col("shift") > floor)
