"""Numeric column expressions: missing-value rules, guarded correlation, number formatting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

MIN_SD = 1e-9
Z_95 = 1.959963984540054
_INF = float("inf")


def finite_or_null(x: Column) -> Column:
    """NaN and infinities become NULL, so that averages and counts skip them."""
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(_INF)), F.lit(None)).otherwise(x)


def to_number(text: Column) -> Column:
    """Lenient numeric cast: anything unreadable or non-finite is NULL."""
    return finite_or_null(F.trim(text.cast("string")).try_cast("double"))


def pearson(
    x: Column,
    y: Column,
    *,
    min_pairs: int = 3,
    min_sd: float = MIN_SD,
    over: WindowSpec | None = None,
) -> Column:
    """Pearson r over non-null pairs; NULL for few pairs or a (nearly) constant side.

    Plain ``corr`` raises on zero variance in ANSI mode, hence the explicit form.
    With ``over`` the same rule is applied to a window frame.
    """

    def agg(c: Column) -> Column:
        return c.over(over) if over is not None else c

    px = F.when(y.isNotNull(), x)
    py = F.when(x.isNotNull(), y)
    n = agg(F.count(px + py))
    sx = agg(F.stddev_samp(px))
    sy = agg(F.stddev_samp(py))
    r = F.try_divide(agg(F.covar_samp(px, py)), sx * sy)
    usable = (n >= min_pairs) & (sx >= min_sd) & (sy >= min_sd)
    return F.when(usable, finite_or_null(r))


# Rational approximations of erfc by range, as numerator and denominator, lowest power first
# (fdlibm); relative error below 1e-15.
_ERFC_NEAR = (
    (1.28379167095512558561e-01, -3.25042107247001499370e-01, -2.84817495755985104766e-02, -5.77027029648944159157e-03,
     -2.37630166566501626084e-05),
    (1.0, 3.97917223959155352819e-01, 6.50222499887672944485e-02, 5.08130628187576562776e-03, 1.32494738004321644526e-04,
     -3.96022827877536812320e-06),
)
_ERFC_ONE = (
    (-2.36211856075265944077e-03, 4.14856118683748331666e-01, -3.72207876035701323847e-01, 3.18346619901161753674e-01,
     -1.10894694282396677476e-01, 3.54783043256182359371e-02, -2.16637559486879084300e-03),
    (1.0, 1.06420880400844228286e-01, 5.40397917702171048937e-01, 7.18286544141962662868e-02, 1.26171219808761642112e-01,
     1.36370839120290507362e-02, 1.19844998467991074170e-02),
)
_ERFC_FAR = (
    (-9.86494403484714822705e-03, -6.93858572707181764372e-01, -1.05586262253232909814e01, -6.23753324503260060396e01,
     -1.62396669462573470355e02, -1.84605092906711035994e02, -8.12874355063065934246e01, -9.81432934416914548592e00),
    (1.0, 1.96512716674392571292e01, 1.37657754143519042600e02, 4.34565877475229228821e02, 6.45387271733267880336e02,
     4.29008140027567833386e02, 1.08635005541779435134e02, 6.57024977031928170135e00, -6.04244152148580987438e-02),
)
_ERFC_TAIL = (
    (-9.86494292470009928597e-03, -7.99283237680523006574e-01, -1.77579549177547519889e01, -1.60636384855821916062e02,
     -6.37566443368389627722e02, -1.02509513161107724954e03, -4.83519191608651397019e02),
    (1.0, 3.03380607434824582924e01, 3.25792512996573918826e02, 1.53672958608443695994e03, 3.19985821950859553908e03,
     2.55305040643316442583e03, 4.74528541206955367215e02, -2.24409524465858183362e01),
)
_ERF_ONE = 8.45062911510467529297e-01


def _ratio(of: tuple[tuple[float, ...], tuple[float, ...]], v: Column) -> Column:
    def polynomial(coefficients: tuple[float, ...]) -> Column:
        out = F.lit(coefficients[-1])
        for c in reversed(coefficients[:-1]):
            out = out * v + F.lit(c)
        return out

    return polynomial(of[0]) / polynomial(of[1])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it occurs there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _erfc(x: Column) -> Column:
    """Complementary error function of x >= 0; NULL for NULL and NaN."""

    def far(v: Column) -> Column:
        # the square of a float is exact, so nothing is lost in the exponent
        near = v.cast("float").cast("double")
        square = F.lit(1.0) / (v * v)
        r = F.when(v < 1 / 0.35, _ratio(_ERFC_FAR, square)).otherwise(_ratio(_ERFC_TAIL, square))
        return F.exp(-near * near - 0.5625) * F.exp((near - v) * (near + v) + r) / v

    def whole(v: Column) -> Column:
        return (
            F.when(v.isNull() | F.isnan(v), F.lit(None).cast("double"))
            .when(v < 0.84375, 1.0 - (v + v * _ratio(_ERFC_NEAR, v * v)))
            .when(v < 1.25, 1.0 - _ERF_ONE - _ratio(_ERFC_ONE, v - 1.0))
            .when(v < 28.0, far(v))
            .otherwise(0.0)
        )

    return _let(x, whole)


def two_sided_normal_p(z: Column) -> Column:
    """Two-sided normal p-value, without Python."""
    return finite_or_null(_erfc(F.abs(z) / F.sqrt(F.lit(2.0))))


def _decimals(v: Column, digits: int) -> Column:
    # Unlike printf-style formatting this rounds the exact binary value, half to even.
    return F.call_function("format_number", v, F.lit("0." + "0" * digits if digits else "0"))


def fixed(x: Column, digits: int = 4) -> Column:
    """Fixed-decimal text, ``n/a`` when missing."""
    return F.coalesce(_decimals(finite_or_null(x.cast("double")), digits), F.lit("n/a"))


def percent(x: Column, digits: int = 3) -> Column:
    """Decimal return as percentage text, ``n/a`` when missing."""
    shown = F.concat(_decimals(finite_or_null(x.cast("double")) * 100, digits), F.lit("%"))
    return F.coalesce(shown, F.lit("n/a"))
