"""Column expressions for rating arithmetic.

Everything here returns a ``pyspark.sql.Column`` built from JVM-side
functions, so it stays inside whole-stage codegen. None of it is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bounds of the 1-to-5 rating scale the similarity and
# prediction formulas assume.
RATING_MIN = 1.0
RATING_MAX = 5.0

# Decimal places used to make floating sums comparable before they are
# ranked, de-duplicated or ordered. Sums of the same terms taken in another
# order differ in the last bits; rounding first makes ties deterministic.
RANK_DIGITS = 12
ORDER_DIGITS = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scale(x: Column | str, mean: Column | str,
          rating_min: float = RATING_MIN, rating_max: float = RATING_MAX) -> Column:
    """Room left on the scale in the direction of ``x`` from ``mean``.

    ``rating_max - mean`` above the mean, ``mean - rating_min`` below it and
    1 when ``x`` equals the mean.
    """
    x, mean = _col(x), _col(mean)
    return (F.when(x > mean, F.lit(rating_max) - mean)
             .when(x < mean, mean - F.lit(rating_min))
             .otherwise(F.lit(1.0)))


def normalized_deviation(rating: Column | str, mean: Column | str,
                         rating_min: float = RATING_MIN,
                         rating_max: float = RATING_MAX) -> Column:
    """``(rating - mean) / scale(rating, mean)``, a value in [-1, 1]."""
    rating, mean = _col(rating), _col(mean)
    return (rating - mean) / scale(rating, mean, rating_min, rating_max)


def denormalize(mean: Column | str, usws: Column | str,
                rating_min: float = RATING_MIN,
                rating_max: float = RATING_MAX) -> Column:
    """Map a weighted deviation back to the rating scale.

    ``mean + usws * scale(mean + usws, mean)``; the branch of ``scale`` is
    chosen by comparing ``mean + usws`` with ``mean`` in floating point.
    """
    mean, usws = _col(mean), _col(usws)
    return mean + usws * scale(mean + usws, mean, rating_min, rating_max)


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """``num / den``, or 0.0 when the divisor is 0 or NULL (ANSI-safe)."""
    return F.coalesce(F.try_divide(_col(num), _col(den)), F.lit(0.0))


def scaled_round(x: Column | str, digits: int) -> Column:
    """``x * 10^digits`` rounded half away from zero, as a whole number.

    A monotone key: equal for values that round equal at ``digits`` places.
    Plain arithmetic (codegen friendly), unlike ``round`` on doubles, which
    goes through a decimal per value. The whole part is taken in doubles, so
    no magnitude overflows.
    """
    x = _col(x)
    y = F.abs(x) * F.lit(10.0 ** digits) + F.lit(0.5)
    return F.signum(x) * (y - y % F.lit(1.0))


def round_half_away(x: Column | str, digits: int) -> Column:
    """``x`` rounded to ``digits`` places, half away from zero; infinities stay."""
    x = _col(x)
    return F.nanvl(scaled_round(x, digits) / F.lit(10.0 ** digits), x)


def rank_key(sim: Column | str) -> Column:
    """Ordering key for similarities: rounded so that ties are exact."""
    return scaled_round(sim, RANK_DIGITS)


def order_key(pred: Column | str) -> Column:
    """Ordering key for predicted ratings in top-n lists."""
    return scaled_round(pred, ORDER_DIGITS)


def pair_low(a: Column | str, b: Column | str) -> Column:
    """Smaller id of an unordered pair."""
    return F.least(_col(a), _col(b))


def pair_high(a: Column | str, b: Column | str) -> Column:
    """Larger id of an unordered pair."""
    return F.greatest(_col(a), _col(b))


def jaccard(common: Column | str, n_u: Column | str, n_v: Column | str) -> Column:
    """|I_u ∩ I_v| / |I_u ∪ I_v| from the overlap and the two set sizes."""
    common = _col(common)
    return common.cast("double") / (_col(n_u) + _col(n_v) - common).cast("double")
