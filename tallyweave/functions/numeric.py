"""Numeric column expressions. NULL is the only missing value (see sources.nulls)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact_sum(x) -> Column:
    """Sum of a money column that does not depend on the order of addition."""
    return F.sum(_c(x).cast("decimal(18,4)")).cast("double")


def exact_avg(x) -> Column:
    return exact_sum(x) / F.count(_c(x))


def ratio(num, den) -> Column:
    """``num / den``; NULL where the denominator is 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def positive_part(x) -> Column:
    """``x`` where positive, else 0 (also for NULL)."""
    return F.coalesce(F.greatest(_c(x), F.lit(0.0)), F.lit(0.0))


def clip(x, low, high) -> Column:
    return F.least(F.greatest(_c(x), F.lit(low)), F.lit(high))


def within(x, low=None, high=None) -> Column:
    """``x`` inside ``[low, high]``, NULL outside; a bound of None is open."""
    x = _c(x)
    ok = F.lit(True)
    if low is not None:
        ok = ok & (x >= low)
    if high is not None:
        ok = ok & (x <= high)
    return F.when(ok, x)


def finite(x) -> Column:
    """NaN and infinities become NULL."""
    x = _c(x)
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def rescale_sentinel(x, limit: float = 20000, divisor: float = 100) -> Column:
    """Values above ``limit`` are ``divisor`` times too large: ``floor(x / divisor)``."""
    x = _c(x)
    return F.when(x > limit, F.floor(x / divisor).cast("double")).otherwise(x.cast("double"))


def fill_scaled(target, source, factor) -> Column:
    """Missing target taken from another unit: ``source * factor``."""
    return F.coalesce(_c(target), _c(source) * factor)


def fill_sum(target, parts) -> Column:
    """Missing target taken as the sum of its parts (NULL if a part is missing)."""
    return F.coalesce(_c(target), reduce(lambda a, b: a + b, [_c(p) for p in parts]))


def fill_ratio(target, num, den) -> Column:
    return F.coalesce(_c(target), ratio(num, den))


def round_to_bucket(x, size) -> Column:
    """Nearest multiple of ``size`` as text; halves go to the even multiple."""
    return (F.rint(_c(x) / size) * size).cast("long").cast("string")


def equal_width_bin(x, low, high, bins: int = 20) -> Column:
    """Right-closed equal-width bin number 1..bins over ``[low, high]``."""
    x, low, high = _c(x), _c(low), _c(high)
    raw = F.ceil(F.try_divide((x - low) * bins, high - low))
    return F.least(F.lit(bins), F.greatest(F.lit(1), F.coalesce(raw, F.lit(1)))).cast("int")


def min_max(x, low, high) -> Column:
    """``(x - low) / (high - low)``; a constant column gives 0."""
    x, low, high = _c(x), _c(low), _c(high)
    return F.when(x.isNotNull(), F.coalesce(F.try_divide(x - low, high - low), F.lit(0.0)))


def energy_from_parts(kcal, kj, fat, carb, protein) -> Column:
    """Recompute kcal as 9 fat + 4 carb + 4 protein where it is implausible.

    Implausible: all operands known and kJ / kcal outside [4.1, 4.2], or kcal > 1000.
    """
    # Atwater factors, plausible kJ/kcal range, kcal ceiling.
    kcal, kj, fat, carb, protein = map(_c, (kcal, kj, fat, carb, protein))
    parts = 9.0 * fat + 4.0 * carb + 4.0 * protein
    quotient = ratio(kj, kcal)
    off = parts.isNotNull() & quotient.isNotNull() & ((quotient < 4.1) | (quotient > 4.2))
    return F.when(off | (kcal > 1000), parts).otherwise(kcal)


def rescale_mass(x, total) -> Column:
    """Component of a total in (100, 105]: percentage rounded down to one decimal."""
    x, total = _c(x), _c(total)
    # Tolerated excess of a per-100-units composition.
    return F.when((total > 100) & (total <= 105), F.floor(x * 1000 / total) / 10).otherwise(x)


def effect_label(value) -> Column:
    """Wording for an eta squared value."""
    value = _c(value)
    # Conventional thresholds for small, medium and large effects.
    return (
        F.when(value < 0.01, "negligible")
        .when(value < 0.06, "small")
        .when(value < 0.14, "medium")
        .when(value.isNotNull(), "large")
    )
