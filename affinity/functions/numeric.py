"""Numeric expression helpers.

Fixed values that results depend on:

* similarities are rounded to 12 digits before they are used for ordering,
  weighting or sign tests (``STABLE_DIGITS``); estimates are ordered on the
  same rounding;
* doubles leave a query rounded to 6 digits (``OUT_DIGITS``);
* report scalars are rounded half-down to 4 digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits for similarity use and for output.
STABLE_DIGITS = 12
OUT_DIGITS = 6


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_away(x, digits: int) -> Column:
    """Round half away from zero in double arithmetic: sign(x) * floor(|x| * 10^d + 0.5) / 10^d.

    Plain arithmetic (no BigDecimal per row, unlike ``round``), and the same
    doubles as the SQL engines that round this way. Values too large to scale
    into a long are returned unrounded; -0.0 becomes 0.0.
    """
    c = _c(x)
    p = float(10 ** digits)
    scaled = F.abs(c) * F.lit(p)
    r = F.signum(c) * (F.floor(scaled + F.lit(0.5)) / F.lit(p))
    return F.when(scaled < F.lit(9.0e18), r).otherwise(c) + F.lit(0.0)


def stable(x) -> Column:
    """Round a similarity or estimate so last-bit noise cannot reorder it."""
    return round_half_away(x, STABLE_DIGITS)


def out(x) -> Column:
    """Round a double for output."""
    return round_half_away(x, OUT_DIGITS)


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 (ANSI division would raise)."""
    return F.try_divide(_c(num), _c(den))


def significance_weight(n_shared, full_at: int = 50) -> Column:
    """min(n / full_at, 1): shrink correlations built on few shared items."""
    return F.least(_c(n_shared) / F.lit(float(full_at)), F.lit(1.0))


def half_down(x, digits: int = 4) -> Column:
    """Round half *down* (ties toward zero) at ``digits`` decimals, as a double.

    ``round`` is half-up and ``bround`` half-even; the report wants half-down:
    3.52985 -> 3.5298, 3.529851 -> 3.5299. Works on the decimal form of the
    double's shortest representation.
    """
    if not 0 <= digits <= 15:
        raise ValueError("digits must be from 0 to 15")
    c = _c(x)
    scale = 10 ** digits
    # 16 digits before the point and 22 after it hold any double below 1e16;
    # larger ones are whole numbers and stay.
    d = F.when(F.abs(c) < 1e16, c).cast("decimal(38,22)")
    kept = F.ceil(F.abs(d) * F.lit(scale) - F.lit(0.5))
    return F.when(F.abs(c) < 1e16, F.signum(c) * (kept.cast("double") / F.lit(float(scale)))).otherwise(c)


def truncate_int(x) -> Column:
    """Double to int by truncation toward zero (119.99 -> 119)."""
    return _c(x).cast("int")
