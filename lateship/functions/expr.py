"""Small scalar column expressions used across operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ORDER_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp(col, lower, upper) -> Column:
    """Conditional clamp to [lower, upper]; null stays null.

    ``when/otherwise`` rather than ``least/greatest``: those would not keep a
    null input null when a bound is a column. Integer input becomes double,
    as the bounds are doubles.
    """
    c = _c(col)
    lo = lower if isinstance(lower, Column) else F.lit(lower).cast("double")
    hi = upper if isinstance(upper, Column) else F.lit(upper).cast("double")
    return (F.when(c < lo, lo).when(c > hi, hi).otherwise(c.cast("double")))


def slug(col) -> Column:
    """Spaces and hyphens become underscores, then lower case."""
    return F.lower(F.translate(_c(col), " -", "__"))


def slug_text(name: str) -> str:
    """The same rule for a driver-side string (model folder names)."""
    return name.replace(" ", "_").replace("-", "_").lower()


def parse_order_date(col) -> Column:
    """Order date text to timestamp; malformed text gives null."""
    return F.try_to_timestamp(_c(col), F.lit(ORDER_DATE_FORMAT))


def format_order_date(col) -> Column:
    return F.date_format(_c(col), ORDER_DATE_FORMAT)


def zero_score(quantity) -> Column:
    """Fallback prediction: quantity times zero, as double (null stays null)."""
    return (_c(quantity) * F.lit(0)).cast("double")


def as_double(col) -> Column:
    return _c(col).cast("double")


# Coefficients of the deterministic logistic score.
SCORE_INTERCEPT = 1.5
SCORE_DAYS = -0.9
SCORE_DISCOUNT = 2.0


def fixed_logit(days: Column, discount: Column) -> Column:
    """The fixed logistic score, rounded to six places."""
    z = F.lit(SCORE_INTERCEPT) + F.lit(SCORE_DAYS) * days + F.lit(SCORE_DISCOUNT) * discount
    return F.round(1 / (1 + F.exp(-z)), 6)
