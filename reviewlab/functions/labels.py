"""Numbers, labels and ratings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewlab.functions.text import _col, strip
from reviewlab.schema import NEGATIVE, NEUTRAL, POSITIVE

# Accepts decimal notation and infinity; refuses the d/f suffixes and hexadecimal
# floats a plain cast would take, and NaN, which compares as the largest number.
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"

# What each label adds to the stars, and the star range.
RATING_RULE = {"Positive": 0.25, "Neutral": 0.0, "Negative": -0.25}
RATING_MIN = 1.0
RATING_MAX = 5.0


def to_number(c: Column | str) -> Column:
    """Number as DOUBLE; anything unparsable and NaN become null."""
    c = _col(c)
    text = strip(c.cast("string"))
    parsed = F.when(text.rlike(NUMBER), text.try_cast("double"))
    # typeof is constant at planning time, so only one branch survives.
    value = F.when(F.typeof(c) == "string", parsed).otherwise(c.try_cast("double"))
    return F.nanvl(value, F.lit(None).cast("double"))


def parse_votes(c: Column | str) -> Column:
    """Vote counts with thousands separators."""
    return to_number(F.replace(_col(c).cast("string"), F.lit(","), F.lit("")))


def label_sentiment(c: Column | str) -> Column:
    """4 and up Positive, exactly 3 Neutral, 2 and below Negative, otherwise null.

    There is no range check: 0 is Negative and 7 is Positive.
    """
    r = to_number(c)
    return F.when(r >= 4, POSITIVE).when(r == 3, NEUTRAL).when(r <= 2, NEGATIVE)


def threshold_label(
    c: Column | str, positive: float = 0.05, negative: float = -0.05, strict: bool = False
) -> Column:
    """Label a score by two thresholds, inclusive unless ``strict``."""
    c = _col(c)
    up, down = (c > positive, c < negative) if strict else (c >= positive, c <= negative)
    return F.when(up, POSITIVE).when(down, NEGATIVE).otherwise(NEUTRAL)


def rating_adjustment(label: Column | str, rule: dict[str, float] | None = None) -> Column:
    """What the stripped label adds to the stars; an unknown label adds nothing."""
    label = strip(label)
    out = F.lit(0.0)
    for name, step in (rule or RATING_RULE).items():
        out = F.when(label == name, F.lit(float(step))).otherwise(out)
    return out


def clip(c: Column | str, lo: float = RATING_MIN, hi: float = RATING_MAX) -> Column:
    return F.least(F.greatest(_col(c), F.lit(float(lo))), F.lit(float(hi)))


def review_time(c: Column | str) -> Column:
    """Epoch seconds to timestamp."""
    return F.timestamp_seconds(_col(c).cast("bigint"))


def review_calendar(df: DataFrame, seconds: str = "unixReviewTime") -> DataFrame:
    """Add the timestamp, the first day of its month and the month of the year."""
    at = review_time(seconds)
    return df.withColumns(
        {"date": at, "month": F.date_trunc("month", at), "month_of_year": F.month(at)}
    )
