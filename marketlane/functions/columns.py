"""Column functions that carry the null and typing rules of the product."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode calls White_Space. Spark's trim() alone
# removes U+0020 only. A character set for btrim is far cheaper than a regex.
WHITESPACE = (
    "\t\n\u000b\u000c\r\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Staged amounts leave ten digits of head room: sum() widens the precision by
# ten, so a sum of NUMERIC stays within 38 digits without losing scale.
NUMERIC = "decimal(28,9)"
PUBLISHED_NUMERIC = "decimal(38,9)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(value: Column | str) -> Column:
    """Trim every kind of white space; blank becomes NULL.

    Most text starts and ends with a visible ASCII character, which is cheap to see and
    leaves nothing to trim; comparing the ends with the whole set costs several times that.
    """
    text = _col(value).cast("string")
    trimmed = F.nullif(F.btrim(text, F.lit(WHITESPACE)), F.lit(""))
    return F.when(_visible(F.substring(text, 1, 1)) & _visible(F.substring(text, -1, 1)), text).otherwise(trimmed)


def _visible(character: Column) -> Column:
    return character.between("!", "~")


def lower_text(value: Column | str) -> Column:
    return F.lower(clean_text(value))


def upper_text(value: Column | str) -> Column:
    return F.upper(clean_text(value))


def to_long(value: Column | str) -> Column:
    """Whole numbers only: text such as ``40.0`` is NULL."""
    return _col(value).try_cast("bigint")


def measure_to_long(value: Column | str) -> Column:
    """A float measure to a whole number, rounding half away from zero."""
    return F.round(_col(value).try_cast("double")).try_cast("bigint")


def to_double(value: Column | str) -> Column:
    return _col(value).try_cast("double")


def to_numeric(value: Column | str) -> Column:
    return _col(value).try_cast(NUMERIC)


def to_bool(value: Column | str) -> Column:
    return _col(value).try_cast("boolean")


def to_date(value: Column | str) -> Column:
    return _full_date_text(_col(value).cast("string")).try_cast("date")


def to_timestamp(value: Column | str) -> Column:
    """Text to an instant; NULL unless year, month and day are all there.

    Text with dashes after year and month is cast as it is: what the cast takes then has a
    day. Everything else, and what the cast does not take, is cleaned and matched first.
    """
    text = _col(value).cast("string")
    dashed = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.coalesce(
        F.when(dashed, text.try_cast("timestamp")), _full_date_text(clean_text(text)).try_cast("timestamp")
    )


def _full_date_text(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text)


def greatest_or_null(*values: Column) -> Column:
    """greatest() that is NULL when any argument is."""
    return F.when(_all_present(values), F.greatest(*values))


def least_or_null(*values: Column) -> Column:
    """least() that is NULL when any argument is."""
    return F.when(_all_present(values), F.least(*values))


def _all_present(values: tuple[Column, ...]) -> Column:
    present = values[0].isNotNull()
    for value in values[1:]:
        present = present & value.isNotNull()
    return present


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double ratio, NULL on a zero or NULL denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def money_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Exact ratio of an amount and a count, NULL on a zero denominator."""
    return F.try_divide(
        _col(numerator).cast(PUBLISHED_NUMERIC), _col(denominator).cast("bigint")
    ).cast(PUBLISHED_NUMERIC)


def money_sum(value: Column | str) -> Column:
    """Sum of amounts, cast back so that a later addition keeps all nine decimals."""
    return F.sum(_col(value)).cast(NUMERIC)


def money_or_zero(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(0).cast(NUMERIC))


def count_where(condition: Column | str) -> Column:
    """Rows for which the condition is true (not false, not NULL)."""
    return F.count_if(_col(condition))


def week_start(value: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(_col(value), "week")


# Lower and upper day of each late band.
LATE_BANDS = (
    (1, 3, "1_to_3_days"),
    (4, 7, "4_to_7_days"),
    (8, 14, "8_to_14_days"),
    (15, None, "15_plus_days"),
)
NOT_DELIVERED = "not_delivered"
ON_TIME = "on_time"
DELAY_BUCKETS = (NOT_DELIVERED, ON_TIME, *(name for _, _, name in LATE_BANDS))


def delay_bucket(
    is_delivered: Column | str = "is_delivered",
    is_cancelled: Column | str = "is_cancelled",
    is_late: Column | str = "is_late",
    late_days: Column | str = "late_days",
) -> Column:
    """Delivery-delay class of one order."""
    delivered = F.coalesce(_col(is_delivered), F.lit(False))
    late = F.coalesce(_col(is_late), F.lit(False))
    days = _col(late_days)
    bucket = F.when(_col(is_cancelled) | ~delivered, NOT_DELIVERED).when(~late, ON_TIME)
    for first, last, name in LATE_BANDS:
        inside = days >= first if last is None else days.between(first, last)
        bucket = bucket.when(inside, name)
    return bucket.otherwise(NOT_DELIVERED)
