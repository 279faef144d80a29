"""Column expressions with the semantics the warehouse relies on.

Everything here is a built-in Spark expression, so it stays inside whole-stage
code generation and never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- text -------------------------------------------------------------------


def clean_upper(value: Column | str) -> Column:
    """Trimmed (blanks only) upper-case text, used for places."""
    return F.upper(F.trim(as_col(value)))


def clean_lower(value: Column | str) -> Column:
    """Trimmed lower-case text, used for codes such as status and payment type."""
    return F.lower(F.trim(as_col(value)))


def zip5(value: Column | str) -> Column:
    """Zip prefix as five digits with leading zeros; NULL stays NULL.

    ``right`` keeps the last five characters of a longer number, where ``lpad``
    would keep the first five.
    """
    return F.right(F.concat(F.lit("00000"), as_col(value).cast("string")), F.lit(5))


# --- dates ------------------------------------------------------------------


def date_key(value: Column | str) -> Column:
    """yyyymmdd as an integer; NULL stays NULL."""
    day = as_col(value).cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(key: Column | str) -> Column:
    """yyyymm of a yyyymmdd key."""
    return F.floor(as_col(key) / 100).cast("int")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar-day boundaries crossed from start to end (time of day ignored)."""
    return F.datediff(as_col(end).cast("date"), as_col(start).cast("date"))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed from start to end (seconds ignored).

    Computed from the calendar parts, so no session time zone is involved.
    """

    def minute_of_day(ts: Column) -> Column:
        return F.hour(ts) * 60 + F.minute(ts)

    start, end = as_col(start), as_col(end)
    return days_between(start, end).cast("long") * 1440 + minute_of_day(end) - minute_of_day(start)


def week_start(value: Column | str) -> Column:
    """Monday of the week."""
    day = as_col(value).cast("date")
    return F.date_sub(day, F.weekday(day))


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """The calendar attributes of a date; weeks run Sunday = 1 to Saturday = 7."""
    day = as_col(day)
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_week": F.dayofweek(day),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }


# --- numbers ----------------------------------------------------------------


def safe_div(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, or NULL where the denominator is zero or NULL."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def ratio(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """Quotient of two exact aggregates as a rounded double."""
    return F.round(safe_div(numerator.cast("double"), denominator.cast("double")), digits)


def percent(numerator: Column, denominator: Column) -> Column:
    return F.round(safe_div(numerator.cast("double") * 100, denominator.cast("double")), 6)


def mean(value: Column | str) -> Column:
    """True mean of an integer or decimal column.

    The sum is exact and divided once, so the result does not depend on the
    order in which partitions are merged.
    """
    value = as_col(value)
    return ratio(F.sum(value), F.count(value))


def truncated_mean(value: Column | str) -> Column:
    """Mean of an integer column cut to an integer toward zero."""
    value = as_col(value).cast("long")
    return F.call_function("div", F.sum(value), F.nullif(F.count(value), F.lit(0)))


def money_sum(value: Column | str) -> Column:
    return F.sum(as_col(value)).cast(MONEY)


def total_if(condition: Column, value: Column | str) -> Column:
    """Conditional total; rows that do not match add nothing, as does NULL."""
    return F.sum(F.when(condition, as_col(value)))


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true (0, not NULL, when there are none)."""
    return F.count(F.when(condition, F.lit(1)))


# --- labels -----------------------------------------------------------------


def bucket(value: Column | str, steps: Sequence[tuple[object, str]], otherwise: str, missing: str | None = None) -> Column:
    """First step whose inclusive upper bound holds the value, else ``otherwise``.

    NULL gets ``missing`` and never falls through to the last bucket.
    """
    value = as_col(value)
    label = F.when(value.isNull(), F.lit(missing).cast("string"))
    for bound, name in steps:
        label = label.when(value <= F.lit(bound), F.lit(name))
    return label.otherwise(F.lit(otherwise))


def bucket_rank(value: Column | str, steps: Sequence[tuple[object, str]], missing: int | None = None) -> Column:
    """Constant sort position of the bucket the value falls in (1, 2, …)."""
    value = as_col(value)
    rank = F.when(value.isNull(), F.lit(missing).cast("int"))
    for position, (bound, _) in enumerate(steps, start=1):
        rank = rank.when(value <= F.lit(bound), F.lit(position))
    return rank.otherwise(F.lit(len(steps) + 1))


def label_equal(left: Column | str, right: Column | str, same: str, different: str) -> Column:
    """``same`` where both values are equal; NULL on either side is ``different``."""
    return F.when(as_col(left) == as_col(right), F.lit(same)).otherwise(F.lit(different))
