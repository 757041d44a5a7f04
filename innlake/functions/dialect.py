"""Column expressions that keep the source dialect's meaning.

Everything is built from JVM-side functions, and nothing depends on the
session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from innlake.constants import WORD_BREAKS

_REST = 2_147_483_647
# microseconds from 1970 to the end of the year 9999
LAST_MICROS = 253_402_300_800_000_000


def has_key(column: str) -> Column:
    """Key is neither NULL nor blank."""
    return F.col(column).isNotNull() & (F.trim(column) != "")


def try_date(column: str) -> Column:
    """Strict ``YYYY-MM-DD``; anything else is NULL.

    The shape test keeps the lax date cast from taking ``2024``, a timestamp, or a date with something after it.
    """
    text = F.col(column)
    return F.when(text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date"))


def try_timestamp(column: str, epoch: bool = False) -> Column:
    """ISO date or timestamp to a zone-less timestamp, else NULL.

    ``epoch=True`` also reads all-digit text as time since 1970, in the unit
    its magnitude implies (seconds, milli-, micro- or nanoseconds). A time after
    the year 9999 is NULL.
    """
    text = F.trim(column)
    shaped = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    parsed = F.when(shaped, text.try_cast("timestamp_ntz"))
    if not epoch:
        return parsed
    number = text.try_cast("decimal(38,0)")
    # fixed values: magnitudes at which the unit changes
    micros = (
        F.when(number < 31_536_000_000, number * 1_000_000)
        .when(number < 31_536_000_000_000, number * 1_000)
        .when(number < 31_536_000_000_000_000, number)
        .otherwise(F.floor(number / 1_000))
        .try_cast("bigint")
    )
    within = F.when(micros < LAST_MICROS, micros)
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    since = origin + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (within.cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
    )
    return F.when(text.rlike(r"^\d+$"), since).otherwise(parsed)


def try_number(column: str) -> Column:
    """Text to a whole number, halves away from zero; else NULL."""
    return F.col(column).try_cast("decimal(38,0)")


def try_integer(column: str) -> Column:
    return try_number(column).try_cast("int")


def try_decimal(column: str, precision: int, scale: int) -> Column:
    """Text to a decimal; garbage and overflow are NULL."""
    return F.col(column).try_cast(f"decimal({precision},{scale})")


def flag(column: str) -> Column:
    """``Y`` (any case, padded) is true; everything else, NULL included, false."""
    return F.coalesce(F.upper(F.trim(column)) == "Y", F.lit(False))


def date_key(date: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def day_number(date_sk: Column) -> Column:
    """Days since 1970-01-01 of a ``YYYYMMDD`` integer."""
    year = F.floor(date_sk / 10000).cast("int")
    month = F.floor(date_sk / 100).cast("int") % 100
    return F.unix_date(F.make_date(year, month, date_sk % 100))


def day_name(date: Column) -> Column:
    return F.date_format(date, "E")


def is_weekend(date: Column) -> Column:
    """Saturday or Sunday; ``dayofweek`` counts from 1 = Sunday."""
    return F.dayofweek(date).isin(1, 7)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, not whole minutes elapsed."""
    return (
        F.datediff(end.cast("date"), start.cast("date")).cast("bigint") * 1440
        + (F.hour(end) * 60 + F.minute(end))
        - (F.hour(start) * 60 + F.minute(start))
    )


def hours_between(start: Column, end: Column) -> Column:
    """Hour boundaries crossed."""
    return (
        F.datediff(end.cast("date"), start.cast("date")).cast("bigint") * 24
        + F.hour(end)
        - F.hour(start)
    )


def init_cap(text: Column) -> Column:
    """Capital after every word break, lower case elsewhere.

    Spark's own ``initcap`` only breaks at blanks, so ``no_show`` would stay
    ``No_show``. Text without any break, the usual case, takes a short path.
    """
    lowered = F.lower(text)
    breaks = r"\s" + "".join(re.escape(c) for c in WORD_BREAKS)
    tokens = F.regexp_extract_all(lowered, F.lit(f"([{breaks}]+|[^{breaks}]+)"), F.lit(1))
    spelled = F.array_join(F.transform(tokens, _capital), "")
    return F.when(lowered.rlike(f"[{breaks}]"), spelled).otherwise(_capital(lowered))


def _capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, _REST))


def safe_ratio(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """Decimal quotient rounded to ``digits``; NULL for a zero denominator.

    Holds amounts of 26 whole digits and any bigint count; the quotient has twelve decimals before it is rounded.
    """
    top = numerator.cast("decimal(28,2)")
    bottom = F.nullif(denominator, F.lit(0).cast("bigint")).cast("decimal(20,0)")
    return F.round(top / bottom, digits)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two digits, from the six-digit quotient."""
    return F.round(safe_ratio(part, whole) * 100, 2).cast("double")
