"""Scalar column functions of the warehouse (dates, ages, bands, labels, text, rounding)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

# Upper bound and label of each age band; any other age, and NULL, is '60+'.
AGE_BANDS = [(18, "0-18"), (35, "19-35"), (60, "36-60")]
OLDEST_BAND = "60+"

# Fixed value: first month of the fiscal year.
FISCAL_START_MONTH = 7


def date_key(day: Column) -> Column:
    """Integer yyyymmdd key; NULL in, NULL out."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def age_years(birth: Column, as_of: Column) -> Column:
    """Whole years between two dates, from the difference of their yyyymmdd keys, truncated toward zero."""
    return ((date_key(as_of) - date_key(birth)) / 10000).cast("int")


def age_band(age: Column) -> Column:
    chain = F
    for limit, label in AGE_BANDS:
        chain = chain.when(age <= limit, F.lit(label))
    return chain.otherwise(F.lit(OLDEST_BAND))


def fiscal_year(day: Column) -> Column:
    return F.year(day) + (F.month(day) >= FISCAL_START_MONTH).cast("int")


def fiscal_quarter(day: Column) -> Column:
    """Quarter counted from the fiscal start month."""
    shifted = F.pmod(F.month(day) - FISCAL_START_MONTH, F.lit(12))
    return F.floor(shifted / 3).cast("int") + 1


def month_label(moment: Column) -> Column:
    """'yyyy-MM' of a date or timestamp."""
    return F.date_format(moment.cast("date"), "yyyy-MM")


def month_start(moment: Column) -> Column:
    """First instant of the month, without a zone."""
    return F.trunc(moment.cast("date"), "month").cast("timestamp_ntz")


def month_name(month: Column) -> Column:
    """English month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM"), 9, " ")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def interval_micros(interval: Column) -> Column:
    """Length of a day-time interval in microseconds, independent of the session zone."""
    return (
        F.extract(F.lit("DAY"), interval).cast("long") * MICROS_PER_DAY
        + F.extract(F.lit("HOUR"), interval).cast("long") * MICROS_PER_HOUR
        + F.extract(F.lit("MINUTE"), interval).cast("long") * 60_000_000
        + (F.extract(F.lit("SECOND"), interval) * 1_000_000).cast("long")
    )


def epoch_micros(moment: Column) -> Column:
    """Microseconds from 1970-01-01 for a timestamp without zone."""
    return interval_micros(moment.cast("timestamp_ntz") - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def micros_to_timestamp(micros: Column) -> Column:
    """Inverse of :func:`epoch_micros`."""
    origin = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return origin + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    )


def moment(value: dt.datetime) -> Column:
    """Literal timestamp without zone, the same in every session zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def stay_hours(admitted: Column, discharged: Column) -> Column:
    """Hours between two timestamps as an integer, rounded half away from zero."""
    hours = interval_micros(discharged - admitted) / F.lit(float(MICROS_PER_HOUR))
    return F.round(hours).cast("int")


def whole_days(later: Column, earlier: Column) -> Column:
    """Full days in a non-negative timestamp difference."""
    return F.floor(interval_micros(later - earlier) / MICROS_PER_DAY).cast("int")


def joined_text(*parts: Column) -> Column:
    """Concatenation that is NULL when any part is NULL."""
    return F.concat(*parts)


def zero_padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def rounded(value: Column, places: int) -> Column:
    """Round half away from zero in decimal arithmetic, returned as double."""
    return F.round(value.cast("decimal(38,10)"), places).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Double quotient, NULL when the divisor is zero or NULL."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, places: int) -> Column:
    """Share in percent; zero when the whole is not positive."""
    return F.when(whole > 0, rounded(part.cast("double") * 100 / whole.cast("double"), places)).otherwise(F.lit(0.0))


def mean(total: Column, count: Column) -> Column:
    """Mean from a sum and a count, as double."""
    return ratio(total, count)


def contains_any(text: Column, fragments: Sequence[str]) -> Column:
    """True when the text holds one of the fragments, ignoring case."""
    return reduce(lambda a, b: a | b, [text.ilike(f"%{fragment}%") for fragment in fragments])


def label_by_fragment(text: Column, rules: Sequence[tuple], default) -> Column:
    """First label whose fragments occur in the text; rules are (label, fragments) in order of precedence."""
    chain = F
    for label, fragments in rules:
        chain = chain.when(contains_any(text, fragments), F.lit(label))
    return chain.otherwise(F.lit(default))


def label_by_prefix(text: Column, labels: dict, default: str) -> Column:
    chain = F
    for prefix, label in labels.items():
        chain = chain.when(text.startswith(prefix), F.lit(label))
    return chain.otherwise(F.lit(default))


def label_by_value(value: Column, rules: Sequence[tuple], default) -> Column:
    """First label whose value list holds the value; rules are (label, values)."""
    chain = F
    for label, values in rules:
        chain = chain.when(value.isin(*values), F.lit(label))
    return chain.otherwise(F.lit(default))


def hash_key(text: Column) -> Column:
    """60-bit surrogate key of a text natural key, stable across loads and engines."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
