"""Date and interval expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_years(dob: Column, as_of: Column) -> Column:
    """Whole calendar years from ``dob`` to ``as_of`` (the birthday counts on
    its day; a 29 February birthday is reached on 1 March in common years).
    ``months_between``-based formulas are off by one around leap days."""
    before_birthday = (F.month(as_of) * 100 + F.dayofmonth(as_of)) < (F.month(dob) * 100 + F.dayofmonth(dob))
    return (F.year(as_of) - F.year(dob) - before_birthday.cast("int")).cast("bigint")


def los_days(admitted: Column, discharged: Column) -> Column:
    """Day field of ``discharged - admitted``: whole days, truncated toward zero."""
    return F.extract(F.lit("DAY"), discharged - admitted).cast("bigint")


def day_number(ts: Column) -> Column:
    """Days since 1970-01-01 of a timestamp's calendar date (time-zone free for NTZ)."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
