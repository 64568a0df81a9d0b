"""Relative ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog.functions.text import strip

# Fixed value: how an age is written.
_AGE = r"(?U)(\d+)\s+(year|month|week|day)s?\s+ago"


def relative_date(text: Column, as_of: Column) -> tuple[Column, Column]:
    """``7 months ago`` as (date, lower-cased text), counted back from ``as_of``.

    Anything that is no age, and an age that leads before year 1, gives ``as_of`` itself. A day that
    the target month lacks becomes the month's last day.
    """
    low = F.lower(strip(F.coalesce(text, F.lit(""))))
    n = F.regexp_extract(low, _AGE, 1).try_cast("bigint")
    unit = F.regexp_extract(low, _AGE, 2)
    months = F.when(unit == "year", F.try_multiply(n, F.lit(12))).when(unit == "month", n)
    days = F.when(unit == "week", F.try_multiply(n, F.lit(7))).when(unit == "day", n)
    # Months and days from the first of year 1 to ``as_of``.
    most_months = (F.year(as_of) - 1) * 12 + F.month(as_of) - 1
    most_days = F.datediff(as_of, F.lit("0001-01-01").cast("date"))
    date = F.when(months <= most_months, F.add_months(as_of, -months.try_cast("int"))).when(
        days <= most_days, F.date_sub(as_of, days.try_cast("int")))
    return F.coalesce(date, as_of), low
