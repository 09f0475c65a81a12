"""Calendar attributes of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_attributes(full_date: Column) -> dict[str, Column]:
    """Attributes of one calendar day.

    ``week`` is the ISO week, ``day_of_week`` counts Monday as 0, and the
    weekend is Saturday and Sunday. Month and day names are the full English
    names.
    """
    dow = F.weekday(full_date)
    return {
        "year": F.year(full_date),
        "quarter": F.quarter(full_date),
        "month": F.month(full_date),
        "month_name": F.date_format(full_date, "MMMM"),
        "week": F.weekofyear(full_date),
        "day_of_week": dow,
        "day_name": F.date_format(full_date, "EEEE"),
        "is_weekend": dow.isin(5, 6),
    }


def year_month_period(year: Column, month: Column) -> Column:
    """``YYYY-MM`` label of a month."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
