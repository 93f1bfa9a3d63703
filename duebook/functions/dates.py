"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: str | Column) -> Column:
    return F.trunc(day, "month")


def whole_months(later: Column, earlier: Column) -> Column:
    """Calendar months from the month of ``earlier`` to the month of ``later``."""
    return F.months_between(month_of(later), month_of(earlier)).cast("int")
