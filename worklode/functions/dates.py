"""Integer date keys and age tests relative to an explicit day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(col: Column) -> Column:
    """``yyyyMMdd`` as an integer."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def key_days_before(as_of: str, days: int) -> int:
    """Date key of the day ``days`` before ``as_of``: a plain literal, so it reaches the file scan."""
    return int((dt.date.fromisoformat(as_of) - dt.timedelta(days=days)).strftime("%Y%m%d"))


def key_to_date(col: Column) -> Column:
    return F.make_date(F.floor(col / 10000).cast("int"), F.floor(col / 100).cast("int") % 100, col % 100)


def age_days(as_of: str, col: Column) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), col)
