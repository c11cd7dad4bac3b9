"""Day-window predicates between index dates and event dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(col: Column) -> Column:
    """DATE view of a date or timestamp column (``date - n`` needs DATE)."""
    return col.cast("date")


def days_between(later: Column, earlier: Column) -> Column:
    """``later - earlier`` in days (int); null when either is null."""
    return F.datediff(later, earlier)


def index_minus_event_within(index: Column, event: Column, days_before_index: int, days_after_index: int) -> Column:
    """Event falls from ``days_before_index`` days before the index date to
    ``days_after_index`` days after it, both ends included.

    Written on ``index - event`` as the closed range
    ``[-days_after_index, days_before_index]``.
    """
    return days_between(index, event).between(-days_after_index, days_before_index)


def event_within(index: Column, event: Column, days_before_index: int, days_after_index: int) -> Column:
    """Same window as ``index_minus_event_within``, written as date bounds on
    the event column so it can become a join condition without a function
    of both sides."""
    return (event >= F.date_sub(index, days_before_index)) & (event <= F.date_add(index, days_after_index))
