"""Optional and multi-valued report filters.

A filter that is switched off adds no predicate at all, so the plan stays as if it had never been written.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def optional_eq(frame: DataFrame, column: str | Column, value: Any | None) -> DataFrame:
    """Keep rows equal to ``value``; no value keeps every row, also those with NULL."""
    if value is None:
        return frame
    return frame.filter((F.col(column) if isinstance(column, str) else column) == F.lit(value))


def eq_or_present(column: Column, value: Any | None) -> Column:
    """Equal to ``value``; without a value the column still has to be present (NULL is dropped)."""
    return column.isNotNull() if value is None else column == F.lit(value)


def one_of(column: Column, values: Sequence[Any] | None) -> Column:
    """Membership; no list, or an empty one, matches nothing."""
    wanted = [v for v in values or () if v is not None]
    return column.isin(*wanted) if wanted else F.lit(False)


def one_of_or_all(frame: DataFrame, column: str, values: Sequence[Any] | None) -> DataFrame:
    """Membership; no list, or a list that holds NULL, keeps every row."""
    if not values or None in values:
        return frame
    return frame.filter(F.col(column).isin(*values))


def moment(value: datetime | None) -> Column:
    """A zone-less timestamp literal, NULL where there is none."""
    return F.lit(None if value is None else value.isoformat(" ")).cast("timestamp_ntz")


def within(column: Column, start: datetime | None, end: datetime | None) -> Column:
    """Closed range; a missing bound matches nothing."""
    return (column >= moment(start)) & (column <= moment(end))
