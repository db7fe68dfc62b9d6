"""Fiscal calendar: the one-row date frame and the quarter logic built on it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.predicates import moment
from tallyframe.functions.values import MONEY
from tallyframe.sources.registry import TableSet

QUARTERS = (1, 2, 3, 4)

# Output column -> (period number that supplies it, column of that period).
DATE_SLOTS = {
    "start_date": (1, "start_date"),
    "end_date": (12, "end_date"),
    "q1_start_date": (1, "start_date"),
    "q2_start_date": (4, "start_date"),
    "q3_start_date": (7, "start_date"),
    "q4_start_date": (10, "start_date"),
}


def fiscal_calendar(tables: TableSet, year: str | None, book: str | None) -> DataFrame:
    """One row with the six dates of the fiscal ``year`` of ``book``; no row where there is no calendar.

    Periods belong to the year when their name contains its last two digits.  The calendar type is the
    first by (book, fiscal year name, calendar type, period number).  A period number that occurs twice in
    the year has no single date, which is an error.
    """
    digits = (year or "")[2:]
    periods = tables["fa_calendar_periods"].filter(F.col("period_name").contains(digits))
    chosen = (
        tables["fa_book_controls"]
        .filter(F.col("book_type_code") == F.lit(book))
        .join(tables["fa_calendar_types"], "fiscal_year_name")
        .join(periods.select("calendar_type", "period_num"), "calendar_type")
        .orderBy(
            *(F.col(c).asc_nulls_last() for c in ("book_type_code", "fiscal_year_name", "calendar_type", "period_num"))
        )
        .limit(1)
        .select("calendar_type")
    )

    def single(name: str) -> Column:
        number, column = DATE_SLOTS[name]
        is_period = F.col("period_num") == number
        message = f"more than one period {number} in fiscal year {year!r}"
        return (
            F.when(F.count_if(is_period) > 1, F.raise_error(F.lit(message)).cast("timestamp_ntz"))
            .otherwise(F.max(F.when(is_period, F.col(column))))
            .alias(name)
        )

    return (
        periods.join(chosen, "calendar_type")
        .groupBy("calendar_type")
        .agg(*(single(name) for name in DATE_SLOTS))
        .drop("calendar_type")
    )


@dataclass(frozen=True)
class Calendar:
    """The collected date row.  As literals the dates reach the scans, which a joined row would not."""

    start_date: datetime | None
    end_date: datetime | None
    q1_start_date: datetime | None
    q2_start_date: datetime | None
    q3_start_date: datetime | None
    q4_start_date: datetime | None

    @classmethod
    def read(cls, tables: TableSet, year: str | None, book: str | None) -> Calendar | None:
        if book is None:
            return None
        row = fiscal_calendar(tables, year, book).first()
        return cls(**row.asDict()) if row else None

    @property
    def start(self) -> Column:
        return moment(self.start_date)

    @property
    def end(self) -> Column:
        return moment(self.end_date)

    def in_year(self, column: Column) -> Column:
        """Whole year, last day included."""
        return (column >= self.start) & (column <= self.end)

    def in_quarter(self, column: Column, quarter: int) -> Column:
        """Half-open quarter.  The fourth ends before the last day, unlike :meth:`in_year`."""
        starts = [moment(getattr(self, f"q{q}_start_date")) for q in QUARTERS]
        bounds = [*starts, self.end]
        return (column >= bounds[quarter - 1]) & (column < bounds[quarter])

    def quarter_mask(self, column: Column) -> Column:
        """Bit k-1 is set when the date lies in quarter k; a small grouping key that stands for the date."""
        bits = [F.when(self.in_quarter(column, q), F.lit(1 << (q - 1))).otherwise(F.lit(0)) for q in QUARTERS]
        return bits[0] + bits[1] + bits[2] + bits[3]


def quarter_sums(amount: str, name: str, mask: str = "quarters") -> list[Column]:
    """Four sums of the expression ``amount`` by the bits of ``mask``.

    Rows outside the quarter count as zero, not as NULL.
    """
    return [
        F.expr(f"cast(sum(if(getbit({mask}, {q - 1}) = 1, {amount}, 0)) as {MONEY}) as q{q}_{name}") for q in QUARTERS
    ]
