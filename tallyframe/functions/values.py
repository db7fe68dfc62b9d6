"""Value expressions with the null, text and rounding rules that the reports were written for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def money(column: Column) -> Column:
    """Every reported amount has this one type, wide enough for sums over any number of rows."""
    return column.cast(MONEY)


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("decimal(1,0)"))


def blank_to_null(text: Column) -> Column:
    """A finished empty string counts as NULL."""
    return F.nullif(text, F.lit(""))


def null_concat(*parts: Column | str) -> Column:
    """Concatenate, reading NULL as the empty string, so that literal separators stay.

    Strings are literals and columns are values.
    """
    texts = [F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts]
    return blank_to_null(F.concat(*texts))


def date_text(column: Column) -> Column:
    """Month/day/year with leading zeros."""
    return F.date_format(column, "MM/dd/yyyy")


def prefix_before(text: Column, mark: str) -> Column:
    """Text before the first ``mark``; NULL where that would be empty or the mark is absent."""
    place = F.instr(text, mark)
    return F.when(place > 1, F.substr(text, F.lit(1), place - 1))


def life_in_years(months: Column) -> Column:
    """Months as years with one decimal, halves rounded away from zero."""
    return F.round(months.cast("decimal(10,0)") / F.lit(12), 1).cast("decimal(12,1)")


def signed(amount: Column, code: Column, *, plus: str, minus: str) -> Column:
    """``amount`` or its negation by ``code``; NULL (skipped by sums) for any other code."""
    return F.when(code == plus, amount).when(code == minus, -amount)


def account_string(frame, prefix: str = "segment") -> Column:
    """The seven account segments joined with dashes; missing segments leave their dash."""
    parts: list[Column | str] = [frame[f"{prefix}1"]]
    for i in range(2, 8):
        parts += ["-", frame[f"{prefix}{i}"]]
    return null_concat(*parts)
