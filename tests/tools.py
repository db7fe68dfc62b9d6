"""Small input tables for tests, and a plain form of results for comparison."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from tallyframe.sources.registry import TableSet
from tallyframe.sources.schemas import SCHEMAS


class SmallTables(TableSet):
    """Rows held as local Arrow data, turned into frames when a report asks for them."""

    def __init__(self, spark, rows: dict[str, list[dict]]):
        super().__init__(spark, {})
        self._rows = rows

    def _load(self, name: str):
        schema = self.schema(name)
        rows = self._rows.get(name, [])
        for row in rows:
            assert set(row) <= set(schema.names), (name, row)
        kinds = {f.name: f.dataType.simpleString() for f in schema}
        data = [{c: _typed(row.get(c), kind) for c, kind in kinds.items()} for row in rows]
        return self.spark.createDataFrame(pa.Table.from_pylist(data, schema=to_arrow_schema(schema)), schema)


def small_tables(spark, **rows: list[dict]) -> TableSet:
    """A table set with the given rows; columns left out are NULL and tables left out are empty."""
    assert set(rows) <= set(SCHEMAS), set(rows) - set(SCHEMAS)
    return SmallTables(spark, rows)


def _typed(value, kind: str):
    if value is not None and kind.startswith("decimal"):
        return Decimal(str(value))
    return value


def day(text: str) -> datetime:
    return datetime.fromisoformat(text)


def plain(rows, columns: list[str]):
    """Columns by name and rows as sorted text, whatever engine they came from."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(row[i]) for i in order) for row in rows)


def first_fall(keys: list[tuple]) -> int | None:
    """Where the first row stands whose key is below the one before it, NULLs last; None in an ordered list."""
    ranked = [tuple((value is None, value if value is not None else 0) for value in key) for key in keys]
    return next((at for at in range(1, len(ranked)) if ranked[at] < ranked[at - 1]), None)


def records(frame) -> list[dict]:
    return [row.asDict() for row in frame.collect()]


CALENDAR = dict(
    fa_book_controls=[dict(book_type_code="BOOK0", fiscal_year_name="FY")],
    fa_calendar_types=[dict(fiscal_year_name="FY", calendar_type="MONTHLY")],
    fa_calendar_periods=[
        dict(
            calendar_type="MONTHLY",
            period_name=f"P{m:02d}-98",
            period_num=m,
            start_date=datetime(1998, m, 1),
            end_date=datetime(1998, 12, 31) if m == 12 else datetime(1998, m, 28),
        )
        for m in range(1, 13)
    ],
)
