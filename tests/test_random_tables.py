"""Every report and operator against naive SQL, on small random tables.

The tables are nastier than real ones: NULLs in every column, duplicate rows, repeated keys, several assets with
one number, dates on every boundary.
"""

from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

from tallyframe.checks import sql
from tallyframe.checks.queries import BUILDS
from tallyframe.sources.derived import SAME_ROWS
from tallyframe.sources.registry import TableSet
from tallyframe.sources.schemas import SCHEMAS
from tools import CALENDAR, plain, small_tables

DATES = [
    datetime(1997, 6, 15),
    datetime(1997, 12, 31),
    datetime(1997, 12, 31, 23, 59, 59),
    datetime(1998, 1, 1),
    datetime(1998, 1, 1, 8, 30),
    datetime(1998, 3, 31),
    datetime(1998, 4, 1),
    datetime(1998, 9, 30, 23),
    datetime(1998, 10, 1),
    datetime(1998, 12, 30),
    datetime(1998, 12, 31),
    datetime(1998, 12, 31, 1),
    datetime(1999, 1, 2),
]
MEANINGS = ["Pending", "Transferred", "Rejected"]
POOLS = {
    "asset_number": ["A1", "A2", "A3"],
    "asset_type": ["CIP", "CAPITALIZED"],
    "book_type_code": ["BOOK0", "BOOK0", "BOOK1"],
    "transaction_type_code": [
        "ADDITION",
        "CIP ADDITION",
        "ADJUSTMENT",
        "PARTIAL RETIREMENT",
        "FULL RETIREMENT",
        "REINSTATEMENT",
        "TRANSFER",
    ],
    "source_type_code": ["ADDITION", "CIP ADDITION", "ADJUSTMENT", "CIP ADJUSTMENT", "RETIREMENT", "CIP RETIREMENT"],
    "adjustment_type": ["COST", "CIP COST", "COST CLEARING", "NBV RETIRED", "RESERVE"],
    "source_dest_code": ["DEST", "SOURCE", "OTHER", None, None],
    "debit_credit_flag": ["CR", "DR", "XX"],
    "deprn_source_code": ["DEPRN", "DEPRN", "BOOKS"],
    "status": ["PROCESSED", "PENDING", "A"],
    "life_in_months": [9, 10, 3, 60],
    "period_counter": [1, 2, 3],
    "period_counter_adjusted": [1, 2, 3],
    "period_name": ["P01-98", "P02-98", "NODASH", "-98"],
    "value_category": ["Location COA", "Company COA", "Company Northgate COA"],
    "flex_value": ["1", "2", "3"],
    "description": ["North", "South"],
    "lookup_type": ["PAY GROUP", "PJF_SERVICE_TYPE", "PJC_TRANSFER_STATUS"],
    "lookup_code": ["X", "Y", "Z"],
    "transfer_status_code": ["X", "Y", "Z"],
    "service_type_code": ["X", "Y", "Z"],
    "pay_group_lookup_code": ["X", "Y", "Z"],
    "meaning": MEANINGS,
    "class_code": ["Task Level", "Class"],
    "accounting_status_code": ["RNBNN", "A"],
    "override_reason": [None, None, "X"],
    "attribute1": ["1", "2"],
    "checkrun_name": ["RUN 1-URGENT", "RUN 5-LOW", "RUN 9"],
    "ok_to_pay_flag": ["Y", "Y", "N"],
    "invoice_line_number": [1, 2],
    "payment_method_code": ["M1", "M2"],
    "language": ["US", "F"],
}
CATEGORY_SEGMENTS = {"segment1": ["MAJ0", "MAJ1", "OTHER"], "segment2": ["MIN0", "MIN1"]}
# Declared unique by the source system where the report would fail on repeats.
UNIQUE = {"gl_code_combinations": "code_combination_id"}
SIZES = {"fa_adjustments": 30, "fa_transaction_headers": 14, "fa_deprn_summary": 16, "pjc_cost_dist_lines_all": 14}
NAMES = list(BUILDS)


def value(rng: random.Random, table: str, column: str, kind: str):
    if rng.random() < 0.08:
        return None
    if table == "fa_categories_b" and column in CATEGORY_SEGMENTS:
        return rng.choice(CATEGORY_SEGMENTS[column])
    if table == "hz_parties" and column == "status":
        return "A"
    if column in POOLS:
        return rng.choice(POOLS[column])
    if column.startswith("segment"):
        return rng.choice(["1", "2", "3"])
    if column.startswith("address_purpose"):
        return rng.choice(["Y", "N"])
    if kind == "timestamp_ntz":
        return rng.choice([None, None, datetime(1997, 1, 1)]) if column == "date_ineffective" else rng.choice(DATES)
    if kind == "bigint":
        return rng.randint(1, 3)
    if kind == "int":
        return rng.randint(1, 12)
    if kind.startswith("decimal(22"):
        return rng.choice([Decimal("10.125000"), Decimal("-2.345000"), Decimal("7.004999"), Decimal("3")])
    if kind.startswith("decimal"):
        return rng.choice([Decimal("10.00"), Decimal("10.00"), Decimal("-4.50"), Decimal("0.00"), Decimal("7.25")])
    return rng.choice(["p", "q"])


def world(seed: int) -> dict[str, list[dict]]:
    rng = random.Random(seed)
    tables = dict(CALENDAR)
    for name in SCHEMAS:
        if name in tables or name in SAME_ROWS:
            continue
        fields = TableSet.schema(name)
        rows = [
            {f.name: value(rng, name, f.name, f.dataType.simpleString()) for f in fields}
            for _ in range(SIZES.get(name, 8))
        ]
        if name in UNIQUE:
            rows = list({row[UNIQUE[name]]: row for row in rows}.values())
        if name == "fa_additions_b" and seed % 2 == 0:
            # Every second world has a number per asset, as real registers do.
            for row in rows:
                row["asset_number"], row["asset_type"] = f"A{row['asset_id']}", "CIP"
        tables[name] = rows
    for name, base in SAME_ROWS.items():
        tables[name] = tables[base]
    return tables


def load(connection, tables: dict[str, list[dict]]) -> None:
    for name, rows in tables.items():
        data = pa.Table.from_pylist(rows, schema=to_arrow_schema(TableSet.schema(name)))
        connection.register("incoming", data)
        connection.execute(f"create table {name} as select * from incoming")
        connection.unregister("incoming")


@pytest.fixture(scope="module", params=[1, 2])
def sides(request, spark):
    tables = world(request.param)
    connection = duckdb.connect()
    load(connection, tables)
    yield small_tables(spark, **tables), connection
    connection.close()


@pytest.mark.parametrize("name", NAMES)
def test_same_as_naive_sql(sides, name):
    tables, connection = sides
    frame = BUILDS[name](tables)
    result = connection.execute(sql.over_tables(name))
    expected = plain(result.fetchall(), [d[0] for d in result.description])
    assert plain(frame.collect(), frame.columns) == expected
