"""Rows come in the order that the reports state: neighbours never fall, NULLs come last."""

from __future__ import annotations

import pytest

from tallyframe import plans
from tallyframe.checks.queries import BUILDS, REPORT_ORDER
from tallyframe.sources import DerivedTables
from tools import day, first_fall, small_tables


@pytest.fixture(scope="module")
def derived(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for key, value in zip(before, ("5", "false")):
        spark.conf.set(key, value)
    tables = DerivedTables(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tables tune the session
    yield tables
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", REPORT_ORDER)
def test_neighbours_do_not_fall(derived, name):
    keys = REPORT_ORDER[name]
    rows = BUILDS[name](derived).collect()
    assert len(rows) > 1 or name == "property_tax_summary"
    assert first_fall([tuple(r[k] for k in keys) for r in rows]) is None


def test_order_is_told():
    assert first_fall([("a", 1), ("a", 2), ("b", None), (None, 0), (None, None)]) is None
    assert first_fall([("a", 2), ("a", 1)]) == 1
    assert first_fall([(None,), ("a",)]) == 1


def test_payments_follow_the_invoices_own_number(spark):
    """The second key is not printed: the number in the invoice register, not the one in the payment run."""
    numbers = {1: "Z", 2: "M", 3: None, 4: "B"}
    tables = small_tables(
        spark,
        ap_inv_selection_criteria_all=[dict(checkrun_id=1, checkrun_name="RUN", check_date=day("1998-02-03"), status="OK")],
        ap_selected_invoices_all=[dict(checkrun_id=1, invoice_id=i, invoice_num=f"P{i}", ok_to_pay_flag="Y") for i in numbers],
        ap_invoices_all=[dict(invoice_id=i, invoice_num=n) for i, n in numbers.items()],
    )
    rows = plans.payment_details(tables, checkruns=["RUN"]).collect()
    assert [r.invoice_num for r in rows] == ["P4", "P2", "P1", "P3"]


def test_property_tax_follows_the_text_of_the_date(spark):
    """Month first, so a later year can come first; assets of one kind before their numbers."""
    dates = ["1998-02-01", "1997-12-31", "1998-01-05"]
    tables = small_tables(
        spark,
        fa_categories_b=[dict(category_id=1, segment1="MAJ", segment2="MIN")],
        fa_additions_b=[dict(asset_id=i, asset_number=f"A{3 - i}", asset_type="CIP", asset_category_id=1) for i in (1, 2)],
        fa_books=[dict(asset_id=i, book_type_code="B") for i in (1, 2)],
        fa_transaction_headers=[
            dict(transaction_header_id=10 * i + k, asset_id=i, transaction_date_entered=day(d)) for i in (1, 2) for k, d in enumerate(dates)
        ],
        fa_distribution_history=[dict(distribution_id=i, asset_id=i, code_combination_id=1) for i in (1, 2)],
        gl_code_combinations=[dict(code_combination_id=1, segment2="5")],
        fnd_flex_values_vl=[dict(flex_value="5", description="North", value_category="Location COA")],
    )
    rows = plans.property_tax_detail(
        tables, majors=["MAJ"], minors=["MIN"], locations=["5"], from_date=day("1997-01-01"), to_date=day("1998-12-31")
    ).collect()
    assert [(r.asset_number, r.transaction_date) for r in rows] == [
        (number, date) for number in ("A1", "A2") for date in ("01/05/1998", "02/01/1998", "12/31/1997")
    ]
