"""Rules that decide the numbers, each on a few hand-made rows with the result worked out by hand."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe import plans
from tallyframe.functions import values
from tallyframe.operators.calendar import Calendar, fiscal_calendar
from tools import CALENDAR, day, records, small_tables

FROM, TO = datetime(1998, 1, 1), datetime(1998, 12, 31)
TAX = dict(majors=["MAJ"], minors=["MIN"], locations=["S", "S2"], from_date=FROM, to_date=TO)


def header(number, when="1998-02-01", kind="ADDITION", asset=1):
    return dict(
        transaction_header_id=number,
        asset_id=asset,
        transaction_date_entered=day(when),
        transaction_type_code=kind,
    )


def adjustment(number, amount=40, asset=1, distribution=5, **others):
    row = dict(
        asset_id=asset,
        distribution_id=distribution,
        transaction_header_id=number,
        source_type_code="ADDITION",
        debit_credit_flag="CR",
        adjustment_amount=amount,
        period_counter_adjusted=1,
    )
    return {**row, **others}


def charge(counter=1, when="1998-02-10", asset=1, **others):
    row = dict(
        asset_id=asset,
        book_type_code="BOOK0",
        period_counter=counter,
        deprn_source_code="DEPRN",
        deprn_run_date=day(when),
        deprn_amount=5,
        deprn_reserve=30,
        system_deprn_amount=5,
        deprn_adjustment_amount=1,
        impairment_reserve=2,
        adjusted_cost=70,
    )
    return {**row, **others}


def asset(number, **others):
    return {**dict(asset_id=number, asset_number=f"A{number}", asset_type="CAPITALIZED", asset_category_id=1), **others}


def book(number=1, **others):
    return {**dict(asset_id=number, book_type_code="BOOK0", method_id=1, cost=100, transaction_header_id_in=11), **others}


def placed(distribution=5, asset_id=1, account=7, **others):
    return {**dict(distribution_id=distribution, asset_id=asset_id, code_combination_id=account), **others}


ONE_ASSET = dict(
    CALENDAR,
    fa_additions_b=[asset(1)],
    fa_categories_b=[dict(category_id=1, segment1="MAJ", segment2="MIN")],
    fa_methods=[dict(method_id=1, life_in_months=60), dict(method_id=2, life_in_months=120)],
    fa_books=[book()],
    fa_distribution_history=[placed()],
    gl_code_combinations=[
        dict(code_combination_id=7, segment1="C", segment2="S"),
        dict(code_combination_id=8, segment1="C", segment2="S2"),
    ],
    fnd_flex_values_vl=[
        dict(flex_value="S", description="Store", value_category="Location COA"),
        dict(flex_value="S2", description="Store 2", value_category="Location COA"),
        dict(flex_value="C", description="Company", value_category="Company COA"),
    ],
    fa_transaction_headers=[header(11)],
    fa_adjustments=[adjustment(11)],
    fa_deprn_periods=[
        dict(book_type_code="BOOK0", period_counter=0, period_name="P12-97", period_open_date=day("1997-12-01")),
        dict(book_type_code="BOOK0", period_counter=1, period_name="P02-98", period_open_date=day("1998-02-01")),
    ],
    fa_deprn_summary=[charge()],
)


@pytest.fixture
def build(spark):
    return lambda **changes: small_tables(spark, **{**ONE_ASSET, **changes})


def costs(tables, **changes):
    return [row["cost"] for row in records(plans.property_tax_detail(tables, **{**TAX, **changes}))]


def test_equal_sums_of_one_day_count_once(build):
    same_day = build(fa_transaction_headers=[header(11), header(12)], fa_adjustments=[adjustment(11), adjustment(12)])
    assert costs(same_day) == [Decimal(40)]
    two_days = build(
        fa_transaction_headers=[header(11), header(12, "1998-02-02")],
        fa_adjustments=[adjustment(11), adjustment(12)],
    )
    assert costs(two_days) == [Decimal(40), Decimal(40)]


def test_adjustments_of_one_header_add_up(build):
    assert costs(build(fa_adjustments=[adjustment(11), adjustment(11), adjustment(11, debit_credit_flag="DR")])) == [80]


def test_transaction_without_adjustment_still_shows(build):
    assert costs(build(fa_adjustments=[])) == [0]


def test_books(build):
    closed = book(date_ineffective=day("1997-01-01"))
    assert costs(build(fa_books=[])) == [40]
    assert costs(build(fa_books=[]), book="BOOK0") == []
    assert costs(build(fa_books=[closed])) == []
    assert costs(build(fa_books=[closed, book()])) == [40]
    # Transactions belong to the asset, so each open book repeats them.
    assert costs(build(fa_books=[book(), book(book_type_code="BOOK1")])) == [40, 40]


def test_lists_are_required(build):
    for name in ("majors", "minors", "locations"):
        assert costs(build(), **{name: None}) == []


def test_range_includes_its_bounds_to_the_second(build):
    assert costs(build(), from_date=day("1998-02-01"), to_date=day("1998-02-01")) == [40]
    late = build(fa_transaction_headers=[header(11, "1998-12-31 00:00:01")])
    assert costs(late) == []


def test_summaries_collapse_equal_costs(build):
    two = build(
        fa_additions_b=[asset(1), asset(2)],
        fa_books=[book(1), book(2)],
        fa_distribution_history=[placed(5, 1, 7), placed(6, 2, 8)],
        fa_transaction_headers=[header(11), header(12, asset=2)],
        fa_adjustments=[adjustment(11), adjustment(12, asset=2, distribution=6)],
    )
    by_store = records(plans.property_tax_by_location(two, **TAX))
    assert [(r["store_location"], r["total_cost"]) for r in by_store] == [("Store", 40), ("Store 2", 40)]
    assert [r["total_cost"] for r in records(plans.property_tax_summary(two, **TAX))] == [40]


def rollforward(tables, **others):
    return records(plans.asset_rollforward(tables, **{**dict(year="1998", book="BOOK0"), **others}))


def test_last_day_of_the_year_is_in_no_quarter(build):
    (row,) = rollforward(build(fa_transaction_headers=[header(11, "1998-12-31")], fa_deprn_summary=[]))
    assert row["q4_additions"] == 0 and row["ending_balance"] == 100 and row["beginning_balance"] == 0
    (row,) = rollforward(build(fa_transaction_headers=[header(11, "1998-12-30")], fa_deprn_summary=[]))
    assert row["q4_additions"] == 40 and row["q4"] == 40


def test_balance_needs_the_book_row_of_the_last_transaction(build):
    (row,) = rollforward(build(fa_books=[book(transaction_header_id_in=99)]))
    assert row["ending_balance"] == 0
    later = build(fa_transaction_headers=[header(11), header(12, "1998-03-01", "ADJUSTMENT")])
    (row,) = rollforward(later)
    assert row["ending_balance"] == 0


def test_retirements_are_negated_and_reinstatements_added(build):
    tables = build(
        fa_transaction_headers=[header(11, kind="FULL RETIREMENT"), header(12, kind="REINSTATEMENT")],
        fa_adjustments=[
            adjustment(11, 40, source_type_code="RETIREMENT", adjustment_type="COST"),
            adjustment(12, 15, source_type_code="RETIREMENT", adjustment_type="COST"),
        ],
    )
    (row,) = rollforward(tables)
    assert row["q1_retirements"] == -25 and row["q1"] == -25


def test_cip_additions_count_for_cip_assets_only(build):
    rows = [adjustment(11, source_type_code="CIP ADDITION")]
    assert rollforward(build(fa_adjustments=rows))[0]["q1_additions"] == 0
    cip = build(fa_adjustments=rows, fa_additions_b=[asset(1, asset_type="CIP")])
    assert rollforward(cip)[0]["q1_additions"] == 40


def test_quarter_without_any_amount_is_null(build):
    bare = build(
        fa_transaction_headers=[header(11, kind="ADJUSTMENT")],
        fa_adjustments=[],
        fa_deprn_summary=[],
        fa_books=[book(transaction_header_id_in=99)],
    )
    (row,) = rollforward(bare)
    assert row["q1_adjustments"] is None and row["q1"] is None
    assert row["q1_additions"] == 0 and row["q2"] == 0
    # Any other branch with the same category and life absorbs the NULL.
    (row,) = rollforward(build(fa_transaction_headers=[header(11, kind="ADJUSTMENT")], fa_adjustments=[]))
    assert row["q1_adjustments"] == 0 and row["q1"] == 0


def test_depreciation_signs_and_sources(build):
    (row,) = rollforward(build())
    assert (row["q1_depreciation"], row["q1_addition_depreciation"]) == (-6, -1)
    (row,) = rollforward(build(fa_deprn_summary=[charge(deprn_source_code="BOOKS")]))
    assert (row["q1_depreciation"], row["q1_addition_depreciation"]) == (-30, 0)


def test_reserve_counts_once_per_life_in_history(build):
    history = [book(), book(method_id=1, date_ineffective=day("1997-01-01")), book(method_id=2, date_ineffective=day("1997-01-01"))]
    rows = rollforward(build(fa_books=history, fa_deprn_summary=[charge(0, deprn_reserve=30), charge(1, deprn_reserve=50)]))
    found = {r["life_in_years"]: (r["beginning_depreciation"], r["ending_depreciation"]) for r in rows}
    assert found == {Decimal("5.0"): (-30, -50), Decimal("10.0"): (-30, -50)}


def test_retired_reserve_uses_its_own_company_category(build):
    tables = build(
        fa_transaction_headers=[header(11, kind="FULL RETIREMENT")],
        fa_adjustments=[adjustment(11, 9, source_type_code="RETIREMENT", adjustment_type="RESERVE")],
        fa_retirements=[dict(asset_id=1, book_type_code="BOOK0", status="PROCESSED", transaction_header_id_in=11)],
    )
    assert rollforward(tables)[0]["q1_retirement_depreciation"] == 9
    assert rollforward(tables, company="C")[0]["q1_retirement_depreciation"] == 0
    same = rollforward(tables, company="C", retirement_company_category="Company COA")
    assert same[0]["q1_retirement_depreciation"] == 9


def test_filters_of_the_rollforward(build):
    tables = build()
    assert len(rollforward(tables, life_years="5.0", major="MAJ", asset_number="A1", company="C")) == 1
    assert rollforward(tables, life_years=Decimal("10")) == []
    assert rollforward(tables, asset_number="A9") == []
    assert rollforward(tables, company="X") == []


def test_missing_calendar(build):
    tables = build()
    assert rollforward(tables, book="BOOK9") == [] and rollforward(tables, book=None) == []
    (row,) = records(plans.cip_rollforward(tables, year="1998", book=None))
    assert set(row.values()) == {Decimal(0)}


def test_calendar_row(build):
    calendar = Calendar.read(build(), "1998", "BOOK0")
    assert calendar.q2_start_date == datetime(1998, 4, 1) and calendar.end_date == TO


def test_repeated_period_number_is_an_error(build):
    twice = [*CALENDAR["fa_calendar_periods"], {**CALENDAR["fa_calendar_periods"][3], "period_name": "X98"}]
    with pytest.raises(Exception, match="more than one period 4"):
        fiscal_calendar(build(fa_calendar_periods=twice), "1998", "BOOK0").collect()


def nbv_summary(tables, **others):
    rows = records(plans.nbv_summary(tables, **{**dict(from_date=day("1998-02-15"), to_date=TO), **others}))
    return {r["store_number"]: r["beginning_nvb"] for r in rows}


def test_net_book_value_at_start(build):
    rows = [charge(0, "1998-01-15"), charge(1, "1998-03-01", deprn_reserve=50)]
    assert nbv_summary(build(fa_deprn_summary=rows)) == {"S": Decimal(40 - 30 - 2)}


def test_reserve_is_taken_off_in_every_store(build):
    rows = [charge(0, "1998-01-15"), charge(1, "1998-03-01")]
    two = build(fa_deprn_summary=rows, fa_distribution_history=[placed(5, 1, 7), placed(6, 1, 8)])
    assert nbv_summary(two) == {"S": 8, "S2": -32}


def test_last_counter_of_another_source_leaves_no_reserve(build):
    rows = [charge(0, "1998-01-15"), charge(1, "1998-02-01", deprn_source_code="BOOKS"), charge(2, "1998-03-01")]
    assert nbv_summary(build(fa_deprn_summary=rows)) == {"S": 40}


def test_assets_sharing_a_number_repeat_per_depreciation_row(build):
    rows = [charge(0, "1998-01-15"), charge(1, "1998-03-01"), charge(2, "1998-04-01", asset=2)]
    tables = build(
        fa_additions_b=[asset(1), asset(2, asset_number="A1")],
        fa_books=[book(1), book(2)],
        fa_distribution_history=[placed(5, 1, 7), placed(6, 2, 7)],
        fa_deprn_summary=rows,
    )
    # Asset 1's line (40 - 30 - 2) and asset 2's line (0) stay apart: their rows differ in period.
    assert nbv_summary(tables) == {"S": 8}


def test_variation_needs_depreciation_and_a_store(build):
    def rows(tables, **others):
        found = records(plans.nbv_detail(tables, **{**dict(from_date=FROM, to_date=TO), **others}))
        return [(r["store_number"], r["period_month"], r["cost_variation"], r["dprn_variation"]) for r in found]

    assert rows(build()) == [("S", "P02", 40, 5)]
    assert rows(build(fa_deprn_summary=[])) == []
    storeless = build(fa_distribution_history=[])
    assert rows(storeless) == [(None, "P02", 0, 5)]
    assert rows(storeless, locations=["S"]) == []
    twins = build(
        fa_additions_b=[asset(1), asset(2)],
        fa_books=[book(1), book(2)],
        fa_distribution_history=[placed(5, 1, 7), placed(6, 2, 7)],
        fa_deprn_summary=[charge(), charge(asset=2)],
    )
    assert rows(twins) == [("S", "P02", 40, 5)]


PAYABLES = dict(
    ap_inv_selection_criteria_all=[
        dict(checkrun_id=1, checkrun_name="RUN", check_date=day("1998-07-01"), status="SELECTED")
    ],
    ap_selected_invoices_all=[
        dict(checkrun_id=1, invoice_id=n, invoice_num=f"I{n}", vendor_name="V", ok_to_pay_flag="Y", discount_amount=d)
        for n, d in ((1, 5), (2, None))
    ],
    ap_invoices_all=[
        dict(invoice_id=1, invoice_num="I1", invoice_amount=100, vendor_id=1, org_id=1),
        dict(invoice_id=2, invoice_num="I2", invoice_amount=50, amount_paid=20, vendor_id=1, org_id=1),
    ],
    gl_code_combinations=[dict(code_combination_id=7, segment2="L7"), dict(code_combination_id=8, segment2="L8")],
    ap_invoice_distributions_all=[
        dict(invoice_id=1, invoice_line_number=n, dist_code_combination_id=a, accounting_date=day("1998-02-01"))
        for n, a in ((1, 8), (1, 7), (2, 7))
    ]
    + [
        dict(invoice_id=2, invoice_line_number=1, dist_code_combination_id=99, accounting_date=day("1998-02-01")),
        dict(invoice_id=2, invoice_line_number=2, dist_code_combination_id=7, accounting_date=day("1999-02-01")),
    ],
)


def test_payment_details(spark):
    tables = small_tables(spark, **PAYABLES)
    rows = records(plans.payment_details(tables, checkruns=["RUN"]))
    assert [(r["invoice_num"], r["unpaid_amount"], r["net_amount"], r["location"]) for r in rows] == [
        ("I1", 100, 95, "L7"),
        ("I2", 30, None, None),
    ]
    assert rows[0]["check_date"] == "07/01/1998"
    assert records(plans.payment_details(tables, checkruns=None)) == []
    assert records(plans.payment_details(tables, checkruns=["RUN"], suppliers=["W"])) == []
    assert len(records(plans.payment_details(tables, checkruns=["RUN"], suppliers=["V"]))) == 2


DIRECTORY = dict(
    PAYABLES,
    poz_suppliers=[dict(vendor_id=1, party_id=10, segment1="S1", creation_date=day("1996-02-03"))],
    hz_parties=[
        dict(party_id=10, party_name="Ten", status="A", address1="1 Main", iden_addr_party_site_id=3),
    ],
    hz_party_sites=[dict(party_site_id=3, party_site_name="Site")],
    fun_all_business_units_v=[dict(bu_id=1, bu_name="Unit")],
    ap_checks_all=[dict(vendor_id=1, party_id=10, payment_id=n) for n in (1, 2, 2)],
    iby_payments_all=[dict(payment_id=n, payment_date=day("1998-03-01")) for n in (1, 2)],
)


def directory(tables, **others):
    return records(plans.supplier_directory(tables, **{**dict(from_date=FROM, to_date=TO), **others}))


def test_supplier_directory_multiplies_invoices_by_payments(spark):
    (row,) = directory(small_tables(spark, **DIRECTORY))
    # (3 x 100 + 1 x 50) distribution rows, times 3 payment rows.
    assert row["total_invoice_amount"] == 1050
    assert (row["total_invoice_count"], row["no_of_payments"], row["total_po_count"]) == (2, 2, 0)
    assert row["address"] == "Site1 Main" + " " * 7
    assert row["contact_name"] is None and row["phone"] == "  " and row["address_purpose"] is None


def test_supplier_directory_filters(spark):
    tables = small_tables(spark, **DIRECTORY)
    assert directory(tables, from_date=TO, to_date=FROM) == [] and directory(tables, from_date=None) == []
    assert directory(tables, status="I") == [] and directory(tables, business_unit=2) == []
    assert len(directory(tables, status="A", business_unit=1)) == 1
    no_status = [{**DIRECTORY["hz_parties"][0], "status": None}]
    assert directory(small_tables(spark, **{**DIRECTORY, "hz_parties": no_status})) == []


def test_cip_statuses_and_repeats(spark):
    def tables(*statuses, names=("US",)):
        items = range(1, len(statuses) + 1)
        return small_tables(
            spark,
            **CALENDAR,
            pjf_projects_all_vl=[dict(project_id=1, attribute1="1")],
            pjf_proj_elements_b=[dict(proj_element_id=2, project_id=1)],
            pjf_proj_elements_tl=[dict(proj_element_id=2, name=n, language=n) for n in names],
            pjf_project_classes=[dict(project_id=1, class_code_id=4)],
            pjf_class_codes_b=[dict(class_code_id=4)],
            pjf_class_codes_tl=[dict(class_code_id=4, class_code="Class")],
            pjc_exp_items_all=[dict(expenditure_item_id=i) for i in items],
            pjc_cost_dist_lines_all=[
                dict(project_id=1, task_id=2, expenditure_item_id=i, projfunc_raw_cost="1.005", prvdr_gl_date=day(d))
                for i in items
                for d in ("1997-12-31", "1998-02-01", "1998-12-31")
            ],
            pjc_prj_asset_ln_dets=[dict(expenditure_item_id=i, project_asset_line_detail_id=i) for i in items],
            pjc_prj_asset_lns_all=[
                dict(project_asset_line_detail_id=i, transfer_status_code=s) for i, s in zip(items, statuses)
            ],
            fnd_lookup_values=[
                dict(lookup_type="PJC_TRANSFER_STATUS", lookup_code=c, meaning=m)
                for c, m in (("P", "Pending"), ("T", "Transferred"), ("R", "Rejected"))
            ],
        )

    def figures(t):
        (row,) = records(plans.cip_rollforward(t, year="1998", book="BOOK0"))
        return [row[c] for c in ("beginning_cip", "ending_cip", "q1_cip", "q4_cip", "q1_cip_cap")]

    cost = Decimal("1.01")
    assert figures(tables("P")) == [cost, 2 * cost, cost, 0, 0]
    assert figures(tables("unknown code")) == [cost, 2 * cost, cost, 0, 0]
    assert figures(tables("T")) == [0, 0, 0, 0, -cost]
    assert figures(tables("R")) == [0, 0, 0, 0, 0]
    # A second language repeats every listing row.
    assert figures(tables("P", names=("US", "F"))) == [2 * cost, 4 * cost, 2 * cost, 0, 0]
    # The year holds its last day, the balance up to the end does not.
    sizes = [plans.cip_listing(tables("P"), year="1998", book="BOOK0", window=w).count() for w in ("beginning", "in_range", "ending")]
    assert sizes == [1, 2, 2]
    with pytest.raises(ValueError):
        plans.cip_listing(tables("P"), year="1998", book="BOOK0", window="never")


def test_values(spark):
    row = (
        spark.createDataFrame([("a", None, "  x", "P01-98", "-98", "none", 9, 10)], "a string, n string, s string, p string, q string, r string, m int, k int")
        .select(
            values.null_concat(F.col("a"), "-", F.col("n")).alias("dash"),
            values.null_concat(F.col("n"), F.col("n")).alias("nothing"),
            values.blank_to_null(F.ltrim(F.col("s"))).alias("trimmed"),
            *(values.prefix_before(F.col(c), "-").alias(c) for c in "pqr"),
            values.life_in_years(F.col("m")).alias("nine"),
            values.life_in_years(F.col("k")).alias("ten"),
            values.date_text(F.lit("1998-02-01 10:00:00").cast("timestamp_ntz")).alias("day"),
            F.round(F.lit("-2.345").cast("decimal(22,6)"), 2).cast("string").alias("half"),
            values.signed(F.lit(5), F.col("a"), plus="b", minus="c").alias("unsigned"),
        )
        .first()
        .asDict()
    )
    assert row == dict(
        dash="a-", nothing=None, trimmed="x", p="P01", q=None, r=None, nine=Decimal("0.8"), ten=Decimal("0.8"),
        day="02/01/1998", half="-2.35", unsigned=None,
    )


def test_supplier_list_that_means_all(spark):
    nameless = [dict(r, vendor_name=None) if r["invoice_id"] == 2 else r for r in PAYABLES["ap_selected_invoices_all"]]
    tables = small_tables(spark, **{**PAYABLES, "ap_selected_invoices_all": nameless})
    for suppliers in (None, [], ["W", None]):
        assert len(records(plans.payment_details(tables, checkruns=["RUN"], suppliers=suppliers))) == 2
    assert len(records(plans.payment_details(tables, checkruns=["RUN"], suppliers=["V"]))) == 1


@pytest.mark.parametrize("invoices", [[], [dict(invoice_id=70, vendor_id=1)]])
def test_account_of_an_invoice_that_may_be_missing(spark, invoices):
    tables = small_tables(
        spark,
        **CALENDAR,
        pjf_projects_all_vl=[dict(project_id=1)],
        pjf_proj_elements_b=[dict(proj_element_id=2, project_id=1)],
        pjf_proj_elements_tl=[dict(proj_element_id=2, name="T")],
        pjf_project_classes=[dict(project_id=1, class_code_id=4)],
        pjf_class_codes_b=[dict(class_code_id=4)],
        pjf_class_codes_tl=[dict(class_code_id=4, class_code="Class")],
        pjc_exp_items_all=[dict(expenditure_item_id=1, original_header_id=70)],
        pjc_cost_dist_lines_all=[
            dict(project_id=1, task_id=2, expenditure_item_id=1, projfunc_raw_cost=1, prvdr_gl_date=day("1998-02-01"))
        ],
        ap_invoices_all=invoices,
        ap_invoice_distributions_all=[dict(invoice_id=70, accounting_event_id=9)],
        xla_ae_headers=[dict(ae_header_id=3, event_id=9)],
        xla_ae_lines=[dict(ae_header_id=3, accounted_dr=1, code_combination_id=5)],
        gl_code_combinations=[dict(code_combination_id=5, segment1="01", segment2="02")],
    )
    (row,) = records(plans.cip_listing(tables, year="1998", book="BOOK0"))
    assert row["raw_cost_debit_acct"] == "01-02-----"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_weights_beyond_twelve_digits(spark, ansi):
    kept = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = spark.createDataFrame([(Decimal("0.25"), 10**12)], "amount decimal(18,2), n bigint")
        product = rows.select((F.col("amount") * F.col("n").cast("decimal(20,0)")).alias("x")).first().x
    finally:
        spark.conf.set("spark.sql.ansi.enabled", kept)
    assert product == 250_000_000_000


def test_asset_numbers_of_large_keys_stay_apart(spark, tmp_path):
    from tallyframe.sources import DerivedTables

    keys = [7, 123456, 1234567, 12345678, 99999, 100000]
    spark.createDataFrame([(k, 1) for k in keys], "p_partkey bigint, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    numbers = {r.asset_id: r.asset_number for r in DerivedTables(spark, str(tmp_path))["fa_additions_b"].collect()}
    assert numbers == {7: "A000007", 123456: "A123456", 1234567: "A1234567", 12345678: "A12345678", 99999: "A099999", 100000: "A100000"}
