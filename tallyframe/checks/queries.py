"""Registered queries: every report with its default parameters, and every shared operator on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe import plans
from tallyframe.functions.predicates import one_of, one_of_or_all, optional_eq, within
from tallyframe.functions.values import (
    account_string,
    date_text,
    life_in_years,
    money,
    prefix_before,
    signed,
    zero_if_null,
)
from tallyframe.operators.assets import adjustment_components, current_books, headers_where
from tallyframe.operators.calendar import Calendar, fiscal_calendar, quarter_sums
from tallyframe.operators.combine import left_join_spreading_nulls, zero_pad_union
from tallyframe.operators.keyed import current_rows, last_before, latest_rows
from tallyframe.plans.cip import asset_status, event_accounts
from tallyframe.plans.payables import first_line_location
from tallyframe.plans.rollforward import TRANSACTION_TYPES
from tallyframe.sources import DerivedTables, TableSet

YEAR, BOOK, COMPANY = "1998", "BOOK0", "1"
FROM, TO = datetime(1998, 1, 1), datetime(1998, 12, 31)
SUPPLIERS_TO = datetime(1998, 3, 31)
MAJORS = [f"MAJ{i}" for i in range(4)]
MINORS = [f"MIN{i}" for i in range(10)]
LOCATIONS = [str(i) for i in range(25)]
TWO_STORES = ["1", "2"]
CHECKRUNS = ["RUN 1-URGENT", "RUN 5-LOW"]
NO_BOOK = "NO SUCH BOOK"
ONE_MAJOR, ASSET_TYPE, LIFE, ASSET_NUMBER = "MAJ1", "CAPITALIZED", "0.9", "A000012"
VENDORS = ["Supplier#000000003", "Supplier#000000014", "Supplier#000000028"]
STATUS, UNIT = "A", 2

PROPERTY_TAX = dict(majors=MAJORS, minors=MINORS, locations=LOCATIONS, from_date=FROM, to_date=TO)
RANGE = dict(from_date=FROM, to_date=TO)
YEAR_BOOK = dict(year=YEAR, book=BOOK)

Build = Callable[[TableSet], DataFrame]


def _labelled_counts(frames: dict[str, DataFrame]) -> DataFrame:
    counted = (
        frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(label).alias("filter"), "n_rows")
        for label, frame in frames.items()
    )
    return reduce(DataFrame.unionByName, counted)


def _optional_filter(t: TableSet) -> DataFrame:
    return _labelled_counts(
        {"book given": optional_eq(t["fa_books"], "book_type_code", BOOK), "all": optional_eq(t["fa_books"], "book_type_code", None)}
    )


def _multi_select(t: TableSet) -> DataFrame:
    codes = t["fnd_flex_values_vl"]
    value = F.col("flex_value")
    return _labelled_counts(
        {
            "listed": codes.filter(one_of(value, TWO_STORES)),
            "no list": codes.filter(one_of(value, None)),
            "no list means all": one_of_or_all(codes, "flex_value", None),
            "null in list means all": one_of_or_all(codes, "flex_value", ["1", None]),
        }
    )


def _date_range_filter(t: TableSet) -> DataFrame:
    rows = t["fa_transaction_headers"].filter(within(F.col("transaction_date_entered"), FROM, TO))
    return rows.groupBy("transaction_type_code").agg(F.count(F.lit(1)).alias("n_rows"))


def _range_join_params(t: TableSet) -> DataFrame:
    calendar = Calendar.read(t, YEAR, BOOK)
    rows = t["fa_deprn_periods"].filter(calendar.in_year(F.col("period_open_date")))
    return rows.select("book_type_code", "period_counter", "period_name")


def _quarter_buckets(t: TableSet) -> DataFrame:
    calendar = Calendar.read(t, YEAR, BOOK)
    rows = t["fa_deprn_summary"].select(
        "book_type_code", "deprn_amount", calendar.quarter_mask(F.col("deprn_run_date")).alias("quarters")
    )
    return rows.groupBy("book_type_code").agg(*quarter_sums("deprn_amount", "amount"))


def _current_books(t: TableSet) -> DataFrame:
    return current_books(t, None, keep_bookless=True)


def _current_rows(t: TableSet) -> DataFrame:
    return current_rows(t["fa_distribution_history"]).select("distribution_id", "asset_id", "code_combination_id")


def _conditional_outer_join(t: TableSet) -> DataFrame:
    companies = (
        t["fnd_flex_values_vl"]
        .filter(F.col("value_category") == "Company COA")
        .select(F.col("flex_value").alias("segment1"), F.col("description").alias("company"))
    )
    accounts = t["gl_code_combinations"].select("code_combination_id", "segment1")
    placed = left_join_spreading_nulls(
        t["fa_distribution_history"].select("distribution_id", "code_combination_id"), accounts, ["code_combination_id"]
    )
    return left_join_spreading_nulls(placed, companies, ["segment1"]).select("distribution_id", "segment1", "company")


def _latest_distribution(t: TableSet) -> DataFrame:
    rows = latest_rows(current_rows(t["fa_distribution_history"]), "asset_id", "distribution_id")
    return rows.select("asset_id", "distribution_id", "code_combination_id")


def _asof_transaction(t: TableSet) -> DataFrame:
    calendar = Calendar.read(t, YEAR, BOOK)
    when = F.col("transaction_date_entered")
    return last_before(
        t["fa_transaction_headers"].filter(F.col("transaction_type_code").isin(*TRANSACTION_TYPES)),
        "asset_id",
        ("transaction_date_entered", "transaction_header_id"),
        {"beginning": when < calendar.start, "ending": when <= calendar.end},
    ).select("asset_id", "cutoff", date_text(F.col("transaction_date_entered")).alias("entered"), "transaction_header_id")


def _asof_period(t: TableSet) -> DataFrame:
    calendar = Calendar.read(t, YEAR, BOOK)
    opened = F.col("period_open_date")
    rows = t["fa_deprn_summary"].join(
        t["fa_deprn_periods"].select("book_type_code", "period_counter", "period_open_date"),
        ["book_type_code", "period_counter"],
    )
    return last_before(
        rows,
        ["asset_id", "book_type_code"],
        ("period_open_date",),
        {"beginning": opened < calendar.start, "ending": opened <= calendar.end},
    ).select("asset_id", "book_type_code", "cutoff", date_text(F.col("period_open_date")).alias("opened"))


def _adjustment_components(t: TableSet) -> DataFrame:
    rows = adjustment_components(t, headers_where(t, F.col("transaction_date_entered").isNotNull()))
    entered = date_text(F.col("transaction_date")).alias("entered")
    return rows.select("asset_id", "distribution_id", "transaction_header_id", entered, "component", "value")


def _grouped_sum(t: TableSet) -> DataFrame:
    return (
        t["fa_adjustments"]
        .groupBy("source_type_code", "adjustment_type")
        .agg(money(F.sum("adjustment_amount")).alias("amount"))
    )


def _sum_distinct(t: TableSet) -> DataFrame:
    return (
        t["fa_adjustments"]
        .groupBy("source_type_code")
        .agg(
            money(F.sum_distinct("adjustment_amount")).alias("distinct_amount"),
            money(F.sum("adjustment_amount")).alias("amount"),
        )
    )


def _multi_count_distinct(t: TableSet) -> DataFrame:
    invoices = t["ap_invoices_all"].select("invoice_id", "vendor_id", zero_if_null(F.col("invoice_amount")).alias("amount"))
    rows = t["ap_invoice_distributions_all"].join(invoices, "invoice_id")
    return rows.groupBy("vendor_id").agg(
        F.count_distinct("invoice_id").alias("invoices"),
        F.count_distinct("po_distribution_id").alias("orders"),
        F.count_distinct("dist_code_combination_id").alias("accounts"),
        money(F.sum("amount")).alias("amount"),
    )


def _global_agg_empty(t: TableSet) -> DataFrame:
    rows = t["fa_books"].filter(F.col("book_type_code") == NO_BOOK)
    return rows.agg(money(zero_if_null(F.sum("cost"))).alias("cost"), F.count(F.lit(1)).alias("n_rows"))


def _group_distinct(t: TableSet) -> DataFrame:
    return t["fa_deprn_summary"].select("book_type_code", "period_counter", "deprn_source_code").distinct()


def _signed_amount(t: TableSet) -> DataFrame:
    amount = F.col("adjustment_amount")
    return (
        t["fa_adjustments"]
        .groupBy("source_type_code")
        .agg(
            money(F.sum(signed(amount, F.col("source_dest_code"), plus="DEST", minus="SOURCE"))).alias("transferred"),
            money(F.sum(signed(amount, F.col("debit_credit_flag"), plus="CR", minus="DR"))).alias("credited"),
        )
    )


def _null_concat(t: TableSet) -> DataFrame:
    accounts = t["gl_code_combinations"]
    return accounts.select("code_combination_id", account_string(accounts).alias("account"))


def _period_prefix(t: TableSet) -> DataFrame:
    return t["fa_deprn_periods"].select(
        "book_type_code", "period_counter", prefix_before(F.col("period_name"), "-").alias("period_month")
    )


def _date_text(t: TableSet) -> DataFrame:
    rows = t["fa_transaction_headers"].groupBy(date_text(F.col("transaction_date_entered")).alias("transaction_date"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


def _life_in_years(t: TableSet) -> DataFrame:
    return t["fa_methods"].select("method_id", life_in_years(F.col("life_in_months")).alias("life_in_years"))


def _zero_pad_union(t: TableSet) -> DataFrame:
    books = t["fa_books"].groupBy("book_type_code").agg(F.sum("cost").alias("cost"))
    reserves = t["fa_deprn_summary"].groupBy("book_type_code").agg(F.sum("deprn_reserve").alias("reserve"))
    return zero_pad_union([books, reserves], ["book_type_code"], ["cost", "reserve"])


BUILDS: dict[str, Build] = {
    # Reports.
    "property_tax_detail": lambda t: plans.property_tax_detail(t, **PROPERTY_TAX),
    "property_tax_by_location": lambda t: plans.property_tax_by_location(t, **PROPERTY_TAX),
    "property_tax_summary": lambda t: plans.property_tax_summary(t, **PROPERTY_TAX),
    "property_tax_detail_filtered": lambda t: plans.property_tax_detail(
        t, **PROPERTY_TAX | dict(majors=[ONE_MAJOR]), book=BOOK, asset_type=ASSET_TYPE
    ),
    "asset_rollforward_filtered": lambda t: plans.asset_rollforward(t, **YEAR_BOOK, major=ONE_MAJOR, life_years=LIFE),
    "asset_rollforward_asset": lambda t: plans.asset_rollforward(t, **YEAR_BOOK, asset_number=ASSET_NUMBER),
    "asset_rollforward_no_calendar": lambda t: plans.asset_rollforward(t, year=YEAR, book=NO_BOOK),
    "cip_rollforward_no_calendar": lambda t: plans.cip_rollforward(t, year=YEAR, book=NO_BOOK),
    "nbv_detail_book": lambda t: plans.nbv_detail(t, **RANGE, book=BOOK),
    "nbv_summary_book": lambda t: plans.nbv_summary(t, **RANGE, book=BOOK),
    "payment_details_suppliers": lambda t: plans.payment_details(t, checkruns=CHECKRUNS, suppliers=VENDORS),
    "payment_details_all_suppliers": lambda t: plans.payment_details(t, checkruns=CHECKRUNS, suppliers=[*VENDORS, None]),
    "supplier_directory_filtered": lambda t: plans.supplier_directory(
        t, from_date=FROM, to_date=SUPPLIERS_TO, status=STATUS, business_unit=UNIT
    ),
    "supplier_directory_reversed": lambda t: plans.supplier_directory(t, from_date=SUPPLIERS_TO, to_date=FROM),
    "asset_rollforward": lambda t: plans.asset_rollforward(t, **YEAR_BOOK),
    "asset_rollforward_company": lambda t: plans.asset_rollforward(t, **YEAR_BOOK, company=COMPANY),
    "cip_rollforward": lambda t: plans.cip_rollforward(t, **YEAR_BOOK),
    "cip_rollforward_company": lambda t: plans.cip_rollforward(t, **YEAR_BOOK, company=COMPANY),
    "cip_listing_beginning": lambda t: plans.cip_listing(t, **YEAR_BOOK, window="beginning"),
    "cip_listing_in_range": lambda t: plans.cip_listing(t, **YEAR_BOOK, window="in_range"),
    "cip_listing_ending": lambda t: plans.cip_listing(t, **YEAR_BOOK, window="ending"),
    "nbv_detail": lambda t: plans.nbv_detail(t, **RANGE),
    "nbv_detail_locations": lambda t: plans.nbv_detail(t, **RANGE, locations=TWO_STORES),
    "nbv_summary": lambda t: plans.nbv_summary(t, **RANGE),
    "nbv_summary_locations": lambda t: plans.nbv_summary(t, **RANGE, locations=TWO_STORES),
    "payment_details": lambda t: plans.payment_details(t, checkruns=CHECKRUNS),
    "supplier_directory": lambda t: plans.supplier_directory(t, from_date=FROM, to_date=SUPPLIERS_TO),
    # Operators.
    "fiscal_calendar": lambda t: fiscal_calendar(t, YEAR, BOOK),
    "optional_filter": _optional_filter,
    "multi_select": _multi_select,
    "date_range_filter": _date_range_filter,
    "range_join_params": _range_join_params,
    "quarter_buckets": _quarter_buckets,
    "current_rows": _current_rows,
    "current_books": _current_books,
    "conditional_outer_join": _conditional_outer_join,
    "latest_distribution": _latest_distribution,
    "asof_transaction": _asof_transaction,
    "asof_period": _asof_period,
    "adjustment_components": _adjustment_components,
    "asset_status": asset_status,
    "event_accounts": event_accounts,
    "first_line_location": first_line_location,
    "grouped_sum": _grouped_sum,
    "sum_distinct": _sum_distinct,
    "multi_count_distinct": _multi_count_distinct,
    "global_agg_empty": _global_agg_empty,
    "group_distinct": _group_distinct,
    "signed_amount": _signed_amount,
    "null_concat": _null_concat,
    "period_prefix": _period_prefix,
    "date_text": _date_text,
    "life_in_years": _life_in_years,
    "zero_pad_union": _zero_pad_union,
}


#: Sort keys of the reports as printed.  Payments are sorted by the register's invoice number, which the derived tables
#: repeat in the payment run; the directory has one key, and rows of one supplier in any order.
REPORT_ORDER: dict[str, tuple[str, ...]] = {
    "property_tax_detail": (
        "asset_book", "asset_type", "major_asset_category", "minor_asset_category", "asset_number", "transaction_date", "store_location",
    ),
    "property_tax_by_location": ("major_asset_category", "minor_asset_category", "store_location"),
    "property_tax_summary": ("major_asset_category", "minor_asset_category"),
    "asset_rollforward": ("major_asset_category", "life_in_years"),
    "nbv_detail": ("asset_book", "store_number", "store_location", "period_name"),
    "nbv_summary": ("asset_book", "store_number"),
    "payment_details": ("checkrun_name", "invoice_num"),
    "supplier_directory": ("supplier_number",),
}


@lru_cache
def derived(spark: SparkSession, directory: str) -> DerivedTables:
    """One table set per session and directory, so that its tables are opened once."""
    return DerivedTables(spark, directory)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Build) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, directory: build(derived(spark, directory))

    return {name: runner(build) for name, build in BUILDS.items()}
