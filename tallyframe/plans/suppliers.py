"""Supplier directory with invoice, payment and purchase-order totals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.predicates import eq_or_present, within
from tallyframe.functions.values import blank_to_null, date_text, money, null_concat, zero_if_null
from tallyframe.operators.combine import at_least_one, left_join_spreading_nulls, row_weights
from tallyframe.sources.registry import TableSet
from tallyframe.sources.scratch import stored

# Printed for each supplier, in report order.
SUPPLIER_COLUMNS = (
    "supplier_number",
    "supplier_name",
    "supplier_type",
    "address",
    "contact_name",
    "phone",
    "email",
    "federal_income_tax_type",
    "taxpayer_id",
    "creation_date",
    "parent_supplier",
    "alternate_name",
    "address_purpose",
)
INVOICE_COLUMNS = ("business_unit", "method_of_payment", "payment_terms", "pay_group")


def _supplier_rows(tables: TableSet, status: str | None, paid: DataFrame) -> DataFrame:
    """Master rows of suppliers in ``paid`` (vendor, party) with everything that is printed about them."""
    parties = tables["hz_parties"]
    own = parties.filter(eq_or_present(F.col("status"), status)).select(
        "party_id",
        F.col("party_name").alias("supplier_name"),
        *(f"address{i}" for i in range(1, 5)),
        "city",
        "state",
        "postal_code",
        "country",
        "preferred_contact_person_id",
        "iden_addr_party_site_id",
    )
    contacts = parties.select(
        F.col("party_id").alias("preferred_contact_person_id"),
        F.col("person_last_name").alias("last_name"),
        F.col("person_first_name").alias("first_name"),
        "primary_phone_area_code",
        "primary_phone_number",
        "primary_phone_extension",
        F.col("email_address").alias("email"),
    )
    # A parent is looked up as a supplier first and named through its own party.
    parents = left_join_spreading_nulls(
        # One without a party can be nobody's parent.
        tables["poz_suppliers"].select("party_id").filter("party_id is not null"),
        parties.select("party_id", F.col("party_name").alias("parent_supplier")),
        ["party_id"],
    ).withColumnRenamed("party_id", "parent_party_id")
    sites = tables["hz_party_sites"].select(
        F.col("party_site_id").alias("iden_addr_party_site_id"), F.col("party_site_name").alias("site")
    )

    rows = (
        tables["poz_suppliers"]
        .join(paid, ["vendor_id", "party_id"], "left_semi")
        .withColumnsRenamed(
            {
                "segment1": "supplier_number",
                "vendor_type_lookup_code": "supplier_type",
                "type_1099": "federal_income_tax_type",
            }
        )
        .join(own, "party_id")
    )
    rows = left_join_spreading_nulls(rows, sites, ["iden_addr_party_site_id"])
    rows = left_join_spreading_nulls(rows, contacts, ["preferred_contact_person_id"])
    rows = left_join_spreading_nulls(rows, parents, ["parent_party_id"])
    rows = rows.join(tables["poz_suppliers_pii"], "vendor_id", "left")
    rows = rows.join(tables["poz_suppliers_v"], "vendor_id", "left")
    rows = rows.join(tables["poz_supplier_address_v"], ["vendor_id", "party_id"], "left")

    def column(name: str):
        return F.col(name)

    address = null_concat(
        column("site"),
        column("address1"),
        *(
            part
            for name in ("address2", "address3", "address4", "city", "state", "postal_code", "country")
            for part in (" ", column(name))
        ),
    )
    last = F.when(column("last_name").isNotNull(), F.concat(column("last_name"), F.lit(", ")))
    uses = {
        "address_purpose_ordering": "Ordering ",
        "address_purpose_remit_to": "Remit to ",
        "address_purpose_rfq_or_bidding": "RFQ or Bidding ",
    }
    return rows.select(
        "vendor_id",
        "party_id",
        "supplier_number",
        "supplier_name",
        "supplier_type",
        blank_to_null(F.ltrim(address)).alias("address"),
        null_concat(last, column("first_name")).alias("contact_name"),
        null_concat(
            column("primary_phone_area_code"),
            " ",
            column("primary_phone_number"),
            " ",
            column("primary_phone_extension"),
        ).alias("phone"),
        "email",
        "federal_income_tax_type",
        F.col("income_tax_id").alias("taxpayer_id"),
        date_text(F.col("creation_date")).alias("creation_date"),
        "parent_supplier",
        F.col("vendor_name_alt").alias("alternate_name"),
        null_concat(*(F.when(column(flag) == "Y", F.lit(text)) for flag, text in uses.items())).alias("address_purpose"),
    )


def _paid_suppliers(
    tables: TableSet, status: str | None, from_date: datetime | None, to_date: datetime | None
) -> DataFrame:
    """Suppliers paid in the range, per printed line: their payment rows and distinct payments.

    Payments are found first, and only suppliers that have one are looked up.  Printed lines are numbered once, with the
    parties they stand for; payments are counted under that number alone.
    """
    dated = row_weights(
        tables["iby_payments_all"].filter(within(F.col("payment_date"), from_date, to_date)), "payment_id", "dated"
    )
    checks = row_weights(
        tables["ap_checks_all"].filter(F.col("vendor_id").isNotNull() & F.col("party_id").isNotNull()),
        ["payment_id", "vendor_id", "party_id"],
        "checks",
    )
    payments = checks.join(dated, "payment_id").select(
        "vendor_id", "party_id", "payment_id", (F.col("checks") * F.col("dated")).alias("rows")
    )
    payments = stored(payments, "payments")
    per_party = row_weights(_supplier_rows(tables, status, payments), ["vendor_id", "party_id", *SUPPLIER_COLUMNS], "times")
    lines = per_party.groupBy("vendor_id", *SUPPLIER_COLUMNS).agg(F.collect_list(F.struct("party_id", "times")).alias("parties"))
    lines = stored(lines.withColumn("line", F.monotonically_increasing_id()), "suppliers")
    parties = lines.select("line", "vendor_id", F.inline("parties"))
    counted = (
        payments.join(parties, ["vendor_id", "party_id"])
        .groupBy("line")
        .agg(F.sum(F.col("rows") * F.col("times")).alias("payment_rows"), F.count_distinct("payment_id").alias("no_of_payments"))
    )
    return lines.drop("parties").join(counted, "line").drop("line")


def _invoiced(
    tables: TableSet, business_unit: int | None, from_date: datetime | None, to_date: datetime | None
) -> DataFrame:
    """Invoices accounted in the range per vendor and printed invoice terms.

    An invoice amount counts once per distribution and matched order row, so those are counted, not listed.
    """
    distributions = row_weights(
        tables["ap_invoice_distributions_all"].filter(within(F.col("accounting_date"), from_date, to_date)),
        ["invoice_id", "po_distribution_id"],
        "distributions",
    )
    order_lines = row_weights(tables["po_distributions_all"], ["po_distribution_id", "po_header_id"], "order_lines")
    orders = row_weights(
        tables["po_headers_all"].withColumnRenamed("segment1", "order_number"),
        ["po_header_id", "vendor_id", "order_number"],
        "orders",
    )
    units = (
        tables["fun_all_business_units_v"]
        .filter(eq_or_present(F.col("bu_id"), business_unit))
        .select(F.col("bu_id").alias("org_id"), F.col("bu_name").alias("business_unit"))
    )
    methods = tables["iby_payment_methods_tl"].select(
        "payment_method_code", F.col("payment_method_name").alias("method_of_payment")
    )
    terms = tables["ap_terms_tl"].select(
        F.col("term_id").alias("terms_id"), F.col("description").alias("payment_terms")
    )
    groups = (
        tables["fnd_lookup_values"]
        .filter(F.col("lookup_type") == "PAY GROUP")
        .select(F.col("lookup_code").alias("pay_group_lookup_code"), F.col("meaning").alias("pay_group"))
    )
    invoices = tables["ap_invoices_all"].select(
        "invoice_id",
        "vendor_id",
        "org_id",
        "terms_id",
        "payment_method_code",
        "pay_group_lookup_code",
        zero_if_null(F.col("invoice_amount")).alias("invoice_amount"),
    )

    rows = distributions.join(invoices, "invoice_id").join(units, "org_id")
    rows = left_join_spreading_nulls(rows, order_lines, ["po_distribution_id"])
    rows = left_join_spreading_nulls(rows, orders, ["po_header_id", "vendor_id"])
    rows = left_join_spreading_nulls(rows, methods, ["payment_method_code"])
    rows = left_join_spreading_nulls(rows, terms, ["terms_id"])
    rows = left_join_spreading_nulls(rows, groups, ["pay_group_lookup_code"])
    times = F.col("distributions") * at_least_one("order_lines") * at_least_one("orders")
    return rows.groupBy("vendor_id", *INVOICE_COLUMNS).agg(
        F.count_distinct("invoice_id").alias("total_invoice_count"),
        F.sum(F.col("invoice_amount") * times.cast("decimal(20,0)")).alias("invoice_amount"),
        F.count_distinct("order_number").alias("total_po_count"),
    )


def supplier_directory(
    tables: TableSet,
    *,
    from_date: datetime | None,
    to_date: datetime | None,
    status: str | None = None,
    business_unit: int | None = None,
) -> DataFrame:
    """Suppliers with invoices and payments in the range, per business unit and invoice terms.

    The report pairs every invoice of a vendor with every payment to it, so each invoice amount counts once
    per payment.  Payments and invoices depend on each other through the vendor only: each side is totalled
    on its own and the two meet as one row per printed line, with the payment count as a factor.
    """
    paid = _paid_suppliers(tables, status, from_date, to_date)
    invoiced = _invoiced(tables, business_unit, from_date, to_date)
    report = paid.join(invoiced, "vendor_id").select(
        *INVOICE_COLUMNS,
        *SUPPLIER_COLUMNS,
        "total_invoice_count",
        money(F.col("invoice_amount") * F.col("payment_rows").cast("decimal(20,0)")).alias("total_invoice_amount"),
        "no_of_payments",
        "total_po_count",
    )
    if from_date is None or to_date is None or from_date > to_date:
        report = report.filter(F.lit(False))
    return report.orderBy(F.col("supplier_number").asc_nulls_last())
