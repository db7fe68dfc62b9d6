"""Payment details: the invoices selected in payment runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.predicates import one_of, one_of_or_all
from tallyframe.functions.values import date_text, money, zero_if_null
from tallyframe.operators.combine import left_join_spreading_nulls
from tallyframe.sources.registry import TableSet


def first_line_location(tables: TableSet, invoices: DataFrame | None = None) -> DataFrame:
    """Location of each invoice: the account of a distribution on its lowest line number.

    When that line's accounts are unknown there is no location, whatever later lines say.  Among several
    distributions of the line the lowest account id decides.  ``invoices`` (invoice_id) limits the work.
    """
    lines = (
        tables["ap_invoice_distributions_all"]
        .filter(F.col("invoice_id").isNotNull() & F.col("invoice_line_number").isNotNull())
        .select("invoice_id", "invoice_line_number", "dist_code_combination_id")
    )
    if invoices is not None:
        lines = lines.join(invoices, "invoice_id", "left_semi")
    accounts = tables["gl_code_combinations"].select(
        F.col("code_combination_id").alias("dist_code_combination_id"), "segment2", F.lit(0).alias("unknown")
    )
    best = F.min(F.struct(F.coalesce("unknown", F.lit(1)).alias("unknown"), "dist_code_combination_id", "segment2"))
    # Only the lowest line of an invoice goes on to the accounts, without its repeats.
    lowest = Window.partitionBy("invoice_id").orderBy("invoice_line_number")
    first = lines.withColumn("_rank", F.rank().over(lowest)).filter("_rank = 1")
    first = first.select("invoice_id", "dist_code_combination_id").distinct()
    return (
        left_join_spreading_nulls(first, accounts, ["dist_code_combination_id"])
        .groupBy("invoice_id")
        .agg(best.alias("first"))
        .select("invoice_id", F.col("first.segment2").alias("location"))
    )


def payment_details(
    tables: TableSet, *, checkruns: Sequence[str] | None, suppliers: Sequence[str] | None = None
) -> DataFrame:
    """Invoices that are cleared to be paid in the named payment runs.

    No supplier list, an empty one and one that holds None mean all suppliers, those without a name included.
    """
    runs = (
        tables["ap_inv_selection_criteria_all"]
        .filter(one_of(F.col("checkrun_name"), checkruns))
        .select("checkrun_id", "checkrun_name", "check_date", F.col("status").alias("batch_status"))
    )
    selected = tables["ap_selected_invoices_all"].filter(F.col("ok_to_pay_flag") == "Y")
    selected = one_of_or_all(selected, "vendor_name", suppliers).join(runs, "checkrun_id")

    invoices = tables["ap_invoices_all"].select(
        "invoice_id",
        F.col("invoice_num").alias("own_invoice_num"),
        "invoice_amount",
        "amount_paid",
        "terms_id",
        "payment_method_code",
        "pay_group_lookup_code",
        "description",
    )
    groups = (
        tables["fnd_lookup_values_vl"]
        .filter(F.col("lookup_type") == "PAY GROUP")
        .select(F.col("lookup_code").alias("pay_group_lookup_code"), F.col("meaning").alias("pay_group"))
    )
    terms = tables["ap_terms_vl"].select(F.col("term_id").alias("terms_id"), F.col("name").alias("payment_terms"))
    methods = tables["iby_payment_methods_vl"].select(
        "payment_method_code", F.col("payment_method_name").alias("payment_method")
    )
    locations = first_line_location(tables, selected.select("invoice_id"))

    rows = selected.join(invoices, "invoice_id").join(locations, "invoice_id", "left")
    rows = left_join_spreading_nulls(rows, groups, ["pay_group_lookup_code"])
    rows = left_join_spreading_nulls(rows, terms, ["terms_id"])
    rows = left_join_spreading_nulls(rows, methods, ["payment_method_code"])

    unpaid = zero_if_null(F.col("invoice_amount")) - zero_if_null(F.col("amount_paid"))
    return rows.orderBy(F.col("checkrun_name").asc_nulls_last(), F.col("own_invoice_num").asc_nulls_last()).select(
        "checkrun_name",
        date_text(F.col("check_date")).alias("check_date"),
        "batch_status",
        "invoice_num",
        "vendor_num",
        "vendor_name",
        date_text(F.col("invoice_date")).alias("invoice_date"),
        date_text(F.col("due_date")).alias("due_date"),
        money(F.col("invoice_amount")).alias("invoice_amount"),
        money(unpaid).alias("unpaid_amount"),
        money(F.col("discount_amount")).alias("discount_amount"),
        # NULL where no discount is stated.
        money(unpaid - F.col("discount_amount")).alias("net_amount"),
        "payment_method",
        "description",
        F.col("pay_group_lookup_code").alias("pay_group_code"),
        "pay_group",
        "payment_terms",
        "location",
        F.col("ok_to_pay_flag").alias("ok_to_pay"),
    )
