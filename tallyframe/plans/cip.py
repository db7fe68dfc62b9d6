"""Construction in progress: the cost listing and its quarterly roll-forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.predicates import optional_eq
from tallyframe.functions.values import account_string, money, zero_if_null
from tallyframe.operators.calendar import QUARTERS, Calendar, quarter_sums
from tallyframe.operators.combine import at_least_one, left_join_spreading_nulls, row_weights
from tallyframe.operators.keyed import pick_first
from tallyframe.sources.registry import TableSet
from tallyframe.sources.scratch import stored

NO_CALENDAR = Calendar(None, None, None, None, None, None)


def asset_status(tables: TableSet, items: DataFrame | None = None) -> DataFrame:
    """Transfer status of each expenditure item, by its lowest asset line detail; NULL meanings are kept.

    ``items`` (expenditure_item_id) limits the work.  Only the lowest detail of an item goes on to the meanings, and only
    a task's best goes on to the shuffle.
    """
    meanings = (
        tables["fnd_lookup_values"]
        .filter(F.col("lookup_type") == "PJC_TRANSFER_STATUS")
        .select(F.col("lookup_code").alias("transfer_status_code"), F.col("meaning").alias("asset_status"))
    )
    details = tables["pjc_prj_asset_ln_dets"]
    if items is not None:
        details = details.join(items, "expenditure_item_id", "left_semi")
    lowest = Window.partitionBy("expenditure_item_id").orderBy(F.col("project_asset_line_detail_id"))
    coded = details.join(tables["pjc_prj_asset_lns_all"], "project_asset_line_detail_id")
    first = coded.withColumn("_rank", F.rank().over(lowest)).filter("_rank = 1").drop("_rank").distinct()
    first = left_join_spreading_nulls(first, meanings, ["transfer_status_code"])
    return pick_first(first, "expenditure_item_id", ("project_asset_line_detail_id", "asset_status")).select(
        "expenditure_item_id", "asset_status"
    )


def event_accounts(tables: TableSet, events: DataFrame | None = None) -> DataFrame:
    """Debit account of each accounting event: the lowest account string among its plain debit lines.

    ``events`` (event_id) limits the work: their headers are found first, and only the lines of those are read on.
    """
    accounts = tables["gl_code_combinations"]
    accounts = accounts.select("code_combination_id", account_string(accounts).alias("account"))
    headers = tables["xla_ae_headers"]
    if events is not None:
        headers = headers.join(events, "event_id", "left_semi")
    debits = (
        tables["xla_ae_lines"]
        .filter(F.col("accounted_dr").isNotNull() & F.col("override_reason").isNull())
        .select("ae_header_id", "code_combination_id")
        .join(headers, "ae_header_id")
        .select("event_id", "code_combination_id")
        .distinct()
    )
    return debits.join(accounts, "code_combination_id").groupBy("event_id").agg(F.min("account").alias("account"))


def _with_own_accounts(tables: TableSet, lines: DataFrame, events: DataFrame) -> DataFrame:
    """Cost lines with the account of their own event and the account that they state."""
    combos = tables["gl_code_combinations"]
    stated = (
        combos.select(F.col("code_combination_id").alias("stated_ccid"), account_string(combos).alias("account"))
        .groupBy("stated_ccid")
        .agg(F.min("account").alias("stated_account"))
    )
    lines = lines.withColumn(
        "stated_ccid", F.when(F.col("accounting_status_code") != "RNBNN", F.col("raw_cost_dr_ccid"))
    )
    own = events.select(F.col("event_id").alias("acct_event_id"), F.col("account").alias("event_account"))
    lines = left_join_spreading_nulls(lines, own, ["acct_event_id"])
    return left_join_spreading_nulls(lines, stated, ["stated_ccid"])


def window_condition(calendar: Calendar, window: str, column: Column) -> Column:
    """Date condition of a listing: before the year, within it (last day included), or up to its last day."""
    if window == "beginning":
        return column < calendar.start
    if window == "in_range":
        return calendar.in_year(column)
    if window == "ending":
        return column < calendar.end
    raise ValueError(f"unknown window {window!r}")


def cip_listing(
    tables: TableSet, *, year: str, book: str | None, window: str = "in_range", company: str | None = None
) -> DataFrame:
    """Project cost lines of one date window, one row per class, task name and other attached row.

    ``window`` is ``beginning``, ``in_range`` or ``ending``.
    """
    calendar = Calendar.read(tables, year, book) or NO_CALENDAR

    projects = optional_eq(tables["pjf_projects_all_vl"], "attribute1", company).select(
        "project_id",
        F.col("name").alias("project_name"),
        F.col("segment1").alias("project_number"),
        F.col("attribute1").alias("legal_entity"),
    )
    classes = (
        tables["pjf_project_classes"]
        .join(tables["pjf_class_codes_b"], "class_code_id")
        .join(tables["pjf_class_codes_tl"], "class_code_id")
        .select("project_id", "class_code")
    )
    services = (
        tables["fnd_lookup_values"]
        .filter(F.col("lookup_type") == "PJF_SERVICE_TYPE")
        .select(F.col("lookup_code").alias("service_type_code"), F.col("meaning").alias("service"))
    )
    tasks = left_join_spreading_nulls(
        tables["pjf_proj_elements_b"].join(
            tables["pjf_proj_elements_tl"].select("proj_element_id", F.col("name").alias("task_name")), "proj_element_id"
        ),
        services,
        ["service_type_code"],
    ).select(
        "project_id",
        F.col("proj_element_id").alias("task_id"),
        "task_name",
        F.col("element_number").alias("task_number"),
        "service",
    )
    # Written before the lines meet them: their sizes are known then, and while they are small no line is dealt by task.
    # Projects with their classes and tasks with their names stay apart, which keeps each small; the keys are narrower yet.
    projects = stored(projects.join(classes, "project_id"), "projects")
    tasks = stored(tasks.join(projects, "project_id", "left_semi"), "tasks")
    listed = stored(tasks.select("project_id", "task_id").distinct(), "task-keys")

    # What the window asks for is known first: its lines, their items, the invoices of those, and all their events.  Each
    # lookup is limited to these keys before it is grouped or joined.
    lines = tables["pjc_cost_dist_lines_all"].filter(window_condition(calendar, window, F.col("prvdr_gl_date")))
    lines = stored(lines.join(listed, ["project_id", "task_id"], "left_semi"), "lines")
    items = stored(tables["pjc_exp_items_all"].join(lines, "expenditure_item_id", "left_semi"), "items")
    asked = items.select(F.col("original_header_id").alias("invoice_id"))
    charged = (
        tables["ap_invoice_distributions_all"]
        .select("invoice_id", F.col("accounting_event_id").alias("event_id"))
        .join(asked, "invoice_id", "left_semi")
        .distinct()
    )
    charged = stored(charged, "invoice-events")
    keys = charged.select("event_id").union(lines.select("acct_event_id")).filter("event_id is not null")
    events = stored(event_accounts(tables, keys), "accounts")
    invoice_accounts = charged.join(events, "event_id").groupBy("invoice_id").agg(F.min("account").alias("invoice_account"))

    people = tables["per_person_names_f_v"].select(
        F.col("person_id").alias("incurred_by_person_id"), F.col("display_name").alias("employee")
    )
    attached = left_join_spreading_nulls(items, people, ["incurred_by_person_id"])
    # The account comes from the distributions, also where the invoice itself is missing.
    lookups = (_invoice_suppliers(tables, asked), invoice_accounts)
    suppliers, accounts = (lookup.withColumnRenamed("invoice_id", "original_header_id") for lookup in lookups)
    attached = left_join_spreading_nulls(attached, suppliers, ["original_header_id"], accounts)
    attached = attached.join(asset_status(tables, items), "expenditure_item_id", "left")

    # Lookups are attached to the side that owns their key, so that the long rows are joined last and once.
    rows = (
        _with_own_accounts(tables, lines, events)
        .join(attached, "expenditure_item_id")
        .join(tasks, ["project_id", "task_id"])
        .join(projects, "project_id")
        .withColumn("raw_cost_debit_acct", F.coalesce("event_account", "invoice_account", "stated_account"))
    )
    code = F.col("class_code")
    return rows.select(
        "project_id",
        "project_name",
        "project_number",
        "task_name",
        "task_number",
        "task_id",
        "expenditure_item_date",
        money(F.round("projfunc_raw_cost", 2)).alias("cost"),
        "employee",
        F.col("expenditure_item_id").alias("transaction_number"),
        "supplier",
        "legal_entity",
        F.col("capitalization_dist_flag").alias("cip_flag"),
        F.col("prvdr_gl_period_name").alias("gl_period"),
        F.when(code != "Task Level", code).otherwise(F.col("service")).alias("location"),
        "raw_cost_debit_acct",
        "asset_status",
        F.col("prvdr_gl_date").alias("provider_acc_date"),
    )


def _invoice_suppliers(tables: TableSet, asked: DataFrame) -> DataFrame:
    """Supplier names by invoice asked for, one row per (invoice, supplier, party) match and at least one per invoice."""
    parties = tables["hz_parties"].select("party_id", F.col("party_name").alias("supplier"))
    suppliers = left_join_spreading_nulls(
        tables["poz_suppliers"].select("vendor_id", "party_id"), parties, ["party_id"]
    ).select("vendor_id", "supplier")
    invoices = tables["ap_invoices_all"].select("invoice_id", "vendor_id").join(asked, "invoice_id", "left_semi")
    return left_join_spreading_nulls(invoices, suppliers, ["vendor_id"]).select("invoice_id", "supplier")


def _project_weights(tables: TableSet, company: str | None) -> DataFrame:
    """Listing rows per project: its rows times the class rows it has."""
    codes = row_weights(tables["pjf_class_codes_b"], "class_code_id", "codes")
    names = row_weights(tables["pjf_class_codes_tl"], "class_code_id", "names")
    classes = row_weights(
        tables["pjf_project_classes"].join(codes, "class_code_id").join(names, "class_code_id"),
        "project_id",
        "classes",
        F.col("codes") * F.col("names"),
    )
    projects = row_weights(optional_eq(tables["pjf_projects_all_vl"], "attribute1", company), "project_id", "projects")
    return projects.join(classes, "project_id").select(
        "project_id", (F.col("projects") * F.col("classes")).alias("project_weight")
    )


def _structure_weights(tables: TableSet, company: str | None) -> DataFrame:
    """Listing rows per task: those of its project times its names and service lookups."""
    names = row_weights(tables["pjf_proj_elements_tl"], "proj_element_id", "names")
    services = row_weights(
        tables["fnd_lookup_values"]
        .filter(F.col("lookup_type") == "PJF_SERVICE_TYPE")
        .select(F.col("lookup_code").alias("service_type_code")),
        "service_type_code",
        "services",
    )
    tasks = left_join_spreading_nulls(
        tables["pjf_proj_elements_b"].join(names, "proj_element_id"), services, ["service_type_code"]
    )
    tasks = row_weights(tasks, ["project_id", "proj_element_id"], "tasks", F.col("names") * at_least_one("services"))
    return tasks.join(_project_weights(tables, company), "project_id").select(
        "project_id",
        F.col("proj_element_id").alias("task_id"),
        (F.col("tasks") * F.col("project_weight")).cast("decimal(20,0)").alias("weight"),
    )


def _item_weights(tables: TableSet, asked: DataFrame) -> DataFrame:
    """Listing rows per expenditure item asked for: its person names times its invoice, supplier and party rows."""
    people = row_weights(
        tables["per_person_names_f_v"].select(F.col("person_id").alias("incurred_by_person_id")),
        "incurred_by_person_id",
        "people",
    )
    parties = row_weights(tables["hz_parties"], "party_id", "parties")
    suppliers = row_weights(
        left_join_spreading_nulls(tables["poz_suppliers"].select("vendor_id", "party_id"), parties, ["party_id"]),
        "vendor_id",
        "suppliers",
        at_least_one("parties"),
    )
    invoices = row_weights(
        left_join_spreading_nulls(tables["ap_invoices_all"].select("invoice_id", "vendor_id"), suppliers, ["vendor_id"]),
        "invoice_id",
        "invoices",
        at_least_one("suppliers"),
    ).withColumnRenamed("invoice_id", "original_header_id")
    items = tables["pjc_exp_items_all"].select("expenditure_item_id", "incurred_by_person_id", "original_header_id")
    items = items.join(asked, "expenditure_item_id", "left_semi")
    items = left_join_spreading_nulls(items, people, ["incurred_by_person_id"])
    items = left_join_spreading_nulls(items, invoices, ["original_header_id"])
    return row_weights(
        items, "expenditure_item_id", "item_weight", at_least_one("people") * at_least_one("invoices")
    )


def cip_rollforward(tables: TableSet, *, year: str, book: str | None, company: str | None = None) -> DataFrame:
    """One row: cost in progress before and after the year, by quarter, and capitalised cost by quarter.

    The three listings are one scan with date flags.  Rows that a listing would repeat are counted instead of
    produced, and the lines of an item are added up before they meet it.  A missing calendar gives zeros.
    """
    calendar = Calendar.read(tables, year, book) or NO_CALENDAR
    when = F.col("prvdr_gl_date")
    cost = F.round("projfunc_raw_cost", 2)
    mask = F.when(calendar.in_year(when), calendar.quarter_mask(when)).otherwise(F.lit(0))

    lines = (
        tables["pjc_cost_dist_lines_all"]
        .filter(window_condition(calendar, "beginning", when) | (when <= calendar.end))
        .select(
            "expenditure_item_id",
            "project_id",
            "task_id",
            cost.alias("cost"),
            window_condition(calendar, "beginning", when).alias("before"),
            window_condition(calendar, "ending", when).alias("up_to_end"),
            mask.alias("quarters"),
        )
        .join(_structure_weights(tables, company), ["project_id", "task_id"])
    )
    per_item = lines.groupBy("expenditure_item_id", "before", "up_to_end", "quarters").agg(
        money(F.sum(F.col("cost") * F.col("weight"))).alias("cost")
    )
    per_item = stored(per_item, "items")
    rows = per_item.join(_item_weights(tables, per_item), "expenditure_item_id").join(
        asset_status(tables, per_item), "expenditure_item_id", "left"
    )
    rows = rows.select(
        "before",
        "up_to_end",
        "quarters",
        "asset_status",
        (F.col("cost") * F.col("item_weight").cast("decimal(20,0)")).alias("amount"),
    ).selectExpr(
        "before",
        "up_to_end",
        "quarters",
        "if(asset_status is null or asset_status = 'Pending', amount, 0) as in_progress",
        "if(asset_status = 'Transferred', -amount, 0) as capitalised",
    )
    totals = rows.agg(
        F.expr("sum(if(before, in_progress, 0)) as beginning_cip"),
        F.expr("sum(if(up_to_end, in_progress, 0)) as ending_cip"),
        *quarter_sums("in_progress", "cip"),
        *quarter_sums("capitalised", "cip_cap"),
    )
    names = ("beginning_cip", "ending_cip", *(f"q{q}_{n}" for n in ("cip", "cip_cap") for q in QUARTERS))
    return totals.select(*(money(zero_if_null(F.col(n))).alias(n) for n in names))
