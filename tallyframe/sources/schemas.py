"""Declared schemas of the ERP input tables (column name and Spark type, as DDL).

Keys are long, money is decimal(18,2), and dates are ``timestamp_ntz`` because they carry a time of day
but no zone.  Only the columns that the reports touch are declared, so scans never read more.
"""

SCHEMAS: dict[str, str] = {
    "fa_additions_b": "asset_id bigint, asset_number string, asset_type string, asset_category_id bigint",
    "fa_categories_b": "category_id bigint, segment1 string, segment2 string",
    "fa_methods": "method_id bigint, life_in_months int",
    "fa_transaction_headers": (
        "transaction_header_id bigint, asset_id bigint, transaction_date_entered timestamp_ntz, "
        "transaction_type_code string"
    ),
    "fa_books": (
        "asset_id bigint, book_type_code string, date_ineffective timestamp_ntz, method_id bigint, cost "
        "decimal(18,2), transaction_header_id_in bigint"
    ),
    "fa_distribution_history": (
        "distribution_id bigint, asset_id bigint, code_combination_id bigint, date_ineffective timestamp_ntz"
    ),
    "gl_code_combinations": (
        "code_combination_id bigint, segment1 string, segment2 string, segment3 string, segment4 string, "
        "segment5 string, segment6 string, segment7 string"
    ),
    "fnd_flex_values_vl": "flex_value string, description string, value_category string",
    "fa_adjustments": (
        "asset_id bigint, distribution_id bigint, transaction_header_id bigint, source_type_code string, "
        "adjustment_type string, source_dest_code string, debit_credit_flag string, adjustment_amount "
        "decimal(18,2), period_counter_adjusted int"
    ),
    "fa_deprn_periods": (
        "book_type_code string, period_counter int, period_name string, period_open_date timestamp_ntz"
    ),
    "fa_deprn_summary": (
        "asset_id bigint, book_type_code string, period_counter int, deprn_source_code string, deprn_run_date "
        "timestamp_ntz, deprn_amount decimal(18,2), deprn_reserve decimal(18,2), system_deprn_amount "
        "decimal(18,2), deprn_adjustment_amount decimal(18,2), impairment_reserve decimal(18,2), "
        "adjusted_cost decimal(18,2)"
    ),
    "fa_retirements": (
        "asset_id bigint, book_type_code string, status string, transaction_header_id_in bigint"
    ),
    "fa_book_controls": "book_type_code string, fiscal_year_name string",
    "fa_calendar_types": "fiscal_year_name string, calendar_type string",
    "fa_calendar_periods": (
        "calendar_type string, period_name string, period_num int, start_date timestamp_ntz, end_date "
        "timestamp_ntz"
    ),
    "ap_invoices_all": (
        "invoice_id bigint, invoice_num string, invoice_amount decimal(18,2), amount_paid decimal(18,2), "
        "vendor_id bigint, org_id bigint, terms_id bigint, payment_method_code string, pay_group_lookup_code "
        "string, description string"
    ),
    "ap_invoice_distributions_all": (
        "invoice_id bigint, invoice_line_number int, dist_code_combination_id bigint, accounting_event_id "
        "bigint, accounting_date timestamp_ntz, po_distribution_id bigint"
    ),
    "ap_inv_selection_criteria_all": (
        "checkrun_id bigint, checkrun_name string, check_date timestamp_ntz, status string"
    ),
    "ap_selected_invoices_all": (
        "checkrun_id bigint, invoice_id bigint, invoice_num string, vendor_num bigint, vendor_name string, "
        "invoice_date timestamp_ntz, due_date timestamp_ntz, discount_amount decimal(18,2), ok_to_pay_flag "
        "string"
    ),
    "fnd_lookup_values": "lookup_type string, lookup_code string, meaning string",
    "ap_terms_vl": "term_id bigint, name string, description string",
    "iby_payment_methods_vl": "payment_method_code string, payment_method_name string",
    "ap_checks_all": "vendor_id bigint, party_id bigint, payment_id bigint",
    "iby_payments_all": "payment_id bigint, payment_date timestamp_ntz",
    "po_distributions_all": "po_distribution_id bigint, po_header_id bigint",
    "po_headers_all": "po_header_id bigint, vendor_id bigint, segment1 string",
    "poz_suppliers": (
        "vendor_id bigint, party_id bigint, parent_party_id bigint, segment1 string, vendor_type_lookup_code "
        "string, type_1099 string, creation_date timestamp_ntz"
    ),
    "hz_parties": (
        "party_id bigint, party_name string, status string, address1 string, address2 string, address3 "
        "string, address4 string, city string, state string, postal_code string, country string, "
        "person_last_name string, person_first_name string, primary_phone_area_code string, "
        "primary_phone_number string, primary_phone_extension string, email_address string, "
        "preferred_contact_person_id bigint, iden_addr_party_site_id bigint"
    ),
    "hz_party_sites": "party_site_id bigint, party_site_name string",
    "poz_suppliers_pii": "vendor_id bigint, income_tax_id string",
    "poz_suppliers_v": "vendor_id bigint, vendor_name_alt string",
    "poz_supplier_address_v": (
        "vendor_id bigint, party_id bigint, address_purpose_ordering string, address_purpose_remit_to string, "
        "address_purpose_rfq_or_bidding string"
    ),
    "fun_all_business_units_v": "bu_id bigint, bu_name string",
    "pjf_projects_all_vl": "project_id bigint, name string, segment1 string, attribute1 string",
    "pjf_proj_elements_b": (
        "proj_element_id bigint, project_id bigint, element_number string, service_type_code string"
    ),
    "pjf_proj_elements_tl": "proj_element_id bigint, name string, language string",
    "pjc_cost_dist_lines_all": (
        "project_id bigint, task_id bigint, expenditure_item_id bigint, projfunc_raw_cost decimal(22,6), "
        "prvdr_gl_date timestamp_ntz, prvdr_gl_period_name string, acct_event_id bigint, raw_cost_dr_ccid "
        "bigint, accounting_status_code string"
    ),
    "pjc_exp_items_all": (
        "expenditure_item_id bigint, expenditure_item_date timestamp_ntz, incurred_by_person_id bigint, "
        "original_header_id bigint, capitalization_dist_flag string"
    ),
    "pjf_project_classes": "project_id bigint, class_code_id bigint",
    "pjf_class_codes_b": "class_code_id bigint",
    "pjf_class_codes_tl": "class_code_id bigint, class_code string",
    "per_person_names_f_v": "person_id bigint, display_name string",
    "pjc_prj_asset_ln_dets": "expenditure_item_id bigint, project_asset_line_detail_id bigint",
    "pjc_prj_asset_lns_all": "project_asset_line_detail_id bigint, transfer_status_code string",
    "xla_ae_headers": "ae_header_id bigint, event_id bigint",
    "xla_ae_lines": (
        "ae_header_id bigint, code_combination_id bigint, accounted_dr decimal(18,2), override_reason string"
    ),
}

SCHEMAS["fnd_lookup_values_vl"] = SCHEMAS["fnd_lookup_values"]
SCHEMAS["ap_terms_tl"] = SCHEMAS["ap_terms_vl"]
SCHEMAS["iby_payment_methods_tl"] = SCHEMAS["iby_payment_methods_vl"]
