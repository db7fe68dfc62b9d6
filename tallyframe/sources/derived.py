"""ERP input tables derived from the supplied star-schema Parquet.

The star schema holds none of the ERP tables, so each one is a deterministic view over it (FIXTURES.md).
The view text is portable SQL: Spark resolves the ``{name}`` slots to DataFrames, and the result check
resolves them to common table expressions, so both engines start from the same inputs.

A view that joins or groups would be worked out again wherever a report reads it.  Such a view is written
once per application, as Parquet in the shared folder named by ``spark.checkpoint.dir``, and read from there
like any stored table: with pruned columns and pushed filters, and without its lineage when executors go.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tallyframe.session import sizes_times
from tallyframe.sources.registry import TableSet
from tallyframe.sources.scratch import COMPRESSION, new_folder

STAR_TABLES = ("region", "nation", "supplier", "part", "orders", "lineitem")

# Names that hold the same rows as another table.
SAME_ROWS = {
    "fnd_lookup_values_vl": "fnd_lookup_values",
    "ap_terms_tl": "ap_terms_vl",
    "iby_payment_methods_tl": "iby_payment_methods_vl",
}

# How many times its files' size a side of a view's join counts.  Keys of the star schema rise, and their columns pack so well
# that a side which passes for 10 MB takes hundreds on the driver; by this factor it has two million rows at most.
SIDES_TIMES = 6

VIEWS: dict[str, str] = {
    "fa_additions_b": """
        select p_partkey asset_id, concat('A', case when p_partkey<100000 then
        lpad(cast(p_partkey as varchar(20)),6,'0') else cast(p_partkey as varchar(20)) end) asset_number, case when
        p_partkey%5=0 then 'CIP' else 'CAPITALIZED' end asset_type, p_size%10 asset_category_id from {part}
    """,
    "fa_categories_b": """
        select distinct p_size%10 category_id, concat('MAJ',cast(p_size%10%4 as varchar(5))) segment1,
        concat('MIN',cast(p_size%10 as varchar(5))) segment2 from {part}
    """,
    "fa_methods": """
        select distinct p_size method_id, case when p_size=50 then null else p_size+2 end life_in_months from {part}
    """,
    "fa_transaction_headers": """
        select l_orderkey*10+l_linenumber transaction_header_id, min(l_partkey) asset_id, min(l_shipdate)
        transaction_date_entered, case l_linenumber when 1 then 'ADDITION' when 2 then 'ADJUSTMENT' when 3 then
        'PARTIAL RETIREMENT' when 4 then 'CIP ADDITION' when 5 then 'FULL RETIREMENT' when 6 then 'REINSTATEMENT'
        else 'TRANSFER' end transaction_type_code from {lineitem} group by l_orderkey, l_linenumber
    """,
    "fa_books": """
        select p_partkey asset_id, concat('BOOK',cast(p_partkey%3 as varchar(5))) book_type_code, cast(null as
        timestamp) date_ineffective, p_size method_id, cast(p_retailprice*10 as decimal(18,2)) cost, h.mx
        transaction_header_id_in from {part} left join (select asset_id, max(transaction_header_id) mx from
        {fa_transaction_headers} group by asset_id) h on h.asset_id=p_partkey where p_partkey%17<>0 union all select
        p_partkey, concat('BOOK',cast(p_partkey%3 as varchar(5))), timestamp '1997-01-01 00:00:00', p_size,
        cast(p_retailprice*8 as decimal(18,2)), th.transaction_header_id from {part} join {fa_transaction_headers}
        th on th.asset_id=p_partkey and th.transaction_date_entered < timestamp '1998-01-01 00:00:00'
    """,
    "fa_distribution_history": """
        select p_partkey*2 distribution_id, p_partkey asset_id, p_size code_combination_id, case when p_partkey%4=0
        then timestamp '1998-06-01 00:00:00' else cast(null as timestamp) end date_ineffective from {part} union all
        select p_partkey*2+1, p_partkey, p_size+40, cast(null as timestamp) from {part} where p_partkey%3=0
    """,
    "gl_code_combinations": """
        select s_suppkey code_combination_id, cast(s_nationkey%5 as varchar(5)) segment1, cast(s_nationkey as
        varchar(5)) segment2, cast(null as varchar(5)) segment3, cast(null as varchar(5)) segment4, cast(null as
        varchar(5)) segment5, cast(null as varchar(5)) segment6, cast(null as varchar(5)) segment7 from {supplier}
    """,
    "fnd_flex_values_vl": """
        select cast(n_nationkey as varchar(5)) flex_value, n_name description, 'Location COA' value_category from
        {nation} union all select cast(r_regionkey as varchar(5)), r_name, 'Company COA' from {region} union all select
        cast(r_regionkey as varchar(5)), r_name, 'Company Northgate COA' from {region} where r_regionkey%2=1
    """,
    "fa_adjustments": """
        select th.asset_id, d.distribution_id, th.transaction_header_id, case l_linenumber when 1 then 'ADDITION'
        when 2 then 'ADJUSTMENT' when 3 then 'RETIREMENT' when 4 then 'CIP ADDITION' when 5 then 'RETIREMENT' when 6
        then 'ADJUSTMENT' else 'CIP ADJUSTMENT' end source_type_code, case when l_linenumber in (3,5) then (case
        l_returnflag when 'A' then 'COST' when 'N' then 'NBV RETIRED' else 'RESERVE' end) when l_returnflag='A' then
        'COST CLEARING' else 'COST' end adjustment_type, case when l_returnflag='A' then null when l_returnflag='N'
        then 'DEST' else 'SOURCE' end source_dest_code, case when l_linestatus='F' then 'CR' else 'DR' end
        debit_credit_flag, cast(l_extendedprice as decimal(18,2)) adjustment_amount,
        year(l_shipdate)*12+month(l_shipdate) period_counter_adjusted from {lineitem} l join
        {fa_transaction_headers} th on th.transaction_header_id=l.l_orderkey*10+l.l_linenumber join (select
        asset_id, min(distribution_id) distribution_id from {fa_distribution_history} group by asset_id) d on
        d.asset_id=th.asset_id
    """,
    "fa_deprn_periods": """
        select distinct concat('BOOK',cast(l_partkey%3 as varchar(5))) book_type_code,
        year(l_shipdate)*12+month(l_shipdate) period_counter, concat('P',lpad(cast(month(l_shipdate) as
        varchar(5)),2,'0'),'-',substr(cast(year(l_shipdate) as varchar(5)),3)) period_name,
        cast(date_trunc('month',l_shipdate) as timestamp) period_open_date from {lineitem}
    """,
    "fa_deprn_summary": """
        select l_partkey asset_id, concat('BOOK',cast(l_partkey%3 as varchar(5))) book_type_code,
        year(l_shipdate)*12+month(l_shipdate) period_counter, case when count(*)%4=0 then 'BOOKS' else 'DEPRN' end
        deprn_source_code, max(l_shipdate) deprn_run_date, cast(sum(cast(l_quantity as decimal(18,2))) as
        decimal(18,2)) deprn_amount, cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2))
        deprn_reserve, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(18,2)) system_deprn_amount,
        cast(count(*) as decimal(18,2)) deprn_adjustment_amount, cast(max(l_linenumber) as decimal(18,2))
        impairment_reserve, cast(max(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) adjusted_cost from
        {lineitem} group by l_partkey, year(l_shipdate)*12+month(l_shipdate)
    """,
    "fa_retirements": """
        select asset_id, concat('BOOK',cast(asset_id%3 as varchar(5))) book_type_code, case when
        transaction_header_id%5=0 then 'PENDING' else 'PROCESSED' end status, transaction_header_id
        transaction_header_id_in from {fa_transaction_headers} where transaction_type_code in ('PARTIAL
        RETIREMENT','FULL RETIREMENT')
    """,
    "fa_book_controls": """
        select distinct concat('BOOK',cast(n_nationkey%3 as varchar(5))) book_type_code, 'FY' fiscal_year_name from
        {nation}
    """,
    "fa_calendar_types": """
        select distinct 'FY' fiscal_year_name, 'MONTHLY' calendar_type from {region}
    """,
    "fa_calendar_periods": """
        select distinct 'MONTHLY' calendar_type, concat('P',lpad(cast(month(o_orderdate) as
        varchar(5)),2,'0'),'-',substr(cast(year(o_orderdate) as varchar(5)),3)) period_name, month(o_orderdate)
        period_num, cast(date_trunc('month',o_orderdate) as timestamp) start_date,
        cast(date_trunc('month',o_orderdate) as timestamp) + interval '1' month - interval '1' day end_date from
        {orders}
    """,
    "ap_invoices_all": """
        select o_orderkey invoice_id, concat('INV',cast(o_orderkey as varchar(12))) invoice_num, cast(o_totalprice
        as decimal(18,2)) invoice_amount, case o_orderstatus when 'F' then cast(o_totalprice as decimal(18,2)) when
        'P' then cast(100 as decimal(18,2)) else null end amount_paid, o_custkey%100 vendor_id, o_custkey%5 org_id,
        o_orderkey%4 terms_id, concat('M',cast(o_orderkey%4 as varchar(5))) payment_method_code, o_orderpriority
        pay_group_lookup_code, case when o_orderkey%7=0 then null else 'goods' end description from {orders}
        where o_orderkey%13<>0
    """,
    "ap_invoice_distributions_all": """
        select l_orderkey invoice_id, l_linenumber invoice_line_number, l_suppkey dist_code_combination_id,
        l_orderkey accounting_event_id, l_shipdate accounting_date, case when l_partkey%3=0 then null else l_partkey
        end po_distribution_id from {lineitem}
    """,
    "ap_inv_selection_criteria_all": """
        select distinct cast(substr(o_orderpriority,1,1) as int) checkrun_id, concat('RUN ',o_orderpriority)
        checkrun_name, timestamp '1998-07-01 00:00:00' check_date, 'SELECTED' status from {orders}
    """,
    "ap_selected_invoices_all": """
        select cast(substr(o_orderpriority,1,1) as int) checkrun_id, o_orderkey invoice_id,
        concat('INV',cast(o_orderkey as varchar(12))) invoice_num, s_suppkey vendor_num, s_name vendor_name,
        o_orderdate invoice_date, o_orderdate + interval '30' day due_date, case when o_orderkey%6=0 then null else
        cast(o_orderkey%50 as decimal(18,2)) end discount_amount, case when o_orderstatus='P' then 'N' else 'Y' end
        ok_to_pay_flag from {orders} join {supplier} on s_suppkey=o_custkey%100
    """,
    "fnd_lookup_values": """
        select distinct 'PAY GROUP' lookup_type, o_orderpriority lookup_code, concat('Group ',o_orderpriority)
        meaning from {orders} where o_orderpriority<>'5-LOW' union all select 'PJF_SERVICE_TYPE', cast(n_nationkey%4
        as varchar(5)), concat('Service ',n_name) from {nation} where n_nationkey<5 union all select
        'PJC_TRANSFER_STATUS', r_name, case r_regionkey when 0 then 'Pending' when 1 then 'Transferred' when 2 then
        'Rejected' else null end from {region}
    """,
    "ap_terms_vl": """
        select n_nationkey term_id, concat('Net ',cast(n_nationkey*15 as varchar(5))) name, n_name description from
        {nation} where n_nationkey<3
    """,
    "iby_payment_methods_vl": """
        select concat('M',cast(n_nationkey as varchar(5))) payment_method_code, concat('Method ',n_name)
        payment_method_name from {nation} where n_nationkey<3
    """,
    "ap_checks_all": """
        select o_custkey%100 vendor_id, case when o_orderstatus='P' then null else o_custkey%100+1000 end party_id,
        o_orderkey payment_id from {orders}
    """,
    "iby_payments_all": """
        select o_orderkey payment_id, o_orderdate payment_date from {orders}
    """,
    "po_distributions_all": """
        select p_partkey po_distribution_id, p_partkey%200 po_header_id from {part}
    """,
    "po_headers_all": """
        select distinct p_partkey%200 po_header_id, p_partkey%200%100 vendor_id,
        concat('PO',cast(p_partkey%200%150 as varchar(5))) segment1 from {part}
    """,
    "poz_suppliers": """
        select s_suppkey vendor_id, s_suppkey+1000 party_id, case when s_suppkey%4=0 then s_suppkey%10+1000 else
        null end parent_party_id, concat('S',cast(s_suppkey as varchar(5))) segment1, case when s_suppkey%3=0 then
        'SUPPLIER' else null end vendor_type_lookup_code, case when s_suppkey%5=0 then 'MISC' else null end
        type_1099, timestamp '1996-02-03 04:05:06' creation_date from {supplier}
    """,
    "hz_parties": """
        select s_suppkey+1000 party_id, s_name party_name, case when s_suppkey%11=0 then null else 'A' end status,
        case when s_suppkey%2=0 then '1 Main' else null end address1, cast(null as varchar(10)) address2, cast(null
        as varchar(10)) address3, cast(null as varchar(10)) address4, case when s_suppkey%3=0 then 'Town' else null
        end city, cast(null as varchar(10)) state, cast(s_nationkey as varchar(5)) postal_code, case when
        s_suppkey%5=0 then null else 'US' end country, case when s_suppkey%3=0 then null else 'Last' end
        person_last_name, 'First' person_first_name, cast(null as varchar(10)) primary_phone_area_code,
        cast(s_suppkey as varchar(10)) primary_phone_number, cast(null as varchar(10)) primary_phone_extension,
        cast(null as varchar(10)) email_address, case when s_suppkey%2=0 then (s_suppkey+1)%100+1000 else null end
        preferred_contact_person_id, case when s_suppkey%2=1 then s_suppkey else null end iden_addr_party_site_id
        from {supplier}
    """,
    "hz_party_sites": """
        select s_suppkey party_site_id, concat('Site',cast(s_suppkey as varchar(5))) party_site_name from {supplier}
    """,
    "poz_suppliers_pii": """
        select s_suppkey vendor_id, concat('T',cast(s_suppkey as varchar(5))) income_tax_id from {supplier} where
        s_suppkey%2=0
    """,
    "poz_suppliers_v": """
        select s_suppkey vendor_id, concat('Alt ',s_name) vendor_name_alt from {supplier} where s_suppkey%3=0
    """,
    "poz_supplier_address_v": """
        select s_suppkey vendor_id, s_suppkey+1000 party_id, case when s_suppkey%2=0 then 'Y' else 'N' end
        address_purpose_ordering, case when s_suppkey%3=0 then 'Y' else null end address_purpose_remit_to, 'N'
        address_purpose_rfq_or_bidding from {supplier} where s_suppkey%7<>0
    """,
    "fun_all_business_units_v": """
        select r_regionkey bu_id, r_name bu_name from {region}
    """,
    "pjf_projects_all_vl": """
        select n_nationkey project_id, concat('Project ',n_name) name, concat('P',cast(n_nationkey as varchar(5)))
        segment1, cast(n_regionkey as varchar(5)) attribute1 from {nation}
    """,
    "pjf_proj_elements_b": """
        select s_suppkey proj_element_id, s_nationkey project_id, concat('T',cast(s_suppkey as varchar(5)))
        element_number, cast(s_suppkey%6 as varchar(5)) service_type_code from {supplier}
    """,
    "pjf_proj_elements_tl": """
        select s_suppkey proj_element_id, concat('Task ',s_name) name, 'US' language from {supplier} union all
        select s_suppkey, concat('Tache ',s_name), 'F' from {supplier} where s_suppkey%9=0
    """,
    "pjc_cost_dist_lines_all": """
        select s_nationkey project_id, s_suppkey task_id, l_orderkey*10+l_linenumber expenditure_item_id,
        cast(l_extendedprice*l_discount as decimal(22,6)) projfunc_raw_cost, l_shipdate prvdr_gl_date, 'P'
        prvdr_gl_period_name, l_orderkey acct_event_id, l_partkey%120 raw_cost_dr_ccid, case when l_linestatus='F'
        then 'A' when l_returnflag='R' then 'RNBNN' else null end accounting_status_code from {lineitem} join
        {supplier} on s_suppkey=l_suppkey
    """,
    "pjc_exp_items_all": """
        select l_orderkey*10+l_linenumber expenditure_item_id, min(l_shipdate) expenditure_item_date, min(case when
        l_partkey%4=0 then null else l_partkey%30 end) incurred_by_person_id, l_orderkey original_header_id, 'N'
        capitalization_dist_flag from {lineitem} group by l_orderkey, l_linenumber
    """,
    "pjf_project_classes": """
        select n_nationkey project_id, n_regionkey class_code_id from {nation} union all select n_nationkey, 4 from
        {nation} where n_nationkey%6=0
    """,
    "pjf_class_codes_b": """
        select r_regionkey class_code_id from {region}
    """,
    "pjf_class_codes_tl": """
        select r_regionkey class_code_id, case when r_regionkey=0 then 'Task Level' else r_name end class_code from
        {region}
    """,
    "per_person_names_f_v": """
        select n_nationkey person_id, concat('Person ',n_name) display_name from {nation} union all select
        n_nationkey, concat('Former ',n_name) from {nation} where n_nationkey%5=0
    """,
    "pjc_prj_asset_ln_dets": """
        select distinct l_orderkey*10+l_linenumber expenditure_item_id, l_orderkey*10+l_linenumber
        project_asset_line_detail_id from {lineitem} where l_linenumber<>7
    """,
    "pjc_prj_asset_lns_all": """
        select d.project_asset_line_detail_id, r_name transfer_status_code from (select distinct
        l_orderkey*10+l_linenumber project_asset_line_detail_id from {lineitem} where l_linenumber<>7) d join
        {region} on r_regionkey=d.project_asset_line_detail_id%5
    """,
    "xla_ae_headers": """
        select o_orderkey ae_header_id, o_orderkey event_id from {orders} where o_orderkey%3<>0
    """,
    "xla_ae_lines": """
        select l_orderkey ae_header_id, l_suppkey code_combination_id, case when l_linestatus='F' then
        cast(l_extendedprice as decimal(18,2)) else null end accounted_dr, case when l_returnflag='A' then 'X' else
        null end override_reason from {lineitem}
    """,
}


def sources_of(name: str) -> list[str]:
    """Tables that the view ``name`` reads directly."""
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", VIEWS[name])))


def is_costly(name: str) -> bool:
    """Whether the view shuffles, so that reading it repeatedly should not repeat it."""
    return re.search(r"\b(distinct|join|group by)\b", VIEWS[name]) is not None


class DerivedTables(TableSet):
    """A :class:`TableSet` whose tables are views over the star-schema files in ``directory``."""

    # (application, directory) -> folder of its written views, and which of them are complete.
    _folders: dict[tuple[str, str], str] = {}
    _written: set[str] = set()

    def __init__(self, spark: SparkSession, directory: str):
        super().__init__(spark, {})
        self._directory = directory.rstrip("/")

    def _load(self, name: str) -> DataFrame:
        base = SAME_ROWS.get(name)
        if base:
            return self[base]
        return self._stored(name) if is_costly(name) else self.conform(name, self._view(name))

    def _view(self, name: str) -> DataFrame:
        inputs = {
            source: self._open(f"{self._directory}/{source}.parquet")
            if source in STAR_TABLES
            else self[source]
            for source in sources_of(name)
        }
        return self.spark.sql(VIEWS[name], **inputs)

    def _stored(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self._directory)
        if key not in self._folders:
            self._folders[key] = new_folder(self.spark, "tallyframe")
        path = f"{self._folders[key]}/{name}"
        if path not in self._written:
            view = self.conform(name, self._view(name))
            with sizes_times(self.spark, SIDES_TIMES):
                view.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
            self._written.add(path)
        return self._open(path, self.schema(name))


def view_prefix(names: list[str]) -> str:
    """``WITH`` clause (without trailing comma) that defines ``names`` and all they read."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        base = SAME_ROWS.get(name)
        if base:
            add(base)
            ordered.setdefault(name, f"select * from {base}")
        elif name in VIEWS and name not in ordered:
            sources = sources_of(name)
            for source in sources:
                add(source)
            ordered[name] = VIEWS[name].format(**{source: source for source in sources}).strip()

    for name in names:
        add(name)
    return "with " + ",\n".join(f"{name} as (\n{body}\n)" for name, body in ordered.items())
