"""SQL that DuckDB runs for comparison, written over the same derived tables.

The statements are deliberately naive: they join first, repeat rows as often as the joins say, and aggregate
last.  The Spark plans avoid exactly that, so equal results mean that the shortcuts hold.
"""

from __future__ import annotations

import re

from tallyframe.checks.queries import (
    ASSET_NUMBER,
    ASSET_TYPE,
    BOOK,
    CHECKRUNS,
    COMPANY,
    FROM,
    LIFE,
    LOCATIONS,
    MAJORS,
    MINORS,
    NO_BOOK,
    ONE_MAJOR,
    STATUS as PARTY_STATUS,
    SUPPLIERS_TO,
    TO,
    TWO_STORES,
    UNIT,
    VENDORS,
    YEAR,
)
from tallyframe.plans.rollforward import RETIREMENT_COMPANY_CATEGORY, TRANSACTION_TYPES
from tallyframe.sources.derived import SAME_ROWS, VIEWS, view_prefix

M = "decimal(38,2)"


def _texts(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _ts(moment) -> str:
    return f"timestamp '{moment:%Y-%m-%d %H:%M:%S}'"


def _between(column: str, to=TO) -> str:
    return f"{column} between {_ts(FROM)} and {_ts(to)}"


def _cost_sums(extra: str = "true") -> str:
    """Subquery with the four sums per (asset, distribution, header)."""
    sums = {
        "additions": ("adjustment_amount", "source_type_code in ('ADDITION', 'CIP ADDITION') and debit_credit_flag = 'CR'"),
        "transfers": (
            "case source_dest_code when 'DEST' then adjustment_amount when 'SOURCE' then -adjustment_amount end",
            "source_type_code in ('ADJUSTMENT', 'CIP ADJUSTMENT') and adjustment_type in ('COST', 'CIP COST')",
        ),
        "clearings": (
            "case debit_credit_flag when 'CR' then adjustment_amount when 'DR' then -adjustment_amount end",
            "source_type_code in ('ADJUSTMENT', 'CIP ADJUSTMENT') and adjustment_type = 'COST CLEARING'"
            " and source_dest_code is null",
        ),
        "retirements": (
            "case debit_credit_flag when 'CR' then adjustment_amount when 'DR' then -adjustment_amount end",
            "source_type_code = 'RETIREMENT' and adjustment_type = 'NBV RETIRED'",
        ),
    }
    columns = ", ".join(
        f"cast(coalesce(sum({value}) filter (where {test} and {extra}), 0) as {M}) as {name}"
        for name, (value, test) in sums.items()
    )
    return (
        f"select asset_id, distribution_id, transaction_header_id, {columns} "
        "from fa_adjustments group by asset_id, distribution_id, transaction_header_id"
    )


DISTINCT_COST = " + ".join(
    f"sum(distinct coalesce(moves.{c}, 0))" for c in ("additions", "transfers", "clearings", "retirements")
)

def _movement_lines(majors=MAJORS, book: str | None = None, asset_type: str | None = None) -> str:
    """Scope of assets, their stores and moments, then the amounts that belong to each combination."""
    return f"""
moves as ({_cost_sums()}),
scope as (
  select asset_id, asset_number, asset_type, segment1 as major_asset_category, segment2 as minor_asset_category
  from fa_additions_b join fa_categories_b on category_id = asset_category_id
  where segment1 in {_texts(majors)} and segment2 in {_texts(MINORS)} {f"and asset_type = '{asset_type}'" if asset_type else ""}
),
open_books as (
  select s.asset_id, b.book_type_code as asset_book from scope s left join fa_books b on b.asset_id = s.asset_id
  where b.date_ineffective is null {f"and b.book_type_code = '{book}'" if book else ""}
),
places as (
  select d.asset_id, d.distribution_id, v.description as store_location
  from fa_distribution_history d, gl_code_combinations g, fnd_flex_values_vl v
  where g.code_combination_id = d.code_combination_id and v.flex_value = g.segment2
    and v.value_category = 'Location COA' and v.flex_value in {_texts(LOCATIONS)}
),
moments as (
  select asset_id, transaction_header_id, transaction_date_entered as entered from fa_transaction_headers
  where {_between('transaction_date_entered')}
),
detail as (
  select k.asset_book, s.asset_number, s.asset_type, m.entered, s.major_asset_category, s.minor_asset_category,
         p.store_location, cast({DISTINCT_COST} as {M}) as cost
  from scope s natural join open_books k natural join places p natural join moments m
  left join moves using (asset_id, distribution_id, transaction_header_id)
  group by all
)
"""


PRINTED_LINES = """
select asset_book, asset_number, asset_type, strftime(entered, '%m/%d/%Y') as transaction_date,
       major_asset_category, minor_asset_category, store_location, cost from detail
"""


def _property_tax_summary(keys: str) -> str:
    return f"""{_movement_lines()}
select {keys}, cast(sum(cost) as {M}) as total_cost
from (select distinct {keys}, cost from detail) group by {keys}
"""


PROPERTY_TAX = {
    "property_tax_detail": _movement_lines() + PRINTED_LINES,
    "property_tax_detail_filtered": _movement_lines([ONE_MAJOR], BOOK, ASSET_TYPE) + PRINTED_LINES,
    "property_tax_by_location": _property_tax_summary("major_asset_category, minor_asset_category, store_location"),
    "property_tax_summary": _property_tax_summary("major_asset_category, minor_asset_category"),
}


def _calendar(book: str = BOOK) -> str:
    return f"""
calendar as (
  select max(start_date) filter (where period_num = 1) as start_date,
         max(end_date) filter (where period_num = 12) as end_date,
         max(start_date) filter (where period_num = 1) as q1_start_date,
         max(start_date) filter (where period_num = 4) as q2_start_date,
         max(start_date) filter (where period_num = 7) as q3_start_date,
         max(start_date) filter (where period_num = 10) as q4_start_date
  from fa_calendar_periods join fa_calendar_types using (calendar_type)
  join fa_book_controls using (fiscal_year_name)
  where book_type_code = '{book}' and period_name like '%{YEAR[2:]}%'
)
"""


CALENDAR = _calendar()

DATES = {q: f"(select q{q}_start_date from calendar)" for q in (1, 2, 3, 4)} | {5: "(select end_date from calendar)"}
START, END = "(select start_date from calendar)", DATES[5]


def _quarters(date: str, value: str, name: str) -> str:
    return ", ".join(
        f"cast(sum(case when {date} >= {DATES[q]} and {date} < {DATES[q + 1]} then {value} else 0 end) as {M})"
        f" as q{q}_{name}"
        for q in (1, 2, 3, 4)
    )


TYPES = _texts(TRANSACTION_TYPES)


def _asof_transactions() -> str:
    def one(name: str, test: str) -> str:
        return f"""
  select asset_id, '{name}' as cutoff, transaction_date_entered, max(transaction_header_id) as transaction_header_id
  from fa_transaction_headers h
  where transaction_type_code in {TYPES} and transaction_date_entered = (
    select max(x.transaction_date_entered) from fa_transaction_headers x
    where x.asset_id = h.asset_id and x.transaction_type_code in {TYPES} and x.transaction_date_entered {test})
  group by asset_id, transaction_date_entered"""

    return one("beginning", f"< {START}") + " union all " + one("ending", f"<= {END}")


def _asof_periods() -> str:
    def one(name: str, test: str) -> str:
        return f"""
  select s.asset_id, s.book_type_code, '{name}' as cutoff, max(p.period_open_date) as period_open_date
  from fa_deprn_summary s join fa_deprn_periods p
    on p.book_type_code = s.book_type_code and p.period_counter = s.period_counter
  where p.period_open_date {test} group by s.asset_id, s.book_type_code"""

    return one("beginning", f"< {START}") + " union all " + one("ending", f"<= {END}")


def _rollforward(company: str | None, assets: str = "true", lives: str = "true", book: str = BOOK) -> str:
    def scope(category: str) -> str:
        return f"""
  select a.asset_id, a.asset_number, a.asset_type, c.segment1 as major_asset_category
  from fa_additions_b a join fa_categories_b c on c.category_id = a.asset_category_id
  join (select asset_id, code_combination_id from fa_distribution_history d
        where date_ineffective is null and distribution_id = (
          select max(x.distribution_id) from fa_distribution_history x
          where x.asset_id = d.asset_id and x.date_ineffective is null)) d on d.asset_id = a.asset_id
  left join gl_code_combinations g on g.code_combination_id = d.code_combination_id
  left join fnd_flex_values_vl f on f.flex_value = g.segment1 and f.value_category = '{category}'
  where {assets} {f"and f.flex_value = '{company}'" if company else ""}"""

    cost = [f"q{q}_{n}" for q in (1, 2, 3, 4) for n in ("additions", "retirements", "adjustments")]
    sys_, add, ret = ([f"q{q}_{n}" for q in (1, 2, 3, 4)] for n in ("sys", "add", "ret"))
    measures = ["beginning_balance", "ending_balance", *cost, "beginning_depreciation", "ending_depreciation", *sys_, *add, *ret]

    def branch(source: str, *filled: str) -> str:
        columns = ", ".join(m if m in filled else f"0 as {m}" for m in measures)
        return f"select major_asset_category, life_in_years, {columns} from {source}"

    keys = "major_asset_category, life_in_years"
    retirement_columns = ", ".join(
        f"q{q}_retired + q{q}_reinstated as q{q}_retirements" for q in (1, 2, 3, 4)
    )
    totals = ", ".join(f"cast(sum({m}) as {M}) as {m}" for m in measures)
    final = ["beginning_balance", "ending_balance"]
    for q in (1, 2, 3, 4):
        final.append(f"q{q}_additions + q{q}_adjustments + q{q}_retirements as q{q}")
        final += [f"q{q}_additions", f"q{q}_retirements", f"q{q}_adjustments"]
    final += ["beginning_depreciation", "ending_depreciation"]
    final += [f"q{q}_sys + q{q}_add + q{q}_ret as q{q}_depreciation" for q in (1, 2, 3, 4)]
    final += [f"q{q}_add as q{q}_addition_depreciation" for q in (1, 2, 3, 4)]
    final += [f"q{q}_ret as q{q}_retirement_depreciation" for q in (1, 2, 3, 4)]
    final = [f"cast({f.split(' as ')[0]} as {M}) as {f.split(' as ')[-1]}" for f in final]

    return f"""{_calendar(book)},
scope as ({scope('Company COA')}),
retirement_scope as ({scope(RETIREMENT_COMPANY_CATEGORY)}),
books as (
  select b.*, m.life_in_months, cast(round(m.life_in_months / 12.0, 1) as decimal(12,1)) as life_in_years
  from fa_books b join fa_methods m using (method_id) where b.book_type_code = '{book}' and {lives}
),
movement as (
  select s.major_asset_category, b.life_in_years, h.transaction_date_entered as d,
         case when h.transaction_type_code in ('ADDITION', 'CIP ADDITION') then coalesce(j.adjustment_amount, 0) else 0 end as added,
         case when h.transaction_type_code <> 'ADJUSTMENT' then 0
              when j.source_dest_code = 'DEST' or (j.source_dest_code is null and j.debit_credit_flag = 'CR') then j.adjustment_amount
              when j.source_dest_code = 'SOURCE' or (j.source_dest_code is null and j.debit_credit_flag = 'DR') then -j.adjustment_amount
         end as adjusted,
         case when h.transaction_type_code in ('PARTIAL RETIREMENT', 'FULL RETIREMENT') then -j.adjustment_amount else 0 end as retired,
         case when h.transaction_type_code = 'REINSTATEMENT' then j.adjustment_amount else 0 end as reinstated
  from scope s join books b on b.asset_id = s.asset_id and b.date_ineffective is null
  join fa_transaction_headers h on h.asset_id = s.asset_id and h.transaction_type_code in {TYPES}
   and h.transaction_date_entered >= {START} and h.transaction_date_entered <= {END}
  left join fa_adjustments j on j.asset_id = h.asset_id and j.transaction_header_id = h.transaction_header_id and (
       (j.source_type_code = 'RETIREMENT' and j.adjustment_type = 'COST')
    or (j.source_type_code = 'CIP RETIREMENT' and j.adjustment_type = 'CIP COST')
    or (j.source_type_code = 'ADDITION' and j.debit_credit_flag = 'CR')
    or (j.source_type_code = 'CIP ADDITION' and j.debit_credit_flag = 'CR' and s.asset_type = 'CIP')
    or (j.source_type_code = 'ADJUSTMENT' and j.adjustment_type = 'COST' and j.source_dest_code in ('SOURCE', 'DEST'))
    or (j.source_type_code = 'ADJUSTMENT' and j.adjustment_type = 'COST CLEARING' and j.source_dest_code is null))
),
moved as (
  select {keys}, {_quarters('d', 'added', 'additions')}, {_quarters('d', 'adjusted', 'adjustments')},
         {_quarters('d', 'retired', 'retired')}, {_quarters('d', 'reinstated', 'reinstated')}
  from movement group by {keys}
),
moved_net as (select *, {retirement_columns} from moved),
last_transaction as ({_asof_transactions()}),
costs as (
  select {keys}, sum(case cutoff when 'beginning' then coalesce(b.cost, 0) else 0 end) as beginning_balance,
         sum(case cutoff when 'ending' then coalesce(b.cost, 0) else 0 end) as ending_balance
  from scope s join books b on b.asset_id = s.asset_id
  join last_transaction t on t.asset_id = b.asset_id and t.transaction_header_id = b.transaction_header_id_in
  group by {keys}
),
charge as (
  select s.major_asset_category, b.life_in_years, p.period_open_date as d,
         -(case when x.deprn_source_code = 'BOOKS' then x.deprn_reserve else x.system_deprn_amount end) as sys,
         -(case when x.deprn_source_code = 'DEPRN' then x.deprn_adjustment_amount else 0 end) as add
  from scope s join books b on b.asset_id = s.asset_id and b.date_ineffective is null
  join fa_deprn_summary x on x.asset_id = s.asset_id and x.book_type_code = b.book_type_code
  join fa_deprn_periods p on p.period_counter = x.period_counter and p.book_type_code = x.book_type_code
   and p.period_open_date >= {START} and p.period_open_date <= {END}
),
charged as (select {keys}, {_quarters('d', 'sys', 'sys')}, {_quarters('d', 'add', 'add')} from charge group by {keys}),
release as (
  select s.major_asset_category, b.life_in_years, h.transaction_date_entered as d, j.adjustment_amount as ret
  from retirement_scope s join books b on b.asset_id = s.asset_id and b.date_ineffective is null
  join fa_retirements r on r.asset_id = s.asset_id and r.book_type_code = b.book_type_code and r.status = 'PROCESSED'
  join fa_transaction_headers h on h.asset_id = s.asset_id and h.transaction_header_id = r.transaction_header_id_in
   and h.transaction_date_entered >= {START} and h.transaction_date_entered <= {END}
  join fa_adjustments j on j.asset_id = s.asset_id and j.transaction_header_id = r.transaction_header_id_in
   and j.source_type_code = 'RETIREMENT' and j.adjustment_type = 'RESERVE'
),
released as (select {keys}, {_quarters('d', 'ret', 'ret')} from release group by {keys}),
last_period as ({_asof_periods()}),
reserve as (
  select distinct s.asset_number, s.major_asset_category, b.life_in_months, b.life_in_years, t.cutoff, p.period_open_date,
         x.deprn_reserve
  from scope s join books b on b.asset_id = s.asset_id
  join fa_deprn_summary x on x.asset_id = b.asset_id and x.book_type_code = b.book_type_code
  join last_period t on t.asset_id = x.asset_id and t.book_type_code = x.book_type_code
  join fa_deprn_periods p on p.book_type_code = t.book_type_code and p.period_counter = x.period_counter
   and p.period_open_date = t.period_open_date
),
reserves as (
  select {keys}, sum(case cutoff when 'beginning' then -deprn_reserve else 0 end) as beginning_depreciation,
         sum(case cutoff when 'ending' then -deprn_reserve else 0 end) as ending_depreciation
  from reserve group by {keys}
),
everything as (
  {branch('moved_net', *cost)} union all {branch('costs', 'beginning_balance', 'ending_balance')}
  union all {branch('charged', *sys_, *add)} union all {branch('released', *ret)}
  union all {branch('reserves', 'beginning_depreciation', 'ending_depreciation')}
),
totals as (select {keys}, {totals} from everything group by {keys})
select {keys}, {', '.join(final)} from totals
"""


ACCOUNT = " || '-' || ".join(f"coalesce(g.segment{i}, '')" for i in range(1, 8))

STATUS = """
picked_status as (
  select d.expenditure_item_id, first(v.meaning order by d.project_asset_line_detail_id, v.meaning nulls first) as asset_status
  from pjc_prj_asset_ln_dets d join pjc_prj_asset_lns_all l using (project_asset_line_detail_id)
  left join fnd_lookup_values v on v.lookup_type = 'PJC_TRANSFER_STATUS' and v.lookup_code = l.transfer_status_code
  group by d.expenditure_item_id
)
"""

EVENT_ACCOUNTS = f"""
event_account as (
  select h.event_id, min({ACCOUNT}) as account
  from xla_ae_headers h join xla_ae_lines l using (ae_header_id) join gl_code_combinations g using (code_combination_id)
  where l.accounted_dr is not null and l.override_reason is null group by h.event_id
)
"""


def _listing(where: str, company: str | None, book: str = BOOK) -> str:
    return f"""{_calendar(book)}, {STATUS}, {EVENT_ACCOUNTS},
invoice_account as (
  select i.invoice_id, min(e.account) as account
  from ap_invoice_distributions_all i join event_account e on e.event_id = i.accounting_event_id group by i.invoice_id
),
listing as (
  select p.project_id, p.name as project_name, p.segment1 as project_number, tn.name as task_name,
         t.element_number as task_number, t.proj_element_id as task_id, i.expenditure_item_date,
         cast(round(c.projfunc_raw_cost, 2) as {M}) as cost, n.display_name as employee,
         i.expenditure_item_id as transaction_number, hp.party_name as supplier, p.attribute1 as legal_entity,
         i.capitalization_dist_flag as cip_flag, c.prvdr_gl_period_name as gl_period,
         case when k.class_code != 'Task Level' then k.class_code else v.meaning end as location,
         coalesce(ea.account, ia.account, (
           select {ACCOUNT} from gl_code_combinations g
           where g.code_combination_id = c.raw_cost_dr_ccid and c.accounting_status_code != 'RNBNN')) as raw_cost_debit_acct,
         st.asset_status, c.prvdr_gl_date as provider_acc_date
  from pjc_cost_dist_lines_all c
  join pjf_projects_all_vl p on p.project_id = c.project_id
  join pjf_proj_elements_b t on t.project_id = c.project_id and t.proj_element_id = c.task_id
  join pjf_proj_elements_tl tn on tn.proj_element_id = t.proj_element_id
  join pjf_project_classes pc on pc.project_id = p.project_id
  join pjf_class_codes_b kb on kb.class_code_id = pc.class_code_id
  join pjf_class_codes_tl k on k.class_code_id = kb.class_code_id
  join pjc_exp_items_all i on i.expenditure_item_id = c.expenditure_item_id
  left join per_person_names_f_v n on n.person_id = i.incurred_by_person_id
  left join ap_invoices_all ai on ai.invoice_id = i.original_header_id
  left join poz_suppliers ps on ps.vendor_id = ai.vendor_id
  left join hz_parties hp on hp.party_id = ps.party_id
  left join fnd_lookup_values v on v.lookup_type = 'PJF_SERVICE_TYPE' and v.lookup_code = t.service_type_code
  left join picked_status st on st.expenditure_item_id = i.expenditure_item_id
  left join event_account ea on ea.event_id = c.acct_event_id
  left join invoice_account ia on ia.invoice_id = i.original_header_id
  where {where} {f"and p.attribute1 = '{company}'" if company else ""}
)
"""


def _cip_rollforward(company: str | None, book: str = BOOK) -> str:
    d = "provider_acc_date"
    in_progress = "(asset_status is null or asset_status = 'Pending')"

    def amount(test: str, sign: str = "") -> str:
        return f"cast(coalesce(sum({sign}cost) filter (where {test}), 0) as {M})"

    columns = [
        f"{amount(f'{in_progress} and {d} < {START}')} as beginning_cip",
        f"{amount(f'{in_progress} and {d} < {END}')} as ending_cip",
    ]
    for name, test, sign in (("cip", in_progress, ""), ("cip_cap", "asset_status = 'Transferred'", "-")):
        for q in (1, 2, 3, 4):
            columns.append(f"{amount(f'{test} and {d} >= {DATES[q]} and {d} < {DATES[q + 1]}', sign)} as q{q}_{name}")
    return _listing("true", company, book) + f"select {', '.join(columns)} from listing"


def _nbv_detail(locations, book: str | None = None) -> str:
    chosen = f"and s.flex_value in {_texts(locations)}" if locations else ""
    chosen += f" and b.book_type_code = '{book}'" if book else ""
    keys = "asset_book, asset_number, asset_type, store_number, store_location"
    return f"""
moves as ({_cost_sums()}),
cost_rows as (
  select b.book_type_code as asset_book, a.asset_number, a.asset_type, s.flex_value as store_number,
         s.description as store_location, h.transaction_date_entered, j.period_counter_adjusted, p.period_name,
         {DISTINCT_COST} as cost
  from fa_additions_b a left join fa_books b on b.asset_id = a.asset_id
  left join fa_transaction_headers h on h.asset_id = a.asset_id
  left join fa_distribution_history d on d.asset_id = a.asset_id
  left join gl_code_combinations g on g.code_combination_id = d.code_combination_id
  left join fnd_flex_values_vl s on s.flex_value = g.segment2
  left join fa_adjustments j on j.distribution_id = d.distribution_id and j.transaction_header_id = h.transaction_header_id
  left join fa_deprn_periods p on p.period_counter = j.period_counter_adjusted
  left join moves on moves.asset_id = a.asset_id and moves.distribution_id = d.distribution_id
       and moves.transaction_header_id = h.transaction_header_id
  where b.date_ineffective is null {chosen} and {_between('h.transaction_date_entered')}
  group by all
),
moved as (select {keys}, period_name, sum(cost) as cost_variation from cost_rows group by all),
charge_rows as (
  select distinct b.book_type_code as asset_book, a.asset_number, a.asset_type, s.flex_value as store_number,
         s.description as store_location, x.period_counter, p.period_name, x.deprn_amount
  from fa_additions_b a left join fa_books b on b.asset_id = a.asset_id
  left join fa_deprn_summary x on x.asset_id = a.asset_id
  left join fa_distribution_history d on d.asset_id = a.asset_id
  left join gl_code_combinations g on g.code_combination_id = d.code_combination_id
  left join fnd_flex_values_vl s on s.flex_value = g.segment2
  left join fa_deprn_periods p on p.period_counter = x.period_counter
  where b.date_ineffective is null {chosen} and {_between('x.deprn_run_date')}
),
charged as (select {keys}, period_name, sum(deprn_amount) as dprn_variation from charge_rows group by all)
select asset_book, store_number, store_location,
       case when strpos(period_name, '-') > 1 then substr(period_name, 1, strpos(period_name, '-') - 1) end as period_month,
       period_name, cast(sum(distinct coalesce(cost_variation, 0)) as {M}) as cost_variation,
       cast(sum(distinct coalesce(dprn_variation, 0)) as {M}) as dprn_variation
from charged left join moved using ({keys}, period_name)
group by all
"""


def _nbv_summary(locations, book: str | None = None) -> str:
    chosen = f"and s.flex_value in {_texts(locations)}" if locations else ""
    chosen += f" and b.book_type_code = '{book}'" if book else ""

    def opening(column: str) -> str:
        return f"""(
    select coalesce(sum(y.{column}), 0) from fa_deprn_summary y join last_counter z using (asset_id)
    where y.asset_id = x.asset_id and y.deprn_source_code = 'DEPRN' and y.period_counter = z.period_counter)"""

    def cost(*names: str) -> str:
        return " + ".join(
            f"sum(distinct case when h.transaction_date_entered <= {_ts(FROM)} then coalesce(moves.{n}, 0) else 0 end)"
            for n in names
        )

    return f"""
moves as ({_cost_sums()}),
last_counter as (
  select asset_id, max(period_counter) as period_counter from fa_deprn_summary
  where deprn_run_date <= {_ts(FROM)} group by asset_id
),
opening as (
  select distinct x.asset_id, {opening('deprn_reserve')} as reserve, {opening('impairment_reserve')} as impairment
  from fa_deprn_summary x
),
lines as (
  select b.book_type_code as asset_book, a.asset_number, a.asset_type, s.flex_value as store_number,
         s.description as store_location, x.period_counter, p.period_name, x.deprn_reserve, x.adjusted_cost,
         x.impairment_reserve, {cost('additions')} as additions, {cost('transfers', 'clearings')} as adjustments,
         {cost('retirements')} as retirements,
         sum(distinct o.reserve) as reserve, sum(distinct o.impairment) as impairment
  from fa_additions_b a left join fa_books b on b.asset_id = a.asset_id
  left join fa_deprn_summary x on x.asset_id = b.asset_id
  left join opening o on o.asset_id = x.asset_id
  left join fa_transaction_headers h on h.asset_id = a.asset_id
  left join fa_distribution_history d on d.asset_id = b.asset_id
  left join gl_code_combinations g on g.code_combination_id = d.code_combination_id
  left join fnd_flex_values_vl s on s.flex_value = g.segment2
  left join fa_deprn_periods p on p.period_counter = x.period_counter
  left join moves on moves.asset_id = a.asset_id and moves.distribution_id = d.distribution_id
       and moves.transaction_header_id = h.transaction_header_id
  where b.date_ineffective is null and x.deprn_source_code = 'DEPRN' {chosen} and {_between('x.deprn_run_date')}
  group by all
),
figures as (
  select distinct asset_book, asset_number, asset_type, store_number, store_location, additions, adjustments,
         retirements, reserve, impairment from lines
)
select asset_book, store_number, store_location,
       cast(sum(additions + adjustments + retirements) - sum(reserve) - sum(impairment) as {M}) as beginning_nvb
from figures group by all
"""


LOCATION = """
line_account as (
  select d.invoice_id, first(g.segment2 order by d.dist_code_combination_id, g.segment2 nulls first) as location
  from ap_invoice_distributions_all d join gl_code_combinations g on g.code_combination_id = d.dist_code_combination_id
  where d.invoice_line_number = (
    select min(x.invoice_line_number) from ap_invoice_distributions_all x where x.invoice_id = d.invoice_id)
  group by d.invoice_id
)
"""

PAYMENT_DETAILS = f"""{LOCATION}
select r.checkrun_name, strftime(r.check_date, '%m/%d/%Y') as check_date, r.status as batch_status, s.invoice_num,
       s.vendor_num, s.vendor_name, strftime(s.invoice_date, '%m/%d/%Y') as invoice_date,
       strftime(s.due_date, '%m/%d/%Y') as due_date, cast(i.invoice_amount as {M}) as invoice_amount,
       cast(coalesce(i.invoice_amount, 0) - coalesce(i.amount_paid, 0) as {M}) as unpaid_amount,
       cast(s.discount_amount as {M}) as discount_amount,
       cast(coalesce(i.invoice_amount, 0) - coalesce(i.amount_paid, 0) - s.discount_amount as {M}) as net_amount,
       m.payment_method_name as payment_method, i.description, i.pay_group_lookup_code as pay_group_code,
       v.meaning as pay_group, t.name as payment_terms, l.location, s.ok_to_pay_flag as ok_to_pay
from ap_selected_invoices_all s
join ap_inv_selection_criteria_all r using (checkrun_id)
join ap_invoices_all i using (invoice_id)
left join fnd_lookup_values_vl v on v.lookup_type = 'PAY GROUP' and v.lookup_code = i.pay_group_lookup_code
left join ap_terms_vl t on t.term_id = i.terms_id
left join iby_payment_methods_vl m on m.payment_method_code = i.payment_method_code
left join line_account l on l.invoice_id = i.invoice_id
where s.ok_to_pay_flag = 'Y' and r.checkrun_name in {_texts(CHECKRUNS)}
"""


def _spaced(*names: str) -> str:
    return " || ' ' || ".join(f"coalesce({n}, '')" for n in names)


def _supplier_directory(start=FROM, end=SUPPLIERS_TO, more: str = "h.status is not null") -> str:
    def between(column: str) -> str:
        return f"{column} between {_ts(start)} and {_ts(end)}"

    return f"""
named as (
  select u.bu_name as business_unit, m.payment_method_name as method_of_payment, t.description as payment_terms,
         v.meaning as pay_group, s.segment1 as supplier_number, h.party_name as supplier_name,
         s.vendor_type_lookup_code as supplier_type,
         nullif(ltrim(coalesce(st.party_site_name, '') || {_spaced('h.address1', 'h.address2', 'h.address3', 'h.address4',
                                                                  'h.city', 'h.state', 'h.postal_code', 'h.country')}), '') as address,
         nullif(coalesce(c.person_last_name || ', ', '') || coalesce(c.person_first_name, ''), '') as contact_name,
         {_spaced('c.primary_phone_area_code', 'c.primary_phone_number', 'c.primary_phone_extension')} as phone,
         c.email_address as email, s.type_1099 as federal_income_tax_type, pii.income_tax_id as taxpayer_id,
         strftime(s.creation_date, '%m/%d/%Y') as creation_date, hp.party_name as parent_supplier,
         sv.vendor_name_alt as alternate_name,
         nullif(case when ad.address_purpose_ordering = 'Y' then 'Ordering ' else '' end
             || case when ad.address_purpose_remit_to = 'Y' then 'Remit to ' else '' end
             || case when ad.address_purpose_rfq_or_bidding = 'Y' then 'RFQ or Bidding ' else '' end, '') as address_purpose,
         s.vendor_id, i.invoice_id, i.invoice_amount, pay.payment_id, po.segment1 as order_number
  from poz_suppliers s
  join hz_parties h on h.party_id = s.party_id
  join ap_invoices_all i on i.vendor_id = s.vendor_id
  join fun_all_business_units_v u on u.bu_id = i.org_id
  join ap_invoice_distributions_all d on d.invoice_id = i.invoice_id
  join ap_checks_all ch on ch.vendor_id = s.vendor_id and ch.party_id = h.party_id
  join iby_payments_all pay on pay.payment_id = ch.payment_id
  left join po_distributions_all pd on pd.po_distribution_id = d.po_distribution_id
  left join po_headers_all po on po.po_header_id = pd.po_header_id and po.vendor_id = s.vendor_id
  left join iby_payment_methods_tl m on m.payment_method_code = i.payment_method_code
  left join ap_terms_tl t on t.term_id = i.terms_id
  left join fnd_lookup_values v on v.lookup_type = 'PAY GROUP' and v.lookup_code = i.pay_group_lookup_code
  left join hz_party_sites st on st.party_site_id = h.iden_addr_party_site_id
  left join hz_parties c on c.party_id = h.preferred_contact_person_id
  left join poz_suppliers sp on sp.party_id = s.parent_party_id
  left join hz_parties hp on hp.party_id = sp.party_id
  left join poz_suppliers_pii pii on pii.vendor_id = s.vendor_id
  left join poz_suppliers_v sv on sv.vendor_id = s.vendor_id
  left join poz_supplier_address_v ad on ad.vendor_id = s.vendor_id and ad.party_id = h.party_id
  where {between('d.accounting_date')} and {between('pay.payment_date')} and {more}
)
select * exclude (vendor_id) from (
select * exclude (invoice_id, invoice_amount, payment_id, order_number),
       count(distinct invoice_id) as total_invoice_count, cast(sum(coalesce(invoice_amount, 0)) as {M}) as total_invoice_amount,
       count(distinct payment_id) as no_of_payments, count(distinct order_number) as total_po_count
from named group by all)
"""

OPERATORS = {
    "fiscal_calendar": f"{CALENDAR} select * from calendar",
    "optional_filter": f"""
select 'book given' as filter, count(*) as n_rows from fa_books where book_type_code = '{BOOK}'
union all select 'all', count(*) from fa_books""",
    "multi_select": f"""
select 'listed' as filter, count(*) as n_rows from fnd_flex_values_vl where flex_value in {_texts(TWO_STORES)}
union all select 'no list', 0
union all select 'no list means all', count(*) from fnd_flex_values_vl
union all select 'null in list means all', count(*) from fnd_flex_values_vl""",
    "date_range_filter": f"""
select transaction_type_code, count(*) as n_rows from fa_transaction_headers
where {_between('transaction_date_entered')} group by transaction_type_code""",
    "range_join_params": f"""{CALENDAR}
select book_type_code, period_counter, period_name from fa_deprn_periods
where period_open_date >= {START} and period_open_date <= {END}""",
    "quarter_buckets": f"""{CALENDAR}
select book_type_code, {_quarters('deprn_run_date', 'deprn_amount', 'amount')} from fa_deprn_summary group by book_type_code""",
    "current_rows": """
select distribution_id, asset_id, code_combination_id from fa_distribution_history where date_ineffective is null""",
    "current_books": """
select distinct a.asset_id, b.book_type_code as asset_book from fa_additions_b a left join fa_books b using (asset_id)
where b.date_ineffective is null""",
    "conditional_outer_join": """
select d.distribution_id, g.segment1, f.description as company from fa_distribution_history d
left join gl_code_combinations g using (code_combination_id)
left join fnd_flex_values_vl f on f.flex_value = g.segment1 and f.value_category = 'Company COA'""",
    "latest_distribution": """
select asset_id, distribution_id, code_combination_id from fa_distribution_history d
where date_ineffective is null and distribution_id = (
  select max(x.distribution_id) from fa_distribution_history x where x.asset_id = d.asset_id and x.date_ineffective is null)""",
    "asof_transaction": f"""{CALENDAR}, picked as ({_asof_transactions()})
select asset_id, cutoff, strftime(transaction_date_entered, '%m/%d/%Y') as entered, transaction_header_id from picked""",
    "asof_period": f"""{CALENDAR}, picked as ({_asof_periods()})
select asset_id, book_type_code, cutoff, strftime(period_open_date, '%m/%d/%Y') as opened from picked""",
    "adjustment_components": f"""moves as ({_cost_sums()}),
listed as (
  select m.asset_id, m.distribution_id, m.transaction_header_id, strftime(h.entered, '%m/%d/%Y') as entered,
         unnest([0, 1, 2, 3]) as component,
         unnest([m.additions, m.transfers, m.clearings, m.retirements]) as value
  from moves m join (
    select distinct asset_id, transaction_header_id, transaction_date_entered as entered from fa_transaction_headers
    where transaction_date_entered is not null) h using (asset_id, transaction_header_id)
)
select * from listed where value <> 0""",
    "asset_status": f"{STATUS} select * from picked_status",
    "event_accounts": f"{EVENT_ACCOUNTS} select * from event_account",
    "first_line_location": f"""{LOCATION}
select i.invoice_id, l.location from (
  select distinct invoice_id from ap_invoice_distributions_all
  where invoice_id is not null and invoice_line_number is not null) i
left join line_account l using (invoice_id)""",
    "grouped_sum": f"""
select source_type_code, adjustment_type, cast(sum(adjustment_amount) as {M}) as amount
from fa_adjustments group by source_type_code, adjustment_type""",
    "sum_distinct": f"""
select source_type_code, cast(sum(distinct adjustment_amount) as {M}) as distinct_amount,
       cast(sum(adjustment_amount) as {M}) as amount from fa_adjustments group by source_type_code""",
    "multi_count_distinct": f"""
select vendor_id, count(distinct invoice_id) as invoices, count(distinct po_distribution_id) as orders,
       count(distinct dist_code_combination_id) as accounts, cast(sum(coalesce(invoice_amount, 0)) as {M}) as amount
from ap_invoice_distributions_all join ap_invoices_all using (invoice_id) group by vendor_id""",
    "global_agg_empty": f"""
select cast(coalesce(sum(cost), 0) as {M}) as cost, count(*) as n_rows from fa_books where book_type_code = '{NO_BOOK}'""",
    "group_distinct": """
select book_type_code, period_counter, deprn_source_code from fa_deprn_summary
group by book_type_code, period_counter, deprn_source_code""",
    "signed_amount": f"""
select source_type_code,
       cast(sum(case source_dest_code when 'DEST' then 1 when 'SOURCE' then -1 end * adjustment_amount) as {M}) as transferred,
       cast(sum(case debit_credit_flag when 'CR' then 1 when 'DR' then -1 end * adjustment_amount) as {M}) as credited
from fa_adjustments group by source_type_code""",
    "null_concat": f"select g.code_combination_id, {ACCOUNT} as account from gl_code_combinations g",
    "period_prefix": """
select book_type_code, period_counter,
       case when strpos(period_name, '-') > 1 then split_part(period_name, '-', 1) end as period_month
from fa_deprn_periods""",
    "date_text": """
select strftime(transaction_date_entered, '%m/%d/%Y') as transaction_date, count(*) as n_rows
from fa_transaction_headers group by 1""",
    "life_in_years": """
select method_id, cast(round(life_in_months / 12.0, 1) as decimal(12,1)) as life_in_years from fa_methods""",
    "zero_pad_union": f"""
select book_type_code, cast(sum(cost) as {M}) as cost, cast(0 as {M}) as reserve from fa_books group by book_type_code
union all select book_type_code, 0, cast(sum(deprn_reserve) as {M}) from fa_deprn_summary group by book_type_code""",
}

BODIES: dict[str, str] = {
    **PROPERTY_TAX,
    "asset_rollforward": _rollforward(None),
    "asset_rollforward_company": _rollforward(COMPANY),
    "asset_rollforward_filtered": _rollforward(None, f"c.segment1 = '{ONE_MAJOR}'", f"life_in_years = {LIFE}"),
    "asset_rollforward_asset": _rollforward(None, f"a.asset_number = '{ASSET_NUMBER}'"),
    "asset_rollforward_no_calendar": _rollforward(None, book=NO_BOOK),
    "cip_rollforward_no_calendar": _cip_rollforward(None, NO_BOOK),
    "cip_rollforward": _cip_rollforward(None),
    "cip_rollforward_company": _cip_rollforward(COMPANY),
    "cip_listing_beginning": _listing(f"c.prvdr_gl_date < {START}", None) + "select * from listing",
    "cip_listing_in_range": _listing(f"c.prvdr_gl_date >= {START} and c.prvdr_gl_date <= {END}", None)
    + "select * from listing",
    "cip_listing_ending": _listing(f"c.prvdr_gl_date < {END}", None) + "select * from listing",
    "nbv_detail": _nbv_detail(None),
    "nbv_detail_locations": _nbv_detail(TWO_STORES),
    "nbv_detail_book": _nbv_detail(None, BOOK),
    "nbv_summary_book": _nbv_summary(None, BOOK),
    "nbv_summary": _nbv_summary(None),
    "nbv_summary_locations": _nbv_summary(TWO_STORES),
    "payment_details": PAYMENT_DETAILS,
    "payment_details_suppliers": f"{PAYMENT_DETAILS} and s.vendor_name in {_texts(VENDORS)}",
    "payment_details_all_suppliers": PAYMENT_DETAILS,
    "supplier_directory": _supplier_directory(),
    "supplier_directory_filtered": _supplier_directory(more=f"h.status = '{PARTY_STATUS}' and u.bu_id = {UNIT}"),
    "supplier_directory_reversed": _supplier_directory(SUPPLIERS_TO, FROM),
    **OPERATORS,
}


def over_tables(name: str) -> str:
    """The statement over tables that already exist under their ERP names."""
    body = BODIES[name].strip()
    return f"with {body}" if re.match(r"\w+ as \(", body) else body


def statements() -> dict[str, str]:
    """Complete statements over the star schema: the derived tables that a body names, then the body."""
    result = {}
    for name, body in BODIES.items():
        words = set(re.findall(r"\w+", body))
        tables = [t for t in (*VIEWS, *SAME_ROWS) if t in words]
        rest = over_tables(name)
        views = view_prefix(tables)
        result[name] = views + (",\n" + rest.removeprefix("with ") if rest.startswith("with ") else "\n" + rest)
    return result
