"""Fixed-asset roll-forward: opening and closing balances of cost and depreciation with quarterly movements."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.predicates import optional_eq
from tallyframe.functions.values import MONEY, life_in_years, money, signed, zero_if_null
from tallyframe.operators.calendar import QUARTERS, Calendar, quarter_sums
from tallyframe.operators.combine import left_join_spreading_nulls, zero_pad_union
from tallyframe.operators.keyed import current_rows, last_before, latest_rows
from tallyframe.sources.registry import TableSet
from tallyframe.sources.scratch import dealt_if_long, stored, stored_together

# Fixed values that the results depend on.
TRANSACTION_TYPES = (
    "ADJUSTMENT",
    "ADDITION",
    "CIP ADDITION",
    "PARTIAL RETIREMENT",
    "FULL RETIREMENT",
    "REINSTATEMENT",
)
COMPANY_CATEGORY = "Company COA"
RETIREMENT_COMPANY_CATEGORY = "Company Northgate COA"

KEYS = ("major_asset_category", "life_in_years")
WEIGHTS = ("weight", "retirement_weight")


def _quarterly(*names: str) -> list[str]:
    return [f"q{q}_{name}" for q in QUARTERS for name in names]


MEASURES = (
    "beginning_balance",
    "ending_balance",
    *_quarterly("additions", "retirements", "adjustments"),
    "beginning_depreciation",
    "ending_depreciation",
    *_quarterly("system_depreciation"),
    *_quarterly("addition_depreciation"),
    *_quarterly("retirement_depreciation"),
)


class _Scope:
    """The tables of one run together with its filters."""

    def __init__(
        self,
        tables: TableSet,
        calendar: Calendar,
        book: str,
        asset_number: str | None,
        company: str | None,
        major: str | None,
        life_years: Decimal | float | str | None,
        retirement_category: str,
    ):
        self.tables, self.calendar, self.book = tables, calendar, book
        self.retirement_category = retirement_category
        self.asset_number, self.company, self.major = asset_number, company, major
        self.life_years = None if life_years is None else Decimal(str(life_years))
        # Written once: every branch is limited to these assets and reads these rows.
        self.assets = dealt_if_long(stored(self._assets(), "scope"))
        self.books, self.year_headers, self.charges = stored_together(
            stored, books=self._books(), headers=self._year_headers(), charges=self._charges()
        )

    def in_scope(self, frame: DataFrame) -> DataFrame:
        return frame.join(self.assets, "asset_id", "left_semi")

    def _assets(self) -> DataFrame:
        """Assets in scope with their major category, placed by their latest open distribution.

        ``weight`` counts the company rows an asset joins, and ``retirement_weight`` does the same in the value
        category that retirements use.  Without a company an asset that joins none still counts once; with one,
        only its rows count, and zero means out of scope.
        """
        t = self.tables
        majors = optional_eq(t["fa_categories_b"], "segment1", self.major).select(
            F.col("category_id").alias("asset_category_id"), F.col("segment1").alias("major_asset_category")
        )
        category = F.col("value_category")
        companies = (
            optional_eq(t["fnd_flex_values_vl"], "flex_value", self.company)
            .groupBy(F.col("flex_value").alias("segment1"))
            .agg(
                F.count_if(category == COMPANY_CATEGORY).alias("weight"),
                F.count_if(category == self.retirement_category).alias("retirement_weight"),
            )
        )
        fewest = F.lit(1 if self.company is None else 0)
        placed = (
            latest_rows(current_rows(t["fa_distribution_history"]), "asset_id", "distribution_id")
            .select("asset_id", "code_combination_id")
        )
        # Accounts meet the companies first: the assets are never dealt by company.
        accounts = t["gl_code_combinations"].select("code_combination_id", "segment1").join(companies, "segment1")
        placed = left_join_spreading_nulls(placed, accounts.drop("segment1"), ["code_combination_id"]).select(
            "asset_id", *(F.greatest(F.coalesce(w, F.lit(0)), fewest).alias(w) for w in WEIGHTS)
        )
        return (
            optional_eq(t["fa_additions_b"], "asset_number", self.asset_number)
            .join(majors, "asset_category_id")
            .join(placed, "asset_id")
            .filter(" + ".join(WEIGHTS) + " > 0")
            .select("asset_id", "asset_number", "asset_type", "major_asset_category", *WEIGHTS)
        )

    def _books(self) -> DataFrame:
        """All rows of the book, past ones included, with the life of their method."""
        lives = self.tables["fa_methods"].withColumn("life_in_years", life_in_years(F.col("life_in_months")))
        lives = optional_eq(lives, "life_in_years", self.life_years)
        rows = self.in_scope(self.tables["fa_books"].filter(F.col("book_type_code") == self.book))
        return rows.join(lives, "method_id").select(
            "asset_id", "date_ineffective", "transaction_header_id_in", "cost", "life_in_months", "life_in_years"
        )

    def weighted_assets(self) -> DataFrame:
        """Assets by life of their open book rows, and how often each movement of theirs counts."""
        lives = current_rows(self.books).select("asset_id", "life_in_years")
        return (
            self.assets.join(lives, "asset_id")
            .groupBy("asset_id", "asset_type", *KEYS)
            .agg(*(F.sum(w).cast("decimal(20,0)").alias(w) for w in WEIGHTS))
        )

    def _year_headers(self) -> DataFrame:
        when = F.col("transaction_date_entered")
        return self.in_scope(self.tables["fa_transaction_headers"].filter(self.calendar.in_year(when))).select(
            "asset_id",
            "transaction_header_id",
            "transaction_type_code",
            self.calendar.quarter_mask(when).alias("quarters"),
        )

    def _charges(self) -> DataFrame:
        """Depreciation rows of the book up to the end of the year, as one row per asset, period and reserve.

        ``system`` and ``added`` are their sums; an asset's periods and reserves are few, however many its rows.
        """
        opened = F.col("period_open_date")
        periods = (
            self.tables["fa_deprn_periods"]
            .filter(F.col("book_type_code") == self.book)
            .filter((opened < self.calendar.start) | (opened <= self.calendar.end))
            .select("period_counter", "period_open_date")
        )
        source = F.col("deprn_source_code")
        booked = F.when(source == "BOOKS", F.col("deprn_reserve")).otherwise(F.col("system_deprn_amount"))
        added = F.when(source == "DEPRN", F.col("deprn_adjustment_amount")).otherwise(F.lit(0).cast("decimal(18,2)"))
        rows = self.in_scope(self.tables["fa_deprn_summary"].filter(F.col("book_type_code") == self.book))
        return (
            rows.join(periods, "period_counter")
            .groupBy("asset_id", "period_open_date", "deprn_reserve")
            .agg(F.sum(booked).alias("system"), F.sum(added).alias("added"))
        )


def _transactions(scope: _Scope) -> DataFrame:
    """Additions, adjustments and retirements of the year per asset and quarter."""
    headers = scope.year_headers.filter(F.col("transaction_type_code").isin(*TRANSACTION_TYPES))

    source, kind = F.col("source_type_code"), F.col("adjustment_type")
    direction, side = F.col("source_dest_code"), F.col("debit_credit_flag")
    cip_only = source == "CIP ADDITION"
    counted = (
        (source.isin("ADDITION", "CIP ADDITION") & (side == "CR"))
        | ((source == "ADJUSTMENT") & direction.isNull() & (kind == "COST CLEARING"))
        | ((source == "ADJUSTMENT") & direction.isin("DEST", "SOURCE") & (kind == "COST"))
        | ((source == "RETIREMENT") & (kind == "COST"))
        | ((source == "CIP RETIREMENT") & (kind == "CIP COST"))
    )
    adjustments = (
        scope.tables["fa_adjustments"]
        .filter(counted)
        .select(
            "asset_id",
            "transaction_header_id",
            cip_only.alias("cip_only"),
            "adjustment_amount",
            "source_dest_code",
            "debit_credit_flag",
        )
    )
    # Transactions without a counted adjustment still make their group appear.  Listing every transaction
    # once more without an amount does that and changes no sum, so no outer join is needed.
    bare = headers.withColumns(
        {
            "cip_only": F.lit(False),
            "adjustment_amount": F.lit(None).cast("decimal(18,2)"),
            "source_dest_code": F.lit(None).cast("string"),
            "debit_credit_flag": F.lit(None).cast("string"),
        }
    )
    rows = bare.unionByName(headers.join(adjustments, ["asset_id", "transaction_header_id"]))

    amount, code = F.col("adjustment_amount"), F.col("transaction_type_code")
    none = F.lit(0).cast("decimal(18,2)")
    adjustment = F.when(direction.isNull(), signed(amount, side, plus="CR", minus="DR")).otherwise(
        signed(amount, direction, plus="DEST", minus="SOURCE")
    )
    kinds = {
        "addition": zero_if_null(F.when(code.isin("ADDITION", "CIP ADDITION"), amount)),
        "adjustment": F.when(code == "ADJUSTMENT", adjustment).otherwise(none),
        "retired": F.when(code.isin("PARTIAL RETIREMENT", "FULL RETIREMENT"), -amount).otherwise(none),
        "reinstated": F.when(code == "REINSTATEMENT", amount).otherwise(none),
    }
    return rows.groupBy("asset_id", "cip_only", "quarters").agg(*(F.sum(v).alias(name) for name, v in kinds.items()))


def _cost_balances(scope: _Scope) -> DataFrame:
    """Book cost after the last transaction before the year, and after the last one in it.

    The last transaction is chosen over all books, so one that belongs to another book leaves no balance.
    """
    when = F.col("transaction_date_entered")
    last = last_before(
        scope.in_scope(scope.tables["fa_transaction_headers"]).filter(
            F.col("transaction_type_code").isin(*TRANSACTION_TYPES)
            & ((when < scope.calendar.start) | (when <= scope.calendar.end))
        ),
        "asset_id",
        ("transaction_date_entered", "transaction_header_id"),
        {"beginning": when < scope.calendar.start, "ending": when <= scope.calendar.end},
    ).select("asset_id", F.col("transaction_header_id").alias("transaction_header_id_in"), "cutoff")
    return _balances(
        scope.books.select("asset_id", "transaction_header_id_in", "life_in_years", "cost")
        .join(last, ["asset_id", "transaction_header_id_in"])
        .join(scope.assets.filter("weight > 0"), "asset_id"),
        zero_if_null(F.col("cost")) * F.col("weight").cast("decimal(20,0)"),
        "balance",
    )


def _balances(rows: DataFrame, amount: Column, suffix: str) -> DataFrame:
    none = F.lit(0).cast("decimal(18,2)")
    return rows.groupBy(*KEYS).agg(
        *(
            money(F.sum(F.when(F.col("cutoff") == cutoff, amount).otherwise(none))).alias(f"{cutoff}_{suffix}")
            for cutoff in ("beginning", "ending")
        )
    )


def _depreciation(scope: _Scope) -> DataFrame:
    """Depreciation of the year per asset and quarter of its period."""
    opened = F.col("period_open_date")
    return (
        scope.charges.filter(scope.calendar.in_year(opened))
        .groupBy("asset_id", scope.calendar.quarter_mask(opened).alias("quarters"))
        .agg(F.sum(-F.col("system")).alias("system_depreciation"), F.sum(-F.col("added")).alias("addition_depreciation"))
    )


def _retired_reserve(scope: _Scope) -> DataFrame:
    """Reserve released by processed retirements of the year, per asset and quarter."""
    keys = ["asset_id", "transaction_header_id"]
    retirements = (
        scope.tables["fa_retirements"]
        .filter((F.col("book_type_code") == scope.book) & (F.col("status") == "PROCESSED"))
        .select("asset_id", F.col("transaction_header_id_in").alias("transaction_header_id"))
    )
    reserves = (
        scope.tables["fa_adjustments"]
        .filter((F.col("source_type_code") == "RETIREMENT") & (F.col("adjustment_type") == "RESERVE"))
        .select(*keys, "adjustment_amount")
    )
    return (
        scope.year_headers
        .select(*keys, "quarters")
        .join(retirements, keys)
        .join(reserves, keys)
        .groupBy("asset_id", "quarters")
        .agg(F.sum("adjustment_amount").alias("retirement_depreciation"))
    )


def _movements(scope: _Scope) -> DataFrame:
    """All movements of the year by quarter.

    They are added up per asset before they meet the assets, so that a busy asset is one row per quarter by
    then, and they meet the assets together.
    """
    cost = ("addition", "adjustment", "retired", "reinstated")
    charge = ("system_depreciation", "addition_depreciation")
    release = ("retirement_depreciation",)
    measures = (*cost, *charge, *release)

    moved = zero_pad_union(
        [
            _transactions(scope).withColumn("released", F.lit(False)),
            _depreciation(scope).withColumns({"cip_only": F.lit(False), "released": F.lit(False)}),
            _retired_reserve(scope).withColumns({"cip_only": F.lit(False), "released": F.lit(True)}),
        ],
        ("asset_id", "cip_only", "released", "quarters"),
        measures,
    )
    sums = [s for m in measures for s in quarter_sums(f"{m} * times", m)]
    grouped = (
        moved.join(scope.weighted_assets(), "asset_id")
        .withColumn("times", F.expr("if(released, retirement_weight, weight)"))
        .filter("times > 0 and (not cip_only or asset_type = 'CIP')")
        .groupBy(*KEYS)
        .agg(*sums)
    )
    return grouped.selectExpr(
        *KEYS,
        *_quarterly("system_depreciation", "addition_depreciation", "retirement_depreciation"),
        *(
            column
            for q in QUARTERS
            for column in (
                f"q{q}_addition as q{q}_additions",
                f"q{q}_adjustment as q{q}_adjustments",
                # NULL on either side makes the sum NULL, as in the report.
                f"q{q}_retired + q{q}_reinstated as q{q}_retirements",
            )
        ),
    )


def _reserve_balances(scope: _Scope) -> DataFrame:
    """Depreciation reserve in the last period before the year, and in the last one of it.

    Every life that the asset ever had in the book counts once.
    """
    opened = F.col("period_open_date")
    reserves = scope.charges.select("asset_id", "period_open_date", "deprn_reserve")
    last = last_before(
        reserves,
        "asset_id",
        ("period_open_date",),
        {"beginning": opened < scope.calendar.start, "ending": opened <= scope.calendar.end},
    )
    lives = scope.books.select("asset_id", "life_in_months", "life_in_years").distinct()
    rows = (
        reserves.join(last, ["asset_id", "period_open_date"])
        .join(lives, "asset_id")
        .join(scope.assets.filter("weight > 0"), "asset_id")
        .select("asset_number", *KEYS, "life_in_months", "cutoff", "period_open_date", "deprn_reserve")
        .distinct()
    )
    return _balances(rows, -F.col("deprn_reserve"), "depreciation")


def asset_rollforward(
    tables: TableSet,
    *,
    year: str,
    book: str | None,
    asset_number: str | None = None,
    company: str | None = None,
    major: str | None = None,
    life_years: Decimal | float | str | None = None,
    retirement_company_category: str = RETIREMENT_COMPANY_CATEGORY,
) -> DataFrame:
    """Cost and depreciation roll-forward per major category and life, for one fiscal year of one book.

    Without a calendar for the book there are no rows.
    """
    calendar = Calendar.read(tables, year, book)
    known = calendar is not None
    calendar = calendar or Calendar(None, None, None, None, None, None)
    scope = _Scope(
        tables, calendar, book or "", asset_number, company, major, life_years, retirement_company_category
    )
    branches = [_movements(scope), _cost_balances(scope), _reserve_balances(scope)]
    totals = zero_pad_union(branches, KEYS, MEASURES).groupBy(*KEYS).agg(*(F.sum(m).alias(m) for m in MEASURES))
    if not known:
        totals = totals.filter(F.lit(False))

    def stated(*names: str) -> list[str]:
        return [f"cast({name} as {MONEY}) as {name}" for name in names]

    def total(quarter: int, name: str, *parts: str) -> str:
        return f"cast({' + '.join(f'q{quarter}_{part}' for part in parts)} as {MONEY}) as {name}"

    return totals.selectExpr(
        *KEYS,
        *stated("beginning_balance", "ending_balance"),
        *(
            column
            for q in QUARTERS
            for column in (
                total(q, f"q{q}", "additions", "adjustments", "retirements"),
                *stated(f"q{q}_additions", f"q{q}_retirements", f"q{q}_adjustments"),
            )
        ),
        *stated("beginning_depreciation", "ending_depreciation"),
        *(
            total(q, f"q{q}_depreciation", "system_depreciation", "addition_depreciation", "retirement_depreciation")
            for q in QUARTERS
        ),
        *stated(*_quarterly("addition_depreciation"), *_quarterly("retirement_depreciation")),
    ).orderBy(*(F.col(k).asc_nulls_last() for k in KEYS))
