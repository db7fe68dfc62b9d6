"""Net book value by store: variation per period, and the value at the start of the range."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.predicates import moment, within
from tallyframe.functions.values import MONEY, money, prefix_before, zero_if_null
from tallyframe.operators.assets import (
    COMPONENTS,
    adjustment_components,
    asset_lines,
    distinct_sums_by_line,
    distribution_stores,
    headers_where,
    owners,
)
from tallyframe.operators.combine import left_join_spreading_nulls
from tallyframe.sources.registry import TableSet
from tallyframe.sources.scratch import stored

STORE = ("store_number", "store_location")
ASSET = ("asset_book", "asset_number", "asset_type")


def _scope(tables: TableSet, book: str | None, keep_bookless: bool) -> DataFrame:
    """Assets in scope with the lines they print as."""
    return asset_lines(tables, tables["fa_additions_b"], ASSET, book, keep_bookless)


def _with_stores(lines: DataFrame, stores: DataFrame, locations: Sequence[str] | None) -> DataFrame:
    """Lines with each distinct store of their asset.

    Without a location list an asset that has no distribution keeps a NULL store.
    """
    how = "inner" if locations and None not in locations else "left"
    return lines.join(stores.select("asset_id", *STORE).distinct(), "asset_id", how)


def _by_period_name(tables: TableSet, totals: DataFrame, total: str) -> DataFrame:
    """Totals per line, store and period counter under the names of the counter, over all books."""
    names = tables["fa_deprn_periods"].select("period_counter", "period_name").distinct()
    named = left_join_spreading_nulls(totals, names, ["period_counter"])
    return named.groupBy(*ASSET, *STORE, "period_name").agg(money(F.sum(total)).alias(total))


def _cost_variation(
    tables: TableSet, lines: DataFrame, stores: DataFrame, from_date: datetime | None, to_date: datetime | None
) -> DataFrame:
    """Cost moved per line, store and period.

    Only rows that can meet a depreciation row are built: with a book, a named store, a named period and an
    amount.  A transaction shows its full amount in every period that it adjusted.  Values are distinct within a
    transaction date and period counter; per asset they are added up first.
    """
    lines = lines.filter("asset_book is not null")
    headers = headers_where(tables, within(F.col("transaction_date_entered"), from_date, to_date), lines)
    adjusted = (
        tables["fa_adjustments"]
        .filter(F.col("period_counter_adjusted").isNotNull())
        .select(
            "transaction_header_id", "distribution_id", F.col("period_counter_adjusted").alias("period_counter")
        )
        .join(headers.select("transaction_header_id"), "transaction_header_id", "left_semi")
        .distinct()
    )
    named = stores.filter(F.col("store_number").isNotNull() & F.col("store_location").isNotNull())
    named = named.join(owners(lines, ASSET), "asset_id").distinct()
    amounts = (
        adjustment_components(tables, headers)
        .join(adjusted, ["transaction_header_id", "distribution_id"])
        .join(named, ["asset_id", "distribution_id"])
        .withColumn("component", F.struct("transaction_date", "component"))
    )
    moved = money(F.sum("value")).alias("cost_variation")
    totals = distinct_sums_by_line(amounts, lines, ASSET, (*STORE, "period_counter"), [moved])
    return _by_period_name(tables, totals, "cost_variation").filter("period_name is not null")


def _depreciation_variation(
    tables: TableSet, places: DataFrame, from_date: datetime | None, to_date: datetime | None
) -> DataFrame:
    """Depreciation per line, store and period; repeated (period, amount) rows count once.

    Amounts are added up per asset and period before they meet the stores of the asset.
    """
    amounts = (
        tables["fa_deprn_summary"]
        .filter(within(F.col("deprn_run_date"), from_date, to_date))
        .select("asset_id", "period_counter", F.lit(None).cast("int").alias("component"), F.col("deprn_amount").alias("value"))
        .join(owners(places, (*ASSET, *STORE)).distinct(), "asset_id")
    )
    charged = money(F.sum("value")).alias("dprn_variation")
    totals = distinct_sums_by_line(amounts, places, (*ASSET, *STORE), ("period_counter",), [charged])
    return _by_period_name(tables, totals, "dprn_variation")


def nbv_detail(
    tables: TableSet,
    *,
    book: str | None = None,
    locations: Sequence[str] | None = None,
    from_date: datetime | None,
    to_date: datetime | None,
) -> DataFrame:
    """Cost and depreciation variation per book, store and period.

    Depreciation leads: a period with cost but no depreciation does not show.  Assets with equal variations
    in one store and period count once.
    """
    lines = stored(_scope(tables, book, keep_bookless=True), "scope")
    stores = stored(distribution_stores(tables, locations).join(lines, "asset_id", "left_semi"), "stores")
    places = stored(_with_stores(lines, stores, locations), "places")
    charged = _depreciation_variation(tables, places, from_date, to_date)
    moved = _cost_variation(tables, lines, stores, from_date, to_date)
    keys = ("asset_book", *STORE, "period_month", "period_name")
    return (
        charged.join(moved, [*ASSET, *STORE, "period_name"], "left")
        .withColumn("period_month", prefix_before(F.col("period_name"), "-"))
        .groupBy(*keys)
        .agg(
            money(F.sum_distinct(zero_if_null(F.col("cost_variation")))).alias("cost_variation"),
            money(F.sum_distinct(zero_if_null(F.col("dprn_variation")))).alias("dprn_variation"),
        )
        .orderBy(*(F.col(c).asc_nulls_last() for c in ("asset_book", *STORE, "period_name")))
    )


def _opening_reserves(tables: TableSet, assets: DataFrame, from_date: datetime | None) -> DataFrame:
    """Reserve and impairment of each of ``assets`` at its last period up to ``from_date``.

    The last period is sought over every source, and only ``DEPRN`` rows of it are added up, over all books, whenever
    they ran.  One read: sums per period with whether it counts as reached, then the highest reached one.
    """
    charge = F.col("deprn_source_code") == "DEPRN"
    sums = [zero_if_null(F.sum(F.when(charge, F.col(c)))).cast(MONEY).alias(c) for c in ("deprn_reserve", "impairment_reserve")]
    reached = F.max(F.col("deprn_run_date") <= moment(from_date)).alias("reached")
    periods = (
        tables["fa_deprn_summary"]
        .filter(F.col("period_counter").isNotNull())
        .join(assets, "asset_id", "left_semi")
        .groupBy("asset_id", "period_counter")
        .agg(reached, *sums)
        .filter("reached")
    )
    last = F.max(F.struct("period_counter", "deprn_reserve", "impairment_reserve")).alias("last")
    return periods.groupBy("asset_id").agg(last).select("asset_id", "last.deprn_reserve", "last.impairment_reserve")


def nbv_summary(
    tables: TableSet,
    *,
    book: str | None = None,
    locations: Sequence[str] | None = None,
    from_date: datetime | None,
    to_date: datetime | None,
) -> DataFrame:
    """Net book value per book and store at ``from_date``, for assets depreciated within the range.

    The report repeats an asset's figures for every depreciation row and then drops equal rows.  The figures
    depend on the row only where several assets share a number, so only those keep the row's identity.  Which assets
    were charged is known first, and only theirs are the places, transactions and reserves that are read on.
    """
    charged = (
        tables["fa_deprn_summary"]
        .filter((F.col("deprn_source_code") == "DEPRN") & within(F.col("deprn_run_date"), from_date, to_date))
        .select(
            "asset_id",
            F.struct("period_counter", "deprn_reserve", "adjusted_cost", "impairment_reserve").alias("row"),
        )
    )
    # One line per book and asset, or per depreciation row where the number is shared.
    lines = stored(
        _scope(tables, book, keep_bookless=False)
        .join(charged, "asset_id")
        .select("asset_id", "shared", *ASSET, F.when(F.col("shared"), F.col("row")).alias("row"))
        .distinct(),
        "scope",
    )
    assets = lines.select("asset_id").distinct()
    stores = stored(distribution_stores(tables, locations).join(lines, "asset_id", "left_semi"), "stores")

    # An asset's amounts: cost by store; its reserves, and a bare row, in each of its stores.
    headers = headers_where(tables, F.col("transaction_date_entered") <= moment(from_date), lines)
    costs = (
        adjustment_components(tables, headers)
        .join(stores, ["asset_id", "distribution_id"])
        .select("asset_id", *STORE, "component", "value")
    )
    reserve = len(COMPONENTS)
    amount = F.array(
        F.struct(F.lit(None).cast("int").alias("component"), F.lit(None).cast(MONEY).alias("value")),
        F.struct(F.lit(reserve).alias("component"), (-F.col("deprn_reserve")).alias("value")),
        F.struct(F.lit(reserve + 1).alias("component"), (-F.col("impairment_reserve")).alias("value")),
    )
    held = (
        _with_stores(assets, stores, locations)
        .join(_opening_reserves(tables, lines, from_date), "asset_id", "left")
        .select("asset_id", *STORE, F.explode(amount).alias("a"))
        .select("asset_id", *STORE, "a.component", "a.value")
        .filter("component is null or value <> 0")
    )
    figure = F.col("component")
    sums = [
        money(F.coalesce(F.sum(F.when(test, F.col("value"))), F.lit(0))).alias(name)
        for name, test in {
            "additions": figure == 0,
            "adjustments": figure.isin(1, 2),
            "retirements": figure == 3,
            "reserve": figure == 4,
            "impairment": figure == 5,
        }.items()
    ]
    amounts = costs.unionByName(held).join(owners(lines, (*ASSET, "row")).distinct(), "asset_id")
    per_line = distinct_sums_by_line(amounts, lines, (*ASSET, "row"), STORE, sums)
    figures = [F.col(c) for c in ("additions", "adjustments", "retirements", "reserve", "impairment")]
    return (
        per_line.drop("row")
        .distinct()
        .groupBy("asset_book", *STORE)
        .agg(money(F.sum(figures[0] + figures[1] + figures[2] + figures[3] + figures[4])).alias("beginning_nvb"))
        .orderBy(*(F.col(c).asc_nulls_last() for c in ("asset_book", "store_number")))
    )
