"""Business property tax: cost movement per asset and day, and its two summaries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.predicates import one_of, optional_eq, within
from tallyframe.functions.values import MONEY, date_text, money, zero_if_null
from tallyframe.operators.assets import (
    adjustment_components,
    asset_lines,
    distinct_sums_by_line,
    distribution_stores,
    headers_where,
    owners,
)
from tallyframe.sources.registry import TableSet
from tallyframe.sources.scratch import stored, stored_together

STORE_CATEGORY = "Location COA"

LINE = ("asset_book", "asset_number", "asset_type", "major_asset_category", "minor_asset_category")


def _movements(
    tables: TableSet,
    book: str | None,
    majors: Sequence[str] | None,
    minors: Sequence[str] | None,
    locations: Sequence[str] | None,
    from_date: datetime | None,
    to_date: datetime | None,
    asset_type: str | None,
    every_moment: bool,
) -> DataFrame:
    """Cost per book, asset, transaction moment, category and store.

    The report pairs every transaction of an asset with every distribution of it and adds up distinct sums.
    A pair without adjustments adds zero, so only the distinct (asset, moment) and (asset, store) pairs are
    combined to find the groups, while the amounts come from the adjustments alone.  The assets in scope, their
    transactions and their places are written once and read by both.

    Summaries do not need the moments at which nothing was booked: without ``every_moment`` one row of zero
    cost stands for all of an asset and store.
    """
    categories = (
        tables["fa_categories_b"]
        .filter(one_of(F.col("segment1"), majors) & one_of(F.col("segment2"), minors))
        .select(
            F.col("category_id").alias("asset_category_id"),
            F.col("segment1").alias("major_asset_category"),
            F.col("segment2").alias("minor_asset_category"),
        )
    )
    register = optional_eq(tables["fa_additions_b"], "asset_type", asset_type).join(categories, "asset_category_id")
    assets = stored(asset_lines(tables, register, LINE, book, keep_bookless=True), "scope")
    # Transactions and places of other assets stay out of everything that follows.
    in_range = within(F.col("transaction_date_entered"), from_date, to_date)
    stores = distribution_stores(tables, None, STORE_CATEGORY).filter(one_of(F.col("store_number"), locations))
    headers, stores = stored_together(
        stored,
        headers=headers_where(tables, in_range, assets),
        stores=stores.join(owners(assets, LINE), "asset_id").drop("store_number").distinct(),
    )

    when = F.col("transaction_date") if every_moment else F.lit(None).cast("timestamp_ntz")
    groups = (
        headers.select("asset_id", when.alias("moment"))
        .distinct()
        .join(stores.drop("distribution_id").distinct(), "asset_id")
        .withColumns({"component": F.lit(None).cast("int"), "value": F.lit(None).cast(MONEY)})
    )
    amounts = (
        adjustment_components(tables, headers)
        .withColumnRenamed("transaction_date", "moment")
        .join(stores, ["asset_id", "distribution_id"])
        .select(*groups.columns)
    )
    cost = money(zero_if_null(F.sum("value"))).alias("cost")
    return distinct_sums_by_line(
        groups.unionByName(amounts), assets, LINE, ("moment", "store_location"), [cost]
    )


def property_tax_detail(
    tables: TableSet,
    *,
    book: str | None = None,
    majors: Sequence[str] | None,
    minors: Sequence[str] | None,
    locations: Sequence[str] | None,
    from_date: datetime | None,
    to_date: datetime | None,
    asset_type: str | None = None,
) -> DataFrame:
    """Cost movement per asset, transaction and store; the three lists have no "all" and must be given."""
    rows = _movements(tables, book, majors, minors, locations, from_date, to_date, asset_type, every_moment=True)
    report = rows.select(
        "asset_book",
        "asset_number",
        "asset_type",
        date_text(F.col("moment")).alias("transaction_date"),
        "major_asset_category",
        "minor_asset_category",
        "store_location",
        "cost",
    )
    # Sorted by the date's text, month first.
    order = (
        "asset_book",
        "asset_type",
        "major_asset_category",
        "minor_asset_category",
        "asset_number",
        "transaction_date",
        "store_location",
    )
    return report.orderBy(*(F.col(c).asc_nulls_last() for c in order))


def _summary(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equal costs within ``keys`` count once."""
    return (
        rows.select(*keys, "cost")
        .distinct()
        .groupBy(*keys)
        .agg(F.sum("cost").cast(MONEY).alias("total_cost"))
        .orderBy(*(F.col(c).asc_nulls_last() for c in keys))
    )


def property_tax_by_location(
    tables: TableSet,
    *,
    book: str | None = None,
    majors: Sequence[str] | None,
    minors: Sequence[str] | None,
    locations: Sequence[str] | None,
    from_date: datetime | None,
    to_date: datetime | None,
    asset_type: str | None = None,
) -> DataFrame:
    """Cost per category and store; each distinct cost of a bucket counts once."""
    rows = _movements(tables, book, majors, minors, locations, from_date, to_date, asset_type, every_moment=False)
    return _summary(rows, ("major_asset_category", "minor_asset_category", "store_location"))


def property_tax_summary(
    tables: TableSet,
    *,
    book: str | None = None,
    majors: Sequence[str] | None,
    minors: Sequence[str] | None,
    locations: Sequence[str] | None,
    from_date: datetime | None,
    to_date: datetime | None,
    asset_type: str | None = None,
) -> DataFrame:
    """Cost per category; equal costs collapse across stores too, so this is not the sum of the store report."""
    rows = _movements(tables, book, majors, minors, locations, from_date, to_date, asset_type, every_moment=False)
    return _summary(rows, ("major_asset_category", "minor_asset_category"))
