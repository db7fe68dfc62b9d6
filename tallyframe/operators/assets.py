"""Asset-register building blocks shared by the property-tax, roll-forward and net-book-value reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.predicates import one_of_or_all
from tallyframe.functions.values import MONEY
from tallyframe.operators.combine import left_join_spreading_nulls
from tallyframe.sources.registry import TableSet

COMPONENTS = ("additions", "transfers", "clearings", "retirements")


def book_states(tables: TableSet, book: str | None) -> DataFrame:
    """Distinct (asset, is_open, book) of the book rows; closed history shrinks to one marker row per asset."""
    books = tables["fa_books"]
    if book is not None:
        books = books.filter(F.col("book_type_code") == book)
    is_open = F.col("date_ineffective").isNull()
    return books.select(
        "asset_id", is_open.alias("is_open"), F.when(is_open, F.col("book_type_code")).alias("asset_book")
    ).distinct()


def current_books(tables: TableSet, book: str | None, keep_bookless: bool) -> DataFrame:
    """Distinct (asset, book) pairs of open book rows.

    With ``keep_bookless`` an asset that never had a book row keeps a NULL book, as an outer join filtered on
    "not closed" would; an asset with closed rows only is dropped either way.
    """
    if book is not None or not keep_bookless:
        return book_states(tables, book).filter("is_open").select("asset_id", "asset_book")
    return (
        tables["fa_additions_b"]
        .select("asset_id")
        .distinct()
        .join(book_states(tables, None), "asset_id", "left")
        .filter("is_open is null or is_open")
        .select("asset_id", "asset_book")
    )


def asset_lines(tables: TableSet, register: DataFrame, line: Sequence[str], book: str | None, keep_bookless: bool) -> DataFrame:
    """Distinct (asset, ``line`` columns, ``shared``) of the assets in ``register`` that have an open book row.

    ``register`` has rows of the asset register with asset_id, asset_number, asset_type and whatever else ``line`` names;
    ``shared`` tells whether another asset, in scope or not, has the number and type.  A report writes this scope once,
    and its transactions, places and charges are limited to it before they are joined or added up.
    """
    number, kind = F.col("asset_number"), F.col("asset_type")
    repeated = (
        tables["fa_additions_b"]
        .groupBy("asset_number", "asset_type")
        .agg(F.min("asset_id").alias("first"), F.max("asset_id").alias("last"))
        .filter("first <> last")
        .select(number.alias("n"), kind.alias("t"), F.lit(True).alias("repeated"))
    )
    flagged = register.join(repeated, number.eqNullSafe(F.col("n")) & kind.eqNullSafe(F.col("t")), "left")
    flagged = flagged.withColumn("shared", F.col("repeated").isNotNull())
    states = book_states(tables, book)
    if book is not None or not keep_bookless:
        placed = flagged.join(states.filter("is_open").select("asset_id", "asset_book"), "asset_id")
    else:
        placed = flagged.join(states, "asset_id", "left").filter("is_open is null or is_open")
    return placed.select("asset_id", *line, "shared").distinct()


def owners(lines: DataFrame, line: Sequence[str]) -> DataFrame:
    """For whom the amounts of each asset are added up: ``own``, the asset, or its ``line`` where it shares a number.

    Rows may repeat; :func:`distinct_sums_by_line` does not mind.
    """
    shared = F.col("shared")
    return lines.select(
        "asset_id", F.when(~shared, F.col("asset_id")).alias("own"), *(F.when(shared, F.col(c)).alias(c) for c in line)
    )


def distinct_sums_by_line(
    amounts: DataFrame, lines: DataFrame, line: Sequence[str], extra: Sequence[str], sums: Sequence[Column]
) -> DataFrame:
    """Sums over distinct (component, value) pairs per report line and ``extra`` columns.

    ``amounts`` has the columns of :func:`owners` but the asset, ``extra``, component and value; ``lines`` maps assets to
    ``line`` columns and says whether their number is ``shared``.  A line is one asset unless assets share a number, so
    amounts are made distinct and added up per asset first, under narrow keys, and meet the lines as totals.  Only assets
    that share a number have line columns beforehand, so that equal amounts of theirs still count once.
    """
    alone = lines.filter("not shared").select(
        F.col("asset_id").alias("own"), F.lit(True).alias("known"), *(F.col(c).alias(f"own_{c}") for c in line)
    )
    totals = amounts.select("own", *line, *extra, "component", "value").distinct().groupBy("own", *line, *extra).agg(*sums)
    by_line = (F.when(F.col("own").isNull(), F.col(c)).otherwise(F.col(f"own_{c}")).alias(c) for c in line)
    kept = [c for c in totals.columns if c != "own" and c not in line]
    # Totals of shared numbers have their line and no asset: they spread by their content.
    placed = left_join_spreading_nulls(totals, alone, ["own"])
    return placed.filter("own is null or known").select(*by_line, *kept)


def distribution_stores(
    tables: TableSet, locations: Sequence[str] | None, category: str | None = None
) -> DataFrame:
    """(asset, distribution, store number, store name) of every distribution, past ones included.

    A distribution without a known store keeps NULLs.  A code that several value categories share gives one
    row per name unless ``category`` picks one.
    """
    stores = tables["fnd_flex_values_vl"]
    if category is not None:
        stores = stores.filter(F.col("value_category") == category)
    stores = stores.select(
        F.col("flex_value").alias("segment2"),
        F.col("flex_value").alias("store_number"),
        F.col("description").alias("store_location"),
    )
    # Accounts meet the stores first, so the long side is dealt by account once and never by store.
    accounts = tables["gl_code_combinations"].select("code_combination_id", "segment2").join(stores, "segment2", "left")
    placed = left_join_spreading_nulls(
        tables["fa_distribution_history"].select("asset_id", "distribution_id", "code_combination_id"),
        accounts.drop("segment2"),
        ["code_combination_id"],
    )
    return (
        one_of_or_all(placed, "store_number", locations)
        .select("asset_id", "distribution_id", "store_number", "store_location")
        .distinct()
    )


def cost_component() -> Column:
    """Number (see :data:`COMPONENTS`) of the cost movement that an adjustment row carries, NULL for none."""
    kind, source = F.col("adjustment_type"), F.col("source_type_code")
    direction, side = F.col("source_dest_code"), F.col("debit_credit_flag")
    is_adjustment = source.isin("ADJUSTMENT", "CIP ADJUSTMENT")
    has_side = side.isin("CR", "DR")
    rules = {
        "additions": source.isin("ADDITION", "CIP ADDITION") & (side == "CR"),
        "transfers": is_adjustment & kind.isin("COST", "CIP COST") & direction.isin("DEST", "SOURCE"),
        "clearings": is_adjustment & (kind == "COST CLEARING") & direction.isNull() & has_side,
        "retirements": (source == "RETIREMENT") & (kind == "NBV RETIRED") & has_side,
    }
    number = F.lit(None).cast("int")
    for name in reversed(COMPONENTS):
        number = F.when(rules[name], F.lit(COMPONENTS.index(name))).otherwise(number)
    return number


def adjustment_components(tables: TableSet, headers: DataFrame) -> DataFrame:
    """Cost movements per (asset, distribution, header), for the transactions in ``headers``.

    ``headers`` has distinct rows of asset_id, transaction_header_id and transaction_date.  The result has one row per non-zero
    ``component`` with its ``value``; sums of distinct values are unchanged by zeros, so that is all they need.
    One scan of the adjustments serves all components, and the join and the grouping share their partitioning
    by (asset, header).
    """
    component, amount = F.col("component"), F.col("adjustment_amount")
    negative = ((component == COMPONENTS.index("transfers")) & (F.col("source_dest_code") == "SOURCE")) | (
        (component > COMPONENTS.index("transfers")) & (F.col("debit_credit_flag") == "DR")
    )
    moves = (
        tables["fa_adjustments"]
        .withColumn("component", cost_component())
        .filter("component is not null")
        .select(
            "asset_id",
            "transaction_header_id",
            "distribution_id",
            "component",
            F.when(negative, -amount).otherwise(amount).alias("value"),
        )
    )
    return (
        moves.join(headers, ["asset_id", "transaction_header_id"])
        .groupBy("asset_id", "transaction_header_id", "transaction_date", "distribution_id", "component")
        .agg(F.sum("value").cast(MONEY).alias("value"))
        .filter("value <> 0")
    )


def headers_where(tables: TableSet, condition: Column, scope: DataFrame | None = None) -> DataFrame:
    """Distinct transactions by date condition (written on ``transaction_date_entered``), of the assets in ``scope``.

    They are made distinct behind the shuffle that limits them to the scope.
    """
    headers = (
        tables["fa_transaction_headers"]
        .filter(condition)
        .select("asset_id", "transaction_header_id", F.col("transaction_date_entered").alias("transaction_date"))
    )
    return (headers if scope is None else headers.join(scope, "asset_id", "left_semi")).distinct()
