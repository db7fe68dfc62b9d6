"""Joins and unions that keep exact multiplicity without paying for it row by row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.values import MONEY


def left_join_spreading_nulls(left: DataFrame, right: DataFrame, keys: Sequence[str], *more: DataFrame) -> DataFrame:
    """Left join on ``keys`` for a left side where many keys are NULL; ``more`` are joined on the same keys.

    Rows without a key match nothing, yet a shuffled join would send them all to one task.  They get a hash of
    their own content and of the partition they are read in as a further key, so that equal rows spread as well;
    rows with a key get zero.  All right sides meet the left one under the same dealing.
    """
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    spread = F.when(missing, F.xxhash64(*left.columns, F.spark_partition_id())).otherwise(F.lit(0).cast("bigint"))
    # Always zero, but computed from the key: a literal would be folded out of the join keys.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1).cast("bigint"))
    joined = left.withColumn("_spread", spread)
    for side in (right, *more):
        joined = joined.join(side.withColumn("_spread", zero), [*keys, "_spread"], "left")
    return joined.drop("_spread")


def row_weights(frame: DataFrame, keys: str | Sequence[str], weight: str, each: Column | None = None) -> DataFrame:
    """Rows per key, or the sum of ``each``: what a fan-out join would multiply by.

    Sums over such joins equal sums over ``amount * weight``, without emitting the repeated rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return frame.groupBy(*keys).agg(F.sum(F.lit(1).cast("bigint") if each is None else each).alias(weight))


def at_least_one(weight: str) -> Column:
    """Weight of a left join: an unmatched row still counts once."""
    return F.coalesce(F.col(weight), F.lit(1).cast("bigint"))


def zero_pad_union(frames: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Union of aggregates that each fill some of ``measures``; the others are zero, which sums ignore."""

    def padded(frame: DataFrame) -> DataFrame:
        filled = set(frame.columns)
        return frame.selectExpr(*keys, *(f"cast({m if m in filled else 0} as {MONEY}) as {m}" for m in measures))

    return reduce(DataFrame.unionByName, map(padded, frames))
