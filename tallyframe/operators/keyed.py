"""Choosing one row, or the latest rows, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def current_rows(frame: DataFrame) -> DataFrame:
    """Rows that no later version has replaced."""
    return frame.filter(F.col("date_ineffective").isNull())


def latest_rows(frame: DataFrame, key: str, version: str) -> DataFrame:
    """All rows whose ``version`` is the highest of their ``key``, ties included.

    Written as rank = 1, which Spark prunes per task before the shuffle: a key that holds a large share of
    the rows still sends only its local best.
    """
    order = Window.partitionBy(key).orderBy(F.col(version).desc())
    return (
        frame.filter(F.col(key).isNotNull() & F.col(version).isNotNull())
        .withColumn("_rank", F.rank().over(order))
        .filter("_rank = 1")
        .drop("_rank")
    )


def last_before(
    frame: DataFrame, key: str | Sequence[str], order: Sequence[str], cutoffs: dict[str, Column]
) -> DataFrame:
    """As-of pick: per key and cutoff, the highest ``order`` columns among rows that meet the cutoff.

    All cutoffs share one scan and one map-side combined aggregation.  The result has one row per
    (key, cutoff name) with the picked columns; keys without a qualifying row are absent.
    """
    keys = [key] if isinstance(key, str) else list(key)
    best = F.struct(*(F.col(c) for c in order))
    picked = frame.groupBy(*keys).agg(*(F.max(F.when(test, best)).alias(name) for name, test in cutoffs.items()))
    per_cutoff = F.array(
        *(F.struct(F.lit(name).alias("cutoff"), F.col(name).alias("best")) for name in cutoffs)
    )
    return (
        picked.select(*keys, F.explode(per_cutoff).alias("p"))
        .filter(F.col("p.best").isNotNull())
        .select(*keys, "p.cutoff", *(F.col(f"p.best.{c}").alias(c) for c in order))
    )


def pick_first(frame: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the lowest by ``order``, NULLs first.  Stands in for an arbitrary pick.

    ``order`` names the columns kept, so equal picks are equal rows and the choice is deterministic.
    """
    best = F.min(F.struct(*(F.col(c) for c in order)))
    return frame.groupBy(key).agg(best.alias("_best")).select(key, *(F.col(f"_best.{c}").alias(c) for c in order))
