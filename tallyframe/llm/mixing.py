"""Mixing sources to target weights by balanced sampling (cube method).

Every document of a source has the same expected number of copies, target / size of the source.  Its whole part is
taken outright; the fraction is an inclusion probability.  Probabilities move along directions that leave the
source's expected words and documents unchanged until they are 0 or 1 (flight); what cannot move any more, and a few
documents kept back for it, is rounded to the words' nearest total (landing).

Flights run in groups of about :data:`GROUP` documents of one source, so a large source is many tasks.  The longest
documents of a group are decided first, balanced by all others together; left to the end they would outweigh what the
others can balance.  Each group leaves at most two undecided documents; these meet in groups of the next level, until one
group per source is left, whose landing rounds at most a dozen documents and exchanges a few others until the words are
as near as they come.  Groups, orders and random numbers depend on the rows alone, so reruns agree.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm import text as words
from tallyframe.llm.store import written

GROUP = 4096
#: Documents of a group that are decided before the others, by length.
LONGEST = 64
#: Documents of a last group that wait for the landing, beside the two that a flight may leave.
SPARE = 10
_TINY = 1e-9


def flight(chance: np.ndarray, size: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Move ``chance`` to 0 or 1 with the sums of ``chance`` and ``chance * size`` kept; at most two stay between."""
    p, x = _longest_decided(chance, size, random).tolist(), size.tolist()
    draws = iter(random.random(len(p) + 1).tolist())
    active: list[int] = []
    for k in range(len(p)):
        if not _TINY < p[k] < 1 - _TINY:
            p[k] = float(round(p[k]))
            continue
        active.append(k)
        while len(active) > 1:
            a, b = active[0], active[1]
            if len(active) == 2:
                if x[a] != x[b]:
                    break
                units, move = (a, b), (1.0, -1.0)
            else:
                c = active[2]
                units, move = (a, b, c), (x[b] - x[c], x[c] - x[a], x[a] - x[b])
                if not any(move):
                    move = (1.0, -1.0, 0.0)
            up = min((1 - p[u]) / m if m > 0 else p[u] / -m for u, m in zip(units, move) if m)
            down = min(p[u] / m if m > 0 else (1 - p[u]) / -m for u, m in zip(units, move) if m)
            step = up if next(draws, 0.5) * (up + down) < down else -down
            for u, m in zip(units, move):
                p[u] += step * m
            still = []
            for u in active:
                if _TINY < p[u] < 1 - _TINY:
                    still.append(u)
                else:
                    p[u] = float(round(p[u]))
            if len(still) == len(active):  # rounding left the unit that should have been decided just inside
                u = min(still, key=lambda u: min(p[u], 1 - p[u]))
                p[u] = float(round(p[u]))
                still.remove(u)
            active = still
    return np.array(p)


def _longest_decided(chance: np.ndarray, size: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """``chance`` after moves that decide the longest documents, as far as the others can balance them.

    A move follows the projection of one document's axis onto the directions that keep both sums.
    """
    p = chance.astype(float).copy()
    inside = np.flatnonzero((p > _TINY) & (p < 1 - _TINY))
    for unit in inside[np.argsort(-size[inside], kind="stable")][:LONGEST]:
        while len(inside) > 3 and _TINY < p[unit] < 1 - _TINY:
            at = int(np.searchsorted(inside, unit))
            apart = size[inside] - size[inside].mean()
            spread = apart @ apart
            move = np.full(len(inside), -1 / len(inside))
            if spread > 0:
                move -= apart * (apart[at] / spread)
            move[at] += 1
            if move[at] < 1e-6:
                break
            rise, room = move > 0, p[inside]
            with np.errstate(divide="ignore"):
                up = np.where(rise, (1 - room) / move, np.where(move < 0, room / -move, np.inf))
                down = np.where(rise, room / move, np.where(move < 0, (1 - room) / -move, np.inf))
            up, first_up, down, first_down = up.min(), up.argmin(), down.min(), down.argmin()
            rises = random.random() * (up + down) < down
            p[inside] += (up if rises else -down) * move
            hit = inside[first_up if rises else first_down]
            p[hit] = round(p[hit])
            inside = inside[(p[inside] > _TINY) & (p[inside] < 1 - _TINY)]
    out = np.abs(p - np.round(p)) <= _TINY
    p[out] = np.round(p[out])
    return p


def exchanged(taken: np.ndarray, size: np.ndarray, free: np.ndarray, total: float) -> np.ndarray:
    """``taken`` after changes of single ``free`` documents, or exchanges of two, that bring the words nearer to ``total``."""
    out = taken.copy()
    for _ in range(LONGEST):
        off = float(out @ size - total)
        ins, outs = np.flatnonzero(free & (out == 0)), np.flatnonzero(free & (out == 1))
        best, chosen = abs(off) - 1e-6, ()
        for units, sign in ((ins, 1), (outs, -1)):
            if len(units):
                change = np.abs(off + sign * size[units])
                if change.min() < best:
                    best, chosen = float(change.min()), (units[change.argmin()],)
        if len(ins) and len(outs):
            # For each document that may go, the two whose sizes are next to what should come.
            order = ins[np.argsort(size[ins], kind="stable")]
            place = np.searchsorted(size[order], size[outs] - off)
            for shift in (0, 1):
                other = order[np.clip(place - shift, 0, len(order) - 1)]
                change = np.abs(off + size[other] - size[outs])
                if change.min() < best:
                    best, chosen = float(change.min()), (other[change.argmin()], outs[change.argmin()])
        if not chosen:
            return out
        out[list(chosen)] = 1 - out[list(chosen)]
    return out


def landing(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the few undecided so that the words, then the documents, come nearest to their expectation."""
    out = chance.copy()
    left = np.flatnonzero((chance > 0) & (chance < 1))
    takes = (np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1).astype(float)
    words_off = np.abs(takes @ size[left] - chance[left] @ size[left])
    documents_off = np.abs(takes.sum(axis=1) - chance[left].sum())
    out[left] = takes[np.lexsort((documents_off, np.round(words_off, 6)))[0]]
    return out


def settled(chance: np.ndarray, size: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Flight and landing of a last group: a few documents of spread sizes stay out of the flight, so that the landing
    has small change to round with; what it leaves is exchanged away."""
    left = np.flatnonzero((chance > _TINY) & (chance < 1 - _TINY))
    by_size = left[np.argsort(size[left], kind="stable")]
    spare = by_size[np.unique(np.linspace(0, 0.8 * (len(left) - 1), SPARE).astype(int))] if len(left) > SPARE + 2 else left
    rest = np.setdiff1d(np.arange(len(chance)), spare)
    out = chance.copy()
    out[rest] = flight(chance[rest], size[rest], random)
    free = (chance > _TINY) & (chance < 1 - _TINY)
    return exchanged(landing(out, size), size, free, float(chance @ size))


def sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """Per row: id, source, words of the whole text (null: 0), and a mark of the text that tells repeated ids apart."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.xxhash64(F.col(f"`{text}`")).alias("mark"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    schema = rows.select("id", "source", "mark").schema.add("size", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.column_bytes(batch.column(3))
            counts = [np.zeros(0, np.int64)]
            for a, b in words.row_groups(offsets):
                part = offsets[a : b + 1]
                _, _, first = words.word_spans(data[part[0] : part[-1]], part - part[0])
                counts.append(np.diff(first))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.concatenate(counts), pa.int64())], names=["id", "source", "mark", "size"]
            )

    return rows.mapInArrow(run, schema)


def targets(measured: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Per source: its words, its documents and its target.

    Sources in code point order, null last, get ``weights`` in turn and share ``share`` times all words by them.  No
    target exceeds ``cap`` times its source's words; the excess is shared again by weight.  The windows see one row
    for each source.
    """
    rows = measured.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    rows = rows.withColumn("weight", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1))
    # In order of the level at which a source is full, the level is set by the first source that stays below it.
    full = F.lit(float(cap)) * F.col("source_size")
    by_level = Window.orderBy(full / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    later = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(earlier), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(later))
    rows = rows.withColumn("level", F.when(F.col("level") * F.col("weight") <= full, F.col("level")))
    rows = rows.withColumn("level", F.first("level", ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(full, F.coalesce(F.col("level") * F.col("weight"), full))
    return rows.select("source", "source_size", "documents", target.alias("target"))


def copies(
    docs: DataFrame,
    weights: Sequence[float],
    share: float,
    cap: float,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
    group: int = GROUP,
) -> DataFrame:
    """How often each row of ``docs`` is taken: id, source, mark, size, source_size, target, copies, taken.

    Null text has size 0; null is a source of its own; a source without words has target 0 and takes nothing.
    Repeated rows are separate documents; they are counted before they are dealt into groups, which go by id, text and
    number, so that rows without an id, or with one, spread.  An empty table gives an empty result.
    """
    measured = sizes(docs, doc_id, text, source).groupBy("id", "source", "mark", "size").agg(F.count(F.lit(1)).alias("times"))
    measured = measured.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).drop("times")
    measured = written(measured, "mixing-sizes")
    goals = targets(measured, weights, share, cap)
    goals = written(goals, "mixing-targets")
    most = goals.agg(F.max("documents")).first()[0] or 0
    goals = goals.withColumnRenamed("source", "goal_source")
    rows = measured.join(goals, F.col("source").eqNullSafe(F.col("goal_source")), "left").drop("goal_source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("whole", F.floor(expected + _TINY)).withColumn("chance", F.greatest(expected - F.col("whole"), F.lit(0.0)))
    rows = rows.withColumn("groups", F.ceil(F.col("documents") / group)).drop("documents")

    def settle(level: int):
        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(["order", "mark", "turn"], kind="stable").reset_index(drop=True)
            name = part["source"].iloc[0]
            key = f"{seed}|{level}|{part['bucket'].iloc[0]}|{'' if name is None else 's' + name}"
            random = np.random.default_rng(zlib.crc32(key.encode("utf-8", "surrogatepass")))
            size = part["size"].to_numpy(float)
            decide = settled if part["groups"].iloc[0] <= 1 else flight
            part["chance"] = decide(part["chance"].to_numpy(float), size, random)
            return part.drop(columns=["order", "bucket"])

        return run

    kept, level = [], 0
    while True:
        order = F.xxhash64(F.lit(seed), F.lit(level), "id", "mark", "turn")
        dealt = rows.withColumn("order", order).withColumn("bucket", F.pmod(F.shiftrightunsigned("order", 16), F.greatest("groups", F.lit(1))))
        done = written(dealt.groupBy("source", "bucket").applyInPandas(settle(level), rows.schema), f"mixing-level-{level}")
        undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
        kept.append(done.where(~undecided))
        most = math.ceil(most / group)
        if most <= 1:
            break
        rows = done.where(undecided).withColumn("groups", F.ceil(2 * F.col("groups") / group))
        most, level = 2 * most, level + 1
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    taken = (F.col("whole") + F.col("chance").cast("bigint")).alias("copies")
    out = out.select("id", "source", "mark", "size", "source_size", "target", taken)
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame, weights: Sequence[float], share: float, cap: float, doc_id: str = "doc_id", text: str = "text", source: str = "source", **more) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as :func:`copies` says, with the same columns."""
    decided = copies(docs, weights, share, cap, doc_id, text, source, **more)
    keys = ["__id", "__no_id", "__source", "__no_source", "__mark"]

    def keyed(frame: DataFrame, id_, origin, mark) -> DataFrame:
        # Plain keys that nulls have as well, so that the join and the numbering deal the texts out only once.
        zero = F.lit("0").cast(decided.schema["id"].dataType)
        named = [F.coalesce(id_, zero), id_.isNull(), F.coalesce(origin, F.lit("")), origin.isNull(), mark]
        return frame.withColumns(dict(zip(keys, named)))

    left = keyed(decided, F.col("id"), F.col("source"), F.col("mark"))
    # Copies of equal rows differ by one at most: so many of them have one more than the others.
    left = left.groupBy(*keys).agg(F.min("copies").alias("__least"), F.sum("copies").alias("__sum"), F.count(F.lit(1)).alias("__rows"))
    left = left.where("__sum > 0").select(*keys, "__least", (F.col("__sum") - F.col("__least") * F.col("__rows")).alias("__more"))
    rows = keyed(docs, F.col(f"`{doc_id}`"), F.col(f"`{source}`").cast("string"), F.xxhash64(F.col(f"`{text}`")))
    # Rows of one id, source and text differ in other columns at most; a hash of those decides between them.
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in (doc_id, text, source) and "map<" not in f.dataType.simpleString()]
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*others) if others else F.lit(1)))
    joined = rows.join(left, keys).withColumn("__turn", turn)
    number = (F.col("__least") + (F.col("__turn") <= F.col("__more")).cast("bigint")).alias("__copies")
    joined = joined.select("*", number).where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns))
