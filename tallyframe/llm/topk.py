"""Exact top-k inner products over integer vectors, by descending length with residual bounds.

* Vectors fall into shells by length, cut at quantiles, and into blocks of bounded size inside a shell.
* One rotation, from the eigenvectors of the sum of outer products of all vectors, moves most of every inner product
  into the first coordinates.
* The shell of the longest vectors is searched first and gives every query a threshold that its results must reach.
  A further shell is searched for a query only if its length times the shell's greatest length reaches it.
* Within a block, vectors go by descending length in tiles.  After the first rotated coordinates the Cauchy-Schwarz
  bound on the rest rules pairs out; survivors get their exact integer product.

Queries meet blocks in groups of bounded size on both sides, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.store import written

SHELLS = 16
#: Vectors of a block and queries of a group, about; and groups, at most (queries beyond make the groups larger).
BLOCK, QUERIES, GROUPS = 8192, 4096, 1 << 16
_TILE = 1024
_RESULT = "query_id bigint, vec_id bigint, score bigint"


def prepared(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """``id``, ``length`` and ``v`` (64-bit integers, packed) of the vectors that take part."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), x.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull())
    rows = rows.where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = np.floor(np.asarray(lists.flatten(), float) * scale)
            ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
            parts = [flat[a:b] for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([float(np.sqrt(p @ p)) for p in parts], pa.float64()),
                    pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary()),
                ],
                names=["id", "length", "v"],
            )

    return rows.mapInArrow(run, "id bigint, length double, v binary")


def _matrix(packed, width: int) -> np.ndarray:
    """Packed vectors as rows of ``width`` integers; shorter ones end in zeros."""
    out = np.zeros((len(packed), width), np.int64)
    for row, v in zip(out, packed):
        x = np.frombuffer(v, "<i8")
        row[: len(x)] = x
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Orthogonal matrix whose first columns carry most of the vectors' length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column(0).to_pylist(), width).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    total = np.zeros((width, width))
    # One width x width matrix for each of at most 32 tasks.
    for part in rows.select("v").coalesce(32).mapInArrow(run, "part binary").collect():
        total += np.frombuffer(part.part).reshape(width, width)
    return np.linalg.eigh(total)[1][:, ::-1].copy()


class Best:
    """The k best (score, then smaller id) of each query so far, and the score that a newcomer must reach."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(float).copy()
        self.query = np.zeros(0, np.int64)
        self.name = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self._n = queries

    def add(self, query: np.ndarray, name: np.ndarray, score: np.ndarray) -> None:
        query, name = np.concatenate([self.query, query]), np.concatenate([self.name, name])
        score = np.concatenate([self.score, score])
        order = np.lexsort((name, -score, query))
        query, name, score = query[order], name[order], score[order]
        begin = np.searchsorted(query, np.arange(self._n))
        rank = np.arange(len(query)) - begin[query]
        last = rank == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])
        keep = rank < self.k
        self.query, self.name, self.score = query[keep], name[keep], score[keep]


def search(queries: np.ndarray, own: np.ndarray, floor: np.ndarray, vectors: np.ndarray, names: np.ndarray, turn: np.ndarray, k: int) -> Best:
    """Best of ``vectors`` for each query among those that reach ``floor``; a query's own id does not count."""
    best = Best(len(queries), k, floor)
    lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    order = np.lexsort((names, -lengths))
    vectors, names, lengths = vectors[order], names[order], lengths[order]
    head = max(1, queries.shape[1] // 4)
    q, v = queries.astype(float), vectors.astype(float)
    turned_q, turned_v = q @ turn, v @ turn
    length_q = np.sqrt((q**2).sum(axis=1))
    rest_q, rest_v = (np.sqrt((t[:, head:] ** 2).sum(axis=1)) for t in (turned_q, turned_v))
    exact = float(length_q.max(initial=0)) * float(lengths.max(initial=0)) < 2**52
    for at in range(0, len(vectors), _TILE):
        tile = slice(at, at + _TILE)
        alive = np.flatnonzero(length_q * lengths[at] * (1 + 1e-9) >= best.floor)
        if not len(alive):
            break
        bound = turned_q[alive, :head] @ turned_v[tile, :head].T + np.outer(rest_q[alive], rest_v[tile])
        slack = 1e-9 * (length_q[alive] * lengths[at])[:, None] + 1e-6
        columns = np.flatnonzero((bound + slack >= best.floor[alive, None]).any(axis=0))
        if not len(columns):
            continue
        some = (v[tile][columns], q[alive]) if exact else (vectors[tile][columns], queries[alive])
        scores = some[1] @ some[0].T
        reached = (scores >= best.floor[alive, None]) & (names[tile][columns] != own[alive, None])
        row, column = np.nonzero(reached)
        if len(row):
            best.add(alive[row], names[tile][columns][column], scores[row, column].astype(np.int64))
    return best


def offered(held: DataFrame, asked: DataFrame) -> DataFrame:
    """Vectors (shell, length, ...) once for each ``group`` that has a query which they could still serve.

    Queries (shells, group, length_q, floor) ask a shell only if its longest vector can reach their floor; of its
    vectors, those too short for every query of a group that asks are not copied for that group.
    """
    least = F.when(F.col("length_q") > 0, F.col("floor") / F.col("length_q")).otherwise(float("-inf"))
    wanted = asked.select(F.explode("shells").alias("shell"), "group", least.alias("least"))
    wanted = wanted.groupBy("shell", "group").agg(F.min("least").alias("least"))
    # One row for each of the few shells, with a pair for each of at most GROUPS groups.
    wanted = wanted.groupBy("shell").agg(F.collect_list(F.struct("group", "least")).alias("__open"))
    held = held.join(F.broadcast(wanted), "shell")
    reach = F.col("length") * (1 + 1e-9)
    held = held.withColumn("__open", F.explode(F.filter("__open", lambda g: g["least"] <= reach)))
    return held.withColumn("group", F.col("__open.group")).drop("__open")


def top_k(vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` highest inner products of every query.

    Components are floor(scale * x).  Queries are the rows that ``is_query`` (over the column ``id``) selects, and all
    rows with another id are their candidates; fewer than ``k`` give fewer results.  Ties go to the smaller id.  Rows
    whose id or vector is null, or whose vector holds a null or non-finite component, take no part; shorter vectors
    count as ending in zeros.  Repeated rows are candidates each, and one of them is the query.  Products must fit
    in 64 bits.
    """
    rows = written(prepared(vectors, vec_id, embedding, scale), "topk-rows")
    about = rows.agg(F.max(F.octet_length("v") / 8).cast("int").alias("width"), F.percentile_approx("length", [i / SHELLS for i in range(1, SHELLS)], 10_000).alias("cuts")).first()
    width, cuts = about.width or 1, sorted(set(about.cuts or []), reverse=True)
    spark = vectors.sparkSession
    turn = spark.sparkContext.broadcast(rotation(rows, width))
    shell = F.lit(0)
    for cut in cuts:
        shell = shell + (F.col("length") < cut).cast("int")
    rows = rows.withColumn("shell", shell)
    # One row for each of the few shells.
    shells = {r.shell: r for r in rows.groupBy("shell").agg(F.max("length").alias("longest"), F.count(F.lit(1)).alias("n")).collect()}
    queries = rows.where(is_query).dropDuplicates(["id"]).select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("length").alias("length_q"))
    groups = min(max(1, -(-queries.count() // QUERIES)), GROUPS)
    queries = queries.withColumn("group", F.pmod(F.xxhash64("query_id", F.lit(7)), F.lit(groups)))
    blocks = {s: max(1, -(-r.n // BLOCK)) for s, r in shells.items()}

    def results(asked: DataFrame, places: list[int]) -> DataFrame:
        """Search ``asked`` (query_id, q, group, floor, shells) in the given shells."""
        number = F.create_map(*(F.lit(x) for s in places for x in (s, blocks[s])))
        held = rows.where(F.col("shell").isin(places)).withColumn("block", F.pmod(F.xxhash64("id", "v"), number[F.col("shell")]))
        held = offered(held, asked)
        held = held.select("shell", "block", "group", "id", "v")
        asked = asked.withColumn("shell", F.explode("shells")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), number[F.col("shell")].cast("bigint") - 1)))
        asked = asked.select("shell", "block", "group", "query_id", "q", "floor")

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
            names = right["query_id"].to_numpy()
            best = search(
                _matrix(right["q"], width), names, right["floor"].to_numpy(float), _matrix(left["v"], width), left["id"].to_numpy(), turn.value, k
            )
            return pd.DataFrame({"query_id": names[best.query], "vec_id": best.name, "score": best.score})

        keys = ["shell", "block", "group"]
        return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(run, _RESULT)

    if not shells:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    order = sorted(shells)
    first = queries.withColumn("floor", F.lit(float("-inf"))).withColumn("shells", F.array(F.lit(order[0])))
    found = written(results(first, order[:1]), "topk-first")
    better = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    if len(order) > 1:
        floors = found.withColumn("rank", F.row_number().over(better)).where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("floor"))
        floors = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        open_ = [F.when(F.col("length_q") * shells[s].longest * (1 + 1e-9) >= F.col("floor"), F.lit(s)) for s in order[1:]]
        floors = floors.withColumn("shells", F.array_compact(F.array(*open_)))
        found = found.unionByName(results(floors, order[1:]))
    found = found.withColumn("rank", F.row_number().over(better)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
