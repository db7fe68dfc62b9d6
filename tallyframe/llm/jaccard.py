"""N-gram Jaccard join by count vectors: groups of near-equal documents.

A document's set holds the hashes of its distinct word n-grams.  Hashing them into groups and counting gives a point
whose summed coordinate minima with another point bound the overlap of the two sets from above.

* Documents with equal sets are one *node*.
* The groups are dealt into runs.  An n-gram that only one of two sets has spoils one run at most, so linked sets,
  which differ in few n-grams, agree in all counts of some run that has n-grams.  Every node is listed under each of
  its runs; nodes that share a run, and whose coordinate minima allow the overlap, form clusters.  No linked pair lies
  across two clusters.  A run that very many nodes share counts only for those that may share no other with a linked
  one.  Sizes are classed by powers of two, and a set just below a power is listed in the class above
  as well, so both ends of a link know the same runs.
* Within a cluster an R-tree over the points (bulk-loaded by size and the most varied groups) yields the pairs whose
  minima reach the needed overlap, and only these are verified on the sets.  Pairs that are connected already are
  skipped, so a group of copies costs about one verification each and never its square.
* A cluster with many n-grams is dealt into chunks.  Each chunk is joined with itself and with one hub document; then
  the documents outside the cluster's largest component, and only these, meet every chunk in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm import text as words
from tallyframe.llm.components import components
from tallyframe.llm.store import dropped, released, written

#: Groups of the points by size of the set: so many below the given size.  Each divides the next, so that points of
#: different sizes are compared in the coarser groups.
GROUPS = ((512, 64), (4096, 256), (1 << 62, 1024))
#: N-grams that one chunk of a cluster holds, about.
CHUNK = 1_000_000
#: Nodes under one run that are compared pair by pair, and in one tree, at most.
FEW, MANY = 16, 20_000
#: Clustered documents that are sent to the tasks which read texts, at most (about 100 bytes each); more are joined.
SENT = 1 << 18
_LEAF, _FAN = 32, 16


def needed(a, b, num: int, den: int):
    """Least overlap of linked sets of sizes ``a`` and ``b``: overlap / union >= num / den."""
    return -(-num * (a + b) // (num + den))


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a word sequence; a shorter one counts as a whole."""
    return np.unique(words.windows(hashes, min(width, len(hashes)))) if len(hashes) else np.zeros(0, np.uint64)


def batch_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The set of every row of a string column."""
    data, offsets = words.column_bytes(column)
    for i, j in words.row_groups(offsets):
        part = offsets[i : j + 1] - offsets[i]
        piece = data[offsets[i] : offsets[j]]
        starts, ends, first = words.word_spans(piece, part)
        hashes = words.span_hashes(piece, starts, ends, fold=True)
        for k in range(j - i):
            yield shingle_set(hashes[first[k] : first[k + 1]], width)


def fingerprint(items: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed integer."""
    total = np.add.reduce(words.mix64(items ^ np.uint64(0xA0761D6478BD642F))) if len(items) else np.uint64(0)
    return int(words.mix64(np.array([total + np.uint64(len(items))], np.uint64))[0].astype(np.int64))


def runs(items: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of the runs of groups under which a set is listed, as signed integers."""
    return runs_and_sure(items, num, den)[0]


def runs_and_sure(items: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """:func:`runs`, and how many runs with n-grams a linked set shares at least (0: not known to share any)."""
    n, sure = len(items), []
    classes = [n.bit_length() - 1]
    if n * den >= num << (classes[0] + 1):
        classes.append(classes[0] + 1)
    spoilt = (n + n * den // num) * (den - num) // (den + num)
    per_run = 0.88 * num / (den - num)
    out = []
    for level in classes:
        largest = (2 << level) - 1
        count = max(int(largest / per_run), 2 * largest * (den - num) // (den + num)) + 1
        high = (items >> np.uint64(32)) * np.uint64(count)
        run, group = high >> np.uint64(32), high & np.uint64(0xFFFFFFFF)
        # One count for each of 2**32 groups in a run: the sum of scrambled group numbers names the run's counts.
        counts = words.mix64(group ^ (run << np.uint64(32)))
        begin = np.flatnonzero(np.diff(run, prepend=run[:1] + np.uint64(1)))
        used, sums = run[begin], np.add.reduceat(counts, begin)
        sure.append(max(len(used) - spoilt, 0))
        if len(used) <= spoilt:  # too few to be sure of one with n-grams: those without count as well
            filled = np.zeros(count, np.uint64)
            filled[used.astype(np.int64)] = sums
            used, sums = np.arange(count, dtype=np.uint64), filled
        out.append(words.mix64(sums ^ words.mix64(used + np.uint64((level << 40) + 0x5851F42D4C957F2D))))
    return np.concatenate(out).astype(np.int64), min(sure)


def point(items: np.ndarray, groups: int | None = None) -> np.ndarray:
    """Counts of a set's items in the groups of the tree."""
    groups = groups or next(g for size, g in GROUPS if len(items) < size)
    return np.bincount(((items >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64), minlength=groups).astype(np.int32)


def packed(counts: np.ndarray) -> bytes:
    """A point as bytes: the width of a count, then the counts, in as few bytes as the largest needs."""
    width = 1 if counts.max() < 256 else 2 if counts.max() < 65536 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def alike(points: list[bytes]) -> np.ndarray:
    """Packed points as rows in the coarsest groups among them."""
    points = [np.frombuffer(p, f"<u{p[0]}", offset=1) for p in points]
    groups = min(map(len, points))
    return np.stack([p.reshape(groups, -1).sum(axis=1, dtype=np.int32) for p in points])


class CountTree:
    """R-tree over count vectors with the sizes of their sets; boxes keep the largest coordinates and the size range."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        spread = int(np.argmax(points.var(axis=0))) if len(points) else 0
        slab = max(_LEAF, int(np.sqrt(len(points) / _LEAF + 1)) * _LEAF)
        by_size = np.argsort(sizes, kind="stable")
        place = np.empty(len(points), np.int64)
        place[by_size] = np.arange(len(points)) // slab
        self.order = np.lexsort((points[:, spread], place))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []
        tops, low, high, fan = self.points, self.sizes, self.sizes, _LEAF
        while len(tops) > 1 or not self.levels:
            begin = np.arange(0, len(tops), fan)
            tops = np.maximum.reduceat(tops, begin)
            low, high = np.minimum.reduceat(low, begin), np.maximum.reduceat(high, begin)
            self.levels.append((tops, low, high))
            fan = _FAN

    def reach(self, point: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """Positions in :attr:`order` of the points whose minima with ``point`` reach the needed overlap."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            tops, low, high = self.levels[depth]
            at = at[(high[at] * den >= num * size) & (low[at] * num <= den * size)]
            bound = np.minimum(tops[at], point).sum(axis=1)
            at = at[bound >= needed(size, np.maximum(low[at], -(-num * size // den)), num, den)]
            fan, n = (_FAN, len(self.levels[depth - 1][0])) if depth else (_LEAF, len(self.points))
            at = (at[:, None] * fan + np.arange(fan)).ravel()
            at = at[at < n]
        bound = np.minimum(self.points[at], point).sum(axis=1)
        return at[bound >= needed(size, self.sizes[at], num, den)]


def tree_links(points: np.ndarray, label: np.ndarray, asks: np.ndarray, num: int, den: int, linked=None) -> list[tuple[int, int]]:
    """Links from the rows with flag ``asks`` to rows of other labels whose minima reach the needed overlap.

    ``linked`` verifies a pair of rows; without it the bound decides.  Rows that links connect share a label from then
    on, so the result connects what all links would, and holds no more links than rows.
    """
    if not len(points):
        return []
    sizes = points.sum(axis=1)
    tree, label, links = CountTree(points, sizes), label.copy(), []
    for q in np.flatnonzero(asks):
        near = tree.order[tree.reach(points[q], int(sizes[q]), num, den)]
        near = near[label[near] != label[q]]
        while len(near):
            p, near = near[0], near[1:]
            if linked is None or linked(q, p):
                links.append((int(q), int(p)))
                label[label == label[p]] = label[q]
                near = near[label[near] != label[q]]
    return links


def join_links(sets: list[np.ndarray], label: np.ndarray, asks: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """:func:`tree_links` verified on the sets."""

    def linked(q: int, p: int) -> bool:
        overlap = len(np.intersect1d(sets[q], sets[p], assume_unique=True))
        return den * overlap >= num * (len(sets[q]) + len(sets[p]) - overlap)

    groups = max((len(point(s)) for s in sets), default=1)
    points = np.stack([point(s, groups) for s in sets]) if sets else np.zeros((0, groups), np.int32)
    return tree_links(points, label, asks, num, den, linked)


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("mark"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )


def _fresh(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches with the set, the node and, once per task and node, a true flag for each row."""
    seen: set[int] = set()
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch, rows = whole.slice(at, 1024), []
            for items in batch_sets(batch.column(column), width):
                node = fingerprint(items) if len(items) else None
                rows.append((items, node, node is not None and node not in seen))
                seen.add(node)
            yield batch, rows


def _listed(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """Per row: its id, a mark of its text, its set's size and node, and once per task and node the point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _fresh(batches, 2, width):
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([len(items) for items, _, _ in rows], pa.int64()),
                    pa.array([node for _, node, _ in rows], pa.int64()),
                    pa.array([packed(point(items)) if fresh else None for items, _, fresh in rows], pa.binary()),
                ],
                names=["id", "mark", "size", "node", "point"],
            )

    return _texts(docs, doc_id, text).mapInArrow(run, "id bigint, mark bigint, size bigint, node bigint, point binary")


def _run_rows(docs: DataFrame, doc_id: str, text: str, width: int, num: int, den: int, turn: int, passes: int) -> DataFrame:
    """``run``, ``node``: the runs of every node, once per task, that the pass ``turn`` of ``passes`` deals.

    They are many and most are one node's alone, so they are not written: signatures are made anew in every pass.
    """

    def mine(names: np.ndarray) -> np.ndarray:
        return names[((names.view(np.uint64) >> np.uint64(32)) * np.uint64(passes) >> np.uint64(32)).astype(np.int64) == turn]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _fresh(batches, 0, width):
            found = [(mine(runs(items, num, den)), node) for items, node, fresh in rows if fresh]
            for at in range(0, len(found), 64):
                part = found[at : at + 64]
                names = np.repeat(np.array([node for _, node in part], np.int64), [len(r) for r, _ in part])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([r for r, _ in part])), pa.array(names)], names=["run", "node"])

    return _texts(docs, doc_id, text).select("text").mapInArrow(run, "run bigint, node bigint")


def _in_one_run(rows: DataFrame) -> DataFrame:
    """Nodes that share a run: ``kind`` 0 pairs ``(a, b)`` under runs of up to ``FEW`` nodes, 1 the nodes ``a`` of a run of
    up to ``MANY``, and 2 links of all nodes ``b`` of a longer run with its first."""
    few_nodes, many = FEW, MANY
    rows = rows.repartition("run").sortWithinPartitions("run", "node").select("run", "node")

    def batch_of(kind: int, run: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(a), kind, np.int32))
        return pa.RecordBatch.from_arrays([kinds, pa.array(run), pa.array(a), pa.array(b)], names=["kind", "run", "a", "b"])

    def split(run: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        keep = np.ones(len(run), bool)
        keep[1:] = (run[1:] != run[:-1]) | (node[1:] != node[:-1])
        run, node = run[keep], node[keep]
        begin = np.flatnonzero(np.diff(run, prepend=run[:1] ^ 1))
        sizes = np.diff(np.append(begin, len(run)))
        size = np.repeat(sizes, sizes)
        some = (size > 1) & (size <= many)
        run, node, size = run[some], node[some], size[some]
        if len(run):
            few = size <= few_nodes
            for shift in range(1, few_nodes):
                pair = np.flatnonzero(few[:-shift] & (run[shift:] == run[:-shift]))
                if not len(pair):
                    break
                a, b = np.unique(np.stack([node[pair], node[pair + shift]]), axis=1)
                yield batch_of(0, np.zeros(len(a), np.int64), a, b)
            if not few.all():
                yield batch_of(1, run[~few], node[~few], node[~few])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_run = left_node = np.zeros(0, np.int64)
        star = None  # run and first node of a run that is too long to wait for its end
        for batch in batches:
            run, node = (np.asarray(c) for c in batch.columns)
            if star is not None:
                end = int(np.searchsorted(run, star[0], "right"))
                other = np.unique(node[:end])
                yield batch_of(2, np.full(len(other), star[0]), np.full(len(other), star[1]), other)
                run, node = run[end:], node[end:]
                if not len(run):
                    continue
                star = None
            run, node = np.concatenate([left_run, run]), np.concatenate([left_node, node])
            if not len(run):
                continue
            begin = int(np.searchsorted(run, run[-1], "left"))
            yield from split(run[:begin], node[:begin])
            for a, b in _long(run[:begin], many):
                yield batch_of(2, run[a:b], np.full(b - a, node[a]), node[a:b])
            left_run, left_node = run[begin:], node[begin:]
            if len(left_run) > 2 * many:
                star = (left_run[0], left_node[0])
                yield batch_of(2, left_run, np.full(len(left_run), star[1]), left_node)
                left_run = left_node = np.zeros(0, np.int64)
        if len(left_run):
            yield from split(left_run, left_node)
            for a, b in _long(left_run, many):
                yield batch_of(2, left_run[a:b], np.full(b - a, left_node[a]), left_node[a:b])

    return rows.mapInArrow(deal, "kind int, run bigint, a bigint, b bigint")


def _sure(docs: DataFrame, text: str, width: int, num: int, den: int) -> DataFrame:
    """``node``, ``sure``: how many runs with n-grams every set shares with a linked one at least, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _fresh(batches, 0, width):
            found = [(node, runs_and_sure(items, num, den)[1]) for items, node, fresh in rows if fresh]
            columns = [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "sure"])

    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    return texts.mapInArrow(run, "node bigint, sure bigint").dropDuplicates(["node"])


def _without_common(found: DataFrame, sure) -> DataFrame:
    """``found`` with the runs of more than ``MANY`` nodes kept only for the nodes that may depend on them.

    Such a run stands for little more than an n-gram that very many documents have.  A node that is sure to share more
    runs with a linked one than it has long ones shares a shorter one with it, under which the pair is found; so it
    leaves the long ones.  Those that stay are taken by their number again: a tree if it is small enough now, else links
    with the first.  ``sure`` gives (node, sure) of all nodes and is only called if there is a long run.
    """
    long = written(found.where("kind = 2").select("run", F.col("b").alias("node")).distinct(), "jaccard-long")
    short = found.where("kind < 2")
    if long.isEmpty():
        return short
    own = long.groupBy("node").agg(F.count(F.lit(1)).alias("n_long")).join(sure(), "node").where("n_long >= sure").select("node")
    left = written(long.join(own, "node", "left_semi"), "jaccard-long")
    sizes = left.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first")).where("n > 1")
    kind = F.when(F.col("n") <= MANY, 1).otherwise(2).alias("kind")
    again = left.join(sizes, "run").select(kind, "run", F.when(F.col("n") <= MANY, F.col("node")).otherwise(F.col("first")).alias("a"), F.col("node").alias("b"))
    return short.unionByName(again)


def _shared_runs(found: DataFrame, listed: DataFrame, num: int, den: int) -> DataFrame:
    """Links ``(a, b)`` between nodes that share a run, connecting at least what the overlap bound does not rule out.

    Each pair of :func:`_in_one_run` is held against the bound; among the nodes of a longer run a tree over their points
    finds the pairs; the longest are linked as they are.
    """
    points = written(listed.where("point is not null").select("node", "point").dropDuplicates(["node"]), "jaccard-points")

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                reach = []
                for pair in zip(*(c.to_pylist() for c in batch.columns[2:])):
                    x, y = alike(list(pair))
                    reach.append(int(np.minimum(x, y).sum()) >= needed(int(x.sum()), int(y.sum()), num, den))
                yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(reach))

    def in_tree(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("node").sort_values("node").reset_index(drop=True)
        node = part["node"].to_numpy()
        links = tree_links(alike(part["point"].to_list()), node, np.ones(len(node), bool), num, den)
        return pd.DataFrame(np.array([(node[p], node[q]) for q, p in links], np.int64).reshape(-1, 2), columns=["a", "b"])

    pairs = found.where("kind = 0").select("a", "b").distinct()
    pairs = pairs.join(points.select(F.col("node").alias("a"), F.col("point").alias("x")), "a")
    pairs = pairs.join(points.select(F.col("node").alias("b"), F.col("point").alias("y")), "b").select("a", "b", "x", "y")
    groups = found.where("kind = 1").select("run", F.col("a").alias("node")).join(points, "node")
    stars = found.where("kind = 2").select("a", "b")
    links = pairs.mapInArrow(bounded, "a bigint, b bigint")
    links = links.unionByName(groups.groupBy("run").applyInPandas(in_tree, "a bigint, b bigint")).unionByName(stars).distinct()
    released(listed.sparkSession)
    out = written(links, "jaccard-bounded")
    dropped(points)
    return out


def _long(run: np.ndarray, many: int) -> list[tuple[int, int]]:
    """Where runs of more than ``many`` rows begin and end."""
    begin = np.flatnonzero(np.diff(run, prepend=run[:1] ^ 1))
    ends = np.append(begin[1:], len(run))
    return [(int(a), int(b)) for a, b in zip(begin, ends) if b - a > many]


def _verified(rows: DataFrame, keys: list[str], width: int, num: int, den: int) -> DataFrame:
    """Links among the documents of each group of ``rows`` (keys, node, label, asks, text)."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("node").sort_values("node").reset_index(drop=True)
        sets = list(batch_sets(pa.array(part["text"], pa.large_string()), width))
        links = join_links(sets, part["label"].to_numpy(), part["asks"].to_numpy(bool), num, den)
        node = part["node"].to_numpy()
        return pd.DataFrame(np.array([(node[p], node[q]) for p, q in links], np.int64).reshape(-1, 2), columns=["a", "b"])

    return rows.groupBy(*keys).applyInPandas(run, "a bigint, b bigint")


def linked(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    num: int = 80,
    den: int = 100,
    chunk: int = CHUNK,
    passes: int = 1,
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``mark`` (a hash of its text), ``size`` of its set and its ``component``.

    Two rows link when overlap / union of their sets of ``width``-word shingles is at least ``num / den``; words are
    lower-cased (A-Z).  ``component`` is the smallest id that links lead to.  A row without words has size 0 and its own
    id as component.  Ids may be null or repeat: rows are told apart by their sets, equal sets always link, and null
    ids never become the smallest one unless there is no other.  An empty table gives an empty result.

    The runs of all documents are the largest thing to be dealt.  With more ``passes`` they are dealt in parts, by their
    names, one after the other, and a part is gone before the next: less disk for the work of reading the texts again.
    """
    return _grouped(docs, doc_id, text, width, num, den, chunk, passes).select("id", "mark", "size", "component")


def _grouped(docs: DataFrame, doc_id: str, text: str, width: int, num: int, den: int, chunk: int, passes: int) -> DataFrame:
    """:func:`linked` with the column ``group``, which tells groups apart even where ids repeat."""
    listed = written(_listed(docs, doc_id, text, width), "jaccard-sets")
    parts = []
    for turn in range(passes):
        parts.append(written(_in_one_run(_run_rows(docs, doc_id, text, width, num, den, turn, passes)), "jaccard-shared"))
        released(docs.sparkSession)
    found = _without_common(reduce(DataFrame.unionByName, parts), lambda: _sure(docs, text, width, num, den))
    shared = _shared_runs(found, listed, num, den)
    dropped(*parts)
    clusters = written(components(shared).withColumnRenamed("component", "cluster"), "jaccard-clusters")
    dropped(shared)
    released(docs.sparkSession)
    # One document stands for each node of a cluster.
    one = listed.where("node is not null").groupBy("node").agg(F.min(F.struct("mark", "id")).alias("row"), F.first("size").alias("size"))
    members = clusters.join(one, "node").select("node", "cluster", "row.mark", "row.id", "size")
    volume = clusters.join(one, "node").groupBy("cluster").agg(F.sum("size").alias("volume"))
    members = members.join(volume, "cluster").withColumn("chunks", F.ceil(F.col("volume") / chunk)).drop("volume")
    members = written(members, "jaccard-members")
    named = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("doc_mark"), F.col(f"`{text}`").cast("string").alias("text")
    )


    def with_text(rows: DataFrame, few: bool = False) -> DataFrame:
        same = (F.col("mark") == F.col("doc_mark")) & F.col("id").eqNullSafe(F.col("doc"))
        return named.join(F.broadcast(rows) if few else rows, same).drop("doc", "doc_mark", "mark", "id")

    own = F.array(F.pmod(F.xxhash64("node"), F.col("chunks")))
    everywhere = F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)
    places = F.when(F.col("node") == F.col("cluster"), everywhere).otherwise(own)
    first = members.withColumn("label", F.col("node")).withColumn("asks", F.lit(True))
    first = with_text(first, few=members.count() <= SENT).withColumn("place", F.explode(places))
    links = written(_verified(first, ["cluster", "place"], width, num, den), "jaccard-links")

    large = members.where("chunks > 1")
    if not large.isEmpty():
        released(docs.sparkSession)
        links = written(links.unionByName(_across_chunks(large, links, with_text, width, num, den, chunk)), "jaccard-links")
    released(docs.sparkSession)
    return _labelled(listed, components(links))


def _across_chunks(large: DataFrame, links: DataFrame, with_text, width: int, num: int, den: int, chunk: int) -> DataFrame:
    """Links from the documents outside a large cluster's main component to all of the cluster."""
    found = components(links)
    state = large.join(found, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    weights = state.groupBy("cluster", "label").agg(F.sum("size").alias("volume"))
    main = weights.groupBy("cluster").agg(F.max_by("label", F.struct("volume", "label")).alias("main"), F.sum("volume").alias("all"), F.max("volume").alias("most"))
    state = state.join(main, "cluster").withColumn("blocks", F.ceil((F.col("all") - F.col("most")) / chunk)).where("blocks > 0")
    outside = F.col("label") != F.col("main")
    place = F.pmod(F.xxhash64("node"), F.col("chunks"))
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))
    zero = F.lit(0).cast("bigint")
    targets = state.withColumn("asks", F.lit(False)).withColumn("place", place).withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    asking = state.where(outside).withColumn("asks", F.lit(True)).withColumn("block", block).withColumn("place", F.explode(F.sequence(zero, F.col("chunks") - 1)))
    # A document that asks here need not be asked as well.
    rows = asking.unionByName(targets).groupBy("cluster", "place", "block", "node").agg(
        F.max("asks").alias("asks"), F.first("label").alias("label"), F.first("mark").alias("mark"), F.first("id").alias("id")
    )
    return _verified(with_text(rows), ["cluster", "place", "block"], width, num, den)


def _labelled(listed: DataFrame, found: DataFrame) -> DataFrame:
    nodes = listed.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    nodes = nodes.join(found, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component")
    least = nodes.groupBy("group").agg(F.min("least").alias("component"))
    nodes = nodes.select("node", "group").join(least, "group")
    filled = listed.where("node is not null").select("id", "mark", "size", "node").join(nodes, "node")
    empty = listed.where("node is null").select("id", "mark", "size", F.col("id").alias("component"), F.lit(None).cast("bigint").alias("group"))
    return filled.select("id", "mark", "size", "component", "group").unionByName(empty)


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, num: int = 80, den: int = 100, chunk: int = CHUNK, passes: int = 1
) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one of each group of linked documents stays.

    That is the row with the smallest id (of repeated ids, the one with the smallest hash of its text; of repeated
    rows, one).  Documents without words belong to no group and all stay.
    """
    found = written(_grouped(docs, doc_id, text, width, num, den, chunk, passes), "jaccard-groups")
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "mark")
    best = found.where("size > 0").groupBy("group").agg(F.min(row).alias("row")).select("row.id", "row.mark")
    stays = best.withColumn("single", F.lit(True)).unionByName(
        found.where("size = 0").select("id", "mark").distinct().withColumn("single", F.lit(False))
    )
    keys = ["__id", "__no_id", "__mark"]

    def keyed(frame: DataFrame, id_, mark) -> DataFrame:
        # Plain keys that null ids have as well, so that the join and the numbering deal the texts out only once.
        return frame.withColumns(dict(zip(keys, [F.coalesce(id_, F.lit(0).cast("bigint")), id_.isNull(), mark])))

    stays = keyed(stays, F.col("id"), F.col("mark")).select(*keys, F.col("single").alias("__single"))
    stays = written(stays, "jaccard-stays")
    released(docs.sparkSession)
    named = keyed(docs, F.col(f"`{doc_id}`").cast("bigint"), F.xxhash64(F.col(f"`{text}`")))
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1)))
    joined = named.join(stays, keys).withColumn("__turn", turn)
    return joined.where("__turn = 1 or not __single").select(*(F.col(f"`{c}`") for c in docs.columns))
