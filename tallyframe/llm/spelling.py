"""Words one edit apart, by banded edit matrices over a sorted vocabulary, and the spellings they stand for.

Two words are near when one inserted, deleted or replaced code point turns one into the other.  Near words of lengths s
and s (or s + 1) share their first i and last j code points wherever the edit lies between, so the vocabulary is dealt
into buckets of such ends, and each bucket is searched on its own: its words' middles are sorted, and every prefix that
adjacent middles share has one banded row of the edit matrix per word that is compared with it.  The row serves the
whole range of middles with that prefix; a range whose row exceeds one edit is skipped with all that it holds.  Buckets
that are too large are dealt again with longer ends, until one code point is left between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.store import written

#: A bucket of more words than this is dealt again with longer ends.
BUCKET = 4096
#: Pairs of a word and a range of middles that one step looks at together, roughly.
FRONTIER = 1 << 20
# Fixed value: what counts as a word is a run of these.
LETTERS = "[A-Za-zÀ-ÿ]+"


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", drop: int = 199, shortest: int = 6, least: int = 5) -> DataFrame:
    """Columns ``word`` and ``n``: the words of all texts with at least ``shortest`` code points and ``n`` >= ``least``.

    A word is a maximal run of :data:`LETTERS` with A-Z lower-cased.  Where ``drop`` divides h, the crc32 of
    ``<id>:<word>`` in UTF-8, all of that document's occurrences lose the code point at h modulo their length; this
    plants slips at a known rate, and ``drop`` = 0 turns it off.  A null id reads as empty text; a null text has no words.
    """
    source = docs.select(F.col(f"`{doc_id}`").cast("string").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))
    low = F.translate("__text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = source.select("__id", F.explode(F.regexp_extract_all(low, F.lit(LETTERS), F.lit(0))).alias("word"))
    if drop:
        runs = runs.withColumn("h", F.crc32(F.concat(F.coalesce("__id", F.lit("")), F.lit(":"), F.col("word")).cast("binary")))
        slip = F.expr("concat(substring(word, 1, int(h % char_length(word))), substring(word, int(h % char_length(word)) + 2))")
        runs = runs.select(F.when(F.col("h") % drop == 0, slip).otherwise(F.col("word")).alias("word"))
    long = runs.where(F.char_length("word") >= shortest)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _dealt(rows: DataFrame, halves: str) -> DataFrame:
    """Rows (word, n, s, i, j, low, high) once for each half of their gap, which ``halves`` cuts."""
    cut = F.expr(f"transform(array(0, 1), h -> struct(h, {halves} as m))")
    both = rows.withColumn("__cut", F.explode(cut))
    left, m = F.col("__cut.h") == 0, F.col("__cut.m")
    return both.select(
        "word",
        "n",
        "s",
        F.when(left, F.col("i")).otherwise(m).alias("i"),
        F.when(left, F.col("s") - m).otherwise(F.col("j")).alias("j"),
        F.when(left, F.col("low")).otherwise(m).alias("low"),
        F.when(left, m).otherwise(F.col("high")).alias("high"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """The bucket's name and the middle of the word: what lies between the first i and the last j code points."""
    ends = [F.col("s"), F.col("i"), F.expr("substring(word, 1, i)"), F.expr("right(word, j)")]
    middle = F.expr("substring(word, i + 1, char_length(word) - i - j)")
    return rows.withColumn("bucket", F.concat_ws("|", *(e.cast("string") for e in ends))).withColumn("middle", middle)


def near_pairs(words: DataFrame, shortest: int = 6, bucket: int = BUCKET) -> DataFrame:
    """Columns word, n, near, near_n, once in each direction, for all pairs of ``words`` (word, n) that are near.

    Words are distinct, not null and have at least ``shortest`` (2 or more) code points.  Every pair comes from one
    bucket alone: the one in whose range [low, high) the length of their common prefix falls.
    """
    shapes = words.select(
        "word",
        "n",
        F.explode(F.expr(f"filter(array(char_length(word), char_length(word) - 1), x -> x >= {max(shortest, 2)})")).alias("s"),
    )
    whole = shapes.select("*", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("low"), F.lit(2**30).alias("high"))
    rows = written(_keyed(_dealt(whole, "int(s / 2)")), "buckets")
    done = None
    while True:
        # Buckets too large: at most the number of rows over `bucket`.
        large = rows.where("s - i - j > 1").groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > bucket)
        large = written(large.select("bucket"), "large-buckets")
        if large.isEmpty():
            break
        small = rows.join(large, "bucket", "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        again = rows.join(large, "bucket", "left_semi").select("word", "n", "s", "i", "j", "low", "high")
        rows = written(_keyed(_dealt(again, "i + int((s - i - j) / 2)")), "buckets")
    rows = rows if done is None else done.unionByName(rows)
    gap = (F.col("s") - F.col("i") - F.col("j")).alias("gap")
    dealt = rows.select("bucket", "middle", "word", "n", "i", "low", "high", gap).repartition("bucket").sortWithinPartitions("bucket", "middle")
    return dealt.mapInArrow(_search, "word string, n bigint, near string, near_n bigint")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of the buckets in a sorted stream; a bucket cut by the end of a batch waits for the next one."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        codes = table.column("bucket").combine_chunks().dictionary_encode()
        codes = (codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
        whole = int(np.searchsorted(codes, codes[-1]))
        rest = table.slice(whole)
        yield from _pairs(table.slice(0, whole), codes[:whole])
    if rest is not None:
        codes = np.zeros(rest.num_rows, np.int32)
        yield from _pairs(rest, codes)


def _pairs(table: pa.Table, buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
    if table.num_rows < 2:
        return
    middles = table.column("middle").to_pylist()
    size = np.array([len(m) for m in middles])
    low, high, i, gap = (table.column(c).to_numpy() for c in ("low", "high", "i", "gap"))
    words, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
    if isinstance(words, pa.ChunkedArray):
        words, n = pa.concat_arrays(words.chunks), pa.concat_arrays(n.chunks)
    for a, b, prefix in within_one(middles, buckets):
        common = i[a] + prefix
        # Two of the longer words of a bucket are shorter ones of another.
        own = (common >= low[a]) & (common < high[a]) & (np.minimum(size[a], size[b]) == gap[a])
        a, b = pa.array(np.concatenate([a[own], b[own]])), pa.array(np.concatenate([b[own], a[own]]))
        if len(a):
            yield pa.RecordBatch.from_arrays(
                [words.take(a), n.take(a), words.take(b), n.take(b)], names=["word", "n", "near", "near_n"]
            )


def within_one(middles: list[str], buckets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays a < b of the indices of middles of one bucket that are exactly one edit apart, and their common prefix.

    ``middles`` is sorted within each bucket by code points, and buckets are contiguous.  ``rows[p]`` holds the cells
    of an edit matrix next to its diagonal: the edits between a prefix of d code points, which the middles ``start[p]``
    to ``stop[p]`` share, and the first d - 1, d and d + 1 code points of middle ``query[p]``.
    """
    m = len(middles)
    size = np.array([len(w) for w in middles], np.int64)
    width = int(size.max()) if m else 0
    # One column more than needed: reading past the end of a middle gives 0, which no code point of a word is.
    codes = np.zeros((m, width + 2), np.uint32)
    flat = np.frombuffer("".join(middles).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes[np.repeat(np.arange(m), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    fresh = np.ones(m, bool)
    fresh[1:] = buckets[1:] != buckets[:-1]
    # Common prefix of each middle with the one before it; -1 at the start of a bucket.
    differs = np.ones((m, width + 1), bool)
    differs[1:, :width] = codes[1:, :width] != codes[:-1, :width]
    shared = differs.argmax(1)
    shared[1:] = np.minimum(shared[1:], np.minimum(size[1:], size[:-1]))
    shared[fresh] = -1
    begins, ends = np.flatnonzero(fresh), np.append(np.flatnonzero(fresh)[1:], m)
    lengths = ends - begins
    first = np.repeat(begins, lengths)
    # Queries are taken so many at a time that the first steps, which rule out little, stay small.
    load = np.cumsum(np.repeat(np.minimum(lengths, 64) * np.minimum(lengths, 16), lengths) * (np.repeat(lengths, lengths) > 1))
    cuts = np.unique(np.append(np.searchsorted(load, np.arange(FRONTIER, load[-1] + FRONTIER, FRONTIER), "right"), m)) if m else []
    at = 0
    for cut in cuts:
        query = np.arange(at, cut)
        at = cut
        query = query[np.repeat(lengths, lengths)[query] > 1]
        if len(query):
            yield from _frontier(query, first[query], np.repeat(ends, lengths)[query], codes, size, shared)


def _frontier(query, start, stop, codes, size, shared) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    far = 9
    rows = np.empty((len(query), 3), np.int8)
    rows[:] = (far, 0, 1)
    depth = 0
    while len(query):
        # The first middle of a range ends here if it is as long as the prefix: the words are as far as the row says.
        over = size[query] - depth
        ended = (size[start] == depth) & (np.abs(over) <= 1) & (query < start)
        if ended.any():
            hit = np.flatnonzero(ended)
            hit = hit[rows[hit, over[hit] + 1] == 1]
            a, b = query[hit], start[hit]
            yield a, b, _common(codes, size, a, b)
        # Children: ranges of the middles that share one code point more; only those with a middle after the query.
        begin = start + (size[start] == depth)
        live = np.flatnonzero((begin < stop) & (query < stop - 1))
        query, begin, stop, rows = query[live], begin[live], stop[live], rows[live]
        if not len(query):
            return
        heads = np.flatnonzero(shared <= depth)  # where a range of prefixes of depth + 1 begins
        a, b = np.searchsorted(heads, begin, "right"), np.searchsorted(heads, stop, "left")
        n = b - a + 1
        owner = np.repeat(np.arange(len(query)), n)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        nth = a[owner] + place
        child = np.where(place == 0, begin[owner], heads[np.minimum(nth - 1, len(heads) - 1)])
        last = np.where(place == n[owner] - 1, stop[owner], heads[np.minimum(nth, len(heads) - 1)])
        after = np.flatnonzero(last - 1 > query[owner])
        owner, child, last = owner[after], child[after], last[after]
        q, letter, before = query[owner], codes[child, depth], rows[owner]
        # Row depth + 1 at columns depth, depth + 1 and depth + 2.
        now = np.empty((len(owner), 3), np.int8)
        length = size[q]
        left = np.full(len(owner), far, np.int8)
        for k in range(3):
            j = depth + k  # column, counted in code points of the query
            up = before[:, k + 1] + 1 if k < 2 else far
            diagonal = before[:, k] + (codes[q, np.minimum(max(j - 1, 0), codes.shape[1] - 1)] != letter) if j > 0 else far
            cell = np.minimum(np.minimum(up, diagonal), left + 1)
            left = np.where(j <= length, np.minimum(cell, far), far).astype(np.int8)
            now[:, k] = left
        alive = np.flatnonzero(now.min(1) <= 1)
        query, start, stop, rows = q[alive], child[alive], last[alive], now[alive]
        depth += 1


def _common(codes: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differs = codes[a] != codes[b]
    prefix = np.where(differs.any(1), differs.argmax(1), codes.shape[1])
    return np.minimum(prefix, np.minimum(size[a], size[b]))


def grouped(words: DataFrame, shortest: int = 6, times: int = 5, bucket: int = BUCKET) -> DataFrame:
    """Each of ``words`` (word, n) with its number of near words, its form, the form's n, and the root it leads to.

    The form is the near word of largest n (ties: the smallest in code-point order) if that n is at least ``times``
    the word's own; the root is reached by following forms, and is the word itself where there is none.  Every step
    multiplies n by ``times`` or more, so chains are short; they are followed by doubling, a written round each.
    """
    pairs = near_pairs(words, shortest, bucket)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best")
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(-F.col("best.less") >= times * F.col("n"), F.col("best.word")).alias("form"),
        F.when(-F.col("best.less") >= times * F.col("n"), -F.col("best.less")).alias("form_n"),
    )
    found = written(found, "near-words")
    steps = written(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = written(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if steps.where("next is not null").isEmpty():
            break
        steps = steps.drop("next")
    return found.join(steps.select("word", "root"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
