"""A maximum-entropy language model over hashed words with class-factored softmax, word pairs and word skips.

The model has three layers, each a distribution over the words that refines the one below it.

The lowest gives a word the probability of its class, given the classes of the two words before, times that of the word
within its class.  The class factor is a softmax over features of the history: a bias, the previous word's class, the class
of the word before it and the pair of both, each pair with weights of its own.  The word factor is the add-one share of the
word in its class; one unseen word is provided for in every class that can have one.

The next has a feature for every word skip (a word and the one two places after it) of the training texts, the top one a
feature for every word pair.  Of all distributions that give the words seen after a history their discounted shares, each
is the one with the least entropy relative to the layer below: that one times 1 + n / (weight * chance), normalized by 1 + h /
weight, where n counts the feature and h the history.  Its solution is exact, so counts are all that it needs; the weights
are chosen for each class of histories, by the likelihood of every training token given all others.

The commonest words have classes of their own; every other word that occurs at least :data:`LEAST_COUNT` times shares one
with words of like frequency, by its count alone.  Rarer words fall into eight classes by their form (a non-ASCII letter,
a final sign, length), and unseen words with them.  Features of words have no least count and no bins: 64-bit keys.

Everything is counted over the whole training text.  Words are counted per task, then added up by a shuffle.  Texts become
chunks of words numbered by name; each chunk sends its distinct words, pairs and skips to where they are added up, and gets
the totals back, so what is counted grows with the corpus and no task or key holds a share of it that does.  Counts of
(history, class) have a fixed number of cells and carry all that the gradient needs, so each step of the distributed
training is exact for the whole corpus.  The commonest words, :data:`HELD` of them at most, have their classes sent to the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import text as words
from tallyframe.llm.store import dropped, released, written

#: Words whose classes every task holds, at most (10 bytes each); no result depends on it.
HELD = 1 << 16
#: Rarer words stay with the unseen ones, whose chance is judged by theirs.
LEAST_COUNT = 4
#: Classes: one for the end, eight for forms, single words, and bands of like frequency.
SINGLES, BANDS, FORMS = 63, 24, 8
CLASSES = 1 + FORMS + SINGLES + BANDS
STARTS = CLASSES  # the class that stands before a text
_HISTORIES = (CLASSES + 1) ** 2
FEATURES = 1 + 2 * (CLASSES + 1) + _HISTORIES
#: How far before a token the words of its features stand: the last one (word pairs) and the one before it (word skips).
DISTANCES = (1, 2)
#: Tokens of a chunk, the least that hold it together, and of a bucket of keys, which one task adds up.
CHUNK, BUCKET = 1 << 19, 1 << 21
#: What the coarser chance may weigh against the training tokens after a word.
WEIGHTS = 4.0 ** np.arange(-1, 12)
_ENDS = words.mix64(np.array([1, 2], np.uint64))  # stand for the end and the start among the names
_ODD = np.uint64(0x9FB21C651E98DF25)
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def named_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words (61 bits of hash above 3 bits of form, signed) and each row's first one (n + 1 values)."""
    starts, ends, first = words.word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), first
    hashes = words.span_hashes(data, starts, ends, fold=True)
    high = np.zeros(len(data) + 1, np.int32)
    np.cumsum(data >= 0x80, out=high[1:], dtype=np.int32)
    form = (high[ends] > high[starts]).astype(np.uint64)
    form |= (~_LETTERS[data[ends - 1]]).astype(np.uint64) << np.uint64(1)
    form |= (ends - starts >= 8).astype(np.uint64) << np.uint64(2)
    return ((hashes & ~np.uint64(7)) | form).view(np.int64), first


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = words.column_bytes(column)
    for i, j in words.row_groups(offsets):
        yield i, j, *named_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``c``: the count of every word name in the only column of ``texts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            names = np.concatenate([n for n, _ in held])
            order = np.argsort(names, kind="stable")
            names, counts = names[order], np.concatenate([c for _, c in held])[order]
            begin = np.flatnonzero(np.diff(names, prepend=names[:1] - 1)) if len(names) else np.zeros(0, np.int64)
            return (names[begin], np.add.reduceat(counts, begin)) if len(names) else (names, counts)

        def batch_of(pair: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(pair[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)]) for x in pair], names=["word", "c"])

        for batch in batches:
            for _, _, names, _ in _pieces(batch.column(0)):
                held.append(np.unique(names, return_counts=True))
                size += len(held[-1][0])
                if size > 3_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1_500_000:
                        yield from batch_of(held[0])
                        held, size = [], 0
        if held:
            yield from batch_of(merged())

    return texts.mapInArrow(run, "word bigint, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What a task needs to know of the words: the rule from counts to classes, and the commonest words in order."""

    names: np.ndarray
    classes: np.ndarray
    class_logs: np.ndarray
    total: int
    distinct: int
    end_log: float
    texts: int
    #: The counts that give a class by frequency, rising, and the class of each.
    levels: np.ndarray
    level_classes: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, texts: int, frequent: int | None = None, held: int | None = None) -> Vocabulary:
        """From written word counts and the number of training texts; ``frequent`` raises the least count of a class by
        frequency until so many words have one at most."""
        held = HELD if held is None else held
        groups = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
        # Distinct counts are few: those of n words add up to at least n * n / 2.
        groups = sorted(((r.c, r.n) for r in groups.collect()), reverse=True)
        total, distinct = sum(c * n for c, n in groups), sum(n for _, n in groups)
        levels, numbers = [], []
        for c, n in groups:
            if c < LEAST_COUNT or (frequent is not None and sum(numbers) + n > frequent):
                break
            levels.append(c)
            numbers.append(n)
        levels, numbers = np.array(levels, np.int64), np.array(numbers, np.int64)
        mass = np.zeros(CLASSES)
        mass[0] = texts + 1
        mass[1 : 1 + FORMS] = 1
        # Single words are the first by count and name; what they leave of each level goes to the bands.
        left = numbers - np.diff(np.minimum(np.cumsum(numbers), SINGLES), prepend=0)
        weight = levels * left
        share = (np.cumsum(weight) - weight / 2) / max(weight.sum(), 1)
        level_classes = 1 + FORMS + SINGLES + np.minimum((share * BANDS).astype(int), BANDS - 1)
        np.add.at(mass, level_classes, (levels + 1) * left)
        names, c, classes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(levels):
            order = [F.col("c").desc(), F.col("word")]
            singles = counts.where(F.col("c") >= int(levels[-1])).orderBy(*order).limit(SINGLES).collect()
            whole = int(np.searchsorted(np.cumsum(numbers), held, "right"))
            top = pd.DataFrame({"word": [r.word for r in singles], "c": [r.c for r in singles]})
            if whole:
                more = counts.where(F.col("c") >= int(levels[whole - 1])).toPandas()
                top = pd.concat([top, more[~more["word"].isin(top["word"])]])
            names, c = top["word"].to_numpy(np.int64), top["c"].to_numpy(np.int64)
            classes = level_classes[np.searchsorted(-levels, -c)]
            classes[: len(singles)] = 1 + FORMS + np.arange(len(singles))
            np.add.at(mass, classes[: len(singles)], c[: len(singles)] + 1)
        least = int(levels[-1]) if len(levels) else None
        rare = counts.where(F.col("c") < least) if least is not None else counts
        for r in rare.groupBy(F.pmod("word", F.lit(8)).cast("int").alias("form")).agg(F.sum(F.col("c") + 1).alias("mass")).collect():
            mass[1 + r.form] += r.mass
        order = np.argsort(names)
        return cls(
            names[order], classes[order].astype(np.int16), np.log10(np.maximum(mass, 1)),
            total + texts, distinct + (texts > 0), math.log10(texts + 1), texts, levels[::-1].copy(), level_classes[::-1].copy(),
        )

    def look_up(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each name, that of its form if it is not among the words held here, and its place there or -1."""
        if not len(self.names):
            return 1 + (names & 7), np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        at = np.where(self.names[at] == names, at, -1)
        return np.where(at >= 0, self.classes[at], 1 + (names & 7)), at

    def by_count(self, names: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Class of each name that is not held, from its count."""
        forms = 1 + (names & 7)
        if not len(self.levels):
            return forms
        at = np.minimum(np.searchsorted(self.levels, counts), len(self.levels) - 1)
        return np.where(counts >= self.levels[0], self.level_classes[at], forms)


def histories(classes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Number of the history before each token of texts that start at ``begin``."""
    one = np.empty(len(classes), np.int64)
    one[1:] = classes[:-1]
    one[begin] = STARTS
    two = np.empty(len(classes), np.int64)
    two[1:] = one[:-1]
    two[begin] = STARTS
    return two * (CLASSES + 1) + one


def _packed(values: np.ndarray) -> bytes:
    """Integers as compressed bytes, equal places of all values beside each other."""
    planes = np.ascontiguousarray(np.asarray(values, np.int64)).view(np.uint8).reshape(-1, 8)
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes.T), "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.int64).reshape(-1)


def chunked(rows: DataFrame) -> DataFrame:
    """Rows (id, trained, text) in chunks of about :data:`CHUNK` words: the names that occur, rising, and the words as places
    in them; texts are not read again."""
    listed = rows.select(F.array("id").alias("ids"), F.array("trained").alias("trains")).schema
    schema = type(listed)().add("chunk", "long").add("ids", listed["ids"].dataType).add("trains", listed["trains"].dataType)
    schema = schema.add("lengths", "binary").add("names", "binary").add("places", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def batch_of() -> pa.RecordBatch:
            names, places = np.unique(np.concatenate([n for n, _, _ in held]).view(np.uint64), return_inverse=True)
            lengths = np.concatenate([n for _, n, _ in held])
            lists = [pa.concat_arrays([part.column(k) for _, _, part in held]) for k in (0, 1)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            binaries = [pa.array([_packed(x)], pa.binary()) for x in (lengths, np.diff(names, prepend=np.uint64(0)).view(np.int64), places)]
            return pa.RecordBatch.from_arrays([pa.array([number]), *lists, *binaries], names=schema.names)

        for batch in batches:
            for i, j, names, first in _pieces(batch.column(2)):
                held.append((names, np.diff(first), batch.slice(i, j - i)))
                size += len(names) + j - i
                if size >= CHUNK:
                    yield batch_of()
                    number, held, size = number + 1, [], 0
        if held:
            yield batch_of()

    return rows.select("id", "trained", "text").mapInArrow(run, schema)


class _Chunk:
    """The tokens of one chunk, ends included, as places in its names, to which the end and the start are added."""

    def __init__(self, row: dict):
        self.names = np.cumsum(_unpacked(row["names"]).view(np.uint64), dtype=np.uint64)
        lengths = _unpacked(row["lengths"])
        self.begin = np.cumsum(lengths + 1) - (lengths + 1)
        n = int((lengths + 1).sum())
        self.is_word = np.ones(n, bool)
        self.is_word[self.begin + lengths] = False
        self.token = np.full(n, len(self.names), np.int64)
        self.token[self.is_word] = _unpacked(row["places"])
        self.trained = np.repeat(np.asarray(row["trains"], bool), lengths + 1)

    def before(self, distance: int) -> np.ndarray:
        """The token so many places before each, or the start."""
        out = np.full(len(self.token), len(self.names) + 1, np.int64)
        out[distance:] = self.token[:-distance]
        for k in range(distance):
            at = self.begin + k
            out[at[at < np.append(self.begin[1:], len(out))]] = len(self.names) + 1
        return out

    def keys(self, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of a kind of feature, and how often training tokens have them: distance 0 for the words by themselves, otherwise
        for each token with the one so far before it, followed by the earlier tokens by themselves."""
        if not distance:
            return self.names, np.bincount(self.token[self.trained & self.is_word], minlength=len(self.names))
        named = np.concatenate([self.names, _ENDS])
        before = self.before(distance)
        pairs = words.mix64(words.mix64(named + np.uint64(distance))[before] * _ODD + named[self.token])
        alone = words.mix64(words.mix64(named ^ _ODD) + np.uint64(distance))
        counts = np.bincount(before[self.trained], minlength=len(named))
        return np.concatenate([pairs, alone]), np.concatenate([self.trained.astype(np.int64), counts])


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the keys, where each distinct one begins in it, and the rank of each in that order."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def training_counts(chunks: DataFrame, distance: int, buckets: int) -> DataFrame:
    """``chunk``, ``bucket``, ``totals``: how often each distinct key of each chunk occurs in all training texts.

    Every chunk sends each of its distinct keys once, with its own count, dealt by ranges of the keys; what comes back has
    no keys, only the totals in the order in which they were sent.  No count is left out, and a common key is as many
    rows as there are chunks.
    """
    edges = (np.arange(1, buckets, dtype=object) * 2**64 // buckets).astype(np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _Chunk(row).keys(distance)
                order, begin, _ = _distinct(keys)
                if not len(begin):
                    continue
                keys, counts = keys[order[begin]], np.add.reduceat(counts[order], begin)
                ends = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
                some = np.flatnonzero(np.diff(ends))
                cuts = [slice(ends[k], ends[k + 1]) for k in some]
                columns = [np.full(len(some), row["chunk"]), some.astype(np.int32)]
                packed = [[_packed(np.diff(keys[c], prepend=np.uint64(0)).view(np.int64)) for c in cuts], [_packed(counts[c]) for c in cuts]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *(pa.array(x, pa.binary()) for x in packed)], names=["chunk", "bucket", "keys", "n"])

    def add(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unpacked(x).view(np.uint64), dtype=np.uint64) for x in table["keys"].to_pylist()]
        counts = np.concatenate([_unpacked(x) for x in table["n"].to_pylist()])
        order, begin, rank = _distinct(np.concatenate(keys))
        totals = np.empty_like(counts)
        totals[order] = np.add.reduceat(counts[order], begin)[rank]
        parts = np.split(totals, np.cumsum([len(x) for x in keys])[:-1])
        return table.select(["chunk", "bucket"]).append_column("totals", pa.array([_packed(x) for x in parts], pa.binary()))

    sent = chunks.select("chunk", "trains", "lengths", "names", "places").mapInArrow(send, "chunk long, bucket int, keys binary, n binary")
    return sent.groupBy("bucket").applyInArrow(add, "chunk long, bucket int, totals binary")


def counted(chunks: DataFrame, vocabulary: Vocabulary, passes: int = 4) -> DataFrame:
    """Chunks with the class of every token and its training counts: ``c`` of itself, ``n1`` with the token before, ``n2`` with
    the one before that, and ``h2`` of the latter as such.  A part of the chunks at a time lies in a shuffle on disk."""
    spark = chunks.sparkSession
    buckets = max(1, vocabulary.total // BUCKET)
    totals = []
    for distance in (0, *DISTANCES):
        totals.append(written(training_counts(chunks, distance, buckets), f"lm-counts-{distance}"))
        for _ in range(2):  # the plans that the first collection lets go of hold shuffles, too
            released(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    given = chunks.select("chunk", "ids", "trains", "lengths").schema
    schema = type(given)(list(given))
    for name in ("classes", "c", "n1", "n2", "h2"):
        schema = schema.add(name, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at, row in enumerate(batch.select(["trains", "lengths", "names", "places", "back"]).to_pylist()):
                chunk = _Chunk(row)
                back = [np.concatenate([np.zeros(0, np.int64), *(_unpacked(r["totals"]) for r in row["back"] if r["kind"] == k)]) for k in (0, *DISTANCES)]
                names = chunk.names.view(np.int64)
                kinds, held = known.look_up(names)
                kinds = np.append(np.where(held >= 0, kinds, known.by_count(names, back[0])), 0)
                count = np.append(back[0], known.texts)
                found = []
                for k in DISTANCES:
                    order, _, rank = _distinct(chunk.keys(k)[0])
                    every = np.empty(len(order), np.int64)
                    every[order] = back[k][rank]
                    found.append(every)
                n, alone = len(chunk.token), found[-1][len(chunk.token) :]
                binaries = kinds[chunk.token], count[chunk.token], found[0][:n], found[1][:n], alone[chunk.before(DISTANCES[-1])]
                kept = batch.select(given.names).slice(at, 1)
                yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array([_packed(x)], pa.binary()) for x in binaries)], names=schema.names)

    parts = []
    for k in range(passes):
        mine = F.pmod(F.xxhash64("chunk"), F.lit(passes)) == k
        back = reduce(DataFrame.unionByName, (t.where(mine).withColumn("kind", F.lit(d)) for d, t in zip((0, *DISTANCES), totals)))
        back = back.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("kind", "bucket", "totals"))).alias("back"))
        none = F.array().cast(back.schema["back"].dataType)
        joined = chunks.where(mine).join(back, "chunk", "left").withColumn("back", F.coalesce("back", none))
        parts.append(written(joined.mapInArrow(run, schema), "lm-tokens"))
        released(spark)
    dropped(*totals)
    return reduce(DataFrame.unionByName, parts)


class _Counted:
    """The tokens of one row of :func:`counted`."""

    def __init__(self, row: dict):
        lengths = _unpacked(row["lengths"]) + 1
        self.begin = np.cumsum(lengths) - lengths
        self.lengths = lengths
        self.trained = np.repeat(np.asarray(row["trains"], bool), lengths)
        self.classes, self.c, self.n1, self.n2, self.h2 = (_unpacked(row[c]) for c in ("classes", "c", "n1", "n2", "h2"))

    def histories(self) -> np.ndarray:
        return histories(self.classes, self.begin)

    def h1(self, texts: int) -> np.ndarray:
        """Training count of the token before, which is that of the texts for the start."""
        out = np.empty_like(self.c)
        out[1:] = self.c[:-1]
        out[self.begin] = texts
        return out


def class_counts(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``history``, ``class``, ``n`` over all tokens of the only column of the training ``texts``."""
    text = F.coalesce(F.col(f"`{texts.columns[0]}`"), F.lit("")).alias("text")
    rows = texts.select(F.lit(0).alias("id"), F.lit(True).alias("trained"), text)
    return cells_of(counted(written(chunked(rows), "lm-chunks"), vocabulary))


def cells_of(tokens: DataFrame) -> DataFrame:
    """``history``, ``class``, ``n`` over all training tokens of :func:`counted`; a fixed number of cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(_HISTORIES * CLASSES, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                lengths, classes = _unpacked(row["lengths"]) + 1, _unpacked(row["classes"])
                at = histories(classes, np.cumsum(lengths) - lengths) * CLASSES + classes
                cell, n = np.unique(at[np.repeat(np.asarray(row["trains"], bool), lengths)], return_counts=True)
                cells[cell] += n
        some = np.flatnonzero(cells)
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            columns = [pa.array(part // CLASSES), pa.array((part % CLASSES).astype(np.int32)), pa.array(cells[part])]
            yield pa.RecordBatch.from_arrays(columns, names=["history", "class", "n"])

    found = tokens.select("trains", "lengths", "classes").mapInArrow(run, "history bigint, class int, n bigint")
    return found.groupBy("history", "class").agg(F.sum("n").alias("n"))


def features(history: np.ndarray) -> np.ndarray:
    """The four active features of each history; the last is the history's own, so that no two share it."""
    two, one = np.divmod(history, CLASSES + 1)
    first = 1 + 2 * (CLASSES + 1)
    return np.stack([np.zeros_like(one), 1 + one, 1 + (CLASSES + 1) + two, first + history], axis=1)


def log_chances(weights: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Natural log probabilities of the classes after each history."""
    scores = weights[features(history)].sum(axis=1)
    scores -= scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def gradient(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Slope and value of the log likelihood at ``weights``, summed over the partitions of (history, classes, ns)."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slope, value = np.zeros((FEATURES, CLASSES)), 0.0
        for batch in batches:
            history = batch["history"].to_numpy(np.int64)
            counts = np.zeros((len(history), CLASSES))
            lengths = batch["classes"].map(len).to_numpy()
            if len(history):
                where = np.repeat(np.arange(len(history)), lengths), np.concatenate(batch["classes"].to_list()).astype(int)
                counts[where] = np.concatenate(batch["ns"].to_list())
            chances = log_chances(shared.value, history)
            value += float((counts * chances).sum())
            off = counts - counts.sum(axis=1, keepdims=True) * np.exp(chances)
            active = features(history)
            for k in range(active.shape[1]):
                np.add.at(slope, active[:, k], off)
        met = np.flatnonzero(slope.any(axis=1))
        yield pd.DataFrame({"met": [met.tobytes()], "slope": [slope[met].tobytes()], "value": [value]})

    slope, value = np.zeros((FEATURES, CLASSES)), 0.0
    # The slopes of the features that each of the few partitions met: a history, and with it a pair, lies in one of them.
    for r in sorted(rows.mapInPandas(run, "met binary, slope binary, value double").collect(), key=lambda r: r.value):
        slope[np.frombuffer(r.met, np.int64)] += np.frombuffer(r.slope).reshape(-1, CLASSES)
        value += r.value
    shared.destroy()
    return slope, value


def trained(counts: DataFrame, steps: int = 12, partitions: int = 8) -> np.ndarray:
    """Weights after distributed gradient steps on all class counts, from smoothed class bigrams on."""
    rows = counts.groupBy("history").agg(F.sort_array(F.collect_list(F.struct("class", "n"))).alias("cells"))
    rows = written(rows.select("history", F.col("cells.class").alias("classes"), F.col("cells.n").alias("ns")).coalesce(partitions), "lm-rows")
    pairs = np.zeros((CLASSES + 1, CLASSES))
    by_previous = counts.groupBy(F.pmod("history", F.lit(CLASSES + 1)).alias("one"), "class").agg(F.sum("n").alias("n"))
    for r in by_previous.collect():
        pairs[r.one, r["class"]] = r.n
    share = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * CLASSES)
    weights = np.zeros((FEATURES, CLASSES))
    weights[0] = np.log(share)
    weights[1 : 2 + CLASSES] = np.log((pairs + 5 * share) / (pairs.sum(axis=1, keepdims=True) + 5) / share)
    total = max(pairs.sum(), 1.0)
    best, best_value, mean, square = weights, -math.inf, 0.0, 0.0
    for step in range(1, steps + 1):
        slope, value = gradient(rows, weights)
        if value > best_value:
            best, best_value = weights, value
        slope = slope / total - 1e-7 * weights
        mean, square = 0.8 * mean + 0.2 * slope, 0.9 * square + 0.1 * slope**2
        # Features seen too rarely to matter do not move as far as the others.
        weights = weights + 0.08 * (mean / (1 - 0.8**step)) / (np.sqrt(square / (1 - 0.9**step)) + 1e-6)
    return best


def _chances_of(tokens: _Counted, table: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Chance of each token by its class and its share of that."""
    return 10.0 ** (table[history * CLASSES + tokens.classes] + np.log10(tokens.c + 1.0))


def _raised(chance: np.ndarray, n: np.ndarray, h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Chances where word features with ``n`` of the ``h`` training tokens after a history refine given ones.

    This is the distribution nearest to the given one (of least relative entropy) that gives each word seen after the
    history its share, discounted by ``weight``: the given chance times one plus n / (weight * chance), over one plus h / weight.
    """
    return (n + weight * chance) / (h + weight)


def fitted(tokens: DataFrame, table: Broadcast, texts: int, weights: np.ndarray | None = None) -> np.ndarray:
    """The weight of the coarser chance for each class of the earlier word: of :data:`WEIGHTS` the likeliest for the training
    tokens, each judged by the others.  First for the words before the last, then, given their ``weights``, for the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(WEIGHTS), CLASSES + 1))
        for batch in batches:
            for row in batch.to_pylist():
                part = _Counted(row)
                history = part.histories()
                some = np.flatnonzero(part.trained)
                two, one = np.divmod(history[some], CLASSES + 1)
                chance = _chances_of(part, table.value, history)[some]
                n, h, kind = part.n2[some] - 1, part.h2[some] - 1, two
                if weights is not None:
                    chance = _raised(chance, n, h, weights[two])
                    n, h, kind = part.n1[some] - 1, part.h1(texts)[some] - 1, one
                for k, weight in enumerate(WEIGHTS):
                    sums[k] += np.bincount(kind, np.log(_raised(chance, n, h, weight)), CLASSES + 1)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    found = tokens.select(*(c for c in tokens.columns if c not in ("chunk", "ids"))).mapInArrow(run, "sums binary")
    sums = np.zeros((len(WEIGHTS), CLASSES + 1))
    # In an order that does not depend on which task ends first.
    for data in sorted(bytes(r.sums) for r in found.collect()):
        sums += np.frombuffer(data).reshape(sums.shape)
    return WEIGHTS[sums.argmax(axis=0)]


def scored(docs: DataFrame, training, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, n_tokens, n_known, train_tokens, base_score and score.

    ``training`` is the condition (a Column) for the rows that the model learns from.  The whole texts count; null is
    empty and has one token, the end.  Scores are log10 probabilities: ``base_score`` of the add-one unigram, ``score``
    of the model.  Without training rows every token is unseen and the classes are equally likely.  Repeated rows are
    scored each.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    learned = docs.where(training).select(body)
    counts = written(word_counts(learned), "lm-words")
    vocabulary = Vocabulary.of(counts, learned.count())
    chunks = written(chunked(docs.select(F.col(f"`{doc_id}`").alias("id"), training.alias("trained"), body)), "lm-chunks")
    released(spark)
    tokens = counted(chunks, vocabulary)
    dropped(chunks, counts)
    weights = trained(written(cells_of(tokens), "lm-classes"))
    # For each history: log10 of the class factor and of the share that the class takes from its words.
    table = np.concatenate([log_chances(weights, part) for part in np.array_split(np.arange(_HISTORIES), 16)])
    table = spark.sparkContext.broadcast((table / math.log(10) - vocabulary.class_logs).ravel())
    texts = vocabulary.texts
    skips = fitted(tokens, table, texts)
    lasts = fitted(tokens, table, texts, skips)
    total, base = vocabulary.total, math.log10(vocabulary.total + vocabulary.distinct + 1)
    schema = type(docs.schema)().add("id", docs.schema[doc_id].dataType).add("trained", "boolean")
    schema = schema.add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(batch.select(batch.schema.names[1:]).to_pylist()):
                part = _Counted(row)
                history = part.histories()
                two, one = np.divmod(history, CLASSES + 1)
                chance = _raised(_chances_of(part, table.value, history), part.n2, part.h2, skips[two])
                chance = _raised(chance, part.n1, part.h1(texts), lasts[one])
                each = (part.c > 0).astype(np.int64), np.log10(part.c + 1.0) - base, np.log10(chance)
                sums = [np.add.reduceat(x, part.begin) for x in each]
                ids, trains = (batch.column(name).slice(at, 1).flatten() for name in ("ids", "trains"))
                columns = [ids, trains, pa.array(part.lengths), pa.array(sums[0]), pa.array(np.full(len(ids), total)), *map(pa.array, sums[1:])]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return tokens.select("ids", *(c for c in tokens.columns if c not in ("chunk", "ids"))).mapInArrow(run, schema)
