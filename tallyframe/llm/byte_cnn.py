"""Document quality from raw bytes: a small convolutional network in numpy that reads every byte of every text.

A filter looks at ``WIDTH`` neighbouring bytes.  Its rectified answers are max-pooled over chunks of two blocks of
``BLOCK`` bytes, each chunk overlapping the next by a block; a layer of hidden units reads the maxima of a chunk, and
the mean of the hidden units over all chunks gives one probability.  Texts are cut nowhere: long ones are convolved
piece by piece, and the pieces' maxima are put together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import text as words

#: Labelled documents the network is fitted on, at most, and chunks taken from each, spread evenly over its text.
TRAINING_DOCUMENTS = 1600
TRAINING_CHUNKS = 8
#: Bytes under a filter, bytes in a block (a chunk has two), filters, and hidden units.
WIDTH, BLOCK, FILTERS, HIDDEN = 6, 128, 16, 8
#: Blocks convolved at once.
PIECE = 64


@dataclass
class Network:
    """``taps[k, byte]`` is what the filters add for a byte at place k; the other weights read the pooled maxima."""

    taps: np.ndarray
    bias: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        random = np.random.default_rng(seed)
        return cls(
            random.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            random.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            random.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32),
            np.zeros(1, np.float32),
        )

    @classmethod
    def constant(cls, chance: float) -> Network:
        """Every text has the same probability."""
        blank = cls.fresh()
        for weights in blank.parts():
            weights[...] = 0
        blank.outer_bias[0] = np.log(chance / (1 - chance))
        return blank

    def parts(self) -> list[np.ndarray]:
        return [self.taps, self.bias, self.inner, self.inner_bias, self.outer, self.outer_bias]

    def chances(self, pooled: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        """Probability of each document from its chunks' maxima; ``chunks`` counts the chunks of each document."""
        units = np.tanh(pooled @ self.inner + self.inner_bias)
        sums = np.zeros((len(chunks), HIDDEN), np.float64)
        some = chunks > 0
        if some.any():
            sums[some] = np.add.reduceat(units.astype(np.float64), (np.cumsum(chunks) - chunks)[some], axis=0)
        logits = sums / np.maximum(chunks, 1)[:, None] @ self.outer + self.outer_bias
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other in whole blocks, which bytes are theirs, and the blocks laid out for each.

    At least ``WIDTH`` - 1 zeros follow a text, so that no window that begins in it sees the next one.
    """
    sizes = np.diff(offsets)
    blocks = np.where(sizes > 0, -(-(sizes + WIDTH - 1) // BLOCK), 0)
    starts = (np.cumsum(blocks) - blocks) * BLOCK
    out = np.zeros(int(blocks.sum()) * BLOCK + WIDTH, np.uint8)
    real = np.zeros(len(out), bool)
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[0], offsets[-1])
    out[at] = data[offsets[0] : offsets[-1]]
    real[at] = True
    return out, real, blocks


class Scorer:
    """The network with the taps of neighbouring places added up for all pairs of bytes."""

    def __init__(self, network: Network):
        self.network = network
        taps = network.taps
        self.pairs = [(taps[k][:, None] + taps[k + 1][None]).reshape(-1, FILTERS) for k in range(0, WIDTH, 2)]
        self.pairs[0] += network.bias

    def block_maxima(self, data: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Rectified maxima of the filters over the windows that begin in each block."""
        n = len(data) // BLOCK
        out = np.zeros((n, FILTERS), np.float32)
        for at in range(0, n, PIECE):
            a, b = at * BLOCK, min(at + PIECE, n) * BLOCK
            pair = data[a : b + WIDTH - 1].astype(np.int32)
            pair = (pair[:-1] << 8) | pair[1:]
            answers = self.pairs[0][pair[: b - a]]
            for k in range(1, WIDTH // 2):
                answers += self.pairs[k][pair[2 * k : 2 * k + b - a]]
            answers[~real[a:b]] = 0
            answers = answers.reshape(-1, BLOCK, FILTERS)
            while answers.shape[1] > 1:
                half = answers.shape[1] // 2
                answers = np.maximum(answers[:, :half], answers[:, half:])
            out[at : at + PIECE] = np.maximum(answers[:, 0], 0)
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of every text, given by its bytes."""
        laid, real, blocks = laid_out(data, offsets)
        maxima = self.block_maxima(laid, real)
        # A chunk is a block and the next one of the same text; a text of one block is one chunk.
        first, own = np.cumsum(blocks) - blocks, -(-np.diff(offsets) // BLOCK)
        chunks = np.where(own > 1, own - 1, own)
        starts = np.repeat(first - (np.cumsum(chunks) - chunks), chunks) + np.arange(int(chunks.sum()))
        ends = np.minimum(starts + 1, np.repeat(first + own - 1, chunks))
        return self.network.chances(np.maximum(maxima[starts], maxima[ends]), chunks)


def chunks_of(data: np.ndarray, most: int = TRAINING_CHUNKS) -> bytes:
    """At most ``most`` chunks spread evenly over a text, each padded by zeros to two blocks and a filter's reach."""
    size = 2 * BLOCK
    n = max(-(-len(data) // BLOCK) - 1, 1) if len(data) else 0
    picked = np.unique(np.linspace(0, n - 1, min(n, most)).astype(np.int64)) if n else []
    return b"".join(bytes(data[k * BLOCK : k * BLOCK + size]).ljust(size, b"\0") for k in picked)


def fitted(chunks: list[bytes], quality: list[int], rounds: int = 10, batch: int = 64, seed: int = 7) -> Network:
    """A network from the chunks of some texts and their labels (0 or 1), by gradient steps (Adam).

    With one label only, every text gets that label's smoothed share; with none, one half.
    """
    n, good = len(quality), sum(quality)
    if good in (0, n):
        return Network.constant((good + 1) / (n + 2))
    random = np.random.default_rng(seed)
    network = Network.fresh(seed)
    size = 2 * BLOCK
    rows = [np.frombuffer(c, np.uint8).reshape(-1, size) for c in chunks]
    y_all = np.array(quality, np.float32)
    # Either label weighs the same, whatever its share of the sample.
    weight = np.where(y_all > 0, 0.5 / good, 0.5 / (n - good)).astype(np.float32) * n
    mean = [np.zeros_like(p) for p in network.parts()]
    square = [np.zeros_like(p) for p in network.parts()]
    step, places = 0, size - WIDTH + 1
    for turn in range(rounds):
        order = random.permutation(n)
        for at in range(0, n, batch):
            picked = order[at : at + batch]
            counts = np.array([len(rows[i]) for i in picked])
            x = np.concatenate([rows[i] for i in picked])
            owner = np.repeat(np.arange(len(picked)), counts)
            m = len(x)
            # Texts shorter than their chunk end in zeros, which windows may see but not begin in.
            answers = network.taps[0][x[:, :places]]
            for k in range(1, WIDTH):
                answers += network.taps[k][x[:, k : k + places]]
            answers[x[:, :places] == 0] = -np.inf
            where = answers.argmax(1)
            top = np.take_along_axis(answers, where[:, None], 1)[:, 0] + network.bias
            pooled = np.maximum(top, 0)
            units = np.tanh(pooled @ network.inner + network.inner_bias)
            share = (1 / np.maximum(counts, 1)).astype(np.float32)
            means = np.zeros((len(picked), HIDDEN), np.float32)
            np.add.at(means, owner, units)
            means *= share[:, None]
            chance = 1 / (1 + np.exp(-np.clip(means @ network.outer + network.outer_bias, -30, 30)))
            wrong = (chance - y_all[picked]) * weight[picked] / len(picked)
            d_units = (wrong[:, None] * network.outer * share[:, None])[owner] * (1 - units**2)
            d_pooled = d_units @ network.inner.T * (top > 0)
            d_taps = np.zeros_like(network.taps)
            line = np.broadcast_to(np.arange(m)[:, None], where.shape)
            column = np.broadcast_to(np.arange(FILTERS), where.shape)
            for k in range(WIDTH):
                cell = x[line, where + k].astype(np.int64) * FILTERS + column
                d_taps[k] = np.bincount(cell.ravel(), d_pooled.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            slopes = [
                d_taps, d_pooled.sum(0), pooled.T @ d_units, d_units.sum(0), means.T @ wrong, np.array([wrong.sum()], np.float32)
            ]
            step += 1
            rate = 0.01 * (1 - turn / rounds)
            for p, slope, a, b in zip(network.parts(), slopes, mean, square):
                slope = slope.astype(np.float32) + 1e-5 * p
                a += 0.1 * (slope - a)
                b += 0.01 * (slope * slope - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-7)
    return network


def trained(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = TRAINING_DOCUMENTS
) -> Network:
    """The network for ``docs``, fitted on at most ``limit`` of the documents that ``labels`` (doc_id, quality) covers.

    The sample has the smallest hashes of the id, half of it from either quality where there are enough.  Rows without
    an id or a quality are not used; of several labels of an id the smallest counts, and of several texts the one with
    the smallest hash.  At most ``TRAINING_CHUNKS`` chunks of each reach the driver, and the id goes no further.
    """
    known = labels.select(F.col("doc_id"), F.col("quality")).where("quality is not null and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("quality = 0").orderBy(*order).limit(limit // 2)
    sample = sample.unionByName(known.where("quality <> 0").orderBy(*order).limit(limit - limit // 2))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"))
    # At most `limit` rows of two numbers.
    rows = rows.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", F.xxhash64("text").alias("mark"), "text")
    schema = T.StructType(rows.schema.fields[:-1]).add("chunks", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.column_bytes(batch.column(3))
            out = [chunks_of(data[offsets[i] : offsets[i + 1]]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary())], names=schema.names)

    first = F.min(F.struct("mark", "chunks")).alias("first")
    found = rows.mapInArrow(run, schema).groupBy("doc_id", "quality").agg(first).collect()
    found.sort(key=lambda r: r.doc_id)
    return fitted([bytes(r.first.chunks) for r in found], [int(r.quality != 0) for r in found])


def scored(docs: DataFrame, network: Network, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality of the whole ``text``, rounded to six digits.

    A null or empty text has no chunks and gets the network's probability of one without any.  A column of that name
    is replaced; all others and repeated rows pass through, and equal texts get equal scores.
    """
    kept = [c for c in docs.columns if c != name]
    source = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType(source.schema.fields[:-1]).add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(network)
        for whole in batches:
            data, offsets = words.column_bytes(whole.column(len(kept)))
            for i, j in words.row_groups(offsets):
                found = scorer.scores(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                batch = whole.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.round(found, 6))], names=schema.names)

    return source.mapInArrow(run, schema)
