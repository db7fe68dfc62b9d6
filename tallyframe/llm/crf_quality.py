"""Document quality by labelling lines: a linear-chain conditional random field marks content and boilerplate.

The field has two states and a few features of each line.  It is trained here, on a bounded sample of labelled
documents, by gradient ascent on the likelihood with exact forward-backward sums; Viterbi decoding then labels all
lines of every document, and the words' share in content lines decides whether the document stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import text as words

#: Labelled documents that the field is fitted on, at most, and lines that such a document has, at most.
TRAINING_DOCUMENTS = 1200
TRAINING_LINES = 512
#: Least share of words in content lines.
CONTENT_SHARE = 0.5
# Phrases of notices and calls to action in the languages of the web's most frequent templates.
NOTICES = re.compile(
    r"cookie|copyright|all rights reserved|privacy policy|terms of (use|service)|subscribe|newsletter|click here"
    r"|sign (in|up)|log in|javascript|licen[sc]ed? under|share this|powered by|follow us",
    re.I,
)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#*$%&|<>")] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
FEATURES = 13
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_features(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Of the lines that have a word: their features and words; and how many of them equal an earlier line."""
    rows, counts, seen, repeats = [], [], set(), 0
    for line in text.split("\n"):
        found = _WORD.findall(line)
        if not found:
            continue
        n = len(found)
        again = line in seen
        seen.add(line)
        repeats += again
        distinct = len(set(found)) / n
        upper = line.upper() == line and line.lower() != line
        marked = sum(map(line.count, "#*$%&<>")) / n
        rows.append(
            (
                1.0,
                float(upper and n > 2),
                min(line.count("!") / n, 2.0),
                min(line.count("|") / n, 2.0),
                min(marked, 2.0),
                1.0 - distinct if n > 7 else 0.0,
                float(distinct < 0.34 and n > 7),
                float(n < 4),
                float(n > 11),
                float(line.rstrip().endswith((".", "!", "?", "…", "。"))),
                float(again),
                min(sum(map(len, found)) / n / 24, 2.0),
                float(NOTICES.search(line) is not None),
            )
        )
        counts.append(n)
    return np.array(rows, float).reshape(-1, FEATURES), np.array(counts, np.int64), repeats


@dataclass
class Field:
    """Weights of the field: state 0 is boilerplate, state 1 content."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray

    @classmethod
    def blank(cls) -> Field:
        return cls(np.zeros((2, FEATURES)), np.zeros((2, 2)), np.zeros(2))

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels of a document's lines (Viterbi); a tie is content."""
        n = len(features)
        if not n:
            return np.zeros(0, np.int64)
        scores = (features @ self.emit.T).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        bad, good = (f + s for f, s in zip(self.first.tolist(), scores[0]))
        from_good = []
        for s_bad, s_good in scores[1:]:
            a, b, c, d = bad + m00, good + m10, bad + m01, good + m11
            from_good.append((b >= a, d >= c))
            bad, good = (b if b >= a else a) + s_bad, (d if d >= c else c) + s_good
        out = [int(good >= bad)]
        for step in reversed(from_good):
            out.append(int(step[out[-1]]))
        return np.array(out[::-1])

    def marginals(self, features: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chances of the states (n, t, 2) and of the moves into each place (n, t, 2, 2) of padded sequences."""
        n, t, _ = features.shape
        scores = features @ self.emit.T
        ahead, back = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        ahead[:, 0] = scores[:, 0] + self.first
        for k in range(1, t):
            step = np.logaddexp.reduce(ahead[:, k - 1, :, None] + self.move, axis=1) + scores[:, k]
            ahead[:, k] = np.where(real[:, k, None], step, ahead[:, k - 1])
        for k in range(t - 2, -1, -1):
            step = np.logaddexp.reduce(self.move + (scores[:, k + 1] + back[:, k + 1])[:, None, :], axis=2)
            back[:, k] = np.where(real[:, k + 1, None], step, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        state = np.exp(ahead + back - total[:, None, None]) * real[:, :, None]
        move = np.zeros((n, t, 2, 2))
        inner = ahead[:, :-1, :, None] + self.move + (scores[:, 1:] + back[:, 1:])[:, :, None, :]
        move[:, 1:] = np.exp(inner - total[:, None, None, None]) * real[:, 1:, None, None]
        return state, move


def _padded(documents: list[np.ndarray], labels: list[np.ndarray], width: int = 32):
    """Documents cut into sequences of at most ``width`` lines, padded to equal length."""
    cuts = [(d[i : i + width], y[i : i + width]) for d, y in zip(documents, labels) for i in range(0, len(d), width)]
    features, state = np.zeros((len(cuts), width, FEATURES)), np.zeros((len(cuts), width, 2))
    real = np.zeros((len(cuts), width), bool)
    for k, (d, y) in enumerate(cuts):
        features[k, : len(d)], real[k, : len(d)] = d, True
        state[k, np.arange(len(d)), y] = 1.0
    return features, state, real


def fitted(documents: list[np.ndarray], quality: list[int], rounds: int = 3, steps: int = 40) -> Field:
    """A field that tells the lines of good documents from the junk of bad ones.

    Only documents are labelled.  All lines of good ones are content; those of a bad one begin as boilerplate, and
    after each round the lines that look like content become it, except for the one that looks least like it.
    With no bad or no good document the field stays blank and calls every line content.
    """
    field = Field.blank()
    labels = [np.full(len(d), int(q), np.int64) for d, q in zip(documents, quality)]
    if len(set(quality)) < 2 or not sum(map(len, documents)):
        return field
    for _ in range(rounds):
        features, state, real = _padded(documents, labels)
        moves = np.einsum("nti,ntj->ij", state[:, :-1], state[:, 1:])
        wanted = np.concatenate([np.einsum("nts,ntf->sf", state, features).ravel(), moves.ravel(), state[:, 0].sum(0)])
        weights = np.concatenate([field.emit.ravel(), field.move.ravel(), field.first])
        size, mean, square = max(int(real.sum()), 1), np.zeros(len(weights)), np.zeros(len(weights))
        for step in range(1, steps + 1):
            field = Field(weights[: 2 * FEATURES].reshape(2, -1), weights[-6:-2].reshape(2, 2), weights[-2:])
            at, into = field.marginals(features, real)
            expected = np.concatenate([np.einsum("nts,ntf->sf", at, features).ravel(), into.sum((0, 1)).ravel(), at[:, 0].sum(0)])
            slope = (wanted - expected) / size - 1e-4 * weights
            mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
            weights = weights + 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        field = Field(weights[: 2 * FEATURES].reshape(2, -1), weights[-6:-2].reshape(2, 2), weights[-2:])
        for k, (d, q) in enumerate(zip(documents, quality)):
            if not q and len(d):
                now = field.decode(d)
                now[np.argmin(d @ (field.emit[1] - field.emit[0]))] = 0
                labels[k] = now
    return field


def trained(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = TRAINING_DOCUMENTS) -> Field:
    """The field for ``docs``, fitted on at most ``limit`` of the documents that ``labels`` (doc_id, quality) covers.

    The sample has the smallest hashes of the id, half of it from either quality where there are enough; only its line
    features reach the driver, and documents of more than ``TRAINING_LINES`` lines are passed over.  An id on several rows
    stands for the text with the smallest hash, chosen before any features are made.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("quality = 0").orderBy(*order).limit(limit // 2)
    sample = sample.unionByName(known.where("quality <> 0").orderBy(*order).limit(limit - limit // 2))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    # At most `limit` rows of two numbers.
    rows = rows.join(F.broadcast(sample), "doc_id").withColumn("mark", F.xxhash64("text"))
    # One hash for each id and task is dealt out, and then one text for each id.
    first = rows.groupBy("doc_id").agg(F.min("mark").alias("mark"))
    rows = rows.join(F.broadcast(first), ["doc_id", "mark"]).groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(2).to_pylist():
                found = line_features(t)[0] if t and t.count("\n") < TRAINING_LINES else np.zeros((0, FEATURES))
                out.append(found.ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int32()), pa.array(out, pa.list_(pa.float64()))],
                names=["doc_id", "quality", "features"],
            )

    found = rows.mapInArrow(run, "doc_id bigint, quality int, features array<double>").collect()
    found = sorted(((r.doc_id, r.features, int(r.quality != 0)) for r in found))
    return fitted([np.array(f).reshape(-1, FEATURES) for _, f, _ in found], [q for *_, q in found])


def _repeated_words(windows: np.ndarray, n: int) -> int:
    """Of ``n`` words, those in a 3-word window that occurs more than once."""
    if n < 3:
        return 0
    values = np.sort(windows)
    if (values[1:] != values[:-1]).all():
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def judged(docs: DataFrame, field: Field, text: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """``docs`` with the statistics of the whole ``text`` and the verdict.

    Adds ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``content_words`` (words in lines decoded as content), ``base_failed`` (under 50 words, or more than half of them
    in repeated 3-word windows) and ``kept``.  Null text counts as empty, has no words and fails.  Columns of these
    names are replaced; all others and repeated rows pass through.
    """
    added = [*STATISTICS, "content_words", "base_failed", "kept"]
    kept = [c for c in docs.columns if c not in added]
    source = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType(source.schema.fields[:-1])
    for name in [*STATISTICS, "content_words"]:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("kept", "boolean")

    def statistics(column: pa.Array) -> Iterator[tuple[int, ...]]:
        data, offsets = words.column_bytes(column)
        texts = column.to_pylist()
        for i, j in words.row_groups(offsets):
            piece, part = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            starts, ends, first = words.word_spans(piece, part)
            windows = words.windows(words.span_hashes(piece, starts, ends), 3)
            in_words = ((piece & 0xC0) != 0x80) & ~_SEPARATOR[piece]
            marks = _MARKS[piece]
            for k in range(j - i):
                a, b, s, e = first[k], first[k + 1], part[k], part[k + 1]
                n = int(b - a)
                features, counts, repeats = line_features(texts[i + k] or "")
                good = int(counts[field.decode(features) == 1].sum())
                again = _repeated_words(windows[a : max(b - 2, a)], n)
                failed = n < 50 or 100 * again > 50 * n
                stays = not failed and good >= share * n
                yield n, np.count_nonzero(in_words[s:e]), np.count_nonzero(marks[s:e]), repeats, again, good, failed, stays

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 6 + [pa.bool_()] * 2
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                columns = list(zip(*statistics(batch.column(len(kept))))) or [()] * 8
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *(pa.array(c, t) for c, t in zip(columns, types))], names=[*kept, *added]
                )

    return source.mapInArrow(run, schema)
