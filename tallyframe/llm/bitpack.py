"""Token ids of a corpus in bit-packed files: every id takes the minimum number of bits that the vocabulary needs.

One *segment* is a self-contained byte string: a header, the byte offsets of its blocks and the packed blocks.
Any run of ids is read by unpacking only the blocks that it touches.  Segments are kept as rows of a Parquet table
next to their document index, so Spark's commit protocol covers them and any file system that Spark reaches holds
them: ``shard`` and ``segment`` order them, ``first`` counts the ids before it in its shard, ``doc_ids`` and ``lengths`` tell whose ids they hold, ``payload`` is the
byte string.

Segment layout, little-endian: ``TIDP``, version (u16), bits (u16), ids per block (u32), number of ids (u64), number
of blocks (u32), then for each block its offset from the end of the header (u64), then the blocks.  64 ids take
``bits`` 64-bit words; the last block is padded with zeros to a multiple of 64 ids.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.bpe import WHITE
from tallyframe.llm.store import new_folder
from tallyframe.llm.text import PIECE, column_bytes, row_groups

BLOCK = 4096
#: A segment is closed once it holds this many ids; it always holds whole documents.
SEGMENT_IDS = 1 << 20
_HEADER = struct.Struct("<4sHHIQI")
_GAP = f"[{WHITE}]"


def id_bits(vocabulary_size: int) -> int:
    """Bits that ids below ``vocabulary_size`` need."""
    return max(1, (vocabulary_size - 1).bit_length())


def _pack(ids: np.ndarray, bits: int) -> np.ndarray:
    lanes = np.zeros(-(-len(ids) // 64) * 64, np.uint64)
    lanes[: len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.reshape(-1, 64).T)
    out = np.zeros((bits, lanes.shape[1]), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        out[word] |= lanes[k] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, bits: int) -> np.ndarray:
    words = np.ascontiguousarray(words.reshape(-1, bits).T)
    out = np.empty((64, words.shape[1]), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        out[k] = value & mask
    return np.ascontiguousarray(out.T).reshape(-1)


def write_segment(ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    """The byte string that holds ``ids``; ``block`` is a multiple of 64."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError("an id needs more bits")
    count = -(-len(ids) // block)
    offsets = np.arange(count, dtype="<u8") * np.uint64(block * bits // 8)
    head = _HEADER.pack(b"TIDP", 1, bits, block, len(ids), count)
    return head + offsets.tobytes() + _pack(ids, bits).astype("<u8").tobytes()


class Segment:
    """Random access to the ids of one segment."""

    def __init__(self, payload: bytes):
        mark, version, self.bits, self.block, self.length, count = _HEADER.unpack_from(payload)
        if mark != b"TIDP" or version != 1:
            raise ValueError("not a segment of packed ids")
        self._payload = payload
        self._offsets = np.frombuffer(payload, "<u8", count, _HEADER.size)
        self._base = _HEADER.size + 8 * count

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on, as unsigned 32-bit integers."""
        if start < 0 or n < 0 or start + n > self.length:
            raise IndexError("outside the segment")
        if not n:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (start + n - 1) // self.block
        begin = self._base + int(self._offsets[first])
        end = self._base + int(self._offsets[last + 1]) if last + 1 < len(self._offsets) else len(self._payload)
        ids = _unpack(np.frombuffer(self._payload, "<u8", (end - begin) // 8, begin), self.bits)
        return ids[start - first * self.block :][:n]

    def read_all(self) -> np.ndarray:
        return self.read(0, self.length)


_NOTHING = np.zeros(0, np.int64)

# What the split of byte-level vocabularies treats alike in every version of Unicode, as classes of bytes;
# the apostrophe of contractions and everything beyond Latin-1 letters are left out.
_OTHER, _LETTER, _DIGIT, _MARK, _BLANK, _SPACE = range(6)
_CLASS = np.zeros(256, np.uint8)
for _kind, _codes in (
    (_LETTER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    (_DIGIT, b"0123456789"),
    (_MARK, b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"),
    (_BLANK, b"\t\n\x0b\x0c\r"),
    (_SPACE, b" "),
):
    _CLASS[list(_codes)] = _kind
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_WIDE = WHITE[WHITE.index("\x85") :]
#: Runs of white space that are more than the bytes of one class each.
_WIDE_RUNS = f"[{WHITE}][{_WIDE}]|[{_WIDE}][{WHITE}]"


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces begin that the split of byte-level vocabularies makes of the rows of ``data``.

    Runs of letters, digits or marks take a space in front of them along.  Of a run of white space in front of something
    else the last character stands alone, or is that space.  What stands between white space stays one piece if it has
    any other character; rows with a match of :data:`_WIDE_RUNS` are not for this function.
    """
    if not len(data):
        return _NOTHING
    kinds = _CLASS[data]
    lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF, letters but for the signs of multiplication and division
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kinds[lead] = kinds[lead + 1] = _LETTER
    rows = np.zeros(len(data) + 1, bool)
    rows[offsets] = True
    white = kinds >= _BLANK
    begins = rows[:-1].copy()
    begins[1:] |= white[1:] & ~white[:-1]
    begins[:-1] |= white[:-1] & ~white[1:] & ~rows[1:-1]
    begins[1:] |= ~white[1:] & (kinds[:-1] == _BLANK)
    changes = np.zeros(len(data), bool)
    changes[1:] = (kinds[1:] != kinds[:-1]) & ~white[1:] & ~white[:-1]
    other = np.flatnonzero(kinds == _OTHER)
    if len(other):
        stretches, changes = np.flatnonzero(begins), np.flatnonzero(changes)
        odd = np.zeros(len(stretches), bool)
        odd[np.searchsorted(stretches, other, "right") - 1] = True
        begins[changes[~odd[np.searchsorted(stretches, changes, "right") - 1]]] = True
    else:
        begins |= changes
    return np.flatnonzero(begins)


class LibraryEncoder:
    """Whole-text ids of a byte-level BPE of the tokenizers library, which sees each piece only once in a while.

    A byte-level BPE never joins two pieces of its split, so a text's ids are those of its pieces.  They are cut on the
    bytes of a whole column at once, Arrow numbers the distinct ones, and unknown ones go to the library, those with a
    space in one text, since each begins with the only token that starts with a space.  The ids of known pieces lie one
    after the other in one array, from which the column's ids are gathered.  Texts with special tokens or runs of rare white
    space do not divide so simply; the former go to the library whole, the latter in the pieces that a regular expression
    gives.
    """

    def __init__(self, description: str, special: list[str], limit: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(description)
        self._library.no_truncation()
        self._library.no_padding()
        self._special = special
        self._split = re.compile(f" ?[^{WHITE}]+|{_GAP}+(?![^{WHITE}])|{_GAP}+")
        size = self._library.get_vocab_size()
        self._begins = np.array([(self._library.id_to_token(i) or "").startswith("\u0120") for i in range(size)], bool)
        self._newline = np.zeros(size, bool)
        self._newline[self._library.encode("\n", add_special_tokens=False).ids] = True
        self._limit = limit
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._store, self._end = np.zeros(1 << 16, np.uint32), 0
        self._at, self._n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self._entries = 0

    def _keep(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """Add runs of ids to the store and return the number of the first of them."""
        for name, end, more in (("_store", self._end, len(ids)), ("_at", self._entries, len(lengths)), ("_n", self._entries, len(lengths))):
            if end + more > len(getattr(self, name)):
                bigger = np.zeros(2 * (end + more), getattr(self, name).dtype)
                bigger[:end] = getattr(self, name)[:end]
                setattr(self, name, bigger)
        first, last = self._entries, self._entries + len(lengths)
        self._store[self._end : self._end + len(ids)] = ids
        self._n[first:last] = lengths
        self._at[first:last] = self._end + np.cumsum(lengths) - lengths
        self._entries, self._end = last, self._end + len(ids)
        return first

    def _asked(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def _joined(self, new: list[str], between: str, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces sent as one text; ``begins`` flags the ids that tell where one begins."""
        ids = np.array(self._library.encode_batch_fast([between.join(new)], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(begins[ids])
        if between:  # what stands between the pieces is an id of its own, and none of theirs
            cuts = np.append(-1, cuts) + 1
        if len(cuts) != len(new):
            return self._asked(new)
        lengths = np.diff(np.append(cuts, len(ids) + bool(between))) - bool(between)
        return (ids[~begins[ids]] if between else ids), lengths

    def _ask(self, new: list[str]) -> None:
        """Have the library encode pieces that are not known."""
        spaced = [p for p in new if p[0] == " " and not p.isspace()]
        bare = [p for p in new if p[0] != " " or p.isspace()]
        words = [p for p in bare if _LETTERS.fullmatch(p)]
        rest = [p for p in bare if not _LETTERS.fullmatch(p)]
        for keys, ask in (
            (spaced, lambda some: self._joined(some, "", self._begins)),
            (words, lambda some: self._joined(some, "\n", self._newline)),
            (rest, self._asked),
        ):
            for at in range(0, len(keys), 1 << 14):
                some = keys[at : at + (1 << 14)]
                first = self._keep(*ask(some))
                self._known.update(zip(some, range(first, first + len(some))))

    def _numbers(self, keys: list[str]) -> np.ndarray:
        """The number of each key in the store."""
        found = np.fromiter(map(self._known.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [keys[i] for i in missing.tolist()]
            self._ask(list(dict.fromkeys(new)))
            found[missing] = np.fromiter(map(self._known.__getitem__, new), np.int64, len(new))
        return found

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the runs with these numbers, one after the other, and their lengths."""
        lengths = self._n[numbers]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self._store[np.repeat(self._at[numbers] - ends + lengths, lengths) + np.arange(total)], lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the n + 1 places between the texts; no text may be null."""
        if self._entries > self._limit or self._end > 16 * self._limit:
            self._forget()
        whole = np.zeros(len(texts), bool)
        for token in self._special:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        gaps = pc.match_substring_regex(texts, _WIDE_RUNS).to_numpy(zero_copy_only=False) & ~whole
        numbers: list[np.ndarray] = [_NOTHING] * len(texts)
        plain = np.flatnonzero(~whole & ~gaps)
        if len(plain):
            data, offsets = column_bytes(texts if len(plain) == len(texts) else texts.take(pa.array(plain)))
            begins = pieces(data, offsets)
            ends = np.searchsorted(begins, offsets)
            buffers = [None, pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data)]
            coded = pa.Array.from_buffers(pa.large_string(), len(begins), buffers).dictionary_encode()
            flat = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
            for row, i, j in zip(plain.tolist(), ends[:-1].tolist(), ends[1:].tolist()):
                numbers[row] = flat[i:j]
        for row in np.flatnonzero(gaps).tolist():
            numbers[row] = self._numbers(self._split.findall(texts[row].as_py()))
        for row in np.flatnonzero(whole).tolist():
            numbers[row] = np.array([self._keep(*self._asked([texts[row].as_py()]))])
        every = np.concatenate(numbers) if numbers else _NOTHING
        ids, lengths = self._gathered(every)
        places = np.concatenate([[0], np.cumsum(lengths)])
        return ids, places[np.concatenate([[0], np.cumsum([len(n) for n in numbers], dtype=np.int64)])]


#: Encoders of this Python worker by vocabulary: what one task has learned serves the next; their size is bounded.
_ENCODERS: dict[str, LibraryEncoder] = {}


def _encoder(description: str, special: list[str]) -> LibraryEncoder:
    key = hashlib.sha256(description.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = LibraryEncoder(description, special)
    return _ENCODERS[key]


SEGMENTS = "shard int, segment int, first bigint, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, payload binary"


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of every text, each followed by ``end_id``, to the new table ``folder`` in ascending ``doc_id``.

    ``path`` is the vocabulary file (a few MB, read on the driver).  Null text counts as empty; rows with a null id
    come first; rows that repeat an id are ordered by their text.  An empty table gives an empty folder of segments.
    The rows are dealt by ranges of ``doc_id`` and of the beginning of the text, so shard numbers follow the order and
    many rows without an id, or with one, spread; other columns are not read.
    """
    import json

    spark = docs.sparkSession
    with open(path, encoding="utf-8") as file:
        content = file.read()
    model = json.loads(content)
    special = [t["content"] for t in model["added_tokens"]]
    size = max([*model["model"]["vocab"].values(), *(t["id"] for t in model["added_tokens"]), end_id]) + 1
    bits, description = id_bits(size), spark.sparkContext.broadcast(content)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    begins = F.substring("text", 1, 64)
    ordered = rows.repartitionByRange(shards, "doc_id", begins).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, number = _encoder(description.value, special), TaskContext.get().partitionId(), 0
        names, lengths, parts, held, first = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([sum(names, [])], pa.list_(pa.int64())),
                    pa.array([np.concatenate(lengths)], pa.list_(pa.int64())),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([write_segment(ids, bits)], pa.binary()),
                ],
                names=["shard", "segment", "first", "doc_ids", "lengths", "n_ids", "payload"],
            )

        for batch in batches:
            _, offsets = column_bytes(batch.column(1))
            for i, j in row_groups(offsets, 8 * PIECE):
                ids, places = encoder.encode(batch.column(1).slice(i, j - i))
                # Every text is followed by the end id.
                sizes = np.diff(places) + 1
                ended = np.full(len(ids) + j - i, end_id, np.uint32)
                inner = np.ones(len(ended), bool)
                inner[np.cumsum(sizes) - 1] = False
                ended[inner] = ids
                names.append(batch.column(0).slice(i, j - i).to_pylist())
                lengths.append(sizes)
                parts.append(ended)
                held += len(ended)
                if held >= SEGMENT_IDS:
                    yield close()
                    names, lengths, parts, held, first, number = [], [], [], 0, first + held, number + 1
        if parts:
            yield close()

    ordered.mapInArrow(run, SEGMENTS).write.option("compression", "zstd").parquet(folder)


def read_documents(spark, folder: str) -> DataFrame:
    """One row for each document in the table ``folder``: its id, where its ids start in the whole corpus, and the ids.

    Columns: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (binary, little-endian unsigned 32-bit).
    """
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    # One row for each shard, of which there are as many as shuffle partitions: small enough to send everywhere.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("in_shard"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("in_shard").over(before), F.lit(0)).alias("shard_start"))
    located = segments.join(F.broadcast(shards), "shard").select(
        (F.col("shard_start") + F.col("first")).alias("start"), "doc_ids", "lengths", "payload"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, names, lengths, payload = (c[i].as_py() for c in batch.columns)
                local, data = np.cumsum([0, *lengths]) * 4, Segment(payload).read_all().astype("<u4").tobytes()
                for at in range(0, len(names), 1024):
                    part = range(at, min(at + 1024, len(names)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[at : at + 1024], pa.int64()),
                            pa.array(local[part.start : part.stop] // 4 + start, pa.int64()),
                            pa.array(lengths[at : at + 1024], pa.int64()),
                            pa.array([data[local[k] : local[k + 1]] for k in part], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return located.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def stored(docs: DataFrame, path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write ``docs`` with :func:`write_ids` (to a folder of its own in the shared one by default) and read them back."""
    folder = folder or new_folder(docs.sparkSession, "token-ids")
    write_ids(docs, path, folder, end_id)
    return read_documents(docs.sparkSession, folder)
