"""Byte-pair encoding and decoding with a given vocabulary, in Arrow batches.

A word is encoded on a contiguous array of parts with the ranks of adjacent pairs beside it: the lowest rank (leftmost
on a tie) is found by a scan, its boundary is deleted and the two neighbouring ranks are refreshed.  That is quadratic
in the parts of a word, which is best for short ones; from :data:`LONG` parts on, the same merges in the same order
come from a heap over a linked list.  Words repeat, so each task keeps the ids of the words it met in a table of
bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of this many bytes and more are merged with a heap.
LONG = 64
#: Words, and stretches between spaces, that a task remembers at least once it met so many.
REMEMBERED = 200_000
_ID_BITS = 32
_ID = (1 << _ID_BITS) - 1
_NONE = 1 << 62
# The white space of Unicode, the special tokens' ids come from the vocabulary file.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the others take the code points from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _class_of(kind: str, top: int) -> str:
    """The characters up to ``top`` whose Unicode category starts with ``kind``, as ranges of a regular expression."""
    out, start = [], None
    for code in range(top + 2):
        inside = code <= top and unicodedata.category(chr(code))[0] == kind
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(out)


def _pattern(top: int) -> re.Pattern[str]:
    letters, numbers = _class_of("L", top), _class_of("N", top)
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{WHITE}{letters}{numbers}]+")


class Remembered:
    """A table of at most twice ``limit`` entries: a full one is set aside, and what is asked for again comes back."""

    def __init__(self, limit: int):
        self.limit = limit
        self.recent: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        found = self.recent.get(key)
        if found is None and (found := self._older.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        self.turn()
        self.recent[key] = value

    def full(self) -> bool:
        return len(self.recent) >= self.limit

    def turn(self) -> None:
        if self.full():
            self._older, self.recent = self.recent, {}

    def missing(self, keys: set[str]) -> list[str]:
        """Which of ``keys`` are unknown; those set aside come back, without turning."""
        out = []
        for key in keys - self.recent.keys():
            if (found := self._older.get(key)) is None:
                out.append(key)
            else:
                self.recent[key] = found
        return out


class WordBpe:
    """A lower-casing BPE with word ends: normalises, splits and merges like its vocabulary file says.

    ``description`` is the text of a tokenizers JSON file with NFC, white space runs as one space, lower case, the
    split into contractions, letter runs, single digits and other runs, and ``</w>`` after a word's last symbol.
    """

    def __init__(self, description: str):
        model = json.loads(description)
        vocabulary = model["model"]["vocab"]
        suffix = model["model"].get("end_of_word_suffix") or ""
        # For a pair of adjacent ids: the rank of its merge above the id it gives, in one integer.
        self.pairs = {}
        for rank, merge in enumerate(model["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocabulary[a], vocabulary[b]] = rank << _ID_BITS | vocabulary[a + b]
        symbols = byte_symbols()
        self.inner = [vocabulary.get(s) for s in symbols]
        self.final = [vocabulary.get(s + suffix) for s in symbols]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()], default=-1) + 1
        self.tokens = [""] * size
        for token, i in [*vocabulary.items(), *self.special.items()]:
            self.tokens[i] = token
        self._split_special = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        self._ascii, self._low, self._all = _pattern(0x7F), _pattern(0xFFFF), None
        self._white = re.compile(f"[{WHITE}]+")
        self._known, self._stretches = Remembered(REMEMBERED), Remembered(REMEMBERED)
        self._token_array = pa.array(self.tokens, pa.string())

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        parts = [i for i in (*map(self.inner.__getitem__, word[:-1]), self.final[word[-1]]) if i is not None] if word else []
        return self._merge_long(parts) if len(parts) >= LONG else self._merge_short(parts)

    def _merge_short(self, parts: list[int]) -> list[int]:
        look = self.pairs.get
        ranks = [look(p, _NONE) for p in zip(parts, parts[1:])]
        while ranks and (lowest := min(ranks)) != _NONE:
            i = ranks.index(lowest)
            parts[i] = lowest & _ID
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = look((parts[i - 1], parts[i]), _NONE)
            if i < len(ranks):
                ranks[i] = look((parts[i], parts[i + 1]), _NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        gone = bytearray(n)
        look = self.pairs.get
        heap = [(r, i, p[0], p[1]) for i, p in enumerate(zip(parts, parts[1:])) if (r := look(p)) is not None]
        heapq.heapify(heap)

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (r := look((parts[i], parts[j]))) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

        while heap:
            lowest, i, a, b = heapq.heappop(heap)
            if gone[i] or parts[i] != a or (j := after[i]) >= n or parts[j] != b:
                continue
            parts[i] = lowest & _ID
            gone[j] = 1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p, g in zip(parts, gone) if not g]

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if text.isascii():
            return self._ascii.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        text = self._white.sub(" ", text)
        # Character by character: a capital sigma gives the plain small one at the end of a word too.
        text = text.replace("Σ", "σ").lower()
        if not text or max(text) <= "￿":
            return self._low.findall(text)
        self._all = self._all or _pattern(sys.maxunicode)
        return self._all.findall(text)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text as unsigned 32-bit integers."""
        return np.frombuffer(self._encoded(text), "<u4")

    def _encoded(self, text: str) -> bytes:
        out, at = [], 0
        for found in self._split_special.finditer(text):
            out += self._pieces(text[at : found.start()])
            out.append(self.special[found[0]].to_bytes(4, "little"))
            at = found.end()
        out += self._pieces(text[at:] if at else text)
        return b"".join(out)

    def _pieces(self, text: str) -> list[bytes]:
        """Ids of the stretches between spaces: a space always parts words, and the rules see nothing across it."""
        stretches = text.split(" ")
        out = list(map(self._stretches.recent.get, stretches))
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    out[i] = self._stretches.get(stretches[i]) or self._stretch(stretches[i])
        return out

    def _stretch(self, stretch: str) -> bytes:
        out = []
        for word in self.words(stretch):
            ids = self._known.get(word)
            if ids is None:
                ids = array("I", self.merge(word.encode())).tobytes()
                if len(word) < LONG:
                    self._known.put(word, ids)
            out.append(ids)
        ids = b"".join(out)
        if len(stretch) < LONG:
            self._stretches.put(stretch, ids)
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids, joined by spaces: the vocabulary names no other decoder."""
        return self.decode_rows([ids.astype("<u4").tobytes()])[0].as_py()

    def decode_rows(self, rows: list[bytes]) -> pa.Array:
        """The decoded text of each row of packed ids."""
        ends = np.cumsum([0, *(len(r) // 4 for r in rows)])
        ids = pa.array(np.frombuffer(b"".join(rows), "<u4"))
        tokens = self._token_array.take(ids)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens), " ")


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``text`` (binary, little-endian unsigned 32-bit) in the column ``ids``.

    Null text counts as empty and gives no ids.  ``decoded`` names a column for the text that the ids decode to.
    Existing columns of those names are replaced; all others, repeated rows included, pass through unchanged.
    ``path`` is a vocabulary file, read once on the driver and sent to the tasks (a few MB, fixed).
    """
    with open(path, encoding="utf-8") as file:
        description = docs.sparkSession.sparkContext.broadcast(file.read())
    new = [c for c in (ids, decoded) if c]
    kept = [c for c in docs.columns if c not in new]
    source = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("__text"))
    schema = docs.select(*(F.col(f"`{c}`") for c in kept)).schema.add(ids, "binary")
    if decoded:
        schema = schema.add(decoded, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(description.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = [bpe._encoded(t or "") for t in batch.column(len(kept)).to_pylist()]
                columns = [*batch.columns[: len(kept)], pa.array(rows, pa.binary())]
                if decoded:
                    columns.append(bpe.decode_rows(rows))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

    return source.mapInArrow(run, schema)
