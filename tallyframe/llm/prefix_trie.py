"""The prefix trie of conversations: one node per distinct sequence of first turns, in minimal-perfect-hash tables.

Turns are sorted by conversation over all partitions, so that a conversation of any length spreads; what a partition
must know of the ones before it are a few numbers.  Every prefix gets a digest of 128 bits.  Distinct digests are the
nodes; they are dealt into shards by the highest prefix above them that few conversations share, so that nearly all
parents are in the shard of their children.  In a shard a minimal perfect hash gives every digest a slot, verified
against the digest kept there; counts lie in flat arrays by slot, and sums move from the deepest nodes up through the
array of parent slots.  What leaves a shard is added up per parent and enters the next one: first the shards of deep
bands, then those above, and the crown of widely shared prefixes, whose number is bounded, last.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.store import written
from tallyframe.llm.text import mix64

#: A prefix that more conversations share belongs to the crown; for large inputs, so many that the crown stays bounded.
SHARED = 4096
CROWN = 200_000
#: Nodes of a shard, about, and the depth of the bands that long shared stretches are cut into.
SHARD = 1 << 16
BAND = 256

_MASK = 2**64 - 1
# Odd numbers, whose powers modulo 2**64 are the weights of the places in the two digests.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_INVERSES = tuple(pow(b, -1, 2**64) for b in _BASES)
_NONE = hashlib.sha256(b"").hexdigest()


class MinimalPerfectHash:
    """Slots 0 .. n - 1 for n distinct digests of two 64-bit words.

    Digests that are alone at their place of a level get that place; the others go on to the next level.  The slot is
    the number of taken places before it.  A digest that is not in the table is recognised, since the digest of every
    slot is kept and compared.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.high, self.low = np.empty_like(high), np.empty_like(low)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, before = np.arange(len(high)), 0
        while len(left):
            if len(self.levels) > 60:
                raise ValueError("equal digests in one table")
            place = self._place(high[left], low[left], len(self.levels), 2 * len(left))
            alone = np.bincount(place, minlength=2 * len(left)) == 1
            ranks = before + np.cumsum(alone) - alone
            self.levels.append((alone, ranks))
            mine = alone[place]
            slots = ranks[place[mine]]
            self.high[slots], self.low[slots] = high[left[mine]], low[left[mine]]
            before, left = before + int(alone.sum()), left[~mine]

    @staticmethod
    def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(high + mix64(low + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for digests that are not in the table."""
        out = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, (alone, ranks) in enumerate(self.levels):
            place = self._place(high[left], low[left], level, len(alone))
            mine = alone[place]
            out[left[mine]] = ranks[place[mine]]
            left = left[~mine]
        found = np.flatnonzero(out >= 0)
        wrong = (self.high[out[found]] != high[found]) | (self.low[out[found]] != low[found])
        out[found[wrong]] = -1
        return out


def borrowed(conv_id: int, block: int, heads: int) -> int:
    """How many first turns a conversation takes from the first one of its block; that one itself takes none."""
    return zlib.crc32(str(conv_id).encode()) % heads if heads > 1 and conv_id != block else 0


@dataclass(frozen=True)
class Seen:
    """What is known after some of the sorted turns: of the last conversation and of its block's first conversation.

    ``head`` and ``base`` hold (digest a, digest b, code points) of at most ``heads`` - 1 first turns.
    """

    conv: int | None = None
    count: int = 0
    sums: tuple[int, int] = (0, 0)
    head: tuple = ()
    block: int | None = None
    base: tuple = ()

    def then(self, part: Seen, one_conversation: bool, one_block: bool, heads: int) -> Seen:
        """Known after a further partition that ends in ``part`` and may hold nothing but one conversation or block."""
        out = part
        if one_conversation and part.conv == self.conv:
            sums = tuple((s + pow(b, self.count, 2**64) * t) & _MASK for b, s, t in zip(_BASES, self.sums, part.sums))
            out = replace(out, count=self.count + part.count, sums=sums, head=(self.head + part.head)[: max(heads - 1, 0)])
        if one_block and part.block == self.block:
            out = replace(out, base=(self.base + part.base)[: max(heads - 1, 0)])
        return out


def _weighted(values: np.ndarray, base: int, first: int) -> np.ndarray:
    """values[i] * base ** (first + i) modulo 2**64."""
    powers = np.full(len(values), base, np.uint64)
    if len(powers):
        powers[0] = pow(base, first, 2**64)
    return values.view(np.uint64) * np.multiply.accumulate(powers)


_PIECE = (
    "pid int, conv_id bigint, block bigint, a array<bigint>, b array<bigint>, chars array<bigint>, start bigint, sum_a bigint,"
    " sum_b bigint, head array<bigint>, base array<bigint>, first_conv bigint, first_block bigint, ended boolean, final boolean,"
    " after_a bigint, after_b bigint, after bigint, after_head array<bigint>, after_base array<bigint>"
)


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _flat(turns: tuple) -> list[int]:
    return [x for turn in turns for x in turn]


def _turns(flat) -> tuple:
    return tuple(tuple(flat[i : i + 3]) for i in range(0, len(flat), 3))


def _pieces(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, block: int, heads: int) -> DataFrame:
    """Runs of turns of one conversation in order, with what their partition knows of the turns before them."""
    conv, said = F.col(f"`{conv_id}`").cast("bigint"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    who = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    rows = conversations.where(conv.isNotNull()).select(
        (conv - conv % block).alias("block"),
        conv.alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.xxhash64(F.lit(1), who, said).alias("a"),
        F.xxhash64(F.lit(2), said, who).alias("b"),
        F.char_length(said).cast("bigint").alias("chars"),
    )
    # The number at random only parts rows that are equal in every respect, of which there may be very many.
    order = ["block", F.col("conv_id") != F.col("block"), "conv_id", F.col("turn").asc_nulls_first(), "a", "b", "salt"]
    rows = rows.withColumn("salt", F.rand(5)).repartitionByRange(*order).sortWithinPartitions(*order[:-1])
    keep = max(heads - 1, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        seen, first, held = Seen(), None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            convs, blocks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            a, b, chars = (batch.column(k).to_numpy() for k in (2, 3, 4))
            cuts = np.append(np.flatnonzero(np.diff(convs, prepend=convs[0] ^ 1)), len(convs)).tolist()
            for i, j in zip(cuts, cuts[1:]):
                c, g = int(convs[i]), int(blocks[i])
                first = first or (c, g)
                if g != seen.block:
                    seen = Seen(block=g)
                if c != seen.conv:
                    seen = Seen(conv=c, block=g, base=seen.base)
                    if held:
                        held[-1][13] = True
                top = min(j, i + keep - len(seen.head))
                head = seen.head + tuple(zip(a[i:top].tolist(), b[i:top].tolist(), chars[i:top].tolist()))
                sums = tuple(
                    (s + int(_weighted(v[i:j], base, seen.count + 1).sum())) & _MASK for s, v, base in zip(seen.sums, (a, b), _BASES)
                )
                now = replace(seen, count=seen.count + j - i, sums=sums, head=head, base=head if c == g else seen.base)
                held.append(
                    [pid, c, g, a[i:j].tolist(), b[i:j].tolist(), chars[i:j].tolist(), seen.count, *map(_signed, seen.sums)]
                    + [_flat(head), _flat(now.base), *first, False, False, *map(_signed, sums), now.count, _flat(head), _flat(now.base)]
                )
                seen = now
            yield from emitted(held[:-1])
            held = held[-1:]
        if held:
            # Whether the conversation ends here depends on the next partition.
            held[-1][13] = held[-1][14] = True
            yield from emitted(held)

    schema = pa.schema(
        [
            (name, {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}.get(kind, pa.list_(pa.int64())))
            for name, kind in (part.split() for part in _PIECE.split(","))
        ]
    )

    def emitted(rows: list[list]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return written(rows.select("conv_id", "block", "a", "b", "chars").mapInArrow(run, _PIECE), "turns")


def _carried(pieces: DataFrame, heads: int) -> tuple[dict[int, Seen], dict[int, int]]:
    """What is known before each partition, and the conversation that begins the next one: a few numbers for each."""
    names = "pid, conv_id, block, first_conv, first_block, after, after_a, after_b, after_head, after_base".split(", ")
    ends = sorted(pieces.where("final").select(*names).collect(), key=lambda r: r.pid)
    before, following, seen = {}, {}, Seen()
    for end, after in zip(ends, [*ends[1:], None]):
        before[end.pid] = seen
        part = Seen(end.conv_id, end.after, (end.after_a & _MASK, end.after_b & _MASK), _turns(end.after_head), end.block, _turns(end.after_base))
        seen = seen.then(part, end.first_conv == end.conv_id, end.first_block == end.block, heads)
        if after is not None:
            following[end.pid] = after.first_conv
    return before, following


_PREFIX = "d1 bigint, d2 bigint, p1 bigint, p2 bigint, depth bigint, conv_id bigint, chars bigint, members bigint, ends bigint"


def _prefixes(pieces: DataFrame, heads: int) -> DataFrame:
    """One row per conversation and prefix of it; ``ends`` marks the whole conversation.

    Where that is a prefix that an earlier piece stands for, a row that counts no member marks it.
    """
    before, following = _carried(pieces, heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [prefixes(row) for row in batch.to_pylist()]
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                names = [part.split()[0] for part in _PREFIX.split(",")]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64, copy=False)) for c in columns], names=names)

    def prefixes(row: dict) -> tuple[np.ndarray, ...]:
        conv, block, start, known = row["conv_id"], row["block"], row["start"], before[row["pid"]]
        sums, head, base = (row["sum_a"] & _MASK, row["sum_b"] & _MASK), _turns(row["head"]), _turns(row["base"])
        if row["first_conv"] == conv and known.conv == conv:
            sums = tuple((s + pow(b, known.count, 2**64) * t) & _MASK for b, s, t in zip(_BASES, known.sums, sums))
            head, start = (known.head + head)[: max(heads - 1, 0)], start + known.count
        if row["first_block"] == block and known.block == block:
            base = (known.base + base)[: max(heads - 1, 0)]
        h = borrowed(conv, block, heads)
        taken = base[:h] if h else ()
        shift, n = h - len(taken), len(row["a"])
        skip = min(max(h - start, 0), n)
        ended = row["ended"] and following.get(row["pid"]) != conv if row["final"] else row["ended"]
        digests, above = [], []
        for k, (name, root, inverse) in enumerate(zip("ab", _BASES, _INVERSES)):
            # Places 1 .. len(taken) come from the block's first conversation, the following ones from here.
            lead = np.array([t[k] for t in taken], np.int64)
            lead = np.cumsum(_weighted(lead, root, 1)) if len(lead) else np.zeros(0, np.uint64)
            at_lead = int(lead[-1]) if len(lead) else 0
            own = np.array(row[name][skip:], np.int64)
            place = start + skip + 1
            skipped = sum(t[k] * pow(root, p + 1, 2**64) for p, t in enumerate(head[:h]))
            behind = (at_lead + pow(inverse, shift, 2**64) * (sums[k] - skipped)) & _MASK if start + skip > h else at_lead
            own = np.cumsum(_weighted(own, root, place - shift)) + np.uint64(behind) if len(own) else np.zeros(0, np.uint64)
            before_own = np.concatenate([np.array([behind], np.uint64), own])[:-1]
            if start == 0:
                # The root, with digest zero, is above the first place.
                digests.append(np.concatenate([np.zeros(1, np.uint64), lead, own]))
                above.append(np.concatenate([np.zeros(1, np.uint64), np.zeros(1, np.uint64), lead, own])[:-1])
            else:
                digests.append(own)
                above.append(before_own)
        chars = np.array(row["chars"][skip:], np.int64)
        depth = start + skip - shift + 1 + np.arange(len(chars))
        if start == 0:
            chars = np.concatenate([[0], [t[2] for t in taken], chars])
            depth = np.arange(len(chars))
        members, ends = np.ones(len(chars), np.int64), np.zeros(len(chars), np.int64)
        if ended and len(chars):
            ends[-1] = 1
        columns = [digests[0], digests[1], above[0], above[1], depth, chars, members, ends]
        if ended and not len(chars):
            # All turns here are replaced: the conversation ends with the last turn it has taken over.
            last, size = [0, 0], 0
            up = [0, 0]
            for p, t in enumerate(taken):
                up, size = last, t[2]
                last = [(v + x * pow(root, p + 1, 2**64)) & _MASK for v, x, root in zip(last, t, _BASES)]
            whole = [last[0], last[1], up[0], up[1], len(taken), size, 0, 1]
            columns = [np.array([x], np.uint64 if i < 4 else np.int64) for i, x in enumerate(whole)]
        columns = [c.view(np.int64) if c.dtype == np.uint64 else c for c in columns]
        return (*columns[:5], np.full(len(columns[0]), conv, np.int64), *columns[5:])

    return pieces.mapInArrow(run, _PREFIX)


_NODE = (
    "d1 bigint, d2 bigint, p1 bigint, p2 bigint, depth bigint, conv_id bigint, n_convs bigint, parent_conv_id bigint,"
    " n_children bigint, n_leaves bigint, saved_tokens bigint, inside boolean"
)


def accumulated(table: pa.Table) -> pa.Table:
    """The nodes of one shard with their children, leaves and saved tokens.

    The columns ``children``, ``leaves`` and ``saved`` are what children in other shards have sent.  ``inside`` tells
    whether the parent is in this shard.
    """
    read = lambda name: table.column(name).to_numpy()
    high, low = read("d1").view(np.uint64), read("d2").view(np.uint64)
    index = MinimalPerfectHash(high, low)
    slot = index.slots(high, low)

    def scattered(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(slot), np.int64)
        out[slot] = values
        return out

    depth, conv, members = scattered(read("depth")), scattered(read("conv_id")), scattered(read("n_convs"))
    up = index.slots(read("p1").view(np.uint64), read("p2").view(np.uint64))
    parent = np.full(len(slot), -1, np.int64)
    parent[slot] = np.where(read("depth") > 0, up, -1)
    if (depth[parent[parent >= 0]] != depth[parent >= 0] - 1).any():
        raise ValueError("two prefixes with one digest")
    # A node is childless if every conversation that has it ends with it.
    leaves = scattered(read("leaves")) + (members == scattered(read("n_ends")))
    saved = scattered(read("saved")) + (members - 1) * scattered(read("chars"))
    children = scattered(read("children"))
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order], prepend=-1))
    for i, j in zip(cuts, np.append(cuts[1:], len(order))):
        nodes = order[i:j]
        nodes = nodes[parent[nodes] >= 0]
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
        np.add.at(children, parent[nodes], 1)
    inside = parent >= 0
    above = pa.array(np.where(inside, conv[parent], 0), mask=~inside)
    given = [table.column(name) for name in ("d1", "d2", "p1", "p2", "depth", "conv_id", "n_convs")]
    sums = [pa.array(values[slot]) for values in (children, leaves, saved, inside)]
    return pa.table([*given, above.take(pa.array(slot)), *sums], names=[part.split()[0] for part in _NODE.split(",")])


def _digest_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, joined by commas, from rows sorted by node and id; none is held back whole."""
    names = ["d1", "d2", "ends_sha256"]
    key, state = None, None

    for batch in batches:
        done = []
        d1, d2, ids = (batch.column(k).to_numpy() for k in range(3))
        if not len(d1):
            continue
        fresh = np.append(True, (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]))
        cuts = [*np.flatnonzero(fresh).tolist(), len(d1)]
        for i, j in zip(cuts, cuts[1:]):
            here, text = (int(d1[i]), int(d2[i])), ",".join(map(str, ids[i:j].tolist()))
            if here == key:
                state.update(b"," + text.encode())
                continue
            if key is not None:
                done.append((*key, state.hexdigest()))
            key, state = here, hashlib.sha256(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=names)


def nodes(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block: int = 100,
    heads: int = 6,
    shared: int = SHARED,
    shard: int = SHARD,
    band: int = BAND,
) -> DataFrame:
    """The nodes of the prefix trie of ``conversations``, of which each row is a turn.

    Turns are ordered by ``turn``, nulls first; of equal ones a digest of role and text decides, so that the order is
    the same in every run, and repeated rows are repeated turns.  Null role or text is empty; rows without a
    conversation take no part, and without any row there is no node.  Conversation c is rebuilt before it enters the trie:
    its first h turns are replaced by those of conversation c - c % ``block`` (all if it has fewer, none if it is
    absent), where h is the crc32 of c in decimal modulo ``heads``; ``heads`` = 1 leaves all as they are.

    A node is a distinct sequence of (role, text) of the first ``depth`` turns; the root has none.  Per node: ``conv_id``
    (the smallest of the conversations that begin with it), ``depth``, ``parent_conv_id`` (the parent's conv_id, null for
    the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes under it, itself included), ``saved_tokens``
    (over all nodes under it, itself included: code points of the last text for every conversation but one), and
    ``ends_sha256`` of the ids of the conversations that are just this sequence, ascending and joined by commas.
    """
    spark = conversations.sparkSession
    pieces = _pieces(conversations, conv_id, turn, role, text, block, heads)
    prefixes = written(_prefixes(pieces, heads), "prefixes")
    same = ["depth", "p1", "p2", "chars"]
    found = prefixes.groupBy("d1", "d2").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("members").alias("n_convs"),
        F.sum("ends").alias("n_ends"),
        *(F.min(c).alias(c) for c in same),
        *(F.max(c).alias(f"max_{c}") for c in same),
    )
    differs = F.expr(" or ".join(f"{c} <> max_{c}" for c in same))
    found = found.withColumn("depth", F.when(differs, F.raise_error(F.lit("two prefixes with one digest")).cast("bigint")).otherwise(F.col("depth")))
    found = written(found.select("d1", "d2", "p1", "p2", "depth", "conv_id", "n_convs", "n_ends", "chars"), "nodes")
    size = found.agg(F.count(F.lit(1)).alias("n"), F.sum("n_convs").alias("rows"), F.max("depth").alias("depth")).first()
    few = max(shared, (size.rows or 0) // CROWN)
    band = max(band, -(-(size.depth or 0) // 256))
    # The crown has less than `CROWN` nodes: each of them stands for more than `few` of the rows.
    crown = found.where(F.col("n_convs") > few)
    in_crown = F.broadcast(crown.select("d1", "d2"))
    highest = (
        prefixes.where("members = 1").join(in_crown, ["d1", "d2"], "left_anti")
        .groupBy("conv_id").agg(F.min(F.struct("depth", "d1", "d2")).alias("top"))
    )
    below = F.floor((F.col("depth") - F.col("top.depth")) / band).cast("int")
    shards = max(1, size.n // shard)
    placed = (
        found.join(in_crown, ["d1", "d2"], "left_anti").join(highest, "conv_id").withColumn("band", below)
        .withColumn("shard", F.pmod(F.xxhash64("top.d1", "top.d2", "band"), F.lit(shards)).cast("int")).drop("top")
    )
    placed = written(placed, "placed")
    deepest = placed.agg(F.max("band")).first()[0]
    sent, parts = None, []
    for level in [*range(deepest if deepest is not None else -1, -1, -1), None]:
        here = crown.withColumn("shard", F.lit(0)) if level is None else placed.where(F.col("band") == level).drop("band")
        if sent is None:
            here = here.withColumns({c: F.lit(0).cast("bigint") for c in ("children", "leaves", "saved")})
        else:
            here = here.join(sent, ["d1", "d2"], "left").fillna(0, ["children", "leaves", "saved"])
        out = written(here.groupBy("shard").applyInArrow(accumulated, _NODE), "trie")
        over = out.where("not inside and depth > 0")
        above = F.col("p1").alias("d1"), F.col("p2").alias("d2")
        sent = over.groupBy("p1", "p2").agg(
            F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        sent = sent.select(*above, "children", "leaves", "saved")
        parents = (F.broadcast(crown) if level == 0 else placed.where(F.col("band") == (level or 0) - 1)).select(
            F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent")
        )
        over = over.join(parents, ["p1", "p2"], "left").withColumn("parent_conv_id", F.col("parent"))
        parts += [out.where("inside or depth = 0"), over.select(*out.columns)] if level is not None else [out]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    whole = prefixes.where("ends = 1").select("d1", "d2", "conv_id").repartition("d1", "d2")
    ends = whole.sortWithinPartitions("d1", "d2", "conv_id").mapInArrow(_digest_stream, "d1 bigint, d2 bigint, ends_sha256 string")
    result = result.join(ends, ["d1", "d2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE)))
    return result.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
