"""Byte-pair encoding, packed token files and mixing against the library, a decoder and brute force."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import bitpack, bpe, mixing, queries
from tallyframe.llm.queries import MIX, vocabulary

tokenizers = pytest.importorskip("tokenizers")

DOCS = "doc_id bigint, text string, source string, token_ids string, size int"
TEXTS = [
    "The cat's hat. IT'S   11 o'clock!\n\nnew\tline",
    None,
    "",
    " ",
    "  <|endoftext|> in <|startoftext|>text ",
    "ÉÀ é ΣΊΣΥΦΟΣ İ 漢字 😀 ² ½  x y",
    "ab" * 3000 + "tionth" * 50,
    "don't WE'LL 'S a'b ''",
    "a \n b\n \nc  d",
    "The cat's hat. IT'S   11 o'clock!\n\nnew\tline",
]


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def all_documents(spark):
    return documents(spark, [(i if i != 8 else None, t, "s", "clash", 7) for i, t in enumerate(TEXTS)])


def test_bpe_equals_the_library(spark):
    path = vocabulary("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    out = bpe.encoded(all_documents(spark), path, decoded="decoded")
    assert out.columns == ["doc_id", "text", "source", "size", "token_ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(row.token_ids), "<u4").tolist() == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_on_random_text():
    path = vocabulary("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        own = bpe.WordBpe(file.read())
    pick = random.Random(3)
    parts = ["a", "B", " ", "\n", "'s", "’", "é", "Σ", "İ", "\x1c", "\x85", "1²", "<|endoftext|>", "tion", "!!", "😀", "漢字", "''LL", "ſ"]
    for _ in range(400):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 40)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    # The heap and the scan merge in the same order.
    for _ in range(50):
        word = bytes(pick.choice(b"tiones") for _ in range(pick.randint(2, 63)))
        start = [own.inner[b] for b in word[:-1]] + [own.final[word[-1]]]
        assert own._merge_short(list(start)) == own._merge_long(list(start))


def test_bpe_empty_table(spark):
    out = bpe.encoded(documents(spark, []), vocabulary("word_bpe_49k.json"))
    assert out.count() == 0


def test_forgetting_keeps_results():
    with open(vocabulary("word_bpe_49k.json"), encoding="utf-8") as file:
        own = bpe.WordBpe(file.read())
    text = " ".join(f"w{i}x{i * 7}" for i in range(300))
    expected = own.encode(text).tolist()
    own._known.limit = own._stretches.limit = 5
    assert own.encode(text).tolist() == expected == own.encode(text).tolist()


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 5000, dtype=np.uint32)
    for n in (0, 1, 63, 64, 65, 4096, 5000):
        segment = bitpack.Segment(bitpack.write_segment(ids[:n], bits, block=128))
        assert (segment.read_all() == ids[:n]).all()
        for start, count in ((0, n), (n // 3, n // 2), (n, 0)):
            assert (segment.read(start, count) == ids[start : start + count]).all()
    with pytest.raises(IndexError):
        segment.read(4999, 2)


def test_packing_refuses_large_ids():
    assert bitpack.id_bits(50257) == 16
    assert bitpack.id_bits(1) == 1
    with pytest.raises(ValueError):
        bitpack.write_segment(np.array([8], np.uint32), 3)


def test_token_files_equal_the_library(spark):
    path = vocabulary("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    docs = all_documents(spark)
    rows = bitpack.stored(docs, path, end_id=2).orderBy("start").collect()
    # A null id comes first; then by id, and texts of one id by text.
    expected = sorted(((i if i != 8 else None, t or "") for i, t in enumerate(TEXTS)), key=lambda r: (r[0] is not None, r[0], r[1]))
    start = 0
    for row, (doc_id, text) in zip(rows, expected, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(ids))
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == ids
        start += len(ids)


def test_token_files_in_many_segments(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        docs = documents(spark, [(i * 37 % 100, f"word{i} " * (i % 9), None, None, None) for i in range(100)])
        rows = bitpack.stored(docs, vocabulary("byte_bpe_50k.json"), end_id=2).orderBy("start").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
    assert [r.doc_id for r in rows] == list(range(100))
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    assert all(zlib.crc32(bytes(r.ids)[-4:]) == zlib.crc32(b"\x02\0\0\0") for r in rows)


def test_token_files_empty_table(spark):
    assert bitpack.stored(documents(spark, []), vocabulary("byte_bpe_50k.json"), end_id=2).count() == 0


def byte_vocabulary():
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        description = file.read()
    return description, tokenizers.Tokenizer.from_str(description)


def test_encoder_learns_pieces_only():
    """Words that meet at line breaks and marks in every combination cost no more than the words."""
    description, library = byte_vocabulary()
    encoder = bitpack.LibraryEncoder(description, ["<|endoftext|>"])
    words = [f"{a}{b}" for a in "bcdfghkl" for b in ("an", "era", "ition", "ou")]
    texts = [" ".join(f"{a}{mark}{b}" for b in words) for a in words for mark in ("\n", ".\n", "-", ",")]
    ids, places = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[places[i] : places[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder._known) <= 2 * len(words) + 4


def test_encoder_on_random_text():
    description, library = byte_vocabulary()
    pick = random.Random(5)
    parts = ["a", "the", "é", "ÿ", "×", "÷", "1", "42", "²", "'", "'ll", ".", "$$", "\\", " ", " ", "  ", "\n", "\t", "\r"]
    parts += ["\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "漢", "😀", "ā", "\u0301", "\0", "<|endoftext|>"]
    encoder = bitpack.LibraryEncoder(description, ["<|endoftext|>"], limit=500)
    for turn in range(150):
        some = pick.sample(parts, pick.randint(2, len(parts)))
        texts = ["".join(pick.choices(some, k=pick.randint(0, pick.choice([3, 60])))) for _ in range(pick.randint(0, 20))]
        ids, places = encoder.encode(pa.array(["x", *texts], pa.string())[1:])
        assert len(places) == len(texts) + 1 and places[-1] == len(ids)
        for i, text in enumerate(texts):
            assert ids[places[i] : places[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def water_level(sizes: dict, weights, share, cap):
    """Targets by repeated resharing, as the rule is stated."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        left = share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else left * weight[s] / total for s in names}
        over = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def test_mix_reaches_targets(spark):
    pick = random.Random(1)
    rows = []
    for source, n in (("b", 400), ("a", 60), ("é", 80), (None, 50), ("c", 3)):
        for _ in range(n):
            words = int(pick.paretovariate(1.2) * 10) % 800
            rows.append((len(rows) if pick.random() < 0.95 else 5, "w " * words if words else None, source, "x", 1))
    docs = documents(spark, rows)
    out = mixing.copies(docs, **MIX, group=64).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len((r[1] or "").split())
    goal = water_level(sizes, *MIX.values())
    for source, size in sizes.items():
        mine = [r for r in out if r.source == source]
        assert {r.source_size for r in mine} == {size}
        assert abs(mine[0].target - goal[source]) < 1e-6 * max(size, 1)
        assert abs(sum(r.taken for r in mine) - goal[source]) <= max(3, 0.02 * size)
        ratio = goal[source] / size if size else 0
        assert all(int(ratio) <= r.copies <= int(ratio) + 1 and r.taken == r.size * r.copies <= 2 * r.size for r in mine)
    again = mixing.copies(docs.repartition(7), **MIX, group=64).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))
    mixed = mixing.mixed(docs, **MIX, group=64)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in out)
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in out)


def test_flight_keeps_sums():
    random_numbers = np.random.default_rng(0)
    size = random_numbers.integers(0, 500, 3000).astype(float)
    chance = random_numbers.random(3000)
    out = mixing.flight(chance, size, random_numbers)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - chance.sum()) < 1e-6 and abs(out @ size - chance @ size) < 1e-3


def test_long_documents_are_balanced():
    """One document as long as a fifth of its source, and sizes over four orders of magnitude: the words still come out."""
    for seed in range(12):
        random_numbers = np.random.default_rng(seed)
        size = np.concatenate([[5184.0], random_numbers.integers(60, 900, 49)]).astype(float)
        chance = np.full(len(size), random_numbers.uniform(0.1, 0.9))
        out = mixing.settled(chance, size, random_numbers)
        assert set(out) <= {0.0, 1.0} and abs(out @ size - chance @ size) <= 3
        size = np.floor(random_numbers.pareto(1.0, 3000) * 20) + 1
        chance = np.full(len(size), 0.3)
        moved = mixing.flight(chance, size, random_numbers)
        assert ((moved > 0) & (moved < 1)).sum() <= 2 and abs(moved @ size - chance @ size) < 1e-2
        assert abs(mixing.settled(chance, size, random_numbers) @ size - chance @ size) <= 1


def test_exchanges_reach_the_total():
    size, free = np.array([7.0, 10, 13, 500, 20]), np.array([True, True, True, False, True])
    out = mixing.exchanged(np.array([1.0, 0, 0, 1, 0]), size, free, 513.0)
    assert out.tolist() == [0, 0, 1, 1, 0]
    assert mixing.exchanged(np.zeros(5), size, np.zeros(5, bool), 30.0).tolist() == [0] * 5


def test_copies_go_to_the_row_they_were_decided_for(spark):
    """One id and text in two sources, in either order of the rows; other columns tell equal rows apart."""
    sized = [(100 + i, "w " * (i % 7 + 1), s, "x", i) for i, s in enumerate(["s1", "s2"] * 20)]
    for rows in ([(1, "a b c d", "s1", "x", 1), (1, "a b c d", "s2", "x", 2)], [(1, "a b c d", "s2", "x", 2), (1, "a b c d", "s1", "x", 1)]):
        docs = documents(spark, rows + sized)
        wanted = sorted((r.id, r.source) for r in mixing.copies(docs, **MIX).collect() for _ in range(r.copies))
        assert sorted((r.doc_id, r.source) for r in mixing.mixed(docs, **MIX).collect()) == wanted
    same = documents(spark, [(None, "a b", None, "x", i) for i in range(9)])
    found = [sorted(r.size for r in mixing.mixed(d, **MIX).collect()) for d in (same, same.orderBy(F.desc("size")))]
    assert found[0] == found[1] and len(found[0]) == sum(r.copies for r in mixing.copies(same, **MIX).collect())


def test_rows_without_id_spread_over_groups(spark):
    docs = documents(spark, [(None, f"w{i} x" if i % 2 else "same text", "s", "x", 1) for i in range(3000)] + [(1, "a b c", "t", "x", 1)])
    seen = []
    kept = mixing.written

    def counted(frame, name):
        out = kept(frame, name)
        if name == "mixing-level-0":
            seen.append(out.where("source = 's'").groupBy(F.spark_partition_id()).count().count())
            order = F.xxhash64(F.lit(0), F.lit(0), "id", "mark", "turn")
            rows = out.where("source = 's'").groupBy(F.pmod(F.shiftrightunsigned(order, 16), F.lit(5))).count().collect()
            seen.append(max(r["count"] for r in rows))
        return out

    mixing.written = counted
    try:
        out = mixing.copies(docs, **MIX, group=600).collect()
    finally:
        mixing.written = kept
    assert len(out) == 3001 and seen[1] < 900


@pytest.mark.parametrize("directory", ["sf0.001", "sf0.01"])
def test_mixing_query(spark, directory):
    """Sizes, targets and bounds by the rule, and every source within a few words of its target."""
    rows = spark.read.parquet(f"/root/testdata/{directory}/documents.parquet").select("doc_id", "text", "source").collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    by_source = {}
    for r in rows:
        by_source[r.source] = by_source.get(r.source, 0) + size[r.doc_id]
    goal = water_level(by_source, *MIX.values())
    found = queries.op3_mixing(spark, f"/root/testdata/{directory}").collect()
    assert sorted(r.doc_id for r in found) == sorted(size)
    source_of = {r.doc_id: r.source for r in rows}
    taken = dict.fromkeys(by_source, 0)
    for r in found:
        source = source_of[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == by_source[source] and r.taken <= 2 * r.size
        assert abs(r.target - goal[source]) < 1e-6 * by_source[source]
        taken[source] += r.taken
    for source, words in taken.items():
        mine = np.array([size[i] for i in size if source_of[i] == source and size[i]])
        nearest = 3.0
        if len(mine) <= 12:  # few documents reach few totals
            whole = int(goal[source] / by_source[source])
            totals = (np.arange(1 << len(mine))[:, None] >> np.arange(len(mine)) & 1) @ mine + whole * by_source[source]
            nearest = np.abs(totals - goal[source]).min() + 1e-6
        assert abs(words - goal[source]) <= nearest, source


def test_mix_without_words(spark):
    docs = documents(spark, [(1, None, "a", None, None), (2, "", None, None, None)])
    assert [(r.size, r.target, r.taken) for r in mixing.copies(docs, **MIX).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.copies(documents(spark, []), **MIX).count() == 0
    assert mixing.mixed(documents(spark, []), **MIX).count() == 0
