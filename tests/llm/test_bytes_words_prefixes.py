"""Byte network, spelling groups and prefix trie: brute force, plain arithmetic and held-out cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import byte_cnn, prefix_trie, queries, spelling

# Byte network


def plain_scores(texts, network):
    """The definition, window by window."""
    out = []
    for text in texts:
        data = text.encode()
        blocks = []
        for at in range(0, len(data), byte_cnn.BLOCK):
            best = np.zeros(byte_cnn.FILTERS, np.float64)
            for start in range(at, min(at + byte_cnn.BLOCK, len(data))):
                window = data[start : start + byte_cnn.WIDTH].ljust(byte_cnn.WIDTH, b"\0")
                best = np.maximum(best, sum(network.taps[k, byte].astype(np.float64) for k, byte in enumerate(window)) + network.bias)
            blocks.append(best)
        chunks = [np.maximum(a, b) for a, b in zip(blocks, blocks[1:])] or blocks
        units = [np.tanh(c @ network.inner + network.inner_bias) for c in chunks]
        mean = np.mean(units, axis=0) if units else np.zeros(byte_cnn.HIDDEN)
        out.append(1 / (1 + np.exp(-(mean @ network.outer + network.outer_bias[0]))))
    return np.array(out)


def test_network_reads_every_byte_and_no_neighbour():
    pick = random.Random(2)
    texts = ["", "a", "é" * 70, "x" * 128, "y" * 129] + ["".join(pick.choices("abc é#\n", k=pick.randint(1, 900))) for _ in range(30)]
    texts.append("ab " * 9000 + "#")  # longer than one piece of blocks
    network = byte_cnn.Network.fresh(3)
    encoded = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, encoded)])
    found = byte_cnn.Scorer(network).scores(np.frombuffer(b"".join(encoded), np.uint8), offsets)
    assert np.allclose(found, plain_scores(texts, network), atol=1e-5)


def test_network_slopes():
    """One step of training goes down the slope that finite differences give."""
    chunks = [b"good text here ".ljust(256, b"\0"), b"### $$$ %%% ###".ljust(256, b"\0") * 2]
    start, end = byte_cnn.Network.fresh(7), byte_cnn.fitted(chunks, [1, 0], rounds=1)

    def loss(network):
        rows = [np.frombuffer(c, np.uint8).reshape(-1, 256) for c in chunks]
        total = 0.0
        for x, y in zip(rows, (1, 0)):
            pooled = np.zeros((len(x), byte_cnn.FILTERS))
            for i, row in enumerate(x):
                for p in range(251):
                    if row[p]:
                        answer = sum(network.taps[k, row[p + k]].astype(float) for k in range(6)) + network.bias
                        pooled[i] = np.maximum(pooled[i], answer)
            mean = np.tanh(pooled @ network.inner + network.inner_bias).mean(0)
            chance = 1 / (1 + np.exp(-(mean @ network.outer + network.outer_bias[0])))
            total -= np.log(chance if y else 1 - chance)
        return total

    # Adam's first step moves every weight by the rate against the sign of its slope.
    for name, at in [("outer", 2), ("outer_bias", 0), ("inner_bias", 3), ("inner", (4, 1)), ("taps", (0, ord("#"), 5)), ("bias", 5)]:
        moved = float(getattr(end, name)[at] - getattr(start, name)[at])
        values = []
        for sign in (1, -1):
            other = byte_cnn.Network.fresh(7)
            getattr(other, name)[at] += np.float32(sign * 1e-3)
            values.append(loss(other))
        slope = (values[0] - values[1]) / 2e-3
        assert abs(slope) < 1e-3 or np.sign(moved) == -np.sign(slope), name


def labelled_texts(pick, n):
    words = ["the", "of", "tion", "er", "and", "ing", "sh", "with"]
    rows = []
    for i in range(n):
        text = " ".join(pick.choice(words) for _ in range(pick.randint(20, 300)))
        good = pick.random() < 0.6
        if not good:
            text = pick.choice([lambda t: t.replace(" ", "$$$ "), lambda t: t.upper() + "!!", lambda t: "buy " * 80])(text)
        rows.append((i, text, int(good)))
    return rows


def test_quality_from_bytes(spark):
    rows = labelled_texts(random.Random(5), 500)
    docs = spark.createDataFrame([(i, t, f"s{i}", 0.0) for i, t, _ in rows] * 2 + [(None, "x", "s", 1.0), (9000, None, "s", 1.0)], "doc_id long, text string, source string, score double")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows if i % 4] + [(3, None, 0), (None, 1, 0), (77777, 1, 1)], "doc_id long, quality int, toxic int")
    network = byte_cnn.trained(docs, labels)
    out = byte_cnn.scored(docs, network)
    assert out.columns == ["doc_id", "text", "source", "score"]
    found = out.collect()
    assert len(found) == 1002
    scores = defaultdict(set)
    for r in found:
        scores[r.doc_id].add(r.score)
    assert all(len(s) == 1 for s in scores.values()) and all(0 <= r.score <= 1 for r in found)
    held = [(next(iter(scores[i])) >= 0.3) == q for i, _, q in rows if i % 4 == 0]
    assert sum(held) >= 0.95 * len(held)
    again = byte_cnn.trained(docs.repartition(3), labels.repartition(2))
    assert all((a == b).all() for a, b in zip(network.parts(), again.parts()))


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in byte_cnn.scored(docs, byte_cnn.trained(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert {r.score for r in byte_cnn.scored(docs, byte_cnn.trained(docs, one)).collect()} == {0.75}
    assert byte_cnn.scored(docs.limit(0), byte_cnn.Network.fresh()).collect() == []


def test_training_sample_has_one_row_per_id(spark):
    seen = []
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(300)] + [(2, "$$$ " * 20)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 0)], "doc_id long, quality int")
    fitted = byte_cnn.fitted
    byte_cnn.fitted = lambda chunks, quality: seen.append((len(chunks), quality)) or fitted(chunks, quality, rounds=1)
    try:
        byte_cnn.trained(docs, labels, limit=10)
    finally:
        byte_cnn.fitted = fitted
    assert seen == [(2, [0, 0])]


@pytest.mark.parametrize("size", [0, 1, 128, 129, 256, 257, 5000, 10**6])
def test_training_chunks(size):
    data = np.frombuffer(bytes(i % 251 + 1 for i in range(size)), np.uint8)
    chunks = byte_cnn.chunks_of(data)
    assert len(chunks) % 256 == 0 and len(chunks) <= 256 * byte_cnn.TRAINING_CHUNKS and (len(chunks) > 0) == (size > 0)
    if size:
        assert chunks[:256].rstrip(b"\0") == bytes(data[:256]) and bytes(data[-100:]) in chunks


# Spelling groups


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_words(docs, drop=199, shortest=6, least=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop and h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def plain_groups(counts, times=5):
    order = sorted(counts)
    patterns = defaultdict(set)
    for w in order:
        for k in range(len(w)):
            patterns[w[:k] + "*" + w[k + 1 :]].add(w)
            patterns[w[:k] + w[k + 1 :]].add(w)
        patterns[w].add(w)
    near = {w: set() for w in order}
    for group in patterns.values():
        for a in group:
            near[a] |= {b for b in group if is_near(a, b)}
    out = {}
    for w in order:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        out[w] = best if best is not None and counts[best] >= times * counts[w] else None
    rows = []
    for w in order:
        root = w
        while out[root]:
            root = out[root]
        rows.append((w, out[w], root, counts[w], len(near[w]), counts[out[w]] if out[w] else None))
    return rows


def test_edit_rows_against_all_pairs():
    pick = random.Random(1)
    for _ in range(150):
        words, buckets = [], []
        for b in range(pick.randint(1, 5)):
            found = sorted({"".join(pick.choice("abé") for _ in range(pick.randint(0, 5))) for _ in range(pick.randint(1, 40))})
            words, buckets = words + found, buckets + [b] * len(found)
        got = [pair for a, b, _ in spelling.within_one(words, np.array(buckets)) for pair in zip(a.tolist(), b.tolist())]
        n = len(words)
        wanted = {(i, j) for i in range(n) for j in range(i + 1, n) if buckets[i] == buckets[j] and is_near(words[i], words[j])}
        assert len(got) == len(set(got)) and set(got) == wanted


@pytest.mark.parametrize("bucket, batch", [(4096, 10_000), (8, 17), (2, 10_000)])
def test_groups_against_all_pairs(spark, bucket, batch):
    """Also with buckets dealt again down to one letter, and with buckets cut by the ends of batches."""
    pick = random.Random(bucket)
    words = {"".join(pick.choice("abcé") for _ in range(pick.randint(6, 8))) for _ in range(500)}
    words |= {"aaaaaa" + "".join(pick.choice("ab") for _ in range(pick.randint(1, 6))) for _ in range(100)}
    counts = {w: pick.choice([5, 6, 30, 150, 900]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        found = spelling.grouped(frame, bucket=bucket).select("word", "form", "root", "n", "n_near", "form_n").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(tuple, found)) == plain_groups(counts)


def test_words_are_counted(spark):
    text = "Hello HELLO hÉllo-hello×x Ābcdefg naïvetés " * 6
    docs = [(i, text) for i in range(60)] + [(None, text), (7, None), (8, ""), (9, "!? 12"), (9, "Z" * 200_000)]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int")
    found = {r.word: r.n for r in spelling.counted(frame, shortest=4, drop=7).collect()}
    assert found == plain_words(docs, drop=7, shortest=4)
    assert spelling.grouped(spelling.counted(frame.limit(0))).collect() == []
    assert spelling.grouped(spark.createDataFrame([("lonely", 9)], "word string, n long")).collect()[0].root == "lonely"


def test_spelling_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = queries.op12_spelling(spark, "/root/testdata/sf0.001")
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect())) == plain_groups(plain_words([tuple(r) for r in rows]))


# Prefix trie


def test_minimal_perfect_hash():
    random_numbers = np.random.default_rng(4)
    for n in (0, 1, 2, 1000, 20_000):
        high, low = random_numbers.integers(0, 2**64, (2, n), dtype=np.uint64)
        low[: n // 2] = 7  # one word alike is no collision
        table = prefix_trie.MinimalPerfectHash(high, low)
        assert sorted(table.slots(high, low).tolist()) == list(range(n))
        assert (table.slots(high + np.uint64(1), low) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.MinimalPerfectHash(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def plain_trie(rows, block=100, heads=6):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn, role or "", text or ""))
    first = {c: [t[1:] for t in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0))] for c, v in turns.items()}
    built = {}
    for c, own in first.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % block) * (1 if c >= 0 else -1)
        built[c] = first.get(base, [])[:h] + own[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in children[key]) or 1
        saved[key] = sum(saved[k] for k in children[key]) + (len(members[key]) - 1) * (len(key[-1][1]) if key else 0)
    out = []
    for key, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(built[c]) == len(key))
        parent = min(members[key[:-1]]) if key else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(found), len(key), parent, len(found), len(children[key]), leaves[key], saved[key], sha))
    return sorted(out, key=str)


def talks(pick, n, longest):
    rows = []
    for k, conv in enumerate([*pick.sample(range(-350, 700), n), None]):
        turns = longest if k == 0 else pick.choice([1, 1, 2, 3, 4, 5, 6, 7])
        for turn in pick.sample(range(100), turns):
            role = pick.choice(["user", None]) if pick.random() < 0.3 else "user"
            rows.append((conv, None if turn == 0 else turn, role, pick.choice(["a", "bb", "ccc", "dé", None])))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts, batch, limits", [(1, 10_000, {}), (5, 7, {"shared": 10, "shard": 60, "band": 8})])
def test_trie_against_plain_python(spark, parts, batch, limits):
    """Also with conversations cut by batches and partitions, with a crown, several shards and bands of depth."""
    rows = talks(random.Random(parts), 150, 60 if limits else 20)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch), "spark.sql.shuffle.partitions": str(parts)}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = prefix_trie.nodes(frame, **limits)
        assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        got = sorted(map(tuple, found.collect()), key=str)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == plain_trie(rows)


def test_trie_repeats_and_copies(spark):
    """Repeated rows are repeated turns, and copies of a conversation share all nodes; plain conversations stay as they are."""
    rows = [(c, t, "user", "hi") for c in (1, 2, 3) for t in (0, 0, 1)] + [(4, 0, "user", "hi"), (5, 0, "bot", "hi")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r.depth, r.conv_id): r for r in prefix_trie.nodes(frame, heads=1).collect()}
    assert set(found) == {(0, 1), (1, 1), (1, 5), (2, 1), (3, 1)}
    assert found[3, 1].n_convs == 3 and found[3, 1].ends_sha256 == hashlib.sha256(b"1,2,3").hexdigest()
    assert found[1, 1].ends_sha256 == hashlib.sha256(b"4").hexdigest() and found[1, 1].saved_tokens == 2 * (3 + 2 + 2)
    assert (found[0, 1].n_leaves, found[0, 1].n_children, found[0, 1].parent_conv_id) == (2, 2, None)
    assert prefix_trie.nodes(frame.limit(0)).collect() == []


def test_digests_of_streams():
    rows = [(1, 1, k) for k in range(20)] + [(1, 2, 5), (2, 1, 7), (2, 1, 8)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 4])], names=["a", "b", "c"]) for i in range(0, len(rows), 4)]
    found = [tuple(r.values()) for b in prefix_trie._digest_stream(iter(batches)) for r in b.to_pylist()]
    sha = lambda *ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert found == [(1, 1, sha(*range(20))), (1, 2, sha(5)), (2, 1, sha(7, 8))]


def test_trie_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = queries.op13_prefix_trie(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, found.collect()), key=str) == plain_trie([tuple(r) for r in rows])


def test_quality_query(spark):
    found = queries.op11_byte_cnn(spark, "/root/testdata/sf0.01")
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert sum(held) >= 0.93 * len(held)


def test_null_ids_share_a_text(spark):
    docs = spark.createDataFrame([(None, "Some words here")] * 6, "doc_id long, text string")
    words = {r.word: r.n for r in spelling.counted(docs, shortest=4, least=1, drop=1).collect()}
    assert words == plain_words([(None, "Some words here")] * 6, drop=1, shortest=4, least=1)
