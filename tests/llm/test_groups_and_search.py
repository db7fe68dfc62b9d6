"""Near-duplicate groups, exact search and link ranks against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tallyframe.llm import jaccard, link_graph, topk
from tallyframe.llm.components import components

DOCS = "doc_id bigint, text string, node int, mark string, component string"


def brute_sets(texts, width):
    fold = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    out = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
        if not words:
            out.append(set())
        elif len(words) < width:
            out.append({tuple(words)})
        else:
            out.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)})
    return out


def brute_groups(sets, num, den):
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    return group


def family(pick, n_words, vocabulary, copies, edits):
    base = [f"w{pick.randrange(vocabulary)}" for _ in range(n_words)]
    out = [" ".join(base)]
    for _ in range(copies):
        words = list(base)
        for _ in range(pick.randint(0, edits)):
            words[pick.randrange(len(words))] = f"e{pick.randrange(10**6)}"
        out.append((" ".join(words)).upper() if pick.random() < 0.3 else "  ".join(words))
    return out


def corpus(seed):
    pick = random.Random(seed)
    texts = [None, "", " \n ", "one", "One", "one two", "one two three four", "A b c d e", "a B c d e f"]
    for n_words, copies, edits in ((4, 3, 1), (9, 6, 1), (30, 8, 2), (120, 25, 9), (700, 12, 40), (40, 0, 0)):
        texts += family(pick, n_words, 5000, copies, edits)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{pick.randrange(10**6)}" for _ in range(pick.choice((3, 8, 60)))) for _ in range(40)]
    texts += ["x" * 5000 + " long word", "z " * 30_000]
    pick.shuffle(texts)
    return texts


@pytest.mark.parametrize(("width", "num", "den", "chunk"), [(4, 85, 100, 10**6), (2, 50, 100, 2000)])
def test_groups_equal_brute_force(spark, width, num, den, chunk):
    texts = corpus(width)
    docs = spark.createDataFrame([(i * 3 + 7, t, 1, "m", "c") for i, t in enumerate(texts)], DOCS)
    out = {r.id: r for r in jaccard.linked(docs, width=width, num=num, den=den, chunk=chunk).collect()}
    sets = brute_sets(texts, width)
    group = brute_groups(sets, num, den)
    least = {}
    for i, g in enumerate(group):
        least[g] = min(least.get(g, 10**9), i * 3 + 7)
    assert {i: out[i * 3 + 7].size for i in range(len(texts))} == {i: len(s) for i, s in enumerate(sets)}
    assert {i: out[i * 3 + 7].component for i in range(len(texts))} == {i: least[g] for i, g in enumerate(group)}
    if chunk < 10**6:
        return
    kept = jaccard.deduplicated(docs, width=width, num=num, den=den)
    assert kept.columns == docs.columns
    stay = {least[g] for g in group} | {i * 3 + 7 for i, s in enumerate(sets) if not s}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(stay)


def test_groups_with_repeated_and_null_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "other words stand here"), (None, "a b c d"), (None, "only null has this"), (None, None), (2, None)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    out = jaccard.linked(docs, width=4, num=85).collect()
    assert sorted(((r.id, r.size, r.component) for r in out), key=repr) == sorted(
        [(1, 1, 1)] * 3 + [(None, 1, 1), (None, 1, None), (None, 0, None), (2, 0, 2)], key=repr
    )
    kept = [(r.doc_id, r.text) for r in jaccard.deduplicated(docs, width=4, num=85).collect()]
    assert sorted(kept, key=repr) == sorted([rows[0], rows[2], rows[4], rows[5], rows[6]], key=repr)


def test_groups_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert jaccard.linked(docs).count() == 0
    assert jaccard.deduplicated(docs).count() == 0


def test_large_group_under_one_run(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FEW", 3)
    monkeypatch.setattr(jaccard, "MANY", 20)
    pick = random.Random(8)
    texts = family(pick, 200, 10**6, 90, 14)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    out = {r.id: r.component for r in jaccard.linked(docs, width=3, num=80, chunk=3000).collect()}
    group = brute_groups(brute_sets(texts, 3), 80, 100)
    assert len({(out[i], g) for i, g in enumerate(group)}) == len(set(out.values())) == len(set(group))


def test_common_passage_links_nobody(spark, monkeypatch):
    """A passage that all documents have fills runs that very many share; who shares nothing else stays out of clusters."""
    monkeypatch.setattr(jaccard, "MANY", 12)
    pick = random.Random(3)

    def own(n):
        return " ".join(f"w{pick.randrange(10**6)}" for _ in range(n))

    texts = [own(60) + " all of us say this " + own(60) for _ in range(900)]
    texts += [t.replace(t.split(" ")[7], "x", 1) for t in texts[:25]] + ["all of us say this"] * 2 + [f"all of us say this {i}" for i in range(30)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    seen, kept = {}, jaccard.written

    def counted(frame, name):
        out = kept(frame, name)
        seen[name] = out.count() if name != "jaccard-long" else max(seen.get(name, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    out = {r.id: r.component for r in jaccard.linked(docs, width=3, num=80, chunk=2000).collect()}
    group = brute_groups(brute_sets(texts, 3), 80, 100)
    assert len({(out[i], g) for i, g in enumerate(group)}) == len(set(out.values())) == len(set(group))
    assert seen["jaccard-long"] > 100  # there are long runs ...
    assert seen["jaccard-members"] < 150  # ... and yet most documents are in no cluster


def test_sure_runs_are_shared():
    """Linked sets share as many runs with n-grams as each is sure of, in every class of sizes that both are listed in."""
    random_numbers = np.random.default_rng(6)
    for _ in range(200):
        n = int(random_numbers.integers(1, 700))
        a = np.unique(random_numbers.integers(0, 2**64, n, dtype=np.uint64))
        drop = int(random_numbers.integers(0, max(1, len(a) // 9 + 1)))
        b = np.unique(np.concatenate([a[drop:], random_numbers.integers(0, 2**64, drop, dtype=np.uint64)]))
        overlap = len(np.intersect1d(a, b))
        if 100 * overlap >= 80 * (len(a) + len(b) - overlap):
            (x, sure_x), (y, sure_y) = (jaccard.runs_and_sure(s, 80, 100) for s in (a, b))
            assert len(np.intersect1d(x, y)) >= max(sure_x, sure_y, 1)


def test_components(spark):
    pick = random.Random(2)
    links = [(i, i + 1) for i in range(100, 130)] + [(pick.randrange(60), pick.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3)]
    out = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    label = {x: x for ab in links if None not in ab for x in ab}
    for _ in range(200):
        for a, b in links:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    assert out == label


VECTORS = "vec_id bigint, embedding array<float>, score int, rank string"


def brute_top(rows, k, step):
    good = [(i, np.floor(np.array(v, float) * 256)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, width - len(v)))) for i, v in good]
    out = []
    for q, x in {i: v for i, v in good if i % step == 0}.items():
        found = sorted(((-int(x @ v), i) for i, v in good if i != q))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    pick = np.random.default_rng(4)
    rows = [(i, (pick.normal(size=12) * pick.choice([0.01, 1, 30])).round(2).tolist()) for i in range(300)]
    rows += [(i, [0.5] * 12) for i in range(300, 340)] + [(350, [0.0] * 12), (400, [1.0, 2.0]), (401, []), (450, [1.0] * 12), (500, [1e5] * 12)]
    rows += [(None, [1.0] * 12), (402, None), (403, [None] + [1.0] * 11), (405, [float("nan")] * 12), (410, [float("inf")] * 12)]
    frame = spark.createDataFrame([(i, v, 1, "r") for i, v in rows], VECTORS)
    out = topk.top_k(frame, topk.F.col("id") % 10 == 0, k=5)
    assert sorted(map(tuple, out.collect())) == brute_top(rows, 5, 10)


def test_top_k_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 4)
    pick = np.random.default_rng(5)
    rows = [(i, pick.integers(-2, 3, 4).astype(float).tolist()) for i in range(200)]
    out = topk.top_k(spark.createDataFrame([(i, v, 1, "r") for i, v in rows], VECTORS), topk.F.col("id") % 20 == 0, k=5)
    assert sorted(map(tuple, out.collect())) == brute_top(rows, 5, 20)


def test_top_k_of_few(spark):
    frame = spark.createDataFrame([(0, [1.0], None, None), (1, [2.0], None, None)], VECTORS)
    assert [tuple(r) for r in topk.top_k(frame, topk.F.col("id") == 0, k=5).collect()] == [(0, 1, 1, 131072)]
    assert topk.top_k(frame.limit(0), topk.F.col("id") == 0, k=5).count() == 0
    assert topk.top_k(frame, topk.F.col("id") == 9, k=5).count() == 0


def brute_ranks(edges, seeds, rounds=200):
    nodes = sorted({x for a, b, _ in edges for x in (a, b)} | set(seeds))
    out = {n: sum(w for a, _, w in edges if a == n) for n in nodes}
    total = sum(seeds.values())
    start = {n: seeds.get(n, 0) / total for n in nodes}
    now = dict(start)
    for _ in range(rounds):
        held = sum(now[n] for n in nodes if not out[n])
        after = {n: start[n] * (0.15 + 0.85 * held) for n in nodes}
        for a, b, w in edges:
            after[b] += 0.85 * now[a] * w / out[a]
        now = after
    return now


def test_ranks_equal_brute_force(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 3.0), ("c", "d", 1.0), ("e", "a", 1.0)]
    seeds = {"a": 0.5, "e": 1.5}
    out = link_graph.ranks(
        spark.createDataFrame(edges, "a string, b string, w double"), spark.createDataFrame(list(seeds.items()), "host string, weight double"),
        rounds=60, settled=1e-10,
    )
    expected = brute_ranks(edges, seeds)
    got = {r.host: r["rank"] for r in out.collect()}
    assert set(got) == {n for n, r in expected.items() if r > 0}
    assert all(abs(got[n] - expected[n]) < 1e-6 for n in got)


def test_ranks_reach_hosts_far_from_seeds(spark):
    edges = [(f"h{i:02}", f"h{i + 1:02}", 1.0) for i in range(34)]
    out = link_graph.ranks(
        spark.createDataFrame(edges, "a string, b string, w double"), spark.createDataFrame([("h00", 1.0)], "host string, weight double"), settled=0.1
    )
    got = {r.host: r["rank"] for r in out.collect()}
    assert len(got) == 35
    assert all(abs(got[f"h{i + 1:02}"] / got[f"h{i:02}"] - 0.85) < 0.1 for i in range(33))


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
PAGES = "page_id bigint, url string, html string, host string, trust string"


def test_urls_and_rules(spark):
    urls = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://A.Example.NET/en/x?q=/y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "http://example.net": ("example.net", "", None, "block"),
        "http://notexample.com/de/x": ("notexample.com", "/de/x", None, "allow"),
        "https://www.example.com/de/x": ("www.example.com", "/de/x", "example.com/de/", "block"),
        "x://a.org/fr/?://b.net/": ("a.org", "/fr/", "org/fr/", "allow"),
        "http://?a": ("", "", None, "allow"),
        "http://com#net/": ("com", "", None, "allow"),
        "http://net/": ("net", "/", "net/", "block"),
        "http://Ünet/": ("Ünet", "/", None, "allow"),
    }
    rows = [(i, u, None, "clash", "clash") for i, u in enumerate(urls)]
    out = link_graph.judged(spark.createDataFrame(rows, PAGES), RULES)
    assert out.columns == ["page_id", "url", "html", "host", "path", "rule", "trust", "distrust", "verdict"]
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got == urls


def test_links_carry_trust_and_distrust(spark):
    link = '<a class="x" href="http://{}/y">t</a>'.format
    rows = [
        (1, "http://farm.com/", link("bad.net") * 3 + link("worse.net")),
        (2, "http://bad.net/", link("worse.net")),
        (3, "http://good.org/fr/1", link("friend.com") + "<a href=//near.com/>n</a>" + '<a href="/own">o</a>'),
        (4, "http://friend.com/", ""),
        (4, "http://friend.com/", None),
        (5, "http://near.com/", "<a HREF='https://FRIEND.com?x'>"),
        (6, "http://lone.com/", link("lone.com")),
    ]
    out = link_graph.judged(spark.createDataFrame([(*r, None, None) for r in rows], PAGES), RULES).collect()
    verdict = {r.host: r.verdict for r in out}
    assert len(out) == len(rows)
    assert verdict == {"farm.com": "block", "bad.net": "block", "good.org": "allow", "friend.com": "allow", "near.com": "allow", "lone.com": "allow"}
    trust = {r.host: r.trust for r in out}
    assert trust["friend.com"] > trust["near.com"] > trust["lone.com"] == 0.0
    assert link_graph.judged(spark.createDataFrame([], PAGES), RULES).count() == 0


def test_vectors_are_copied_only_where_they_are_asked_for(spark):
    held = spark.createDataFrame([(1, s, float(10 - 3 * s - k)) for s in range(3) for k in range(3)], "id bigint, shell int, length double")
    asked = spark.createDataFrame(
        [([0, 1], 0, 2.0, 12.0), ([0], 0, 1.0, 1.0), ([1, 2], 1, 1.0, float("-inf")), ([], 2, 1.0, 99.0), ([2], 3, 0.0, 0.0), ([0], 4, 1.0, 9.5)],
        "shells array<int>, group bigint, length_q double, floor double",
    )
    found = sorted((r.group, r.shell, r.length) for r in topk.offered(held, asked).collect())
    wanted = [(0, 0, x) for x in (8.0, 9.0, 10.0)] + [(0, 1, x) for x in (6.0, 7.0)]  # 12 / 2 = 6 is the least length of group 0
    wanted += [(1, s, x) for s, xs in ((1, (5.0, 6.0, 7.0)), (2, (2.0, 3.0, 4.0))) for x in xs]
    wanted += [(3, 2, x) for x in (2.0, 3.0, 4.0)] + [(4, 0, 10.0)]
    assert found == sorted(wanted)


def test_points_are_packed_without_loss():
    random_numbers = np.random.default_rng(1)
    for most, width in ((200, 1), (70, 1), (3000, 2), (10**6, 4)):
        counts = [random_numbers.integers(0, most, g).astype(np.int32) for g in (64, 256)]
        counts[0][0] = most - 1
        found = jaccard.alike([jaccard.packed(c) for c in counts])
        assert jaccard.packed(counts[0])[0] == width and found.dtype == np.int32
        assert (found == [counts[0], counts[1].reshape(64, 4).sum(1)]).all()
