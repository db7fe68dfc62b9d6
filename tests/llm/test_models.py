"""Block labels, language model, line labels and license scans: numbers by brute force, models on held-out cases."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import crf_quality, html_extract, maxent_lm, patience, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = {"en": ["the", "ti", "er", "an", "sh"], "fr": ["é", "ou", "que", "eaux", "le"]}


def prose(pick, words, language="en"):
    out = []
    for _ in range(words):
        word = "".join(pick.choice(SYLLABLES[language]) for _ in range(1 + (pick.random() < 0.4)))
        out.append(word + ("." if pick.random() < 0.08 else ""))
    return " ".join(out).capitalize() + "."


# Block labels


def page(pick, inside_comment=False):
    paragraphs = "".join(f"<p>{prose(pick, pick.randint(3, 40))}</p>" for _ in range(pick.randint(2, 8)))
    links = "".join(f'<li><a href="/{i}">{prose(pick, 1)}</a></li>' for i in range(4))
    comment = f'<div class="comments"><p>{prose(pick, 20)}</p></div>' if inside_comment else ""
    return (
        f"<html><head><title>t</title><script>var a='<p>';</script></head><body><nav><ul>{links}</ul></nav>"
        f'<div class="ad">{prose(pick, 9)}</div><article><h1>{prose(pick, 5)}</h1>{paragraphs}{comment}</article>'
        f"<footer>&copy; {prose(pick, 4)}</footer></body></html>"
    )


@pytest.fixture(scope="module")
def model():
    pick = random.Random(4)
    return html_extract.fitted([page(pick) for _ in range(60)])


def test_blocks():
    html = (
        "<!DOCTYPE html><title>A &amp; B</title><style>p{}</style><!-- <p>no</p> --><p class='x Y-1'>One<br>two &lt;b&gt; <b>three</b>\n\tfour"
        "<p>&eacute;&#233;&nbsp;&amp;amp; <a href=\"a>b\">link</a><ul><li>a<li>b</ul>tail < 3<script>if (a<b) '</p>'</script> end</div><hr>&copy;"
    )
    found = html_extract.blocks(html)
    assert [b.text for b in found] == ["A & B", "One two <b> three four", "éé &amp; link", "a", "b", "tail < 3 end", "©"]
    assert found[1].path == ("p", ".x", ".y", ".1")
    assert found[2].linked == 4
    assert html_extract.blocks("") == [] and html_extract.blocks("<p></p> <br>") == []
    assert [b.text for b in html_extract.blocks("text <script>never closed")] == ["text"]
    assert len(html_extract.blocks("<p>x" * 20_000)) == 20_000
    assert [b.text for b in html_extract.blocks('<p title="open' * 300 + ">x")]


@pytest.mark.parametrize(
    "html, found",
    [
        ("<div>a" * 170_000, 170_000),
        ("<a " * 340_000, 1),
        ('<a ">" ' * 150_000, 1),
        ("<ul><li>" + "<div>" * 80_000 + "<li></li>" * 60_000, 0),
        ("<script>" + "</script " * 110_000, 0),
        ("<div>" * 90_000 + "</p>a" * 100_000, 100_000),
        ("<!--" * 250_000, 0),
    ],
)
def test_deep_and_broken_pages_take_linear_time(model, html, found):
    """A megabyte each: time and memory grow with the page, not with its square."""
    import time
    import tracemalloc

    start = time.process_time()
    assert len(html_extract.blocks(html)) == found
    assert time.process_time() - start < 20
    tracemalloc.start()
    html_extract.blocks(html[: len(html) // 8])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 << 20


def test_quotes_that_do_not_pair_up():
    """Ends of tags by the marks alone agree with the plain reading from each place."""
    pick = random.Random(6)
    for _ in range(400):
        html = "".join(pick.choice("<a>\"' x") for _ in range(pick.randint(0, 30)))
        ends = html_extract._Ends(html)
        for at in range(len(html) + 1):
            wanted, quote = -1, None
            for k in range(at, len(html)):
                if quote:
                    quote = None if html[k] == quote else quote
                elif html[k] in "\"'":
                    quote = html[k]
                elif html[k] == ">":
                    wanted = k
                    break
            assert ends.after(at) == wanted


def test_places_are_shared_and_path_vectors_add_up():
    places = html_extract.Places(most=50)
    pages = [page(random.Random(k)) for k in range(4)] * 30
    for at in range(0, len(pages), 4):
        for html, read in zip(pages[at : at + 4], places.read(pages[at : at + 4])):
            alone = html_extract.blocks(html)
            assert [(b.path, b.text, b.linked) for b in read] == [(b.path, b.text, b.linked) for b in alone]
            assert (html_extract.Features()(read) == html_extract.Features()(alone)).all()
    deep = html_extract.blocks("<div class=a><div class=a><p class='b a'>x</div><p>y")
    assert [b.place.fresh for b in deep] == [("p", ".b"), ("p",)]


def test_long_sequences_are_multiplied_in_steps(model):
    x, real = html_extract.padded([np.random.default_rng(2).normal(size=(n, html_extract.INPUT)).astype(np.float32) for n in (700, 130)])
    whole = model.chances(x, real)
    before, html_extract.STEPS = html_extract.STEPS, 64
    try:
        assert np.allclose(model.chances(x, real), whole, atol=1e-5)
    finally:
        html_extract.STEPS = before


def test_labels_on_unseen_layouts(model):
    pick = random.Random(9)
    pages = [html_extract.blocks(page(pick)) for _ in range(40)]
    cases = html_extract.varied(pages, 80, seed=5) + [(p, np.array([html_extract.landmark(b) for b in p])) for p in pages]
    wrong = total = 0
    for (_, labels), found in zip(cases, html_extract.labelled([p for p, _ in cases], model, html_extract.Features())):
        wrong, total = wrong + int((labels != found).sum()), total + len(labels)
    assert wrong <= 0.03 * total


def test_backpropagation():
    random_numbers = np.random.default_rng(1)
    model = html_extract.Model.fresh()
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, real = html_extract.padded([random_numbers.normal(size=(n, html_extract.INPUT)) for n in (4, 2)])
    y = random_numbers.random(real.shape) < 0.5
    slopes, _ = model.slopes(x.astype(float), real, y)
    for name in model.weights:
        at = tuple(int(random_numbers.integers(0, n)) for n in model.weights[name].shape)
        kept = model.weights[name][at]
        losses = []
        for step in (1e-4, -1e-4):
            model.weights[name][at] = kept + step
            losses.append(model.slopes(x.astype(float), real, y)[1])
        model.weights[name][at] = kept
        assert abs((losses[0] - losses[1]) / 2e-4 - slopes[name][at]) < 2e-3


def test_extraction(spark, model):
    pick = random.Random(3)
    html = page(pick)
    rows = [(1, html, "clash", "url"), (1, html, "clash", None), (2, None, None, None), (3, "", "x", ""), (None, "<nav><a href=/>x</a></nav>", "x", "")]
    frame = spark.createDataFrame(rows, "page_id bigint, html string, text string, url string")
    out = html_extract.extracted(frame, model)
    assert out.columns == ["page_id", "html", "url", "text"]
    texts = [r.text for r in out.collect()]
    expected = "\n\n".join(b.text for b in html_extract.blocks(html) if html_extract.landmark(b))
    assert texts == [expected, expected, "", "", ""]
    assert html_extract.extracted(frame.limit(0), model).count() == 0
    assert html_extract.trained(frame.limit(0)) is None
    assert html_extract.extracted(frame, None).count() == 5


def test_training_pages_differ_and_have_articles(spark, monkeypatch):
    samples = []

    def fitted(pages):
        samples.append(pages)
        return "model" if any(html_extract.landmark(b) for p in pages for b in html_extract.blocks(p)) else None

    monkeypatch.setattr(html_extract, "fitted", fitted)
    pick = random.Random(14)
    pages = [page(pick) for _ in range(10)]
    rows = [(h,) for p in pages for h in [p] * 30] + [("",), (None,)]
    assert html_extract.trained(spark.createDataFrame(rows, "html string"), limit=10) == "model"
    assert sorted(samples.pop()) == sorted(pages)
    menus = [(f"<html><body><nav><ul><li>{i} {prose(pick, 3)}</li></ul></nav></body></html>",) for i in range(200)]
    assert html_extract.trained(spark.createDataFrame([*menus, (pages[0],)], "html string"), limit=3) == "model"
    assert samples[-1] == [pages[0]]
    assert html_extract.trained(spark.createDataFrame(menus, "html string"), limit=3) is None


def test_extraction_query(spark, tmp_path):
    pick = random.Random(12)
    pages = [(i, f"http://h/{i}", page(pick, i % 3 == 0)) for i in range(60)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = {r.page_id: r for r in queries.op1_html_lstm(spark, str(tmp_path)).collect()}
    right = 0
    for i, url, html in pages:
        expected = "\n\n".join(b.text for b in html_extract.blocks(html) if html_extract.landmark(b))
        assert (out[i].url, out[i].n_chars) == (url, len(out[i].text))
        right += out[i].text == expected
    assert len(out) == 60 and right >= 57


# Language model


def test_language_model(spark):
    pick = random.Random(6)
    rows = [(i, prose(pick, pick.randint(1, 60), pick.choice(("en", "fr"))), "clash", 1.0) for i in range(260)]
    rows += [(300, None, None, None), (301, "", "", 0.0), (None, "The TI un seen", "x", 0.0), (7, rows[7][1], "x", 0.0), (302, "rare " * 3000, "x", 0.0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, row string, score double")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    out = maxent_lm.scored(frame, ~held).collect()
    assert len(out) == len(rows)
    fold = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    tokens = [[*WORD.findall((t or "").translate(fold)), None] for _, t, *_ in rows]
    trains = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2 for i, *_ in rows]
    counts = Counter(w for ts, learn in zip(tokens, trains) if learn for w in ts)
    total, distinct = sum(counts.values()), len(counts)
    got = sorted((r.id is not None, r.id, r.trained, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out)
    expected = sorted(
        (i is not None, i, learn, len(ts), sum(counts[w] > 0 for w in ts), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ts), 4))
        for (i, *_), ts, learn in zip(rows, tokens, trains)
    )
    assert got == expected
    unseen = [r for r in out if not r.trained and r.id != 302]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_language_model_is_a_distribution(spark):
    pick = random.Random(7)
    frame = spark.createDataFrame([(prose(pick, 30),) for _ in range(80)], "text string")
    counts = maxent_lm.word_counts(frame)
    vocabulary = maxent_lm.Vocabulary.of(counts, 80, frequent=10)
    weights = maxent_lm.trained(maxent_lm.class_counts(frame, vocabulary), steps=3, partitions=2)
    chances = np.exp(maxent_lm.log_chances(weights, np.arange(50)))
    assert np.allclose(chances.sum(axis=1), 1)
    inside = np.zeros(maxent_lm.CLASSES)
    inside[1 : 1 + maxent_lm.FORMS] = 1  # one unseen word each
    inside[0] = 10**vocabulary.end_log
    for r in counts.collect():
        kind, _ = vocabulary.look_up(np.array([r.word]))
        inside[kind[0]] += r.c + 1
    filled = inside > 0
    assert np.allclose(np.log10(inside[filled]), vocabulary.class_logs[filled])


def test_language_model_without_training(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    out = {r.id: r for r in maxent_lm.scored(frame, F.lit(False)).collect()}
    assert (out[1].n_tokens, out[1].n_known, out[1].train_tokens, out[1].base_score) == (3, 0, 0, 0.0)
    assert out[2].score < 0
    assert maxent_lm.scored(frame.limit(0), F.lit(True)).count() == 0


def test_language_model_gives_every_pair_its_own_weights(spark):
    # Each history is followed by one class that tells it from all others with either class of the pair.
    history = np.arange((maxent_lm.CLASSES + 1) ** 2)
    active = maxent_lm.features(history)
    assert len(np.unique(active[:, 3])) == len(history) and active.max() < maxent_lm.FEATURES
    some = history[::97] + history[::97] // 97 % 7
    cells = [(int(h), int(h * 7 % maxent_lm.CLASSES), 50) for h in some]
    rows = spark.createDataFrame([(h, [c], [n]) for h, c, n in cells], "history long, classes array<int>, ns array<long>")
    weights = np.zeros((maxent_lm.FEATURES, maxent_lm.CLASSES))
    slope, value = maxent_lm.gradient(rows.repartition(3), weights)
    assert value == pytest.approx(-50 * len(cells) * math.log(maxent_lm.CLASSES))
    for h, c, n in cells:
        expected = np.full(maxent_lm.CLASSES, -n / maxent_lm.CLASSES)
        expected[c] += n
        assert slope[active[h, 3]] == pytest.approx(expected)


def test_language_model_classes_by_count_alone(spark, monkeypatch):
    pick = random.Random(8)
    rows = [(i, " ".join(f"w{int(pick.paretovariate(0.35)) % 1500}" for _ in range(60))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = Counter(w for i, t in rows if i % 5 for w in t.split())
    words = counts.most_common()
    assert sum(c >= maxent_lm.LEAST_COUNT for _, c in words) > 1.5 * maxent_lm.SINGLES
    results = []
    for held in (0, 90, 1 << 16):
        monkeypatch.setattr(maxent_lm, "HELD", held)
        vocabulary = maxent_lm.Vocabulary.of(maxent_lm.word_counts(frame.where("doc_id % 5 > 0").select("text")), 96)
        assert len(vocabulary.names) <= max(held, maxent_lm.SINGLES)
        results.append(sorted((r.id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in maxent_lm.scored(frame, F.col("doc_id") % 5 > 0).collect()))
    assert results[0] == results[1] == results[2]
    # Every word with the least count has a class by its frequency, and words of the same count share it.
    names = np.arange(len(words)) * 8
    kinds = vocabulary.by_count(names, np.array([c for _, c in words]))
    assert all((k > maxent_lm.FORMS) == (c >= maxent_lm.LEAST_COUNT) for k, (_, c) in zip(kinds, words))
    assert len({(k, c) for k, (_, c) in zip(kinds, words)}) == len({c for _, c in words})


def test_language_model_learns_word_pairs_and_skips(spark):
    """Every word occurs as often as every other, so that no class tells them apart; only who follows whom does."""
    names = [f"w{k}" for k in range(240)]

    def passage(at: int, n: int) -> list[str]:
        return [names[(at + k) % len(names)] for k in range(n)]

    rows = [(i, " ".join(passage(7 * i, 120))) for i in range(40)]
    known = passage(31, 60)
    # With every other word new, only the skips over those are known.
    gaps, turned = ([word for w in some for word in (w, f"new{w}")] for some in (known[::2], known[::-2]))
    rows += [(100 + k, " ".join(text)) for k, text in enumerate((known, known[::-1], gaps, turned))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.id: r for r in maxent_lm.scored(frame, F.col("doc_id") < 100).collect()}
    assert out[100].base_score == pytest.approx(out[101].base_score)
    assert out[100].score > out[101].score + 60
    assert out[102].score > out[103].score + 5


def test_language_model_counts_every_pair_and_skip(spark, monkeypatch):
    pick = random.Random(10)
    rows = [(i, prose(pick, pick.randint(0, 40))) for i in range(90)] + [(90, None), (91, "a a a a"), (5, "a a a a"), (None, "b")]
    learned = [i is not None and i % 4 > 0 for i, _ in rows]
    fold = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    texts = [["<", "<", *WORD.findall((t or "").translate(fold)), ">"] for _, t in rows]
    singles, pairs, skips, before = Counter(), Counter(), Counter(), Counter()
    for text, learn in zip(texts, learned):
        for t, u, w in zip(text, text[1:], text[2:]) if learn else ():
            singles[w] += 1
            pairs[u, w] += 1
            skips[t, w] += 1
            before[t] += 1
    expected = sorted(
        [(singles[w], pairs[u, w], skips[t, w], before[t]) for t, u, w in zip(text, text[1:], text[2:])] for text in texts
    )
    frame = spark.createDataFrame(rows, "id bigint, text string")
    training = F.coalesce(F.col("id") % 4 > 0, F.lit(False))
    body = F.coalesce("text", F.lit("")).alias("text")
    scores = []
    for chunk, bucket, passes in ((1 << 19, 1 << 21, 2), (40, 60, 3)):
        monkeypatch.setattr(maxent_lm, "CHUNK", chunk)
        monkeypatch.setattr(maxent_lm, "BUCKET", bucket)
        vocabulary = maxent_lm.Vocabulary.of(maxent_lm.word_counts(frame.where(training).select(body)), sum(learned))
        chunks = maxent_lm.written(maxent_lm.chunked(frame.select("id", training.alias("trained"), body)), "chunks")
        got = []
        for row in maxent_lm.counted(chunks, vocabulary, passes).collect():
            part = maxent_lm._Counted(row.asDict())
            columns = np.stack([part.c, part.n1, part.n2, part.h2], axis=1)
            got += [[tuple(map(int, token)) for token in text] for text in np.split(columns, part.begin[1:])]
            assert part.h1(vocabulary.texts)[part.begin].tolist() == [sum(learned)] * len(part.begin)
        assert sorted(got) == expected
        scores.append(sorted((r.id is None, r.id, r.n_tokens, round(r.score, 6)) for r in maxent_lm.scored(frame, training, doc_id="id").collect()))
    assert scores[0] == scores[1] and len(scores[0]) == len(rows)
    # What follows a word adds up to its own count, so that refined chances add up to one.
    after, chances = Counter(), np.array([0.2, 0.5, 0.3])
    for (t, _), n in skips.items():
        after[t] += n
    assert after == +before
    assert maxent_lm._raised(chances, np.array([3, 0, 4]), 7, 2.5).sum() == pytest.approx(1)


def test_word_counts_flush(spark):
    frame = spark.createDataFrame([("a b A",), ("b b\tc",), (None,)], "text string")
    assert sorted(r.c for r in maxent_lm.word_counts(frame).collect()) == [1, 2, 3]


# Line labels


def junk(pick):
    kind = pick.randrange(3)
    words = prose(pick, 70).split()
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    return " | ".join(words) if kind == 1 else " ".join(w + pick.choice(("$$$", "###", "%%%")) for w in words)


def graded(pick, n):
    out = []
    for i in range(n):
        good = pick.random() < 0.7
        lines = [prose(pick, pick.randint(15, 40)) for _ in range(4)]
        out.append((i, "\n".join(lines) if good else "\n".join([lines[0], junk(pick), junk(pick)]), int(good)))
    return out


def brute_statistics(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again),
        len(words) < 50 or 100 * len(again) > 50 * len(words),
    )


def test_line_sample_has_one_row_per_id(spark):
    docs = spark.createDataFrame([(1, f"text number {k}\nmore") for k in range(500)] + [(2, "x | y | z")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id bigint, quality int")
    seen, fitted = [], crf_quality.fitted
    crf_quality.fitted = lambda documents, quality: seen.append((list(map(len, documents)), quality)) or fitted(documents, quality, rounds=1, steps=2)
    try:
        crf_quality.trained(docs, labels, limit=10)
        crf_quality.trained(docs.repartition(7), labels, limit=10)
    finally:
        crf_quality.fitted = fitted
    assert seen == [([2, 1], [1, 0])] * 2


def test_lines(spark):
    pick = random.Random(5)
    known = graded(pick, 200)
    extra = [None, "", "\n\n", "é 漢字 #*$%&|<>", "a b c " * 40, "x y z\nx y z\n x y z\nx y z", "w " * 40_000, "one word\x1ctwo\r\nthree"]
    rows = [(i, t, "clash", 1) for i, t, _ in known] + [(1000 + i, t, None, None) for i, t in enumerate(extra)] + [(None, known[0][1], "x", 0)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string, other int")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in known[:120]] + [(None, 1, 0), (5, None, 0), (99999, 0, 0)], "doc_id bigint, quality int, toxic int")
    field = crf_quality.trained(docs, labels, limit=80)
    out = crf_quality.judged(docs, field)
    assert out.columns[:3] == ["doc_id", "text", "other"]
    rows_out = out.collect()
    assert len(rows_out) == len(rows)
    for r in rows_out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_statistics(r.text)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in rows_out if not r.base_failed}
    wrong = sum(kept[i] != bool(q) for i, _, q in known[120:] if i in kept)
    assert wrong <= 2
    assert crf_quality.judged(docs.limit(0), field).count() == 0


def test_no_labels_keep_all(spark):
    docs = spark.createDataFrame([(1, "word " * 3 + prose(random.Random(1), 80))], "doc_id bigint, text string")
    field = crf_quality.trained(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert crf_quality.judged(docs, field).first().kept


def test_viterbi_and_marginals_equal_enumeration():
    random_numbers = np.random.default_rng(2)
    field = crf_quality.Field(random_numbers.normal(size=(2, crf_quality.FEATURES)), random_numbers.normal(size=(2, 2)), random_numbers.normal(size=2))
    x = random_numbers.normal(size=(6, crf_quality.FEATURES))
    scores = x @ field.emit.T
    paths = [[k >> i & 1 for i in range(6)] for k in range(64)]
    weight = np.array([field.first[p[0]] + sum(scores[i, y] for i, y in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:])) for p in paths])
    assert field.decode(x).tolist() == paths[int(np.argmax(weight))]
    chance = np.exp(weight) / np.exp(weight).sum()
    state, move = field.marginals(np.concatenate([x, np.zeros((2, crf_quality.FEATURES))])[None], np.array([[True] * 6 + [False] * 2]))
    for i in range(6):
        assert abs(state[0, i, 1] - sum(c for c, p in zip(chance, paths) if p[i])) < 1e-9
    assert abs(move[0, 3, 1, 0] - sum(c for c, p in zip(chance, paths) if p[2:4] == [1, 0])) < 1e-9
    assert state[0, 6:].sum() == move[0, 6:].sum() == 0


# License scans


def test_alignment():
    a = "a b c x d e".split()
    assert [a[i] for i, _ in patience.align(a, "a b y c d d e".split())][:3] == ["a", "b", "c"]
    assert patience.align([], a) == patience.align(a, []) == []
    assert [(i, j) for i, j in patience.align(a, a)] == [(i, i) for i in range(6)]
    pairs = patience.align("p q r p s".split(), "p z q r p s".split())
    assert pairs == [(0, 0), (1, 2), (2, 3), (3, 4), (4, 5)] or pairs == [(1, 2), (2, 3), (3, 4), (4, 5)]
    assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))


def test_licenses(spark):
    pick = random.Random(2)
    mit = patience.TEMPLATES["MIT"]
    words = mit.split()
    worn = " ".join("EDIT" if pick.random() < 0.08 else w for w in words)
    half = " ".join(words[: len(words) // 2])
    apache = patience.TEMPLATES["Apache-2.0 notice"]
    texts = {
        "whole": (prose(pick, 200) + "\n" + mit + "\n" + prose(pick, 50), "MIT"),
        "worn": (prose(pick, 50) + worn, "MIT"),
        "half": (half, None),
        "notice": (prose(pick, 300) + "\n" + apache, "Apache-2.0 notice"),
        "twice": ((apache + "\n" + prose(pick, 30) + "\n") * 5, "Apache-2.0 notice"),
        "scattered": (" filler words stand between ".join(apache.split()), None),
        "prose": (prose(pick, 500), None),
        "long": ("licensed under the version 2 " * 20_000 + apache, "Apache-2.0 notice"),
        "none": (None, None),
        "empty": ("", None),
    }
    docs = spark.createDataFrame([(n, t, "clash", 1) for n, (t, _) in texts.items()], "doc_id string, text string, licenses string, begin int")
    out = patience.scanned(docs)
    assert out.columns == ["doc_id", "text", "begin", "licenses"]
    found = {r.doc_id: r.licenses for r in out.collect()}
    assert {n: (ls[0].name if ls else None) for n, ls in found.items()} == {n: name for n, (_, name) in texts.items()}
    assert found["whole"][0].coverage == 1.0
    span = patience.words_of(texts["whole"][0])[found["whole"][0].begin : found["whole"][0].end]
    assert span == patience.words_of(mit)
    assert patience.scanned(docs.limit(0)).count() == 0
    assert [r.licenses for r in patience.scanned(docs, templates={}).collect()] == [[]] * len(texts)


def full_slide(template, words):
    """Windows at every word, all of them aligned."""
    best = None
    for begin in range(len(words)):
        pairs = patience.align(template, words[begin : begin + int(len(template) / patience.DENSITY)])
        for n in range(len(pairs), 0, -1):
            runs = [pairs[s : s + n] for s in range(len(pairs) - n + 1)]
            run = next((r for r in runs if n >= patience.DENSITY * (r[-1][1] + 1 - r[0][1])), None)
            if run:
                rank = (n, -begin - run[0][1], begin + run[-1][1] + 1)
                best = rank if n >= patience.COVERAGE * len(template) and (best is None or rank[:2] > best[:2]) else best
                break
    return best and (best[0] / len(template), -best[1], best[2])


def test_licenses_equal_a_full_slide():
    pick = random.Random(9)
    template = patience.words_of(patience.TEMPLATES["Apache-2.0 header"])[:40]
    scanner = patience.Scanner({"t": " ".join(template)}, patience.COVERAGE, patience.DENSITY)
    hits = 0
    for _ in range(60):
        text = []
        for _ in range(pick.randint(1, 3)):
            text += pick.choices([*template, "x", "y", "z"], k=pick.randint(0, 60))
            lost, more = pick.choice((0, 0.1, 0.2)), pick.choice((0, 0.2, 0.5))
            for w in template:
                text += [w] * (pick.random() >= lost) + ["filler"] * (pick.random() < more)
        expected, found = full_slide(template, text), scanner.scan(" ".join(text))
        assert [f[1:3] for f in found] == ([expected[:2]] if expected else [])
        hits += len(found)
    assert hits > 20


def test_license_without_its_rarest_words():
    words = [w for w in patience.words_of(patience.TEMPLATES["MIT"]) if w not in ("hereby", "granted", "free")]
    text = " ".join(["hereby granted free", "filler " * 1000, *words])
    found = {f[0]: f for f in patience.Scanner(patience.TEMPLATES, patience.COVERAGE, patience.DENSITY).scan(text)}
    assert found["MIT"][1] > 0.95 and found["MIT"][2:] == (1003, 1003 + len(words))
    # As many words put in as the density allows.
    text = " ".join(w + " filler" * (i % 3 == 0) for i, w in enumerate(patience.words_of(patience.TEMPLATES["MIT"])))
    assert patience.Scanner(patience.TEMPLATES, patience.COVERAGE, patience.DENSITY).scan(text)[0][0] == "MIT"
