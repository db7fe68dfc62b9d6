"""The registered queries themselves, over the supplied tables, against plain Python and the tokenizers library."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tallyframe.llm import patience, queries
from tests.llm.test_groups_and_search import brute_groups, brute_sets
from tests.llm.test_models import brute_statistics

tokenizers = pytest.importorskip("tokenizers")

HERE = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{HERE}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def by_id(frame, columns):
    assert frame.columns[: len(columns)] == columns
    return {r[0]: r for r in frame.collect()}


def test_bpe_query(spark, documents):
    library = tokenizers.Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    found = by_id(queries.op4_bpe(spark, HERE), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    assert len(found) == len(documents)
    for doc_id, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), decoded.encode())]
        assert tuple(found[doc_id]) == (doc_id, len(ids), *digests)


def test_token_file_query(spark, documents):
    library = tokenizers.Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    found, start = by_id(queries.op10_token_ids(spark, HERE), ["doc_id", "start", "n_tokens", "ids_crc32"]), 0
    assert len(found) == len(documents)
    for doc_id, text in documents:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert tuple(found[doc_id]) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_language_model_query(spark, documents):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = {i: [*WORD.findall((t or "").translate(low)), None] for i, t in documents}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, words in texts.items() if not held[i] for w in words)
    total = sum(counts.values())
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = by_id(queries.op5_maxent_lm(spark, HERE), columns)
    assert len(found) == len(documents)
    for i, words in texts.items():
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words)
        row = found[i]
        assert tuple(row)[:5] == (i, held[i], len(words), sum(counts[w] > 0 for w in words), total)
        assert abs(row.base_score - base) < 1e-6 * abs(base) and math.isfinite(row.score) and row.score < 0
    unseen = [i for i in texts if held[i]]
    assert sum(found[i].score for i in unseen) > sum(found[i].base_score for i in unseen)


def test_line_query(spark, documents):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    found = by_id(queries.op6_line_crf(spark, HERE), columns)
    assert len(found) == len(documents)
    for doc_id, text in documents:
        assert tuple(found[doc_id])[1:7] == brute_statistics(text)
        assert not (found[doc_id].base_failed and found[doc_id].kept)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{HERE}/labels.parquet").collect()}
    wrong = sum(found[i].kept != bool(q) for i, q in quality.items() if i in found and not found[i].base_failed)
    assert wrong <= 0.05 * len(quality)


def test_license_query(spark, documents):
    found = by_id(queries.op7_patience(spark, HERE), ["doc_id", "n_licenses", "license", "coverage", "begin_word", "end_word"])
    assert len(found) == len(documents)
    lines = {name: patience.words_of(text) for name, text in patience.TEMPLATES.items() if name.endswith("notice")}
    for doc_id, text in documents:
        words = patience.words_of(text or "")
        whole = {n for n, line in lines.items() if any(words[k : k + len(line)] == line for k in range(len(words)))}
        row = found[doc_id]
        assert row.n_licenses >= len(whole) and (row.license is None) == (row.n_licenses == 0)
        if row.license is not None:
            assert row.coverage >= patience.COVERAGE and 0 <= row.begin_word < row.end_word <= len(words)


def test_url_query(spark):
    rules = [(verdict, *(lambda host, path: (host, f"/{path}/" if path else "/"))(*rule.rstrip("/").partition("/")[::2]), rule) for verdict, rule in queries.URL_RULES]
    pages = spark.read.parquet(f"{HERE}/pages.parquet").select("page_id", "url").collect()
    found = by_id(queries.op8_link_graph(spark, HERE), ["page_id", "host", "path", "rule", "verdict"])
    assert len(found) == len(pages)
    for page in pages:
        host = path = ""
        if "://" in (page.url or ""):
            host, path = re.match(r"([^/?#]*)([^?#]*)", page.url.split("://", 1)[1]).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: len(r[3]), default=None)
        row = found[page.page_id]
        assert (row.host, row.path, row.rule) == (host, path, best[3] if best else None)
        assert row.verdict == best[0] if best else row.verdict in ("allow", "block")


def test_pipeline_query(spark, documents):
    """Every text that is kept passes the rules, no two that are kept link, and each that went as a copy links to one kept."""
    rows = corpus_pipeline.run(spark, HERE).collect()
    source = {i: t for i, t in documents}
    library = tokenizers.Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    for r in rows:
        assert source[r.doc_id] == r.text and not brute_statistics(r.text)[-1]
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids
    times = Counter(r.doc_id for r in rows)
    assert max(times.values()) <= 2
    kept = sorted(times)
    groups = brute_groups(brute_sets([source[i] for i in kept], 5), 80, 100)
    assert len(set(groups)) == len(kept)
