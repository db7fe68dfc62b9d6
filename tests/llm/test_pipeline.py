"""The corpus pipeline against brute force, stage by stage, and the entry points of this subpackage."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from tallyframe.llm import crf_quality, queries
from tallyframe.llm.store import shared_folder
from tests.llm.test_groups_and_search import brute_groups, brute_sets
from tests.llm.test_models import brute_statistics, junk, prose

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pick = random.Random(12)
    rows, labels = [], []
    for i in range(120):
        good = pick.random() < 0.7
        text = "\n".join(prose(pick, pick.randint(20, 60)) for _ in range(3)) if good else junk(pick) + "\n" + junk(pick)
        rows.append((i, text, "en", f"src{i % 4}" if i % 9 else None, len(text)))
        labels.append((i, int(good), 0))
    for i in range(120, 160):
        words = rows[i % 20][1].split(" ")
        words[pick.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "en", "src0", 1))
    rows += [(160, None, None, None, None), (161, "", "en", "src1", 0), (162, "few words", "en", "src1", 9), (None, prose(pick, 90), None, "src2", 1), (3, rows[3][1], "en", "src0", 1)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "mix", "encode"]
    states = [docs]
    for _, stage in corpus_pipeline.STAGES:
        states.append(spark.createDataFrame(*_held(stage(spark, states[-1], folder))))
    tables = [[tuple(r) for r in s.collect()] for s in states]
    assert all(s.columns == docs.columns for s in states[:4])

    field = crf_quality.trained(docs, labels)

    def stays(text):
        n, *_, failed = brute_statistics(text)
        features, counts, _ = crf_quality.line_features(text or "")
        return not failed and counts[field.decode(features) == 1].sum() >= 0.5 * n

    assert sorted(map(repr, tables[1])) == sorted(repr(r) for r in tables[0] if stays(r[1]))

    groups = {}
    texts = [r[1] for r in tables[1]]
    for r, g in zip(tables[1], brute_groups(brute_sets(texts, 5), 80, 100)):
        groups.setdefault(g, []).append(r)
    least = sorted(repr(min((r[0] for r in g if r[0] is not None), default=None)) for g in groups.values())
    assert sorted(repr(r[0]) for r in tables[2]) == least
    assert set(tables[2]) <= set(tables[1])

    # Words of each source against its target: 150 % of all words, weights 5, 2, 1, nothing more than twice.
    kept, mixed = {}, {}
    for table, sizes in ((tables[2], kept), (tables[3], mixed)):
        for r in table:
            sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    assert set(tables[3]) <= set(tables[2]) and max(tables[3].count(r) for r in set(tables[3])) <= 2
    assert abs(sum(mixed.values()) - 1.5 * sum(kept.values())) <= 0.02 * sum(kept.values())
    assert all(mixed.get(s, 0) <= 2 * n for s, n in kept.items())

    library = tokenizers.Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    assert sorted(repr(r[:5]) for r in tables[4]) == sorted(map(repr, tables[3]))
    for r in tables[4]:
        assert np.frombuffer(bytes(r[5]), "<u4").tolist() == library.encode(r[1], add_special_tokens=False).ids


def _held(frame):
    return [tuple(r) for r in frame.collect()], frame.schema


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).columns[-1] == "token_ids"
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_names_and_folder(spark):
    names = list(queries.registered())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.statements()) <= set(names)
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_statements_are_sql():
    assert all(isinstance(sql, str) for sql in queries.statements().values())
