"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next one.

Line quality, then near-duplicates, then mixing to source weights, then token ids.  All stages but the last give the
columns that came in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import bpe, crf_quality, jaccard, mixing
from tallyframe.llm.queries import MIX, vocabulary
from tallyframe.llm.store import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels keep, with the columns that came in.

    Null and empty texts have no words, fail the base rules and go.  Rows are judged each by its text, so repeated rows
    and equal texts stay or go together; ids may be null or repeat.  Columns named like the operator's own are kept as
    they came.  Without labels every line counts as content and the base rules alone decide.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    kept = crf_quality.judged(docs, crf_quality.trained(docs, labels)).where("kept")
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more, with all its columns.

    The smallest id stays (null after all others; of equal ids the smallest hash of the text, of repeated rows one).
    Texts without words, null or empty, belong to no group and all stay.  No column of the operator's is added.
    """
    return jaccard.deduplicated(docs, width=5, num=80, den=100, passes=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with the columns that came in.

    Null is a source of its own; texts without words have size 0 and follow the share of their source.  Repeated rows are
    documents each; of rows with equal id, source and text, a hash of the other columns decides which is taken more often.
    """
    return mixing.mixed(docs, **MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (binary, little-endian unsigned 32-bit) of every document, after all columns that came in.

    A null or empty text gives no ids.  Repeated rows stay; a column ``token_ids`` that came in is replaced.
    """
    return bpe.encoded(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("mix", mix), ("encode", encode)]

#: Training, sampling and tokenizing are not expressible in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the documents in ``sf_dir``; each stage's table is written and read again by the next.

    An empty table of documents gives an empty result with the same columns.
    """
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
