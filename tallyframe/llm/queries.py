"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import (
    bitpack,
    bpe,
    byte_cnn,
    crf_quality,
    html_extract,
    jaccard,
    link_graph,
    maxent_lm,
    mixing,
    patience,
    prefix_trie,
    spelling,
    sql,
    topk,
)
from tallyframe.llm.store import written


def vocabulary(name: str) -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def op1_html_lstm(spark: SparkSession, directory: str) -> DataFrame:
    pages = _table(spark, directory, "pages").select("page_id", "url", "html")
    out = html_extract.extracted(pages, html_extract.trained(pages))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_ngram_jaccard(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text")
    out = jaccard.linked(docs, width=4, num=85, den=100)
    return out.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


#: Sources weigh 5, 2, 1 in turn; the mix holds 150 % of all words; no source and no document is taken more than twice.
MIX = {"weights": (5, 2, 1), "share": 1.5, "cap": 2.0}


def op3_mixing(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text", "source")
    out = mixing.copies(docs, **MIX)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def op4_bpe(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text")
    out = bpe.encoded(docs, vocabulary("word_bpe_49k.json"), decoded="decoded")
    return out.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_maxent_lm(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    out = maxent_lm.scored(docs, ~held_out)
    return out.select(
        F.col("id").alias("doc_id"), (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_line_crf(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text")
    field = crf_quality.trained(docs, _table(spark, directory, "labels"))
    return crf_quality.judged(docs, field).select("doc_id", *crf_quality.STATISTICS, "base_failed", "kept")


def op7_patience(spark: SparkSession, directory: str) -> DataFrame:
    docs = patience.scanned(_table(spark, directory, "documents").select("doc_id", "text"))
    best = F.get("licenses", F.lit(0))
    return docs.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        best["name"].alias("license"),
        best["coverage"].alias("coverage"),
        best["begin"].alias("begin_word"),
        best["end"].alias("end_word"),
    )


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op8_link_graph(spark: SparkSession, directory: str) -> DataFrame:
    pages = _table(spark, directory, "pages").select("page_id", "url", "html")
    return link_graph.judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op9_top_k(spark: SparkSession, directory: str) -> DataFrame:
    return topk.top_k(_table(spark, directory, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0, k=5)


def op10_token_ids(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text")
    out = bitpack.stored(docs, vocabulary("byte_bpe_50k.json"), end_id=2)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_byte_cnn(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    network = byte_cnn.trained(docs, _table(spark, directory, "labels").where(fold != 0))
    out = byte_cnn.scored(docs, network).withColumn("held_out", fold == 0)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_spelling(spark: SparkSession, directory: str) -> DataFrame:
    words = spelling.counted(_table(spark, directory, "documents").select("doc_id", "text"))
    out = spelling.grouped(written(words, "vocabulary"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def op13_prefix_trie(spark: SparkSession, directory: str) -> DataFrame:
    return prefix_trie.nodes(_table(spark, directory, "conversations").select("conv_id", "turn", "role", "text"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_lstm": op1_html_lstm,
        "op2_ngram_jaccard": op2_ngram_jaccard,
        "op3_mixing": op3_mixing,
        "op4_bpe": op4_bpe,
        "op5_maxent_lm": op5_maxent_lm,
        "op6_line_crf": op6_line_crf,
        "op7_patience": op7_patience,
        "op8_link_graph": op8_link_graph,
        "op9_top_k": op9_top_k,
        "op10_token_ids": op10_token_ids,
        "op11_byte_cnn": op11_byte_cnn,
        "op12_spelling": op12_spelling,
        "op13_prefix_trie": op13_prefix_trie,
    }


def statements() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {
        "op2_ngram_jaccard": sql.NGRAM_JACCARD,
        "op9_top_k": sql.TOP_K,
        "op12_spelling": sql.SPELLING,
        "op13_prefix_trie": sql.PREFIX_TRIE,
    }
