"""The contract queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import (centroids, decontamination, fill_in_middle, html_text, near_duplicates, private_data, quality, secrets, sql,
                          substrings, token_files, topk, unigram, url_filter)
from clinlake.llm.common import cut, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.secrets(table(spark, sf_dir, "documents")))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = cut(quality.feature_table(table(spark, sf_dir, "documents")))  # the texts are read once
    model = quality.fit(quality.labelled(features, table(spark, sf_dir, "labels"), lambda i: ~quality.held_out(i)))
    return quality.scores(features, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return token_files.read(manifest)


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = unigram.Model.load(tokenizer_file("piece_bpe_32k.model"))
    return unigram.round_trip(table(spark, sf_dir, "documents"), model).select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
        F.length("text").cast("long").alias("n_decoded"), F.sha2("text", 256).alias("decoded_sha256"))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = substrings.whole_documents(table(spark, sf_dir, "documents"))
    return substrings.remove_repeats(docs, texts=False).withColumnRenamed("kept", "kept_sha256")


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(table(spark, sf_dir, "pages"))


@query
def op6_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.digest(private_data.private_spans(table(spark, sf_dir, "documents")))


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.85)


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows.filter(F.col("vec_id").cast("long") % 50 == 0), rows, k=5)


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents")))


@query
def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(html_text.main_text(table(spark, sf_dir, "pages")))


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5)


SQL |= {"op1_substring_dedup": sql.OP1, "op5_url_filter": sql.OP5, "op7_near_duplicates": sql.OP7,
        "op8_decontamination": sql.OP8, "op9_top_k": sql.OP9, "op11_fill_in_middle": sql.OP11, "op12_html_text": sql.OP12,
        "op13_centroids": sql.OP13}
