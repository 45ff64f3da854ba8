"""Queries of the operators in this package: name -> (function of session and folder, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, chat, embeddings, html_text, jaccard, language, licences, packing, phrases, quality, ranked, substrings
from .common import prepare, read_table


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """All documents and all pages; the text model is fitted on labelled documents."""
    prepare(spark)
    docs, pages = read_table(spark, folder, "documents"), read_table(spark, folder, "pages")
    languages, model = language.fit_text(docs)
    found = language.identify(language.document_records(docs).unionByName(language.page_records(pages)), languages, model)
    number = lambda kind: F.when(F.col("kind") == kind, F.col("id").cast("long"))
    return found.select("kind", number("document").alias("doc_id"), number("page").alias("page_id"), "lang",
                        F.round("probability", 6).alias("probability"), "text_lang", "declared", "host", "n_trigrams", "kept")


def op2_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(read_table(spark, folder, "documents"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """A row per passage that repeats an earlier document (``home_id``), with its words in the later one."""
    found = substrings.repeated_passages(read_table(spark, folder, "documents"))
    spans = F.explode(F.arrays_zip("starts", "ends", "homes")).alias("x")
    return found.select("doc_id", "n_words", spans).select(
        "doc_id", F.col("x.homes").alias("home_id"), F.col("x.starts").alias("start_word"), F.col("x.ends").alias("end_word"), "n_words")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(read_table(spark, folder, "embeddings"))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(read_table(spark, folder, "documents"))


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_digests(chat.with_test_conversation(read_table(spark, folder, "conversations")))


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_join(read_table(spark, folder, "documents"))


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read_table(spark, folder, "pages"))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit(packing.sized(read_table(spark, folder, "documents")))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.token_alignment(read_table(spark, folder, "documents"))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.decontaminate(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.ranked_search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


QUERIES = {
    "op1_language_id": (op1_language_id, None),
    "op2_licence_scan": (op2_licence_scan, None),
    "op3_substring_dedup": (op3_substring_dedup, None),
    "op4_quality_rules": (op4_quality_rules, None),
    "op5_embedding_near_dedup": (op5_embedding_near_dedup, None),
    "op6_byte_bpe": (op6_byte_bpe, None),
    "op7_chat_format": (op7_chat_format, None),
    "op8_jaccard_join": (op8_jaccard_join, None),
    "op9_html_text": (op9_html_text, None),
    "op10_best_fit_packing": (op10_best_fit_packing, None),
    "op11_token_alignment": (op11_token_alignment, None),
    "op12_decontamination": (op12_decontamination, phrases.SQL),
    "op13_ranked_search": (op13_ranked_search, ranked.SQL),
}
