"""The registered queries of the corpus operators and their SQL texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    fingerprints, html_extract, importance, lexical_search, mixing, near_dedup, quality, suffix_dedup, url_filters, warc,
)
from ledgerloom.llm.byte_bpe import encode_texts
from ledgerloom.llm.common import table
from ledgerloom.llm.piece_bpe import encode_pieces
from ledgerloom.llm.token_counts import token_counts
from ledgerloom.session import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Tokens above which a document does not fit.
TOKEN_LIMIT = 512


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_source_mix", mixing.ORACLE)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_token_counts")
def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op5_quality_rules", quality.ORACLE)
def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op7_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_texts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep_ids=False)


@query("op11_piece_bpe")
def piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_pieces(table(spark, sf_dir, "documents"), path, keep_ids=False)


@query("op12_lexical_search", lexical_search.ORACLE)
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_importance_resampling", importance.ORACLE)
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_url_filters", url_filters.ORACLE)
def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


@query("op10_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_and_fingerprint(table(spark, sf_dir, "documents"))


@query("op3_suffix_dedup")
def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op6_near_duplicates", near_dedup.ORACLE)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_warc", warc.ORACLE)
def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    read = warc.read_warc(spark, folder, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))
