"""From raw documents to token ids: quality rules, near and exact repeats, source weights, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.byte_bpe import encode_texts
from ledgerloom.llm.common import staged, table
from ledgerloom.llm.mixing import apply_mix, mix
from ledgerloom.llm.near_dedup import near_duplicates
from ledgerloom.llm.quality import quality_rules
from ledgerloom.llm.suffix_dedup import suffix_dedup

RANKS = "byte_bpe_multi_50k.tiktoken"


def _with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """``docs`` with another text, its length with it."""
    new = {"text": F.col(text).alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    return docs.select(*[new.get(c, F.col(c)) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that fail."""
    others = F.struct(*[F.col(c) for c in docs.columns if c != "text"])
    row = F.struct(others.alias("own"), F.col("kept").alias("kept"), F.col("clean_text").alias("text"))
    # A filter does not move below a generator, where it would compute the rules once more.
    judged = quality_rules(docs).select(F.explode(F.array(row)).alias("row")).filter("row.kept")
    length = F.length("row.text").cast("long")
    new = {"text": F.col("row.text").alias("text"), "n_chars": length.alias("n_chars")}
    return judged.select(*[new[c] if c in new else F.col("row.own")[c].alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id; a repeated row stays once, different texts under one id
    all stay."""
    kept = near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    once = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text")
    named = docs.join(kept, "doc_id", "left_semi").withColumn("_n", F.row_number().over(once)).filter("_n = 1")
    return named.select(*docs.columns).union(docs.filter("doc_id is null"))


def string_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that occur earlier. Documents stay, even if nothing of their text does."""
    return _with_text(suffix_dedup(docs), docs.columns, "kept_text")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return apply_mix(docs, mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of what they decode to."""
    return encode_texts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, memory=100_000)


STAGES = [
    ("quality rules", quality),
    ("near-duplicate removal", near_dedup),
    ("suffix-array dedup", string_dedup),
    ("source mix", source_mix),
    ("byte-level BPE", encode),
]
#: SQL can express neither the removal of repeated bytes nor the encoding; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
