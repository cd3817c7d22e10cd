"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE, WORD, prefix_sums, uniform

#: Characters that count against a document's quality weight.
SYMBOLS = "#*$%&|<>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Words / (words + symbols); 1 without words. A document full of symbols is drawn later."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.coalesce(F.when(size > 0, size / (size + symbols)), F.lit(1.0)).cast("double")


def source_targets(
    totals: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, max_epochs: int = 3
) -> DataFrame:
    """``totals(source, source_size long)`` with ``target double`` added.

    Sources in code point order, null last, take the weights in turn, repeating, and share ``share`` of the sum of all
    sizes. No target is above ``max_epochs`` times the source's size; the excess goes to the others by weight until
    none is above. That is a water level: with sources sorted by cap / weight, the level is the largest of
    (budget - caps before) / (weights from here on).
    """
    placed = prefix_sums(totals, [], ["source"])
    turns = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    weighted = placed.select(
        "source",
        "source_size",
        F.element_at(turns, (F.col("before_rows") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"),
    ).withColumn("ratio", F.col("cap") / F.col("weight"))
    filled = prefix_sums(weighted, ["weight", "cap"], ["ratio", "source"])
    whole = filled.agg((F.sum("source_size") * F.lit(float(share))).alias("budget"), F.sum("weight").alias("all_weights"))
    levels = filled.crossJoin(F.broadcast(whole)).select(  # one row
        ((F.col("budget") - F.col("before_cap")) / (F.col("all_weights") - F.col("before_weight"))).alias("level")
    )
    level = levels.agg(F.max("level").alias("level"))
    return filled.crossJoin(F.broadcast(level)).select(  # one row
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.0,
    max_epochs: int = 3,
    seed: str = "mix",
    quality: Column | None = None,
) -> DataFrame:
    """``(doc_id, source, size, text_hash, source_size, target double, copies long, taken long)``, a row per row of
    ``docs``.

    Reads ``doc_id, source, text`` only. A source whose target is e times its size and a rest is taken e times as a
    whole, every document once per epoch; for the rest its documents are ordered by -ln(u) / w, where u is uniform and
    fixed by the document's id and ``seed`` and w > 0 is its quality weight (words / (words + symbols) unless
    ``quality`` is given), which is weighted sampling without replacement. Their sizes are summed up in that order and
    a document is taken once more if more than half of it lies below the rest: the sum misses the target by at most
    half a document. No document is taken more than ``max_epochs`` times.

    Null texts and texts without words have size 0 and take nothing. A null source is a source, the last one. Rows
    with equal doc_id, source and text are taken together, so reruns agree with repeated rows too; the sum then misses
    the target by at most half of such a group. Keys that tie are ordered by doc_id, size and text hash. Null ids sort
    last; other columns are not read, whatever their names; a text of any length is one row. An empty table gives an empty result.
    """
    size = word_count(F.col("text"))
    rows = docs.select(
        "doc_id", "source", size.alias("size"), F.xxhash64("text").alias("text_hash"), (quality if quality is not None else quality_weight(F.col("text"), size)).alias("w")
    )
    units = rows.groupBy("doc_id", "source", "size", "text_hash", "w").agg(F.count(F.lit(1)).alias("times"))
    chance = uniform(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    units = units.select(
        "doc_id", "source", "size", "text_hash", "times", (-F.log(chance) / F.col("w")).alias("key"), (F.col("size") * F.col("times")).alias("words")
    )
    summed = prefix_sums(units, ["words"], ["key", "doc_id", "size", "text_hash"], ["source"])
    totals = summed.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals, weights, share, max_epochs).withColumnRenamed("source", "_source")
    joined = summed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    more = (F.col("before_words") + F.col("words") / 2.0 <= rest) & (F.col("words") > 0)
    return (
        joined.withColumn("epochs", epochs.cast("long"))
        .withColumn("copies", F.col("epochs") + more.cast("long"))
        .withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select("doc_id", "source", "size", "text_hash", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def apply_mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` with every document repeated as often as the mix takes it; documents that are not taken go."""
    chosen = plan.filter("copies > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_hash").alias("_hash"), "copies"
    ).distinct()
    same = (
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & F.col("source").eqNullSafe(F.col("_source"))
        & (F.xxhash64("text") == F.col("_hash"))
    )
    return (
        docs.join(chosen, same)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(*docs.columns)
    )


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+')) AS size,
         length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{SYMBOLS}', '')) AS symbols
  FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(md5('mix|' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
            / (CASE WHEN size > 0 THEN size::DOUBLE / (size + symbols)::DOUBLE ELSE 1.0 END) AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
f AS (
  SELECT *, coalesce(sum(3 * source_size) OVER o, 0) AS caps, coalesce(sum(weight) OVER o, 0) AS past,
         sum(source_size) OVER () AS budget, sum(weight) OVER () AS weights
  FROM w WINDOW o AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         least((3 * source_size)::DOUBLE, max((budget - caps)::DOUBLE / (weights - past)::DOUBLE) OVER () * weight) AS target
  FROM f),
c AS (
  SELECT k.*, t.source_size, t.target,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_words,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN size > 0 AND before_words + size / 2.0 <= target - epochs * source_size
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
