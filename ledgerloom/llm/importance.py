"""Importance resampling towards a target distribution: gains by hashed feature, exact ranks by regular sampling."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerloom.llm.common import discard, staged

#: Words: lower-case letters, digits and everything beyond ASCII. On lower-cased UTF-8.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BUCKETS = 10_000
#: Rows of the sorted runs that the driver sees as regular samples, at most.
MAX_SAMPLES = 200_000
#: Rows of one segment after the exchange, about.
SEGMENT_ROWS = 200_000
#: Bits of a row's number inside its partition.
INNER = (1 << 33) - 1
ROW_NUMBER = F.monotonically_increasing_id


def features_of(text: str | None, longest: int) -> tuple[int, list[bytes]]:
    """Number of words, and all runs of 1 to ``longest`` consecutive words."""
    words = WORD.findall(text.encode().lower()) if text else []
    found = list(words)
    for size in range(2, longest + 1):
        found += [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    return len(words), found


def hashed(texts: DataFrame, id_column: str | None, text_column: str, buckets: int, longest: int) -> DataFrame:
    """``(doc_id long, n_words long, n_features long, buckets binary)``: the bucket of every feature as 4 bytes."""
    schema = "doc_id long, n_words long, n_features long, buckets binary"
    own = F.col(id_column).cast("long") if id_column else F.lit(None).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc32 = zlib.crc32
        for batch in batches:
            words, sizes, out = [], [], []
            for text in batch.column(1):
                n, found = features_of(text.as_py(), longest)
                words.append(n)
                sizes.append(len(found))
                out.append((np.array([crc32(x) for x in found], np.uint32) % buckets).astype(np.uint32).tobytes())
            arrays = [batch.column(0), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "buckets"])

    return texts.select(own.alias("doc_id"), text_column).mapInArrow(run, schema)


def _in_buckets(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), np.uint32)


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket; the driver gets one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_in_buckets(batch, 0), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in features.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: 1000 times the logarithm of the target's smoothed share over the source's, rounded down."""
    size, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (all_source + size) / ((s + 1) * (all_target + size))))
         for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """A Gumbel value fixed by seed and id, in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)``: gains are looked up in an array, summed per document by segments."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            totals = np.concatenate([[0], np.cumsum(gain[_in_buckets(batch, 3)])])
            ends = np.cumsum(sizes)
            weight = (totals[ends] - totals[ends - sizes]) // np.maximum(sizes, 1)
            extra = np.array([noise(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            arrays = [*batch.columns[:3], pa.array(weight), pa.array(weight + extra)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight", "score"])

    return features.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def _order() -> list[Column]:
    """The order of ranks. Run and place tell rows apart that tie in everything, so that copies of a row can be split."""
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("run"), F.col("place")]


def exact_ranks(rows: DataFrame, max_samples: int = MAX_SAMPLES, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``rows`` with ``rank long``, 1 for the highest score, ties by ascending doc_id, nulls last, then in any order.

    Parallel sorting by regular sampling. Each task sorts its rows into a run, which is written with the rows' places.
    Every step-th row of each run is a sample, and every so many samples in order a splitter: a segment then has at most
    (rows / segments + runs * step) rows, whatever the values; equal keys are told apart by run and place. The segments
    are exchanged, each to a task of its own, where the pieces of the runs are merged by a local sort; the ranks are the
    places there plus the number of rows in earlier segments. Samples are bounded by ``max_samples``.
    """
    spark = rows.sparkSession
    local = rows.sortWithinPartitions(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    local = local.withColumn("run", F.spark_partition_id()).withColumn("place", ROW_NUMBER().bitwiseAND(F.lit(INNER)))
    runs = staged(local, "runs")
    n = runs.count()
    segments = max(1, min(-(-n // segment_rows), max_samples), min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 1000))
    step = max(1, -(-n // max_samples))
    samples = []
    if segments > 1:
        picked = runs.filter((F.col("place") + 1) % step == 0).select("score", "doc_id", "run", "place")
        samples = sorted((-r.score, r.doc_id is None, r.doc_id or 0, r.run, r.place) for r in picked.collect())
    splitters = [samples[len(samples) * i // segments] for i in range(1, segments)] if samples else []
    schema = StructType([*runs.schema.fields, StructField("segment", IntegerType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, doc, run, place = (batch.column(c).to_pylist() for c in ("score", "doc_id", "run", "place"))
            keys = ((-s, d is None, d or 0, r, p) for s, d, r, p in zip(score, doc, run, place, strict=True))
            own = pa.array([bisect_right(splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, "segment"])

    exchanged = runs.mapInArrow(deal, schema).repartitionById(segments, F.col("segment"))
    merged = exchanged.sortWithinPartitions("segment", *_order()).withColumn("inner", ROW_NUMBER().bitwiseAND(F.lit(INNER)))
    merged = staged(merged, "segments")
    discard(runs)
    sizes = merged.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.min("inner").alias("first")).orderBy("segment").collect()
    before, offsets = 0, []
    for row in sizes:  # one row per segment
        offsets.append((row.segment, before - row.first + 1))
        before += row.n
    offset = spark.createDataFrame(offsets, "segment int, offset long")
    return merged.join(F.broadcast(offset), "segment").select(*rows.columns, (F.col("inner") + F.col("offset")).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, buckets: int = BUCKETS, longest: int = 1,
    seed: int = 2024, id_column: str = "doc_id", text_column: str = "text", target_column: str = "text",
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)``, all long, for every row of ``docs``.

    A feature is a run of 1 to ``longest`` words, its bucket a checksum. ``weight`` is the mean gain of a document's
    features, rounded down, 0 without any; ``score`` adds a Gumbel value fixed by ``seed`` and id, so that the highest
    scores are a sample without replacement by weight. Of the documents with at least ``min_words`` words, ``percent``
    per cent are drawn; they have a rank, the others null.

    Null and empty texts have no features. A null doc_id is written as an empty string for the Gumbel value and comes
    after other ids that tie; repeated rows are documents of their own. Empty tables give an empty result; other columns
    are not read. A text must fit into a worker.
    """
    features = staged(hashed(docs, id_column, text_column, buckets, longest), "features")
    wanted = bucket_counts(hashed(target, None, target_column, buckets, longest), buckets)
    rated = staged(scored(features, gains(bucket_counts(features, buckets), wanted), seed), "scores")
    discard(features)
    ranked = exact_ranks(rated.filter(F.col("n_words") >= min_words))
    drawn = percent * ranked.count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    short = rated.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.union(short).select("doc_id", "n_features", "weight", "score", rank)


ORACLE = r"""
WITH crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS entries FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c
    FROM range(256) t(i))),
texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, false AS wanted, text FROM documents
  UNION ALL SELECT NULL, NULL, true, text FROM benchmark),
lists AS (
  SELECT row_no, doc_id, wanted,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
counted AS (
  SELECT row_no, wanted, word, count(*) AS n
  FROM (SELECT row_no, wanted, unnest(words) AS word FROM lists) GROUP BY ALL),
hashes AS MATERIALIZED (
  SELECT word, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(hex(word)) // 2 + 1), lambda i:
             (strpos('0123456789ABCDEF', substr(hex(word), 2 * i - 1, 1)) - 1) * 16
              + strpos('0123456789ABCDEF', substr(hex(word), 2 * i, 1)) - 1)),
           lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM counted), crc_table),
placed AS MATERIALIZED (SELECT row_no, wanted, bucket, n FROM counted JOIN hashes USING (word)),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE NOT wanted), 0)::BIGINT AS s, coalesce(sum(n) FILTER (WHERE wanted), 0)::BIGINT AS t
  FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::BIGINT AS all_s, coalesce(sum(t), 0)::BIGINT AS all_t FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000))::DOUBLE / ((s + 1) * (all_t + 10000))::DOUBLE))::BIGINT AS gain
  FROM sums, totals),
weights AS (
  SELECT row_no, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
  FROM placed JOIN gains USING (bucket) WHERE NOT wanted GROUP BY row_no),
rated AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight,
         list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 9), lambda i:
           strpos('0123456789abcdef', substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), i, 1)) - 1)),
           lambda a, b: a * 16 + b) AS h
  FROM lists LEFT JOIN weights USING (row_no) WHERE NOT wanted),
scores AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM rated),
ranks AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scores)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
       CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END::BIGINT AS rank
FROM ranks
"""
