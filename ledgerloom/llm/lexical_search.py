"""Ranked lexical search by the Best Position Algorithm: impact lists, direct accesses, a threshold from seen positions."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from ledgerloom.llm.common import discard, staged

#: Terms: ASCII letters and digits, and everything beyond ASCII. On lower-cased UTF-8.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Distinct query terms that go to the executors at once; more queries take more rounds over the documents.
ROUND_TERMS = 1_000_000
#: Postings of one block of documents, which is searched in memory.
BLOCK_POSTINGS = 2_000_000
#: Rows of every list read in the first step of a search; each step reads twice as many as the one before.
FIRST_STEP = 16
#: Parts into which the found documents of an item are dealt before the last ranking.
PARTS = 32


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order; A-Z only are lower-cased."""
    return TERM.findall(text.encode().lower()) if text else []


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


class Block:
    """Documents of one block with an impact list for each term: places ordered by falling impact.

    Entry arrays are ordered by document; ``place`` says where an entry stands in the lists, so that a direct access
    finds impact and position of all terms of a document at once.
    """

    def __init__(self, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int) -> None:
        self.starts, self.terms, self.impacts = starts, terms, impacts
        owner = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
        order = np.lexsort((-impacts, terms))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.list_docs, self.list_impacts = owner[order], impacts[order]
        self.list_starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.seen = np.zeros(len(order), bool)
        self.scored = np.zeros(len(starts) - 1, bool)
        self.wanted = np.zeros(n_terms, bool)

    def _access(self, docs: np.ndarray) -> np.ndarray:
        """Scores of documents for the wanted terms; the positions met are marked as seen."""
        begins, sizes = self.starts[docs], self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(sizes)
        entries = np.arange(ends[-1]) + np.repeat(begins - (ends - sizes), sizes)
        own = self.wanted[self.terms[entries]]
        self.seen[self.place[entries[own]]] = True
        return np.add.reduceat(np.where(own, self.impacts[entries], 0), ends - sizes)

    def best(self, query: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores among which are all that can be in the k best and score ``floor`` at least, and the
        number of documents scored.

        All lists are read in step. Every document met is looked up in all lists, which marks its positions there. The
        best position of a list is the last of those seen without a gap from its top; a document not yet met stands
        behind it in every list, so its score is at most the sum of the impacts next to the best positions. The search
        stops when that sum is strictly below the k-th score (or ``floor``): a document that ties is still met.
        """
        begins, ends = self.list_starts[query], self.list_starts[query + 1]
        begins, ends, query = begins[ends > begins], ends[ends > begins], query[ends > begins]
        self.wanted[query] = True
        position, read, step = begins.copy(), begins.copy(), FIRST_STEP
        docs, scores, held = [], [], np.array([], np.int64)
        while len(query):
            upto = np.minimum(read + step, ends)
            rows = [self.list_docs[a:b] for a, b in zip(read, upto, strict=True) if a < b]
            if not rows:
                break
            met = np.unique(np.concatenate(rows))
            met = met[~self.scored[met]]
            if len(met):
                self.scored[met] = True
                score = self._access(met)
                docs.append(met)
                scores.append(score)
                held = np.concatenate([held, score])
                if len(held) > k:
                    held = np.partition(held, len(held) - k)[-k:]
            read, bound = upto, 0
            for i in range(len(query)):
                unseen = ~self.seen[position[i] : ends[i]]
                position[i] += int(unseen.argmax()) if unseen.any() else len(unseen)
                if position[i] < ends[i]:
                    bound += int(self.list_impacts[position[i]])
            if bound < floor or bound <= 0 or (len(held) >= k and bound < held.min()):
                break
            read = np.maximum(read, position)  # rows up to the best position are seen already
            step *= 2
        self.wanted[query] = False
        for a, b in zip(begins, ends, strict=True):
            self.seen[a:b] = False
        if not docs:
            return np.array([], np.int64), np.array([], np.int64), 0
        found, score = np.concatenate(docs), np.concatenate(scores)
        self.scored[found] = False
        least = max(floor, 1, int(np.partition(score, len(score) - k)[-k]) if len(score) > k else 0)
        return found[score >= least], score[score >= least], len(found)


def _postings(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """``(doc_id, n, terms array<int>, counts array<int>)`` of every document: n counts all its terms, the arrays hold
    those of the vocabulary."""
    schema = StructType().add("doc_id", "long").add("n", "long").add("terms", ArrayType(IntegerType()))
    schema = schema.add("counts", ArrayType(IntegerType()))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            sizes, offsets, terms, counts = [], [0], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py())
                own, times = np.unique(np.array([x for x in map(number, words) if x is not None], np.int32), return_counts=True)
                sizes.append(len(words))
                offsets.append(offsets[-1] + len(own))
                terms.append(own)
                counts.append(times.astype(np.int32))
            if sizes:
                arrays = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), np.concatenate(x)) for x in (terms, counts)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *arrays], names=schema.names)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_column).mapInArrow(post, schema)


def _frequencies(postings: DataFrame, n_terms: int) -> np.ndarray:
    """Number of documents by term: one row per term at most, which bounds what the driver gets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["term", "df"])

    counted = postings.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(n_terms, np.int64)
    for row in counted.collect():
        out[row.term] = row.df
    return out


def _search(
    postings: DataFrame, queries: list[tuple[int, np.ndarray]], weights: np.ndarray, n_documents: int, n_terms: int, limit: int
) -> DataFrame:
    """``(query long, doc_id long, score long)``: the ``limit`` best documents of every task for every query."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {q: (np.array([], np.int64),) * 3 for q, _ in queries}  # score, is null, id

        def block(ids: list, sizes: list, terms: list, counts: list, lengths: list) -> None:
            lengths, tf = np.concatenate(lengths), np.concatenate(counts).astype(np.int64)
            n, owned = np.concatenate(sizes), np.concatenate(terms)
            # Above 2^63 the products need integers of any size.
            safe = int(n.max()) * 50 * n_documents < 2**63
            m = 50 + (50 * n * n_documents // n_terms if safe else np.array([50 * int(x) * n_documents // n_terms for x in n], np.int64))
            impacts = weights[owned] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, lengths)))
            own = Block(np.concatenate([[0], np.cumsum(lengths)]), owned, impacts, len(weights))
            ids = pa.concat_arrays(ids)
            null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for q, wanted in queries:
                before = kept[q]
                floor = int(before[0][-1]) if len(before[0]) >= limit else 1
                docs, scores, _ = own.best(wanted, limit, floor)
                if len(docs):
                    score, none, doc = (np.concatenate(x) for x in zip(before, (scores, null[docs], ids[docs]), strict=True))
                    order = np.lexsort((doc, none, -score))[:limit]
                    kept[q] = score[order], none[order], doc[order]

        held: tuple[list, ...] = ([], [], [], [], [])
        size = 0
        for batch in batches:
            lists = batch.column(2)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = batch.column(0), batch.column(1).to_numpy(), lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy(), lengths
            for part, values in zip(held, row, strict=True):
                part.append(values)
            size += int(lengths.sum())
            if size >= BLOCK_POSTINGS:
                block(*held)
                held, size = ([], [], [], [], []), 0
        if size:
            block(*held)
        for q, (score, none, doc) in kept.items():
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * len(score), pa.int64()), pa.array(doc, mask=none.astype(bool)), pa.array(score)],
                    names=["query", "doc_id", "score"],
                )

    return postings.filter(F.size("terms") > 0).mapInArrow(search, "query long, doc_id long, score long")


def _top(found: DataFrame, keys: list[str], limit: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= limit)


def search(
    docs: DataFrame, items: DataFrame, limit: int = 50, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", query_column: str = "text",
) -> DataFrame:
    """``(item, rank int, doc_id long, score long)``: the ``limit`` highest-scoring documents of every row of ``items``.

    Scores are sums of integer impacts, see ``weight`` and ``_search``; equal ones rank by ascending id, nulls last.
    Documents are cut into blocks of about BLOCK_POSTINGS postings; each block is searched by itself for every item, with
    the score to beat from the blocks before it in the same task, and the blocks' best are ranked in two steps. So no
    list of a term has to fit into one task. Queries go in rounds of about ROUND_TERMS terms, each a pass over the
    documents, so what is sent to the executors is bounded.

    Null and empty texts have no terms: such documents count for nothing, such items give no rows, and neither do items
    that no document scores above 0 for. Repeated documents are documents of their own, repeated items too. Empty tables
    give an empty result; other columns are not read. A text must fit into a worker.
    """
    spark = docs.sparkSession
    named = items.select(F.monotonically_increasing_id().alias("query"), F.col(item_column).alias("item"), F.col(query_column).alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(set(terms_of(text.as_py()))) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in own], pa.int64()), pa.array(own, pa.list_(pa.binary()))],
                names=["query", "item", "size", "terms"],
            )

    schema = StructType([*named.select("query", "item").schema.fields]).add("size", LongType()).add("terms", ArrayType(BinaryType()))
    asked = staged(named.mapInArrow(split, schema), "queries")
    rounds = max(1, -(-(asked.agg(F.sum("size")).first()[0] or 0) // ROUND_TERMS))
    result = None
    for number in range(rounds):
        rows = asked.filter((F.pmod(F.xxhash64("query"), F.lit(rounds)) == number) & (F.col("size") > 0)).select("query", "terms").collect()
        vocabulary = {term: i for i, term in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
        queries = [(r.query, np.array(sorted(vocabulary[bytes(t)] for t in r.terms), np.int64)) for r in rows]
        postings = staged(_postings(docs, vocabulary, id_column, text_column), "postings")
        totals = postings.agg(F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("docs"), F.sum("n").alias("terms")).first()
        n_documents, n_terms = totals.docs or 0, totals.terms or 1
        weights = np.array([weight(n_documents, int(df)) for df in _frequencies(postings, len(vocabulary))] or [0], np.int64)
        found = staged(_search(postings, queries, weights, n_documents, n_terms, limit), "found")
        discard(postings)
        result = found if result is None else result.union(found)
    parts = result.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    best = _top(_top(parts, ["query", "part"], limit).drop("rank"), ["query"], limit)
    return best.join(asked.select("query", "item"), "query").select(F.col("item").alias(item_column), "rank", "doc_id", "score")


ORACLE = r"""
WITH terms AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
totals AS (SELECT count(*) FILTER (WHERE len(words) > 0) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM terms),
wanted AS (
  SELECT DISTINCT item_no, item_id, term FROM (
    SELECT row_number() OVER () AS item_no, item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)),
postings AS (
  SELECT row_no, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_no, doc_id, len(words)::BIGINT AS n, unnest(words) AS term FROM terms)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, totals GROUP BY term),
impacts AS (
  SELECT row_no, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS impact
  FROM postings JOIN weights USING (term), totals),
scores AS (
  SELECT item_no, item_id, row_no, doc_id, sum(impact)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""
