"""Ranked search and importance resampling against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import importance, lexical_search
from tests.llm.conftest import EDGE

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_search(docs, items, limit):
    split = [(i, TERM.findall((t or "").translate(LETTERS))) for i, t in docs]
    total, all_terms = sum(bool(w) for _, w in split), sum(len(w) for _, w in split)
    df = collections.Counter(t for _, w in split for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for i, words in split:
            tf, score = collections.Counter(words), 0
            for t in set(TERM.findall((text or "").translate(LETTERS))) & tf.keys():
                m = 100 - 50 + (50 * len(words) * total) // all_terms
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:limit])]
    return sorted(out, key=repr)


ITEMS = [(1, "a B c, thé 中文"), (1, "a B c, thé 中文"), (2, None), (3, ""), (None, "one two seven x-y"), (4, "nothing of this"), (5, "A a A " * 4000)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, 7, 8) for i, t in ITEMS], "item_id long, text string, rank int, score long")


@pytest.mark.parametrize("limit, postings", [(50, 2_000_000), (3, 4), (1, 1)])
def test_search_edges(spark, edge, items, limit, postings, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "FIRST_STEP", 1)
    got = sorted(map(tuple, lexical_search.search(edge, items, limit).collect()), key=repr)
    assert got == brute_search([(i, t) for i, t, _ in EDGE], ITEMS, limit)


def test_search_in_rounds(spark, documents, items, monkeypatch):
    asked = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute_search([tuple(r) for r in documents.select("doc_id", "text").collect()], [tuple(r) for r in asked.collect()], 10)
    monkeypatch.setattr(lexical_search, "ROUND_TERMS", 100)
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", 3000)
    assert sorted(map(tuple, lexical_search.search(documents.repartition(3), asked, 10).collect()), key=repr) == want


def test_search_of_nothing(spark, edge, items):
    assert lexical_search.search(edge.limit(0), items).count() == 0
    assert lexical_search.search(edge, items.limit(0)).count() == 0
    assert lexical_search.search(edge.filter("doc_id = 3"), items).count() == 0


@settings(max_examples=300, deadline=None)
@given(rows=st.lists(st.dictionaries(st.integers(0, 4), st.integers(0, 6), max_size=5), min_size=1, max_size=40), k=st.integers(1, 6), data=st.data())
def test_block_search_finds_all_ties(rows, k, data):
    query = np.array(sorted(data.draw(st.sets(st.integers(0, 4), min_size=1))))
    starts = np.cumsum([0, *map(len, rows)])
    terms = np.array([t for r in rows for t in sorted(r)], np.int32)
    impacts = np.array([r[t] for r in rows for t in sorted(r)], np.int64)
    block = lexical_search.Block(starts, terms, impacts, 5)
    want = sorted(((sum(r.get(t, 0) for t in query), -i) for i, r in enumerate(rows)), reverse=True)
    want = [(-i, s) for s, i in want if s > 0][:k]
    for _ in range(2):  # nothing stays behind from a search
        docs, scores, _ = block.best(query, k, 1)
        assert sorted(zip(docs.tolist(), scores.tolist(), strict=True), key=lambda x: (-x[1], x[0]))[:k] == want


def test_search_stops_early():
    rng = np.random.default_rng(1)
    n = 5000
    starts = np.arange(n + 1) * 3
    impacts = np.sort(rng.zipf(1.3, (n, 3)).clip(max=10**9), axis=1)[:, ::-1].reshape(-1).astype(np.int64)
    block = lexical_search.Block(starts, np.tile(np.arange(3, dtype=np.int32), n), impacts, 3)
    _, _, scored = block.best(np.arange(3), 10, 1)
    assert 10 <= scored < n / 5


def brute_resample(docs, target, percent, min_words, buckets, longest):
    def features(text):
        words = WORD.findall((text or "").translate(LETTERS))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(x.encode()) % buckets for x in runs]

    own = [(i, *features(t)) for i, t in docs]
    s, t = collections.Counter(b for x in own for b in x[2]), collections.Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, n, found in own:
        gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in found]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= min_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = percent * len(able) // 100
    rows = [(*able[k][:1], *able[k][2:], k + 1 if k < drawn else None) for k in range(len(able))]
    return sorted(rows + [(*x[:1], *x[2:], None) for x in out if x[1] < min_words], key=repr)


@pytest.mark.parametrize("longest, percent", [(1, 10), (2, 50), (3, 100)])
def test_resample(spark, documents, longest, percent):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = importance.resample(documents.repartition(5), target, percent, buckets=997, longest=longest).collect()
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == brute_resample(docs, [r.text for r in target.collect()], percent, 20, 997, longest)


def test_resample_edges(spark, edge, items):
    got = sorted(map(tuple, importance.resample(edge, items, 60, 2).collect()), key=repr)
    want = brute_resample([(i, t) for i, t, _ in EDGE], [t for _, t in ITEMS], 60, 2, 10_000, 1)
    assert got == want
    assert importance.resample(edge.limit(0), items).count() == 0
    empty = importance.resample(edge, items.limit(0), 100, 1).collect()
    assert len(empty) == len(EDGE) and sorted(r.rank for r in empty if r.rank) == list(range(1, 9))


@pytest.mark.parametrize("samples", [50, 400, 200_000])
def test_ranks_split_ties(spark, samples, monkeypatch):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 2500, 7).otherwise(F.col("id") % 11).cast("long").alias("score"),
        F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).cast("long").alias("doc_id"),
    ).repartition(6)
    seen = []
    stage = importance.staged
    monkeypatch.setattr(importance, "staged", lambda df, name: seen.append((name, stage(df, name))) or seen[-1][1])
    got = importance.exact_ranks(rows, samples, 300).collect()
    assert sorted(r.rank for r in got) == list(range(1, 4001))
    order = [(-r.score, r.doc_id) for r in sorted(got, key=lambda r: r.rank)]
    assert order == sorted(order)
    sizes = dict(seen)["segments"].groupBy("segment").count().collect()
    step = -(-4000 // samples)
    assert len(sizes) == 14 and max(r["count"] for r in sizes) <= 4000 / 14 + 6 * step + step
