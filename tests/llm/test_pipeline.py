"""The pipeline, stage by stage, against brute force on the smallest tables."""

import hashlib

import corpus_pipeline as pipeline
import public_tokenizers
import tiktoken
from ledgerloom.llm import quality
from ledgerloom.llm.byte_bpe import load_ranks
from ledgerloom.llm.common import staged
from tests.llm.test_operators import brute_mix, brute_near, brute_spans


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in pipeline.STAGES:
        out = staged(stage(spark, docs, "unused"), "test")
        kept.append((name, docs, out))
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, f) = kept
    judged = {r.doc_id: (r.kept, r.clean_text) for r in quality.quality_rules(a).collect()}
    assert {r.doc_id: r.text for r in b.collect()} == {i: t for i, (k, t) in judged.items() if k}
    assert all(r.n_chars == len(r.text) for r in b.collect())
    near = brute_near([(r.doc_id, r.text) for r in b.collect()])
    assert sorted(r.doc_id for r in c.collect()) == sorted(i for i, x in near.items() if x[2])
    spans = {x[0]: x for x in brute_spans([(r.doc_id, r.text) for r in c.collect()])}
    for r in d.collect():
        if spans[r.doc_id][2] == 0 or r.text.isascii():
            assert hashlib.sha256(r.text.encode()).hexdigest() == spans[r.doc_id][4]
    sizes, target = brute_mix([(r.doc_id, r.text, r.source) for r in d.collect()])
    taken, most = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in e.collect():
        n = len(r.text.split())
        taken[r.source] += n
        most[r.source] = max(most[r.source], n)
    assert all(abs(taken[s] - target[s]) <= max(most[s], 1) for s in sizes)
    coder = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(public_tokenizers.path(pipeline.RANKS)), special_tokens={}
    )
    assert sorted((r.doc_id, tuple(r.ids)) for r in f.collect()) == sorted((r.doc_id, tuple(coder.encode_ordinary(r.text))) for r in e.collect())
