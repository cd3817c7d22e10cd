"""Each operator against a brute-force version, and on nulls, empty and long texts, repeated rows and empty tables."""

import collections
import hashlib
import html
import random
import re

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import (
    byte_bpe, common, fingerprints, html_extract, mixing, near_dedup, quality, suffix_dedup, token_counts, url_filters, warc,
)
from tests.llm.conftest import EDGE

RANKS, JSON = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- op 1

def brute_mix(docs, weights=(5, 2, 1)):
    sizes = collections.Counter()
    for _, text, source in docs:
        sizes[source] += len(WORDS.findall(text or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while True:
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * sizes[s]] if open_ else []
        if not over:
            return sizes, target | {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= set(over)


def test_mix_meets_targets(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text", "source").collect()]
    sizes, target = brute_mix(docs)
    got = mixing.mix(documents).collect()
    assert len(got) == len(docs)
    taken, most = collections.Counter(), collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 + 1e-6 for s in sizes)
    again = mixing.mix(documents.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_mix_edges(spark, edge):
    plan = mixing.mix(edge)
    assert plan.count() == len(EDGE)
    assert {r.source for r in plan.collect()} == {"s1", "s2", "s3", None}
    assert plan.filter("size = 0 and taken > 0").count() == 0
    assert mixing.apply_mix(edge, plan).columns == edge.columns
    assert mixing.mix(edge.limit(0)).count() == 0


def test_weighted_prefix_sums_are_exact(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    got = {(r.g, r.o): (r.before_v, r.before_rows) for r in common.prefix_sums(df, ["v"], ["o"], ["g"], 50).collect()}
    sums = collections.defaultdict(lambda: (0, 0))
    for o in range(1000):
        assert got[o % 3, o] == sums[o % 3]
        sums[o % 3] = (sums[o % 3][0] + o % 7, sums[o % 3][1] + 1)


# --- op 2

PAGE = (
    '<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><div class="cookie-notice">We'
    ' use cookies</div><nav>menu</nav><main class="with-sidebar"><article><header><h1>Title &amp; more</h1></header>'
    '<p>One<br>two&nbsp;three<p>Last <b>bold</b>ly &lt;x&gt; a < b</p><div class="ad">BUY</div><form>name</form></article>'
    '<section id="comments"><article class="comment">nice</article></section></main><aside>s</aside><footer>f</footer>'
    "<script>var t='</p>';</script></body></html>"
)


def test_declared_article(spark):
    pages = [(1, "http://a.com/1", PAGE), (2, None, None), (None, "http://a.com/2", ""), (3, "x", "<article>cut off")]
    got = rows_of(html_extract.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")), "page_id", "text")
    assert got == sorted([(1, "Title & more\n\nOne two three\n\nLast boldly <x> a < b"), (2, ""), (None, ""), (3, "cut off")], key=repr)


def test_shared_runs_of_a_host_go(spark):
    fill = " ".join(f"w{i}" for i in range(15))
    pages = [(i, f"http://h.com/{i}", f"<div>{fill}</div><p>word{i} alone {i}</p>") for i in range(4)]
    pages += [(9, "http://other.com/", f"<div>{fill}</div>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_text(df).collect()}
    assert got[9] == (fill, len(fill))
    assert all(got[i] == (f"word{i} alone {i}", len(f"word{i} alone {i}")) for i in range(4))
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_copies_of_a_page_keep_their_text(spark):
    fill, own = " ".join(f"w{i}" for i in range(15)), " ".join(f"v{i}" for i in range(20))
    copy = f"<div>{fill}</div><p>{own}</p>"
    pages = [(1, "http://h.com/1", copy), (2, "http://h.com/2", copy), (3, "http://g.com/3", copy), (4, "http://g.com/4", copy),
             (5, "http://g.com/5", f"<div>{fill}</div><p>other</p>"), (6, None, copy), (7, "no scheme", copy + "<p>more</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_text(df).collect()}
    assert got[1] == got[2] == got[6] == f"{fill}\n\n{own}" and got[7] == f"{fill}\n\n{own}\n\nmore"
    assert got[3] == got[4] == own and got[5] == "other"  # two distinct contents share the fill


def test_text_of_declared_pages_is_compared_too(spark):
    """Text around an article loses what the host's pages share and keeps the rest; articles stay whole, but count."""
    fill, quote = " ".join(f"w{i}" for i in range(14)), " ".join(f"q{i}" for i in range(14))
    around = "<main><h2>Lead {0}</h2><article><p>" + quote + "</p></article><p>end{0} " + fill + "</p></main><p>below</p>"
    pages = [(1, "http://h.com/1", around.format(1)), (2, "http://h.com/2", around.format(2)), (3, "http://g.com/3", around.format(3)),
             (4, "http://g.com/4", f"<article>{quote} {fill}</article>"), (5, "http://g.com/5", f"<p>own {quote}</p>"),
             (6, "http://f.com/6", f"<article>{quote}</article>"), (7, "http://f.com/7", f"<article>{quote} seven</article>")]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in (1, 2, 3)] == [f"Lead {i}\n\n{quote}\n\nend{i}" for i in (1, 2, 3)]
    assert got[4] == f"{quote} {fill}" and got[5] == "own" and got[6] == quote and got[7] == f"{quote} seven"


@pytest.mark.parametrize("batch", [3, 10_000])
def test_suffix_array_shows_the_shared_strings(spark, batch):
    """Compared with all pairs of pages; few words, so that equal strings lie across batches and ranges, with copies."""
    rng = random.Random(batch)
    words = ["a", "b", "b\x01", "é", "ab"]
    rows = [(f"h{i % 2}" if i % 9 else "", i, i % 4 == 0, " ".join(rng.choices(words, [6, 1, 1, 1, 1], k=rng.randrange(14)))) for i in range(60)]
    rows += [("h0", 1000, False, " ".join("uvwxyzuvwxyz")), ("h0", 1001, True, " ".join(["c"] * 3)), *rows[:20]]
    df = spark.createDataFrame(rows, "host string, h long, declared boolean, stream string")
    k, found = 4, collections.defaultdict(set)
    for host, h, _, stream in rows:
        w = stream.split(" ")
        for i in range(len(w) - k + 1):
            found[host, tuple(w[i : i + k])].add(h)
    want = collections.defaultdict(set)
    for host, h, declared, stream in rows:
        w = stream.split(" ")
        want[host, h] |= {i for i in range(len(w) - k + 1) if host and not declared and len(found[host, tuple(w[i : i + k])]) > 1}
    conf = {"spark.sql.execution.arrow.maxRecordsPerBatch": batch, "spark.sql.shuffle.partitions": 9, "spark.sql.adaptive.coalescePartitions.enabled": False}
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        got = {(r.host, r.h): set(r.places) for r in html_extract.shared_places(df, k).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(got) > 20 and got == {key: places for key, places in want.items() if places}


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_extract.extract_text(pages).join(pages.drop("url"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)


# --- op 3

def brute_spans(docs, length=100):
    seen, out = set(), []
    for i, text in sorted(set(docs)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for j, x in enumerate(gone) if x and (j == 0 or not gone[j - 1]))
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("block", [suffix_dedup.BLOCK, 64])
def test_repeated_strings(spark, monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(400)) for _ in range(4)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(3):
            b = rng.choice(base)
            a = rng.randrange(len(b))
            parts += [b[a : a + rng.randrange(300)], rng.choice(["", "x", "yz"])]
        docs.append((i, "".join(parts)))
    docs += [(60, "a" * 99), (61, "a" * 100), (62, "a" * 350), (63, "ab" * 200), (64, None), (65, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(suffix_dedup.suffix_dedup(df), *COLUMNS) == brute_spans(docs)


def test_suffix_dedup_of_the_tables_and_edges(spark, documents, edge):
    assert rows_of(suffix_dedup.suffix_dedup(documents), *COLUMNS) == brute_spans(texts(documents))
    got = suffix_dedup.suffix_dedup(edge).collect()
    assert len(got) == len(EDGE)
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].n_removed == by_id[1].n_bytes and by_id[1].n_removed == by_id[1].n_bytes - 14
    assert by_id[None].n_removed == 0
    assert suffix_dedup.suffix_dedup(edge.limit(0)).count() == 0


# --- op 4 and 7

@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab's \n\t.,é1２中😀\x1c\x85\xa0\u3000", "'ll", " the", "<|endoftext|>"]), max_size=60).map("".join))
def test_encoder_equals_the_library(text):
    assert CODER.encode(text) == REFERENCE.encode_ordinary(text)
    assert CODER.decode(CODER.encode(text)) == text.encode()
    assert sum(COUNT(byte_bpe.blank_chunks(text))) == COUNT([text])[0]


CODER = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
COUNT, _ = token_counts._lengths(JSON)


def test_long_pre_tokens():
    rng = random.Random(1)
    for text in ("a" * 5001, "".join(rng.choice("abc") for _ in range(4000)), "日本" * 1500):
        assert CODER.encode(text) == REFERENCE.encode_ordinary(text)
    assert len(CODER.encode("ab" * 200_000)) > 0


def test_encoding_and_counts(spark, documents, edge):
    own = Tokenizer.from_file(JSON)
    for df in (documents, edge):
        for r in byte_bpe.encode_texts(df, RANKS, public_tokenizers.PATTERN).join(df.select("doc_id", "text").distinct(), "doc_id").collect():
            ids = REFERENCE.encode_ordinary(r.text or "")
            assert (r.n_tokens, r.ids) == (len(ids), ids)
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        for r in token_counts.token_counts(df, JSON).join(df.select("doc_id", "text").distinct(), "doc_id").collect():
            assert r.n_bytes == len((r.text or "").encode())
            assert r.n_tokens == len(own.encode(r.text or "", add_special_tokens=False).ids)
    assert token_counts.token_counts(edge, JSON).count() == len(EDGE)
    assert byte_bpe.encode_texts(edge.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    encoded = byte_bpe.encode_texts(edge, RANKS, public_tokenizers.PATTERN)
    assert rows_of(byte_bpe.decode_ids(encoded, RANKS).withColumn("t", F.col("decoded").cast("string")), "doc_id", "t") == sorted(
        ((i, t or "") for i, t, _ in EDGE), key=repr
    )


def test_other_tokenizers(spark, edge):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = rows_of(token_counts.token_counts(edge, path), "doc_id", "n_tokens")
    assert got == sorted(((i, len(model.encode(t or ""))) for i, t, _ in EDGE), key=repr)


# --- op 5

def test_quality_rules(spark, documents, edge):
    for df in (documents, edge):
        out = quality.quality_rules(df)
        assert out.count() == df.count() and out.columns.count("kept") == 1
        for r in out.collect():
            text = r.text or ""
            words = WORDS.findall(text)
            windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
            covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
            lines = [x for x in text.split("\n") if WORDS.search(x)]
            assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
            assert r.n_dup_lines == len(lines) - len(set(lines))
            assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
            assert r.base_failed == (len(words) < 50 or 2 * len(covered) > len(words))
            assert not (r.kept and r.base_failed)
    assert quality.quality_rules(edge.limit(0)).count() == 0


def test_names_of_own_columns_may_clash(spark, edge):
    clash = edge.withColumns({c: F.lit(1) for c in ("_counts", "kept", "clean_text", "row", "own")})
    plain = rows_of(quality.quality_rules(edge), "doc_id", "n_repeat_words", "kept")
    assert rows_of(quality.quality_rules(clash), "doc_id", "n_repeat_words", "kept") == plain
    stage = corpus_pipeline.quality(spark, clash, "")
    assert stage.columns == clash.columns and stage.count() == sum(r[2] for r in plain)


def test_line_rules(spark):
    lines = ["A plain sentence that ends well.", "Home | News | About | Contact", "Accept all cookies", "### $$$ %% word",
             "THIS LINE IS ALL SHOUTED OUT!", "eight words and not one mark of punctuation here", "", "Title"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [r[0] for r in df.select(quality.line_passes(F.col("line"))).collect()] == [True, *[False] * 5, True, True]


def test_clean_documents_are_kept(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    good = quality.quality_rules(documents).join(labels, "doc_id").filter("quality = 1 and not base_failed")
    assert good.filter("not kept").count() == 0


# --- op 6

def shingles(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_near(docs):
    sets = {i: shingles(t) for i, t in docs if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_duplicates(spark, documents, edge):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    family = [rng.choice(words) for _ in range(120)]
    docs = []
    for i in range(80):  # a family of copies with few to many edits, so that many pairs lie near the threshold
        own = list(family)
        for _ in range(rng.randrange(8)):
            own[rng.randrange(len(own))] = rng.choice(words)
        docs.append((i, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for some in (df, documents):
        want = brute_near(texts(some))
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(some).collect()}
        assert got == want
    got = near_dedup.near_duplicates(edge).collect()
    assert len(got) == len(EDGE)
    assert {r.doc_id: r.component_id for r in got}[2] == 1
    assert [r.kept for r in got if r.doc_id is None] == [True, True]
    assert near_dedup.near_duplicates(edge.limit(0)).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (7, 8), (5, 5), (3, 1)] + [(100, i) for i in range(101, 160)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7} | {i: 100 for i in range(100, 160)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- op 8

def test_url_rules_and_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    pages = [
        (1, "http://a.example.com/en/1", ""), (2, "https://WWW.example.com/en/x", None), (3, "http://x.net/es/1", ""),
        (4, "http://plain.org/a", link.format("http://x.net/es/1")), (5, "https://plain.org/b", link.format("/a")),
        (6, "http://plain.org/c", '<meta http-equiv="refresh" content="0; url=http://shop.com/">' + link.format("/b")),
        (7, "http://alone.org", ""), (8, None, None), (9, "no scheme", ""), (None, "http://q.net/fr/?x", ""),
        (10, "http://blocked.org/z", link.format("http://y.net/fr/2")), (11, "http://example.com", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge_urls(df).collect()}
    assert got[1] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[3] == ("x.net", "/es/1", "net/es/", "block")  # its own rule stands
    assert [got[i][2:] for i in (4, 5, 6)] == [(None, "allow")] * 3  # an alias is allowed by com/
    assert got[7] == ("alone.org", "", None, "allow") and got[8] == got[9] == ("", "", None, "allow")
    assert got[None] == ("q.net", "/fr/", "net/fr/", "block")
    assert got[10][2:] == (None, "block") and got[11][1:] == ("", None, "allow")
    assert url_filters.judge_urls(df.limit(0)).count() == 0


def test_relative_links_and_references(spark):
    link, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="{}">'
    cases = [
        ("http://a.org/x/y/z.html", link.format("page.html"), "http://a.org/x/y/page.html"),
        ("http://a.org/x/y/z.html", link.format("../w/./v?q=../1#f"), "http://a.org/x/w/v?q=../1#f"),
        ("http://a.org/x", link.format("../../up"), "http://a.org/up"),
        ("http://a.org", link.format("p"), "http://a.org/p"),
        ("http://a.org/x?old=1#g", refresh.format("0; URL=?q=2"), "http://a.org/x?q=2"),
        ("http://a.org/x?old=1", refresh.format("5"), None),
        ("http://a.org/x", link.format("/b/../c/"), "http://a.org/c/"),
        ("https://a.org/x", link.format("//B.org/c"), "https://B.org/c"),
        ("http://a.org/x", link.format("q?to=http://b.org/"), "http://a.org/q?to=http://b.org/"),
        ("http://a.org/x", refresh.format("0; url=http://h/p?a=1&amp;b=2&#38;c=&#x33;&copy=4"), "http://h/p?a=1&b=2&c=3&copy=4"),
        ("http://a.org/x", refresh.format("0;url='p;v=1'"), "http://a.org/p;v=1"),
        ("http://a.org/x", "<base href='/deep/er/'>" + link.format("p"), "http://a.org/deep/er/p"),
        ("no scheme", link.format("p"), None),
    ]
    for n, (url, page, want) in enumerate(cases):
        cases[n] = (n, url, page, want)
    df = spark.createDataFrame([(f"{url}#{n}" if "#" not in url and want else url, page) for n, url, page, want in cases], "url string, html string")
    want = [w for *_, w in cases if w]
    assert sorted(r.target for r in url_filters.link_edges(df).collect()) == sorted(want)
    pages = [(1, "http://p.org/x/a", refresh.format("0; url=../y/b")), (2, "http://p.org/y/b", link.format("http://x.net/es/1")),
             (3, "http://p.org/q?a=1&b=2", ""), (4, "http://p.org/r", refresh.format("0;url=http://p.org/q?a=1&amp;b=2") + link.format("//x.net/fr/3"))]
    got = url_filters.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r.page_id: r.verdict for r in got.collect()} == {i: "block" for i in (1, 2, 3, 4)}


# --- op 9

def test_warc_round_trip(spark, tmp_path):
    long = "<p>é" + "x" * 1000
    pages = [(i, f"http://h/{i}", long) for i in (1, 2, 5)] + [(3, "u\r\nv", "short"), (4, None, "short"), (6, "u", None), (None, "n", long),
             (7, "u", "y" * 5000), (7, "u", "y" * 5000)] + [(100 + i, "u", f"<p>{i}" * 300) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    sums = []
    for run in "ab":
        manifest = warc.write_warc(df.repartition(3), str(tmp_path / run), shard_bytes=9000, file_bytes=1500)
        sums.append(rows_of(manifest, "file", "records", "bytes", "sha256"))
    assert sums[0] == sums[1] and len(sums[0]) > 5  # the same files, whatever the input's partitions
    read = warc.read_warc(spark, str(tmp_path / "a"))
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read.collect())
    want = collections.Counter()
    for n, (i, _, page) in enumerate(pages):
        data = (page or "").encode()
        refers = 5 if page == long and i in (1, 2) else 7 if n == 8 else None
        want[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers] += 1
    want[None, len(long.encode()), hashlib.sha1(long.encode()).hexdigest(), "response", None] = 1
    assert got == want
    assert warc.read_warc(spark, str(tmp_path / "a")).filter("payload is null and record_type = 'response'").count() == 0
    warc.write_warc(df.limit(0), str(tmp_path / "empty"))
    assert warc.read_warc(spark, str(tmp_path / "empty")).count() == 0


# --- op 10

def test_edited_texts_and_likeness(spark, documents, edge):
    got = {r.doc_id: r for r in fingerprints.edit_and_fingerprint(documents).collect()}
    docs = sorted(texts(documents))
    for n, (i, text) in enumerate(docs):
        after = docs[(n + 1) % len(docs)][1]
        half = len(text) // 2
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
        assert (got[i].fingerprint == got[docs[(n + 1) % len(docs)][0]].fingerprint) == (got[i].near_next == 1.0)
    out = fingerprints.edit_and_fingerprint(edge).collect()
    assert len(out) == len(EDGE)
    same = {r.fingerprint for r in out if r.doc_id in (1, 2)}
    assert len(same) == 1 and all(0 <= r.near_next <= 1 for r in out)
    assert fingerprints.edit_and_fingerprint(edge.limit(0)).count() == 0


def test_collisions_estimate_the_weighted_jaccard(spark):
    rng = random.Random(4)
    pool = [f"{w}t" for w in ("abc", "de", "f", "ghij", "kl", "mnop", "q", "rs", "tuv", "wxyz")]
    docs = [(i, " ".join(rng.choices(pool, weights=[rng.random() for _ in pool], k=60))) for i in range(24)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(df, ["doc_id"], "text", 512).collect()}
    errors = []
    for a, x in docs:
        for b, y in docs[a + 1 :]:
            u, v = collections.Counter(x.split()), collections.Counter(y.split())
            whole = sum(len(t) * max(u[t], v[t]) for t in u | v)
            true = sum(len(t) * min(u[t], v[t]) for t in u | v) / whole
            errors.append(sum(p == q for p, q in zip(prints[a], prints[b], strict=True)) / 512 - true)
    assert abs(sum(errors) / len(errors)) < 0.02
    assert sum(e * e for e in errors) / len(errors) < 0.035**2


def test_edits_inside_a_text_lose_their_own_weight_only(spark):
    rng = random.Random(5)
    docs = []
    for kind in range(4):  # words without t and marks, words that all end in t, no white space, one long word
        first, count, glue = [("a", 7, " "), ("a", 7, "t "), (chr(0x4E00), 2000, ""), ("a", 7, "")][kind]
        words = ["".join(chr(ord(first) + rng.randrange(count)) for _ in range(6)) for _ in range(200)]
        other = ["".join(chr(ord(first) + count + rng.randrange(count)) for _ in range(6)) for _ in range(20)]
        texts = (words, words[:90] + other + words[110:], words[:100], words[:100] + words)
        docs += [(10 * kind + i, glue.join(x)) for i, x in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(df, ["doc_id"], "text").collect()}
    for kind in range(4):
        for i, true in ((1, 180 / 220), (2, 1 / 2), (3, 2 / 3)):  # the last: occurrences count
            same = sum(p == q for p, q in zip(prints[10 * kind], prints[10 * kind + i], strict=True))
            assert same / 64 == pytest.approx(true, abs=0.2)
