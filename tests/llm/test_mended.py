"""Plans that must stay small, links against the standard library, rows that must not get lost."""

import collections
import html
import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.llm import fingerprints, mixing, near_dedup, url_filters
from tests.llm.conftest import EDGE
from tests.llm.test_operators import brute_near


def test_link_plans_stay_small(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = url_filters.link_edges(pages)
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    judged = url_filters.judge_urls(pages)
    assert len(judged._jdf.queryExecution().optimizedPlan().toString()) < 200_000


LINKS = [
    "http://a.com/x", "//b.org/y?q=1", "/abs/../p", "rel.html", "../up", "./here", "?only=query", "#part", "a/b/../../c/", "&#47;dec",
    "x?a=1&amp;b=2", "caf&eacute;", "..", "../../../../far", "x;y=1", "&#x2f;hex&quot;",
]


def test_links_resolve_like_the_standard_library(spark):
    rows, want = [], []
    for n, url in enumerate(["http://h.net/d/e/f.html?k=v", "http://h.net", "http://h.net/", "https://H.net/a/b/"]):
        for m, link in enumerate(LINKS):
            rows.append((n * 100 + m, url, f'<p>x</p><link rel="canonical" href="{link}">'))
            want.append(urljoin(url, html.unescape(link)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")

    def shown(target):
        host, _, rest = target.partition("://")[2].partition("#")[0].partition("/")
        return host.lower(), ("/" + rest).rstrip("/")

    got = collections.Counter(shown(r.target) for r in url_filters.link_edges(df).collect())
    assert got == collections.Counter(shown(t) for t in want)


def test_every_row_has_a_fingerprint(spark, edge):
    out = fingerprints.edit_and_fingerprint(edge).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(i for i, _, _ in EDGE)
    renamed = edge.select("*", F.lit(1).alias("d"), F.lit("h").alias("h"), F.lit(2).alias("n"), F.lit(3).alias("version"))
    assert sorted(map(repr, fingerprints.edit_and_fingerprint(renamed).collect())) == sorted(map(repr, out))


def test_one_id_with_several_texts(spark):
    words = [f"w{i}" for i in range(120)]
    x, near_x = " ".join(words), " ".join([*words[:-2], "other", "end"])
    y = " ".join(f"y{i}" for i in range(100))
    rows = [(5, x), (5, y), (5, x), (9, near_x), (9, near_x), (7, y + " more"), (8, "alone in the whole wide world")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == {5: 5, 9: 5, 7: 5, 8: 8}
    # The least holder of two sets, one of which is near a third document's.
    rows = [(1, x), (1, y), (2, x), (3, y), (4, near_x)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {1}


def test_mix_tells_texts_of_one_id_apart(spark):
    rows = [(1, f"{a} {b}" + " w" * 20, "s") for a in "xyz" for b in "pq"] + [(2, "one " * 5, "s"), (3, "t " * 200, "t"), (3, "t " * 200, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix(docs, (1, 3))
    taken = collections.Counter()
    for r in plan.collect():
        taken[r.doc_id, r.text_hash] += r.copies
    made = mixing.apply_mix(docs, plan).select("doc_id", F.xxhash64("text").alias("h")).collect()
    assert collections.Counter((r.doc_id, r.h) for r in made) == +taken


def test_staged_tables_go(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    assert near_dedup.near_duplicates(documents).count() == documents.count()
    assert len(list(tmp_path.iterdir())) <= 2  # the signatures and the components, which the result reads


def test_passing_over_bids_changes_no_winner(spark, sf_dir, monkeypatch):
    """Every text of the smallest table, with the bound and with one that no bid exceeds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    short = fingerprints.fingerprints(docs, ["doc_id"], "text", 16).collect()
    monkeypatch.setattr(fingerprints, "BOUND", 1e12)
    assert sorted(short) == sorted(fingerprints.fingerprints(docs, ["doc_id"], "text", 16).collect())
    assert len(short) == docs.count()


def test_a_large_family_leaves_few_pairs_to_the_last_step(spark, monkeypatch):
    """Pairs that reach the last step grow with the documents left over, not with the square of a family."""
    draw, rows = random.Random(3), []
    for i in range(300):
        words = [f"w{j}" for j in range(120)]
        for at in draw.sample(range(120), 2):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    sizes, real = {}, near_dedup.staged

    def counted(df, name):
        out = real(df, name)
        sizes[name] = out.count() if name == "rest" else None
        return out

    monkeypatch.setattr(near_dedup, "staged", counted)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: x[1] for i, x in brute_near(rows).items()}
    assert sizes["rest"] < 300
