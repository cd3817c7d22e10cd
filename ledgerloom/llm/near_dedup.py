"""Near-duplicate documents by an inverted join over the coordinates of MinHash signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import components, discard, staged
from ledgerloom.llm.rolling import JOIN, Powers, mixed, prefix_hashes

SHINGLE = 5
#: Coordinates of a signature, and how many a pair must share to be looked at. Two documents with a similarity of 0.75
#: share 48 on average; fewer than 28 have a probability of about 1e-8.
COORDINATES, MATCHES = 64, 28
_FACTORS = np.random.default_rng(7).integers(1, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def shingle_sets(texts: list[bytes], powers: Powers, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; a text of fewer words is one shingle."""
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    bounds = np.r_[0, np.cumsum(lengths)]
    up, down = powers(len(data) + 1)
    word = ~_BLANK[data]
    edge = np.diff(np.r_[False, word, False].view(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = prefix_hashes(data, up)
    words = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * JOIN[0])
    first = np.searchsorted(starts, bounds)
    n = len(words)
    joined = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k if n >= k else 0):
        joined += words[j : n - k + 1 + j] * JOIN[1 + j]
    joined = mixed(joined)
    out = []
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            out.append(np.unique(joined[a : b - k + 1]))
        elif b > a:
            whole = (words[a:b] * JOIN[1 : 1 + b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mixed(whole + JOIN[20 + b - a]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _texts(batch: pa.RecordBatch, size: int = 1 << 22) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch as bytes, a few megabytes at a time, with the place of the first."""
    held, begin, total = [], 0, 0
    for i, text in enumerate(batch.column(1)):
        value = b"" if not text.is_valid else text.as_buffer().to_pybytes()
        if held and total + len(value) > size:
            yield begin, held
            held, begin, total = [], i, 0
        held.append(value)
        total += len(value)
    if held:
        yield begin, held


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers, factors = Powers(), _FACTORS[:COORDINATES, None]
    names = ["doc_id", "n_shingles", "set_key", "signature"]
    for batch in batches:
        for begin, texts in _texts(batch):
            counts, keys, signatures = [], [], []
            for own in shingle_sets(texts, powers):
                counts.append(len(own))
                keys.append(_key(own))
                least = np.full(COORDINATES, 2**64 - 1, np.uint64)
                for part in range(0, len(own), 4096):
                    least = np.minimum(least, (own[None, part : part + 4096] * factors).min(axis=1))
                signatures.append(least.view(np.int64))
            flat = pa.array(np.concatenate(signatures))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * COORDINATES, pa.int32()), flat)
            ids = batch.column(0).slice(begin, len(texts))
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), lists], names=names)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for begin, texts in _texts(batch):
            own = [x.view(np.int64) for x in shingle_sets(texts, powers)]
            keys = pa.array([_key(x) for x in own], pa.binary())
            offsets = np.r_[0, np.cumsum([len(x) for x in own])]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(own)))
            arrays = [batch.column(0).slice(begin, len(texts)), keys, lists]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "set_key", "shingles"])


def _best(pairs: DataFrame, ways: int = 8) -> DataFrame:
    """At most ``ways`` pairs per pair of components: those that share most coordinates, one of each way of a hash."""
    best = F.max(F.struct("shared", F.col("a"), F.col("b"))).alias("x")
    way = F.pmod(F.xxhash64("a", "b"), F.lit(ways)).alias("way")
    return pairs.groupBy("part_a", "part_b", way).agg(best).select("x.a", "x.b")


def _possible(n_a: str, c_a: str, n_b: str, c_b: str):
    """Whether two sets can be similar at all: what they share is at most what either shares with any other set."""
    most = F.least(c_a, c_b)
    return most * 175 >= (F.col(n_a) + F.col(n_b)) * 75


def near_links(tokens: DataFrame, sets: DataFrame, rounds: int = 3) -> DataFrame:
    """Links ``(a, b)`` between similar representatives that connect all components of the similarity graph.

    ``tokens(rep, n, c, tokens array<long>)``: the size of a set, how many of its shingles occur in another set, and
    the shared coordinate values of its signature, rarest first. By the prefix principle a pair that shares MATCHES of
    them meets under one of the first size - MATCHES + 1 of each, so only these are posted. The first rounds pair one
    document of each component under a value with one of the component that has most documents there, so a value that m
    components share makes m - 1 pairs; confirmed links contract the components. After the first round these documents
    are drawn anew for each value and round: a document outside a large component meets many of its members, not one of
    them again and again. The last round looks at the documents that still meet one of another component under a value;
    of their pairs, those that also meet under a rare shingle.
    """
    spark, made = tokens.sparkSession, []

    def held(df: DataFrame, name: str) -> DataFrame:
        made.append(staged(df, name))
        return made[-1]

    posts = tokens.select("rep", "n", "c", F.explode(F.slice("tokens", 1, F.size("tokens") - F.lit(MATCHES - 1))).alias("token"))
    posts = held(posts, "posts")
    parts = tokens.select("rep", F.col("rep").alias("part"))
    links = spark.createDataFrame([], "a long, b long")

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs whose full sets are similar."""
        side = {x: sets.select(F.col("rep").alias(f"_{x}"), F.col("shingles").alias(f"set_{x}")) for x in "ab"}
        full = pairs.join(side["a"], F.col("a") == F.col("_a")).join(side["b"], F.col("b") == F.col("_b"))
        common = F.size(F.array_intersect("set_a", "set_b"))
        whole = F.size("set_a") + F.size("set_b") - common
        return held(full.filter(common * 100 >= whole * 75).select("a", "b"), name)

    def matched(pairs: DataFrame) -> DataFrame:
        """Counts collisions: pairs with the number of coordinates they share, if enough."""
        side = {x: tokens.select(F.col("rep").alias(f"_{x}"), F.col("tokens").alias(f"t_{x}")) for x in "ab"}
        full = pairs.join(side["a"], F.col("a") == F.col("_a")).join(side["b"], F.col("b") == F.col("_b"))
        shared = F.size(F.array_intersect("t_a", "t_b"))
        return full.select(*pairs.columns, shared.alias("shared")).filter(F.col("shared") >= MATCHES)

    for turn in range(rounds):
        placed = posts.join(parts, "rep")
        order = F.xxhash64("rep", "token", F.lit(turn)) if turn else F.col("rep")
        head = F.min(F.struct(order.alias("o"), F.col("rep").alias("b"), "n", "c")).alias("h")
        heads = placed.groupBy("token", "part").agg(head, F.count(F.lit(1)).alias("m")).select("token", "part", "m", "h.*")
        leader = F.min(F.struct((-F.col("m")).alias("m"), "o", F.col("b").alias("a"), F.col("part").alias("part_a"), F.col("n").alias("n_a"), F.col("c").alias("c_a")))
        leaders = heads.groupBy("token").agg(leader.alias("x"), F.count(F.lit(1)).alias("k")).filter("k > 1")
        leaders = leaders.select("token", "x.a", "x.part_a", "x.n_a", "x.c_a")
        pairs = heads.join(leaders, "token").withColumnRenamed("part", "part_b")
        pairs = pairs.filter((F.col("part_a") != F.col("part_b")) & _possible("n_a", "c_a", "n", "c"))
        pairs = matched(pairs.select("a", "b", "part_a", "part_b").distinct())
        found = confirm(held(_best(pairs), f"pairs{turn}"), f"links{turn}")
        if found.isEmpty():
            break
        links = held(links.union(found), f"all{turn}")
        found = components(links)
        parts = held(_parts(tokens.select("rep"), found), f"parts{turn}")
        discard(found)
    placed = held(posts.join(parts, "rep"), "placed")
    least = placed.groupBy("token").agg(F.min("n").alias("n_least"))
    # A partner has at least three quarters of the size, and no less than the least size of the value.
    partner = F.greatest(F.col("n_least") * 100, F.col("n") * 75)
    able = held(placed.join(least, "token").filter(F.col("c") * 17500 >= (F.col("n") * 100 + partner) * 75).drop("n_least"), "able")
    several = able.groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y").select("token")
    left = able.join(several, "token", "left_semi").select("rep", "part").distinct()
    rare = held(_front(left.join(sets, "rep")), "rare")
    pairs = matched(_rare_pairs(rare))
    out = staged(links.union(confirm(held(pairs.select("a", "b"), "rest"), "more")), "near-links")
    discard(*made)
    return out


def _front(docs: DataFrame) -> DataFrame:
    """``(rep, part, n, i, s)``: the rarest shingles of ``docs(rep, part, shingles)``, each with its place i."""
    n = F.size("shingles")
    items = docs.select("rep", "part", n.alias("n"), F.explode("shingles").alias("s"))
    ranks = items.groupBy("s").agg(F.count(F.lit(1)).alias("k"))
    sets = items.join(ranks, "s").groupBy("rep", "part", "n").agg(F.array_sort(F.collect_list(F.struct("k", "s"))).alias("x"))
    front = F.slice("x", 1, F.col("n") - F.ceil(F.col("n") * 75 / 100).cast("int") + 1)
    posts = sets.select("rep", "part", "n", F.posexplode(front).alias("i", "x")).filter("x.k > 1")
    return posts.select("rep", "part", "n", "i", F.col("x.s").alias("s"))


def _rare_pairs(posts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` in different parts that can still be similar.

    Here the long lists are skipped: with shingles in one order, rarest first, the first one that two similar sets
    share lies in the first size - 0.75 size + 1 of each, and what follows it must be long enough for the rest of the
    overlap. Documents of one family differ in their rarest shingles, so that few of their pairs meet.
    """
    several = posts.groupBy("s").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y").select("s")
    posts = posts.join(several, "s", "left_semi")
    side = {d: posts.select("s", *[F.col(c).alias(f"{c}_{d}") for c in ("rep", "part", "n", "i")]) for d in "ab"}
    rest = F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b"))
    meet = (side["a"]["s"] == side["b"]["s"]) & (F.col("rep_a") < F.col("rep_b")) & (F.col("part_a") != F.col("part_b"))
    met = side["a"].join(side["b"], meet & (rest * 175 >= (F.col("n_a") + F.col("n_b")) * 75))
    return met.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def _parts(reps: DataFrame, found: DataFrame) -> DataFrame:
    return reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("component", "rep").alias("part"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles long, component_id long, kept boolean)`` for every row.

    A document's set holds its distinct shingles of five words, A-Z lower-cased; a text of fewer words is one shingle.
    Documents with 100 * intersection >= 75 * union are linked, confirmed on the full sets (of 64-bit hashes); a
    component is named by its least doc_id, which is kept. Equal sets are compared once. The only links that can be
    missed are those whose signatures share fewer than MATCHES coordinates (about one in 1e8 at a similarity of 0.75).

    Null or empty texts and texts without words have an empty set and are linked with nothing. Rows that repeat an id
    are one document: their texts' sets are linked. Rows with a null id are compared with nothing, have no component
    and are kept. An empty table gives an empty result; other columns are not read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = staged(
        own.mapInArrow(_signatures, "doc_id long, n_shingles long, set_key binary, signature array<long>"), "signatures"
    )
    named = signed.filter("doc_id is not null and n_shingles > 0")
    # A set is known by a number of its own: one id may have several sets, and be the least holder of more than one.
    reps = named.groupBy("set_key").agg(F.min("doc_id").alias("doc"), F.max("n_shingles").alias("n"))
    reps = staged(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")
    holders = reps.select(F.col("doc").alias("doc_id"), "set_key", "rep")
    coordinates = named.join(holders, ["doc_id", "set_key"]).select("rep", F.posexplode("signature")).distinct()
    values = staged(coordinates.select("rep", F.xxhash64("pos", "col").alias("token")), "values")
    often = staged(values.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "often")
    shared = values.join(often, "token").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("x"))
    enough = shared.filter(F.size("x") >= MATCHES).select("rep", F.col("x.token").alias("tokens"))
    signs = staged(enough.join(reps.select("rep", "n"), "rep").select("rep", "n", "tokens"), "tokens")
    wanted = staged(holders.join(signs.select("rep"), "rep", "left_semi"), "wanted")
    sets = own.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = sets.mapInArrow(_sets, "doc_id long, set_key binary, shingles array<long>")
    sets = sets.groupBy("doc_id", "set_key").agg(F.first("shingles").alias("shingles"))
    sets = staged(sets.join(wanted, ["doc_id", "set_key"]).select("rep", "shingles"), "sets")
    alone = sets.select("rep", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("rep").alias("rep"), F.count(F.lit(1)).alias("k"))
    alone = alone.filter("k = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("alone"))
    tokens = signs.join(alone, "rep", "left").withColumn("c", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")
    tokens = staged(tokens.filter(F.col("c") * 100 >= F.col("n") * 75), "able-tokens")
    links = near_links(tokens, sets)
    doc = {x: reps.select(F.col("rep").alias(x), F.col("doc").alias(f"doc_{x}")) for x in "ab"}
    linked = links.join(doc["a"], "a").join(doc["b"], "b").select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    again = named.select("doc_id", "set_key").join(reps, "set_key").filter("doc_id <> doc").select(
        F.col("doc_id").alias("a"), F.col("doc").alias("b")
    )
    found = components(linked.union(again))
    discard(reps, values, often, signs, wanted, sets, tokens, links)
    return signed.join(found, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT p.a, p.b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS other FROM w UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a)
SELECT w.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id, w.doc_id = min(r.other) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN r ON w.doc_id = r.node GROUP BY w.doc_id
"""
