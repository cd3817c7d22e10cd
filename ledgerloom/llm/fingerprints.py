"""Document fingerprints by consistent weighted sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE, prefix_sums, staged
from ledgerloom.llm.quality import let

#: Samples of a fingerprint.
SAMPLES = 64
#: Code points of the longest word that is a term of its own. Longer ones (scripts without white space, addresses) give
#: their overlapping shingles of SHINGLE code points, so that an edit changes the terms next to it only.
WORD_CHARS = 16
SHINGLE = 4
#: A bid is only worked out if it may be below this number divided by the text's whole weight. The least bid is above that
#: with a chance of exp(-BOUND), 4e-11; such a sample has no winner and its value stands for that.
BOUND = 24.0


def term_codes(text: Column) -> Column:
    """``array<long>``, one entry for every occurrence of a term: the upper 59 bits of a hash, and in the lower 5 the
    weight of the occurrence. That is a word's code points; every shingle of a long word weighs 1."""
    words = F.array_remove(F.split(text, rf"[{SPACE}]+"), "")
    code = lambda term, weight: F.shiftleft(F.xxhash64(term, weight), 5).bitwiseOR(weight)

    def shingles(word: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(word) - (SHINGLE - 1))
        return F.transform(starts, lambda i: code(F.substring(word, i, F.lit(SHINGLE)), F.lit(1).cast("long")))

    def codes(all_words: Column) -> Column:
        long_ones = F.filter(all_words, lambda w: F.length(w) > WORD_CHARS)
        short = F.transform(F.filter(all_words, lambda w: F.length(w) <= WORD_CHARS), lambda w: code(w, F.length(w).cast("long")))
        return F.concat(short, F.flatten(F.transform(long_ones, shingles)))

    return let(words, codes)


def weighted_terms(text: Column) -> Column:
    """``array<struct<term long, log_weight double, bound double>>``: the text's terms; a term weighs its code points (a
    shingle 1) times its number of occurrences. ``bound`` is BOUND times the term's share of the whole weight."""

    def counted(codes: Column) -> Column:
        n = F.size(codes)
        places = F.sequence(F.lit(0), n - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(codes, i) != F.get(codes, i - 1)))
        whole = F.aggregate(codes, F.lit(0).cast("long"), lambda sum, code: sum + code.bitwiseAND(F.lit(31)))

        def weigh(begin: Column, total: Column) -> Column:
            def one(start: Column, j: Column) -> Column:
                times = F.coalesce(F.get(begin, j + 1), n) - start
                term = F.get(codes, start)
                weight = (times * term.bitwiseAND(F.lit(31))).cast("double")
                return F.struct(term.alias("term"), F.log(weight).alias("log_weight"), (weight * F.lit(BOUND) / total).alias("bound"))

            return F.transform(begin, one)

        return F.when(n > 0, let(starts, lambda begin: let(whole, lambda total: weigh(begin, total))))

    return let(F.sort_array(term_codes(text)), counted)


def _mask(i: int) -> int:
    """What tells draw i of a term from its other draws: i + 1 golden ratios, modulo 2**64 and signed."""
    return ((i + 1) * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63


def _middle(bits: Column) -> Column:
    """Some bits as a number, the middle of its step."""
    return bits.cast("double") + 0.5


def sample(term: Column, log_weight: Column, bound: Column, k: int) -> Column:
    """A term's bid for sample k, ln a; null if a is surely above what wins. The least bid wins.

    With r, c from Gamma(2, 1) and b uniform, all fixed by term and k: t = floor(ln w / r + b) and
    ln a = ln c - r (t - b + 1). Two weight vectors agree in (term, t) of the least a with a probability equal to
    their generalised Jaccard similarity. Term, k and t fix ln a to its last digit, so the bid itself stands for them.

    For a text, the a of its terms are exponential with the rates w. As a is at least c exp(-r) / w, that is
    -ln(u3 u4) u1 u2 / w, and -ln(p) at least 2 (1 - p) / (1 + p), most terms are passed over without a logarithm.
    """
    one, two = [F.xxhash64(term.bitwiseXOR(F.lit(_mask(i)))) for i in (2 * k, 2 * k + 1)]
    low, part = F.lit(0xFFFFFFFF), F.lit(0x3FFFFF)
    u12 = _middle(one.bitwiseAND(low)) * _middle(F.shiftrightunsigned(one, 32)) * F.lit(2.0**-64)
    u34 = _middle(F.shiftrightunsigned(two, 42)) * _middle(F.shiftrightunsigned(two, 20).bitwiseAND(part)) * F.lit(2.0**-44)
    b = two.bitwiseAND(F.lit(0xFFFFF)).cast("double") * F.lit(2.0**-20)
    r, c = -F.log(u12), -F.log(u34)
    t = F.floor(log_weight / r + b).cast("double")
    return F.when((1.0 - u34) * u12 * 2.0 < bound * (u34 + 1.0), F.log(c) - r * (t - b + 1.0))


def fingerprints(rows: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``fingerprint array<int>``, what the ``samples`` winning bids stand for; null if the text has no term. Rows with
    equal keys count once and must have equal texts. If the rows are already distributed by some of the keys, nothing
    is shuffled."""
    bids = rows.select(*keys, F.explode_outer(weighted_terms(F.coalesce(F.col(text), F.lit("")))).alias("t"))
    term = {c: F.col("t")[c].alias(c) for c in ("term", "log_weight", "bound")}
    bids = bids.select(*keys, *term.values())
    least = bids.groupBy(*keys).agg(
        F.max("bound").alias("_bound"), *[F.min(sample(*[F.col(c) for c in term], k)).alias(f"_s{k}") for k in range(samples)]
    )
    values = F.array(*[F.hash(F.lit(k), F.col(f"_s{k}")) for k in range(samples)])
    return least.select(*keys, F.when(F.col("_bound").isNotNull(), values).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; 1 if neither text has a term, 0 if one has none."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return (
        F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same / F.size(a)).cast("double")
    )


def as_text(fingerprint: Column) -> Column:
    return F.coalesce(
        F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""), F.lit("")
    )


def edit_and_fingerprint(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``(doc_id, n_chars long, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    Reads ``doc_id, text``. The edited text is the text with its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document by doc_id, after the last the first. ``near_*`` is the likeness of the
    fingerprint to the edited text's and to the next document's.

    A null text counts as empty; texts without terms have an empty fingerprint, which is like another empty one. Rows
    with equal doc_id and text count as one document, whose row comes as often as theirs; different texts under one
    doc_id are separate documents, ordered by a hash; a null doc_id comes last. A table of one document is its own next;
    an empty table gives an empty result. Other columns are not read, whatever their names. A text of any length is one
    row; its terms are counted in the executor that holds it.
    """
    key = ["d", "z", "h"]  # equal for equal documents, and never null, so that one shuffle serves all steps below
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    base = docs.select(F.coalesce(F.col("doc_id"), F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("z"), text)
    base = base.withColumn("h", F.xxhash64("text"))
    ids = base.select(*key, F.length("text").alias("n")).distinct()
    ranked = staged(prefix_sums(ids, [], ["z", "d", "h"]).withColumnRenamed("before_rows", "place"), "places")
    total = ranked.count()
    to = {c: f"to_{c}" for c in key}
    previous = ranked.select(
        *[F.col(c).alias(to[c]) for c in key], F.floor(F.col("n") / 2).cast("int").alias("wanted"),
        ((F.col("place") + 1) % max(total, 1)).alias("place"),
    )
    chain = staged(ranked.join(previous, "place").drop("place"), "chain")
    own = base.join(chain.select(*key, "n").hint("merge"), key)
    heads = base.join(chain.select(*key, *to.values(), "wanted").hint("merge"), key)
    heads = heads.select(*[F.col(to[c]).alias(c) for c in key], F.left("text", F.col("wanted")).alias("head")).distinct()
    both = own.join(heads.hint("merge"), key)
    edited = F.concat(F.left("text", F.col("n") - F.floor(F.col("n") / 2).cast("int")), F.col("head"))
    versions = both.select(*key, "n", "text", edited.alias("edited")).select(
        *key, "n",
        F.explode(F.array(
            F.struct(F.lit(0).alias("v"), F.lit("").alias("sha"), F.col("text").alias("version")),
            F.struct(F.lit(1).alias("v"), F.sha2("edited", 256).alias("sha"), F.col("edited").alias("version")),
        )).alias("x"),
    ).select(*key, "n", "x.*")
    marked = fingerprints(versions, [*key, "n", "v", "sha"], "version", samples)
    prints = staged(
        marked.groupBy(*key, "n").agg(
            F.max("sha").alias("edited_sha256"),
            F.max(F.when(F.col("v") == 0, F.col("fingerprint"))).alias("fp"),
            F.max(F.when(F.col("v") == 1, F.col("fingerprint"))).alias("efp"),
        ),
        "fingerprints",
    )
    links = chain.select(*key, *to.values())
    nexts = links.join(prints.select(*key, F.col("fp").alias("next_fp")), key).select(
        *[F.col(to[c]).alias(c) for c in key], "next_fp"
    )
    # Copies of a row come back: their number is counted on the narrow keys, which leaves one row of each before the join.
    times = base.groupBy(*key).agg(F.count(F.lit(1)).alias("times"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    out = prints.join(nexts, key).join(times, key).select(*prints.columns, "next_fp", copies.alias("copy"))
    out = out.withColumn("doc_id", F.when(~F.col("z"), F.col("d")))
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("efp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
