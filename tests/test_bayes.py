"""Naive Bayes as tables against sums by hand, and the limit law of the K-S gap."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import profile
from ledgerloom.plans.bayes import fit_bayes

DOCS = [(1, "a a b", "x"), (2, "b c", "y"), (3, "a c c", "x"), (4, "d", None), (5, "", "y")]
OPEN = [(10, "a b", None), (11, "c c zzz", "y"), (12, "", "x"), (13, None, "x"), (None, "a", "x"), (10, "a b", None)]


def counts(spark, rows):
    found = [(i, t, float(n)) for i, text, _ in rows if i is not None for t, n in Counter((text or "").split()).items()]
    return spark.createDataFrame(found, "id long, term string, weight double").distinct()


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, category string")


def by_hand(text):
    labelled = [(t.split(), label) for _, t, label in DOCS if label]
    sums, known = defaultdict(Counter), {t for words, _ in labelled for t in words}
    for words, label in labelled:
        sums[label].update(words)
    shares = Counter(label for _, label in labelled)
    return [
        math.log(shares[label] / len(labelled))
        + sum(math.log((sums[label][t] + 1) / (sum(sums[label].values()) + len(known))) for t in (text or "").split() if t in known)
        for label in ("x", "y")
    ]


def test_scores_agree_with_sums_by_hand(spark):
    model = fit_bayes(table(spark, DOCS), counts(spark, DOCS))
    assert model.labels == ["x", "y"] and {r.term for r in model.terms.collect()} == {"a", "b", "c"}
    out = model.predict(table(spark, OPEN), counts(spark, OPEN)).collect()
    assert len(out) == len(OPEN)  # nulls, empty texts and repeated rows stay
    for r in out:
        scores = by_hand(r.text if r.id is not None else "")
        assert r.class_log_scores == pytest.approx(scores)
        assert r.predicted == ("x", "y")[scores.index(max(scores))]
        assert r.confidence == pytest.approx(1 / sum(math.exp(s - max(scores)) for s in scores))


def test_without_labels_nothing_is_predicted(spark):
    none = table(spark, DOCS).withColumn("category", F.lit(None).cast("string"))
    out = fit_bayes(none, counts(spark, DOCS)).predict(table(spark, OPEN), counts(spark, OPEN)).collect()
    assert len(out) == len(OPEN) and all(r.predicted is None and r.confidence is None for r in out)
    assert fit_bayes(table(spark, DOCS), counts(spark, DOCS)).predict(table(spark, []), counts(spark, OPEN)).count() == 0


def test_p_value_of_the_gap(spark):
    rows = [(0.1, 50, 50), (0.3, 50, 50), (0.0, 10, 10), (0.5, 10, 0), (1.0, 1000, 1000)]
    out = profile.ks_p_value(spark.createDataFrame(rows, "statistic double, n_first long, n_second long")).collect()
    got = {r.statistic: r.p_value for r in out}
    # Values of the limit distribution at 0.5 and 1.5.
    assert got[0.1] == pytest.approx(0.963945, abs=1e-6) and got[0.3] == pytest.approx(0.022218, abs=1e-6)
    assert got[0.0] == 1.0 and got[0.5] is None and got[1.0] == pytest.approx(0.0, abs=1e-12)


def test_query_counts_its_vocabulary_once(spark):
    """The prediction reads the words that the fit has counted; its plan splits texts for the weights only."""
    from checks import text_queries

    plan = text_queries.bayes_scores(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" not in plan and plan.count("regexp_extract_all") == 1
