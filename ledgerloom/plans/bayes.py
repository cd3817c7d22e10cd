"""Multinomial naive Bayes as tables: a term's log-likelihoods per class come from one aggregate, a text's class from a
join with them and another aggregate. Nothing is collected but one number per class."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import checked_broadcast


@dataclass(frozen=True)
class BayesTables:
    """``terms(term, log_likelihood array<double>)`` and the classes' ``log_prior``, both in the order of ``labels``."""

    labels: list[str]
    log_prior: list[float]
    terms: DataFrame

    def predict(self, docs: DataFrame, weights: DataFrame, doc_id: str = "id") -> DataFrame:
        """``docs`` with ``predicted``, its share of the classes' posteriors (``confidence``) and ``class_log_scores``.

        ``weights(doc_id, term, weight)`` lists the terms of the documents. Terms that the model does not know are
        skipped; a document without any (or with an empty or null text) gets the classes' shares of the training rows.
        Of equal scores the class that sorts first wins. Documents under one id are scored as one, a null id has no
        terms; all rows of ``docs`` come back. Without classes everything is null. The term table is broadcast if it is
        small, else the join is shuffled.
        """
        known = weights.select(F.col(doc_id).alias("_doc"), "term", "weight").join(checked_broadcast(self.terms), "term")
        sums = [F.sum(F.col("weight") * F.get("log_likelihood", F.lit(i))).alias(f"_{i}") for i in range(len(self.labels))]
        if not self.labels:
            empty = {"predicted": "string", "confidence": "double", "class_log_scores": "array<double>"}
            return docs.withColumns({c: F.lit(None).cast(t) for c, t in empty.items()})
        scored = known.groupBy("_doc").agg(*sums).select("_doc", F.array(*[F.col(f"_{i}") for i in range(len(sums))]).alias("_sums"))
        prior = F.array(*[F.lit(x) for x in self.log_prior])
        scores = F.when(F.col("_sums").isNull(), prior).otherwise(F.zip_with("_sums", prior, lambda a, p: a + p))
        out = docs.join(scored, F.col(doc_id) == F.col("_doc"), "left").withColumn("class_log_scores", scores)
        best = F.array_max("class_log_scores")
        place = F.array_position("class_log_scores", best).cast("int") - 1
        odds = F.aggregate("class_log_scores", F.lit(0.0), lambda done, s: done + F.exp(s - F.array_max("class_log_scores")))
        labels = F.array(*[F.lit(x) for x in self.labels])
        return out.select(*[docs[c] for c in docs.columns], F.get(labels, place).alias("predicted"), (1.0 / odds).alias("confidence"), "class_log_scores")


def fit_bayes(
    docs: DataFrame, weights: DataFrame, label: str = "category", doc_id: str = "id", smoothing: float = 1.0
) -> BayesTables:
    """Fit on ``docs(doc_id, label)`` and the term weights (counts or TF-IDF) of the same documents.

    A class's likelihood of a term is (weight of the term in the class + smoothing) / (weight of all terms in the class +
    smoothing * number of terms). Documents without a label are left out, and so are the terms that only they have.
    The driver holds the classes with their numbers of documents, which must be few; term weights are combined before
    they are shuffled, so a frequent term or class is no hot key.
    """
    labelled = docs.filter(F.col(label).isNotNull()).select(F.col(doc_id).alias("_doc"), F.col(label).alias("_label"))
    sizes = {r["_label"]: r["n"] for r in labelled.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(sizes)
    joined = weights.select(F.col(doc_id).alias("_doc"), "term", "weight").join(labelled, "_doc")

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_label") == name, F.col("weight"))), F.lit(0)).cast("double")

    by_class = F.array(*[of(x) for x in labels]) if labels else F.array().cast("array<double>")
    per_term = checked_broadcast(joined.groupBy("term").agg(by_class.alias("_weights")))
    n_terms = F.count(F.lit(1)).alias("n")
    whole = per_term.agg(n_terms, *[F.sum(F.get("_weights", F.lit(i))).alias(f"w{i}") for i in range(len(labels))]).first()
    below = [(whole[f"w{i}"] or 0.0) + smoothing * whole["n"] for i in range(len(labels))]
    likelihoods = [F.log((F.get("_weights", F.lit(i)) + smoothing) / F.lit(float(b))) for i, b in enumerate(below)]
    terms = per_term.select("term", (F.array(*likelihoods) if labels else F.col("_weights")).alias("log_likelihood"))
    rows = sum(sizes.values())
    return BayesTables(labels, [math.log(sizes[x] / rows) for x in labels], terms)
