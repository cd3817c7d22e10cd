"""Exact classification metrics.

Rows are first combined: per (label, prediction) for counts, per distinct score for ranking metrics.
Cumulative counts over distinct scores are cut at score ranges (see ``scan``), so no step sorts all
scores in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import one_row
from ledgerloom.operators.scan import value_prefix_sums


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    df: DataFrame, classes: Sequence, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows = labels, one ``predicted_<class>`` column per class, 0 where there is none."""
    return (
        df.groupBy(F.col(label).alias("label"))
        .agg(*[F.count_if(F.col(prediction) == c).alias(f"predicted_{c}") for c in classes])
        .orderBy("label")
    )


def class_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """True positives, predicted rows and support of every class that occurs on either side."""
    sides = F.array(
        F.struct(F.col("label").alias("label"), F.lit(True).alias("actual")),
        F.struct(F.col("prediction").alias("label"), F.lit(False).alias("actual")),
    )
    counted = confusion_counts(df, label, prediction).withColumn("_hit", F.col("label") == F.col("prediction"))
    long = counted.select("n", "_hit", F.explode(sides).alias("_s")).select("n", "_hit", "_s.label", "_s.actual")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return long.groupBy("label").agg(
        total(F.col("actual") & F.col("_hit")).alias("tp"),
        total(~F.col("actual")).alias("predicted"),
        total(F.col("actual")).alias("support"),
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the macro and weighted means.

    A ratio with nothing below the line counts as 0.
    """
    zero = F.lit(0.0)
    tp = F.col("tp").cast("double")
    counts = class_counts(df, label, prediction).select(
        F.col("label").cast("string").alias("label"),
        F.coalesce(F.try_divide(tp, F.col("predicted")), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, F.col("support")), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, F.col("predicted") + F.col("support")), zero).alias("f1_score"),
        "support",
        "tp",
    )
    accuracy = F.try_divide(F.sum("tp").cast("double"), F.sum("support"))
    scores = ("precision", "recall", "f1_score")
    kinds = {
        "accuracy": [accuracy.alias(s) for s in scores],
        "macro avg": [F.avg(s).alias(s) for s in scores],
        "weighted avg": [F.try_divide(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(s) for s in scores],
    }
    report = counts.drop("tp")
    for name, parts in kinds.items():
        summary = counts.agg(*parts, F.sum("support").alias("support")).select(
            F.lit(name).alias("label"), *scores, "support"
        )
        report = report.unionByName(summary)
    return report


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def per_class_accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows on which label and prediction agree about belonging to the class."""
    counts = class_counts(df, label, prediction)
    total = one_row(counts, F.sum("support").alias("n")).getField("n")
    agree = total - F.col("predicted") - F.col("support") + 2 * F.col("tp")
    return counts.select("label", (agree / total).alias("accuracy"), "support")


def score_counts(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return known.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def roc_auc(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null if only one class is present."""
    along = value_prefix_sums(score_counts(df, label, score, keys), keys, "score", ["neg"])
    pos, neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    # Twice the number of (positive, lower negative) pairs, as an exact integer.
    pairs = F.sum(
        F.col("pos").cast("decimal(18,0)") * (2 * F.col("neg_upto") - F.col("neg")).cast("decimal(19,0)")
    ).cast("double")
    return along.groupBy(*keys).agg(
        F.try_divide(pairs / 2, pos * neg).alias("auc"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    )


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at every distinct score, from the highest score down."""
    counted = score_counts(df, label, score).withColumn("_down", -F.col("score"))
    along = value_prefix_sums(counted, [], "_down", ["pos", "neg"])
    return along.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("neg_upto").cast("double"), F.col("neg_all")).alias("fpr"),
        F.try_divide(F.col("pos_upto").cast("double"), F.col("pos_all")).alias("tpr"),
    )


def roc_auc_per_class(df: DataFrame, label: str, probabilities: str) -> DataFrame:
    """One-vs-rest area per class; ``probabilities`` is a map from class to probability."""
    long = df.select(label, F.explode(probabilities).alias("class_label", "score"))
    long = long.withColumn("_is_class", (F.col(label) == F.col("class_label")).cast("int"))
    return roc_auc(long, "_is_class", "score", ["class_label"])


def feature_auc_screen(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Area under the curve of each feature used alone as the score, best first.

    ``best_auc`` is the area in the feature's better direction. All features share one stacked pass.
    """
    long = df.select(label, *[F.col(f"`{f}`").cast("double").alias(f) for f in features]).unpivot(
        [label], [F.col(f"`{f}`") for f in features], "feature", "value"
    )
    return (
        roc_auc(long, label, "value", ["feature"])
        .select("feature", "auc", F.greatest(F.col("auc"), 1 - F.col("auc")).alias("best_auc"))
        .orderBy(F.desc("best_auc"), "feature")
    )


def binary_metrics(df: DataFrame, model: str, label: str, probability: str, cut: float = 0.5) -> DataFrame:
    """One comparison row: area, accuracy and the weighted precision, recall and F1 at a cut."""
    predicted = df.withColumn("_predicted", (F.col(probability) > cut).cast("double")).withColumn(
        "_label", F.col(label).cast("double")
    )
    weighted = classification_report(predicted, "_label", "_predicted").filter(
        F.col("label").isin("accuracy", "weighted avg")
    )

    def cell(row: str, column: str, name: str) -> Column:
        return F.max(F.when(F.col("label") == row, F.col(column))).alias(name)

    area = roc_auc(df, label, probability).select("auc").scalar()
    return weighted.agg(
        F.lit(model).alias("model"),
        F.max(area).alias("roc_auc"),
        cell("accuracy", "precision", "accuracy"),
        cell("weighted avg", "precision", "precision"),
        cell("weighted avg", "recall", "recall"),
        cell("weighted avg", "f1_score", "f1_score"),
    )


def model_comparison(rows: Sequence[DataFrame]) -> DataFrame:
    """Comparison rows of several models, best area first."""
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row, allowMissingColumns=True)
    return table.orderBy(F.desc("roc_auc"), "model")
