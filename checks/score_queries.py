"""Splits, class balancing, metrics, ensembles, scores and reason codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.bindings import Registry, big, rnd, with_views
from checks.text_queries import SIDE_SQL
from ledgerloom.operators import evaluate, neighbors, sampling, scoring

registry = Registry()
query = registry.add

HASH_SQL = "CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT)"
ROW_HASH = HASH_SQL.format(key="CAST(txn_id AS VARCHAR)")


@query("hash_sample", with_views(b.TXN, body=f"SELECT txn_id FROM txn WHERE {ROW_HASH} % 100 < 10"))
def hash_sample(spark, sf_dir):
    return sampling.hash_sample(b.txn(spark, sf_dir), "txn_id", 10).select("txn_id")


@query("split_by_row", with_views(b.TXN, body=f"SELECT txn_id, {SIDE_SQL.format(key='txn_id')} AS side FROM txn"))
def split_by_row(spark, sf_dir):
    return sampling.split_side(b.txn(spark, sf_dir), "txn_id").select("txn_id", "side")


@query(
    "split_by_consumer",
    with_views(
        b.TXN,
        body=f"""SELECT txn_id, consumer_id FROM txn
WHERE consumer_id IN (SELECT c_custkey FROM customer WHERE {SIDE_SQL.format(key='c_custkey')} = 'test')""",
    ),
)
def split_by_consumer(spark, sf_dir):
    sides = sampling.split_side(b.consumer(spark, sf_dir), "consumer_id")
    held_out = sides.filter("side = 'test'")
    return sampling.keep_keys(b.txn(spark, sf_dir), held_out, "consumer_id").select("txn_id", "consumer_id")


@query(
    "unlabelled_consumers",
    with_views(
        b.TXN,
        b.CONSUMER,
        body="""SELECT txn_id, consumer_id FROM txn WHERE consumer_id NOT IN (
  SELECT consumer_id FROM consumer WHERE dq_target IS NOT NULL)""",
    ),
)
def unlabelled_consumers(spark, sf_dir):
    labelled = b.consumer(spark, sf_dir).filter("dq_target is not null")
    return sampling.drop_keys(b.txn(spark, sf_dir), labelled, "consumer_id").select("txn_id", "consumer_id")


@query(
    "split_stratified",
    with_views(
        b.TXN,
        body=f"""SELECT txn_id, category_id, CASE WHEN rn <= n * 80 // 100 THEN 'train' ELSE 'test' END AS side FROM (
  SELECT txn_id, category_id, count(*) OVER (PARTITION BY category_id) AS n,
    row_number() OVER (PARTITION BY category_id ORDER BY {ROW_HASH}, txn_id) AS rn FROM txn)""",
    ),
)
def split_stratified(spark, sf_dir):
    return sampling.split_stratified(b.txn(spark, sf_dir), "category_id", "txn_id").select(
        "txn_id", "category_id", "side"
    )


@query(
    "undersample",
    with_views(
        b.TXN,
        body=f"""SELECT txn_id, credit_or_debit FROM (
  SELECT *, row_number() OVER (PARTITION BY credit_or_debit ORDER BY {ROW_HASH}, txn_id) AS rn FROM txn)
WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM txn GROUP BY credit_or_debit))""",
    ),
)
def undersample(spark, sf_dir):
    return sampling.undersample(b.txn(spark, sf_dir), "credit_or_debit", "txn_id").select("txn_id", "credit_or_debit")


@query(
    "class_weights",
    with_views(
        b.CONSUMER,
        "known AS (SELECT * FROM consumer WHERE dq_target IS NOT NULL)",
        body="""SELECT dq_target, count(*) AS n,
  round((SELECT count(*) FROM known) / ((SELECT count(DISTINCT dq_target) FROM known) * count(*)), 6) AS weight FROM known GROUP BY 1""",
    ),
)
def class_weights(spark, sf_dir):
    return sampling.class_weights(b.consumer(spark, sf_dir), "dq_target").select("dq_target", "n", rnd("weight"))


@query(
    "positive_weight",
    with_views(
        b.CONSUMER,
        body="""SELECT round(count(*) FILTER (WHERE dq_target = 0) / count(*) FILTER (WHERE dq_target = 1), 6) AS by_negatives,
  round(count(dq_target) / count(*) FILTER (WHERE dq_target = 1), 6) AS by_rows FROM consumer""",
    ),
)
def positive_weight(spark, sf_dir):
    rows = b.consumer(spark, sf_dir)
    by_rows = sampling.positive_weight(rows, "dq_target", "rows").scalar()
    return sampling.positive_weight(rows, "dq_target").select(
        rnd("positive_weight", "by_negatives"), F.round(by_rows, 6).alias("by_rows")
    )


PAIRS_SQL = "list_distance(a.v, c.v)"


@query(
    "smote_neighbors",
    with_views(
        b.POINTS,
        body=f"""SELECT id, neighbor_id, rank, round(d, 6) AS distance FROM (
  SELECT a.id, c.id AS neighbor_id, {PAIRS_SQL} AS d, row_number() OVER (PARTITION BY a.id ORDER BY {PAIRS_SQL}, c.id) AS rank
  FROM points a, points c WHERE a.y = 1 AND c.y = 1 AND a.id <> c.id) WHERE rank <= 5""",
    ),
)
def smote_neighbors(spark, sf_dir):
    return neighbors.smote_neighbors(b.points(spark, sf_dir)).select(
        "id", "neighbor_id", big("rank"), rnd("distance")
    )


@query(
    "smote_rows",
    with_views(
        b.POINTS,
        f"""ranked AS (SELECT a.id, a.v, c.id AS neighbor_id, c.v AS nv, row_number() OVER (PARTITION BY a.id ORDER BY {PAIRS_SQL}, c.id) AS rank
  FROM points a, points c WHERE a.y = 1 AND c.y = 1 AND a.id <> c.id)""",
        "sizes AS (SELECT count(*) FILTER (WHERE y = 1) AS few, count(*) FILTER (WHERE y = 0) - count(*) FILTER (WHERE y = 1) AS wanted FROM points)",
        f"""planned AS (SELECT id, unnest(range(1, CAST(wanted // few AS BIGINT) + 1 +
    CASE WHEN row_number() OVER (ORDER BY {HASH_SQL.format(key='CAST(id AS VARCHAR)')}, id) <= wanted % few THEN 1 ELSE 0 END)) AS copy_no
  FROM points, sizes WHERE y = 1)""",
        f"""drawn AS (SELECT id, copy_no, {HASH_SQL.format(key="id || '|' || copy_no")} % 5 + 1 AS rank,
    ({HASH_SQL.format(key="copy_no || '|' || id")} % 1000000) / 1000000.0 AS step FROM planned)""",
        body="""SELECT d.id AS base_id, copy_no, neighbor_id, round(step, 6) AS step, round(v[1] + step * (nv[1] - v[1]), 6) AS first_value,
  round(list_sum(list_transform(range(1, 65), lambda i: v[i] + step * (nv[i] - v[i]))), 6) AS total
FROM drawn d JOIN ranked r ON r.id = d.id AND r.rank = d.rank""",
    ),
)
def smote_rows(spark, sf_dir):
    out = neighbors.smote_rows(b.points(spark, sf_dir))
    return out.select(
        "base_id",
        big("copy_no"),
        "neighbor_id",
        rnd("step"),
        rnd(F.col("v")[0], "first_value"),
        rnd(F.expr("aggregate(v, cast(0 as double), (s, x) -> s + x)"), "total"),
    )


@query(
    "tomek_links",
    with_views(
        b.POINTS,
        f"pairs AS MATERIALIZED (SELECT a.id AS a, c.id AS c, {PAIRS_SQL} AS d FROM points a JOIN points c ON a.id < c.id)",
        """closest AS MATERIALIZED (SELECT id, min(struct_pack(d := d, n := n)) AS best FROM (
  SELECT a AS id, c AS n, d FROM pairs UNION ALL SELECT c, a, d FROM pairs) GROUP BY id)""",
        body="""SELECT p.id, p.best.n AS neighbor_id, x.y AS label, z.y AS neighbor_label, round(p.best.d, 6) AS distance
FROM closest p JOIN closest q ON q.id = p.best.n AND q.best.n = p.id JOIN points x ON x.id = p.id JOIN points z ON z.id = p.best.n
WHERE p.id < p.best.n AND x.y <> z.y""",
    ),
)
def tomek_links(spark, sf_dir):
    return neighbors.tomek_links(b.points(spark, sf_dir)).select(
        "id", "neighbor_id", "label", "neighbor_label", rnd("distance")
    )


PREDICTED = """predicted AS (
  SELECT o_orderkey AS id, substr(o_orderpriority, 3) AS label,
    CASE WHEN o_orderkey % 3 = 0 THEN substr(o_orderpriority, 3) ELSE ['URGENT', 'HIGH', 'MEDIUM', 'LOW', 'OTHER'][o_custkey % 5 + 1] END AS prediction,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
    ((o_orderkey * 31 + o_custkey * 7) % 1009 + CASE WHEN o_orderstatus = 'F' THEN 150 ELSE 0 END) / 1200.0 AS p1,
    round(o_totalprice / 1000000.0, 3) AS p2, ((o_custkey * 13 + o_orderkey) % 101) / 100.0 AS p3
  FROM orders)"""


def predicted(spark, sf_dir):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    label = F.expr("substr(o_orderpriority, 3)")
    others = F.element_at(F.array(*[F.lit(c) for c in ("URGENT", "HIGH", "MEDIUM", "LOW", "OTHER")]), (cust % 5 + 1).cast("int"))
    y = (F.col("o_orderstatus") == "F").cast("int")
    return b.table(spark, sf_dir, "orders").select(
        key.alias("id"),
        label.alias("label"),
        F.when(key % 3 == 0, label).otherwise(others).alias("prediction"),
        y.alias("y"),
        (((key * 31 + cust * 7) % 1009 + y * 150) / 1200.0).cast("double").alias("p1"),
        F.round(F.col("o_totalprice") / 1000000.0, 3).alias("p2"),
        (((cust * 13 + key) % 101) / 100.0).cast("double").alias("p3"),
    )


REPORT = """classes AS (SELECT label FROM predicted UNION SELECT prediction FROM predicted),
counts AS (SELECT c.label, count(*) FILTER (WHERE p.label = c.label AND p.prediction = c.label) AS tp,
    count(*) FILTER (WHERE p.prediction = c.label) AS predicted, count(*) FILTER (WHERE p.label = c.label) AS support
  FROM classes c, predicted p GROUP BY 1),
scores AS (SELECT label, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
    coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f1_score, support, tp FROM counts)"""


@query(
    "classification_report",
    with_views(
        PREDICTED,
        REPORT,
        body="""SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support FROM scores
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1_score * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores""",
    ),
)
def classification_report(spark, sf_dir):
    return evaluate.classification_report(predicted(spark, sf_dir)).select(
        "label", rnd("precision"), rnd("recall"), rnd("f1_score"), "support"
    )


@query(
    "accuracy",
    with_views(PREDICTED, body="SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM predicted"),
)
def accuracy(spark, sf_dir):
    return evaluate.accuracy(predicted(spark, sf_dir)).select(rnd("accuracy"))


MATRIX_CLASSES = ["HIGH", "LOW", "MEDIUM", "NOT SPECIFIED", "OTHER", "URGENT"]


@query(
    "confusion_matrix",
    with_views(
        PREDICTED,
        body="SELECT label, "
        + ", ".join(f"count(*) FILTER (WHERE prediction = '{c}') AS \"predicted_{c}\"" for c in MATRIX_CLASSES)
        + " FROM predicted GROUP BY 1",
    ),
)
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(predicted(spark, sf_dir), MATRIX_CLASSES)


@query(
    "per_class_accuracy",
    with_views(
        PREDICTED,
        REPORT,
        body="""SELECT c.label, round(avg(CASE WHEN (p.label = c.label) = (p.prediction = c.label) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  count(*) FILTER (WHERE p.label = c.label) AS support FROM classes c, predicted p GROUP BY 1""",
    ),
)
def per_class_accuracy(spark, sf_dir):
    return evaluate.per_class_accuracy(predicted(spark, sf_dir)).select("label", rnd("accuracy"), "support")


def auc_sql(source: str, label: str, score: str, keys: str = "", names: str = "") -> str:
    """Area from average ranks."""
    lead = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    return f"""SELECT {names or lead} round((sum(r) FILTER (WHERE {label} = 1) - pos * (pos + 1) / 2.0) / (pos * neg), 6) AS auc, pos AS n_pos, neg AS n_neg
FROM (SELECT *, rank() OVER (PARTITION BY {lead}1 ORDER BY {score}) + (count(*) OVER (PARTITION BY {lead}{score}) - 1) / 2.0 AS r,
    count(*) FILTER (WHERE {label} = 1) OVER ({part}) AS pos, count(*) FILTER (WHERE {label} <> 1) OVER ({part}) AS neg FROM {source}){group or ''}
{', ' if group else ' GROUP BY '}pos, neg"""


@query("roc_auc", with_views(PREDICTED, body=auc_sql("predicted", "y", "p1")))
def roc_auc(spark, sf_dir):
    return evaluate.roc_auc(predicted(spark, sf_dir), "y", "p1").select(rnd("auc"), "n_pos", "n_neg")


CLASS_PROBABILITIES = """long AS (SELECT id, c AS class_label, CASE WHEN label = c THEN 1 ELSE 0 END AS hit,
    ((id * (10 + i) + CASE WHEN label = c THEN 20 ELSE 0 END) % 97) / 100.0 AS score
  FROM predicted, (SELECT unnest(['URGENT', 'HIGH', 'MEDIUM', 'LOW', 'NOT SPECIFIED']) AS c, unnest([1, 2, 3, 4, 5]) AS i))"""


@query(
    "roc_auc_per_class",
    with_views(PREDICTED, CLASS_PROBABILITIES, body=auc_sql("long", "hit", "score", "class_label")),
)
def roc_auc_per_class(spark, sf_dir):
    entries = [
        x
        for i, c in enumerate(("URGENT", "HIGH", "MEDIUM", "LOW", "NOT SPECIFIED"), 1)
        for x in (
            F.lit(c),
            (((F.col("id") * (10 + i) + F.when(F.col("label") == c, 20).otherwise(0)) % 97) / 100.0).cast("double"),
        )
    ]
    rows = predicted(spark, sf_dir).withColumn("probabilities", F.create_map(*entries))
    return evaluate.roc_auc_per_class(rows, "label", "probabilities").select(
        "class_label", rnd("auc"), "n_pos", "n_neg"
    )


@query(
    "roc_curve",
    with_views(
        PREDICTED,
        body="""SELECT p1 AS threshold, round(sum(n) OVER w / sum(n) OVER (), 6) AS fpr, round(sum(p) OVER w / sum(p) OVER (), 6) AS tpr FROM (
  SELECT round(p1, 9) AS p1, count(*) FILTER (WHERE y = 0) AS n, count(*) FILTER (WHERE y = 1) AS p FROM predicted GROUP BY 1)
WINDOW w AS (ORDER BY p1 DESC)""",
    ),
)
def roc_curve(spark, sf_dir):
    return evaluate.roc_curve(predicted(spark, sf_dir), "y", "p1").select(
        rnd("threshold", digits=9), rnd("fpr"), rnd("tpr")
    )


MEMBERS = ("p1", "p2", "p3")


@query(
    "ensemble_max",
    with_views(
        PREDICTED,
        body="""SELECT id, round(greatest(p1, p2, p3), 6) AS ensemble_probability,
  CASE WHEN greatest(p1, p2, p3) > 0.5 THEN 1 ELSE 0 END AS ensemble_prediction FROM predicted""",
    ),
)
def ensemble_max(spark, sf_dir):
    return scoring.ensemble_max(predicted(spark, sf_dir), MEMBERS).select(
        "id", rnd("ensemble_probability"), big("ensemble_prediction")
    )


@query(
    "ensemble_weighted",
    with_views(
        PREDICTED,
        body="""SELECT id, round((0.8301 * p1 + 0.8212 * p2 + 0.8144 * p3) / (0.8301 + 0.8212 + 0.8144), 6) AS ensemble_probability,
  CASE WHEN (0.8301 * p1 + 0.8212 * p2 + 0.8144 * p3) / (0.8301 + 0.8212 + 0.8144) > 0.5 THEN 1 ELSE 0 END AS ensemble_prediction FROM predicted""",
    ),
)
def ensemble_weighted(spark, sf_dir):
    weights = {"p1": 0.8301, "p2": 0.8212, "p3": 0.8144}
    return scoring.ensemble_weighted(predicted(spark, sf_dir), weights).select(
        "id", rnd("ensemble_probability"), big("ensemble_prediction")
    )


# A fixed linear model over simple consumer features.
COEFFICIENTS = {
    "credit_score": -0.8,
    "amount": 0.3,
    "n_transactions": -0.25,
    "total_credit": -0.2,
    "total_debit": 0.45,
}
INTERCEPT = -2.0
SCOREFEAT = """scorefeat AS (
  SELECT c.consumer_id, c.credit_score, c.dq_target, t.* EXCLUDE (consumer_id) FROM consumer c JOIN (
    SELECT consumer_id, CAST(sum(amount) AS DOUBLE) AS amount, CAST(count(*) AS DOUBLE) AS n_transactions,
      CAST(sum(CASE WHEN credit_or_debit = 'CREDIT' THEN amount ELSE 0 END) AS DOUBLE) AS total_credit,
      CAST(sum(CASE WHEN credit_or_debit = 'DEBIT' THEN amount ELSE 0 END) AS DOUBLE) AS total_debit
    FROM txn GROUP BY 1) t USING (consumer_id))"""
CONTRIB = "contrib AS (SELECT consumer_id, dq_target, " + ", ".join(
    f"coalesce(({f} - avg({f}) OVER ()) / nullif(stddev_pop({f}) OVER (), 0) * {c}, 0) AS {f}" for f, c in COEFFICIENTS.items()
) + " FROM scorefeat)"
SCORE_VIEWS = (b.CONSUMER, b.TXN, SCOREFEAT, CONTRIB)
LONG_CONTRIB = "long AS (UNPIVOT contrib ON " + ", ".join(COEFFICIENTS) + " INTO NAME feature VALUE value)"
TOTAL_SQL = " + ".join(COEFFICIENTS)


def scorefeat(spark, sf_dir):
    credit = F.col("credit_or_debit") == "CREDIT"
    totals = b.txn(spark, sf_dir).groupBy("consumer_id").agg(
        F.sum("amount").cast("double").alias("amount"),
        F.count(F.lit(1)).cast("double").alias("n_transactions"),
        F.coalesce(F.sum(F.when(credit, F.col("amount"))), F.lit(0)).cast("double").alias("total_credit"),
        F.coalesce(F.sum(F.when(~credit, F.col("amount"))), F.lit(0)).cast("double").alias("total_debit"),
    )
    return b.consumer(spark, sf_dir).join(totals, "consumer_id")


def contributions(df, coefficients=None):
    """The table with the moments attached, and the contribution of each feature."""
    coefficients = coefficients or COEFFICIENTS
    rows, means, stds = scoring.with_moments(df, list(coefficients))
    return rows, scoring.linear_contributions(coefficients, means, stds)


def probability(parts):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(sum(parts.values(), F.lit(INTERCEPT)))))


def scored(df, coefficients=None):
    rows, parts = contributions(df, coefficients)
    coded = scoring.reason_codes(rows, parts)
    return coded.withColumn("probability", probability(parts)).withColumn(
        "score", scoring.risk_score(F.col("probability"))
    )


SCORE_SQL = "CAST(round_even(1 + (999 - round_even(1 + {p} * 998, 0)), 0) AS INTEGER)"
LINEAR_SQL = f"(1 / (1 + exp(-({INTERCEPT} + {TOTAL_SQL}))))"


@query(
    "risk_score",
    with_views(
        *SCORE_VIEWS,
        body=f"SELECT consumer_id, round({LINEAR_SQL}, 6) AS probability, {SCORE_SQL.format(p=LINEAR_SQL)} AS score FROM contrib",
    ),
)
def risk_score(spark, sf_dir):
    return scored(scorefeat(spark, sf_dir)).select("consumer_id", rnd("probability"), big("score"))


RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY consumer_id ORDER BY value DESC, feature) AS rn FROM long)"""


@query(
    "reason_codes",
    with_views(
        *SCORE_VIEWS,
        LONG_CONTRIB,
        RANKED,
        body="SELECT consumer_id, "
        + ", ".join(
            f"max(feature) FILTER (WHERE rn = {i}) AS top_{i}_feature, round(max(value) FILTER (WHERE rn = {i}), 6) AS top_{i}_score"
            for i in (1, 2, 3)
        )
        + " FROM ranked GROUP BY 1",
    ),
)
def reason_codes(spark, sf_dir):
    out = scored(scorefeat(spark, sf_dir))
    return out.select(
        "consumer_id", *[x for i in (1, 2, 3) for x in (F.col(f"top_{i}_feature"), rnd(f"top_{i}_score"))]
    )


@query(
    "reason_code_frequency",
    with_views(
        *SCORE_VIEWS, LONG_CONTRIB, RANKED, body="SELECT feature, count(*) AS n FROM ranked WHERE rn <= 3 GROUP BY 1"
    ),
)
def reason_code_frequency(spark, sf_dir):
    return scoring.reason_code_frequency(scored(scorefeat(spark, sf_dir)))


@query(
    "global_contributions",
    with_views(
        *SCORE_VIEWS,
        LONG_CONTRIB,
        body="SELECT feature, round(avg(abs(value)), 6) AS mean_abs_contribution FROM long GROUP BY 1",
    ),
)
def global_contributions(spark, sf_dir):
    rows, parts = contributions(scorefeat(spark, sf_dir))
    return scoring.global_contributions(rows, parts).select("feature", rnd("mean_abs_contribution"))


@query(
    "score_histogram",
    with_views(
        *SCORE_VIEWS,
        f"s AS (SELECT CAST({SCORE_SQL.format(p=LINEAR_SQL)} AS DOUBLE) AS v FROM contrib)",
        body="""SELECT bin, round(1 + bin * 99.8, 6) AS low_edge, n, round(n / (sum(n) OVER () * 99.8), 9) AS density FROM (
  SELECT CAST(least(9, floor((v - 1.0) / (998.0 / 10.0))) AS INTEGER) AS bin, count(*) AS n FROM s GROUP BY 1)""",
    ),
)
def score_histogram(spark, sf_dir):
    return scoring.score_histogram(scored(scorefeat(spark, sf_dir))).select(
        "bin", rnd("low_edge"), "n", rnd("density", digits=9)
    )


@query(
    "scores_below",
    with_views(
        *SCORE_VIEWS,
        body=f"SELECT count(*) FILTER (WHERE {SCORE_SQL.format(p=LINEAR_SQL)} < 600) AS n_below FROM contrib",
    ),
)
def scores_below(spark, sf_dir):
    return scoring.count_below(scored(scorefeat(spark, sf_dir)), 600)


@query(
    "feature_auc_screen",
    with_views(
        b.CONSUMER,
        b.TXN,
        SCOREFEAT,
        "longf AS (SELECT * FROM (UNPIVOT (SELECT consumer_id, CAST(dq_target AS INTEGER) AS y, " + ", ".join(COEFFICIENTS)
        + " FROM scorefeat WHERE dq_target IS NOT NULL) ON " + ", ".join(COEFFICIENTS) + " INTO NAME feature VALUE value))",
        "areas AS (" + auc_sql("longf", "y", "value", "feature") + ")",
        body="SELECT feature, auc, round(greatest(auc, 1 - auc), 6) AS best_auc FROM areas",
    ),
)
def feature_auc_screen(spark, sf_dir):
    out = evaluate.feature_auc_screen(scorefeat(spark, sf_dir), list(COEFFICIENTS), "dq_target")
    return out.select("feature", rnd("auc"), F.round(F.greatest(F.round("auc", 6), 1 - F.round("auc", 6)), 6).alias("best_auc"))


SHORT = {k: v for k, v in COEFFICIENTS.items() if k != "credit_score"}


def _final_sql() -> str:
    def part(prefix: str, features: dict) -> str:
        cells = ", ".join(
            f"coalesce(({f} - avg({f}) OVER ()) / nullif(stddev_pop({f}) OVER (), 0) * {c}, 0) AS {f}" for f, c in features.items()
        )
        total = " + ".join(features)
        p = f"(1 / (1 + exp(-({INTERCEPT} + {total}))))"
        return f"""{prefix}_c AS (SELECT consumer_id, {cells} FROM open WHERE n_transactions > 1),
{prefix}_l AS (SELECT *, row_number() OVER (PARTITION BY consumer_id ORDER BY value DESC, feature) AS rn
  FROM (UNPIVOT {prefix}_c ON {', '.join(features)} INTO NAME feature VALUE value)),
{prefix}_r AS (SELECT c.consumer_id, CAST(max({SCORE_SQL.format(p=p)}) AS DOUBLE) AS {prefix}_score, """ + ", ".join(
            f"max(feature) FILTER (WHERE rn = {i}) AS {prefix}_top_{i}_feature" for i in (1, 2, 3)
        ) + f" FROM {prefix}_c c JOIN {prefix}_l USING (consumer_id) GROUP BY 1)"

    return with_views(
        b.CONSUMER,
        b.TXN,
        SCOREFEAT,
        "open AS (SELECT * FROM scorefeat WHERE dq_target IS NULL)",
        part("credit", COEFFICIENTS),
        part("non_credit", SHORT),
        body="""SELECT * FROM (SELECT consumer_id FROM consumer WHERE dq_target IS NULL) LEFT JOIN credit_r USING (consumer_id)
LEFT JOIN non_credit_r USING (consumer_id)""",
    )


@query("final_scores", _final_sql())
def final_scores(spark, sf_dir):
    ids = b.consumer(spark, sf_dir).filter("dq_target is null")
    open_rows = scorefeat(spark, sf_dir).filter("dq_target is null and n_transactions > 1")
    out = scoring.final_scores(ids, scored(open_rows), scored(open_rows, SHORT))
    return out.withColumns({c: F.col(c).cast("double") for c in ("credit_score", "non_credit_score")})


@query(
    "standardized_features",
    with_views(
        b.CONSUMER,
        b.TXN,
        SCOREFEAT,
        f"fit AS (SELECT * FROM scorefeat WHERE {SIDE_SQL.format(key='consumer_id')} = 'train')",
        body="SELECT consumer_id, "
        + ", ".join(
            f"round(({f} - (SELECT avg({f}) FROM fit)) / (SELECT stddev_pop({f}) FROM fit), 6) AS {f}" for f in COEFFICIENTS
        )
        + " FROM scorefeat",
    ),
)
def standardized_features(spark, sf_dir):
    from ledgerloom.plans.risk import standardize

    rows = scorefeat(spark, sf_dir)
    train = sampling.split_side(rows, "consumer_id").filter("side = 'train'")
    out = standardize(rows, list(COEFFICIENTS), fitted_on=train)
    return out.select("consumer_id", *[rnd(f) for f in COEFFICIENTS])
