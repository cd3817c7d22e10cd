"""Model queries. Fits cannot be written as SQL, so these are checked by rows and by the tests."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import bindings as b
from checks.bindings import Registry, rnd
from checks.flow_queries import ctxn
from checks.score_queries import COEFFICIENTS, HASH_SQL, SCOREFEAT, scorefeat
from ledgerloom.operators import evaluate, sampling, scoring
from ledgerloom.plans import attributions, boosting, memo, risk, screening, trees
from ledgerloom.plans.consumer_features import consumer_features
from ledgerloom.session import cut_lineage, new_path

registry = Registry()
query = registry.add


def memo_sides(spark, sf_dir):
    return memo.split(memo.prepared_memos(b.memo(spark, sf_dir)))


def memo_report(spark, sf_dir, classifier, bigrams=False, max_terms=2000):
    train, test = memo_sides(spark, sf_dir)
    features = memo.bigram_features() if bigrams else memo.fit_tfidf(train, max_terms=max_terms)
    report = memo.train(train, classifier, features).report(test)
    return report.select("label", rnd("precision"), rnd("recall"), rnd("f1_score"), "support")


@query("memo_logreg")
def memo_logreg(spark, sf_dir):
    return memo_report(spark, sf_dir, memo.logistic(), max_terms=5000)


@query("memo_forest")
def memo_forest(spark, sf_dir):
    return memo_report(spark, sf_dir, memo.forest())


@query("memo_boosted")
def memo_boosted(spark, sf_dir):
    """100 rounds of depth 6 on 2,000 terms for each class."""
    return memo_report(spark, sf_dir, memo.boosted())


@query("memo_softmax_boosted")
def memo_softmax_boosted(spark, sf_dir):
    """100 rounds of depth 6 on 2,000 terms, all classes in the same passes."""
    train, test = memo_sides(spark, sf_dir)
    report = memo.train_softmax(train, memo.fit_tfidf(train, max_terms=2000)).report(test)
    return report.select("label", rnd("precision"), rnd("recall"), rnd("f1_score"), "support")


@query("memo_bayes")
def memo_bayes(spark, sf_dir):
    return memo_report(spark, sf_dir, memo.bayes())


@query("memo_bigram_linear")
def memo_bigram_linear(spark, sf_dir):
    return memo_report(spark, sf_dir, memo.logistic(25), bigrams=True)


@query("memo_predictions")
def memo_predictions(spark, sf_dir):
    train, test = memo_sides(spark, sf_dir)
    model = memo.train(train, memo.logistic(), memo.fit_tfidf(train))
    return model.predict(test).select("id", "category", "predicted", rnd("confidence"), "class_probabilities")


def risk_table(spark, sf_dir):
    return consumer_features(
        b.consumer(spark, sf_dir), b.account(spark, sf_dir), ctxn(spark, sf_dir), b.CATEGORIES, b.ACCOUNT_TYPES
    )


def risk_columns(table):
    return [c for c in table.columns if c not in ("consumer_id", "dq_target")]


def risk_data(spark, sf_dir):
    table = cut_lineage(risk_table(spark, sf_dir))
    return risk.prepare(table, risk_columns(table))


def risk_metrics(spark, sf_dir, name, estimator, view="plain"):
    data = risk_data(spark, sf_dir)
    model = estimator(data).fit(risk.training_view(data.train, view))
    scored = risk.positive_probability(model, data.test, "p")
    out = evaluate.binary_metrics(cut_lineage(scored.drop("features")), name, "label", "p")
    return out.select("model", *[rnd(c) for c in out.columns[1:]])


@query("risk_logreg")
def risk_logreg(spark, sf_dir):
    return risk_metrics(
        spark, sf_dir, "logistic_regression", lambda d: risk.logistic(d.train.count()), "balanced"
    )


@query("risk_forest")
def risk_forest(spark, sf_dir):
    return risk_metrics(spark, sf_dir, "balanced_forest", lambda d: risk.forest(), "undersampled")


@query("risk_balanced_forest")
def risk_balanced_forest(spark, sf_dir):
    """200 trees, each on its own draw of both classes."""
    data = risk_data(spark, sf_dir)
    model = trees.fit_balanced_forest(data.train, data.features, risk.LABEL, risk.KEY)
    scored = data.test.select(risk.KEY, risk.LABEL, model.probability(vector_to_array("features")).alias("p"))
    out = evaluate.binary_metrics(cut_lineage(scored), "forest_of_balanced_draws", risk.LABEL, "p")
    return out.select("model", *[rnd(c) for c in out.columns[1:]])


@query(
    "forest_draws",
    f"""
WITH {b.CONSUMER},
d AS (SELECT consumer_id, CAST(dq_target AS INT) AS y FROM consumer WHERE dq_target IS NOT NULL),
n AS (SELECT y, count(*) AS n FROM d GROUP BY y),
rates AS (SELECT y, CAST((SELECT min(n) FROM n) AS DOUBLE) / n AS rate FROM n),
terms AS (
  SELECT y, k, sum(exp(-rate) * pow(rate, k) / factorial(k)) OVER (PARTITION BY y ORDER BY k) AS upto
  FROM rates, (SELECT CAST(unnest(range(20)) AS INT) AS k)),
limits AS (SELECT y, list(DISTINCT CAST(floor(4294967296 * upto) AS BIGINT)) AS l
           FROM terms WHERE floor(4294967296 * upto) < 4294967296 GROUP BY y),
r AS (SELECT d.consumer_id, d.y, l, unnest(range(200)) AS tree FROM d JOIN limits USING (y)),
t AS (
  SELECT tree, y, len(list_filter(l, lambda x: x <= chance)) AS times
  FROM (SELECT *, {HASH_SQL.format(key="'42|' || tree || '|' || consumer_id")} AS chance FROM r))
SELECT CAST(tree AS INT) AS tree, CAST(sum(times) FILTER (WHERE y = 0) AS BIGINT) AS negatives,
       CAST(sum(times) FILTER (WHERE y = 1) AS BIGINT) AS positives
FROM t GROUP BY tree
""",
)
def forest_draws(spark, sf_dir):
    """What each tree of a fitted forest was grown on, by class."""
    rows = b.consumer(spark, sf_dir).withColumn("known", F.coalesce(F.col("credit_score").cast("double"), F.lit(0.0)))
    model = trees.fit_balanced_forest(rows, ["known"], "dq_target", "consumer_id", vector=None)
    return spark.createDataFrame(model.class_counts(), "tree int, negatives long, positives long")


@query("risk_plain_forest")
def risk_plain_forest(spark, sf_dir):
    return risk_metrics(spark, sf_dir, "random_forest", lambda d: risk.forest())


@query("risk_gbt")
def risk_gbt(spark, sf_dir):
    return risk_metrics(spark, sf_dir, "gradient_boosting", lambda d: risk.boosted())


@query("risk_gbt_undersampled")
def risk_gbt_undersampled(spark, sf_dir):
    data = risk_data(spark, sf_dir)
    model = boosting.fit_undersampled(data.train, data.features, risk.LABEL, risk.KEY)
    scored = data.test.select(risk.KEY, risk.LABEL, model.probability(vector_to_array("features")).alias("p"))
    out = evaluate.binary_metrics(cut_lineage(scored), "undersampled_boosting", risk.LABEL, "p")
    return out.select("model", *[rnd(c) for c in out.columns[1:]])


@query(
    "undersampled_draws",
    f"""
WITH {b.CONSUMER},
d AS (
  SELECT consumer_id, CAST(dq_target AS INT) AS y FROM consumer WHERE dq_target IS NOT NULL),
n AS (SELECT count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1 FROM d),
t AS (
  SELECT d.*, CASE WHEN y = 1 THEN 4294967296 * least(n0, n1) // greatest(n1, 1)
                   ELSE 4294967296 * least(n0, n1) // greatest(n0, 1) END AS threshold
  FROM d, n),
r AS (
  SELECT t.*, unnest(range(200)) AS round FROM t)
SELECT CAST(round AS INT) AS round, count(*) FILTER (WHERE taken AND y = 0) AS negatives,
       count(*) FILTER (WHERE taken AND y = 1) AS positives
FROM (SELECT *, {HASH_SQL.format(key="'42|' || round || '|' || consumer_id")} < threshold AS taken FROM r) GROUP BY round
""",
)
def undersampled_draws(spark, sf_dir):
    return boosting.round_draws(b.consumer(spark, sf_dir), "dq_target", "consumer_id")


@query("risk_svm")
def risk_svm(spark, sf_dir):
    return risk_metrics(spark, sf_dir, "linear_margin", lambda d: risk.margin())


@query("model_comparison")
def model_comparison(spark, sf_dir):
    data = risk_data(spark, sf_dir)
    chosen = risk.candidates(data.train.count())
    return risk.compare(data, chosen).table.drop("train_seconds")  # a result that can be checked


@query("top_features")
def top_features(spark, sf_dir):
    table = cut_lineage(risk_table(spark, sf_dir))
    data = risk.prepare(table, risk_columns(table))
    model = risk.forest().fit(data.train)
    return risk.importances(model, data.features, table, "dq_target", 10)


@query("tree_reason_codes")
def tree_reason_codes(spark, sf_dir):
    """Probabilities of a forest for the test side, three reason codes each, and whether all contributions add up."""
    data = risk_data(spark, sf_dir)
    model = risk.forest().fit(data.train)
    trees = attributions.tree_model(model, spark)
    scored = risk.positive_probability(model, data.test, "probability")
    scored = scored.withColumn("_added", trees.contributions(vector_to_array("features")))
    total = F.aggregate("_added", F.lit(trees.base), lambda done, x: done + x)
    codes = scoring.reason_codes(scored, {f: F.get("_added", F.lit(i)) for i, f in enumerate(data.features)})
    reasons = [c for i in (1, 2, 3) for c in (F.col(f"top_{i}_feature"), rnd(f"top_{i}_score"))]
    adds_up = (F.abs(total - F.col("probability")) < 1e-9).alias("adds_up")
    return codes.select("consumer_id", rnd("probability"), scoring.risk_score(F.col("probability")).alias("score"), *reasons, adds_up)


@query("tuned_gbt")
def tuned_gbt(spark, sf_dir):
    """100 trials of 50 to 450 rounds."""
    data = risk_data(spark, sf_dir)
    search = risk.tune_boosting(data.train)
    scored = risk.positive_probability(search.bestModel, data.test, "p")
    return evaluate.binary_metrics(cut_lineage(scored.drop("features")), "tuned_boosting", "label", "p")


@query(
    "single_feature_models",
    f"""
WITH RECURSIVE {b.CONSUMER},
{b.TXN},
{SCOREFEAT},
labelled AS (SELECT *, CAST(dq_target AS INT) AS y FROM scorefeat WHERE dq_target IS NOT NULL),
weights AS (SELECT y, (SELECT count(*) FROM labelled) / (2.0 * count(*)) AS c FROM labelled GROUP BY y),
longf AS (SELECT * FROM (UNPIVOT (SELECT y, {", ".join(COEFFICIENTS)} FROM labelled) ON {", ".join(COEFFICIENTS)} INTO NAME feature VALUE v)),
m AS (SELECT feature, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS std FROM longf GROUP BY feature),
z AS (SELECT feature, y, CAST(c AS DOUBLE) AS c, (v - mean) / std AS x, 1 / (std * std) AS l2 FROM longf JOIN m USING (feature) JOIN weights USING (y)),
fit AS (
  SELECT 0 AS step, feature, CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS w FROM m
  UNION ALL
  SELECT step + 1, feature, b - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), w - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (
    SELECT step, feature, b, w, sum(c * (p - y)) AS g0, sum(c * (p - y) * x) + any_value(l2) * w AS g1, sum(c * p * (1 - p)) AS h00,
           sum(c * p * (1 - p) * x) AS h01, sum(c * p * (1 - p) * x * x) + any_value(l2) AS h11
    FROM (SELECT step, feature, b, w, y, c, x, l2, 1 / (1 + exp(-(b + w * x))) AS p FROM fit JOIN z USING (feature) WHERE step < 15)
    GROUP BY step, feature, b, w))
SELECT feature, n AS rows, round(b, 6) AS intercept, round(w, 6) AS slope FROM fit JOIN m USING (feature) WHERE step = 15
""",
)
def single_feature_models(spark, sf_dir):
    """A logistic model per feature on all labelled rows, on the feature's own scale of mean 0 and deviation 1."""
    models = screening.fit_singles(scorefeat(spark, sf_dir), list(COEFFICIENTS), "dq_target")
    out = spark.createDataFrame([(m.feature, m.rows, m.intercept, m.slope) for m in models], "feature string, rows long, intercept double, slope double")
    return out.select("feature", "rows", rnd("intercept"), rnd("slope"))


@query("feature_screening")
def feature_screening(spark, sf_dir):
    """Every feature's own model, fitted on the balanced training side and ranked by its area on the test side."""
    data = risk_data(spark, sf_dir)
    train, test = (
        df.select(risk.LABEL, *[vector_to_array("features")[i].alias(f) for i, f in enumerate(data.features)]) for df in (data.train, data.test)
    )
    out = screening.screen(train, test, data.features, risk.LABEL)
    return out.select("feature", "rows", rnd("intercept"), rnd("slope"), rnd("loss"), rnd("logistic_auc"))


@query("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    rows = scorefeat(spark, sf_dir).filter("dq_target is not null").withColumnRenamed("dq_target", "label")
    train = sampling.with_class_weight(rows, "label")
    fitted = risk.scaling_pipeline(list(COEFFICIENTS), risk.logistic(train.count())).fit(train)
    path = new_path(spark, "risk-pipeline")
    risk.save_model(fitted, path)
    restored = risk.load_model(path)
    before = risk.positive_probability(fitted, rows, "before")
    after = risk.positive_probability(restored, before, "after")
    return after.select("consumer_id", rnd("before"), rnd("after"), (F.col("before") == F.col("after")).alias("same"))


@query("scored_consumers")
def scored_consumers(spark, sf_dir):
    args = (b.account(spark, sf_dir), ctxn(spark, sf_dir), b.CATEGORIES, b.ACCOUNT_TYPES)
    consumers = b.consumer(spark, sf_dir)
    labelled = cut_lineage(consumer_features(consumers, *args, labelled=True))
    unlabelled = cut_lineage(consumer_features(consumers, *args, labelled=False))
    return risk.score_all(labelled, unlabelled, consumers, risk_columns(labelled))
