"""Training, comparing and applying the delinquency models with ``pyspark.ml``."""

from __future__ import annotations

import random
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import TrainValidationSplit
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import evaluate, neighbors, profile, sampling, scoring
from ledgerloom.plans import gradient
from ledgerloom.session import cut_lineage

KEY = "consumer_id"
LABEL = "label"
WEIGHT = "class_weight"


def standardize(df: DataFrame, features: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population standard deviation, both from ``fitted_on``; a constant feature becomes 0."""
    rows, means, stds = scoring.with_moments(df, features, fitted_on)
    contributions = scoring.linear_contributions({f: 1.0 for f in features}, means, stds)
    return rows.withColumns({f: c for f, c in contributions.items()}).drop("_moments")


@dataclass(frozen=True)
class PreparedData:
    """Scaled training and test rows (``features`` vector and ``label``) and how they were scaled."""

    train: DataFrame
    test: DataFrame
    features: list[str]
    fitted_on: DataFrame


def prepare(
    table: DataFrame,
    features: Sequence[str],
    target: str = "dq_target",
    key: str = KEY,
    train_percent: int = 80,
    balance: bool = True,
) -> PreparedData:
    """Drop rows with nulls, impute, split by key, balance the training side, scale by its moments.

    ``balance`` over-samples the minority to 1:1 and removes Tomek links on the training side only. The
    prepared rows are checkpointed, since every model reads them many times.
    """
    features = list(features)
    rows = profile.drop_null_rows(table.select(key, target, *[F.col(f"`{f}`") for f in features]))
    rows = profile.impute_median(rows, features)
    sides = sampling.split_side(rows, key, train_percent)
    array = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    points = cut_lineage(
        sides.select(
            F.col(key).cast("string").alias("id"), array.alias("v"), F.col(target).cast("int").alias("y"), "side"
        )
    )
    train = points.filter("side = 'train'").drop("side")
    if balance:
        train = neighbors.resample(train, "y")

    def unpacked(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("id").alias(key),
            F.col("y").cast("double").alias(LABEL),
            *[F.col("v")[i].alias(f) for i, f in enumerate(features)],
        )

    fitted_on = cut_lineage(unpacked(train))
    assembled = F.array(*[F.col(f"`{f}`") for f in features])

    def scaled(df: DataFrame) -> DataFrame:
        columns = standardize(df, features, fitted_on)
        return cut_lineage(columns.select(key, LABEL, array_to_vector(assembled).alias("features")))

    test = unpacked(points.filter("side = 'test'").drop("side"))
    return PreparedData(scaled(fitted_on), scaled(test), features, fitted_on)


def logistic(rows: int, max_iter: int = 1000, weighted: bool = True) -> LogisticRegression:
    """Strength 0.1 in the inverse notation, spread over the rows as the averaged loss needs it."""
    model = LogisticRegression(
        labelCol=LABEL, maxIter=max_iter, regParam=1.0 / (0.1 * max(1, rows)), standardization=False
    )
    return model.setWeightCol(WEIGHT) if weighted else model


def forest(trees: int = 200, depth: int = 10, seed: int = 42) -> RandomForestClassifier:
    """Each row's nodes are kept from level to level; without that every level walks all rows down all trees again."""
    return RandomForestClassifier(
        labelCol=LABEL, numTrees=trees, maxDepth=depth, minInstancesPerNode=2, seed=seed, cacheNodeIds=True
    )


def boosted(
    rounds: int = 200, rate: float = 0.05, depth: int = 6, seed: int = 42, weighted: bool = False
) -> GBTClassifier:
    """Boosted trees on 80 % of rows and features per round; the lineage is cut every 10 rounds."""
    model = GBTClassifier(
        labelCol=LABEL,
        maxIter=rounds,
        stepSize=rate,
        maxDepth=depth,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=seed,
        checkpointInterval=10,
    )
    return model.setWeightCol(WEIGHT) if weighted else model


def margin(max_iter: int = 100) -> LinearSVC:
    return LinearSVC(labelCol=LABEL, maxIter=max_iter)


def with_positive_weight(df: DataFrame, over: str = "negatives") -> DataFrame:
    """Weight 1 for negatives and negatives / positives (or rows / positives) for positives."""
    weight = sampling.positive_weight(df, LABEL, over).scalar()
    return df.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, weight).otherwise(1.0))


def training_view(train: DataFrame, view: str, key: str = KEY) -> DataFrame:
    """Rows a model is fitted on: plain, with balanced class weights, with a positive weight, or
    under-sampled to the smaller class."""
    if view == "balanced":
        return sampling.with_class_weight(train, LABEL, WEIGHT)
    if view == "positive":
        return with_positive_weight(train)
    if view == "undersampled":
        return sampling.undersample(train, LABEL, key)
    return train


@dataclass(frozen=True)
class Candidate:
    estimator: Estimator | gradient.Boosting
    view: str = "plain"


def candidates(rows: int, rounds: int = 200, trees: int = 200, max_iter: int = 1000) -> dict[str, Candidate]:
    """The models that are compared, by name. Rounds of boosting run inside a task where the rows fit one."""
    return {
        "logistic_regression": Candidate(logistic(rows, max_iter), "balanced"),
        "random_forest": Candidate(forest(trees)),
        "balanced_forest": Candidate(forest(trees, depth=30), "undersampled"),
        "gradient_boosting": Candidate(gradient.Boosting(boosted(rounds))),
        "weighted_boosting": Candidate(gradient.Boosting(boosted(rounds, weighted=True)), "positive"),
        "undersampled_boosting": Candidate(gradient.Boosting(boosted(rounds)), "undersampled"),
        "linear_margin": Candidate(margin(max_iter)),
    }


def positive_probability(model: Model, df: DataFrame, name: str) -> DataFrame:
    """Add the probability of class 1; a margin model's score goes through the logistic function."""
    out = model.transform(df)
    if "probability" in out.columns:
        value = vector_to_array("probability")[1]
    else:
        value = 1.0 / (1.0 + F.exp(-vector_to_array("rawPrediction")[1]))
    return out.select(*df.columns, value.alias(name))


@dataclass(frozen=True)
class Comparison:
    models: dict[str, Model]
    predictions: DataFrame
    table: DataFrame
    weights: dict[str, float]


def compare(data: PreparedData, chosen: Mapping[str, Candidate], parallelism: int = 4) -> Comparison:
    """Fit the models, ``parallelism`` at a time, score the test side, and compare them and their two ensembles.

    A round of boosting is a few small jobs one after the other, which leave most cores idle; other fits take these.
    The driver holds the fitted models and one line of metrics per model.
    """
    spark = data.train.sparkSession

    def fit(candidate: Candidate) -> tuple[Model, float]:
        start = time.perf_counter()
        # An under-sampled view may come in a single partition, and a deep forest then grows on a single core.
        rows = training_view(data.train, candidate.view).repartition(spark.sparkContext.defaultParallelism)
        model = candidate.estimator.fit(rows)
        return model, time.perf_counter() - start

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        # Each candidate gets a thread target of its own, which carries the caller's job properties.
        running = {name: pool.submit(inheritable_thread_target(spark)(fit), chosen[name]) for name in chosen}
        fitted = {name: future.result() for name, future in running.items()}
    models, seconds = ({name: found[i] for name, found in fitted.items()} for i in (0, 1))
    scored = data.test
    for name, model in models.items():
        scored = positive_probability(model, scored, f"p_{name}")
    scored = cut_lineage(scored.drop("features"))
    rows = [evaluate.binary_metrics(scored, name, LABEL, f"p_{name}") for name in models]
    lines = [row for table in rows for row in table.collect()]
    weights = {f"p_{line['model']}": line["roc_auc"] for line in lines if line["roc_auc"] is not None}
    averaged = scoring.ensemble_weighted(scored, weights)
    highest = scoring.ensemble_max(scored, list(weights))
    for name, ensemble in (("ensemble_weighted", averaged), ("ensemble_max", highest)):
        lines += evaluate.binary_metrics(ensemble, name, LABEL, "ensemble_probability").collect()
    schema = "model string, roc_auc double, accuracy double, precision double, recall double, f1_score double"
    metrics = spark.createDataFrame(lines, schema)
    times = spark.createDataFrame(list(seconds.items()), "model string, train_seconds double")
    table = evaluate.model_comparison([metrics.join(times, "model", "left")])
    return Comparison(models, averaged, table, weights)


def ensemble_probability(models: Mapping[str, Model], weights: Mapping[str, float], df: DataFrame) -> DataFrame:
    """Weighted mean of the members' probabilities for new rows."""
    for name, model in models.items():
        if f"p_{name}" in weights:
            df = positive_probability(model, df, f"p_{name}")
    return scoring.ensemble_weighted(df, weights)


def importances(model: Model, features: Sequence[str], df: DataFrame, target: str, n: int = 50) -> DataFrame:
    """The ``n`` features with the largest importance in a tree model, with their target correlation."""
    spark = df.sparkSession
    pairs = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    table = spark.createDataFrame(pairs, "feature string, importance double")
    correlation = profile.target_correlation(df, features, target)
    return table.join(correlation, "feature").orderBy(F.desc("importance"), "feature").limit(n)


@dataclass(frozen=True)
class Search:
    """Settings that were tried, their areas on the validation share, and the best ones fitted on all rows."""

    trials: list[dict[str, float | int | str]]
    validationMetrics: list[float]
    bestModel: Model | gradient.BoostedTrees


def tune_boosting(
    train: DataFrame, n_trials: int = 100, rounds: Sequence[int] = tuple(range(50, 500, 50)), seed: int = 42, parallelism: int = 4
) -> Search:
    """Random search on a validation share, best by area (the first among equals), refitted on all rows.

    Trials are tasks side by side where the rows fit one; else the library fits them, ``parallelism`` at a time.
    """
    model = boosted(seed=seed)
    draw = random.Random(seed)
    grid = [
        {
            model.maxDepth: draw.randint(3, 10),
            model.stepSize: 10 ** draw.uniform(-2.0, -0.5),
            model.maxIter: draw.choice(list(rounds)),
            model.subsamplingRate: draw.uniform(0.5, 1.0),
            model.featureSubsetStrategy: str(draw.uniform(0.6, 1.0)),
            model.minInstancesPerNode: draw.randint(1, 10),
        }
        for _ in range(n_trials)
    ]
    trials = [{param.name: value for param, value in one.items()} for one in grid]
    rows = gradient.Boosting(model).rows(train)
    if rows is not None:
        fits = [gradient.Boosting(model.copy(one)) for one in grid]
        areas = gradient.validation_areas(train.sparkSession, rows, [fit.settings() for fit in fits], 0.2, seed)
        best = max(range(n_trials), key=areas.__getitem__)
        return Search(trials, areas, fits[best].fit_rows(train.sparkSession, rows))
    search = TrainValidationSplit(
        estimator=model,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol=LABEL),
        trainRatio=0.8,
        parallelism=parallelism,
        seed=seed,
    ).fit(train)
    return Search(trials, search.validationMetrics, search.bestModel)


def linear_reasons(
    model: Model, features: Sequence[str], scaled: DataFrame, top: int = 3, by: str = "signed"
) -> DataFrame:
    """Reason codes of a linear model on scaled rows: the contribution is coefficient * value."""
    values = scaled.withColumn("_v", vector_to_array("features"))
    coefficients = model.coefficients.toArray()
    contributions = {f: F.col("_v")[i] * F.lit(float(c)) for i, (f, c) in enumerate(zip(features, coefficients))}
    return scoring.reason_codes(values, contributions, top, by).drop("_v")


def score_open(
    data: PreparedData, model: Model, open_rows: DataFrame, key: str = KEY
) -> DataFrame:
    """Score (1-999) and three reason codes for rows without a target, scaled like the training rows."""
    imputed = profile.impute_median(open_rows, data.features)
    scaled = standardize(imputed, data.features, data.fitted_on)
    array = F.array(*[F.col(f"`{f}`") for f in data.features])
    ready = scaled.select(key, array_to_vector(array).alias("features"))
    reasons = linear_reasons(model, data.features, positive_probability(model, ready, "probability"))
    return reasons.withColumn("score", scoring.risk_score(F.col("probability"))).drop("features")


def score_all(
    labelled: DataFrame, unlabelled: DataFrame, consumers: DataFrame, features: Sequence[str], max_iter: int = 1000,
    credit: str = "credit_score", target: str = "dq_target",
) -> DataFrame:
    """The whole scoring job: a linear model with and one without the credit score, each explained, and
    both results side by side for all consumers without a target. The first model is fitted while the rows of the
    second are prepared: the iterations of a fit are small jobs, which leave cores idle."""
    target_of = inheritable_thread_target(labelled.sparkSession)

    def fit(data: PreparedData) -> Model:
        return logistic(data.train.count(), max_iter).fit(training_view(data.train, "balanced"))

    with ThreadPoolExecutor(2) as pool:
        running = []
        for columns in (list(features), [f for f in features if f != credit]):
            data = prepare(labelled, columns, target)
            running.append((data, pool.submit(target_of(fit), data)))
        results = [score_open(data, model.result(), unlabelled) for data, model in running]
    ids = consumers.filter(F.col(target).isNull())
    return scoring.final_scores(ids, *results)


def scaling_pipeline(features: Sequence[str], estimator: Estimator) -> Pipeline:
    """Assembler and model as one saveable pipeline."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), estimator])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
