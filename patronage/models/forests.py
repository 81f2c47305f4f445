"""Random-forest models of the forecasting, journey and campaign families."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from patronage.functions import constants as k
from patronage.functions.expr import hash_fraction
from patronage.models.metrics import classification_metrics, regression_metrics
from patronage.operators.features import drop_incomplete, require_rows
from patronage.operators.splits import stratified_folds, train_test

CLASSIFICATION, REGRESSION = "classification", "regression"


@dataclass
class Forest:
    """A fitted model. The feature list is part of the fitted stages, so scoring cannot
    use another one."""

    kind: str
    target: str
    model: PipelineModel
    metrics: dict[str, float] = field(default_factory=dict)
    #: What a constant guess reaches on the same split; known after fitting, not stored.
    baseline: dict[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return list(self.model.stages[0].getInputCols())

    @property
    def labels(self) -> list[str]:
        return list(self.model.stages[2].labels) if self.kind == CLASSIFICATION else []


def _estimator(kind: str, features: Sequence[str], target: str, trees: int, depth: int, seed: int) -> Pipeline:
    assemble = VectorAssembler(inputCols=list(features), outputCol="raw_features")
    scale = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    if kind == REGRESSION:
        forest = RandomForestRegressor(
            labelCol=target, numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="all"
        )
        return Pipeline(stages=[assemble, scale, forest])
    index = StringIndexer(inputCol=target, outputCol="label_index", stringOrderType="alphabetAsc", handleInvalid="skip")
    forest = RandomForestClassifier(
        labelCol="label_index", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt"
    )
    return Pipeline(stages=[assemble, scale, index, forest])


def _numeric(df: DataFrame, features: Sequence[str], target: str | None, kind: str | None, keep: Sequence[str]) -> DataFrame:
    """Features as doubles with 0 for absent values; columns the model lacks become 0."""
    columns = [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)).alias(c)
        for c in features
    ]
    if target is not None:
        wanted = F.col(target).cast("double" if kind == REGRESSION else "string")
        columns.append(wanted.alias(target))
    return df.select(*[F.col(c) for c in keep], *columns)


def guess_metrics(train: DataFrame, test: DataFrame, target: str, kind: str) -> dict[str, float]:
    """Rows of both parts, and what the best constant of the training rows reaches on the test
    rows: the error of the mean, or the accuracy of the most frequent class (ties: the smallest)."""
    y = F.col(target)
    if kind == REGRESSION:
        n, guess, low, high = train.agg(F.count(F.lit(1)), F.avg(y), F.min(y), F.max(y)).first()
        n_test, error = test.agg(F.count(F.lit(1)), F.sqrt(F.avg((y - F.lit(guess)) * (y - F.lit(guess))))).first()
        return {"n_train": n, "n_test": n_test, "label_min": low, "label_max": high, "baseline_rmse": error}
    counts = train.groupBy(y.alias("c")).agg(F.count(F.lit(1)).alias("n"))
    n, guess = counts.agg(F.sum("n"), F.min(F.struct((-F.col("n")).alias("n"), "c"))["c"]).first()
    n_test, share = test.agg(F.count(F.lit(1)), F.avg((y == F.lit(guess)).cast("double"))).first()
    return {"n_train": n, "n_test": n_test, "baseline_accuracy": share}


def _held(df: DataFrame, key: str) -> DataFrame:
    """The rows in memory, or on disk, with a part for every core. A fit reads its rows a dozen times, and
    what comes out of a join or a sort of small rows is often in fewer parts than there are cores."""
    parts = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(parts, key).persist(StorageLevel.MEMORY_AND_DISK)


def train_forest(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    kind: str,
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    test_fraction: float = 0.2,
    stratify: bool = False,
    key: str = "customer_id",
    min_rows: int = 100,
) -> Forest | None:
    """Fit on 80 % of the rows and measure on the rest; None with fewer than ``min_rows``."""
    data = _held(drop_incomplete(_numeric(df, features, target, kind, [key]), [target]), key)
    held = [data]
    try:
        if not require_rows(data, min_rows):
            return None
        train, test = train_test(data, test_fraction, seed, key, target if stratify else None)
        if stratify:  # a join, not a filter of the rows at hand
            train, test = _held(train, key), _held(test, key)
            held += [train, test]
        baseline = guess_metrics(train, test, target, kind)
        model = _estimator(kind, features, target, trees, depth, seed).fit(train)
        forest = Forest(kind, target, model, baseline=baseline)
        if kind == REGRESSION:
            row = regression_metrics(model.transform(test), target, "prediction").first()
        else:
            row = classification_metrics(named_prediction(forest, model.transform(test)), target, "predicted").first()
    finally:
        for rows in held:
            rows.unpersist()
    forest.metrics = {**row.asDict(), "n_estimators": trees, "max_depth": depth}
    return forest


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    kind: str,
    folds: int = 5,
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    key: str = "customer_id",
) -> dict[str, float]:
    """Mean and standard deviation of accuracy or R2 over folds: by key hash for a number, and for a
    class dealt out within it, so that every fold has its share of a rare one."""
    data = drop_incomplete(_numeric(df, features, target, kind, [key]), [target])
    if kind == REGRESSION:
        data = data.withColumn("fold", F.floor(hash_fraction(key, seed) * folds).cast("int"))
    else:
        data = stratified_folds(data, target, folds, seed, key)
    estimator = _estimator(kind, features, target, trees, depth, seed)
    if kind == REGRESSION:
        evaluator, name = RegressionEvaluator(labelCol=target, metricName="r2"), "cv_r2"
    else:
        evaluator = MulticlassClassificationEvaluator(labelCol="label_index", metricName="accuracy")
        name = "cv_accuracy"
    data = _held(data, key)

    def measured(fold: int) -> float:
        train, test = data.filter(F.col("fold") != fold), data.filter(F.col("fold") == fold)
        if train.isEmpty() or test.isEmpty():
            raise ValueError(f"fold {fold} or its rest has no rows")
        return evaluator.evaluate(estimator.fit(train).transform(test))

    # the folds alone: a CrossValidator would fit all rows once more, for a model that nobody reads
    with ThreadPool(2) as pool:
        values = pool.map(inheritable_thread_target(data.sparkSession)(measured), range(folds), chunksize=1)
    data.unpersist()
    return {f"{name}_mean": float(np.mean(values)), f"{name}_std": float(np.std(values))}


def named_prediction(forest: Forest, scored: DataFrame, output: str = "predicted") -> DataFrame:
    """Class names instead of class numbers."""
    return IndexToString(inputCol="prediction", outputCol=output, labels=forest.labels).transform(scored)


def apply_forest(forest: Forest, df: DataFrame, keep: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Kept columns plus ``prediction`` (and ``probability``, ``predicted`` of a classifier)."""
    # the label indexer is for fitting only: scored rows have no label
    stages = [s for s in forest.model.stages if not isinstance(s, StringIndexerModel)]
    scored = PipelineModel(stages).transform(_numeric(df, forest.features, None, None, keep))
    if forest.kind == REGRESSION:
        return scored.select(*keep, "prediction")
    return named_prediction(forest, scored).select(*keep, "predicted", "probability")


def class_probability(forest: Forest, label: str) -> Column:
    """Probability of a class by its name; 0 for a class the model never saw."""
    if label not in forest.labels:
        return F.lit(0.0)
    return vector_to_array("probability")[forest.labels.index(label)]


def top_probability() -> Column:
    return F.array_max(vector_to_array("probability"))


# ---- the eight models ----------------------------------------------------------------

def train_revenue(df: DataFrame, features: Sequence[str] = k.REVENUE_FEATURES, target: str = "monetary_value", **options) -> Forest | None:
    return train_forest(df, features, target, REGRESSION, **options)


def train_ctr(df: DataFrame, features: Sequence[str] = k.CTR_FEATURES, target: str = "ctr", **options) -> Forest | None:
    return train_forest(df, features, target, REGRESSION, **options)


def train_stage(df: DataFrame, features: Sequence[str] = k.JOURNEY_FEATURES, target: str = "journey_stage", **options) -> Forest | None:
    return train_forest(df, features, target, CLASSIFICATION, stratify=True, **options)


def train_conversion(
    df: DataFrame,
    kind: str = REGRESSION,
    features: Sequence[str] = k.JOURNEY_FEATURES,
    target: str = "conversion_probability",
    **options,
) -> Forest | None:
    """Regression of the probability, or (``kind=CLASSIFICATION``) of a 0/1 label."""
    return train_forest(df, features, target, kind, **options)


def train_success(df: DataFrame, features: Sequence[str] = k.SUCCESS_FEATURES, target: str = "campaign_success", **options) -> Forest | None:
    return train_forest(df, features, target, CLASSIFICATION, **options)


def train_budget(df: DataFrame, features: Sequence[str] = k.BUDGET_FEATURES, target: str = "optimal_budget", **options) -> Forest | None:
    return train_forest(df, features, target, REGRESSION, **options)
