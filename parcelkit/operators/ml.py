"""Model training, search, evaluation, persistence and scoring with Spark ML.

Training data are DataFrames; estimators run distributed (tree statistics
are aggregated per partition and merged).  The train frame used by several
fits is checkpointed to the shared checkpoint folder (``cut_lineage``), so
a search or mitigation loop neither recomputes the feature lineage per fit
nor restarts it after an executor loss.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.session import cut_lineage

# Registry defaults and search spaces.
MODEL_DEFAULTS = {
    "random_forest": {"numTrees": 5, "seed": 42},
    "gbt": {"maxIter": 5, "stepSize": 0.1, "seed": 42},
    "linear": {"regParam": 0.0},
}
RF_SEARCH = {
    "numTrees": [100, 200, 300, 500, 1000],
    "maxDepth": [10, 20, 30],          # Spark trees cap depth at 30
    "minInstancesPerNode": [1, 2, 4, 6, 8],
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    "bootstrap": [True, False],
}
GBT_SEARCH = {
    "maxIter": [100, 200, 300, 500, 1000],
    "stepSize": [0.001, 0.01, 0.05, 0.1],
    "maxDepth": [3, 4, 5, 6, 7, 8],
    "minInstancesPerNode": [1, 3, 5, 7],
    "subsamplingRate": [0.6, 0.7, 0.8, 0.9],
    "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9"],
}
# The configurations of the training job (boosting stops after ROUNDS_WITHOUT_GAIN).
TRAINING_CONFIGS = {
    "random_forest": {"numTrees": 500, "maxDepth": 20, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt",
                      "seed": 42},
    "gbt": {"maxIter": 500, "stepSize": 0.05, "maxDepth": 8, "minInstancesPerNode": 3, "subsamplingRate": 0.8,
            "featureSubsetStrategy": "0.8", "seed": 42},
}
ROUNDS_WITHOUT_GAIN = 50
#: Rows of a task of a boosting round, which reads them from memory some three hundred bytes each.
ROWS_PER_TASK = 500_000
_CLASSES = {"random_forest": RandomForestRegressor, "gbt": GBTRegressor, "linear": LinearRegression}


def list_models() -> dict:
    return {k: {"class": _CLASSES[k].__name__, "default_params": dict(v)} for k, v in MODEL_DEFAULTS.items()}


def get_model(name: str, label: str = "label", features: str = "features", **overrides):
    """Estimator with registry defaults merged with ``overrides``."""
    try:
        estimator, params = _CLASSES[name], MODEL_DEFAULTS[name] | overrides
    except KeyError:
        raise ValueError(f"no model named {name!r}; there are {', '.join(sorted(MODEL_DEFAULTS))}") from None
    return estimator(labelCol=label, featuresCol=features, **params)


def assembler(features: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")


def train(df: DataFrame, features: list[str], label: str, name: str = "random_forest", **params) -> PipelineModel:
    return Pipeline(stages=[assembler(features), get_model(name, label=label, **params)]).fit(df)


def train_with_early_stopping(df: DataFrame, features: list[str], label: str, validation_col: str,
                              **params) -> PipelineModel:
    """Boosted trees that stop when the validation error stops improving
    (rows flagged by ``validation_col`` are the evaluation set)."""
    est = get_model("gbt", label=label, validationIndicatorCol=validation_col, **params)
    return Pipeline(stages=[assembler(features), est]).fit(df)


def best_round(errors: list[float], patience: int = ROUNDS_WITHOUT_GAIN) -> int:
    """Rounds to keep: the best one so far when ``patience`` rounds in a row brought no gain."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def cut_back(model: PipelineModel, rounds: int) -> PipelineModel:
    """A pipeline whose boosted model keeps its first ``rounds`` trees (no second fit)."""
    gbt = model.stages[-1]
    java = gbt._java_obj
    jvm, gateway = SparkSession.active().sparkContext._jvm, SparkSession.active().sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(java.trees()[:rounds], gbt.treeWeights[:rounds])):
        trees[i], weights[i] = tree, float(weight)
    kept = jvm.org.apache.spark.ml.regression.GBTRegressionModel(gbt.uid, trees, weights, gbt.numFeatures)
    return PipelineModel([*model.stages[:-1], GBTRegressionModel(java.copyValues(kept, java.extractParamMap()))])


def bounded_tasks(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` dealt to tasks of about ``rows`` rows (ROWS_PER_TASK) where its files, small as they are, would make larger ones."""
    wanted = -(-df.count() // (rows or ROWS_PER_TASK))   # from the files' footers, for a written table
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df


def train_with_patience(train_df: DataFrame, validation_df: DataFrame, features: list[str], label: str,
                        patience: int = ROUNDS_WITHOUT_GAIN, **params) -> tuple[PipelineModel, list[float]]:
    """Boosted trees that stop after ``patience`` rounds without gain in the squared validation error, cut back to the
    best round; returns the model and the error of every round that was run.

    The rounds run in blocks that double, from just over ``patience`` to maxIter.  With the same seed the rounds of a
    shorter fit are the first rounds of a longer one, so the result is that of the full run cut back, for at most twice
    the rounds that the stop needs; the errors of a block are one pass."""
    most = params.get("maxIter", MODEL_DEFAULTS["gbt"]["maxIter"])
    block = min(most, patience + 1)
    train_df = bounded_tasks(train_df)
    while True:
        model = train(train_df, features, label, "gbt", **{**params, "maxIter": block})
        scored = model.stages[0].transform(bounded_tasks(validation_df))
        errors = [float(e) for e in model.stages[-1].evaluateEachIteration(scored, "squared")]
        rounds = best_round(errors, patience)
        if rounds + patience <= len(errors) or block == most:
            return (model if rounds == len(errors) else cut_back(model, rounds)), errors
        block = min(most, 2 * block)


def feature_importance(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    imp = model.stages[-1].featureImportances.toArray().tolist()  # one value per feature
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")


def sample_grid(space: dict, n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` seeded random draws from a parameter space."""
    rng = random.Random(seed)
    return [{k: rng.choice(v) for k, v in sorted(space.items())} for _ in range(n_iter)]


def random_search(df: DataFrame, features: list[str], label: str, name: str = "random_forest",
                  n_iter: int = 1, folds: int = 2, seed: int = 42, base: dict | None = None,
                  space: dict | None = None, parallelism: int = 2) -> tuple[PipelineModel, DataFrame]:
    """Seeded random search with k-fold CV on RMSE.  The search starts from
    the configured parameters (``base``) and overrides only the drawn keys.
    Returns the refit best model and the result table (config, mean_rmse,
    std_rmse)."""
    space = space or (RF_SEARCH if name == "random_forest" else GBT_SEARCH)
    est = get_model(name, label=label, **(base or {}))
    grid_b = ParamGridBuilder()
    draws = sample_grid(space, n_iter, seed)
    maps = []
    for d in draws:
        maps.append({getattr(est, k): v for k, v in d.items()})
    if not maps:
        maps = grid_b.build()
    pipe = Pipeline(stages=[assembler(features), est])
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=ev, numFolds=folds, seed=seed,
                        parallelism=parallelism, collectSubModels=False)
    cvm = cv.fit(df)
    spark = df.sparkSession
    rows = []
    std = cvm.stdMetrics if cvm.stdMetrics else [None] * len(maps)
    for i, (m, avg, sd) in enumerate(zip(maps, cvm.avgMetrics, std)):
        rows.append((i, str({p.name: v for p, v in m.items()}), float(avg), None if sd is None else float(sd)))
    table = spark.createDataFrame(rows, "config int, params string, mean_rmse double, std_rmse double")
    return cvm.bestModel, table


def score(model: PipelineModel, df: DataFrame, keep: list[str], version: str = "1") -> DataFrame:
    """Batch scoring: (keep..., prediction, scored_at, model_version)."""
    out = model.transform(df)
    return out.select(*keep, "prediction", F.current_timestamp().alias("scored_at"),
                      F.lit(version).alias("model_version"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass
class TrainResult:
    name: str
    model: PipelineModel
    metrics: DataFrame


def train_models(train_df: DataFrame, test_df: DataFrame, features: list[str], label: str,
                 names: list[str] | None = None, params: dict | None = None,
                 validation_df: DataFrame | None = None, fitted: dict | None = None) -> list[TrainResult]:
    """Fit each registered model on ``train_df`` and compute the regression
    metrics on ``test_df``; with ``validation_df``, boosted trees are cut back
    to their best round on it.  ``fitted`` holds models, by name, that are only
    scored (a stored forest)."""
    from parcelkit.operators.metrics import regression_metrics
    out = []
    for n in names or ["random_forest", "gbt"]:
        given = (params or {}).get(n, {})
        if n in (fitted or {}):
            m = fitted[n]
        elif n == "gbt" and validation_df is not None:
            m, _ = train_with_patience(train_df, validation_df, features, label, **given)
        else:
            m = train(train_df, features, label, n, **given)
        scored = cut_lineage(m.transform(test_df).select(label, "prediction"))   # scored once, read by each statistic
        metrics = regression_metrics(scored, label, "prediction").withColumn("model", F.lit(n))
        out.append(TrainResult(n, m, metrics))
    return out
