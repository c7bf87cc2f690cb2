"""Default classifiers with Spark ML: fitting, scoring, validation, importance, persistence."""

import os
from datetime import datetime

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from creditloom import settings as S
from creditloom.functions.scalar import col, quoted, unquoted
from creditloom.operators.boosting import BoostedTrees
from creditloom.operators.profile import class_counts
from creditloom.operators.quantiles import medians
from creditloom.operators.ranking import class_report, ranking_summary
from creditloom.operators.sampling import fold_column, sample_rows
from creditloom.session import small_table

WEIGHT = "_weight"
FEATURES = "_features"
ROWS_PER_PARTITION = 50_000  # of the rows to train on, about
LEAST_ROWS = 5_000  # of a partition, where there are too few rows to give all cores 50,000

# Hyperparameters per learner.
LEARNERS = {
    "logistic": {"weights": "balanced", "params": {"maxIter": 500}},
    "forest": {
        "weights": "balanced",
        "params": {"numTrees": 300, "maxDepth": 12, "featureSubsetStrategy": "sqrt"},
    },
    "boosted_a": {
        "weights": "positive",
        "params": {
            "maxIter": 400, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8, "columnShare": 0.8,
            "regLambda": 1.0, "minHessian": 1.0,
        },
    },
    "boosted_b": {
        "weights": "balanced",
        "params": {"maxIter": 600, "maxDepth": 7, "stepSize": 0.03, "maxLeaves": 63, "minRows": 20},
    },
}


def _weights(counts, kind):
    n0, n1 = counts[0], counts[1]
    if not n0 or not n1:
        raise ValueError("training needs rows of both classes")
    if kind == "positive":
        return 1.0, n0 / n1
    return (n0 + n1) / (2 * n0), (n0 + n1) / (2 * n1)


def _estimator(name, label, total_weight, rows, seed, overrides):
    params = {**LEARNERS[name]["params"], **overrides}
    common = {"labelCol": label, "weightCol": WEIGHT, "featuresCol": FEATURES}
    if name == "logistic":
        # Unit inverse regularisation spread over the total weight. Spark scales by the deviation
        # over n - 1; the factor gives the penalty it has on features scaled by that over n.
        penalty = (rows - 1) / rows / total_weight
        return LogisticRegression(
            **{**common, "featuresCol": "_scaled"}, standardization=False, regParam=penalty, **params
        )
    if name == "forest":
        return RandomForestClassifier(**common, seed=seed, **params)
    return BoostedTrees(**common, seed=seed, **params)


def weighted(df, label=S.LABEL, kind="balanced", counts=None):
    """The rows with a class weight column, the sum of the weights and the number of rows."""
    counts = counts or class_counts(df, label)
    w0, w1 = _weights(counts, kind)
    rows = df.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0)))
    return rows, w0 * counts[0] + w1 * counts[1], counts[0] + counts[1]


def _partitions(n):
    """Partitions for ``n`` rows to train on."""
    return max(1, -(-n // ROWS_PER_PARTITION))


def _even_partitions(n, cores):
    """Partitions of equal size for ``n`` rows to train on: whole rounds of the cores, or as many as the rows are worth.

    A single partition stays one.
    """
    most = _partitions(n)
    if most == 1:
        return 1
    return round(most / cores) * cores if most >= cores else max(most, min(cores, n // LEAST_ROWS))


def _imputer(fill):
    """A stage that replaces missing features by ``fill``, stored with the model."""
    names = ", ".join(quoted(c) for c in fill)
    full = ", ".join(f"coalesce(CAST({quoted(c)} AS DOUBLE), {float(v)!r}D) AS {quoted(c)}" for c, v in fill.items())
    return SQLTransformer(statement=f"SELECT * EXCEPT ({names}), {full} FROM __THIS__")


def _without_summary(model):
    """The fitted model without its training summary.

    The summary holds the session, which cannot be sent to executors once it has observed a write;
    a stored model has none either.
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


class MedianFill(Estimator):
    """Fits the exact medians of the features over the rows it is given; 0 for a feature without values.

    The fitted stage is a projection that is stored with the model.
    """

    def __init__(self, features):
        super().__init__()
        self.features = list(features)

    def _fit(self, dataset):
        return _imputer(fill_values(dataset, self.features))


class WeightedLearner(Estimator):
    """Fits a learner with class weights, and the penalty that goes with them, from the rows it is given."""

    def __init__(self, name, label=S.LABEL, seed=S.SEED, overrides=None):
        super().__init__()
        self.name, self.label, self.seed, self.overrides = name, label, seed, overrides or {}

    def estimator(self, total_weight, rows):
        return _estimator(self.name, self.label, total_weight, rows, self.seed, self.overrides)

    def _fit(self, dataset):
        rows, total_weight, n = weighted(dataset, self.label, LEARNERS[self.name]["weights"])
        # the folds of a sample lie in as many partitions as the table it comes from; rows dealt before stay as they are
        cores = dataset.sparkSession.sparkContext.defaultParallelism
        rows = rows.coalesce(_even_partitions(n, cores) if self.name == "forest" else _partitions(n))
        return _without_summary(self.estimator(total_weight, n).fit(rows))


def learner(name, features, label=S.LABEL, seed=S.SEED, vectors=(), **overrides):
    """Imputer, assembler, scaler where the learner needs one, and the learner as one Spark ML workflow.

    Fill values and class weights are fitted with it, so a validation refits them on the rows of
    each fold. ``vectors`` are columns of sparse flags, placed behind the features.
    """
    inputs = [quoted(c) for c in [*features, *vectors]]
    stages = [MedianFill(features)] if features else []
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    if name == "logistic":
        # centring would fill every zero of sparse flags; the intercept takes up the means
        stages.append(StandardScaler(inputCol=FEATURES, outputCol="_scaled", withMean=not vectors, withStd=True))
    return Pipeline(stages=[*stages, WeightedLearner(name, label, seed, overrides)])


def fill_values(df, features):
    """Median of each feature over the rows to train on; 0 for one without values."""
    return {c: m if m is not None else 0.0 for c, m in medians(df, {c: col(c) for c in features}).items()}


def fit_model(name, df, features, label=S.LABEL, seed=S.SEED, most_rows=None, key=S.CUSTOMER, vectors=(), **overrides):
    """Fit a learner on rows that may miss features. Overrides replace single hyperparameters.

    ``most_rows`` bounds the labelled rows to train on, drawn by a hash of their
    key; without it all rows are used. Small inputs are gathered into few
    partitions, as boosting runs thousands of short stages. Larger ones for the forest are
    dealt evenly and kept until the fit ends, so that each of its long passes, those of the
    medians too, keeps all cores busy and reads no file.
    """
    rows = df.where(F.col(label).isNotNull())
    if most_rows is not None:
        rows = sample_rows(rows, most_rows, key, seed)
    rows = rows.select(label, *[col(c) for c in [*features, *vectors]])
    n = rows.count()
    workflow = learner(name, features, label, seed, vectors, **overrides)
    if _partitions(n) == 1 or name != "forest":
        return workflow.fit(rows.coalesce(_partitions(n)))
    kept = rows.repartition(_even_partitions(n, rows.sparkSession.sparkContext.defaultParallelism))
    kept.persist()
    try:
        return workflow.fit(kept)
    finally:
        kept.unpersist()


def _features(model):
    """The quoted names of the columns a stored model reads."""
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def score_rows(model, df, key=S.CUSTOMER, label=None):
    """Probability of default and predicted class per row; the label beside them if given. Features may be missing."""
    kept = [col(key).alias(key)] + ([F.col(label).cast("int").alias("label")] if label else [])
    rows = df.select(*kept, *[F.col(c) for c in _features(model)])
    return model.transform(rows).select(
        key, *(["label"] if label else []),
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("predicted"),
    )


METRICS = "model string, auc_roc double, avg_precision double, recall_default double, precision_default double, f1_default double"


def evaluate(scored_by_model):
    """One metrics row per model, best area under the ROC curve first."""
    rows = []
    for name, scored in scored_by_model.items():
        ranks, classes = ranking_summary(scored).first(), class_report(scored).first()
        rows.append((
            name, ranks.auc_roc, ranks.avg_precision,
            classes.recall_default, classes.precision_default, classes.f1_default,
        ))
    return leaderboard(small_table(SparkSession.active(), rows, METRICS))


def leaderboard(metrics):
    return metrics.orderBy(F.desc("auc_roc"), "model")


def feature_importance(model, k=S.TOP_IMPORTANCES):
    """The k most important features: impurity importance, or absolute coefficient."""
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    names = [unquoted(name) for name in _features(model)]
    if len(values) > len(names):  # the last input is a vector of flags
        names[-1:] = [f"{names[-1]}_{i}" for i in range(len(values) - len(names) + 1)]
    rows = [(name, abs(float(v))) for name, v in zip(names, values.toArray())]
    return small_table(SparkSession.active(), rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    ).limit(k)


def validated(
    name, df, features, key=S.CUSTOMER, label=S.LABEL, folds=S.CV_FOLDS, rows=S.CV_SAMPLE_ROWS,
    seed=S.SEED, parallelism=1, keep_models=False, vectors=(), **overrides,
):
    """Spark ML's validation over stratified folds of a sample.

    The whole workflow is fitted on each fold's own rows: medians, class weights, scaler and learner.
    """
    sample = sample_rows(df.where(F.col(label).isNotNull()), rows, key, seed)
    sample = sample.withColumn("_fold", fold_column(sample, key, label, folds, seed + 1)).select(
        label, "_fold", *[col(c) for c in [*features, *vectors]]
    )
    return CrossValidator(
        estimator=learner(name, features, label, seed, vectors, **overrides),
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0),
        numFolds=folds, foldCol="_fold", seed=seed, parallelism=parallelism, collectSubModels=keep_models,
    ).fit(sample)


def cross_validate(name, df, features, folds=S.CV_FOLDS, **given):
    """Mean and population deviation of the area under the ROC curve over stratified folds of a sample."""
    fitted = validated(name, df, features, folds=folds, **given)
    return small_table(
        df.sparkSession, [(name, folds, float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0]))],
        "model string, folds int, auc_mean double, auc_std double",
    )


def save_model(model, name, folder):
    """Store a fitted model under its name and the time; returns the path."""
    path = os.path.join(folder, f"{name.replace(' ', '_')}_{datetime.now():%Y%m%d_%H%M%S_%f}")
    model.write().overwrite().save(path)
    return path


def load_model(path):
    return PipelineModel.load(path)
