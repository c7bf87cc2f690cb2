"""Learners against an independent solution, and their settings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import categories, models, sampling


def solve(x, y, w):
    """Weighted logistic regression with a unit penalty on the slopes of standardised features, by Newton steps."""
    z = (x - x.mean(0)) / x.std(0)
    design = np.column_stack([np.ones(len(z)), z])
    penalty = np.diag([0.0] + [1.0] * z.shape[1])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (w * (p - y)) + penalty @ beta
        hessian = design.T @ (design * (w * p * (1 - p))[:, None]) + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return 1 / (1 + np.exp(-design @ beta))


def test_logistic_matches_the_direct_solution(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3)) * [1.0, 50.0, 0.01] + [0.0, 7.0, 3.0]
    y = (x[:, 0] + rng.normal(size=60) > 0.8).astype(int)
    counts = np.bincount(y)
    w = np.where(y == 1, 60 / (2 * counts[1]), 60 / (2 * counts[0]))
    rows = [(i, int(t), *map(float, v)) for i, (t, v) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, a double, `b.c` double, d double")
    model = models.fit_model("logistic", df, ["a", "b.c", "d"], tol=1e-12)
    got = [r.score for r in models.score_rows(model, df).orderBy("SK_ID_CURR").collect()]
    assert np.allclose(got, solve(x, y, w), atol=1e-6)
    names = [r.feature for r in models.feature_importance(model).collect()]
    assert names[0] == "a" and set(names) == {"a", "b.c", "d"}


def test_default_hyperparameters():
    for name, expected in {
        "logistic": {"maxIter": 500}, "forest": {"numTrees": 300, "maxDepth": 12},
        "boosted_a": {"maxIter": 400, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8},
        "boosted_b": {"maxIter": 600, "maxDepth": 7, "stepSize": 0.03},
    }.items():
        last = models.learner(name, ["a"]).getStages()[-1].estimator(10.0, 10)
        assert {k: last.getOrDefault(k) for k in expected} == expected


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "TARGET int")
    for kind, want in (("balanced", {0: 8 / 12, 1: 2.0}), ("positive", {0: 1.0, 1: 3.0})):
        rows, total, n = models.weighted(df, kind=kind)
        assert {r.TARGET: r[models.WEIGHT] for r in rows.distinct().collect()} == want
        assert total == pytest.approx(6 * want[0] + 2 * want[1]) and n == 8


def test_cross_validation(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(i % 5 == 0), float(i % 5 == 0) + float(rng.normal()) * 0.5) for i in range(200)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, a double")
    row = models.cross_validate("logistic", df, ["a"], rows=150, maxIter=20).first()
    assert row.folds == 5 and 0.8 < row.auc_mean <= 1 and row.auc_std >= 0


def test_each_fold_has_medians_and_weights_of_its_own(spark):
    rows = [(i, int(i % 4 == 0), float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, a double")
    fitted = models.validated("logistic", df, ["a"], rows=120, keep_models=True, maxIter=5)
    whole = fitted.bestModel.stages[0].getStatement()
    folds = [m[0].stages[0].getStatement() for m in fitted.subModels]
    assert "59.5D" in whole and len(folds) == 5
    folded = sampling.sample_rows(df, 120, "SK_ID_CURR", models.S.SEED)
    folded = folded.withColumn("f", sampling.fold_column(folded, "SK_ID_CURR", "TARGET", 5, models.S.SEED + 1)).collect()
    for i, statement in enumerate(folds):
        kept = sorted(r.a for r in folded if r.f != i)
        median = (kept[(len(kept) - 1) // 2] + kept[len(kept) // 2]) / 2
        assert f"{median!r}D" in statement
    assert len(set(folds)) > 1


def test_models_take_vectors_of_flags(spark, tmp_path):
    rows = [(i, int(i % 7 < 3), float(i % 5), f"v{i % 7}") for i in range(140)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, a double, s string")
    found = categories.fit_categories(df, ["s"], str(tmp_path / "fit"))
    flagged = categories.flag_vectors(df, found, str(tmp_path / "rows"))
    for name in ("logistic", "forest"):
        given = {"numTrees": 10} if name == "forest" else {}
        model = models.fit_model(name, flagged, ["a"], vectors=["flags"], **given)
        model = models.load_model(models.save_model(model, name, str(tmp_path)))
        scored = models.score_rows(model, flagged, label="TARGET").collect()
        assert all((r.score > 0.5) == (r.label == 1) for r in scored)
    names = {r.feature for r in models.feature_importance(model, k=20).collect()}
    assert names == {"a", *[f"flags_{i}" for i in range(6)]}


def test_leaderboard_breaks_ties_by_name(spark):
    board = spark.createDataFrame([("b", 0.7), ("a", 0.7), ("c", 0.9)], "model string, auc_roc double")
    assert [r.model for r in models.leaderboard(board).collect()] == ["c", "a", "b"]


def test_missing_features_are_filled_by_the_stored_model(spark, tmp_path):
    rows = [(i, i % 2, float(i) if i % 3 else None, None) for i in range(30)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, `a.b` double, empty double")
    model = models.fit_model("logistic", df, ["a.b", "empty"])
    again = models.load_model(models.save_model(model, "m", str(tmp_path)))
    scores = {r.SK_ID_CURR: r.score for r in models.score_rows(again, df).collect()}
    known = sorted(r[2] for r in rows if r[2] is not None)
    median = (known[9] + known[10]) / 2
    filled = models.score_rows(model, df.fillna({"empty": 0.0}).withColumn(
        "a.b", F.coalesce(F.col("`a.b`"), F.lit(median))))
    assert len(scores) == 30 and {r.SK_ID_CURR: r.score for r in filled.collect()} == scores
    assert models.fit_model("logistic", df, ["a.b"], most_rows=10).stages[-1].numFeatures == 1


def test_registered_models_use_the_default_parameters():
    import inspect

    from creditloom.plans import catalog
    source = inspect.getsource(catalog.Data.model) + inspect.getsource(catalog)
    assert not hasattr(catalog, "TRIAL_SIZE") and "maxIter" not in source and "numTrees" not in source


def test_a_learner_gathers_the_rows_it_is_given(spark, monkeypatch):
    """The folds of a sample are learned from few partitions, however many the table has they come from."""
    seen = []

    class Kept:
        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return self

    learner = models.WeightedLearner("logistic")
    monkeypatch.setattr(learner, "estimator", lambda total_weight, rows: Kept())
    rows = spark.range(0, 100, numPartitions=20).selectExpr("cast(id % 2 as int) AS TARGET")
    learner.fit(rows)
    monkeypatch.setattr(models, "ROWS_PER_PARTITION", 30)
    learner.fit(rows)
    assert seen == [1, 4]


@pytest.mark.parametrize("n, cores, parts", [
    (50_000, 12, 1), (60_000, 12, 12), (60_000, 4, 4), (50_001, 200, 10), (607_680, 12, 12), (607_680, 8, 16), (3_646_080, 12, 72),
])
def test_forest_rows_fill_whole_rounds_of_the_cores(n, cores, parts):
    assert models._even_partitions(n, cores) == parts


def test_forest_rows_are_dealt_evenly_and_kept_during_the_fit(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(models, "LEAST_ROWS", 20)
    # all rows lie in one partition
    df = spark.range(0, 400, 1, 1).select((F.col("id") % 2).cast("int").alias("TARGET"), F.sin("id").alias("a"))
    kept = lambda: spark._jsc.sc().getPersistentRDDs().size()
    seen, fit = [], models.WeightedLearner._fit

    def watched(self, dataset):
        seen.append((kept(), [r[0] for r in dataset.groupBy(F.spark_partition_id()).count().select("count").collect()]))
        return fit(self, dataset)

    monkeypatch.setattr(models.WeightedLearner, "_fit", watched)
    before = kept()
    models.fit_model("forest", df, ["a"], numTrees=2)
    (during, sizes), = seen
    assert during == before + 1 and kept() == before
    assert len(sizes) == models._even_partitions(400, spark.sparkContext.defaultParallelism) > 1
    assert sum(sizes) == 400 and max(sizes) - min(sizes) <= len(sizes)
