"""The whole work on CSV files made from the role views."""

import os

import pytest
from pyspark.sql import functions as F

from creditloom.operators import models
from creditloom.plans import catalog, lending
from creditloom.sources import files

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("work")
    d = catalog.data(spark, FOLDER)
    for name, table in d.tables().items():
        files.write_csv(table, str(folder / "raw" / f"{name}.csv"))
    tables = lending.csv_inputs(spark, str(folder / "raw"))
    expected = {name: table.count() for name, table in d.tables().items() if name != "application_test"}
    lending.extract(tables, str(folder), expected)
    prepared, fitted = lending.transform(spark, tables, str(folder))
    return folder, tables, prepared, fitted


def test_extract_refuses_truncated_inputs(work):
    folder, tables, _, _ = work
    with pytest.raises(ValueError, match="bureau"):
        lending.extract(tables, str(folder / "never"))
    assert not os.path.exists(folder / "never")


def test_csv_inputs_equal_the_tables(spark, work):
    _, tables, _, _ = work
    d = catalog.data(spark, FOLDER)
    for name in ("bureau", "installments_payments", "POS_CASH_balance"):
        a, b = tables[name], d.tables()[name].select(*tables[name].columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_prepared_matrix(spark, work):
    _, _, prepared, fitted = work
    assert prepared.count() == 150
    assert len([c for c in fitted.numeric if c.startswith(("bur_", "prev_", "pos_", "cc_", "inst_"))]) == 79 + 3
    assert set(fitted.features()) <= set(prepared.columns)
    assert "float" in dict(prepared.dtypes).values() and "tinyint" in dict(prepared.dtypes).values()
    # the stage from CSV equals the one built directly from the role views
    direct = catalog.data(spark, FOLDER).prepared()
    sums = lambda df: [float(v) for v in df.agg(*[F.sum(F.col(f"`{c}`").cast("double")) for c in fitted.features()]).first()]
    assert sums(prepared) == pytest.approx(sums(direct), rel=1e-5, abs=1e-3)


def test_published_layer(spark, work):
    folder, *_ = work
    mart, checks = lending.publish(spark, str(folder))
    assert sum(r.customers for r in mart.collect()) == spark.table("credit_data").count() == (
        catalog.data(spark, FOLDER).roles.train().count()
    )
    assert {r.check_name: r.status for r in checks.collect()}["row_count"] == "error"
    spark.sql("DROP TABLE credit_data")
    spark.sql("DROP TABLE fct_cohort_default_rates")


def test_exploration_tables(work):
    _, _, prepared, _ = work
    tables = lending.explore(prepared.where("SET = 'train'"))
    assert tables["rate_by_age"].count() > 1 and tables["top_correlations"].count() == 20
    assert tables["rate_grid"].columns == ["age_group", "Unstable", "Short-term", "Moderate", "Stable"]
    assert tables["class_histogram"].count() > 10


def test_training(spark, work):
    folder, _, prepared, fitted = work
    names = fitted.features()
    found = lending.train_models(
        prepared, names, str(folder), learners=("logistic", "forest"),
        overrides={"logistic": {"maxIter": 20}, "forest": {"numTrees": 5, "maxDepth": 3}},
    )
    assert {r.model for r in found["metrics"].collect()} == {"logistic", "forest"}
    assert found["best"] in ("logistic", "forest") and 0.05 <= found["threshold"] <= 0.9
    assert found["cross_validation"].first().folds == 5
    assert found["sweep"].count() == 18 and os.path.exists(found["path"])
    assert found["cumulative_gain"].agg(F.max("gain_pct")).first()[0] == 100.0


def test_bounded_scores_and_round_trip(spark, work):
    from creditloom.operators import models, sampling
    folder, _, prepared, fitted = work
    labelled, unlabelled = sampling.slice_sets(prepared)
    names = fitted.features()
    model = models.fit_model("boosted_a", labelled, names, maxIter=2)
    scores = {r.SK_ID_CURR: r.score for r in models.score_rows(model, unlabelled).collect()}
    assert len(scores) == unlabelled.count() > 0 and all(0 <= s <= 1 for s in scores.values())
    again = models.load_model(models.save_model(model, "Boosted A", str(folder / "m")))
    assert {r.SK_ID_CURR: r.score for r in models.score_rows(again, unlabelled).collect()} == scores
    same = models.fit_model("boosted_a", labelled, names, maxIter=2)
    assert {r.SK_ID_CURR: r.score for r in models.score_rows(same, unlabelled).collect()} == scores


def test_one_class_cannot_train(spark, work):
    from creditloom.operators import models
    _, _, prepared, _ = work
    with pytest.raises(ValueError, match="both classes"):
        models.fit_model("logistic", prepared.where("TARGET = 0"), ["AMT_CREDIT"])


def test_scoring_of_new_applications(spark, work):
    from creditloom.operators import models, sampling
    folder, tables, prepared, fitted = work
    labelled, _ = sampling.slice_sets(prepared)
    model = models.fit_model("logistic", labelled, fitted.features(), maxIter=5)
    path = models.save_model(model, "logistic", str(folder / "scoring"))
    # an unseen category, and a number missing that never was
    new = tables["application_test"].withColumns({"NAME_SEGMENT": F.lit("UNSEEN"), "DAYS_BIRTH": F.lit(None).cast("int")})
    scores = lending.score(spark, {**tables, "application_test": new}, str(folder), path).collect()
    assert len(scores) == new.count() > 0 and all(0 <= r.score <= 1 for r in scores)


def test_wide_categories_reach_models_and_scores(spark, work):
    folder, tables, _, _ = work
    prepared, fitted = lending.transform(spark, tables, str(folder), dense=3)
    assert fitted.wide and not any(n.startswith(fitted.wide[0]) for n in fitted.features())
    row = prepared.first()
    assert 1 <= row[lending.FLAGS].size < 20 and fitted.wide[0] not in prepared.columns
    train = prepared.where("SET = 'train'")
    model = models.fit_model("logistic", train, fitted.features(), vectors=[lending.FLAGS], maxIter=5)
    path = models.save_model(model, "wide", str(folder))
    again = {r.SK_ID_CURR: r.score for r in lending.score(spark, tables, str(folder), path).collect()}
    direct = {r.SK_ID_CURR: r.score for r in models.score_rows(model, prepared.where("SET = 'test'")).collect()}
    assert again.keys() == direct.keys() and all(abs(again[k] - direct[k]) < 1e-6 for k in again)


def test_restart_uses_finished_summaries_of_the_same_inputs(spark, work, monkeypatch):
    folder, tables, prepared, _ = work
    # last in this file, as it writes the prepared table anew
    written, write = [], lending.files.write_stage

    def noted(df, path, *given, **measures):
        written.append(path.rsplit("/", 1)[1].split("-")[0])
        return write(df, path, *given, **measures)

    monkeypatch.setattr(lending.files, "write_stage", noted)
    again, _ = lending.transform(spark, tables, str(folder))
    assert again.count() == 150
    assert written == ["engineered", "prepared"]
    changed = {**tables, "POS_CASH_balance": tables["POS_CASH_balance"].where("SK_ID_CURR <> 3")}
    lending.transform(spark, changed, str(folder))
    assert written[2:] == ["summary_pos", "engineered", "prepared"]
    build = lending.SUMMARIES["card"]
    monkeypatch.setitem(lending.SUMMARIES, "card", lambda t: build(t).where("SK_ID_CURR > 5"))
    lending.transform(spark, changed, str(folder))
    assert written[5:] == ["summary_card", "engineered", "prepared"]
