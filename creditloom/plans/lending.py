"""The end-to-end work: extract, transform, train. Stages meet only in stage tables."""

import os
import warnings
from functools import reduce

from pyspark.sql import functions as F

from creditloom import settings as S
from creditloom.functions.scalar import col
from creditloom.operators import (
    categories, decision, features, joins, marts, models, prepare, profile, quality, ranking, sampling, summaries,
)
from creditloom.session import fresh_path, path_exists, size_shuffles, small_table
from creditloom.sources import files, schemas

FLAGS = "category_flags"
SUMMARIES = {
    "bureau": lambda t: summaries.summarise_bureau(t["bureau"], t["bureau_balance"]),
    "previous": lambda t: summaries.summarise_previous(t["previous_application"]),
    "pos": lambda t: summaries.summarise_pos(t["POS_CASH_balance"]),
    "card": lambda t: summaries.summarise_card(t["credit_card_balance"]),
    "instalments": lambda t: summaries.summarise_instalments(t["installments_payments"]),
}


def csv_inputs(spark, folder):
    """The eight inputs from CSV files. Types of the application tables are inferred for the
    columns the schema does not name; the others are declared and only the used columns are read."""
    tables = {}
    for name, schema in schemas.INPUTS.items():
        path = os.path.join(folder, f"{name}.csv")
        if not path_exists(spark, path):
            raise FileNotFoundError(path)
        wide = name.startswith("application")
        tables[name] = files.read_csv(
            spark, path, None if wide else schema, None if wide else schema.fieldNames()
        )
    return tables


def all_summaries(tables):
    return [build(tables) for build in SUMMARIES.values()]


def customer_features(applications, parts):
    """Applications with all summaries and engineered columns, as one lazy plan."""
    view = joins.customer_view(applications, parts)
    return features.engineer(view, applications.columns)


def extract(tables, folder, expected=None):
    """Check the inputs and write the consolidated application table.

    Inputs with under 90 % of the expected rows are reported as warnings; absent
    ones or those with under half stop the work.
    """
    if expected != {}:
        for row in quality.check_completeness(tables, expected):
            if row.status == "warn":
                warnings.warn(f"{row.table_name}: {row.actual_rows} of {row.expected_rows} rows", stacklevel=2)
    union = joins.union_sets(tables["application_train"], tables["application_test"])
    return files.write_stage(union, os.path.join(folder, "applications"))[0]


def transform(spark, tables, folder, fresh=False, fit_on="all", dense=prepare.DENSE_CATEGORIES):
    """Summaries, customer view, features, prepared matrix and exports, each a stage table.

    Every summary is stored once, and redone when its inputs or its own plan change; so is the
    engineered view, as several passes take statistics from it. Rows and missing values are counted while
    tables are written. A join that multiplied rows stops the work before anything is prepared from them.
    Text columns of more than ``dense`` values become one vector of sparse flags, which the exports leave out.
    """
    path = os.path.join(folder, "applications")
    applications = files.read_table(spark, path)
    size_shuffles(spark, [applications, *tables.values()])
    parts = []
    for name, build in SUMMARIES.items():
        summary = build(tables)
        version = files.fingerprint([summary])
        parts.append(files.load_or_compute(spark, folder, f"summary_{name}", lambda s=summary: s, fresh, version))
    engineered, counted = files.write_stage(customer_features(applications, parts), os.path.join(folder, "engineered"))
    known = files.manifest(spark, path)
    before = known["rows"] if known else applications.count()
    if before != counted["rows"]:
        joins.check_unique(dict(zip(SUMMARIES, parts)))
        joins.check_row_count(before, counted["rows"])

    basis = engineered if fit_on == "all" else engineered.where(F.col(S.SET) == "train")
    fitted = prepare.fit(basis, dense=dense)
    save_preparation(spark, fitted, folder)
    prepared = prepare.apply(engineered, fitted)
    if fitted.wide:
        found = categories.fit_categories(prepare.plain_types(basis), fitted.wide, os.path.join(folder, "categories"))
        prepared = categories.flag_vectors(prepared, found, os.path.join(folder, "flagged"), FLAGS)
    plan = [p for p in prepare.compact_types(prepared) if p[0] != S.CUSTOMER]
    missing = F.count_if(reduce(lambda a, b: a | b, [col(c).isNull() for c in fitted.features()], F.lit(False)))
    prepared, counted = files.write_stage(prepare.compact(prepared, plan), os.path.join(folder, "prepared"), missing=missing)
    if counted["missing"]:
        prepare.check_no_nulls(prepared, fitted.features())
    train = prepared.where(F.col(S.SET) == "train").drop(FLAGS)
    files.export_slim(train, os.path.join(folder, "credit_data_csv"))
    files.export_full(train, os.path.join(folder, "enriched_csv"))
    return prepared, fitted


def save_preparation(spark, fitted, folder):
    """Store the fitted facts beside the stage tables, for scoring later."""
    rows = small_table(spark, [(fitted.to_json(),)], "value string")
    rows.coalesce(1).write.mode("overwrite").text(os.path.join(folder, "preparation"))


def load_preparation(spark, folder):
    return prepare.Preparation.from_json(spark.read.text(os.path.join(folder, "preparation"), wholetext=True).first()[0])


def score(spark, tables, folder, model_path):
    """Scores of new applications, prepared by the facts stored in ``folder``.

    ``tables`` has the same inputs as the training, with the new applications as
    ``application_test``.
    """
    applications = tables["application_test"].withColumns(
        {S.SET: F.lit("test"), S.LABEL: F.lit(None).cast("double")}
    )
    engineered = customer_features(applications, all_summaries(tables))
    fitted = load_preparation(spark, folder)
    prepared = prepare.apply(engineered, fitted, keep=(S.CUSTOMER,))
    if fitted.wide:
        found = categories.load_categories(spark, os.path.join(folder, "categories"), fitted.wide)
        prepared = categories.flag_vectors(prepared, found, fresh_path(spark, "flagged"), FLAGS)
    return models.score_rows(models.load_model(model_path), prepared)


def explore(train):
    """The tables behind the exploration charts."""
    cut = profile.exploration_segments(train)
    return {
        "rate_by_age": profile.rate_by_age(cut),
        "rate_by_employment": profile.rate_by_employment(cut),
        "rate_by_income": profile.rate_by_income(cut),
        "rate_grid": profile.rate_grid(cut),
        "class_histogram": profile.class_histogram(train),
        "top_correlations": profile.top_correlations(
            train, profile.numeric_columns(train, without=[S.LABEL, S.CUSTOMER])
        ),
    }


def train_models(prepared, names, folder, learners=tuple(models.LEARNERS), overrides=None):
    """Fit, score, rank and store the models; choose the threshold of the best one.

    Logistic regression and forest take the vector of sparse flags where there is one. The boosted
    learners bin every feature and leave it out.
    """
    vectors = [FLAGS] if FLAGS in prepared.columns else []
    taken = {name: [] if name.startswith("boosted") else vectors for name in learners}
    labelled, _ = sampling.slice_sets(prepared)
    train, held_out = sampling.stratified_split(labelled)
    fitted, scored = {}, {}
    for name in learners:
        fitted[name] = models.fit_model(name, train, names, vectors=taken[name], **(overrides or {}).get(name, {}))
        # scores are written once: every metric and curve reads them
        scored[name] = files.write_table(
            models.score_rows(fitted[name], held_out, label=S.LABEL), os.path.join(folder, f"scored_{name}")
        )
    board = files.write_table(models.evaluate(scored), os.path.join(folder, "model_results"))
    best = models.leaderboard(board).first()["model"]
    folds = models.cross_validate(best, train, names, vectors=taken[best], **(overrides or {}).get(best, {}))
    sweep = decision.fbeta_sweep(scored[best])
    threshold = decision.best_threshold(sweep).first()["threshold"]
    return {
        "metrics": board,
        "best": best,
        "cross_validation": folds,
        "model": fitted[best],
        "threshold": threshold,
        "sweep": sweep,
        "roc_curve": ranking.roc_curve(scored[best]),
        "pr_curve": ranking.pr_curve(scored[best]),
        "confusion": ranking.confusion(scored[best]),
        "cumulative_gain": ranking.cumulative_gain(scored[best]),
        "top_share": ranking.top_share_capture(scored[best]),
        "importance": models.feature_importance(fitted[best]),
        "path": models.save_model(fitted[best], best, os.path.join(folder, "models")),
    }


def publish(spark, folder):
    """The SQL layer: typed table, staging view, cohort mart and its checks."""
    loaded = files.load_typed(
        spark, os.path.join(folder, "credit_data_csv"), "credit_data", os.path.join(folder, "credit_data")
    )
    staged = files.stage_view(loaded)
    mart = marts.cohort_default_rates(staged)
    mart.write.mode("overwrite").option("path", os.path.join(folder, "cohort_default_rates")).saveAsTable(
        "fct_cohort_default_rates"
    )
    return spark.table("fct_cohort_default_rates"), quality.slim_report(staged)
