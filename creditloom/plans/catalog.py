"""The registered queries: every operator over the role views of a test-data folder."""

import hashlib
import os

from pyspark.sql import functions as F

from creditloom import settings as S
from creditloom.functions import bands
from creditloom.functions.scalar import clip, col, flag, ratio, ratio_or, years
from creditloom.operators import (
    categories, decision, features, joins, marts, models, prepare, profile, quality, ranking, sampling, summaries,
)
from creditloom.plans import lending
from creditloom.session import fresh_path, shared_folder, small_table
from creditloom.sources import files, schemas
from creditloom.sources.roles import Roles

SPARSE_TRIAL_PCT = 30
SAMPLE_TRIAL_ROWS = 1000
COMPLETENESS_TRIAL = {
    "application_train": 1200, "bureau": 16_000, "bureau_balance": 70_000, "previous_application": 40_000,
    "POS_CASH_balance": 10_000, "credit_card_balance": 10_000, "installments_payments": 60_000,
}

_data = {}


def data(spark, folder):
    key = (spark.sparkContext.applicationId, folder)
    if key not in _data:
        _data[key] = Data(spark, folder)
    return _data[key]


class Data:
    """Inputs and stage tables of one folder, each built on first use."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.roles = spark, folder, Roles(spark, folder)
        version = hashlib.sha256(folder.encode()).hexdigest()[:12]
        self.stages = os.path.join(
            shared_folder(spark), "creditloom", f"{spark.sparkContext.applicationId}-{version}"
        )
        self._memo = {}

    def _once(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def tables(self):
        r = self.roles
        return {
            "application_train": r.train(), "application_test": r.test(),
            "bureau": r.bureau, "bureau_balance": r.bureau_balance,
            "previous_application": r.previous_application, "POS_CASH_balance": r.pos_cash,
            "credit_card_balance": r.credit_card, "installments_payments": r.installments_payments,
        }

    def applications(self):
        return joins.union_sets(self.roles.train(), self.roles.test())

    def view(self):
        return joins.customer_view(self.applications(), lending.all_summaries(self.tables()))

    def features(self):
        applications = self.applications()
        return lending.customer_features(applications, lending.all_summaries(self.tables()))

    def engineered(self):
        """The engineered view as a stage table: statistics pass over it several times."""
        return self._once(
            "engineered", lambda: files.load_or_compute(self.spark, self.stages, "engineered", self.features)
        )

    def fitted(self):
        return self._once("fitted", lambda: prepare.fit(self.engineered()))

    def prepared(self):
        return self._once("prepared", lambda: files.load_or_compute(
            self.spark, self.stages, "prepared", lambda: prepare.apply(self.engineered(), self.fitted())
        ))

    def train(self):
        return self.prepared().where(F.col(S.SET) == "train")

    def slim(self):
        """Slim columns of the labelled rows straight from the features, missing values included."""
        return lower(files.slim(self.features().where(F.col(S.SET) == "train")))

    def published(self):
        """The slim table after its way through CSV into a typed catalog table."""
        def build():
            csv = fresh_path(self.spark, "slim")
            files.export_slim(self.train(), csv)
            name = f"credit_data_{os.path.basename(csv)[-12:]}"
            return files.load_typed(self.spark, csv, name, fresh_path(self.spark, "credit_data"))
        return self._once("published", build)

    def scored(self):
        return self.roles.scored.withColumn("predicted", flag(F.col("score") >= 0.5))

    def rivals(self):
        second = (F.col(S.CUSTOMER) * 91 % 1000).cast("double") / 1000
        return {
            "score_a": self.scored(),
            "score_b": self.scored().withColumns({"score": second, "predicted": flag(second >= 0.5)}),
        }

    def model_features(self):
        return self.fitted().features()

    def split(self):
        """Training and held-out rows; the cuts between them are looked for once."""
        return self._once("split", lambda: sampling.stratified_split(sampling.slice_sets(self.prepared())[0]))

    def model(self, name):
        return self._once(f"model {name}", lambda: models.fit_model(
            name, self.split()[0], self.model_features()
        ))


def lower(df):
    return df.toDF(*[c.lower() for c in df.columns])


QUERIES = {}


def query(build):
    QUERIES[build.__name__] = lambda spark, folder: build(data(spark, folder))
    return build


# Scans and sinks

@query
def scan_csv(d):
    path = fresh_path(d.spark, "application")
    files.write_csv(d.roles.application, path)
    return files.read_csv(d.spark, path, schemas.APPLICATION)


@query
def scan_parquet(d):
    return files.read_table(d.spark, f"{d.folder}/customer.parquet")


@query
def sink_parquet(d):
    return files.write_table(d.roles.bureau, fresh_path(d.spark, "bureau"))


@query
def sink_bucketed(d):
    tables = d.tables()
    parts = []
    for name in ("previous", "instalments"):
        path = fresh_path(d.spark, name)
        parts.append(files.write_bucketed(
            lending.SUMMARIES[name](tables), f"{name}_{os.path.basename(path)[-12:]}", path, buckets=8
        ))
    return parts[0].join(parts[1], S.CUSTOMER, "left").select(
        S.CUSTOMER, "prev_num_applications", "inst_num_records", "inst_late_rate"
    )


@query
def checkpoint_agg(d):
    folder = fresh_path(d.spark, "stages")
    build = lambda: summaries.summarise_instalments(d.roles.installments_payments)
    files.load_or_compute(d.spark, folder, "instalments", build)
    return files.load_or_compute(d.spark, folder, "instalments", build)


@query
def export_slim(d):
    path = fresh_path(d.spark, "slim")
    files.export_slim(d.train(), path)
    raw = d.spark.read.csv(path, header=True)
    return raw.select([col(c).cast("double").alias(c) for c in raw.columns])


@query
def export_full(d):
    path = fresh_path(d.spark, "enriched")
    files.export_full(d.train(), path, drop=("SET",))
    raw = d.spark.read.csv(path, header=True)
    return raw.select([col(c).cast("double").alias(c) for c in raw.columns])


@query
def metrics_table(d):
    path = fresh_path(d.spark, "model_results")
    files.write_csv(models.evaluate(d.rivals()), path)
    raw = d.spark.read.csv(path, header=True)
    return raw.select("model", *[col(c).cast("double").alias(c) for c in raw.columns if c != "model"])


@query
def load_typed(d):
    return d.published()


@query
def staging_view(d):
    return files.stage_view(d.published())


@query
def model_roundtrip(d):
    path = models.save_model(d.model("logistic"), "logistic", os.path.join(d.stages, "models"))
    held_out = d.split()[1]
    before = models.score_rows(d.model("logistic"), held_out)
    after = models.score_rows(models.load_model(path), held_out).select(S.CUSTOMER, F.col("score").alias("again"))
    return before.join(after, S.CUSTOMER).select(S.CUSTOMER, (F.col("score") == F.col("again")).alias("same"))


# Projections and scalar expressions

@query
def project_slim(d):
    # straight from the features: the summaries then carry the slim columns alone, and no stage is written
    return files.slim(d.features().where(F.col(S.SET) == "train"))


@query
def tag_union(d):
    return d.applications().select(S.CUSTOMER, S.SET, S.LABEL)


@query
def filter_eq(d):
    return d.applications().where((F.col(S.SET) == "train") & (F.col(S.LABEL) == 1)).select(S.CUSTOMER, S.SET)


@query
def filter_notnull(d):
    return d.applications().where(F.col(S.LABEL).isNotNull()).select(S.CUSTOMER, S.LABEL)


@query
def drop_columns(d):
    return d.engineered().drop(*S.NOT_FEATURES)


@query
def sentinel_null(d):
    return summaries.without_sentinels(d.roles.previous_application)


@query
def missing_flag(d):
    return features.cleaned_days(d.roles.application, ["DAYS_EMPLOYED"]).select(S.CUSTOMER, "DAYS_EMPLOYED_FLAG")


@query
def indicator_flags(d):
    status = F.col("NAME_CONTRACT_STATUS")
    return d.roles.pos_cash.select(
        S.LOAN,
        flag(status == "Completed").alias("is_completed"),
        flag(status == "Active").alias("is_active"),
        flag(F.col("SK_DPD") > 0).alias("has_dpd"),
        flag(F.col("CNT_INSTALMENT_FUTURE") < 5).alias("ends_soon"),
    )


@query
def isin_flag(d):
    return d.roles.bureau_balance.select(
        S.CREDIT, "MONTHS_BALANCE", summaries.is_late_status(F.col("STATUS")).alias("is_bad")
    )


@query
def abs_days(d):
    applications = d.roles.application
    return features.cleaned_days(applications, applications.columns).select(
        S.CUSTOMER, "DAYS_BIRTH", "DAYS_EMPLOYED"
    )


@query
def diff_cols(d):
    return summaries.with_payment_measures(d.roles.installments_payments).select(
        S.CUSTOMER, S.LOAN, "DAYS_LATE", "PAYMENT_DIFF",
        flag(F.col("PAID_LATE")).alias("PAID_LATE"), flag(F.col("PAID_EARLY")).alias("PAID_EARLY"),
    )


@query
def ratio_null(d):
    return d.roles.installments_payments.select(
        S.CUSTOMER, S.LOAN, ratio(F.col("AMT_PAYMENT"), F.col("AMT_INSTALMENT")).alias("PAYMENT_RATIO")
    )


@query
def ratio_fill(d):
    income, credit = F.col("AMT_INCOME_TOTAL"), F.col("AMT_CREDIT")
    return d.roles.application.select(
        S.CUSTOMER,
        ratio_or(income, credit).alias("income_credit_ratio"),
        ratio_or(F.col("AMT_ANNUITY"), credit, -1).alias("annuity_credit_ratio"),
    )


@query
def years_columns(d):
    return d.roles.application.select(S.CUSTOMER, years(F.col("DAYS_BIRTH")).alias("age_years"))


QUERIES["years"] = QUERIES.pop("years_columns")


@query
def fill_const(d):
    return d.roles.application.select(
        S.CUSTOMER, F.coalesce(F.col("CNT_FAM_MEMBERS"), F.lit(1.0)).alias("CNT_FAM_MEMBERS")
    )


@query
def bin_left(d):
    return d.roles.application.select(
        S.CUSTOMER,
        bands.income_group(F.col("AMT_INCOME_TOTAL")).alias("income_group"),
        bands.loan_size(F.col("AMT_CREDIT")).alias("loan_size"),
    )


@query
def bin_right(d):
    applications = d.roles.application
    df = features.with_ratios(features.cleaned_days(applications, applications.columns))
    return df.select(
        S.CUSTOMER,
        bands.age_group(F.col("age_years")).alias("age_group"),
        bands.employment_group(F.col("employment_age_ratio")).alias("employment_group"),
        bands.risk_level(F.col("income_credit_ratio")).alias("risk_level"),
    )


@query
def case_bands(d):
    applications = d.roles.application
    df = features.with_ratios(features.cleaned_days(applications, applications.columns))
    return df.select(
        S.CUSTOMER,
        bands.mart_age_band(F.col("DAYS_BIRTH")).alias("age_band"),
        bands.mart_employment_band(F.col("employment_age_ratio")).alias("employment_band"),
    )


@query
def clip_columns(d):
    return d.roles.application.select(
        S.CUSTOMER,
        clip(F.col("AMT_INCOME_TOTAL"), 50_000.0, 200_000.0).alias("AMT_INCOME_TOTAL"),
        clip(F.col("AMT_ANNUITY"), 5_000.0, 40_000.0).alias("AMT_ANNUITY"),
    )


QUERIES["clip"] = QUERIES.pop("clip_columns")


@query
def cast_label(d):
    return sampling.slice_sets(d.applications())[0].select(S.CUSTOMER, S.LABEL)


@query
def compact_types(d):
    plan = prepare.compact_types(d.roles.application)
    return small_table(d.spark, plan, "column_name string, from_type string, to_type string")


@query
def round_modes(d):
    eighths = (F.col(S.CUSTOMER) % 1000).cast("double") / 8
    return d.roles.application.select(
        S.CUSTOMER, F.bround(eighths, 2).alias("half_even"), F.round(eighths, 2).alias("half_up")
    )


@query
def features_full(d):
    return d.features()


# Joins

@query
def join_child_summary(d):
    return summaries.with_balance(d.roles.bureau, d.roles.bureau_balance)


@query
def customer_360(d):
    return d.view()


@query
def join_guard(d):
    tables = {"application": d.applications()}
    tables.update({name: build(d.tables()) for name, build in lending.SUMMARIES.items()})
    profiles = [joins.key_profile(df, name) for name, df in tables.items()]
    union = profiles[0]
    for one in profiles[1:]:
        union = union.unionByName(one)
    return union


# Aggregations

@query
def agg_bureau_balance(d):
    return summaries.summarise_balance(d.roles.bureau_balance)


@query
def agg_bureau(d):
    return summaries.summarise_bureau(d.roles.bureau, d.roles.bureau_balance)


@query
def agg_previous(d):
    return summaries.summarise_previous(d.roles.previous_application)


@query
def agg_pos(d):
    return summaries.summarise_pos(d.roles.pos_cash)


@query
def agg_card(d):
    return summaries.summarise_card(d.roles.credit_card)


@query
def agg_installments(d):
    return summaries.summarise_instalments(d.roles.installments_payments)


@query
def count_if(d):
    status = F.col("NAME_CONTRACT_STATUS")
    return d.roles.pos_cash.where(F.col(S.CUSTOMER).isNotNull()).groupBy(S.CUSTOMER).agg(
        F.count_if(status == "Completed").alias("completed"), F.count_if(status == "Active").alias("active")
    )


@query
def rate_by_age(d):
    return profile.rate_by_age(profile.exploration_segments(d.train()))


@query
def rate_by_employment(d):
    return profile.rate_by_employment(profile.exploration_segments(d.train()))


@query
def rate_by_income(d):
    return profile.rate_by_income(profile.exploration_segments(d.train()))


@query
def cohort_default_rates(d):
    return marts.cohort_default_rates(d.slim())


@query
def cohort_default_rates_published(d):
    return marts.cohort_default_rates(files.stage_view(d.published()))


@query
def pivot_age_employment(d):
    return profile.rate_grid(profile.exploration_segments(d.train()))


@query
def set_profile(d):
    return profile.set_profile(d.applications())


@query
def filtered_counts(d):
    return quality.quirk_counts(d.slim())


@query
def missing_profile(d):
    return profile.missing_profile(d.engineered())


@query
def nunique(d):
    return profile.distinct_counts(d.roles.application)


@query
def medians(d):
    df = d.engineered()
    names = profile.numeric_columns(df, without=[S.CUSTOMER, S.LABEL])
    return profile.quantile_report(df, names, [0.5]).select("column_name", F.col("value").alias("median_value"))


@query
def quantiles(d):
    return profile.quantile_report(d.engineered(), S.CAPPED + S.BEHAVIOURAL, [0.01, 0.99])


@query
def top_correlations(d):
    df = d.train()
    names = profile.numeric_columns(df, without=[S.CUSTOMER, S.LABEL])
    return profile.top_correlations(df, names).select(
        "feature", F.round("abs_correlation", 6).alias("abs_correlation")
    )


@query
def class_histogram(d):
    return profile.class_histogram(d.train())


@query
def class_weights(d):
    return profile.class_weights(d.train())


@query
def minmax(d):
    return profile.minmax(d.engineered(), S.BEHAVIOURAL)


# Ranking, curves, thresholds

@query
def cumulative_gain(d):
    return ranking.cumulative_gain(d.scored())


@query
def sort_desc(d):
    return d.scored().orderBy(F.desc("score"), S.CUSTOMER)


@query
def top_k(d):
    return d.scored().orderBy(F.desc("score"), S.CUSTOMER).limit(S.TOP_IMPORTANCES)


@query
def fbeta_sweep(d):
    return decision.fbeta_sweep(d.scored())


@query
def best_threshold(d):
    return decision.best_threshold(decision.fbeta_sweep(d.scored()))


@query
def roc_auc(d):
    return ranking.roc_auc(d.scored())


@query
def avg_precision(d):
    return ranking.avg_precision(d.scored())


@query
def class_report(d):
    return ranking.class_report(d.scored())


@query
def roc_curve(d):
    return ranking.roc_curve(d.scored())


@query
def pr_curve(d):
    return ranking.pr_curve(d.scored())


@query
def confusion(d):
    return ranking.confusion(d.scored())


@query
def top20_capture(d):
    return ranking.top_share_capture(d.scored())


@query
def leaderboard(d):
    return models.leaderboard(models.evaluate(d.rivals())).limit(1)


# Set operations

@query
def union_by_name(d):
    return d.applications()


@query
def union_all(d):
    train = d.applications().select(S.CUSTOMER, S.LABEL, "AMT_CREDIT")
    return train.where(F.col(S.LABEL) == 0).union(train.where(F.col(S.LABEL) == 1))


# Matrix preparation and sampling

@query
def encode_binary(d):
    fitted = prepare.fit_encoding(d.applications())
    fitted.numeric, fitted.one_hot = [], {}
    return prepare.encode(d.applications(), fitted, keep=[S.CUSTOMER])


@query
def encode_onehot(d):
    fitted = prepare.fit_encoding(d.applications())
    fitted.numeric, fitted.binary = [], {}
    return prepare.encode(d.applications(), fitted, keep=[S.CUSTOMER])


def amounts_as_text(d):
    """Two text columns, one of few values and one of very many."""
    amount = F.floor("AMT_CREDIT").cast("string")
    return d.applications().select(S.CUSTOMER, "NAME_SEGMENT", amount.alias("CREDIT_TEXT"))


def text_categories(d):
    return d._once("categories", lambda: categories.fit_categories(
        amounts_as_text(d), ["NAME_SEGMENT", "CREDIT_TEXT"], fresh_path(d.spark, "categories")
    ))


@query
def category_table(d):
    return text_categories(d).table


@query
def encode_sparse(d):
    path = fresh_path(d.spark, "flagged")
    categories.flag_vectors(amounts_as_text(d), text_categories(d), path)
    # read without the vector's type, so that SQL expressions reach its parts
    stored = d.spark.read.parquet(os.path.join(path, "flagged"))
    return stored.select(
        S.CUSTOMER, F.col("flags.size").alias("width"),
        F.array_join(F.col("flags.indices").cast("array<string>"), ",").alias("positions"),
        F.aggregate(F.col("flags.values"), F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@query
def compact_table(d):
    """The table in its narrowest types, stored and read back; shown in its first types."""
    first = dict(d.roles.application.dtypes)
    stored = files.write_table(prepare.compact(d.roles.application), fresh_path(d.spark, "compact"))
    return stored.select([F.bround(col(c).cast(first[c]), 2).alias(c) if first[c] == "double" else col(c).cast(first[c]).alias(c)
                          for c in stored.columns])


@query
def drop_sparse(d):
    df = d.engineered()
    fitted = prepare.fit(df, limit_pct=SPARSE_TRIAL_PCT)
    return prepare.drop_sparse(prepare.encode(df, fitted, keep=[S.CUSTOMER]), fitted)


@query
def impute_median(d):
    fitted = d.fitted()
    df = prepare.drop_sparse(prepare.encode(d.engineered(), fitted, keep=[S.CUSTOMER]), fitted)
    # a column without missing values keeps its whole-number type; show all alike
    numbers = set(fitted.numeric)
    filled = prepare.impute(df, fitted)
    return filled.select([col(c).cast("double").alias(c) if c in numbers else col(c) for c in filled.columns])


@query
def winsorise(d):
    return d.prepared().select(S.CUSTOMER, *S.CAPPED)


@query
def slice_sets(d):
    train, test = sampling.slice_sets(d.applications())
    return train.select(S.CUSTOMER, S.LABEL, F.lit("train").alias("slice")).unionByName(
        test.select(S.CUSTOMER, F.lit("test").alias("slice")), allowMissingColumns=True
    )


@query
def stratified_split(d):
    train, held_out = sampling.stratified_split(d.roles.train())
    keys = [S.CUSTOMER, S.LABEL]
    return train.select(*keys, F.lit("train").alias("part")).unionByName(
        held_out.select(*keys, F.lit("held_out").alias("part"))
    )


@query
def stratified_split_shares(d):
    held_out = sampling.split_column(d.roles.train())
    return d.roles.train().groupBy(S.LABEL).agg(
        F.count("*").alias("n"), F.count_if(held_out).alias("held_out")
    )


@query
def sample_n(d):
    return sampling.sample_rows(d.roles.application, SAMPLE_TRIAL_ROWS).select(S.CUSTOMER)


@query
def sample_n_size(d):
    sample = sampling.sample_rows(d.roles.application, SAMPLE_TRIAL_ROWS)
    return sample.agg(F.count("*").alias("n"), F.count_distinct(S.CUSTOMER).alias("distinct_keys"))


# Models

def _trained(d, name):
    # scores are written once: every metric reads them
    scored = files.write_table(
        models.score_rows(d.model(name), d.split()[1], label=S.LABEL), fresh_path(d.spark, f"scored_{name}")
    )
    return models.evaluate({name: scored})


@query
def train_logistic(d):
    return _trained(d, "logistic")


@query
def train_forest(d):
    return _trained(d, "forest")


@query
def train_boosted_a(d):
    return _trained(d, "boosted_a")


@query
def train_boosted_b(d):
    return _trained(d, "boosted_b")


@query
def boosted_rounds(d):
    # what holds of any right fit, so that it can be compared: every round lowers the loss, no tree passes its limits
    model = d.model("boosted_b")
    last = model.stages[-1]
    rows, _, _ = models.weighted(d.split()[0], kind=models.LEARNERS["boosted_b"]["weights"])
    losses = last.staged_loss(model.transform(rows.select(S.LABEL, models.WEIGHT, *[col(c) for c in d.model_features()])))
    earlier = losses.select((F.col("round") + 1).alias("round"), F.col("loss").alias("before"))
    leaves = last.node_table(d.spark).where("feature < 0").groupBy((F.col("tree") + 1).cast("bigint").alias("round")).agg(
        ((F.count("*") <= 63) & (F.max("node") < 2**8)).alias("within")
    )
    return losses.join(earlier, "round", "left").join(leaves, "round").select(
        "round", (F.col("loss") <= F.coalesce("before", "loss") + 1e-12).alias("falls"), "within"
    )


@query
def score_batch(d):
    # what holds of any right scores, so that it can be compared: a probability, and the class it implies
    scores = models.score_rows(d.model("logistic"), d.prepared().where(F.col(S.SET) == "test"))
    return scores.select(
        S.CUSTOMER, F.col("score").between(0, 1).alias("in_range"),
        (F.col("predicted") == (F.col("score") > 0.5).cast("int")).alias("agrees"),
    )


@query
def cross_validate(d):
    return models.cross_validate("logistic", d.split()[0], d.model_features())


@query
def feature_importance(d):
    return models.feature_importance(d.model("forest"))


# Data-quality checks

@query
def dq_accepted_values(d):
    return quality.accepted_values(d.slim())


@query
def dq_not_null(d):
    return quality.not_null(d.slim(), ("amt_income_total", "amt_credit", "days_birth", "days_employed"))


@query
def dq_age_range(d):
    return quality.age_range(d.slim())


@query
def dq_row_count(d):
    return quality.row_count(d.slim())


@query
def dq_rate_band(d):
    return quality.rate_band(d.slim())


@query
def dq_quirks(d):
    return quality.quirks(d.slim())


@query
def dq_completeness(d):
    return quality.completeness(d.tables(), COMPLETENESS_TRIAL)


@query
def dq_no_nulls(d):
    return prepare.remaining_nulls(d.prepared(), d.fitted().features())


@query
def dq_report(d):
    return quality.slim_report(d.slim())
