"""One query per operator, over tables derived from the test data."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import fixtures
from riskloom.config import QualityGates, TrainingConfig
from riskloom.functions.codes import icd9_category
from riskloom.functions.scoring import decision, risk_tier, round_score
from riskloom.operators import (
    attribution, cleaning, counts, drift, encoding, fairness, features, lookups, profiling,
    scores, splits, vocabulary as vocabularies,
)
from riskloom.plans import evaluation, models, scoring, training
from riskloom.schema import (
    ADMISSION_SOURCE_GROUPS, CATEGORICAL_FEATURES, COUNT_COLUMNS, MEDICATIONS, NUMERIC_FEATURES, RAW_COLUMNS,
    TARGET,
)
from riskloom.session import scratch_path, settle, stored, tune
from riskloom.sources import artifacts, checks as row_checks, tables
from riskloom.streaming import scoring as streaming

KEY = "encounter_id"
CUT = 0.12
# Fixed linear model of the contribution queries: feature, coefficient, background mean.
LINEAR = tuple(
    (name, ((7 * i) % 11 - 5) / 50, float((3 * i) % 7)) for i, name in enumerate(NUMERIC_FEATURES)
)


class Inputs:
    """Derived tables a query starts from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def raw(self) -> DataFrame:
        return fixtures.raw_encounters(self.spark, self.sf_dir)

    def encounters(self) -> DataFrame:
        return fixtures.encounters(self.spark, self.sf_dir)

    def model_rows(self) -> DataFrame:
        return training.prepare(self.encounters())

    def scored(self) -> DataFrame:
        return fixtures.scored_from(self.encounters())

    def two_scores(self) -> DataFrame:
        return fixtures.two_scores_from(self.encounters())

    def two_models(self) -> DataFrame:
        return self.two_scores().unpivot([KEY, "y"], ["first", "second"], "model", "p")

    def sides(self) -> tuple[DataFrame, DataFrame]:
        """Reference and current rows, stored first as real snapshots are."""
        return fixtures.sides_of(settle(fixtures.numeric_rows(self.encounters())))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of decimals, so engines can be compared."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    @wraps(function)
    def run(inputs: Inputs) -> DataFrame:
        return rounded(function(inputs))

    QUERIES[function.__name__] = run
    return run


# ---- sources ----------------------------------------------------------------

@query
def csv_scan(t):
    """Raw encounters written as a marked-up CSV file and read back typed."""
    raw = t.raw()
    marked = [
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("?")).alias(c) for c in raw.columns
    ]
    path = scratch_path(t.spark, "raw-csv")
    tables.write_csv(raw.select(*marked), path)
    return tables.load_raw_data(t.spark, path, RAW_COLUMNS)


@query
def scored_csv_sink(t):
    """Scored rows through the CSV sink and back through the typed scan."""
    path = scratch_path(t.spark, "scored-csv")
    s = t.scored().select(KEY, round_score(F.col("p")).alias("risk_score"), risk_tier(F.col("p")).alias("risk_tier"))
    tables.write_csv(s, path)
    return t.spark.read.schema(s.schema).option("header", True).csv(path)


@query
def preview_rows(t):
    return tables.preview(t.encounters(), KEY, 10).select(
        KEY, "patient_nbr", "race", "gender", "age", "diag_1", "readmitted"
    )


@query
def score_requests_scan(t):
    """Model rows written as a request file, scanned with the contract's types."""
    path = scratch_path(t.spark, "requests")
    tables.write_csv(t.model_rows().select(KEY, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES), path)
    requests = tables.load_score_requests(t.spark, path)
    return requests.select(
        F.col(KEY).cast("bigint").alias(KEY), "age_ordinal", "num_lab_procedures",
        "lab_procedure_intensity", "race", "admission_type_id",
    )


@query
def reference_snapshot(t):
    """Raw numeric features of the reference rows, written and read back."""
    path = scratch_path(t.spark, "reference")
    reference, _ = t.sides()
    artifacts.save_reference(reference, [KEY, *NUMERIC_FEATURES], path)
    return artifacts.load_reference(t.spark, path)


# ---- projections and rows ----------------------------------------------------

@query
def drop_low_signal_columns(t):
    return cleaning.drop_columns(t.encounters(), ["patient_nbr", "weight", "payer_code", "not_there", *MEDICATIONS])


@query
def clean_encounters(t):
    return cleaning.clean_data(t.encounters().drop(*MEDICATIONS), keep=[KEY])


@query
def contract_fill(t):
    return cleaning.fill_contract(
        t.model_rows().drop("race", "num_procedures", "change_flag"), keep=[KEY]
    )


@query
def contract_errors(t):
    checked = row_checks.apply_contract(t.model_rows().drop("change_flag"))
    return checked.select(
        KEY, F.concat_ws(",", "errors").alias("errors"), (F.size("errors") == 0).alias("valid"),
        "change_flag",
    )


@query
def quarantine_counts(t):
    _, bad = row_checks.split_valid(t.model_rows())
    return bad.select(F.explode("errors").alias("error")).groupBy("error").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def required_columns(t):
    """Rows of a table that has every required column."""
    return row_checks.validate_data(t.encounters()).select(KEY, "race")


@query
def batch_size_rule(t):
    return row_checks.require_rows(t.model_rows()).select(KEY, TARGET)


@query
def selected_columns(t):
    return cleaning.select_model_columns(t.model_rows().withColumn("other", F.lit(1)), [KEY, TARGET])


@query
def stored_report(t):
    """Metrics through the stored JSON report and back."""
    path = scratch_path(t.spark, "report")
    metrics = scores.compute_metrics(t.scored(), CUT).first().asDict()
    artifacts.save_metrics_report(t.spark, path, metrics, CUT)
    body = artifacts.load_metrics_report(t.spark, path)["metrics"]
    return t.spark.createDataFrame(sorted(body.items()), "metric string, value double")


@query
def stored_threshold(t):
    """The chosen cut through the threshold record and back."""
    path = scratch_path(t.spark, "threshold")
    cut = scores.find_optimal_threshold(t.scored()).first()["threshold"]
    artifacts.save_threshold(t.spark, path, cut, 0.7, "check")
    return t.spark.createDataFrame([(artifacts.load_threshold(t.spark, path),)], "threshold double")


@query
def nonnull_feature_counts(t):
    return (
        counts.numeric_counts(t.model_rows(), NUMERIC_FEATURES)
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_values"))
    )


@query
def first_encounters(t):
    return cleaning.deduplicate_patients(t.encounters()).select(KEY, "patient_nbr", "readmitted")


# ---- lookups and joins --------------------------------------------------------

@query
def code_group_lookup(t):
    dim = lookups.code_group_dim(t.spark, ADMISSION_SOURCE_GROUPS)
    e = t.encounters().select(KEY, "admission_source_id")
    return lookups.lookup_join(e, dim, "admission_source_id", "grp", "source_group", "Other")


@query
def icd_range_join(t):
    e = t.encounters().select(KEY, "diag_1")
    joined = lookups.icd_category_join(e, "diag_1", "by_join")
    return joined.withColumn("by_case", F.expr(icd9_category("diag_1")))


@query
def aligned_predictions(t):
    s = t.scored()
    predictions = s.select(KEY, "y", decision(F.col("p"), CUT).alias("yhat"))
    return fairness.align_by_key(predictions, t.encounters().select(KEY, "gender", "race"), KEY)


@query
def paired_value_counts(t):
    return drift.paired_counts(*t.sides())


# ---- features -----------------------------------------------------------------

@query
def diagnosis_features(t):
    e = t.encounters().select(KEY, "diag_1", "diag_2", "diag_3")
    return features.engineer_diagnosis_features(e)


@query
def medication_features(t):
    return features.engineer_medication_features(
        t.encounters().select(KEY, *[F.col(f"`{m}`") for m in MEDICATIONS])
    )


@query
def utilization_features(t):
    e = t.encounters().select(KEY, *features.VISIT_COLUMNS)
    return features.engineer_utilization_features(features.engineer_visit_decomposition(e))


@query
def age_feature(t):
    return features.engineer_age_ordinal(t.encounters().select(KEY, "age"))


@query
def intensity_features(t):
    made = features.engineer_medication_features(t.encounters())
    return features.engineer_intensity_features(made).select(
        KEY, "lab_procedure_intensity", "procedure_intensity", "medication_intensity",
        "diagnosis_complexity", "med_change_ratio",
    )


@query
def clinical_flags(t):
    return features.engineer_clinical_flags(t.encounters().select(KEY, "A1Cresult", "diabetesMed", "change"))


@query
def disposition_features(t):
    return features.engineer_disposition_features(
        t.encounters().select(KEY, "discharge_disposition_id", "admission_source_id")
    )


@query
def feature_chain(t):
    return t.model_rows().select(KEY, TARGET, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES)


@query
def risk_tiers(t):
    return t.scored().select(
        KEY, risk_tier(F.col("p")).alias("risk_tier"), decision(F.col("p"), CUT).alias("readmitted"),
        round_score(F.col("p")).alias("risk_score"),
    )


@query
def run_fingerprint(t):
    size = t.model_rows().agg(F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("pos"))
    body = size.select(
        F.to_json(F.struct(F.col("n").alias("n_train_samples"), F.col("pos").alias("positives"))).alias("body")
    )
    return training.fingerprint_of(body)


@query
def readmission_by_diagnosis(t):
    """Flagship: 30-day rate per primary diagnosis group over first encounters."""
    return _rates(t.model_rows())


def _rates(rows: DataFrame) -> DataFrame:
    return rows.groupBy("diag1_category").agg(
        F.count(F.lit(1)).alias("encounters"),
        F.sum(F.col(TARGET).cast("bigint")).alias("readmitted_30d"),
        (F.avg(TARGET) * 100).alias("rate_pct"),
    )


# ---- preparation ----------------------------------------------------------------

@query
def medians(t):
    return encoding.median_table(t.model_rows(), NUMERIC_FEATURES)


@query
def scaling(t):
    return encoding.scaling_table(t.model_rows(), NUMERIC_FEATURES)


@query
def modes(t):
    return encoding.mode_table(t.model_rows(), CATEGORICAL_FEATURES)


@query
def vocabulary(t):
    return encoding.level_table(t.model_rows(), CATEGORICAL_FEATURES)


@query
def one_hot_long(t):
    """Vocabulary table of training rows, categories of all rows in long form."""
    rows = splits.assign_splits(settle(t.model_rows()), KEY)
    encoder = vocabularies.fit(rows.filter("split = 'train'"), [], CATEGORICAL_FEATURES)
    return vocabularies.long_entries(encoder, rows, KEY).select(
        KEY, "feature", F.col("value").cast("int").alias("value")
    )


@query
def scaled_long(t):
    """All scaled columns of the fitted encoder in long form."""
    rows = settle(t.model_rows())
    encoder = encoding.TabularEncoder(NUMERIC_FEATURES, []).fit(rows)
    return encoding.long_features(
        encoding.encode(encoder, rows, [KEY]), encoding.feature_names(encoder), KEY
    )


@query
def feature_name_table(t):
    rows = settle(t.model_rows())
    return vocabularies.fit(rows).names


# ---- windows and order ------------------------------------------------------------

@query
def cumulative_counts(t):
    return scores.cumulative_counts(scores.score_counts(t.scored()))


@query
def best_model_by_score(t):
    table = scores.average_precision(t.two_models(), group=["model"])
    order = F.when(F.col("model") == "first", 0).otherwise(1)
    return scores.best_model(table.select("model", F.col("pr_auc").alias("score"), order.alias("position")))


# ---- profiling ---------------------------------------------------------------------

@query
def null_report(t):
    return profiling.null_report(t.encounters())


@query
def describe(t):
    return profiling.describe(t.encounters(), COUNT_COLUMNS)


@query
def value_counts(t):
    return profiling.value_counts(t.encounters(), "insulin")


@query
def value_shares(t):
    return profiling.value_shares(t.encounters(), ["readmitted", "race", "gender"])


@query
def group_rates(t):
    e = cleaning.clean_data(t.encounters())
    return profiling.group_rates(e, ["race", "gender", "age"], TARGET)


@query
def histogram(t):
    return profiling.histogram(t.encounters(), COUNT_COLUMNS, 30)


@query
def event_value_histogram(t):
    return profiling.histogram(t.table("events"), ["value"], 15)


@query
def correlations(t):
    return profiling.correlations(t.encounters(), COUNT_COLUMNS)


@query
def fold_metrics(t):
    return _fold_metrics(t)


def _fold_metrics(t: Inputs) -> DataFrame:
    folded = splits.assign_folds(settle(t.two_scores()), KEY, "y", 5)
    pooled = folded.unpivot([KEY, "y", "fold"], ["first", "second"], "model", "p")
    return scores.compute_metrics(pooled, group=["model", "fold"]).select("model", "fold", "roc_auc", "pr_auc")


@query
def fold_summary(t):
    return profiling.fold_summary(_fold_metrics(t), ["roc_auc", "pr_auc"])


@query
def fold_pivot(t):
    return profiling.fold_pivot(_fold_metrics(t), ["first", "second"], "pr_auc")


@query
def tier_counts(t):
    return profiling.tier_counts(t.scored())


@query
def age_distribution(t):
    return profiling.value_counts(t.model_rows(), "age_ordinal").orderBy("value")


@query
def class_balance(t):
    return profiling.class_balance(t.scored())


# ---- evaluation ----------------------------------------------------------------------

@query
def roc_auc(t):
    return scores.roc_auc(t.scored())


@query
def average_precision(t):
    return scores.average_precision(t.scored())


@query
def cut_metrics(t):
    return scores.precision_recall_f1(t.scored(), CUT)


@query
def brier_score(t):
    return scores.brier_score(t.scored())


@query
def all_metrics(t):
    return scores.tall_metrics(scores.compute_metrics(t.scored(), CUT))


@query
def threshold_table(t):
    return scores.threshold_table(t.scored())


@query
def optimal_threshold(t):
    return scores.find_optimal_threshold(t.scored())


@query
def highest_score_with_recall(t):
    return scores.highest_score_with_recall(t.scored())


@query
def confusion_matrix(t):
    return scores.confusion_matrix(t.scored(), CUT)


@query
def calibration_curve(t):
    return scores.calibration_curve(t.scored())


@query
def roc_points(t):
    return scores.roc_points(t.scored())


@query
def pr_points(t):
    return scores.pr_points(t.scored())


@query
def quality_gates(t):
    strict = QualityGates(min_pr_auc=0.9, min_recall=0.70, max_brier_score=0.1)
    return fairness.quality_gate_violations(scores.compute_metrics(t.scored(), CUT), strict)


def _flagged(t: Inputs) -> DataFrame:
    return t.scored().withColumn("yhat", decision(F.col("p"), CUT))


@query
def subgroup_recall(t):
    return fairness.subgroup_recalls(_flagged(t), ["gender"])


@query
def fairness_report(t):
    return fairness.fairness_report(_flagged(t), ["gender", "race", "age_ordinal", "admission_type_id", "absent"])


@query
def gap_gates(t):
    gaps = fairness.recall_gaps(
        fairness.subgroup_recalls(_flagged(t), ["gender", "race", "age_ordinal", "admission_type_id"])
    )
    return fairness.gap_violations(gaps, QualityGates(subgroup_max_recall_gap=0.02))


@query
def document_fairness(t):
    """Recall of a quality flag for toxic documents, by language and source."""
    d = t.table("labels").join(t.table("documents").select("doc_id", "lang", "source"), "doc_id")
    return fairness.fairness_report(
        d.select("lang", "source", F.col("toxic").alias("y"), (1 - F.col("quality")).alias("yhat")),
        ["lang", "source"],
    )


@query
def model_comparison(t):
    return scores.model_comparison(t.two_models())


# ---- splits --------------------------------------------------------------------------

@query
def stratified_split(t):
    return splits.assign_splits(settle(t.model_rows().select(KEY, TARGET)), KEY).select(KEY, TARGET, "split")


@query
def train_and_validation_rows(t):
    train, val, _ = splits.split_data(settle(t.model_rows().select(KEY, TARGET, "race")), KEY)
    return splits.concat([train, val])


@query
def stratified_folds(t):
    return splits.assign_folds(settle(t.model_rows().select(KEY, TARGET)), KEY).select(KEY, TARGET, "fold")


@query
def class_weights(t):
    return splits.class_weights(t.model_rows())


# ---- attribution ------------------------------------------------------------------------

def _explained(t: Inputs) -> tuple[DataFrame, list[str]]:
    names = [f for f, _, _ in LINEAR]
    # A feature without a value counts as its mean and contributes nothing.
    values = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(m)) for f, _, m in LINEAR])
    df = attribution.linear_contributions(
        t.model_rows(), values, [c for _, c, _ in LINEAR], [m for _, _, m in LINEAR]
    )
    return df, names


@query
def linear_contributions(t):
    df, names = _explained(t)
    return attribution.long_contributions(df, names, KEY)


@query
def top_reasons(t):
    df, names = _explained(t)
    reasons = df.select(KEY, F.posexplode(attribution.top_reasons(names)).alias("place", "reason"))
    return reasons.select(KEY, "place", "reason.feature", "reason.impact", "reason.direction")


@query
def global_importance(t):
    df, names = _explained(t)
    return attribution.global_importance(df, names)


@query
def top_importance(t):
    df, names = _explained(t)
    return profiling.top_features(attribution.global_importance(df, names), "importance", k=3)


# The drift queries take the limiting p-value for samples of every size, which SQL can state;
# user_value_ks takes the exact one, which SQL states by following all paths.
# ---- drift ---------------------------------------------------------------------------------

@query
def psi(t):
    return drift.compute_psi(*t.sides())


@query
def ks_test(t):
    return drift.compute_ks_tests(*t.sides(), exact_rows=0)


@query
def event_value_ks(t):
    """Drift of event values between clicks and all other events."""
    events = t.table("events").select("event_type", "value")
    click = F.col("event_type") == "click"
    return drift.detect_drift(events.filter(~click), events.filter(click), ["value"], exact_rows=0)


@query
def user_value_ks(t):
    """Exact test, per user, of the values of clicks against those of all other events."""
    events = t.table("events").filter("value IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL")
    click = F.col("event_type") == "click"
    pairs = events.groupBy(F.col("user_id").cast("string").alias("feature"), "value").agg(
        F.count_if(~click).alias("n_ref"), F.count_if(click).alias("n_cur")
    )
    return drift.ks_from_counts(pairs)


@query
def drift_report(t):
    return drift.detect_drift(*t.sides(), exact_rows=0)


@query
def drift_summary(t):
    return drift.drift_summary(drift.detect_drift(*t.sides(), exact_rows=0))


@query
def drift_check(t):
    reference, current = t.sides()
    return drift.drift_check(reference.drop("num_procedures"), current, exact_rows=0)


# ---- models: rows only, values depend on the learner -----------------------------------------

SMALL = TrainingConfig(
    n_trials=2, cv_folds=3, calibration_folds=2, forest_trees=10, forest_depth=4,
    boosted_tree_range=(3, 6), boosted_depth_range=(2, 3),
)
LOGISTIC = models.Candidate("logistic_regression", {"max_iter": 50})
FOREST = models.Candidate("random_forest", {"n_estimators": 10, "max_depth": 4})
BOOSTED = models.Candidate(
    "xgboost", {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "scale_pos_weight": 5.0}
)


def _encoded(t: Inputs):
    rows = splits.assign_splits(stored(t.model_rows(), "prepared"), KEY)
    encoder = encoding.TabularEncoder().fit(rows.filter("split = 'train'"))
    encoded = encoding.encode(encoder, rows, [KEY, TARGET, "split"])
    return rows, encoder, stored(encoded, "encoded", "split")


def _parts(encoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    return encoded.filter("split = 'train'"), encoded.filter("split = 'test'")


def _test_metrics(t: Inputs, candidate: models.Candidate) -> DataFrame:
    _, _, encoded = _encoded(t)
    train, test = _parts(encoded)
    scored = models.probability(candidate.fit(train), test)
    return scores.compute_metrics(scored.select(F.col(TARGET).alias("y"), "p"))


@query
def logistic_test_metrics(t):
    return _test_metrics(t, LOGISTIC)


@query
def forest_test_metrics(t):
    return _test_metrics(t, FOREST)


@query
def boosted_test_metrics(t):
    return _test_metrics(t, BOOSTED)


@query
def out_of_fold_scores(t):
    """Every train and validation row, scored once by a model that did not see it."""
    _, _, encoded = _encoded(t)
    pooled = models.out_of_fold(encoded.filter("split <> 'test'"), LOGISTIC.fit, KEY, folds=3)
    return pooled.groupBy(KEY, "y").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.col("p").between(0, 1)).alias("in_range")
    )


@query
def tuning_trials(t):
    _, _, encoded = _encoded(t)
    train, val = encoded.filter("split = 'train'"), encoded.filter("split = 'val'")
    return models.tune("xgboost", train, val, SMALL)[1]


@query
def calibrated_scores(t):
    _, _, encoded = _encoded(t)
    train, test = _parts(encoded)
    model = models.fit_calibrated(train, LOGISTIC, KEY, folds=2)
    return models.probability(model, test).select(KEY, F.col("p").between(0, 1).alias("in_range"))


@query
def evaluation_curves(t):
    """Row totals of the evaluation tables of the test rows."""
    _, _, encoded = _encoded(t)
    train, test = _parts(encoded)
    tables = evaluation.evaluate_model(LOGISTIC.fit(train), test, 0.5)
    return (
        tables["calibration_curve"].agg(F.sum("n").alias("binned"))
        .withColumn("_one", F.lit(1))
        .join(tables["confusion_matrix"].agg(F.sum("n").alias("counted")).withColumn("_one", F.lit(1)), "_one")
        .drop("_one")
    )


@query
def forest_importance(t):
    _, encoder, encoded = _encoded(t)
    model = FOREST.fit(_parts(encoded)[0])
    table = attribution.importance_table(model, encoding.feature_names(encoder), encoded)
    return profiling.top_features(table, "importance")


@query
def tree_contributions(t):
    """For every row: whether expected score plus contributions give its score."""
    _, encoder, encoded = _encoded(t)
    model = BOOSTED.fit(_parts(encoded)[0])
    forest = attribution.read_forest(encoded, model)
    explained = attribution.tree_contributions(model.transform(encoded), forest)
    total = F.aggregate("contributions", F.lit(forest.base), lambda a, v: a + v)
    reasons = attribution.top_reasons(encoding.feature_names(encoder), top_n=1)
    return explained.select(
        KEY,
        (F.abs(2 * vector_to_array("rawPrediction")[1] - total) < 1e-6).alias("additive"),
        F.size(reasons).alias("reasons"),
    )


@query
def training_run(t):
    """The whole training job with one candidate: its run table."""
    out = scratch_path(t.spark, "artifacts")
    config = TrainingConfig(
        models=("logistic_regression",), cv_folds=2, calibration_folds=2, logistic_iterations=20
    )
    training.run_training(t.encounters(), out, config)
    return t.spark.read.parquet(artifacts.current_run(t.spark, out).runs)


def _scorer(t: Inputs) -> tuple[DataFrame, scoring.Scorer]:
    rows, encoder, encoded = _encoded(t)
    train, _ = _parts(encoded)
    model = LOGISTIC.fit(train)
    return rows, scoring.Scorer(
        encoder, model, model, CUT, "check", attribution.feature_means(train)
    )


@query
def batch_scores(t):
    rows, scorer = _scorer(t)
    return _consistent(scorer.predict_batch(rows, [KEY])[0])


def _consistent(scored: DataFrame) -> DataFrame:
    """Whether range, tier, decision and reasons of a row agree with its score."""
    near = F.abs(F.col("risk_score") - CUT) < 1e-4
    return scored.select(
        KEY,
        F.col("risk_score").between(0, 1).alias("in_range"),
        ((F.col("readmitted") == (F.col("risk_score") >= CUT).cast("int")) | near).alias("decided"),
        F.col("risk_tier").isin("Low", "Medium", "High").alias("tiered"),
        F.size("top_reasons").alias("reasons"),
    )


def _reloaded(t: Inputs) -> tuple[DataFrame, scoring.Scorer, scoring.Scorer]:
    """Rows, a scorer, and the same scorer read back from a published run."""
    rows, scorer = _scorer(t)
    out = scratch_path(t.spark, "artifacts")
    run = artifacts.new_run(out)
    scorer.encoder.write().overwrite().save(run.encoder)
    artifacts.save_model(scorer.model, run.model, t.spark)
    artifacts.save_model(scorer.margin_model, run.margin, t.spark)
    artifacts.save_threshold(t.spark, run.threshold, CUT, 0.7, "check")
    extra = {"model_version": scorer.model_version, "background": scorer.background}
    artifacts.save_metrics_report(t.spark, run.report, {"pr_auc": 0.5}, CUT, extra)
    assert not artifacts.artifacts_ready(t.spark, out)
    artifacts.publish_run(t.spark, out, run)
    assert artifacts.artifacts_ready(t.spark, out)
    return rows, scorer, scoring.Scorer.load(t.spark, out)


@query
def reloaded_scores(t):
    """For every valid row: whether a stored and reloaded scorer gives the score it gave before."""
    rows, scorer, loaded = _reloaded(t)
    valid, _ = row_checks.split_valid(rows)
    before, after = (s.score(valid, [KEY], explain=False).select(KEY, F.col("risk_score").alias(n)) for s, n in ((scorer, "a"), (loaded, "b")))
    return before.join(after, KEY).select(KEY, (F.abs(F.col("a") - F.col("b")) < 1e-9).alias("same"))


@query
def model_card(t):
    _, _, loaded = _reloaded(t)
    return loaded.model_card(t.spark).select(
        "model_type", "model_version", "threshold", "n_features", F.size("feature_names").alias("named")
    )


@query
def explained_row(t):
    """The reasons of the encounter with the smallest id, largest first."""
    rows, scorer = _scorer(t)
    encoded = encoding.encode(scorer.encoder, rows, [KEY])
    first = rows.agg(F.min(KEY)).first()[0]
    one = attribution.explain_row(scorer.explain(encoded), KEY, first, scorer.names)
    impacts = F.transform("top_reasons", lambda r: r["impact"])
    return one.select(KEY, F.size("top_reasons").alias("reasons"), (impacts == F.sort_array(impacts, False)).alias("ordered"))


@query
def rejected_requests(t):
    """Invalid rows that batch scoring returns with their errors."""
    rows, scorer = _scorer(t)
    return scorer.predict_batch(rows, [KEY])[1].select(KEY, F.concat_ws(",", "errors").alias("errors"))


@query
def records_scored_with_defaults(t):
    """Model rows as JSON lines, some with fields left out, nulled, misspelled or cut off: all come back."""
    rows, scorer = _scorer(t)
    k = F.col(KEY)
    gone = {"race": 5, "num_procedures": 5, "diag2_category": 5, "gender": 7, "time_in_hospital": 11}
    # Null fields are left out of the text, so what is to be null or wrong is added to it.
    fields = [
        F.when(k % gone[c] != 0, F.col(c)).alias(c) if c in gone else F.col(c)
        for c in (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES)
    ]
    text = F.concat(
        F.rtrim(F.to_json(F.struct(KEY, *fields)), F.lit("}")), F.when(k % 7 == 0, ',"gender":null').otherwise(""),
        F.when(k % 11 == 0, ',"time_in_hospital":"long"').otherwise(""), F.lit("}"),
    )
    path = scratch_path(t.spark, "records")
    rows.select(F.when(k % 13 == 0, F.substring(text, 1, 30)).otherwise(text)).write.text(path)
    kept = {KEY: "bigint", "race": "string", "num_procedures": "double"}
    valid, bad = row_checks.by_errors(stored(tables.load_records(t.spark, path, {KEY: "bigint"}), "records"))
    scored = scorer.score(valid, list(kept))
    near = F.abs(F.col("risk_score") - CUT) < 1e-4
    fits = F.col("risk_score").between(0, 1) & ((F.col("readmitted") == (F.col("risk_score") >= CUT).cast("int")) | near)
    return scored.select(
        *kept, F.lit("").alias("errors"), (fits & (F.size("top_reasons") == 3)).alias("scored")
    ).unionAll(
        bad.select(
            KEY, F.lit(None).cast("string"), F.lit(None).cast("double"), F.concat_ws(",", "errors"), F.lit(False)
        )
    )


@query
def path_contributions(t):
    """For every row: whether expected score plus path contributions give its score; leaves come by join."""
    _, _, encoded = _encoded(t)
    model = BOOSTED.fit(_parts(encoded)[0]).setLeafCol("leaves")
    base = attribution.read_forest(encoded, model).base
    scored = model.transform(encoded)
    summed = attribution.path_contributions(scored, attribution.path_table(encoded, model), KEY).groupBy(KEY).agg(
        F.sum("contribution").alias("total"), F.count("feature").alias("n"), F.count_distinct("feature").alias("own")
    )
    margin = scored.select(KEY, (2 * vector_to_array("rawPrediction")[1]).alias("m"))
    return summed.join(margin, KEY).select(
        KEY, (F.abs(F.col("m") - F.coalesce("total", F.lit(0.0)) - base) < 1e-6).alias("additive"),
        (F.col("n") == F.col("own")).alias("each_feature_once"),
    )


@query
def streamed_scores(t):
    """Valid rows scored as a file stream."""
    rows, scorer = _scorer(t)
    requests = scratch_path(t.spark, "stream-in")
    out = scratch_path(t.spark, "stream-out")
    rows = rows.drop("split", TARGET)
    rows.write.parquet(requests)
    stream = streaming.read_requests(t.spark, requests, rows.schema)
    started = streaming.score_stream(scorer, stream, out, keep=[KEY])
    started.awaitTermination()
    return _consistent(t.spark.read.parquet(out))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: function(Inputs(tune(spark), sf_dir))

    return {name: bind(function) for name, function in QUERIES.items()}
