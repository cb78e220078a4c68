"""Splits, contributions, learners and the training, scoring and streaming jobs."""

import itertools
import json
from dataclasses import replace
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from checks import fixtures
from riskloom.config import QualityGates, TrainingConfig
from riskloom.operators import attribution, profiling, splits
from riskloom.plans import evaluation, models, scoring, training
from riskloom.schema import NUMERIC_FEATURES
from riskloom.session import settle
from riskloom.sources import artifacts
from riskloom.streaming import scoring as streaming

SMALL = TrainingConfig(
    n_trials=1, cv_folds=2, calibration_folds=2, forest_trees=4, forest_depth=3,
    boosted_tree_range=(2, 3), boosted_depth_range=(2, 2), parallel_trials=1,
    models=("logistic_regression", "xgboost"), gates=QualityGates(min_pr_auc=0.99),
)


# ---- splits ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(2_003).selectExpr("id", "int(id % 9 = 0) AS readmitted")


def test_split_shares_and_rates(labelled):
    parts = splits.assign_splits(labelled, "id")
    got = {(r["split"], r["readmitted"]): r["count"] for r in parts.groupBy("split", "readmitted").count().collect()}
    for label, size in ((0, 1780), (1, 223)):
        assert got[("test", label)] == int(np.floor(size * 0.15 + 0.5))
        assert abs(got[("val", label)] - size * 0.15) <= 1
    train, val, test = splits.split_data(labelled, "id")
    assert train.count() + val.count() + test.count() == 2_003
    assert train.join(test, "id").count() == 0 and val.join(test, "id").count() == 0


def test_split_is_repeatable_and_depends_on_the_seed(labelled):
    def ids(seed, df):
        return {r["id"] for r in splits.assign_splits(df, "id", seed=seed).filter("split = 'test'").collect()}

    assert ids(42, labelled) == ids(42, labelled.repartition(7))
    assert ids(42, labelled) != ids(43, labelled)


def test_split_adds_no_shuffle_of_rows(labelled):
    plan = splits.assign_splits(labelled, "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_folds_are_even_and_cover_all(labelled):
    got = splits.assign_folds(labelled, "id", k=5).groupBy("fold", "readmitted").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in got if r["readmitted"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_split_of_tiny_and_null_strata(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "id int, readmitted int")
    out = splits.assign_splits(df, "id").collect()
    assert len(out) == 4 and all(r["split"] in ("train", "val", "test") for r in out)


def test_class_weights(labelled):
    got = {r["label"]: r["weight"] for r in splits.class_weights(labelled).collect()}
    assert np.isclose(got[1], 2003 / (2 * 223)) and np.isclose(got[0], 2003 / (2 * 1780))


def test_hash_sample(labelled):
    a = {r["id"] for r in splits.hash_sample(labelled, "id", 50).collect()}
    assert len(a) == 50 and a == {r["id"] for r in splits.hash_sample(labelled.repartition(5), "id", 50).collect()}


# ---- contributions ----------------------------------------------------------------

def test_top_reasons_order_and_direction(spark):
    df = spark.createDataFrame([([0.1, -0.5, 0.0, 0.5],)], "contributions array<double>")
    reasons = df.select(attribution.top_reasons(["a", "b", "c", "d"], top_n=3).alias("r")).first()["r"]
    assert [(r["feature"], r["impact"], r["direction"]) for r in reasons] == [
        ("b", 0.5, "decreased risk"), ("d", 0.5, "increased risk"), ("a", 0.1, "increased risk"),
    ]
    for n in (1, 5):
        got = df.select(attribution.top_reasons(["a", "b", "c", "d"], top_n=n).alias("r")).first()["r"]
        assert len(got) == min(n, 4)


def test_linear_contributions_add_up(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "x array<double>")
    out = attribution.linear_contributions(df, F.col("x"), [2.0, -1.0], [0.5, 0.5])
    assert out.first()["contributions"] == [1.0, -1.5]


def plain_shapley(predict, row, n):
    """Exponential definition over all feature subsets."""
    phi = np.zeros(n)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            for known in itertools.combinations(others, size):
                w = factorial(size) * factorial(n - size - 1) / factorial(n)
                phi[i] += w * (predict(row, {*known, i}) - predict(row, set(known)))
    return phi


def expected(tree, row, known, node=0):
    """Value of a tree when only ``known`` features are known, by its own cover shares."""
    if tree.left[node] < 0:
        return tree.value[node]
    children = tree.left[node], tree.right[node]
    feature, categories = tree.feature[node], tree.categories[node]
    if feature not in known:
        return sum(tree.share[c] * expected(tree, row, known, c) for c in children)
    left = row[feature] <= tree.threshold[node] if categories is None else row[feature] in categories
    return expected(tree, row, known, children[0] if left else children[1])


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    x[:, 3] = rng.integers(0, 2, 300)
    y = ((x[:, 0] > 0) & (x[:, 1] < 0.5) | (x[:, 3] == 1) & (x[:, 2] > 0.8)).astype(int)
    pdf = pd.DataFrame({"id": range(300), "readmitted": y, "x": x.tolist()})
    df = spark.createDataFrame(pdf).select("id", "readmitted", array_to_vector("x").alias("features"))
    return settle(df)


@pytest.mark.parametrize("name", ["random_forest", "xgboost"])
def test_tree_contributions_equal_the_definition(vectors, name):
    params = {"n_estimators": 4, "max_depth": 4, "scale_pos_weight": 3.0}
    model = models.Candidate(name, params).fit(vectors)
    forest = attribution.read_forest(vectors, model)
    scored = attribution.tree_contributions(model.transform(vectors), forest)
    margin = vector_to_array("probability")[1] if name == "random_forest" else 2 * vector_to_array("rawPrediction")[1]
    rows = scored.select(vector_to_array("features").alias("x"), "contributions", margin.alias("m")).collect()
    for r in rows:
        assert np.isclose(sum(r["contributions"]) + forest.base, r["m"])
    for r in rows[:5]:
        want = sum(plain_shapley(lambda v, k, t=t: expected(t, v, k), r["x"], 4) for t in forest.trees)
        assert np.allclose(r["contributions"], want)


def test_path_weights_equal_the_subset_sum():
    rng = np.random.default_rng(5)
    for d in range(1, 12):
        shares, taken = rng.uniform(0.01, 1, d), rng.integers(0, 2, (d, 6)).astype(float)
        got = attribution.path_weights(shares, taken)
        for p in range(6):
            def pays(_, known):
                return np.prod([taken[j, p] if j in known else shares[j] for j in range(d)])

            if d <= 8:
                assert np.allclose(got[:, p], plain_shapley(pays, None, d))
            assert np.isclose(got[:, p].sum(), np.prod(taken[:, p]) - np.prod(shares))


def test_long_paths_and_small_slices_give_the_same(vectors, monkeypatch):
    model = models.Candidate("random_forest", {"n_estimators": 3, "max_depth": 6}).fit(vectors)
    forest, rows = attribution.read_forest(vectors, model), model.transform(vectors)
    whole = {r["id"]: r["contributions"] for r in attribution.tree_contributions(rows, forest).collect()}
    sliced = {r["id"]: r["contributions"] for r in attribution.tree_contributions(rows, forest, rows=7).collect()}
    assert all(np.allclose(whole[k], sliced[k]) for k in whole)
    phi = {}
    for bits in (12, 0):  # with and without a table of all patterns
        monkeypatch.setattr(attribution, "LONGEST_TABLE_BITS", bits)
        x = np.random.default_rng(1).normal(size=(50, 4))
        phi[bits] = np.zeros((4, 50))
        for tree in forest.trees:
            attribution._explain_tree(x, tree, phi[bits])
    assert np.allclose(phi[12], phi[0])


@pytest.mark.parametrize("name,depth", [("random_forest", 4), ("xgboost", 4), ("xgboost", 1)])
def test_path_contributions_add_up_and_equal_exact_ones_of_stumps(spark, vectors, name, depth):
    params = {"n_estimators": 6, "max_depth": depth, "scale_pos_weight": 3.0}
    model = models.Candidate(name, params).fit(vectors).setLeafCol("leaves")
    forest, rows = attribution.read_forest(vectors, model), model.transform(vectors)
    got = attribution.path_contributions(rows, attribution.path_table(vectors, model), "id")
    sums = {r["id"]: {} for r in rows.select("id").collect()}
    for r in got.collect():
        sums[r["id"]][r["feature"]] = r["contribution"]
    margin = vector_to_array("probability")[1] if name == "random_forest" else 2 * vector_to_array("rawPrediction")[1]
    for r in attribution.tree_contributions(rows, forest).select("id", "contributions", margin.alias("m")).collect():
        assert np.isclose(sum(sums[r["id"]].values()) + forest.base, r["m"])
        if depth == 1:
            assert np.allclose([sums[r["id"]].get(f, 0.0) for f in range(4)], r["contributions"])


def test_importances(vectors):
    model = models.Candidate("random_forest", {"n_estimators": 5, "max_depth": 3}).fit(vectors)
    table = attribution.importance_table(model, list("abcd"), vectors)
    assert np.isclose(table.agg(F.sum("importance")).first()[0], 1.0)
    assert profiling.top_features(table, "importance", k=2).count() == 2


def test_global_importance_and_one_row(spark):
    df = spark.createDataFrame([(1, [1.0, -2.0]), (2, [-3.0, 0.0])], "id int, contributions array<double>")
    got = {r["feature"]: r["importance"] for r in attribution.global_importance(df, ["a", "b"]).collect()}
    assert got == {"a": 2.0, "b": 1.0}
    one = attribution.explain_row(df, "id", 2, ["a", "b"], 1).first()
    assert one["top_reasons"][0]["feature"] == "a"


# ---- learners -----------------------------------------------------------------------

@pytest.mark.parametrize("name", ["logistic_regression", "random_forest", "xgboost", "lightgbm"])
def test_candidates_give_probabilities(vectors, name):
    candidate = models.base_models(SMALL)[name]
    if name in models.BOOSTED:
        candidate = models.Candidate(name, {**candidate.params, "n_estimators": 3})
    scored = models.probability(candidate.fit(vectors), vectors)
    low, high, n = scored.agg(F.min("p"), F.max("p"), F.count("p")).first()
    assert 0 <= low <= high <= 1 and n == 300
    assert "rawPrediction" not in scored.columns


def test_registry():
    assert list(models.base_models(SMALL)) == ["logistic_regression", "random_forest", "xgboost", "lightgbm"]
    assert list(models.configured_models(SMALL)) == ["logistic_regression", "xgboost"]
    with pytest.raises(ValueError):
        models.configured_models(TrainingConfig(models=("other",)))


def test_empty_training_table(vectors):
    with pytest.raises(ValueError):
        models.Candidate("logistic_regression", {}).fit(vectors.limit(0))


def test_out_of_fold_covers_every_row_once(vectors):
    fit = models.Candidate("logistic_regression", {"max_iter": 20}).fit
    pooled = models.out_of_fold(vectors, fit, "id", folds=3)
    assert pooled.count() == 300 and pooled.select("id").distinct().count() == 300
    assert models.fold_metrics(pooled).count() == 3
    prevalence = pooled.agg(F.avg("y")).first()[0]
    assert models.cross_validated_pr_auc(vectors, fit, "id", folds=3) > prevalence
    assert 0.01 <= models.cross_validated_threshold(vectors, fit, "id", 0.5, folds=3) <= 0.99


def test_sigmoid_recovers_a_logistic_curve(spark):
    df = spark.range(20_000).selectExpr("double(id % 41 - 20) / 10 AS v").withColumn(
        "readmitted", (F.rand(7) < 1 / (1 + F.exp(-(1.5 * F.col("v") - 0.5)))).cast("int")
    )
    fitted = models.fit_sigmoid(df, "v")
    assert abs(fitted.slope - 1.5) < 0.1 and abs(fitted.intercept + 0.5) < 0.1


def test_tuning_is_repeatable(vectors):
    config = TrainingConfig(n_trials=2, boosted_tree_range=(2, 3), boosted_depth_range=(2, 2))
    a, trials = models.tune("xgboost", vectors, vectors, config)
    b, _ = models.tune("xgboost", vectors, vectors, config)
    assert a.params == b.params
    assert trials.filter("name = 'pr_auc'").count() == 2
    assert 0.01 <= a.params["learning_rate"] <= 0.3 and 5 <= a.params["scale_pos_weight"] <= 15


def test_stored_tables_keep_metadata_and_prune(vectors):
    from riskloom.operators import encoding
    from riskloom.session import stored

    df = vectors.selectExpr("id", "readmitted", "string(id % 3) AS k", "id % 2 AS side")
    encoder = encoding.TabularEncoder([], ["k"]).fit(df)
    table = stored(encoding.encode(encoder, df, ["id", "readmitted", "side"]), "t", "side")
    assert table.schema["features"].metadata["ml_attr"]["num_attrs"] == 3
    plan = table.filter("side = 1").select("readmitted")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(side" in plan and "ReadSchema: struct<readmitted:bigint>" in plan


# ---- jobs -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def trained(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("artifacts"))
    raw = settle(fixtures.encounters(spark, sf_dir))
    status, report = evaluation.run_evaluation(spark, raw, out, SMALL, fail_on_gates=True)
    return raw, out, status, report


def test_evaluation_job(spark, trained):
    raw, out, status, report = trained
    assert status == 1 and any("PR-AUC" in m for m in report["quality_gate_violations"])
    assert set(report["metrics"]) == {"roc_auc", "pr_auc", "f1", "precision", "recall", "brier_score"}
    assert report["best_model"] in SMALL.models and len(report["training_fingerprint"]) == 12
    assert "gender" in report["subgroup_fairness"]
    # Existing artifacts are reported without another training.
    again = evaluation.run_evaluation(spark, raw.limit(0), out, SMALL, train_if_missing=True)
    assert again == (0, report)
    runs = spark.read.parquet(artifacts.current_run(spark, out).runs)
    assert {r["model"] for r in runs.collect()} == set(SMALL.models)


def test_scorer(spark, trained):
    raw, out, _, report = trained
    scorer = scoring.Scorer.load(spark, out)
    assert scorer.threshold == report["threshold"]
    rows = training.prepare(raw)
    scored = scorer.score(rows, ["encounter_id"])
    assert scored.count() == rows.count()
    plain = scorer.score(rows, ["encounter_id"], explain=False)
    assert "Exchange hashpartitioning(encounter_id" not in plain._jdf.queryExecution().executedPlan().toString()
    r = scored.first()
    assert 0 <= r["risk_score"] <= 1 and r["risk_tier"] in ("Low", "Medium", "High")
    assert len(r["top_reasons"]) == 3 and r["model_version"] == SMALL.model_version
    card = scorer.model_card(spark).first()
    assert card["n_features"] == len(card["feature_names"]) and card["quality_gate_violations"]


def test_single_and_batch_prediction(spark, trained):
    raw, out, _, _ = trained
    scorer = scoring.Scorer.load(spark, out)
    partial = {"age_ordinal": 2, "time_in_hospital": 9, "num_medications": 31, "gender": "Male",
               "diag1_category": "Neoplasms"}
    one = scorer.predict(spark, partial)
    assert 0 <= one["risk_score"] <= 1 and len(one["top_reasons"]) == 3
    rows = training.prepare(raw)
    good, bad = scorer.predict_batch(rows, ["encounter_id"])
    assert good.count() + bad.count() == rows.count() and bad.count() > 0


def test_incomplete_artifacts(spark, trained, tmp_path):
    with pytest.raises(FileNotFoundError):
        scoring.Scorer.load(spark, str(tmp_path))
    assert artifacts.load_threshold(spark, str(tmp_path / "nothing")) == 0.5
    (tmp_path / "bad.json").write_text("not json at all")
    assert artifacts.load_threshold(spark, str(tmp_path / "bad.json")) == 0.5
    (tmp_path / "text.json").write_text('{"threshold": "high"}')
    assert artifacts.load_threshold(spark, str(tmp_path / "text.json")) == 0.5


def test_report_is_sorted_json(spark, tmp_path):
    path = artifacts.save_metrics_report(spark, str(tmp_path / "r"), {"recall": 1, "f1": 0.5}, 0.2, {"a": 1})
    text = spark.read.text(path).first()[0]
    assert list(json.loads(text)) == ["a", "metrics", "threshold"]


def test_fingerprint_depends_on_settings(spark):
    a = training.fingerprint(spark, SMALL, 10, 3, "x")
    assert a == training.fingerprint(spark, SMALL, 10, 3, "x") and len(a) == 12
    assert a != training.fingerprint(spark, SMALL, 11, 3, "x")


def test_drift_against_the_snapshot(spark, trained):
    raw, out, _, _ = trained
    rows = training.prepare(raw)
    calm = scoring.check_drift(spark, out, rows)
    assert calm.count() == len(NUMERIC_FEATURES) and calm.filter("drifted").count() == 0
    moved = rows.withColumn("time_in_hospital", F.col("time_in_hospital") + 5)
    assert [r["feature"] for r in scoring.check_drift(spark, out, moved).filter("drifted").collect()] == ["time_in_hospital"]
    with pytest.raises(FileNotFoundError):
        scoring.check_drift(spark, out + "-absent", rows)


def test_every_candidate_is_kept(spark, trained):
    _, out, _, _ = trained
    run = artifacts.current_run(spark, out)
    names = {r["model"] for r in spark.read.parquet(run.runs).filter("kind = 'metric' AND run_id = 'fit'").collect()}
    assert names == set(models.configured_models(SMALL))
    for name in names:
        assert artifacts.load_model(run.candidate(name), spark).numFeatures > 0


def test_a_failed_calibration_leaves_the_model(spark, trained, tmp_path, monkeypatch):
    raw, _, _, _ = trained

    def fail(*_):
        raise RuntimeError("no sigmoid")

    monkeypatch.setattr(models, "fit_calibrated", fail)
    small = replace(SMALL, models=("logistic_regression",), cv_folds=2)
    with pytest.warns(UserWarning, match="no sigmoid"):
        result = training.run_training(raw, str(tmp_path / "run"), small)
    assert not result.calibrated and result.best_model == "logistic_regression"


def test_streams(spark, trained, tmp_path):
    raw, out, _, _ = trained
    scorer = scoring.Scorer.load(spark, out)
    rows = training.prepare(raw).drop("readmitted")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = streaming.read_requests(spark, str(tmp_path / "in"), rows.schema, files_per_batch=1)
    streaming.score_stream(scorer, stream, str(tmp_path / "out"), keep=["encounter_id"]).awaitTermination()
    good, _ = scorer.predict_batch(rows, ["encounter_id"])
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("encounter_id", "risk_score").exceptAll(good.select("encounter_id", "risk_score")).count() == 0
    assert got.count() == good.count()

    reference = artifacts.load_reference(spark, artifacts.current_run(spark, out).reference)
    again = streaming.read_requests(spark, str(tmp_path / "in"), rows.schema, files_per_batch=1)
    streaming.drift_stream(reference, again, str(tmp_path / "drift"), ["time_in_hospital"]).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "drift")).select("batch").distinct().count() == 3


def test_a_later_run_into_one_folder_appends(spark, trained, tmp_path):
    raw, out, _, _ = trained
    scorer = scoring.Scorer.load(spark, out)
    rows = training.prepare(raw).drop("readmitted").limit(40)
    first, second = rows.filter("encounter_id % 2 = 0"), rows.filter("encounter_id % 2 = 1")
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = streaming.read_requests(spark, str(tmp_path / "in"), rows.schema)
        streaming.score_stream(scorer, stream, str(tmp_path / "out"), keep=["encounter_id"]).awaitTermination()
    good, bad = scorer.predict_batch(rows, ["encounter_id"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == good.count()
    assert spark.read.parquet(str(tmp_path / "out-rejected")).count() == bad.count()


def test_a_model_saved_over_another_form_is_the_one_loaded(spark, vectors, tmp_path):
    fit = models.Candidate("logistic_regression", {"max_iter": 10})
    path = str(tmp_path / "model")
    artifacts.save_model(fit.fit(vectors), path, spark)
    artifacts.save_model(models.fit_calibrated(vectors, fit, "id", folds=2), path, spark)
    assert isinstance(artifacts.load_model(path, spark), models.CalibratedModel)
    artifacts.save_model(fit.fit(vectors), path, spark)
    assert not isinstance(artifacts.load_model(path, spark), models.CalibratedModel)


def test_a_run_that_fails_between_writes_leaves_the_earlier_one(spark, trained):
    _, out, _, report = trained
    before = artifacts.current_run(spark, out)
    torn = artifacts.new_run(out)
    artifacts.save_metrics_report(spark, torn.report, {"recall": 0.0}, 0.9)
    assert artifacts.current_run(spark, out) == before
    assert scoring.Scorer.load(spark, out).report == report


def test_a_scorer_without_threshold_record_uses_one_half(spark, trained, tmp_path):
    import shutil

    _, out, _, _ = trained
    copy = str(tmp_path / "copy")
    shutil.copytree(out, copy, ignore=shutil.ignore_patterns("threshold"))
    assert artifacts.artifacts_ready(spark, copy) and scoring.Scorer.load(spark, copy).threshold == 0.5


def test_run_tables_are_kept(spark, trained):
    _, out, _, report = trained
    run = artifacts.current_run(spark, out)
    assert spark.read.parquet(f"{run.evaluation}/metrics").first()["recall"] == report["metrics"]["recall"]
    points = spark.read.parquet(f"{run.evaluation}/roc_curve")
    assert points.filter("threshold IS NULL").count() == 1
    importance = spark.read.parquet(run.importance)
    assert importance.count() == len(report["feature_names"]) and importance.filter("importance < 0").count() == 0


def test_records_are_scored_or_returned(spark, trained):
    _, out, _, _ = trained
    scorer = scoring.Scorer.load(spark, out)
    record = {"age_ordinal": 2, "time_in_hospital": 9, "num_lab_procedures": 70, "num_medications": 31,
              "number_diagnoses": 8, "num_med_changes": 1, "num_meds_active": 4, "total_prior_visits": 0,
              "insulin_changed": 0, "gender": "Male"}
    good, bad = scorer.predict_records(spark, [record, {**record, "time_in_hospital": 15}, {**record, "gender": None}])
    assert good.count() == 1
    assert sorted(r["errors"] for r in bad.collect()) == [["gender"], ["time_in_hospital"]]
