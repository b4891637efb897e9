"""The jobs end to end on a small marketing-like table."""

import pytest
from pyspark.sql import functions as F

from millrace import Spec, load_model, score
from millrace.plans import jobs
from millrace.sources.readers import rename_dots
from millrace.sources.sinks import read_runs

# The parts of a nested configuration that a spec is built from.
CONFIG = {
    "random_seed": 42, "project_name": "bank",
    "data": {"target_column": "y", "task_type": "classification"},
    "schema": {"expected_columns": ["age", "emp.var.rate", "job", "contact"], "max_null_percentage": 0.05},
    "split": {"test_size": 0.2, "stratify": True, "shuffle": True},
    "preprocessing": {"numeric_features": ["age", "emp.var.rate", "pdays"], "categorical_features": ["job", "month"],
                      "imputation": {"numeric_strategy": "median", "categorical_strategy": "most_frequent"},
                      "scaling": {"method": "standard"}, "pca": {"enabled": False}},
    "cross_validation": {"n_splits": 3},
    "metrics": {"classification": {"primary": "roc_auc", "secondary": ["average_precision", "balanced_accuracy", "f1"]}},
    "supervised_models": {
        "baseline": {"model_type": "logistic_regression", "params": {"max_iter": 1000, "class_weight": "balanced"}},
        "random_forest": {"class_weight": "balanced",
                          "randomized_search": {"n_iter": 2, "params": {"max_depth": [2, 3], "min_samples_leaf": [1, 2]}},
                          "grid_search": {"enabled": False}}},
    "kmeans": {"k_range": [2, 3], "n_init": 2, "max_iter": 20},
}


@pytest.fixture(scope="module")
def spec():
    made = Spec.from_config(CONFIG, key=("id",))
    return made.but(forest_params={"n_estimators": 4})


@pytest.fixture(scope="module")
def table(people):
    return rename_dots(people).persist()


def test_spec_from_config(spec):
    assert spec.numeric == ("age", "emp_var_rate", "pdays") and spec.folds == 3 and spec.stratify
    assert spec.scoring == ("roc_auc", "average_precision", "balanced_accuracy", "f1")
    assert spec.k_range == (2, 3) and not spec.grid_enabled and spec.search_iterations == 2
    with pytest.raises(ValueError, match="unknown task"):
        Spec(task="ranking")
    with pytest.raises(ValueError, match="shuffle"):
        Spec(stratify=True, shuffle=False)


def test_summary(table, spec):
    result = jobs.data_summary(table, spec)
    assert result.values == {"rows": 200, "columns": 7, "schema_valid": False, "nulls_valid": False}
    findings = {(r["finding"], r["column"]) for r in result.tables["schema"].collect()}
    assert ("missing", "contact") in findings and ("extra", "month") in findings
    assert {r["column"] for r in result.tables["null_findings"].collect()} == {"age", "job"}
    assert {r["value"]: r["n"] for r in result.tables["target"].collect()}.keys() == {"yes", "no"}
    assert dict(tuple(r) for r in result.tables["dtypes"].collect())["age"] == "int"
    no_target = jobs.data_summary(table.drop("y"), spec)
    assert "target" not in no_target.tables


def test_train_save_load(table, spec, tmp_path):
    result = jobs.train(table, spec, save_to=str(tmp_path), run_id="r1")
    assert result.values["roc_auc"] > 0.7
    assert set(result.tables) >= {"cv_scores", "cv_summary", "confusion_matrix", "classification_report", "roc_curve", "pr_curve"}
    assert result.tables["confusion_matrix"].agg(F.sum("n")).first()[0] == 40
    assert result.tables["cv_summary"].count() == 4 * 2
    again = load_model(result.values["model_path"])
    a, b = (score(m, table).select("id", "prediction", "probability") for m in (result.model, again))
    assert a.exceptAll(b).count() == 0
    result.close()
    with pytest.raises(ValueError, match="unknown model"):
        jobs.train(table, spec, "boosting")


def test_train_forest_reports_importances(table, spec):
    result = jobs.train(table, spec, "random_forest")
    rows = result.tables["feature_importance"].collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert rows[0]["feature"] == "emp_var_rate"
    result.close()


def test_tune_with_both_stages(table, spec, tmp_path):
    space = {"max_depth": [2], "max_features": ["sqrt", "log2"]}
    both = spec.but(grid_enabled=True, search_space=space, forest_params={"n_estimators": 3, "min_samples_leaf": 2})
    result = jobs.tune(table, both, log_path=str(tmp_path / "log"))
    assert result.values["improvement"] == pytest.approx(result.values["grid_best_score"] - result.values["random_best_score"])
    stages = {r["stage"]: r["count"] for r in result.tables["ranking"].groupBy("stage").count().collect()}
    assert stages == {"random": 2, "grid": 8}
    assert read_runs(table.sparkSession, str(tmp_path / "log")).first()["project"] == "bank"
    result.close()


def test_cluster(table, spec, tmp_path):
    result = jobs.cluster(table, spec.but(silhouette="euclidean"), save_to=str(tmp_path))
    k = result.values["best_k"]
    assert result.tables["sizes"].agg(F.sum("n")).first()[0] == 160
    assert result.tables["profile"].count() == k * 3 and result.tables["centroids"].count() == k * 3
    assert result.tables["scatter"].count() == 160 and result.tables["k_curves"].count() == 8
    scored = load_model(result.values["model_path"]).transform(table)
    assert scored.select("cluster").distinct().count() <= k
    with pytest.raises(ValueError, match="unknown selection"):
        jobs.cluster(table, spec, "gap")
    with pytest.raises(ValueError, match="not found"):
        jobs.cluster(table.drop("y"), spec)


def test_full_and_report(table, spec):
    results = jobs.full(table, spec)
    report = jobs.report_tables(results)
    assert [r.job for r in results] == ["data_summary", "train_baseline", "tune", "cluster"]
    sections = {r["section"] for r in report.select("section").distinct().collect()}
    assert sections >= {"shape", "missing", "target", "cross_validation", "metric", "tuning", "k_table", "cluster_sizes"}
    for r in results:
        r.close()


def test_full_stops_at_the_first_failure(table, spec):
    with pytest.raises(ValueError, match="not found"):
        jobs.full(table.drop("y"), spec)


def test_regression_job(table, spec):
    result = jobs.train(table, spec.but(target="pdays", task="regression", stratify=False, metrics=(), baseline=None,
                                        baseline_params={}, numeric=("age", "emp_var_rate")))
    assert {"rmse", "mae", "r2", "mse"} <= set(result.values) and "residual_histogram" in result.tables
    assert result.tables["residuals"].count() == 40
    result.close()


def test_summary_and_cluster_jobs_write_what_they_find(people, spark, tmp_path):
    df = rename_dots(people)
    summary = jobs.data_summary(df, Spec(target="y"), report_to=str(tmp_path / "report"))
    report = spark.read.schema("section string, item string, metric string, value double").json(str(tmp_path / "report"))
    assert report.count() == summary.long.count()
    assert {"type", "numeric", "top_values", "missing", "target"} <= {r["section"] for r in report.select("section").distinct().collect()}

    spec = Spec(numeric=("age", "emp_var_rate"), key=("id",), k_range=(2, 3), n_init=1, max_iter=5, parallelism=2)
    result = jobs.cluster(df, spec, results_to=str(tmp_path / "out"), log_path=str(tmp_path / "runs"), save_to=str(tmp_path / "models"))
    header = spark.read.option("header", True)
    assert header.csv(str(tmp_path / "out" / "k_table")).count() == 2
    assert header.csv(str(tmp_path / "out" / "centroids")).count() == 2 * result.values["best_k"]
    analysis = spark.read.json(str(tmp_path / "out" / "cluster_analysis"))
    assert analysis.count() == result.tables["profile"].count()
    assert header.csv(str(tmp_path / "out" / "differences")).count() == 2
    run = read_runs(spark, str(tmp_path / "runs")).first()
    assert {"best_k", "best_silhouette", "best_inertia", "model_path"} <= set(run["details"]) and run["n_rows"] == 200
    result.close()
