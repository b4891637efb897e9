"""Search grids, folds, scores and rankings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import splits, tuning
from millrace.operators.curves import learning_curve
from millrace.operators.tuning import Candidate
from millrace.plans.catalog import QUERIES
from millrace.sources.readers import rename_dots
from millrace.spec import FOREST_SPACE, Spec

SPEC = Spec(target="y", numeric=("age", "emp_var_rate"), categorical=("job", "month"), key=("id",), folds=3,
            search_space={"n_estimators": [3, 5], "max_depth": [2, 3]}, search_iterations=2, parallelism=4)


def test_refined_grid():
    best = {"n_estimators": 50, "max_depth": 5, "max_features": 0.1, "min_samples_split": 2, "min_samples_leaf": 4,
            "bootstrap": True}
    assert tuning.refine_grid(best) == {
        "n_estimators": [50, 100], "max_depth": [5, 10, None], "max_features": [0.1, 0.2],
        "min_samples_split": [2, 4], "min_samples_leaf": [3, 4, 5], "bootstrap": [True]}
    other = tuning.refine_grid({"n_estimators": 300, "max_depth": None, "max_features": "sqrt", "min_samples_split": 10,
                                "min_samples_leaf": 1})
    assert other == {"n_estimators": [250, 300, 350], "max_depth": [None, 20, 25, 30], "max_features": ["sqrt", "log2"],
                     "min_samples_split": [8, 10, 12], "min_samples_leaf": [1, 2]}
    assert tuning.refine_grid({"max_features": 0.95}) == {"max_features": [0.85, 0.95, 1.0]}


def test_candidates_are_drawn_without_replacement():
    drawn = tuning.sample_candidates(FOREST_SPACE, 30, 42)
    assert len({repr(sorted(c.items(), key=str)) for c in drawn}) == 30
    assert drawn == tuning.sample_candidates(FOREST_SPACE, 30, 42) != tuning.sample_candidates(FOREST_SPACE, 30, 43)
    assert len(tuning.sample_candidates({"a": [1, 2], "b": [3]}, 99, 1)) == 2
    assert len(tuning.grid_candidates(FOREST_SPACE)) == 5 * 6 * 4 * 4 * 4


def test_equal_fits_share_a_fingerprint():
    def mark(**p):
        return Candidate("c", "random_forest", p).fingerprint("classification")

    assert mark(max_depth=None) == mark(max_depth=30) != mark(max_depth=29)
    assert mark(min_samples_split=4, min_samples_leaf=2) == mark(min_samples_leaf=2) != mark(min_samples_split=4) != mark()
    assert mark(max_features="sqrt") == mark()


@pytest.fixture(scope="module")
def folded(people):
    df = rename_dots(people)
    return tuning.with_folds(splits.encode_label(df, "y", splits.class_codes(df, "y")), SPEC).persist()


@pytest.fixture(scope="module")
def scores(folded):
    models = [Candidate("line", "logistic_regression", {"class_weight": "balanced"}),
              Candidate("tree", "decision_tree", {"max_depth": 3}), Candidate("twin", "decision_tree", {"max_depth": 3})]
    return tuning.cross_validate(folded, SPEC, models, ["roc_auc", "f1", "accuracy"]).persist()


def test_every_fold_part_and_metric_is_scored(scores):
    assert scores.count() == 3 * 3 * 2 * 3
    assert scores.where("score is null or score < 0 or score > 1").count() == 0
    twin = scores.where("candidate = 'twin'").select("fold", "part", "metric", "score")
    assert twin.exceptAll(scores.where("candidate = 'tree'").select("fold", "part", "metric", "score")).count() == 0


def test_held_out_rows_do_not_influence_the_fit(folded):
    """Changing the held-out features of fold 0 leaves the training score of fold 0 as it was."""
    spoiled = folded.withColumn("age", F.when(F.col("fold") == 0, 10_000).otherwise(F.col("age"))).withColumn(
        "job", F.when(F.col("fold") == 0, F.lit("spoiled")).otherwise(F.col("job")))
    model = [Candidate("line", "logistic_regression", {})]
    a, b = (tuning.cross_validate(d, SPEC, model, ["roc_auc"]).where("fold = 0 and part = 'train'").first()["score"]
            for d in (folded, spoiled))
    assert a == pytest.approx(b, abs=1e-9)


def test_summary_uses_population_std(scores):
    rows = tuning.cv_summary(scores).collect()
    for r in rows:
        assert r["mean"] == pytest.approx(np.mean(r["scores"])) and r["std"] == pytest.approx(np.std(r["scores"]))
        assert len(r["scores"]) == 3


def test_comparison_puts_the_best_first(scores):
    rows = tuning.model_comparison(scores).collect()
    assert [r["roc_auc"] for r in rows] == sorted((r["roc_auc"] for r in rows), reverse=True)
    assert set(rows[0].asDict()) == {"candidate", "accuracy", "f1", "roc_auc", "roc_auc_std", "seconds"}


def test_ranks_are_shared_by_equal_means(spark):
    rows = [(c, {"p": c}, f, 1.0, s, 0.1) for c, s in (("a", 0.5), ("b", 0.7), ("c", 0.7), ("d", 0.1)) for f in range(2)]
    table = spark.createDataFrame(
        rows, "candidate string, params map<string,string>, fold int, train_score double, test_score double, seconds double")
    ranks = {r["candidate"]: r["rank"] for r in tuning.rank_candidates(table).collect()}
    assert ranks == {"a": 3, "b": 1, "c": 1, "d": 4}
    curve = {r["value"]: r["test_score"] for r in learning_curve(table, "p").collect()}
    assert curve == {"a": 0.5, "b": 0.7, "c": 0.7, "d": 0.1}


def test_random_search_then_grid(folded):
    first = tuning.random_search(folded, SPEC)
    assert first.ranking.count() == 2 and set(first.best_params) == {"n_estimators", "max_depth"}
    top = first.ranking.orderBy("rank", "candidate").first()
    assert top["rank"] == 1 and top["mean_test"] == first.best_score
    with pytest.raises(ValueError, match="refined grid has"):
        tuning.grid_search(folded, SPEC.but(max_candidates=1), first.best_params)


def test_registered_random_search_is_whole(spark, tmp_path, monkeypatch):
    """Twenty candidates of the default space, with the number of trees and the depth that were drawn; fits are left out here."""
    rows = [(i, i % 7, i % 5, i % 4, float(i % 50), 1000.0 * (i % 97), 0.05, 0.02, "ANR"[i % 3], "FO"[i % 2]) for i in range(200)]
    names = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
    spark.createDataFrame(rows, names.split()).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen = []

    def scored(df, spec, models, metrics):
        seen.extend(models)
        return spark.createDataFrame([(m.name, f, p, metrics[0], 0.5, 0.1) for m in models for f in range(spec.folds) for p in ("train", "test")], tuning.SCORE_SCHEMA)

    monkeypatch.setattr(tuning, "cross_validate", scored)
    assert QUERIES["random_search"](spark, str(tmp_path)).count() == 20
    assert [m.params for m in seen] == [{**p, "class_weight": "balanced"} for p in tuning.sample_candidates(FOREST_SPACE, 20, 42)]


def test_regression_folds_and_multiclass(spark, people):
    df = rename_dots(people)
    spec = SPEC.but(target="pdays", task="regression", metrics=("r2", "neg_mean_absolute_error"))
    reg = tuning.with_folds(splits.with_label(df, spec, None), spec)
    got = tuning.cross_validate(reg, spec, [Candidate("f", "random_forest", {"n_estimators": 3, "max_depth": 2})])
    assert got.count() == 3 * 2 * 2
    multi = SPEC.but(target="month", categorical=("job",))
    labelled = tuning.with_folds(splits.encode_label(df, "month", ["mar", "may", "sep"]), multi)
    many = tuning.cross_validate(labelled, multi, [Candidate("l", "logistic_regression")],
                                 ["roc_auc", "average_precision", "balanced_accuracy"])
    assert many.count() == 3 * 2 * 3 and many.where("isnan(score)").count() == 0


# --- ridges from the products of the folds --------------------------------------------------------


REGRESSION = Spec(target="pdays", task="regression", numeric=("age", "emp_var_rate"), categorical=("job", "month"), key=("id",), folds=4)
RIDGES = [Candidate(f"ridge_{a}_{b}", "ridge", {"alpha": a, "fit_intercept": b}) for a in (0.01, 1.0, 300.0) for b in (True, False)]
ERRORS = ["neg_root_mean_squared_error", "r2", "neg_mean_absolute_error", "mse"]


@pytest.fixture(scope="module")
def numbers(people):
    return tuning.with_folds(splits.with_label(rename_dots(people), REGRESSION, None), REGRESSION).persist()


def by_part(scores):
    return {(r["candidate"], r["fold"], r["part"], r["metric"]): r["score"] for r in scores.collect()}


@pytest.mark.parametrize("changes", [{}, {"numeric_strategy": "constant", "categorical_strategy": "constant"}, {"scaling": "minmax"}, {"categorical": ()}])
def test_ridges_from_products_equal_single_fits(numbers, monkeypatch, changes):
    """All folds, penalties and metrics from one scan, equal to a fit for each."""
    spec = REGRESSION.but(**changes)
    got = by_part(tuning.cross_validate(numbers, spec, RIDGES, ERRORS))
    monkeypatch.setattr(tuning.gram, "WIDTH", 0)  # too wide: today's way
    one_by_one = by_part(tuning.cross_validate(numbers, spec, RIDGES, ERRORS))
    assert got.keys() == one_by_one.keys() and len(got) == 6 * 4 * 2 * 4
    for k, v in one_by_one.items():
        assert got[k] == pytest.approx(v, abs=1e-9, rel=1e-9), k


def test_products_need_no_fit_and_few_jobs(spark, numbers, monkeypatch):
    monkeypatch.setattr(tuning, "fit_model", lambda *a, **k: pytest.fail("a single fit"))
    monkeypatch.setattr(tuning, "score_parts", lambda *a, **k: pytest.fail("a single scoring"))
    assert len(by_part(tuning.cross_validate(numbers, REGRESSION, RIDGES, ERRORS))) == 192


# --- scores of logistic regressions ----------------------------------------------------------------


LINES = [Candidate("plain", "logistic_regression"), Candidate("free", "logistic_regression", {"fit_intercept": False, "penalty": "l1", "C": 0.1}),
         Candidate("balanced", "logistic_regression", {"class_weight": "balanced", "max_iter": 1000})]


@pytest.mark.parametrize("changes", [{}, {"scaling": "minmax", "numeric_strategy": "constant", "categorical_strategy": "constant"}, {"categorical": ()}])
def test_logistic_scores_by_arithmetic_equal_those_of_the_models(folded, monkeypatch, changes):
    """No row is encoded to be scored: the encoders of the folds are used for the fits alone."""
    spec, names = SPEC.but(**changes), ["roc_auc", "average_precision", "balanced_accuracy", "f1", "accuracy"]
    with monkeypatch.context() as m:
        m.setattr(tuning, "vector_to_array", lambda *a, **k: pytest.fail("scored by the model"))
        got = by_part(tuning.cross_validate(folded, spec, LINES, names))
    monkeypatch.setattr(tuning.logit, "WIDTH", 0)  # too wide: the models score
    one_by_one = by_part(tuning.cross_validate(folded, spec, LINES, names))
    assert got.keys() == one_by_one.keys() and len(got) == 3 * 3 * 2 * 5
    for k, v in one_by_one.items():
        assert got[k] == pytest.approx(v, abs=1e-12), k
