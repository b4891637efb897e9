"""Metrics and curves against direct definitions, including degenerate inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import curves, metrics


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return float(np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])))


def brute_ap(y, s):
    ap, before = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        take = s >= t
        recall = y[take].sum() / y.sum()
        ap += (recall - before) * y[take].mean()
        before = recall
    return ap


def scored(spark, y, s):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y_true int, score double")


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.3).astype(int)
    s = np.round(y * 0.3 + rng.random(400), 2)
    return y, s, scored(spark, y, s).persist()


@pytest.mark.parametrize("per_bucket", [1_000_000, 7])
def test_ranking_metrics(sample, per_bucket):
    y, s, df = sample
    row = metrics.ranking_metrics(df, "y_true", "score", scores_per_bucket=per_bucket).first()
    assert row["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert row["average_precision"] == pytest.approx(brute_ap(y, s), abs=1e-12)


def test_auc_ignores_monotone_maps_and_layout(sample):
    _, _, df = sample
    base = metrics.ranking_metrics(df, "y_true", "score").first()
    mapped = df.withColumn("score", F.exp(F.col("score") * 3) - 5).repartition(11)
    again = metrics.ranking_metrics(mapped, "y_true", "score").first()
    assert base["roc_auc"] == pytest.approx(again["roc_auc"], abs=1e-12)


def test_parts_are_scored_alone(sample):
    y, s, df = sample
    two = df.withColumn("p", (F.monotonically_increasing_id() % 2).cast("int")).persist()
    rows = {r["p"]: r for r in two.toPandas().to_dict("records") and
            metrics.ranking_metrics(two, "y_true", "score", ["p"], scores_per_bucket=9).collect()}
    pdf = two.toPandas()
    for p, r in rows.items():
        part = pdf[pdf.p == p]
        assert r["roc_auc"] == pytest.approx(brute_auc(part.y_true.to_numpy(), part.score.to_numpy()), abs=1e-12)


def test_known_row_count_skips_the_estimate(sample):
    _, _, df = sample
    a = metrics.ranking_metrics(df, "y_true", "score").first()
    assert metrics.ranking_metrics(df, "y_true", "score", n_rows=400).first() == a


def test_single_class(spark):
    df = scored(spark, [1, 1, 1], [0.1, 0.5, 0.9])
    row = metrics.ranking_metrics(df, "y_true", "score").first()
    assert row["roc_auc"] is None and row["average_precision"] == 1.0
    none = metrics.ranking_metrics(scored(spark, [0, 0], [0.1, 0.2]), "y_true", "score").first()
    assert none["roc_auc"] is None and none["average_precision"] == 0.0


def brute_roc(y, s):
    points = [(np.inf, 0.0, 0.0)]
    steps = [(t, ((s >= t) & (y == 0)).sum(), ((s >= t) & (y == 1)).sum()) for t in sorted(set(s), reverse=True)]
    for i, (t, fp, tp) in enumerate(steps):
        inner = 0 < i < len(steps) - 1
        if inner:
            (_, f0, t0), (_, f1, t1) = steps[i - 1], steps[i + 1]
            if f1 - 2 * fp + f0 == 0 and t1 - 2 * tp + t0 == 0:
                continue
        points.append((t, fp / (y == 0).sum(), tp / (y == 1).sum()))
    return points


@pytest.mark.parametrize("per_bucket", [1_000_000, 5])
def test_roc_points(sample, per_bucket):
    y, s, df = sample
    got = [tuple(r) for r in curves.roc_curve(df, scores_per_bucket=per_bucket).orderBy(F.desc("threshold")).collect()]
    np.testing.assert_allclose(got, brute_roc(y, s))


def test_pr_points(sample):
    y, s, df = sample
    got = curves.pr_curve(df).collect()
    assert {(None, 1.0, 0.0)} <= {tuple(r) for r in got} and len(got) == len(set(s)) + 1
    for t, p, rec in (tuple(r) for r in got if r["threshold"] is not None):
        assert p == pytest.approx(y[s >= t].mean()) and rec == pytest.approx(y[s >= t].sum() / y.sum())


def test_confusion_includes_unpredicted_labels(spark):
    df = spark.createDataFrame([(0, 1), (2, 1), (2, 2)], "y_true int, y_pred int")
    rows = {(r["y_true"], r["y_pred"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert len(rows) == 9 and sum(rows.values()) == 3 and rows[(1, 1)] == 0
    report = {r["label"]: r for r in metrics.classification_report(df).collect()}
    assert report["1"]["recall"] == 0.0 and report["1"]["support"] == 0
    assert report["0"]["precision"] == 0.0
    summary = metrics.summary_metrics(df, "y_true", "y_pred").first()
    assert summary["balanced_accuracy"] == pytest.approx((0 + 0.5) / 2)
    assert summary["accuracy"] == pytest.approx(1 / 3)


def test_regression_edges(spark):
    perfect = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y_true double, y_pred double")
    assert metrics.regression_metrics(perfect).first()["r2"] == 1.0
    constant = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "y_true double, y_pred double")
    assert metrics.regression_metrics(constant).first()["r2"] == 0.0
    zero = spark.createDataFrame([(0.0, 1.0), (2.0, 3.0)], "y_true double, y_pred double")
    assert metrics.regression_metrics(zero).first()["mape"] is None


def test_metric_names_are_checked():
    with pytest.raises(ValueError, match="unknown"):
        metrics.check_metrics(["auc"], "classification")
    with pytest.raises(ValueError, match="unknown"):
        metrics.check_metrics(["roc_auc"], "regression")


def test_residual_histogram_counts_every_row(spark):
    rng = np.random.default_rng(5)
    t, p = rng.normal(size=500), rng.normal(size=500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(t, p)], "y_true double, y_pred double")
    got = [r["n"] for r in curves.residual_histogram(df).orderBy("bin").collect()]
    np.testing.assert_array_equal(got, np.histogram(t - p, bins=50)[0])
    same = spark.createDataFrame([(1.0, 0.0)] * 4, "y_true double, y_pred double")
    rows = curves.residual_histogram(same).orderBy("bin").collect()
    assert sum(r["n"] for r in rows) == 4 and rows[0]["low"] == 0.5 and rows[25]["n"] == 4
