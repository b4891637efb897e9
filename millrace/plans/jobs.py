"""The jobs users call: summary, training, tuning, clustering and all of them in a row."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import quoted
from millrace.operators import clusters, profile, tuning
from millrace.operators.models import baseline, forest
from millrace.operators.preprocess import project_2d
from millrace.operators.splits import class_codes, split_table, with_label
from millrace.operators.tuning import Candidate, SearchResult
from millrace.plans.evaluate import LONG, Evaluation, evaluate, union_long
from millrace.sources.sinks import append_run, run_record, save_model, write_centroids, write_csv, write_json
from millrace.spec import Spec


class OnDemand(dict):
    """Tables by name; one that is given as a function is made when it is first asked for."""

    def __getitem__(self, name: str) -> DataFrame:
        table = super().__getitem__(name)
        if callable(table):
            self[name] = table = table()
        return table


@dataclass
class JobResult:
    """Tables and values of one job; ``long`` is its part of the report."""

    job: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    values: dict[str, Any] = field(default_factory=dict)
    model: PipelineModel | None = None
    search: dict[str, SearchResult] = field(default_factory=dict)
    clusters: clusters.KMeansRange | None = None
    evaluation: Evaluation | None = None
    long: DataFrame | None = None
    cached: list[DataFrame] = field(default_factory=list)

    def close(self) -> None:
        """Give back what the job keeps cached for its lazy tables."""
        if self.evaluation is not None:
            self.evaluation.close()
        for df in self.cached:
            df.unpersist()


def finished(results: list[JobResult], table: DataFrame) -> DataFrame:
    """A result table (metrics and counts, a few rows) taken out of its jobs, whose caches are given back."""
    rows = table.collect()
    for r in results:
        r.close()
    return table.sparkSession.createDataFrame([tuple(r) for r in rows], table.schema)


def _persisted_split(df: DataFrame, spec: Spec) -> DataFrame:
    """Only the columns the spec uses, split once."""
    used = list(dict.fromkeys([*spec.key, *spec.order_by, *spec.numeric, *spec.categorical,
                               *([spec.target] if spec.target else [])]))
    if spec.key:
        df = df.select(*[quoted(c) for c in used])
    return split_table(df, spec).persist()


@dataclass
class Prepared:
    """Train and test rows with label codes learned on the training rows."""

    split: DataFrame
    train: DataFrame
    test: DataFrame
    classes: list | None

    def close(self) -> None:
        self.split.unpersist()


def prepare(df: DataFrame, spec: Spec) -> Prepared:
    if spec.target not in df.columns:
        raise ValueError(f"target column {spec.target!r} not found")
    split = _persisted_split(df, spec)
    train = split.where("split = 'train'").drop("split")
    test = split.where("split = 'test'").drop("split")
    classes = class_codes(train, spec.target) if spec.is_classification else None
    return Prepared(split, with_label(train, spec, classes), with_label(test, spec, classes), classes)


# --- summary -----------------------------------------------------------------------------------


def data_summary(df: DataFrame, spec: Spec, report_to: str | None = None) -> JobResult:
    """Schema and null checks (reported, never fatal) and the profile of every column: types, missing values, numbers, top values.

    ``report_to`` gets the whole report as JSON lines."""
    spark = df.sparkSession
    missing = profile.profile_missing(df)
    rows = missing.collect()  # one row per column
    n_rows = rows[0]["n_rows"] if rows else df.count()
    expected = list(spec.expected_columns)
    schema = profile.schema_findings(df, expected).collect()
    bad_nulls = [r for r in rows if r["fraction"] is not None and r["fraction"] > spec.max_null_fraction]
    long = [("shape", "rows", "count", float(n_rows)), ("shape", "columns", "count", float(len(df.columns))),
            ("schema", "valid", "flag", float(profile.schema_is_valid(df, expected))),
            ("nulls", "valid", "flag", float(not bad_nulls))]
    long += [("schema", r["column"], r["finding"], 1.0) for r in schema]
    long += [("nulls", r["column"], "fraction", r["fraction"]) for r in bad_nulls]
    long += [("missing", r["column"], "count", float(r["missing"])) for r in rows]
    long += [("missing", r["column"], "percent", (r["fraction"] or 0.0) * 100) for r in rows]
    tables = {
        "schema": profile.schema_findings(df, expected),
        "missing": missing,
        "null_findings": profile.null_findings(df, spec.max_null_fraction),
        "dtypes": spark.createDataFrame(df.dtypes, "column string, type string"),
        "numeric": profile.profile_numeric(df),
        "top_values": profile.profile_top_values(df),
    }
    long += [("type", name, kind, 1.0) for name, kind in df.dtypes]
    numbers = [c for c in tables["numeric"].columns if c != "column"]
    entries = F.array(*[F.struct(F.lit(c).alias("m"), F.col(quoted(c)).cast("double").alias("v")) for c in numbers])
    parts = [
        spark.createDataFrame(long, LONG),
        tables["numeric"].select("column", F.explode(entries).alias("e")).select(
            F.lit("numeric").alias("section"), F.col("column").alias("item"), F.col("e.m").alias("metric"), F.col("e.v").alias("value")),
        tables["top_values"].select(F.lit("top_values").alias("section"), F.col("column").alias("item"),
                                    F.concat(F.col("rank").cast("string"), F.lit(":"), F.coalesce(F.col("value").cast("string"), F.lit("null"))).alias("metric"),
                                    F.col("n").cast("double").alias("value")),
    ]
    if spec.target in df.columns:
        target = profile.target_distribution(df, spec.target)
        tables["target"] = target
        parts.append(target.select(F.lit("target").alias("section"), F.col("value").cast("string").alias("item"),
                                   F.lit("percent").alias("metric"), F.col("percent").cast("double").alias("value")))
    values = {"rows": n_rows, "columns": len(df.columns), "schema_valid": profile.schema_is_valid(df, expected),
              "nulls_valid": not bad_nulls}
    report = union_long(parts)
    if report_to:
        write_json(report, report_to)
    return JobResult("data_summary", tables, values, long=report)


# --- supervised --------------------------------------------------------------------------------


def _cv_long(summary: DataFrame) -> DataFrame:
    entries = F.array(F.struct(F.lit("mean").alias("m"), F.col("mean").alias("v")),
                      F.struct(F.lit("std").alias("m"), F.col("std").alias("v")))
    return summary.where("part = 'test'").select("candidate", "metric", F.explode(entries).alias("e")).select(
        F.lit("cross_validation").alias("section"), F.col("candidate").alias("item"),
        F.concat_ws("_", "metric", "e.m").alias("metric"), F.col("e.v").alias("value"))


def train_prepared(data: Prepared, spec: Spec, model: str = "baseline") -> JobResult:
    if model == "baseline":
        kind, params = baseline(spec)
    elif model == "random_forest":
        kind, params = forest(spec)
    else:
        raise ValueError(f"unknown model: {model}")
    start = time.monotonic()
    folded = tuning.with_folds(data.train, spec)
    scores = tuning.cross_validate(folded, spec, [Candidate(model, kind, params)])
    seconds = time.monotonic() - start
    summary = tuning.cv_summary(scores)
    fitted = tuning.refit(data.train, spec, kind, params)
    tested = evaluate(fitted, data.test, spec, model, len(data.classes) if data.classes else None)
    tables = {"cv_scores": scores, "cv_summary": summary, **tested.tables}
    return JobResult(f"train_{model}", tables, {"seconds": seconds, **tested.values}, fitted, evaluation=tested,
                     long=union_long([_cv_long(summary), tested.long()]))


def _log(result: JobResult, df: DataFrame, spec: Spec, log_path: str | None, dataset_path: str | None) -> None:
    """Append the record of a run: what it found, and which data it ran on."""
    if log_path:
        append_run(run_record(df.sparkSession, spec.seed, spec.project, df, dataset_path, dataset_path is not None, result.values), log_path)


def train(df: DataFrame, spec: Spec, model: str = "baseline", save_to: str | None = None, run_id: str | None = None,
          log_path: str | None = None, dataset_path: str | None = None) -> JobResult:
    """Split, cross-validate, refit on all training rows, evaluate on the test rows."""
    data = prepare(df, spec)
    try:
        result = train_prepared(data, spec, model)
    finally:
        data.close()
    if save_to:
        result.values["model_path"] = save_model(result.model, save_to, model, run_id)
    _log(result, df, spec, log_path, dataset_path)
    return result


def model_comparison(df: DataFrame, spec: Spec, candidates: list[Candidate]) -> DataFrame:
    """Cross-validate several models on the training rows and rank them."""
    data = prepare(df, spec)
    try:
        scores = tuning.cross_validate(tuning.with_folds(data.train, spec), spec, candidates)
    finally:
        data.close()
    return tuning.model_comparison(scores, spec.primary)


def tune_prepared(data: Prepared, spec: Spec) -> JobResult:
    folded = tuning.with_folds(data.train, spec)
    stages = {"random": tuning.random_search(folded, spec)}
    if spec.grid_enabled:
        stages["grid"] = tuning.grid_search(folded, spec, stages["random"].best_params)
    best = stages["grid"] if spec.grid_enabled else stages["random"]
    kind, params = forest(spec, **best.best_params)
    fitted = tuning.refit(data.train, spec, kind, params)
    tested = evaluate(fitted, data.test, spec, "random_forest_tuned", len(data.classes) if data.classes else None)
    ranking = union_long([s.ranking.withColumn("stage", F.lit(name)) for name, s in stages.items()])
    values = {f"{name}_best_score": s.best_score for name, s in stages.items()}
    if spec.grid_enabled:
        values["improvement"] = stages["grid"].best_score - stages["random"].best_score
    values |= {f"{name}_best_params": s.best_params for name, s in stages.items()}
    values["best_params"] = best.best_params
    values |= tested.values
    spark = data.split.sparkSession
    rows = [("tuning", name, "best_score", s.best_score) for name, s in stages.items()]
    rows += [("best_params", name, f"{k}={v}", float(v) if isinstance(v, (int, float)) else None)
             for name, s in stages.items() for k, v in s.best_params.items()]
    if "improvement" in values:
        rows.append(("tuning", "grid", "improvement", values["improvement"]))
    tables = {"ranking": ranking, **tested.tables}
    return JobResult("tune", tables, values, fitted, stages, evaluation=tested,
                     long=union_long([spark.createDataFrame(rows, LONG), tested.long()]))


def tune(df: DataFrame, spec: Spec, save_to: str | None = None, run_id: str | None = None, log_path: str | None = None,
         dataset_path: str | None = None) -> JobResult:
    """Random search, refined grid search, refit, test evaluation."""
    data = prepare(df, spec)
    try:
        result = tune_prepared(data, spec)
    finally:
        data.close()
    if save_to:
        result.values["model_path"] = save_model(result.model, save_to, "random_forest_tuned", run_id)
    _log(result, df, spec, log_path, dataset_path)
    return result


# --- clustering --------------------------------------------------------------------------------


def cluster_train(train_rows: DataFrame, spec: Spec, method: str = "silhouette", top: int = 5) -> JobResult:
    """Fit every k, choose one, describe its clusters."""
    run = clusters.evaluate_k_range(train_rows, spec)
    k = clusters.best_k(run.table, method)
    if k is None:
        raise ValueError(f"no k can be chosen by {method}")
    features = run.features
    assigned = run.assign(train_rows, k)
    centroids = run.centroids(k)
    sizes = clusters.cluster_sizes(assigned, "cluster")
    # histograms and the projection read the rows before anyone looks at them, so they wait until asked for
    tables = OnDemand({
        "k_table": run.table,
        "k_curves": clusters.k_curves(run.table),
        "centroids": centroids,
        "profile": clusters.cluster_profile(assigned, "cluster", features),
        "differences": clusters.cluster_differences(centroids, top),
        "sizes": sizes,
        "histograms": lambda: clusters.cluster_feature_histograms(assigned, "cluster", features),
        "assigned": assigned,
    })
    if len(features) >= 2:
        tables["scatter"] = lambda: project_2d(assigned, features).select("pc1", "pc2", "cluster")
    entries = F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("v")) for m in clusters.K_METRICS])
    by_k = run.table.select(F.col("k").cast("string").alias("item"), F.explode(entries).alias("e")).select(
        F.lit("k_table").alias("section"), "item", F.col("e.m").alias("metric"), F.col("e.v").alias("value"))
    by_size = sizes.select(F.lit("cluster_sizes").alias("section"), F.col("cluster").cast("string").alias("item"),
                           F.lit("n").alias("metric"), F.col("n").cast("double").alias("value"))
    chosen = train_rows.sparkSession.createDataFrame([("clustering", method, "best_k", float(k))], LONG)
    return JobResult("cluster", tables, {"best_k": k, "method": method}, run.model(k), clusters=run,
                     long=union_long([chosen, by_k, by_size]))


def cluster(df: DataFrame, spec: Spec, method: str = "silhouette", save_to: str | None = None,
            run_id: str | None = None, log_path: str | None = None, results_to: str | None = None,
            dataset_path: str | None = None) -> JobResult:
    """Cluster the training rows of the split; a target, if named, must exist and is not used. ``results_to`` gets the k table, centroids
    (a folder for each k), the analysis of the chosen clusters and the features that tell them apart."""
    if spec.target is not None and spec.target not in df.columns:
        raise ValueError(f"target column {spec.target!r} not found")
    split = _persisted_split(df, spec)  # read by the fits and by every table that describes the clusters
    result = cluster_train(split.where("split = 'train'").drop("split"), spec, method)
    result.cached.append(split)
    if save_to:
        result.values["model_path"] = save_model(result.model, save_to, f"kmeans_k{result.values['best_k']}", run_id)
    k = result.values["best_k"]
    best = result.tables["k_table"].where(F.col("k") == k).first().asDict()
    result.values |= {f"best_{m}": best[m] for m in clusters.K_METRICS}
    if results_to:
        folder = results_to.rstrip("/")
        write_csv(result.tables["k_table"], f"{folder}/k_table")
        write_centroids(result.tables["centroids"], f"{folder}/centroids")
        write_json(result.tables["profile"], f"{folder}/cluster_analysis")
        write_csv(result.tables["differences"], f"{folder}/differences")
    _log(result, df, spec, log_path, dataset_path)
    return result


# --- everything --------------------------------------------------------------------------------


def report_tables(results: list[JobResult]) -> DataFrame:
    """(job, section, item, metric, value): what all given jobs found."""
    return union_long([r.long.select(F.lit(r.job).alias("job"), "*") for r in results])


def full(df: DataFrame, spec: Spec, method: str = "silhouette") -> list[JobResult]:
    """Summary, baseline, tuning and clustering over one split; the first failure stops the job."""
    results = [data_summary(df, spec)]
    data = prepare(df, spec)
    try:
        results.append(train_prepared(data, spec, "baseline"))
        results.append(tune_prepared(data, spec))
        results.append(cluster_train(data.train.drop("label"), spec, method))
    finally:
        data.close()
    return results
