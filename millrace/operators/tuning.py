"""Cross-validation and two-stage parameter search."""

from __future__ import annotations

import hashlib
import itertools
import math
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import quoted, spread
from millrace.operators import gram, logit
from millrace.operators.metrics import REGRESSION, check_metrics, score_parts
from millrace.operators.models import MAX_DEPTH, LabelStats, _resolve, feature_subset, fit_model, forest, tree_size
from millrace.operators.preprocess import fit_by_fold, learn_by_fold, preprocessor
from millrace.operators.splits import kfold, stratified_kfold
from millrace.spec import Spec

SCORE_SCHEMA = "candidate string, fold int, part string, metric string, score double, seconds double"


@dataclass(frozen=True)
class Candidate:
    """A model to be cross-validated."""

    name: str
    kind: str
    params: Mapping[str, Any] = field(default_factory=dict)

    def fingerprint(self, task: str) -> str:
        """Equal for candidates that Spark would fit identically."""
        p = _resolve(self.kind, self.params, task)
        if "max_depth" in p:
            p.update(tree_size(p), split=max(int(p["min_samples_split"]), 2 * int(p["min_samples_leaf"])))
            for name in ("max_depth", "min_samples_split", "min_samples_leaf"):
                del p[name]
        if "max_features" in p:
            p["max_features"] = feature_subset(p["max_features"], task)
        return repr((self.kind, sorted(p.items(), key=lambda kv: kv[0])))


def with_folds(df: DataFrame, spec: Spec) -> DataFrame:
    """Add ``fold``: class-balanced for classification, plain for regression."""
    if spec.is_classification:
        return stratified_kfold(df, "label", spec.key, spec.folds, spec.seed)
    return kfold(df, spec.key, spec.folds, spec.seed, () if spec.fold_shuffle else (spec.order_by or spec.key))


def fold_stats(df: DataFrame, spec: Spec) -> tuple[dict[int, int], dict[int, LabelStats]]:
    """Rows per fold, and label statistics of "all folds but f", from one grouped pass."""
    sizes: dict[int, int] = {}
    out: dict[int, LabelStats] = {}
    if spec.is_classification:
        rows = df.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()
        for r in rows:
            sizes[r["fold"]] = sizes.get(r["fold"], 0) + r["n"]
        for f in sizes:
            counts: dict[float, int] = {}
            for r in rows:
                if r["fold"] != f:
                    counts[r["label"]] = counts.get(r["label"], 0) + r["n"]
            out[f] = LabelStats(sum(counts.values()), 0.0, tuple(sorted(counts.items())))
        return sizes, out
    rows = df.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("m"),
                                  F.var_pop("label").alias("v")).collect()
    sizes = {r["fold"]: r["n"] for r in rows}
    for f in sizes:
        rest = [r for r in rows if r["fold"] != f]
        n = sum(r["n"] for r in rest)
        mean = sum(r["n"] * r["m"] for r in rest) / n
        out[f] = LabelStats(n, math.sqrt(sum(r["n"] * (r["v"] + (r["m"] - mean) ** 2) for r in rest) / n))
    return sizes, out


def cross_validate(
    df: DataFrame, spec: Spec, candidates: Sequence[Candidate], metrics: Sequence[str] | None = None
) -> DataFrame:
    """Scores of every candidate, fold, part (train and test) and metric, as a long table.

    ``df`` has columns label and fold. Preprocessing is learned inside each fold but in
    shared passes, and is common to all candidates. Only the raw rows are cached, once; the encoded
    rows are cheap expressions over them. All folds of a candidate are scored by one set of jobs.
    Logistic regressions of two classes score rows by arithmetic on the cached columns (``logit``). Ridges come from the folds' products, one pass for all of them, unless the rows are too wide for that or there is no penalty (see ``gram``).
    """
    metrics = list(metrics or spec.scoring)
    check_metrics(metrics, spec.task)
    used = dict.fromkeys([*spec.numeric, *spec.categorical, "label", "fold"])
    base = spread(df.select(*[quoted(c) for c in used]), spec.fit_partitions).persist()
    try:
        sizes, stats = fold_stats(base, spec)
        learned = learn_by_fold(base, spec, sorted(sizes))
        n_classes = max(len(s.counts) for s in stats.values())
        unique: dict[str, Candidate] = {}
        for c in candidates:
            unique.setdefault(c.fingerprint(spec.task), c)
        ridges = {mark: p for mark, c in unique.items() if c.kind == "ridge" and gram.fits(spec, p := _resolve(c.kind, c.params, spec.task), learned)}
        results = gram.ridge_scores(base, learned, ridges, {m: REGRESSION[m] for m in metrics}) if ridges else {}
        others = {mark: c for mark, c in unique.items() if mark not in ridges}
        encoders = fit_by_fold(base, spec, sorted(sizes), learned) if others else {}

        outer = max(1, min(len(others), spec.parallelism))
        inner = max(1, spec.parallelism // outer)

        def fit(candidate: Candidate, fold: int):
            start = time.monotonic()
            train = encoders[fold].transform(base.where(F.col("fold") != fold)).select("features", "label")
            model = fit_model(train, candidate.kind, candidate.params, spec, stats[fold])
            return model, time.monotonic() - start

        def scored(fold: int, model) -> DataFrame:
            out = model.transform(encoders[fold].transform(base))
            part = F.when(F.col("fold") == fold, "test").otherwise("train")
            columns = [F.lit(fold).alias("held_out"), part.alias("part"), "label", "prediction"]
            if spec.is_classification:
                columns.append(vector_to_array("probability").alias("probability"))
            return out.select(*columns)

        def run(candidate: Candidate) -> tuple[dict[tuple, dict[str, float]], dict[int, float]]:
            """Fit all folds, score them together, keep only the numbers."""
            folds = sorted(stats)
            with ThreadPoolExecutor(inner) as pool:
                fits = dict(zip(folds, pool.map(lambda f: fit(candidate, f), folds)))
            if logit.fits(spec, candidate.kind, learned, stats):
                together = logit.scored(base, learned, {f: logit.coefficients(m) for f, (m, _) in fits.items()})
            else:
                together = reduce(DataFrame.unionAll, [scored(f, m) for f, (m, _) in fits.items()]).persist()
            try:
                values = score_parts(together, metrics, spec.task, ["held_out", "part"], n_classes,
                                     sum(sizes.values()))
            finally:
                together.unpersist()
            return values, {f: seconds for f, (_, seconds) in fits.items()}

        with ThreadPoolExecutor(outer) as pool:
            results.update(zip(others, pool.map(run, others.values())))
        rows = []
        for c in candidates:
            values, seconds = results[c.fingerprint(spec.task)]
            for (fold, part), by_metric in values.items():
                rows += [(c.name, fold, part, m, float(v), seconds[fold]) for m, v in by_metric.items()]
    finally:
        base.unpersist()
    return df.sparkSession.createDataFrame(rows, SCORE_SCHEMA)


def cv_summary(scores: DataFrame) -> DataFrame:
    """(candidate, part, metric, mean, std, scores): population std, scores in fold order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("fold", "score"))), lambda s: s["score"])
    return scores.groupBy("candidate", "part", "metric").agg(
        F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"), ordered.alias("scores")
    )


def model_comparison(scores: DataFrame, primary: str = "roc_auc") -> DataFrame:
    """One row per candidate: test mean of each metric, std of the primary, time; best first."""
    test = scores.where("part = 'test'")
    times = test.groupBy("candidate", "fold").agg(F.max("seconds").alias("s")).groupBy("candidate").agg(
        F.sum("s").alias("seconds"))
    names = [r["metric"] for r in test.select("metric").distinct().orderBy("metric").collect()]
    means = test.groupBy("candidate").agg(
        *[F.avg(F.when(F.col("metric") == m, F.col("score"))).alias(m) for m in names],
        F.stddev_pop(F.when(F.col("metric") == primary, F.col("score"))).alias(f"{primary}_std"),
    )
    return means.join(times, "candidate").orderBy(F.desc(primary), "candidate")


# --- search ----------------------------------------------------------------------------------


def grid_candidates(space: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    names = sorted(space)
    return [dict(zip(names, values)) for values in itertools.product(*[space[n] for n in names])]


def sample_candidates(space: Mapping[str, Sequence[Any]], n: int, seed: int) -> list[dict[str, Any]]:
    """``n`` grid points without replacement, in a seeded hash order; all of them if fewer."""
    grid = grid_candidates(space)
    order = sorted(range(len(grid)), key=lambda i: hashlib.md5(f"{i}|{seed}".encode()).hexdigest())
    return [grid[i] for i in order[:n]]


# Step and lowest value of the refined search, per whole-number parameter.
REFINE_STEPS = {"n_estimators": (50, 50), "min_samples_split": (2, 2), "min_samples_leaf": (1, 1)}
REFINE_DEPTH = (5, 5)
REFINE_OPEN_DEPTHS = [None, 20, 25, 30]
REFINE_SUBSETS = ["sqrt", "log2"]
REFINE_FRACTION = (0.1, 0.1, 1.0)


def refine_grid(best: Mapping[str, Any]) -> dict[str, list[Any]]:
    """The neighbourhood of the best parameters; values clipped onto each other are kept once."""

    def neighbours(name: str, value: Any) -> list[Any]:
        if name in REFINE_STEPS:
            step, low = REFINE_STEPS[name]
            return [max(low, value - step), value, value + step]
        if name == "max_depth":
            step, low = REFINE_DEPTH
            # deeper than Spark grows is the same as no limit, which is in the list
            return REFINE_OPEN_DEPTHS if value is None else [d for d in (max(low, value - step), value, value + step, None) if d is None or d <= MAX_DEPTH]
        if name == "max_features" and isinstance(value, str):
            return REFINE_SUBSETS
        if name == "max_features" and value is not None:
            step, low, high = REFINE_FRACTION
            return [max(low, round(value - step, 10)), value, min(high, round(value + step, 10))]
        return [value]

    return {name: list(dict.fromkeys(neighbours(name, value))) for name, value in best.items()}


@dataclass
class SearchResult:
    """Outcome of one search stage."""

    stage: str
    params: list[dict[str, Any]]
    scores: DataFrame  # candidate, params, fold, train_score, test_score
    ranking: DataFrame  # candidate, params, mean_test, std_test, mean_train, std_train, seconds, rank
    best_params: dict[str, Any]
    best_score: float
    seconds: float


def search_table(scores: DataFrame, params: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """(candidate, params, fold, train_score, test_score, seconds) from long scores of one metric."""
    spark = scores.sparkSession
    named = spark.createDataFrame(
        [(name, {k: str(v) for k, v in p.items()}) for name, p in params.items()],
        "candidate string, params map<string,string>",
    )
    wide = scores.groupBy("candidate", "fold").agg(
        F.max(F.when(F.col("part") == "train", F.col("score"))).alias("train_score"),
        F.max(F.when(F.col("part") == "test", F.col("score"))).alias("test_score"),
        F.max("seconds").alias("seconds"),
    )
    return wide.join(named, "candidate")


def rank_candidates(table: DataFrame) -> DataFrame:
    """Mean and population std per candidate, ranked by mean test score, equal means sharing a rank."""
    summary = table.groupBy("candidate").agg(
        F.first("params").alias("params"),
        F.avg("test_score").alias("mean_test"), F.stddev_pop("test_score").alias("std_test"),
        F.avg("train_score").alias("mean_train"), F.stddev_pop("train_score").alias("std_train"),
        F.sum("seconds").alias("seconds"),
    )
    # one row per candidate
    return summary.withColumn("rank", F.rank().over(Window.orderBy(F.desc("mean_test"))))


def search(df: DataFrame, spec: Spec, stage: str, candidates: Sequence[Mapping[str, Any]]) -> SearchResult:
    """Cross-validate forests with the given parameters on the primary metric."""
    start = time.monotonic()
    if not candidates:
        raise ValueError("nothing to search")
    names = [f"{stage}_{i:04d}" for i in range(len(candidates))]
    models = [Candidate(n, *forest(spec, **p)) for n, p in zip(names, candidates)]
    scores = cross_validate(df, spec, models, [spec.primary])
    params = dict(zip(names, candidates))
    table = search_table(scores, params)
    ranking = rank_candidates(table)
    top = ranking.orderBy("rank", "candidate").first()
    return SearchResult(stage, list(candidates), table, ranking, dict(params[top["candidate"]]),
                        top["mean_test"], time.monotonic() - start)


def random_search(df: DataFrame, spec: Spec) -> SearchResult:
    return search(df, spec, "random", sample_candidates(spec.search_space, spec.search_iterations, spec.seed))


def grid_search(df: DataFrame, spec: Spec, best: Mapping[str, Any]) -> SearchResult:
    """Exhaustive search of the refined grid; ``max_candidates`` refuses grids that are too large."""
    candidates = grid_candidates(refine_grid(best))
    if spec.max_candidates is not None and len(candidates) > spec.max_candidates:
        raise ValueError(f"refined grid has {len(candidates)} candidates, more than {spec.max_candidates}")
    return search(df, spec, "grid", candidates)


def refit(df: DataFrame, spec: Spec, kind: str, params: Mapping[str, Any]) -> PipelineModel:
    """Preprocessing and model fitted on all given rows, as one model."""
    encoder = preprocessor(spec).fit(df)
    used = dict.fromkeys([*spec.numeric, *spec.categorical, "label"])
    dealt = spread(df.select(*[quoted(c) for c in used]), spec.fit_partitions)
    ready = encoder.transform(dealt).select("features", "label").persist()
    try:
        model = fit_model(ready, kind, params, spec)
    finally:
        ready.unpersist()
    return PipelineModel([*encoder.stages, model])
